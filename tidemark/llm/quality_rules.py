"""Quality rules whose cutoffs are certified on labelled documents. DataFrame and SQL functions only."""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .shared import table, whole_row

# Rules: a document fails if the measure lies beyond the cutoff; cutoffs are listed from harmless to strict.
# (measure as SQL over the features, "above" or "below", candidate cutoffs)
RULES = {
    "symbols": ("n_symbols / greatest(word_chars, 1)", "above", [0.5, 0.4, 0.3, 0.25, 0.2, 0.15, 0.1, 0.07, 0.05, 0.03]),
    "dup_lines": ("n_dup_lines / greatest(n_lines, 1)", "above", [0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.15, 0.1]),
    "repeats": ("n_repeat_words / greatest(n_words, 1)", "above", [0.45, 0.4, 0.35, 0.3, 0.25, 0.2, 0.15, 0.1, 0.08, 0.05]),
    "upper": ("n_upper / greatest(word_chars, 1)", "above", [0.95, 0.9, 0.8, 0.7, 0.6, 0.5, 0.4, 0.3, 0.2, 0.15]),
    "marks": ("n_marks / greatest(n_words, 1)", "above", [1.5, 1.2, 1.0, 0.8, 0.6, 0.4, 0.3, 0.2, 0.15, 0.1]),
    "long_words": ("word_chars / greatest(n_words, 1)", "above", [40.0, 30.0, 25.0, 20.0, 18.0, 16.0, 14.0, 12.0, 11.0, 10.0]),
    "short_words": ("word_chars / greatest(n_words, 1)", "below", [1.2, 1.5, 1.8, 2.0, 2.3, 2.6, 2.8, 3.0, 3.2, 3.5]),
}

BLANKS = " \t\n\x0b\x0c\r"
# Share of good documents that all rules together may reject, in every stratum.
RATE = 0.03

SPACE = r"[\x20\x09-\x0D]+"


def _adjacent_repeats() -> Column:
    """Places of three-word windows that occur twice or more, rising, from the sorted window codes ``s``.

    A code holds 40 bits of a window's hash above 24 bits of its place. Equal windows are neighbours in ``s``;
    neighbours are compared word by word, so that a collision of hashes adds nothing.
    """
    place = lambda k: (F.element_at("s", k).bitwiseAND(F.lit(2**24 - 1))).cast("int")
    word = lambda k, i: F.get("w", place(k) + i)

    def equal(k):
        same = F.shiftright(F.element_at("s", k), 24) == F.shiftright(F.element_at("s", k + 1), 24)
        return same & (word(k, 0) == word(k + 1, 0)) & (word(k, 1) == word(k + 1, 1)) & (word(k, 2) == word(k + 1, 2))

    pairs = F.filter(F.sequence(F.lit(1), F.size("s") - 1), equal)
    return F.sort_array(F.array_distinct(F.flatten(F.transform(pairs, lambda k: F.array(place(k), place(k + 1))))))


def _covered() -> Column:
    """Words covered by the windows at the places ``p``: three each, or as many as lie before the next one."""
    gaps = F.transform(F.sequence(F.lit(1), F.size("p") - 1), lambda k: F.least(F.lit(3), F.element_at("p", k + 1) - F.element_at("p", k)))
    return F.when(F.size("p") < 2, F.lit(0)).otherwise(F.aggregate(gaps, F.lit(3), lambda a, g: a + g)).cast("bigint")


def features(docs: DataFrame) -> DataFrame:
    """One row of text measures per row of ``docs``: ``__did, __row, doc_id, stratum`` and the counts the rules use.

    Words are what lies between ASCII white space; a null or empty text has none and all its counts are 0.
    ``stratum`` is the document's ``lang`` (``?`` where it is null or there is no such column). Everything is
    worked out within the row, so a text stays where it was read; texts may have up to 2^24 words.
    """
    lang = F.coalesce(F.col("lang").cast("string"), F.lit("?")) if "lang" in docs.columns else F.lit("?")
    gone = lambda marks: F.length("t") - F.length(F.translate("t", marks, ""))
    has_word = lambda x: F.length(F.btrim(x, F.lit(BLANKS))) > 0
    code = lambda i: F.xxhash64(F.get("w", i), F.get("w", i + 1), F.get("w", i + 2)).bitwiseAND(F.lit(-(2**24))).bitwiseOR(i.cast("bigint"))
    out = docs.select(
        *whole_row(docs), F.col("doc_id").cast("bigint").alias("doc_id"), lang.alias("stratum"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("t"),
    )
    out = out.withColumn("bare", F.btrim("t", F.lit(BLANKS)))
    out = out.withColumn("w", F.when(F.length("bare") > 0, F.split("bare", SPACE)).otherwise(F.array().cast("array<string>")))
    out = out.withColumn("n", F.size("w"))
    out = out.withColumn("s", F.when(F.col("n") > 3, F.sort_array(F.transform(F.sequence(F.lit(0), F.col("n") - 3), code))))
    out = out.withColumn("p", F.when(F.col("n") > 3, _adjacent_repeats()).otherwise(F.array().cast("array<int>")))
    out = out.withColumn("lines", F.filter(F.split("t", "\n"), has_word))
    return out.select(
        "__did", "__row", "doc_id", "stratum", F.col("n").cast("bigint").alias("n_words"),
        (F.length("t") - gone(BLANKS)).cast("bigint").alias("word_chars"),
        gone("#*$%&|<>").cast("bigint").alias("n_symbols"),
        (F.size("lines") - F.size(F.array_distinct("lines"))).cast("bigint").alias("n_dup_lines"),
        _covered().alias("n_repeat_words"),
        F.size("lines").alias("n_lines"),
        gone("ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_upper"), gone("!?").alias("n_marks"),
    )


def base_failed() -> Column:
    return F.expr("n_words < 50 OR 100 * n_repeat_words > 50 * n_words")


def most_rejected(n: Column, rate: float, level: Column) -> Column:
    """Largest k with P(Binomial(n, rate) <= k) <= level, -1 if there is none: the exact one-sided binomial test.

    With at most k of n good documents rejected, the exact upper bound (confidence 1 - level) of the rate of
    false rejection is at most ``rate``. Terms are carried as logarithms, so that none underflows. For large n the sum
    starts forty deviations below n * rate, before which less than e^-700 lies, so it has a few sqrt(n * rate) terms.
    """
    def step(a, _):
        cdf = a["cdf"] + F.exp(a["term"])
        odds = F.log((n - a["k"]) / (a["k"] + 1)) + F.log(F.lit(rate / (1 - rate)))
        return F.struct((a["k"] + 1).alias("k"), (a["term"] + odds).alias("term"), cdf.alias("cdf"), F.when(cdf <= level, a["k"]).otherwise(a["best"]).alias("best"))

    def log_factorial(x):  # Stirling's series, for x of 100 or more
        return (x + 0.5) * F.log(x) - x + 0.5 * math.log(2 * math.pi) + 1 / (12 * x) - 1 / (360 * x * x * x)

    low = F.floor(n * rate - 40 * F.sqrt(n * rate)).cast("double")
    low = F.when(low >= 100, low).otherwise(F.lit(0.0))
    ways = log_factorial(n) - log_factorial(low) - log_factorial(n - low)
    first = F.when(low > 0, ways + low * math.log(rate)).otherwise(F.lit(0.0)) + (n - low) * math.log1p(-rate)
    start = F.struct(low.alias("k"), first.alias("term"), F.lit(0.0).alias("cdf"), (low - 1).alias("best"))
    # Beyond the expected number the sum exceeds any level below one half.
    return F.aggregate(F.sequence(low.cast("bigint"), F.floor(n * rate).cast("bigint")), start, step, lambda a: a["best"])


def certify(feats: DataFrame, labels: DataFrame, rate: float = RATE, confidence: float = 0.95) -> DataFrame:
    """Cutoffs ``(stratum, rule, cutoff, n_good, n_rejected, n_allowed)``; no row where none can be certified.

    Looked at are all labelled good documents (``quality = 1``) that pass the base rules. Each rule may reject ``rate / number of
    rules`` of the good documents, so that together they reject at most ``rate`` in every stratum. A rule's cutoffs
    are tested in fixed order, from lax to strict, up to the first whose exact bound fails (fixed-sequence
    testing, which needs no share of the error level); the level ``1 - confidence`` is divided by the number of
    strata and rules (Bonferroni). So with this confidence all chosen cutoffs keep the promise at once. A doc_id labelled twice is good if any label says so; null
    ids and labels of unknown documents count nowhere; without good labels no rule applies.
    """
    assert 0 < rate < 0.5 < confidence < 1
    flat = [(r, i, c, F.expr(m) > c if way == "above" else F.expr(m) < c) for r, (m, way, cuts) in RULES.items() for i, c in enumerate(cuts)]
    good = labels.filter("quality = 1").select(F.col("doc_id").cast("bigint").alias("doc_id")).distinct()
    held = feats.filter(~base_failed()).join(good, "doc_id", "left_semi")
    counts = table(held.groupBy("stratum").agg(F.count("*").cast("double").alias("n_good"), *[F.sum(hit.cast("int")).alias(f"h{k}") for k, (*_, hit) in enumerate(flat)]), "holdout")
    level = F.lit((1 - confidence) / len(RULES) / max(1, counts.count()))
    tried = F.explode(F.array(*[F.struct(F.lit(r).alias("rule"), F.lit(i).alias("i"), F.lit(c).alias("cutoff"), F.col(f"h{k}").alias("n_rejected")) for k, (r, i, c, _) in enumerate(flat)]))
    rows = counts.withColumn("n_allowed", most_rejected(F.col("n_good"), rate / len(RULES), level)).select("stratum", "n_good", "n_allowed", tried.alias("r")).select("stratum", "n_good", "n_allowed", "r.*")
    stop = F.min(F.when(F.col("n_rejected") > F.col("n_allowed"), F.col("i")))
    per_rule = rows.groupBy("stratum", "rule").agg(stop.alias("stop"), F.collect_list(F.struct("i", "cutoff", "n_rejected", "n_good", "n_allowed")).alias("cuts"))
    best = F.expr("array_max(filter(cuts, x -> stop IS NULL OR x.i < stop))")
    return per_rule.withColumn("b", best).filter("b IS NOT NULL").select("stratum", "rule", "b.cutoff", "b.n_good", "b.n_rejected", "b.n_allowed")


def quality_verdicts(docs: DataFrame, labels: DataFrame, rate: float = RATE, confidence: float = 0.95) -> DataFrame:
    """The features of every row of ``docs``, ``base_failed`` and ``kept``.

    ``kept`` is false if the base rules fail or a certified cutoff of the document's stratum is crossed. Repeated
    rows are judged alike; extra columns are not read; an empty table gives no rows.
    """
    feats = table(features(docs), "quality")
    cuts = certify(feats, labels, rate, confidence).groupBy(F.col("stratum").alias("s")).pivot("rule", list(RULES)).agg(F.first("cutoff"))
    crossed = [F.coalesce(F.expr(m) > F.col(f"`{r}`") if way == "above" else F.expr(m) < F.col(f"`{r}`"), F.lit(False)) for r, (m, way, _) in RULES.items()]
    broken = crossed[0]
    for c in crossed[1:]:
        broken = broken | c
    judged = feats.join(cuts, F.col("stratum") == F.col("s"), "left")
    return judged.withColumn("base_failed", base_failed()).withColumn("kept", ~(F.col("base_failed") | broken)).select(*feats.columns, "base_failed", "kept")


def accepted(docs: DataFrame, labels: DataFrame, rate: float = RATE, confidence: float = 0.95) -> DataFrame:
    """The rows of ``docs`` that are kept, unchanged."""
    out = quality_verdicts(docs, labels, rate, confidence).filter(~F.col("kept")).select("__did", "__row")
    return docs.select(*whole_row(docs), "*").join(out, ["__did", "__row"], "left_anti").select(*docs.columns)
