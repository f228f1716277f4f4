"""One registered query per operator: the operator on its whole table, and the digest columns drawn from its output."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import configure
from . import chosen_path, collocations, decontaminate, fill_middle, licenses, mixing, pitman_yor, quality_rules, sharding, simhash, substrings, toxicity, urls

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Near-duplicate groups: three-word shingles, 64-bit fingerprints, links at three differing bits or fewer."""
    return simhash.simhash_groups(_read(spark, sf_dir, "documents"), shingle=3, most=3).select("doc_id", "fingerprint", "component_id")


@query
def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Base counts and the verdict of the certified cutoffs."""
    verdicts = quality_rules.quality_verdicts(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels"))
    return verdicts.select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept")


@query
def op3_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of each document by the lexicon and weights learned from two thirds of the labelled ones."""
    return toxicity.score_toxicity(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "labels")).select("doc_id", "held_out", "score", "predicted")


@query
def op4_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words left of each document without windows of 20 words that occurred before."""
    kept = substrings.without_repeats(_read(spark, sf_dir, "documents"), window=20)
    return kept.select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query
def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a mix of 150 % of all words takes of each document, sources weighing 5, 2, 1 in turn."""
    return mixing.mix(_read(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken")


@query
def op6_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Log10 probability of each document under a hierarchical Pitman-Yor model of four fifths of them."""
    scored = pitman_yor.score_documents(_read(spark, sf_dir, "documents"))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score")


@query
def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words of each document inside any 13-word window of a benchmark item."""
    found = decontaminate.find_contamination(_read(spark, sf_dir, "documents"), _read(spark, sf_dir, "benchmark"), window=13)
    return decontaminate.contaminated(found).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("bigint").alias("n_items"), F.sha2(F.concat_ws(",", "items"), 256).alias("items_sha256"), "contaminated"
    )


@query
def op8_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Forty shards of near-equal bytes."""
    placed = sharding.kd_shards(_read(spark, sf_dir, "documents"), shards=40)
    return placed.select("doc_id", "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))


@query
def op9_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Licence phrases and covered licence wording of each document."""
    found = licenses.scan_licenses(_read(spark, sf_dir, "documents"))
    return found.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score")


@query
def op10_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verdict per page: the rules, else the reputation of the host from the outcomes labelled under the page's id."""
    bad = F.when((F.col("quality") == 0) | (F.col("toxic") == 1), 1).otherwise(0)
    outcomes = _read(spark, sf_dir, "labels").select(F.col("doc_id").alias("page_id"), bad.alias("bad"))
    return urls.filter_urls(_read(spark, sf_dir, "pages"), outcomes).select("page_id", "host", "path", "rule", "verdict")


@query
def op11_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of two to five words of each language, found in 100 places at least."""
    return collocations.collocations(_read(spark, sf_dir, "documents"), least=100, longest=5, top=2000)


@query
def op12_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of documents that share 85 % of their three-word shingles, and the first of each."""
    found = chosen_path.near_duplicates(_read(spark, sf_dir, "documents"), size=3, percent=85)
    return found.select("doc_id", "n_shingles", "component_id", F.col("doc_id").eqNullSafe(F.col("component_id")).alias("kept"))


@query
def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fill-in-the-middle form of each document, with hashes of the output and of the text rebuilt from it."""
    made = fill_middle.fill_in_middle(_read(spark, sf_dir, "documents"), seed=1, plain_percent=10, spm_percent=20)
    return made.select(
        "doc_id", "n", "form", "prefix_chars", "middle_chars", F.sha2("output", 256).alias("output_sha256"), F.sha2(fill_middle.restored(), 256).alias("restored_sha256")
    )


# Words by position; a window's first place is the least (doc_id, start) of its words.
ORACLES["op4_substring_dedup"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
  win AS (SELECT doc_id, i, array_to_string(w[i : i + 19], ' ') AS k FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS i FROM d WHERE len(w) >= 20)),
  again AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY k ORDER BY doc_id, i) AS r FROM win) WHERE r > 1),
  gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 20)) AS p FROM again),
  word AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS p FROM d),
  kept AS (SELECT doc_id, string_agg(x, ' ' ORDER BY p) AS t FROM word ANTI JOIN gone USING (doc_id, p) GROUP BY 1),
  n AS (SELECT doc_id, count(*) AS n FROM gone GROUP BY 1)
SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, cast(coalesce(n, 0) AS BIGINT) AS n_removed, sha256(coalesce(t, '')) AS kept_sha256
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN kept USING (doc_id)
"""

ORACLES["op7_decontamination"] = r"""
WITH d AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
  b AS (SELECT coalesce(cast(item_id AS VARCHAR), '') AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
  phrase AS (SELECT DISTINCT item, least(len(w), 13) AS n, array_to_string(w[i : i + 12], ' ') AS k FROM (SELECT item, w, unnest(range(1, greatest(len(w) - 12, 1) + 1)) AS i FROM b WHERE len(w) > 0)),
  win AS (SELECT doc_id, n, i, array_to_string(w[i : i + n - 1], ' ') AS k FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d JOIN (SELECT DISTINCT n FROM phrase) ON len(w) >= n)),
  hit AS (SELECT doc_id, i, win.n, item FROM win JOIN phrase ON win.k = phrase.k AND win.n = phrase.n),
  covered AS (SELECT doc_id, count(DISTINCT p) AS n_hit FROM (SELECT doc_id, unnest(range(i, i + n)) AS p FROM hit) GROUP BY 1),
  items AS (SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item FROM hit) GROUP BY 1)
SELECT doc_id, cast(len(w) AS BIGINT) AS n_words, cast(coalesce(n_hit, 0) AS BIGINT) AS n_hit, cast(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit > 0 AND 20 * n_hit >= len(w), false) AS contaminated
FROM d LEFT JOIN covered USING (doc_id) LEFT JOIN items USING (doc_id)
"""

ORACLES["op11_collocations"] = r"""
WITH d AS (SELECT coalesce(lang, 'und') AS lang, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents),
  p AS (SELECT lang, regexp_extract_all(unnest(regexp_split_to_array(t, '[.,;:!?\x0A-\x0D]')), '[^\x20\x09]+') AS w FROM d),
  total AS (SELECT lang, cast(sum(len(w)) AS BIGINT) AS n FROM p GROUP BY 1),
  g AS (SELECT lang, k, w[i : i + k - 1] AS g FROM (SELECT lang, w, k, unnest(range(1, len(w) - k + 2)) AS i FROM p, (SELECT unnest(range(1, 6)) AS k) WHERE len(w) >= k)),
  f AS (SELECT lang, k, g, count(*) AS a FROM g GROUP BY ALL HAVING count(*) >= 100),
  cut AS (SELECT lang, k, g, a, unnest(range(1, k)) AS c FROM f WHERE k > 1),
  scored AS (SELECT cut.lang, cut.k, cut.g, cut.a, c, x.a AS l, y.a AS r, n, cast((1000::HUGEINT * cut.a * n) // (x.a::HUGEINT * y.a) AS BIGINT) AS score
    FROM cut JOIN f x ON x.lang = cut.lang AND x.g = cut.g[1 : c] JOIN f y ON y.lang = cut.lang AND y.g = cut.g[c + 1 : cut.k] JOIN total ON total.lang = cut.lang),
  best AS (SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, g ORDER BY score, c) = 1),
  inside AS (SELECT lang, g[i : i + m - 1] AS g, max(a) AS a FROM (SELECT lang, g, a, m, unnest(range(1, k - m + 2)) AS i FROM f, (SELECT unnest(range(2, 5)) AS m) WHERE k > m) GROUP BY ALL),
  kept AS (SELECT lang, array_to_string(g, ' ') AS phrase, a, l, r, n, score FROM best WHERE NOT EXISTS (SELECT 1 FROM inside i WHERE i.lang = best.lang AND i.g = best.g AND i.a >= best.a))
SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) AS rank, phrase, a, l, r, n, score
FROM kept QUALIFY row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, phrase) <= 2000
"""

ORACLES["op13_fill_in_middle"] = r"""
WITH u AS (SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS u, sha256('1:' || doc_id) AS h FROM documents),
  d AS (SELECT doc_id, t, u, cast(len(u) AS BIGINT) AS n, cast('0x' || substr(h, 1, 8) AS BIGINT) AS h1, cast('0x' || substr(h, 9, 8) AS BIGINT) AS h2,
    cast('0x' || substr(h, 17, 8) AS BIGINT) AS h3, cast('0x' || substr(h, 25, 8) AS BIGINT) AS h4 FROM u),
  c AS (SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR h3 % 100 >= 90 THEN 'plain' WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM d),
  p AS (SELECT doc_id, t, n, form, coalesce(array_to_string(u[1 : a], ''), '') AS x, coalesce(array_to_string(u[a + 1 : b], ''), '') AS y, coalesce(array_to_string(u[b + 1 :], ''), '') AS z FROM c)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(x) END AS prefix_chars, CASE WHEN form <> 'plain' THEN length(y) END AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || x || '<S>' || z || '<M>' || y ELSE '<S>' || z || '<P>' || x || '<M>' || y END) AS output_sha256, sha256(t) AS restored_sha256
FROM p
"""
