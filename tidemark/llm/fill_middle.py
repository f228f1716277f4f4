"""Fill-in-the-middle training texts: prefix, middle and suffix from one counted-quantifier match. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A unit is a run of ASCII letters or any other single code point.
UNITS = "[A-Za-z]+|[^A-Za-z]"
# The same inside a counted group. Possessive, so the engine loops over the units and never goes back or deeper.
ONE = "(?:[A-Za-z]++|[^A-Za-z])"
PRE, SUF, MID = "<P>", "<S>", "<M>"


def draws(doc_id: str, seed: int = 1) -> list[Column]:
    """Four unsigned 32-bit numbers from the SHA-256 of ``seed:doc_id``; a null id counts as no digits."""
    digest = F.sha2(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col(doc_id).cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 8 * i + 1, 8), 16, 10).cast("bigint") for i in range(4)]


def fill_in_middle(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", seed: int = 1, plain_percent: int = 10, spm_percent: int = 20) -> DataFrame:
    """``(doc_id, n, form, prefix_chars, middle_chars, text, output)``, one row per row of ``docs``.

    ``n`` counts the units of the text. Two draws cut it into prefix, middle and suffix by whole units, a third keeps
    ``plain_percent`` of the texts as they are, a fourth gives ``spm_percent`` of the others the order suffix, prefix,
    middle in place of prefix, suffix, middle. A row's pattern counts its own units with possessive quantifiers, so
    one match captures all three parts, whatever the length of the text. Lengths are in code points, null if plain.

    A null text is empty, and an empty text, or one that holds a marker already, stays plain. Malformed UTF-8 is
    replaced by U+FFFD first, and ``text`` is the text after that. A null id draws like one without digits; repeated
    rows and equal ids draw alike. Other columns are not passed on and may have any name. No rows give no rows.
    """
    whole = docs.select(F.col(f"`{doc_id}`").alias("doc_id"), F.make_valid_utf8(F.coalesce(F.col(f"`{text}`").cast("string"), F.lit(""))).alias("text"))
    h1, h2, h3, h4 = draws("doc_id", seed)
    marked = F.contains("text", F.lit(PRE)) | F.contains("text", F.lit(SUF)) | F.contains("text", F.lit(MID))
    plain = (F.col("text") == "") | marked | (h3 % 100 >= 100 - plain_percent)
    form = F.when(plain, "plain").when(h4 % 100 < spm_percent, "spm").otherwise("psm")
    cuts = whole.withColumns({"n": F.regexp_count("text", F.lit(UNITS)).cast("bigint"), "form": form})
    cuts = cuts.withColumns({"a": F.least(h1 % (F.col("n") + 1), h2 % (F.col("n") + 1)), "b": F.greatest(h1 % (F.col("n") + 1), h2 % (F.col("n") + 1))})
    pattern = F.format_string(f"(?s)^(%s{{%d}}+)(%s{{%d}}+)(.*)$", F.lit(ONE), F.col("a"), F.lit(ONE), F.col("b") - F.col("a"))
    order = F.when(F.col("form") == "psm", f"{PRE}$1{SUF}$3{MID}$2").otherwise(f"{SUF}$3{PRE}$1{MID}$2")
    made = cuts.withColumn("output", F.when(F.col("form") == "plain", F.col("text")).otherwise(F.regexp_replace("text", pattern, order)))
    at = {m: F.instr("output", F.lit(m)) for m in (PRE, SUF, MID)}
    prefix = F.when(F.col("form") == "psm", at[SUF] - at[PRE] - len(PRE)).when(F.col("form") == "spm", at[MID] - at[PRE] - len(PRE))
    middle = F.when(F.col("form") != "plain", F.char_length("output") - at[MID] - len(MID) + 1)
    return made.select("doc_id", "n", "form", prefix.cast("bigint").alias("prefix_chars"), middle.cast("bigint").alias("middle_chars"), "text", "output")


def restored(output: str = "output", form: str = "form") -> Column:
    """The text from its output and form alone; the markers are the first ones, as no part holds or completes another."""
    psm = F.regexp_replace(output, f"(?s)^{PRE}(.*?){SUF}(.*?){MID}(.*)$", "$1$3$2")
    spm = F.regexp_replace(output, f"(?s)^{SUF}(.*?){PRE}(.*?){MID}(.*)$", "$2$3$1")
    return F.when(F.col(form) == "psm", psm).when(F.col(form) == "spm", spm).otherwise(F.col(output))
