"""Text clean-up, splitting and pattern helpers."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .numeric import _c


def slugify_name(name: str) -> str:
    """Plain-Python slug for column names."""
    slug = re.sub(r"[^a-z0-9_]+", "", re.sub(r"[ -]+", "_", name.lower()))
    return re.sub(r"^(\d)", r"_\1", slug)


def slugify(col: str | Column) -> Column:
    joined = F.regexp_replace(F.lower(_c(col)), "[ -]+", "_")
    return F.regexp_replace(F.regexp_replace(joined, "[^a-z0-9_]+", ""), "^([0-9])", "_$1")


def strip_suffix(col: str | Column) -> Column:
    """Drop one trailing ``-n`` or ``-n-n`` instance suffix."""
    return F.regexp_replace(_c(col), "(-[0-9]+){1,2}$", "")


def split_at(col: str | Column, delimiter: str, n: int) -> Column:
    """0-based part, negative from the end; NULL when out of range."""
    position = n + 1 if n >= 0 else n
    return F.try_element_at(F.split(_c(col), re.escape(delimiter)), F.lit(position))


def split_trim(col: str | Column, delimiter: str = ",") -> Column:
    return F.transform(F.split(_c(col), re.escape(delimiter)), lambda part: F.trim(part))


def id_parts(col: str | Column, n: int) -> tuple[Column, Column]:
    """Prefix of n characters and the numeric rest (NULL when it is no number)."""
    c = _c(col)
    return F.substring(c, 1, n), F.substring(c, n + 1, 2**31 - 1).try_cast("bigint")


def leading_int(col: str | Column) -> Column:
    return F.regexp_extract(_c(col), "^([0-9]+)", 1).try_cast("bigint")


def _duration_part(c: Column, unit: str) -> Column:
    return F.coalesce(F.regexp_extract(c, f"([0-9]+){unit}", 1).try_cast("bigint"), F.lit(0))


def iso8601_duration(col: str | Column) -> Column:
    """``PT1H2M3S`` as ``01:02:03``."""
    parts = [F.lpad(_duration_part(_c(col), u).cast("string"), 2, "0") for u in "HMS"]
    return F.concat_ws(":", *parts)


def iso8601_seconds(col: str | Column) -> Column:
    h, m, s = (_duration_part(_c(col), u) for u in "HMS")
    return h * 3600 + m * 60 + s


def platform_of(col: str | Column) -> Column:
    """Numeric store ids belong to iOS, all other ids to Android."""
    return F.when(_c(col).try_cast("bigint").isNotNull(), "IOS").otherwise("ANDROID")


def flag_text(col: str | Column) -> Column:
    c = _c(col)
    return F.when(c.isin("0", "0.0"), "False").when(c.isin("1", "1.0"), "True").otherwise(c)


def seconds_to_hms(col: str | Column) -> Column:
    """Seconds (also as a float string) to ``HH:MM:SS``, wrapping at 24 hours."""
    seconds = F.pmod(_c(col).cast("double").cast("bigint"), F.lit(86400))
    parts = [F.floor(seconds / 3600), F.floor(F.pmod(seconds, F.lit(3600)) / 60), F.pmod(seconds, F.lit(60))]
    return F.concat_ws(":", *[F.lpad(p.cast("string"), 2, "0") for p in parts])


def repair_json(col: str | Column) -> Column:
    """Quote bare keys and bare words so that pseudo-JSON such as ``{a: x, b: 1}`` parses."""
    keyed = F.regexp_replace(_c(col), r'([{,]\s*)"?([A-Za-z_][A-Za-z0-9_]*)"?\s*:', '$1"$2":')
    return F.regexp_replace(keyed, r":\s*(?!true|false|null)([A-Za-z_][A-Za-z0-9_ ]*)(?=\s*[,}\]])", ': "$1"')


def regexp_position(col: str | Column, pattern: str, flags: str = "") -> Column:
    """1-based position of the first match, 0 when there is none; flags go inline (``i``, ``s``, ``m``)."""
    prefixed = f"(?{flags}){pattern}" if flags else pattern
    return F.regexp_instr(_c(col), F.lit(prefixed))


def mentions(df: DataFrame, text: str, users: DataFrame, user_id: str, user_name: str, keys: list[str],
             placeholder: str = "unknown") -> DataFrame:
    """Mention ids and links of each message as newline lists, and the text with ids replaced by names.

    The user table is joined by id to the distinct ids, so it may be of any size; a message is rebuilt
    from its own ids only.
    """
    found = df.withColumn("__ids", F.array_distinct(F.regexp_extract_all(text, F.lit(r"<@([A-Za-z0-9]+)>"), F.lit(1))))
    found = found.withColumn("links", F.array_join(F.regexp_extract_all(text, F.lit(r"<(https?://[^>|]+)"), F.lit(1)), "\n"))
    # one name per id, the first by alphabet
    names = users.groupBy(F.col(user_id).cast("string").alias("__id")).agg(F.min(user_name).alias("__name"))
    pairs = (
        found.select(*keys, F.explode("__ids").alias("__id"))
        .join(names, "__id", "left")
        .groupBy(*keys)
        .agg(F.map_from_entries(F.collect_list(F.struct("__id", F.coalesce("__name", F.lit(placeholder))))).alias("__names"))
    )
    replaced = F.reduce(
        F.coalesce("__ids", F.array().cast("array<string>")),
        F.col(text),
        lambda acc, i: F.replace(acc, F.concat(F.lit("<@"), i, F.lit(">")), F.concat(F.lit("@"), F.element_at("__names", i))),
    )
    return (
        found.join(pairs, keys, "left")
        .withColumn("mentions", F.array_join("__ids", "\n"))
        .withColumn("resolved_text", replaced)
        .drop("__ids", "__names")
    )
