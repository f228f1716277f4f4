"""Projections, filters and conformed staging columns."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import as_date
from ..functions.numeric import _c


def filtered_columns(df: DataFrame, except_: list[str] = ()) -> list[str]:
    """Column names minus an exclusion list, case-insensitive."""
    out = {c.lower() for c in except_}
    return [c for c in df.columns if c.lower() not in out]


def star(df: DataFrame, except_: list[str] = (), prefix: str = "", suffix: str = "") -> DataFrame:
    return df.select([F.col(f"`{c}`").alias(f"{prefix}{c}{suffix}") for c in filtered_columns(df, except_)])


def except_replace(df: DataFrame, drop: list[str] = (), replace: dict[str, Column] | None = None) -> DataFrame:
    """``* EXCEPT (...) REPLACE (...)``: replaced columns keep their place."""
    replace = replace or {}
    return df.select([
        replace[c].alias(c) if c in replace else F.col(f"`{c}`") for c in filtered_columns(df, drop)
    ])


def nullcheck(df: DataFrame) -> DataFrame:
    """Empty strings to NULL on every string column."""
    text = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
    return df.withColumns({c: F.nullif(F.col(c), F.lit("")) for c in text}) if text else df


def null_sentinels(df: DataFrame, cols: list[str], sentinels: list[str]) -> DataFrame:
    return df.withColumns({c: F.when(F.col(c).isin(*sentinels), None).otherwise(F.col(c)) for c in cols})


def stage(df: DataFrame, spec: dict[str, tuple[str, str] | Column]) -> DataFrame:
    """Rename and cast: ``new name -> (source column, type)`` or a ready expression.

    A type prefixed with ``try_`` gives NULL on bad text instead of failing the job; ``upper`` upper-cases.
    """
    out = []
    for name, rule in spec.items():
        if isinstance(rule, Column):
            out.append(rule.alias(name))
            continue
        source, kind = rule
        if kind == "upper":
            out.append(F.upper(source).alias(name))
        elif kind.startswith("try_"):
            out.append(F.col(source).try_cast(kind[4:]).alias(name))
        else:
            out.append(F.col(source).cast(kind).alias(name))
    return df.select(out)


def classify(rules: list[tuple[Column, str]], default: str | Column | None = None) -> Column:
    """First matching rule wins."""
    expr = F
    for cond, label in rules:
        expr = expr.when(cond, label)
    return expr.otherwise(default)


def last_n_days(df: DataFrame, date_col: str, as_of: str | date, n: int, include_today: bool = True) -> DataFrame:
    """Rows dated within n days before ``as_of``; plain comparisons, so the filter reaches the scan."""
    end = as_date(as_of)
    out = df.filter(F.col(date_col) >= F.date_sub(end, n))
    upper = F.date_add(end, 1) if include_today else end
    return out.filter(F.col(date_col) < upper)


def in_ci(col: str | Column, values: list[str]) -> Column:
    """Case-insensitive membership in a literal list."""
    return F.lower(_c(col)).isin(*sorted({v.lower() for v in values}))


def in_ci_table(df: DataFrame, col: str, members: DataFrame, member_col: str) -> DataFrame:
    """Case-insensitive membership in a table of any size."""
    keys = members.select(F.lower(member_col).alias("__m")).distinct()
    return df.join(keys, F.lower(col) == F.col("__m"), "left_semi")


def exclude_matching(df: DataFrame, col: str, rules: DataFrame, kind: str = "kind", text: str = "text") -> DataFrame:
    """Drop rows that match any rule (``prefix``, ``suffix`` or ``contains`` with its text).

    Equality on the rule text replaces one long alternation: all prefixes, suffixes and substrings of the
    lengths that occur are cut from each distinct value and looked up, so the rule table may be large.
    """
    lens = rules.groupBy(kind).agg(F.sort_array(F.collect_set(F.length(text))).alias("lens"))

    def lengths(name: str) -> Column:
        return F.coalesce(f"__{name}", F.array().cast("array<int>"))

    v = F.col("__v")
    starts = F.sequence(F.lit(1), F.greatest(F.length(v), F.lit(1)))
    values = df.select(F.col(col).alias("__v")).filter(F.col(col).isNotNull()).distinct().withColumns(
        {f"__{k}": lens.filter(F.col(kind) == k).select("lens").scalar() for k in ("prefix", "suffix", "contains")}
    )
    cut = F.concat(
        F.transform(lengths("prefix"), lambda k: F.struct(F.lit("prefix").alias("k"), F.substr(v, F.lit(1), k).alias("t"))),
        F.transform(lengths("suffix"), lambda k: F.struct(F.lit("suffix").alias("k"), F.right(v, k).alias("t"))),
        F.flatten(F.transform(lengths("contains"), lambda k: F.transform(
            starts, lambda i: F.struct(F.lit("contains").alias("k"), F.substr(v, i, k).alias("t"))))),
    )
    pieces = values.select("__v", F.explode(F.array_distinct(cut)).alias("__p")).select("__v", "__p.k", "__p.t")
    terms = rules.select(F.col(kind).alias("k"), F.col(text).alias("t")).distinct()
    hits = pieces.join(terms, ["k", "t"], "left_semi").select("__v").distinct()
    return df.join(hits, F.col(col) == F.col("__v"), "left_anti")
