"""Unions of unequal tables, differences and the double-entry ledger."""

from __future__ import annotations

import fnmatch
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.numeric import _c


def union_relations(frames: dict[str, DataFrame], include: list[str] | None = None, exclude: list[str] | None = None,
                    overrides: dict[str, str] | None = None, source_col: str | None = "_source", where: str | None = None) -> DataFrame:
    """Union by name over the superset of columns, missing ones as NULL, with the table name in ``source_col``."""
    if include and exclude:
        raise ValueError("give include or exclude, not both")
    overrides = overrides or {}
    keep_all = {c.lower() for c in include or []}
    drop_all = {c.lower() for c in exclude or []}
    parts = []
    for name, df in frames.items():
        cols = [c for c in df.columns if (not keep_all or c.lower() in keep_all) and c.lower() not in drop_all]
        part = df.select(*[F.col(c).cast(overrides[c]).alias(c) if c in overrides else F.col(c) for c in cols])
        parts.append(part.select(F.lit(name).alias(source_col), "*") if source_col else part)
    out = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), parts)
    return out.filter(where) if where else out


def union_tables(spark: SparkSession, pattern: str, exclude: str = "", **options) -> DataFrame:
    """Union of all catalog tables and views whose name matches a shell pattern (a prefix is ``name*``)."""
    names = sorted(t.name for t in spark.catalog.listTables()
                   if fnmatch.fnmatch(t.name, pattern) and not (exclude and fnmatch.fnmatch(t.name, exclude)))
    if not names:
        raise ValueError(f"no table matches {pattern!r}")
    return union_relations({n: spark.table(n) for n in names}, **options)


def symmetric_diff(a: DataFrame, b: DataFrame, cols: list[str] | None = None, label: str = "which_diff") -> DataFrame:
    """Distinct rows found on one side only.

    One union and one aggregation tell both sides apart, where two EXCEPTs would read each side twice.
    """
    cols = cols or a.columns
    tagged = a.select(*cols).withColumn("__a", F.lit(1)).withColumn("__b", F.lit(0)).unionByName(
        b.select(*cols).withColumn("__a", F.lit(0)).withColumn("__b", F.lit(1)))
    sides = tagged.groupBy(*cols).agg(F.max("__a").alias("__a"), F.max("__b").alias("__b")).filter("__a + __b = 1")
    return sides.select(*cols, F.when(F.col("__a") == 1, "a_minus_b").otherwise("b_minus_a").alias(label))


def ledger(df: DataFrame, from_col: str, to_col: str, value: str | Column, keep: list[str] = (),
           party: str = "party", amount: str = "amount") -> DataFrame:
    """Each transfer as two entries, minus for the sender and plus for the receiver, from one scan."""
    v = _c(value)
    legs = F.array(
        F.struct(F.col(from_col).alias(party), F.col(to_col).alias("counterparty"), (-v).alias(amount), F.lit("out").alias("direction")),
        F.struct(F.col(to_col).alias(party), F.col(from_col).alias("counterparty"), v.alias(amount), F.lit("in").alias("direction")),
    )
    return df.select(*keep, F.inline(legs))
