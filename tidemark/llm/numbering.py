"""Running sums and gapless numbers inside groups of any size. DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..operators.windows import range_parts

RANGE = 2**62


def place(*cols, seed: int = 42) -> Column:
    """A bigint from 0 to 2^62, spread evenly by the hash of the columns."""
    return F.shiftrightunsigned(F.xxhash64(F.lit(seed), *cols), 2)


def running(df: DataFrame, group: str, at: str, tie: list[str], add: dict[str, Column], rows: int = 10_000) -> DataFrame:
    """Per row the sums of ``add`` over the rows before it in its group, in the order of ``at`` (see ``place``) and ``tie``.

    The range of ``at`` is cut into cells, so many per group that a cell has about ``rows`` rows. Cells are summed
    by a partial aggregation, the sums are carried from cell to cell (one small row per cell), and every cell is
    ordered on its own. So a group that holds most of the rows is spread over as many tasks as it has cells. A null
    group is a group of its own. Rows that tie in everything stand in any order.
    """
    size = df.groupBy(group).agg(F.count("*").alias("__n")).withColumnRenamed(group, "__g")
    cells = df.join(size, F.col(group).eqNullSafe(F.col("__g"))).drop("__g")
    cells = cells.withColumn("__cell", F.floor(F.col(at) / float(RANGE) * F.ceil(F.col("__n") / rows)))
    sums = cells.groupBy(group, "__cell").agg(*[F.sum(c).alias(f"__s_{n}") for n, c in add.items()])
    before = Window.partitionBy(group).orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    carried = sums.select(
        F.col(group).alias("__g"), F.col("__cell").alias("__c"), *[F.coalesce(F.sum(f"__s_{n}").over(before), F.lit(0)).alias(f"__b_{n}") for n in add]
    )
    inner = Window.partitionBy(group, "__cell").orderBy(at, *tie).rowsBetween(Window.unboundedPreceding, -1)
    ordered = cells.withColumns({n: F.coalesce(F.sum(c).over(inner), F.lit(0)) for n, c in add.items()})
    joined = ordered.join(carried, F.col(group).eqNullSafe(F.col("__g")) & (F.col("__cell") == F.col("__c")))
    return joined.withColumns({n: F.col(n) + F.col(f"__b_{n}") for n in add}).select(*df.columns, *add)


def ordered(df: DataFrame, order: list[Column], add: dict[str, Column]) -> DataFrame:
    """Per row the sums of ``add`` over the rows before it in the whole table, in an ``order`` without ties.

    The table is cut into ranges of the order; each is summed and ordered on its own, and the sums are carried from
    range to range (one small row per range).
    """
    ranges = range_parts(df, order)
    before = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    inner = Window.partitionBy("__part").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    sums = ranges.groupBy(F.col("__part").alias("__p")).agg(*[F.sum(c).alias(f"__s_{n}") for n, c in add.items()]).withColumnRenamed("__p", "__part")
    carried = sums.select(F.col("__part").alias("__p"), *[F.coalesce(F.sum(f"__s_{n}").over(before), F.lit(0)).alias(f"__b_{n}") for n in add])
    joined = ranges.withColumns({n: F.coalesce(F.sum(c).over(inner), F.lit(0)) for n, c in add.items()}).join(carried, F.col("__part") == F.col("__p"))
    return joined.withColumns({n: F.col(n) + F.col(f"__b_{n}") for n in add}).select(*df.columns, *add)
