"""Partitioned tables, date shards and snapshot filters."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import as_date


def scan_partitioned(spark: SparkSession, root: str, partition_types: dict[str, str], fmt: str = "parquet", schema: T.StructType | None = None) -> DataFrame:
    """Table over ``key=value`` folders with declared partition types.

    The declared types are part of the read schema, so Spark never guesses them (``007`` stays text). With a
    schema given, unknown file columns are ignored, missing ones are NULL, and no footer is read to plan.
    """
    reader = spark.read.format(fmt).option("basePath", root)
    if schema is None:
        schema = reader.load(root).schema
    full = T.StructType([f for f in schema.fields if f.name not in partition_types])
    for k, t in partition_types.items():
        full = full.add(T.StructType.fromDDL(f"`{k}` {t}").fields[0])
    return reader.schema(full).load(root)


def scan_date_shards(spark: SparkSession, root: str, as_of: str, days_back: int | None = None, min_suffix: str | None = None,
                     schema: T.StructType | None = None) -> DataFrame:
    """Day shards kept under ``_suffix=YYYYMMDD``; the range becomes a plain comparison on the partition column.

    The last ``days_back`` days up to ``as_of``, or everything from ``min_suffix`` on.
    """
    df = scan_partitioned(spark, root, {"_suffix": "string"}, schema=schema)
    low = min_suffix
    if days_back is not None:
        from datetime import date, timedelta

        low = (date.fromisoformat(as_of) - timedelta(days=days_back)).strftime("%Y%m%d")
    df = df.filter(F.col("_suffix") <= as_of.replace("-", ""))
    return df.filter(F.col("_suffix") >= low) if low else df


def file_system(spark: SparkSession, path: str):
    """Hadoop's file system of a path and its path class (PySpark has no public form of either)."""
    make = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return make(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), make


def newest_partition(spark: SparkSession, root: str, part: str, numeric: bool = False) -> str | None:
    """Greatest value of the outermost partition column, by the folder names alone; None if there is no folder."""
    fs, make = file_system(spark, root)
    names = [s.getPath().getName() for s in fs.listStatus(make(root))]
    values = [unquote(n.split("=", 1)[1]) for n in names if n.startswith(f"{part}=") and not n.endswith("=__HIVE_DEFAULT_PARTITION__")]
    return max(values, key=int if numeric else str, default=None)


def scan_latest_shard(spark: SparkSession, root: str, suffix_col: str = "_suffix", schema: T.StructType | None = None) -> DataFrame:
    """Only the newest shard. Its suffix is the greatest folder name and becomes a literal: no job runs before, one folder is read."""
    df = scan_partitioned(spark, root, {suffix_col: "string"}, schema=schema)
    return df.filter(F.col(suffix_col) == F.lit(newest_partition(spark, root, suffix_col)))


def latest_snapshot(df: DataFrame, snapshot: str) -> DataFrame:
    """Rows of the newest snapshot; the maximum is a scalar subquery, so a partition column is pruned by it."""
    return df.filter(F.col(snapshot) == df.agg(F.max(snapshot)).scalar())


def latest_snapshot_per_period(df: DataFrame, snapshot: str, period: str = "month", ignore_year: bool = False) -> DataFrame:
    """Rows of the last snapshot in each month (or year). ``ignore_year`` groups by month number only."""
    key: Column = F.month(snapshot) if ignore_year else F.trunc(snapshot, period)
    last = df.groupBy(key.alias("__p")).agg(F.max(snapshot).alias("__s"))
    return df.join(last.select("__s"), F.col(snapshot) == F.col("__s"), "left_semi")


def keep_first_last_snapshots(df: DataFrame, ts: str) -> DataFrame:
    """Rows of the first and the last snapshot of a dataset."""
    ends = df.agg(F.min(ts).alias("a"), F.max(ts).alias("b"))
    return df.filter((F.col(ts) == ends.select("a").scalar()) | (F.col(ts) == ends.select("b").scalar()))


def retain_days(df: DataFrame, date_col: str, as_of: str, days: int) -> DataFrame:
    """Rows no older than n days before the run date."""
    return df.filter(F.col(date_col) >= F.date_sub(as_date(as_of), days))


def register_view(df: DataFrame, name: str) -> DataFrame:
    df.createOrReplaceTempView(name)
    return df.sparkSession.table(name)
