"""Daily activity as stored bitmaps of user codes: periods are counted without reading an event again."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.windows import split_window
from ..session import written
from .keylog import KeyedLog
from .sinks import overwrite_partitions


class ActivityBitmaps:
    """Who was active on which day, one bit per user and day.

    Users are numbered in the order in which they first appear, in a keyed log, so any key type becomes a dense code;
    a day is a few 4 KB bitmaps. Adding events reads only those events and the files of the log that may hold one of
    their users. Adding a day again replaces it. Weeks, months or any other union of days are or-ed bitmaps.
    """

    def __init__(self, spark: SparkSession, root: str, user: str):
        self.spark, self.root, self.user = spark, root.rstrip("/"), user
        self.codes = KeyedLog(spark, f"{self.root}/users", [user])

    def add(self, events: DataFrame, day: str) -> None:
        """Store the days that ``events`` holds, which must be all events of those days. Rows without user or day are left out."""
        active = written(events.select(F.col(self.user), F.col(day).cast("date").alias("day")).filter(f"`{self.user}` IS NOT NULL AND day IS NOT NULL").distinct(), "active")
        users = active.select(self.user).distinct()
        version = self.codes.current()
        start = sum(rows for _, _, rows in version.folders.values())
        fresh = split_window(self.codes.unseen(users, version), [], [self.user], None, {"code": ("row_number", None)})
        self.codes.insert(fresh.withColumn("code", F.col("code").cast("bigint") + start), version)
        coded = active.join(self.codes.files(users), self.user)
        bits = coded.groupBy("day", F.bitmap_bucket_number("code").alias("bucket")).agg(F.bitmap_construct_agg(F.bitmap_bit_position("code")).alias("bits"))
        overwrite_partitions(bits, f"{self.root}/days", ["day"])

    def counts(self, grain: str = "day") -> DataFrame:
        """``(period, users)``: distinct users per day, week, month, quarter or year, from the bitmaps alone."""
        days = self.spark.read.schema("bucket bigint, bits binary, day date").parquet(f"{self.root}/days")
        period = F.to_date(F.date_trunc(grain, "day")).alias("period")
        merged = days.groupBy(period, "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
        return merged.groupBy("period").agg(F.sum(F.bitmap_count("bits")).cast("bigint").alias("users"))
