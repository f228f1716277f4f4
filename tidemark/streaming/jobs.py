"""Deduplicated inserts, burst windows, sessions and upserts over streams."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.windows import latest_per_key
from ..sources.keylog import KeyedLog
from ..sources.scans import file_system
from ..sources.sinks import VersionedTable, insert_new, overwrite_partitions, rewrite


def file_stream(spark: SparkSession, path: str, files_per_batch: int | None = None) -> DataFrame:
    """Stream over a Parquet folder with the schema of its present files."""
    reader = spark.readStream.schema(spark.read.parquet(path).schema)
    if files_per_batch:
        reader = reader.option("maxFilesPerTrigger", files_per_batch)
    return reader.parquet(path)


def stream_new_rows(stream: DataFrame, keys: list[str], ts: str, delay: str) -> DataFrame:
    """First copy of every key; state older than the delay is dropped, so it stays bounded."""
    return stream.withWatermark(ts, delay).dropDuplicatesWithinWatermark(keys)


def stream_burst(stream: DataFrame, keys: list[str], ts: str, delay: str, window: str, slide: str, threshold: int, amount: Column | None = None) -> DataFrame:
    """Keys whose count (or amount) within a sliding window reaches the threshold, once the window is complete."""
    total = F.count("*") if amount is None else F.sum(amount)
    out = stream.withWatermark(ts, delay).groupBy(F.window(ts, window, slide), *keys).agg(total.alias("total"))
    return out.filter(F.col("total") >= threshold).select(*keys, F.col("window.start").alias("window_start"), F.col("window.end").alias("window_end"), "total")


def stream_sessions(stream: DataFrame, user: str, ts: str, delay: str, gap: str) -> DataFrame:
    """Sessions by inactivity gap, emitted when complete."""
    out = stream.withWatermark(ts, delay).groupBy(user, F.session_window(ts, gap).alias("__w")).agg(F.count("*").alias("events"), F.max(ts).alias("last_event"))
    return out.select(user, F.col("__w.start").alias("session_start"), "last_event", "events")


def enrich(stream: DataFrame, static: DataFrame, key: str) -> DataFrame:
    """Stream-static left join; the static side is read again for every batch."""
    return stream.join(static, key, "left")


def run_to_parquet(df: DataFrame, path: str, checkpoint: str, mode: str = "append") -> DataFrame:
    """Process everything available, append it to a folder exactly once, and return the folder as a table."""
    q = df.writeStream.format("parquet").outputMode(mode).option("path", path).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return df.sparkSession.read.schema(df.schema).parquet(path)


def run_batches(df: DataFrame, step: Callable[[DataFrame, int], None], checkpoint: str) -> StreamingQuery:
    """Run ``step`` on every available micro-batch; ``step`` must give the same state when a batch is repeated."""
    q = df.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    q.awaitTermination()
    return q


def stream_insert_new(stream: DataFrame, path: str, keys: list[str], checkpoint: str) -> StreamingQuery:
    """Append unseen keys of every batch to a folder; a repeated batch adds nothing."""
    def step(batch: DataFrame, _: int) -> None:
        insert_new(batch.sparkSession, path, batch.dropDuplicates(keys), keys)

    return run_batches(stream, step, checkpoint)


def stream_upsert(stream: DataFrame, table: VersionedTable, keys: list[str], order: list[str], checkpoint: str) -> StreamingQuery:
    """Newest row per key over stored and arriving rows, whatever the order of arrival.

    Of a table with ``keys`` only the buckets that a batch touches are rewritten.
    """
    def step(batch: DataFrame, _: int) -> None:
        if table.exists():
            rewrite(table, batch, lambda stored: latest_per_key(stored.unionByName(batch), keys, order))
        else:
            table.write(latest_per_key(batch, keys, order), 0)

    return run_batches(stream, step, checkpoint)


def stream_insert_keyed(stream: DataFrame, log: KeyedLog, checkpoint: str) -> StreamingQuery:
    """Add the unseen keys of every batch to a keyed log; a repeated batch adds nothing."""
    return run_batches(stream, lambda batch, _: log.insert(batch.dropDuplicates(log.keys)) and None, checkpoint)


class DayHistory:
    """All rows that a stream has brought, by day: a folder per day with one folder per batch in it.

    A batch lists and reads only the folders of its own days. A day with more than ``batches`` batches is compacted:
    the rows of all batches before the present one go into one ``base`` folder that names the last of them. A base
    counts once it is complete, and the batches up to it are ignored from then on, so a compaction that was cut off
    is harmless. Only the present batch can be repeated, which replaces its own folders.
    """

    def __init__(self, spark: SparkSession, root: str, day: str, batches: int = 8):
        self.spark, self.root, self.day, self.batches = spark, root.rstrip("/"), day, batches
        self._fs, self._path = file_system(spark, self.root)

    def folder(self) -> Column:
        """The day as a folder name: itself if it is plain, else its bytes in hex."""
        text = F.col(self.day).cast("string")
        return F.when(text.isNull(), "none").when(text.rlike("^[0-9A-Za-z_.-]+$"), F.concat(F.lit("d"), text)).otherwise(F.concat(F.lit("x"), F.hex(text)))

    def add(self, batch: DataFrame, number: int) -> list[str]:
        """Store a batch; the folder names of its days."""
        named = batch.withColumns({"__day": self.folder(), "__batch": F.lit(number)})
        (named.hint("rebalance", F.col("__day")).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("__day", "__batch").parquet(self.root))
        return sorted(r[0] for r in batch.select(self.folder()).distinct().collect())  # one name per day

    def _parts(self, day: str) -> tuple[str | None, list[int]]:
        """The newest complete base of a day and the batches after it."""
        names = [s.getPath().getName() for s in self._fs.listStatus(self._path(f"{self.root}/__day={day}"))]
        bases = sorted(int(n[5:]) for n in names if n.startswith("base-") and self._fs.exists(self._path(f"{self.root}/__day={day}/{n}/_SUCCESS")))
        last = bases[-1] if bases else -1
        return (f"base-{last}" if bases else None), sorted(b for n in names if n.startswith("__batch=") and (b := int(n[8:])) > last)

    def paths(self, days: list[str]) -> list[str]:
        out = []
        for day in days:
            base, batches = self._parts(day)
            out += [f"{self.root}/__day={day}/{x}" for x in ([base] if base else []) + [f"__batch={b}" for b in batches]]
        return out

    def read(self, days: list[str], schema) -> DataFrame:
        return self.spark.read.schema(schema).parquet(*self.paths(days))

    def compact(self, days: list[str], schema, number: int) -> None:
        """Gather the batches before ``number`` of days that have many, then drop what the new base covers."""
        for day in days:
            base, batches = self._parts(day)
            old = [b for b in batches if b < number]
            if len(batches) <= self.batches or not old:
                continue
            home, new = f"{self.root}/__day={day}", f"base-{old[-1]}"
            covered = ([base] if base else []) + [f"__batch={b}" for b in old]
            self.spark.read.schema(schema).parquet(*[f"{home}/{x}" for x in covered]).hint("rebalance").write.mode("overwrite").parquet(f"{home}/{new}")
            for name in [s.getPath().getName() for s in self._fs.listStatus(self._path(home))]:  # leftovers of earlier ones, too
                if (name.startswith("base-") and name != new) or (name.startswith("__batch=") and int(name[8:]) <= old[-1]):
                    self._fs.delete(self._path(f"{home}/{name}"), True)


def stream_reprocess(stream: DataFrame, build: Callable[[DataFrame], DataFrame], history: str, path: str, day: str, checkpoint: str, batches: int = 8) -> StreamingQuery:
    """Late data: store each batch, then rebuild exactly the days it touches from all stored rows of those days.

    The stored rows lie by day (``DayHistory``), so the work of a batch follows the size of its days, not the number
    of batches so far. Repeating a batch replaces its rows instead of doubling them.
    """
    def step(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        stored = DayHistory(spark, history, day, batches)
        days = stored.add(batch, batch_id)
        if days:
            overwrite_partitions(build(stored.read(days, batch.schema)), path, [day])
            stored.compact(days, batch.schema, batch_id)

    return run_batches(stream, step, checkpoint)
