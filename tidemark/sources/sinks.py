"""Writers: replace, append, snapshots, incremental loads and keyed merges on Parquet folders.

A keyed merge writes new files for the hash buckets of keys it touches beside the old ones and then publishes the new
version by a marker file, so readers see the old or the new state and a lost executor or a failed job leaves the old one
in place. Of two writers that started from the same version, the second fails.
"""

from __future__ import annotations

import json
import time
import uuid
from collections.abc import Callable
from functools import reduce
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .scans import file_system, newest_partition, retain_days


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, make = file_system(spark, path)
    return fs.exists(make(path))


def write_replace(df: DataFrame, path: str, partition_by: list[str] | None = None, cluster_by: list[str] | None = None, partitions: int | None = None) -> None:
    """Full rebuild. Clustering sorts files by ranges of the columns, which lets readers skip row groups.

    The new table is complete before it takes the place of the old one, so a failed rebuild leaves that as it was.
    """
    if cluster_by:
        spread = [*(partition_by or []), *cluster_by]
        df = df.repartitionByRange(*([partitions] if partitions else []), *spread).sortWithinPartitions(*spread)
    fresh, old = (f"{path.rstrip('/')}.{kind}-{uuid.uuid4().hex}" for kind in ("new", "old"))
    (df.write.partitionBy(*partition_by) if partition_by else df.write).parquet(fresh)
    fs, make = file_system(df.sparkSession, path)
    had = fs.exists(make(path)) and fs.rename(make(path), make(old))
    if not fs.rename(make(fresh), make(path)):
        raise OSError(f"could not put the new table at {path}; it is complete at {fresh}")
    if had:
        fs.delete(make(old), True)


def write_append(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    writer = df.write.mode("append")
    (writer.partitionBy(*partition_by) if partition_by else writer).parquet(path)


def overwrite_partitions(df: DataFrame, path: str, partition_by: list[str]) -> None:
    """Replace exactly the partitions that occur in the frame.

    The rebalance hint gathers each partition into files of a sound size and splits a hot partition.
    """
    df = df.hint("rebalance", *[F.col(c) for c in partition_by])
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def write_snapshot(df: DataFrame, root: str, ds: str, suffix: str = "_suffix") -> None:
    """Daily snapshot: one ``_suffix=YYYYMMDD`` partition replaced."""
    overwrite_partitions(df.withColumn(suffix, F.lit(ds.replace("-", ""))), root, [suffix])


def write_collected(df: DataFrame, root: str, partition: dict[str, str], collected_ts: str) -> bool:
    """Records with their collection time under one partition; an empty input writes nothing."""
    if df.isEmpty():
        return False
    out = df.withColumns({"__collected_ts": F.lit(collected_ts).cast("timestamp"), **{k: F.lit(v) for k, v in partition.items()}})
    overwrite_partitions(out, root, list(partition))
    return True


def insert_overwrite_since_max(build: Callable[[Column | None], DataFrame], spark: SparkSession, path: str, part: str, part_type: str = "date") -> None:
    """Recompute from the newest stored partition on (that one included) and replace just those partitions.

    ``build`` gets the watermark as a literal, or None on the first run, and applies it to its scan. The watermark comes
    from the names of the partition folders; no file is read for it.
    """
    newest = newest_partition(spark, path, part, numeric=part_type in ("int", "bigint")) if path_exists(spark, path) else None
    overwrite_partitions(build(None if newest is None else F.lit(newest).cast(part_type)), path, [part])


def reprocess_window(build: Callable[[], DataFrame], path: str, date_col: str, as_of: str, days: int) -> None:
    """Late data: recompute the last n days and replace their partitions."""
    overwrite_partitions(retain_days(build(), date_col, as_of, days), path, [date_col])


class Version(NamedTuple):
    """A published state: folder -> buckets that it holds (none: all rows, without buckets), and the rows of each bucket."""

    number: int
    folders: dict[str, list[int]]
    buckets: int = 1
    rows: dict[int, int] = {}


class VersionLog:
    """Numbered states of a folder, one marker file each, published by one writer at a time."""

    STALE_S = 60  # an empty marker older than this belongs to a writer that died while publishing

    def __init__(self, spark: SparkSession, root: str, keep: int = 3):
        self.spark, self.root, self.keep = spark, root.rstrip("/"), keep
        self._fs, self._path = file_system(spark, self.root)

    def _markers(self) -> dict[int, object]:
        folder = self._path(f"{self.root}/_versions")
        if not self._fs.exists(folder):
            return {}
        return {int(s.getPath().getName()): s for s in self._fs.listStatus(folder) if s.getPath().getName().isdigit()}

    def _manifest(self, number: int, status) -> Version | None:
        """The state that a marker describes; None if nothing was published by it."""
        if status.getLen() == 0:
            return None
        stream = self._fs.open(status.getPath())
        try:
            told = json.loads(self.spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()
        return Version(number, told["folders"], told["buckets"], {int(k): v for k, v in told["rows"].items()})

    def current(self) -> Version:
        """The newest published version; number 0 and nothing before the first."""
        for number, status in sorted(self._markers().items(), reverse=True):
            version = self._manifest(number, status)
            if version is not None:
                return version
        return Version(0, {})

    def exists(self) -> bool:
        return self.current().number > 0

    def _publish(self, version: Version, expected: int) -> int:
        """Take the number after ``expected`` by creating its marker without overwriting."""
        number = expected + 1
        for found, status in sorted(self._markers().items()):
            if found <= expected:
                continue
            dead = status.getLen() == 0 and time.time() - status.getModificationTime() / 1000 >= self.STALE_S
            if not dead:
                raise RuntimeError(f"{self.root}: version {found} was published by another writer; this one started from {expected}")
            number = found + 1
        marker = self._fs.create(self._path(f"{self.root}/_versions/{number}"), False)
        try:
            marker.write(bytearray(json.dumps({"folders": version.folders, "buckets": version.buckets, "rows": version.rows}).encode()))
        finally:
            marker.close()
        return number

    def _forget(self) -> None:
        published = {n: v for n, s in self._markers().items() if (v := self._manifest(n, s)) is not None}
        newest = sorted(published)[-self.keep :]
        used = {f for n in newest for f in published[n].folders}
        for n in sorted(published)[: -self.keep]:
            self._fs.delete(self._path(f"{self.root}/_versions/{n}"), False)
            for folder in set(published[n].folders) - used:
                self._fs.delete(self._path(f"{self.root}/{folder}"), True)


def bucket_of(keys: list[str], buckets: int) -> Column:
    """Linear hashing: with n buckets, the lowest ones are already split by one more bit of the hash than the others.

    Bucket ``i`` was split off from bucket ``i`` without its highest bit, so going from n to n + 1 buckets moves rows
    of one bucket only.
    """
    wide = 1 << max(0, (buckets - 1).bit_length())
    place = F.xxhash64(*keys).bitwiseAND(F.lit(wide - 1))
    return F.when(place >= buckets, place - wide // 2).otherwise(place).cast("int")


def split_from(bucket: int, buckets: int) -> int:
    """The one of the first ``buckets`` buckets that a later bucket's rows lie in before it is split off."""
    while bucket >= buckets:
        bucket -= 1 << (bucket.bit_length() - 1)
    return bucket


BUCKET_ROWS = 2_000_000
FINE_BUCKETS = 64  # buckets that a table may have before they are full


class VersionedTable(VersionLog):
    """A table as immutable Parquet folders and one marker file per published version.

    With ``keys`` the rows lie in buckets by a hash of the keys, and a version lists the folder of every bucket, so a
    merge reads and rewrites only the buckets that its source touches. Buckets keep their size: when the rows outgrow
    ``bucket_rows`` per bucket, buckets are split one by one, in the merge that brings the rows (linear hashing), from
    ``buckets`` on. Buckets of fewer than ``BUCKET_ROWS`` rows are made only up to ``FINE_BUCKETS`` of them: a merge that
    touches all buckets pays for each one's file, so the number of files must follow the size of the table. The last ``keep`` versions stay readable; older markers, and folders that only they use, are
    removed after a new version is out.
    """

    def __init__(self, spark: SparkSession, root: str, keys: list[str] | None = None, buckets: int = 1, keep: int = 3, bucket_rows: int = BUCKET_ROWS):
        super().__init__(spark, root, keep)
        self.keys, self.least, self.bucket_rows = keys, buckets, bucket_rows

    def buckets_for(self, rows: int, at_least: int = 0) -> int:
        fine = min(-(-rows // self.bucket_rows), FINE_BUCKETS)
        return max(self.least, at_least, fine, -(-rows // max(self.bucket_rows, BUCKET_ROWS)))

    def read(self, version: Version | None = None, touched: set[int] | None = None) -> DataFrame:
        """The newest version, or the one that ``current`` returned; with ``touched`` only those buckets."""
        version = version or self.current()
        if not version.number:
            raise ValueError(f"no version of {self.root} yet")
        paths = [f"{self.root}/{folder}" if not held else f"{self.root}/{folder}/__bucket={b}" for folder, held in version.folders.items() for b in held or [None]
                 if touched is None or not held or b in touched]
        if not paths:  # the touched buckets are empty so far
            return self.read(version).limit(0)
        return self.spark.read.option("recursiveFileLookup", "true").parquet(*paths)

    def write(self, df: DataFrame, expected: int | None = None, touched: set[int] | None = None, buckets: int | None = None) -> int:
        """Write the next version and publish it.

        ``expected`` is the version that ``df`` was made from (the current one if not given); if another has been
        published meanwhile, the write fails and nothing changes. With ``touched``, ``df`` holds all rows of those
        buckets, the others stay as they are, and there are ``buckets`` buckets from now on. A full write counts its
        rows to choose the number of buckets.
        """
        before = self.current()
        expected = before.number if expected is None else expected
        folder = f"data-{uuid.uuid4().hex}"
        if not self.keys:
            df.write.mode("errorifexists").parquet(f"{self.root}/{folder}")
            fresh = Version(0, {folder: []})
        else:
            n = buckets or (before.buckets if touched is not None else self.buckets_for(df.count()))
            df.withColumn("__bucket", bucket_of(self.keys, n)).hint("rebalance", F.col("__bucket")).write.partitionBy("__bucket").parquet(f"{self.root}/{folder}")
            held = {}
            if any(s.getPath().getName().startswith("__bucket=") for s in self._fs.listStatus(self._path(f"{self.root}/{folder}"))):
                held = dict(self.spark.read.parquet(f"{self.root}/{folder}").groupBy("__bucket").count().collect())  # from the file footers
            rest = {f: [b for b in bs if b not in touched] for f, bs in before.folders.items()} if touched is not None else {}
            folders = {f: bs for f, bs in rest.items() if bs} | ({folder: sorted(held)} if held else {})
            if not folders:  # an empty table still has its columns
                df.write.parquet(f"{self.root}/{folder}-empty")
                folders = {f"{folder}-empty": []}
            fresh = Version(0, folders, n, {b: r for b, r in before.rows.items() if touched is not None and b not in touched} | held)
        number = self._publish(fresh, expected)
        self._forget()
        return number


def reject_duplicate_keys(source: DataFrame, keys: list[str]) -> DataFrame:
    """The source itself, failing at run time when a full key occurs twice (as MERGE does).

    The count is a partial aggregation on the keys, kept as the join's own shuffle input.
    """
    rest = [c for c in source.columns if c not in keys] or keys
    one = source.groupBy(*keys).agg(F.count("*").alias("__n"), F.any_value(F.struct(*rest)).alias("__r"))
    filled = reduce(lambda a, b: a & b, [F.col(k).isNotNull() for k in keys])
    message = F.concat(F.lit("merge source has more than one row for key "), F.to_json(F.struct(*keys)))
    checked = one.withColumn("__n", F.when((F.col("__n") > 1) & filled, F.raise_error(message).cast("bigint")).otherwise(F.col("__n")))
    kept = checked.filter("__n >= 1")
    return kept.select(*[F.col(c) if c in keys else F.col("__r")[c].alias(c) for c in source.columns])


def merged(target: DataFrame, source: DataFrame, keys: list[str], update_cols: list[str] | None = None) -> DataFrame:
    """MERGE: matched rows take the listed columns of the source (all when not listed), the rest is inserted.

    NULL keys never match: such source rows are inserted, such target rows kept.
    """
    cols = target.columns
    updates = set(update_cols if update_cols is not None else [c for c in cols if c not in keys])
    nulls = reduce(lambda a, b: a | b, [F.col(k).isNull() for k in keys])
    checked = reject_duplicate_keys(source.filter(~nulls), keys)
    s = checked.select(*[F.col(c).alias(f"__s_{c}") for c in cols], F.lit(True).alias("__hit"))
    t = target.withColumn("__old", F.lit(True))
    both = t.join(s, reduce(lambda a, b: a & b, [F.col(k) == F.col(f"__s_{k}") for k in keys]), "full_outer")
    take_new = F.col("__old").isNull()
    out = []
    for c in cols:
        new = F.col(f"__s_{c}")
        if c in updates:
            out.append(F.when(F.col("__hit").isNotNull(), new).otherwise(F.col(c)).alias(c))
        else:
            out.append(F.when(take_new, new).otherwise(F.col(c)).alias(c))
    return both.select(*out).unionByName(source.filter(nulls).select(*cols))


def new_rows(target: DataFrame, source: DataFrame, keys: list[str]) -> DataFrame:
    """Source rows whose key the target lacks. Rows with a NULL key always count as new.

    Only target rows within the source's span of the first key are read, which row group statistics skip by.
    """
    span = source.agg(F.min(keys[0]).alias("a"), F.max(keys[0]).alias("b")).first()
    near = target.filter(F.col(keys[0]).between(F.lit(span["a"]), F.lit(span["b"])))
    return source.join(near.select(*keys).distinct(), keys, "left_anti")


def rewrite(table: VersionedTable, source: DataFrame, merge: Callable[[DataFrame], DataFrame]) -> int:
    """Publish ``merge(stored rows)``: of a bucketed table only the buckets that keys of ``source`` fall into are read and rewritten.

    If the table may outgrow its buckets by the rows of ``source``, the next buckets in turn are split as well.
    """
    version = table.current()
    if not table.keys:
        return table.write(merge(table.read(version)), version.number)
    batch = dict(source.groupBy(bucket_of(table.keys, version.buckets).alias("b")).count().collect())  # at most one row per bucket
    grown = table.buckets_for(sum(version.rows.values()) + sum(batch.values()), version.buckets)
    touched = set(batch) | {split_from(b, version.buckets) for b in range(version.buckets, grown)}
    return table.write(merge(table.read(version, touched)), version.number, touched, grown)


def merge_upsert(table: VersionedTable, source: DataFrame, keys: list[str], update_cols: list[str] | None = None) -> int:
    if not table.exists():
        return table.write(source, 0)
    return rewrite(table, source, lambda stored: merged(stored, source, keys, update_cols))


def insert_new(spark: SparkSession, path: str, source: DataFrame, keys: list[str]) -> None:
    """Append only unseen keys. The target is read before the append, and a repeated run adds nothing."""
    write_append(new_rows(spark.read.parquet(path), source, keys) if path_exists(spark, path) else source, path)


def merge_id_sets(target: DataFrame, batch: DataFrame, key: str, array_cols: list[str]) -> DataFrame:
    """Stored and new entities: id arrays are united, all other attributes come from the batch where it has the key."""
    others = [c for c in target.columns if c not in (key, *array_cols)]
    t = target.select(key, *[F.col(c).alias(f"__t_{c}") for c in target.columns if c != key], F.lit(True).alias("__old"))
    both = batch.withColumn("__new", F.lit(True)).join(t, key, "full_outer")
    empty = {c: F.array().cast(target.schema[c].dataType) for c in array_cols}
    arrays = [F.array_sort(F.array_union(F.coalesce(c, empty[c]), F.coalesce(f"__t_{c}", empty[c]))).alias(c) for c in array_cols]
    attrs = [F.when(F.col("__new").isNotNull(), F.col(c)).otherwise(F.col(f"__t_{c}")).alias(c) for c in others]
    return both.select(key, *arrays, *attrs).select(*target.columns)


def merge_min_attrs(target: DataFrame, batch: DataFrame, key: str, min_cols: list[str], array_cols: list[str]) -> DataFrame:
    """Stored and new entities: first-seen attributes keep their minimum, id arrays are united."""
    both = target.select(key, *min_cols, *array_cols).unionByName(batch.select(key, *min_cols, *array_cols))
    out = both.groupBy(key).agg(*[F.min(c).alias(c) for c in min_cols])
    for c in array_cols:  # duplicates go before anything is collected
        ids = both.select(key, F.explode(c).alias("__id")).distinct().groupBy(key).agg(F.array_sort(F.collect_list("__id")).alias(c))
        out = out.join(ids, key, "left").withColumn(c, F.coalesce(c, F.array().cast(target.schema[c].dataType)))
    return out


def export_csv(df: DataFrame, path: str) -> None:
    """Table export as a folder of part files; no task has to hold the whole table."""
    df.write.mode("overwrite").option("header", True).csv(path)


def store_check_results(results: DataFrame, central: str, history: str, run_id: str) -> None:
    """The latest results replace the central table; a keyed copy is appended to the history."""
    from ..operators.checks import check_result_keys

    results.write.mode("overwrite").parquet(central)
    write_append(check_result_keys(results.sparkSession.read.parquet(central), run_id), history)
