"""Append-only tables of unique keys: an insert reads only the files that may hold one of its keys."""

from __future__ import annotations

import uuid
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import written
from .sinks import Version, VersionLog

BLOCK_BITS = 32768  # a block of a Bloom filter is one 4 KB bitmap
BLOCK_KEYS = 2048  # 16 bits for a key, four of them set: one key in 400 passes by chance
PROBES = 4
SENT_BLOCKS = 2048  # blocks of filters that are sent to every task at most, 8 MB


def _power(n: int) -> int:
    return 1 << max(0, (n - 1).bit_length())


class KeyedLog(VersionLog):
    """Rows that are only ever added, one per key, in one folder per insert.

    The rows of a folder are dealt by a hash of the keys to files of about ``file_rows`` rows. Beside them lies a Bloom
    filter of the folder's keys, cut into blocks by the same hash, so a block speaks for one file. An insert looks its
    keys up in the blocks by a join, reads the few files that may hold one of them, and appends what they lack. It is
    published as the version after the one it has read; if another writer was faster, it fails and adds nothing, so no
    key is inserted twice. When there are more than ``folders`` folders, the small ones are put together, so that their
    number stays bounded while a row is moved only a few times.
    """

    def __init__(self, spark: SparkSession, root: str, keys: list[str], file_rows: int = 2_000_000, folders: int = 16, keep: int = 3):
        super().__init__(spark, root, keep)
        self.keys, self.file_rows, self.folders = keys, file_rows, folders

    def _hash(self) -> Column:
        return F.xxhash64(*[F.col(f"`{k}`") for k in self.keys])

    def _places(self) -> list[Column]:
        other = F.xxhash64(F.lit(1), *[F.col(f"`{k}`") for k in self.keys])
        return [F.shiftrightunsigned(other, 15 * i).bitwiseAND(F.lit(BLOCK_BITS - 1)) for i in range(PROBES)]

    def read(self, version: Version | None = None) -> DataFrame:
        """All rows of the newest version, or of the one that ``current`` returned."""
        version = version or self.current()
        if not version.number:
            raise ValueError(f"no version of {self.root} yet")
        return self._files([f"{self.root}/{f}/rows" for f in version.folders])

    def _files(self, paths: list[str]) -> DataFrame:
        return self.spark.read.option("recursiveFileLookup", "true").parquet(*paths)

    def files_for(self, source: DataFrame, version: Version | None = None) -> list[str]:
        """The stored files (as folders, one per file) that may hold a key of ``source``, by the Bloom filters alone."""
        version = version or self.current()
        if not version.folders:
            return []
        asked = source.select(self._hash().alias("h"), F.array(*self._places()).alias("places")).distinct()
        hits = [self._hits(asked, folders, kind) for folders, kind in self._by_filter_size(version) if folders]
        hits = reduce(DataFrame.unionAll, hits).distinct().collect()  # at most one row per file
        return sorted(f"{self.root}/{r['folder']}/rows/__part={r['part']}" for r in hits)

    def _by_filter_size(self, version: Version) -> list[tuple[dict[str, list[int]], str]]:
        """The folders, smallest first, whose filters make up ``SENT_BLOCKS`` at most, and the others, with a join hint for each."""
        sent, rest, n = {}, {}, 0
        for folder, (parts, blocks, rows) in sorted(version.folders.items(), key=lambda x: min(x[1][1:])):
            n += min(blocks, rows)
            (sent if n <= SENT_BLOCKS else rest)[folder] = [parts, blocks]
        return [(sent, "broadcast"), (rest, "merge")]

    def _hits(self, asked: DataFrame, folders: dict[str, list[int]], kind: str) -> DataFrame:
        """``(folder, part)`` of the files of ``folders`` whose filters may hold one of the asked keys.

        Folders with equally many blocks keep a key in the same block, so a key is asked once per number of blocks. The
        planner does not count that as more rows, so the join is told what to do: small filters, whose few blocks would
        gather all keys in few tasks, go to every task; otherwise both sides are shuffled. The keys are never broadcast.
        """
        shape = F.create_map(*[c for f, (parts, blocks) in folders.items() for c in (F.lit(f), F.struct(F.lit(parts).alias("parts"), F.lit(blocks).alias("blocks")))])
        filters = self.spark.read.parquet(*[f"{self.root}/{f}/keys" for f in folders]).withColumn("shape", shape[F.col("folder")])
        sizes = F.explode(F.array(*[F.lit(n) for n in sorted({blocks for _, blocks in folders.values()})]))
        looked = asked.withColumn("blocks", sizes).withColumn("block", F.col("h").bitwiseAND(F.col("blocks") - 1))
        bit = F.expr("forall(places, p -> (cast(conv(hex(substring(bits, cast(p div 8 AS int) + 1, 1)), 16, 10) AS int) & shiftleft(1, cast(p % 8 AS int))) > 0)")
        found = looked.join(filters.select("folder", "block", "bits", "shape.parts", "shape.blocks").hint(kind), ["blocks", "block"]).filter(bit)
        return found.select("folder", F.col("h").bitwiseAND(F.col("parts") - 1).alias("part"))

    def files(self, source: DataFrame) -> DataFrame:
        """The stored rows of the files that may hold a key of ``source``."""
        version = self.current()
        paths = self.files_for(source, version)
        return self._files(paths) if paths else self.read(version).limit(0)

    def unseen(self, source: DataFrame, version: Version) -> DataFrame:
        """The rows of ``source`` whose key that version does not hold.

        The stored keys are never broadcast: packed in files, millions of them look small to the planner.
        """
        paths = self.files_for(source, version)
        if not paths:
            return source
        return source.join(self._files(paths).select(*self.keys).hint("merge"), self.keys, "left_anti")

    def _add(self, df: DataFrame, at_most: int) -> dict[str, list[int]]:
        """Rows written to a new folder with their filter; nothing if there are none."""
        folder = f"data-{uuid.uuid4().hex}"
        parts = _power(-(-at_most // self.file_rows))
        blocks = max(parts, _power(-(-at_most // BLOCK_KEYS)))
        dealt = df.withColumn("__part", self._hash().bitwiseAND(F.lit(parts - 1)))
        dealt.repartition(parts, "__part").write.partitionBy("__part").parquet(f"{self.root}/{folder}/rows")
        if not any(s.getPath().getName().startswith("__part=") for s in self._fs.listStatus(self._path(f"{self.root}/{folder}/rows"))):
            self._fs.delete(self._path(f"{self.root}/{folder}"), True)
            return {}
        rows = self._files([f"{self.root}/{folder}/rows"])
        bits = rows.select(self._hash().bitwiseAND(F.lit(blocks - 1)).alias("block"), F.explode(F.array(*self._places())).alias("place"))
        bits.groupBy("block").agg(F.bitmap_construct_agg("place").alias("bits")).withColumn("folder", F.lit(folder)).write.parquet(f"{self.root}/{folder}/keys")
        return {folder: [parts, blocks, rows.count()]}

    def insert(self, source: DataFrame, version: Version | None = None) -> int:
        """Add the rows whose key is not stored yet; returns the version that holds them.

        Rows with a NULL in their key always count as new, and rows of the source that share a new key are all added.
        ``version`` is the one that ``source`` was made from, if it depends on one.
        """
        version = version or self.current()
        source = written(source, "batch")  # it is looked at several times
        added = self._add(self.unseen(source, version), max(1, source.count()))
        if not added and version.number:
            return version.number
        if not added:  # an empty table still has its columns
            folder = f"data-{uuid.uuid4().hex}"
            source.limit(0).write.parquet(f"{self.root}/{folder}/rows")
            self.spark.createDataFrame([], "folder string, block bigint, bits binary").write.parquet(f"{self.root}/{folder}/keys")
            added = {folder: [1, 1, 0]}
        number = self._publish(Version(0, version.folders | added), version.number)
        number = self._compact(number) if len(version.folders) + len(added) > self.folders else number
        self._forget()
        return number

    def _compact(self, number: int) -> int:
        """Put the smallest folders together: all that are no larger than the sum of those smaller than them."""
        version = self.current()
        by_size = sorted(version.folders, key=lambda f: version.folders[f][2])
        small, total = by_size[:2], sum(version.folders[f][2] for f in by_size[:2])
        for f in by_size[2:]:
            if version.folders[f][2] > total:
                break
            small.append(f)
            total += version.folders[f][2]
        made = self._add(self._files([f"{self.root}/{f}/rows" for f in small]), max(1, total))
        return self._publish(Version(0, {f: v for f, v in version.folders.items() if f not in small} | made), number)

