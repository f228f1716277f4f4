"""CSV members of zip archives as a data source with one partition per member."""

from __future__ import annotations

import csv
import io
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition
from pyspark.sql.types import StructType

CHUNK = 5000  # lines that a task holds at a time


@contextmanager
def opened(path: str, mode: str = "rb"):
    """A seekable file of any store that Arrow knows (local, HDFS, S3, GCS, Azure), as a Python file."""
    from pyarrow import fs

    if path.startswith("file:"):
        path = "/" + path[5:].lstrip("/")
    store, name = (fs.LocalFileSystem(), path) if path.startswith("/") else fs.FileSystem.from_uri(path)
    with (store.open_output_stream(name) if mode == "wb" else store.open_input_file(name)) as f:
        yield f


class Member(InputPartition):
    def __init__(self, path: str, name: str):
        self.path, self.name = path, name


class ZipReader(DataSourceReader):
    """Members come from the archives' central directories; a task seeks to its member and streams it."""

    def __init__(self, options: dict):
        self.paths, self.first = options["paths"].split("\n"), options.get("first", "false") == "true"
        self.sep, self.encoding = options.get("sep", ","), options.get("encoding", "UTF-8")

    def partitions(self) -> list[Member]:
        out = []
        for path in filter(None, self.paths):
            with opened(path) as f, zipfile.ZipFile(f) as archive:
                names = [m.filename for m in archive.infolist() if not m.is_dir()]
            out += [Member(path, n) for n in (names[:1] if self.first else names)]
        return out or [Member("", "")]

    def read(self, partition: Member) -> Iterator[pa.RecordBatch]:
        if not partition.path:
            return
        with opened(partition.path) as f, zipfile.ZipFile(f) as archive, archive.open(partition.name) as raw:
            lines = csv.reader(io.TextIOWrapper(raw, encoding=self.encoding, newline=""), delimiter=self.sep)
            place, held = {}, []
            for at, name in enumerate(next(lines, [])):
                place.setdefault(name, at)
            for i, line in enumerate(x for x in lines if x):
                held.append((i, [(name, line[at]) for name, at in place.items() if at < len(line)]))
                if len(held) == CHUNK:
                    yield self.frame(partition, held)
                    held = []
            if held:
                yield self.frame(partition, held)

    @staticmethod
    def frame(partition: Member, held: list) -> pa.RecordBatch:
        kinds = [pa.string(), pa.string(), pa.int64(), pa.map_(pa.string(), pa.string())]
        values = [[partition.path] * len(held), [partition.name] * len(held), [i for i, _ in held], [r for _, r in held]]
        return pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(values, kinds)], ["path", "member", "line", "record"])


class ZipReports(DataSource):
    """``spark.read.format("zip_reports").option("paths", one per line)`` with ``sep``, ``encoding`` and ``first`` (only the first member)."""

    @classmethod
    def name(cls) -> str:
        return "zip_reports"

    def schema(self) -> str:
        return "path string, member string, line bigint, record map<string,string>"

    def reader(self, schema: StructType) -> ZipReader:
        return ZipReader(self.options)


def ingest_zip_reports(spark: SparkSession, glob: str, date_regex: str, date_format: str = "yyyyMMdd", sep: str = ",", encoding: str = "UTF-8",
                       date_col: str = "snapshot_date", first_only: bool = False, loaded: DataFrame | None = None) -> DataFrame:
    """CSV members of zip archives as (path, member, line number, values by header name, date of the archive).

    Archives are listed by Spark and opened by Arrow's file systems. One task reads one member, line by line, so a
    member is the unit of work and memory is bounded by a chunk of lines. Empty lines are skipped; of columns with the
    same name the first counts, and missing values at a line's end are absent. ``loaded`` holds the dates already in
    the target: their archives are not opened. ``first_only`` reads the first member of each archive.
    """
    date = F.to_date(F.regexp_extract("path", date_regex, 1), date_format)
    found = spark.read.format("binaryFile").load(glob).select("path", date.alias("__date"))
    if loaded is not None:
        found = found.join(loaded.select(F.col(date_col).alias("__date")).distinct(), "__date", "left_anti")
    paths = sorted(r["path"] for r in found.select("path").collect())  # names only
    spark.dataSource.register(ZipReports)
    reader = spark.read.format("zip_reports").option("paths", "\n".join(paths)).option("sep", sep).option("encoding", encoding).option("first", str(first_only).lower())
    return reader.load().withColumn(date_col, date)
