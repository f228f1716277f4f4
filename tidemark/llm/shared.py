"""Helpers that several training-data operators share: tables cut from their lineage, bounded text batches, packed arrays."""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import configure, shared_dir

# Words between ASCII white space; bytes.split() cuts at the same six characters.
WORD = r"[^\x20\x09-\x0D]+"
# Lower-cases A-Z and turns every other ASCII character that is no letter or digit into a space; bytes of other letters stay.
ALNUM = bytes(c + 32 if 65 <= c <= 90 else c if c >= 128 or 48 <= c <= 57 or 97 <= c <= 122 else 32 for c in range(256))


def table(df: DataFrame, label: str) -> DataFrame:
    """``df`` written below ``spark.checkpoint.dir`` and read again: it is computed once and survives lost executors."""
    spark = configure(df.sparkSession)
    path = shared_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def word_total(docs: DataFrame, text: str = "text") -> int:
    """A rough number of words, from the length of the texts (only used to choose how many buckets there are)."""
    return int((docs.agg(F.sum(F.length(text)).alias("n")).first()["n"] or 0) / 6) + 1


def buckets_for(n: int, each: int) -> int:
    """Number of hash buckets that hold about ``each`` of ``n`` items; a few dozen at least, so that all cores have work."""
    return max(32, math.ceil(n / each))


def row_key(doc_id: str = "doc_id", text: str = "text") -> list[Column]:
    """What tells documents apart: the id (null last) and the text. Rows that agree in both are one document."""
    return [F.coalesce(F.col(doc_id).cast("bigint"), F.lit(2**63 - 1)).alias("did"), F.xxhash64(F.col(text)).alias("th")]


def whole_row(docs: DataFrame) -> list[Column]:
    """A key that only rows equal in every column share: the id (null last) and a hash of the whole row."""
    return [F.coalesce(F.col("doc_id").cast("bigint"), F.lit(2**63 - 1)).alias("__did"), F.xxhash64(*[F.col(f"`{c}`") for c in docs.columns]).alias("__row")]


def attach(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """One output row per row of ``decided`` (keyed by ``__did, __row``): the document with that key and the other columns.

    Equal rows of ``docs`` count once, so ``decided`` says how often such a row appears. It has as many rows as there
    are documents, or more, which the planner does not see after an explode; it is never broadcast. The documents lie
    by key already.
    """
    once = docs.select(*whole_row(docs), "*").dropDuplicates(["__did", "__row"])
    return once.join(decided.hint("merge"), ["__did", "__row"]).drop("__did", "__row")


def texts(batch: pa.RecordBatch, name: str = "text") -> list[bytes]:
    """The texts of an Arrow batch as UTF-8; null is empty."""
    return [x or b"" for x in batch.column(name).cast(pa.binary()).to_pylist()]


class WordHash(dict):
    """Word -> 64-bit hash, worked out once per word; emptied when it has grown large."""

    def __missing__(self, word: bytes) -> int:
        h = self[word] = xxhash.xxh3_64_intdigest(word)
        return h

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self) > 400_000:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def word_batches(batches: Iterator[pa.RecordBatch], most: int, split, text: str = "text") -> Iterator[tuple[list[dict], list[list[bytes]]]]:
    """Rows with their words, in groups of about ``most`` words (one document at least)."""
    rows, words, n = [], [], 0
    for batch in batches:
        other = batch.drop_columns([text]).to_pylist()
        for row, t in zip(other, texts(batch, text)):
            w = split(t)
            if rows and n + len(w) > most:
                yield rows, words
                rows, words, n = [], [], 0
            rows.append(row)
            words.append(w)
            n += len(w)
    if rows:
        yield rows, words


def pack_gaps(values: np.ndarray) -> bytes:
    """Rising integers as their gaps, one or two bytes each, whichever is shorter; a full byte or word carries on."""
    gaps = np.diff(values.astype(np.int64), prepend=0)
    kind, top = (np.uint8, 255) if not len(gaps) or gaps.mean() < 100 else (np.uint16, 65535)
    more, rest = np.divmod(gaps, top)
    out = np.full(int(more.sum()) + len(gaps), top, kind)
    out[np.cumsum(more + 1) - 1] = rest
    return (b"\1" if kind is np.uint8 else b"\2") + out.tobytes()


def unpack_gaps(data: bytes) -> np.ndarray:
    kind, top = (np.uint8, 255) if data[:1] == b"\1" else (np.uint16, 65535)
    raw = np.frombuffer(data, kind, offset=1)
    return np.cumsum(raw, dtype=np.int64)[raw != top]


def pack_low(values: np.ndarray, width: int) -> bytes:
    """The low ``width`` bytes of 64-bit numbers."""
    return np.ascontiguousarray(values.astype("<u8")).view(np.uint8).reshape(-1, 8)[:, :width].tobytes()


def unpack_low(data: bytes, width: int) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8).reshape(-1, width)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :width] = raw
    return out.view("<u8").ravel()


def pack_numbers(values: np.ndarray) -> bytes:
    """Whole numbers, byte by byte: all lowest bytes first, so that the high ones compress to nothing."""
    v = np.ascontiguousarray(values.astype("<u8"))
    width = max(1, (int(v.max()).bit_length() + 7) // 8) if len(v) else 1
    return bytes([width]) + v.view(np.uint8).reshape(-1, 8)[:, :width].T.tobytes()


def unpack_numbers(data: bytes) -> np.ndarray:
    raw = np.frombuffer(data, np.uint8, offset=1).reshape(data[0], -1)
    out = np.zeros((raw.shape[1], 8), np.uint8)
    out[:, : data[0]] = raw.T
    return out.view("<u8").ravel()
