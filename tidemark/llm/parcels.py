"""Numbers of a batch of documents, packed into one row per hash bucket and one for the batch itself."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import xxhash
from pyspark import TaskContext

from .shared import pack_gaps

PARCEL = "bucket int, batch bigint, docs binary, places binary, hashes binary, flags binary"


def batch_name(number: int, *content: np.ndarray) -> int:
    """From task, number and content: a batch that were made anew of other rows would not pass for this one."""
    own = f"{TaskContext.get().partitionId()} {number} ".encode()
    return int(np.uint64(xxhash.xxh64_intdigest(own + b"".join(c.tobytes() for c in content))).view(np.int64))


def parcel(bucket: int, batch: int | None, **data: bytes) -> dict:
    return {"bucket": bucket, "batch": batch, "docs": None, "places": None, "hashes": None, "flags": None} | data


def parcels(batch: int, places: np.ndarray, hashes: np.ndarray, buckets: int, rest: Callable[[np.ndarray], dict]) -> list[dict]:
    """Rows for the buckets (by remainder) of the entries; ``places`` rise; ``rest`` packs the entries of one bucket."""
    bucket = (hashes % np.uint64(buckets)).astype(np.uint16 if buckets < 2**16 else np.int64)
    order = np.argsort(bucket, kind="stable")
    cuts = np.concatenate([[0], np.nonzero(np.diff(bucket[order]))[0] + 1, [len(order)]])
    rows = []
    for a, b in zip(cuts[:-1], cuts[1:]):
        mine = order[a:b]
        if len(mine):
            rows.append(parcel(int(bucket[mine[0]]), batch, **{"places": pack_gaps(places[mine])} | rest(mine)))
    return rows


def frame(rows: list[dict]) -> pa.RecordBatch:
    names = ["bucket", "batch", "docs", "places", "hashes", "flags"]
    kinds = [pa.int32(), pa.int64(), *[pa.binary()] * 4]
    return pa.RecordBatch.from_arrays([pa.array([r[n] for r in rows], k) for n, k in zip(names, kinds)], names)
