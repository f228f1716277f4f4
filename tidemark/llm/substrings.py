"""Removal of repeated word sequences with fixed-block anchors.

A repeat of ``window`` words holds a whole block of its first occurrence, if every document is cut into blocks of half
a window. So: blocks are the index, all rolling windows of block length are the probes, and only where a probe meets a
block of another place are the sequences extended, to runs of windows that occurred before. Both steps send numbers
packed into arrays: a task's batch of documents is cut into hash buckets, a bucket's rows meet in one task, and what
it finds goes back to the batch. Within a batch equal sequences are settled at once and sent once, so a passage that
millions of documents share adds one entry per batch to its bucket. The number of buckets follows the size of the
input, so buckets keep their size.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .parcels import PARCEL, batch_name, frame, parcel, parcels
from .shared import WordHash, buckets_for, pack_gaps, pack_low, row_key, texts, unpack_gaps, unpack_low, word_total

WINDOW = 20
BATCH_WORDS = 1_500_000
BUCKET_ENTRIES = 4_000_000
LOW = 4  # bytes of an anchor's hash beyond its bucket; in a bucket of this size one probe in ten thousand matches falsely, which only adds a candidate
RESULT = "did bigint, th bigint, places binary"
MIX = (np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F))  # odd multipliers of the two rolling hashes


class Batch:
    """Documents of one task, as one array of word hashes with the documents' places in it."""

    def __init__(self, dids: list[int], ths: list[int], hashes: list[np.ndarray], extra: list):
        self.dids, self.ths, self.extra = np.array(dids, np.int64), np.array(ths, np.int64), extra
        sizes = np.fromiter(map(len, hashes), np.int64, len(hashes))
        self.starts = np.cumsum(sizes) - sizes
        self.words = np.concatenate(hashes) if hashes else np.empty(0, np.uint64)
        self.doc = np.repeat(np.arange(len(sizes)), sizes)
        self.left = np.repeat(self.starts + sizes, sizes) - np.arange(len(self.words))  # words from here to the document's end

    def rolling(self, words: np.ndarray, k: int, by: np.uint64) -> np.ndarray:
        n = max(0, len(words) - k + 1)
        out = words[:n].copy()
        for j in range(1, k):
            out = out * by + words[j : n + j]
        return out


def _batches(parts: Iterator[pa.RecordBatch], most: int, extra: str | None = None) -> Iterator[Batch]:
    hasher, dids, ths, hashes, more, n = WordHash(), [], [], [], [], 0
    for b in parts:
        others = b.column(extra).to_pylist() if extra else [None] * b.num_rows
        for did, th, t, x in zip(b.column("did").to_pylist(), b.column("th").to_pylist(), texts(b), others):
            h = hasher.of(t.split())
            if dids and n + len(h) > most:
                yield Batch(dids, ths, hashes, more)
                dids, ths, hashes, more, n = [], [], [], [], 0
            dids.append(did)
            ths.append(th)
            hashes.append(h)
            more.append(x)
            n += len(h)
    if dids:
        yield Batch(dids, ths, hashes, more)


def _groups(keys: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Order by the keys (first one leading) and, in that order, whether an entry differs in them from the one before."""
    order = np.lexsort(keys[::-1]) if len(keys) > 1 else np.argsort(keys[0], kind="stable")
    fresh = np.ones(len(order), bool)
    fresh[1:] = np.logical_or.reduce([k[order[1:]] != k[order[:-1]] for k in keys])
    return order, fresh


def _runs(values: np.ndarray) -> bytes:
    """Values and lengths of the runs of equal neighbours."""
    first = np.concatenate([[0], np.nonzero(np.diff(values))[0] + 1])
    return np.concatenate([values[first], np.diff(np.append(first, len(values)))]).astype(np.int64).tobytes()


def _own(batch: Batch, name: int, places: np.ndarray, buckets: int) -> dict:
    """The row that goes back to the batch itself: its documents and the places settled within it."""
    return parcel(-1 - name % buckets, name, docs=np.concatenate([batch.dids, batch.ths, batch.starts]).tobytes(), places=pack_gaps(places))


def _return(sent: DataFrame, settle: Callable[[pd.DataFrame], pd.DataFrame]) -> DataFrame:
    """Settle each bucket, bring the found places back to their batch and list them by document."""
    def bucket(pdf: pd.DataFrame) -> pd.DataFrame:
        if pdf["bucket"].iloc[0] < 0:  # a batch's own rows pass through
            return pdf[["batch", "docs", "places"]]
        return settle(pdf)

    def batch(pdf: pd.DataFrame) -> pd.DataFrame:
        own = pdf[pdf["docs"].notna()]
        if len(own) != 1:
            raise RuntimeError("a batch of documents was made anew with other rows; read them from a file or checkpoint")
        dids, ths, starts = np.frombuffer(own["docs"].iloc[0], np.int64).reshape(3, -1)
        places = np.unique(np.concatenate([unpack_gaps(p) for p in pdf["places"]]))
        doc = np.searchsorted(starts, places, "right") - 1  # of documents without words the last one starts here
        cuts = np.concatenate([[0], np.nonzero(np.diff(doc))[0] + 1, [len(doc)]])
        found = [(doc[a], pack_gaps(places[a:b] - starts[doc[a]])) for a, b in zip(cuts[:-1], cuts[1:]) if b > a]
        at = np.array([d for d, _ in found], np.int64)
        return pd.DataFrame({"did": dids[at], "th": ths[at], "places": [p for _, p in found]})

    answers = sent.groupBy("bucket").applyInPandas(bucket, "batch bigint, docs binary, places binary")
    return answers.groupBy("batch").applyInPandas(batch, RESULT)


def anchor_hits(docs: DataFrame, buckets: int, block: int, least: int) -> DataFrame:
    """Starts of rolling windows of ``block`` words that equal a block of another place, by document.

    The index is every ``block``-th window of a document, the probes are all of them.
    """
    def run(parts):
        for number, b in enumerate(_batches(parts, BATCH_WORDS)):
            name = batch_name(number, b.dids, b.ths)
            h = b.rolling(b.words, block, MIX[0])
            at = np.nonzero(b.left[: len(h)] >= block)[0]
            anchor = (at - b.starts[b.doc[at]]) % block == 0
            order, fresh = _groups([h[at]])
            group = np.cumsum(fresh) - 1
            many = np.bincount(group)
            settled = np.sort(at[order[many[group] > 1]])
            is_anchor = np.zeros(len(many), bool)
            is_anchor[group[anchor[order]]] = True
            sent = np.sort(order[fresh])  # the first window of every kind stands for it
            flag = np.zeros(len(at), bool)
            flag[order[fresh]] = is_anchor
            hashes, flags = h[at[sent]], flag[sent]
            low = hashes // np.uint64(buckets)
            rows = parcels(name, at[sent], hashes, buckets, lambda i, low=low, flags=flags: {"hashes": pack_low(low[i], LOW), "flags": np.packbits(flags[i]).tobytes()})
            yield frame([*rows, _own(b, name, settled, buckets)])

    def settle(pdf: pd.DataFrame) -> pd.DataFrame:
        low = [unpack_low(x, LOW) for x in pdf["hashes"]]
        flags = np.concatenate([np.unpackbits(np.frombuffer(f, np.uint8), count=len(x)) for f, x in zip(pdf["flags"], low)]).astype(bool)
        row = np.repeat(np.arange(len(low)), [len(x) for x in low])
        order, fresh = _groups([np.concatenate(low)])
        group = np.cumsum(fresh) - 1
        good = (np.bincount(group) > 1) & (np.bincount(group, flags[order]) > 0)
        hit = np.zeros(len(order), bool)
        hit[order] = good[group]
        out = [(k, hit[row == k]) for k in np.unique(row[hit])]
        return pd.DataFrame({"batch": [pdf["batch"].iloc[k] for k, _ in out], "docs": [None] * len(out), "places": [pack_gaps(unpack_gaps(pdf["places"].iloc[k])[m]) for k, m in out]})

    return _return(docs.filter(F.length("text") >= 2 * least - 1).mapInArrow(run, PARCEL), settle)


def repeated_windows(docs: DataFrame, buckets: int, window: int, block: int) -> DataFrame:
    """Starts of windows whose words also start earlier (smaller did, or the same did and an earlier start).

    ``docs`` carries the anchor hits of each document; only windows that hold one are looked at. Windows are the
    same if two 64-bit rolling hashes of their words agree.
    """
    def run(parts):
        for number, b in enumerate(_batches(parts, BATCH_WORDS, "places")):
            name = batch_name(number, b.dids, b.ths)
            hit = np.zeros(len(b.words) + 1, np.int64)
            for s, p in zip(b.starts, b.extra):
                hit[s + unpack_gaps(p)] = 1
            upto = np.concatenate([[0], np.cumsum(hit)])
            n = max(0, len(b.words) - window + 1)
            start = np.arange(n)
            at = np.nonzero((b.left[:n] >= window) & (upto[start + window - block + 1] > upto[start]))[0]
            one = b.rolling(b.words, window, MIX[0])[at]
            two = b.rolling((b.words ^ (b.words >> np.uint64(29))) * MIX[0], window, MIX[1])[at]
            did, pos = b.dids[b.doc[at]], at - b.starts[b.doc[at]]
            order, fresh = _groups([one, two])
            order = np.lexsort([pos, did, two, one])
            first = order[np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))]
            later = (did[order] != did[first]) | (pos[order] != pos[first])
            settled = np.sort(at[order[later]])
            sent = np.sort(order[~later])
            o, t, d, p = one[sent], two[sent], did[sent], pos[sent]
            rows = parcels(name, at[sent], o, buckets, lambda i, o=o, t=t, d=d, p=p: {"hashes": np.concatenate([o[i], t[i]]).tobytes(), "docs": _runs(d[i]), "flags": p[i].astype(np.uint32).tobytes()})
            yield frame([*rows, _own(b, name, settled, buckets)])

    def settle(pdf: pd.DataFrame) -> pd.DataFrame:
        one, two = np.concatenate([np.frombuffer(x, np.uint64).reshape(2, -1) for x in pdf["hashes"]], axis=1)
        did = np.concatenate([np.repeat(*np.frombuffer(x, np.int64).reshape(2, -1)) for x in pdf["docs"]])
        pos = np.concatenate([np.frombuffer(x, np.uint32) for x in pdf["flags"]])
        row = np.repeat(np.arange(len(pdf)), [len(x) // 16 for x in pdf["hashes"]])
        _, fresh = _groups([one, two])
        order = np.lexsort([pos, did, two, one])
        first = order[np.maximum.accumulate(np.where(fresh, np.arange(len(order)), 0))]
        later = np.zeros(len(order), bool)
        later[order] = (did[order] != did[first]) | (pos[order] != pos[first])
        out = [(k, later[row == k]) for k in np.unique(row[later])]
        return pd.DataFrame({"batch": [pdf["batch"].iloc[k] for k, _ in out], "docs": [None] * len(out), "places": [pack_gaps(unpack_gaps(pdf["places"].iloc[k])[m]) for k, m in out]})

    return _return(docs.mapInArrow(run, PARCEL), settle)


def without_repeats(docs: DataFrame, window: int = WINDOW, buckets: int | None = None) -> DataFrame:
    """``(doc_id, did, th, n_words, n_removed, spans, kept_text)`` per row of ``docs``.

    Words are what lies between ASCII white space, unchanged. Every word of a ``window`` of consecutive words whose
    sequence also starts earlier (smaller doc_id, or same document and earlier start) is removed; windows are judged
    on the input. ``spans`` are the removed word ranges: maximal runs of such windows. ``kept_text`` is the rest,
    joined by one space.

    A null or empty text has no words and an empty ``kept_text``; texts below ``window`` words lose nothing. A null
    doc_id comes after all others. Repeated rows (same id and text) are one place and are not repeats of each
    other; rows of one id with different texts neither. Malformed UTF-8 is compared and kept as bytes. Other columns
    are not read; an empty table gives no rows.
    The rows of ``docs`` must be the same whenever they are computed (a file or a checkpoint).
    """
    assert window >= 3
    block = (window + 1) // 2  # 2 * block - 1 <= window: any window holds a whole block
    buckets = buckets or buckets_for(word_total(docs), BUCKET_ENTRIES)
    # Both joins below read the texts with the same columns, so that they share one shuffle of them.
    keyed = docs.select(*row_key(), F.col("text").cast("string").alias("text"))
    hits = anchor_hits(keyed, buckets, block, window).groupBy("did", "th").agg(F.first("places").alias("places"))
    suspects = keyed.join(hits, ["did", "th"]).select("did", "th", "text", "places")
    repeats = repeated_windows(suspects, buckets, window, block).groupBy("did", "th").agg(F.first("places").alias("places"))
    out = keyed.join(repeats, ["did", "th"], "left").select("did", "th", "text", "places").mapInArrow(
        lambda parts: _removed(parts, window), "did bigint, th bigint, n_words bigint, n_removed bigint, spans array<struct<start:int,stop:int>>, kept_text string"
    )
    return out.select(F.when(F.col("did") < 2**63 - 1, F.col("did")).alias("doc_id"), *out.columns)


def _removed(parts: Iterator[pa.RecordBatch], window: int) -> Iterator[pa.RecordBatch]:
    span = pa.struct([("start", pa.int32()), ("stop", pa.int32())])
    for b in parts:
        n_words, n_removed, spans, kept = [], [], [], []
        for t, p in zip(texts(b), b.column("places").to_pylist()):
            words, mine = t.split(), []
            n_words.append(len(words))
            if p is not None:
                starts = unpack_gaps(p)
                cut = np.nonzero(np.diff(starts) > window)[0]
                begin, end = starts[np.concatenate([[0], cut + 1])], starts[np.concatenate([cut, [len(starts) - 1]])] + window
                mine = [{"start": int(a), "stop": int(z)} for a, z in zip(begin, end)]
                edges = np.concatenate([[0], np.stack([begin, end], 1).ravel(), [len(words)]]).tolist()
                words = [w for a, z in zip(edges[::2], edges[1::2]) for w in words[a:z]]
            n_removed.append(sum(m["stop"] - m["start"] for m in mine))
            spans.append(mine)
            kept.append(b" ".join(words))
        arrays = [b.column("did"), b.column("th"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(spans, pa.list_(span)), pa.array(kept, pa.binary()).cast(pa.string(), safe=False)]
        yield pa.RecordBatch.from_arrays(arrays, ["did", "th", "n_words", "n_removed", "spans", "kept_text"])
