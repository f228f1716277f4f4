"""Benchmark decontamination with an FM-index per shard of documents."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .fm_index import FMIndex
from .shared import ALNUM, table, texts, whole_row

WINDOW = 13
SHARD_SYMBOLS = 1_000_000  # indexed words of a shard
SHARD_DOCS = 20_000
BLOCK_BYTES = 32_000_000  # text of the benchmark items that one pass over the documents looks for
FOUND = "n_words bigint, spans array<struct<start:int,stop:int>>, items array<string>"


def words_of(text: bytes) -> list[bytes]:
    return text.translate(ALNUM).split()


class Phrases:
    """The windows of a block of benchmark items as numbers: words, distinct phrases by length, and their items."""

    def __init__(self, items: list[tuple[str, bytes]], window: int):
        self.number: dict[bytes, int] = {}
        seen: dict[tuple[int, ...], set[str]] = {}
        for item, text in items:
            w = [self.number.setdefault(x, len(self.number) + 1) for x in words_of(text)]
            for i in range(max(1, len(w) - window + 1) if w else 0):
                seen.setdefault(tuple(w[i : i + window]), set()).add(item)
        self.shortest = min(map(len, seen), default=0)
        by_length: dict[int, list] = {}
        for p in seen:
            by_length.setdefault(len(p), []).append(p)
        self.groups = [(np.array(ps, np.int64), [seen[p] for p in ps]) for ps in by_length.values()]


def _search_shard(docs: list[tuple], phrases: Phrases) -> list[tuple[list, set]]:
    """Per document of the shard the merged hit spans and the items found. ``docs``: runs ``(start, symbols)`` of each."""
    runs = [(d, start, symbols) for d, parts in enumerate(docs) for start, symbols in parts]
    out = [([], set()) for _ in docs]
    if not runs:
        return out
    index = FMIndex([r[2] for r in runs], len(phrases.number))
    doc_of, start_of = np.array([r[0] for r in runs]), np.array([r[1] for r in runs])
    edges = np.zeros(index.n + 1, np.int64)
    for block, items in phrases.groups:
        low, high = index.search(block)
        hit = np.nonzero(high > low)[0]
        if not len(hit):
            continue
        n = (high - low)[hit]
        rows = np.repeat(low[hit] - np.cumsum(n) + n, n) + np.arange(int(n.sum()))
        at = index.locate(rows)
        np.add.at(edges, at, 1)
        np.add.at(edges, at + block.shape[1], -1)
        docs_hit = doc_of[np.searchsorted(index.starts, at, "right") - 1]
        for d, p in np.unique(np.stack([docs_hit, np.repeat(hit, n)], 1), axis=0).tolist():
            out[d][1].update(items[p])
    covered = np.diff(np.concatenate([[0], (np.cumsum(edges) > 0).astype(np.int8)]))
    for a, b in zip(np.nonzero(covered == 1)[0].tolist(), np.nonzero(covered == -1)[0].tolist()):
        r = int(np.searchsorted(index.starts, a, "right")) - 1
        shift = int(start_of[r] - index.starts[r])
        out[doc_of[r]][0].append({"start": a + shift, "stop": b + shift})
    return out


def _pass(docs: DataFrame, phrases: Phrases) -> DataFrame:
    """One pass over the documents for one block of phrases; columns of ``docs`` except the text, and ``FOUND``."""
    shared = docs.sparkSession.sparkContext.broadcast(phrases)
    names = [c for c in docs.columns if c != "text"]
    schema = ", ".join(f"{n} {t}" for n, t in docs.dtypes if n != "text") + ", " + FOUND
    found = pa.struct([("start", pa.int32()), ("stop", pa.int32())])

    def run(batches):
        p = shared.value
        number = p.number
        keep, counts, parts, n_symbols = [], [], [], 0

        def shard():
            spans, items = zip(*_search_shard(parts, p))
            rows = pa.Table.from_batches(keep).combine_chunks().to_batches()[0]
            return pa.RecordBatch.from_arrays(
                [*(rows.column(n) for n in names), pa.array(counts, pa.int64()), pa.array(spans, pa.list_(found)), pa.array([sorted(x) for x in items], pa.list_(pa.string()))],
                [*names, "n_words", "spans", "items"],
            )

        for b in batches:
            start = 0
            for i, t in enumerate(texts(b)):
                w = words_of(t)
                ids = np.fromiter((number.get(x, 0) for x in w), np.int64, len(w))
                # A word that no phrase has ends a run; a run shorter than any phrase cannot hold one.
                cut = np.concatenate([[-1], np.nonzero(ids == 0)[0], [len(ids)]])
                long = np.nonzero(np.diff(cut) - 1 >= max(1, p.shortest))[0] if p.groups else ()
                parts.append([(int(cut[k]) + 1, ids[cut[k] + 1 : cut[k + 1]]) for k in long])
                n_symbols += sum(len(s) for _, s in parts[-1])
                counts.append(len(w))
                if n_symbols >= SHARD_SYMBOLS or len(parts) >= SHARD_DOCS:
                    keep.append(b.slice(start, i + 1 - start))
                    yield shard()
                    keep, counts, parts, n_symbols, start = [], [], [], 0, i + 1
            if start < b.num_rows:
                keep.append(b.slice(start))
        if parts:
            yield shard()

    return docs.mapInArrow(run, schema)


def find_contamination(docs: DataFrame, benchmark: DataFrame, item: str = "item_id", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``(__did, __row, doc_id, n_words, spans, items)`` per row of ``docs``.

    Words are runs of ASCII letters and digits and any other non-ASCII characters, lower-cased in A-Z. Every
    ``window`` consecutive words of an item, or all words of a shorter one, are a phrase. ``spans`` are the merged
    word ranges of ``docs`` inside any occurrence of a phrase, ``items`` the ids (as strings) with an occurrence.

    Documents are gathered into shards of bounded size inside each task; each shard gets an FM-index over the words
    that some phrase contains, in which all phrases are searched backward at once and their places located. The
    benchmark is taken in blocks of at most about ``block_bytes`` of text, so what is sent to the tasks is bounded;
    each block is one pass over the documents, and the passes' spans are merged.

    A null or empty text has no words; a null item text has no phrases; a null item id counts as the item ``''``;
    items that share an id are one item. Repeated rows are judged alike. Empty tables give no rows or no hits.
    """
    keyed = docs.select(*whole_row(docs), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    items = benchmark.select(F.coalesce(F.col(item).cast("string"), F.lit("")).alias("item"), F.col("text").cast("string").alias("text")).filter("text IS NOT NULL")
    sized = table(items.withColumn("size", F.octet_length("text") + 64), "benchmark")
    before = F.sum("size").over(Window.orderBy("item", "text").rowsBetween(Window.unboundedPreceding, -1))
    if (sized.agg(F.sum("size").alias("s")).first()["s"] or 0) <= block_bytes:
        sized = sized.withColumn("block", F.lit(0))
    else:
        sized = table(sized.withColumn("block", F.floor(F.coalesce(before, F.lit(0)) / block_bytes).cast("int")), "benchmark")
    blocks = [r["block"] for r in sized.select("block").distinct().orderBy("block").collect()] or [0]
    passes = []
    for b in blocks:
        mine = [(r["item"], r["text"].encode()) for r in sized.filter(F.col("block") == b).collect()]
        passes.append(_pass(keyed, Phrases(mine, window)))
    first = passes[0]
    if len(passes) == 1:
        return first
    more = passes[1].filter("size(spans) > 0")
    for p in passes[2:]:
        more = more.union(p.filter("size(spans) > 0"))
    joined = more.groupBy("__did", "__row").agg(
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("spans")))).alias("m_spans"), F.array_distinct(F.flatten(F.collect_list("items"))).alias("m_items")
    )
    both = first.join(joined, ["__did", "__row"], "left")
    spans = F.array_sort(F.concat("spans", F.coalesce("m_spans", F.array().cast("array<struct<start:int,stop:int>>"))))
    merged = F.expr(
        "aggregate(all_spans, cast(array() AS array<struct<start:int,stop:int>>), (a, s) -> if(size(a) > 0 AND s.start <= element_at(a, -1).stop,"
        " concat(slice(a, 1, size(a) - 1), array(named_struct('start', element_at(a, -1).start, 'stop', greatest(element_at(a, -1).stop, s.stop)))), concat(a, array(s))))"
    )
    items = F.array_sort(F.array_union("items", F.coalesce("m_items", F.array().cast("array<string>"))))
    return both.withColumn("all_spans", spans).withColumn("spans", merged).withColumn("items", items).select(*first.columns)


def contaminated(found: DataFrame) -> DataFrame:
    """Add ``n_hit`` (words inside spans) and ``contaminated``: some hit, and a twentieth of the words or more."""
    n_hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["stop"] - s["start"])
    return found.withColumn("n_hit", n_hit).withColumn("contaminated", F.expr("n_hit > 0 AND 20 * n_hit >= n_words"))


def clean(docs: DataFrame, benchmark: DataFrame, window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, unchanged."""
    out = contaminated(find_contamination(docs, benchmark, window=window)).filter("contaminated").select("__did", "__row")
    return docs.select(*whole_row(docs), "*").join(out, ["__did", "__row"], "left_anti").select(*docs.columns)
