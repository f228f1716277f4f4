"""Near-duplicate groups by SimHash fingerprints and deletion-variant signatures."""

from __future__ import annotations

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import attach, table, texts, whole_row

HALF = 32  # bits of a segment: two segments, so that of 3 differing bits one segment has at most one
# Members of a signature that are compared directly in one task. Larger groups are cut by signatures of the other half.
DIRECT = 2048


def fingerprint(text: bytes, shingle: int) -> int:
    """SimHash of one lower-cased UTF-8 text: a bit is set if more than half of the shingle hashes (XXH64, seed 42) have it."""
    words = text.lower().split()
    if not words:
        return 0
    if len(words) <= shingle:
        return xxhash.xxh64_intdigest(b" ".join(words), 42)
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = (ends[: len(words) - shingle + 1] - np.fromiter(map(len, words[: len(words) - shingle + 1]), np.int64) - 1).tolist()
    stops = (ends[shingle - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    ones = np.zeros(64, np.int64)
    for at in range(0, len(starts), 50_000):  # a very long text needs no more memory than this many shingles
        h = np.array([digest(line[s:e], 42) for s, e in zip(starts[at : at + 50_000], stops[at : at + 50_000])], ">u8")
        ones += np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(starts)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 3) -> DataFrame:
    """``(__did, __row, doc_id, fp)`` per row: its key, its id and the fingerprint as a signed bigint."""
    names = ["__did", "__row", "doc_id"]

    def run(batches):
        for b in batches:
            fp = np.array([fingerprint(t, shingle) for t in texts(b)], np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*(b.column(n) for n in names), pa.array(fp)], [*names, "fp"])

    narrow = docs.select(*whole_row(docs), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "__did bigint, __row bigint, doc_id bigint, fp bigint")


def near_groups(prints: np.ndarray, most: int) -> np.ndarray:
    """Per fingerprint the smallest one that it reaches over links of at most ``most`` bits within the given ones."""
    root = np.zeros_like(prints)
    left = np.arange(len(prints))
    while len(left):
        seed, todo = prints[left[0]], [left[0]]
        root[left[0]] = seed
        left = left[1:]
        while todo and len(left):
            near = np.bitwise_count(prints[left] ^ prints[todo.pop()]) <= most
            root[left[near]] = seed
            todo.extend(left[near])
            left = left[~near]
    return root


def _dense_groups(prints: np.ndarray, most: int) -> np.ndarray:
    """As ``near_groups`` for a large group whose members differ in few bit places: neighbours are looked up, not compared."""
    varying = int(np.bitwise_or.reduce(prints ^ prints[0]))
    bits = [1 << i for i in range(64) if varying >> i & 1]
    masks = {0}
    for _ in range(most):
        masks |= {m ^ b for m in masks for b in bits}
    masks = np.array(sorted(masks - {0}), np.uint64)
    root, seen = np.zeros_like(prints), np.zeros(len(prints), bool)
    for i in range(len(prints)):
        if seen[i]:
            continue
        seen[i], root[i], todo = True, prints[i], prints[i : i + 1]
        while len(todo):
            at = np.concatenate([_found(prints, (part[:, None] ^ masks).ravel()) for part in np.array_split(todo, max(1, len(todo) // 256))])
            at = np.unique(at[~seen[at]])
            seen[at], root[at], todo = True, prints[i], prints[at]
    return root


def _found(prints: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    at = np.minimum(np.searchsorted(prints, wanted), len(prints) - 1)
    return at[prints[at] == wanted]


def _group_edges(groups: DataFrame, most: int, direct: int) -> DataFrame:
    """Rows with an array ``fps`` -> edges from each member to the smallest of its component within the array."""
    def run(batches):
        for b in batches:
            a_, b_ = [], []
            for fps in b["fps"]:
                p = np.sort(np.asarray(fps, np.int64).view(np.uint64))
                if len(p) == 2:
                    root = p[[0, 0]] if int(p[0] ^ p[1]).bit_count() <= most else p
                else:
                    root = near_groups(p, most) if len(p) <= 2 * direct else _dense_groups(p, most)
                far = root != p
                a_.append(root[far])
                b_.append(p[far])
            if a_:
                yield pd.DataFrame({"a": np.concatenate(a_).view(np.int64), "b": np.concatenate(b_).view(np.int64)})

    return groups.select("fps").mapInPandas(run, "a bigint, b bigint")


def near_edges(prints: DataFrame, most: int = 3, direct: int = DIRECT) -> DataFrame:
    """Edges ``(a, b)`` between distinct fingerprints that join the same fingerprints as all links of at most ``most`` (<= 3) bits.

    Each fingerprint is cut into two halves. Of at most three differing bits, one half has at most one; so two
    linked fingerprints share a signature: that half with one bit masked, and the place of the mask. Signatures
    that several fingerprints share are found by a partial count and an equality join. A signature's members are
    compared in one task if they are at most ``direct``; a larger group is cut again by the same signatures of
    the two quarters of the other half, after which at most 18 bits are free, so a group is bounded by 2^18
    fingerprints at any size of the input. A group yields one edge per member, not its pairs.
    """
    assert most <= 3, "two halves find three differing bits at most"
    # A fixed number of partitions: each row becomes 64, so adaptive execution must not gather them into a few tasks.
    # Dealt by another hash than that of the distinct rows, as Spark leaves out a shuffle that equals the one before it.
    tasks = int(prints.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    fps = prints.select("fp").distinct().repartition(tasks, F.xxhash64("fp"))
    both = F.explode(F.sequence(F.lit(0), F.lit(2 * HALF - 1)))
    masked = F.expr(f"(CASE WHEN slot < {HALF} THEN shiftrightunsigned(fp, {HALF}) ELSE fp & {2**HALF - 1} END) & ~shiftleft(1L, slot % {HALF})")
    variants = fps.withColumn("slot", both).select("fp", "slot", (masked + F.col("slot").cast("bigint") * F.lit(2**HALF)).alias("sig"))
    shared = variants.groupBy("sig").agg(F.count("*").alias("n")).filter("n > 1")
    # Never a broadcast: the planner sizes the variants by the fingerprints that they are made from, a 64th of their rows.
    matched = variants.join(shared.hint("merge"), "sig")
    few = matched.filter(F.col("n") <= direct).groupBy("sig").agg(F.collect_list("fp").alias("fps"))
    quarter = F.expr("CASE WHEN slot < 32 THEN fp & 4294967295 ELSE shiftrightunsigned(fp, 32) END")
    cut = (
        matched.filter(F.col("n") > direct)
        .withColumn("rest", quarter)
        .withColumn("sub", F.explode(F.sequence(F.lit(0), F.lit(31))))
        .withColumn("part", F.expr("(CASE WHEN sub < 16 THEN shiftrightunsigned(rest, 16) ELSE rest & 65535 END) & ~shiftleft(1L, sub % 16)"))
    )
    many = cut.groupBy("sig", "sub", "part").agg(F.collect_list("fp").alias("fps")).filter("size(fps) > 1")
    return _group_edges(few, most, direct).union(_group_edges(many, most, direct)).distinct()


def simhash_groups(docs: DataFrame, shingle: int = 3, most: int = 3, direct: int = DIRECT) -> DataFrame:
    """``(__did, __row, doc_id, fp, root, fingerprint, component_id)`` per row of ``docs`` (columns ``doc_id``, ``text``).

    Fingerprints are linked when they differ in at most ``most`` bits; ``component_id`` is the smallest doc_id
    that can be reached over links, the row's own included. A null or empty text has fingerprint zero and is
    linked like any other. Texts of up to ``shingle`` words are one shingle. Repeated rows and equal texts share
    a fingerprint and so a group. A null doc_id keeps its row and never becomes a component_id unless its whole
    group has none. Other columns only help to tell rows apart; an empty table gives no rows.
    """
    prints = table(fingerprints(docs, shingle), "simhash")
    firsts = prints.groupBy("fp").agg(F.min("doc_id").alias("first"))
    roots = components(near_edges(prints, most, direct)).select(F.col("node").alias("fp"), "root")
    firsts = firsts.join(roots, "fp", "left").withColumn("root", F.coalesce("root", "fp"))
    group = firsts.groupBy("root").agg(F.min("first").alias("component_id"))
    named = firsts.join(group, "root").select("fp", "root", "component_id")
    return prints.join(named, "fp").withColumn("fingerprint", F.lower(F.lpad(F.hex("fp"), 16, "0"))).select(
        "__did", "__row", "doc_id", "fp", "root", "fingerprint", "component_id")


def one_per_group(docs: DataFrame, shingle: int = 3, most: int = 3) -> DataFrame:
    """The documents without near-duplicates: of each group the row with the smallest doc_id (null last), then the smallest row hash."""
    groups = simhash_groups(docs, shingle, most).groupBy("root").agg(F.min(F.struct("__did", "__row")).alias("r"))
    return attach(docs, groups.select("r.*")).select(*docs.columns)
