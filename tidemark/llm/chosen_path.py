"""Near-duplicate groups by a chosen-path set similarity join over minwise tokens (Christiani, Pagh and Sivertsen, 2018).

Every distinct shingle set has a fixed number of minwise tokens. A tree deals the sets out by one token, splits every
node that is still large by two tokens that the node chooses, and so on; sets that are alike stay together along some
path. Small nodes are compared exhaustively. Independent trees are repeated until the target recall is reached.

A large node that keeps more than three quarters of its sets together holds sets that are nearly the same. It is cut into blocks that all contain one set of
the node, which joins blocks of copies; what is not in the node's largest component by then is compared with all of it.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import components
from .shared import WordHash, table, texts, whole_row

TOKENS = 64  # minwise tokens of a set, 32 bits each
LEVEL = 8  # tokens that the nodes of one level choose from; the roots have the first ones
ALIKE = 40  # tokens that two sets of similarity 0.85 share with a chance of 1 - 10^-6
LIMIT = 500  # weight of a small node; a set weighs one, a large one a piece of HEAVY shingles
HEAVY = 8000
MIX = np.uint64(0x9E3779B97F4A7C15)
_R = np.random.default_rng(12)
MASK, ODD = _R.integers(0, 2**64, TOKENS, np.uint64), _R.integers(0, 2**64, TOKENS, np.uint64) | np.uint64(1)


def shingles(text: bytes, size: int, hashes: WordHash) -> np.ndarray:
    """The distinct shingles of a text as sorted 64-bit hashes; fewer words than ``size`` are one shingle, none are none."""
    words = hashes.of(text.lower().split())
    if len(words) < size:
        size = len(words)
    if not size:
        return words
    h = words[: len(words) - size + 1]
    for i in range(1, size):
        h = h * MIX + words[i : len(words) - size + 1 + i]
    return np.unique(h + np.uint64(size))


def tokens(shingle_set: np.ndarray) -> np.ndarray:
    """The minwise tokens of a set; two sets share each with the chance of their similarity."""
    least = np.full(TOKENS, 2**64 - 1, np.uint64)
    for at in range(0, len(shingle_set), 20_000):  # very long texts need no more memory
        least = np.minimum(least, ((shingle_set[at : at + 20_000, None] ^ MASK) * ODD).min(0))
    return ((least * MIX) >> np.uint64(32)).astype("<u4")


def described(docs: DataFrame, size: int) -> DataFrame:
    """``(__did, __row, doc_id, n, key, sig)`` per row: number of shingles, a 128-bit name of the set, its tokens."""
    names = ["__did", "__row", "doc_id"]

    def run(batches):
        hashes = WordHash()
        for b in batches:
            n, key, sig = [], [], []
            for t in texts(b):
                s = shingles(t, size, hashes)
                n.append(len(s))
                key.append(xxhash.xxh3_128_digest(s.tobytes()))
                sig.append(tokens(s).tobytes())
            yield pa.RecordBatch.from_arrays([*(b.column(x) for x in names), pa.array(n, pa.int64()), pa.array(key, pa.binary()), pa.array(sig, pa.binary())], [*names, "n", "key", "sig"])

    narrow = docs.select(*whole_row(docs), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return narrow.mapInArrow(run, "__did bigint, __row bigint, doc_id bigint, n bigint, key binary, sig binary")


def trees_for(similarity: float, recall: float) -> int:
    """Trees after which a pair of just that similarity has met with the wanted chance, however deep the trees are."""
    met = similarity
    for _ in range(64):
        met = similarity * (1 - (1 - met) ** 2)
    return max(1, math.ceil(math.log(1 - recall) / math.log(1 - met)))


def _sized(rows: DataFrame) -> DataFrame:
    """Rows of nodes with two sets or more, with the weight of their node."""
    sizes = rows.groupBy("node").agg(F.sum("w").alias("size"), F.count("*").alias("m")).filter("m > 1").drop("m")
    return rows.join(sizes, "node")


def tree_nodes(sets: DataFrame, trees: int, limit: int) -> tuple[list[DataFrame], list[DataFrame]]:
    """Rows ``(node, key)`` of small nodes, and ``(node, key, w, size)`` of nodes that do not fall apart."""
    roots = F.array(*[F.xxhash64(F.lit(t), F.substring("sig", 4 * t + 1, 4)) for t in range(trees)])
    rows = table(_sized(sets.select("key", "w", F.explode(roots).alias("node"))), "nodes")
    small, dense = [rows.filter(F.col("size") <= limit).select("node", "key")], []
    levels = range(trees, TOKENS - LEVEL + 1, LEVEL)
    for first in levels:
        large = rows.filter(F.col("size") > limit)
        large = large if first == trees else large.filter("4 * size <= 3 * above")
        if not large.take(1):
            return small, dense
        one = F.pmod(F.xxhash64("node", F.lit(1)), F.lit(LEVEL))
        two = F.pmod(one + 1 + F.pmod(F.xxhash64("node", F.lit(2)), F.lit(LEVEL - 1)), F.lit(LEVEL))
        both = large.join(sets.select("key", "sig"), "key").withColumn("at", F.explode(F.array(one, two)))
        child = F.xxhash64("node", "at", F.expr(f"substring(sig, cast(4 * ({first} + at) + 1 AS int), 4)"))
        rows = table(_sized(both.select("key", "w", F.col("size").alias("above"), child.alias("node"))), "nodes")
        small.append(rows.filter(F.col("size") <= limit).select("node", "key"))
        stuck = (F.col("size") > limit) & ((4 * F.col("size") > 3 * F.col("above")) | F.lit(first == levels[-1]))
        dense.append(rows.filter(stuck).select("node", "key", "w", "size"))
    return small, dense


def _groups(batches: Iterator[pa.RecordBatch], by: list[str]) -> Iterator[list[dict]]:
    """Rows that follow each other with the same values of ``by``."""
    held, name = [], None
    for b in batches:
        for r in b.to_pylist():
            at = tuple(r[x] for x in by)
            if held and at != name:
                yield held
                held = []
            name = at
            held.append(r)
    if held:
        yield held


def linked(n: int, near: Callable[[int, np.ndarray], np.ndarray]) -> Iterator[np.ndarray]:
    """The connected sets among n ones, two members or more; ``near(i, others)`` says which others i is linked with."""
    left = np.arange(n)
    while len(left):
        todo, left, found = [left[0]], left[1:], [left[0]]
        while todo and len(left):
            hit = near(todo.pop(), left)
            todo.extend(left[hit])
            found.extend(left[hit])
            left = left[~hit]
        if len(found) > 1:
            yield np.array(found)


def probable(rows: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """``(grp, key)``: within each node, sets that hang together by their tokens. Equal groups of several nodes are one."""
    def run(batches):
        for held in _groups(batches, ["node", "block"]):
            sig = np.frombuffer(b"".join(r["sig"] for r in held), "<u4").reshape(-1, TOKENS)
            n = np.array([r["n"] for r in held])

            def near(i, others):
                fits = 100 * np.minimum(n[i], n[others]) >= percent * np.maximum(n[i], n[others])
                fits[fits] = (sig[others[fits]] == sig[i]).sum(1) >= ALIKE
                return fits

            out = []
            for found in linked(len(held), near):
                keys = sorted(held[i]["key"] for i in found)
                out += [(xxhash.xxh3_128_digest(b"".join(keys)), k) for k in keys]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.binary()) for i in (0, 1)], ["grp", "key"])

    dealt = rows.join(sets.select("key", "n", "sig"), "key").repartition("node", "block").sortWithinPartitions("node", "block")
    return dealt.select("node", "block", "key", "n", "sig").mapInArrow(run, "grp binary, key binary").distinct()


def whole_texts(keys: DataFrame, sets: DataFrame, docs: DataFrame) -> DataFrame:
    """``(key, text)``: a text of each of the given sets."""
    wanted = sets.select("key", "at.*").join(keys.distinct(), "key")
    return docs.select(*whole_row(docs), F.col("text").cast("string").alias("text")).join(wanted, ["__did", "__row"]).select("key", "text").dropDuplicates(["key"])


def confirmed(groups: DataFrame, whole: DataFrame, size: int, percent: int) -> DataFrame:
    """Edges ``(a, b)`` between keys that connect what the links between full sets connect within each group."""
    def run(batches):
        hashes = WordHash()
        for held in _groups(batches, ["grp"]):
            full = [shingles(r["text"], size, hashes) for r in held]
            n = np.array(list(map(len, full)))

            def near(i, others):
                fits = 100 * np.minimum(n[i], n[others]) >= percent * np.maximum(n[i], n[others])
                for at in np.nonzero(fits)[0]:
                    both = len(np.intersect1d(full[i], full[others[at]], assume_unique=True))
                    fits[at] = 100 * both >= percent * (n[i] + n[others[at]] - both)
                return fits

            out = [(held[found[0]]["key"], held[i]["key"]) for found in linked(len(held), near) for i in found[1:]]
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([x[i] for x in out], pa.binary()) for i in (0, 1)], ["a", "b"])

    dealt = groups.join(whole, "key").repartition("grp").sortWithinPartitions("grp").select("grp", "key", F.col("text").cast("binary").alias("text"))
    return dealt.mapInArrow(run, "a binary, b binary").distinct()


def _blocks(dense: DataFrame, limit: int) -> DataFrame:
    """Dense nodes in blocks of half the limit; one set of the node is in all of them."""
    count = F.ceil(2 * F.col("size") / limit).cast("int")
    own = dense.select("node", F.pmod(F.xxhash64("key"), count).cast("int").alias("block"), "key")
    pivot = dense.groupBy("node").agg(F.min("key").alias("key"), F.max("size").alias("size")).select("node", F.explode(F.sequence(F.lit(0), count - 1)).alias("block"), "key")
    return own.unionByName(pivot).distinct()


def _strays(dense: DataFrame, roots: DataFrame, limit: int) -> DataFrame:
    """What lies outside the largest component of a dense node, in blocks, each with every block of the node.

    Nodes of several trees with the same largest component are taken together, as they hold much the same sets.
    """
    named = dense.join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    parts = named.groupBy("node", "root").agg(F.sum("w").alias("w"))
    main = parts.groupBy("node").agg(F.max_by("root", F.struct("w", "root")).alias("main"), (F.sum("w") - F.max("w")).alias("rest")).filter("rest > 0")
    rows = named.join(main.select("node", "main"), "node").select(F.xxhash64("main").alias("node"), "key", "w", (F.col("root") != F.col("main")).alias("stray")).distinct()
    sizes = rows.groupBy("node").agg(F.sum("w").alias("size"), F.sum(F.when(F.col("stray"), F.col("w"))).alias("rest"))
    blocks, others = F.ceil(2 * F.col("size") / limit).cast("int"), F.ceil(2 * F.col("rest") / limit).cast("int")
    rows = rows.join(sizes.select("node", blocks.alias("blocks"), others.alias("others")), "node")
    own, other = F.pmod(F.xxhash64("key"), F.col("blocks")).cast("int"), F.pmod(F.xxhash64("key", F.lit(1)), F.col("others")).cast("int")
    members = rows.select("node", "key", "blocks", own.alias("b"), F.explode(F.sequence(F.lit(0), F.col("others") - 1)).alias("o"))
    strays = rows.filter("stray").select("node", "key", "blocks", other.alias("o"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("b"))
    return members.unionByName(strays).select("node", (F.col("o") * F.col("blocks") + F.col("b")).alias("block"), "key").distinct()


def near_duplicates(docs: DataFrame, size: int = 3, percent: int = 85, recall: float = 0.9999, limit: int = LIMIT) -> DataFrame:
    """``(__did, __row, doc_id, n_shingles, component_id)`` per row of ``docs`` (columns ``doc_id``, ``text``).

    A document's set are its distinct shingles of ``size`` words (lower-cased in A-Z, between ASCII white space); fewer
    words are one shingle. Two documents are linked if 100 times their common shingles are at least ``percent`` times
    all of both, which is checked on the full sets. ``component_id`` is the smallest doc_id that can be reached over
    links, the row's own included.

    Equal sets are taken once. ``percent`` must be 85 or more, the similarity that ``ALIKE`` is set for. A linked pair
    of just ``percent`` is found with the chance ``recall``, a closer one with a higher; links within dense nodes are
    all found. Documents without words have no shingles and are linked with nothing. Repeated rows share a group. A null
    doc_id keeps its row and is a component_id only if its whole group has none. Malformed UTF-8 is compared as bytes.
    Other columns only help to tell rows apart; an empty table gives no rows.
    """
    assert percent >= 85, "fewer common tokens would have to be enough"
    prints = table(described(docs, size), "prints")
    sets = prints.filter("n > 0").groupBy("key").agg(F.min(F.struct("__did", "__row")).alias("at"), F.any_value("n").alias("n"), F.any_value("sig").alias("sig"))
    sets = table(sets.withColumn("w", F.expr(f"greatest(1, n div {HEAVY})")), "sets")

    small, dense = tree_nodes(sets, trees_for(percent / 100, recall), limit)
    rows = small[0].withColumn("block", F.lit(0))
    for s in small[1:]:
        rows = rows.unionByName(s.withColumn("block", F.lit(0)))
    packed = None
    for d in dense:
        packed = d if packed is None else packed.unionByName(d)
    if packed is not None:
        packed = table(packed, "dense")
        rows = rows.unionByName(_blocks(packed, limit))
    groups = table(probable(rows, sets, percent), "groups")
    keys = groups.select("key") if packed is None else groups.select("key").union(packed.select("key"))
    whole = whole_texts(keys, sets, docs)
    whole = whole if packed is None else table(whole, "texts")
    edges = table(confirmed(groups, whole, size, percent), "links")
    roots = components(edges).select(F.col("node").alias("key"), "root")
    if packed is not None:
        rest = _strays(packed, roots, limit)
        groups = table(probable(rest, sets, percent), "groups")
        more = confirmed(groups, whole, size, percent)
        named = more.join(roots.withColumnRenamed("key", "a").withColumnRenamed("root", "ra"), "a", "left").join(roots.withColumnRenamed("key", "b").withColumnRenamed("root", "rb"), "b", "left")
        fresh = table(named.select(F.coalesce("ra", "a").alias("a"), F.coalesce("rb", "b").alias("b")).filter("a <> b"), "links")
        if fresh.take(1):
            roots = components(edges.union(fresh)).select(F.col("node").alias("key"), "root")

    firsts = prints.filter("n > 0").groupBy("key").agg(F.min("doc_id").alias("first")).join(roots, "key", "left").withColumn("root", F.coalesce("root", "key"))
    ids = firsts.join(firsts.groupBy("root").agg(F.min("first").alias("component_id")), "root").select("key", "component_id")
    named = prints.drop("sig").join(ids, "key", "left")
    own = F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc_id"))
    return named.select("__did", "__row", "doc_id", F.col("n").alias("n_shingles"), own.alias("component_id"))
