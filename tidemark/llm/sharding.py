"""Shards of near-equal bytes from a k-d tree over metadata. DataFrame and SQL functions only."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .numbering import ordered, place, running
from .shared import attach, table, whole_row

SHARDS = 40
DIMS = ("source", "lang", "n_chars")
WHOLE = 0.02  # share of a shard's bytes up to which a group of equal texts stays together
EXACT = 0.001  # share of a shard's bytes within which a median is found
CELLS = 2**16  # cells of one look at a split, per box
NUMBERS = ("tinyint", "smallint", "int", "bigint", "float", "double", "decimal")


@dataclass
class Box:
    """A box of the tree: its leaves and, once split, the dimension, the last key of the left child and the children."""

    leaves: int
    first: int
    dim: int | None = None
    cut: int | None = None
    left: Box | None = None
    right: Box | None = None

    def unsplit(self) -> list[Box]:
        if self.dim is None:
            return [self] if self.leaves > 1 else []
        return self.left.unsplit() + self.right.unsplit()

    def column(self) -> Column:
        """The first leaf of the box that a point lies in."""
        if self.dim is None:
            return F.lit(self.first)
        return F.when(F.col(f"key{self.dim}") <= self.cut, self.left.column()).otherwise(self.right.column())


def _with_dimension(docs: DataFrame, name: str, out: str) -> DataFrame:
    """Add ``out``, a metadata column as a number below 2^30: numbers by their logarithm, other values by their rank.

    Null, NaN, negative numbers and a missing column are 0.
    """
    kind = dict(docs.dtypes).get(name)
    if kind is None:
        return docs.withColumn(out, F.lit(0).cast("bigint"))
    if kind.split("(")[0] in NUMBERS:
        x = F.greatest(F.nanvl(F.coalesce(F.col(name).cast("double"), F.lit(0.0)), F.lit(0.0)), F.lit(0.0))
        return docs.withColumn(out, F.least(F.floor(F.log1p(x) * 2**20), F.lit(2**30 - 1)).cast("bigint"))
    value = F.col(name).cast("string")
    values = docs.select(value.alias("__v")).distinct().filter("__v IS NOT NULL")
    ranks = ordered(values, [F.col("__v").asc()], {out: F.lit(1).cast("bigint")}).withColumn(out, F.col(out) + 1)
    joined = docs.join(ranks, value == F.col("__v"), "left").drop("__v")
    return joined.withColumn(out, F.coalesce(out, F.lit(0)))


def _spans(dims: int) -> list[Column]:
    return [F.struct(F.min(f"key{d}").alias("lo"), F.max(f"key{d}").alias("hi")).alias(f"d{d}") for d in range(dims)]


def _split(points: DataFrame, root: Box, extent: list[int], exact: float) -> None:
    """Split every box that has leaves left at its weighted median along its widest dimension.

    All medians are searched at once: one partial aggregation counts the weight per box and cell of its key range,
    a window over those cells finds where each median lies, and the next look divides that cell, until it weighs at
    most ``exact`` or holds a single key. The driver gets one row per box.
    """
    at = points.withColumn("box", root.column())
    dims = len(extent)
    spans = _spans(dims)
    seen = {r["box"]: r for r in at.groupBy("box").agg(F.sum("weight").alias("weight"), *spans).collect()}
    search: dict[int, tuple[Box, int, int, float]] = {}
    for b in root.unsplit():
        b.dim, b.cut, half = 0, 2**62, b.leaves // 2
        if (r := seen.get(b.first)) is not None:
            b.dim = max(range(dims), key=lambda d: (r[f"d{d}"]["hi"] - r[f"d{d}"]["lo"]) / extent[d])
            search[b.first] = (b, r[f"d{b.dim}"]["lo"], r[f"d{b.dim}"]["hi"] + 1, r["weight"] * half / b.leaves)
        b.left, b.right = Box(half, b.first), Box(b.leaves - half, b.first + half)
    while search:
        per_box = lambda pick: F.get(F.array(*[F.lit(pick(*search[i])) if i in search else F.lit(None) for i in range(root.leaves)]), F.col("box"))
        looked = at.withColumns({
            "k": F.get(F.array(*[F.col(f"key{d}") for d in range(dims)]), per_box(lambda b, lo, hi, goal: b.dim)),
            "lo": per_box(lambda b, lo, hi, goal: lo).cast("bigint"),
            "hi": per_box(lambda b, lo, hi, goal: hi).cast("bigint"),
            "step": per_box(lambda b, lo, hi, goal: -(-(hi - lo) // CELLS)).cast("bigint"),
            "goal": per_box(lambda b, lo, hi, goal: float(goal)),
        }).filter("k >= lo AND k < hi")
        cells = looked.groupBy("box", F.expr("(k - lo) div step").alias("cell")).agg(F.sum("weight").alias("w"), F.first("goal").alias("goal"))
        upto = Window.partitionBy("box").orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
        crossed = cells.withColumn("upto", F.sum("w").over(upto)).filter("upto >= goal").groupBy("box").agg(F.min(F.struct("cell", "w", "upto")).alias("c"))
        for r in crossed.collect():
            (b, lo, hi, goal), c = search.pop(r["box"]), r["c"]
            step = -(-(hi - lo) // CELLS)
            start, before = lo + c["cell"] * step, c["upto"] - c["w"]
            if step > 1 and c["w"] > exact:
                search[b.first] = (b, start, min(hi, start + step), goal - before)
            else:  # the last cell goes to the side where the error is smaller
                b.cut = start - 1 if goal - before < c["upto"] - goal else start + step - 1


def kd_shards(docs: DataFrame, shards: int = SHARDS, dims: tuple[str, ...] = DIMS) -> DataFrame:
    """``(__did, __row, doc_id, size, text_crc32, shard, slot)`` per row of ``docs``: ``shards`` shards of near-equal bytes.

    A document's size is the UTF-8 length of its text (null: none) plus 16. The box of all documents is split at the
    weighted median along its widest metadata dimension (extent relative to that of the table), in proportion to the
    leaves on either side, until every box is one shard. Points of the tree are groups of equal texts with the least
    metadata of the group, so copies share a shard; a group above ``WHOLE`` of a shard's bytes is cut into pieces by a
    hash of the document, each a point of its own. ``slot`` numbers the rows of a shard from 0 without gaps, in hash
    order; a shard is numbered in cells, so no task holds a whole one. Repeated rows are separate rows; ties in the
    metadata are ordered by text hash; an empty table gives no rows, and fewer points than shards leave shards empty.
    """
    size = F.coalesce(F.octet_length(F.col("text").cast("string")), F.lit(0)).cast("bigint") + 16
    rows = docs.select(*whole_row(docs), "doc_id", F.xxhash64("text").alias("th"), size.alias("size"),
                       F.crc32(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")).alias("text_crc32"), *[d for d in dims if d in docs.columns])
    rows = rows.withColumnsRenamed({d: f"__{d}" for d in dims})
    for i, d in enumerate(dims):
        rows = _with_dimension(rows, f"__{d}", f"dim{i}")
    rows = table(rows.drop(*[f"__{d}" for d in dims]), "shard-rows")
    total = rows.agg(F.sum("size").alias("s")).first()["s"] or 0
    least = [F.min(f"dim{i}").alias(f"dim{i}") for i in range(len(dims))]
    # Written, so that the join has a plain shuffle on either side, of which adaptive execution can split a large group.
    groups = table(rows.groupBy("th").agg(F.sum("size").alias("bytes"), *least), "shard-groups")
    keyed = rows.drop(*[f"dim{i}" for i in range(len(dims))]).join(groups, "th")
    pieces = F.ceil(F.col("bytes") / max(1.0, WHOLE * total / shards))
    keyed = keyed.withColumn("piece", F.pmod(F.xxhash64("__did", "__row"), pieces))
    tie = F.shiftright(F.col("th"), 44).bitwiseAND(2**20 - 1) * 2**12 + F.pmod("piece", F.lit(2**12))
    keyed = table(keyed.withColumns({f"key{i}": F.col(f"dim{i}") * 2**32 + tie for i in range(len(dims))}), "shard-keys")
    keys = [f"key{i}" for i in range(len(dims))]
    points = table(keyed.groupBy(*keys).agg(F.sum("size").cast("double").alias("weight")), "shard-points")
    whole = points.agg(*_spans(len(dims))).first()
    extent = [max(1, (whole[f"d{i}"]["hi"] or 0) - (whole[f"d{i}"]["lo"] or 0)) for i in range(len(dims))]
    root = Box(shards, 0)
    while root.unsplit():
        _split(points, root, extent, EXACT * total / shards)
    placed = keyed.withColumns({"shard": root.column().cast("int"), "at": place("__did", "__row")})
    return running(placed.select("__did", "__row", "doc_id", "size", "text_crc32", "shard", "at"), "shard", "at", ["__did", "__row"], {"slot": F.lit(1).cast("bigint")}).drop("at")


def sharded(docs: DataFrame, shards: int = SHARDS, dims: tuple[str, ...] = DIMS) -> DataFrame:
    """The documents with two more columns, ``shard`` and ``slot`` (older columns of these names give way)."""
    placed = kd_shards(docs, shards, dims).select("__did", "__row", "shard", "slot")
    older = {c: f"__{c}" for c in ("shard", "slot") if c in docs.columns}
    return attach(docs, placed.withColumnsRenamed({"shard": "__new_shard", "slot": "__new_slot"})).drop(*older).withColumnsRenamed({"__new_shard": "shard", "__new_slot": "slot"})
