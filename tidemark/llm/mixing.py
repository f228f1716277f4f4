"""Mixing sources to target weights by weighted fair queueing. DataFrame and SQL functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .numbering import ordered, place, running
from .shared import WORD, attach, table, whole_row

WEIGHTS = (5, 2, 1)  # repeated over the sources in code point order, null last
SHARE = 1.5  # of all words, taken in total
EPOCHS = 2  # times a document may be taken


def targets(queue: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """``(source, source_size, weight, target)``, one row per source.

    The total is ``share`` of all words, dealt out by weight; a target stops at ``epochs`` times its source's size
    and the excess goes to the others by weight until none is above. That is one water level: sources in the order
    of their limit per weight, each full as long as the level of the rest reaches its limit. Sources without a word
    have target 0. Sources are numbered and summed by ranges of their order, so they may be as many as the rows.
    """
    sizes = queue.groupBy("source").agg(F.sum("size").alias("source_size"))
    last = F.col("source").asc_nulls_last()
    given = F.array(*[F.lit(float(w)) for w in weights])
    s = ordered(sizes, [last], {"no": F.lit(1)})
    s = s.withColumn("weight", F.get(given, (F.col("no") % len(weights)).cast("int"))).withColumn("most", F.col("source_size") * float(epochs))
    s = s.withColumn("limit", F.col("most") / F.col("weight"))
    s = table(ordered(s, [F.col("limit").asc(), last], {"filled": F.col("most"), "filled_weight": F.col("weight")}), "filling")
    whole = s.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    s = s.withColumn("level", (F.lit(float(whole["size"] or 0) * share) - F.col("filled")) / (F.lit(whole["weight"] or 0.0) - F.col("filled_weight")))
    s = s.withColumn("full", F.col("most") <= F.col("level") * F.col("weight"))
    level = F.lit(s.agg(F.max(F.when(~F.col("full"), F.col("level"))).alias("level")).first()["level"])  # falls from the first source that is not full
    return s.select("source", "source_size", "weight", F.when(F.col("full"), F.col("most")).otherwise(level.cast("double") * F.col("weight")).alias("target"))


def mix(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS, seed: int = 5) -> DataFrame:
    """One row per row of ``docs``: ``__did, __row, doc_id, source, size, source_size, target, times, taken``.

    Every source is a queue: its documents in the order of a hash (the shuffle), and once more for each further
    epoch. A document's virtual finish time is the source's words up to and with it, divided by the source's target.
    All queued documents are put in the order of their finish times and taken while the total stays within the
    budget, so at any time each source has come equally far on the way to its target. The global order is cut into
    ranges of finish time; only their sums, and the rows of the one range where the budget ends, are looked at to
    find the last document taken. Whole documents are taken, so a source misses its target by less than one document.

    Null text or one without words has size 0 and is never taken. A null source is a source. Repeated rows are
    queued one by one; ties stand in the order of source, hash and id, and rows that tie in all of it are equal.
    An empty table gives no rows. Reruns agree.
    """
    size = F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("bigint")
    key = docs.select(*whole_row(docs), F.col("doc_id").cast("bigint").alias("doc_id"), F.col("source").cast("string").alias("source"), size.alias("size"))
    queue = table(key.withColumn("at", place("__did", "__row", seed=seed)), "queue")
    goal = table(targets(queue, weights, share, epochs), "targets")
    ahead = running(queue, "source", "at", ["__did", "__row"], {"ahead": F.col("size")})
    to = goal.withColumnRenamed("source", "__source")
    lined = ahead.join(to, F.col("source").eqNullSafe(F.col("__source"))).drop("__source")
    lined = table(lined.withColumn("end", F.col("ahead") + F.col("size")), "lined")

    sums = lined.agg(F.count("*").alias("n")).first()
    budget = goal.agg(F.sum("target").alias("t")).first()["t"] or 0.0
    cells = int(sums["n"] * epochs / 10_000) + 1
    finish = lambda e: (F.col("end") + F.col("source_size") * e) / F.col("target")
    rounds = F.explode(F.array(*[F.struct(finish(e).alias("finish"), F.lit(e).alias("epoch")) for e in range(epochs)]))
    instances = lined.filter("size > 0 AND target > 0").select("*", rounds.alias("i")).select("*", "i.*")
    instances = instances.withColumn("cell", F.least(F.floor(F.col("finish") * cells), F.lit(2 * cells)))
    upto = Window.orderBy("cell").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = instances.groupBy("cell").agg(F.sum("size").alias("words")).withColumn("upto", F.sum("words").over(upto))
    over = ranges.filter(F.col("upto") > budget).orderBy("cell").first()
    if over is None:  # the budget holds everything
        times = F.when(F.col("size") > 0, F.lit(epochs)).otherwise(F.lit(0))
    else:
        order = ["finish", "source_at", "at", "__did", "__row", "epoch"]
        edge = instances.filter(F.col("cell") == over["cell"]).withColumn("source_at", F.coalesce("source", F.lit("\U0010ffff" * 4)))
        run = Window.orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
        first_out = edge.withColumn("upto", F.sum("size").over(run) + F.lit(over["upto"] - over["words"])).filter(F.col("upto") > budget).orderBy(*order).first()
        stop = F.struct(*[F.lit(first_out[c]).alias(c) for c in order])

        def before(e: int) -> Column:
            me = F.struct(finish(e).alias("finish"), F.coalesce("source", F.lit("\U0010ffff" * 4)).alias("source_at"), "at", "__did", "__row", F.lit(e).alias("epoch"))
            return F.when((F.col("size") > 0) & (F.col("target") > 0) & (me < stop), F.lit(1)).otherwise(F.lit(0))

        times = before(0)
        for e in range(1, epochs):
            times = times + before(e)
    out = lined.withColumn("times", times).withColumn("taken", F.col("size") * F.col("times"))
    return out.select("__did", "__row", "doc_id", "source", "size", "source_size", "target", "times", "taken")


def mixed(docs: DataFrame, weights: tuple[float, ...] = WEIGHTS, share: float = SHARE, epochs: int = EPOCHS) -> DataFrame:
    """The documents as often as the mix takes them, with the columns of ``docs``."""
    taken = mix(docs, weights, share, epochs).filter("times > 0").select("__did", "__row", F.explode(F.sequence(F.lit(1), F.col("times"))).alias("__copy"))
    return attach(docs, taken).select(*docs.columns)
