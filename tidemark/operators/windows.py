"""Ordered windows that stay spread out when one key holds most of the rows.

A plain window puts a whole key into one task. ``split_window`` first counts the rows per key. Ordinary keys
take the plain window. Keys above ``HOT_ROWS`` are cut into buckets along their order (hours of a timestamp, days
of a date), the buckets are summarised by an ordinary partial aggregation, and every bucket gets what came before
it as one extra "carry" row. The window then runs per (key, bucket) and gives the same values as the plain one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.numeric import _c
from ..session import written

FIRST_ROW = Window.unboundedPreceding
CURRENT_ROW = Window.currentRow

# Rows of one key that a single task may sort. Keys above it are split; there can be at most
# (rows of the table / HOT_ROWS) of them, which bounds the broadcast list of hot keys: half a million keys for 10^12
# rows. Left to the planner, the join would shuffle the whole table before the list's size is known.
HOT_ROWS = 2_000_000


def _cols(names) -> list[str]:
    return [names] if isinstance(names, str) else list(names)


def hot_keys(df: DataFrame, keys: list[str], hot_rows: int | None = None) -> DataFrame:
    """Keys with more than ``hot_rows`` rows, as ``__k_<key>`` columns: a partial count of the key columns."""
    counts = df.groupBy(*keys).agg(F.count("*").alias("__n")).filter(F.col("__n") > (hot_rows or HOT_ROWS))
    return counts.select(*[F.col(k).alias(f"__k_{k}") for k in keys], F.lit(True).alias("__hot"))


def _with_hot(df: DataFrame, hot: DataFrame, keys: list[str], how: str) -> DataFrame:
    same = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys]
    return df.join(F.broadcast(hot), same, how).drop(*[f"__k_{k}" for k in keys])


def split_window(df: DataFrame, keys, order, bucket: Column | None, outputs: dict[str, tuple[str, str | Column | None]]) -> DataFrame:
    """Add window columns over ``keys`` in ascending ``order``.

    ``outputs`` maps a name to ``(kind, column)``: ``sum`` (running sum over rows), ``peer_sum`` (running sum,
    rows equal in order included), ``lag``, ``lead`` (neighbour row), ``last`` (latest non-null so far, the
    row itself included), ``rank``, ``dense_rank``, ``row_number`` (no column). ``bucket`` must be a function
    of the leading order column that rises with it and may be fine-grained, as it only serves hot keys; ``None``
    runs a plain window, for keys known to be small. Without keys the whole table is one group: with a bucket it
    is always cut, without one it is cut into ranges of its order (``range_parts``). Rows without an order value
    come first; a bucket of NULL holds them.
    """
    keys, order = _cols(keys), _cols(order)
    if not keys and bucket is None:
        return split_window(range_parts(df, order), keys, order, F.col("__part"), outputs).drop("__part")
    ins = {name: f"__in{i}" for i, name in enumerate(outputs)}
    counters = ("rank", "dense_rank", "row_number")
    base = df.withColumns({ins[n]: F.lit(0).cast("bigint") if kind in counters else _c(c) for n, (kind, c) in outputs.items()})

    if bucket is None:
        by, sort, rows = keys, order, base
    else:
        if keys:
            hot = hot_keys(df, keys)
            cut = _with_hot(base, hot, keys, "inner").withColumn("__bucket", bucket).drop("__hot")
            base = _with_hot(base, hot, keys, "left").withColumn("__bucket", F.when(F.col("__hot"), bucket)).drop("__hot")
        else:
            base = cut = base.withColumn("__bucket", bucket)
        carry = _carry_rows(cut, keys, order, outputs, ins)
        rows = base.withColumn("__edge", F.lit(0)).unionByName(carry, allowMissingColumns=True)
        by, sort = [*keys, "__bucket"], ["__edge", *order]

    ordered = Window.partitionBy(*by).orderBy(*sort)
    so_far = ordered.rowsBetween(FIRST_ROW, CURRENT_ROW)
    peers = ordered.rangeBetween(FIRST_ROW, CURRENT_ROW)
    made = {}
    for name, (kind, _) in outputs.items():
        c = F.col(ins[name])
        made[name] = {
            "sum": lambda: F.sum(c).over(so_far),
            "peer_sum": lambda: F.sum(c).over(peers),
            "lag": lambda: F.lag(c).over(ordered),
            "lead": lambda: F.lead(c).over(ordered),
            "last": lambda: F.last(c, ignorenulls=True).over(so_far),
            "rank": lambda: F.rank().over(ordered) + F.first(c).over(so_far),
            "dense_rank": lambda: F.dense_rank().over(ordered) + F.first(c).over(so_far),
            "row_number": lambda: F.row_number().over(ordered) + F.first(c).over(so_far),
        }[kind]()
    out = rows.withColumns(made)
    if bucket is not None:
        out = out.filter(F.col("__edge") == 0)
    return out.drop("__edge", "__bucket", *ins.values())


def _carry_rows(cut: DataFrame, keys, order, outputs, ins) -> DataFrame:
    """One row before each later bucket and, where a lead is asked for, one after it, with the carried values.

    A carry row is itself one row of its window, so numbering starts one lower.
    """
    place = F.struct(*order)  # never NULL itself, so rows without an order value count as well
    across = Window.partitionBy(*keys).orderBy("__bucket")
    before = across.rowsBetween(FIRST_ROW, -1)
    summary, carried, after = {}, {}, {}
    for name, (kind, _) in outputs.items():
        n, c = ins[name], F.col(ins[name])
        if kind in ("sum", "peer_sum"):
            summary[n], carried[n] = F.sum(c), F.sum(c).over(before)
        elif kind == "lag":
            summary[n], carried[n] = F.max_by(c, place), F.lag(c).over(across)
        elif kind == "last":
            summary[n], carried[n] = F.max_by(c, F.when(c.isNotNull(), place)), F.last(c, ignorenulls=True).over(before)
        elif kind == "lead":
            summary[n], after[n] = F.min_by(c, place), F.lead(c).over(across)
        else:
            summary[n] = F.count_distinct(place) if kind == "dense_rank" else F.count(F.lit(1))
            carried[n] = F.sum(c).over(before) - 1
    buckets = cut.groupBy(*keys, "__bucket").agg(*[c.alias(n) for n, c in summary.items()])
    numbered = buckets.withColumns({**carried, **after, "__first": F.row_number().over(across) == 1})
    edges = F.array(*[F.lit(e) for e, cols in ((-1, carried), (1, after)) if cols])
    rows = numbered.withColumn("__edge", F.explode(edges)).filter("NOT (__first AND __edge = -1)").drop("__first")
    return rows.withColumns(
        {n: F.when(F.col("__edge") == (-1 if n in carried else 1), F.col(n)) for n in summary}
    )


def range_parts(df: DataFrame, order: list[str | Column]) -> DataFrame:
    """Add ``__part``: the rank of the row's range, of as many even ranges of ``order`` as there are shuffle partitions.

    The ranges are drawn by Spark's own range partitioning and written down, so every use of the frame sees the
    same ones. Rows that tie in all of ``order`` share a range; give a tie-breaker where ties may be many.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    return written(df.repartitionByRange(parts, *order).withColumn("__part", F.spark_partition_id()), "ranges")


def running_sum(df: DataFrame, keys, order, cols: dict[str, str | Column], frame: str = "rows", bucket: Column | None = None) -> DataFrame:
    """Running sums ``new name -> column``; ``frame='range'`` counts rows of equal order together."""
    kind = {"rows": "sum", "range": "peer_sum"}[frame]
    return split_window(df, keys, order, bucket, {n: (kind, c) for n, c in cols.items()})


def period_deltas(df: DataFrame, keys, order, cols: list[str], bucket: Column | None = None) -> DataFrame:
    """Previous value, delta and relative delta per column; a missing or zero base counts as 1."""
    out = split_window(df, keys, order, bucket, {f"{c}_prev": ("lag", c) for c in cols})
    deltas = {}
    for c in cols:
        prev = F.col(f"{c}_prev")
        base = F.when(prev.isNull() | (prev == 0), F.lit(1)).otherwise(prev)
        deltas[f"{c}_delta"] = F.col(c) - prev
        deltas[f"{c}_delta_pct"] = (F.col(c) - prev).cast("double") / base.cast("double")
    return out.withColumns(deltas)


def validity_ranges(df: DataFrame, keys, start: str, order=None, end: str = "valid_to", default_end: Column | None = None,
                    bucket: Column | None = None) -> DataFrame:
    """Start of the next row of the key as the end of this one; ``default_end`` closes the last row."""
    out = split_window(df, keys, order or [start], bucket, {end: ("lead", start)})
    return out if default_end is None else out.withColumn(end, F.coalesce(end, default_end))


def trailing(df: DataFrame, keys, order, n: int, outputs: dict[str, tuple[str, str]], bucket: Column | None = None) -> DataFrame:
    """Aggregates over the n rows before the current one: ``new name -> (sum|avg|stddev|count|max|min, column)``.

    Without ``bucket`` a plain window, for series of one row per period, whose keys are short. With it (a rising
    function of the leading order column, as for ``split_window``) a hot key is cut into stretches of its row numbers,
    and the last n rows of each stretch also go to the next one (a halo), so every window is complete within its task.
    ``order`` should be total; rows without an order value come first. An ungrouped table is always cut.
    """
    keys, order = _cols(keys), _cols(order)
    agg = {"sum": F.sum, "avg": F.avg, "stddev": F.stddev_samp, "count": F.count, "max": F.max, "min": F.min}

    def over(rows: DataFrame, by: list[str], sort: list[str]) -> DataFrame:
        w = Window.partitionBy(*by).orderBy(*sort).rowsBetween(-n, -1)
        return rows.withColumns({name: agg[fn](c).over(w) for name, (fn, c) in outputs.items()})

    if bucket is None:
        return over(df, keys, order)
    hot = hot_keys(df, keys) if keys else None
    rows = _with_hot(df, hot, keys, "inner").drop("__hot") if keys else df
    numbered = split_window(rows, keys, order, bucket, {"__at": ("row_number", None)})
    size = max(n, HOT_ROWS)  # a halo never reaches beyond the next stretch
    own, place = F.floor((F.col("__at") - 1) / size), (F.col("__at") - 1) % size
    stretches = F.when(place >= size - n, F.array(own, own + 1)).otherwise(F.array(own))
    spread = numbered.withColumns({"__own": own, "__stretch": stretches}).withColumn("__stretch", F.explode("__stretch"))
    cut = over(spread, [*keys, "__stretch"], ["__at"]).filter("__stretch = __own").drop("__stretch", "__own", "__at")
    if not keys:
        return cut
    cold = _with_hot(df, hot, keys, "left").filter("__hot IS NULL").drop("__hot")
    return over(cold, keys, order).unionByName(cut)


def partition_agg(df: DataFrame, keys, aggs: dict[str, Column]) -> DataFrame:
    """Partition aggregates as attributes, as one partial aggregation joined back on the key.

    A window would move every row of a key into one task; the join lets adaptive execution split hot keys.
    """
    keys = _cols(keys)
    totals = df.groupBy(*keys).agg(*[c.alias(n) for n, c in aggs.items()])
    renamed = totals.select(*[F.col(k).alias(f"__k_{k}") for k in keys], *aggs)
    cond = [F.col(k).eqNullSafe(F.col(f"__k_{k}")) for k in keys]
    return df.join(renamed, cond, "left").drop(*[f"__k_{k}" for k in keys])


def keep_group_max(df: DataFrame, keys, ts: str) -> DataFrame:
    """Rows that carry the latest ``ts`` of their key, ties kept."""
    return partition_agg(df, keys, {"__max": F.max(ts)}).filter(F.col(ts) == F.col("__max")).drop("__max")


def deduplicate(df: DataFrame, partition_by, order_by: list[Column]) -> DataFrame:
    """One row per key, the first in ``order_by`` (give a total order). Every map task forwards one row per key."""
    w = Window.partitionBy(*_cols(partition_by)).orderBy(*order_by)
    return df.withColumn("__rn", F.row_number().over(w)).filter(F.col("__rn") == 1).drop("__rn")


def latest_per_key(df: DataFrame, keys, ts: list[str] | str) -> DataFrame:
    """Newest row per key by the given columns; an aggregation, so nothing is sorted."""
    keys, ts = _cols(keys), _cols(ts)
    rest = [c for c in df.columns if c not in keys]
    best = df.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(*ts)).alias("__r"))
    return best.select(*keys, "__r.*").select(*df.columns)


def top_n(df: DataFrame, keys, order: list[Column], n: int, rank: str = "rank") -> DataFrame:
    """First n rows per key, numbered; map tasks forward at most n rows per key."""
    w = Window.partitionBy(*_cols(keys)).orderBy(*order)
    return df.withColumn(rank, F.row_number().over(w)).filter(F.col(rank) <= n)


def rank_in_group(df: DataFrame, keys, order, name: str = "rank", bucket: Column | None = None) -> DataFrame:
    """RANK by ascending order."""
    return split_window(df, keys, order, bucket, {name: ("rank", None)})


def dense_rank_in_group(df: DataFrame, keys, order, name: str = "dense_rank", bucket: Column | None = None) -> DataFrame:
    """DENSE_RANK by ascending order."""
    return split_window(df, keys, order, bucket, {name: ("dense_rank", None)})


def global_rank(df: DataFrame, score: str, tie: str, name: str = "ranking") -> DataFrame:
    """ROW_NUMBER over the whole table, highest score first, without a one-task sort.

    The table is cut into ranges of (score, tie); each range is numbered on its own, shifted by the rows above it.
    A score that many rows share is cut by the tie-breaker.
    """
    flipped = df.withColumn("__neg", -F.col(score).cast("double"))
    return split_window(flipped, [], ["__neg", tie], None, {name: ("row_number", None)}).drop("__neg")


def row_index(df: DataFrame, name: str = "row_index") -> DataFrame:
    """A unique id per row (identity only, not consecutive)."""
    return df.withColumn(name, F.monotonically_increasing_id())


def attempt_counters(df: DataFrame, keys, ts: str, success: Column, bucket: Column | None = None) -> DataFrame:
    """Attempt number (distinct times so far) and number of successes so far, per key."""
    return split_window(df, keys, [ts], bucket, {"attempt": ("dense_rank", None), "wins": ("peer_sum", F.when(success, 1).otherwise(0))})


def cumulative_until(df: DataFrame, keys, order, stop: Column, measures: dict[str, str | Column], bucket: Column | None = None) -> DataFrame:
    """Per key: running sums of the measures at the first row where ``stop`` holds (keys without one drop out).

    Replaces the self join of every row with all rows before it.
    """
    keys, order = _cols(keys), _cols(order)
    out = running_sum(df.withColumn("__stop", stop), keys, order, measures, bucket=bucket).filter("__stop")
    return out.groupBy(*keys).agg(
        F.min_by(F.struct(*order, *measures), F.struct(*order)).alias("__r")
    ).select(*keys, "__r.*")
