"""Runs, attempts, inventories and item catalogs."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_timestamp
from ..functions.text import strip_suffix
from .windows import attempt_counters, cumulative_until, deduplicate, partition_agg, split_window


def pair_events(events: DataFrame, keys: list[str], kind: str, order: list[str], specs: dict[str, dict[str, str]],
                end_kinds: list[str], status: str = "status", undetected: str = "UNDETECTED") -> DataFrame:
    """Start, continuation and end events of one run as one row.

    ``specs`` maps an event kind to ``output column -> source column``; a column fed by several kinds takes the
    first filled one in the order listed. One pass of conditional aggregation replaces a join per event kind. A
    run without any end event gets the undetected status.
    """
    place = F.struct(*order)
    fed: dict[str, list[Column]] = {}
    for k, fields in specs.items():
        for name, source in fields.items():
            value = F.min_by(F.col(source), F.when((F.col(kind) == k) & F.col(source).isNotNull(), place))
            fed.setdefault(name, []).append(value)
    ended = F.max(F.when(F.col(kind).isin(*end_kinds), 1).otherwise(0)).alias("__ended")
    begun = F.max(F.when(F.col(kind) == next(iter(specs)), 1).otherwise(0)).alias("__begun")
    out = events.filter(F.col(kind).isin(*specs)).groupBy(*keys).agg(ended, begun, *[F.coalesce(*v).alias(n) for n, v in fed.items()])
    final = F.when(F.col("__ended") == 0, undetected).otherwise(F.col(status)) if status in fed else F.when(F.col("__ended") == 0, undetected)
    return out.filter("__begun = 1").withColumn(status, final).drop("__ended", "__begun")


def attempts_to_win(df: DataFrame, keys: list[str], ts: str, tie: str, success: Column, measure: str | Column, day0: DataFrame, day0_col: str,
                    bucket: Column | None = None) -> DataFrame:
    """Every key ever tried, with attempts, total measure and days until its first success (empty without one)."""
    amount = F.col(measure) if isinstance(measure, str) else measure
    rows = df.select(*keys, ts, tie, success.alias("__win"), amount.alias("__m")).distinct()
    won = cumulative_until(rows, keys, [ts, tie], F.col("__win"), {"attempts_to_win": F.lit(1), "total_to_win": F.col("__m")}, bucket)
    tried = rows.select(*keys).distinct()
    out = tried.join(won.withColumnRenamed(ts, "__won"), keys, "left").join(day0, keys[0], "left")
    return out.withColumn("days_to_win", F.datediff("__won", day0_col).cast("bigint")).drop("__won", tie, day0_col)


def progress_mart(facts: DataFrame, user: str, item: str, ts: str, tie: str, success: Column, cumulative: str, run: list[str],
                  bucket: Column | None = None) -> DataFrame:
    """Deduplicated facts with attempt and win counters and the increment of a cumulative measure within its run."""
    once = deduplicate(facts, [user, item, ts, tie], [F.asc(cumulative)])
    out = attempt_counters(once, [user, item], ts, success, bucket)
    out = split_window(out, run, [ts, tie], bucket, {"__before": ("lag", cumulative)})
    return out.withColumn(f"{cumulative}_increment", F.coalesce(F.col(cumulative) - F.col("__before"), F.col(cumulative))).drop("__before")


def conform(events: DataFrame, kind: str, keep: list[str], specs: dict[str, dict[str, Column]], types: dict[str, str]) -> DataFrame:
    """Several event kinds in one wide schema: ``kind -> output column -> expression``, NULL where not given."""
    cols = []
    for name, dtype in types.items():
        expr = F
        for k, fields in specs.items():
            if name in fields:
                expr = expr.when(F.col(kind) == k, fields[name].cast(dtype))
        cols.append((F.lit(None).cast(dtype) if expr is F else expr).alias(name))
    return events.filter(F.col(kind).isin(*specs)).select(*keep, kind, *cols)


def current_balance(updates: DataFrame, keys: list[str], ts: str, max_cols: list[str]) -> DataFrame:
    """Last balance row per key; values that tie at the last time are reduced by their maximum."""
    best = [F.max_by(F.col(c), F.struct(F.col(ts), F.col(c))).alias(c) for c in max_cols]
    return updates.groupBy(*keys).agg(F.max(ts).alias(ts), *best)


def balance_updates_of_day(updates: DataFrame, keys: list[str], ts: str, max_cols: list[str], day: Column) -> DataFrame:
    """Last balance per key among the updates of one day."""
    return current_balance(updates.filter((F.col(ts) >= day) & (F.col(ts) < F.date_add(day, 1))), keys, ts, max_cols)


def route_enrich(df: DataFrame, type_col: str, code: str, routes: dict[str, tuple[DataFrame, str, list[str]]], attrs: list[str],
                 required: list[str] = ()) -> DataFrame:
    """Attributes from the dimension that belongs to the row's type.

    ``routes`` maps a type to (dimension, key column, attribute columns present). The dimensions become one
    table keyed by (type, code) and are joined once. Rows of ``required`` types without a match drop out.
    """
    parts = [
        d.select(F.lit(kind).alias("__type"), F.col(key).cast("string").alias("__code"), F.lit(1).alias("__hit"),
                 *[(F.col(a).cast("string") if a in have else F.lit(None).cast("string")).alias(a) for a in attrs])
        for kind, (d, key, have) in routes.items()
    ]
    dims = reduce(DataFrame.unionByName, parts)
    out = df.join(dims, (F.col(type_col) == F.col("__type")) & (F.col(code).cast("string") == F.col("__code")), "left")
    if required:
        out = out.filter(~(F.col(type_col).isin(*required) & F.col("__hit").isNull()))
    return out.drop("__type", "__code", "__hit")


def catalog_dim(updates: DataFrame, code: str, group: Column, name: Column, rarity: list[tuple[Column, int]], labels: dict[int, str]) -> DataFrame:
    """Item dimension mined from a log: cleaned code, group, display name, and the top rarity of its group.

    Rules apply to the distinct codes, not to the log rows; the first matching rule gives the rarity rank.
    """
    codes = updates.select(strip_suffix(code).alias(code)).distinct()
    rank = F
    for cond, value in rarity:
        rank = rank.when(cond, value)
    items = codes.select(code, group.alias("item_group"), name.alias("item_name"), rank.otherwise(0).alias("rarity_rank"))
    out = partition_agg(items, "item_group", {"group_rarity_rank": F.max("rarity_rank")})
    text = F.create_map(*[F.lit(x) for kv in labels.items() for x in kv])
    return out.withColumn("group_rarity", F.try_element_at(text, F.col("group_rarity_rank")))


def consuming_traces(updates: DataFrame, keys: list[str], ts: str, balance: str, trace: str, bucket: Column | None = None) -> DataFrame:
    """Traces in which a balance went down against the update before it."""
    line = split_window(updates, keys, [ts, trace], bucket, {"__before": ("lag", balance)})
    fell = F.coalesce(F.col(balance), F.lit(0)) < F.coalesce("__before", F.lit(0))
    return line.filter(fell).select(trace).distinct()


def multi_unlock(client: DataFrame, server: DataFrame, consumed: DataFrame, keys: list[str], trace: str, item: str, amount: str, ts: str, as_of: str,
                 minutes: int, threshold: int) -> DataFrame:
    """Keys whose unlocks within the lookback reach the threshold, with the evidence of both sides.

    Server rows count only for traces that consumed a key; copies of a row count once per side.
    """
    now = as_timestamp(as_of)
    cols = [*keys, item, amount]

    def recent(df: DataFrame) -> DataFrame:
        return df.filter((F.col(ts) >= now - F.make_interval(mins=F.lit(minutes))) & (F.col(ts) <= now))

    proven = recent(server).join(consumed, trace, "left_semi")
    rows = recent(client).select(*cols).withColumn("source", F.lit("client")).unionByName(proven.select(*cols).withColumn("source", F.lit("server"))).distinct()
    out = rows.groupBy(*keys).agg(
        F.sum(amount).alias("total"),
        F.array_join(F.array_sort(F.collect_set("source")), ",").alias("sources"),
        F.count("*").alias("evidence"),
    )
    return out.filter(F.col("total") >= threshold)
