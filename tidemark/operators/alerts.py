"""Threshold rules over aggregated series, rank movements, rule tables and message digests."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.dates import as_date, as_timestamp
from .joins import null_safe_join
from .windows import latest_per_key, top_n, trailing


def cost_spike(df: DataFrame, date: str, cost: str, times: float, rows: int = 7, as_of: str | None = None) -> DataFrame:
    """Days that cost more than ``times`` the mean of the ``rows`` days before.

    The sum is divided by ``rows`` even where fewer days exist.
    """
    daily = df.groupBy(F.to_date(date).alias("day")).agg(F.sum(cost).alias("cost"))
    line = trailing(daily, [], "day", rows, {"__before": ("sum", "cost")})
    line = line.withColumn("mean_before", F.col("__before").cast("double") / rows).drop("__before")
    hot = line.filter(F.col("cost").cast("double") > F.col("mean_before") * times)
    return hot.filter(F.col("day") == as_date(as_of)) if as_of else hot


def today_vs_mean(df: DataFrame, date: str, cost: str, as_of: str, times: float = 3.0, days: int = 7, by: list[str] = (), exclude_today: bool = False) -> DataFrame:
    """Cost of the day against the mean over the window; the day itself counts unless left out."""
    today = as_date(as_of)
    window = df.filter((F.col(date) >= F.date_sub(today, days)) & (F.col(date) < F.date_add(today, 1)))
    daily = window.groupBy(*by, F.to_date(date).alias("day")).agg(F.sum(cost).alias("cost"))
    is_today = F.col("day") == today
    base = F.when(~is_today, F.col("cost")) if exclude_today else F.col("cost")
    out = daily.groupBy(*by).agg(
        F.sum(F.when(is_today, F.col("cost"))).cast("double").alias("today_cost"),
        (F.sum(base).cast("double") / F.nullif(F.count(base), F.lit(0))).alias("mean_cost"),
    )
    return out.filter("today_cost IS NOT NULL").withColumn("exceeds", F.col("today_cost") >= F.col("mean_cost") * times)


def total_over_limit(df: DataFrame, date: str, cost: Column, as_of: str, limit: float) -> DataFrame:
    """The day's total when it reaches the limit."""
    day = as_date(as_of)
    rows = df.filter((F.col(date) >= day) & (F.col(date) < F.date_add(day, 1)))
    return rows.agg(F.sum(cost).cast("double").alias("total_cost")).filter(F.col("total_cost") >= limit)


def units_over_limit(df: DataFrame, cost: Column, limit: float) -> DataFrame:
    """Single queries that reach the limit."""
    return df.withColumn("unit_cost", cost).filter(F.col("unit_cost") >= limit)


def top_spenders(df: DataFrame, user: str, cost: Column, n: int = 5) -> DataFrame:
    return df.groupBy(user).agg(F.sum(cost).alias("cost")).orderBy(F.desc("cost"), user).limit(n)


def rate_change(latest: DataFrame, base: DataFrame, key: str, value: str, threshold: float = 0.05) -> DataFrame:
    """Keys whose value moved by at least the threshold against the base."""
    b = base.select(key, F.col(value).alias("base_value"))
    change = (F.col(value) - F.col("base_value")) / F.nullif(F.col("base_value"), F.lit(0.0))
    return latest.join(b, key).withColumn("change", change).filter(F.abs("change") >= threshold)


def rebase(base: DataFrame, alerts: DataFrame, key: str, value: str) -> DataFrame:
    """Base table after an alert: alerted keys take the latest value."""
    new = alerts.select(key, F.col(value).alias("__new"))
    return base.join(new, key, "left").withColumn(value, F.coalesce("__new", value)).drop("__new")


def daily_ranking(df: DataFrame, platform: str, key: str, date: str, value: str, as_of: Column, days: int, n: int) -> DataFrame:
    """Top keys per platform by the sum of the last ``days`` days."""
    rows = df.filter((F.col(date) > F.date_sub(as_of, days)) & (F.col(date) < F.date_add(as_of, 1)))
    sums = rows.groupBy(platform, key).agg(F.sum(value).alias("total"))
    return top_n(sums, platform, [F.desc("total"), F.asc(key)], n, "ranking")


def rank_movement(today: DataFrame, yesterday: DataFrame, keys: list[str], rank: str, top: int = 50, min_move: int = 5) -> DataFrame:
    """Moves within the first ``top`` of two rankings, with a label; kept are keys that moved far enough."""
    out = rank_labels(today, yesterday, keys, rank, top)
    return out.filter(F.col("today_rank").isNotNull() & (F.col("rank_change") >= min_move))


def rank_labels(today: DataFrame, yesterday: DataFrame, keys: list[str], rank: str, top: int | None = None) -> DataFrame:
    """Every key of either day: both ranks, the size of the move, and up / drop / same / new / out.

    ``top`` says how far the ranking goes: a key beyond it counts as unranked on that day. Without it all are ranked.
    """
    if top is not None:
        today, yesterday = today.filter(F.col(rank) <= top), yesterday.filter(F.col(rank) <= top)
    a = today.select(*keys, F.col(rank).alias("today_rank"))
    b = yesterday.select(*keys, F.col(rank).alias("yesterday_rank"))
    t, y = F.col("today_rank"), F.col("yesterday_rank")
    status = (F.when(t.isNull(), "out of ranking").when(y.isNull(), "new in ranking").when(t > y, "drop").when(t < y, "up").otherwise("same rank"))
    return null_safe_join(a, b, keys, "full_outer").withColumns({"rank_change": F.abs(t - y), "rank_status": status})


def apply_rules(df: DataFrame, rules: list[dict[str, str]]) -> DataFrame:
    """Alert rows of declarative rules: ``name``, ``condition`` (SQL), ``message`` with ``{column}`` places.

    The table is scanned once: each row carries the array of rules it meets.
    """
    def message(text: str) -> Column:
        out, rest = [], text
        while "{" in rest:
            head, _, tail = rest.partition("{")
            name, _, rest = tail.partition("}")
            out += [F.lit(head), F.coalesce(F.col(name).cast("string"), F.lit(""))]
        return F.concat(*out, F.lit(rest))

    hits = F.array(*[
        F.when(F.expr(r["condition"]), F.struct(F.lit(r["name"]).alias("rule"), message(r["message"]).alias("message"))) for r in rules
    ])
    met = df.withColumn("__a", F.explode(F.filter(hits, lambda a: a.isNotNull())))
    return met.select(*df.columns, "__a.rule", "__a.message")


def message_digest(messages: DataFrame, keys: list[str], version: list[str], ts: str, as_of: str, days: int, links: DataFrame, link_keys: list[str],
                   users: DataFrame, user: str) -> DataFrame:
    """Latest copy of each message of the last days, with its links and author."""
    now = as_timestamp(as_of)
    recent = messages.filter((F.col(ts) >= now - F.make_interval(days=F.lit(days))) & (F.col(ts) < now))
    last = latest_per_key(recent, keys, version)
    per = links.select(*link_keys, "link").distinct().groupBy(*link_keys).agg(F.array_join(F.array_sort(F.collect_set("link")), "\n").alias("links"))
    return last.join(per, link_keys, "left").join(users, user, "left").distinct()
