"""Sessions, activity, retention and growth of users over an event table."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .windows import running_sum, split_window


def user_days(events: DataFrame, user: str, ts: str, dims: list[str] = ()) -> DataFrame:
    """One row per user and day: the compact base of every activity measure, reduced before any shuffle."""
    return events.select(user, *dims, F.to_date(ts).alias("day")).distinct()


def assign_sessions(events: DataFrame, user: str, ts: str, tie: str, start: Column, bucket: Column | None = None) -> DataFrame:
    """Number the sessions of each user; a start event opens one, events before the first start drop out.

    The number is a running count of starts, so events need no range join with their sessions.
    """
    flagged = events.withColumn("__start", F.when(start, 1).otherwise(0))
    numbered = running_sum(flagged, user, [ts, tie], {"session_no": "__start"}, bucket=bucket)
    return numbered.filter("session_no > 0").drop("__start")


def sessionize(events: DataFrame, user: str, ts: str, tie: str, start: Column, bucket: Column | None = None) -> DataFrame:
    """One row per session: bounds, size, whole minutes and an id built from user, number and start day."""
    rows = assign_sessions(events, user, ts, tie, start, bucket)
    out = rows.groupBy(user, "session_no").agg(F.min(ts).alias("session_start"), F.max(ts).alias("session_end"), F.count("*").alias("events"))
    minutes = F.timestamp_diff("MINUTE", F.col("session_start").cast("timestamp"), F.col("session_end").cast("timestamp"))
    return out.withColumns({
        "minutes": minutes,
        "session_id": F.concat_ws("-", F.col(user), F.col("session_no"), F.to_date("session_start")),
    })


def session_minutes(events: DataFrame, user: str, ts: str, tie: str, start: Column, bucket: Column | None = None) -> DataFrame:
    """Minutes per user and day: every session counts the span it has on that day."""
    rows = assign_sessions(events, user, ts, tie, start, bucket).withColumn("day", F.to_date(ts))
    spans = rows.groupBy(user, "session_no", "day").agg(F.min(ts).alias("a"), F.max(ts).alias("b"))
    minutes = F.timestamp_diff("MINUTE", F.col("a").cast("timestamp"), F.col("b").cast("timestamp"))
    return spans.groupBy(user, "day").agg(F.sum(minutes).alias("session_minutes"))


def daily_activity(events: DataFrame, user: str, ts: str, tie: str, kind: str, start: str, played: str, funnel: list[str],
                   bucket: Column | None = None) -> DataFrame:
    """One row per user and day with a session start: played, first-ever flag, funnel flags and session minutes."""
    day = events.withColumn("day", F.to_date(ts))
    flags = day.groupBy(user, "day").agg(
        F.max(F.when(F.col(kind) == start, 1).otherwise(0)).alias("active"),
        F.max(F.when(F.col(kind) == played, 1).otherwise(0)).alias("played"),
        F.min(F.when(F.col(kind) == start, F.col(ts))).alias("first_start"),
        *[F.max(F.when(F.col(kind) == f, 1).otherwise(0)).alias(f"did_{f}") for f in funnel],
    ).filter("active = 1")
    first = flags.groupBy(user).agg(F.min("first_start").alias("first_active_time"))
    minutes = session_minutes(events, user, ts, tie, F.col(kind) == start, bucket)
    out = flags.join(first, user).join(minutes, [user, "day"], "left")
    return out.withColumn("is_first_day", (F.to_date("first_active_time") == F.col("day"))).drop("first_start", "active")


def session_rollup(df: DataFrame, keys: list[str], ts: str, engagement: str | Column, attrs: list[str], default: str = "unknown") -> DataFrame:
    """Engagement sum, first timestamp and the greatest known attribute values per key."""
    amount = F.col(engagement) if isinstance(engagement, str) else engagement
    return df.groupBy(*keys).agg(
        F.sum(amount).alias("engagement"), F.min(ts).alias("first_ts"),
        *[F.coalesce(F.max(a), F.lit(default)).alias(a) for a in attrs],
    )


def active_users(events: DataFrame, user: str, ts: str, grain: str = "day", dims: list[str] = ()) -> DataFrame:
    """Distinct users per day, week or month."""
    period = F.to_date(F.date_trunc(grain, F.col(ts)))
    return events.select(user, *dims, period.alias("period")).distinct().groupBy("period", *dims).agg(F.count(user).alias("users"))


def _aged(days: DataFrame, user: str) -> DataFrame:
    first = days.groupBy(user).agg(F.min("day").alias("first_day"))
    return days.join(first, user)


def retention(events: DataFrame, user: str, ts: str, n_days: list[int], cohort: Column | None = None) -> DataFrame:
    """Users per first-event cohort and how many of them come back exactly n days later."""
    aged = _aged(user_days(events, user, ts), user).withColumn("n", F.datediff("day", "first_day"))
    key = (F.col("first_day") if cohort is None else cohort).alias("cohort")
    # a user has one row per day, so plain counts are distinct counts
    return aged.groupBy(key).agg(F.count_if(F.col("n") == 0).alias("users"), *[F.count_if(F.col("n") == d).alias(f"d{d}") for d in n_days])


def retention_curve(events: DataFrame, user: str, ts: str, unit_days: int = 7) -> DataFrame:
    """Users by period since their first event, change against the previous period, share of period 0."""
    aged = _aged(user_days(events, user, ts), user)
    period = F.floor(F.datediff("day", "first_day") / unit_days).cast("bigint").alias("period")
    sizes = aged.select(user, period).distinct().groupBy("period").agg(F.count("*").alias("users"))
    line = sizes.withColumn("before", F.lag("users").over(Window.orderBy("period")))  # one row per period
    base = sizes.filter("period = 0").select("users").scalar()
    return line.select(
        "period", "users",
        F.round((F.col("users") - F.col("before")) / F.col("before"), 2).alias("churn_rate"),
        F.round(F.col("users") / base, 2).alias("share_of_first"),
    )


def growth_accounting(events: DataFrame, user: str, ts: str, bucket: Column | None = None) -> DataFrame:
    """Per day: users at the beginning and end, new, returning, retained and temporarily churned.

    ``bucket`` may be an expression over ``day``; a user has one row per day, so the default is a plain window.
    """
    days = user_days(events, user, ts)
    line = split_window(days, user, ["day"], bucket, {"previous": ("lag", "day")})
    gap = F.datediff("day", "previous")
    daily = line.groupBy("day").agg(
        F.count("*").alias("ending"),
        F.count_if(F.col("previous").isNull()).alias("new_users"),
        F.count_if(gap > 1).alias("returning"),
        F.count_if(gap == 1).alias("retained"),
    )
    out = daily.withColumn("beginning", F.lag("ending").over(Window.orderBy("day")))  # one row per day
    return out.withColumn("churned", F.col("beginning") - F.col("retained"))


def first_touch(df: DataFrame, user: str, order: list[str], attrs: list[str]) -> DataFrame:
    """Attributes of each user's first event, by aggregation instead of a sort."""
    first = df.groupBy(user).agg(F.min_by(F.struct(*attrs), F.struct(*order)).alias("__f"))
    return first.select(user, *[F.col(f"__f.{a}").alias(f"first_{a}") for a in attrs])


def time_spent(events: DataFrame, keys: list[str], ts: str) -> DataFrame:
    """Seconds between first and last event per key."""
    out = events.groupBy(*keys).agg(F.min(ts).alias("a"), F.max(ts).alias("b"))
    return out.select(*keys, F.timestamp_diff("SECOND", F.col("a").cast("timestamp"), F.col("b").cast("timestamp")).alias("seconds"))


def daily_counts(df: DataFrame, ts_text: str) -> DataFrame:
    """Events per day from raw timestamp text."""
    return df.groupBy(F.substring(ts_text, 1, 10).alias("day")).agg(F.count("*").alias("n"))


def engagement_dashboard(events: DataFrame, user: str, ts: str, tie: str, item: str, points: Column, levels: list[tuple[float, int]],
                         holdings: DataFrame, holding: str, bucket: Column | None = None) -> DataFrame:
    """Per user and day: last item, points so far (day included), level reached, lifetime label and holdings."""
    from ..functions.numeric import lifetime_bucket, step_function

    daily = events.withColumn("day", F.to_date(ts)).groupBy(user, "day").agg(
        F.max_by(item, F.struct(ts, tie)).alias("last_item"), F.sum(points).alias("points"))
    running = running_sum(daily, user, ["day"], {"points_so_far": "points"}, bucket=bucket)
    first = daily.groupBy(user).agg(F.min("day").alias("first_day"))
    out = running.join(first, user).join(holdings.select(user, holding), user, "left")
    age = F.datediff("day", "first_day")
    return out.withColumns({
        "level": step_function("points_so_far", levels),
        "lifetime": lifetime_bucket(age, [(0, "new"), (7, "recent")], "regular"),
        holding: F.coalesce(F.col(holding), F.lit(0)),
    }).drop("first_day")


def event_mart(events: DataFrame, keys: list[str], kind: str, kinds: list[str], counters: dict[str, Column], dims: dict[str, Column] | None = None) -> DataFrame:
    """Per key: one count column per event kind, distinct or max counters and attribute columns, in one pass."""
    counts = [F.coalesce(F.sum(F.when(F.col(kind) == k, 1)), F.lit(0)).alias(f"n_{k}") for k in kinds]
    extra = {**counters, **(dims or {})}
    return events.groupBy(*keys).agg(*counts, *[c.alias(n) for n, c in extra.items()])


def queue_average(tasks: DataFrame, keys: list[str], start: str, end: str) -> DataFrame:
    """Mean waiting seconds per key, finished tasks only."""
    wait = F.timestamp_diff("SECOND", F.col(start).cast("timestamp"), F.col(end).cast("timestamp"))
    return tasks.filter(F.col(end).isNotNull()).groupBy(*keys).agg((F.sum(wait).cast("double") / F.count(wait)).alias("avg_seconds"), F.count("*").alias("tasks"))
