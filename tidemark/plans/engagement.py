"""Engagement queries over the event table."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import engagement as E
from ..operators.aggregates import money
from ..session import shared_dir
from ..sources.bitmaps import ActivityBitmaps
from .registry import query


def k():
    return F.get_json_object("props", "$.k").cast("bigint")


def day():
    return F.to_date("ts")


def hour():
    return F.date_trunc("hour", "ts")


@query("""SELECT 'day' AS grain, cast(ts AS DATE) AS period, count(DISTINCT user_id) AS users FROM events GROUP BY 2
          UNION ALL SELECT 'month', cast(date_trunc('month', ts) AS DATE), count(DISTINCT user_id) FROM events GROUP BY 2""")
def dau_mau(t):
    parts = [E.active_users(t.events, "user_id", "ts", g).select(F.lit(g).alias("grain"), "period", "users") for g in ("day", "month")]
    return parts[0].union(parts[1])


@query("""SELECT 'day' AS grain, cast(ts AS DATE) AS period, count(DISTINCT user_id) AS users FROM events GROUP BY 2
          UNION ALL SELECT 'week', cast(date_trunc('week', ts) AS DATE), count(DISTINCT user_id) FROM events GROUP BY 2
          UNION ALL SELECT 'month', cast(date_trunc('month', ts) AS DATE), count(DISTINCT user_id) FROM events GROUP BY 2""")
def active_user_bitmaps(t):
    """Stored bitmaps of users with text keys: the first weeks, then the rest with one day again; periods come from the bitmaps alone."""
    stored = ActivityBitmaps(t.spark, shared_dir(t.spark, "active"), "user")
    e = t.events.select(F.concat(F.lit("u"), "user_id").alias("user"), F.to_date("ts").alias("day"))
    stored.add(e.filter("day < '2024-01-20'"), "day")
    stored.add(e.filter("day >= '2024-01-19'"), "day")
    parts = [stored.counts(g).select(F.lit(g).alias("grain"), "period", "users") for g in ("day", "week", "month")]
    return parts[0].union(parts[1]).union(parts[2])


@query("""WITH f AS (SELECT user_id, min(cast(ts AS DATE)) AS d0 FROM events GROUP BY 1), a AS (SELECT DISTINCT user_id, cast(ts AS DATE) AS d FROM events)
          SELECT d0 AS cohort, count(DISTINCT user_id) AS users, count(DISTINCT CASE WHEN d - d0 = 1 THEN user_id END) AS d1, count(DISTINCT CASE WHEN d - d0 = 2 THEN user_id END) AS d2,
                 count(DISTINCT CASE WHEN d - d0 = 7 THEN user_id END) AS d7, count(DISTINCT CASE WHEN d - d0 = 14 THEN user_id END) AS d14 FROM a JOIN f USING (user_id) GROUP BY 1""")
def retention_nday(t):
    return E.retention(t.events, "user_id", "ts", [1, 2, 7, 14])


@query("""WITH f AS (SELECT user_id, min(cast(ts AS DATE)) AS d0 FROM events GROUP BY 1),
               s AS (SELECT cast((cast(ts AS DATE) - d0) // 7 AS BIGINT) AS period, count(DISTINCT user_id) AS users FROM events JOIN f USING (user_id) GROUP BY 1)
          SELECT period, users, cast(round(cast((users - lag(users) OVER (ORDER BY period)) / lag(users) OVER (ORDER BY period) AS DECIMAL(38,9)), 2) AS DOUBLE) AS churn_rate, cast(round(cast(users / (SELECT users FROM s WHERE period = 0) AS DECIMAL(38,9)), 2) AS DOUBLE) AS share_of_first FROM s""")
def retention_curve(t):
    return E.retention_curve(t.events, "user_id", "ts")


@query("""WITH d AS (SELECT DISTINCT user_id, cast(ts AS DATE) AS day FROM events), l AS (SELECT *, lag(day) OVER (PARTITION BY user_id ORDER BY day) AS p FROM d),
               g AS (SELECT day, count(*) AS ending, count(*) FILTER (p IS NULL) AS new_users, count(*) FILTER (day - p > 1) AS returning, count(*) FILTER (day - p = 1) AS retained FROM l GROUP BY 1)
          SELECT *, lag(ending) OVER (ORDER BY day) AS beginning, lag(ending) OVER (ORDER BY day) - retained AS churned FROM g""")
def growth_accounting(t):
    return E.growth_accounting(t.events, "user_id", "ts")


SESSIONS = """WITH n AS (SELECT *, sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM events),
  e AS (SELECT * REPLACE (cast(s AS BIGINT) AS s) FROM n WHERE s > 0)"""


@query(SESSIONS + """ SELECT user_id, s AS session_no, min(ts) AS session_start, max(ts) AS session_end, count(*) AS events, date_sub('minute', min(ts), max(ts)) AS minutes,
                             user_id || '-' || s || '-' || cast(min(ts) AS DATE) AS session_id FROM e GROUP BY 1, 2""")
def sessionize(t):
    return E.sessionize(t.events, "user_id", "ts", "event_id", F.col("event_type") == "signup", hour())


@query(SESSIONS + """ SELECT event_id, user_id, s AS session_no FROM e""")
def join_session_window(t):
    e = t.events.select("event_id", "user_id", "ts", "event_type")
    return E.assign_sessions(e, "user_id", "ts", "event_id", F.col("event_type") == "signup", hour()).select("event_id", "user_id", "session_no")


@query(SESSIONS + """, m AS (SELECT user_id, day, cast(sum(mi) AS BIGINT) AS session_minutes FROM (SELECT user_id, s, cast(ts AS DATE) AS day, date_sub('minute', min(ts), max(ts)) AS mi FROM e GROUP BY 1, 2, 3) GROUP BY 1, 2),
               d AS (SELECT user_id, cast(ts AS DATE) AS day, max(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) AS active, max(CASE WHEN event_type = 'view' THEN 1 ELSE 0 END) AS played,
                            max(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) AS did_click, max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS did_purchase FROM events GROUP BY 1, 2),
               f AS (SELECT user_id, min(ts) AS first_active_time FROM events WHERE event_type = 'signup' GROUP BY 1)
          SELECT user_id, day, played, did_click, did_purchase, first_active_time, session_minutes, cast(first_active_time AS DATE) = day AS is_first_day FROM d JOIN f USING (user_id) LEFT JOIN m USING (user_id, day) WHERE active = 1""")
def session_daily_activity(t):
    return E.daily_activity(t.events, "user_id", "ts", "event_id", "event_type", "signup", "view", ["click", "purchase"], hour())


@query("""SELECT cast(ts AS DATE) AS day, user_id, cast(sum(cast(value AS DECIMAL(14,2))) AS DOUBLE) AS engagement, min(ts) AS first_ts,
                 coalesce(max(CASE WHEN event_type <> 'error' THEN event_type END), 'unknown') AS kind, coalesce(max(CASE WHEN value > 200 THEN props END), 'unknown') AS device FROM events GROUP BY 1, 2""")
def login_rollup(t):
    e = t.events.withColumns({"day": day(), "kind": F.when(F.col("event_type") != "error", F.col("event_type")), "device": F.when(F.col("value") > 200, F.col("props"))})
    out = E.session_rollup(e, ["day", "user_id"], "ts", money("value"), ["kind", "device"])
    return out.withColumn("engagement", F.col("engagement").cast("double"))


@query("""SELECT user_id, arg_min(event_type, (ts, event_id)) AS first_event_type, arg_min(value, (ts, event_id)) AS first_value FROM events GROUP BY 1""")
def first_touch(t):
    return E.first_touch(t.events, "user_id", ["ts", "event_id"], ["event_type", "value"])


@query("""SELECT user_id, event_type, cast(ts AS DATE) AS day, date_sub('second', min(ts), max(ts)) AS seconds FROM events GROUP BY 1, 2, 3""")
def time_spent(t):
    return E.time_spent(t.events.withColumn("day", day()), ["user_id", "event_type", "day"], "ts")


@query("""SELECT strftime(ts, '%Y-%m-%d') AS day, count(*) AS n FROM events WHERE event_type = 'signup' GROUP BY 1""")
def star_history(t):
    raw = t.events.filter("event_type = 'signup'").select(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'Z'").alias("starred_at"))
    return E.daily_counts(raw, "starred_at")


@query("""WITH d AS (SELECT user_id, cast(ts AS DATE) AS day, arg_max(event_type, (ts, event_id)) AS last_item, sum(cast(value AS DECIMAL(14,2))) AS points FROM events GROUP BY 1, 2),
               r AS (SELECT *, sum(points) OVER (PARTITION BY user_id ORDER BY day) AS sofar, min(day) OVER (PARTITION BY user_id) AS d0 FROM d),
               h AS (SELECT o_custkey AS user_id, count(*) AS orders FROM orders GROUP BY 1)
          SELECT user_id, day, last_item, cast(points AS DOUBLE) AS points, cast(sofar AS DOUBLE) AS points_so_far, CASE WHEN sofar >= 3000 THEN 3 WHEN sofar >= 1500 THEN 2 WHEN sofar >= 500 THEN 1 ELSE 0 END AS level,
                 CASE WHEN day = d0 THEN 'new' WHEN day - d0 <= 7 THEN 'recent' ELSE 'regular' END AS lifetime, coalesce(orders, 0) AS orders FROM r LEFT JOIN h USING (user_id)""")
def quest_dashboard(t):
    held = t.orders.groupBy(F.col("o_custkey").alias("user_id")).agg(F.count("*").alias("orders"))
    out = E.engagement_dashboard(t.events, "user_id", "ts", "event_id", "event_type", money("value"), [(500, 1), (1500, 2), (3000, 3)], held, "orders")
    return out.withColumns({c: F.col(c).cast("double") for c in ("points", "points_so_far")})


@query("""SELECT cast(json_extract_string(props, '$.k') AS BIGINT) AS image, cast(count(*) FILTER (event_type = 'view') AS BIGINT) AS n_view, cast(count(*) FILTER (event_type = 'click') AS BIGINT) AS n_click,
                 max(value) AS best_value, count(DISTINCT user_id) AS users, max(cast(ts AS DATE)) AS last_day FROM events GROUP BY 1""")
def image_stats(t):
    return E.event_mart(t.events.withColumn("image", k()), ["image"], "event_type", ["view", "click"],
                        {"best_value": F.max("value"), "users": F.countDistinct("user_id")}, {"last_day": F.max(day())})


@query("""SELECT event_type AS page, cast(count(*) FILTER (k < 20) AS BIGINT) AS n_0, cast(count(*) FILTER (k BETWEEN 20 AND 39) AS BIGINT) AS n_1, cast(count(*) FILTER (k BETWEEN 40 AND 59) AS BIGINT) AS n_2,
                 cast(count(*) FILTER (k BETWEEN 60 AND 79) AS BIGINT) AS n_3, cast(count(*) FILTER (k >= 80) AS BIGINT) AS n_4 FROM (SELECT *, cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events) GROUP BY 1""")
def page_stats(t):
    """Pivot columns taken from the data, through the bounded value list."""
    from ..operators.aggregates import column_values, pivot

    e = t.events.select(F.col("event_type").alias("page"), F.floor(k() / 20).cast("string").alias("section"))
    return pivot(e, "page", "section", sorted(column_values(e, "section", limit=50)), prefix="n_")


@query("""SELECT o_orderpriority, cast(sum(date_diff('second', o_orderdate, l)) AS DOUBLE) / count(*) AS avg_seconds, count(*) AS tasks FROM orders JOIN (SELECT l_orderkey, max(l_shipdate) AS l FROM lineitem WHERE l_linestatus = 'F' GROUP BY 1) ON l_orderkey = o_orderkey GROUP BY 1""")
def task_stats(t):
    done = t.lineitem.filter("l_linestatus = 'F'").groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.max("l_shipdate").alias("finished"))
    return E.queue_average(t.orders.join(done, "o_orderkey", "left"), ["o_orderpriority"], "o_orderdate", "finished")


@query("""SELECT user_id, count(*) AS runs, cast(sum(cast(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS k_total, 2 AS params_per_run, list_aggregate(list_sort(list(DISTINCT event_type)), 'string_agg', '|') AS recipes FROM events GROUP BY 1""")
def recipe_usage(t):
    from ..functions.nested import event_param, params_like
    from .scalars import with_params

    e = with_params(t.events)
    return e.groupBy("user_id").agg(
        F.count("*").alias("runs"), F.sum(event_param("event_params", "k", "int_value")).alias("k_total"),
        F.max(F.size(params_like("event_params", "k%", "%kind"))).alias("params_per_run"),
        F.array_join(F.array_sort(F.collect_set(event_param("event_params", "page_kind"))), "|").alias("recipes"))
