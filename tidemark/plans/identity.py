"""Identity, device and version queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import identity as I
from .registry import query


@query("""WITH w AS (SELECT c_custkey AS u, lower('C' || c_custkey) AS w FROM customer UNION SELECT c_custkey, lower('C' || c_custkey) || 'x' FROM customer UNION SELECT user_id, event_type FROM events),
               p AS (SELECT o_custkey AS u, list_aggregate(list_sort(list(DISTINCT o_orderpriority)), 'string_agg', ',') AS names FROM orders GROUP BY 1)
          SELECT u AS user_id, count(*) AS n_wallets, string_agg(w, ',' ORDER BY w) AS wallets, any_value(names) AS names FROM w LEFT JOIN p USING (u) GROUP BY 1""")
def identity_union(t):
    wallet = F.concat(F.lit("C"), "c_custkey")
    a = t.customer.select(F.col("c_custkey").alias("user_id"), F.concat(wallet, F.lit(" , "), wallet, F.lit("X,")).alias("w"))
    b = t.events.select("user_id", F.upper("event_type").alias("w")).distinct()
    directory = t.orders.select(F.col("o_custkey").alias("user_id"), F.col("o_orderpriority").alias("name"))
    out = I.identity_union([a, b], directory, "user_id", "w", ["name"])
    return out.select("user_id", F.size("wallets").cast("bigint").alias("n_wallets"), F.array_join("wallets", ",").alias("wallets"), F.array_join("name", ",").alias("names"))


@query("""SELECT c_custkey, coalesce(a.v, b.v, 'none') AS v FROM customer LEFT JOIN (SELECT o_custkey, max(o_orderpriority) AS v FROM orders WHERE o_orderstatus = 'P' GROUP BY 1) a ON a.o_custkey = c_custkey
          LEFT JOIN (SELECT user_id, min(event_type) AS v FROM events GROUP BY 1) b ON b.user_id = c_custkey""")
def identity_fallback_attributes(t):
    first = t.orders.filter("o_orderstatus = 'P'").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max("o_orderpriority").alias("v"))
    second = t.events.groupBy(F.col("user_id").alias("c_custkey")).agg(F.min("event_type").alias("v"))
    return I.coalesce_sources(t.customer.select("c_custkey"), [first, second], "c_custkey", "v", "none")


@query("""WITH e AS (SELECT ts, CASE WHEN event_type <> 'error' THEN user_id END AS user_id, 'd' || user_id || '-' || (event_id % 3) AS device, 'm' || (event_id % 2) AS model FROM events),
               l AS (SELECT DISTINCT device, user_id FROM e WHERE user_id IS NOT NULL), s AS (SELECT device, model, min(ts) AS a, max(ts) AS b, count(*) AS n FROM e GROUP BY 1, 2)
          SELECT user_id, model, list_aggregate(list_sort(list(DISTINCT device)), 'string_agg', ',') AS device_ids, min(a) AS first_seen, max(b) AS last_seen, cast(sum(n) AS BIGINT) AS events, md5(user_id || '-' || model) AS device_key
          FROM s JOIN l USING (device) GROUP BY 1, 2""")
def device_graph(t):
    e = t.events.select("ts", F.when(F.col("event_type") != "error", F.col("user_id")).alias("user_id"),
                        F.concat(F.lit("d"), "user_id", F.lit("-"), (F.col("event_id") % 3)).alias("device"), F.concat(F.lit("m"), F.col("event_id") % 2).alias("model"))
    return I.device_map(e, "user_id", "device", "ts", "model").withColumn("device_ids", F.array_join("device_ids", ","))


@query("""WITH s AS (SELECT user_id, event_type, min(ts) AS a, max(ts) AS b FROM events GROUP BY 1, 2), r AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY a DESC, event_type DESC) AS rk FROM s)
          SELECT user_id, event_type, a AS start_ts, CASE WHEN rk = 1 THEN TIMESTAMP '2026-01-01 00:00:00' ELSE b END AS end_ts, CASE WHEN rk = 1 THEN 1 ELSE 0 END AS is_active FROM r""")
def account_lifespan(t):
    return I.lifespan(t.events, "user_id", "event_type", "ts", F.lit("2026-01-01 00:00:00").cast("timestamp_ntz"))


@query("""SELECT DISTINCT o_custkey, o_orderdate, o_orderpriority FROM (SELECT *, max(o_orderdate) OVER (PARTITION BY o_custkey) AS m FROM orders) WHERE o_orderdate = m""")
def latest_contact(t):
    return I.attrs_at_latest(t.orders, "o_custkey", "o_orderdate", ["o_orderpriority"])


@query("""WITH l AS (SELECT user_id, ts, '1.' || (cast(ts AS DATE) - DATE '2024-01-01') // 4 AS version FROM events), s AS (SELECT user_id, version, min(ts) AS version_start FROM l GROUP BY 1, 2),
               d AS (SELECT user_id, cast(min(ts) AS DATE) AS day0_date FROM l GROUP BY 1)
          SELECT user_id, version, version_start, lead(version_start) OVER (PARTITION BY user_id ORDER BY version_start, version) AS next_version_start, day0_date, coalesce(c_mktsegment = 'BUILDING', false) AS is_internal
          FROM s JOIN d USING (user_id) LEFT JOIN customer ON c_custkey = user_id""")
def day0_version_history(t):
    users = t.customer.select(F.col("c_custkey").alias("user_id"), F.concat("c_name", F.lit("@"), "c_mktsegment").alias("mail"))
    return I.version_history(builds(t), "user_id", "version", "ts", users, "mail", "Building")


def builds(t):
    number = F.floor(F.datediff(F.to_date("ts"), F.lit("2024-01-01").cast("date")) / 4)
    return t.events.select("user_id", "ts", F.concat(F.lit("1."), number.cast("string")).alias("version"))


@query("""WITH v AS (SELECT (cast(ts AS DATE) - DATE '2024-01-01') // 4 AS n, min(cast(ts AS DATE)) AS from_date FROM events GROUP BY 1)
          SELECT '1.' || n AS version, from_date, coalesce(lead(from_date) OVER (ORDER BY n), DATE '2024-02-15') AS to_date FROM v""")
def release_calendar(t):
    """Calendar of the whole span, reached by closing the open end of an older one."""
    b = builds(t)
    old = I.release_calendar(b.filter("ts < '2024-01-20'"), "version", "ts", F.lit("2024-01-20").cast("date"))
    new = I.release_calendar(b.filter("ts >= '2024-01-13'"), "version", "ts", F.lit("2024-02-15").cast("date"))
    return I.close_releases(old, new, "version")
