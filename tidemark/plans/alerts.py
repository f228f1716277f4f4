"""Alert rules over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import scan_cost
from ..operators import alerts as N
from ..operators.aggregates import money
from ..operators.windows import period_deltas, range_parts, split_window
from .registry import query


def day():
    return F.to_date("ts")


@query("""WITH d AS (SELECT cast(o_orderdate AS DATE) AS day, sum(cast(o_totalprice AS DECIMAL(14,2))) AS c FROM orders GROUP BY 1),
               w AS (SELECT day, c, cast(sum(c) OVER (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS DOUBLE) / 7 AS mean_before FROM d)
          SELECT day, cast(c AS DOUBLE) AS cost, mean_before FROM w WHERE cast(c AS DOUBLE) > mean_before * 2""")
def anomaly_cost_vs_trailing(t):
    out = N.cost_spike(t.orders.withColumn("cost", money("o_totalprice")), "o_orderdate", "cost", 2)
    return out.withColumn("cost", F.col("cost").cast("double"))


@query("""WITH d AS (SELECT event_type, cast(ts AS DATE) AS day, sum(cast(value AS DECIMAL(14,2))) AS c FROM events WHERE cast(ts AS DATE) BETWEEN DATE '2024-01-18' AND DATE '2024-01-25' GROUP BY 1, 2)
          SELECT event_type, cast(max(c) FILTER (day = DATE '2024-01-25') AS DOUBLE) AS today_cost, cast(sum(c) AS DOUBLE) / count(*) AS mean_cost,
                 cast(max(c) FILTER (day = DATE '2024-01-25') AS DOUBLE) >= cast(sum(c) AS DOUBLE) / count(*) * 1.1 AS exceeds FROM d GROUP BY 1""")
def anomaly_today_vs_mean(t):
    return N.today_vs_mean(t.events.withColumn("cost", money("value")), "ts", "cost", "2024-01-25", 1.1, 7, ["event_type"])


@query("""SELECT 'total' AS rule, 'all' AS who, cast(sum(n_chars) / 1073741824.0 * 0.005 AS DOUBLE) AS cost FROM documents HAVING sum(n_chars) > 0
          UNION ALL SELECT 'single', cast(doc_id AS VARCHAR), n_chars / 1073741824.0 * 0.005 FROM documents WHERE n_chars / 1073741824.0 * 0.005 >= 0.00000005
          UNION ALL SELECT * FROM (SELECT 'top', source, cast(sum(n_chars) AS DOUBLE) FROM documents GROUP BY 2 ORDER BY 3 DESC, 2 LIMIT 5)""")
def usage_limits(t):
    """Total, single-query and top-user cost rules over the size of documents."""
    docs = t.documents
    total = docs.agg(scan_cost(F.sum("n_chars"), 0.005).alias("cost")).filter("cost >= 0").select(F.lit("total").alias("rule"), F.lit("all").alias("who"), "cost")
    single = N.units_over_limit(docs, scan_cost("n_chars", 0.005), 5e-8).select(F.lit("single"), F.col("doc_id").cast("string"), "unit_cost")
    top = N.top_spenders(docs, "source", F.col("n_chars"), 5).select(F.lit("top"), "source", F.col("cost").cast("double"))
    return total.union(single).union(top)


@query("""SELECT cast(sum(cast(value AS DECIMAL(14,2))) AS DOUBLE) AS total_cost FROM events WHERE cast(ts AS DATE) = DATE '2024-01-25' HAVING sum(cast(value AS DECIMAL(14,2))) >= 1000""")
def daily_cost_alarm(t):
    return N.total_over_limit(t.events, "ts", money("value"), "2024-01-25", 1000)


@query("""WITH b AS (SELECT event_type, cast(sum(cast(value AS DECIMAL(14,2))) AS DOUBLE) AS v FROM events WHERE cast(ts AS DATE) = DATE '2024-01-10' GROUP BY 1), l AS (SELECT event_type, cast(sum(cast(value AS DECIMAL(14,2))) AS DOUBLE) AS v FROM events WHERE cast(ts AS DATE) = DATE '2024-01-20' GROUP BY 1)
          SELECT event_type, b.v AS base_value, l.v AS v, (l.v - b.v) / b.v AS change, l.v AS new_base FROM l JOIN b USING (event_type) WHERE abs((l.v - b.v) / b.v) >= 0.05""")
def anomaly_rate_change(t):
    def at(d):
        return t.events.filter(day() == F.lit(d).cast("date")).groupBy("event_type").agg(F.sum(money("value")).cast("double").alias("v"))

    base, latest = at("2024-01-10"), at("2024-01-20")
    alerts = N.rate_change(latest, base, "event_type", "v")
    renewed = N.rebase(base, alerts, "event_type", "v").withColumnRenamed("v", "new_base")
    return alerts.join(renewed, "event_type")


def ranking(t, d):
    counts = t.events.filter(day() == F.lit(d).cast("date")).groupBy("user_id").agg(F.count("*").alias("n"))
    places = range_parts(counts.select("user_id", (F.col("user_id") % 2).alias("os"), (-F.col("n")).alias("__less")), ["os", "__less", "user_id"])
    ranked = split_window(places, "os", ["__less", "user_id"], F.col("__part"), {"ranking": ("row_number", None)})
    return ranked.select("user_id", "os", F.col("ranking").cast("int").alias("ranking"))


RANKS = """r AS (SELECT day, user_id, user_id % 2 AS os, row_number() OVER (PARTITION BY day, user_id % 2 ORDER BY n DESC, user_id) AS rk FROM (SELECT cast(ts AS DATE) AS day, user_id, count(*) AS n FROM events GROUP BY 1, 2)),
  a AS (SELECT user_id, os, cast(rk AS INTEGER) AS today_rank FROM r WHERE day = DATE '2024-01-21' AND rk <= 50), b AS (SELECT user_id, os, cast(rk AS INTEGER) AS yesterday_rank FROM r WHERE day = DATE '2024-01-20' AND rk <= 50),
  m AS (SELECT user_id, os, today_rank, yesterday_rank, abs(today_rank - yesterday_rank) AS rank_change, CASE WHEN today_rank IS NULL THEN 'out of ranking' WHEN yesterday_rank IS NULL THEN 'new in ranking'
        WHEN today_rank > yesterday_rank THEN 'drop' WHEN today_rank < yesterday_rank THEN 'up' ELSE 'same rank' END AS rank_status FROM a FULL JOIN b USING (user_id, os))"""


@query(f"WITH {RANKS} SELECT * FROM m WHERE today_rank <= 50 AND rank_change >= 5")
def rank_movement(t):
    return N.rank_movement(ranking(t, "2024-01-21"), ranking(t, "2024-01-20"), ["user_id", "os"], "ranking", top=50)


@query(f"WITH {RANKS} SELECT * FROM m")
def rank_labels(t):
    return N.rank_labels(ranking(t, "2024-01-21"), ranking(t, "2024-01-20"), ["user_id", "os"], "ranking", top=50)


@query("""WITH s AS (SELECT o_orderpriority, o_custkey, cast(sum(cast(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) AS total FROM orders WHERE cast(o_orderdate AS DATE) BETWEEN DATE '2000-06-01' AND DATE '2000-06-30' GROUP BY 1, 2)
          SELECT * FROM (SELECT *, cast(row_number() OVER (PARTITION BY o_orderpriority ORDER BY total DESC, o_custkey) AS INTEGER) AS ranking FROM s) WHERE ranking <= 10""")
def daily_ranking(t):
    o = t.orders.withColumn("price", money("o_totalprice"))
    out = N.daily_ranking(o, "o_orderpriority", "o_custkey", "o_orderdate", "price", F.lit("2000-06-30").cast("date"), 30, 10)
    return out.withColumn("total", F.col("total").cast("double"))


@query("""WITH m AS (SELECT event_type, cast(ts AS DATE) AS day, cast(sum(cast(value AS DECIMAL(14,2))) AS DOUBLE) AS revenue, count(*) AS copies FROM events GROUP BY 1, 2),
               p AS (SELECT *, lag(revenue) OVER w AS revenue_prev, lag(copies) OVER w AS copies_prev FROM m WINDOW w AS (PARTITION BY event_type ORDER BY day))
          SELECT event_type, day, 'revenue_jump' AS rule, event_type || ' grew to ' || copies AS message FROM p WHERE (revenue - revenue_prev) / revenue_prev > 0.3 AND revenue > 1000
          UNION ALL SELECT event_type, day, 'copies_jump', 'from ' || copies_prev || ' to ' || copies || '!' FROM p WHERE copies > 20 AND (copies - copies_prev) / copies_prev > 0.3""")
def rule_filter(t):
    m = t.events.groupBy("event_type", day().alias("day")).agg(F.sum(money("value")).cast("double").alias("revenue"), F.count("*").alias("copies"))
    rules = [
        {"name": "revenue_jump", "condition": "revenue_delta_pct > 0.3 AND revenue > 1000 AND revenue_prev IS NOT NULL", "message": "{event_type} grew to {copies}"},
        {"name": "copies_jump", "condition": "copies > 20 AND copies_delta_pct > 0.3", "message": "from {copies_prev} to {copies}!"},
    ]
    return N.apply_rules(period_deltas(m, "event_type", "day", ["revenue", "copies"]), rules).select("event_type", "day", "rule", "message")


@query("""WITH m AS (SELECT user_id, cast(ts AS DATE) AS day, arg_max(event_type, (ts, event_id)) AS event_type, arg_max(value, (ts, event_id)) AS value FROM events WHERE ts >= TIMESTAMP '2024-01-20' AND ts < TIMESTAMP '2024-01-22' GROUP BY 1, 2),
               l AS (SELECT user_id, string_agg(DISTINCT json_extract_string(props, '$.k'), '|' ORDER BY json_extract_string(props, '$.k')) AS links FROM events WHERE event_type = 'error' GROUP BY 1)
          SELECT m.user_id, day, event_type, value, links, c_name FROM m LEFT JOIN l USING (user_id) LEFT JOIN customer ON c_custkey = m.user_id""")
def message_dedupe_digest(t):
    e = t.events.select("user_id", day().alias("day"), "ts", "event_id", "event_type", "value")
    links = t.events.filter("event_type = 'error'").select("user_id", F.get_json_object("props", "$.k").alias("link"))
    users = t.customer.select(F.col("c_custkey").alias("user_id"), "c_name")
    out = N.message_digest(e, ["user_id", "day"], ["ts", "event_id"], "ts", "2024-01-22", 2, links, ["user_id"], users, "user_id")
    return out.select("user_id", "day", "event_type", "value", F.replace("links", F.lit("\n"), F.lit("|")).alias("links"), "c_name")
