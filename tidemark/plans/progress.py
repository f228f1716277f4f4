"""Runs, attempts, inventories and catalogs."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import progress as G
from ..operators.aggregates import money
from .registry import query


def day():
    return F.to_date("ts")


def hour():
    return F.date_trunc("hour", "ts")


@query("""WITH e AS (SELECT user_id, cast(ts AS DATE) AS day, event_type, value, ts, event_id FROM events WHERE event_type <> 'error')
          SELECT user_id, day, min(ts) FILTER (event_type = 'signup') AS start_ts, coalesce(arg_min(value, (ts, event_id)) FILTER (event_type = 'signup'), arg_min(value, (ts, event_id)) FILTER (event_type = 'view')) AS power,
                 arg_min(value, (ts, event_id)) FILTER (event_type = 'click') AS bonus,
                 CASE WHEN count(*) FILTER (event_type = 'purchase') = 0 THEN 'UNDETECTED' ELSE arg_min(CASE WHEN value > 30 THEN 'SUCCESS' ELSE 'FAIL' END, (ts, event_id)) FILTER (event_type = 'purchase') END AS status
          FROM e GROUP BY 1, 2 HAVING count(*) FILTER (event_type = 'signup') > 0""")
def paired_event_fact(t):
    e = t.events.withColumns({"day": day(), "result": F.when(F.col("value") > 30, "SUCCESS").otherwise("FAIL")})
    specs = {
        "signup": {"start_ts": "ts", "power": "value"},
        "view": {"power": "value"},
        "purchase": {"status": "result"},
        "click": {"bonus": "value"},
    }
    return G.pair_events(e, ["user_id", "day"], "event_type", ["ts", "event_id"], specs, ["purchase"])


@query("""WITH e AS (SELECT user_id, cast(json_extract_string(props, '$.k') AS BIGINT) // 20 AS stage, ts, event_id, event_type = 'purchase' AS win, cast(value AS DECIMAL(14,2)) AS v FROM events),
               r AS (SELECT *, row_number() OVER w AS n, sum(v) OVER w AS total FROM e WINDOW w AS (PARTITION BY user_id, stage ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
               f AS (SELECT user_id, stage, min(n) AS n FROM r WHERE win GROUP BY 1, 2), d AS (SELECT user_id, min(cast(ts AS DATE)) AS d0 FROM events GROUP BY 1)
          SELECT k.user_id, k.stage, f.n AS attempts_to_win, cast(r.total AS DOUBLE) AS total_to_win, cast(cast(r.ts AS DATE) - d0 AS BIGINT) AS days_to_win
          FROM (SELECT DISTINCT user_id, stage FROM e) k LEFT JOIN f USING (user_id, stage) LEFT JOIN r ON r.user_id = k.user_id AND r.stage = k.stage AND r.n = f.n JOIN d ON d.user_id = k.user_id""")
def attempts_to_first_win(t):
    e = t.events.withColumn("stage", F.floor(F.get_json_object("props", "$.k").cast("bigint") / 20))
    day0 = e.groupBy("user_id").agg(F.min(day()).alias("day0"))
    out = G.attempts_to_win(e, ["user_id", "stage"], "ts", "event_id", F.col("event_type") == "purchase", money("value"), day0, "day0", hour())
    return out.withColumn("total_to_win", F.col("total_to_win").cast("double"))


@query("""SELECT user_id, cast(sum(n) AS BIGINT) AS clicks FROM (SELECT user_id, CASE WHEN event_type = 'click' THEN 1 ELSE 0 END AS n, coalesce(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END)
            OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS done, max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id) AS ever FROM events)
          WHERE done = 0 AND ever = 1 GROUP BY 1""")
def attempts_to_win(t):
    from ..operators.windows import cumulative_until

    clicks = {"clicks": F.when(F.col("event_type") == "click", 1).otherwise(0)}
    return cumulative_until(t.events, "user_id", ["ts", "event_id"], F.col("event_type") == "purchase", clicks, hour()).select("user_id", "clicks")


@query("""WITH e AS (SELECT event_id, user_id, event_type AS stage, ts, cast(ts AS DATE) AS day, event_id AS played, value > 40 AS win FROM events)
          SELECT event_id, dense_rank() OVER (PARTITION BY user_id, stage ORDER BY ts) AS attempt, cast(sum(CASE WHEN win THEN 1 ELSE 0 END) OVER (PARTITION BY user_id, stage ORDER BY ts) AS BIGINT) AS wins,
                 coalesce(played - lag(played) OVER (PARTITION BY user_id, stage, day ORDER BY ts, event_id), played) AS played_increment FROM e""")
def level_mart(t):
    e = t.events.select("event_id", "user_id", F.col("event_type").alias("stage"), "ts", day().alias("day"), F.col("event_id").alias("played"), "value")
    out = G.progress_mart(e, "user_id", "stage", "ts", "event_id", F.col("value") > 40, "played", ["user_id", "stage", "day"], hour())
    return out.select("event_id", "attempt", "wins", "played_increment")


@query("""SELECT event_id, user_id, event_type, CASE WHEN event_type = 'purchase' THEN value END AS price, CASE WHEN event_type IN ('purchase', 'click') THEN cast(json_extract_string(props, '$.k') AS BIGINT) END AS item,
                 CASE WHEN event_type = 'view' THEN 'seen' END AS note, cast(NULL AS VARCHAR) AS reserved FROM events WHERE event_type IN ('purchase', 'click', 'view')""")
def conform_event_variants(t):
    item = F.get_json_object("props", "$.k")
    specs = {"purchase": {"price": F.col("value"), "item": item}, "click": {"item": item}, "view": {"note": F.lit("seen")}}
    return G.conform(t.events, "event_type", ["event_id", "user_id"], specs, {"price": "double", "item": "bigint", "note": "string", "reserved": "string"})


@query("""WITH m AS (SELECT *, max(l_shipdate) OVER (PARTITION BY l_partkey, l_suppkey) AS last FROM lineitem)
          SELECT l_partkey, l_suppkey, l_shipdate, max(l_quantity) AS l_quantity, max(l_extendedprice) AS l_extendedprice FROM m WHERE l_shipdate = last GROUP BY 1, 2, 3""")
def current_balance(t):
    return G.current_balance(t.lineitem, ["l_partkey", "l_suppkey"], "l_shipdate", ["l_quantity", "l_extendedprice"])


@query("""SELECT l_partkey, max(l_shipdate) AS l_shipdate, max(l_quantity) AS l_quantity FROM lineitem WHERE cast(l_shipdate AS DATE) = DATE '1998-05-05' GROUP BY 1""")
def balance_updates_by_day(t):
    return G.balance_updates_of_day(t.lineitem, ["l_partkey"], "l_shipdate", ["l_quantity"], F.lit("1998-05-05").cast("date"))


@query("""SELECT l_orderkey, l_linenumber, l_returnflag, CASE l_returnflag WHEN 'A' THEN p_name WHEN 'R' THEN s_name END AS label, CASE WHEN l_returnflag = 'A' THEN p_brand END AS brand
          FROM lineitem LEFT JOIN (SELECT * REPLACE (CASE WHEN p_size < 40 THEN p_partkey ELSE -p_partkey END AS p_partkey) FROM part) ON p_partkey = l_partkey LEFT JOIN supplier ON s_suppkey = l_partkey
          WHERE NOT (l_returnflag = 'A' AND p_partkey IS NULL)""")
def enrich_by_type_union(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_returnflag", "l_partkey")
    parts = t.part.select(F.when(F.col("p_size") < 40, F.col("p_partkey")).otherwise(-F.col("p_partkey")).alias("p_partkey"), F.col("p_name").alias("label"), F.col("p_brand").alias("brand"))
    routes = {"A": (parts, "p_partkey", ["label", "brand"]), "R": (t.supplier.select("s_suppkey", F.col("s_name").alias("label")), "s_suppkey", ["label"])}
    return G.route_enrich(lines, "l_returnflag", "l_partkey", routes, ["label", "brand"], required=["A"]).drop("l_partkey")


@query("""WITH c AS (SELECT DISTINCT replace(p_name, ' ', '_') AS code FROM part),
               i AS (SELECT code, split_part(code, '_', 1) AS item_group, upper(split_part(code, '_', 2)) AS item_name, CASE WHEN code LIKE '%bolt' THEN 3 WHEN code LIKE '%ring' THEN 2 WHEN code LIKE '%e%' THEN 1 ELSE 0 END AS rarity_rank FROM c)
          SELECT *, max(rarity_rank) OVER (PARTITION BY item_group) AS group_rarity_rank, CASE max(rarity_rank) OVER (PARTITION BY item_group) WHEN 3 THEN 'epic' WHEN 2 THEN 'rare' WHEN 1 THEN 'common' END AS group_rarity FROM i""")
def catalog_dimension(t):
    log = t.lineitem.join(t.part, F.col("l_partkey") == F.col("p_partkey")).select(F.concat(F.replace("p_name", F.lit(" "), F.lit("_")), F.lit("-"), "l_linenumber").alias("code"))
    code = F.col("code")
    return G.catalog_dim(log, "code", F.split_part(code, F.lit("_"), F.lit(1)), F.upper(F.split_part(code, F.lit("_"), F.lit(2))),
                         [(code.like("%bolt"), 3), (code.like("%ring"), 2), (code.like("%e%"), 1)], {3: "epic", 2: "rare", 1: "common"})


@query("""WITH u AS (SELECT *, user_id || '-' || cast(json_extract_string(props, '$.k') AS BIGINT) // 50 AS trace FROM events),
               d AS (SELECT DISTINCT trace FROM (SELECT trace, value, coalesce(lag(value) OVER (PARTITION BY user_id ORDER BY ts, trace), 0) AS p FROM u WHERE event_type = 'click') WHERE value < p),
               w AS (SELECT * FROM u WHERE ts BETWEEN TIMESTAMP '2024-01-19' AND TIMESTAMP '2024-01-20'),
               e AS (SELECT DISTINCT user_id, trace, event_type AS item, 1 AS amount, 'client' AS source FROM w WHERE value > 30 UNION SELECT DISTINCT user_id, trace, event_type, 2, 'server' FROM w WHERE value > 60 AND trace IN (SELECT trace FROM d))
          SELECT user_id, trace, cast(sum(amount) AS BIGINT) AS total, string_agg(DISTINCT source, ',' ORDER BY source) AS sources, count(*) AS evidence FROM e GROUP BY 1, 2 HAVING sum(amount) >= 3""")
def multi_unlock_detector(t):
    half = F.expr("cast(get_json_object(props, '$.k') AS BIGINT) div 50").cast("string")
    u = t.events.select("user_id", "ts", "event_type", "value", F.concat(F.col("user_id").cast("string"), F.lit("-"), half).alias("trace"), F.col("event_type").alias("item"))
    consumed = G.consuming_traces(u.filter("event_type = 'click'"), ["user_id"], "ts", "value", "trace", hour())
    client, server = u.filter("value > 30").withColumn("amount", F.lit(1)), u.filter("value > 60").withColumn("amount", F.lit(2))
    return G.multi_unlock(client, server, consumed, ["user_id", "trace"], "trace", "item", "amount", "ts", "2024-01-20 00:00:00", 1440, 3)
