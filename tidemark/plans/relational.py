"""Projections, joins, aggregations, windows and set operations over the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import nested as N
from ..operators import aggregates as A
from ..operators import joins as J
from ..operators import projections as P
from ..operators import sets as S
from ..operators import windows as W
from ..operators.aggregates import money
from .registry import query


def day():
    return F.to_date("ts")


def hour():
    return F.date_trunc("hour", "ts")


def order_month():
    return F.trunc("o_orderdate", "month")


# ---- projections and filters

@query("SELECT p_partkey AS x_p_partkey, p_name AS x_p_name, p_size AS x_p_size, p_retailprice AS x_p_retailprice FROM part")
def star_projection(t):
    return P.star(t.part, except_=["P_BRAND", "p_type"], prefix="x_")


@query("SELECT o_orderkey, o_custkey, lower(o_orderstatus) AS o_orderstatus, o_totalprice * 2 AS o_totalprice FROM orders")
def select_except_replace(t):
    return P.except_replace(t.orders, ["o_orderdate", "o_orderpriority"],
                            {"o_orderstatus": F.lower("o_orderstatus"), "o_totalprice": F.col("o_totalprice") * 2})


@query("SELECT l_orderkey, l_linenumber, l_quantity FROM lineitem")
def select_filtered_columns(t):
    return t.lineitem.select(P.filtered_columns(t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity", "l_tax"), ["L_TAX"]))


@query("""SELECT p_partkey, nullif(CASE WHEN p_size > 25 THEN '' ELSE p_name END, '') AS p_name, p_size FROM part""")
def nullcheck_columns(t):
    return P.nullcheck(t.part.select("p_partkey", F.when(F.col("p_size") > 25, "").otherwise(F.col("p_name")).alias("p_name"), "p_size"))


@query("""SELECT p_partkey, CASE WHEN p_type IN ('SMALL', 'ECONOMY') THEN NULL ELSE p_type END AS p_type, CASE WHEN p_brand IN ('SMALL', 'ECONOMY') THEN NULL ELSE p_brand END AS p_brand FROM part""")
def null_sentinels(t):
    return P.null_sentinels(t.part.select("p_partkey", "p_type", "p_brand"), ["p_type", "p_brand"], ["SMALL", "ECONOMY"])


@query("""SELECT event_id AS id, upper(event_type) AS kind, cast(floor(value) AS INTEGER) AS amount_floor, try_cast(json_extract_string(props, '$.k') AS INTEGER) AS k,
                 try_cast(event_type AS BIGINT) AS bad, cast(ts AS DATE) AS day FROM events""")
def typed_staging_projection(t):
    raw = t.events.select(*[F.col(c).cast("string").alias(c) for c in ("event_id", "ts", "event_type", "props")], F.floor("value").alias("value"))
    raw = raw.withColumn("k", F.get_json_object("props", "$.k"))
    return P.stage(raw, {"id": ("event_id", "bigint"), "kind": ("event_type", "upper"), "amount_floor": ("value", "int"), "k": ("k", "try_int"),
                         "bad": ("event_type", "try_bigint"), "day": F.col("ts").cast("timestamp_ntz").cast("date")})


@query("""SELECT CASE WHEN p_name LIKE 'red%' THEN 'red' WHEN regexp_matches(p_name, '(bolt|ring)$') THEN 'hardware' WHEN p_type = 'SMALL' THEN 'small' ELSE 'other' END AS class,
                 count(*) AS n FROM part GROUP BY 1""")
def case_classification(t):
    name = F.col("p_name")
    rule = P.classify([(name.like("red%"), "red"), (name.rlike("(bolt|ring)$"), "hardware"), (F.col("p_type") == "SMALL", "small")], "other")
    return t.part.groupBy(rule.alias("class")).agg(F.count("*").alias("n"))


@query("""SELECT event_id, ts FROM events WHERE ts >= DATE '2024-01-13' AND ts < DATE '2024-01-20'""")
def relative_date_filter(t):
    return P.last_n_days(t.events, "ts", "2024-01-20", 7, include_today=False).select("event_id", "ts")


@query("""SELECT c_custkey FROM customer WHERE lower(c_mktsegment) IN ('building', 'machinery')
          AND lower(c_name) IN (SELECT lower(replace(s_name, 'Supplier', 'CUSTOMER')) FROM supplier)""")
def case_insensitive_in(t):
    listed = t.customer.filter(P.in_ci("c_mktsegment", ["Building", "MACHINERY"]))
    names = t.supplier.select(F.replace("s_name", F.lit("Supplier"), F.lit("CUSTOMER")).alias("name"))
    return P.in_ci_table(listed, "c_name", names, "name").select("c_custkey")


@query("""SELECT p_partkey, p_name FROM part WHERE NOT (p_name LIKE 'red%' OR p_name LIKE '%bolt' OR p_name LIKE '%ue%')""")
def regex_exclusion_list(t):
    words = t.part.select(F.split("p_name", " ").alias("w"))
    first = words.select(F.lit("prefix").alias("kind"), F.col("w")[0].alias("text")).filter("text = 'red'")
    last = words.select(F.lit("suffix").alias("kind"), F.col("w")[1].alias("text")).filter("text = 'bolt'")
    inner = words.select(F.lit("contains").alias("kind"), F.substring(F.col("w")[0], 3, 2).alias("text")).filter("text = 'ue'")
    return P.exclude_matching(t.part.select("p_partkey", "p_name"), "p_name", first.union(last).union(inner).distinct())


@query("""SELECT o_orderkey, o_custkey FROM (SELECT *, max(o_orderdate) OVER (PARTITION BY o_custkey) AS m FROM orders) WHERE o_orderdate = m""")
def row_filter_by_group_max(t):
    return W.keep_group_max(t.orders.select("o_orderkey", "o_custkey", "o_orderdate"), "o_custkey", "o_orderdate").select("o_orderkey", "o_custkey")


# ---- joins

@query("""SELECT c_mktsegment, count(*) AS n, count(DISTINCT o_custkey) AS buyers FROM orders JOIN customer ON o_custkey = c_custkey GROUP BY 1""")
def join_inner(t):
    per_buyer = t.orders.groupBy("o_custkey").agg(F.count("*").alias("k"))
    return per_buyer.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).groupBy("c_mktsegment").agg(F.sum("k").alias("n"), F.count("*").alias("buyers"))


@query("""SELECT c_custkey, n_name, r_name, coalesce(k, 0) AS orders FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey LEFT JOIN region ON n_regionkey = r_regionkey
          LEFT JOIN (SELECT o_custkey, count(*) AS k FROM orders GROUP BY 1) ON o_custkey = c_custkey""")
def join_left(t):
    k = t.orders.groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count("*").alias("k"))
    places = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"), "left")
    return t.customer.join(places, F.col("c_nationkey") == F.col("n_nationkey"), "left").join(k, "c_custkey", "left").select(
        "c_custkey", "n_name", "r_name", F.coalesce("k", F.lit(0)).alias("orders"))


@query("""WITH s AS (SELECT CASE WHEN s_nationkey > 12 THEN s_nationkey END AS k, count(*) AS suppliers FROM supplier GROUP BY 1),
               c AS (SELECT CASE WHEN c_nationkey > 10 THEN c_nationkey END AS k, count(*) AS customers FROM customer GROUP BY 1)
          SELECT c.k AS k, suppliers, customers FROM s RIGHT JOIN c ON s.k IS NOT DISTINCT FROM c.k""")
def join_right(t):
    s = t.supplier.groupBy(F.when(F.col("s_nationkey") > 12, F.col("s_nationkey")).alias("k")).agg(F.count("*").alias("suppliers"))
    c = t.customer.groupBy(F.when(F.col("c_nationkey") > 10, F.col("c_nationkey")).alias("k")).agg(F.count("*").alias("customers"))
    return J.null_safe_join(s, c, "k", "right")


@query("""WITH a AS (SELECT CASE WHEN c_acctbal < 500 THEN c_nationkey ELSE c_nationkey + 20 END AS k, count(*) AS customers FROM customer GROUP BY 1),
               b AS (SELECT s_nationkey AS k, count(*) AS suppliers FROM supplier GROUP BY 1)
          SELECT k, customers, suppliers FROM a FULL JOIN b USING (k)""")
def join_full_using(t):
    a = t.customer.groupBy(F.when(F.col("c_acctbal") < 500, F.col("c_nationkey")).otherwise(F.col("c_nationkey") + 20).alias("k")).agg(F.count("*").alias("customers"))
    b = t.supplier.groupBy(F.col("s_nationkey").alias("k")).agg(F.count("*").alias("suppliers"))
    return a.join(b, "k", "full_outer")


@query("""WITH a AS (SELECT cast(date_trunc('month', o_orderdate) AS DATE) AS month, substr(o_orderpriority, 1, 1) AS class, cast(sum(cast(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) AS revenue
                     FROM orders GROUP BY 1, 2),
               b AS (SELECT cast(date_trunc('month', l_shipdate) AS DATE) AS month, cast(l_linenumber AS VARCHAR) AS class, cast(sum(cast(l_tax AS DECIMAL(14,2))) AS DOUBLE) AS tax
                     FROM lineitem GROUP BY 1, 2)
          SELECT month, class, coalesce(revenue, 0.0) AS revenue, coalesce(tax, 0.0) AS tax FROM a FULL JOIN b USING (month, class)""")
def full_join_zero_fill(t):
    a = t.orders.groupBy(order_month().alias("month"), F.substring("o_orderpriority", 1, 1).alias("class")).agg(F.sum(money("o_totalprice")).cast("double").alias("revenue"))
    b = t.lineitem.groupBy(F.trunc("l_shipdate", "month").alias("month"), F.col("l_linenumber").cast("string").alias("class")).agg(
        F.sum(money("l_tax")).cast("double").alias("tax"))
    return J.full_join_zero_fill(a, b, ["month", "class"], ["revenue", "tax"])


@query("""WITH k AS (SELECT DISTINCT o_custkey AS k FROM orders UNION SELECT l_suppkey FROM lineitem UNION SELECT p_partkey FROM part)
          SELECT k, coalesce(a.n, 0) AS orders, coalesce(b.n, 0) AS lines, coalesce(c.n, 0) AS sizes FROM k
          LEFT JOIN (SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1) a ON a.o_custkey = k LEFT JOIN (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1) b ON b.l_suppkey = k
          LEFT JOIN (SELECT p_partkey, cast(p_size AS BIGINT) AS n FROM part) c ON c.p_partkey = k""")
def join_full_chain(t):
    return J.full_join_many({
        "orders": t.orders.groupBy(F.col("o_custkey").alias("k")).agg(F.count("*").alias("n")),
        "lines": t.lineitem.groupBy(F.col("l_suppkey").alias("k")).agg(F.count("*").alias("n")),
        "sizes": t.part.select(F.col("p_partkey").alias("k"), F.col("p_size").cast("bigint").alias("n")),
    }, "k", "n")


@query("""SELECT c_custkey, c_acctbal - (SELECT cast(max(cast(c_acctbal AS DECIMAL(14,2))) AS DOUBLE) FROM customer) AS below_best,
                 (SELECT count(*) FROM supplier) AS suppliers FROM customer""")
def join_cross(t):
    best = t.customer.agg(F.max(money("c_acctbal")).cast("double"))
    return t.customer.select("c_custkey", (F.col("c_acctbal") - best.scalar()).alias("below_best"), t.supplier.agg(F.count("*")).scalar().alias("suppliers"))


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'P') ")
def join_semi_in(t):
    return t.customer.join(t.orders.filter("o_orderstatus = 'P'"), F.col("c_custkey") == F.col("o_custkey"), "left_semi").select("c_custkey")


@query("""SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_partkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 3000) OR l_suppkey IN (SELECT s_suppkey FROM supplier WHERE s_acctbal < 3000)""")
def join_semi_either(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")
    poor = t.supplier.filter("s_acctbal < 3000")
    return J.either_endpoint_in(lines, ["l_partkey", "l_suppkey"], poor, "s_suppkey", ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey"]).select("l_orderkey", "l_linenumber")


@query("SELECT c_custkey FROM customer WHERE c_custkey NOT IN (SELECT o_custkey FROM orders WHERE o_orderstatus = 'F')")
def join_anti_not_in(t):
    return J.not_in(t.customer.select("c_custkey"), t.orders.filter("o_orderstatus = 'F'"), "c_custkey", "o_custkey")


@query("SELECT d.doc_id, d.source FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id WHERE l.doc_id IS NULL")
def join_anti_left_null(t):
    return t.documents.join(t.labels, "doc_id", "left_anti").select("doc_id", "source")


@query("""WITH a AS (SELECT n_nationkey AS k, n_name, n_regionkey AS r FROM nation), b AS (SELECT c_nationkey AS k, c_nationkey % 5 AS r, c_custkey FROM customer)
          SELECT k, r, n_name, c_custkey FROM a NATURAL JOIN b""")
def join_natural(t):
    a = t.nation.select(F.col("n_nationkey").alias("k"), "n_name", F.col("n_regionkey").alias("r"))
    b = t.customer.select(F.col("c_nationkey").alias("k"), (F.col("c_nationkey") % 5).alias("r"), "c_custkey")
    return J.natural_join(a, b)


@query("""WITH v AS (SELECT user_id, ts AS valid_from, value AS signup_value, lead(ts) OVER (PARTITION BY user_id ORDER BY ts) AS nxt FROM events WHERE event_type = 'signup')
          SELECT e.event_id, e.user_id, valid_from, signup_value FROM events e JOIN v ON v.user_id = e.user_id AND e.ts > v.valid_from AND e.ts < coalesce(v.nxt, TIMESTAMP '9999-12-31')
          WHERE e.event_type = 'purchase'""")
def asof_validity(t):
    e = t.events
    versions = e.filter("event_type = 'signup'").select("user_id", F.col("ts").alias("start"), F.col("value").alias("signup_value"))
    buys = e.filter("event_type = 'purchase'").select("event_id", "user_id", "ts")
    return J.asof_validity_join(buys, versions, "user_id", "ts", "start", ["signup_value"], "event_id", hour()).drop("ts")


@query("""WITH r AS (SELECT o_orderpriority AS label, cast(min(o_orderdate) AS DATE) AS a, cast(min(o_orderdate) AS DATE) + 40 AS b FROM orders GROUP BY 1
                     UNION ALL SELECT 'open', DATE '2001-06-01', DATE '9999-12-31'),
               d AS (SELECT cast(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1)
          SELECT label, d, n FROM d JOIN r ON d BETWEEN a AND b""")
def join_range_between(t):
    first = F.to_date(F.min("o_orderdate"))
    r = t.orders.groupBy(F.col("o_orderpriority").alias("label")).agg(first.alias("a"), F.date_add(first, 40).alias("b"))
    last = t.orders.agg(F.lit("open").alias("label"), F.lit("2001-06-01").cast("date").alias("a"), F.lit("9999-12-31").cast("date").alias("b"))
    days = t.orders.groupBy(F.to_date("o_orderdate").alias("d")).agg(F.count("*").alias("n"))
    return J.range_join(days, r.union(last), "d", "a", "b").select("label", "d", "n")


@query("""WITH r AS (SELECT event_type AS label, min(ts) AS a, min(ts) + INTERVAL 90 MINUTE AS b FROM events GROUP BY 1
                     UNION ALL SELECT 'error ' || event_id, ts, ts + to_seconds(cast(user_id AS BIGINT)) FROM events WHERE event_type = 'error' AND value > 50
                     UNION ALL SELECT 'since', TIMESTAMP '2024-01-29 12:00:00.000001', NULL UNION ALL SELECT 'until', NULL, TIMESTAMP '2024-01-02' UNION ALL SELECT 'always', NULL, NULL
                     UNION ALL SELECT 'centuries', TIMESTAMP '1700-01-01', TIMESTAMP '2500-01-01' UNION ALL SELECT 'never', TIMESTAMP '1990-01-01', TIMESTAMP '1990-01-02')
          SELECT label, count(*) AS n, cast(sum(event_id) AS BIGINT) AS ids FROM events JOIN r ON (a IS NULL OR ts >= a) AND (b IS NULL OR ts <= b) GROUP BY 1""")
def join_range_timestamps(t):
    """Events in ranges of seconds and of centuries, some with open ends."""
    e = t.events
    first = e.groupBy(F.col("event_type").alias("label")).agg(F.min("ts").alias("a")).withColumn("b", F.col("a") + F.expr("INTERVAL 90 MINUTES"))
    errors = e.filter("event_type = 'error' AND value > 50").select(F.concat(F.lit("error "), "event_id").alias("label"), F.col("ts").alias("a"), (F.col("ts") + F.expr("make_dt_interval(0, 0, 0, user_id)")).alias("b"))
    at = lambda x: F.lit(x).cast("timestamp_ntz")
    fixed = [("since", "2024-01-29 12:00:00.000001", None), ("until", None, "2024-01-02"), ("always", None, None), ("centuries", "1700-01-01", "2500-01-01"), ("never", "1990-01-01", "1990-01-02")]
    ranges = first.union(errors)
    for label, a, b in fixed:
        ranges = ranges.union(e.agg(F.lit(label).alias("label"), at(a).alias("a"), at(b).alias("b")))
    hits = J.range_join(e.select("event_id", "ts"), ranges, "ts", "a", "b", totals={"ids": "event_id"})
    return hits.groupBy("label").agg(F.sum("n").alias("n"), F.sum("ids").alias("ids"))


@query("""WITH w AS (SELECT DISTINCT split_part(p_name, ' ', 2) AS w, 'kind' AS tag FROM part UNION ALL SELECT 'd b', 'gap')
          SELECT p_partkey, w, tag FROM part LEFT JOIN w ON p_name LIKE '%' || w || '%'""")
def join_like_pattern(t):
    words = t.part.select(F.split_part("p_name", F.lit(" "), F.lit(2)).alias("w"), F.lit("kind").alias("tag")).distinct()
    gap = t.part.agg(F.lit("d b").alias("w"), F.lit("gap").alias("tag"))
    return J.like_join(t.part, words.union(gap), "p_name", "w").select("p_partkey", "w", "tag")


@query("""WITH d AS (SELECT DISTINCT user_id, cast(ts AS DATE) AS day FROM events), r AS (SELECT user_id, day, cast(day - DATE '2024-01-01' AS INTEGER) AS r FROM d)
          SELECT c.user_id, c.r FROM r c LEFT JOIN r p ON p.user_id = c.user_id AND p.r = c.r - 1 WHERE p.user_id IS NULL""")
def join_self_previous(t):
    days = t.events.select("user_id", F.datediff(day(), F.lit("2024-01-01").cast("date")).alias("r")).distinct()
    return J.self_prev_join(days, "user_id", "r", F.lit(True))


@query("""WITH x AS (SELECT user_id, ts, event_id, event_type, sum(CASE WHEN event_type = 'click' THEN 1 ELSE 0 END) OVER w AS clicks, sum(cast(value AS DECIMAL(14,2))) OVER w AS spent
                     FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING)),
               f AS (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS rn FROM x WHERE event_type = 'purchase')
          SELECT user_id, ts, event_id, cast(clicks AS BIGINT) AS clicks, cast(spent AS DOUBLE) AS spent FROM f WHERE rn = 1""")
def cumulative_until_success(t):
    measures = {"clicks": F.when(F.col("event_type") == "click", 1).otherwise(0), "spent": money("value")}
    out = W.cumulative_until(t.events, "user_id", ["ts", "event_id"], F.col("event_type") == "purchase", measures, bucket=hour())
    return out.withColumn("spent", F.col("spent").cast("double"))


@query("""WITH d AS (SELECT user_id, cast(ts AS DATE) AS day, count(*) AS n FROM events WHERE cast(ts AS DATE) IN (DATE '2024-01-10', DATE '2024-01-11') GROUP BY 1, 2)
          SELECT user_id, max(CASE WHEN day = DATE '2024-01-11' THEN n END) AS n_today, max(CASE WHEN day = DATE '2024-01-10' THEN n END) AS n_before FROM d GROUP BY 1""")
def join_day_over_day(t):
    daily = t.events.groupBy("user_id", day().alias("day")).agg(F.count("*").alias("n"))
    return J.day_over_day(daily, "user_id", "day", "n", F.lit("2024-01-11").cast("date"), F.lit("2024-01-10").cast("date"))


@query("""SELECT p_partkey, w FROM (SELECT p_partkey, unnest(string_split(p_name, ' ')) AS w FROM part WHERE p_size > 10) UNION ALL SELECT p_partkey, NULL FROM part WHERE p_size <= 10""")
def join_correlated_unnest(t):
    words = F.when(F.col("p_size") > 10, F.split("p_name", " ")).otherwise(F.array().cast("array<string>"))
    return t.part.select("p_partkey", F.explode_outer(words).alias("w"))


@query("""SELECT n.n_nationkey, n.n_name AS name, r.n AS customers, s.n AS n_suppliers FROM nation n LEFT JOIN (SELECT c_nationkey, count(*) AS n FROM customer GROUP BY 1) r ON c_nationkey = n_nationkey
          LEFT JOIN (SELECT s_nationkey, count(*) AS n FROM supplier GROUP BY 1) s ON s_nationkey = n_nationkey""")
def join_report_parts(t):
    base = t.nation.select("n_nationkey", F.col("n_name").alias("name"))
    parts = {
        "customers": t.customer.groupBy(F.col("c_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n")),
        "suppliers": t.supplier.groupBy(F.col("s_nationkey").alias("n_nationkey")).agg(F.count("*").alias("n")),
    }
    return J.join_parts(base, parts, "n_nationkey").withColumnRenamed("n", "customers")


@query("""SELECT o_orderkey, CASE o_orderstatus WHEN 'F' THEN 'finished' WHEN 'O' THEN 'open' ELSE 'n/a' END AS status FROM orders""")
def derived_literal_dimension(t):
    return J.code_lookup(t.orders, "o_orderstatus", {"F": "finished", "O": "open"}, "status", "n/a").select("o_orderkey", "status")


# ---- aggregations

@query("""SELECT l_returnflag, l_linestatus, count(*) AS n, cast(sum(cast(l_quantity AS DECIMAL(14,2))) AS DOUBLE) AS qty, min(l_shipdate) AS first_ship, max(l_shipdate) AS last_ship,
                 cast(sum(cast(l_extendedprice AS DECIMAL(14,2))) AS DOUBLE) / count(l_extendedprice) AS avg_price FROM lineitem GROUP BY ALL""")
def agg_group(t):
    price = money("l_extendedprice")
    return t.lineitem.groupBy("l_returnflag", "l_linestatus").agg(
        F.count("*").alias("n"), F.sum(money("l_quantity")).cast("double").alias("qty"), F.min("l_shipdate").alias("first_ship"), F.max("l_shipdate").alias("last_ship"),
        (F.sum(price).cast("double") / F.count("l_extendedprice")).alias("avg_price"))


@query("SELECT cast(ts AS DATE) AS day, event_type, count(DISTINCT user_id) AS users FROM events GROUP BY 1, 2")
def agg_count_distinct(t):
    return t.events.groupBy(day().alias("day"), "event_type").agg(F.countDistinct("user_id").alias("users"))


@query("""SELECT user_id, cast(coalesce(sum(CASE WHEN event_type = 'view' THEN 1 END), 0) AS BIGINT) AS n_view, cast(coalesce(sum(CASE WHEN event_type = 'purchase' THEN 1 END), 0) AS BIGINT) AS n_purchase,
                 cast(coalesce(sum(CASE WHEN event_type = 'refund' THEN 1 END), 0) AS BIGINT) AS n_refund FROM events GROUP BY 1""")
def agg_conditional_sum(t):
    return A.conditional_sums(t.events, "user_id", "event_type", ["view", "purchase", "refund"], prefix="n_")


@query("""SELECT event_type, count(DISTINCT CASE WHEN value > 50 THEN user_id END) AS big_users, count(DISTINCT CASE WHEN value <= 5 THEN user_id END) AS small_users FROM events GROUP BY 1""")
def agg_conditional_distinct(t):
    return t.events.groupBy("event_type").agg(F.countDistinct(F.when(F.col("value") > 50, F.col("user_id"))).alias("big_users"),
                                              F.countDistinct(F.when(F.col("value") <= 5, F.col("user_id"))).alias("small_users"))


@query("""SELECT user_id, list_aggregate(list_sort(list(DISTINCT event_type)), 'string_agg', ',') AS kinds FROM events GROUP BY 1""")
def agg_array_distinct(t):
    return A.collect_distinct(t.events, "user_id", ["event_type"]).select("user_id", F.array_join("event_type", ",").alias("kinds"))


@query("""WITH d AS (SELECT DISTINCT p_brand, p_type, p_size // 10 AS size_class FROM part)
          SELECT p_brand, count(*) AS n, string_agg(p_type || ':' || size_class, ',' ORDER BY p_type, size_class) AS variants FROM d GROUP BY 1""")
def agg_array_struct(t):
    parts = t.part.select("p_brand", "p_type", F.floor(F.col("p_size") / 10).alias("size_class"))
    items = A.collect_structs(parts, "p_brand", ["p_type", "size_class"])
    return items.select("p_brand", F.size("items").cast("bigint").alias("n"),
                        F.array_join(F.transform("items", lambda i: F.concat_ws(":", i["p_type"], i["size_class"])), ",").alias("variants"))


@query("""SELECT n_regionkey, string_agg(n_name, '>' ORDER BY n_nationkey) AS names FROM nation JOIN region ON r_regionkey = n_regionkey GROUP BY 1""")
def agg_string_concat_ordered(t):
    rows = t.nation.join(t.region, F.col("r_regionkey") == F.col("n_regionkey"))
    return A.string_agg_ordered(rows, "n_regionkey", "n_name", "n_nationkey", ">", "names")


@query("""SELECT user_id, max(cast(json_extract_string(props, '$.k') AS BIGINT)) AS latest_k FROM events GROUP BY 1""")
def agg_array_last(t):
    held = t.events.select("user_id", F.get_json_object("props", "$.k").cast("bigint").alias("k")).distinct().groupBy("user_id").agg(F.collect_list("k").alias("ks"))
    return held.select("user_id", N.array_last("ks").alias("latest_k"))


@query("""SELECT event_id, dense_rank() OVER w AS place, lag(event_id) OVER w AS previous, cast(count(*) FILTER (event_id % 3 = 0) OVER (PARTITION BY user_id ORDER BY t NULLS FIRST, event_id ROWS UNBOUNDED PRECEDING) AS BIGINT) AS thirds
          FROM (SELECT event_id, user_id, CASE WHEN event_id % 7 <> 0 THEN ts END AS t FROM events) WINDOW w AS (PARTITION BY user_id ORDER BY t NULLS FIRST, event_id)""")
def win_null_times(t):
    """Every seventh event lost its time; such events come first, in the order of their ids."""
    e = t.events.select("event_id", "user_id", F.when(F.col("event_id") % 7 != 0, F.col("ts")).alias("t"))
    outputs = {"place": ("dense_rank", None), "previous": ("lag", "event_id"), "thirds": ("sum", F.when(F.col("event_id") % 3 == 0, 1).otherwise(0))}
    return W.split_window(e, "user_id", ["t", "event_id"], F.date_trunc("hour", "t"), outputs).select("event_id", "place", "previous", F.col("thirds").cast("bigint").alias("thirds"))


@query("""SELECT event_type, round(quantile_cont(value, 0.25), 6) AS q25, round(median(value), 6) AS med FROM events GROUP BY 1""")
def agg_median_percentile(t):
    out = A.percentiles(t.events, "value", {"q25": 0.25, "med": 0.5}, "event_type")
    return out.select("event_type", F.round("q25", 6).alias("q25"), F.round("med", 6).alias("med"))


@query("SELECT o_orderkey FROM orders WHERE o_orderdate = (SELECT max(o_orderdate) FROM orders)")
def agg_single_value(t):
    """One value read by the driver becomes a literal of the next query."""
    newest = A.single_value(t.orders.agg(F.max("o_orderdate")))
    return t.orders.filter(F.col("o_orderdate") == F.lit(newest)).select("o_orderkey")


@query("SELECT o_orderkey, n AS status_rows FROM orders JOIN (SELECT o_orderstatus, count(*) AS n FROM orders GROUP BY 1) USING (o_orderstatus)")
def agg_query_dict(t):
    """A small result read as name -> values and used as a lookup."""
    counts = A.as_dict(t.orders.groupBy("o_orderstatus").agg(F.count("*").alias("n")))
    lookup = F.create_map(*[F.lit(x) for pair in zip(counts["o_orderstatus"], counts["n"]) for x in pair])
    return t.orders.select("o_orderkey", lookup[F.col("o_orderstatus")].cast("bigint").alias("status_rows"))


@query("SELECT event_type, round(stddev_samp(value), 6) AS sd FROM events GROUP BY 1")
def agg_stddev(t):
    return t.events.groupBy("event_type").agg(F.round(F.stddev_samp("value"), 6).alias("sd"))


@query("SELECT o_custkey, count(*) AS n FROM orders GROUP BY 1 HAVING count(*) >= 15")
def agg_having(t):
    return t.orders.groupBy("o_custkey").agg(F.count("*").alias("n")).filter("n >= 15")


@query("""SELECT l_suppkey, n FROM (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1) ORDER BY n DESC, l_suppkey LIMIT 1 OFFSET 2""")
def agg_most_common(t):
    return A.nth_most_common(t.lineitem, "l_suppkey", 3)


@query("""SELECT o_custkey, cast(count(*) FILTER (o_orderpriority = '1-URGENT') AS BIGINT) AS p_1_urgent, cast(count(*) FILTER (o_orderpriority = '2-HIGH') AS BIGINT) AS p_2_high,
                 cast(count(*) FILTER (o_orderpriority = '3-MEDIUM') AS BIGINT) AS p_3_medium, cast(count(*) FILTER (o_orderpriority = '4-NOT SPECIFIED') AS BIGINT) AS p_4_not_specified,
                 cast(count(*) FILTER (o_orderpriority = '5-LOW') AS BIGINT) AS p_5_low FROM orders GROUP BY 1""")
def agg_column_values(t):
    values = sorted(A.column_values(t.orders, "o_orderpriority", limit=100))
    out = A.pivot(t.orders, "o_custkey", "o_orderpriority", values, prefix="p", slug=True)
    return out


@query("""SELECT o_orderpriority, cast(sum(CASE WHEN o_orderstatus = 'F' THEN 1 ELSE 0 END) AS BIGINT) AS n_F, cast(sum(CASE WHEN o_orderstatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS n_O,
                 cast(sum(CASE WHEN o_orderstatus = 'P' THEN 1 ELSE 0 END) AS BIGINT) AS n_P FROM orders GROUP BY 1""")
def pivot(t):
    return A.pivot(t.orders, "o_orderpriority", "o_orderstatus", ["F", "O", "P"], prefix="n_")


@query("""SELECT o_custkey, cast(sum(cast(o_totalprice AS DECIMAL(14,2))) FILTER (o_orderpriority = '1-URGENT') AS DOUBLE) AS urgent,
                 cast(sum(cast(o_totalprice AS DECIMAL(14,2))) FILTER (o_orderpriority = '5-LOW') AS DOUBLE) AS low FROM orders GROUP BY 1""")
def pivot_native(t):
    wide = A.pivot_native(t.orders, "o_custkey", "o_orderpriority", ["1-URGENT", "5-LOW"], F.sum(money("o_totalprice")).cast("double"))
    return wide.withColumnsRenamed({"1-URGENT": "urgent", "5-LOW": "low"})


@query("""SELECT p_partkey, 'p_brand' AS prop, p_brand AS val FROM part UNION ALL SELECT p_partkey, 'p_size', cast(p_size AS VARCHAR) FROM part
          UNION ALL SELECT p_partkey, 'is_small', cast(p_type = 'SMALL' AS VARCHAR) FROM part""")
def unpivot(t):
    part = t.part.select("p_partkey", "p_name", "p_brand", "p_size", (F.col("p_type") == "SMALL").alias("is_small"))
    return A.unpivot(part, exclude=["p_partkey"], remove=["p_name"], field_name="prop", value_name="val")


@query("""SELECT user_id, arg_min(value, event_id) FILTER (event_type = 'view') AS "view", arg_min(value, event_id) FILTER (event_type = 'click') AS click FROM events GROUP BY 1""")
def metric_list_pivot(t):
    e = t.events.withColumn("v", F.col("value").cast("string"))
    wide = A.metrics_wide(e, "user_id", "event_type", "v", ["view", "click"], "event_id")
    return wide.select("user_id", F.col("view").cast("double").alias("view"), F.col("click").cast("double").alias("click"))


# ---- windows

@query("""SELECT l_orderkey, l_linenumber, l_extendedprice FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey ORDER BY l_extendedprice DESC, l_linenumber, l_partkey, l_suppkey) AS rn
          FROM lineitem) WHERE rn = 1""")
def deduplicate(t):
    order = [F.desc("l_extendedprice"), F.asc("l_linenumber"), F.asc("l_partkey"), F.asc("l_suppkey")]
    return W.deduplicate(t.lineitem, "l_orderkey", order).select("l_orderkey", "l_linenumber", "l_extendedprice")


@query("""SELECT user_id, event_id, event_type, value FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""")
def win_qualify_latest(t):
    return W.latest_per_key(t.events.select("user_id", "event_id", "event_type", "value", "ts"), "user_id", ["ts", "event_id"]).drop("ts")


@query("SELECT o_orderkey, o_custkey, rank() OVER (PARTITION BY o_custkey ORDER BY o_orderdate) AS rank FROM orders")
def win_rank(t):
    o = t.orders.select("o_orderkey", "o_custkey", "o_orderdate")
    return W.rank_in_group(o, "o_custkey", "o_orderdate", bucket=F.to_date("o_orderdate")).drop("o_orderdate")


@query("""SELECT event_id, dense_rank() OVER (PARTITION BY user_id ORDER BY ts) AS attempt, cast(sum(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts) AS BIGINT) AS wins
          FROM events""")
def win_dense_rank_attempts(t):
    e = t.events.select("event_id", "user_id", "ts", "event_type")
    return W.attempt_counters(e, "user_id", "ts", F.col("event_type") == "purchase", hour()).select("event_id", "attempt", "wins")


@query("SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal DESC, c_custkey) AS ranking FROM customer")
def win_global_rank(t):
    return W.global_rank(t.customer.select("c_custkey", "c_acctbal"), "c_acctbal", "c_custkey").select("c_custkey", "ranking")


@query("""WITH m AS (SELECT cast(date_trunc('month', o_orderdate) AS DATE) AS month, cast(sum(cast(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) AS total FROM orders GROUP BY 1),
               p AS (SELECT *, lag(total) OVER (ORDER BY month) AS total_prev FROM m)
          SELECT month, total, total_prev, total - total_prev AS total_delta, (total - total_prev) / CASE WHEN total_prev IS NULL OR total_prev = 0 THEN 1 ELSE total_prev END AS total_delta_pct FROM p""")
def period_deltas(t):
    m = t.orders.groupBy(order_month().alias("month")).agg(F.sum(money("o_totalprice")).cast("double").alias("total"))
    return W.period_deltas(m, [], "month", ["total"])


@query("""SELECT o_orderkey, o_orderdate AS valid_from, coalesce(lead(o_orderdate) OVER (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey), TIMESTAMP '9999-12-31') AS valid_to FROM orders""")
def validity_ranges(t):
    o = t.orders.select("o_orderkey", "o_custkey", F.col("o_orderdate").alias("valid_from"))
    end = F.lit("9999-12-31 00:00:00").cast("timestamp_ntz")
    return W.validity_ranges(o, "o_custkey", "valid_from", ["valid_from", "o_orderkey"], "valid_to", end, F.to_date("valid_from")).drop("o_custkey")


@query("""WITH d AS (SELECT event_type, cast(ts AS DATE) AS day, count(DISTINCT user_id) AS users FROM events GROUP BY 1, 2)
          SELECT event_type, day, users, lag(users) OVER (PARTITION BY event_type ORDER BY day) AS users_prev FROM d""")
def win_lag_over_agg(t):
    d = t.events.groupBy("event_type", day().alias("day")).agg(F.countDistinct("user_id").alias("users"))
    return W.split_window(d, "event_type", "day", None, {"users_prev": ("lag", "users")})


@query("""SELECT event_id, cast(sum(cast(value AS DECIMAL(14,2))) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS DOUBLE) AS running FROM events""")
def win_running_sum(t):
    e = W.running_sum(t.events.select("event_id", "user_id", "ts", "value"), "user_id", ["ts", "event_id"], {"running": money("value")}, bucket=hour())
    return e.select("event_id", F.col("running").cast("double").alias("running"))


@query("""SELECT o_orderkey, cast(sum(cast(o_totalprice AS DECIMAL(14,2))) OVER (PARTITION BY o_orderpriority ORDER BY o_orderdate) AS DOUBLE) AS running FROM orders""")
def win_running_sum_range(t):
    o = t.orders.select("o_orderkey", "o_orderpriority", "o_orderdate", "o_totalprice")
    out = W.running_sum(o, "o_orderpriority", "o_orderdate", {"running": money("o_totalprice")}, frame="range", bucket=F.to_date("o_orderdate"))
    return out.select("o_orderkey", F.col("running").cast("double").alias("running"))


@query("""WITH d AS (SELECT cast(o_orderdate AS DATE) AS day, cast(sum(cast(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) AS total, sum(cast(o_totalprice AS DECIMAL(14,2))) AS dec FROM orders GROUP BY 1),
               w AS (SELECT day, total, dec, cast(sum(dec) OVER (ORDER BY day ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING) AS DOUBLE) AS before FROM d)
          SELECT day, total, before / 7 AS mean_before FROM w WHERE total > 2 * (before / 7)""")
def trailing_bound(t):
    d = t.orders.groupBy(F.to_date("o_orderdate").alias("day")).agg(F.sum(money("o_totalprice")).alias("dec"))
    w = W.trailing(d, [], "day", 7, {"before": ("sum", "dec")})
    out = w.select("day", F.col("dec").cast("double").alias("total"), (F.col("before").cast("double") / 7).alias("mean_before"))
    return out.filter(F.col("total") > 2 * F.col("mean_before"))


@query("""WITH e AS (SELECT event_id, event_type, CASE WHEN event_id % 9 > 0 THEN ts END AS t, cast(value AS DECIMAL(14,2)) AS v FROM events)
          SELECT event_id, cast(sum(v) OVER w AS DOUBLE) AS before, cast(max(v) OVER w AS DOUBLE) AS most, cast(min(v) OVER w AS DOUBLE) AS least, count(v) OVER w AS n
          FROM e WINDOW w AS (PARTITION BY event_type ORDER BY t NULLS FIRST, event_id ROWS BETWEEN 50 PRECEDING AND 1 PRECEDING)""")
def trailing_events(t):
    """The fifty events of the same kind before each event; few kinds, so every key is hot, and a ninth of the times is missing."""
    e = t.events.select("event_id", "event_type", F.when(F.col("event_id") % 9 > 0, F.col("ts")).alias("at"), money("value").alias("v"))
    w = W.trailing(e, ["event_type"], ["at", "event_id"], 50, {"before": ("sum", "v"), "most": ("max", "v"), "least": ("min", "v"), "n": ("count", "v")}, bucket=F.date_trunc("hour", "at"))
    return w.select("event_id", *[F.col(c).cast("double").alias(c) for c in ("before", "most", "least")], "n")


@query("""SELECT l_orderkey, l_linenumber, l_quantity, max(l_quantity) OVER (PARTITION BY l_orderkey) AS most, count(*) OVER (PARTITION BY l_orderkey) AS lines FROM lineitem""")
def win_partition_agg(t):
    lines = t.lineitem.select("l_orderkey", "l_linenumber", "l_quantity")
    return W.partition_agg(lines, "l_orderkey", {"most": F.max("l_quantity"), "lines": F.count("*")})


@query("SELECT count(*) AS n, count(*) AS ids FROM lineitem")
def win_row_index(t):
    return W.row_index(t.lineitem.select("l_orderkey")).agg(F.count("*").alias("n"), F.countDistinct("row_index").alias("ids"))


# ---- sort, limit, top-k

@query("""SELECT o_custkey, cast(sum(cast(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) AS spent FROM orders GROUP BY 1 ORDER BY spent DESC, o_custkey LIMIT 5""")
def sort_limit_topk(t):
    spent = t.orders.groupBy("o_custkey").agg(F.sum(money("o_totalprice")).cast("double").alias("spent"))
    return spent.orderBy(F.desc("spent"), "o_custkey").limit(5)


@query("""SELECT p_brand, p_partkey, cast(rank AS INTEGER) AS rank FROM (SELECT p_brand, p_partkey, row_number() OVER (PARTITION BY p_brand ORDER BY p_retailprice DESC, p_partkey) AS rank FROM part) WHERE rank <= 3""")
def topk_per_group(t):
    return W.top_n(t.part, "p_brand", [F.desc("p_retailprice"), F.asc("p_partkey")], 3).select("p_brand", "p_partkey", "rank")


# ---- set operations

@query("""SELECT c_nationkey AS k, c_name AS name FROM customer UNION ALL SELECT s_nationkey, s_name FROM supplier""")
def union_all(t):
    a = t.customer.select(F.col("c_nationkey").alias("k"), F.col("c_name").alias("name"))
    return a.unionByName(t.supplier.select(F.col("s_name").alias("name"), F.col("s_nationkey").alias("k")))


@query("SELECT o_custkey AS k FROM orders UNION SELECT l_suppkey FROM lineitem")
def union_distinct(t):
    return t.orders.select(F.col("o_custkey").alias("k")).distinct().union(t.lineitem.select("l_suppkey").distinct()).distinct()


@query("""SELECT 'customer' AS _source, c_custkey AS id, cast(c_nationkey AS BIGINT) AS nation, c_mktsegment AS segment, cast(NULL AS DOUBLE) AS balance FROM customer
          UNION ALL SELECT 'supplier', s_suppkey, cast(s_nationkey AS BIGINT), NULL, s_acctbal FROM supplier""")
def union_relations(t):
    c = t.customer.select(F.col("c_custkey").alias("id"), F.col("c_nationkey").alias("nation"), F.col("c_mktsegment").alias("segment"), "c_name")
    s = t.supplier.select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("nation"), F.col("s_acctbal").alias("balance"))
    return S.union_relations({"customer": c, "supplier": s}, exclude=["C_NAME"], overrides={"nation": "bigint"})


@query("""SELECT 'tm_shard_f' AS _source, o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'F' UNION ALL SELECT 'tm_shard_o', o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'O'
          UNION ALL SELECT 'tm_shard_p', o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus NOT IN ('F', 'O')""")
def union_by_pattern(t):
    for name, rows in {"f": "o_orderstatus = 'F'", "o": "o_orderstatus = 'O'", "p": "o_orderstatus NOT IN ('F', 'O')"}.items():
        t.orders.filter(rows).select("o_orderkey", "o_orderstatus").createOrReplaceTempView(f"tm_shard_{name}")
    return S.union_tables(t.spark, "tm_shard_*")


@query("""SELECT k, 'a_minus_b' AS which_diff FROM (SELECT l_partkey AS k FROM lineitem EXCEPT SELECT o_custkey FROM orders)
          UNION ALL SELECT k, 'b_minus_a' FROM (SELECT o_custkey AS k FROM orders EXCEPT SELECT l_partkey FROM lineitem)""")
def symmetric_diff(t):
    return S.symmetric_diff(t.lineitem.select(F.col("l_partkey").alias("k")), t.orders.select(F.col("o_custkey").alias("k")))


@query("SELECT DISTINCT l_returnflag, l_linestatus, l_linenumber FROM lineitem")
def distinct(t):
    return t.lineitem.select("l_returnflag", "l_linestatus", "l_linenumber").distinct()
