"""Finance queries: orders give revenue, line taxes give cost, first orders give installs."""

from __future__ import annotations

from pyspark.sql import Window
from pyspark.sql import functions as F

from ..operators import finance as B
from ..operators.aggregates import money
from ..session import written
from .registry import query


def day():
    return F.to_date("ts")


def order_day():
    return F.to_date("o_orderdate")


@query("""SELECT event_id, user_id, 'item_' || json_extract_string(props, '$.k') AS product, cast(floor(value) * 1000000 AS BIGINT) / 1e6 AS amount, CASE WHEN user_id % 2 = 0 THEN 'even_app' ELSE 'odd_app' END AS app FROM events WHERE event_type = 'purchase'""")
def iap_events(t):
    from ..functions.nested import event_param
    from .scalars import with_params

    name = F.concat(F.lit("item_"), event_param("event_params", "k", "int_value"))
    micros = F.floor(event_param("event_params", "value", "double_value")) * 1000000
    return B.purchases(with_params(t.events), "event_type", "purchase", ["event_id", "user_id"], name, micros, F.when(F.col("user_id") % 2 == 0, "even_app").otherwise("odd_app"))


def CHANNELS(term: str, joined: str) -> str:
    """The SQL term once per channel (the first character of an order priority)."""
    return joined.join(term.replace("{c}", c) for c in "12345")


COUNTRY_DAYS = """o AS (SELECT cast(date_trunc('month', o_orderdate) AS DATE) AS month, n_name AS country, substr(o_orderpriority, 1, 1) AS channel, cast(o_totalprice AS DECIMAL(14,2)) AS revenue, o_orderkey, o_custkey, o_orderdate
       FROM orders JOIN customer ON c_custkey = o_custkey JOIN nation ON n_nationkey = c_nationkey),
  c AS (SELECT cast(date_trunc('month', l_shipdate) AS DATE) AS month, n_name AS country, cast(l_tax AS DECIMAL(14,2)) * cast(l_quantity AS DECIMAL(14,2)) AS cost FROM lineitem JOIN supplier ON s_suppkey = l_suppkey JOIN nation ON n_nationkey = s_nationkey),
  i AS (SELECT cast(date_trunc('month', d0) AS DATE) AS month, country, count(*) AS installs FROM (SELECT o_custkey, any_value(country) AS country, min(o_orderdate) AS d0 FROM o GROUP BY 1) GROUP BY 1, 2)"""


def revenue_rows(t):
    who = t.customer.join(t.nation, F.col("c_nationkey") == F.col("n_nationkey")).select(F.col("c_custkey").alias("o_custkey"), F.col("n_name").alias("country"))
    return t.orders.join(who, "o_custkey").select(
        F.trunc("o_orderdate", "month").alias("month"), "country", F.substring("o_orderpriority", 1, 1).alias("channel"), money("o_totalprice").alias("revenue"),
        "o_orderkey", "o_custkey", "o_orderdate")


def cost_rows(t):
    """Line costs reduced per supplier and month before the supplier's country is looked up."""
    where = t.supplier.join(t.nation, F.col("s_nationkey") == F.col("n_nationkey")).select(F.col("s_suppkey").alias("l_suppkey"), F.col("n_name").alias("country"))
    per = t.lineitem.groupBy("l_suppkey", F.trunc("l_shipdate", "month").alias("month")).agg(F.sum(F.col("l_tax").cast("decimal(4,2)") * money("l_quantity")).alias("cost"))
    return per.join(where, "l_suppkey").groupBy("month", "country").agg(F.sum("cost").alias("cost"))


def installs(t):
    first = revenue_rows(t).groupBy("o_custkey", "country").agg(F.min("o_orderdate").alias("d0"))
    return first.groupBy(F.trunc("d0", "month").alias("month"), "country").agg(F.count("*").alias("installs"))


@query("""SELECT 'ads' AS feed, event_type AS network, cast(cast(ts AS DATE) AS VARCHAR) AS day, NULL AS country, cast(sum(cast(value AS DECIMAL(14,2))) AS DOUBLE) AS revenue, cast(count(*) AS DOUBLE) AS impressions,
                 cast(sum(cast(value AS DECIMAL(14,2))) * 1000 AS DOUBLE) / count(*) AS ecpm FROM events GROUP BY 2, 3
          UNION ALL SELECT 'iap', NULL, cast(cast(o_orderdate AS DATE) AS VARCHAR), cast(c_nationkey AS VARCHAR), cast(sum(cast(o_totalprice AS DECIMAL(14,2))) AS DOUBLE), NULL, 0.0 FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 3, 4""")
def conform_revenue_feeds(t):
    ads = t.events.select(F.col("event_type").alias("network"), day().alias("day"), F.col("value").alias("revenue"), F.lit(1).alias("impressions"))
    iap = t.orders.join(t.customer, F.col("o_custkey") == F.col("c_custkey")).select(F.col("c_nationkey").alias("country"), order_day().alias("day"), F.col("o_totalprice").alias("revenue"))
    out = B.with_ecpm(B.conform_facts({"ads": ads, "iap": iap}, ["network", "day", "country"], ["revenue", "impressions"]), "revenue", "impressions")
    return out.withColumns({c: F.col(c).cast("double") for c in ("revenue", "impressions")})


@query(f"""WITH {COUNTRY_DAYS}, r AS (SELECT month, country, cast(sum(revenue) AS DOUBLE) AS revenue FROM o GROUP BY 1, 2), k AS (SELECT month, country, cast(sum(cost) AS DOUBLE) AS cost FROM c GROUP BY 1, 2)
           SELECT month, country, coalesce(cost, 0.0) AS cost, coalesce(revenue, 0.0) AS revenue, coalesce(revenue, 0.0) - coalesce(cost, 0.0) AS profit FROM k FULL JOIN r USING (month, country)""")
def cost_revenue_rollup(t):
    dims = ["month", "country"]
    revenue = revenue_rows(t).groupBy(*dims).agg(F.sum("revenue").cast("double").alias("revenue"))
    return B.cost_revenue(cost_rows(t).withColumn("cost", F.col("cost").cast("double")), revenue, dims)


@query(f"""WITH {COUNTRY_DAYS}, k AS (SELECT month, country FROM o UNION SELECT month, country FROM c UNION SELECT month, country FROM i),
               r AS (SELECT month, country, {CHANNELS("coalesce(cast(sum(revenue) FILTER (channel = '{c}') AS DOUBLE), 0.0) AS r{c}", ", ")} FROM o GROUP BY 1, 2), s AS (SELECT month, country, cast(sum(cost) AS DOUBLE) AS cost FROM c GROUP BY 1, 2)
           SELECT month, country, {CHANNELS("coalesce(r{c}, 0.0) AS rev_{c}", ", ")}, coalesce(cost, 0.0) AS cost, coalesce(cast(installs AS DOUBLE), 0.0) AS installs, {CHANNELS("coalesce(r{c}, 0.0)", " + ")} AS total_revenue,
                  ({CHANNELS("coalesce(r{c}, 0.0)", " + ")}) / nullif(coalesce(cost, 0.0), 0.0) AS roas FROM k LEFT JOIN r USING (month, country) LEFT JOIN s USING (month, country) LEFT JOIN i USING (month, country)""")
def roas_by_channel(t):
    return B.roas(revenue_rows(t), cost_rows(t), installs(t), ["month", "country"], "channel", list("12345"))


@query(f"""WITH {COUNTRY_DAYS}, f AS (SELECT o_custkey, any_value(country) AS country, cast(date_trunc('month', min(o_orderdate)) AS DATE) AS cohort FROM o GROUP BY 1),
               r AS (SELECT cohort, f.country, cast(date_diff('month', cohort, month) AS BIGINT) AS age, cast(sum(revenue) AS DOUBLE) AS revenue FROM o JOIN f USING (o_custkey) GROUP BY 1, 2, 3),
               s AS (SELECT month AS cohort, country, cast(sum(cost) AS DOUBLE) AS cost FROM c GROUP BY 1, 2), n AS (SELECT month AS cohort, country, installs FROM i),
               b AS (SELECT cohort, country, coalesce(age, 0) AS age, coalesce(revenue, 0.0) AS revenue, coalesce(cost, 0.0) AS cost, coalesce(installs, 0) AS installs FROM r FULL JOIN s USING (cohort, country) FULL JOIN n USING (cohort, country)),
               e AS (SELECT cohort, f.country, cast(date_diff('month', cohort, month) AS BIGINT) AS age, count(DISTINCT o_custkey) AS retained FROM o JOIN f USING (o_custkey) GROUP BY 1, 2, 3),
               v AS (SELECT 'v' || year(month) AS version, min(month) AS from_date FROM o GROUP BY 1), w AS (SELECT version, from_date, lead(from_date, 1, DATE '2002-01-01') OVER (ORDER BY version) AS to_date FROM v)
           SELECT b.*, revenue / nullif(cost, 0.0) AS roas, retained, version FROM b LEFT JOIN e USING (cohort, country, age) LEFT JOIN w ON cohort >= from_date AND cohort < to_date""")
def cohort_ltv(t):
    from ..operators.identity import release_calendar

    # One row per customer and month gives cohort, revenue, retention and installs; a customer has few months.
    per = revenue_rows(t).groupBy("o_custkey", "country", "month").agg(F.sum("revenue").alias("revenue"))
    aged = per.withColumn("cohort", F.min("month").over(Window.partitionBy("o_custkey"))).withColumn("age", F.round(F.months_between("month", "cohort")).cast("bigint"))
    by_age = written(aged.groupBy("cohort", "country", "age").agg(F.sum("revenue").cast("double").alias("revenue"), F.count("*").alias("retained")), "cohorts")
    cost = written(cost_rows(t).select(F.col("month").alias("cohort"), "country", F.col("cost").cast("double").alias("cost")), "costs")
    installed = by_age.filter("age = 0").select("cohort", "country", F.col("retained").alias("installs"))
    months = by_age.select(F.add_months("cohort", F.col("age").cast("int")).alias("month"))
    releases = release_calendar(months.withColumn("version", F.concat(F.lit("v"), F.year("month"))), "version", "month", F.lit("2002-01-01").cast("date"))
    return B.cohort_ltv(by_age, cost, installed, releases, "cohort", "country", "age")


@query("""WITH w AS (SELECT cast(date_trunc('month', o_orderdate) AS DATE) AS month, c_mktsegment AS segment, count(DISTINCT o_custkey) AS users, cast(sum(cast(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) AS rev FROM orders JOIN customer ON c_custkey = o_custkey GROUP BY 1, 2),
               c AS (SELECT cast(date_trunc('month', l_shipdate) AS DATE) AS month, cast(sum(cast(l_tax AS DECIMAL(14,2))) AS DOUBLE) AS tax, cast(sum(cast(l_discount AS DECIMAL(14,2))) AS DOUBLE) AS disc FROM lineitem GROUP BY 1),
               s AS (SELECT month, segment, users, cast(round(cast(rev AS DECIMAL(38,9)), 3) AS DOUBLE) AS revenue, cast(round(cast(coalesce(tax, 0.0) * users / sum(users) OVER (PARTITION BY month) AS DECIMAL(38,9)), 3) AS DOUBLE) AS cost_tax,
                            cast(round(cast(coalesce(disc, 0.0) * users / sum(users) OVER (PARTITION BY month) AS DECIMAL(38,9)), 3) AS DOUBLE) AS cost_disc FROM w LEFT JOIN c USING (month))
          SELECT month, segment, users, cost_tax, cost_disc, cast(round(cast(cost_tax + cost_disc AS DECIMAL(38,9)), 3) AS DOUBLE) AS total_cost, cast(round(cast((cost_tax + cost_disc) / users AS DECIMAL(38,9)), 3) AS DOUBLE) AS cost_per_unit, revenue,
                 cast(round(cast(revenue / users AS DECIMAL(38,9)), 3) AS DOUBLE) AS rev_per_user_segment,
                 cast(round(cast(cast(sum(cast(revenue AS DECIMAL(20,3))) OVER (PARTITION BY month) AS DOUBLE) / sum(users) OVER (PARTITION BY month) AS DECIMAL(38,9)), 3) AS DOUBLE) AS rev_per_user FROM s""")
def cost_allocation(t):
    month = F.trunc("o_orderdate", "month").alias("month")
    # one row per month, segment and customer first, so that the users are counted without a wide distinct
    per = t.orders.groupBy(month, "o_custkey").agg(F.sum(money("o_totalprice")).alias("rev")).join(
        t.customer.select(F.col("c_custkey").alias("o_custkey"), F.col("c_mktsegment").alias("segment")), "o_custkey")
    seg = per.groupBy("month", "segment").agg(F.count("*").alias("users"), F.sum("rev").alias("revenue"))
    cost = t.lineitem.groupBy(F.trunc("l_shipdate", "month").alias("month"))
    costs = {"tax": cost.agg(F.sum(money("l_tax")).alias("cost")), "disc": cost.agg(F.sum(money("l_discount")).alias("cost"))}
    out = B.allocate(seg.drop("revenue"), costs, "month", "users")
    out = B.new_user_profit(out, seg.drop("users"), ["month", "segment"], "month", "users")
    return out.withColumns({c: F.col(c).cast("double") for c in out.columns if c not in ("month", "segment", "users")})


@query("""WITH b AS (SELECT l_returnflag AS acct, cast(l_shipdate AS DATE) AS snap, l_linestatus AS kind, l_suppkey % 10 AS product, cast(l_tax AS DECIMAL(14,2)) AS cost FROM lineitem),
               s AS (SELECT acct, snap AS last FROM (SELECT acct, max(snap) AS snap FROM b GROUP BY acct, date_trunc('month', snap)))
          SELECT acct AS account, cast(date_trunc('month', snap) AS DATE) AS month, product, cast(sum(cost) AS DOUBLE) AS cost FROM b JOIN s USING (acct) WHERE snap = last AND kind = 'F' GROUP BY 1, 2, 3""")
def billing_usage_rollup(t):
    li = t.lineitem.select("l_returnflag", F.to_date("l_shipdate").alias("snap"), F.col("l_linestatus").alias("kind"), (F.col("l_suppkey") % 10).alias("product"), money("l_tax").alias("cost"))
    frames = {a: li.filter(F.col("l_returnflag") == a) for a in ("A", "N", "R")}
    out = B.billing_rollup(frames, "snap", "snap", "kind", "F", ["product"], "cost")
    return out.withColumn("cost", F.col("cost").cast("double"))


@query("""WITH a AS (SELECT c_nationkey AS k, cast(sum(cast(c_acctbal AS DECIMAL(14,2))) AS DOUBLE) AS v, count(*) AS n FROM customer GROUP BY 1), b AS (SELECT s_nationkey AS k, cast(sum(cast(s_acctbal AS DECIMAL(14,2))) AS DOUBLE) AS v, count(*) AS n FROM supplier GROUP BY 1)
          SELECT k, coalesce(a.v, 0.0) AS v_net, coalesce(b.v, 0.0) AS v_store, coalesce(a.n, 0) AS n_net, coalesce(b.n, 0) AS n_store, coalesce(a.v, 0.0) - coalesce(b.v, 0.0) AS v_diff, coalesce(a.n, 0) - coalesce(b.n, 0) AS n_diff FROM a FULL JOIN b USING (k)""")
def source_comparison(t):
    a = t.customer.groupBy(F.col("c_nationkey").alias("k")).agg(F.sum(money("c_acctbal")).cast("double").alias("v"), F.count("*").alias("n"))
    b = t.supplier.groupBy(F.col("s_nationkey").alias("k")).agg(F.sum(money("s_acctbal")).cast("double").alias("v"), F.count("*").alias("n"))
    return B.side_by_side(a, b, ["k"], ("net", "store"), ["v", "n"])
