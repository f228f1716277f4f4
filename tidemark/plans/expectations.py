"""Expectations over the test tables; every query returns the failing rows or groups."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import expectations as X
from ..operators.aggregates import money
from .registry import query


@query("""SELECT o_custkey, false AS expression FROM orders WHERE o_orderstatus <> 'P' GROUP BY 1 HAVING NOT (count(*) >= 5 AND max(o_totalprice) > 100000)""")
def expect_expression_is_true(t):
    return X.expect_true(t.orders, "count(*) >= 5 AND max(o_totalprice) > 100000", "o_custkey", "o_orderstatus <> 'P'")


@query("SELECT l_suppkey, cast(count(*) AS BIGINT) AS value FROM lineitem WHERE l_returnflag = 'R' GROUP BY 1 HAVING NOT (count(*) > 190 AND count(*) < 210)")
def expect_expression_between(t):
    return X.expect_between(t.lineitem, F.count("*"), 190, 210, "l_suppkey", "l_returnflag = 'R'", strictly=True)


@query("""WITH a AS (SELECT c_nationkey AS k, cast(sum(cast(c_acctbal AS DECIMAL(14,2))) AS DOUBLE) AS value_a FROM customer GROUP BY 1), b AS (SELECT s_nationkey AS k, cast(sum(cast(s_acctbal AS DECIMAL(14,2))) AS DOUBLE) AS value_b FROM supplier GROUP BY 1)
          SELECT k, value_a, value_b FROM a FULL JOIN b USING (k) WHERE abs(coalesce(value_a, 0) - coalesce(value_b, 0)) > 150000""")
def expect_equal_expression(t):
    a = t.customer.select(F.col("c_nationkey").alias("k"), money("c_acctbal").alias("bal"))
    b = t.supplier.select(F.col("s_nationkey").alias("k"), money("s_acctbal").alias("bal"))
    return X.expect_equal_expression(a, F.sum("bal"), b, group_by="k", tolerance=150000)


@query("""WITH a AS (SELECT l_returnflag AS k, cast(sum(cast(l_quantity AS DECIMAL(14,2))) AS DOUBLE) AS value_a, cast(count(*) * 25 AS DOUBLE) AS value_b FROM lineitem GROUP BY 1)
          SELECT * FROM a WHERE abs(value_a - value_b) / abs(value_a) > 0.01""")
def expect_aggregation_equal_other(t):
    li = t.lineitem.withColumn("k", F.col("l_returnflag"))
    return X.expect_equal_expression(li, F.sum(money("l_quantity")), li, F.count("*") * 25, "k", tolerance_percent=0.01)


@query("""WITH x AS (SELECT doc_id, quality, toxic, CASE WHEN lang = 'en' THEN 1 END AS en FROM documents LEFT JOIN labels USING (doc_id))
          SELECT count(*) FILTER (NOT (quality IS NULL AND en IS NULL)) AS not_all, count(*) FILTER (NOT (quality IS NULL OR en IS NULL)) AS not_any, count(*) AS every FROM x""")
def ignore_row_if(t):
    x = t.documents.join(t.labels, "doc_id", "left").withColumn("en", F.when(F.col("lang") == "en", 1))
    modes = {"not_all": "all_values_are_missing", "not_any": "any_value_is_missing", "every": "never"}
    return x.agg(*[F.count_if(X.ignore_row_if(["quality", "en"], m)).alias(n) for n, m in modes.items()])


@query("""SELECT cast(ts AS DATE) AS day, count(DISTINCT user_id) AS n_distinct FROM events WHERE event_type = 'purchase' GROUP BY 1 HAVING NOT count(DISTINCT user_id) > 50""")
def expect_distinct_count(t):
    return X.expect_distinct_count(t.events.withColumn("day", F.to_date("ts")), "user_id", "gt", 50, "day", "event_type = 'purchase'")


@query("""SELECT * FROM (SELECT cast(ts AS DATE) AS day, count(DISTINCT user_id) AS n_distinct, 'lt' AS rule FROM events GROUP BY 1) WHERE NOT n_distinct < 100
          UNION ALL SELECT * FROM (SELECT cast(ts AS DATE), count(DISTINCT user_id) AS n, 'eq' FROM events GROUP BY 1) WHERE NOT n = 100""")
def expect_distinct_count_lt_eq(t):
    e = t.events.withColumn("day", F.to_date("ts"))
    return X.expect_distinct_count(e, "user_id", "lt", 100, "day").withColumn("rule", F.lit("lt")).union(
        X.expect_distinct_count(e, "user_id", "eq", 100, "day").withColumn("rule", F.lit("eq")))


@query("""SELECT o_custkey, cast(count(*) AS DOUBLE) AS value FROM orders GROUP BY 1 HAVING NOT count(*) = 10""")
def expect_row_count_equal(t):
    return X.expect_row_count(t.orders, equal=10, group_by="o_custkey").withColumn("value", F.col("value").cast("double"))


@query("""SELECT * FROM (SELECT cast(count(DISTINCT o_custkey) AS DOUBLE) AS value_a, (SELECT cast(count(DISTINCT c_custkey) AS DOUBLE) FROM customer) AS value_b FROM orders) WHERE value_a <> value_b
          UNION ALL SELECT * FROM (SELECT cast(count(DISTINCT o_custkey) FILTER (o_orderstatus = 'F') AS DOUBLE) AS a, (SELECT cast(count(DISTINCT c_custkey) AS DOUBLE) FROM customer) AS b FROM orders) WHERE a <> b""")
def expect_distinct_count_equal_other(t):
    whole = X.expect_distinct_count_equal(t.orders, "o_custkey", t.customer, "c_custkey")
    return whole.union(X.expect_distinct_count_equal(t.orders, "o_custkey", t.customer, "c_custkey", "o_orderstatus = 'F'", "true"))


@query("""SELECT DISTINCT 'in' AS mode, p_type AS value, 'not in set' AS problem FROM part WHERE p_type NOT IN ('SMALL', 'ECONOMY')
          UNION ALL SELECT 'contain', 'GIANT', 'missing' UNION ALL SELECT 'equal', 'GIANT', 'missing' UNION ALL SELECT DISTINCT 'equal', p_type, 'not in set' FROM part WHERE p_type <> 'SMALL'""")
def expect_distinct_values(t):
    def run(values, mode):
        return X.expect_distinct_values(t.part, "p_type", values, mode).select(F.lit(mode).alias("mode"), "value", "problem")

    return run(["SMALL", "ECONOMY"], "in").union(run(["SMALL", "GIANT"], "contain")).union(run(["SMALL", "GIANT"], "equal"))


@query("""SELECT o_custkey, 'max' AS agg, cast(max(o_totalprice) AS DOUBLE) AS value FROM orders GROUP BY 1 HAVING NOT (max(o_totalprice) >= 300000)
          UNION ALL SELECT o_custkey, 'min', min(o_totalprice) FROM orders GROUP BY 1 HAVING NOT (min(o_totalprice) <= 100000)
          UNION ALL SELECT o_custkey, 'sum', cast(sum(cast(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) FROM orders GROUP BY 1 HAVING NOT (sum(cast(o_totalprice AS DECIMAL(14,2))) BETWEEN 500000 AND 4000000)""")
def expect_agg_between(t):
    o = t.orders.withColumn("price", money("o_totalprice"))
    parts = {"max": (300000, None), "min": (None, 100000), "sum": (500000, 4000000)}
    out = [X.expect_agg_between(o, a, "price", lo, hi, "o_custkey").select("o_custkey", F.lit(a).alias("agg"), F.col("value").cast("double").alias("value")) for a, (lo, hi) in parts.items()]
    return out[0].union(out[1]).union(out[2])


@query("""SELECT user_id, 'mean' AS agg, cast(round(cast(cast(sum(cast(value AS DECIMAL(14,2))) AS DOUBLE) / count(*) AS DECIMAL(38,12)), 6) AS DOUBLE) AS value FROM events GROUP BY 1 HAVING NOT (avg(value) BETWEEN 45 AND 55)
          UNION ALL SELECT user_id, 'median', round(median(value), 4) FROM events GROUP BY 1 HAVING NOT (median(value) BETWEEN 30 AND 40)""")
def expect_mean_median_between(t):
    exact = t.events.select("user_id", money("value").alias("value"))
    mean = X.expect_agg_between(exact, "mean", "value", 45, 55, "user_id").select("user_id", F.lit("mean").alias("agg"), F.col("value").cast("double").alias("value"))
    return mean.union(X.expect_agg_between(t.events, "median", "value", 30, 40, "user_id").select("user_id", F.lit("median"), F.round("value", 4)))


@query("""SELECT l_returnflag, round(quantile_cont(l_extendedprice, 0.9), 4) AS value FROM lineitem GROUP BY 1 HAVING NOT (quantile_cont(l_extendedprice, 0.9) < 90000)""")
def expect_quantile_between(t):
    return X.expect_quantile(t.lineitem, "l_extendedprice", 0.9, high=90000, group_by="l_returnflag", strictly=True).withColumn("value", F.round("value", 4))


@query("SELECT p_brand, round(stddev_samp(p_size), 6) AS value FROM part GROUP BY 1 HAVING NOT (stddev_samp(p_size) BETWEEN 13.5 AND 14.5)")
def expect_stdev_between(t):
    return X.expect_agg_between(t.part, "stddev", "p_size", 13.5, 14.5, "p_brand").withColumn("value", F.round("value", 6))


@query("""SELECT p_brand, cast(count(DISTINCT p_size) AS DOUBLE) AS value, 'count' AS kind FROM part GROUP BY 1 HAVING NOT count(DISTINCT p_size) >= 40
          UNION ALL SELECT p_brand, cast(count(DISTINCT p_name) AS DOUBLE) / count(p_name), 'share' FROM part GROUP BY 1 HAVING NOT cast(count(DISTINCT p_name) AS DOUBLE) / count(p_name) <= 0.5""")
def expect_unique_value_count(t):
    n = X.expect_unique_count(t.part, "p_size", low=40, group_by="p_brand").select("p_brand", F.col("value").cast("double").alias("value"), F.lit("count").alias("kind"))
    return n.union(X.expect_unique_proportion(t.part, "p_name", high=0.5, group_by="p_brand").select("p_brand", "value", F.lit("share")))


@query("""SELECT l_suppkey, n FROM (SELECT l_suppkey, count(*) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, l_suppkey LIMIT 1 OFFSET 1) WHERE l_suppkey NOT IN (1, 2)""")
def expect_most_common_value_in_set(t):
    return X.expect_most_common(t.lineitem, "l_suppkey", [1, 2], 2)


@query("SELECT event_id, value FROM events WHERE event_type = 'purchase' AND NOT (value >= 2 AND value <= 120)")
def expect_values_between(t):
    return X.expect_values_between(t.events, "value", 2, 120, "event_type = 'purchase'").select("event_id", "value")


@query("""SELECT event_id FROM (SELECT event_id, value, lag(value) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS p FROM events) WHERE NOT (value > p)""")
def expect_values_increasing(t):
    return X.expect_monotone(t.events, "value", ["ts", "event_id"], group_by="user_id", bucket=F.date_trunc("hour", "ts")).select("event_id")


@query("""SELECT day, n FROM (SELECT day, n, lag(n) OVER (ORDER BY day) AS p FROM (SELECT cast(ts AS DATE) AS day, count(DISTINCT user_id) AS n FROM events GROUP BY 1)) WHERE NOT (n <= p)""")
def expect_values_decreasing(t):
    daily = t.events.groupBy(F.to_date("ts").alias("day")).agg(F.countDistinct("user_id").alias("n"))
    return X.expect_monotone(daily, "n", "day", "decreasing", strict=False).select("day", "n")


@query("""SELECT event_id, 'outside' AS kind FROM events WHERE value > 30 AND event_type NOT IN ('view', 'click') UNION ALL SELECT event_id, 'forbidden' FROM events WHERE event_type IN ('error')""")
def expect_values_in_set(t):
    out = X.expect_values_in_set(t.events, "event_type", ["view", "click"], row_condition="value > 30").select("event_id", F.lit("outside").alias("kind"))
    return out.union(X.expect_values_in_set(t.events, "event_type", ["error"], negate=True).select("event_id", F.lit("forbidden")))


@query("""SELECT c_custkey, 'outside' AS kind FROM customer WHERE c_nationkey NOT IN (SELECT s_nationkey FROM supplier WHERE s_acctbal > 5000)
          UNION ALL SELECT c_custkey, 'forbidden' FROM customer WHERE c_nationkey IN (SELECT s_nationkey FROM supplier WHERE s_acctbal < 1000)""")
def expect_values_in_table(t):
    out = X.expect_values_in_table(t.customer, "c_nationkey", t.supplier.filter("s_acctbal > 5000"), "s_nationkey").select("c_custkey", F.lit("outside").alias("kind"))
    return out.union(X.expect_values_in_table(t.customer, "c_nationkey", t.supplier.filter("s_acctbal < 1000"), "s_nationkey", negate=True).select("c_custkey", F.lit("forbidden")))


@query("""SELECT doc_id, 'filled' AS kind FROM documents LEFT JOIN labels USING (doc_id) WHERE lang = 'de' AND quality IS NOT NULL UNION ALL SELECT doc_id, 'empty' FROM documents LEFT JOIN labels USING (doc_id) WHERE lang <> 'de' AND quality IS NULL""")
def expect_values_null(t):
    d = t.documents.join(t.labels, "doc_id", "left")
    return X.expect_null(d, "quality", "lang = 'de'").select("doc_id", F.lit("filled").alias("kind")).union(X.expect_not_null(d, "quality", "lang <> 'de'").select("doc_id", F.lit("empty")))


@query("SELECT p_name, count(*) AS n_records FROM part WHERE p_size > 48 GROUP BY 1 HAVING count(*) > 1")
def expect_values_unique(t):
    return X.expect_unique(t.part, "p_name", "p_size > 48")


@query("""WITH v AS (SELECT DISTINCT CASE WHEN p_size % 7 = 0 THEN upper(p_name) ELSE p_name END AS value FROM part)
          SELECT value FROM v WHERE lower(value) IN (SELECT lower(value) FROM v GROUP BY 1 HAVING count(*) > 1)
          UNION ALL SELECT count(*) || '/' || count(DISTINCT lower(value)) FROM v HAVING count(*) <> count(DISTINCT lower(value))""")
def expect_consistent_casing(t):
    v = t.part.withColumn("label", F.when(F.col("p_size") % 7 == 0, F.upper("p_name")).otherwise(F.col("p_name")))
    counts = X.expect_consistent_casing(v, "label").select(F.concat_ws("/", "set_count", "set_count_case_insensitive"))
    return X.expect_consistent_casing(v, "label", display_inconsistent=True).union(counts)


@query("""WITH s AS (SELECT user_id, cast(sum(cast(value AS DECIMAL(14,2))) AS DOUBLE) AS metric FROM events GROUP BY 1), z AS (SELECT *, (metric - avg(metric) OVER ()) / stddev_samp(metric) OVER () AS z FROM s)
          SELECT user_id, metric, round(z, 6) AS metric_sigma FROM z WHERE abs(z) > 2""")
def expect_within_n_stdevs(t):
    e = t.events.withColumn("money", money("value"))
    return X.expect_within_stdevs(e, "money", "user_id", 2).withColumn("metric_sigma", F.round("metric_sigma", 6))


@query("""WITH s AS (SELECT event_type, cast(date_trunc('day', ts) AS TIMESTAMP) AS metric_period, cast(sum(cast(value AS DECIMAL(14,2))) AS DOUBLE) AS agg_metric_value FROM events GROUP BY 1, 2),
               p AS (SELECT *, lag(agg_metric_value) OVER (PARTITION BY event_type ORDER BY metric_period) AS prior FROM s),
               v AS (SELECT *, coalesce(ln(nullif(agg_metric_value, 0)), 0) - coalesce(ln(nullif(prior, 0)), 0) AS v FROM p),
               m AS (SELECT *, avg(v) OVER w AS a, stddev_samp(v) OVER w AS sd FROM v WINDOW w AS (PARTITION BY event_type ORDER BY metric_period ROWS BETWEEN 7 PRECEDING AND 1 PRECEDING))
          SELECT event_type, metric_period, agg_metric_value, round((v - a) / nullif(sd, 0), 6) AS metric_test_sigma FROM m
          WHERE metric_period >= TIMESTAMP '2024-01-17' AND metric_period < TIMESTAMP '2024-01-31' AND NOT ((v - a) / nullif(sd, 0) BETWEEN -1.5 AND 1.5)""")
def expect_within_n_moving_stdevs(t):
    e = t.events.withColumn("money", money("value"))
    out = X.expect_within_moving_stdevs(e, "money", "ts", "2024-01-31", sigma=1.5, group_by="event_type")
    return out.select("event_type", "metric_period", "agg_metric_value", F.round("metric_test_sigma", 6).alias("metric_test_sigma"))


@query("""WITH s AS (SELECT unnest(generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2001-07-31', INTERVAL 1 DAY)) AS d), b AS (SELECT d FROM s WHERE (cast(d AS DATE) - DATE '1995-01-01') % 2 = 0),
               o AS (SELECT DISTINCT o_orderdate - to_days(cast((cast(o_orderdate AS DATE) - DATE '1995-01-01') % 2 AS INTEGER)) AS d FROM orders WHERE o_orderpriority = '1-URGENT' AND o_totalprice < 100000)
          SELECT d AS date_day, cast(0 AS BIGINT) AS row_cnt FROM b WHERE d NOT IN (SELECT d FROM o) AND year(d) <> 1999""")
def expect_data_every_n_datepart(t):
    return X.expect_data_every(t.orders, "o_orderdate", "day", 2, "1995-01-01", "2001-08-01", "o_orderpriority = '1-URGENT' AND o_totalprice < 100000", "year(date_day) <> 1999")


@query("""SELECT l_orderkey, l_linenumber, 'gt' AS rule FROM lineitem WHERE NOT (l_discount > l_tax) UNION ALL SELECT l_orderkey, l_linenumber, 'eq' FROM lineitem WHERE NOT (l_linenumber = l_quantity) AND l_returnflag = 'A'
          UNION ALL SELECT l_orderkey, l_linenumber, 'set' FROM lineitem WHERE NOT ((l_returnflag = 'A' AND l_linestatus = 'F') OR (l_returnflag = 'N' AND l_linestatus = 'O'))""")
def expect_pair(t):
    def tag(df, rule):
        return df.select("l_orderkey", "l_linenumber", F.lit(rule).alias("rule"))

    li = t.lineitem
    pairs = X.expect_pair_in_set(li, "l_returnflag", "l_linestatus", [("A", "F"), ("N", "O")])
    return tag(X.expect_pair(li, "l_discount", "l_tax", "gt"), "gt").union(tag(X.expect_pair(li, "l_linenumber", "l_quantity", "eq", "l_returnflag = 'A'"), "eq")).union(tag(pairs, "set"))


@query("""WITH x AS (SELECT CASE WHEN p_size > 10 THEN p_name END AS a, CASE WHEN p_size < 40 THEN p_size END AS b FROM part)
          SELECT a, b, count(*) AS n_records FROM x WHERE NOT (a IS NULL OR b IS NULL) GROUP BY 1, 2 HAVING count(*) > 1""")
def expect_compound_unique(t):
    x = t.part.select(F.when(F.col("p_size") > 10, F.col("p_name")).alias("a"), F.when(F.col("p_size") < 40, F.col("p_size")).alias("b"))
    return X.expect_compound_unique(x, ["a", "b"], "any_value_is_missing")


@query("""SELECT l_returnflag, cast(sum(cast(l_quantity AS BIGINT)) + sum(l_linenumber) AS BIGINT) AS sum_of_columns, cast(count(*) * 30 AS BIGINT) AS expected FROM lineitem GROUP BY 1
          HAVING sum(cast(l_quantity AS BIGINT)) + sum(l_linenumber) <> count(*) * 30""")
def expect_multicolumn_sum(t):
    li = t.lineitem.select("l_returnflag", F.col("l_quantity").cast("bigint").alias("q"), "l_linenumber")
    return X.expect_multicolumn_sum(li, ["q", "l_linenumber"], F.count("*") * 30, "l_returnflag")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_orderkey = l_partkey OR l_orderkey = l_suppkey OR l_partkey = l_suppkey")
def expect_unique_within_record(t):
    return X.expect_unique_within_record(t.lineitem, ["l_orderkey", "l_partkey", "l_suppkey"]).select("l_orderkey", "l_linenumber")


@query("""SELECT p_partkey, 'between' AS rule FROM part WHERE NOT (length(p_name) >= 9 AND length(p_name) <= 11) UNION ALL SELECT p_partkey, 'equal' FROM part WHERE length(p_brand) <> 8 AND p_size < 10""")
def expect_length(t):
    a = X.expect_length(t.part, "p_name", 9, 11).select("p_partkey", F.lit("between").alias("rule"))
    return a.union(X.expect_length(t.part, "p_brand", equal=8, row_condition="p_size < 10").select("p_partkey", F.lit("equal")))


@query("""SELECT p_partkey, 'like' AS rule FROM part WHERE NOT (p_name LIKE 'red%' OR p_name LIKE '%bolt') UNION ALL SELECT p_partkey, 'all' FROM part WHERE NOT (p_name LIKE '%e%' AND p_name LIKE '%i%')
          UNION ALL SELECT p_partkey, 'not' FROM part WHERE p_name LIKE '%ring%'""")
def expect_like(t):
    def tag(rule, *args):
        return X.expect_like(t.part, "p_name", *args).select("p_partkey", F.lit(rule).alias("rule"))

    return tag("like", ["red%", "%bolt"]).union(tag("all", ["%e%", "%i%"], True, "all")).union(tag("not", "%ring%", False))


@query("""SELECT page_id, 'regex' AS rule FROM pages WHERE NOT regexp_matches(url, '^https://') UNION ALL SELECT page_id, 'flags' FROM pages WHERE NOT (regexp_matches(url, '(?i)EXAMPLE\\.ORG') OR regexp_matches(url, '(?i)page='))
          UNION ALL SELECT page_id, 'not' FROM pages WHERE regexp_matches(url, '#') OR regexp_matches(url, '[?]ref')""".replace("\\\\", "\\"))
def expect_regex(t):
    def tag(rule, *args):
        return X.expect_regex(t.pages, "url", *args).select("page_id", F.lit(rule).alias("rule"))

    return tag("regex", "^https://").union(tag("flags", ["EXAMPLE\\.ORG", "page="], True, "any", "i")).union(tag("not", ["#", "[?]ref"], False, "all"))


@query("""SELECT o_custkey, cast(count(*) AS DOUBLE) AS value FROM orders WHERE o_orderstatus = 'F' GROUP BY 1 HAVING NOT (count(*) BETWEEN 2 AND 8)""")
def expect_row_count_between(t):
    return X.expect_row_count(t.orders, 2, 8, group_by="o_custkey", row_condition="o_orderstatus = 'F'").withColumn("value", F.col("value").cast("double"))


@query("""WITH a AS (SELECT l_suppkey AS k, cast(count(*) AS DOUBLE) AS value_a FROM lineitem GROUP BY 1), b AS (SELECT o_custkey AS k, cast(count(*) * 60 AS DOUBLE) AS value_b FROM orders GROUP BY 1)
          SELECT k, value_a, value_b FROM a FULL JOIN b USING (k) WHERE coalesce(value_a, 0) <> coalesce(value_b, 0)""")
def expect_row_count_equal_other_times_factor(t):
    a, b = t.lineitem.withColumnRenamed("l_suppkey", "k"), t.orders.withColumnRenamed("o_custkey", "k")
    return X.expect_row_count(a, other=b, factor=60, group_by="k")


@query("""SELECT max(o_orderdate) FILTER (o_orderdate <= TIMESTAMP '2000-06-15 12:00:00') AS latest, TIMESTAMP '2000-06-15 06:00:00' AS cutoff FROM orders
          HAVING coalesce(max(o_orderdate) FILTER (o_orderdate <= TIMESTAMP '2000-06-15 12:00:00'), TIMESTAMP '1970-01-01') < TIMESTAMP '2000-06-15 06:00:00'""")
def expect_recent_data(t):
    return X.expect_recent(t.orders, "o_orderdate", "hour", 6, "2000-06-15 12:00:00")


@query("""SELECT user_id, max(ts) FILTER (ts <= TIMESTAMP '2024-01-20') AS latest, TIMESTAMP '2024-01-19 12:00:00' AS cutoff FROM events WHERE event_type <> 'error' GROUP BY 1
          HAVING coalesce(max(ts) FILTER (ts <= TIMESTAMP '2024-01-20'), TIMESTAMP '1970-01-01') < TIMESTAMP '2024-01-19 12:00:00'""")
def expect_grouped_recent_data(t):
    return X.expect_recent(t.events, "ts", "hour", 12, "2024-01-20", "user_id", "event_type <> 'error'")
