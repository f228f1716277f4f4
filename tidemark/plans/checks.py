"""Generic checks over the test tables; every query returns the failing rows."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import checks as K
from ..operators import expectations as X
from ..operators.aggregates import money
from .registry import query


@query("SELECT l_orderkey, l_linenumber, l_discount FROM lineitem WHERE l_discount <= 0.0 OR l_discount >= 0.1")
def check_accepted_range(t):
    return K.accepted_range(t.lineitem, "l_discount", 0.0, 0.1, inclusive=False).select("l_orderkey", "l_linenumber", "l_discount")


@query("""SELECT user_id, count(CASE WHEN event_type = 'purchase' AND value > 60 THEN value END) AS filled FROM events GROUP BY 1 HAVING count(CASE WHEN event_type = 'purchase' AND value > 60 THEN value END) = 0""")
def check_at_least_one(t):
    e = t.events.withColumn("big", F.when((F.col("event_type") == "purchase") & (F.col("value") > 60), F.col("value")))
    return K.at_least_one(e, "big", "user_id")


@query("""WITH a AS (SELECT c_nationkey AS value, count(*) AS num_rows FROM customer GROUP BY 1), b AS (SELECT s_nationkey AS value, count(*) AS num_rows FROM supplier GROUP BY 1)
          SELECT *, 'a_minus_b' AS which_diff FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT *, 'b_minus_a' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def check_cardinality_equality(t):
    return K.cardinality_equality(t.customer, "c_nationkey", t.supplier, "s_nationkey")


@query("""WITH a AS (SELECT c_nationkey AS k, count(*) AS count_a FROM customer GROUP BY 1), b AS (SELECT s_nationkey AS k, count(*) AS count_b FROM supplier GROUP BY 1)
          SELECT k, count_a, count_b, abs(coalesce(count_a, 0) - coalesce(count_b, 0)) AS diff_count FROM a FULL JOIN b USING (k) WHERE coalesce(count_a, 0) <> coalesce(count_b, 0)""")
def check_equal_rowcount(t):
    return K.equal_rowcount(t.customer.select(F.col("c_nationkey").alias("k")), t.supplier.select(F.col("s_nationkey").alias("k")), "k")


@query("""WITH a AS (SELECT o_orderpriority AS k, count(*) AS count_a FROM orders WHERE o_orderstatus <> 'O' GROUP BY 1), b AS (SELECT o_orderpriority AS k, count(*) AS count_b FROM orders WHERE o_orderstatus = 'O' GROUP BY 1)
          SELECT k, count_a, count_b, CASE WHEN count_a > count_b THEN count_a - count_b ELSE 1 END AS row_count_delta FROM a FULL JOIN b USING (k) WHERE coalesce(count_a, 0) >= coalesce(count_b, 0)""")
def check_fewer_rows_than(t):
    o = t.orders.withColumnRenamed("o_orderpriority", "k")
    return K.fewer_rows_than(o.filter("o_orderstatus <> 'O'"), o.filter("o_orderstatus = 'O'"), "k")


@query("""WITH a AS (SELECT n_nationkey AS k, n_regionkey AS r FROM nation), b AS (SELECT DISTINCT c_nationkey AS k, c_nationkey // 6 AS r FROM customer)
          SELECT k, r, 'a_minus_b' AS which_diff FROM (SELECT * FROM a EXCEPT SELECT * FROM b) UNION ALL SELECT k, r, 'b_minus_a' FROM (SELECT * FROM b EXCEPT SELECT * FROM a)""")
def check_equality(t):
    a = t.nation.select(F.col("n_nationkey").alias("k"), F.col("n_regionkey").alias("r"))
    return K.equality(a, t.customer.select(F.col("c_nationkey").alias("k"), F.expr("c_nationkey div 6").cast("int").alias("r")))


@query("SELECT o_orderkey, o_totalprice FROM orders WHERE NOT (o_totalprice >= 5000 OR o_orderstatus = 'F')")
def check_expression_is_true(t):
    return K.expression_is_true(t.orders, "o_totalprice >= 5000 OR o_orderstatus = 'F'").select("o_orderkey", "o_totalprice")


@query("""WITH r AS (SELECT o_custkey, o_orderdate AS a, o_orderdate + to_days(cast(o_orderkey % 90 AS INTEGER)) AS b, o_orderkey FROM orders),
               w AS (SELECT *, lead(a) OVER (PARTITION BY o_custkey ORDER BY a, b) AS nxt FROM r)
          SELECT o_custkey, a, b FROM w WHERE NOT (a < b AND coalesce(b <= nxt, true))""")
def check_mutually_exclusive_ranges(t):
    end = F.col("o_orderdate") + F.make_interval(days=(F.col("o_orderkey") % 90).cast("int"))
    r = t.orders.select("o_custkey", F.col("o_orderdate").alias("a"), end.alias("b"))
    return K.mutually_exclusive_ranges(r, "a", "b", "o_custkey", bucket=F.to_date("a")).select("o_custkey", "a", "b")


@query("SELECT DISTINCT o_orderpriority FROM orders WHERE o_orderpriority IN ('5-LOW', 'NONE')")
def check_not_accepted_values(t):
    return K.not_accepted_values(t.orders, "o_orderpriority", ["5-LOW", "NONE"])


@query("SELECT l_orderkey, min(l_returnflag) AS lowest, max(l_returnflag) AS highest FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_returnflag) = 1")
def check_not_constant(t):
    return K.not_constant(t.lineitem, "l_returnflag", "l_orderkey")


@query("SELECT p_partkey FROM part WHERE trim(CASE WHEN p_size > 45 THEN '  ' ELSE p_name END) = ''")
def check_not_empty_string(t):
    return K.not_empty_string(t.part.withColumn("label", F.when(F.col("p_size") > 45, "  ").otherwise(F.col("p_name"))), "label").select("p_partkey")


@query("""SELECT user_id, cast(count(CASE WHEN value > 20 THEN 1 END) AS DOUBLE) / count(*) AS not_null_proportion FROM events GROUP BY 1
          HAVING cast(count(CASE WHEN value > 20 THEN 1 END) AS DOUBLE) / count(*) NOT BETWEEN 0.6 AND 0.7""")
def check_not_null_proportion(t):
    e = t.events.withColumn("big", F.when(F.col("value") > 20, F.col("value")))
    return K.not_null_proportion(e, "big", 0.6, 0.7, "user_id")


@query("""SELECT user_id, max(ts) AS most_recent, TIMESTAMP '2024-01-30 12:00:00' AS threshold FROM events GROUP BY 1 HAVING max(ts) < TIMESTAMP '2024-01-30 12:00:00'""")
def check_recency(t):
    return K.recency(t.events, "ts", "day", 1, "2024-01-31 12:00:00", group_by="user_id")


@query("""SELECT max(ts) AS newest, cast(date_sub('day', max(ts), TIMESTAMP '2024-02-01 06:00:00') AS BIGINT) AS age_days,
                 CASE WHEN date_sub('day', max(ts), TIMESTAMP '2024-02-01 06:00:00') >= 2 THEN 'error' WHEN date_sub('day', max(ts), TIMESTAMP '2024-02-01 06:00:00') >= 1 THEN 'warn' ELSE 'pass' END AS state FROM events""")
def check_source_freshness(t):
    return K.freshness(t.events, "ts", "2024-02-01 06:00:00", 1, 2)


@query("""SELECT l_orderkey, l_linenumber, l_partkey FROM lineitem WHERE l_returnflag = 'A' AND l_partkey NOT IN (SELECT p_partkey FROM part WHERE p_size < 45)""")
def check_relationships_where(t):
    return K.relationships_where(t.lineitem, "l_partkey", t.part, "p_partkey", "l_returnflag = 'A'", "p_size < 45").select("l_orderkey", "l_linenumber", "l_partkey")


@query("""SELECT user_id, day FROM (SELECT user_id, day, lag(day) OVER (PARTITION BY user_id ORDER BY day) AS p FROM (SELECT DISTINCT user_id, cast(date_trunc('day', ts) AS TIMESTAMP) AS day FROM events))
          WHERE day <> p + INTERVAL 1 DAY""")
def check_sequential_values(t):
    days = t.events.select("user_id", F.date_trunc("day", "ts").cast("timestamp_ntz").alias("day")).distinct()
    return K.sequential_values(days, "day", 1, "day", "user_id").select("user_id", "day")


@query("SELECT l_orderkey, l_linenumber, count(*) AS n_records FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def check_unique_combination(t):
    return K.unique_combination(t.lineitem, ["l_orderkey", "l_linenumber"])


@query("""SELECT 'accepted' AS check_name, o_orderstatus AS found, count(*) AS n FROM orders WHERE o_orderstatus NOT IN ('F', 'O') GROUP BY 2
          UNION ALL SELECT 'not_null', 'missing label', count(*) FROM documents LEFT JOIN labels USING (doc_id) WHERE quality IS NULL
          UNION ALL SELECT 'unique', 'l_partkey', count(*) FROM (SELECT l_partkey FROM lineitem GROUP BY 1 HAVING count(*) > 1)""")
def check_not_null_unique_accepted(t):
    accepted = K.accepted_values(t.orders, "o_orderstatus", ["F", "O"]).select(F.lit("accepted").alias("check_name"), F.col("o_orderstatus").alias("found"), F.col("n_records").alias("n"))
    empty = K.not_null(t.documents.join(t.labels, "doc_id", "left"), "quality").agg(F.count("*").alias("n"))
    twice = K.unique(t.lineitem, "l_partkey").agg(F.count("*").alias("n"))
    return accepted.union(empty.select(F.lit("not_null"), F.lit("missing label"), "n")).union(twice.select(F.lit("unique"), F.lit("l_partkey"), "n"))


@query("""SELECT doc_id FROM documents LEFT JOIN labels USING (doc_id) WHERE lang = 'en' AND quality IS NULL AND toxic IS NULL""")
def check_all_null_rows(t):
    return K.all_null_rows(t.documents.join(t.labels, "doc_id", "left"), ["quality", "toxic"], "lang = 'en'").select("doc_id")


@query("""SELECT column_name, sum_a, sum_b FROM (
            SELECT 'balance' AS column_name, (SELECT cast(sum(cast(c_acctbal AS DECIMAL(14,2))) AS DOUBLE) FROM customer) AS sum_a, (SELECT cast(sum(cast(s_acctbal AS DECIMAL(14,2))) AS DOUBLE) FROM supplier) AS sum_b
            UNION ALL SELECT 'one', 1.0 * (SELECT count(*) FROM customer), 1.0 * (SELECT count(*) FROM supplier)) WHERE abs(sum_a - sum_b) > 0.0001""")
def check_equal_sums(t):
    a = t.customer.select(money("c_acctbal").alias("balance"), F.lit(1).alias("one"))
    b = t.supplier.select(money("s_acctbal").alias("balance"), F.lit(1).alias("one"))
    return K.equal_sums(a, b, ["balance", "one"])


@query("""WITH c AS (SELECT max(cast(o_orderdate AS DATE)) - 30 AS d FROM orders)
          SELECT (SELECT cast(sum(cast(o_totalprice AS DECIMAL(14,2))) AS DOUBLE) FROM orders, c WHERE cast(o_orderdate AS DATE) <= d) AS sum_a,
                 (SELECT cast(sum(cast(l_extendedprice AS DECIMAL(14,2))) AS DOUBLE) FROM lineitem, c WHERE cast(l_shipdate AS DATE) <= d) AS sum_b""")
def check_sum_diff_until_date(t):
    a = t.orders.withColumn("amount", money("o_totalprice"))
    return K.equal_sum_until(a, "amount", t.lineitem.withColumn("price", money("l_extendedprice")), "price", "o_orderdate", "l_shipdate", 30)


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_tax > 0 AND l_discount = 0")
def check_implied_nonzero(t):
    return K.implied_nonzero(t.lineitem, "l_tax", "l_discount").select("l_orderkey", "l_linenumber")


@query("""SELECT DISTINCT p_partkey, p_name FROM part WHERE regexp_matches(p_name, '^(red|blue)') AND NOT regexp_matches(p_name, 'bolt$') AND NOT regexp_matches(p_name, 'ring')""")
def check_code_format(t):
    return K.code_format(t.part, ["p_partkey"], "p_name", "^(red|blue)", ["bolt$", "ring"])


@query("""WITH r AS (SELECT user_id, cast(json_extract_string(props, '$.k') AS INTEGER) // 10 AS step, max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS ok FROM events GROUP BY 1, 2),
               k AS (SELECT *, cast(dense_rank() OVER (ORDER BY step) AS INTEGER) AS step_rank FROM r)
          SELECT c.user_id, c.step, c.step_rank FROM k c WHERE c.step_rank > 1 AND NOT EXISTS (SELECT 1 FROM k p WHERE p.user_id = c.user_id AND p.step_rank = c.step_rank - 1 AND p.ok = 1)""")
def check_missing_predecessor(t):
    steps = t.events.withColumn("step", F.expr("cast(get_json_object(props, '$.k') AS INT) div 10").cast("int"))
    return K.missing_predecessor(steps, "user_id", "step", F.col("event_type") == "purchase")


@query("""SELECT * FROM (VALUES ('big_discount', 'error'), ('part_known', 'error'), ('positive_total', 'error'), ('status_known', 'warn')) v(check_name, severity)
          JOIN (SELECT 'big_discount' AS check_name, count(*) AS failures FROM lineitem WHERE l_discount > 0.09 UNION ALL SELECT 'part_known', count(*) FROM lineitem WHERE l_partkey NOT IN (SELECT p_partkey FROM part)
                UNION ALL SELECT 'positive_total', count(*) FROM orders WHERE o_totalprice <= 0 UNION ALL SELECT 'status_known', count(DISTINCT o_orderstatus) FROM orders WHERE o_orderstatus NOT IN ('F', 'O')) USING (check_name)
          JOIN (VALUES ('big_discount', 'fail'), ('part_known', 'pass'), ('positive_total', 'pass'), ('status_known', 'warn')) s(check_name, state) USING (check_name)""")
def run_checks(t):
    return K.run_checks(
        {
            "big_discount": K.accepted_range(t.lineitem, "l_discount", max_value=0.09),
            "part_known": K.relationships_where(t.lineitem, "l_partkey", t.part, "p_partkey"),
            "positive_total": K.expression_is_true(t.orders, "> 0", "o_totalprice"),
            "status_known": K.accepted_values(t.orders, "o_orderstatus", ["F", "O"]),
        },
        severity={"status_known": "warn"},
    )


@query("""WITH n AS (SELECT count(*) AS n FROM orders)
          SELECT check_name, CASE WHEN check_name = 'rows' THEN n ELSE f END AS failures, 'error' AS severity, CASE WHEN check_name = 'rows' OR f > 0 THEN 'fail' ELSE 'pass' END AS state FROM n,
          (VALUES ('exists', 0), ('position', 1), ('contains', 0), ('match_set', 1), ('ordered', 1), ('absent', 0), ('count', 0), ('count_equal', 1), ('count_other', 1), ('type', 0), ('type_list', 1), ('rows', 0)) v(check_name, f)""")
def run_schema_checks(t):
    """Table-shape expectations next to a row check that reads the whole table."""
    o = t.orders
    return K.run_checks({
        "exists": X.expect_column(o, "O_ORDERKEY", 1),
        "position": X.expect_column(o, "o_custkey", 5),
        "contains": X.expect_columns(o, ["o_orderkey", "o_custkey"], "contain"),
        "match_set": X.expect_columns(o, ["o_orderkey"], "match_set"),
        "ordered": X.expect_columns(o, list(reversed(o.columns)), "match_ordered"),
        "absent": X.expect_columns(o, ["secret"], "not_contain"),
        "count": X.expect_column_count(o, 3, 10),
        "count_equal": X.expect_column_count(o, equal=99),
        "count_other": X.expect_column_count(o, other=t.lineitem),
        "type": X.expect_type(o, "o_totalprice", "double"),
        "type_list": X.expect_type(o, "o_totalprice", ["int", "bigint"]),
        "rows": X.expect_null(o, "o_orderkey"),
    })
