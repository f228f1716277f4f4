"""Calendars spanned by the dates that occur in the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import calendars as C
from .registry import query

# The columns of the calendar dimension as plain SQL.
DIMENSION_SQL = """
  SELECT d AS date_day, d - 1 AS prior_date_day, d + 1 AS next_date_day, cast(d - INTERVAL 1 YEAR AS DATE) AS prior_year_date_day, d - 364 AS prior_year_over_year_date_day,
    cast(dayofweek(d) + 1 AS INTEGER) AS day_of_week, cast(isodow(d) AS INTEGER) AS day_of_week_iso, dayname(d) AS day_of_week_name, substr(dayname(d), 1, 3) AS day_of_week_name_short,
    cast(day(d) AS INTEGER) AS day_of_month, cast(dayofyear(d) AS INTEGER) AS day_of_year,
    d - cast(dayofweek(d) AS INTEGER) AS week_start_date, d - cast(dayofweek(d) AS INTEGER) + 6 AS week_end_date,
    d - 364 - cast(dayofweek(d - 364) AS INTEGER) AS prior_year_week_start_date, d - 364 - cast(dayofweek(d - 364) AS INTEGER) + 6 AS prior_year_week_end_date,
    cast(ceil(dayofyear(d) / 7.0) AS INTEGER) AS week_of_year, cast(date_trunc('week', d) AS DATE) AS iso_week_start_date, cast(date_trunc('week', d) AS DATE) + 6 AS iso_week_end_date,
    cast(date_trunc('week', d - 364) AS DATE) AS prior_year_iso_week_start_date, cast(date_trunc('week', d - 364) AS DATE) + 6 AS prior_year_iso_week_end_date,
    cast(weekofyear(d) AS INTEGER) AS iso_week_of_year, cast(ceil(dayofyear(d - 364) / 7.0) AS INTEGER) AS prior_year_week_of_year, cast(weekofyear(d - 364) AS INTEGER) AS prior_year_iso_week_of_year,
    cast(month(d) AS INTEGER) AS month_of_year, monthname(d) AS month_name, substr(monthname(d), 1, 3) AS month_name_short,
    cast(date_trunc('month', d) AS DATE) AS month_start_date, last_day(d) AS month_end_date,
    cast(date_trunc('month', d - INTERVAL 1 YEAR) AS DATE) AS prior_year_month_start_date, last_day(cast(d - INTERVAL 1 YEAR AS DATE)) AS prior_year_month_end_date,
    cast(quarter(d) AS INTEGER) AS quarter_of_year, cast(date_trunc('quarter', d) AS DATE) AS quarter_start_date, cast(date_trunc('quarter', d) + INTERVAL 3 MONTH - INTERVAL 1 DAY AS DATE) AS quarter_end_date,
    cast(year(d) AS INTEGER) AS year_number, cast(date_trunc('year', d) AS DATE) AS year_start_date, cast(date_trunc('year', d) + INTERVAL 1 YEAR - INTERVAL 1 DAY AS DATE) AS year_end_date
  FROM (SELECT cast(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS d FROM (SELECT min(cast(o_orderdate AS DATE)) AS a, max(cast(o_orderdate AS DATE)) AS b FROM orders))"""


@query(DIMENSION_SQL)
def date_dimension(t):
    return C.date_dimension(C.spine_of(t.orders, "o_orderdate"))


FISCAL_SQL = f"""
  WITH dim AS ({DIMENSION_SQL}),
  ends AS (SELECT year_number - 1 AS fy, date_day + 6 AS week_end, month_end_date FROM dim WHERE month_of_year = 12 AND day_of_week = 1),
  best AS (SELECT fy, week_end FROM (SELECT *, rank() OVER (PARTITION BY fy ORDER BY abs(week_end - month_end_date)) AS r FROM ends) WHERE r = 1),
  years AS (SELECT fy, lag(week_end) OVER (ORDER BY week_end) + 1 AS a, week_end AS b FROM best),
  weeks AS (SELECT date_day AS ws, date_day + 6 AS we FROM dim WHERE day_of_week = 1),
  fiscal AS (SELECT date_day, fy AS fiscal_year_number, a AS fiscal_year_start_date, b AS fiscal_year_end_date, ws AS week_start_date, we AS week_end_date,
                    cast(dense_rank() OVER (PARTITION BY fy ORDER BY ws) AS INTEGER) AS fiscal_week_of_year
             FROM dim JOIN years ON date_day BETWEEN a AND b JOIN weeks ON date_day BETWEEN ws AND we)"""


@query(FISCAL_SQL + " SELECT * FROM fiscal")
def fiscal_year_dates(t):
    return C.fiscal_year_dates(C.date_dimension(C.spine_of(t.orders, "o_orderdate")))


@query(FISCAL_SQL + """,
  q AS (SELECT *, (fiscal_week_of_year - 1) % 13 AS w13, least((fiscal_week_of_year - 1) // 13, 3) AS qn FROM fiscal),
  p AS (SELECT *, CASE WHEN fiscal_week_of_year = 53 THEN 3 WHEN w13 BETWEEN 0 AND 3 THEN 1 WHEN w13 BETWEEN 4 AND 8 THEN 2 ELSE 3 END AS pq FROM q)
  SELECT date_day, fiscal_year_number, week_start_date, week_end_date, fiscal_week_of_year,
         cast(dense_rank() OVER (PARTITION BY qn * 3 + pq ORDER BY fiscal_week_of_year) AS INTEGER) AS fiscal_week_of_period,
         cast(qn * 3 + pq AS INTEGER) AS fiscal_period_number, cast(qn + 1 AS INTEGER) AS fiscal_quarter_number, cast(pq AS INTEGER) AS fiscal_period_of_quarter FROM p""")
def fiscal_periods(t):
    return C.fiscal_periods(C.date_dimension(C.spine_of(t.orders, "o_orderdate")))


@query("""WITH s AS (SELECT cast(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS date_day FROM (SELECT min(cast(ts AS DATE)) AS a, max(cast(ts AS DATE)) - 1 AS b FROM events))
          SELECT date_day, count(event_id) AS n FROM s LEFT JOIN events ON cast(ts AS DATE) = date_day GROUP BY 1""")
def date_spine(t):
    """A spine leaves its end out; the rows of each day are counted against it."""
    days = t.events.groupBy(F.to_date("ts").alias("date_day")).agg(F.count("*").alias("n"))
    return C.spine_of(t.events, "ts", include_end=False).join(days, "date_day", "left").fillna(0, ["n"])


@query("""WITH n AS (SELECT DISTINCT l_linenumber AS i, count(*) OVER (PARTITION BY l_linenumber) AS lines FROM lineitem)
          SELECT i AS generated_number, lines FROM n""")
def generate_series(t):
    top = t.lineitem.agg(F.max("l_linenumber")).first()[0]
    lines = t.lineitem.groupBy(F.col("l_linenumber").cast("bigint").alias("generated_number")).agg(F.count("*").alias("lines"))
    return C.generate_series(t.spark, top).join(lines, "generated_number").withColumn("generated_number", F.col("generated_number").cast("int"))


@query("""WITH s AS (SELECT unnest(generate_series(TIMESTAMP '2001-07-22', TIMESTAMP '2001-08-01', INTERVAL 1 DAY)) AS date_day)
          SELECT date_day, count(o_orderkey) AS n FROM s LEFT JOIN orders ON o_orderdate = date_day GROUP BY 1""")
def base_dates(t):
    """The last ten days up to a run date and the orders of each."""
    days = C.base_dates(t.spark, n=10, part="day", as_of="2001-08-01")
    n = t.orders.groupBy(F.col("o_orderdate").alias("date_day")).agg(F.count("*").alias("n"))
    return days.join(n, "date_day", "left").fillna(0, ["n"])


@query("""WITH k AS (SELECT DISTINCT user_id FROM events), s AS (SELECT cast(unnest(generate_series(a, b, INTERVAL 1 DAY)) AS DATE) AS day FROM (SELECT min(cast(ts AS DATE)) AS a, max(cast(ts AS DATE)) AS b FROM events)),
               n AS (SELECT user_id, cast(ts AS DATE) AS day, count(*) AS n FROM events GROUP BY 1, 2)
          SELECT user_id, day, n FROM k CROSS JOIN s LEFT JOIN n USING (user_id, day)""")
def dense_date_fill(t):
    daily = t.events.groupBy("user_id", F.to_date("ts").alias("day")).agg(F.count("*").alias("n"))
    return C.densify(daily, ["user_id"], "day")
