"""Number series, date spines, the calendar and fiscal dimensions, and date densification."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions import dates as D

# Spark interval units of the date parts a spine may step by.
PARTS = ["second", "minute", "hour", "day", "week", "month", "quarter", "year"]


def _step(part: str, n: str | Column = "1") -> Column:
    if part not in PARTS:
        raise ValueError(f"part must be one of {PARTS}")
    count = F.expr(n) if isinstance(n, str) else n
    count = count.cast("int")
    if part == "second":
        return F.make_interval(secs=count)
    field = {"minute": "mins", "hour": "hours", "day": "days", "week": "weeks", "month": "months", "quarter": "months", "year": "years"}[part]
    return F.make_interval(**{field: count * 3 if part == "quarter" else count})


def generate_series(spark: SparkSession, upper: int, name: str = "generated_number") -> DataFrame:
    """1..upper as one distributed range."""
    if upper <= 0:
        raise ValueError("upper bound must be positive")
    return spark.range(1, upper + 1).withColumnRenamed("id", name)


def date_spine(spark: SparkSession, part: str, start: str, end: str) -> DataFrame:
    """start, start + 1 part, ... : as many rows as boundaries between start and end, the end left out."""
    span = spark.range(1).select(D.boundaries(D.as_timestamp(start), D.as_timestamp(end), part)).first()[0]
    name = f"date_{part}"
    if span <= 0:
        return spark.range(0).select(D.as_timestamp(start).alias(name))
    return spark.range(span).select((D.as_timestamp(start) + _step(part, F.col("id"))).alias(name))


def base_dates(spark: SparkSession, start: str | None = None, end: str | None = None, n: int | None = None,
               part: str = "day", as_of: str | None = None) -> DataFrame:
    """A spine between two dates, or over the last n parts up to and including ``as_of``."""
    if start and end:
        return date_spine(spark, part, start, end)
    if not (n and as_of):
        raise ValueError("give start and end, or n and as_of")
    ends = spark.range(1).select((D.as_timestamp(as_of) - _step(part, str(n))).cast("string"),
                                 (D.as_timestamp(as_of) + _step("day")).cast("string")).first()
    return date_spine(spark, part, ends[0], ends[1])


def spine_of(df: DataFrame, date_col: str, part: str = "day", name: str = "date_day", include_end: bool = True) -> DataFrame:
    """All periods between the first and the last date that occur in a table, found by Spark itself."""
    start, end = F.trunc(F.min(date_col), part) if part != "day" else F.min(date_col), F.max(date_col)
    days = df.agg(start.cast("date").alias("a"), end.cast("date").alias("b"))
    step = {"day": F.expr("INTERVAL 1 DAY"), "week": F.expr("INTERVAL 7 DAYS"), "month": F.expr("INTERVAL 1 MONTH")}[part]
    out = days.filter("a IS NOT NULL").select(F.explode(F.sequence("a", "b", step)).alias(name), "b")
    return (out if include_end else out.filter(F.col(name) < F.col("b"))).drop("b")


def date_dimension(days: DataFrame, col: str = "date_day") -> DataFrame:
    """Calendar attributes for a frame of days, prior-year columns included.

    Fixed values: the column names, which readers of a date dimension expect.
    """
    d = F.col("date_day")
    prior, py, pyoy = F.date_sub(d, 1), D.shift(d, -1, "year"), F.date_sub(d, 364)
    return days.select(F.col(col).cast("date").alias("date_day")).select(
        "date_day",
        prior.alias("prior_date_day"),
        F.date_add(d, 1).alias("next_date_day"),
        py.alias("prior_year_date_day"),
        pyoy.alias("prior_year_over_year_date_day"),
        D.day_of_week(d, iso=False).alias("day_of_week"),
        D.day_of_week(d, iso=True).alias("day_of_week_iso"),
        D.day_name(d, short=False).alias("day_of_week_name"),
        D.day_name(d, short=True).alias("day_of_week_name_short"),
        F.dayofmonth(d).alias("day_of_month"),
        F.dayofyear(d).alias("day_of_year"),
        D.week_start(d).alias("week_start_date"),
        D.week_end(d).alias("week_end_date"),
        D.week_start(pyoy).alias("prior_year_week_start_date"),
        D.week_end(pyoy).alias("prior_year_week_end_date"),
        D.week_of_year(d).alias("week_of_year"),
        D.iso_week_start(d).alias("iso_week_start_date"),
        D.iso_week_end(d).alias("iso_week_end_date"),
        D.iso_week_start(pyoy).alias("prior_year_iso_week_start_date"),
        D.iso_week_end(pyoy).alias("prior_year_iso_week_end_date"),
        D.iso_week_of_year(d).alias("iso_week_of_year"),
        D.week_of_year(pyoy).alias("prior_year_week_of_year"),
        D.iso_week_of_year(pyoy).alias("prior_year_iso_week_of_year"),
        F.month(d).alias("month_of_year"),
        D.month_name(d, short=False).alias("month_name"),
        D.month_name(d, short=True).alias("month_name_short"),
        F.trunc(d, "month").alias("month_start_date"),
        F.last_day(d).alias("month_end_date"),
        F.trunc(py, "month").alias("prior_year_month_start_date"),
        F.last_day(py).alias("prior_year_month_end_date"),
        F.quarter(d).alias("quarter_of_year"),
        F.trunc(d, "quarter").alias("quarter_start_date"),
        D.quarter_end(d).alias("quarter_end_date"),
        F.year(d).alias("year_number"),
        F.trunc(d, "year").alias("year_start_date"),
        D.year_end(d).alias("year_end_date"),
    )


def fiscal_year_dates(dim: DataFrame, year_end_month: int = 12, week_start_day: int = 1, shift_year: int = 1) -> DataFrame:
    """Fiscal year, its bounds and its weeks for each calendar day.

    A fiscal year ends with the week, among those starting in the closing month, whose last day is nearest to
    the end of that month. Weeks and years are derived per day by arithmetic; only the handful of year ends
    is ranked and joined back.
    """
    week = dim.filter((F.col("day_of_week") == week_start_day) & (F.col("month_of_year") == year_end_month))
    ends = week.select(
        (F.col("year_number") - shift_year).alias("fiscal_year_number"),
        F.date_add("date_day", 6).alias("week_end_date"),
        "month_end_date",
    )
    nearest = F.rank().over(Window.partitionBy("fiscal_year_number").orderBy(F.abs(F.datediff("week_end_date", "month_end_date"))))
    closing = ends.withColumn("__r", nearest).filter("__r = 1").select("fiscal_year_number", "week_end_date")
    years = closing.select(
        "fiscal_year_number",
        F.date_add(F.lag("week_end_date").over(Window.orderBy("week_end_date")), 1).alias("fiscal_year_start_date"),
        F.col("week_end_date").alias("fiscal_year_end_date"),
    ).filter("fiscal_year_start_date IS NOT NULL")
    first_day = dim.agg(F.min(F.when(F.col("day_of_week") == week_start_day, F.col("date_day")))).scalar()
    back = F.pmod(F.col("day_of_week") - F.lit(week_start_day), F.lit(7))
    days = dim.select("date_day", F.date_sub("date_day", back).alias("week_start_date")).filter(F.col("week_start_date") >= first_day)
    spread = years.withColumn("date_day", F.explode(F.sequence("fiscal_year_start_date", "fiscal_year_end_date")))
    weeks = F.dense_rank().over(Window.partitionBy("fiscal_year_number").orderBy("week_start_date"))
    return days.join(spread, "date_day").select(
        "date_day", "fiscal_year_number", "fiscal_year_start_date", "fiscal_year_end_date", "week_start_date",
        F.date_add("week_start_date", 6).alias("week_end_date"),
    ).withColumn("fiscal_week_of_year", weeks)


def fiscal_periods(dim: DataFrame, year_end_month: int = 12, week_start_day: int = 1, shift_year: int = 1) -> DataFrame:
    """4-5-4 periods of each 13-week quarter; a 53rd week joins the last period."""
    week = F.col("fiscal_week_of_year")
    in_quarter = F.pmod(week - 1, F.lit(13))
    quarter = F.least(F.floor((week - 1) / 13), F.lit(3)).cast("int")
    period = F.when(week == 53, 3).when(in_quarter < 4, 1).when(in_quarter < 9, 2).otherwise(3)
    out = fiscal_year_dates(dim, year_end_month, week_start_day, shift_year).withColumns(
        {"fiscal_quarter_number": quarter + 1, "fiscal_period_of_quarter": period, "fiscal_period_number": quarter * 3 + period}
    )
    return out.select(
        "date_day", "fiscal_year_number", "week_start_date", "week_end_date", "fiscal_week_of_year",
        F.dense_rank().over(Window.partitionBy("fiscal_period_number").orderBy("fiscal_week_of_year")).alias("fiscal_week_of_period"),
        "fiscal_period_number", "fiscal_quarter_number", "fiscal_period_of_quarter",
    )


def densify(df: DataFrame, keys: list[str], date_col: str, start: Column | None = None, end: Column | None = None,
            step: str = "INTERVAL 1 DAY") -> DataFrame:
    """Every key with every period of the span, the table's own columns where it has a row.

    Give ``df`` one row per key and period. The span defaults to the dates that occur; each key unfolds its
    own sequence, so no cross join is planned.
    """
    span = df.agg(F.min(date_col).alias("a"), F.max(date_col).alias("b"))
    lo = span.select("a").scalar() if start is None else start
    hi = span.select("b").scalar() if end is None else end
    grid = df.select(*keys).distinct().withColumn(date_col, F.explode(F.sequence(lo, hi, F.expr(step))))
    right = df.select(*[F.col(k).alias(f"__r_{k}") for k in [*keys, date_col]], *[c for c in df.columns if c not in [*keys, date_col]])
    return grid.join(right, [F.col(k).eqNullSafe(F.col(f"__r_{k}")) for k in [*keys, date_col]], "left").drop(
        *[f"__r_{k}" for k in [*keys, date_col]])
