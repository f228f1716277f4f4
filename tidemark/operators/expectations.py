"""Expectations: checks with row filters, groups, bounds and tolerances. Each returns the failing rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions import dates as D
from .aggregates import nth_most_common, percentile_cont
from .calendars import _step
from .joins import null_safe_join
from .windows import _cols, split_window


def _where(df: DataFrame, row_condition: str | None) -> DataFrame:
    return df.filter(row_condition) if row_condition else df


def _e(expr: str | Column) -> Column:
    return F.expr(expr) if isinstance(expr, str) else expr


def _inside(c: Column, low, high, strictly: bool) -> Column:
    if low is None and high is None:
        raise ValueError("give a lower or an upper bound")
    ok = F.lit(True)
    if low is not None:
        ok = ok & (c > low if strictly else c >= low)
    if high is not None:
        ok = ok & (c < high if strictly else c <= high)
    return ok


def expect_true(df: DataFrame, expr: str | Column, group_by=None, row_condition: str | None = None) -> DataFrame:
    """Rows where the condition is false or, with ``group_by`` (an empty list for the whole table), groups."""
    df = _where(df, row_condition)
    if group_by is None:
        return df.filter(~_e(expr))
    return df.groupBy(*_cols(group_by)).agg(_e(expr).alias("expression")).filter("NOT expression")


def expect_between(df: DataFrame, expr: str | Column, low=None, high=None, group_by=None, row_condition: str | None = None,
                   strictly: bool = False) -> DataFrame:
    """Row values or group aggregates outside the bounds."""
    df = _where(df, row_condition)
    if group_by is None:
        return df.filter(~_inside(_e(expr), low, high, strictly))
    return df.groupBy(*_cols(group_by)).agg(_e(expr).alias("value")).filter(~_inside(F.col("value"), low, high, strictly))


def expect_equal_expression(a: DataFrame, expr: str | Column, b: DataFrame | None = None, expr_b: str | Column | None = None, group_by=(),
                            tolerance: float = 0.0, tolerance_percent: float | None = None, row_condition: str | None = None,
                            row_condition_b: str | None = None) -> DataFrame:
    """Groups whose aggregate differs between two tables by more than an absolute or relative tolerance.

    A missing side counts as 0; the relative difference is taken from the first table. The second table takes
    over whatever is not given for it.
    """
    keys = _cols(group_by)
    side_a = _where(a, row_condition).groupBy(*keys).agg(_e(expr).cast("double").alias("value_a"))
    side_b = _where(a if b is None else b, row_condition_b or row_condition).groupBy(*keys).agg(
        _e(expr if expr_b is None else expr_b).cast("double").alias("value_b"))
    both = null_safe_join(side_a, side_b, keys, "full_outer") if keys else side_a.withColumn("value_b", side_b.scalar())
    diff = F.abs(F.coalesce("value_a", F.lit(0.0)) - F.coalesce("value_b", F.lit(0.0)))
    if tolerance_percent is not None:
        return both.filter(diff / F.nullif(F.abs("value_a"), F.lit(0.0)) > tolerance_percent)
    return both.filter(diff > float(tolerance))


def ignore_row_if(cols: list[str], mode: str) -> Column:
    """Condition that KEEPS a row: drop it when all / any listed values are missing (``never`` keeps all)."""
    nulls = [F.col(c).isNull() for c in cols]
    if mode == "never":
        return F.lit(True)
    if mode not in ("all_values_are_missing", "any_value_is_missing"):
        raise ValueError(f"unknown mode {mode!r}")
    every = nulls[0]
    some = nulls[0]
    for n in nulls[1:]:
        every, some = every & n, some | n
    return ~(every if mode == "all_values_are_missing" else some)


# Comparisons of a distinct count with a value.
COUNT_RULES = {"gt": lambda n, v: n > v, "lt": lambda n, v: n < v, "eq": lambda n, v: n == v}


def expect_distinct_count(df: DataFrame, col: str, op: str, value: int, group_by=(), row_condition: str | None = None) -> DataFrame:
    n = _where(df, row_condition).groupBy(*_cols(group_by)).agg(F.countDistinct(col).alias("n_distinct"))
    return n.filter(~COUNT_RULES[op](F.col("n_distinct"), value))


def expect_distinct_count_equal(a: DataFrame, col: str, b: DataFrame, col_b: str | None = None, row_condition: str | None = None,
                                row_condition_b: str | None = None) -> DataFrame:
    return expect_equal_expression(a, F.countDistinct(col), b, F.countDistinct(col_b or col), row_condition=row_condition, row_condition_b=row_condition_b)


def expect_distinct_values(df: DataFrame, col: str, values: list, mode: str, row_condition: str | None = None) -> DataFrame:
    """Distinct values outside the set (``in``), set members that never occur (``contain``), or both (``equal``)."""
    seen = _where(df, row_condition).select(F.col(col).alias("value")).distinct()
    kind = seen.schema["value"].dataType
    listed = F.coalesce(F.col("value").isin(*values), F.lit(False))
    extra = seen.filter(~listed).withColumn("problem", F.lit("not in set"))
    # members come out of one aggregate row, so that the literal list needs no frame of its own
    hits = seen.filter(listed).agg(F.collect_set("value").alias("hit"))
    members = F.array(*[F.lit(v).cast(kind) for v in values])
    absent = hits.select(F.explode(F.array_except(members, F.col("hit"))).alias("value")).withColumn("problem", F.lit("missing"))
    return {"in": lambda: extra, "contain": lambda: absent, "equal": lambda: extra.unionByName(absent)}[mode]()


# Aggregates a bound may be put on.
AGGREGATES = {"max": F.max, "mean": F.avg, "min": F.min, "sum": F.sum, "stddev": F.stddev_samp}


def expect_agg_between(df: DataFrame, agg: str, col: str, low=None, high=None, group_by=(), row_condition: str | None = None,
                       strictly: bool = False) -> DataFrame:
    """Groups whose max, mean, median, min, sum or stddev is out of bounds."""
    if agg == "median":
        return expect_quantile(df, col, 0.5, low, high, group_by, row_condition, strictly)
    return expect_between(df, AGGREGATES[agg](col), low, high, _cols(group_by), row_condition, strictly)


def expect_quantile(df: DataFrame, col: str, q: float, low=None, high=None, group_by=(), row_condition: str | None = None, strictly: bool = False) -> DataFrame:
    stat = percentile_cont(_where(df, row_condition), col, q, group_by, "value")
    return stat.filter(~_inside(F.col("value"), low, high, strictly))


def expect_unique_count(df: DataFrame, col: str, low=None, high=None, group_by=(), row_condition: str | None = None, strictly: bool = False) -> DataFrame:
    return expect_between(df, F.countDistinct(col), low, high, _cols(group_by), row_condition, strictly)


def expect_unique_proportion(df: DataFrame, col: str, low=None, high=None, group_by=(), row_condition: str | None = None, strictly: bool = False) -> DataFrame:
    share = F.countDistinct(col).cast("double") / F.nullif(F.count(col), F.lit(0)).cast("double")
    return expect_between(df, share, low, high, _cols(group_by), row_condition, strictly)


def expect_most_common(df: DataFrame, col: str, values: list, top_n: int = 1, row_condition: str | None = None) -> DataFrame:
    """The value at frequency rank ``top_n`` when it is not in the set."""
    top = nth_most_common(_where(df, row_condition), col, top_n)
    return top.filter(~F.coalesce(F.col(col).isin(*values), F.lit(False)))


def expect_values_between(df: DataFrame, col: str, low=None, high=None, row_condition: str | None = None, strictly: bool = False) -> DataFrame:
    return expect_between(df, F.col(col), low, high, None, row_condition, strictly)


def expect_monotone(df: DataFrame, col: str, sort: list[str] | str, direction: str = "increasing", strict: bool = True, group_by=(),
                    bucket: Column | None = None, row_condition: str | None = None) -> DataFrame:
    """Rows whose value breaks the order given by the sort columns."""
    out = split_window(_where(df, row_condition), group_by, sort, bucket, {"previous_value": ("lag", col)})
    c, p = F.col(col), F.col("previous_value")
    ok = {("increasing", True): c > p, ("increasing", False): c >= p, ("decreasing", True): c < p, ("decreasing", False): c <= p}[direction, strict]
    return out.filter(~ok)


def expect_values_in_set(df: DataFrame, col: str, values: list, negate: bool = False, row_condition: str | None = None) -> DataFrame:
    """Rows outside the set (NULL counts as outside), or inside a forbidden set."""
    hit = F.coalesce(F.col(col).isin(*values), F.lit(False))
    return _where(df, row_condition).filter(hit if negate else ~hit)


def expect_values_in_table(df: DataFrame, col: str, members: DataFrame, member: str, negate: bool = False, row_condition: str | None = None) -> DataFrame:
    """The same with the set in a table of any size."""
    keys = members.select(F.col(member).alias("__m")).distinct()
    return _where(df, row_condition).join(keys, F.col(col) == F.col("__m"), "left_semi" if negate else "left_anti")


def expect_null(df: DataFrame, col: str, row_condition: str | None = None) -> DataFrame:
    return _where(df, row_condition).filter(F.col(col).isNotNull())


def expect_not_null(df: DataFrame, col: str, row_condition: str | None = None) -> DataFrame:
    return _where(df, row_condition).filter(F.col(col).isNull())


def expect_unique(df: DataFrame, col: str, row_condition: str | None = None) -> DataFrame:
    return expect_compound_unique(df, [col], "all_values_are_missing", row_condition)


def expect_compound_unique(df: DataFrame, cols: list[str], ignore: str = "all_values_are_missing", row_condition: str | None = None) -> DataFrame:
    kept = _where(df, row_condition).filter(ignore_row_if(cols, ignore))
    return kept.groupBy(*cols).agg(F.count("*").alias("n_records")).filter("n_records > 1")


def expect_consistent_casing(df: DataFrame, col: str, display_inconsistent: bool = False) -> DataFrame:
    """Spellings that differ only in case: the variants themselves, or one row with both counts."""
    forms = df.select(F.col(col).alias("value")).distinct()
    if display_inconsistent:
        multi = forms.groupBy(F.lower("value").alias("__l")).agg(F.count("*").alias("__n")).filter("__n > 1").select("__l")
        return forms.join(multi, F.lower("value") == F.col("__l"), "left_semi")
    n = forms.agg(F.count("value").alias("set_count"), F.countDistinct(F.lower("value")).alias("set_count_case_insensitive"))
    return n.filter("set_count <> set_count_case_insensitive")


def expect_within_stdevs(df: DataFrame, col: str, group_by, sigma: float = 3.0) -> DataFrame:
    """Group sums more than ``sigma`` standard deviations from the mean of all group sums."""
    sums = df.groupBy(*_cols(group_by)).agg(F.sum(col).cast("double").alias("metric"))
    stats = sums.agg(F.avg("metric").alias("m"), F.stddev_samp("metric").alias("s"))
    z = (F.col("metric") - stats.select("m").scalar()) / F.nullif(stats.select("s").scalar(), F.lit(0.0))
    return sums.withColumn("metric_sigma", z).filter(F.abs("metric_sigma") > sigma)


def expect_within_moving_stdevs(df: DataFrame, col: str, date_col: str, as_of: str, period: str = "day", lookback: int = 1, trend: int = 7, test: int = 14,
                                sigma: float = 3.0, sigma_upper: float | None = None, sigma_lower: float | None = None, take_diffs: bool = True,
                                take_logs: bool = True, group_by=()) -> DataFrame:
    """Period sums whose (log, differenced) value leaves the band of the periods before.

    Tested are the last ``test`` complete periods before ``as_of``; a period without a spread passes.
    """
    keys = _cols(group_by)
    upper = sigma if sigma_upper is None else sigma_upper
    lower = -sigma if sigma_lower is None else sigma_lower
    sums = df.groupBy(*keys, F.date_trunc(period, F.col(date_col)).cast("timestamp_ntz").alias("metric_period")).agg(
        F.sum(col).cast("double").alias("agg_metric_value"))
    line = Window.partitionBy(*keys).orderBy("metric_period")

    def scaled(c: Column) -> Column:
        return F.coalesce(F.ln(F.nullif(c, F.lit(0.0))) if take_logs else c, F.lit(0.0))

    value = scaled(F.col("agg_metric_value"))
    if take_diffs:
        sums = sums.withColumn("prior_value", F.lag("agg_metric_value", lookback).over(line))
        value = value - scaled(F.col("prior_value"))
    sums = sums.withColumn("metric_test_value", value)
    past = line.rowsBetween(-trend, -1)
    sums = sums.withColumns({"rolling_average": F.avg("metric_test_value").over(past), "rolling_stddev": F.stddev_samp("metric_test_value").over(past)})
    z = (F.col("metric_test_value") - F.col("rolling_average")) / F.nullif("rolling_stddev", F.lit(0.0))
    end = F.date_trunc(period, D.as_timestamp(as_of)).cast("timestamp_ntz")
    recent = (F.col("metric_period") >= end - _step(period, str(test))) & (F.col("metric_period") < end)
    return sums.withColumn("metric_test_sigma", z).filter(recent & ~F.col("metric_test_sigma").between(lower, upper))


def expect_data_every(df: DataFrame, date_col: str, part: str = "day", interval: int = 1, start: str | None = None, end: str | None = None,
                      row_condition: str | None = None, exclusion_condition: str | None = None) -> DataFrame:
    """Periods (or n-period buckets from the start) between two dates without a row; the end is left out."""
    rows = _where(df, row_condition)
    span = rows.agg(F.min(date_col).cast("date").cast("timestamp_ntz").alias("a"), F.max(date_col).cast("date").cast("timestamp_ntz").alias("b"))
    first = D.as_timestamp(start) if start else span.select("a").scalar()
    last = D.as_timestamp(end) if end else span.select("b").scalar()
    name = f"date_{part}"
    step = {"hour": "INTERVAL 1 HOUR", "day": "INTERVAL 1 DAY", "week": "INTERVAL 7 DAYS", "month": "INTERVAL 1 MONTH"}[part]
    spine = rows.agg(F.lit(1).alias("x")).select(first.alias("a"), last.alias("b")).filter("a < b").select(
        "a", "b", F.explode(F.sequence("a", "b", F.expr(step))).alias(name)).filter(F.col(name) < F.col("b"))
    if interval > 1:
        spine = spine.filter(F.pmod(D.boundaries("a", F.col(name), part), F.lit(interval)) == 0)
    offset = F.pmod(D.boundaries(first, F.col("__p"), part), F.lit(interval))
    counts = rows.select(F.date_trunc(part, F.col(date_col)).cast("timestamp_ntz").alias("__p")).groupBy("__p").agg(F.count("*").alias("n"))
    if interval > 1:
        counts = counts.withColumn("__p", F.col("__p") - _step(part, offset)).groupBy("__p").agg(F.sum("n").alias("n"))
    out = spine.select(name).join(counts, F.col(name) == F.col("__p"), "left_anti").withColumn("row_cnt", F.lit(0).cast("bigint"))
    return out.filter(exclusion_condition) if exclusion_condition else out


# Two-column comparisons.
PAIR_RULES = {"gt": lambda a, b: a > b, "gte": lambda a, b: a >= b, "eq": lambda a, b: a == b}


def expect_pair(df: DataFrame, a: str, b: str, op: str, row_condition: str | None = None) -> DataFrame:
    return _where(df, row_condition).filter(~PAIR_RULES[op](F.col(a), F.col(b)))


def expect_pair_in_set(df: DataFrame, a: str, b: str, pairs: list[tuple], row_condition: str | None = None) -> DataFrame:
    hit = F.lit(False)
    for x, y in pairs:
        hit = hit | ((F.col(a) == x) & (F.col(b) == y))
    return _where(df, row_condition).filter(~hit)


def expect_multicolumn_sum(df: DataFrame, cols: list[str], total, group_by=(), row_condition: str | None = None) -> DataFrame:
    """Groups in which the columns' sums do not add up to a number or to another aggregate."""
    parts = [F.coalesce(F.sum(c), F.lit(0)) for c in cols]
    value = parts[0]
    for p in parts[1:]:
        value = value + p
    sums = _where(df, row_condition).groupBy(*_cols(group_by)).agg(value.alias("sum_of_columns"), _e(total).alias("expected") if isinstance(total, (str, Column)) else F.lit(total).alias("expected"))
    return sums.filter("sum_of_columns <> expected")


def expect_unique_within_record(df: DataFrame, cols: list[str], ignore: str = "all_values_are_missing", row_condition: str | None = None) -> DataFrame:
    """Rows in which two listed columns hold the same value; decided inside the row, nothing is shuffled."""
    kept = _where(df, row_condition).filter(ignore_row_if(cols, ignore))
    values = F.array(*[F.col(c).cast("string") for c in cols])
    filled = F.filter(values, lambda v: v.isNotNull())
    holes = F.when(F.size(values) - F.size(filled) > 1, True).otherwise(False) if ignore == "never" else F.lit(False)
    return kept.filter((F.size(F.array_distinct(filled)) < F.size(filled)) | holes)


def expect_length(df: DataFrame, col: str, low=None, high=None, equal: int | None = None, row_condition: str | None = None, strictly: bool = False) -> DataFrame:
    if equal is not None:
        return _where(df, row_condition).filter(F.length(col) != equal)
    return expect_between(df, F.length(col), low, high, None, row_condition, strictly)


def _match(df: DataFrame, hits: list[Column], positive: bool, match_on: str, row_condition: str | None) -> DataFrame:
    if match_on not in ("any", "all"):
        raise ValueError("match_on must be 'any' or 'all'")
    ok = None
    for hit in hits:
        rule = hit if positive else ~hit
        ok = rule if ok is None else (ok | rule if match_on == "any" else ok & rule)
    return _where(df, row_condition).filter(~ok)


def expect_like(df: DataFrame, col: str, patterns: str | list[str], positive: bool = True, match_on: str = "any", row_condition: str | None = None) -> DataFrame:
    return _match(df, [F.col(col).like(p) for p in _cols(patterns)], positive, match_on, row_condition)


def expect_regex(df: DataFrame, col: str, patterns: str | list[str], positive: bool = True, match_on: str = "any", flags: str = "",
                 row_condition: str | None = None) -> DataFrame:
    inline = f"(?{flags})" if flags else ""
    return _match(df, [F.col(col).rlike(inline + p) for p in _cols(patterns)], positive, match_on, row_condition)


# ---- table shape: decided from the schema, reported in the same form as row checks

def _finding(df: DataFrame, ok: bool, detail: str) -> DataFrame:
    return df.sparkSession.range(0 if ok else 1).select(F.lit(detail).alias("finding"))


def expect_column(df: DataFrame, col: str, index: int | None = None) -> DataFrame:
    names = [c.lower() for c in df.columns]
    found = col.lower() in names and (index is None or names.index(col.lower()) + 1 == index)
    return _finding(df, found, f"column {col} not found" + (f" at position {index}" if index else ""))


def expect_columns(df: DataFrame, cols: list[str], mode: str) -> DataFrame:
    have, want = [c.upper() for c in df.columns], [c.upper() for c in cols]
    ok = {
        "contain": set(want) <= set(have),
        "match_set": set(want) == set(have),
        "match_ordered": want == have,
        "not_contain": not set(want) & set(have),
    }[mode]
    return _finding(df, ok, f"columns {have} do not satisfy {mode} {want}")


def expect_column_count(df: DataFrame, low: int | None = None, high: int | None = None, equal: int | None = None, other: DataFrame | None = None) -> DataFrame:
    n = len(df.columns)
    target = equal if equal is not None else len(other.columns) if other is not None else None
    ok = n == target if target is not None else (low is None or n >= low) and (high is None or n <= high)
    return _finding(df, ok, f"{n} columns")


def expect_type(df: DataFrame, col: str, types: str | list[str]) -> DataFrame:
    actual = df.schema[col].dataType.simpleString().lower()
    return _finding(df, actual in [t.lower() for t in _cols(types)], f"column {col} is {actual}")


def expect_row_count(df: DataFrame, low=None, high=None, equal: int | None = None, other: DataFrame | None = None, factor: int = 1, group_by=(),
                     row_condition: str | None = None, row_condition_b: str | None = None) -> DataFrame:
    """Row counts out of bounds, unlike a number, or unlike ``factor`` times another table's count."""
    if other is not None:
        return expect_equal_expression(df, F.count("*"), other, F.count("*") * factor, group_by, row_condition=row_condition, row_condition_b=row_condition_b)
    if equal is not None:
        low = high = equal
    return expect_between(df, F.count("*"), low, high, _cols(group_by), row_condition)


def expect_recent(df: DataFrame, col: str, part: str, n: int, as_of: str, group_by=None, row_condition: str | None = None) -> DataFrame:
    """Newest value (future rows left out) before the cutoff; no row at all fails as well."""
    now = D.as_timestamp(as_of)
    past = F.max(F.when(F.col(col) <= now, F.col(col)))
    newest = _where(df, row_condition).groupBy(*_cols(group_by or [])).agg(past.alias("latest"))
    cutoff = now - _step(part, str(n))
    return newest.withColumn("cutoff", cutoff).filter("latest IS NULL OR latest < cutoff")
