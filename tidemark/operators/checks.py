"""Data-quality checks. Each returns the failing rows; an empty result is a pass.

A condition that evaluates to NULL counts as passed, as in SQL. ``run_checks`` turns a set of checks into one
results table.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.dates import as_timestamp
from ..functions.numeric import surrogate_key
from .joins import null_safe_join
from .sets import symmetric_diff
from .windows import _cols, split_window


def accepted_range(df: DataFrame, col: str, min_value=None, max_value=None, inclusive: bool = True) -> DataFrame:
    if min_value is None and max_value is None:
        raise ValueError("give min_value, max_value or both")
    c, out = F.col(col), F.lit(False)
    if min_value is not None:
        out = out | (c < min_value if inclusive else c <= min_value)
    if max_value is not None:
        out = out | (c > max_value if inclusive else c >= max_value)
    return df.filter(out)


def at_least_one(df: DataFrame, col: str, group_by=()) -> DataFrame:
    """Groups (or the whole table) in which the column is never filled."""
    return df.groupBy(*_cols(group_by)).agg(F.count(col).alias("filled")).filter("filled = 0")


def cardinality_equality(a: DataFrame, col: str, b: DataFrame, field: str) -> DataFrame:
    """(value, count) pairs that the other table does not have."""
    def counts(df, c):
        return df.groupBy(F.col(c).alias("value")).agg(F.count("*").alias("num_rows"))

    return symmetric_diff(counts(a, col), counts(b, field))


def _paired_counts(a: DataFrame, b: DataFrame, group_by) -> DataFrame:
    """Row counts of both sides per group, from one union and one aggregation."""
    keys = _cols(group_by)

    def side(df, left):
        return df.groupBy(*keys).agg(F.count("*").alias("__n")).select(
            *keys, F.when(F.lit(left), F.col("__n")).alias("count_a"), F.when(F.lit(not left), F.col("__n")).alias("count_b"))

    return side(a, True).unionByName(side(b, False)).groupBy(*keys).agg(F.max("count_a").alias("count_a"), F.max("count_b").alias("count_b"))


def equal_rowcount(a: DataFrame, b: DataFrame, group_by=()) -> DataFrame:
    diff = F.abs(F.coalesce("count_a", F.lit(0)) - F.coalesce("count_b", F.lit(0)))
    return _paired_counts(a, b, group_by).withColumn("diff_count", diff).filter("diff_count > 0")


def fewer_rows_than(a: DataFrame, b: DataFrame, group_by=()) -> DataFrame:
    """Groups in which a does not have strictly fewer rows than b; equal counts report 1."""
    n = F.coalesce("count_a", F.lit(0)) - F.coalesce("count_b", F.lit(0))
    return _paired_counts(a, b, group_by).withColumn("row_count_delta", F.when(n > 0, n).when(n == 0, 1).otherwise(0)).filter("row_count_delta > 0")


def equality(a: DataFrame, b: DataFrame, cols: list[str] | None = None) -> DataFrame:
    return symmetric_diff(a, b, cols)


def expression_is_true(df: DataFrame, expression: str | Column, col: str | None = None) -> DataFrame:
    """Rows where the condition is false; with ``col`` the text is appended to it (``col`` + ``">= 0"``)."""
    cond = expression if isinstance(expression, Column) else F.expr(f"{col} {expression}" if col else expression)
    return df.filter(~cond)


# How the end of a range must relate to the start of the next one.
GAP_RULES = {
    "not_allowed": lambda end, nxt: end == nxt,
    "allowed": lambda end, nxt: end <= nxt,
    "required": lambda end, nxt: end < nxt,
}


def mutually_exclusive_ranges(df: DataFrame, lo: str, hi: str, partition_by=(), gaps: str = "allowed", zero_length: bool = False,
                              bucket: Column | None = None) -> DataFrame:
    """Ranges that are inverted, empty (unless allowed) or clash with the next range of their partition.

    A NULL bound fails.
    """
    if gaps not in GAP_RULES:
        raise ValueError(f"gaps must be one of {list(GAP_RULES)}")
    out = split_window(df, partition_by, [lo, hi], bucket, {"next_lower_bound": ("lead", lo), "__more": ("lead", F.lit(True))})
    shape = (F.col(lo) <= F.col(hi)) if zero_length else (F.col(lo) < F.col(hi))
    last = F.col("__more").isNull()
    fits = F.coalesce(GAP_RULES[gaps](F.col(hi), F.col("next_lower_bound")), last, F.lit(False))
    return out.filter(~(F.coalesce(shape, F.lit(False)) & fits)).drop("__more")


def not_accepted_values(df: DataFrame, col: str, values: list) -> DataFrame:
    return df.select(col).distinct().filter(F.col(col).isin(*values))


def not_constant(df: DataFrame, col: str, group_by=()) -> DataFrame:
    """Groups with exactly one distinct value; min and max tell without collecting the values."""
    stats = df.groupBy(*_cols(group_by)).agg(F.min(col).alias("lowest"), F.max(col).alias("highest"))
    return stats.filter("lowest = highest")


def not_empty_string(df: DataFrame, col: str, trim: bool = True) -> DataFrame:
    return df.filter((F.trim(col) if trim else F.col(col)) == "")


def not_null_proportion(df: DataFrame, col: str, at_least: float, at_most: float = 1.0, group_by=()) -> DataFrame:
    share = (F.count(col).cast("double") / F.count("*").cast("double")).alias("not_null_proportion")
    return df.groupBy(*_cols(group_by)).agg(share).filter(~F.col("not_null_proportion").between(at_least, at_most))


def recency(df: DataFrame, field: str, part: str, n: int, as_of: str, ignore_time: bool = False, group_by=()) -> DataFrame:
    """Groups whose newest value lies more than n parts before ``as_of``."""
    from .calendars import _step

    clock = as_timestamp(as_of)
    newest = F.max(field)
    if ignore_time:
        clock, newest = F.to_date(clock), F.max(F.to_date(field))
        limit = F.to_date(clock.cast("timestamp_ntz") - _step(part, str(n)))
    else:
        limit = clock - _step(part, str(n))
    return df.groupBy(*_cols(group_by)).agg(newest.alias("most_recent")).withColumn("threshold", limit).filter("most_recent < threshold")


def freshness(df: DataFrame, loaded_at: str, as_of: str, warn_days: int, error_days: int) -> DataFrame:
    """One row with the state of a source: pass, warn or error by the age of its newest row (empty is an error)."""
    age = F.timestamp_diff("DAY", F.col("newest").cast("timestamp"), F.lit(as_of).cast("timestamp_ntz").cast("timestamp"))
    state = F.when(F.col("newest").isNull() | (age >= error_days), "error").when(age >= warn_days, "warn").otherwise("pass")
    return df.agg(F.max(loaded_at).alias("newest")).withColumns({"age_days": age, "state": state})


def relationships_where(a: DataFrame, col: str, b: DataFrame, field: str, from_cond: str = "true", to_cond: str = "true") -> DataFrame:
    """Filled foreign keys without a partner."""
    keys = b.filter(to_cond).select(F.col(field).alias("__k")).filter("__k IS NOT NULL").distinct()
    return a.filter(from_cond).filter(F.col(col).isNotNull()).join(keys, F.col(col) == F.col("__k"), "left_anti")


def sequential_values(df: DataFrame, col: str, interval: int = 1, part: str | None = None, group_by=(), bucket: Column | None = None) -> DataFrame:
    """Rows that do not follow the previous value by exactly one interval; the first row passes."""
    from .calendars import _step

    out = split_window(df, group_by, [col], bucket, {"previous_value": ("lag", col)})
    expected = F.col("previous_value") + (_step(part, str(interval)) if part else F.lit(interval))
    return out.filter(F.col(col) != expected)


def unique_combination(df: DataFrame, cols: list[str]) -> DataFrame:
    """Column combinations that occur more than once; NULLs count as equal."""
    return df.groupBy(*cols).agg(F.count("*").alias("n_records")).filter("n_records > 1")


def not_null(df: DataFrame, col: str) -> DataFrame:
    return df.filter(F.col(col).isNull())


def unique(df: DataFrame, col: str) -> DataFrame:
    return unique_combination(df.filter(F.col(col).isNotNull()), [col])


def accepted_values(df: DataFrame, col: str, values: list) -> DataFrame:
    return df.groupBy(col).agg(F.count("*").alias("n_records")).filter(~F.col(col).isin(*values))


def all_null_rows(df: DataFrame, cols: list[str], condition: str = "true") -> DataFrame:
    """Rows under a condition in which every listed column is empty."""
    empty = reduce(lambda a, b: a & b, [F.col(c).isNull() for c in cols])
    return df.filter(condition).filter(empty)


def equal_sums(a: DataFrame, b: DataFrame, cols: list[str], tol: float = 1e-4) -> DataFrame:
    """Columns whose totals differ by more than the tolerance, one row per column."""
    both = a.select(*[F.sum(c).cast("double").alias(f"{c}_a") for c in cols],
                    *[b.agg(F.sum(c).cast("double")).scalar().alias(f"{c}_b") for c in cols])
    parts = F.array(*[F.struct(F.lit(c).alias("column_name"), F.col(f"{c}_a").alias("sum_a"), F.col(f"{c}_b").alias("sum_b")) for c in cols])
    return both.select(F.inline(parts)).filter(F.coalesce(F.abs(F.col("sum_a") - F.col("sum_b")) > tol, F.lit(True)))


def equal_sum_until(a: DataFrame, col_a: str, b: DataFrame, col_b: str, date_a: str, date_b: str, days: int) -> DataFrame:
    """Totals up to ``days`` before the latest date of the first table, when they differ."""
    cut = a.agg(F.date_sub(F.to_date(F.max(date_a)), days))
    total_b = b.filter(F.to_date(date_b) <= cut.scalar()).agg(F.sum(col_b).cast("double"))
    total_a = a.filter(F.to_date(date_a) <= cut.scalar()).agg(F.sum(col_a).cast("double").alias("sum_a"))
    return total_a.withColumn("sum_b", total_b.scalar()).filter(~F.col("sum_a").eqNullSafe(F.col("sum_b")))


def implied_nonzero(df: DataFrame, x: str, y: str) -> DataFrame:
    return df.filter((F.col(x) > 0) & (F.col(y) == 0))


def code_format(df: DataFrame, keys: list[str], col: str, must: str, must_not: list[str] = ()) -> DataFrame:
    """Distinct rows whose code matches one pattern and none of the others."""
    hit = F.col(col).rlike(must)
    for pattern in must_not:
        hit = hit & ~F.col(col).rlike(pattern)
    return df.select(*keys, col).filter(hit).distinct()


def missing_predecessor(df: DataFrame, user: str, step: str, success: Column, partition=(), ranked: bool = True) -> DataFrame:
    """Steps a user reached without a success at the step before.

    Steps are numbered by their rank among all steps of the partition, or taken as numbers themselves. The
    step list is ranked on its own, so its window holds distinct steps only.
    """
    part = _cols(partition)
    reached = df.withColumn("__ok", success.cast("int")).groupBy(user, *part, step).agg(F.max("__ok").alias("__ok"))
    if ranked:
        ranks = df.select(*part, step).distinct().withColumn("step_rank", F.dense_rank().over(Window.partitionBy(*part).orderBy(step)))
        reached = null_safe_join(reached, ranks, [*part, step])
    else:
        reached = reached.withColumn("step_rank", F.col(step).cast("int"))
    done = reached.filter("__ok = 1").select(user, *part, (F.col("step_rank") + 1).alias("step_rank"))
    later = reached.filter(F.col("step_rank") > 1).drop("__ok")
    return null_safe_join(later, done.distinct(), [user, *part, "step_rank"], "left_anti")


def run_checks(checks: dict[str, DataFrame | Callable[[], DataFrame]], fail_calc: dict[str, Column] | None = None,
               severity: dict[str, str] | None = None) -> DataFrame:
    """One row per check: name, number of failures, state. All checks run as one job.

    ``fail_calc`` replaces the row count of a check by an aggregate over its failing rows.
    """
    fail_calc, severity = fail_calc or {}, severity or {}
    parts = []
    for name, check in checks.items():
        rows = check() if callable(check) else check
        n = fail_calc.get(name, F.count("*"))
        parts.append(rows.agg(F.coalesce(n, F.lit(0)).cast("bigint").alias("failures")).select(
            F.lit(name).alias("check_name"), "failures", F.lit(severity.get(name, "error")).alias("severity")))
    out = reduce(DataFrame.unionByName, parts)
    return out.withColumn("state", F.when(F.col("failures") == 0, "pass").otherwise(F.when(F.col("severity") == "warn", "warn").otherwise("fail")))


def check_result_keys(results: DataFrame, run_id: str) -> DataFrame:
    """Results with a surrogate id for the history table."""
    return results.withColumns({"run_id": F.lit(run_id)}).withColumn("result_id", surrogate_key("run_id", "check_name"))
