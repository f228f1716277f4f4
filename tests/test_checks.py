"""Every check on data that passes and on data that fails."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import checks as K
from tidemark.operators import expectations as X


@pytest.fixture
def data(frame):
    return frame([(1, "2020-10-21", 0.0, 1.0, "a", "b", None), (2, "2020-10-22", 1.0, 0.0, "b", "ab", None), (3, "2020-10-23", 2.0, 3.0, "c", "abc", None),
                  (4, "2020-10-24", 0.5, 0.5, "c", "abcd", "x")], "idx int, date_col string, a double, b double, s string, s2 string, hole string")


def d(n):
    return dt.date(2024, 1, n)


def fails(df, n=None):
    count = df.count()
    return count > 0 if n is None else count == n


CASES = {
    "accepted_range": (lambda x: K.accepted_range(x, "a", 0.0, 2.0), lambda x: K.accepted_range(x, "a", 0.0, 2.0, inclusive=False), 2),
    "range_one_bound": (lambda x: K.accepted_range(x, "a", min_value=0.0), lambda x: K.accepted_range(x, "a", max_value=1.0), 1),
    "at_least_one": (lambda x: K.at_least_one(x, "hole"), lambda x: K.at_least_one(x, "hole", "s"), 2),
    "expression": (lambda x: K.expression_is_true(x, "a >= 0"), lambda x: K.expression_is_true(x, "< 2", "a"), 1),
    "not_accepted": (lambda x: K.not_accepted_values(x, "s", ["z"]), lambda x: K.not_accepted_values(x, "s", ["c"]), 1),
    "accepted": (lambda x: K.accepted_values(x, "s", ["a", "b", "c"]), lambda x: K.accepted_values(x, "s", ["a"]), 2),
    "not_constant": (lambda x: K.not_constant(x, "s"), lambda x: K.not_constant(x.withColumn("k", F.lit(1)), "k"), 1),
    "not_empty": (lambda x: K.not_empty_string(x, "s"), lambda x: K.not_empty_string(x.withColumn("s", F.lit(" ")), "s"), 4),
    "proportion": (lambda x: K.not_null_proportion(x, "hole", 0.25), lambda x: K.not_null_proportion(x, "hole", 0.5), 1),
    "unique_combination": (lambda x: K.unique_combination(x, ["s", "s2"]), lambda x: K.unique_combination(x, ["s"]), 1),
    "not_null": (lambda x: K.not_null(x, "s"), lambda x: K.not_null(x, "hole"), 3),
    "unique": (lambda x: K.unique(x, "hole"), lambda x: K.unique(x, "s"), 1),
    "all_null": (lambda x: K.all_null_rows(x, ["hole", "s"]), lambda x: K.all_null_rows(x, ["hole"], "idx < 3"), 2),
    "implied_nonzero": (lambda x: K.implied_nonzero(x, "b", "idx"), lambda x: K.implied_nonzero(x, "a", "b"), 1),
    "code_format": (lambda x: K.code_format(x, ["idx"], "s2", "^a", ["b"]), lambda x: K.code_format(x, ["idx"], "s2", "^ab", ["d"]), 2),
    "sequential": (lambda x: K.sequential_values(x, "idx"), lambda x: K.sequential_values(x, "idx", 2), 3),
    "missing_predecessor": (lambda x: K.missing_predecessor(x.withColumn("u", F.lit(1)), "u", "idx", F.lit(True)),
                            lambda x: K.missing_predecessor(x.withColumn("u", F.lit(1)), "u", "idx", F.col("idx") != 2, ranked=False), 1),
    "true": (lambda x: X.expect_true(x, "a <= 2", row_condition="idx < 4"), lambda x: X.expect_true(x, "count(*) > 1", "s"), 2),
    "between": (lambda x: X.expect_values_between(x, "a", 0, 2), lambda x: X.expect_values_between(x, "a", 0, 2, strictly=True), 2),
    "distinct_count": (lambda x: X.expect_distinct_count(x, "s", "eq", 3), lambda x: X.expect_distinct_count(x, "s", "lt", 3), 1),
    "distinct_in": (lambda x: X.expect_distinct_values(x, "s", ["a", "b", "c"], "in"), lambda x: X.expect_distinct_values(x, "hole", ["x"], "in"), 1),
    "distinct_contain": (lambda x: X.expect_distinct_values(x, "s", ["a"], "contain"), lambda x: X.expect_distinct_values(x, "s", ["a", "q"], "contain"), 1),
    "distinct_equal": (lambda x: X.expect_distinct_values(x, "s", ["a", "b", "c"], "equal"), lambda x: X.expect_distinct_values(x, "s", ["a", "b", "q"], "equal"), 2),
    "agg_max": (lambda x: X.expect_agg_between(x, "max", "a", 2, 2), lambda x: X.expect_agg_between(x, "max", "a", 2, 3, strictly=True), 1),
    "agg_median": (lambda x: X.expect_agg_between(x, "median", "a", 0.75, 0.75), lambda x: X.expect_agg_between(x, "median", "a", 1, 2), 1),
    "agg_stddev": (lambda x: X.expect_agg_between(x, "stddev", "a", 0.8, 0.9), lambda x: X.expect_agg_between(x, "stddev", "a", 2, 3), 1),
    "quantile": (lambda x: X.expect_quantile(x, "a", 1.0, 2, 2), lambda x: X.expect_quantile(x, "a", 0.0, 1, 2), 1),
    "unique_share": (lambda x: X.expect_unique_proportion(x, "s", 0.75, 0.75), lambda x: X.expect_unique_proportion(x, "s", 0.9, 1), 1),
    "most_common": (lambda x: X.expect_most_common(x, "s", ["c"]), lambda x: X.expect_most_common(x, "s", ["a"]), 1),
    "increasing": (lambda x: X.expect_monotone(x, "idx", "date_col"), lambda x: X.expect_monotone(x, "a", "idx"), 1),
    "decreasing": (lambda x: X.expect_monotone(x.withColumn("n", -F.col("idx")), "n", "idx", "decreasing"), lambda x: X.expect_monotone(x, "idx", "idx", "decreasing"), 3),
    "in_set": (lambda x: X.expect_values_in_set(x, "s", ["a", "b", "c"]), lambda x: X.expect_values_in_set(x, "hole", ["x"]), 3),
    "not_in_set": (lambda x: X.expect_values_in_set(x, "hole", ["y"], negate=True), lambda x: X.expect_values_in_set(x, "s", ["c"], negate=True), 2),
    "null": (lambda x: X.expect_null(x, "hole", "idx < 4"), lambda x: X.expect_null(x, "hole"), 1),
    "compound": (lambda x: X.expect_compound_unique(x, ["s", "s2"]), lambda x: X.expect_compound_unique(x, ["s"]), 1),
    "casing": (lambda x: X.expect_consistent_casing(x, "s"), lambda x: X.expect_consistent_casing(x.union(x.withColumn("s", F.upper("s"))), "s", True), 6),
    "stdevs": (lambda x: X.expect_within_stdevs(x, "a", "idx", 3), lambda x: X.expect_within_stdevs(x, "a", "idx", 1), 2),
    "pair_gt": (lambda x: X.expect_pair(x, "b", "a", "gte", "idx IN (1, 3, 4)"), lambda x: X.expect_pair(x, "b", "a", "gt"), 2),
    "pair_set": (lambda x: X.expect_pair_in_set(x, "s", "s2", [("a", "b"), ("b", "ab"), ("c", "abc"), ("c", "abcd")]), lambda x: X.expect_pair_in_set(x, "s", "s2", [("a", "b")]), 3),
    "multicolumn": (lambda x: X.expect_multicolumn_sum(x, ["a", "b"], 8.0), lambda x: X.expect_multicolumn_sum(x, ["a", "b"], 7.0), 1),
    "within_record": (lambda x: X.expect_unique_within_record(x, ["s", "s2", "hole"]), lambda x: X.expect_unique_within_record(x, ["a", "b"]), 1),
    "length": (lambda x: X.expect_length(x, "s", equal=1), lambda x: X.expect_length(x, "s2", 2, 3), 2),
    "like": (lambda x: X.expect_like(x, "s2", ["a%", "b"]), lambda x: X.expect_like(x, "s2", "a%"), 1),
    "not_like": (lambda x: X.expect_like(x, "s2", "z%", False), lambda x: X.expect_like(x, "s2", ["%c%", "%d%"], False, "all"), 2),
    "regex": (lambda x: X.expect_regex(x, "s2", "^[A-D]+$", flags="i"), lambda x: X.expect_regex(x, "s2", ["c", "d"], match_on="all"), 3),
    "column": (lambda x: X.expect_column(x, "IDX", 1), lambda x: X.expect_column(x, "idx", 2), 1),
    "columns_order": (lambda x: X.expect_columns(x, x.columns, "match_ordered"), lambda x: X.expect_columns(x, x.columns[::-1], "match_ordered"), 1),
    "columns_not": (lambda x: X.expect_columns(x, ["q"], "not_contain"), lambda x: X.expect_columns(x, ["idx"], "not_contain"), 1),
    "column_count": (lambda x: X.expect_column_count(x, equal=7), lambda x: X.expect_column_count(x, 8), 1),
    "type": (lambda x: X.expect_type(x, "idx", ["BIGINT", "INT"]), lambda x: X.expect_type(x, "idx", "string"), 1),
    "row_count": (lambda x: X.expect_row_count(x, equal=4), lambda x: X.expect_row_count(x, 2, group_by="s"), 2),
    "times_factor": (lambda x: X.expect_row_count(x.union(x), other=x, factor=2), lambda x: X.expect_row_count(x, other=x, factor=2), 1),
    "equal_expression": (lambda x: X.expect_equal_expression(x, F.sum("a"), x, F.sum("b"), tolerance=1), lambda x: X.expect_equal_expression(x, F.sum("a"), x, F.sum("b"), tolerance_percent=0.2), 1),
}


@pytest.mark.parametrize("name", list(CASES))
def test_pass_and_fail(data, name):
    ok, bad, n = CASES[name]
    assert ok(data).count() == 0
    assert bad(data).count() == n


def test_two_table_checks(frame):
    a, b = frame([(1,), (2,), (2,)], "x int"), frame([(1,), (2,)], "x int")
    assert not fails(K.cardinality_equality(a, "x", a, "x")) and fails(K.cardinality_equality(a, "x", b, "x"), 2)
    assert not fails(K.equal_rowcount(a, a)) and rows(K.equal_rowcount(a, b).select("diff_count")) == [(1,)]
    assert rows(K.equal_rowcount(a, frame([], "x int")).select("diff_count")) == [(3,)]
    assert not fails(K.fewer_rows_than(b, a)) and rows(K.fewer_rows_than(a, a).select("row_count_delta")) == [(1,)]
    assert not fails(K.equality(a, b)) and fails(K.equality(a, frame([(9,)], "x int")), 3)
    assert not fails(K.relationships_where(a, "x", b, "x")) and fails(K.relationships_where(a, "x", b, "x", to_cond="x < 2"), 2)
    assert not fails(K.equal_sums(a, a, ["x"])) and fails(K.equal_sums(a, b, ["x"]), 1)


RANGES = {
    "adjacent": [(1, d(1), d(2)), (1, d(2), d(4))],
    "gap": [(1, d(1), d(2)), (1, d(3), d(4))],
    "overlap": [(1, d(1), d(3)), (1, d(2), d(4))],
    "empty": [(1, d(1), d(1)), (1, d(1), d(2))],
    "open": [(1, d(1), None)],
}


@pytest.mark.parametrize("kind,gaps,zero,n", [
    ("adjacent", "allowed", False, 0), ("adjacent", "not_allowed", False, 0), ("adjacent", "required", False, 1), ("gap", "not_allowed", False, 1), ("gap", "required", False, 0),
    ("overlap", "allowed", False, 1), ("empty", "allowed", False, 1), ("empty", "allowed", True, 0), ("open", "allowed", False, 1),
])
def test_mutually_exclusive_ranges(frame, kind, gaps, zero, n):
    df = frame(RANGES[kind], "id int, lo date, hi date")
    assert K.mutually_exclusive_ranges(df, "lo", "hi", "id", gaps, zero).count() == n


def test_recency_and_freshness(frame):
    df = frame([(1, dt.datetime(2024, 1, 9, 12)), (2, dt.datetime(2024, 1, 1))], "g int, ts timestamp_ntz")
    assert not fails(K.recency(df, "ts", "day", 1, "2024-01-10 00:00:00"))
    assert rows(K.recency(df, "ts", "day", 1, "2024-01-10 00:00:00", group_by="g").select("g")) == [(2,)]
    assert not fails(K.recency(df.filter("g = 1"), "ts", "day", 1, "2024-01-10 23:00:00", ignore_time=True))
    assert K.freshness(df, "ts", "2024-01-11 13:00:00", 1, 2).first()["state"] == "error"
    assert not fails(X.expect_recent(df, "ts", "day", 1, "2024-01-10 00:00:00"))
    assert fails(X.expect_recent(df, "ts", "day", 1, "2024-01-10 00:00:00", "g"), 1)
    # rows of the future do not count, and no row at all fails
    assert fails(X.expect_recent(df, "ts", "day", 1, "2024-01-08 00:00:00"), 1)
    assert fails(X.expect_recent(df.filter("g = 9"), "ts", "day", 1, "2024-01-10"), 1)


def test_data_every(frame):
    df = frame([(dt.datetime(2020, 1, n, 5),) for n in (1, 2, 4, 7)], "ts timestamp_ntz")
    assert [r[0].day for r in X.expect_data_every(df, "ts").orderBy("date_day").collect()] == [3, 5, 6]
    assert [r[0].day for r in X.expect_data_every(df, "ts", interval=2, start="2020-01-01", end="2020-01-09").orderBy("date_day").collect()] == [5]
    assert X.expect_data_every(df, "ts", exclusion_condition="day(date_day) = 3").count() == 1


def test_moving_stdevs(frame):
    values = [10.0, 11.0, 10.0, 12.0, 11.0, 10.0, 11.0, 12.0, 10.0, 500.0, 11.0]
    df = frame([(dt.datetime(2024, 1, 1 + i), v) for i, v in enumerate(values)], "ts timestamp_ntz, v double")
    hit = X.expect_within_moving_stdevs(df, "v", "ts", "2024-01-12", test=5)
    assert [r["metric_period"].day for r in hit.orderBy("metric_period").collect()] == [10]
    assert X.expect_within_moving_stdevs(df, "v", "ts", "2024-01-12", test=1).count() == 0


def test_run_checks_and_keys(frame):
    df = frame([(1,), (None,)], "x int")
    out = K.run_checks({"a": K.not_null(df, "x"), "b": lambda: K.unique(df, "x"), "c": K.not_null(df, "x")},
                       fail_calc={"c": F.count("*") * 10}, severity={"c": "warn"})
    assert rows(out) == [("a", 1, "error", "fail"), ("b", 0, "error", "pass"), ("c", 10, "warn", "warn")]
    assert K.check_result_keys(out, "r").select("result_id").distinct().count() == 3


def test_arguments_are_checked(data):
    for bad in (lambda: K.accepted_range(data, "a"), lambda: K.mutually_exclusive_ranges(data, "a", "b", gaps="some"), lambda: X.expect_between(data, "a"),
                lambda: X.ignore_row_if(["a"], "sometimes"), lambda: X.expect_like(data, "s", "a", match_on="most")):
        with pytest.raises(ValueError):
            bad()
