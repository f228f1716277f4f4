"""Split windows must equal plain windows, whatever the skew."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import aggregates as A
from tidemark.operators import windows as W
from tidemark.operators.aggregates import percentile_cont

OUTPUTS = {
    "s": ("sum", "v"), "p": ("peer_sum", "v"), "b": ("lag", "v"), "n": ("lead", "v"), "l": ("last", "w"),
    "r": ("rank", None), "d": ("dense_rank", None), "rn": ("row_number", None),
}


@pytest.fixture
def skewed(frame):
    """One key holds a third of the rows; times repeat, values and one key are sometimes missing."""
    rnd = random.Random(3)
    data = []
    for i in range(600):
        key = 1 if i % 3 == 0 else rnd.choice([2, 3, 4, 5, 6, None])
        data.append((key, rnd.randint(0, 60), i, rnd.choice([None, rnd.randint(-5, 9)]), rnd.choice([None, None, f"w{i}"])))
    return frame(data, "k int, t int, id int, v int, w string")


@pytest.fixture
def gaps(skewed):
    """Order values are missing on some rows, for the hot key and for others."""
    return skewed.withColumn("t", F.when(F.col("id") % 7 != 0, F.col("t")))


@pytest.mark.parametrize("hot", [3, 20, 150])
@pytest.mark.parametrize("order", [["t", "id"], ["t"], ["id"]])
def test_split_equals_plain_with_null_order(gaps, monkeypatch, hot, order):
    """Nulls come first, in a bucket of their own; with one order column ties leave only the tie-free kinds."""
    monkeypatch.setattr(W, "HOT_ROWS", hot)
    data = gaps.withColumn("id", F.when(F.col("id") > 1, F.col("id"))) if order == ["id"] else gaps
    data = data.dropDuplicates(["k", "id"]) if order == ["id"] else data
    outputs = {k: OUTPUTS[k] for k in ("p", "r", "d")} if order == ["t"] else OUTPUTS
    bucket = F.floor(F.col(order[0]) / 7)
    assert rows(W.split_window(data, "k", order, bucket, outputs)) == rows(W.split_window(data, "k", order, None, outputs))


def test_one_null_time_of_a_hot_key(frame, monkeypatch):
    data = frame([(1, None, 5), (1, 1, 6), (1, 2, 7), (1, 3, 8)], "k int, t int, v int")
    monkeypatch.setattr(W, "HOT_ROWS", 2)
    out = W.split_window(data, "k", ["t"], F.col("t"), {"d": ("dense_rank", None), "b": ("lag", "v"), "l": ("last", "v")})
    assert rows(out.select("v", "d", "b", "l")) == [(5, 1, None, 5), (6, 2, 5, 6), (7, 3, 6, 7), (8, 4, 7, 8)]


@pytest.mark.parametrize("hot", [20, 150])
@pytest.mark.parametrize("order", [["t", "id"], ["t"]])
def test_split_equals_plain(skewed, monkeypatch, hot, order):
    monkeypatch.setattr(W, "HOT_ROWS", hot)
    outputs = OUTPUTS if len(order) == 2 else {k: OUTPUTS[k] for k in ("p", "r", "d")}
    split = W.split_window(skewed, "k", order, F.floor(F.col("t") / 7), outputs)
    assert rows(split) == rows(W.split_window(skewed, "k", order, None, outputs))


def whole():
    return Window.orderBy("t", "id")


def test_split_without_keys(skewed):
    split = W.split_window(skewed, [], ["t", "id"], F.floor(F.col("t") / 5), OUTPUTS)
    plain = {n: {"s": F.sum("v").over(whole().rowsBetween(W.FIRST_ROW, 0)), "p": F.sum("v").over(whole().rangeBetween(W.FIRST_ROW, 0)), "b": F.lag("v").over(whole()),
                 "n": F.lead("v").over(whole()), "l": F.last("w", True).over(whole().rowsBetween(W.FIRST_ROW, 0)), "r": F.rank().over(whole()),
                 "d": F.dense_rank().over(whole()), "rn": F.row_number().over(whole())}[n] for n in OUTPUTS}
    assert rows(split) == rows(skewed.withColumns(plain)) == rows(W.split_window(skewed, [], ["t", "id"], None, OUTPUTS))


def test_hot_keys_are_bounded(skewed):
    assert [r["__k_k"] for r in W.hot_keys(skewed, ["k"], 150).collect()] == [1]


def test_only_hot_keys_get_buckets(skewed, monkeypatch):
    """With no hot key the carry side is empty, so each key stays one window."""
    monkeypatch.setattr(W, "HOT_ROWS", 10_000)
    base = skewed.withColumn("__in0", F.col("v"))
    hot = W.hot_keys(base, ["k"])
    assert hot.count() == 0


def test_global_rank(skewed):
    got = W.global_rank(skewed.filter("v IS NOT NULL"), "v", "id")
    want = skewed.filter("v IS NOT NULL").withColumn("ranking", F.row_number().over(Window.orderBy(F.desc("v"), "id")))
    assert rows(got.select("id", "ranking")) == rows(want.select("id", "ranking"))


@pytest.mark.parametrize("q", [0.0, 0.5, 0.77])
def test_percentile_is_exact(skewed, monkeypatch, q):
    monkeypatch.setattr(W, "HOT_ROWS", 3)
    want = skewed.groupBy("k").agg(F.expr(f"percentile(v, {q})").alias("percentile"))
    got = percentile_cont(skewed, "v", q, "k")
    assert rows(got.withColumn("percentile", F.round("percentile", 9))) == rows(want.withColumn("percentile", F.round("percentile", 9)))
    assert percentile_cont(skewed, "v", q).first()[0] == pytest.approx(skewed.agg(F.expr(f"percentile(v, {q})")).first()[0])


@pytest.mark.parametrize("few", [9, 100])
def test_percentiles_by_bracketing(spark, monkeypatch, few):
    """Ties, spikes, outliers and missing keys, with brackets that must shrink to a few rows."""
    monkeypatch.setattr(W, "HOT_ROWS", 50)
    monkeypatch.setattr(A, "RANK_ROWS", few)
    monkeypatch.setattr(A, "GRID", 8)
    r = random.Random(few)
    data = [("ties", float(r.randint(0, 3))) for _ in range(400)] + [("wide", r.choice([-1, 1]) * 10.0 ** r.randint(-300, 300)) for _ in range(900)]
    data += [("spike", 7.0 if r.random() < 0.7 else r.random() * 14) for _ in range(500)] + [("same", 2.5)] * 80 + [(None, r.gauss(0, 1)) for _ in range(300)]
    data += [("small", float(i)) for i in range(5)] + [("none", None)] * 60
    r.shuffle(data)
    df = spark.createDataFrame(data, "k string, v double").repartition(4)
    qs = {"a": 0.0, "b": 0.03, "c": 0.5, "d": 0.77, "e": 1.0}
    near = lambda x: [tuple(c if c is None or isinstance(c, str) else float(f"{c:.9g}") for c in row) for row in rows(x)]
    want = df.filter("v IS NOT NULL").groupBy("k").agg(*[F.expr(f"percentile(v, {q})").alias(n) for n, q in qs.items()])
    assert near(A.percentiles(df, "v", qs, "k")) == near(want)
    assert near(A.percentiles(df, "v", qs)) == near(df.agg(*[F.expr(f"percentile(v, {q})").alias(n) for n, q in qs.items()]))


def test_deduplicate_and_latest(frame):
    df = frame([(1, "play", 1), (1, "play", 2), (2, "play", 1)], "user_id int, event string, version int")
    assert rows(W.deduplicate(df, "user_id", [F.desc("version")])) == [(1, "play", 2), (2, "play", 1)]
    assert rows(W.latest_per_key(df, "user_id", "version")) == [(1, "play", 2), (2, "play", 1)]


def test_keep_group_max_keeps_ties(frame):
    df = frame([(1, 5), (1, 5), (1, 3), (None, 2)], "k int, t int")
    assert rows(W.keep_group_max(df, "k", "t")) == sorted([(1, 5), (1, 5), (None, 2)], key=repr)


def test_period_deltas_guard(frame):
    df = frame([(1, 0), (2, 4), (3, 2)], "t int, v int")
    got = {r["t"]: (r["v_prev"], r["v_delta"], r["v_delta_pct"]) for r in W.period_deltas(df, [], "t", ["v"]).collect()}
    assert got == {1: (None, None, None), 2: (0, 4, 4.0), 3: (4, -2, -0.5)}


def test_cumulative_until_drops_keys_without_a_stop(frame):
    df = frame([(1, 1, "c"), (1, 2, "p"), (1, 3, "p"), (2, 1, "c")], "k int, t int, e string")
    out = W.cumulative_until(df, "k", "t", F.col("e") == "p", {"n": F.lit(1)})
    assert rows(out) == [(1, 2, 2)]


@pytest.mark.parametrize("keys", [["k"], []])
@pytest.mark.parametrize("n", [1, 4, 25])
def test_trailing_on_hot_keys_equals_the_plain_window(spark, monkeypatch, keys, n):
    monkeypatch.setattr(W, "HOT_ROWS", 5)
    r = random.Random(n)
    start = dt.datetime(2024, 1, 1)
    data = [(r.choice(["a", "a", "a", "b", None]), None if r.random() < 0.15 else start + dt.timedelta(minutes=r.randint(0, 600)), i, r.randint(-9, 9) if r.random() < 0.9 else None) for i in range(300)]
    data += [("one", start, 1000, 7), (None, None, 1001, 8)]
    df = spark.createDataFrame(data, "k string, t timestamp, id int, v int")
    outputs = {"s": ("sum", "v"), "m": ("max", "v"), "l": ("min", "v"), "c": ("count", "v"), "a": ("avg", "v"), "d": ("stddev", "v")}
    plain = W.trailing(df, keys, ["t", "id"], n, outputs)
    split = W.trailing(df, keys, ["t", "id"], n, outputs, bucket=F.date_trunc("hour", "t"))
    assert split.columns == plain.columns
    same = lambda x: [tuple(round(v, 9) if isinstance(v, float) else v for v in row) for row in rows(x)]
    assert same(split) == same(plain)
