import datetime as dt
import random
from fractions import Fraction

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators import aggregates as A
from tidemark.operators import calendars as C
from tidemark.operators import joins as J
from tidemark.operators import projections as P
from tidemark.operators import sets as S


def test_pivot_fills_with_else_value(frame):
    df = frame([("S", "red"), ("S", "blue"), ("M", "red"), ("S", "blue's")], "size string, color string")
    out = A.pivot(df, "size", "color", ["red", "blue", "blue's"])
    assert out.columns == ["size", "red", "blue", "blue's"]
    assert rows(out) == [("M", 1, 0, 0), ("S", 1, 1, 1)]
    assert rows(A.pivot(df, "size", "color", ["red"], then_value=F.lit(2), else_value=None, prefix="c_", suffix="_n", slug=True)) == [("M", 2), ("S", 2)]
    assert rows(A.pivot(df, [], "color", ["red"], cmp="!=")) == [(2,)]


def test_unpivot_keeps_nulls_and_casts(frame):
    df = frame([(1, "x", True, None)], "id int, name string, flag boolean, gone string")
    out = A.unpivot(df, exclude=["ID"], remove=["name"], field_name="prop", value_name="val")
    assert rows(out) == [(1, "flag", "true"), (1, "gone", None)]


def test_union_relations(frame):
    a = frame([(1, "ann", 7)], "id int, name string, favorite_number int")
    b = frame([(2, "red", 8)], "id int, favorite_color string, favorite_number int")
    out = S.union_relations({"a": a, "b": b}, overrides={"favorite_number": "bigint"})
    assert set(out.columns) == {"_source", "id", "name", "favorite_number", "favorite_color"}
    assert rows(out.select("_source", "id", "name", "favorite_color")) == [("a", 1, "ann", None), ("b", 2, None, "red")]
    assert dict(out.dtypes)["favorite_number"] == "bigint"
    assert S.union_relations({"a": a, "b": b}, include=["ID"], source_col=None).columns == ["id"]
    assert S.union_relations({"a": a, "b": b}, where="id > 1").count() == 1
    with pytest.raises(ValueError):
        S.union_relations({"a": a}, include=["id"], exclude=["name"])


def test_union_tables(spark, frame):
    for day in (1, 2):
        frame([(day, "e")], "user_id int, event string").createOrReplaceTempView(f"tm_ev_2018010{day}")
    assert rows(S.union_tables(spark, "tm_ev_*", exclude="*2", source_col=None)) == [(1, "e")]
    with pytest.raises(ValueError):
        S.union_tables(spark, "nothing_like_it*")


def test_symmetric_diff_counts_nulls_as_equal(frame):
    a, b = frame([(1,), (None,), (2,), (2,)], "x int"), frame([(None,), (3,)], "x int")
    assert rows(S.symmetric_diff(a, b)) == sorted([(1, "a_minus_b"), (2, "a_minus_b"), (3, "b_minus_a")], key=repr)


def test_ledger_sums_to_zero(frame):
    df = frame([("a", "b", 5), ("b", "c", 2)], "f string, t string, v int")
    legs = S.ledger(df, "f", "t", "v")
    assert legs.agg(F.sum("amount")).first()[0] == 0
    assert rows(legs.groupBy("party").agg(F.sum("amount"))) == [("a", -5), ("b", 3), ("c", 2)]


@pytest.mark.parametrize("keys,others,want", [
    ([1, 2, None], [2], [1]),
    ([1, 2, None], [2, None], []),
    ([1, None], [], [1, None]),
])
def test_not_in_follows_sql(spark, frame, keys, others, want):
    a, b = frame([(k,) for k in keys], "k int"), frame([(o,) for o in others], "o int")
    assert rows(J.not_in(a, b, "k", "o")) == sorted([(w,) for w in want], key=repr)
    a.createOrReplaceTempView("tm_a")
    b.createOrReplaceTempView("tm_b")
    assert rows(spark.sql("SELECT k FROM tm_a WHERE k NOT IN (SELECT o FROM tm_b)")) == rows(J.not_in(a, b, "k", "o"))


def test_asof_bounds_are_exclusive(frame):
    ts = lambda h: dt.datetime(2024, 1, 1, h)
    events = frame([(1, "u", ts(1)), (2, "u", ts(2)), (3, "u", ts(3)), (4, "u", ts(9)), (5, "v", ts(3))], "id int, u string, ts timestamp_ntz")
    versions = frame([("u", ts(2), "v1"), ("u", ts(5), "v2")], "u string, start timestamp_ntz, name string")
    for bucket in (None, F.date_trunc("hour", "ts")):
        out = J.asof_validity_join(events, versions, "u", "ts", "start", ["name"], "id", bucket)
        assert rows(out.select("id", "name")) == [(3, "v1"), (4, "v2")]
        left = J.asof_validity_join(events, versions, "u", "ts", "start", ["name"], "id", bucket, "left")
        assert left.count() == 5


def test_like_join(frame):
    df = frame([(1, "dungeon_fire_1"), (2, "ice"), (3, None), (4, "fire_ice")], "id int, code string")
    d = frame([("fire", "F"), ("i_e", "I"), ("f%1", "X"), ("%", "any"), ("", "any2"), ("e", "E"), ("dungeon_fire", "long"), ("zz", "no")], "name string, tag string")
    out = J.like_join(df, d, "code", "name")
    want = df.join(d, F.expr("code LIKE concat('%', name, '%')"), "left")
    assert rows(out.select("id", "tag")) == rows(want.select("id", "tag"))


def test_like_join_of_a_large_dictionary(frame):
    """More patterns than the old switch between two ways of joining."""
    d = frame([(f"item{i}", i) for i in range(2500)] + [("%", -1), ("m1_", -2)], "name string, tag int")
    df = frame([(i, f"x_item{i * 37}y") for i in range(60)], "id int, code string")
    want = df.join(d, F.expr("code LIKE concat('%', name, '%')"), "left")
    assert rows(J.like_join(df, d, "code", "name").select("id", "tag")) == rows(want.select("id", "tag"))


def test_like_candidates_follow_the_rarest_gram(frame):
    """All texts hold the start of every pattern; only the rare end of each finds candidates."""
    texts = frame([(f"the level of the dungeon {i:04d} and the end",) for i in range(400)], "__text string")
    names = frame([(f"the dungeon 0{i:03d}",) for i in range(50)] + [(f"of the dungeon {i:04d}",) for i in range(300)] + [("the level of the",), ("absent zebra",)], "__name string")
    pairs = J.like_candidates(texts, names)
    per_name = dict(rows(pairs.groupBy("__name").count()))
    assert per_name.pop("the level of the") == 400 and "absent zebra" not in per_name
    assert max(per_name.values()) <= 10  # four digits at most are shared with ten others
    matched = pairs.filter(F.expr("__text LIKE concat('%', __name, '%')"))
    assert matched.count() == 400 + 300 + 50


def test_no_limit_on_values(frame):
    from tidemark.operators.aggregates import as_dict, column_values, money

    many = frame([(i,) for i in range(12_000)], "v int")
    assert len(column_values(many, "v")) == len(as_dict(many)["v"]) == 12_000
    with pytest.raises(ValueError):
        column_values(many, "v", limit=1000)
    assert frame([(1e14,), (2e14,)], "v double").agg(F.sum(money("v"))).first()[0] == 300_000_000_000_000


def test_range_join_cuts_open_ends(frame):
    d = lambda n: dt.date(2024, 1, n)
    df = frame([(d(1),), (d(5),), (d(9),)], "day date")
    r = frame([("a", d(1), d(4)), ("b", d(5), dt.date(9999, 12, 31))], "v string, lo date, hi date")
    assert rows(J.range_join(df, r, "day", "lo", "hi").select("day", "v")) == [(d(1), "a"), (d(5), "b"), (d(9), "b")]


def test_either_endpoint_and_chain(frame):
    df = frame([(1, "a", "b"), (2, "b", "c"), (3, "c", "a"), (4, "x", "y")], "id int, f string, t string")
    m = frame([("a",), ("c",)], "w string")
    assert [r[0] for r in rows(J.either_endpoint_in(df, ["f", "t"], m, "w", ["id"]).select("id"))] == [1, 2, 3]
    one, two = frame([("k", 1)], "k string, n int"), frame([("j", 2)], "k string, n int")
    assert rows(J.full_join_many({"x": one, "y": two}, "k", "n")) == [("j", 0, 2), ("k", 1, 0)]


def test_exclude_matching(frame):
    df = frame([("alpha",), ("beta",), (None,), ("gamma",)], "s string")
    rules = frame([("prefix", "al"), ("suffix", "ma"), ("contains", "zz")], "kind string, text string")
    assert rows(P.exclude_matching(df, "s", rules)) == sorted([("beta",), (None,)], key=repr)


def test_projections(frame):
    df = frame([(1, "x", "nan")], "id int, a string, b string")
    assert P.star(df, ["B"], prefix="p_", suffix="_s").columns == ["p_id_s", "p_a_s"]
    assert rows(P.except_replace(df, ["a"], {"b": F.upper("b")})) == [(1, "NAN")]
    assert rows(P.null_sentinels(df, ["b"], ["nan"])) == [(1, "x", None)]


def test_date_spine_leaves_the_end_out(spark):
    days = C.date_spine(spark, "day", "2020-02-28", "2020-03-02")
    assert [r[0].date() for r in days.orderBy("date_day").collect()] == [dt.date(2020, 2, 28), dt.date(2020, 2, 29), dt.date(2020, 3, 1)]
    assert C.date_spine(spark, "month", "2020-01-01", "2020-04-01").count() == 3
    assert C.date_spine(spark, "day", "2020-01-02", "2020-01-01").count() == 0
    assert C.base_dates(spark, n=3, part="day", as_of="2024-05-05").count() == 4
    with pytest.raises(ValueError):
        C.generate_series(spark, 0)


def test_densify_null_keys(frame):
    d = lambda n: dt.date(2024, 1, n)
    df = frame([("a", d(1), 5), (None, d(3), 7)], "k string, day date, v int")
    out = C.densify(df, ["k"], "day")
    assert out.count() == 6
    assert out.filter("k IS NULL AND v = 7").count() == 1


def test_column_values_limit(frame):
    df = frame([("a",), ("a",), ("b",)], "x string")
    assert A.column_values(df, "x") == ["a", "b"]
    with pytest.raises(ValueError):
        A.column_values(df, "x", limit=1)
    assert A.column_values(df, "x", where="x = 'z'", default=["none"]) == ["none"]
    assert A.as_dict(df.distinct().orderBy("x")) == {"x": ["a", "b"]}
    assert A.single_value(df.filter("x = 'z'"), "d") == "d"


def test_metrics_wide(frame):
    df = frame([(1, "v", "3", 1), (1, "v", "9", 2), (1, "w", "{}", 1), (2, "v", None, 1)], "id int, name string, value string, o int")
    assert rows(A.metrics_wide(df, "id", "name", "value", ["v", "w"], "o")) == [(1, "3", ""), (2, None, None)]


def test_range_blocks_are_exact_and_few(spark):
    r = random.Random(5)
    cases = [(a, a + r.choice([0, 1, 2, 15, 16, 17, 255, 256, 300, 4095, 4096, 5000])) for a in (r.randint(0, 5000) for _ in range(150))]
    for step, levels in ((1, 14), (4, 4), (4, 9), (3, 1), (5, 2)):
        made = spark.createDataFrame(cases, "a bigint, b bigint").select("a", "b", J.range_blocks(F.col("a"), F.col("b"), step, levels).alias("out")).collect()
        for a, b, out in made:
            covered = [x for level, block in out for x in range(block << step * level, (block + 1) << step * level)]
            assert sorted(covered) == list(range(a, b + 1))
            assert levels < 9 or len(out) <= 2 * (2**step - 1) * (b - a + 1).bit_length()
    edge = spark.range(1).select(J.range_blocks(F.lit(0), F.lit(2**60), 4, 16).alias("out")).first()["out"]
    assert sum(1 << 4 * level for level, _ in edge) == 2**60 + 1


@pytest.mark.parametrize("kind", ["timestamp", "timestamp_ntz", "date", "bigint"])
@pytest.mark.parametrize("how", ["inner", "left"])
def test_range_join_against_a_filter(spark, kind, how):
    r = random.Random(kind)
    make = {"bigint": lambda i: i - 700, "date": lambda i: dt.date(2024, 1, 1) + dt.timedelta(days=i - 700)}.get(kind, lambda i: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=997 * i, microseconds=i))
    points = [None if i % 40 == 0 else make(r.randint(0, 1000)) for i in range(120)]
    ranges = []
    for i in range(60):
        a = r.randint(-100, 1000)
        ranges.append((f"r{i}", None if r.random() < 0.1 else make(a), None if r.random() < 0.1 else make(a + r.choice([-5, 0, 1, 30, 900]))))
    df = spark.createDataFrame(list(enumerate(points)), f"id int, at {kind}")
    rs = spark.createDataFrame(ranges, f"label string, lo {kind}, hi {kind}")
    got = rows(J.range_join(df, rs, "at", "lo", "hi", how).select("id", "label"))
    want = [(i, n) for i, p in enumerate(points) for n, a, b in ranges if p is not None and (a is None or a <= p) and (b is None or p <= b)]
    if how == "left":
        want += [(i, None) for i in set(range(len(points))) - {i for i, _ in want}]
    assert got == sorted(want, key=repr)


@pytest.mark.parametrize("kind", ["timestamp_ntz", "bigint"])
def test_range_totals_against_the_pairs(spark, kind):
    r = random.Random(kind)
    make = (lambda i: i - 70) if kind == "bigint" else (lambda i: dt.datetime(2024, 1, 1) + dt.timedelta(seconds=997 * i))
    points = [(r.choice([None, 10**12 + i, -i]), None if i % 40 == 0 else make(r.randint(0, 60))) for i in range(200)]
    ranges = [(f"r{i % 30}", None if r.random() < 0.2 else make(a), None if r.random() < 0.2 else make(a + r.choice([-5, 0, 1, 30]))) for i in range(60) for a in [r.randint(-30, 90)]]
    ranges += [ranges[0], ("all", None, None), ("all", None, None), ("gone", make(900), make(901)), ("none", make(5), make(4))]
    df = spark.createDataFrame(points, f"id bigint, at {kind}")
    rs = spark.createDataFrame(ranges, f"label string, lo {kind}, hi {kind}")
    got = J.range_join(df, rs, "at", "lo", "hi", totals={"ids": "id"})
    pairs = J.range_join(df, rs, "at", "lo", "hi").groupBy("label", "lo", "hi").agg(F.count("*").alias("n"), F.sum("id").alias("ids"))
    assert rows(got) == rows(pairs) and got.count() > 20 and got.schema["ids"].dataType.simpleString() == "bigint"
    assert J.range_join(df.limit(0), rs, "at", "lo", "hi", totals={"ids": "id"}).count() == 0
    with pytest.raises(TypeError):
        J.range_join(df, rs, "at", "lo", "hi", totals={"x": F.lit(1.5)})


def test_range_blocks_of_unknown_number_are_not_broadcast(spark, monkeypatch):
    monkeypatch.setattr(J, "FEW_BLOCKS", 10)
    ids = spark.range(100).select(F.col("id").alias("a"), (F.col("id") + 5).alias("b"))
    joined = J.range_join(spark.range(200), ids, "id", "a", "b")
    assert "BroadcastHashJoin" not in joined._jdf.queryExecution().executedPlan().toString()
    assert joined.count() == 600


def test_range_join_without_rows(spark, frame):
    none, some = frame([], "d date"), frame([(dt.date(2024, 1, 1),)], "d date")
    rs = frame([(dt.date(2023, 1, 1), dt.date(2025, 1, 1))], "lo date, hi date")
    assert J.range_join(none, rs, "d", "lo", "hi").count() == 0
    assert J.range_join(some, rs.limit(0), "d", "lo", "hi").count() == 0
    assert J.range_join(some, rs.limit(0), "d", "lo", "hi", "left").count() == 1
    with pytest.raises(TypeError):
        J.range_join(some.select(F.lit(1.5).alias("d")), rs, "d", "lo", "hi")


def test_large_costs_are_shared_exactly(spark, frame):
    from tidemark.operators import finance as N

    weights = frame([("m", "a", 1), ("m", "b", 2), ("m", "c", 5), ("n", "a", 3)], "month string, seg string, users bigint")
    costs = frame([("m", 1e15), ("n", 0.0005)], "month string, cost double")
    odd = frame([("m", -7.0), ("n", 2e16)], "month string, cost double")
    got = {(r["month"], r["seg"]): (r["cost_ads"], r["cost_odd"], r["total_cost"]) for r in N.allocate(weights, {"ads": costs, "odd": odd}, "month", "users").collect()}
    half_up = lambda x: (abs(x) * 1000 + Fraction(1, 2)).__floor__() * Fraction(1 if x >= 0 else -1, 1000)
    for (month, seg), (ads, odd_cost, total) in got.items():
        users = {("m", "a"): 1, ("m", "b"): 2, ("m", "c"): 5, ("n", "a"): 3}[month, seg]
        all_users = 8 if month == "m" else 3
        first, second = ({"m": Fraction(10**15), "n": Fraction(5, 10_000)}[month], {"m": Fraction(-7), "n": Fraction(2 * 10**16)}[month])
        assert Fraction(ads) == half_up(first * users / all_users) and Fraction(odd_cost) == half_up(second * users / all_users)
        assert Fraction(total) == Fraction(ads) + Fraction(odd_cost)


def test_large_revenues(frame):
    from tidemark.operators import finance as N

    rev = frame([("d", "x", 3e17), ("d", "y", 1e17)], "day string, ch string, revenue double")
    out = N.roas(rev, frame([("d", 2e17)], "day string, cost double"), frame([("d", 5)], "day string, installs bigint"), ["day"], "ch", ["x", "y"])
    assert [tuple(r) for r in out.select("rev_x", "rev_y", "cost", "roas").collect()] == [(3e17, 1e17, 2e17, 2.0)]
    facts = N.conform_facts({"f": frame([("k", 9e18)], "dim string, v double")}, ["dim"], ["v"])
    assert float(facts.first()["v"]) == 9e18


def test_classified_transfers_search_for_hot_transactions_only_if_there_can_be_one(frame, monkeypatch):
    from tidemark.operators import ledgers as L
    from tidemark.operators import windows as W

    r = random.Random(8)
    moves = [(r.choice([1, 1, 1, 2, 3, None]), i % 30, f"a{r.randint(0, 5)}", f"b{r.randint(0, 5)}") for i in range(60)]
    table = [("from", "a1", "x"), ("from", "a1", "y"), ("from", "a2", "x"), ("to", "b1", "z"), ("to", "b1", "z"), ("from", "b2", "no")]
    tr, rules = frame(moves, "tx int, at int, a string, b string"), frame(table, "side string, address string, tag string")
    tagged = [(*m, tag) for m in moves for side, address, tag in table if address == m[2 if side == "from" else 3]]
    want = sorted(((*t, 1 + sum(u[0] == t[0] and u[1] < t[1] for u in tagged)) for t in tagged), key=repr)
    for hot, searched in ((2_000_000, False), (3, True)):
        monkeypatch.setattr(W, "HOT_ROWS", hot)
        out = L.classify_transfers(tr, "a", "b", rules, ["tx"], "at", F.floor(F.col("at") / 10))
        assert ("__hot" in out._jdf.queryExecution().executedPlan().toString()) == searched
        assert rows(out.select("tx", "at", "a", "b", "tag", "rank_in_tx")) == want
    assert L.classify_transfers(tr, "a", "b", rules.limit(0), ["tx"], "at", F.floor(F.col("at") / 10)).count() == 0
