import hashlib
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.functions import dates as D
from tidemark.functions import nested as N
from tidemark.functions import numeric as M
from tidemark.functions import text as X
from tidemark.functions import web as U
from tidemark.functions import wide as WD


def one(spark, *cols):
    return tuple(spark.range(1).select(*cols).first())


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_surrogate_key(spark):
    null = F.lit(None).cast("string")
    assert one(spark, M.surrogate_key(F.lit("a"), null, F.lit("c"))) == (md5("a--c"),)
    assert one(spark, M.surrogate_key(F.lit("a"), null, null_text="?")) == (md5("a-?"),)
    assert one(spark, M.surrogate_key(F.lit(""), F.lit("b"))) == one(spark, M.surrogate_key(null, F.lit("b")))


def test_safe_math(spark):
    n = F.lit(None).cast("int")
    assert one(spark, M.safe_add(F.lit(1), n, F.lit(3)), M.safe_subtract(F.lit(3), F.lit(2), n), M.safe_divide(F.lit(6.0), F.lit(0.0)),
               M.ratio_or_zero(F.lit(6), F.lit(0)), M.ratio_or_zero(F.lit(6), n), M.ratio_or_zero(F.lit(6), F.lit(4))) == (4, 1, None, 0.0, 0.0, 1.5)


def test_haversine(spark):
    """A quarter of the globe along the equator and up to the pole, and a pair of places by the formula."""
    from math import asin, cos, pi, radians, sin, sqrt

    spot = [F.lit(x) for x in (-33.45, -70.66, 35.68, 139.69)]
    mi, km, equator, pole = one(spark, M.haversine(*spot), M.haversine(*spot, unit="km"), M.haversine(F.lit(0.0), F.lit(10.0), F.lit(0.0), F.lit(100.0), unit="km"),
                                M.haversine(F.lit(0.0), F.lit(5.0), F.lit(90.0), F.lit(77.0), unit="km"))
    a = sin(radians(35.68 + 33.45) / 2) ** 2 + cos(radians(-33.45)) * cos(radians(35.68)) * sin(radians(139.69 + 70.66) / 2) ** 2
    radius = equator / (pi / 2)
    assert 6360 < radius < 6380 and round(pole, 6) == round(equator, 6)
    assert round(km / radius, 9) == round(2 * asin(sqrt(a)), 9) and round(km / mi, 3) == 1.609
    with pytest.raises(ValueError):
        M.haversine(*spot, unit="m")


def test_width_bucket_edges(spark):
    got = one(spark, *[M.width_bucket(F.lit(v), 0, 10, 5) for v in (-1.0, 0.0, 1.9, 2.0, 9.99, 10.0, 50.0)])
    assert got == (0, 1, 1, 2, 5, 6, 6)


def test_scale_units(spark):
    none = F.lit(None).cast("int")
    raw = F.lit("1500000000000000000")
    from decimal import Decimal

    assert one(spark, M.scale_units(raw, F.lit(18)), M.scale_units(F.lit("42"), none), M.scale_units(raw, F.lit(18), exact=True)) == (1.5, 42.0, Decimal("1.500000000000000000"))


def test_buckets_and_steps(spark):
    assert one(spark, M.period_bucket(F.lit(13), 7), M.lifetime_bucket(F.lit(3), [(3, "new"), (14, "mid")], "old"), M.lifetime_bucket(F.lit(99), [(3, "new")], "old"),
               M.step_function(F.lit(250), [(100, 1), (200, 2), (300, 3)]), M.step_function(F.lit(5), [(100, 1)])) == (1, "new", "old", 2, 0)


URLS = [
    ("www.example.com/blog?utm_source=a&utm_medium=b", "www.example.com", "blog", "a"),
    ("https://example.com/p/a/t/h?x=1", "example.com", "p/a/t/h", None),
    ("android-app://m.example.com", "m.example.com", "", None),
    ("http://example.com?utm_source=z", "example.com", "", "z"),
]


@pytest.mark.parametrize("url,host,path,source", URLS)
def test_urls(spark, url, host, path, source):
    assert one(spark, U.url_host(F.lit(url)), U.url_path(F.lit(url)), U.url_parameter(F.lit(url), "utm_source")) == (host, path, source)


def test_url_authority(spark):
    assert one(spark, U.url_authority(F.lit("https://a.b/c")), U.url_authority(F.lit("a.b/c"))) == ("a.b", None)


def test_slugs(spark):
    assert X.slugify_name("1st Name - Of!") == "_1st_name_of"
    assert one(spark, X.slugify(F.lit("1st Name - Of!"))) == ("_1st_name_of",)


def test_text_helpers(spark):
    assert one(spark, X.strip_suffix(F.lit("a-b-12-3")), X.strip_suffix(F.lit("a-b")), X.split_at(F.lit("a.b.c"), ".", 1), X.split_at(F.lit("a.b.c"), ".", -1),
               X.split_at(F.lit("a"), ".", 5), X.split_trim(F.lit(" a , b")), X.leading_int(F.lit("12x")), X.leading_int(F.lit("x")),
               X.iso8601_duration(F.lit("PT1H2M3S")), X.iso8601_duration(F.lit("PT45S")), X.iso8601_seconds(F.lit("PT1H2M3S")), X.seconds_to_hms(F.lit("90061.0")),
               X.flag_text(F.lit("1.0")), X.flag_text(F.lit("x")), X.platform_of(F.lit("123")), X.platform_of(F.lit("com.x"))) == (
        "a-b", "a-b", "b", "c", None, ["a", "b"], 12, None, "01:02:03", "00:00:45", 3723, "01:01:01", "True", "x", "IOS", "ANDROID")


def test_repair_json(spark):
    fixed = X.repair_json(F.lit("{name: Iron Sword, tier: 3, ok: true}"))
    assert one(spark, F.get_json_object(fixed, "$.name"), F.get_json_object(fixed, "$.tier"), F.get_json_object(fixed, "$.ok")) == ("Iron Sword", "3", "true")


def test_mentions(frame):
    msg = frame([(1, "hi <@U1> and <@U9> <https://x.y/z|link>"), (2, "none")], "id int, text string")
    users = frame([("U1", "Ann")], "uid string, name string")
    got = {r["id"]: (r["mentions"], r["links"], r["resolved_text"]) for r in X.mentions(msg, "text", users, "uid", "name", ["id"]).collect()}
    assert got == {1: ("U1\nU9", "https://x.y/z", "hi @Ann and @unknown <https://x.y/z|link>"), 2: ("", "", "none")}


def test_event_params(spark):
    arr = F.array(N.param("a", int_=F.lit(5)), N.param("b", string=F.lit("x")), N.param("b", string=F.lit("y")))
    df = spark.range(1).select(arr.alias("p"))
    assert tuple(df.select(N.event_param("p", "a", "int_value"), N.event_param("p", "z"), F.size(N.params_like("p", "b%"))).first()) == (5, None, 2)
    with pytest.raises(Exception, match="occurs more than once"):
        df.select(N.event_param("p", "b", unique=True)).collect()


def test_arrays(spark):
    holes = F.array(F.lit("b"), F.lit(None).cast("string"), F.lit("a"))
    assert one(spark, N.array_first_nulls_first(holes), N.array_first_nulls_first(F.array(F.lit("b"), F.lit("a"))), N.array_last(holes)) == (None, "a", "b")


def test_ticks(spark):
    # 16 characters are tenths of microseconds since year 1 cut to 16 digits; 13 are milliseconds
    assert one(spark, D.ticks_to_micros(F.lit("1704067200000")), D.ticks_to_micros(F.lit("6383966400000000")), D.ticks_to_micros(F.lit("12"))) == (
        1704067200000000, 63839664000000000 - 62135596800000000, None)


def test_weeks(spark):
    d = F.lit("2024-01-06").cast("date")  # a Saturday
    import datetime as dt

    assert one(spark, D.week_start(d), D.week_end(d), D.iso_week_start(d), D.day_of_week(d), D.day_of_week(d, iso=False), D.week_of_year(d), D.iso_week_of_year(d)) == (
        dt.date(2023, 12, 31), dt.date(2024, 1, 6), dt.date(2024, 1, 1), 6, 7, 1, 1)


def test_differences(spark):
    a, b = D.as_timestamp("2024-01-01 23:59:30"), D.as_timestamp("2024-01-02 00:00:10")
    assert one(spark, D.boundaries(a, b, "day"), D.boundaries(a, b, "minute"), D.full_units(a, b, "minute"), D.full_units(a, b, "day")) == (1, 1, 0, 0)


def test_convert_timezone_and_rounding(spark):
    import datetime as dt

    noon = D.as_timestamp("2024-06-30 12:00:00")
    assert one(spark, D.convert_timezone(noon, "America/New_York"), D.round_to_day(noon).cast("timestamp_ntz")) == (dt.datetime(2024, 6, 30, 8), dt.datetime(2024, 7, 1))


def test_wide_sums_equal_python_integers(spark):
    r = random.Random(11)
    big = lambda: r.choice([-1, 1]) * r.randint(0, 10 ** r.choice([1, 17, 18, 19, 36, 60, 80]))
    data = [(r.choice("abc"), str(big())) for _ in range(400)]
    data += [("zero", "5" + "0" * 70), ("zero", "-5" + "0" * 70), ("sign", "+007"), ("sign", "-0"), ("edge", "9" * 90), ("edge", "1"), ("none", None), ("none", "x1"), ("none", "1.5"), ("none", "")]
    df = spark.createDataFrame(data, "k string, v string").repartition(3)
    got = dict(rows(df.groupBy("k").agg(WD.wide_text(WD.wide_sum(WD.wide("v"))).alias("s"))))
    want = {k: str(sum(int(v) for j, v in data if j == k)) for k in {k for k, _ in data} - {"none"}}
    assert got == want | {"none": None}
    each = [v for _, v in data if v and v.lstrip("+-").isdigit()]
    assert [x[0] for x in spark.createDataFrame([(v,) for v in each], "v string").select(WD.wide_text(WD.wide("v"))).collect()] == [str(int(v)) for v in each]
    with pytest.raises(Exception, match="more than 36 digits"):
        spark.createDataFrame([("1" * 37,)], "v string").select(WD.wide_text(WD.wide("v", 2))).collect()


def test_wide_sums_stay_in_whole_64_bit_numbers(spark):
    r = random.Random(12)
    data = [(r.choice("ab"), r.choice([-1, 1]) * r.randint(0, 10**80)) for _ in range(200)] + [("zero", 7), ("zero", -7)]
    df = spark.createDataFrame([(k, str(v), 1 - 2 * (i % 2)) for i, (k, v) in enumerate(data)], "k string, v string, s bigint")
    made = df.groupBy("k").agg(WD.wide_sum(WD.wide("v"), sign=F.col("s")).alias("x"))
    assert made.schema["x"].dataType.simpleString() == "array<bigint>"  # decimals of 38 digits cost several times as much
    want = {}
    for i, (k, v) in enumerate(data):
        want[k] = want.get(k, 0) + v * (1 - 2 * (i % 2))
    assert dict(rows(made.select("k", WD.wide_text("x")))) == {k: str(v) for k, v in want.items()}


def test_wide_scaled(spark):
    cases = [("1" + "0" * 60, 18, "1" + "0" * 42), ("-5", 3, "-0.005"), ("1200", 2, "12"), ("12345", 2, "123.45"), ("0", 18, "0"), ("7", None, "7"), ("100", 0, "100"), ("-1500", 3, "-1.5"), (None, 2, None)]
    df = spark.createDataFrame([(i, a, b) for i, (a, b, _) in enumerate(cases)], "i int, a string, b int")
    assert [r[1] for r in sorted(df.select("i", WD.wide_scaled("a", "b")).collect())] == [c for _, _, c in cases]
