"""Scalar functions over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import dates as D
from ..functions import nested as N
from ..functions import numeric as M
from ..functions import text as X
from ..functions import web as U
from ..operators.aggregates import money
from .registry import query


def with_params(events):
    """Events with a parameter array built from the flat columns."""
    k = F.get_json_object("props", "$.k").cast("bigint")
    return events.withColumn("event_params", F.array(
        N.param("k", int_=k),
        N.param("value", double=F.col("value")),
        N.param("page_kind", string=F.col("event_type")),
    ))


@query("""SELECT n_nationkey, md5(coalesce(n_name, '') || '-' || coalesce(r_name, '')) AS sk,
                 md5(coalesce(n_name, '') || '-' || coalesce(cast(CASE WHEN n_regionkey > 1 THEN n_regionkey END AS VARCHAR), '')) AS sk_null
          FROM nation JOIN region ON n_regionkey = r_regionkey""")
def surrogate_key(t):
    known = F.when(F.col("n_regionkey") > 1, F.col("n_regionkey"))
    return t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey")).select(
        "n_nationkey", M.surrogate_key("n_name", "r_name").alias("sk"), M.surrogate_key("n_name", known).alias("sk_null"))


@query("""WITH x AS (SELECT l_orderkey, l_linenumber, CASE WHEN l_returnflag = 'A' THEN cast(l_quantity AS BIGINT) END AS a,
                            CASE WHEN l_linestatus = 'O' THEN cast(l_linenumber AS BIGINT) END AS b FROM lineitem)
          SELECT l_orderkey, l_linenumber, coalesce(a, 0) + coalesce(b, 0) AS added, coalesce(a, 0) - coalesce(b, 0) AS subtracted,
                 cast(a AS DOUBLE) / nullif(cast(b - 3 AS DOUBLE), 0) AS divided
          FROM x""")
def safe_math(t):
    x = t.lineitem.select(
        "l_orderkey", "l_linenumber",
        F.when(F.col("l_returnflag") == "A", F.col("l_quantity").cast("bigint")).alias("a"),
        F.when(F.col("l_linestatus") == "O", F.col("l_linenumber").cast("bigint")).alias("b"))
    return x.select("l_orderkey", "l_linenumber", M.safe_add("a", "b").alias("added"), M.safe_subtract("a", "b").alias("subtracted"),
                    M.safe_divide(F.col("a").cast("double"), (F.col("b") - 3).cast("double")).alias("divided"))


@query("""SELECT CASE WHEN p_size < 10 THEN 0 WHEN p_size >= 42 THEN 9 ELSE cast(floor(8 * (p_size - 10) / 32.0) AS BIGINT) + 1 END AS bucket,
                 count(*) AS n FROM part GROUP BY 1""")
def width_bucket(t):
    return t.part.groupBy(M.width_bucket("p_size", 10, 42, 8).alias("bucket")).agg(F.count("*").alias("n"))


@query("""WITH p AS (SELECT c_custkey, c_nationkey * 3 - 36 AS lat1, c_nationkey * 7 - 90 AS lon1, s_nationkey * 3 - 36 AS lat2, s_nationkey * 7 - 90 AS lon2
                     FROM customer JOIN supplier ON c_custkey = s_suppkey),
          d AS (SELECT c_custkey, 7922 * asin(sqrt(pow(sin((radians(lat2) - radians(lat1)) / 2), 2)
                + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin((radians(lon2) - radians(lon1)) / 2), 2))) AS mi FROM p)
          SELECT c_custkey, round(mi, 4) AS miles, round(mi * 1.60934, 4) AS km FROM d""")
def haversine(t):
    def at(key):
        return F.col(key) * 3 - 36, F.col(key) * 7 - 90

    args = (*at("c_nationkey"), *at("s_nationkey"))
    pairs = t.customer.join(t.supplier, F.col("c_custkey") == F.col("s_suppkey"))
    return pairs.select("c_custkey", F.round(M.haversine(*args), 4).alias("miles"), F.round(M.haversine(*args, unit="km"), 4).alias("km"))


@query("SELECT o_orderkey, round(ln(o_totalprice), 6) AS log_price FROM orders")
def log_natural(t):
    return t.orders.select("o_orderkey", F.round(M.log_natural("o_totalprice"), 6).alias("log_price"))


@query("SELECT count(*) AS n, true AS in_range FROM orders")
def rand_uniform(t):
    drawn = t.orders.select(M.uniform(7).alias("u"))
    return drawn.agg(F.count("*").alias("n"), F.bool_and((F.col("u") >= 0) & (F.col("u") < 1)).alias("in_range"))


@query("""SELECT p_partkey, cast(p_size * 1000000 AS DOUBLE) / pow(10.0, coalesce(CASE WHEN p_size < 40 THEN p_size % 7 END, 0)) AS units
          FROM part""")
def scale_by_decimals(t):
    decimals = F.when(F.col("p_size") < 40, F.col("p_size") % 7)
    return t.part.select("p_partkey", M.scale_units(F.col("p_size") * 1000000, decimals).alias("units"))


@query("SELECT p_brand, cast(round(cast(max(p_size * 1234567) / 1e6 AS DECIMAL(38,9)), 2) AS DOUBLE) AS units FROM part GROUP BY 1")
def micros_to_units(t):
    return t.part.groupBy("p_brand").agg(M.from_micros(F.max(F.col("p_size") * 1234567)).alias("units"))


@query("""SELECT source, cast(sum(n_chars) AS BIGINT) AS bytes_scanned, cast(sum(n_chars) AS DOUBLE) / 1073741824.0 * 0.005 AS cost_usd
          FROM documents GROUP BY 1""")
def bytes_to_cost(t):
    return t.documents.groupBy("source").agg(F.sum("n_chars").alias("bytes_scanned")).withColumn("cost_usd", M.scan_cost("bytes_scanned", 0.005))


@query("""WITH f AS (SELECT user_id, min(cast(ts AS DATE)) AS first_day FROM events GROUP BY 1),
          d AS (SELECT DISTINCT e.user_id, cast(e.ts AS DATE) - first_day AS days FROM events e JOIN f USING (user_id))
          SELECT cast(floor(days / 7.0) AS BIGINT) AS week, CASE WHEN days <= 3 THEN 'new' WHEN days <= 14 THEN 'settled' ELSE 'old' END AS lifetime,
                 count(*) AS user_days FROM d GROUP BY 1, 2""")
def period_bucket(t):
    days = t.events.select("user_id", F.to_date("ts").alias("day")).distinct()
    first = days.groupBy("user_id").agg(F.min("day").alias("first_day"))
    aged = days.join(first, "user_id").select(F.datediff("day", "first_day").alias("days"))
    return aged.groupBy(
        M.period_bucket("days", 7).alias("week"), M.lifetime_bucket("days", [(3, "new"), (14, "settled")], "old").alias("lifetime")
    ).agg(F.count("*").alias("user_days"))


@query("""WITH x AS (SELECT user_id, sum(cast(value AS DECIMAL(14,2))) AS xp FROM events GROUP BY 1)
          SELECT user_id, CASE WHEN xp >= 4000 THEN 3 WHEN xp >= 3000 THEN 2 WHEN xp >= 2000 THEN 1 ELSE 0 END AS level FROM x""")
def step_function(t):
    xp = t.events.groupBy("user_id").agg(F.sum(money("value")).alias("xp"))
    return xp.select("user_id", M.step_function("xp", [(2000, 1), (3000, 2), (4000, 3)]).alias("level"))


@query(r"""SELECT p_partkey, regexp_replace(regexp_replace(regexp_replace(lower(p_size || ' ' || p_brand || '- ' || p_type), '[ -]+', '_', 'g'),
                  '[^a-z0-9_]+', '', 'g'), '^([0-9])', '_\1') AS slug FROM part""")
def slugify(t):
    return t.part.select("p_partkey", X.slugify(F.concat_ws("", F.concat_ws(" ", "p_size", "p_brand"), F.lit("- "), F.col("p_type"))).alias("slug"))


@query("""WITH u AS (SELECT page_id, url, replace(replace(replace(url, 'android-app://', ''), 'http://', ''), 'https://', '') AS rest FROM pages)
          SELECT page_id, split_part(split_part(rest, '/', 1), '?', 1) AS host,
                 split_part(CASE WHEN position('/' IN rest) = 0 THEN '' ELSE substr(rest, position('/' IN rest) + 1) END, '?', 1) AS path,
                 nullif(split_part(split_part(url, 'page=', 2), '&', 1), '') AS page_no,
                 nullif(regexp_extract(url, '://([^/]+)/', 1), '') AS authority
          FROM u""")
def url_parts(t):
    return t.pages.select("page_id", U.url_host("url").alias("host"), U.url_path("url").alias("path"),
                          U.url_parameter("url", "page").alias("page_no"), U.url_authority("url").alias("authority"))


@query("""SELECT page_id, CASE WHEN regexp_extract(url, '[0-9]+') = '' THEN 0 ELSE position(regexp_extract(url, '[0-9]+') IN url) END AS first_digit,
                 CASE WHEN regexp_matches(url, '(?i)EXAMPLE') THEN position('example' IN lower(url)) ELSE 0 END AS example_at
          FROM pages""")
def regexp_instr(t):
    return t.pages.select("page_id", X.regexp_position("url", "[0-9]+").cast("bigint").alias("first_digit"),
                          X.regexp_position("url", "EXAMPLE", "i").cast("bigint").alias("example_at"))


@query("""SELECT event_id, event_type AS kind, cast(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events""")
def regex_repair_json(t):
    k = F.regexp_extract("props", "([0-9]+)", 1)
    loose = F.concat(F.lit("{kind: "), F.col("event_type"), F.lit(", k: "), k, F.lit("}"))
    fixed = t.events.select("event_id", X.repair_json(loose).alias("j"))
    return N.json_fields(fixed, "j", {"kind": "string", "k": "bigint"}).drop("j")


@query(r"""WITH x AS (SELECT c_custkey, c_name, replace(c_name, '#', '-') || CASE WHEN c_nationkey > 12 THEN '-' || c_nationkey ELSE '' END AS code FROM customer)
           SELECT c_custkey, regexp_replace(code, '(-[0-9]+){1,2}$', '') AS base, split_part(c_name, '#', 2) AS digits,
                  CASE WHEN length(code) - length(replace(code, '-', '')) >= 2 THEN split_part(code, '-', 3) END AS third, split_part(code, '-', -1) AS last_part,
                  substr(c_name, 1, 9) AS prefix, try_cast(substr(c_name, 10) AS BIGINT) AS number_part,
                  try_cast(nullif(regexp_extract(split_part(c_name, '#', 2), '^([0-9]+)', 1), '') AS BIGINT) AS leading_number
           FROM x""")
def id_splitting(t):
    tail = F.when(F.col("c_nationkey") > 12, F.concat(F.lit("-"), F.col("c_nationkey").cast("string"))).otherwise("")
    code = F.concat(F.replace("c_name", F.lit("#"), F.lit("-")), tail)
    prefix, number = X.id_parts("c_name", 9)
    return t.customer.withColumn("code", code).select(
        "c_custkey", X.strip_suffix("code").alias("base"), X.split_at("c_name", "#", 1).alias("digits"), X.split_at("code", "-", 2).alias("third"),
        X.split_at("code", "-", -1).alias("last_part"), prefix.alias("prefix"), number.alias("number_part"),
        X.leading_int(X.split_at("c_name", "#", 1)).alias("leading_number"))


@query("""SELECT p_partkey, replace(p_name, ' ', '|') AS parts, cast(length(p_name) - length(replace(p_name, ' ', '')) + 1 AS INTEGER) AS n FROM part""")
def split_trim_array(t):
    parts = X.split_trim(F.replace("p_name", F.lit(" "), F.lit(" , ")))
    return t.part.select("p_partkey", F.array_join(parts, "|").alias("parts"), F.size(parts).alias("n"))


@query("""WITH x AS (SELECT event_id, cast(floor(value * 60) AS BIGINT) AS s FROM events)
          SELECT event_id, lpad(cast(s // 3600 AS VARCHAR), 2, '0') || ':' || lpad(cast(s % 3600 // 60 AS VARCHAR), 2, '0') || ':00' AS clock,
                 s // 3600 * 3600 + s % 3600 // 60 * 60 AS seconds,
                 lpad(cast((s * 40 % 86400) // 3600 AS VARCHAR), 2, '0') || ':' || lpad(cast((s * 40 % 3600) // 60 AS VARCHAR), 2, '0') || ':'
                 || lpad(cast(s * 40 % 60 AS VARCHAR), 2, '0') AS wrapped
          FROM x""")
def durations(t):
    s = F.floor(F.col("value") * 60).cast("bigint")
    x = t.events.select("event_id", s.alias("s"))
    iso = F.concat(F.lit("PT"), F.expr("s div 3600").cast("string"), F.lit("H"), F.expr("s % 3600 div 60").cast("string"), F.lit("M"))
    return x.withColumn("iso", iso).select("event_id", X.iso8601_duration("iso").alias("clock"), X.iso8601_seconds("iso").alias("seconds"),
                                           X.seconds_to_hms((F.col("s") * 40).cast("double").cast("string")).alias("wrapped"))


@query("""SELECT CASE WHEN p_size > 25 THEN 'IOS' ELSE 'ANDROID' END AS platform, count(*) AS n FROM part GROUP BY 1""")
def platform_from_id(t):
    store_id = F.when(F.col("p_size") > 25, F.col("p_partkey").cast("string")).otherwise(F.concat(F.lit("com."), F.col("p_name")))
    return t.part.groupBy(X.platform_of(store_id).alias("platform")).agg(F.count("*").alias("n"))


@query("""SELECT doc_id, CASE WHEN toxic = 1 THEN 'True' WHEN toxic = 0 THEN 'False' END AS toxic, CASE WHEN quality = 1 THEN 'True' ELSE 'False' END AS quality FROM labels""")
def bool_from_flag(t):
    return t.labels.select("doc_id", X.flag_text(F.col("toxic").cast("string")).alias("toxic"),
                           X.flag_text(F.col("quality").cast("double").cast("string")).alias("quality"))


@query("""SELECT event_id, cast(json_extract_string(props, '$.k') AS BIGINT) AS k, value AS value_param, event_type AS kind, cast(NULL AS VARCHAR) AS missing FROM events""")
def event_param(t):
    p = "event_params"
    return with_params(t.events).select(
        "event_id", N.event_param(p, "k", "int_value", unique=True).alias("k"), N.event_param(p, "value", "double_value").alias("value_param"),
        N.event_param(p, "page_kind").alias("kind"), N.event_param(p, "absent").alias("missing"))


@query("SELECT event_id, 2 AS n, 'k,page_kind' AS keys FROM events")
def event_param_subset(t):
    some = N.params_like("event_params", "k%", "page%")
    return with_params(t.events).select("event_id", F.size(some).alias("n"), F.array_join(some["key"], ",").alias("keys"))


@query("""SELECT param_key, count(*) AS n, count(param_text) AS texts, cast(sum(cast(param_number AS DECIMAL(14,2))) AS DOUBLE) AS total FROM (
            SELECT 'k' AS param_key, cast(NULL AS VARCHAR) AS param_text, cast(json_extract_string(props, '$.k') AS DOUBLE) AS param_number FROM events
            UNION ALL SELECT 'value', NULL, value FROM events UNION ALL SELECT 'page_kind', event_type, NULL FROM events) GROUP BY 1""")
def event_params_explode(t):
    rows = N.explode_params(with_params(t.events), "event_params", ["event_id"])
    return rows.groupBy("param_key").agg(F.count("*").alias("n"), F.count("param_text").alias("texts"),
                                         F.sum(money("param_number")).cast("double").alias("total"))


@query("""SELECT event_id, json_extract_string(props, '$.k') AS k, upper(event_type) AS kind, 'v' || json_extract_string(props, '$.k') AS spaced FROM events""")
def json_scalar(t):
    doc = F.to_json(F.struct(F.col("event_type").alias("kind"), F.concat(F.lit("v"), F.get_json_object("props", "$.k")).alias("a b")))
    e = t.events.withColumns({"doc": doc, "none": F.lit(None).cast("string")})
    return e.select("event_id", N.json_first(["none", "props"], "$.k").alias("k"), F.upper(N.json_scalar("doc", "$.kind")).alias("kind"),
                    N.json_scalar("doc", "$['a b']").alias("spaced"))


@query("""SELECT p_partkey, cast(len(string_split(p_name, ' ')) AS INTEGER) AS n, split_part(p_name, ' ', 1) AS first_word, cast(NULL AS VARCHAR) AS ninth FROM part""")
def json_array(t):
    doc = F.to_json(F.struct(F.struct(F.split("p_name", " ").alias("words")).alias("name")))
    arr = t.part.select("p_partkey", N.json_array(doc, "$.name.words").alias("a"))
    return arr.select("p_partkey", F.size("a").alias("n"), N.array_at(F.col("a"), 0).alias("first_word"), N.array_at(F.col("a"), 8).alias("ninth"))


@query("""SELECT p_partkey, list_aggregate(list_sort(string_split(p_name, ' ')), 'string_agg', ',') AS words,
                 list_max(string_split(p_name, ' ')) AS last_word,
                 CASE WHEN p_size > 25 THEN NULL ELSE list_min(string_split(p_name, ' ')) END AS first_word FROM part""")
def nested_list_unwrap(t):
    wrapped = F.struct(F.transform(F.split("p_name", " "), lambda w: F.struct(w.alias("element"))).alias("list"))
    a = t.part.withColumn("w", wrapped).withColumn("a", N.unwrap_list("w"))
    holes = F.when(F.col("p_size") > 25, F.concat("a", F.array(F.lit(None).cast("string")))).otherwise(F.col("a"))
    return a.select("p_partkey", F.array_join(F.array_sort("a"), ",").alias("words"), N.array_last("a").alias("last_word"),
                    N.array_first_nulls_first(holes).alias("first_word"))


@query("""SELECT r_name, 'region|nation' AS sources, TIMESTAMP '2024-02-01 00:00:00' AS loaded_at, count(*) AS n
          FROM region JOIN nation ON r_regionkey = n_regionkey GROUP BY 1""")
def load_metadata(t):
    joined = t.region.join(t.nation, F.col("r_regionkey") == F.col("n_regionkey"))
    m = joined.withColumn("metadata", N.load_metadata(["region", "nation"], "2024-02-01 00:00:00"))
    return m.groupBy("r_name", F.col("metadata")[0]["sources"].alias("sources"),
                     F.col("metadata")[0]["load_timestamp"].cast("timestamp_ntz").alias("loaded_at")).agg(F.count("*").alias("n"))


@query("""SELECT o_orderkey, cast(o_orderdate AS DATE) AS a, cast(o_orderdate AS DATE) AS b,
                 CASE WHEN o_orderstatus = 'F' THEN NULL ELSE cast(o_orderdate AS DATE) END AS c, o_orderdate - INTERVAL 7 HOUR AS d FROM orders""")
def parse_event_date(t):
    o = t.orders.select("o_orderkey", "o_orderstatus", F.date_format("o_orderdate", "yyyyMMdd").alias("compact"),
                        F.date_format("o_orderdate", "yyyy-MM-dd").alias("dashed"))
    iso = F.concat("dashed", F.lit("T00:00:00.000+07:00"))
    return o.select("o_orderkey", D.parse_date("compact", "yyyyMMdd").alias("a"), D.parse_date("dashed", "yyyy-MM-dd", safe=False).alias("b"),
                    D.parse_date(F.when(F.col("o_orderstatus") == "F", "bad").otherwise(F.col("dashed")), "yyyy-MM-dd").alias("c"),
                    D.parse_timestamp(iso).cast("timestamp_ntz").alias("d"))


@query("""SELECT event_id, cast(floor(epoch_us(ts) / 1000000.0) AS BIGINT) AS s, cast(floor(epoch_us(ts) / 1000.0) AS BIGINT) AS ms, epoch_us(ts) AS us,
                 ts AS back, date_trunc('second', ts) AS back_s FROM events""")
def epoch_convert(t):
    e = t.events.select("event_id", D.to_epoch("ts").alias("s"), D.to_epoch("ts", "millis").alias("ms"), D.to_epoch("ts", "micros").alias("us"))
    return e.withColumns({"back": D.from_epoch("us", "micros").cast("timestamp_ntz"), "back_s": D.from_epoch("s").cast("timestamp_ntz")})


@query("""SELECT event_id, CASE WHEN event_type = 'error' THEN NULL WHEN event_type = 'view' THEN cast(floor(epoch_us(ts) / 1000.0) AS BIGINT) * 1000
                 ELSE (epoch_us(ts) + 62135596800000000) // 10 * 10 - 62135596800000000 END AS us FROM events""")
def dotnet_ticks_to_micros(t):
    us = D.to_epoch("ts", "micros")
    text = (F.when(F.col("event_type") == "error", "n/a").when(F.col("event_type") == "view", D.to_epoch("ts", "millis").cast("string"))
            .otherwise(F.floor((us + D.EPOCH_OFFSET_MICROS) / F.lit(10).cast("decimal(20,0)")).cast("bigint").cast("string")))
    return t.events.select("event_id", D.ticks_to_micros(text).alias("us"))


@query("""SELECT event_id, ts + INTERVAL 7 HOUR AS saigon, ts - INTERVAL 2 HOUR AS back FROM events""")
def convert_timezone(t):
    return t.events.select("event_id", D.convert_timezone("ts", "Asia/Ho_Chi_Minh").alias("saigon"),
                           D.convert_timezone("ts", "Asia/Ho_Chi_Minh", "Asia/Tokyo").alias("back"))


@query("""SELECT d, cast(isodow(d) AS INTEGER) AS dow_iso, cast(dayofweek(d) + 1 AS INTEGER) AS dow, cast(day(d) AS INTEGER) AS dom, cast(dayofyear(d) AS INTEGER) AS doy,
                 dayname(d) AS long_day, substr(dayname(d), 1, 3) AS short_day, monthname(d) AS long_month, substr(monthname(d), 1, 3) AS short_month,
                 d - cast(dayofweek(d) AS INTEGER) AS week_start, d - cast(dayofweek(d) AS INTEGER) + 6 AS week_end, cast(ceil(dayofyear(d) / 7.0) AS INTEGER) AS week_no,
                 cast(date_trunc('week', d) AS DATE) AS iso_start, cast(date_trunc('week', d) AS DATE) + 6 AS iso_end, cast(weekofyear(d) AS INTEGER) AS iso_week, n
          FROM (SELECT cast(o_orderdate AS DATE) AS d, count(*) AS n FROM orders GROUP BY 1)""")
def date_parts(t):
    d = F.col("d")
    days = t.orders.groupBy(F.to_date("o_orderdate").alias("d")).agg(F.count("*").alias("n"))
    return days.select(
        "d", D.day_of_week(d).alias("dow_iso"), D.day_of_week(d, iso=False).alias("dow"), D.date_part("DAY", d).alias("dom"), D.date_part("DOY", d).alias("doy"),
        D.day_name(d, short=False).alias("long_day"), D.day_name(d).alias("short_day"), D.month_name(d, short=False).alias("long_month"),
        D.month_name(d).alias("short_month"), D.week_start(d).alias("week_start"), D.week_end(d).alias("week_end"), D.week_of_year(d).alias("week_no"),
        D.iso_week_start(d).alias("iso_start"), D.iso_week_end(d).alias("iso_end"), D.iso_week_of_year(d).alias("iso_week"), "n")


@query("""WITH x AS (SELECT o_orderkey, cast(o_orderdate AS DATE) AS d FROM orders)
          SELECT o_orderkey, d - 1 AS yesterday, d + 1 AS tomorrow, d - 14 AS two_weeks_ago, cast(d + INTERVAL 1 MONTH AS DATE) AS next_month,
                 cast(d - INTERVAL 3 MONTH AS DATE) AS three_months_ago, monthname(cast(d - INTERVAL 1 MONTH AS DATE)) AS last_month_name,
                 cast(date_diff('month', d, DATE '2001-08-01') AS BIGINT) AS months_since, cast(date_diff('day', d, DATE '2001-08-01') AS BIGINT) AS days_since,
                 cast(date_diff('day', date_trunc('week', d), date_trunc('week', DATE '2001-08-01')) // 7 AS BIGINT) AS weeks_since, cast(date_diff('quarter', d, DATE '2001-08-01') AS BIGINT) AS quarters_since
          FROM x""")
def n_periods_ago(t):
    d = F.to_date("o_orderdate")
    since = {f"{u}s_since": D.periods_since(d, u, "2001-08-01") for u in ("month", "day", "week", "quarter")}
    return t.orders.select(
        "o_orderkey", D.shift(d, -1).alias("yesterday"), D.shift(d, 1).alias("tomorrow"), D.shift(d, -2, "week").alias("two_weeks_ago"),
        D.shift(d, 1, "month").alias("next_month"), D.shift(d, -3, "month").alias("three_months_ago"),
        D.month_name(D.shift(d, -1, "month"), short=False).alias("last_month_name"), *[c.alias(n) for n, c in since.items()])


@query("""SELECT event_id, cast(date_trunc('day', ts + INTERVAL 12 HOUR) AS TIMESTAMP) AS nearest_day, cast(date_diff('hour', ts, TIMESTAMP '2024-02-01 00:00:00') AS BIGINT) AS hours,
                 cast(date_sub('minute', ts, TIMESTAMP '2024-02-01 00:00:00') AS BIGINT) AS full_minutes, cast(DATE '2024-02-01' - cast(ts AS DATE) AS BIGINT) AS days FROM events""")
def date_diff(t):
    end = D.as_timestamp("2024-02-01 00:00:00")
    return t.events.select("event_id", D.round_to_day("ts").cast("timestamp_ntz").alias("nearest_day"), D.periods_since("ts", "hour", "2024-02-01 00:00:00").alias("hours"),
                           D.full_units("ts", end, "minute").alias("full_minutes"), D.day_diff(D.as_date("2024-02-01"), F.to_date("ts")).alias("days"))


@query("""WITH m AS (SELECT conv_id, turn, role, '<@' || role || '> <@U9> see <https://example.org/' || conv_id || '> ' || text AS full_text FROM conversations),
               f AS (SELECT *, regexp_extract_all(full_text, '<@([A-Za-z0-9]+)>', 1) AS ids FROM m)
          SELECT conv_id, turn, array_to_string(list_filter(ids, lambda x, i: list_position(ids, x) = i), chr(10)) AS mentions,
                 array_to_string(regexp_extract_all(full_text, '<(https?://[^>|]+)', 1), chr(10)) AS links,
                 regexp_replace(replace(full_text, '<@' || role || '>', '@' || upper(role[1]) || lower(role[2:])), '<@[A-Za-z0-9]+>', '@unknown', 'g') AS resolved_text FROM f""")
def mentions_and_links(t):
    """Message texts with a mention of the turn's speaker and a link; speakers come from the same table."""
    msg = t.conversations.select(
        "conv_id", "turn", F.concat(F.lit("<@"), F.col("role"), F.lit("> <@U9> see <https://example.org/"), F.col("conv_id"), F.lit("> "), F.col("text")).alias("text"))
    people = t.conversations.select("role").distinct().withColumn("display", F.initcap("role"))
    return X.mentions(msg, "text", people, "role", "display", ["conv_id", "turn"]).select("conv_id", "turn", "mentions", "links", "resolved_text")
