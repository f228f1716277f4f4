"""Scans, ingestion and sinks: tables are written to a fresh shared folder, loaded and read back."""

from __future__ import annotations

import zipfile

import pandas as pd
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.aggregates import money
from ..operators.checks import run_checks, accepted_range, accepted_values
from ..session import shared_dir
from ..sources import ingest as I
from ..sources import scans as S
from ..sources import sinks as W
from ..sources.archives import ingest_zip_reports, opened
from ..sources.keylog import KeyedLog
from .registry import query


def scratch(t, label):
    return shared_dir(t.spark, label)


def suffix_of(col):
    return F.date_format(col, "yyyyMMdd")


# ---- scans

@query("""SELECT o_orderkey, o_totalprice, o_orderstatus, cast(year(o_orderdate) AS INTEGER) AS year, cast(NULL AS VARCHAR) AS later_column FROM orders WHERE o_orderstatus = 'F' AND year(o_orderdate) >= 1999""")
def scan_hive_partitioned(t):
    root = scratch(t, "hive")
    t.orders.withColumn("year", F.year("o_orderdate")).write.partitionBy("o_orderstatus", "year").parquet(root)
    schema = T.StructType.fromDDL("o_orderkey bigint, o_totalprice double, later_column string")
    df = S.scan_partitioned(t.spark, root, {"o_orderstatus": "string", "year": "int"}, schema=schema)
    return df.filter("o_orderstatus = 'F' AND year >= 1999")


def write_shards(t, label):
    root = scratch(t, label)
    t.events.withColumn("_suffix", suffix_of("ts")).write.partitionBy("_suffix").parquet(root)
    return root


@query("""SELECT strftime(ts, '%Y%m%d') AS _suffix, count(*) AS n, cast(sum(cast(value AS DECIMAL(14,2))) AS DOUBLE) AS total FROM events WHERE cast(ts AS DATE) BETWEEN DATE '2024-01-11' AND DATE '2024-01-25' GROUP BY 1""")
def scan_date_shards(t):
    df = S.scan_date_shards(t.spark, write_shards(t, "shards"), "2024-01-25", days_back=14)
    return df.groupBy("_suffix").agg(F.count("*").alias("n"), F.sum(money("value")).cast("double").alias("total"))


@query("""SELECT event_id, strftime(ts, '%Y%m%d') AS _suffix FROM events WHERE cast(ts AS DATE) = (SELECT max(cast(ts AS DATE)) FROM events)""")
def scan_latest_shard(t):
    return S.scan_latest_shard(t.spark, write_shards(t, "shards")).select("event_id", "_suffix")


@query("SELECT l_orderkey, l_linenumber, l_shipdate FROM lineitem WHERE l_shipdate = (SELECT max(l_shipdate) FROM lineitem)")
def scan_latest_snapshot(t):
    return S.latest_snapshot(t.lineitem, "l_shipdate").select("l_orderkey", "l_linenumber", "l_shipdate")


@query("""SELECT o_orderkey, o_orderdate FROM orders WHERE o_orderdate IN (SELECT max(o_orderdate) FROM orders GROUP BY date_trunc('month', o_orderdate))""")
def scan_latest_snapshot_per_month(t):
    return S.latest_snapshot_per_period(t.orders, "o_orderdate").select("o_orderkey", "o_orderdate")


@query("""SELECT cast(c_custkey AS VARCHAR) AS customer_key, c_name AS full_name, c_mktsegment AS market_segment, DATE '2024-01-01' + (c_nationkey % 3) AS snapshot_date FROM customer WHERE c_nationkey % 3 > 0""")
def scan_csv_all_string(t):
    """Tab-separated gzip reports, one folder per day; the first day is already loaded and skipped."""
    root = scratch(t, "reports")
    c = t.customer.select(F.col("c_custkey").alias("Customer Key"), F.col("c_name").alias("Full.Name"), F.col("c_mktsegment").alias("Market Segment"), (F.col("c_nationkey") % 3).alias("d"))
    for d in range(3):
        c.filter(F.col("d") == d).drop("d").write.option("header", True).option("sep", "\t").option("compression", "gzip").csv(f"{root}/report_2024010{d + 1}")
    loaded = t.customer.agg(F.lit("2024-01-01").cast("date").alias("snapshot_date"))
    return I.ingest_csv_reports(t.spark, f"{root}/report_*", r"report_([0-9]{8})", sep="\t", loaded=loaded)


@query("""SELECT cast(s_suppkey AS VARCHAR) AS key, s_name AS name, cast(s_nationkey AS VARCHAR) AS nation, DATE '2024-01-05' AS snapshot_date FROM supplier""")
def scan_csv_utf16(t):
    """A report as the app stores write it: UTF-16, comma-separated, with a header."""
    root = scratch(t, "utf16")
    s = t.supplier.select(F.col("s_suppkey").alias("Key"), F.col("s_name").alias("Name"), F.col("s_nationkey").alias("Nation"))
    s.write.option("header", True).option("encoding", "UTF-16").csv(f"{root}/report_20240105")
    return I.ingest_csv_reports(t.spark, f"{root}/report_*", r"report_([0-9]{8})", encoding="UTF-16")


@query("""SELECT strftime(cast(o_orderdate AS DATE), '%Y-%m') || '.csv' AS member, cast(o_orderkey AS VARCHAR) AS order_key, o_orderpriority AS priority, make_date(cast(year(o_orderdate) AS BIGINT), 1, 1) AS snapshot_date FROM orders""")
def scan_csv_zip(t):
    """Yearly archives with one report per month in them, every member read by a task of its own."""
    root = scratch(t, "zips")

    def pack(key, pdf):
        path = f"{root}/orders_{key[0]}01.zip"
        with opened(path, "wb") as f, zipfile.ZipFile(f, "w", zipfile.ZIP_DEFLATED) as archive:
            for month, rows in pdf.groupby("month"):
                archive.writestr(f"{month}.csv", rows[["Order Key", "Priority"]].to_csv(index=False))
        return pd.DataFrame({"path": [path]})

    date = F.col("o_orderdate").cast("date")
    o = t.orders.select(F.year(date).alias("year"), F.date_format(date, "yyyy-MM").alias("month"), F.col("o_orderkey").alias("Order Key"), F.col("o_orderpriority").alias("Priority"))
    t.spark.read.parquet(t.path("region")).limit(0).write.mode("overwrite").parquet(f"{root}/made")  # the folder
    o.groupBy("year").applyInPandas(pack, "path string").write.mode("overwrite").parquet(f"{root}/made")
    read = ingest_zip_reports(t.spark, f"{root}/*.zip", r"orders_([0-9]{6})", "yyyyMM")
    return read.select("member", F.col("record")["Order Key"].alias("order_key"), F.col("record")["Priority"].alias("priority"), "snapshot_date")


@query("""SELECT cast(o_orderkey AS VARCHAR) AS o_orderkey, cast(o_custkey AS VARCHAR) AS o_custkey, o_orderpriority, cast(NULL AS VARCHAR) AS absent FROM orders""")
def scan_json_all_string(t):
    root = scratch(t, "dump")
    t.orders.write.json(root)
    return I.ingest_json_columns(t.spark, root, ["o_orderkey", "o_custkey", "o_orderpriority", "absent"])


@query("""SELECT p_partkey, unnest(string_split(p_name, ' ')) AS amounts, unnest([cast(p_size AS VARCHAR), p_brand]) AS batch FROM part WHERE p_size > 10 UNION ALL SELECT p_partkey, '[]', '[]' FROM part WHERE p_size <= 10""")
def explode_parallel_lists(t):
    filled = F.col("p_size") > 10
    a = F.when(filled, F.concat(F.lit("["), F.replace("p_name", F.lit(" "), F.lit(", ")), F.lit("]"))).otherwise("[]")
    b = F.when(filled, F.concat(F.lit("["), F.col("p_size"), F.lit(","), F.col("p_brand"), F.lit("]"))).otherwise("[]")
    return I.explode_zip(t.part.select("p_partkey", a.alias("amounts"), b.alias("batch")), ["amounts", "batch"])


@query("""SELECT c_custkey, c_name AS name, c_mktsegment AS segment, cast(NULL AS VARCHAR) AS phone, 'N' || c_nationkey AS provider, cast(c_nationkey AS BIGINT) AS account FROM customer""")
def explode_struct_attributes(t):
    ids = F.to_json(F.array(F.struct(F.concat(F.lit("N"), "c_nationkey").alias("provider"), F.col("c_nationkey").alias("account"))))
    attrs = F.to_json(F.array(*[F.struct(F.lit(k).alias("Name"), v.alias("Value")) for k, v in (("name", F.col("c_name")), ("segment", F.col("c_mktsegment")), ("identities", ids))]))
    return I.flatten_attributes(t.customer.select("c_custkey", attrs.alias("attributes")), "attributes", ["name", "segment", "phone"], "identities", "provider:string,account:bigint").drop("attributes")


@query("""SELECT p_partkey, 'name' AS platform, p_name AS address FROM part WHERE p_size > 5 UNION ALL SELECT p_partkey, 'brand', p_brand FROM part WHERE p_size > 5 UNION ALL SELECT p_partkey, NULL, NULL FROM part WHERE p_size <= 5""")
def explode_map_entries(t):
    m = F.when(F.col("p_size") > 5, F.create_map(F.lit("name"), "p_name", F.lit("brand"), "p_brand")).otherwise(F.create_map().cast("map<string,string>"))
    return I.explode_map(t.part.select("p_partkey", m.alias("platforms")), "platforms", "platform", "address")


@query("""SELECT o_orderkey, cast(o_totalprice AS DOUBLE) AS m_price, o_orderstatus AS m_status, 1 AS first_rank, cast(o_custkey AS DOUBLE) AS second_value FROM orders""")
def flatten_nested_records(t):
    rec = F.struct(F.col("o_totalprice").alias("price"), F.col("o_orderstatus").alias("status"))
    pairs = F.array(F.array(F.lit(1).cast("string"), F.lit("0.5")), F.array(F.lit("2"), F.col("o_custkey").cast("string")))
    o = I.flatten_struct(t.orders.select("o_orderkey", rec.alias("metric"), pairs.alias("pairs")), "metric", "m_")
    o = o.withColumn("points", I.pairs_to_structs("pairs", "rank", "value", ("int", "double")))
    return o.select("o_orderkey", "m_price", "m_status", F.col("points")[0]["rank"].alias("first_rank"), F.col("points")[1]["value"].alias("second_value"))


@query("""SELECT user_id, 'by_type_' || event_type AS metric_key, count(*) AS metric_value FROM events GROUP BY 1, 2""")
def explode_metric_map(t):
    per = t.events.groupBy("user_id", F.concat(F.lit("by.type."), "event_type").alias("k")).agg(F.count("*").alias("n"))
    doc = per.groupBy("user_id").agg(F.to_json(F.map_from_entries(F.collect_list(F.struct("k", "n")))).alias("value"))
    return I.explode_metric_map(doc, "value")


@query("""SELECT n_nationkey, n_name, r_name, cast(n_nationkey * 10 AS INTEGER) AS score FROM nation JOIN region ON r_regionkey = n_regionkey""")
def explode_nested_list(t):
    rows = t.nation.join(t.region, F.col("n_regionkey") == F.col("r_regionkey"))
    packed = rows.groupBy("r_name").agg(F.sort_array(F.collect_list(F.struct("n_nationkey", "n_name", (F.col("n_nationkey") * 10).alias("score")))).alias("creatives"))
    return I.explode_list(packed, "creatives", ["r_name"], ["n_nationkey", "n_name", "score"])


@query("SELECT c_custkey AS customer_id, c_name AS full_name FROM customer")
def normalize_column_names(t):
    return I.normalize_columns(t.customer.select(F.col("c_custkey").alias("Customer Id"), F.col("c_name").alias("Full.Name")))


@query("""WITH f AS (SELECT page_id, nullif(regexp_extract(html, '<title>([^<]*)</title>', 1), '') AS title, nullif(regexp_extract(html, 'lang="([a-z]+)"', 1), '') AS lang, try_cast(nullif(regexp_extract(html, 'track\\(([0-9]+)\\)', 1), '') AS DOUBLE) AS tracker FROM pages)
          SELECT page_id, trim(replace(replace(replace(replace(replace(replace(title, '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', ''''), '&nbsp;', ' '), '&amp;', '&')) AS title, lang, tracker FROM f""".replace("\\\\", "\\"))
def html_field_extract(t):
    specs = {"title": "<title>([^<]*)</title>", "lang": 'lang="([a-z]+)"', "tracker": r"track\(([0-9]+)\)"}
    return I.extract_fields(t.pages, "html", specs, ["page_id"], numeric=["tracker"])


@query("""SELECT page_id, cast(generate_subscripts(l, 1) - 1 AS INTEGER) AS position, unnest(l) AS item FROM (SELECT page_id, regexp_extract_all(html, 'href="([^"]*)"', 1) AS l FROM pages)""")
def html_series(t):
    return I.price_series(t.pages, "html", 'href="([^"]*)"', ["page_id"])


@query("""SELECT label, weight, count(*) AS n FROM orders JOIN (VALUES ('F', 'finished', 1.0::DOUBLE), ('O', 'open', 0.5::DOUBLE), ('P', 'partial', 0.25::DOUBLE)) v(o_orderstatus, label, weight) USING (o_orderstatus) GROUP BY 1, 2""")
def literal_dimension(t):
    dim = I.literal_table(t.spark, [("F", "finished", 1.0), ("O", "open", 0.5), ("P", "partial", 0.25)], "o_orderstatus string, label string, weight double")
    return t.orders.groupBy("o_orderstatus").agg(F.count("*").alias("n")).join(dim, "o_orderstatus").select("label", "weight", "n")


# ---- sinks

@query("""SELECT o_orderkey, o_custkey, cast(year(o_orderdate) AS INTEGER) AS year FROM orders""")
def write_table_replace(t):
    """Built twice: the second, larger build leaves nothing of the first behind."""
    root = scratch(t, "replace")
    o = t.orders.select("o_orderkey", "o_custkey", F.year("o_orderdate").alias("year"))
    W.write_replace(o.filter("year < 1998").withColumn("o_custkey", F.lit(-1).cast("bigint")), root, ["year"])
    W.write_replace(o, root, ["year"], ["o_custkey"])
    return S.scan_partitioned(t.spark, root, {"year": "int"})


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def write_view(t):
    return S.register_view(t.events, "tm_events_view").groupBy("event_type").agg(F.count("*").alias("n"))


@query("SELECT o_orderkey, o_orderstatus FROM orders UNION ALL SELECT o_orderkey, o_orderstatus FROM orders WHERE o_orderstatus = 'P'")
def write_append(t):
    root = scratch(t, "append")
    o = t.orders.select("o_orderkey", "o_orderstatus")
    W.write_append(o, root)
    W.write_append(o.filter("o_orderstatus = 'P'"), root)
    return t.spark.read.parquet(root)


@query("""SELECT c_custkey, c_acctbal + 1 AS balance, '20240102' AS _suffix FROM customer UNION ALL SELECT c_custkey, c_acctbal, '20240101' FROM customer""")
def write_snapshot_shard(t):
    """Two daily snapshots; the second day is written twice and replaced."""
    root = scratch(t, "snapshot")
    c = t.customer.select("c_custkey", F.col("c_acctbal").alias("balance"))
    W.write_snapshot(c, root, "2024-01-01")
    W.write_snapshot(c.withColumn("balance", F.lit(0.0)), root, "2024-01-02")
    W.write_snapshot(c.withColumn("balance", F.col("balance") + 1), root, "2024-01-02")
    return S.scan_partitioned(t.spark, root, {"_suffix": "string"})


@query("""SELECT doc_id, quality, TIMESTAMP '2024-02-01 00:00:00' AS collected, '2024-02-01' AS dt FROM labels""")
def write_partition_parquet(t):
    root = scratch(t, "collected")
    assert W.write_collected(t.labels.select("doc_id", "quality"), root, {"dt": "2024-02-01"}, "2024-02-01 00:00:00")
    assert not W.write_collected(t.labels.filter("doc_id < 0").select("doc_id", "quality"), root, {"dt": "2024-02-01"}, "2024-02-02 00:00:00")
    df = S.scan_partitioned(t.spark, root, {"dt": "string"})
    return df.select("doc_id", "quality", F.col("__collected_ts").cast("timestamp_ntz").alias("collected"), "dt")


@query("""SELECT cast(ts AS DATE) AS day, event_type, count(*) AS n, cast(sum(cast(value AS DECIMAL(14,2))) AS DOUBLE) AS total FROM events GROUP BY 1, 2""")
def incremental_insert_overwrite(t):
    """A first run on half of the month, then a run from the stored maximum on; equal to a full rebuild."""
    root = scratch(t, "incremental")

    def build(limit):
        def run(watermark):
            rows = t.events.filter(F.col("ts") < limit)
            if watermark is not None:
                rows = rows.filter(F.col("ts") >= watermark)
            return rows.groupBy(F.to_date("ts").alias("day"), "event_type").agg(F.count("*").alias("n"), F.sum(money("value")).cast("double").alias("total"))
        return run

    for limit in ("2024-01-15 12:00:00", "2024-02-01 00:00:00"):
        W.insert_overwrite_since_max(build(limit), t.spark, root, "day")
    return S.scan_partitioned(t.spark, root, {"day": "date"})


@query("""SELECT c_custkey, c_name, CASE WHEN c_custkey % 2 = 0 THEN c_acctbal * 2 ELSE c_acctbal END AS c_acctbal, c_mktsegment FROM customer WHERE c_custkey < 1000
          UNION ALL SELECT c_custkey, 'new', c_acctbal * 2, c_mktsegment FROM customer WHERE c_custkey >= 1000 AND c_custkey % 2 = 0""")
def incremental_merge_upsert(t):
    """Only the listed column changes on a match; other rows are inserted; a second run changes nothing."""
    table = W.VersionedTable(t.spark, scratch(t, "merge"), keys=["c_custkey"], bucket_rows=2000)
    c = t.customer.select("c_custkey", "c_name", "c_acctbal", "c_mktsegment")
    table.write(c.filter("c_custkey < 1000"))
    source = c.filter("c_custkey % 2 = 0").withColumns({"c_name": F.lit("new"), "c_acctbal": F.col("c_acctbal") * 2})
    for _ in range(2):
        W.merge_upsert(table, source, ["c_custkey"], ["c_acctbal"])
    return table.read()


@query("""SELECT o_orderkey, o_custkey FROM orders""")
def incremental_merge_insert_only(t):
    """Orders of some customers, then all orders twice; then one order that was stored first, which is not stored again."""
    log = KeyedLog(t.spark, scratch(t, "insert"), ["o_orderkey"], file_rows=4000, folders=3)
    o = t.orders.select("o_orderkey", "o_custkey")
    for part in (o.filter("o_custkey < 700"), o.filter("o_custkey < 800"), o, o, o.filter("o_custkey = 1")):
        log.insert(part)
    return log.read()


def id_batch(events, cond):
    rows = events.filter(cond)
    return rows.groupBy("user_id").agg(F.array_sort(F.collect_set("event_type")).alias("ids"), F.max("value").alias("top"), F.min("ts").alias("first_ts"))


IDS = "list_aggregate(list_sort(list(DISTINCT event_type)), 'string_agg', ',')"


@query(f"""SELECT user_id, {IDS} AS ids, coalesce(max(value) FILTER (ts >= TIMESTAMP '2024-01-10'), max(value) FILTER (ts < TIMESTAMP '2024-01-12')) AS top FROM events GROUP BY 1""")
def incremental_array_merge(t):
    table = W.VersionedTable(t.spark, scratch(t, "ids"), keys=["user_id"], bucket_rows=100)
    table.write(id_batch(t.events, "ts < '2024-01-12'").drop("first_ts"))
    batch = id_batch(t.events, "ts >= '2024-01-10'").drop("first_ts")
    W.rewrite(table, batch, lambda stored: W.merge_id_sets(stored, batch, "user_id", ["ids"]))
    return table.read().withColumn("ids", F.array_join("ids", ","))


@query(f"""SELECT user_id, {IDS} AS ids, min(ts) AS first_ts FROM events GROUP BY 1""")
def incremental_min_merge(t):
    table = W.VersionedTable(t.spark, scratch(t, "mins"), keys=["user_id"], bucket_rows=100)
    table.write(id_batch(t.events, "ts >= '2024-01-10'").drop("top"))
    batch = id_batch(t.events, "ts < '2024-01-12'").drop("top")
    W.rewrite(table, batch, lambda stored: W.merge_min_attrs(stored, batch, "user_id", ["first_ts"], ["ids"]))
    return table.read().withColumn("ids", F.array_join("ids", ","))


@query("SELECT s_suppkey, s_name, s_acctbal FROM supplier")
def export_csv_replace(t):
    root = scratch(t, "export")
    for _ in range(2):
        W.export_csv(t.supplier.select("s_suppkey", "s_name", "s_acctbal"), root)
    return t.spark.read.option("header", True).schema("s_suppkey bigint, s_name string, s_acctbal double").csv(root)


@query("""SELECT event_id, cast(ts AS DATE) AS day FROM events WHERE cast(ts AS DATE) IN ((SELECT min(cast(ts AS DATE)) FROM events), (SELECT max(cast(ts AS DATE)) FROM events))""")
def retain_snapshot_endpoints(t):
    return S.keep_first_last_snapshots(t.events.select("event_id", F.to_date("ts").alias("day")), "day")


@query("""SELECT event_id, ts FROM events WHERE ts >= TIMESTAMP '2024-01-18 00:00:00'""")
def retain_recent_partitions(t):
    return S.retain_days(t.events.select("event_id", "ts"), "ts", "2024-01-25", 7)


@query("""SELECT 'r1' AS run_id, check_name, n AS failures, md5('r1-' || check_name) AS result_id FROM (SELECT 'discount' AS check_name, count(*) AS n FROM lineitem WHERE l_discount > 0.05 UNION ALL SELECT 'status', count(DISTINCT o_orderstatus) FROM orders WHERE o_orderstatus <> 'F')
          UNION ALL SELECT 'r2', 'discount', count(*), md5('r2-discount') FROM lineitem WHERE l_discount > 0.08""")
def check_results_log(t):
    root = scratch(t, "checks")
    first = run_checks({"discount": accepted_range(t.lineitem, "l_discount", max_value=0.05), "status": accepted_values(t.orders, "o_orderstatus", ["F"])})
    W.store_check_results(first, f"{root}/central", f"{root}/history", "r1")
    W.store_check_results(run_checks({"discount": accepted_range(t.lineitem, "l_discount", max_value=0.08)}), f"{root}/central", f"{root}/history", "r2")
    return t.spark.read.parquet(f"{root}/history").select("run_id", "check_name", "failures", "result_id")
