import datetime as dt
import gzip
import itertools
import random
import re
import zipfile

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.session import shared_dir
from tidemark.sources import archives as A
from tidemark.sources import ingest as I
from tidemark.sources import keylog
from tidemark.sources import scans as S
from tidemark.sources import sinks as W
from tidemark.sources.bitmaps import ActivityBitmaps
from tidemark.sources.keylog import KeyedLog


@pytest.fixture
def table(spark):
    return W.VersionedTable(spark, shared_dir(spark, "t"))


def test_merge_updates_inserts_and_keeps(table, frame):
    ddl = "k int, a string, b string"
    table.write(frame([(1, "x", "y"), (2, "x", "y"), (None, "n", "n")], ddl))
    W.merge_upsert(table, frame([(2, "X", "Y"), (3, "X", "Y"), (None, "new", "new")], ddl), ["k"], ["a"])
    assert rows(table.read()) == sorted([(1, "x", "y"), (2, "X", "y"), (3, "X", "Y"), (None, "n", "n"), (None, "new", "new")], key=repr)


def test_merge_sets_null_from_source(table, frame):
    table.write(frame([(1, "x")], "k int, a string"))
    W.merge_upsert(table, frame([(1, None)], "k int, a string"), ["k"])
    assert rows(table.read()) == [(1, None)]


def test_merge_rejects_duplicate_source_keys(table, frame):
    table.write(frame([(1, "x")], "k int, a string"))
    with pytest.raises(Exception, match="more than one row for key"):
        W.merge_upsert(table, frame([(1, "p"), (1, "q")], "k int, a string"), ["k"])
    assert rows(table.read()) == [(1, "x")]  # the failed run published nothing


def test_merge_with_key_columns_only(table, frame):
    table.write(frame([(1,)], "k int"))
    W.merge_upsert(table, frame([(1,), (2,)], "k int"), ["k"])
    assert rows(table.read()) == [(1,), (2,)]


def test_readers_keep_their_version(table, frame):
    table.write(frame([(1,)], "k int"))
    before = table.read()
    assert table.write(frame([(2,)], "k int")) == 2
    assert rows(before) == [(1,)] and rows(table.read()) == [(2,)]


def test_unpublished_version_is_ignored(spark, table, frame):
    table.write(frame([(1,)], "k int"))
    table._fs.create(table._path(f"{table.root}/_versions/2"), False).close()  # a writer is publishing, or died here
    assert rows(table.read()) == [(1,)]
    with pytest.raises(RuntimeError, match="another writer"):
        table.write(frame([(3,)], "k int"))
    table.STALE_S = 0  # long enough ago: it died
    assert table.write(frame([(3,)], "k int")) == 3
    assert rows(table.read()) == [(3,)]


@pytest.mark.parametrize("keys", [None, ["k"]])
def test_second_writer_from_the_same_version_fails(spark, frame, keys):
    ddl = "k int, a string"
    root = shared_dir(spark, "race")
    one, two = (W.VersionedTable(spark, root, keys, buckets=4) for _ in range(2))
    one.write(frame([(1, "x"), (2, "x")], ddl))
    seen = two.current()
    W.merge_upsert(one, frame([(3, "one")], ddl), ["k"])
    with pytest.raises(RuntimeError, match="another writer"):
        two.write(W.merged(two.read(seen), frame([(4, "two")], ddl), ["k"]), expected=seen[0])
    assert rows(one.read()) == [(1, "x"), (2, "x"), (3, "one")]


def test_merge_rewrites_only_touched_buckets(spark, frame):
    ddl = "k int, a string"
    table = W.VersionedTable(spark, shared_dir(spark, "buckets"), ["k"], buckets=16)
    table.write(frame([(i, "old") for i in range(200)], ddl))
    (before,) = table.current()[1]
    W.merge_upsert(table, frame([(5, "new"), (500, "new")], ddl), ["k"])
    manifest = table.current()[1]
    fresh = next(f for f in manifest if f != before)
    assert len(manifest[before]) >= 14 and len(manifest[fresh]) <= 2
    assert rows(table.read()) == sorted([(i, "new" if i == 5 else "old") for i in range(200)] + [(500, "new")], key=repr)


def test_buckets_keep_their_size_as_the_table_grows(spark, frame):
    table = W.VersionedTable(spark, shared_dir(spark, "linear"), ["k"], bucket_rows=100, keep=20)
    want, at = {}, 0
    for turn in range(10):
        fresh = [(i, f"v{turn}") for i in range(at, at + 60 + 40 * turn)] + [(i, f"v{turn}") for i in range(0, at, 97)]
        at += 60 + 40 * turn
        want |= dict(fresh)
        W.merge_upsert(table, frame(fresh, "k int, a string"), ["k"])
        version = table.current()
        assert version.rows == {r["__b"]: r["n"] for r in table.read().groupBy(W.bucket_of(["k"], version.buckets).alias("__b")).agg(F.count("*").alias("n")).collect()}
        assert sum(version.rows.values()) == len(want) <= 100 * version.buckets
        assert max(version.rows.values()) <= 2 * 1.5 * len(want) / version.buckets  # unsplit buckets hold twice the rows, give or take the hash
        if turn == 4:
            middle, then = version, dict(want)
    assert version.buckets > 15 and rows(table.read()) == sorted(want.items(), key=repr)
    assert rows(table.read(middle)) == sorted(then.items(), key=repr)


def test_small_buckets_stay_few(spark):
    table = W.VersionedTable(spark, shared_dir(spark, "few"), ["id"], bucket_rows=10)
    for end in (500, 5000):
        W.merge_upsert(table, spark.range(end).select("id", F.lit(end).alias("v")), ["id"])
        assert table.current().buckets == min(end // 10, 64) and table.read().count() == end
    assert [table.buckets_for(n) for n in (30, 64 * 2_000_000, 200_000_000)] == [3, 64, 100]
    assert W.VersionedTable(spark, table.root, ["id"], buckets=300).buckets_for(5) == 300


def test_a_split_moves_the_rows_of_one_bucket(spark):
    ids = spark.range(3000)
    for n in (1, 2, 3, 5, 8, 13):
        moved = ids.select(W.bucket_of(["id"], n).alias("a"), W.bucket_of(["id"], n + 1).alias("b")).filter("a <> b").distinct().collect()
        assert [tuple(r) for r in moved] == [(W.split_from(n, n), n)]
    assert [W.split_from(b, 3) for b in (3, 4, 5, 6, 7, 12)] == [1, 0, 1, 2, 1, 0]


def test_old_versions_are_removed(spark, frame):
    table = W.VersionedTable(spark, shared_dir(spark, "keep"), ["k"], buckets=4, keep=2)
    for i in range(6):
        W.merge_upsert(table, frame([(i, f"v{i}")], "k int, a string"), ["k"])
    assert sorted(table._markers()) == [5, 6]
    assert rows(table.read()) == [(i, f"v{i}") for i in range(6)]
    empty = W.VersionedTable(spark, shared_dir(spark, "none"), ["k"], buckets=4)
    empty.write(frame([], "k int, a string"))
    assert empty.read().columns == ["k", "a"] and empty.read().count() == 0


def test_failed_rebuild_leaves_the_table(spark, frame):
    path = shared_dir(spark, "rebuild")
    W.write_replace(frame([(1,)], "v int"), path)
    with pytest.raises(Exception):
        W.write_replace(frame([(2,)], "v int").select(F.raise_error(F.lit("no")).cast("int").alias("v")), path)
    assert rows(spark.read.parquet(path)) == [(1,)]
    W.write_replace(frame([(3,)], "v int"), path)
    assert rows(spark.read.parquet(path)) == [(3,)]


def test_insert_only_is_repeatable(spark, frame):
    path = shared_dir(spark, "ins")
    for _ in range(2):
        W.insert_new(spark, path, frame([(1, "a"), (2, "b")], "k int, v string"), ["k"])
    W.insert_new(spark, path, frame([(2, "z"), (3, "c")], "k int, v string"), ["k"])
    assert rows(spark.read.parquet(path)) == [(1, "a"), (2, "b"), (3, "c")]


def test_dynamic_overwrite_touches_only_its_partitions(spark, frame):
    path = shared_dir(spark, "dyn")
    W.overwrite_partitions(frame([(1, "a"), (2, "b")], "v int, p string"), path, ["p"])
    W.overwrite_partitions(frame([(9, "b"), (8, "c")], "v int, p string"), path, ["p"])
    assert rows(S.scan_partitioned(spark, path, {"p": "string"})) == [(1, "a"), (8, "c"), (9, "b")]


def test_id_sets_and_minimums(frame):
    old = frame([(1, ["a"], "x", 5), (2, ["b"], "y", 1)], "k int, ids array<string>, top string, first int")
    new = frame([(1, ["c", "a"], "z", 3), (3, ["d"], "w", 2)], "k int, ids array<string>, top string, first int")
    assert rows(W.merge_id_sets(old, new, "k", ["ids"]).select("k", "ids", "top")) == [(1, ["a", "c"], "z"), (2, ["b"], "y"), (3, ["d"], "w")]
    assert rows(W.merge_min_attrs(old, new, "k", ["first"], ["ids"])) == [(1, 3, ["a", "c"]), (2, 1, ["b"]), (3, 2, ["d"])]


def test_partition_types_are_declared(spark, frame):
    path = shared_dir(spark, "typed")
    W.write_replace(frame([(1, "007"), (2, "010")], "v int, code string"), path, ["code"])
    schema = spark.read.parquet(path).select("v").schema
    for given in (None, schema):
        assert rows(S.scan_partitioned(spark, path, {"code": "string"}, schema=given)) == [(1, "007"), (2, "010")]


def test_shards_prune_partitions(spark, frame):
    path = shared_dir(spark, "shard")
    df = frame([(i, f"2024010{i}") for i in range(1, 8)], "v int, _suffix string")
    W.write_replace(df, path, ["_suffix"])
    recent = S.scan_date_shards(spark, path, "2024-01-06", days_back=2, schema=df.select("v").schema)
    assert rows(recent.select("v")) == [(4,), (5,), (6,)]
    plan = recent._jdf.queryExecution().toString()
    assert "PartitionFilters: [isnotnull(_suffix" in plan
    before = spark.sparkContext.statusTracker().getJobIdsForGroup()
    newest = S.scan_latest_shard(spark, path, schema=df.select("v").schema)
    assert spark.sparkContext.statusTracker().getJobIdsForGroup() == before  # folder names only, no job
    assert rows(newest.select("v")) == [(7,)]


def test_csv_reports(spark, tmp_path):
    for day, name in (("20240101", "Ann"), ("20240102", "Bob")):
        with gzip.open(tmp_path / f"sales_{day}.csv.gz", "wt") as f:
            f.write(f"User Name,Item.Price\n{name},1.5\n{name},1.5\n")
    loaded = spark.range(1).select(F.lit("2024-01-01").cast("date").alias("snapshot_date"))
    out = I.ingest_csv_reports(spark, f"{tmp_path}/*.csv.gz", r"sales_([0-9]{8})", loaded=loaded, distinct=True)
    assert out.columns == ["user_name", "item_price", "snapshot_date"]
    assert rows(out) == [("Bob", "1.5", dt.date(2024, 1, 2))]


def test_csv_utf16_tab(spark, tmp_path):
    (tmp_path / "r_20240103.csv").write_bytes("Name\tNote\nÄnn\tx\n".encode("utf-16"))
    out = I.ingest_csv_reports(spark, f"{tmp_path}/r_*.csv", r"r_([0-9]{8})", sep="\t", encoding="UTF-16")
    assert rows(out) == [("Änn", "x", dt.date(2024, 1, 3))]


def test_zip_reports(spark, tmp_path):
    with zipfile.ZipFile(tmp_path / "earnings_202401.zip", "w") as z:
        z.writestr("a.csv", "id,amount\n1,2.50\n2,3.00\n")
        z.writestr("folder/", "")
        z.writestr("folder/b.csv", 'id,id,note\n7,8,"two\nlines"\n\n9\n')
        z.writestr("empty.csv", "")
    with zipfile.ZipFile(tmp_path / "earnings_202402.zip", "w", zipfile.ZIP_DEFLATED) as z:
        z.writestr("long.csv", "id\n" + "\n".join(str(i) for i in range(12_000)))
    out = A.ingest_zip_reports(spark, f"{tmp_path}/*.zip", r"earnings_([0-9]{6})", "yyyyMM")
    assert out.rdd.getNumPartitions() == 4  # one task per member
    first = out.filter("snapshot_date = '2024-01-01'")
    assert rows(first.select("member", "line", F.to_json("record"))) == [
        ("a.csv", 0, '{"id":"1","amount":"2.50"}'), ("a.csv", 1, '{"id":"2","amount":"3.00"}'),
        ("folder/b.csv", 0, '{"id":"7","note":"two\\nlines"}'), ("folder/b.csv", 1, '{"id":"9"}')]
    long = out.filter("member = 'long.csv'")
    assert tuple(long.agg(F.count("*"), F.max("line"), F.countDistinct(F.col("record")["id"])).first()) == (12_000, 11_999, 12_000)
    loaded = spark.range(1).select(F.lit("2024-01-01").cast("date").alias("snapshot_date"))
    assert A.ingest_zip_reports(spark, f"{tmp_path}/*.zip", r"earnings_([0-9]{6})", "yyyyMM", loaded=loaded).select("member").distinct().count() == 1
    only = A.ingest_zip_reports(spark, f"{tmp_path}/*01.zip", r"earnings_([0-9]{6})", "yyyyMM", first_only=True)
    assert rows(only.select("line", F.col("record")["amount"], "snapshot_date")) == [(0, "2.50", dt.date(2024, 1, 1)), (1, "3.00", dt.date(2024, 1, 1))]


def test_json_columns(spark, tmp_path):
    (tmp_path / "d.json").write_text('[{"a": 1, "b": {"c": 2}}, {"a": "x", "z": 0}]')
    assert rows(I.ingest_json_columns(spark, str(tmp_path / "d.json"), ["a", "b", "none"], multi_line=True)) == [("1", '{"c": 2}', None), ("x", None, None)]


def test_explode_zip(frame):
    df = frame([(1, "[1, 2]", "[a,b]"), (2, "[]", "[]"), (3, None, None)], "id int, x string, y string")
    assert rows(I.explode_zip(df, ["x", "y"])) == sorted([(1, "1", "a"), (1, "2", "b"), (2, "[]", "[]"), (3, None, None)], key=repr)


def test_html_fields(frame):
    df = frame([(1, "<h1>Gold &amp; <b>Co</b></h1><span class='p'>$1,234.50</span>"), (2, "nothing")], "id int, html string")
    out = I.extract_fields(df, "html", {"name": "<h1>(.*?)</h1>", "price": "class='p'>([^<]*)<"}, ["id"], numeric=["price"])
    assert rows(out) == [(1, "Gold & Co", 1234.5), (2, None, None)]


def test_latest_snapshots(frame):
    d = dt.date
    df = frame([(1, d(2023, 1, 5)), (2, d(2023, 1, 31)), (3, d(2024, 1, 9)), (4, d(2024, 2, 1))], "id int, s date")
    assert rows(S.latest_snapshot(df, "s").select("id")) == [(4,)]
    assert rows(S.latest_snapshot_per_period(df, "s").select("id")) == [(2,), (3,), (4,)]
    assert rows(S.latest_snapshot_per_period(df, "s", ignore_year=True).select("id")) == [(3,), (4,)]
    assert rows(S.keep_first_last_snapshots(df, "s").select("id")) == [(1,), (4,)]


def test_shared_dir_needs_a_setting_on_a_cluster(spark, monkeypatch):
    class Context:
        master = "yarn"

    class Session:
        sparkContext = Context()

        class conf:
            get = staticmethod(lambda k, d=None: d)

    with pytest.raises(ValueError):
        shared_dir(Session(), "x")


def log_of(spark, **kw):
    return KeyedLog(spark, shared_dir(spark, "log"), ["k"], **kw)


def test_keyed_log_reads_only_files_that_may_hold_a_key(spark):
    log = log_of(spark, file_rows=500, folders=20)
    for i in range(5):
        log.insert(spark.range(i * 4000, (i + 1) * 4000).select(F.col("id").alias("k"), F.lit(f"v{i}").alias("v")))
    assert log.read().count() == 20_000
    version = log.current()
    assert [parts for parts, _, _ in version.folders.values()] == [8] * 5
    batch = spark.createDataFrame([(17, "again"), (10**12, "new")], "k bigint, v string")
    files = log.files_for(batch)
    holds = [r[0] for r in log.read().filter("k = 17").select(F.regexp_extract(F.input_file_name(), "(data-.*/__part=\\d+)", 1)).collect()]
    assert any(f.endswith(holds[0]) for f in files) and len(files) <= 2  # a chance hit of the filters is possible, but rare
    log.insert(batch)
    assert [tuple(r) for r in log.read().filter("k IN (17, 1000000000000)").orderBy("k").collect()] == [(17, "v0"), (10**12, "new")]


def test_keyed_log_filters_miss_no_key_and_pass_few_others(spark):
    log = log_of(spark, file_rows=2000)
    keys = spark.range(30_000).select(F.xxhash64("id").alias("k"))
    log.insert(keys)
    every = log.files_for(keys)
    assert len(every) == 16
    assert log.unseen(keys, log.current()).count() == 0
    others = spark.range(10**6, 10**6 + 200).select(F.xxhash64("id").alias("k"))
    assert sum(len(log.files_for(others.filter(f"abs(k) % 200 = {i}"))) for i in range(0, 200, 20)) <= 3


def test_keyed_log_never_broadcasts_its_keys(spark):
    log = log_of(spark)
    log.insert(spark.range(5000).select(F.col("id").alias("k")))
    asked = spark.range(4990, 5010).select(F.col("id").alias("k"))
    unseen = log.unseen(asked, log.current())
    plan = unseen._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan
    assert rows(unseen) == [(k,) for k in range(5000, 5010)]


@pytest.mark.parametrize("sent", [0, 3, 100])
def test_keyed_log_never_broadcasts_keys_spread_over_folders(spark, monkeypatch, sent):
    """A key is looked up in every folder's filter, which the planner does not count; filters up to a size may be sent."""
    log = log_of(spark, folders=20, file_rows=2000)
    for i, n in enumerate([10, 300, 6000, 5000, 10, 4000]):
        log.insert(spark.range(10_000 * i, 10_000 * i + n).select(F.col("id").alias("k"), F.lit("v").alias("v")))
    plans, kind = [], type(log.read())
    collect = kind.collect

    def spied(df):
        out = collect(df)
        plans.append(df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0])
        return out

    monkeypatch.setattr(keylog, "SENT_BLOCKS", sent, raising=False)
    monkeypatch.setattr(kind, "collect", spied)
    few = F.array(*[F.lit(k) for k in (5, 10_299, 25_999, 31_000, 10**9)])
    files = log.files_for(spark.range(5).select(F.get(few, F.col("id").cast("int")).cast("bigint").alias("k")))  # looks smaller than the filters
    monkeypatch.undo()
    lines = plans[0].split("\n")
    depth = [len(re.match(r"[\s:|*+-]*", line)[0]) for line in lines]
    for i in (i for i, line in enumerate(lines) if "BroadcastExchange" in line):
        below = itertools.takewhile(lambda k, i=i: depth[k] > depth[i], range(i + 1, len(lines)))
        assert not any("Generate" in lines[k] for k in below)
    assert ("BroadcastHashJoin" in plans[0]) == (sent > 0) and ("SortMergeJoin" in plans[0]) == (sent < 100)
    holds = {r[0] for r in log.read().filter("k IN (5, 10299, 25999, 31000)").select(F.regexp_extract(F.input_file_name(), "(data-.*/__part=\\d+)", 1)).collect()}
    assert len(holds) == 4 and holds <= {f.removeprefix(f"{log.root}/") for f in files} and len(files) <= 6


def test_keyed_log_has_one_writer_at_a_time(spark, frame):
    one = log_of(spark)
    one.insert(frame([(1, "a")], "k bigint, v string"))
    two = KeyedLog(spark, one.root, ["k"])
    seen = two.current()
    one.insert(frame([(2, "one")], "k bigint, v string"))
    two.current = lambda: seen  # the other writer began before
    with pytest.raises(RuntimeError, match="another writer"):
        two.insert(frame([(2, "two"), (3, "two")], "k bigint, v string"))
    assert rows(one.read()) == [(1, "a"), (2, "one")]


def test_keyed_log_stays_small_and_repeatable(spark, frame):
    log = log_of(spark, folders=4, keep=2)
    for i in range(14):
        batch = frame([(j, f"v{i}") for j in range(3 * i, 3 * i + 5)] + [(None, f"null {i}")], "k bigint, v string")
        log.insert(batch)
        assert len(log.current().folders) <= 4
    want = {j: f"v{max(0, -(-(j - 4) // 3))}" for j in range(3 * 13 + 5)}
    got = log.read()
    assert rows(got.filter("k IS NOT NULL")) == sorted(want.items(), key=repr) and got.filter("k IS NULL").count() == 14
    known = frame([(4, "x")], "k bigint, v string")
    assert log.insert(known) == log.current().number == log.insert(known)
    used = {f for n, s in log._markers().items() for f in log._manifest(n, s).folders}
    stored = {s.getPath().getName() for s in log._fs.listStatus(log._path(log.root))} - {"_versions"}
    assert stored == used
    empty = log_of(spark)
    empty.insert(frame([], "k bigint, v string"))
    assert empty.read().columns == ["k", "v"] and empty.read().count() == 0
    empty.insert(frame([(1, "a")], "k bigint, v string"))
    assert rows(empty.read()) == [(1, "a")]


def test_activity_bitmaps_read_only_what_is_new(spark, frame):
    r = random.Random(2)
    ddl = "u string, d date, n int"
    day = lambda i: dt.date(2024, 1, 1) + dt.timedelta(days=i)
    events = [(r.choice([None, *(f"user {i}" for i in range(60))]), day(i), r.randint(0, 9)) for i in range(45) for _ in range(30)]
    stored = ActivityBitmaps(spark, shared_dir(spark, "active"), "u")
    for a, b in ((0, 20), (20, 21), (21, 45), (5, 7)):  # the last one brings two days again
        stored.add(frame([e for e in events if day(a) <= e[1] < day(b)], ddl), "d")
    for grain, cut in (("day", lambda x: x), ("month", lambda x: x.replace(day=1)), ("week", lambda x: x - dt.timedelta(days=x.weekday()))):
        want = {}
        for u, d, _ in events:
            want.setdefault(cut(d), set()).add(u) if u else None
        assert rows(stored.counts(grain)) == sorted(((p, len(us)) for p, us in want.items()), key=repr)
    codes = [c for _, c in rows(stored.codes.read())]
    assert sorted(codes) == list(range(1, 61))
    stored.add(frame([("user 1", day(50), 1)], ddl).limit(0), "d")
    stored.add(frame([("user 1", day(5), 1)], ddl), "d")  # a corrected day replaces the old one
    assert rows(stored.counts("day").filter(F.col("period") == F.lit(day(5)))) == [(day(5), 1)]
