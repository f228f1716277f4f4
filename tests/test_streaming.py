"""Streams run to completion must equal their batch twins."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from tests.conftest import rows
from tidemark.operators.engagement import sessionize
from tidemark.session import shared_dir
from tidemark.sources.sinks import VersionedTable
from tidemark.streaming import jobs as J
from tidemark.streaming import sessions as SE
from tidemark.streaming.sessions import keyed_state, stream_start_sessions


@pytest.fixture
def land(spark, frame):
    """Write frames as successive files and open them as a stream, one file per batch."""
    def go(*parts):
        root = shared_dir(spark, "land")
        for p in parts:
            p.coalesce(1).write.mode("append").parquet(root)
        return J.file_stream(spark, root, files_per_batch=1)

    return go


def at(minute):
    return dt.datetime(2024, 1, 1, 0, 0) + dt.timedelta(minutes=minute)


def test_new_rows_once(spark, frame, land):
    a = frame([(1, at(0)), (2, at(1))], "id int, ts timestamp")
    b = frame([(2, at(1)), (3, at(2)), (3, at(2))], "id int, ts timestamp")
    root = shared_dir(spark, "out")
    out = J.run_to_parquet(J.stream_new_rows(land(a, b), ["id"], "ts", "1 hour"), f"{root}/t", f"{root}/c")
    assert rows(out.select("id")) == [(1,), (2,), (3,)]


def test_upsert_is_order_free(spark, frame, land):
    newer = frame([(1, "new", at(5)), (2, "x", at(1))], "k int, v string, ts timestamp")
    older = frame([(1, "old", at(0)), (3, "y", at(2))], "k int, v string, ts timestamp")
    table = VersionedTable(spark, shared_dir(spark, "t"))
    J.stream_upsert(land(newer, older), table, ["k"], ["ts"], shared_dir(spark, "c"))
    assert rows(table.read().select("k", "v")) == [(1, "new"), (2, "x"), (3, "y")]


def test_burst_and_sessions(spark, frame, land):
    df = frame([(1, at(m)) for m in (0, 4, 8, 40)] + [(2, at(1)), (9, at(500))], "u int, ts timestamp")
    root = shared_dir(spark, "out")
    burst = J.run_to_parquet(J.stream_burst(land(df), ["u"], "ts", "1 minute", "15 minutes", "15 minutes", 3), f"{root}/b", f"{root}/cb")
    assert rows(burst.select("u", "total")) == [(1, 3)]
    sessions = J.run_to_parquet(J.stream_sessions(land(df), "u", "ts", "1 minute", "10 minutes"), f"{root}/s", f"{root}/cs")
    assert rows(sessions.select("u", "events")) == [(1, 1), (1, 3), (2, 1)]


def test_reprocess_rebuilds_touched_days(spark, frame, land):
    first = frame([("d1", 1), ("d2", 5)], "day string, v int")
    late = frame([("d1", 10)], "day string, v int")
    root = shared_dir(spark, "late")
    J.stream_reprocess(land(first, late), lambda r: r.groupBy("day").agg(F.sum("v").alias("v")), f"{root}/h", f"{root}/o", "day", f"{root}/c")
    assert rows(spark.read.parquet(f"{root}/o").select("day", "v")) == [("d1", 11), ("d2", 5)]


def start_sessions(land, parts, delay="60 minutes", idle=None):
    with keyed_state(parts[0].sparkSession):
        root = shared_dir(parts[0].sparkSession, "out")
        out = stream_start_sessions(land(*parts), "u", "ts", "id", F.col("kind") == "start", delay, idle)
        return J.run_to_parquet(out, f"{root}/t", f"{root}/c")


@pytest.mark.parametrize("seed", [1, 2])
def test_start_sessions_equal_the_batch_for_any_split(spark, frame, land, seed):
    r = random.Random(seed)
    ddl = "u string, id bigint, kind string, ts timestamp"
    events = [(r.choice(["a", "a", "b", None]), i, r.choice(["start", "play", "play", "end", None]), at(r.randint(0, 400))) for i in range(150)]
    events += [("late", 900, "play", at(10)), ("late", 901, "start", at(20)), ("late", 902, "start", at(20)), ("late", 903, "start", at(60)), ("never", 910, "play", at(5)), ("x", 920, "start", None)]
    arrival = lambda e: (e[3].hour * 60 + e[3].minute if e[3] else 0) + r.randint(0, 50)
    waves = [[] for _ in range(5)]
    for e in events:
        waves[min(4, arrival(e) // 100)].append(e)
    for w in waves:
        r.shuffle(w)
    waves.append([("tick", 999, "play", at(2000))])
    got = start_sessions(land, [frame(w, ddl) for w in waves if w])
    batch = sessionize(frame([e for e in events if e[3]], ddl), "u", "ts", "id", F.col("kind") == "start").select("u", "session_no", "session_start", "session_end", "events").collect()
    last = {}
    for b in batch:
        last[b["u"]] = max(last.get(b["u"], 0), b["session_no"])
    want = sorted((tuple(b) for b in batch if b["session_no"] < last[b["u"]]), key=repr)  # the last one of a user has no next start
    assert rows(got) == want and len(want) > 10


def test_start_sessions_end_when_idle(spark, frame, land):
    ddl = "u string, id bigint, kind string, ts timestamp"
    one = frame([("a", 1, "start", at(0)), ("a", 2, "play", at(5))], ddl)
    two = frame([("a", 3, "play", at(200)), ("a", 4, "start", at(210)), ("b", 5, "start", at(190))], ddl)
    three = frame([("tick", 6, "play", at(500))], ddl)
    got = start_sessions(land, [one, two, three], "10 minutes", idle=1800)
    assert rows(got.select("u", "session_no", "session_end", "events")) == [("a", 1, at(5), 2), ("a", 2, at(210), 1), ("b", 1, at(190), 1)]


def test_start_sessions_keep_large_and_missing_users_apart_in_one_state(spark, frame, land, monkeypatch):
    monkeypatch.setattr(SE, "BUCKETS", 1)  # one call per batch for all users
    ddl = "u bigint, id bigint, kind string, ts timestamp"
    users = [None, 2**62, 2**62 + 1, -7, 0]
    one = frame([(u, i, "start", at(i)) for i, u in enumerate(users)] + [(2**62, 50, "play", at(30))], ddl)
    two = frame([(u, 100 + i, "start", at(100 + i)) for i, u in enumerate(users)], ddl)
    three = frame([(0, 999, "play", at(900))], ddl)
    got = start_sessions(land, [one, two, three])
    assert got.schema["u"].dataType.simpleString() == "bigint"
    want = [(u, 1, at(i), at(30) if u == 2**62 else at(i), 2 if u == 2**62 else 1) for i, u in enumerate(users)]
    assert rows(got) == sorted(want, key=repr)


def test_history_by_day_stays_small(spark, frame, land):
    root = shared_dir(spark, "late")
    ddl = "day date, v int"
    day = lambda n: dt.date(2024, 1, n)
    waves = [[(day(1), i)] + [(day(2 + i % 3), 100 * i)] + ([(None, 7)] if i == 3 else []) for i in range(14)]
    build = lambda r: r.groupBy("day").agg(F.sum("v").alias("v"), F.count("*").alias("n"))
    J.stream_reprocess(land(*[frame(w, ddl) for w in waves]), build, f"{root}/h", f"{root}/o", "day", f"{root}/c", batches=3)
    every = [x for w in waves for x in w]
    want = {d: (sum(v for e, v in every if e == d), sum(e == d for e, _ in every)) for d in {e for e, _ in every}}
    made = spark.read.parquet(f"{root}/o").select("day", "v", "n")
    assert rows(made) == sorted(((d, *x) for d, x in want.items()), key=repr)
    stored = J.DayHistory(spark, f"{root}/h", "day", 3)
    assert len(stored.paths(["d2024-01-01"])) <= 5  # a base and a few batches, after fourteen
    assert stored.read(["d2024-01-01"], ddl).count() == 14 and stored.read(["none"], ddl).count() == 1


def test_history_survives_repeats_and_broken_compactions(spark, frame):
    stored = J.DayHistory(spark, shared_dir(spark, "days"), "day", batches=1)
    ddl = "day string, v int"
    for number in range(3):
        for _ in range(2):  # the batch is repeated
            assert stored.add(frame([("a/b", number), ("c", 10 * number)], ddl), number) == ["dc", "x612F62"]
    home = f"{stored.root}/__day=dc"
    frame([("c", 99)], ddl).write.parquet(f"{home}/base-1")
    stored._fs.delete(stored._path(f"{home}/base-1/_SUCCESS"), False)  # cut off before its end
    assert rows(stored.read(["dc"], ddl)) == [("c", 0), ("c", 10), ("c", 20)]
    stored.compact(["dc", "x612F62"], ddl, 2)
    assert rows(stored.read(["dc"], ddl)) == [("c", 0), ("c", 10), ("c", 20)]
    assert [p.rsplit("/", 1)[1] for p in stored.paths(["dc"])] == ["base-1", "__batch=2"]
    stored.add(frame([("c", 20)], ddl), 2)
    assert rows(stored.read(["dc"], ddl)) == [("c", 0), ("c", 10), ("c", 20)]
