"""Streaming jobs over the event table, run to completion."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators.aggregates import money
from ..session import shared_dir
from ..sources.keylog import KeyedLog
from ..sources.scans import scan_partitioned
from ..sources.sinks import VersionedTable
from ..streaming import jobs as J
from ..streaming.sessions import keyed_state
from ..streaming.sessions import stream_start_sessions as start_sessions
from .registry import query


def stamped(t):
    """Events with a zoned timestamp, as watermarks need one."""
    return t.events.withColumn("ts", F.col("ts").cast("timestamp"))


def landed(t, *parts, files_per_batch=4):
    """Write the parts one after the other into a landing folder and open it as a stream."""
    root = shared_dir(t.spark, "landing")
    for p in parts:
        p.write.mode("append").parquet(root)
    return J.file_stream(t.spark, root, files_per_batch)


def finish(t, df):
    root = shared_dir(t.spark, "stream")
    return J.run_to_parquet(df, f"{root}/out", f"{root}/checkpoint")


def plain(df, *cols):
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in cols})


@query("""SELECT event_id, user_id, event_type, c_mktsegment AS segment FROM events LEFT JOIN customer ON c_custkey = user_id""")
def stream_new_transactions(t):
    """Purchases and errors arrive twice; the stream keeps one copy and adds the buyer's segment."""
    e = stamped(t).select("event_id", "user_id", "event_type", "ts")
    new = J.stream_new_rows(landed(t, e, e.filter("event_type IN ('purchase', 'error')")), ["event_id"], "ts", "60 days")
    segments = t.customer.select(F.col("c_custkey").alias("user_id"), F.col("c_mktsegment").alias("segment"))
    return finish(t, J.enrich(new, segments, "user_id")).select("event_id", "user_id", "event_type", "segment")


@query("""SELECT event_id, user_id, event_type FROM events""")
def stream_insert_only(t):
    e = t.events.select("event_id", "user_id", "event_type")
    root = shared_dir(t.spark, "insert")
    log = KeyedLog(t.spark, f"{root}/out", ["event_id"])
    J.stream_insert_keyed(landed(t, e.filter("event_type <> 'view'"), e), log, f"{root}/checkpoint")
    return log.read()


@query("""WITH w AS (SELECT user_id, time_bucket(INTERVAL 20 MINUTE, ts) - to_minutes(unnest([0, 20, 40])) AS window_start FROM events)
          SELECT user_id, window_start, window_start + INTERVAL 60 MINUTE AS window_end, count(*) AS total FROM w GROUP BY 1, 2 HAVING count(*) >= 2 AND window_start + INTERVAL 60 MINUTE <= (SELECT max(ts) - INTERVAL 60 MINUTE FROM events)""")
def stream_burst_window(t):
    out = J.stream_burst(landed(t, stamped(t).select("user_id", "ts"), files_per_batch=None), ["user_id"], "ts", "60 minutes", "60 minutes", "20 minutes", 2)
    return plain(finish(t, out), "window_start", "window_end")


@query("""WITH p AS (SELECT user_id, ts, CASE WHEN ts >= lag(ts) OVER w + INTERVAL 6 HOUR OR lag(ts) OVER w IS NULL THEN 1 ELSE 0 END AS fresh FROM events WINDOW w AS (PARTITION BY user_id ORDER BY ts)),
               n AS (SELECT *, sum(fresh) OVER (PARTITION BY user_id ORDER BY ts ROWS UNBOUNDED PRECEDING) AS s FROM p)
          SELECT user_id, min(ts) AS session_start, max(ts) AS last_event, count(*) AS events FROM n GROUP BY user_id, s HAVING max(ts) + INTERVAL 6 HOUR <= (SELECT max(ts) - INTERVAL 60 MINUTE FROM events)""")
def stream_sessions(t):
    out = J.stream_sessions(landed(t, stamped(t).select("user_id", "ts"), files_per_batch=None), "user_id", "ts", "60 minutes", "6 hours")
    return plain(finish(t, out), "session_start", "last_event")


@query("""WITH n AS (SELECT *, sum(CASE WHEN event_type = 'signup' THEN 1 ELSE 0 END) OVER (PARTITION BY user_id ORDER BY ts, event_id ROWS UNBOUNDED PRECEDING) AS s FROM events),
               e AS (SELECT user_id, cast(s AS BIGINT) AS session_no, min(ts) AS session_start, max(ts) AS session_end, count(*) AS events FROM n WHERE s > 0 GROUP BY 1, 2)
          SELECT user_id, session_no, session_start, session_end, events FROM (SELECT *, lead(session_start) OVER (PARTITION BY user_id ORDER BY session_no) AS next FROM e)
          WHERE next <= (SELECT max(ts) - INTERVAL 3 DAY FROM events)""")
def stream_start_sessions(t):
    """Sessions by start event; every file holds events of up to two days before the newest of the file before it."""
    e = stamped(t).select("user_id", "ts", "event_id", "event_type")
    wave = F.floor((F.datediff("ts", F.lit("2024-01-01")) + F.col("event_id") % 3) / 8)
    stream = landed(t, *[e.filter(wave == i).coalesce(1) for i in range(5)], files_per_batch=1)
    with keyed_state(t.spark):
        out = finish(t, start_sessions(stream, "user_id", "ts", "event_id", F.col("event_type") == "signup", "3 days"))
    return plain(out, "session_start", "session_end")


@query("""SELECT user_id, arg_max(event_id, (ts, event_id)) AS event_id, max(ts) AS ts, arg_max(value, (ts, event_id)) AS value FROM events GROUP BY 1""")
def stream_intraday_upsert(t):
    """History and today's rows arrive in any order; the table keeps the newest row of each user."""
    e = t.events.select("user_id", "event_id", "ts", "value")
    table = VersionedTable(t.spark, shared_dir(t.spark, "upsert"), keys=["user_id"], bucket_rows=100)
    J.stream_upsert(landed(t, e.filter("ts >= '2024-01-20'"), e.filter("ts < '2024-01-20'")), table, ["user_id"], ["ts", "event_id"], shared_dir(t.spark, "checkpoint"))
    return table.read()


@query("""SELECT cast(ts AS DATE) AS day, event_type, count(*) AS n, cast(sum(cast(value AS DECIMAL(14,2))) AS DOUBLE) AS total FROM events GROUP BY 1, 2""")
def stream_late_reprocess(t):
    """Late errors reach days that were built before; those days are rebuilt."""
    e = t.events.select("event_id", "event_type", "value", F.to_date("ts").alias("day"))
    root = shared_dir(t.spark, "late")

    def build(rows):
        return rows.groupBy("day", "event_type").agg(F.count("*").alias("n"), F.sum(money("value")).cast("double").alias("total"))

    J.stream_reprocess(landed(t, e.filter("event_type <> 'error'"), e.filter("event_type = 'error'")), build, f"{root}/history", f"{root}/out", "day", f"{root}/checkpoint")
    return scan_partitioned(t.spark, f"{root}/out", {"day": "date"})
