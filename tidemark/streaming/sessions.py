"""Sessions that begin with a start event, over a stream whose events come in any order within the watermark."""

from __future__ import annotations

from collections.abc import Iterator
from contextlib import contextmanager

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

STORE = "spark.sql.streaming.stateStore.providerClass"
ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


@contextmanager
def keyed_state(spark: SparkSession):
    """Queries started inside keep their state in RocksDB, on disk."""
    before = spark.conf.get(STORE, None)
    spark.conf.set(STORE, ROCKS)
    try:
        yield
    finally:
        spark.conf.unset(STORE) if before is None else spark.conf.set(STORE, before)


BUCKETS = 4096  # groups of users by a hash, each with one state, so that a batch costs a call per bucket and not per user
STATE = ("users array<string>, number array<bigint>, first array<bigint>, last array<bigint>, events array<bigint>, live array<boolean>, "
         "at array<bigint>, tie array<bigint>, start array<boolean>, who array<string>")  # open sessions; events that wait


def start_sessions_of(idle: int | None):
    """The step of one bucket: its users' open sessions as five numbers each and the events that the watermark has not passed.

    Events wait until the watermark has passed them, as an earlier one may still come. Then they are taken in order:
    a start closes its user's open session and opens the next, any other event extends the open one or, before the user's
    first start, is dropped. With ``idle`` (microseconds) a session is also closed when the watermark is that far past its
    last event; what follows it before the next start is dropped. The state comes and goes with the rows, once per batch.
    """

    def step(key, frames: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        watermark = state.getCurrentWatermarkMs()
        passed = watermark * 1000
        stored = state.get if state.exists else [[]] * 10
        sessions = {user: numbers for user, *numbers in zip(*stored[:6])}
        waiting = list(zip(*stored[6:]))
        for pdf in frames:
            waiting += zip(pdf["event_us"].tolist(), pdf["event_tie"].tolist(), pdf["is_start"].tolist(), pdf["user"].tolist())
        waiting.sort(key=lambda w: w[:3])
        ready = [w for w in waiting if w[0] <= passed]
        rest = waiting[len(ready) :]
        done = []
        for at, _, start, user in ready:
            number, first, last, events, live = sessions.get(user, (0, 0, 0, 0, False))
            if live and idle is not None and at > last + idle:
                done.append((user, number, first, last, events))
                live = False
            if start:
                if live:
                    done.append((user, number, first, last, events))
                sessions[user] = [number + 1, at, at, 1, True]
            elif number:
                sessions[user] = [number, first, at if live else last, events + live, live]
        wake = [rest[0][0]] if rest else []
        if idle is not None:
            for user, (number, first, last, events, live) in sessions.items():
                if live and passed > last + idle:
                    done.append((user, number, first, last, events))
                    sessions[user] = [number, first, last, events, False]
                elif live:
                    wake.append(last + idle + 1000)
        if sessions or rest:
            state.update((list(sessions), *([n[i] for n in sessions.values()] for i in range(5)), *([w[i] for w in rest] for i in range(4))))
            if wake:  # the first millisecond of the watermark by which it is past; a timeout comes when the watermark is beyond it
                state.setTimeoutTimestamp(max(-(-min(wake) // 1000) - 1, watermark, 1))
        elif state.exists:
            state.remove()
        if done:
            yield pd.DataFrame(done, columns=["user", "session_no", "first_us", "last_us", "events"]).astype({"user": object})

    return step


def stream_start_sessions(stream: DataFrame, user: str, ts: str, tie: str, start: Column, delay: str, idle_seconds: int | None = None) -> DataFrame:
    """Closed sessions ``(user, session_no, session_start, session_end, events)``, numbered per user from 1.

    Equal to the batch ``sessionize`` for any split and order of the files in which no event is later than ``delay``:
    a session is emitted once the watermark has passed the start of the user's next one (or, with ``idle_seconds``, its
    own end by that much). ``ts`` is a zoned timestamp and ``tie`` a whole number that orders equal times. Rows without
    a time are dropped. The query needs ``keyed_state`` around its start. State is one open session per user and the
    events of the last ``delay``, in ``BUCKETS`` groups of users. Users are kept as text, so their type must survive that.
    """
    rows = stream.filter(F.col(ts).isNotNull()).withWatermark(ts, delay).select(
        F.pmod(F.xxhash64(user), F.lit(BUCKETS)).alias("bucket"), F.col(user).cast("string").alias("user"), ts, F.unix_micros(ts).alias("event_us"),
        F.coalesce(F.col(tie).cast("bigint"), F.lit(-(2**63))).alias("event_tie"), F.coalesce(start, F.lit(False)).alias("is_start"))
    idle = None if idle_seconds is None else idle_seconds * 1_000_000
    schema = "user string, session_no bigint, first_us bigint, last_us bigint, events bigint"
    closed = rows.groupBy("bucket").applyInPandasWithState(start_sessions_of(idle), schema, STATE, "append", GroupStateTimeout.EventTimeTimeout)
    return closed.select(F.col("user").cast(stream.schema[user].dataType).alias(user), "session_no", F.timestamp_micros("first_us").alias("session_start"), F.timestamp_micros("last_us").alias("session_end"), "events")
