"""Streams in which something ends by itself: claims that expire, hand-outs that nobody answers.

Time is event time, so a rerun over the same files ends the same way. `late_by` is how far behind the newest
row a row may come; what is later is dropped, and nothing expires before the newest row is `late_by` past it.
A source that falls silent should send a tick, a row that only carries a moment: it moves the time on.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from crawlfold.params import CLAIMED, FREE
from crawlfold.streaming.jobs import append

#: Request of a tick. Not NULL, as Spark takes rows out that cannot join before it looks at their time.
TICK = ""
#: Keeps state on disk, which timers need.
_PROVIDER = "spark.sql.streaming.stateStore.providerClass"
_ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
_EVENT = "id string, seq long, ts timestamp, code int"


class _Claims(StatefulProcessor):
    """One row of state per id, its last event in order, and one timer while that is a claim."""

    def __init__(self, ttl: dt.timedelta):
        self.ttl_us = ttl // dt.timedelta(microseconds=1)

    def init(self, handle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "us long, seq long, code int")

    def _due(self, us: int) -> int:
        """First millisecond at which a claim of that moment is older than allowed."""
        return (us + self.ttl_us) // 1000 + 1

    def handleInputRows(self, key, rows, timerValues):
        if key[0] is None:  # a tick
            return
        old = self.last.get() if self.last.exists() else None
        # One id has few events in a batch; of these only the last can hold.
        newest = max(
            (us, seq, code) for part in rows
            for us, seq, code in zip((part["ts"].astype("int64") // 1000 if part["ts"].dtype == "datetime64[ns]" else
                                      part["ts"].astype("datetime64[us]").astype("int64")).tolist(), part["seq"].tolist(), part["code"].tolist()))
        if old is not None and newest <= tuple(old):
            return
        if old is not None and old[2] == CLAIMED:
            self.handle.deleteTimer(self._due(old[0]))
        if newest[2] == CLAIMED:
            self.handle.registerTimer(self._due(newest[0]))
        self.last.update(newest)
        yield self._event(key[0], *newest)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):
        us, seq, code = self.last.get()
        if code == CLAIMED and self._due(us) <= expiredTimerInfo.getExpiryTimeInMs():
            freed = us + self.ttl_us, seq, FREE
            self.last.update(freed)
            yield self._event(key[0], *freed)

    @staticmethod
    def _event(id_: str, us: int, seq: int, code: int) -> pd.DataFrame:
        return pd.DataFrame({"id": [id_], "seq": [seq], "ts": pd.to_datetime([us], unit="us"), "code": [code]})

    def close(self) -> None:
        pass


def expire_claims(claims: DataFrame, out: str, checkpoint: str, ttl: dt.timedelta, late_by: str) -> StreamingQuery:
    """Append to a claim log what holds of a stream of claim events `(id, seq, ts, code)`, and a release for every claim
    that is older than `ttl`, dated when it ran out.

    A crashed worker's claim so ends without a batch job that is told the time. Events of an id follow their
    time, then number; an event behind the last one changes nothing. Rows with a NULL id are ticks.
    """
    timed = claims.select("id", "seq", F.col("ts").cast("timestamp").alias("ts"), "code").withWatermark("ts", late_by)
    events = timed.groupBy("id").transformWithStateInPandas(_Claims(ttl), _EVENT, "Append", "EventTime")
    return _on_disk(claims, lambda: append(events.withColumn("ts", F.col("ts").cast("timestamp_ntz")), out, checkpoint))


def _on_disk(frame: DataFrame, run: Callable[[], StreamingQuery]) -> StreamingQuery:
    """Run a query whose state is on disk; the session keeps its setting for other queries."""
    conf = frame.sparkSession.conf
    before = conf.get(_PROVIDER, None)
    conf.set(_PROVIDER, _ROCKS)
    try:
        return run()
    finally:
        conf.set(_PROVIDER, before) if before else conf.unset(_PROVIDER)


def unanswered(handouts: DataFrame, outcomes: DataFrame, timeout: str) -> DataFrame:
    """Hand-outs `(request, key, id, ts)` without an outcome `(request, at)` within `timeout`: request, key, id and the
    moment `ts` they ran out.

    For batches and, with watermarks on `ts` and `at`, for streams: a stream-stream outer join that lets go of a
    hand-out once no outcome in time can come any more. An outcome after the timeout does not count.
    """
    due = F.col("h.ts") + F.expr(f"interval '{timeout}'")
    met = (F.col("h.request") == F.col("o.request")) & (F.col("o.at") >= F.col("h.ts")) & (F.col("o.at") <= due)
    joined = handouts.alias("h").join(outcomes.alias("o"), met, "left_outer")
    return joined.filter(F.col("o.request").isNull()).select("h.request", "h.key", "h.id", due.alias("ts"))


def release_unanswered(handouts: DataFrame, outcomes: DataFrame, out: str, checkpoint: str, timeout: str, late_by: str) -> StreamingQuery:
    """Append the unanswered hand-outs of two streams. Rows whose request is `TICK` only move the time on."""
    def timed(rows: DataFrame, at: str) -> DataFrame:
        return rows.withColumn(at, F.col(at).cast("timestamp")).withWatermark(at, late_by)

    ended = unanswered(timed(handouts, "ts"), timed(outcomes, "at"), timeout)
    return append(ended.withColumn("ts", F.col("ts").cast("timestamp_ntz")), out, checkpoint)


def as_outcomes(ended: DataFrame, seq: str = "unix_micros(cast(ts as timestamp))") -> DataFrame:
    """Outcomes of kind `timeout` for the members whose hand-outs nobody answered: they are no longer in use."""
    return ended.filter(F.col("request") != TICK).select("key", F.expr(seq).alias("seq"), "ts", F.lit("timeout").alias("kind"))


def as_releases(ended: DataFrame) -> DataFrame:
    """Claim events that free the shops of unanswered hand-outs, so that they are handed out again."""
    moment = F.unix_micros(F.col("ts").cast("timestamp"))
    return ended.filter((F.col("request") != TICK) & F.col("id").isNotNull()).select(
        "id", moment.alias("seq"), "ts", F.lit(FREE).alias("code"))
