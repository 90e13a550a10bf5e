"""Silence alerts while a stream runs (STR-07).

Posts are matched by the keywords' automata and reduced in each task to the first and last match of every (keyword,
slice of the idle time); gaps of the idle time lie between slices only, so that is all a keyword's clock needs, and a
keyword in a third of all posts costs its slices. Each keyword has a clock in the state store and a timer at its
last match plus the idle time. A timer that the stream's event time passes raises an alert; so does a gap that long between two
matches of one micro-batch. A silence is told once. A match that comes after its alert changes nothing told, one that comes late but in time
moves the timer; ``delay`` says how long event time waits for late posts.
"""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StreamingQuery

from sentiflow.functions.expressions import as_column
from sentiflow.operators.keywords import KeywordMachine
from sentiflow.streaming.derive import rocksdb_state
from sentiflow.streaming.files import make_folder
from sentiflow.streaming.jobs import BatchLog, run_stream

ALERT_DDL = "keyword string, last_seen bigint, silent_at bigint"
SPAN_DDL = "keyword string, first bigint, last bigint"


class SilenceClock(StatefulProcessor):
    """Per keyword: the last match (microseconds), whether its silence was told, and the timer that is set (milliseconds)."""

    def __init__(self, idle: int):
        self.idle = idle

    def init(self, handle) -> None:
        self.handle = handle
        self.clock = handle.getValueState("clock", "last bigint, told boolean, timer bigint")

    def handleInputRows(self, key, rows, timerValues):  # noqa: N802
        held = self.clock.get() if self.clock.exists() else None
        last, told, timer = held or (None, False, None)
        for row in sorted(rows, key=lambda r: (r.first, r.last)):
            if last is not None and not told and row.first >= last + self.idle:
                yield self._alert(key, last)
            if last is None or row.last > last:
                last, told = row.last, False
        if held is None or last != held[0]:
            if timer is not None:
                self.handle.deleteTimer(timer)
            self._set(last)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo):  # noqa: N802
        last, told, _ = self.clock.get()
        if not told and last + self.idle <= expiredTimerInfo.getExpiryTimeInMs() * 1000:
            self.clock.update((last, True, None))
            yield self._alert(key, last)

    def handleInitialState(self, key, initialState, timerValues) -> None:  # noqa: N802
        self._set(initialState.last)

    def _set(self, last: int) -> None:
        timer = -(-(last + self.idle) // 1000)
        self.clock.update((last, False, timer))
        self.handle.registerTimer(timer)

    def _alert(self, key, last: int) -> Row:
        return Row(keyword=key[0], last_seen=last, silent_at=last + self.idle)

    def close(self) -> None:
        pass


def match_spans(posts: DataFrame, machine: KeywordMachine, idle_seconds: int) -> DataFrame:
    """``(keyword, first, last)`` in microseconds of each task's matches, by slices of the idle time (streaming)."""
    idle = int(idle_seconds) * 1_000_000

    def reduced(batches):
        for batch in batches:
            at = batch.column("at")
            table = pa.table({"keyword": batch.column("keyword"), "at": at, "slice": pa.array(at.to_numpy() // idle)})
            spans = table.group_by(["keyword", "slice"]).aggregate([("at", "min"), ("at", "max")])
            for out in pa.table([spans["keyword"], spans["at_min"], spans["at_max"]], names=["keyword", "first", "last"]).to_batches():
                yield out

    return machine.matches(posts.withColumn("at", F.unix_micros("event_time")), "at").mapInArrow(reduced, SPAN_DDL)


def silence_alerts(
    spark: SparkSession, posts: DataFrame, keywords: DataFrame, idle_seconds: int = 60, delay: str = "0 seconds", connected_at=None
) -> DataFrame:
    """Streaming ``(keyword, last_seen, silent_at)`` alerts of keywords without a match for ``idle_seconds``.

    With ``connected_at`` every keyword's clock starts there, so one that never matches is told too; else a clock
    starts at the first match.
    """
    clocked = posts.withColumn("event_time", F.col("processed_at").cast("timestamp")).withWatermark("event_time", delay)
    spans = match_spans(clocked, KeywordMachine(keywords), idle_seconds).groupBy("keyword")
    seeds = None
    if connected_at is not None:
        start = F.unix_micros(as_column(connected_at).cast("timestamp"))
        seeds = keywords.select("keyword").distinct().select("keyword", start.alias("last")).groupBy("keyword")
    alerts = spans.transformWithState(SilenceClock(int(idle_seconds) * 1_000_000), ALERT_DDL, "Update", "EventTime", initialState=seeds)
    return alerts.select("keyword", *[F.timestamp_micros(c).cast("timestamp_ntz").alias(c) for c in ("last_seen", "silent_at")])


def silence_stream(
    spark: SparkSession, posts: DataFrame, keywords: DataFrame, root: str, checkpoint: str, idle_seconds: int = 60,
    delay: str = "0 seconds", connected_at=None, trigger: str | None = "30 seconds",
) -> StreamingQuery:
    """Start the alert stream; alerts are appended to ``root/alerts`` as they are raised."""
    alerts = silence_alerts(spark, posts, keywords, idle_seconds, delay, connected_at)
    make_folder(spark, f"{root}/alerts")
    with rocksdb_state(spark):
        return run_stream(alerts, sink=BatchLog(f"{root}/alerts", lambda batch: batch), checkpoint=checkpoint, trigger=trigger, output_mode="update")


def raised_alerts(spark: SparkSession, root: str) -> DataFrame:
    """All alerts raised so far."""
    schema = "keyword string, last_seen timestamp_ntz, silent_at timestamp_ntz, batch_id bigint"
    return spark.read.schema(schema).parquet(f"{root}/alerts").drop("batch_id")
