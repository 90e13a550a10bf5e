"""Structured Streaming jobs (STR-01..07, STR-14).

All stateful jobs append what a micro-batch adds -- keys, partial sums, first and last
times -- under its ``batch_id`` through ``foreachBatch`` and merge the batches on read. No row is
dropped for being late and no window waits to be closed; what is read is what the same batch
query gives over everything delivered so far.
"""

from __future__ import annotations

import contextlib
import threading
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sentiflow.functions.expressions import as_column
from sentiflow.operators.keywords import KeywordMachine, keyword_matches
from sentiflow.operators.merge import finish_series, merge_partials, series_partials
from sentiflow.streaming.levels import fold, read_levels


def run_stream(
    df: DataFrame,
    sink: Callable[[DataFrame, int], None] | None = None,
    checkpoint: str | None = None,
    trigger: str | None = "10 seconds",
    output_mode: str = "append",
    fmt: str | None = None,
    path: str | None = None,
    query_name: str | None = None,
) -> StreamingQuery:
    """Start a streaming query.

    ``trigger``: a processing-time interval (default 10 s), or ``"available_now"``
    to drain what is available and stop (tests, backfills). ``sink`` is a
    ``foreachBatch`` function; otherwise ``fmt``/``path`` name a built-in sink.
    Offsets and state live in ``checkpoint``, so a restart resumes where the
    last committed batch ended.
    """
    w = df.writeStream.outputMode(output_mode)
    if query_name:
        w = w.queryName(query_name)
    if checkpoint:
        w = w.option("checkpointLocation", checkpoint)
    if trigger == "available_now":
        w = w.trigger(availableNow=True)
    elif trigger:
        w = w.trigger(processingTime=trigger)
    if sink is not None:
        w = w.foreachBatch(sink)
    elif fmt:
        w = w.format(fmt)
        if path:
            w = w.option("path", path)
    return w.start()


def stop_gracefully(query: StreamingQuery, timeout_s: float = 30.0) -> bool:
    """Let what is available be processed, for at most ``timeout_s`` seconds, then stop; True if it was done in time.

    A live source may never run dry, so the wait is in a thread of its own; stopping the query ends it.
    """

    def drain() -> None:
        with contextlib.suppress(Exception):  # the query was stopped or failed: query.exception() tells
            query.processAllAvailable()

    waiting = threading.Thread(target=drain, daemon=True)
    waiting.start()
    waiting.join(timeout_s)
    done = not waiting.is_alive()
    query.stop()
    return done


def first_deliveries(df: DataFrame, id_col: str = "tweet_id", ts_col: str = "processed_at") -> DataFrame:
    """The rows of a stream whose id has not come before, once each, in the micro-batch in which they arrive (update mode).

    A streaming aggregation keeps, per id, the first delivery (micro-batch, then time, then a hash of the row) and the newest
    one; an id is new exactly where both are this micro-batch. The state holds every id ever seen, hashed by id in the state
    store, so a repeat goes however late it comes and no late id is lost; a micro-batch looks up its own ids
    only. Rows without an id are never repeats and pass by.
    """
    blank = F.col(id_col).isNull() | (F.col(id_col) == "")
    rest = [c for c in df.columns if c != id_col]
    rows = df.filter(~blank).withColumn("_batch", F.current_timestamp())  # one time a micro-batch, the same in a replay
    order = F.struct("_batch", ts_col, F.xxhash64(*df.columns).alias("_tie"))
    state = rows.groupBy(id_col).agg(
        F.min_by(F.struct(*rest), order).alias("_row"), F.min("_batch").alias("_first"), F.max("_batch").alias("_last")
    )
    new = state.filter(F.col("_first") == F.col("_last"))
    new = new.select(*[F.col(c) if c == id_col else F.col(f"_row.{c}").alias(c) for c in df.columns])
    return new.unionByName(df.filter(blank))


def dedup_stream(df: DataFrame, root: str, checkpoint: str, id_col: str = "tweet_id", ts_col: str = "processed_at", trigger: str | None = "available_now") -> StreamingQuery:
    """Stream each id's first delivery, as it arrives, into the log under ``root/seen``; nothing in it is repeated."""
    from sentiflow.streaming.derive import rocksdb_state
    from sentiflow.streaming.files import make_folder

    make_folder(df.sparkSession, f"{root}/seen")
    with rocksdb_state(df.sparkSession):
        return run_stream(
            first_deliveries(df, id_col, ts_col), sink=BatchLog(f"{root}/seen", lambda batch: batch), checkpoint=checkpoint, trigger=trigger, output_mode="update"
        )


def deduplicated(spark: SparkSession, root: str) -> DataFrame:
    """The log of first deliveries as it is."""
    return spark.read.parquet(f"{root}/seen").drop("batch_id")


def first_per_id(df: DataFrame, id_col: str, order: list[str]) -> DataFrame:
    blank = F.col(id_col).isNull() | (F.col(id_col) == "")
    ranked = F.struct(*order, F.xxhash64(*df.columns).alias("_tie"))
    rest = [c for c in df.columns if c != id_col]
    first = df.filter(~blank).groupBy(id_col).agg(F.min_by(F.struct(*rest), ranked).alias("_r"))
    return first.select(id_col, *[F.col("_r")[c].alias(c) for c in rest]).select(*df.columns).unionByName(df.filter(blank))


class BatchLog:
    """``foreachBatch`` function: what ``summarise`` makes of a micro-batch, appended under its ``batch_id``.

    A replayed batch rewrites its own partition. Nothing waits for a watermark, so late rows and
    open windows are in the log as soon as they arrive; readers merge the batches.
    """

    def __init__(self, path: str, summarise: Callable[[DataFrame], DataFrame]):
        self.path, self.summarise = path, summarise

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        rows = self.summarise(batch).withColumn("batch_id", F.lit(int(batch_id)).cast("bigint"))
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(self.path)


def series_stream(df: DataFrame, root: str, checkpoint: str, unit: str = "minute", trigger: str | None = "available_now") -> StreamingQuery:
    """Stream into mergeable partial sums per (bucket, class); ``stream_per_bucket`` and ``sliding_window_sentiment`` read them."""
    return run_stream(df, sink=BatchLog(f"{root}/partials", lambda batch: series_partials(batch, unit)), checkpoint=checkpoint, trigger=trigger)


PARTIALS_DDL = (
    "bucket timestamp_ntz, sentiment string, tweet_count bigint, score_sum decimal(28,4), score_n bigint, total_retweets bigint, "
    "total_likes bigint, lag_sum decimal(28,6), lag_n bigint"
)
SPANS_DDL = "keyword string, slice bigint, first timestamp_ntz, last timestamp_ntz"


def stored_partials(spark: SparkSession, root: str) -> DataFrame:
    return merge_partials(read_levels(spark, f"{root}/partials", PARTIALS_DDL))


def fold_partials(spark: SparkSession, root: str) -> int:
    """Merge the partial sums of whole groups of micro-batches."""

    def merged(rows: DataFrame) -> DataFrame:
        kinds = {f.name: f.dataType for f in rows.schema}
        return merge_partials(rows).select(*[F.col(c).cast(kinds[c]) for c in rows.columns])

    return fold(spark, f"{root}/partials", PARTIALS_DDL, merged)


def fold_activity(spark: SparkSession, root: str) -> int:
    """Merge the first and last matches of whole groups of micro-batches."""

    def merged(rows: DataFrame) -> DataFrame:
        return rows.groupBy("keyword", "slice").agg(F.min("first").alias("first"), F.max("last").alias("last"))

    return fold(spark, f"{root}/activity", SPANS_DDL, merged)


def stream_per_bucket(spark: SparkSession, root: str) -> DataFrame:
    """Per-bucket x class series of everything streamed so far."""
    return finish_series(stored_partials(spark, root))


def sliding_window_sentiment(spark: SparkSession, root: str, width_minutes: int = 5) -> DataFrame:
    """Sliding windows of ``width_minutes`` every minute per class, from the per-minute partial sums."""
    starts = F.transform(F.sequence(F.lit(0), F.lit(width_minutes - 1)), lambda i: F.col("bucket") - F.make_dt_interval(mins=i))
    spread = stored_partials(spark, root).withColumn("window_start", F.explode(starts)).drop("bucket")
    merged = spread.groupBy("window_start", "sentiment").agg(*[F.sum(c).alias(c) for c in ("tweet_count", "score_sum", "score_n", "total_retweets", "total_likes")])
    series = finish_series(merged.withColumnRenamed("window_start", "bucket"), 4)
    end = F.col("bucket") + F.expr(f"INTERVAL {int(width_minutes)} MINUTES")
    return series.select(
        F.col("bucket").alias("window_start"), end.alias("window_end"), "sentiment", "tweet_count", "avg_compound", end.alias("computed_at")
    )


def activity_stream(
    df: DataFrame, keywords: DataFrame, root: str, checkpoint: str, idle_seconds: int = 60, trigger: str | None = "available_now"
) -> StreamingQuery:
    """Stream into first and last match per (keyword, slice of ``idle_seconds``), and the newest post time of each batch."""

    machine = KeywordMachine(keywords)

    def summarise(batch: DataFrame) -> DataFrame:
        second = F.unix_timestamp(F.col("processed_at").cast("timestamp"))
        matches = keyword_matches(batch, machine).withColumn("slice", F.floor(second / F.lit(int(idle_seconds))).cast("bigint"))
        seen = matches.groupBy("keyword", "slice").agg(F.min("processed_at").alias("first"), F.max("processed_at").alias("last"))
        clock = batch.select(F.lit(None).cast("string").alias("keyword"), F.lit(None).cast("bigint").alias("slice"), "processed_at")
        clock = clock.groupBy("keyword", "slice").agg(F.min("processed_at").alias("first"), F.max("processed_at").alias("last"))
        return seen.unionByName(clock)

    return run_stream(df, sink=BatchLog(f"{root}/activity", summarise), checkpoint=checkpoint, trigger=trigger)


def silent_keyword_stream(spark: SparkSession, root: str, idle_seconds: int = 60, as_of=None) -> DataFrame:
    """``(keyword, last_seen, silent_at)``: one row per silence of at least ``idle_seconds`` between matches, or up to now.

    Gaps that long lie between slices only, so comparing each slice's first match with the slice before is
    exact, and a keyword costs its slices, not its matches. ``as_of`` is the clock for silences that still
    last (the newest post streamed, unless given).
    """
    log = read_levels(spark, f"{root}/activity", SPANS_DDL)
    now = log.agg(F.max("last")).first()[0] if as_of is None else as_of
    slices = log.filter(F.col("keyword").isNotNull()).groupBy("keyword", "slice").agg(F.min("first").alias("first"), F.max("last").alias("last"))
    after = F.coalesce(F.lead("first").over(Window.partitionBy("keyword").orderBy("slice")), as_column(now))
    idle = F.expr(f"INTERVAL {int(idle_seconds)} SECONDS")
    ended = slices.withColumn("after", after).filter(F.col("after") >= F.col("last") + idle)
    return ended.select("keyword", F.col("last").alias("last_seen"), (F.col("last") + idle).alias("silent_at"))
