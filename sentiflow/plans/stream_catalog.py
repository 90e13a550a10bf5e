"""Registered streaming queries: replay the posts derived from ``events`` through
Structured Streaming (file source, ``availableNow``) and return what the sink wrote.

Each call works in a fresh folder under the session's shared checkpoint folder.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentiflow.operators.keywords import keyword_dim
from sentiflow.plans.bundles import stats_bundle_at
from sentiflow.plans.catalog import TRACKED, register
from sentiflow.plans.inputs import posts
from sentiflow.session import scratch_path
from sentiflow.streaming import jobs as SJ
from sentiflow.streaming.derive import refresh_derived
from sentiflow.streaming.sink import PostsLogSink, compact_log, current_posts, current_series, current_snapshots, sink_metrics
from sentiflow.streaming.silence import raised_alerts, silence_stream
from sentiflow.streaming.sources import write_replay_files

REPLAY_FILES = 8
TRIGGER_FILES = 2

# Replay inputs already written in this process: (sf_dir, duplicate_tail, files) -> folder.
_REPLAY_INPUTS: dict[tuple, str] = {}


def _exists(spark: SparkSession, path: str) -> bool:
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()).exists(jpath)


def _replay(
    spark: SparkSession, sf_dir: str, duplicate_tail: str | None = None, files: int = REPLAY_FILES, per_trigger: int = TRIGGER_FILES,
    shuffled: bool = False,
) -> tuple[str, DataFrame]:
    """Replay files of the posts, in time order or (``shuffled``) in the order of a hash, so that rows come late, written once per process and table folder, and a
    fresh run folder for this query's checkpoint and output; returns (run folder, stream)."""
    run = scratch_path(spark, f"sentiflow-runs/{uuid.uuid4().hex}")
    p = posts(spark, sf_dir)
    if duplicate_tail:
        # Re-deliver every post of the newest period once more (identical copies).
        newest = p.select(F.max("processed_at")).scalar()
        p = p.unionByName(p.filter(F.col("processed_at") >= newest - F.expr(f"INTERVAL {duplicate_tail}")))
    key = (sf_dir, duplicate_tail, files, shuffled)
    source = _REPLAY_INPUTS.get(key)
    if source is None or not _exists(spark, f"{source}/_SUCCESS"):
        source = f"{run}/input"
        schema = p.schema
        if shuffled:
            p = p.withColumn("_order", F.xxhash64("tweet_id", "processed_at"))
        write_replay_files(p, source, "_order" if shuffled else "processed_at", files, spark, fmt="parquet", tiebreak="tweet_id")
        p = p.select(*schema.names)
        _REPLAY_INPUTS[key] = source
    stream = spark.readStream.schema(p.schema).option("maxFilesPerTrigger", per_trigger).parquet(source)
    return run, stream


@register("stream_ingest")
def q_stream_ingest(spark, sf_dir):
    """Replay through the log sink, compact the log once it is drained, and read the
    current posts through the compacted base (equals the merged log)."""
    run, stream = _replay(spark, sf_dir)
    q = SJ.run_stream(stream, sink=PostsLogSink(f"{run}/store"), checkpoint=f"{run}/_ckpt_ingest", trigger="available_now")
    q.awaitTermination()
    compact_log(spark, f"{run}/store")
    return current_posts(spark, f"{run}/store")


@register("stream_snapshots")
def q_stream_snapshots(spark, sf_dir):
    run, stream = _replay(spark, sf_dir)
    q = SJ.run_stream(stream, sink=PostsLogSink(f"{run}/store"), checkpoint=f"{run}/_ckpt_ingest", trigger="available_now")
    q.awaitTermination()
    return current_snapshots(spark, f"{run}/store")


@register("stream_refresh")
def q_stream_refresh(spark, sf_dir):
    """The per-minute table that the derived stream keeps, while batches come late and the newest days come twice."""
    run, stream = _replay(spark, sf_dir, duplicate_tail="3 days", shuffled=True)
    q = SJ.run_stream(stream, sink=PostsLogSink(f"{run}/store"), checkpoint=f"{run}/_ckpt_ingest", trigger="available_now")
    q.awaitTermination()
    refresh_derived(spark, f"{run}/store", f"{run}/_ckpt_derived")
    return current_series(spark, f"{run}/store")


@register("stream_dedup")
def q_stream_dedup(spark, sf_dir):
    """The newest three days come twice, and files come out of time order; the log itself has no repeats."""
    run, stream = _replay(spark, sf_dir, duplicate_tail="3 days", shuffled=True)
    SJ.dedup_stream(stream, run, f"{run}/_ckpt_dedup").awaitTermination()
    return SJ.deduplicated(spark, run).select("tweet_id", "processed_at")


def _series(spark, sf_dir) -> str:
    run, stream = _replay(spark, sf_dir, shuffled=True)
    SJ.series_stream(stream, run, f"{run}/_ckpt_series").awaitTermination()
    return run


@register("sliding_window_sentiment")
def q_sliding_window_sentiment(spark, sf_dir):
    return SJ.sliding_window_sentiment(spark, _series(spark, sf_dir), 5)


@register("stream_per_minute")
def q_stream_per_minute(spark, sf_dir):
    return SJ.stream_per_bucket(spark, _series(spark, sf_dir))


STREAM_KEYWORDS = TRACKED + ["purchase k99", "view k42"]


@register("stream_silent_keywords")
def q_stream_silent_keywords(spark, sf_dir):
    run, stream = _replay(spark, sf_dir, shuffled=True)
    SJ.activity_stream(stream, keyword_dim(spark, STREAM_KEYWORDS), run, f"{run}/_ckpt_silence", 3600).awaitTermination()
    return SJ.silent_keyword_stream(spark, run, 3600)


@register("stream_silence_alerts")
def q_stream_silence_alerts(spark, sf_dir):
    """The alerts that the running stream raises by timers and gaps, files in time order."""
    run, stream = _replay(spark, sf_dir)
    query = silence_stream(spark, stream, keyword_dim(spark, STREAM_KEYWORDS), run, f"{run}/_ckpt_alerts", 3600, trigger="available_now")
    query.awaitTermination()
    return raised_alerts(spark, run)


def broken(posts: DataFrame) -> DataFrame:
    """Posts of which some break a constraint, by their own figures."""
    return posts.withColumn("author", F.when(F.col("like_count") % 50 != 0, F.col("author"))).withColumn(
        "sentiment", F.when(F.col("retweet_count") % 40 == 7, F.lit("odd")).otherwise(F.col("sentiment"))
    )


@register("stream_batch_metrics")
def q_stream_batch_metrics(spark, sf_dir):
    """What the sink measured in its writes, over all micro-batches: rows, rejects by reason, lags."""
    run, stream = _replay(spark, sf_dir)
    q = SJ.run_stream(stream, sink=PostsLogSink(f"{run}/store", transform=broken), checkpoint=f"{run}/_ckpt_ingest", trigger="available_now")
    q.awaitTermination()
    sums = ("input_rows", "valid_rows", "null_author", "bad_sentiment", "lag_sum", "lag_rows")
    return sink_metrics(spark, f"{run}/store").agg(
        F.count(F.lit(1)).alias("batches"), *[F.sum(c).alias(c) for c in sums], F.max("lag_max").alias("lag_max"), F.max("newest").alias("newest")
    )


@register("stream_bundle_series")
def q_stream_bundle_series(spark, sf_dir):
    """A member of the statistics bundle as of the last complete batch: the series of the newest three hours."""
    run, stream = _replay(spark, sf_dir)
    q = SJ.run_stream(stream, sink=PostsLogSink(f"{run}/store"), checkpoint=f"{run}/_ckpt_ingest", trigger="available_now")
    q.awaitTermination()
    return stats_bundle_at(spark, f"{run}/store", minutes=180)["timeSeries"]


def written_lexicon(spark: SparkSession, run: str, lexicon: DataFrame) -> DataFrame:
    """The lexicon as a table: a stream joins it in every micro-batch."""
    lexicon.write.parquet(f"{run}/lexicon")
    return spark.read.parquet(f"{run}/lexicon")


@register("stream_ingest_documents")
def q_stream_ingest_documents(spark, sf_dir):
    """The ingest job end to end: every document as a raw JSON message -> decode -> keep
    non-empty English texts -> score (full rules) -> label -> keyed log."""
    from sentiflow.functions.scoring import corpus_lexicon
    from sentiflow.operators.filters import filter_text_lang
    from sentiflow.plans.inputs import table
    from sentiflow.streaming.app import ingest_transform

    docs = table(spark, sf_dir, "documents")
    payload = F.struct(
        F.col("doc_id").cast("string").alias("id"), "text", F.col("source").alias("author"),
        F.col("n_chars").alias("author_followers"), "lang", F.array().cast("array<string>").alias("hashtags"),
        F.lit(0).cast("bigint").alias("retweet_count"), F.lit(0).cast("bigint").alias("like_count"), "source",
    )
    raw = docs.select("doc_id", F.to_json(payload).alias("value"))
    run = scratch_path(spark, f"sentiflow-runs/{uuid.uuid4().hex}")
    key = ("documents", sf_dir)
    source = _REPLAY_INPUTS.get(key)
    if source is None or not _exists(spark, f"{source}/_SUCCESS"):
        source = f"{run}/input"
        write_replay_files(raw, source, "doc_id", REPLAY_FILES, spark, fmt="parquet")
        _REPLAY_INPUTS[key] = source
    stream = spark.readStream.schema(raw.schema).option("maxFilesPerTrigger", TRIGGER_FILES).parquet(source)
    lexicon = written_lexicon(spark, run, corpus_lexicon(filter_text_lang(docs, ["en"])))
    sink = PostsLogSink(f"{run}/store", transform=ingest_transform(spark, lexicon))
    SJ.run_stream(stream, sink=sink, checkpoint=f"{run}/_ckpt", trigger="available_now").awaitTermination()
    return current_posts(spark, f"{run}/store", ("tweet_id", "lang", "compound_score", "sentiment"))
