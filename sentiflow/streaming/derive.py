"""Derived tables kept by a stream over the posts log (SNK-06, STR-06).

``derive_stream`` reads the batches that ``PostsLogSink`` appends and keeps one row of state per post, in the state store of
a streaming aggregation: the first version's immutable columns, the last version's mutable ones, and what was last
told to the derived tables about the post. A micro-batch emits the posts whose contribution changed, as (told, new);
the tables get ``new`` added and ``told`` retracted, as partial sums under the micro-batch's ``batch_id``.

What is told is fed back: the sink writes the new contributions to a folder that is the query's second source, so the next
micro-batch starts from them. The engine runs micro-batches one after another, so a post's ``told`` is always what the tables
hold of it. A micro-batch therefore reads the log batches that are new and what the micro-batch before it
told, and never the log's history; fed back folders are deleted once read. Versions that come again, late or in
another order change nothing or exactly what they should, because the state merges by version.

A replayed micro-batch has the same sources and state, and rewrites its own partitions.
The state is kept by RocksDB under the checkpoint, hashed by post, so it may outgrow memory.
"""

from __future__ import annotations

import contextlib
import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from sentiflow.operators.merge import (
    HASHTAG_KEYS,
    SERIES_KEYS,
    finish_hashtags,
    finish_series,
    hashtag_partials,
    merge_partials,
    retracted,
    series_partials,
    version_struct,
)
from sentiflow.operators.rollup import with_levels
from sentiflow.schema import CANONICAL_COLUMNS, MUTABLE_COLUMNS, POSTS_TYPES
from sentiflow.streaming.files import children, delete_path, make_folder, path_exists, read_newest_json, write_partition
from sentiflow.streaming.levels import fold, read_levels
from sentiflow.streaming.metrics import write_text

_STORE = "spark.sql.streaming.stateStore"
#: RocksDB; a commit saves what changed, not the whole store; a write looks up no old row just to count rows.
STATE_CONF = {
    f"{_STORE}.providerClass": "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
    f"{_STORE}.rocksdb.changelogCheckpointing.enabled": "true",
    f"{_STORE}.rocksdb.trackTotalNumberOfRows": "false",
}
#: Columns of a post that the derived tables are made of.
FIRST = ("hashtags", "retweet_count", "like_count", "tweet_created_at")
DERIVED = (("series", series_partials, SERIES_KEYS), ("hashtags", hashtag_partials, HASHTAG_KEYS))
_SUMS = "score_sum decimal(38,4), score_n bigint"
DERIVED_DDL = {
    "series": (
        f"level string, bucket timestamp_ntz, sentiment string, tweet_count bigint, {_SUMS}, total_retweets bigint, total_likes bigint, "
        "lag_sum decimal(38,6), lag_n bigint"
    ),
    "hashtags": f"bucket timestamp_ntz, hashtag string, sentiment string, mention_count bigint, {_SUMS}",
}


@contextlib.contextmanager
def rocksdb_state(spark: SparkSession):
    """Queries started inside the block keep their state in RocksDB."""
    before = {key: spark.conf.get(key, None) for key in STATE_CONF}
    for key, value in STATE_CONF.items():
        spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def changed_posts(log: DataFrame, told: DataFrame, key: str = "tweet_id") -> DataFrame:
    """``(key, told, new, upto)`` of the posts whose contribution to the derived tables changed (streaming, update mode).

    ``log``: versions with ``batch_id``; ``told``: (key, new, told_at) rows as emitted earlier.
    """
    version = version_struct(["batch_id", "processed_at"], [c for c in log.columns if c != key])
    versions = log.select(key, F.struct(*FIRST).alias("first"), F.struct(*MUTABLE_COLUMNS).alias("last"), version.alias("version"), "batch_id")
    rows = versions.unionByName(told, allowMissingColumns=True)
    state = rows.groupBy(key).agg(
        F.min_by("first", "version").alias("first"),
        F.max_by("last", "version").alias("last"),
        F.max_by("new", "told_at").alias("told"),
        F.max("batch_id").alias("upto"),
    )
    new = F.struct(*[F.col(f"first.{c}").alias(c) for c in FIRST], *[F.col(f"last.{c}").alias(c) for c in MUTABLE_COLUMNS])
    # a post of which only the feedback has come has no other contribution than the one told
    return state.select(key, "told", new.alias("new"), "upto").filter(~F.col("new").eqNullSafe(F.col("told")))


class DerivedSink:
    """``foreachBatch`` function: changed contributions -> the feedback, and partial sums of the derived tables."""

    def __init__(self, root: str):
        self.root = root.rstrip("/")

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark, batch_id = batch.sparkSession, int(batch_id)
        # Written once and read back, so the state is gone through once. Where nothing changed there is no partition: an empty
        # file would be new input, and the feedback would go on for ever.
        told = batch.withColumn("told_at", F.lit(batch_id).cast("bigint"))
        told.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("told_at").parquet(f"{self.root}/told")
        mine = f"{self.root}/told/told_at={batch_id}"
        if path_exists(spark, mine):
            rows = spark.read.schema(batch.schema).parquet(mine)
            new, old = rows.select("new.*"), rows.filter(F.col("told").isNotNull()).select("told.*")
            for name, partials, keys in DERIVED:
                change = merge_partials(partials(new), retracted(partials(old), keys), keys=keys, settled=False)
                change = with_levels(change) if name == "series" else change
                write_partition(change.withColumn("batch_id", F.lit(batch_id).cast("bigint")), f"{self.root}/{name}")
            upto = rows.agg(F.max("upto")).first()[0]
            write_text(spark, f"{self.root}/manifest/derived-{batch_id % 2}.json", json.dumps({"batch_id": batch_id, "upto": upto}))
        # This batch reads what the one before it told; older feedback is in the state.
        for name in children(spark, f"{self.root}/told"):
            kind, _, number = name.partition("=")
            if kind == "told_at" and int(number) < batch_id - 1:
                delete_path(spark, f"{self.root}/told/{name}")


def derived_upto(spark: SparkSession, root: str) -> int | None:
    """The newest log batch in the derived tables (None before the first)."""
    return read_newest_json(spark, [f"{root.rstrip('/')}/manifest/derived-{i}.json" for i in (0, 1)]).get("upto")


def derived_partials(spark: SparkSession, root: str, name: str) -> DataFrame:
    """The partial sums of a derived table, all micro-batches merged."""
    return merge_partials(read_levels(spark, f"{root.rstrip('/')}/{name}", DERIVED_DDL[name]), keys=_keys(name))


def _keys(name: str) -> tuple[str, ...]:
    return ("level", *SERIES_KEYS) if name == "series" else HASHTAG_KEYS


def fold_derived(spark: SparkSession, root: str) -> int:
    """Merge the changes of whole groups of micro-batches (``levels.fold``) in both derived tables; run from time to time."""
    return sum(
        fold(spark, f"{root.rstrip('/')}/{name}", DERIVED_DDL[name], lambda rows, name=name: merge_partials(rows, keys=_keys(name), settled=False))
        for name, _, _ in DERIVED
    )


def current_series(spark: SparkSession, root: str) -> DataFrame:
    """The per-minute table kept by ``derive_stream``."""
    return finish_series(time_nodes(spark, root).filter(F.col("level") == "minute"))


def time_nodes(spark: SparkSession, root: str) -> DataFrame:
    """Sums per (minute | hour | day, class) kept by ``derive_stream``, for ``rollup.window_kpis``."""
    return derived_partials(spark, root, "series")


def current_hashtags(spark: SparkSession, root: str, since=None) -> DataFrame:
    """Mentions and average score per hashtag kept by ``derive_stream``, over all minutes or those from ``since`` on."""
    tags = derived_partials(spark, root, "hashtags")
    return finish_hashtags(tags if since is None else tags.filter(F.col("bucket") >= since))


def derive_stream(spark: SparkSession, root: str, checkpoint: str, trigger: str = "10 seconds", per_trigger: int | None = None) -> StreamingQuery:
    """Start the stream that keeps ``current_series`` and ``current_hashtags`` of a sink folder.

    It may run beside the ingest stream or be drained from time to time (``drain``). If the log was compacted before the first
    start, the base is read as the first batch. ``per_trigger`` bounds the log files of a micro-batch.
    """
    from sentiflow.streaming.sink import base_version

    root = root.rstrip("/")
    for folder in ("posts_log", "told", *DERIVED_DDL):
        make_folder(spark, f"{root}/{folder}")
    upto = base_version(spark, root)
    if upto is not None and derived_upto(spark, root) is None:
        base = spark.read.parquet(f"{root}/base/upto={upto}").select(*CANONICAL_COLUMNS)
        write_partition(base.withColumn("batch_id", F.lit(-1).cast("bigint")), f"{root}/posts_log")
    log = spark.readStream.schema(", ".join(f"{c} {POSTS_TYPES[c]}" for c in CANONICAL_COLUMNS) + ", batch_id bigint").option("ignoreMissingFiles", "true")
    log = log.option("maxFilesPerTrigger", per_trigger) if per_trigger else log
    new = ", ".join(f"{c}: {POSTS_TYPES[c]}" for c in (*FIRST, *MUTABLE_COLUMNS))
    told = spark.readStream.schema(f"tweet_id string, new struct<{new}>, told_at bigint")
    changes = changed_posts(log.parquet(f"{root}/posts_log"), told.parquet(f"{root}/told"))
    with rocksdb_state(spark):
        writer = changes.writeStream.outputMode("update").option("checkpointLocation", checkpoint)
        return writer.trigger(processingTime=trigger).foreachBatch(DerivedSink(root)).start()


def drain(query: StreamingQuery) -> None:
    """Process all that is there (feedback included), then stop. Errors of the query are raised."""
    try:
        query.processAllAvailable()
    finally:
        query.stop()


def refresh_derived(spark: SparkSession, root: str, checkpoint: str) -> None:
    """Bring the derived tables up to the newest log batch, then return (a scheduled refresh)."""
    drain(derive_stream(spark, root, checkpoint, trigger="0 seconds"))
