"""Micro-batch sink (SNK-02, STR-12) and merge-on-read views over what it writes.

Layout under ``root``:
  posts_log/batch_id=N/     valid posts of micro-batch N (append-only log of versions)
  manifest/recent-{0,1}.json  newest processed_at of the batches that a snapshot window can still reach (driver-written metadata)
  rejects/batch_id=N/       rows breaking a row-level constraint, with reasons
  metrics/N.json            rows, rejects by reason and lags of micro-batch N
  snapshots/batch_id=N/     rolling window snapshot computed after batch N
  series/, hashtags/batch_id=N/  changes of the derived per-minute and hashtag tables, written by ``derive.derive_stream``

Every write is a dynamic partition overwrite of ``batch_id=N``, so a replayed
micro-batch (after an executor or driver failure) rewrites exactly its own
partition: effectively-once output without a transactional store. Nothing is
collected to the driver; a batch is counted by ``observe`` while its log is written.
"""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentiflow.functions.expressions import ts_literal
from sentiflow.operators.aggregates import rolling_snapshot
from sentiflow.operators.merge import (
    current_from_log,
    snapshot_upsert,
)
from sentiflow.operators.quality import quarantine, row_checks, violated
from sentiflow.schema import CANONICAL_COLUMNS, MUTABLE_COLUMNS
from sentiflow.streaming.derive import current_hashtags, current_series, derived_upto  # noqa: F401  (read with the sink's other tables)
from sentiflow.streaming.files import children, filesystem, path_exists, read_json, read_newest_json, write_partition
from sentiflow.streaming.metrics import write_text


class PostsLogSink:
    """``foreachBatch`` function: quarantine, append the batch to the log, snapshot the window.

    ``transform`` turns a raw micro-batch into canonical posts (decode,
    normalise, score); ``as_of`` picks the batch's clock: ``"max"`` uses the
    batch's newest ``processed_at`` (replay-deterministic), ``"now"`` the
    wall clock (live).
    """

    def __init__(
        self,
        root: str,
        transform: Callable[[DataFrame], DataFrame] | None = None,
        snapshot_width: str = "5 minutes",
        as_of: str = "max",
        snapshot_every: int = 1,
    ):
        self.root = root.rstrip("/")
        self.transform = transform
        self.snapshot_width = snapshot_width
        self.as_of = as_of
        # Refresh cadence of the derived snapshot: every N-th micro-batch (1 = every batch).
        self.snapshot_every = max(int(snapshot_every), 1)
        # batch_id -> newest processed_at of its valid rows, for the batches that can still
        # overlap a snapshot window (read from the manifest after a restart).
        self._recent: dict[int, dt.datetime] | None = None

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        posts = (self.transform(batch_df) if self.transform else batch_df).select(*CANONICAL_COLUMNS)
        # Kept for the second write that a batch with rejects needs.
        # (Lost cached blocks are recomputed from the batch's fixed source offsets.)
        posts = posts.persist()
        try:
            self._write(posts, int(batch_id))
        finally:
            posts.unpersist()

    def _write(self, posts: DataFrame, batch_id: int) -> None:
        spark, bid = posts.sparkSession, F.lit(batch_id).cast("bigint")
        # The batch is measured while the log is written; an empty one writes nothing.
        seen = Observation()
        measured = posts.observe(seen, *batch_metrics(None if self.as_of == "max" else F.current_timestamp().cast("timestamp_ntz")))
        # Row-level constraints only: a key repeated within or across batches is an
        # upsert, resolved by the log's merge-on-read (first immutables, latest mutables).
        valid, _ = quarantine(measured, check_unique=False)
        write_partition(valid.withColumn("batch_id", bid), f"{self.root}/posts_log")
        metrics = seen.get
        rows, newest = metrics["valid_rows"], metrics["newest"]
        if metrics["input_rows"] == 0:
            return
        if metrics["input_rows"] > rows:
            _, rejected = quarantine(posts, check_unique=False)
            write_partition(rejected.withColumn("batch_id", bid), f"{self.root}/rejects")
        entry = {"batch_id": batch_id} | {k: v if k != "newest" else v and v.isoformat(sep=" ") for k, v in metrics.items()}
        write_text(spark, f"{self.root}/metrics/{batch_id}.json", json.dumps(entry))
        recent = self._recent_batches(spark)
        if rows:
            recent[batch_id] = newest
        now = newest if self.as_of == "max" else dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
        _write_recent(spark, f"{self.root}/manifest", batch_id, recent)
        if batch_id % self.snapshot_every or now is None:
            return
        lower = now - _width(self.snapshot_width)
        # Only batches that can hold rows inside the window are read (explicit partition
        # paths: no listing of the whole log); versions inside the window are then merged.
        # Exact while processed_at does not decrease across a post's versions, which holds
        # when it is the processing time.
        needed = sorted(b for b, mx in recent.items() if b <= batch_id and mx is not None and mx >= lower)
        for b in [b for b, mx in recent.items() if mx is not None and mx < lower - _width(self.snapshot_width)]:
            del recent[b]
        clock = ts_literal(now)
        if needed:
            schema = T.StructType([*posts.schema.fields, T.StructField("batch_id", T.LongType())])
            log = spark.read.schema(schema).option("basePath", f"{self.root}/posts_log").parquet(
                *[f"{self.root}/posts_log/batch_id={b}" for b in needed]
            )
            window = log.filter(F.col("processed_at") >= ts_literal(lower))
        else:
            window = posts.limit(0).withColumn("batch_id", bid)
        snap = rolling_snapshot(current_posts_from(window), clock, self.snapshot_width)
        write_partition(snap.withColumn("batch_id", bid), f"{self.root}/snapshots")

    def _recent_batches(self, spark: SparkSession) -> dict[int, dt.datetime]:
        if self._recent is None:
            self._recent = _read_recent(spark, f"{self.root}/manifest")
        return self._recent


def batch_metrics(clock: Column | None = None) -> list[Column]:
    """Aggregates over a micro-batch of canonical posts, for ``DataFrame.observe``: rows, valid rows, rows by broken constraint, the newest
    valid ``processed_at``, and the sum, maximum and number of the lags (creation to processing, in seconds; to ``clock`` if given)."""
    ok = ~violated()
    lag = F.when(ok, F.timestamp_diff("SECOND", F.col("tweet_created_at"), F.col("processed_at") if clock is None else clock))
    return [
        F.count(F.lit(1)).alias("input_rows"),
        F.count_if(ok).alias("valid_rows"),
        *[F.count_if(cond).alias(reason) for cond, reason in row_checks()],
        F.max(F.when(ok, F.col("processed_at"))).alias("newest"),
        F.coalesce(F.sum(lag), F.lit(0)).alias("lag_sum"),
        F.max(lag).alias("lag_max"),
        F.count(lag).alias("lag_rows"),
    ]


def sink_metrics(spark: SparkSession, root: str) -> DataFrame:
    """One row per micro-batch: what ``PostsLogSink`` measured in its write (a batch delivered again replaces its row)."""
    reasons = ", ".join(f"{reason} bigint" for _, reason in row_checks())
    schema = f"batch_id bigint, input_rows bigint, valid_rows bigint, {reasons}, newest timestamp_ntz, lag_sum bigint, lag_max bigint, lag_rows bigint"
    return spark.read.schema(schema).json(f"{root.rstrip('/')}/metrics")


_UNIT_SECONDS = {"second": 1, "minute": 60, "hour": 3600, "day": 86400}


def _width(spec: str) -> dt.timedelta:
    """``'5 minutes'`` -> timedelta (units: seconds, minutes, hours, days)."""
    amount, unit = spec.split()
    return dt.timedelta(seconds=float(amount) * _UNIT_SECONDS[unit.lower().rstrip("s")])


def _write_recent(spark: SparkSession, folder: str, batch_id: int, recent: dict[int, dt.datetime]) -> None:
    """The batches in reach of a window, as one small file: two files take turns, so one of them is always whole."""
    entries = {str(b): t.isoformat(sep=" ") for b, t in recent.items() if t is not None}
    write_text(spark, f"{folder}/recent-{batch_id % 2}.json", json.dumps({"batch_id": batch_id, "newest": entries}))


def _read_recent(spark: SparkSession, folder: str) -> dict[int, dt.datetime]:
    """The entries of the newest whole file; its size does not depend on how many batches there were."""
    best = read_newest_json(spark, [f"{folder}/recent-{i}.json" for i in (0, 1)])
    return {int(b): dt.datetime.fromisoformat(t) for b, t in best.get("newest", {}).items()}


def current_posts_from(log: DataFrame, columns: Sequence[str] = CANONICAL_COLUMNS) -> DataFrame:
    """Merge-on-read of the posts log: first-written immutables, latest mutables per ``tweet_id``; only ``columns`` are moved."""
    return current_from_log(log, "tweet_id", ["batch_id", "processed_at"], MUTABLE_COLUMNS, columns).select(*columns)


def base_versions(spark: SparkSession, root: str) -> list[int]:
    """The compacted bases that are whole (their last merged batch ids), ascending."""
    root = root.rstrip("/")
    names = [n for n in children(spark, f"{root}/base") if n.startswith("upto=")]
    return sorted(int(n.split("=", 1)[1]) for n in names if path_exists(spark, f"{root}/base/{n}/_SUCCESS"))


def base_version(spark: SparkSession, root: str) -> int | None:
    """The newest compacted base (its last merged batch id), or None."""
    versions = base_versions(spark, root)
    return versions[-1] if versions else None


def posts_versions(spark: SparkSession, root: str) -> DataFrame:
    """All versions still needed: the newest compacted base (as batch -1) plus newer log batches."""
    root = root.rstrip("/")
    log = spark.read.parquet(f"{root}/posts_log")
    upto = base_version(spark, root)
    if upto is None:
        return log
    base = spark.read.parquet(f"{root}/base/upto={upto}").withColumn("batch_id", F.lit(-1).cast("bigint"))
    return base.unionByName(log.filter(F.col("batch_id") > F.lit(upto)))


def current_posts(spark: SparkSession, root: str, columns: Sequence[str] = CANONICAL_COLUMNS) -> DataFrame:
    """The current posts table of a sink folder (compacted base plus newer log batches, merged), or ``columns`` of it."""
    return current_posts_from(posts_versions(spark, root), columns)


def complete_version(spark: SparkSession, root: str) -> int | None:
    """The newest batch of which everything is written (its snapshot is written last), or None."""
    found = [int(n.split("=", 1)[1]) for n in children(spark, f"{root.rstrip('/')}/snapshots") if n.startswith("batch_id=")]
    return max(found, default=None)


def posts_as_of(spark: SparkSession, root: str, batch_id: int) -> DataFrame:
    """The current posts after log batch ``batch_id``, whatever came later: the newest base up to it and the batches between."""
    root = root.rstrip("/")
    bases = [b for b in base_versions(spark, root) if b <= batch_id]
    log = spark.read.parquet(f"{root}/posts_log").filter((F.col("batch_id") <= F.lit(batch_id)) & (F.col("batch_id") >= 0))
    if not bases:
        return current_posts_from(log)
    base = spark.read.parquet(f"{root}/base/upto={bases[-1]}").withColumn("batch_id", F.lit(-1).cast("bigint"))
    return current_posts_from(base.unionByName(log.filter(F.col("batch_id") > F.lit(bases[-1]))))


def compact_log(spark: SparkSession, root: str, drop_merged: bool = False) -> int | None:
    """Merge everything up to the newest logged batch into a new base version.

    The merged view is written to a new folder ``base/upto=N`` (nothing read is
    overwritten, and the folder only counts once its ``_SUCCESS`` marker
    exists), so readers and a concurrent stream keep working, and later reads
    merge only the base plus batches after N. Writing the base also cuts the
    lineage of the merge. With ``drop_merged`` the older bases and the log's merged
    batches are deleted afterwards (when no reader that began before still
    needs them). Returns N (None when the log is empty).
    """
    root = root.rstrip("/")
    log = spark.read.parquet(f"{root}/posts_log")
    upto, last = log.agg(F.max("batch_id")).first()[0], base_version(spark, root)
    if upto is None or (last is not None and upto <= last):
        return last
    versions = posts_versions(spark, root).filter(F.col("batch_id") <= F.lit(int(upto)))
    current_posts_from(versions).write.mode("overwrite").parquet(f"{root}/base/upto={int(upto)}")
    if drop_merged:
        for name, keep in (("base", "upto"), ("posts_log", "batch_id")):
            fs, folder = filesystem(spark, f"{root}/{name}")
            for st in fs.listStatus(folder):
                kind, _, number = st.getPath().getName().partition("=")
                if kind == keep and (int(number) < upto if name == "base" else _merged(int(number), int(upto), spark, root)):
                    fs.delete(st.getPath(), True)
    return int(upto)


def _merged(batch_id: int, upto: int, spark: SparkSession, root: str) -> bool:
    """A batch in the base that no snapshot window can reach any more and that the derived tables hold, if they are kept."""
    derived = derived_upto(spark, root)
    return batch_id < upto and (derived is None or batch_id <= derived) and batch_id not in _read_recent(spark, f"{root}/manifest")


def current_snapshots(spark: SparkSession, root: str, upto: int | None = None) -> DataFrame:
    """Snapshot table with the keyed-upsert semantics: latest computation per (window_end, sentiment), of the batches up to ``upto`` if given."""
    snaps = spark.read.parquet(f"{root.rstrip('/')}/snapshots")
    snaps = (snaps if upto is None else snaps.filter(F.col("batch_id") <= F.lit(upto))).drop("batch_id")
    empty = snaps.limit(0)
    return snapshot_upsert(empty, snaps)


def publish_json(df: DataFrame, key_col: str = "id", fmt: str = "kafka", path: str | None = None, **options) -> None:
    """Keyed JSON publish (batch): ``key`` = id string, ``value`` = JSON with non-ASCII kept.

    ``fmt="kafka"`` needs the Kafka connector and options such as
    ``kafka.bootstrap.servers``, ``topic``, ``kafka.acks=all``,
    ``kafka.compression.type=snappy``, ``kafka.linger.ms=20``; any other format
    (``json``, ``text``, ``parquet``) writes the same ``(key, value)`` rows to ``path``.
    """
    from sentiflow.sources.json_codec import encode_json

    out = encode_json(df, key_col)
    writer = out.write.format(fmt).options(**options)
    if fmt == "kafka":
        writer.save()
    else:
        writer.mode("append").save(path)


def publish_json_stream(df: DataFrame, checkpoint: str, key_col: str = "id", fmt: str = "kafka", path: str | None = None, **options):
    """Streaming twin of :func:`publish_json`; returns the started query."""
    from sentiflow.sources.json_codec import encode_json

    w = encode_json(df, key_col).writeStream.format(fmt).option("checkpointLocation", checkpoint).options(**options)
    if path:
        w = w.option("path", path)
    return w.start()


class FeedSink:
    """``foreachBatch`` form of the client poll loop: keep the newest ``cap`` posts.

    Each micro-batch merges its posts into the previous feed (``accumulate_feed``:
    fresh rows first, older rows not re-delivered, newest ``cap`` kept) and writes
    the result as a new version folder ``feed/v=N``. Pointer files name the newest version
    and the one it was made from; versions before that are deleted. Nothing read is overwritten, and
    a replayed batch starts from the same version again. Each batch touches at most ``cap`` old rows and
    three folders, however many batches there were.
    """

    def __init__(self, root: str, cap: int = 200):
        self.root = root.rstrip("/")
        self.cap = cap

    def _pointer(self, spark: SparkSession) -> dict:
        found = [read_json(spark, f"{self.root}/pointer-{i}.json") for i in (0, 1)]
        return max((p for p in found if p), key=lambda p: p["version"], default={"version": None, "previous": None})

    def _previous(self, spark: SparkSession, batch_id: int) -> int | None:
        p = self._pointer(spark)
        return p["version"] if p["version"] is None or p["version"] < batch_id else p["previous"]

    def __call__(self, batch_df: DataFrame, batch_id: int) -> None:
        from sentiflow.operators.topk import RECENT_COLUMNS, accumulate_feed, newest

        spark, batch_id = batch_df.sparkSession, int(batch_id)
        fresh = batch_df.select(*RECENT_COLUMNS)
        prev, before = self._previous(spark, batch_id), self._pointer(spark)
        old = None if prev is None else spark.read.parquet(f"{self.root}/feed/v={prev}")
        merged = newest(fresh, self.cap) if old is None else accumulate_feed(old, fresh, self.cap)
        merged.write.mode("overwrite").parquet(f"{self.root}/feed/v={batch_id}")
        write_text(spark, f"{self.root}/pointer-{batch_id % 2}.json", json.dumps({"version": batch_id, "previous": prev}))
        if before["version"] is not None and before["version"] < batch_id and before["previous"] is not None:
            fs, path = filesystem(spark, f"{self.root}/feed/v={before['previous']}")
            fs.delete(path, True)


def current_feed(spark: SparkSession, root: str) -> DataFrame | None:
    """The newest completed feed version of a ``FeedSink`` folder."""
    version = FeedSink(root)._pointer(spark)["version"]
    return None if version is None else spark.read.parquet(f"{root.rstrip('/')}/feed/v={version}")
