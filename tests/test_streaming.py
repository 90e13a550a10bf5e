import pathlib
import tempfile

from pyspark.sql import functions as F

from conftest import SF_SMALL
from sentiflow.plans.inputs import posts as load_posts
from sentiflow.streaming import jobs as SJ
from sentiflow.streaming.sink import PostsLogSink, current_posts
from sentiflow.streaming.sources import write_replay_files


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_replayed_batch_is_idempotent(spark):
    root = tempfile.mkdtemp(prefix="sentiflow-test-")
    p = load_posts(spark, SF_SMALL)
    half = p.filter(F.col("processed_at") < F.lit("2024-01-15").cast("timestamp_ntz"))
    sink = PostsLogSink(root)
    sink(half, 0)
    sink(p, 1)
    first = _rows(current_posts(spark, root))
    sink(p, 1)  # the same micro-batch delivered again after a failure
    assert _rows(current_posts(spark, root)) == first
    assert first == _rows(p)


def test_restart_from_checkpoint_exactly_once(spark):
    run = tempfile.mkdtemp(prefix="sentiflow-test-")
    p = load_posts(spark, SF_SMALL)
    early = p.filter(F.col("processed_at") < F.lit("2024-01-15").cast("timestamp_ntz"))
    late = p.filter(F.col("processed_at") >= F.lit("2024-01-15").cast("timestamp_ntz"))
    write_replay_files(early, f"{run}/in/a", "processed_at", 2, spark, fmt="parquet")
    stream = spark.readStream.schema(p.schema).option("maxFilesPerTrigger", 1).parquet(f"{run}/in/*")
    sink = PostsLogSink(f"{run}/store")
    SJ.run_stream(stream, sink=sink, checkpoint=f"{run}/ckpt", trigger="available_now").awaitTermination()
    assert current_posts(spark, f"{run}/store").count() == early.count()
    write_replay_files(late, f"{run}/in/b", "processed_at", 2, spark, fmt="parquet")
    SJ.run_stream(stream, sink=sink, checkpoint=f"{run}/ckpt", trigger="available_now").awaitTermination()
    assert _rows(current_posts(spark, f"{run}/store")) == _rows(p)


def test_dedup_keeps_blank_ids(spark):
    run = tempfile.mkdtemp(prefix="sentiflow-test-")
    df = spark.createDataFrame(
        [("a", "2024-01-01 00:00:00"), ("a", "2024-01-01 00:00:01"), ("", "2024-01-01 00:00:02"), ("", "2024-01-01 00:00:02"), (None, "2024-01-01 00:00:03")],
        "tweet_id string, ts string",
    ).select("tweet_id", F.col("ts").cast("timestamp_ntz").alias("processed_at"))
    df.write.parquet(f"{run}/in")
    stream = spark.readStream.schema(df.schema).parquet(f"{run}/in")
    SJ.dedup_stream(stream, run, f"{run}/ckpt").awaitTermination()
    out = SJ.deduplicated(spark, run).collect()
    assert sorted("<null>" if r["tweet_id"] is None else r["tweet_id"] for r in out) == ["", "", "<null>", "a"]


def _feed(spark, run, batches, start):
    """Deliver batches one by one to a stream that is started anew each time (same checkpoint)."""
    from conftest import make_posts

    schema = make_posts(spark, batches[0]).schema
    for rows in batches:
        make_posts(spark, rows).coalesce(1).write.mode("append").parquet(f"{run}/in")
        start(spark.readStream.schema(schema).parquet(f"{run}/in")).awaitTermination()


def test_dedup_keeps_late_ids(spark):
    """An id never seen before is kept however late it comes; a repeat goes however late it comes."""
    import datetime as dt

    run = tempfile.mkdtemp(prefix="sentiflow-test-")
    t0 = dt.datetime(2024, 1, 1, 12)
    batches = [
        [dict(tweet_id="a", processed_at=t0), dict(tweet_id="a", processed_at=t0 + dt.timedelta(minutes=1))],
        [dict(tweet_id="late", processed_at=t0 - dt.timedelta(minutes=90)), dict(tweet_id="a", processed_at=t0 + dt.timedelta(days=2))],
    ]
    _feed(spark, run, batches, lambda s: SJ.dedup_stream(s, run, f"{run}/ckpt"))
    got = sorted((r["tweet_id"], r["processed_at"]) for r in SJ.deduplicated(spark, run).collect())
    assert got == [("a", t0), ("late", t0 - dt.timedelta(minutes=90))]


def test_dedup_emits_on_arrival_and_once_after_a_failure(spark):
    """Each micro-batch's partition holds its new ids; a batch that fails after its write is run again and repeats nothing."""
    import pytest

    run, failing = tempfile.mkdtemp(prefix="sentiflow-test-"), []
    batches = [[dict(tweet_id=i) for i in ids] for ids in ("ab", "bc", "cab", "da")]
    whole = SJ.BatchLog.__call__

    def breaks(self, batch, batch_id):
        whole(self, batch, batch_id)
        if batch_id == 1 and not failing:
            failing.append(batch_id)
            raise RuntimeError("lost after the write")

    SJ.BatchLog.__call__ = breaks
    try:
        _feed(spark, run, batches[:1], lambda s: SJ.dedup_stream(s, run, f"{run}/ckpt"))
        with pytest.raises(Exception, match="lost after the write"):
            _feed(spark, run, batches[1:2], lambda s: SJ.dedup_stream(s, run, f"{run}/ckpt"))
        _feed(spark, run, batches[2:], lambda s: SJ.dedup_stream(s, run, f"{run}/ckpt"))
    finally:
        SJ.BatchLog.__call__ = whole
    got = sorted((r["tweet_id"], r["batch_id"]) for r in spark.read.parquet(f"{run}/seen").collect())
    assert failing and [g[0] for g in got] == list("abcd")
    assert [g[1] for g in got[:3]] == [0, 0, 1]


def test_series_streams_hold_late_and_open_windows(spark):
    import datetime as dt

    from conftest import make_posts
    from sentiflow.operators.aggregates import per_bucket_series
    from sentiflow.operators.windows import snapshot_series

    run = tempfile.mkdtemp(prefix="sentiflow-test-")
    t0 = dt.datetime(2024, 1, 1, 12, 30, 20)
    batches = [
        [dict(tweet_id="a", processed_at=t0, compound_score=0.5, sentiment="positive")],
        [dict(tweet_id="b", processed_at=t0 - dt.timedelta(hours=2), compound_score=-0.5, sentiment="negative"),
         dict(tweet_id="c", processed_at=t0 + dt.timedelta(seconds=5), compound_score=0.7, sentiment="positive")],
    ]
    _feed(spark, run, batches, lambda s: SJ.series_stream(s, run, f"{run}/ckpt"))
    everything = make_posts(spark, [r for b in batches for r in b])
    assert _rows(SJ.stream_per_bucket(spark, run)) == _rows(per_bucket_series(everything, "minute"))
    assert _rows(SJ.sliding_window_sentiment(spark, run)) == _rows(snapshot_series(everything, "5 minutes", "1 minute"))


def test_silent_keyword_stream(spark):
    """Every silence counts: inside a micro-batch, between batches, and one that late rows close again."""
    import datetime as dt

    from sentiflow.operators.keywords import keyword_dim

    run = tempfile.mkdtemp(prefix="sentiflow-test-")
    t0 = dt.datetime(2024, 1, 1, 0, 0, 0)
    h = dt.timedelta(hours=1)
    batches = [
        [dict(tweet_id="a1", text="alpha one", processed_at=t0), dict(tweet_id="b1", text="beta", processed_at=t0 + h / 6)],
        [dict(tweet_id="b2", text="beta", processed_at=t0 + 3 * h), dict(tweet_id="b3", text="beta", processed_at=t0 + 6 * h)],
        [dict(tweet_id=f"late{i}", text="beta", processed_at=t0 + 3 * h + i * h / 2) for i in range(1, 6)],
    ]
    kw = keyword_dim(spark, ["alpha", "beta"])
    _feed(spark, run, batches, lambda s: SJ.activity_stream(s, kw, run, f"{run}/ckpt", 3600))
    got = sorted(tuple(r) for r in SJ.silent_keyword_stream(spark, run, 3600).collect())
    assert got == [("alpha", t0, t0 + h), ("beta", t0 + h / 6, t0 + h / 6 + h)]
    later = sorted(tuple(r) for r in SJ.silent_keyword_stream(spark, run, 3600, as_of=t0 + 9 * h).collect())
    assert later == [*got, ("beta", t0 + 6 * h, t0 + 7 * h)]


def test_sink_merges_repeated_keys(spark):
    """A key delivered twice in one micro-batch and again later is an upsert, not a reject."""
    import datetime as dt

    from conftest import AS_OF, make_posts

    root = tempfile.mkdtemp(prefix="sentiflow-test-")
    h = dt.timedelta(hours=1)
    sink = PostsLogSink(root)
    sink(make_posts(spark, [dict(tweet_id="k", text="first", compound_score=0.5, sentiment="positive", processed_at=AS_OF),
                            dict(tweet_id="k", text="second", compound_score=-0.5, sentiment="negative", processed_at=AS_OF + h),
                            dict(tweet_id="bad", author=None)]), 0)
    sink(make_posts(spark, [dict(tweet_id="k", text="third", compound_score=0.0, sentiment="neutral", processed_at=AS_OF + 2 * h)]), 1)
    (r,) = current_posts(spark, root).collect()
    assert (r["text"], r["compound_score"], r["processed_at"]) == ("first", 0.0, AS_OF + 2 * h)
    rejects = spark.read.parquet(f"{root}/rejects").collect()
    assert [(x["tweet_id"], list(x["reasons"])) for x in rejects] == [("bad", ["null_author"])]


def test_processing_time_trigger_and_graceful_stop(spark):
    run = tempfile.mkdtemp(prefix="sentiflow-test-")
    p = load_posts(spark, SF_SMALL)
    p.write.parquet(f"{run}/in")
    stream = spark.readStream.schema(p.schema).parquet(f"{run}/in")
    q = SJ.run_stream(stream.select("tweet_id"), checkpoint=f"{run}/ckpt", trigger="1 second", fmt="parquet", path=f"{run}/out")
    assert q.isActive
    SJ.stop_gracefully(q)
    assert not q.isActive
    assert spark.read.parquet(f"{run}/out").count() == p.count()


def test_compaction_keeps_current_view(spark):
    import datetime as dt

    from conftest import AS_OF, make_posts
    from sentiflow.streaming.sink import compact_log

    h = dt.timedelta(hours=1)
    batches = [
        [dict(tweet_id="a", text="a0", compound_score=0.5, sentiment="positive", processed_at=AS_OF), dict(tweet_id="b", text="b0")],
        [dict(tweet_id="a", text="a1", compound_score=-0.5, sentiment="negative", processed_at=AS_OF + h)],
        [dict(tweet_id="a", text="a2", compound_score=0.0, sentiment="neutral", processed_at=AS_OF + 2 * h), dict(tweet_id="c", text="c0")],
    ]
    plain, compacted = tempfile.mkdtemp(prefix="sentiflow-test-"), tempfile.mkdtemp(prefix="sentiflow-test-")
    for i, rows in enumerate(batches):
        PostsLogSink(plain)(make_posts(spark, rows), i)
        PostsLogSink(compacted)(make_posts(spark, rows), i)
        if i == 1:
            assert compact_log(spark, compacted) == 1
    assert _rows(current_posts(spark, compacted)) == _rows(current_posts(spark, plain))
    assert compact_log(spark, compacted) == 2
    assert _rows(current_posts(spark, compacted)) == _rows(current_posts(spark, plain))


def test_start_ingest_from_json_files(spark):
    import json

    from sentiflow.streaming.app import start_ingest

    run = tempfile.mkdtemp(prefix="sentiflow-test-")
    msgs = [
        {"id": "1", "text": "good great day", "author": "a", "lang": "en", "hashtags": ["x"]},
        {"id": "2", "text": "awful", "author": "b", "lang": "en"},
        {"id": "3", "text": "", "author": "c", "lang": "en"},
        {"id": "4", "text": "bueno", "author": "d", "lang": "es"},
        {"id": "5", "text": "bad", "author": None, "lang": "en"},
    ]
    spark.createDataFrame([(json.dumps(m),) for m in msgs], "value string").coalesce(1).write.json(f"{run}/in")
    lex = spark.createDataFrame([("good", 1.9), ("great", 3.1), ("awful", -3.4), ("bad", -2.5)], "token string, valence double")
    raw = spark.readStream.schema("value string").json(f"{run}/in")
    q = start_ingest(spark, raw, lex, f"{run}/out", f"{run}/ckpt", trigger="1 second")
    SJ.stop_gracefully(q)
    got = {r["tweet_id"]: r["sentiment"] for r in current_posts(spark, f"{run}/out").collect()}
    assert got == {"1": "positive", "2": "negative"}
    rejects = spark.read.parquet(f"{run}/out/rejects").collect()
    assert [(r["tweet_id"], list(r["reasons"])) for r in rejects] == [("5", ["null_author"])]


def test_snapshots_match_full_log_recompute(spark):
    """Window-bounded snapshot reads (manifest + explicit partitions) equal a brute-force
    recomputation over the whole log, also after the sink restarts."""
    from sentiflow.operators.aggregates import rolling_snapshot
    from sentiflow.functions.expressions import ts_literal
    from sentiflow.streaming.sink import current_posts_from

    root = tempfile.mkdtemp(prefix="sentiflow-test-")
    p = load_posts(spark, SF_SMALL)
    cuts = ["2024-01-05", "2024-01-12", "2024-01-20", "2024-01-26", "2024-02-01"]
    batches = []
    lo = "2023-12-01"
    for hi in cuts:
        batches.append(p.filter((F.col("processed_at") >= F.lit(lo).cast("timestamp_ntz")) & (F.col("processed_at") < F.lit(hi).cast("timestamp_ntz"))))
        lo = hi
    # A 10-day window spans earlier batches, also right after the restart.
    sink = PostsLogSink(root, snapshot_width="10 days")
    for i, b in enumerate(batches):
        if i == 3:
            sink = PostsLogSink(root, snapshot_width="10 days")  # restart: recent batches come from the manifest
        sink(b, i)
    log = spark.read.parquet(f"{root}/posts_log")
    got = spark.read.parquet(f"{root}/snapshots")
    for i, b in enumerate(batches):
        clock = b.agg(F.max("processed_at")).first()[0]
        upto = log.filter(F.col("batch_id") <= i)
        expected = rolling_snapshot(current_posts_from(upto), ts_literal(clock), "10 days")
        mine = got.filter(F.col("batch_id") == i).drop("batch_id")
        assert sorted(tuple(r) for r in mine.collect()) == sorted(tuple(r) for r in expected.collect()), i


def test_feed_sink_keeps_newest(spark):
    """Poll-delta loop as a stream: after all batches the feed is the newest 200 posts overall."""
    from sentiflow.operators.topk import recent_posts
    from sentiflow.streaming.sink import FeedSink, current_feed

    run = tempfile.mkdtemp(prefix="sentiflow-test-")
    p = load_posts(spark, SF_SMALL)
    write_replay_files(p, f"{run}/in", "processed_at", 4, spark, fmt="parquet", tiebreak="tweet_id")
    stream = spark.readStream.schema(p.schema).option("maxFilesPerTrigger", 1).parquet(f"{run}/in")
    SJ.run_stream(stream, sink=FeedSink(f"{run}/out", cap=200), checkpoint=f"{run}/ckpt", trigger="available_now").awaitTermination()
    assert _rows(current_feed(spark, f"{run}/out")) == _rows(recent_posts(p, 200))
    assert sorted(x.name for x in pathlib.Path(f"{run}/out/feed").iterdir()) == ["v=2", "v=3"]  # older versions are gone
    FeedSink(f"{run}/out", cap=200)(p.filter(F.lit(False)), 3)  # a replay starts from version 2 again
    assert current_feed(spark, f"{run}/out").count() <= 200


def _derived_equal_recompute(spark, root):
    from sentiflow.operators import merge as M
    from sentiflow.streaming.sink import current_hashtags, current_series

    now = current_posts(spark, root)
    assert _rows(current_series(spark, root)) == _rows(M.finish_series(M.series_partials(now)))
    assert _rows(current_hashtags(spark, root)) == _rows(M.finish_hashtags(M.hashtag_partials(now)))


def _rescored(h):
    from conftest import AS_OF

    return [
        [dict(tweet_id=f"p{i}", hashtags=["a", f"t{i % 3}"], compound_score=0.1 * i, sentiment="positive", processed_at=AS_OF + i * h) for i in range(6)],
        [dict(tweet_id=f"p{i}", hashtags=["b"], compound_score=-0.5, sentiment="negative", processed_at=AS_OF + 9 * h) for i in (1, 4, 7)],
        [dict(tweet_id="p1", compound_score=0.0, sentiment="neutral", processed_at=AS_OF), dict(tweet_id="p8", hashtags=["t1"])],
        [dict(tweet_id="p2", compound_score=0.9, sentiment="positive", processed_at=AS_OF + 2 * h), dict(tweet_id="p3", compound_score=0.3, sentiment="positive", processed_at=AS_OF + 3 * h)],
    ]


def test_derived_stream_equals_recompute(spark):
    """After re-scored posts (also inside their bucket), a replayed batch, a restart and a compaction."""
    import datetime as dt

    from conftest import make_posts
    from sentiflow.streaming.derive import refresh_derived
    from sentiflow.streaming.sink import compact_log

    root = tempfile.mkdtemp(prefix="sentiflow-test-")
    for i, rows in enumerate(_rescored(dt.timedelta(minutes=7))):
        PostsLogSink(root)(make_posts(spark, rows), i)
        if i == 1:
            PostsLogSink(root)(make_posts(spark, rows), i)  # delivered again
        refresh_derived(spark, root, f"{root}/ckpt")
        if i == 1:
            PostsLogSink(root)(make_posts(spark, rows), i)  # delivered again after it was read
            compact_log(spark, root, drop_merged=True)
        _derived_equal_recompute(spark, root)
    assert len(list(pathlib.Path(f"{root}/manifest").glob("recent-*.json"))) == 2


def test_derived_stream_reads_several_batches_at_once(spark):
    """Versions of one post in several log batches of a micro-batch, and a start after the log was compacted away."""
    import datetime as dt

    from conftest import make_posts
    from sentiflow.streaming.derive import refresh_derived
    from sentiflow.streaming.sink import compact_log

    root = tempfile.mkdtemp(prefix="sentiflow-test-")
    batches = _rescored(dt.timedelta(minutes=7))
    for i, rows in enumerate(batches[:3]):
        PostsLogSink(root, snapshot_width="1 second")(make_posts(spark, rows), i)
    compact_log(spark, root, drop_merged=True)
    refresh_derived(spark, root, f"{root}/ckpt")
    _derived_equal_recompute(spark, root)
    for i in (3, 4, 5):
        PostsLogSink(root)(make_posts(spark, batches[i - 3]), i)
    refresh_derived(spark, root, f"{root}/ckpt")
    _derived_equal_recompute(spark, root)


def test_derived_replay_after_failure(spark):
    """A micro-batch that fails after its writes is run again: nothing is counted twice."""
    import datetime as dt

    import pytest
    from conftest import make_posts
    from sentiflow.streaming import derive

    root, failing = tempfile.mkdtemp(prefix="sentiflow-test-"), []
    batches = _rescored(dt.timedelta(minutes=7))
    whole = derive.DerivedSink.__call__

    def breaks(self, batch, batch_id):
        whole(self, batch, batch_id)
        if batch_id == 2 and not failing:
            failing.append(batch_id)
            raise RuntimeError("lost after the write")

    derive.DerivedSink.__call__ = breaks
    try:
        for i, rows in enumerate(batches):
            PostsLogSink(root)(make_posts(spark, rows), i)
            if i == 1:
                with pytest.raises(Exception, match="lost after the write"):
                    derive.refresh_derived(spark, root, f"{root}/ckpt")
            derive.refresh_derived(spark, root, f"{root}/ckpt")
            _derived_equal_recompute(spark, root)
    finally:
        derive.DerivedSink.__call__ = whole
    assert failing


def test_derived_batch_cost_does_not_grow(spark):
    """Rows read by a micro-batch are its own and those told before it, however long the log is."""
    from conftest import make_posts
    from sentiflow.streaming.derive import derive_stream, drain

    root, read, left = tempfile.mkdtemp(prefix="sentiflow-test-"), [], []
    for i in range(4):
        PostsLogSink(root)(make_posts(spark, [dict(tweet_id=f"b{i}-{j}") for j in range(20)] + [dict(tweet_id="again", compound_score=i / 10)]), i)
        query = derive_stream(spark, root, f"{root}/ckpt", trigger="0 seconds")
        drain(query)
        read.append(sum(p["numInputRows"] for p in query.recentProgress))
        left.append(len(list(pathlib.Path(f"{root}/told").glob("told_at=*"))))
    assert read[0] == 42 and set(read[1:]) == {42}  # 21 posts of the log and 21 told
    assert max(left) <= 2
    _derived_equal_recompute(spark, root)


def test_batch_metrics_come_from_the_write(spark):
    """Rows, rejects by reason and lags of a batch are measured in its write; a batch costs few jobs, an empty one writes nothing."""
    import datetime as dt

    from conftest import AS_OF, make_posts
    from sentiflow.streaming.sink import sink_metrics

    root, jobs = tempfile.mkdtemp(prefix="sentiflow-test-"), []
    made = AS_OF - dt.timedelta(seconds=30)
    batches = [
        [dict(tweet_id="a", tweet_created_at=made, processed_at=AS_OF), dict(tweet_id="b", tweet_created_at=None), dict(tweet_id="c", author=None)],
        [],
        [dict(tweet_id="a", tweet_created_at=made, processed_at=AS_OF + dt.timedelta(seconds=60)), dict(tweet_id="d", sentiment="odd"), dict(tweet_id=None)],
        [dict(tweet_id="e")],
    ]
    tracker = spark.sparkContext.statusTracker()
    for i, rows in enumerate(batches):
        df = make_posts(spark, rows or [dict(tweet_id="x")]).limit(len(rows))
        spark.sparkContext.setJobGroup(f"sink-{root}-{i}", "batch")
        PostsLogSink(root)(df, i)
        jobs.append(len(tracker.getJobIdsForGroup(f"sink-{root}-{i}")))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    got = {r["batch_id"]: r for r in sink_metrics(spark, root).collect()}
    assert sorted(got) == [0, 2, 3]
    assert (got[0]["input_rows"], got[0]["valid_rows"], got[0]["null_author"]) == (3, 2, 1)
    assert (got[0]["lag_sum"], got[0]["lag_max"], got[0]["lag_rows"]) == (30, 30, 1)
    assert (got[2]["valid_rows"], got[2]["bad_sentiment"], got[2]["null_tweet_id"], got[2]["lag_sum"]) == (1, 1, 1, 90)
    assert got[2]["newest"] == AS_OF + dt.timedelta(seconds=60)
    assert max(jobs) <= 8 and jobs[1] <= 2, jobs


def test_silence_alerts_by_timer_and_gap(spark):
    """Alerts equal the silences at each clock: inside a batch, between batches, by timer alone, and of a keyword that never comes."""
    import datetime as dt

    from sentiflow.operators.keywords import keyword_dim
    from sentiflow.streaming.silence import raised_alerts, silence_stream

    run = tempfile.mkdtemp(prefix="sentiflow-test-")
    t0, h = dt.datetime(2024, 1, 1, 0, 0, 0), dt.timedelta(hours=1)
    batches = [
        [dict(tweet_id="a1", text="alpha one", processed_at=t0), dict(tweet_id="b1", text="beta", processed_at=t0 + h / 6)],
        [dict(tweet_id="b2", text="beta", processed_at=t0 + 3 * h), dict(tweet_id="b3", text="BETA too", processed_at=t0 + 6 * h)],
        [dict(tweet_id="c", text="nothing", processed_at=t0 + 6.5 * h), dict(tweet_id="b4", text="x", hashtags=["Beta"], processed_at=t0 + 6.6 * h)],
        [dict(tweet_id="d", text="nothing", processed_at=t0 + 9 * h)],
    ]
    kw, seen = keyword_dim(spark, ["alpha", "#beta", "never"]), []

    def start(stream):
        return silence_stream(spark, stream, kw, run, f"{run}/ckpt", 3600, connected_at=t0 - h / 2, trigger="available_now")

    from conftest import make_posts

    schema = make_posts(spark, batches[0]).schema
    for rows in batches:
        make_posts(spark, rows).coalesce(1).write.mode("append").parquet(f"{run}/in")
        start(spark.readStream.schema(schema).parquet(f"{run}/in")).awaitTermination()
        seen.append(sorted(tuple(r) for r in raised_alerts(spark, run).collect()))
    assert seen[0] == []
    first = [("#beta", t0 + h / 6, t0 + h / 6 + h), ("#beta", t0 + 3 * h, t0 + 4 * h), ("alpha", t0, t0 + h), ("never", t0 - h / 2, t0 + h / 2)]
    assert seen[1] == first and seen[2] == first
    assert seen[3] == sorted([*first, ("#beta", t0 + 6.6 * h, t0 + 7.6 * h)])
