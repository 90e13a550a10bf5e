import json
import tempfile

from conftest import AS_OF, SF_SMALL, seed_posts
from sentiflow.operators.health import backlog, batch_throughput
from sentiflow.plans.bundles import bundle_json, search_bundle, stats_bundle
from sentiflow.plans.inputs import posts as load_posts
from sentiflow.operators.windows import snapshot_series
from sentiflow.streaming import jobs as SJ
from sentiflow.streaming.metrics import ProgressRecorder, offsets_frame, progress_frame
from sentiflow.streaming.sink import publish_json
from sentiflow.streaming.sources import write_replay_files


def test_stats_and_search_bundles(spark):
    p = seed_posts(spark)
    b = stats_bundle(p, snapshot_series(p), AS_OF, 5000)
    assert set(b) == {"summary", "timeSeries", "rolling", "hashtags"}
    doc = {r["member"]: json.loads(r["json"]) for r in bundle_json(b).collect()}
    assert doc["summary"][0]["total_tweets"] == 3 and len(doc["rolling"]) == 3
    s = search_bundle(p, ["kafka"], None, "1")
    assert s["count"].first()["count"] == 1 and s["summary"].first()["total"] == 2


def test_bundle_members_share_one_version(spark):
    """A batch that lands between the reads of two members changes none of them; older versions can be asked for, also after a compaction."""
    import datetime as dt

    from conftest import make_posts
    from sentiflow.plans.bundles import stats_bundle_at
    from sentiflow.streaming.sink import PostsLogSink, compact_log

    root, h = tempfile.mkdtemp(prefix="sentiflow-test-"), dt.timedelta(minutes=2)
    batches = [[dict(tweet_id=f"p{i}", hashtags=["a"], compound_score=i / 10, processed_at=AS_OF + b * h) for i in range(b, b + 3)] for b in range(4)]
    for b in (0, 1):
        PostsLogSink(root)(make_posts(spark, batches[b]), b)

    def read(bundle):
        return {r["member"]: r["json"] for r in bundle_json(bundle).collect()}

    wanted = read(stats_bundle_at(spark, root))
    bundle = stats_bundle_at(spark, root)
    first = read({"summary": bundle["summary"]})
    PostsLogSink(root)(make_posts(spark, batches[2]), 2)
    compact_log(spark, root)
    PostsLogSink(root)(make_posts(spark, batches[3]), 3)
    rest = read({k: v for k, v in bundle.items() if k != "summary"})
    assert first | rest == wanted
    assert read(stats_bundle_at(spark, root, version=1)) == wanted
    assert json.loads(read(stats_bundle_at(spark, root))["summary"])[0]["total_tweets"] == 6


def test_publish_json_files(spark):
    out = tempfile.mkdtemp(prefix="sentiflow-test-") + "/pub"
    df = spark.createDataFrame([("1", "héllo", None)], "id string, text string, lang string")
    publish_json(df, "id", fmt="json", path=out)
    (r,) = spark.read.json(out).collect()
    assert r["key"] == "1" and json.loads(r["value"]) == {"id": "1", "text": "héllo", "lang": None}


def test_progress_frame_and_throughput(spark):
    run = tempfile.mkdtemp(prefix="sentiflow-test-")
    p = load_posts(spark, SF_SMALL)
    write_replay_files(p, f"{run}/in", "processed_at", 3, spark, fmt="parquet")
    rec = ProgressRecorder()
    spark.streams.addListener(rec)
    try:
        stream = spark.readStream.schema(p.schema).option("maxFilesPerTrigger", 1).parquet(f"{run}/in")
        q = SJ.run_stream(stream.select("tweet_id"), checkpoint=f"{run}/ckpt", trigger="available_now", fmt="noop")
        q.awaitTermination()
        frame = progress_frame(spark, q.recentProgress)
    finally:
        spark.streams.removeListener(rec)
    rows = batch_throughput(frame.filter("num_input_rows > 0")).orderBy("batch_id").collect()
    assert sum(r["num_input_rows"] for r in rows) == p.count()
    assert rows[-1]["cumulative_rows"] == p.count()


def test_offsets_frame_backlog(spark):
    progress = {
        "batchId": 7,
        "sources": [
            {
                "description": "KafkaV2[Subscribe[tweets]]",
                "startOffset": {"tweets": {"0": 10, "1": 5, "2": 0}},
                "endOffset": {"tweets": {"0": 40, "1": 5}},
                "latestOffset": {"tweets": {"0": 100, "1": 5, "2": 7}},
            }
        ],
    }
    offs = offsets_frame(spark, json.dumps(progress))
    r = backlog(offs).first()
    assert r["total_lag"] == 60 + 0 + 7 and r["partitions"] == 3 and r["healthy"] is True
