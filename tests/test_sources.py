import json

from pyspark.sql import functions as F

from conftest import AS_OF
from sentiflow.sources import json_codec as J
from sentiflow.sources import normalize as N
from sentiflow.sources import tables as TB


def test_decode_malformed_and_field_errors(spark):
    good = json.dumps({"id": 12, "text": "hi", "author_followers": "many", "hashtags": ["a"]})
    df = spark.createDataFrame([(good,), ("{not json",)], "value string")
    rows = J.decode_json(df).collect()
    assert rows[0]["id"] == "12" and rows[0]["text"] == "hi" and rows[0]["author_followers"] is None
    # A field-level type error nulls that field, keeps its siblings and flags the raw record.
    assert rows[0]["_corrupt_record"] == good
    assert rows[1]["id"] is None and rows[1]["_corrupt_record"] == "{not json"


def test_encode_json_keeps_nulls_and_unicode(spark):
    df = spark.createDataFrame([("1", "héllo ✓", None)], "id string, text string, lang string")
    r = J.encode_json(df, "id").first()
    assert r["key"] == "1"
    assert json.loads(r["value"]) == {"id": "1", "text": "héllo ✓", "lang": None}


def test_route_envelopes(spark):
    msgs = [
        json.dumps({"type": "tweet", "data": {"id": "1", "text": "x"}}),
        json.dumps({"type": "tweet", "data": {"id": "2", "text": "", "full_text": "long"}}),
        json.dumps({"type": "tweet", "data": {"id": "3", "text": ""}}),
        json.dumps({"type": "error", "message": "Rate Limit exceeded"}),
        json.dumps({"type": "ping"}),
        "garbage",
    ]
    df = spark.createDataFrame([(m,) for m in msgs], "value string")
    got = [(r["route"], r["rate_limited"]) for r in J.route_envelopes(df).collect()]
    assert got == [("publish", False), ("publish", False), ("empty", False), ("error", True), ("ignored", False), ("dropped", False)]


def test_normalize_ws_cases(spark):
    recs = [
        {"id_str": "s1", "text": "", "full_text": "full", "user": None, "lang": "en", "retweet_count": 2, "favorite_count": 3},
        {"id": "i2", "text": "t", "user": {"screen_name": "bob", "followers_count": 7}, "entities": {"hashtags": [{"text": "A"}]},
         "created_at": "Wed Oct 10 20:19:24 +0000 2018"},
        {"text": "no id"},
    ]
    df = spark.createDataFrame([(json.dumps(r),) for r in recs], "value string")
    rows = N.normalize_posts(df, "ws", AS_OF).collect()
    assert rows[0]["id"] == "s1" and rows[0]["text"] == "full" and rows[0]["author"] == "unknown" and rows[0]["like_count"] == 3
    assert rows[0]["hashtags"] == [] and rows[0]["created_at"].startswith("2024-01-30T12:00:00")
    assert rows[1]["author"] == "bob" and rows[1]["author_followers"] == 7 and rows[1]["hashtags"] == ["A"]
    assert rows[1]["created_at"] == "Wed Oct 10 20:19:24 +0000 2018"
    assert len(rows[2]["id"]) == 64 and rows[2]["lang"] == "en"


def test_normalize_rest_and_scrape(spark):
    rest = {"id": "", "id_str": "r1", "author": {"userName": "", "followers": 0}, "user": {"screen_name": "u", "followers_count": 5},
            "createdAt": "2025-01-01T00:00:00Z", "entities": {"hashtags": [{"text": "x"}, "y"]}, "retweet_count": 4, "likeCount": 0}
    scrape = {"id": "c1", "text": "hey", "username": "sam", "followersCount": 3, "timeParsed": "2025-01-01T00:00:00.000Z",
              "hashtags": ["z"], "retweetCount": 1, "likeCount": 2}
    r = N.normalize_posts(spark.createDataFrame([(json.dumps(rest),)], "value string"), "rest", AS_OF).first()
    assert r["id"] == "r1" and r["author"] == "u" and r["author_followers"] == 5 and r["hashtags"] == ["x", "y"]
    assert r["retweet_count"] == 4 and r["like_count"] == 0 and r["text"] == "" and r["source"] == "twitterapi.io"
    s = N.normalize_posts(spark.createDataFrame([(json.dumps(scrape),)], "value string"), "scrape", AS_OF).first()
    assert (s["id"], s["author"], s["hashtags"], s["source"]) == ("c1", "sam", ["z"], "twitter")


def test_first_nonempty_and_ensure_column(spark):
    a = spark.createDataFrame([], "x int")
    b = spark.createDataFrame([(1,), (2,)], "x int")
    c = spark.createDataFrame([(9,)], "x int")
    out = TB.first_nonempty([("a", a), ("b", b), ("c", c)]).collect()
    assert sorted((r["x"], r["source_used"]) for r in out) == [(1, "b"), (2, "b")]
    d = TB.ensure_column(b, "y", F.lit(1))
    assert TB.ensure_column(d, "y", F.lit(2)).first()["y"] == 1
    assert TB.column_status(d, ["y", "z"]) == [("y", "EXISTS"), ("z", "MISSING")]


def test_first_nonempty_falls_through_failures(spark):
    import pytest

    def broken():
        raise OSError("source is down")

    empty, full = spark.createDataFrame([], "x int"), spark.createDataFrame([(1,)], "x int")
    failing = full.select(F.raise_error(F.lit("no answer")).cast("int").alias("x"))
    out = TB.first_nonempty([("a", broken), ("b", failing), ("c", empty), ("d", full)]).collect()
    assert [(r["x"], r["source_used"]) for r in out] == [(1, "d")]
    assert TB.first_nonempty([("a", broken), ("b", empty)]).count() == 0
    with pytest.raises(OSError):
        TB.first_nonempty([("a", broken)])


def test_shared_folder_is_required_off_local_masters(spark, monkeypatch):
    import pytest

    from sentiflow import session

    class Context:
        master = "spark://host:7077"

        def getConf(self):
            return {}

        def getCheckpointDir(self):
            return None

    class Session:
        sparkContext = Context()

    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        session.shared_checkpoint_dir(Session())


def test_kafka_options_defaults():
    from sentiflow.streaming.sources import kafka_options

    o = kafka_options("broker:9092")
    assert o["subscribe"] == "tweets" and o["startingOffsets"] == "latest" and o["failOnDataLoss"] == "false"
