import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import AS_OF, make_posts
from sentiflow.operators import merge as M
from sentiflow.operators import quality as Q

H = dt.timedelta(hours=1)


def _rows(df):
    return sorted(tuple(r) for r in df.collect())


def test_upsert_partial_updates_only_mutables(spark):
    target = make_posts(spark, [dict(tweet_id="a", text="old", like_count=5, compound_score=0.5, sentiment="positive")])
    batch = make_posts(
        spark,
        [
            dict(tweet_id="a", text="new text", like_count=99, compound_score=-0.5, sentiment="negative", processed_at=AS_OF + H),
            dict(tweet_id="b", text="fresh", like_count=1, compound_score=0.0, sentiment="neutral", processed_at=AS_OF + H),
        ],
    )
    out = {r["tweet_id"]: r for r in M.upsert_partial(target, batch).collect()}
    assert out["a"]["text"] == "old" and out["a"]["like_count"] == 5
    assert out["a"]["compound_score"] == -0.5 and out["a"]["sentiment"] == "negative"
    assert out["a"]["processed_at"] == AS_OF + H
    assert out["b"]["text"] == "fresh"


def test_upsert_in_batch_duplicates_deterministic(spark):
    target = make_posts(spark, [])
    batch = make_posts(
        spark,
        [
            dict(tweet_id="k", text="first", compound_score=0.1, sentiment="positive", processed_at=AS_OF),
            dict(tweet_id="k", text="second", compound_score=-0.9, sentiment="negative", processed_at=AS_OF + H),
        ],
    )
    (r,) = M.upsert_partial(target, batch).collect()
    assert r["text"] == "first" and r["compound_score"] == -0.9


def test_upsert_idempotent(spark):
    target = make_posts(spark, [dict(tweet_id="a", compound_score=0.5, sentiment="positive")])
    batch = make_posts(spark, [dict(tweet_id="a", compound_score=-0.5, sentiment="negative", processed_at=AS_OF + H), dict(tweet_id="c")])
    once = M.upsert_partial(target, batch)
    twice = M.upsert_partial(once, batch)
    assert _rows(once) == _rows(twice)


def test_insert_if_absent_first_write_wins(spark):
    target = make_posts(spark, [dict(tweet_id="a", text="kept")])
    batch = make_posts(spark, [dict(tweet_id="a", text="ignored"), dict(tweet_id="b", text="b1", processed_at=AS_OF), dict(tweet_id="b", text="b2", processed_at=AS_OF + H)])
    out = {r["tweet_id"]: r["text"] for r in M.insert_if_absent(target, batch).collect()}
    assert out == {"a": "kept", "b": "b1"}


def test_snapshot_upsert_latest_wins_start_kept(spark):
    ddl = "window_start string, window_end string, sentiment string, tweet_count long, avg_compound double, computed_at string"
    old = spark.createDataFrame([("s0", "e1", "positive", 1, 0.1, "c1")], ddl)
    new = spark.createDataFrame([("s9", "e1", "positive", 5, 0.5, "c2"), ("s2", "e2", "negative", 2, -0.2, "c2")], ddl)
    out = {(r["window_end"], r["sentiment"]): r for r in M.snapshot_upsert(old, new).collect()}
    assert out[("e1", "positive")]["tweet_count"] == 5 and out[("e1", "positive")]["window_start"] == "s0"
    assert out[("e2", "negative")]["tweet_count"] == 2


def test_incremental_refresh_equals_full(spark):
    rows = [dict(tweet_id=f"x{i}", compound_score=round(0.1 * (i % 7) - 0.3, 4), processed_at=AS_OF + dt.timedelta(seconds=37 * i), retweet_count=i) for i in range(40)]
    df = make_posts(spark, rows)
    cut = AS_OF + dt.timedelta(seconds=37 * 20)
    inc = M.finish_series(M.refresh_series(M.series_partials(df.filter(F.col("processed_at") < cut)), df.filter(F.col("processed_at") >= cut)))
    full = M.finish_series(M.series_partials(df))
    assert _rows(inc) == _rows(full)


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 3), st.sampled_from([-0.5, 0.0, 0.5])), min_size=1, max_size=8))
def test_upsert_idempotence_property(spark, batch_rows):
    batch = make_posts(spark, [dict(tweet_id=k, compound_score=s, processed_at=AS_OF + dt.timedelta(minutes=m)) for k, m, s in batch_rows])
    base = make_posts(spark, [dict(tweet_id="a", text="base")])
    once = M.upsert_partial(base, batch)
    assert _rows(M.upsert_partial(once, batch)) == _rows(once)


def test_quarantine_reasons(spark):
    df = make_posts(
        spark,
        [
            dict(tweet_id="ok"),
            dict(tweet_id=None),
            dict(tweet_id="na", author=None),
            dict(tweet_id="bad", sentiment="mixed"),
            dict(tweet_id="dup", processed_at=AS_OF),
            dict(tweet_id="dup", processed_at=AS_OF + H),
        ],
    )
    valid, rejected = Q.quarantine(df)
    assert sorted(r["tweet_id"] for r in valid.collect()) == ["dup", "ok"]
    reasons = {(r["tweet_id"], tuple(r["reasons"])) for r in rejected.collect()}
    assert reasons == {(None, ("null_tweet_id",)), ("na", ("null_author",)), ("bad", ("bad_sentiment",)), ("dup", ("duplicate_key",))}


def test_apply_defaults_keeps_existing_nulls(spark):
    df = spark.createDataFrame([("t1", None)], "tweet_id string, lang string")
    r = Q.apply_defaults(df, AS_OF).first().asDict()
    assert r["lang"] is None and r["author_followers"] == 0 and r["hashtags"] == [] and r["source"] == "twitterapi.io"
    assert r["processed_at"] == AS_OF


def test_parse_created_at_formats(spark):
    df = spark.createDataFrame(
        [("2025-01-02T03:04:05.123456+00:00",), ("2025-01-02T05:04:05+02:00",), ("Wed Oct 10 20:19:24 +0000 2018",), ("garbage",), (None,)],
        "s string",
    )
    got = [r[0] for r in df.select(Q.parse_created_at("s")).collect()]
    assert got[0] == dt.datetime(2025, 1, 2, 3, 4, 5, 123456)
    assert got[1] == dt.datetime(2025, 1, 2, 3, 4, 5)
    assert got[2] == dt.datetime(2018, 10, 10, 20, 19, 24)
    assert got[3] is None and got[4] is None


def test_quarantine_exact_copies(spark):
    row = dict(tweet_id="same", text="x", processed_at=AS_OF)
    df = make_posts(spark, [row, row, row, dict(tweet_id="other")])
    valid, rejected = Q.quarantine(df)
    assert sorted(r["tweet_id"] for r in valid.collect()) == ["other", "same"]
    assert [tuple(r["reasons"]) for r in rejected.collect()] == [("duplicate_key",), ("duplicate_key",)]


def test_refresh_partials_retracts_rescored_posts(spark):
    """A post that an upsert re-scores and moves to a later minute leaves its old bucket, in both derived tables."""
    import datetime as dt

    from conftest import AS_OF, make_posts
    from sentiflow.operators import merge as M

    base = make_posts(spark, [dict(tweet_id="a", hashtags=["x"], compound_score=0.5, sentiment="positive", processed_at=AS_OF),
                              dict(tweet_id="b", hashtags=["x", "y"], compound_score=0.3, sentiment="positive", processed_at=AS_OF)])
    batch = make_posts(spark, [dict(tweet_id="b", hashtags=["z"], compound_score=-0.4, sentiment="negative", processed_at=AS_OF + dt.timedelta(minutes=5)),
                               dict(tweet_id="c", hashtags=["y"], processed_at=AS_OF)])
    after = M.upsert_partial(base, batch)
    rows = lambda df: sorted(tuple(r) for r in df.collect())
    series = M.refresh_partials(M.series_partials(base), base, batch)
    assert rows(M.finish_series(series)) == rows(M.finish_series(M.series_partials(after)))
    assert [r["tweet_count"] for r in M.finish_series(series).orderBy("bucket", "sentiment").collect()] == [1, 1, 1]
    tags = M.refresh_partials(M.hashtag_partials(base), base, batch, M.hashtag_partials, M.HASHTAG_KEYS)
    assert rows(M.finish_hashtags(tags)) == rows(M.finish_hashtags(M.hashtag_partials(after)))


def test_snapshot_violations(spark):
    import datetime as dt

    from conftest import AS_OF
    from sentiflow.operators.quality import snapshot_violations

    end = AS_OF + dt.timedelta(minutes=5)
    rows = [(AS_OF, end, "positive", 1, 0.1, end), (AS_OF, end, "positive", 2, 0.2, end), (AS_OF, end, "mixed", 1, 0.1, end), (None, end, "neutral", 1, None, end)]
    df = spark.createDataFrame(rows, "window_start timestamp_ntz, window_end timestamp_ntz, sentiment string, tweet_count long, avg_compound double, computed_at timestamp_ntz")
    got = sorted((r["sentiment"], tuple(r["reasons"])) for r in snapshot_violations(df).collect())
    assert got == [("mixed", ("bad_sentiment",)), ("neutral", ("null_window_start", "null_avg_compound")), ("positive", ("duplicate_key",)), ("positive", ("duplicate_key",))]
