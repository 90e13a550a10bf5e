from pyspark.sql import functions as F

from conftest import AS_OF, make_posts, seed_posts
from sentiflow.operators import aggregates as A
from sentiflow.operators import filters as FL
from sentiflow.operators import latest as L
from sentiflow.operators import topk as TK


def test_kpi_on_seed_rows(spark):
    r = A.kpi_summary(seed_posts(spark)).first().asDict()
    assert r["total_tweets"] == 3
    assert (r["positive_count"], r["negative_count"], r["neutral_count"]) == (1, 1, 1)
    assert r["positive_pct"] == 33.33
    assert r["avg_compound_score"] == 0.0333


def test_kpi_empty_table(spark):
    r = A.kpi_summary(make_posts(spark, []).limit(0)).first().asDict()
    assert r["total_tweets"] == 0 and r["positive_pct"] is None and r["avg_compound_score"] is None


def test_top_hashtags_seed(spark):
    rows = {r["hashtag"]: r for r in A.top_hashtags(seed_posts(spark), AS_OF, 20).collect()}
    assert rows["kafka"]["mention_count"] == 2
    assert rows["kafka"]["avg_score"] == 0.05


def test_explode_drops_null_and_empty_arrays(spark):
    df = make_posts(spark, [dict(hashtags=None), dict(hashtags=[]), dict(hashtags=["x"])])
    out = A.hashtag_by_sentiment(df, AS_OF).collect()
    assert [(r["hashtag"], r["mention_count"]) for r in out] == [("x", 1)]


def test_class_counts_zero_filled(spark):
    df = make_posts(spark, [dict(sentiment="positive"), dict(sentiment="positive")])
    r = A.class_counts(df).first().asDict()
    assert r == {"total": 2, "positive": 2, "negative": 0, "neutral": 0}
    shares = A.class_shares(A.class_counts(df.limit(0))).first().asDict()
    assert shares["positive_pct"] == 0.0 and shares["positive_pct_int"] == 0


def test_trailing_window_closed_lower_bound(spark):
    import datetime as dt

    df = make_posts(spark, [dict(processed_at=AS_OF - dt.timedelta(minutes=5)), dict(processed_at=AS_OF - dt.timedelta(minutes=5, microseconds=1)), dict(processed_at=AS_OF + dt.timedelta(hours=1))])
    assert FL.trailing_window(df, AS_OF, "5 minutes").count() == 2


def test_rolling_snapshot_label_and_zero_fill(spark):
    df = seed_posts(spark)
    rows = A.rolling_snapshot(df.filter(F.col("sentiment") != "neutral"), AS_OF, "5 minutes", zero_fill=True).collect()
    by = {r["sentiment"]: r for r in rows}
    assert set(by) == {"positive", "negative", "neutral"}
    assert by["neutral"]["tweet_count"] == 0 and by["neutral"]["avg_compound"] == 0.0
    assert str(by["positive"]["window_end"]) == "2024-01-30 12:00:00"
    assert str(by["positive"]["window_start"]) == "2024-01-30 11:55:00"


def test_latest_per_key_without_window_sort(spark):
    snaps = spark.createDataFrame(
        [("positive", 1, "2024-01-01 00:05:00"), ("positive", 2, "2024-01-01 00:06:00"), ("negative", 3, "2024-01-01 00:01:00")],
        "sentiment string, tweet_count int, window_end string",
    )
    got = {r["sentiment"]: r["tweet_count"] for r in L.latest_per_key(snaps, ["sentiment"], ["window_end"]).collect()}
    assert got == {"positive": 2, "negative": 3}


def test_search_posts_summary_ignores_limit(spark):
    df = make_posts(spark, [dict(hashtags=["a"], sentiment="positive") for _ in range(5)] + [dict(hashtags=["b"])])
    res = TK.search_posts(df, ["a"], None, 2)
    assert res["data"].count() == 2
    assert res["summary"].first()["total"] == 5


def test_invalid_class_rejected(spark):
    import pytest

    with pytest.raises(ValueError):
        FL.by_class(seed_posts(spark), "mixed")


def test_series_pivot_fills_zero(spark):
    series = spark.createDataFrame([("2024-01-01", "positive", 2)], "bucket string, sentiment string, tweet_count long")
    r = A.series_pivot(series).first().asDict()
    assert r == {"bucket": "2024-01-01", "positive": 2, "negative": 0, "neutral": 0}
