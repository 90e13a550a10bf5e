"""Aggregations over the posts table (AGG-*).

Every aggregate here is a declarative ``groupBy``/``agg`` so Catalyst plans a
partial (map-side) aggregate before the shuffle: a hot key -- one hashtag or
one class holding a third of all rows -- collapses to one row per map task
before it is exchanged, and global aggregates exchange one row per task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentiflow.functions.expressions import (
    as_column,
    class_count_columns,
    count_class,
    exact_avg,
    interval,
    lag_seconds,
    minute_bucket,
    pct,
)
from sentiflow.operators.filters import trailing_window
from sentiflow.schema import SENTIMENT_CLASSES


def kpi_summary(posts: DataFrame) -> DataFrame:
    """One row: totals, class counts, positive share, average score and lag, time range."""
    lag = F.col("processed_lag") if "processed_lag" in posts.columns else lag_seconds("processed_at", "tweet_created_at")
    total = F.count(F.lit(1))
    return posts.agg(
        total.alias("total_tweets"),
        count_class("positive").alias("positive_count"),
        count_class("negative").alias("negative_count"),
        count_class("neutral").alias("neutral_count"),
        pct(count_class("positive"), total, 2).alias("positive_pct"),
        exact_avg("compound_score", 4, 4).alias("avg_compound_score"),
        exact_avg(lag, 6, 2).alias("avg_lag_seconds"),
        F.min("processed_at").alias("earliest_tweet"),
        F.max("processed_at").alias("latest_tweet"),
    )


def per_bucket_series(posts: DataFrame, unit: str = "minute", digits: int | None = None, ts_col: str = "processed_at") -> DataFrame:
    """Per time-bucket x class: count, average score, retweet and like sums.

    ``digits=None`` keeps the exact decimal average (8 places); the stats
    endpoint's form rounds to 4.
    """
    return (
        posts.groupBy(minute_bucket(ts_col, unit).alias("bucket"), F.col("sentiment"))
        .agg(
            F.count(F.lit(1)).alias("tweet_count"),
            exact_avg("compound_score", 4, digits).alias("avg_compound"),
            F.sum("retweet_count").cast("bigint").alias("total_retweets"),
            F.sum("like_count").cast("bigint").alias("total_likes"),
        )
    )


def time_series_recent(posts: DataFrame, as_of, minutes: int = 60) -> DataFrame:
    """Per-minute series over the trailing ``minutes`` window, average rounded to 4 (requests: ``requests.minutes_param``)."""
    recent = trailing_window(posts, as_of, f"{minutes} minutes")
    return per_bucket_series(recent, "minute", 4).orderBy("bucket", "sentiment")


def hashtag_by_sentiment(posts: DataFrame, as_of, width: str = "24 hours") -> DataFrame:
    """Hashtag x class mention counts and average score over a trailing window."""
    recent = trailing_window(posts, as_of, width)
    return (
        recent.select(F.explode("hashtags").alias("hashtag"), "sentiment", "compound_score")
        .groupBy("hashtag", "sentiment")
        .agg(F.count(F.lit(1)).alias("mention_count"), exact_avg("compound_score", 4, None).alias("avg_sentiment_score"))
    )


def top_hashtags(posts: DataFrame, as_of, k: int = 20, width: str = "24 hours") -> DataFrame:
    """Top-k hashtags by mentions over a trailing window; ties broken by tag."""
    recent = trailing_window(posts, as_of, width)
    return (
        recent.select(F.explode("hashtags").alias("hashtag"), "compound_score")
        .groupBy("hashtag")
        .agg(F.count(F.lit(1)).alias("mention_count"), exact_avg("compound_score", 4, 4).alias("avg_score"))
        .orderBy(F.desc("mention_count"), F.asc("hashtag"))
        .limit(k)
    )


def rolling_snapshot(posts: DataFrame, as_of, width: str = "5 minutes", zero_fill: bool = False, exact_window: bool = False) -> DataFrame:
    """Class counts and average score for the processing-time window ending at ``as_of``.

    Faithful form: label ``[trunc(as_of, minute) - width, trunc(as_of, minute)]``
    while rows are ``processed_at >= as_of - width`` with no upper bound.
    ``exact_window=True`` filters to the labelled interval instead.
    ``zero_fill=True`` emits all three classes (count 0, average 0.0).
    """
    as_of_col = as_column(as_of)
    end = F.date_trunc("minute", as_of_col).cast("timestamp_ntz")
    start = end - interval(width)
    if exact_window:
        rows = posts.filter((F.col("processed_at") >= start) & (F.col("processed_at") < end))
    else:
        rows = trailing_window(posts, as_of_col, width)
    snap = rows.groupBy("sentiment").agg(
        F.count(F.lit(1)).alias("tweet_count"), exact_avg("compound_score", 4, 4).alias("avg_compound")
    )
    if zero_fill:
        classes = posts.sparkSession.createDataFrame([(c,) for c in SENTIMENT_CLASSES], "sentiment string")
        snap = classes.join(snap, "sentiment", "left").select(
            "sentiment",
            F.coalesce("tweet_count", F.lit(0)).cast("bigint").alias("tweet_count"),
            F.coalesce("avg_compound", F.lit(0.0)).alias("avg_compound"),
        )
    return snap.select(
        start.alias("window_start"),
        end.alias("window_end"),
        "sentiment",
        "tweet_count",
        "avg_compound",
        as_of_col.cast("timestamp_ntz").alias("computed_at"),
    )


def class_counts(posts: DataFrame) -> DataFrame:
    """Zero-filled ``{total, positive, negative, neutral}`` in one global aggregate."""
    return posts.agg(F.count(F.lit(1)).alias("total"), *class_count_columns())


def class_counts_long(posts: DataFrame) -> DataFrame:
    """Plain ``GROUP BY sentiment`` counts (classes without rows are absent)."""
    return posts.groupBy("sentiment").agg(F.count(F.lit(1)).alias("cnt"))


def positive_rate(posts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """``count(positive) / count(sentiment) * 100``; NULL (BLANK) when there is nothing to count."""
    rate = pct(F.count_if(F.col("sentiment") == "positive"), F.count("sentiment"), 4)
    if by:
        return posts.groupBy(*by).agg(rate.alias("positive_rate"))
    return posts.agg(rate.alias("positive_rate"))


def rolling_avg(posts: DataFrame, as_of, width: str = "1 hour") -> DataFrame:
    """Average score over the trailing window (the BI 1-hour measure)."""
    return trailing_window(posts, as_of, width).agg(
        exact_avg("compound_score", 4, 4).alias("rolling_avg"), F.count(F.lit(1)).alias("tweet_count")
    )


def series_pivot(series: DataFrame, value_col: str = "tweet_count") -> DataFrame:
    """``(bucket, sentiment, n)`` rows -> ``(bucket, positive, negative, neutral)``, missing = 0.

    Conditional aggregation over the fixed class list: one aggregate (partial +
    final) instead of the two phases ``pivot`` plans, and no distinct-values job.
    """
    return series.groupBy("bucket").agg(
        *[
            F.coalesce(F.sum(F.when(F.col("sentiment") == c, F.col(value_col))), F.lit(0)).cast("bigint").alias(c)
            for c in SENTIMENT_CLASSES
        ]
    )


def minute_of_day_pivot(posts: DataFrame, ts_col: str = "processed_at") -> DataFrame:
    """Counts per ``HH:mm`` time-of-day bucket, pivoted by class (days collapse, as the client does)."""
    return (
        posts.groupBy(F.date_format(ts_col, "HH:mm").alias("time"))
        .agg(*class_count_columns())
        .select("time", *[F.col(c).cast("bigint").alias(c) for c in SENTIMENT_CLASSES])
    )


def class_shares(counts: DataFrame) -> DataFrame:
    """From one class-count row: percent shares to 1 dp (0.0 when empty) and integer percents."""
    out = [F.col("total")]
    for c in SENTIMENT_CLASSES:
        out.append(F.coalesce(pct(F.col(c), F.col("total"), 1), F.lit(0.0)).alias(f"{c}_pct"))
    for c in SENTIMENT_CLASSES:
        out.append(F.coalesce(pct(F.col(c), F.col("total"), 0), F.lit(0.0)).cast("bigint").alias(f"{c}_pct_int"))
    return counts.select(*out)


def kpi_unpivot(summary: DataFrame) -> DataFrame:
    """KPI row -> ``(class, count)`` rows for a donut chart."""
    return summary.select(
        F.col("positive_count").alias("positive"),
        F.col("negative_count").alias("negative"),
        F.col("neutral_count").alias("neutral"),
    ).unpivot([], list(SENTIMENT_CLASSES), "class", "count")
