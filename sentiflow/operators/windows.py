"""Event-time window series (the scalable twin of the processing-time rolling snapshot)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentiflow.functions.expressions import exact_avg


def snapshot_series(posts: DataFrame, width: str = "5 minutes", slide: str | None = "1 minute", ts_col: str = "processed_at") -> DataFrame:
    """Rolling-snapshot rows ``(window_start, window_end, sentiment, tweet_count, avg_compound, computed_at)``
    for every sliding window ``[start, start + width)`` that holds rows.

    ``groupBy(window(...), sentiment)`` with partial aggregation: each row is
    expanded to ``width / slide`` windows map-side, then one partial row per
    (window, class) per task is shuffled.
    """
    win = F.window(ts_col, width, slide) if slide else F.window(ts_col, width)
    return (
        posts.groupBy(win.alias("w"), "sentiment")
        .agg(F.count(F.lit(1)).alias("tweet_count"), exact_avg("compound_score", 4, 4).alias("avg_compound"))
        .select(
            F.col("w.start").cast("timestamp_ntz").alias("window_start"),
            F.col("w.end").cast("timestamp_ntz").alias("window_end"),
            "sentiment",
            "tweet_count",
            "avg_compound",
            F.col("w.end").cast("timestamp_ntz").alias("computed_at"),
        )
    )
