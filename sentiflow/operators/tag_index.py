"""Tag search acceleration: a sorted hashtag side table instead of an inverted index.

``build_tag_index`` writes ``(hashtag, tweet_id, processed_at)`` rows
range-partitioned and sorted by ``(hashtag, tweet_id)``, so each Parquet file
and row group covers a narrow hashtag range; a ``hashtag IN (...)`` filter is
pushed into the scan and row groups whose min/max exclude the tags are
skipped. A hashtag carried by a third of all posts spans many files (the
tiebreak splits it), so no file or task holds it whole. ``tag_search`` reads
the matching ids and semi-joins them back to the posts; the result equals
``tag_overlap`` (case-sensitive, NULL/empty tag arrays never match).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def build_tag_index(posts: DataFrame, path: str, files: int = 64, key: str = "tweet_id") -> str:
    """Write the hashtag side table to ``path`` (a new folder) and return it."""
    rows = posts.select(F.explode("hashtags").alias("hashtag"), key, "processed_at")
    (
        rows.repartitionByRange(files, "hashtag", key)
        .sortWithinPartitions("hashtag", key)
        .write.mode("overwrite")
        .parquet(path)
    )
    return path


def tag_search(spark: SparkSession, posts: DataFrame, index_path: str, tags: Iterable[str], key: str = "tweet_id") -> DataFrame:
    """Posts carrying any of ``tags``, found through the side table."""
    tags = [t for t in tags if t]
    ids = spark.read.parquet(index_path).filter(F.col("hashtag").isin(tags)).select(key).distinct()
    return posts.join(ids, key, "left_semi")
