"""Newest-N feeds, search bundles and feed merging (TOP-*, PRJ-06, SNK-09, JON-02, SET-01).

Each newest-N is ``orderBy(...).limit(n)`` which Spark plans as
``TakeOrderedAndProject``: every task keeps its own top n and only n rows per
task reach the final merge, so the cost is one scan with no full sort. The
key is the last sort column so ties are deterministic.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentiflow.operators.aggregates import class_counts
from sentiflow.operators.filters import search_predicate
from sentiflow.requests import limit_param, tags_param

RECENT_COLUMNS = (
    "tweet_id", "text", "author", "author_followers", "hashtags", "compound_score",
    "sentiment", "retweet_count", "like_count", "processed_at", "source",
)
FEED_COLUMNS = RECENT_COLUMNS[:-1]


def newest(df: DataFrame, n: int, ts_col: str = "processed_at", key: str = "tweet_id") -> DataFrame:
    """The ``n`` newest rows, key as tie-break (a per-task top-n, then a merge)."""
    return df.orderBy(F.desc(ts_col), F.desc(key)).limit(n)


def recent_posts(posts: DataFrame, n: int = 100) -> DataFrame:
    """The 11-column recent feed, newest first."""
    return newest(posts.select(*RECENT_COLUMNS), n)


parse_tags_param = tags_param
clamp_limit = limit_param


def filtered_feed(posts: DataFrame, tags_param: str | None, label: str | None, limit_param) -> dict[str, DataFrame]:
    """The filtered feed endpoint: optional tags and class, newest first, 10 columns, plus counts."""
    return search_posts(posts, parse_tags_param(tags_param), label, limit_param, FEED_COLUMNS)


def search_posts(
    posts: DataFrame,
    tags: Iterable[str] | None = None,
    label: str | None = None,
    limit=50,
    columns: Iterable[str] = RECENT_COLUMNS,
) -> dict[str, DataFrame]:
    """``{data, summary}``: newest matching posts and the class counts of *all* matches.

    Both outputs are lazy DataFrames over the same predicate; ``summary`` ignores the limit.
    """
    n = clamp_limit(limit)
    matches = posts.filter(search_predicate(tags, label))
    return {"data": newest(matches.select(*columns), n), "summary": class_counts(matches)}


def feed_cards(posts: DataFrame) -> DataFrame:
    """Display projection of a feed: tag line, 60-char preview, thousands separators, source badge."""
    return posts.select(
        "tweet_id",
        F.array_join(F.transform(F.coalesce("hashtags", F.array().cast("array<string>")), lambda h: F.concat(F.lit("#"), h)), " ").alias("tag_line"),
        F.substring("text", 1, 60).alias("preview"),
        F.format_number(F.col("author_followers"), 0).alias("followers_display"),
        # Exact HALF_UP rounding of the 4-place score, then fixed 3-place text.
        F.format_number(F.round(F.col("compound_score").cast("decimal(10,4)"), 3), 3).alias("score_display"),
        F.when(F.col("source") == "twitterapi.io", F.lit("LIVE")).otherwise(F.upper("source")).alias("source_badge"),
    )


def new_since(incoming: DataFrame, seen: DataFrame, key: str = "tweet_id") -> DataFrame:
    """Rows of ``incoming`` whose key has not been seen.

    ``seen`` may be all history: it is first cut to the incoming keys (a semi join, so
    only matches are kept), and the anti join then compares two small sides.
    """
    known = seen.select(key).join(incoming.select(key).distinct(), key, "left_semi").distinct()
    return incoming.join(known, key, "left_anti")


def explorer_rows(posts: DataFrame, label: str | None = None) -> DataFrame:
    """The explorer's five columns, newest first, with an optional class slicer."""
    rows = posts if label is None else posts.filter(F.col("sentiment") == label)
    return rows.select("processed_at", "author", "text", "sentiment", "compound_score").orderBy(F.desc("processed_at"), "author", "text")


def accumulate_feed(old: DataFrame, fresh: DataFrame, cap: int = 200, key: str = "tweet_id") -> DataFrame:
    """Fresh rows plus old rows not in fresh, newest ``cap`` kept."""
    merged = fresh.unionByName(old.join(fresh.select(key), key, "left_anti"))
    return newest(merged, cap, key=key)

