"""Covering posting lists: hashtag search without the posts table (FLT-04, TOP-02, AGG-07).

``append_postings`` writes one row per (hashtag, post) with the feed columns, sorted by (hashtag, time descending), and a head
for each block of ``BLOCK`` rows of a list: row count, class counts, newest and oldest time. A batch of posts is a folder of its
own, so lists grow by appends.

``search`` reads heads first. The newest N of any of the tags cannot be older than the time from which one list alone holds N rows,
which the heads tell; that bound is pushed into the scan of the lists, so old blocks are skipped. Counts come from the
heads of the largest list; rows of the other lists that carry an earlier tag of the request are left out, so
a post with several of the tags counts once. A hashtag in a third of all posts is many files and many blocks; only one
time and no list reaches the driver.

The result equals ``search_posts`` over the posts: tags are case-sensitive, null and empty tag arrays never match, repeated rows are rows. A search needs a tag.
"""

from __future__ import annotations

import uuid
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from sentiflow.functions.expressions import ts_literal
from sentiflow.operators.aggregates import class_counts
from sentiflow.operators.filters import search_predicate
from sentiflow.operators.topk import RECENT_COLUMNS, clamp_limit, newest
from sentiflow.requests import search_tags
from sentiflow.schema import SENTIMENT_CLASSES

BLOCK = 4096
#: The lists' columns besides hashtag and block: what feeds show and searches ask for.
COVERED = RECENT_COLUMNS


def append_postings(posts: DataFrame, path: str, files: int = 64, block: int = BLOCK, batch: str | None = None, columns: Iterable[str] = COVERED) -> str:
    """Add the posting lists of ``posts`` to the index under ``path``; a batch name that is there already is replaced."""
    spark, path = posts.sparkSession, path.rstrip("/")
    batch = batch or uuid.uuid4().hex
    rows = posts.select(F.explode(F.array_distinct("hashtags")).alias("hashtag"), *columns).filter(F.col("hashtag").isNotNull())
    order = ["hashtag", F.desc("processed_at"), F.desc("tweet_id")]
    lists = rows.repartitionByRange(files, *order).sortWithinPartitions(*order)
    # rows are numbered as they are written, and a list's rows of one stretch of numbers are a block
    lists = lists.withColumn("block", F.expr(f"monotonically_increasing_id() div {int(block)}"))
    lists.write.mode("overwrite").parquet(f"{path}/rows/batch={batch}")
    stored = spark.read.schema(lists.schema).parquet(f"{path}/rows/batch={batch}")
    heads = stored.groupBy("hashtag", "block").agg(
        F.count(F.lit(1)).alias("total"), *[F.count_if(F.col("sentiment") == c).alias(c) for c in SENTIMENT_CLASSES],
        F.min("processed_at").alias("oldest"), F.max("processed_at").alias("newest"), F.count_if(F.col("processed_at").isNull()).alias("undated"),
    )
    heads.coalesce(max(1, files // 16)).write.mode("overwrite").parquet(f"{path}/heads/batch={batch}")
    return path


class Postings:
    """Reader of an index."""

    def __init__(self, spark: SparkSession, path: str):
        self.lists, self.heads = (spark.read.parquet(f"{path.rstrip('/')}/{name}") for name in ("rows", "heads"))

    def rows(self, tags: Iterable[str], label: str | None = None) -> DataFrame:
        """Every post row that carries any of ``tags``, once: under the first of the tags that it carries."""
        tags = list(dict.fromkeys(search_tags(tags)))
        found = self.lists.filter(F.col("hashtag").isin(tags)).filter(F.col("hashtag") == first_of(tags))
        return found.filter(search_predicate(None, label))

    def bound(self, tags: Iterable[str], label: str | None, n: int):
        """A time from which one list alone holds ``n`` rows of the class (None if no list has that many)."""
        counted = F.col(label) if label in SENTIMENT_CLASSES else F.col("total")
        newer = Window.partitionBy("hashtag").orderBy(F.desc("oldest"), "batch", "block")  # a row a block
        heads = self.heads.filter(F.col("hashtag").isin(list(tags)) & (counted > 0) & (F.col("undated") == 0)).withColumn("n", F.sum(counted).over(newer))
        return heads.filter(F.col("n") >= n).agg(F.max("oldest")).first()[0]

    def counts(self, tags: Iterable[str], label: str | None = None) -> DataFrame:
        """``class_counts`` of all matches: the largest list from its heads, the others' rows that no earlier list holds."""
        tags = list(dict.fromkeys(search_tags(tags)))
        sizes = {r[0]: r[1] for r in self.heads.filter(F.col("hashtag").isin(tags)).groupBy("hashtag").agg(F.sum("total")).collect()}
        tags = sorted(tags, key=lambda t: (-sizes.get(t, 0), t))  # at most one row a tag of the request
        head = self.heads.filter(F.col("hashtag") == tags[0])
        sums = [F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in SENTIMENT_CLASSES]
        parts = head.agg(F.coalesce(F.sum("total"), F.lit(0)).alias("total"), *sums)
        if tags[1:]:
            rest = self.lists.filter(F.col("hashtag").isin(tags[1:])).filter(F.col("hashtag") == first_of(tags))
            parts = parts.unionByName(class_counts(rest))
        wanted = label if label in SENTIMENT_CLASSES else None
        kept = [(F.sum(c) if wanted in (None, c) else F.lit(0)).cast("bigint").alias(c) for c in SENTIMENT_CLASSES]
        return parts.agg(F.sum(wanted or "total").cast("bigint").alias("total"), *kept).select("total", *SENTIMENT_CLASSES)

    def search(self, tags: Iterable[str], label: str | None = None, limit=50, columns: Iterable[str] = RECENT_COLUMNS) -> dict[str, DataFrame]:
        """``{data, summary}`` as ``search_posts`` gives for the posts."""
        n, tags = clamp_limit(limit), search_tags(tags)
        found = self.rows(tags, label)
        bound = self.bound(tags, label, n) if n else None
        if bound is not None:
            found = found.filter(F.col("processed_at") >= ts_literal(bound))
        return {"data": newest(found.select(*columns), n), "summary": self.counts(tags, label)}


def first_of(tags: list[str]) -> Column:
    """The first of ``tags`` that a row's ``hashtags`` hold."""
    return F.element_at(F.array_intersect(F.array(*[F.lit(t) for t in tags]), F.col("hashtags")), 1)
