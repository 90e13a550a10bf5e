"""Keyed merges that replace the row store's upserts (SNK-03..06, JON-01).

Storage model: an append-only log of versions (e.g. ``posts_log/batch_id=N``)
and a merge-on-read "current" view. Each merge is one ``groupBy(key)`` whose
aggregates are ``min_by`` / ``max_by`` over a version struct, so the map side
collapses every key -- a key repeated across a third of the rows included --
before the shuffle and no join is needed. The payload travels once per half
(immutable, mutable) and is compared by the order columns and one 64-bit hash;
Spark plans these struct-valued aggregates as SortAggregate, which sorts by key
on both sides of the shuffle.

Derived tables are kept as mergeable partial sums. A batch that re-scores posts
retracts what their previous versions contributed (``refresh_partials``).
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentiflow.functions.expressions import lag_seconds
from sentiflow.schema import MUTABLE_COLUMNS

def version_struct(order: Sequence[str], cols: Sequence[str]) -> Column:
    """Version struct: the order columns, then one hash of all other columns as a deterministic tie-break."""
    return F.struct(*[F.col(c) for c in order], F.xxhash64(F.lit(0), *[F.col(c) for c in cols if c not in order]).alias("_tie"))


def upsert_partial(
    target: DataFrame,
    batch: DataFrame,
    key: str = "tweet_id",
    mutable: Sequence[str] = MUTABLE_COLUMNS,
    order: str = "processed_at",
) -> DataFrame:
    """Insert new keys; for existing keys update only ``mutable`` columns.

    Immutable columns keep their first-written values (the target's, or the
    first copy within the batch for a new key); mutable columns take the last
    version (batch after target, then by ``order``). Duplicate keys inside one
    batch are resolved deterministically instead of failing.
    """
    cols = target.columns
    u = target.select(*cols, F.lit(0).alias("_src")).unionByName(batch.select(*cols, F.lit(1).alias("_src")))
    return current_from_log(u, key, ["_src", order], mutable).select(*cols)


def current_from_log(
    log: DataFrame, key: str, order: Sequence[str], mutable: Sequence[str] = MUTABLE_COLUMNS, wanted: Sequence[str] | None = None
) -> DataFrame:
    """Merge-on-read of a version log: immutables from the first version, mutables from the last; of ``wanted`` columns only, if given
    (versions are told apart by all columns, but only these are shuffled)."""
    cols = [c for c in log.columns if (c not in order or c in mutable or c == key) and (wanted is None or c == key or c in wanted)]
    payload = [c for c in log.columns if c != key]
    imm = [c for c in cols if c != key and c not in mutable]
    mut = [c for c in cols if c in mutable]
    rows = log.select(*{c: None for c in (key, *cols)}, version_struct(list(order), payload).alias("_version"))
    halves = [take(F.struct(*[F.col(c) for c in part]), "_version").alias(name) for take, part, name in ((F.min_by, imm, "_i"), (F.max_by, mut, "_m")) if part]
    if not halves:
        return log.select(key).distinct()
    g = rows.groupBy(key).agg(*halves)
    return g.select(key, *[F.col(f"_i.{c}").alias(c) for c in imm], *[F.col(f"_m.{c}").alias(c) for c in mut])


def dedup_first(batch: DataFrame, key: str = "tweet_id", order: str = "processed_at") -> DataFrame:
    """One row per key: the first by ``order`` (then by content)."""
    cols = batch.columns
    g = batch.groupBy(key).agg(F.min_by(F.struct(*[F.col(c) for c in cols if c != key]), version_struct([order], cols)).alias("_r"))
    return g.select(key, *[F.col(f"_r.{c}").alias(c) for c in cols if c != key]).select(*cols)


def insert_if_absent(target: DataFrame, batch: DataFrame, key: str = "tweet_id", order: str = "processed_at") -> DataFrame:
    """First write wins on all columns: target rows stay, new keys are inserted once."""
    new_rows = new_keys(target, batch, key, order)
    return target.unionByName(new_rows)


def new_keys(target: DataFrame, batch: DataFrame, key: str = "tweet_id", order: str = "processed_at") -> DataFrame:
    """The rows an insert-if-absent would append: batch keys not in the target, once each.

    Only the target's key column is shuffled for the anti join.
    """
    return dedup_first(batch, key, order).join(target.select(key), key, "left_anti")


def snapshot_upsert(target: DataFrame, new: DataFrame, keys: Sequence[str] = ("window_end", "sentiment")) -> DataFrame:
    """Upsert snapshots on ``keys``: the latest ``computed_at`` wins on count, average and time;
    ``window_start`` keeps its first-written value."""
    cols = target.columns
    u = target.select(*cols, F.lit(0).alias("_src")).unionByName(new.select(*cols, F.lit(1).alias("_src")))
    ver = F.struct("computed_at", "_src", "tweet_count", "avg_compound")
    g = u.groupBy(*keys).agg(
        F.min_by("window_start", F.struct("_src", "computed_at")).alias("window_start"),
        F.max_by(F.struct("tweet_count", "avg_compound", "computed_at"), ver).alias("_m"),
    )
    return g.select("window_start", *keys, "_m.tweet_count", "_m.avg_compound", "_m.computed_at").select(*cols)


# ---------------------------------------------------------- derived series


def series_partials(posts: DataFrame, unit: str = "minute") -> DataFrame:
    """Mergeable per-bucket partial aggregates (exact decimal sums of scores and of lags in seconds)."""
    lag = lag_seconds("processed_at", "tweet_created_at").cast("decimal(18,6)")
    return posts.groupBy(F.date_trunc(unit, "processed_at").cast("timestamp_ntz").alias("bucket"), "sentiment").agg(
        F.count(F.lit(1)).alias("tweet_count"),
        F.sum(F.col("compound_score").cast("decimal(18,4)")).alias("score_sum"),
        F.count("compound_score").alias("score_n"),
        F.sum("retweet_count").cast("bigint").alias("total_retweets"),
        F.sum("like_count").cast("bigint").alias("total_likes"),
        F.sum(lag).alias("lag_sum"),
        F.count(lag).alias("lag_n"),
    )


def hashtag_partials(posts: DataFrame, unit: str = "minute") -> DataFrame:
    """Mergeable partial sums per (bucket, hashtag, class)."""
    tags = posts.select(
        F.date_trunc(unit, "processed_at").cast("timestamp_ntz").alias("bucket"), F.explode("hashtags").alias("hashtag"), "sentiment", "compound_score"
    )
    return tags.groupBy("bucket", "hashtag", "sentiment").agg(
        F.count(F.lit(1)).alias("mention_count"),
        F.sum(F.col("compound_score").cast("decimal(18,4)")).alias("score_sum"),
        F.count("compound_score").alias("score_n"),
    )


SERIES_KEYS = ("bucket", "sentiment")
HASHTAG_KEYS = ("bucket", "hashtag", "sentiment")


def merge_partials(*parts: DataFrame, keys: Sequence[str] = SERIES_KEYS, settled: bool = True) -> DataFrame:
    """Sum partial sums per key (partially aggregated before the shuffle).

    Keys that come to no rows go. What is only a change (``settled=False``) goes where all its sums are zero: a post that is
    scored anew inside its bucket changes no row count.
    """
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    values = [c for c in parts[0].columns if c not in keys]
    merged = u.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in values])
    if settled:
        return merged.filter(F.col(values[0]) != 0)
    return merged.filter(reduce(lambda a, b: a | b, [F.col(c) != 0 for c in values]))


def retracted(partials: DataFrame, keys: Sequence[str] = SERIES_KEYS) -> DataFrame:
    """The same partial sums with the opposite sign."""
    return partials.select(*[F.col(c) if c in keys else F.negative(F.col(c)).alias(c) for c in partials.columns])


def finish_series(partials: DataFrame, digits: int = 8) -> DataFrame:
    """Partials -> the per-bucket series with the exact average."""
    return partials.select(
        "bucket", "sentiment", F.col("tweet_count").cast("bigint").alias("tweet_count"), _average(digits).alias("avg_compound"),
        F.col("total_retweets").cast("bigint").alias("total_retweets"), F.col("total_likes").cast("bigint").alias("total_likes"),
    )


def finish_hashtags(partials: DataFrame, digits: int = 4) -> DataFrame:
    """Partials -> mentions and exact average per hashtag over all buckets given."""
    tags = partials.groupBy("hashtag").agg(
        F.sum("mention_count").cast("bigint").alias("mention_count"), F.sum("score_sum").alias("score_sum"), F.sum("score_n").alias("score_n")
    )
    return tags.select("hashtag", "mention_count", _average(digits).alias("avg_score"))


def _average(digits: int) -> Column:
    # Bounded precisions keep 14 fractional digits in the decimal quotient before rounding.
    quotient = F.col("score_sum").cast("decimal(28,4)") / F.nullif(F.col("score_n"), F.lit(0)).cast("decimal(12,0)")
    return F.round(quotient, digits).cast("double")


def touched(target: DataFrame, batch: DataFrame, key: str = "tweet_id") -> DataFrame:
    """The target's rows whose key occurs in the batch (the smaller side's keys are matched)."""
    return target.join(batch.select(key).distinct(), key, "left_semi")


def refresh_partials(
    stored: DataFrame, before: DataFrame, batch: DataFrame, partials=series_partials, keys: Sequence[str] = SERIES_KEYS,
    key: str = "tweet_id", mutable: Sequence[str] = MUTABLE_COLUMNS,
) -> DataFrame:
    """Incremental refresh after an upsert of ``batch`` into the current posts ``before``; equals a full recompute.

    Only posts named by the batch are looked at: what their previous versions
    contributed is retracted, what their merged versions contribute is added.
    """
    old = touched(before, batch, key)
    new = upsert_partial(old, batch, key, mutable)
    return merge_partials(stored, retracted(partials(old), keys), partials(new), keys=keys)


def refresh_series(stored_partials: DataFrame, delta_posts: DataFrame, unit: str = "minute") -> DataFrame:
    """Refresh by posts that are all new (no post of the delta was counted before); re-scored posts need ``refresh_partials``."""
    return merge_partials(stored_partials, series_partials(delta_posts, unit))
