"""Canonical projection, timestamps, defaults and constraint quarantine (PRJ-*, SNK-07/08)."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentiflow.functions.expressions import as_column, label_expr, lag_seconds
from sentiflow.operators.filters import filter_text_lang
from sentiflow.schema import COLUMN_DEFAULTS, NOT_NULL_COLUMNS, SENTIMENT_CLASSES

# Fixed value: the legacy API date layout after the weekday, e.g. "Oct 10 20:19:24 +0000 2018".
LEGACY_DATE_PATTERN = "MMM dd HH:mm:ss Z yyyy"


def parse_created_at(col: Column | str) -> Column:
    """ISO-8601 (with or without offset) or legacy ``EEE MMM dd HH:mm:ss Z yyyy`` -> UTC ``timestamp_ntz``.

    Never throws under ANSI mode: unparseable text gives NULL.
    """
    s = F.trim(F.col(col) if isinstance(col, str) else col)
    iso = F.try_to_timestamp(s)
    legacy = F.try_to_timestamp(F.substring(s, 5, 1 << 16), F.lit(LEGACY_DATE_PATTERN))
    return F.coalesce(iso, legacy).cast("timestamp_ntz")


def with_processing_lag(posts: DataFrame) -> DataFrame:
    """Add ``processed_lag`` (seconds, NULL when the created time is missing)."""
    return posts.withColumn("processed_lag", lag_seconds("processed_at", "tweet_created_at"))


def canonical_posts(
    payload: DataFrame,
    scorer: Callable[[DataFrame], DataFrame],
    processed_at=None,
    langs=("en",),
) -> DataFrame:
    """Decoded payload rows -> the 14-column canonical posts table.

    Filters first (non-empty text, language), then scores once: ``scorer``
    adds ``compound_score`` from ``text``, and the label is derived from that
    column, so each text is scored in one pass.
    """
    kept = filter_text_lang(payload, langs)
    scored = scorer(kept)
    stamp: Column = F.current_timestamp().cast("timestamp_ntz") if processed_at is None else as_column(processed_at).cast("timestamp_ntz")
    return scored.select(
        F.col("id").alias("tweet_id"),
        "text",
        "author",
        "author_followers",
        F.trim("lang").alias("lang"),
        parse_created_at("created_at").alias("tweet_created_at"),
        "hashtags",
        F.coalesce(F.size("hashtags"), F.lit(0)).alias("hashtag_count"),
        "retweet_count",
        "like_count",
        "compound_score",
        label_expr("compound_score").alias("sentiment"),
        "source",
        stamp.alias("processed_at"),
    )


def apply_defaults(df: DataFrame, as_of=None) -> DataFrame:
    """Add omitted columns with their declared defaults; existing NULLs stay NULL."""
    out = df
    for name, value in COLUMN_DEFAULTS.items():
        if name in out.columns:
            continue
        if isinstance(value, list):
            out = out.withColumn(name, F.array().cast("array<string>"))
        elif isinstance(value, int):
            out = out.withColumn(name, F.lit(value).cast("bigint") if name != "hashtag_count" else F.lit(value))
        else:
            out = out.withColumn(name, F.lit(value))
    if "processed_at" not in out.columns:
        stamp = F.current_timestamp() if as_of is None else as_column(as_of)
        out = out.withColumn("processed_at", stamp.cast("timestamp_ntz"))
    return out


def row_checks() -> list[tuple[Column, str]]:
    """(condition, reason) of every row-level constraint."""
    checks = [(F.col(c).isNull(), f"null_{c}") for c in NOT_NULL_COLUMNS]
    checks.append((F.col("sentiment").isNotNull() & ~F.col("sentiment").isin(list(SENTIMENT_CLASSES)), "bad_sentiment"))
    return checks


def violated() -> Column:
    """True when a row breaks any row-level constraint (a plain boolean, no array built)."""
    return reduce(lambda a, b: a | b, [cond for cond, _ in row_checks()])


def violations(key: str = "tweet_id") -> Column:
    """Array of constraint-violation reasons for one row (empty when valid)."""
    empty = F.array().cast("array<string>")
    return F.concat(*[F.when(cond, F.array(F.lit(reason))).otherwise(empty) for cond, reason in row_checks()])


def quarantine(
    df: DataFrame, key: str = "tweet_id", order: str = "processed_at", check_unique: bool = True
) -> tuple[DataFrame, DataFrame]:
    """Split rows into ``(valid, rejected)``; rejected rows carry a ``reasons`` array.

    ``check_unique=False`` applies only the row-level checks (a projection and
    a filter, no shuffle) -- for upsert targets, where repeated keys are merged
    rather than rejected.

    Row-level checks (NOT NULL, class enum) are projections. Key uniqueness:
    among rows passing them, the first row per key (smallest ``order``, then
    smallest hash of the row) is the valid one. Keys are counted first (``groupBy(key)`` over
    the key column alone); rows of keys that occur once pass
    as they are. Only the rows of repeated keys are ranked: the winner's (order,
    hash) is a partially aggregated ``min``, and of the rows that equal it one copy is kept
    through a row count. A key repeated across a third of the rows streams through a join
    that AQE can split; no task holds its rows.
    """
    cols = df.columns
    # The reasons array is built only for failing rows; valid rows pass a boolean filter.
    bad = df.filter(violated()).select(*cols, violations(key).alias("reasons"))
    ok = df.filter(~violated()).select(*cols)
    if not check_unique:
        return ok, bad
    tie = F.struct(F.col(order), F.xxhash64(*[F.col(c) for c in cols]).alias("h"))
    ranked = ok.withColumn("_t", tie)
    repeated = ranked.groupBy(key).agg(F.count(F.lit(1)).alias("_n"), F.min("_t").alias("_first")).filter(F.col("_n") > 1)
    marked = ranked.join(repeated.select(key, "_first"), key, "left")
    single = marked.filter(F.col("_first").isNull())
    # Copies equal to the winner are one group per key; the first copy stays, the others are rejected like all later rows.
    equal = marked.filter(F.col("_t") == F.col("_first")).groupBy(*cols).agg(F.count(F.lit(1)).alias("_n"))
    valid = single.select(*cols).unionByName(equal.select(*cols))
    copies = equal.filter(F.col("_n") > 1).withColumn("_c", F.explode(F.sequence(F.lit(2), F.col("_n").cast("int")))).select(*cols)
    later = marked.filter(F.col("_t") != F.col("_first")).select(*cols)
    dups = later.unionByName(copies).withColumn("reasons", F.array(F.lit("duplicate_key")))
    return valid, bad.unionByName(dups)


def snapshot_violations(snapshots: DataFrame) -> DataFrame:
    """Snapshot rows that break a constraint, with reasons: NOT NULL columns, the class enum, unique (window_end, sentiment)."""
    needed = ("window_start", "window_end", "sentiment", "tweet_count", "avg_compound", "computed_at")
    empty = F.array().cast("array<string>")
    checks = [(F.col(c).isNull(), f"null_{c}") for c in needed]
    checks.append((F.col("sentiment").isNotNull() & ~F.col("sentiment").isin(list(SENTIMENT_CLASSES)), "bad_sentiment"))
    keyed = snapshots.groupBy(F.col("window_end").alias("_e"), F.col("sentiment").alias("_s"))
    repeated = keyed.agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > 1)
    same = F.col("window_end").eqNullSafe(F.col("_e")) & F.col("sentiment").eqNullSafe(F.col("_s"))
    marked = snapshots.join(repeated, same, "left").drop("_e", "_s")
    reasons = F.concat(*[F.when(cond, F.array(F.lit(why))).otherwise(empty) for cond, why in [*checks, (F.col("_n") > 1, "duplicate_key")]])
    return marked.withColumn("reasons", reasons).filter(F.size("reasons") > 0).drop("_n")
