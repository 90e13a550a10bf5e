"""Latest-row-per-key operators (WIN-*), i.e. ``DISTINCT ON (key) ... ORDER BY key, t DESC``.

Implemented with ``max_by(struct(...), order)`` inside a ``groupBy`` rather
than ``row_number() OVER (PARTITION BY key ORDER BY t DESC)``: the window form
sorts and holds every row of a key in one task, which breaks when one key
(a sentiment class has only three values) holds a third of the data, while
``max_by`` is partially aggregated on the map side and moves one row per key
per task through the shuffle. Spark plans the struct-valued aggregate as
SortAggregate (a sort by key before and after the shuffle).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def latest_per_key(df: DataFrame, keys: list[str], order: list[str] | str) -> DataFrame:
    """Keep, for each key, the row with the greatest ``order`` (ties: greatest hash of the remaining columns)."""
    order = [order] if isinstance(order, str) else list(order)
    rest = [c for c in df.columns if c not in keys]
    # Order first, then one hash of every other column, so ties resolve deterministically and the payload travels once.
    ordering: Column = F.struct(*[F.col(c) for c in order], F.xxhash64(F.lit(0), *[F.col(c) for c in rest if c not in order]).alias("_tie"))
    picked = df.groupBy(*keys).agg(F.max_by(F.struct(*[F.col(c) for c in rest]), ordering).alias("_row"))
    return picked.select(*keys, *[F.col(f"_row.{c}").alias(c) for c in rest]).select(*df.columns)


def rolling_latest(snapshots: DataFrame) -> DataFrame:
    """Latest snapshot per class, average rounded to 4 dp, ordered by class."""
    latest = latest_per_key(snapshots, ["sentiment"], ["window_end"])
    return latest.select(
        "sentiment",
        "tweet_count",
        F.round(F.col("avg_compound").cast("decimal(18,6)"), 4).cast("double").alias("avg_compound"),
        "window_start",
        "window_end",
        "computed_at",
    ).orderBy("sentiment")
