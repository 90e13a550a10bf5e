"""Roll-ups of mergeable sums: time nodes for trailing windows (FLT-03, AGG-01, AGG-09) and cuboids for filter contexts (AGG-08).

Time nodes are partial sums per (minute | hour | day, class). A window is a handful of ranges of nodes, whole days in its
middle, hours and minutes towards its ends, plus the raw rows of its edge minutes; ``cover`` names the ranges. Nodes
are sums, so those that ``derive_stream`` keeps are refreshed by its changes.

Cuboids are partial sums over subsets of the dimensions, made in one pass with grouping sets. A request with any filters on
dimensions is answered from the smallest cuboid that has them all; one that no cuboid covers is answered from the posts, and
says so.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentiflow.functions.expressions import lag_seconds, minute_bucket, pct, ts_literal
from sentiflow.operators.merge import series_partials
from sentiflow.schema import SENTIMENT_CLASSES

LEVELS = ("minute", "hour", "day")
_STEP = {"minute": dt.timedelta(minutes=1), "hour": dt.timedelta(hours=1), "day": dt.timedelta(days=1)}


def with_levels(minutes: DataFrame) -> DataFrame:
    """Per-minute partial sums -> the same sums per (level, bucket, class) at every level, in one shuffle."""
    nodes = F.array(*[F.struct(F.lit(lv).alias("level"), minute_bucket("bucket", lv).alias("bucket")) for lv in LEVELS])
    sums = [c for c in minutes.columns if c not in ("bucket", "sentiment")]
    spread = minutes.select(F.explode(nodes).alias("n"), "sentiment", *sums).select("n.*", "sentiment", *sums)
    return spread.groupBy("level", "bucket", "sentiment").agg(*[F.sum(c).alias(c) for c in sums])


def build_nodes(posts: DataFrame, path: str) -> str:
    """Write the time nodes of ``posts`` to ``path``."""
    with_levels(series_partials(posts)).write.mode("overwrite").partitionBy("level").parquet(path)
    return path


def _floor(t: dt.datetime, level: str) -> dt.datetime:
    zero = {"minute": {}, "hour": {"minute": 0}, "day": {"minute": 0, "hour": 0}}[level]
    return t.replace(second=0, microsecond=0, **zero)


def _ceil(t: dt.datetime, level: str) -> dt.datetime:
    low = _floor(t, level)
    return low if low == t else low + _STEP[level]


def cover(lower: dt.datetime, upper: dt.datetime | None = None) -> tuple[list[tuple[str, dt.datetime, dt.datetime | None]], list[tuple]]:
    """``(nodes, edges)`` of ``lower <= t`` (and ``t <= upper``): half-open (level, start, end) ranges of nodes, and (start, end, closed) raw ranges.

    Ranges do not overlap and leave nothing out; without ``upper`` the days go on for ever.
    """
    starts = [lower]
    for level in LEVELS:
        starts.append(_ceil(starts[-1], level))  # first minute, hour, day that lies in the window
    if upper is None:
        nodes = [(level, a, b) for level, a, b in zip(LEVELS, starts[1:], [*starts[2:], None])]
        edges = [(lower, starts[1], False)]
    else:
        ends = [upper]
        for level in LEVELS:
            ends.append(_floor(ends[-1], level))
        top = max((i for i in range(1, 4) if starts[i] <= ends[i]), default=0)  # coarsest level with a place in the window
        if not top:
            return [], [(lower, upper, True)]
        nodes = [(LEVELS[i - 1], starts[i], starts[i + 1]) for i in range(1, top)]
        nodes.append((LEVELS[top - 1], starts[top], ends[top]))
        nodes += [(LEVELS[i - 1], ends[i + 1], ends[i]) for i in range(top - 1, 0, -1)]
        edges = [(lower, starts[1], False), (ends[1], upper, True)]
    return [n for n in nodes if n[2] is None or n[1] < n[2]], [e for e in edges if e[0] < e[1] or (e[2] and e[0] == e[1])]


def window_sums(nodes: DataFrame, posts: DataFrame, lower: dt.datetime, upper: dt.datetime | None = None) -> DataFrame:
    """Partial sums per class over the window, from the nodes and the raw rows of its edge minutes only."""
    ranges, edges = cover(lower, upper)

    def within(c, a, b, closed=False):
        low = F.col(c) >= ts_literal(a)
        return low if b is None else low & (F.col(c) <= ts_literal(b) if closed else F.col(c) < ts_literal(b))

    sums = [c for c in nodes.columns if c not in ("level", "bucket", "sentiment")]
    of_nodes = reduce(lambda a, b: a | b, [(F.col("level") == lv) & within("bucket", a, b) for lv, a, b in ranges], F.lit(False))
    of_edges = reduce(lambda a, b: a | b, [within("processed_at", *e) for e in edges], F.lit(False))
    parts = nodes.filter(of_nodes).select("sentiment", *sums).unionByName(series_partials(posts.filter(of_edges)).select("sentiment", *sums))
    return parts.groupBy("sentiment").agg(*[F.sum(c).alias(c) for c in sums])


def _mean(total: str, n: str, scale: int, digits: int) -> Column:
    """The exact average as ``exact_avg`` gives it: rounded to four more digits than the values have, then to ``digits``."""
    quotient = F.sum(total).cast(f"decimal(28,{scale})") / F.nullif(F.sum(n), F.lit(0)).cast("decimal(12,0)")
    return F.round(F.round(quotient, scale + 4), digits).cast("double")


def kpis(sums: DataFrame, by: Sequence[str] = ()) -> DataFrame:
    """Totals, class counts, positive share, average score and lag of partial sums per class."""
    total = F.coalesce(F.sum("tweet_count"), F.lit(0)).cast("bigint")
    of = {c: F.coalesce(F.sum(F.when(F.col("sentiment") == c, F.col("tweet_count"))), F.lit(0)).cast("bigint") for c in SENTIMENT_CLASSES}
    return sums.groupBy(*by).agg(
        total.alias("total_tweets"), *[n.alias(f"{c}_count") for c, n in of.items()], pct(of["positive"], total, 2).alias("positive_pct"),
        _mean("score_sum", "score_n", 4, 4).alias("avg_compound_score"), _mean("lag_sum", "lag_n", 6, 2).alias("avg_lag_seconds"),
    )


def window_kpis(nodes: DataFrame, posts: DataFrame, as_of: dt.datetime, width: dt.timedelta, upper: dt.datetime | None = None) -> DataFrame:
    """``kpis`` of the posts from ``as_of - width`` on (up to ``upper``, if given)."""
    return kpis(window_sums(nodes, posts, as_of - width, upper))


def rolling_avg_from_nodes(nodes: DataFrame, posts: DataFrame, as_of: dt.datetime, width: dt.timedelta) -> DataFrame:
    """``rolling_avg`` from the nodes."""
    return window_kpis(nodes, posts, as_of, width).select(F.col("avg_compound_score").alias("rolling_avg"), F.col("total_tweets").alias("tweet_count"))


# ------------------------------------------------------------------ cuboids

#: Dimensions and the cuboids over them that are kept unless others are asked for.
DIMENSIONS = ("source", "lang", "sentiment", "hour")
CUBOIDS = (("source", "lang", "sentiment", "hour"), ("lang", "sentiment", "hour"), ("source", "lang", "sentiment"), ("sentiment", "hour"), ("lang", "sentiment"), ("sentiment",))


def _measured(posts: DataFrame) -> DataFrame:
    """Posts with their dimensions and the measures that are summed."""
    hour = [] if "hour" in posts.columns else [minute_bucket("processed_at", "hour").alias("hour")]
    return posts.select(
        "*", *hour, F.col("compound_score").cast("decimal(18,4)").alias("_score"), lag_seconds("processed_at", "tweet_created_at").cast("decimal(18,6)").alias("_lag")
    )


def _sums() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("tweet_count"), F.sum("_score").alias("score_sum"), F.count("_score").alias("score_n"),
        F.sum("_lag").alias("lag_sum"), F.count("_lag").alias("lag_n"),
    ]


def grouping_number(cuboid: Iterable[str]) -> int:
    """The ``grouping_id`` of a cuboid: a bit for every dimension that it leaves out."""
    return sum(1 << (len(DIMENSIONS) - 1 - i) for i, d in enumerate(DIMENSIONS) if d not in cuboid)


def build_cuboids(posts: DataFrame, path: str, cuboids: Sequence[Sequence[str]] = CUBOIDS) -> str:
    """Write the cuboids to ``path``, a partition each, from one pass over the posts."""
    sets = [[F.col(d) for d in c] for c in cuboids]
    cubes = _measured(posts).groupingSets(sets, *DIMENSIONS).agg(F.grouping_id().cast("int").alias("cuboid"), *_sums())
    cubes.write.mode("overwrite").partitionBy("cuboid").parquet(path)
    return path


class Cuboids:
    """Chooser over stored cuboids."""

    def __init__(self, stored: DataFrame):
        self.stored = stored
        self.sizes = {r["cuboid"]: r["n"] for r in stored.groupBy("cuboid").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a cuboid

    def choose(self, needed: Iterable[str]) -> int | None:
        """The smallest cuboid that has all of the dimensions, or None."""
        needed = set(needed)
        fit = [(n, c) for c, n in self.sizes.items() if all(not c >> (len(DIMENSIONS) - 1 - i) & 1 for i, d in enumerate(DIMENSIONS) if d in needed)]
        return min(fit)[1] if fit and needed <= set(DIMENSIONS) else None

    def answer(self, posts: DataFrame, slicers: dict[str, Iterable], by: Sequence[str] = ()) -> tuple[DataFrame, str]:
        """``kpis`` of the posts that pass the slicers (column -> values; a null value takes nulls), by some dimensions; and what answered it.

        ``by`` and the slicers may name any column of the posts; one that no cuboid has is answered from the posts.
        """
        chosen = self.choose([*slicers, *by, "sentiment"])
        if chosen is None:
            sums = _measured(posts).filter(_passes(slicers)).groupBy(*dict.fromkeys([*by, "sentiment"])).agg(*_sums())
            return kpis(sums, by), "posts"
        return kpis(self.stored.filter((F.col("cuboid") == chosen) & _passes(slicers)), by), f"cuboid {chosen}"


def _passes(slicers: dict[str, Iterable]) -> Column:
    conditions = [reduce(lambda a, b: a | b, [F.col(c).eqNullSafe(F.lit(v)) for v in values], F.lit(False)) for c, values in slicers.items()]
    return reduce(lambda a, b: a & b, conditions, F.lit(True))
