"""Result bundles of the analytics endpoints (SNK-09), as lazy DataFrames.

``stats_bundle`` = summary, per-minute series, latest rolling snapshots and
top hashtags; ``search_bundle`` = newest matching posts, their count and the
class counts of all matches. All members read one ``posts`` DataFrame, so a
caller can ``persist()`` it once and every member sees the same snapshot (the
four endpoint queries of the reference ran as separate snapshots).
``bundle_json`` renders the (bounded) members as JSON, one row per member.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentiflow.operators.aggregates import kpi_summary, time_series_recent, top_hashtags
from sentiflow.operators.latest import rolling_latest
from sentiflow.operators.topk import RECENT_COLUMNS, search_posts
from sentiflow.requests import limit_param, minutes_param, search_tags

# Row bounds of each bundle member (what makes rendering them as JSON safe).
MEMBER_ROW_BOUNDS = {"summary": 1, "timeSeries": 1440 * 3, "rolling": 3, "hashtags": 20, "data": 200, "counts": 1}


# Order of each member's array: column names, descending with a minus.
MEMBER_ORDER = {
    "timeSeries": ("bucket", "sentiment"),
    "rolling": ("sentiment",),
    "hashtags": ("-mention_count", "hashtag"),
    "data": ("-processed_at", "-tweet_id"),
}


def _rank(df: DataFrame, key: str) -> Column:
    """A number or string that sorts ascending in the member's order."""
    name = key.lstrip("-")
    if not key.startswith("-"):
        return F.col(name).alias(f"o_{name}")
    kind = df.schema[name].dataType
    value = F.unix_micros(F.col(name).cast("timestamp")) if isinstance(kind, (T.TimestampNTZType, T.TimestampType)) else F.col(name)
    if isinstance(kind, T.StringType):  # complement each character's code, shorter strings last
        value = F.concat_ws("", F.transform(F.split(F.col(name), ""), lambda c: F.lpad((F.lit(1114111) - F.ascii(c)).cast("string"), 7, "0")), F.lit("~"))
        return value.alias(f"o_{name}")
    return (-value).alias(f"o_{name}")


def stats_bundle(posts: DataFrame, snapshots: DataFrame, as_of, minutes: int = 60) -> dict[str, DataFrame]:
    """Summary, recent per-minute series, latest rolling snapshots and top hashtags."""
    minutes = minutes_param(minutes)
    return {
        "summary": kpi_summary(posts),
        "timeSeries": time_series_recent(posts, as_of, minutes),
        "rolling": rolling_latest(snapshots),
        "hashtags": top_hashtags(posts, as_of, 20),
    }


def stats_bundle_at(spark: SparkSession, root: str, as_of=None, minutes: int = 60, version: int | None = None) -> dict[str, DataFrame]:
    """``stats_bundle`` of a sink folder, all members as of one log batch (the newest complete one unless given).

    Log, base and snapshots are read up to that batch only, so what lands while the members are read is in none of them.
    ``as_of`` is the clock (the newest post of that version, unless given). ``compact_log(drop_merged=True)`` must not run
    while an older version is read.
    """
    from sentiflow.streaming.sink import complete_version, current_snapshots, posts_as_of

    version = complete_version(spark, root) if version is None else version
    if version is None:
        raise ValueError(f"no complete batch in {root}")
    posts = posts_as_of(spark, root, version)
    now = posts.agg(F.max("processed_at")).first()[0] if as_of is None else as_of
    return stats_bundle(posts, current_snapshots(spark, root, version), now, minutes)


def search_bundle(posts: DataFrame, tags, label=None, limit=50) -> dict[str, DataFrame]:
    """Newest matching posts, their count, and class counts of all matches."""
    res = search_posts(posts, search_tags(tags), label, limit_param(limit), RECENT_COLUMNS)
    data = res["data"]
    return {"data": data, "count": data.agg(F.count(F.lit(1)).alias("count")), "summary": res["summary"]}


def bundle_json(bundle: dict[str, DataFrame]) -> DataFrame:
    """``(member, json)`` rows: each member rendered as a JSON array of its rows.

    Members are bounded by construction (``MEMBER_ROW_BOUNDS``: one-row
    aggregates, top-k, newest-N, a clamped minute range), which is what makes
    gathering each one into a single row safe; unbounded frames do not belong here.
    """
    parts = []
    for name, df in bundle.items():
        keys = [k for k in MEMBER_ORDER.get(name, ()) if k.lstrip("-") in df.columns]
        rows = F.collect_list(F.struct(F.struct(*[_rank(df, k) for k in keys] or [F.lit(0).alias("k0")]).alias("order"), F.struct(*df.columns).alias("row")))
        listed = F.transform(F.sort_array(rows), lambda x: x["row"])
        parts.append(df.agg(F.to_json(listed).alias("json")).select(F.lit(name).alias("member"), "json"))
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
