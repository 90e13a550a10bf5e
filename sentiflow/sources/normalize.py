"""Normalise the three raw post shapes to the 10-field payload (SRC-04..06).

``or`` in the source shapes means "first non-empty" -> ``coalesce(nullif(x, ''), ...)``;
``??`` / ``.get(default)`` means "first non-NULL" -> ``coalesce``. A missing id
gets a deterministic id derived from the raw record (``sha2``), so batch
replays produce the same key; a missing created time gets ``as_of``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentiflow.functions.expressions import as_column

S, L = T.StringType(), T.LongType()

WS_SCHEMA = T.StructType(
    [
        T.StructField("id", S), T.StructField("id_str", S), T.StructField("text", S), T.StructField("full_text", S),
        T.StructField("user", T.StructType([T.StructField("screen_name", S), T.StructField("followers_count", L)])),
        T.StructField("lang", S), T.StructField("created_at", S),
        T.StructField("entities", T.StructType([T.StructField("hashtags", T.ArrayType(T.StructType([T.StructField("text", S)])))])),
        T.StructField("retweet_count", L), T.StructField("favorite_count", L),
    ]
)

REST_SCHEMA = T.StructType(
    [
        T.StructField("id", S), T.StructField("id_str", S), T.StructField("text", S), T.StructField("full_text", S),
        T.StructField("author", T.StructType([T.StructField("userName", S), T.StructField("followers", L)])),
        T.StructField("user", T.StructType([T.StructField("screen_name", S), T.StructField("followers_count", L)])),
        T.StructField("lang", S), T.StructField("createdAt", S), T.StructField("created_at", S),
        # Hashtag entries are objects {text} or plain strings; keep them raw and resolve below.
        T.StructField("entities", T.StructType([T.StructField("hashtags", T.ArrayType(S))])),
        T.StructField("retweetCount", L), T.StructField("retweet_count", L),
        T.StructField("likeCount", L), T.StructField("favorite_count", L),
    ]
)

SCRAPE_SCHEMA = T.StructType(
    [
        T.StructField("id", S), T.StructField("text", S), T.StructField("username", S), T.StructField("followersCount", L),
        T.StructField("lang", S), T.StructField("timeParsed", S), T.StructField("hashtags", T.ArrayType(S)),
        T.StructField("retweetCount", L), T.StructField("likeCount", L),
    ]
)

# The source label each shape stores.
SOURCE_LABEL = {"ws": "twitterapi.io", "rest": "twitterapi.io", "scrape": "twitter"}


def _first_nonempty(*cols: Column) -> Column:
    return F.coalesce(*[F.nullif(c, F.lit("")) for c in cols])


def _truthy_long(*cols: Column) -> Column:
    """JS ``a || b || 0`` over numbers: 0 and NULL fall through."""
    return F.coalesce(*[F.nullif(c, F.lit(0)) for c in cols], F.lit(0).cast("bigint"))


def normalize_posts(raw: DataFrame, shape: str, as_of, value_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Raw JSON records of one ``shape`` (``ws``, ``rest`` or ``scrape``) -> payload rows."""
    keep = keep or []
    schema = {"ws": WS_SCHEMA, "rest": REST_SCHEMA, "scrape": SCRAPE_SCHEMA}[shape]
    r = raw.select(*keep, F.col(value_col).cast("string").alias("_raw"), F.from_json(F.col(value_col).cast("string"), schema).alias("t"))
    fallback_id = F.sha2(F.col("_raw"), 256)
    now = as_column(as_of).cast("timestamp_ntz")
    now_iso = F.date_format(now, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    if shape == "ws":
        tags = F.transform(F.coalesce(F.col("t.entities.hashtags"), F.array()), lambda h: h["text"])
        cols = [
            _first_nonempty(F.col("t.id"), F.col("t.id_str"), fallback_id).alias("id"),
            F.coalesce(_first_nonempty(F.col("t.text")), F.col("t.full_text"), F.lit("")).alias("text"),
            F.coalesce(F.col("t.user.screen_name"), F.lit("unknown")).alias("author"),
            F.coalesce(F.col("t.user.followers_count"), F.lit(0).cast("bigint")).alias("author_followers"),
            F.coalesce(F.col("t.lang"), F.lit("en")).alias("lang"),
            F.coalesce(F.col("t.created_at"), now_iso).alias("created_at"),
            tags.cast("array<string>").alias("hashtags"),
            F.coalesce(F.col("t.retweet_count"), F.lit(0).cast("bigint")).alias("retweet_count"),
            F.coalesce(F.col("t.favorite_count"), F.lit(0).cast("bigint")).alias("like_count"),
        ]
    elif shape == "rest":
        tags = F.transform(
            F.coalesce(F.col("t.entities.hashtags"), F.array().cast("array<string>")),
            lambda h: F.coalesce(F.get_json_object(h, "$.text"), h),
        )
        cols = [
            _first_nonempty(F.col("t.id"), F.col("t.id_str"), fallback_id).alias("id"),
            F.coalesce(_first_nonempty(F.col("t.text"), F.col("t.full_text")), F.lit("")).alias("text"),
            F.coalesce(_first_nonempty(F.col("t.author.userName"), F.col("t.user.screen_name")), F.lit("unknown")).alias("author"),
            _truthy_long(F.col("t.author.followers"), F.col("t.user.followers_count")).alias("author_followers"),
            F.coalesce(_first_nonempty(F.col("t.lang")), F.lit("en")).alias("lang"),
            F.coalesce(_first_nonempty(F.col("t.createdAt"), F.col("t.created_at")), now_iso).alias("created_at"),
            tags.alias("hashtags"),
            F.coalesce(F.col("t.retweetCount"), F.col("t.retweet_count"), F.lit(0).cast("bigint")).alias("retweet_count"),
            F.coalesce(F.col("t.likeCount"), F.col("t.favorite_count"), F.lit(0).cast("bigint")).alias("like_count"),
        ]
    else:
        cols = [
            _first_nonempty(F.col("t.id"), fallback_id).alias("id"),
            F.coalesce(_first_nonempty(F.col("t.text")), F.lit("")).alias("text"),
            F.coalesce(_first_nonempty(F.col("t.username")), F.lit("unknown")).alias("author"),
            F.coalesce(F.col("t.followersCount"), F.lit(0).cast("bigint")).alias("author_followers"),
            F.coalesce(_first_nonempty(F.col("t.lang")), F.lit("en")).alias("lang"),
            F.coalesce(F.col("t.timeParsed"), now_iso).alias("created_at"),
            F.coalesce(F.col("t.hashtags"), F.array().cast("array<string>")).alias("hashtags"),
            F.coalesce(F.col("t.retweetCount"), F.lit(0).cast("bigint")).alias("retweet_count"),
            F.coalesce(F.col("t.likeCount"), F.lit(0).cast("bigint")).alias("like_count"),
        ]
    return r.select(*keep, *cols, F.lit(SOURCE_LABEL[shape]).alias("source"))
