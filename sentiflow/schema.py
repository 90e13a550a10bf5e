"""Fixed schemas, class labels, defaults and constraints of the posts model."""

from __future__ import annotations

from pyspark.sql import types as T

# The three sentiment classes and the label thresholds.
SENTIMENT_CLASSES = ("positive", "negative", "neutral")
POSITIVE_THRESHOLD = 0.05
NEGATIVE_THRESHOLD = -0.05

# Wire payload of one post (all fields nullable, as received).
POST_PAYLOAD_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType(), True),
        T.StructField("text", T.StringType(), True),
        T.StructField("author", T.StringType(), True),
        T.StructField("author_followers", T.LongType(), True),
        T.StructField("lang", T.StringType(), True),
        T.StructField("created_at", T.StringType(), True),
        T.StructField("hashtags", T.ArrayType(T.StringType()), True),
        T.StructField("retweet_count", T.LongType(), True),
        T.StructField("like_count", T.LongType(), True),
        T.StructField("source", T.StringType(), True),
    ]
)

# Canonical enriched post, in stored column order.
CANONICAL_COLUMNS = (
    "tweet_id",
    "text",
    "author",
    "author_followers",
    "lang",
    "tweet_created_at",
    "hashtags",
    "hashtag_count",
    "retweet_count",
    "like_count",
    "compound_score",
    "sentiment",
    "source",
    "processed_at",
)

# Types of the canonical columns as stored.
POSTS_TYPES = {
    "tweet_id": "string", "text": "string", "author": "string", "author_followers": "bigint", "lang": "string",
    "tweet_created_at": "timestamp_ntz", "hashtags": "array<string>", "hashtag_count": "int", "retweet_count": "bigint",
    "like_count": "bigint", "compound_score": "double", "sentiment": "string", "source": "string", "processed_at": "timestamp_ntz",
}

# Columns a keyed upsert may change; all others keep their first-written value.
MUTABLE_COLUMNS = ("compound_score", "sentiment", "processed_at")

# Columns that must not be NULL in the posts table.
NOT_NULL_COLUMNS = ("tweet_id", "text", "author", "compound_score", "sentiment")

# Column defaults applied when a column is omitted on write.
COLUMN_DEFAULTS = {
    "author_followers": 0,
    "lang": "en",
    "hashtags": [],
    "hashtag_count": 0,
    "retweet_count": 0,
    "like_count": 0,
    "source": "twitterapi.io",
}

SNAPSHOT_COLUMNS = ("window_start", "window_end", "sentiment", "tweet_count", "avg_compound", "computed_at")
