"""Map the driver's test tables onto the posts model (pure projections, no shuffle).

The same expressions appear in the DuckDB oracle (``sentiflow.plans.oracle``).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentiflow.functions.expressions import label_expr


def events_to_posts(events: DataFrame) -> DataFrame:
    """``events`` -> canonical posts (14 columns), one post per event, row-local."""
    k = F.get_json_object(F.col("props"), "$.k").try_cast("int")
    x = (F.col("value") - F.lit(50)) / F.lit(10)
    score = F.round(x / F.sqrt(x * x + F.lit(15)), 4)
    tags = (
        F.when(k % 25 == 0, F.array().cast("array<string>"))
        .otherwise(F.array(F.col("event_type"), F.concat(F.lit("k"), (k % 10).cast("string"))))
    )
    created = F.when(k == 0, F.lit(None).cast("timestamp_ntz")).otherwise(
        F.col("ts") - F.make_dt_interval(F.lit(0), F.lit(0), F.lit(0), k)
    )
    return (
        events.select(
            F.col("event_id").cast("string").alias("tweet_id"),
            F.concat(F.col("event_type"), F.lit(" k"), k.cast("string")).alias("text"),
            F.concat(F.lit("user_"), F.col("user_id").cast("string")).alias("author"),
            (F.col("user_id") * F.lit(100)).alias("author_followers"),
            F.when(F.col("event_type") == "signup", F.lit("es")).otherwise(F.lit("en")).alias("lang"),
            created.alias("tweet_created_at"),
            tags.alias("hashtags"),
            k.cast("bigint").alias("retweet_count"),
            F.floor(F.col("value")).cast("bigint").alias("like_count"),
            score.alias("compound_score"),
            F.col("ts").alias("processed_at"),
        )
        .withColumn("hashtag_count", F.coalesce(F.size("hashtags"), F.lit(0)))
        .withColumn("sentiment", label_expr("compound_score"))
        .withColumn("source", F.lit("events"))
        .select(
            "tweet_id", "text", "author", "author_followers", "lang", "tweet_created_at", "hashtags",
            "hashtag_count", "retweet_count", "like_count", "compound_score", "sentiment", "source",
            "processed_at",
        )
    )


def conversations_to_envelopes(conversations: DataFrame) -> DataFrame:
    """``conversations`` -> raw websocket envelopes ``{type, data:{id,text,...}}`` as JSON strings."""
    kind = (
        F.when(F.col("role") == "user", F.lit("tweet"))
        .when(F.col("role") == "system", F.lit("error"))
        .otherwise(F.lit("other"))
    )
    data = F.struct(
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"),
        F.col("text").alias("text"),
    )
    return conversations.select(
        F.col("conv_id"),
        F.col("turn"),
        F.to_json(F.struct(kind.alias("type"), data.alias("data"))).alias("value"),
    )


def events_to_payload_json(events: DataFrame) -> DataFrame:
    """``events`` -> wire JSON payloads (the 10-field post shape) for decode tests."""
    posts = events_to_posts(events)
    payload = F.struct(
        F.col("tweet_id").alias("id"),
        F.col("text"),
        F.col("author"),
        F.col("author_followers"),
        F.col("lang"),
        F.date_format(F.col("tweet_created_at"), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("created_at"),
        F.col("hashtags"),
        F.col("retweet_count"),
        F.col("like_count"),
        F.col("source"),
    )
    return posts.select(F.col("tweet_id").alias("key"), F.to_json(payload).alias("value"), F.col("processed_at"))
