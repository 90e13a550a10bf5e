"""Registered queries: one per operator of the inventory, each ``(spark, sf_dir) -> DataFrame``.

Every query reads whole driver tables (or what Spark derives from them); the
parameters are the reference's defaults unless noted.
"""

from __future__ import annotations

import datetime as dt

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentiflow.functions import expressions as X
from sentiflow.operators import aggregates as A
from sentiflow.operators import filters as FL
from sentiflow.operators import latest as L
from sentiflow.operators import topk as TK
from sentiflow.operators.windows import snapshot_series
from sentiflow.plans.inputs import as_of, posts, table

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}

# Parameters of the registered queries (fixed values, mirrored in the oracle SQL).
SEARCH_TAGS = ["click", "k3"]
SEARCH_CLASS = "positive"
SEARCH_LIMIT = 50
KEYWORD = "purchase"


def register(name: str):
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        return fn

    return deco


# ---------------------------------------------------------------- projections


@register("canonical_posts")
def q_canonical_posts(spark, sf_dir):
    """Payload rows of every event, with its score at hand, through the canonical projection."""
    from sentiflow.operators.quality import canonical_posts

    p = posts(spark, sf_dir)
    payload = p.select(
        F.col("tweet_id").alias("id"), "text", "author", "author_followers", "lang",
        F.date_format("tweet_created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("created_at"),
        "hashtags", "retweet_count", "like_count", "source", "processed_at", F.col("compound_score").alias("given"),
    )
    return canonical_posts(payload, lambda df: df.withColumn("compound_score", F.col("given")), F.col("processed_at"), ("en", "es"))


@register("processing_lag")
def q_processing_lag(spark, sf_dir):
    p = posts(spark, sf_dir)
    return p.select("tweet_id", X.lag_seconds("processed_at", "tweet_created_at").alias("processed_lag"))


@register("sentiment_label")
def q_sentiment_label(spark, sf_dir):
    p = posts(spark, sf_dir)
    return p.select("tweet_id", "compound_score", X.label_expr("compound_score").alias("label"))


@register("feed_cards")
def q_feed_cards(spark, sf_dir):
    return TK.feed_cards(posts(spark, sf_dir))


# -------------------------------------------------------------------- filters


@register("filter_text_lang")
def q_filter_text_lang(spark, sf_dir):
    docs = table(spark, sf_dir, "documents")
    return FL.filter_text_lang(docs, ["en"]).select("doc_id", "lang", "n_chars")


@register("trailing_window")
def q_trailing_window(spark, sf_dir):
    p = posts(spark, sf_dir)
    return FL.trailing_window(p, as_of(p), "24 hours").select("tweet_id", "processed_at", "sentiment")


@register("tag_overlap")
def q_tag_overlap(spark, sf_dir):
    p = posts(spark, sf_dir)
    return FL.tag_overlap(p, SEARCH_TAGS).select("tweet_id", "hashtags")


@register("keyword_match")
def q_keyword_match(spark, sf_dir):
    p = posts(spark, sf_dir)
    return FL.keyword_match(p, "#" + KEYWORD.upper()).select("tweet_id", "text", "hashtags")


# --------------------------------------------------------------- aggregations


@register("kpi_summary")
def q_kpi_summary(spark, sf_dir):
    return A.kpi_summary(posts(spark, sf_dir))


@register("per_minute_series")
def q_per_minute_series(spark, sf_dir):
    return A.per_bucket_series(posts(spark, sf_dir), "minute").orderBy(F.desc("bucket"), "sentiment")


@register("per_hour_series")
def q_per_hour_series(spark, sf_dir):
    return A.per_bucket_series(posts(spark, sf_dir), "hour", 4)


@register("time_series_recent")
def q_time_series_recent(spark, sf_dir):
    p = posts(spark, sf_dir)
    return A.time_series_recent(p, as_of(p), 60)


@register("hashtag_by_sentiment")
def q_hashtag_by_sentiment(spark, sf_dir):
    p = posts(spark, sf_dir)
    return A.hashtag_by_sentiment(p, as_of(p)).orderBy(F.desc("mention_count"), "hashtag", "sentiment")


@register("top_hashtags")
def q_top_hashtags(spark, sf_dir):
    p = posts(spark, sf_dir)
    return A.top_hashtags(p, as_of(p), 20)


@register("rolling_snapshot")
def q_rolling_snapshot(spark, sf_dir):
    p = posts(spark, sf_dir)
    return A.rolling_snapshot(p, as_of(p), "5 minutes")


@register("rolling_snapshot_24h")
def q_rolling_snapshot_24h(spark, sf_dir):
    p = posts(spark, sf_dir)
    return A.rolling_snapshot(p, as_of(p), "24 hours", zero_fill=True)


@register("search_summary")
def q_search_summary(spark, sf_dir):
    return TK.search_posts(posts(spark, sf_dir), SEARCH_TAGS, None, SEARCH_LIMIT)["summary"]


@register("class_counts")
def q_class_counts(spark, sf_dir):
    return A.class_counts_long(posts(spark, sf_dir))


@register("positive_rate")
def q_positive_rate(spark, sf_dir):
    return A.positive_rate(posts(spark, sf_dir), by=["lang"])


@register("rolling_1h_avg")
def q_rolling_1h_avg(spark, sf_dir):
    p = posts(spark, sf_dir)
    return A.rolling_avg(p, as_of(p), "1 hour")


@register("series_pivot")
def q_series_pivot(spark, sf_dir):
    series = A.per_bucket_series(posts(spark, sf_dir), "hour", 4)
    return A.series_pivot(series).orderBy("bucket")


@register("minute_of_day_pivot")
def q_minute_of_day_pivot(spark, sf_dir):
    return A.minute_of_day_pivot(posts(spark, sf_dir)).orderBy("time")


@register("class_shares")
def q_class_shares(spark, sf_dir):
    return A.class_shares(A.class_counts(posts(spark, sf_dir)))


@register("kpi_unpivot")
def q_kpi_unpivot(spark, sf_dir):
    return A.kpi_unpivot(A.kpi_summary(posts(spark, sf_dir)))


@register("hashtag_polarity")
def q_hashtag_polarity(spark, sf_dir):
    p = posts(spark, sf_dir)
    tags = p.select(F.explode("hashtags").alias("hashtag"), "compound_score").groupBy("hashtag").agg(
        X.exact_avg("compound_score", 4, 4).alias("avg_score")
    )
    return tags.select("hashtag", "avg_score", X.polarity_class("avg_score").alias("polarity"))


# ------------------------------------------------------------ latest per key


@register("snapshot_series")
def q_snapshot_series(spark, sf_dir):
    return snapshot_series(posts(spark, sf_dir), "5 minutes", "1 minute")


@register("latest_per_class")
def q_latest_per_class(spark, sf_dir):
    snaps = snapshot_series(posts(spark, sf_dir), "1 hour", "10 minutes")
    return L.latest_per_key(snaps, ["sentiment"], ["window_end"])


@register("rolling_latest")
def q_rolling_latest(spark, sf_dir):
    return L.rolling_latest(snapshot_series(posts(spark, sf_dir), "5 minutes", "1 minute"))


# -------------------------------------------------------------------- top-k


@register("recent_posts")
def q_recent_posts(spark, sf_dir):
    return TK.recent_posts(posts(spark, sf_dir), 100)


@register("search_posts")
def q_search_posts(spark, sf_dir):
    return TK.search_posts(posts(spark, sf_dir), SEARCH_TAGS, SEARCH_CLASS, SEARCH_LIMIT)["data"]


@register("new_since_poll")
def q_new_since_poll(spark, sf_dir):
    p = posts(spark, sf_dir)
    t = as_of(p)
    incoming = FL.trailing_window(p, t, "24 hours")
    seen = p.filter(F.col("processed_at") < t - X.interval("1 hour"))
    return TK.new_since(incoming, seen).select("tweet_id", "processed_at", "sentiment")


@register("accumulate_feed")
def q_accumulate_feed(spark, sf_dir):
    p = posts(spark, sf_dir).select(*TK.RECENT_COLUMNS)
    t = as_of(p)
    cut = t - X.interval("1 hour")
    old = TK.newest(p.filter(F.col("processed_at") < cut), 200)
    fresh = p.filter(F.col("processed_at") >= cut)
    return TK.accumulate_feed(old, fresh, 200)


# ===================================================== front end (SRC, PRJ, SNK)
from sentiflow.functions import scoring as SC  # noqa: E402
from sentiflow.operators import health as H  # noqa: E402
from sentiflow.operators import keywords as KW  # noqa: E402
from sentiflow.operators import merge as M  # noqa: E402
from sentiflow.operators import quality as Q  # noqa: E402
from sentiflow.sources import fixtures as FX  # noqa: E402
from sentiflow.sources import json_codec as J  # noqa: E402
from sentiflow.sources import normalize as N  # noqa: E402
from sentiflow.sources import tables as TB  # noqa: E402

PAYLOAD_FIELDS = ["id", "text", "author", "author_followers", "lang", "created_at", "hashtags", "retweet_count", "like_count", "source"]


@register("decode_json")
def q_decode_json(spark, sf_dir):
    good = FX.events_to_payload_json(table(spark, sf_dir, "events")).select("key", "value")
    conv = table(spark, sf_dir, "conversations")
    bad = conv.select(F.concat_ws("-", F.lit("c"), "conv_id", "turn").alias("key"), F.col("text").alias("value"))
    return J.decode_json(good.unionByName(bad), keep=["key"])


@register("encode_json")
def q_encode_json(spark, sf_dir):
    p = posts(spark, sf_dir)
    payload = p.select(
        F.col("tweet_id").alias("id"), "text", "author", "author_followers", "lang",
        F.date_format("tweet_created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("created_at"),
        "hashtags", "retweet_count", "like_count", "source",
    )
    return J.encode_json(payload, "id")


@register("envelope_routes")
def q_envelope_routes(spark, sf_dir):
    conv = table(spark, sf_dir, "conversations")
    env = FX.conversations_to_envelopes(conv).select("value")
    raw = conv.select(F.col("text").alias("value"))  # not JSON: dropped
    return J.route_counts(J.route_envelopes(env.unionByName(raw)))


def _ws_raw(spark, sf_dir):
    """Websocket-shaped raw posts derived from events, with missing/empty/null fields by event type."""
    p = posts(spark, sf_dir).withColumn("_etype", F.split("text", " ").getItem(0))
    raw = F.struct(
        F.when(F.col("_etype") != "view", F.col("tweet_id")).alias("id"),
        F.col("tweet_id").alias("id_str"),
        F.when(F.col("_etype") != "error", F.col("text")).otherwise(F.lit("")).alias("text"),
        F.col("text").alias("full_text"),
        F.when(F.col("_etype") != "signup", F.struct(F.col("author").alias("screen_name"), F.col("author_followers").alias("followers_count"))).alias("user"),
        F.col("lang"),
        F.date_format("tweet_created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("created_at"),
        F.when(F.size("hashtags") > 0, F.struct(F.transform("hashtags", lambda h: F.struct(h.alias("text"))).alias("hashtags"))).alias("entities"),
        F.col("retweet_count"),
        F.col("like_count").alias("favorite_count"),
    )
    return p, p.select("tweet_id", F.to_json(raw).alias("value"))


@register("normalize_posts")
def q_normalize_posts(spark, sf_dir):
    p, raw = _ws_raw(spark, sf_dir)
    return N.normalize_posts(raw, "ws", as_of(p), keep=["tweet_id"])


@register("parse_created_at")
def q_parse_created_at(spark, sf_dir):
    p = posts(spark, sf_dir).filter(F.col("tweet_created_at").isNotNull())
    legacy = F.startswith(F.col("text"), F.lit("click"))
    raw = F.when(legacy, F.date_format("tweet_created_at", "EEE MMM dd HH:mm:ss '+0000' yyyy")).otherwise(
        F.date_format("tweet_created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    )
    s = p.select("tweet_id", raw.alias("raw"))
    return s.select("tweet_id", "raw", Q.parse_created_at("raw").alias("tweet_created_at"))


@register("apply_defaults")
def q_apply_defaults(spark, sf_dir):
    p = posts(spark, sf_dir)
    slim = p.select("tweet_id", "text", "author", "tweet_created_at", "compound_score", "sentiment")
    return Q.apply_defaults(slim, as_of(p))


def _dirty_posts(spark, sf_dir):
    p = posts(spark, sf_dir)
    k = F.col("retweet_count")
    kind = F.split("text", " ").getItem(0)
    dirty = p.select(
        F.when((kind == "view") & (k < 5), F.lit(None).cast("string")).otherwise(F.col("tweet_id")).alias("tweet_id"),
        "text",
        F.when((kind == "signup") & (k < 10), F.lit(None).cast("string")).otherwise(F.col("author")).alias("author"),
        "compound_score",
        F.when((kind == "error") & (k < 5), F.lit("mixed")).otherwise(F.col("sentiment")).alias("sentiment"),
        "processed_at",
    )
    again = p.filter(k == 1).select(
        "tweet_id", "text", "author", "compound_score", "sentiment", (F.col("processed_at") + X.interval("1 minute")).alias("processed_at")
    )
    return dirty.unionByName(again)


@register("quarantine")
def q_quarantine(spark, sf_dir):
    _, rejected = Q.quarantine(_dirty_posts(spark, sf_dir))
    return rejected.select("tweet_id", "author", "sentiment", "processed_at", "reasons")


@register("quarantine_valid")
def q_quarantine_valid(spark, sf_dir):
    valid, _ = Q.quarantine(_dirty_posts(spark, sf_dir))
    return valid.groupBy("sentiment").agg(F.count(F.lit(1)).alias("n"), F.max("processed_at").alias("latest"))


@register("table_counts")
def q_table_counts(spark, sf_dir):
    return TB.table_counts({t: table(spark, sf_dir, t) for t in TB.TEST_TABLES})


@register("first_nonempty_source")
def q_first_nonempty_source(spark, sf_dir):
    p = posts(spark, sf_dir).select("tweet_id", "hashtags")
    live = FL.tag_overlap(p, ["nosuchtag"])
    cookie = FL.tag_overlap(p, ["click"])
    return TB.first_nonempty([("live", live), ("twitter", cookie), ("mock", p)]).select("tweet_id", "source_used")


# ================================================================ scoring


def _en_docs(spark, sf_dir):
    return FL.filter_text_lang(table(spark, sf_dir, "documents"), ["en"]).select("doc_id", "text")


@register("corpus_lexicon")
def q_corpus_lexicon(spark, sf_dir):
    return SC.corpus_lexicon(_en_docs(spark, sf_dir))


@register("lexicon_score")
def q_lexicon_score(spark, sf_dir):
    docs = _en_docs(spark, sf_dir)
    return SC.lexicon_score(docs, SC.corpus_lexicon(docs), "doc_id")


@register("score_and_label")
def q_score_and_label(spark, sf_dir):
    docs = _en_docs(spark, sf_dir)
    s = SC.lexicon_score(docs, SC.corpus_lexicon(docs), "doc_id")
    return s.select("doc_id", "compound_score", X.label_expr("compound_score").alias("sentiment"))


@register("lexicon_score_udf")
def q_lexicon_score_udf(spark, sf_dir):
    docs = _en_docs(spark, sf_dir)
    score = SC.lexicon_score_udf(spark, SC.corpus_lexicon(docs))
    return score.rows(docs, key="doc_id").select("doc_id", "compound_score")


# ================================================================= merges


def _base_and_batch(spark, sf_dir):
    """Base = posts before t2; batch = posts from t1 re-scored (+1 h) plus a second,
    later copy (+2 h, score 0) of the overlap [t1, t2), so the batch has conflicts,
    new keys and in-batch duplicates."""
    p = posts(spark, sf_dir)
    t = as_of(p)
    t1, t2 = t - X.interval("15 days"), t - X.interval("10 days")
    base = p.filter(F.col("processed_at") < t2)
    neg = F.lit(0.0) - F.col("compound_score")
    upd = p.filter(F.col("processed_at") >= t1).withColumns(
        {"compound_score": neg, "sentiment": X.label_expr(neg), "processed_at": F.col("processed_at") + X.interval("1 hour")}
    )
    again = (
        p.filter((F.col("processed_at") >= t1) & (F.col("processed_at") < t2))
        .withColumn("compound_score", F.lit(0.0))
        .withColumn("sentiment", F.lit("neutral"))
        .withColumn("processed_at", F.col("processed_at") + X.interval("2 hours"))
    )
    return p, base, upd.unionByName(again), t2


@register("upsert_partial")
def q_upsert_partial(spark, sf_dir):
    _, base, batch, _ = _base_and_batch(spark, sf_dir)
    return M.upsert_partial(base, batch)


@register("insert_if_absent")
def q_insert_if_absent(spark, sf_dir):
    _, base, batch, _ = _base_and_batch(spark, sf_dir)
    return M.insert_if_absent(base, batch)


def _bucketed(spark, sf_dir, policy):
    """The base loaded into a bucketed table, then the batch upserted."""
    import uuid

    from sentiflow.operators.bucketed import BucketedTable
    from sentiflow.session import scratch_path

    _, base, batch, _ = _base_and_batch(spark, sf_dir)
    schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in base.schema)
    table = BucketedTable.create(spark, scratch_path(spark, f"sentiflow-runs/{uuid.uuid4().hex}/posts"), schema, buckets=16)
    table.upsert(base, policy)
    table.upsert(batch, policy)
    return table.current()


@register("bucketed_upsert")
def q_bucketed_upsert(spark, sf_dir):
    return _bucketed(spark, sf_dir, "update")


@register("bucketed_insert")
def q_bucketed_insert(spark, sf_dir):
    return _bucketed(spark, sf_dir, "first")


@register("rolling_upsert")
def q_rolling_upsert(spark, sf_dir):
    p, base, _, t2 = _base_and_batch(spark, sf_dir)
    old = snapshot_series(base, "5 minutes", "1 minute")
    recent = p.filter(F.col("processed_at") >= t2 - X.interval("1 day"))
    new = snapshot_series(recent, "5 minutes", "1 minute").withColumn("computed_at", F.col("computed_at") + X.interval("1 minute"))
    return M.snapshot_upsert(old, new)


@register("refresh_per_minute")
def q_refresh_per_minute(spark, sf_dir):
    """Stored partials of the base, refreshed by a batch that re-scores posts and adds new ones."""
    _, base, batch, _ = _base_and_batch(spark, sf_dir)
    return M.finish_series(M.refresh_partials(M.series_partials(base), base, batch))


@register("refresh_top_hashtags")
def q_refresh_top_hashtags(spark, sf_dir):
    _, base, batch, _ = _base_and_batch(spark, sf_dir)
    tags = M.refresh_partials(M.hashtag_partials(base), base, batch, M.hashtag_partials, M.HASHTAG_KEYS)
    return M.finish_hashtags(tags).orderBy(F.desc("mention_count"), "hashtag").limit(20)


@register("explorer_rows")
def q_explorer_rows(spark, sf_dir):
    return TK.explorer_rows(posts(spark, sf_dir), "negative")


@register("bound_query")
def q_bound_query(spark, sf_dir):
    text = """SELECT sentiment, count(*) AS n, max(processed_at) AS latest FROM bound_posts
              WHERE source = :source AND like_count >= :likes GROUP BY sentiment"""
    return TB.bound_query(spark, text, {"bound_posts": posts(spark, sf_dir)}, {"source": "events", "likes": 100})


@register("snapshot_violations")
def q_snapshot_violations(spark, sf_dir):
    """Snapshots with a class out of the enum, a missing count and a repeated key put in."""
    snaps = snapshot_series(posts(spark, sf_dir), "1 hour", "1 hour")
    hour = F.hour("window_end")
    dirty = snaps.withColumns(
        {
            "sentiment": F.when((hour == 3) & (F.col("sentiment") == "neutral"), F.lit("mixed")).otherwise(F.col("sentiment")),
            "tweet_count": F.when(hour == 5, F.lit(None)).otherwise(F.col("tweet_count")),
        }
    )
    again = snaps.filter(hour == 7)
    return Q.snapshot_violations(dirty.unionByName(again)).select("window_end", "sentiment", "tweet_count", "reasons")


# =============================================================== keywords

TRACKED = ["click", "error", "#Purchase", "k3", "nosuchkey"]
BACKUPS = ["signup", "view", "click"]


@register("keyword_activity")
def q_keyword_activity(spark, sf_dir):
    return KW.keyword_activity(posts(spark, sf_dir), KW.keyword_dim(spark, TRACKED))


def _silent(spark, sf_dir):
    p = posts(spark, sf_dir)
    kw = KW.keyword_dim(spark, TRACKED)
    act = KW.keyword_activity(p, kw)
    started = X.ts_literal(p.select(F.min("processed_at")).first()[0])
    return KW.silent_keywords(act, kw, as_of(p), 60, connected_at=started)


@register("silent_keywords")
def q_silent_keywords(spark, sf_dir):
    return _silent(spark, sf_dir)


@register("rotation_plan")
def q_rotation_plan(spark, sf_dir):
    return KW.rotation_plan(_silent(spark, sf_dir), KW.keyword_dim(spark, BACKUPS), cursor=0)


# ================================================================= health


@register("freshness")
def q_freshness(spark, sf_dir):
    p = posts(spark, sf_dir)
    return H.freshness(p, as_of(p), by=["author"], stale_seconds=3600)


def _offsets(spark, sf_dir):
    """Per topic partition (keyed by event type) offsets: high = rows, committed = rows older than 6 h."""
    p = posts(spark, sf_dir)
    t = as_of(p)
    part = F.split("text", " ").getItem(0)
    return p.groupBy(part.alias("partition")).agg(
        F.lit(0).cast("bigint").alias("low"),
        F.nullif(F.count_if(F.col("processed_at") < t - X.interval("6 hours")), F.lit(0)).alias("committed"),
        F.count(F.lit(1)).alias("high"),
    )


@register("backlog_by_partition")
def q_backlog_by_partition(spark, sf_dir):
    return H.partition_lag(_offsets(spark, sf_dir))


@register("backlog_total")
def q_backlog_total(spark, sf_dir):
    return H.backlog(_offsets(spark, sf_dir))


@register("batch_throughput")
def q_batch_throughput(spark, sf_dir):
    p = posts(spark, sf_dir)
    start = X.ts_literal(p.select(F.min("processed_at")).first()[0])
    batch = F.floor(F.timestamp_diff("MICROSECOND", start, F.col("processed_at")) / F.lit(3_600_000_000)).cast("bigint")
    progress = p.groupBy(batch.alias("batch_id")).agg(F.count(F.lit(1)).alias("num_input_rows"))
    return H.batch_throughput(progress, block_size=64)


@register("rule_score")
def q_rule_score(spark, sf_dir):
    from sentiflow.functions.rules import rule_score

    docs = _en_docs(spark, sf_dir)
    return rule_score(docs, SC.corpus_lexicon(docs), "doc_id")


def _rest_raw(spark, sf_dir):
    """REST-shaped raw posts derived from events: empty ids, author object vs user object,
    zero follower counts, both date spellings, hashtag objects mixed with plain strings."""
    p = posts(spark, sf_dir).withColumn("_etype", F.split("text", " ").getItem(0))
    et = F.col("_etype")
    iso = F.date_format("tweet_created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'")
    # First tag as an object {text}, second as a plain string (variant values keep both JSON shapes).
    tags = F.when(
        F.size("hashtags") > 0,
        F.array(
            F.parse_json(F.to_json(F.struct(F.element_at("hashtags", 1).alias("text")))),
            F.parse_json(F.concat(F.lit('"'), F.element_at("hashtags", 2), F.lit('"'))),
        ),
    )
    raw = F.struct(
        F.when(et == "view", F.lit("")).otherwise(F.col("tweet_id")).alias("id"),
        F.col("tweet_id").alias("id_str"),
        F.col("text"),
        F.when(et != "signup", F.struct(F.col("author").alias("userName"),
                                        F.when(et == "purchase", F.lit(0).cast("bigint")).otherwise(F.col("author_followers")).alias("followers"))).alias("author"),
        F.when(et != "signup", F.struct(F.col("author").alias("screen_name"), F.col("author_followers").alias("followers_count"))).alias("user"),
        F.col("lang"),
        F.when(et != "click", iso).alias("createdAt"),
        F.when(et == "click", iso).alias("created_at"),
        F.when(tags.isNotNull(), F.struct(tags.alias("hashtags"))).alias("entities"),
        F.when(et == "error", F.col("retweet_count")).alias("retweetCount"),
        F.when(et != "error", F.col("retweet_count")).alias("retweet_count"),
        F.when(et == "view", F.col("like_count")).alias("likeCount"),
        F.when(et != "view", F.col("like_count")).alias("favorite_count"),
    )
    return p, p.select("tweet_id", F.to_json(raw).alias("value"))


@register("normalize_rest")
def q_normalize_rest(spark, sf_dir):
    p, raw = _rest_raw(spark, sf_dir)
    return N.normalize_posts(raw, "rest", as_of(p), keep=["tweet_id"])


@register("normalize_scrape")
def q_normalize_scrape(spark, sf_dir):
    p = posts(spark, sf_dir).withColumn("_etype", F.split("text", " ").getItem(0))
    et = F.col("_etype")
    raw = F.struct(
        F.col("tweet_id").alias("id"),
        F.col("text"),
        F.when(et == "signup", F.lit("")).otherwise(F.col("author")).alias("username"),
        F.col("author_followers").alias("followersCount"),
        F.when(et != "error", F.col("lang")).alias("lang"),
        F.date_format("tweet_created_at", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'").alias("timeParsed"),
        F.when(F.size("hashtags") > 0, F.col("hashtags")).alias("hashtags"),
        F.col("retweet_count").alias("retweetCount"),
        F.col("like_count").alias("likeCount"),
    )
    raw_df = p.select("tweet_id", F.to_json(raw).alias("value"))
    return N.normalize_posts(raw_df, "scrape", as_of(p), keep=["tweet_id"])


@register("stats_bundle_json")
def q_stats_bundle_json(spark, sf_dir):
    from sentiflow.plans.bundles import bundle_json, stats_bundle

    p = posts(spark, sf_dir)
    return bundle_json(stats_bundle(p, snapshot_series(p, "5 minutes", "1 minute"), as_of(p), 60))


@register("parse_tag_list")
def q_parse_tag_list(spark, sf_dir):
    """Request-parameter parsing over strings built from every event: tag lists with
    '#', blanks and empty items, and limit strings with junk suffixes or none."""
    ev = table(spark, sf_dir, "events")
    k = F.get_json_object("props", "$.k").try_cast("int")
    raw_tags = F.concat(F.lit(" #"), F.col("event_type"), F.lit(" ,k"), (k % 10).cast("string"), F.lit(",, ##x,#"))
    raw_limit = F.when(F.col("event_type") == "view", F.lit("abc")).otherwise(
        F.concat((k * 3).cast("string"), F.when(F.col("event_type") == "click", F.lit("px")).otherwise(F.lit("")))
    )
    return ev.select(
        F.col("event_id"),
        X.parse_tag_list(raw_tags).alias("tags"),
        X.clamp_int(raw_limit, 50, 200).alias("limit_value"),
    )


def _nodes(spark, sf_dir):
    """Posts, their stored time nodes and the newest time."""
    import uuid

    from sentiflow.operators.rollup import build_nodes
    from sentiflow.session import scratch_path

    p = posts(spark, sf_dir)
    path = build_nodes(p, scratch_path(spark, f"sentiflow-runs/{uuid.uuid4().hex}/nodes"))
    return p, spark.read.parquet(path), p.select(F.max("processed_at")).first()[0]


@register("node_rolling_avg")
def q_node_rolling_avg(spark, sf_dir):
    from sentiflow.operators.rollup import rolling_avg_from_nodes

    p, nodes, now = _nodes(spark, sf_dir)
    return rolling_avg_from_nodes(nodes, p, now, dt.timedelta(hours=1))


@register("node_window_kpis")
def q_node_window_kpis(spark, sf_dir):
    """KPIs of nine days and some seconds, up to a day before the newest post."""
    from sentiflow.operators.rollup import window_kpis

    p, nodes, now = _nodes(spark, sf_dir)
    return window_kpis(nodes, p, now, dt.timedelta(days=9, seconds=4321), now - dt.timedelta(days=1))


@register("cuboid_kpis")
def q_cuboid_kpis(spark, sf_dir):
    """KPIs per hour of one language's positive and negative posts, from the smallest cuboid."""
    import uuid

    from sentiflow.operators.rollup import Cuboids, build_cuboids
    from sentiflow.session import scratch_path

    p = posts(spark, sf_dir)
    path = build_cuboids(p, scratch_path(spark, f"sentiflow-runs/{uuid.uuid4().hex}/cuboids"))
    return Cuboids(spark.read.parquet(path)).answer(p, {"lang": ["en"], "sentiment": ["positive", "negative"]}, ["hour"])[0]


def _postings(spark, sf_dir):
    """The posting lists of the posts, in two batches."""
    import uuid

    from sentiflow.operators.postings import Postings, append_postings
    from sentiflow.session import scratch_path

    p, path = posts(spark, sf_dir), scratch_path(spark, f"sentiflow-runs/{uuid.uuid4().hex}/postings")
    early = F.col("retweet_count") % 3 == 0
    append_postings(p.filter(early), path, files=16, batch="0")
    append_postings(p.filter(~early), path, files=16, batch="1")
    return Postings(spark, path)


@register("tag_index_search")
def q_tag_index_search(spark, sf_dir):
    return _postings(spark, sf_dir).rows(SEARCH_TAGS).select("tweet_id", "hashtags")


@register("posting_feed")
def q_posting_feed(spark, sf_dir):
    return _postings(spark, sf_dir).search(SEARCH_TAGS, SEARCH_CLASS, SEARCH_LIMIT)["data"]


@register("posting_counts")
def q_posting_counts(spark, sf_dir):
    return _postings(spark, sf_dir).search(SEARCH_TAGS, None, SEARCH_LIMIT)["summary"]


@register("trailing_window_partitioned")
def q_trailing_window_partitioned(spark, sf_dir):
    """FLT-03 over a date-partitioned, time-sorted posts table: the bound prunes partitions."""
    import uuid

    from sentiflow.session import scratch_path

    p = posts(spark, sf_dir)
    path = TB.write_posts_table(p, scratch_path(spark, f"sentiflow-runs/{uuid.uuid4().hex}/posts"), files=16)
    stored = spark.read.parquet(path)
    return FL.trailing_window(stored, as_of(stored), "24 hours", date_col="dt").select("tweet_id", "processed_at", "sentiment")


@register("filtered_feed")
def q_filtered_feed(spark, sf_dir):
    """Feed endpoint with raw request parameters: tags '#click, k3,', class 'negative', limit '500' (-> 200)."""
    return TK.filtered_feed(posts(spark, sf_dir), "#click, k3,", "negative", "500")["data"]
