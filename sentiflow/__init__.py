"""sentiflow: Spark-native sentiment analytics over short text posts.

Every operator is a plain ``DataFrame -> DataFrame`` function (or a column
expression) that batch jobs and Structured Streaming micro-batches share.
Time-relative operators take an explicit ``as_of`` (a literal or a Column,
e.g. a scalar subquery) instead of reading the wall clock.
"""

from sentiflow.functions.expressions import label_expr, parse_tag_list, polarity_class
from sentiflow.functions.rules import RuleParams, rule_score
from sentiflow.functions.scoring import corpus_lexicon, lexicon_score, lexicon_score_udf
from sentiflow.operators.aggregates import (
    class_counts,
    class_shares,
    hashtag_by_sentiment,
    kpi_summary,
    kpi_unpivot,
    minute_of_day_pivot,
    per_bucket_series,
    positive_rate,
    rolling_avg,
    rolling_snapshot,
    series_pivot,
    time_series_recent,
    top_hashtags,
)
from sentiflow.operators.filters import by_class, filter_text_lang, keyword_match, tag_overlap, trailing_window
from sentiflow.operators.health import backlog, batch_throughput, freshness
from sentiflow.operators.keywords import keyword_activity, keyword_dim, rotation_plan, silent_keywords
from sentiflow.operators.latest import latest_per_key, rolling_latest
from sentiflow.operators.merge import insert_if_absent, refresh_series, snapshot_upsert, upsert_partial
from sentiflow.operators.quality import apply_defaults, canonical_posts, parse_created_at, quarantine
from sentiflow.operators.tag_index import build_tag_index, tag_search
from sentiflow.operators.topk import accumulate_feed, feed_cards, filtered_feed, new_since, recent_posts, search_posts
from sentiflow.operators.windows import snapshot_series
from sentiflow.session import build_session, ensure_session_defaults, recommended_shuffle_partitions, shared_checkpoint_dir
from sentiflow.sources.json_codec import decode_json, encode_json, route_envelopes
from sentiflow.sources.normalize import normalize_posts
from sentiflow.sources.tables import first_nonempty, read_posts, table_counts, write_posts_table
from sentiflow.streaming.app import ingest_transform, start_ingest
from sentiflow.streaming.jobs import dedup_stream, run_stream, silent_keyword_stream, sliding_window_sentiment, stream_per_bucket
from sentiflow.streaming.sink import FeedSink, PostsLogSink, compact_log, current_feed, current_posts, current_snapshots

__all__ = [name for name in dir() if not name.startswith("_")]
