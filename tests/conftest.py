import datetime as dt
import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
sys.path.insert(0, ROOT)

from sentiflow.schema import CANONICAL_COLUMNS  # noqa: E402
from sentiflow.session import build_session  # noqa: E402

SF_SMALL = "/root/testdata/sf0.001"
AS_OF = dt.datetime(2024, 1, 30, 12, 0, 0)

POSTS_DDL = (
    "tweet_id string, text string, author string, author_followers bigint, lang string, "
    "tweet_created_at timestamp_ntz, hashtags array<string>, hashtag_count int, retweet_count bigint, "
    "like_count bigint, compound_score double, sentiment string, source string, processed_at timestamp_ntz"
)


@pytest.fixture(scope="session")
def spark():
    s = build_session("local[4]", app_name="sentiflow-tests", shuffle_partitions=8)
    yield s
    s.stop()


def make_posts(spark, rows):
    """Canonical posts from partial dicts (missing fields get neutral test defaults)."""
    full = []
    for i, r in enumerate(rows):
        d = {
            "tweet_id": f"t{i}",
            "text": "hello",
            "author": "a",
            "author_followers": 0,
            "lang": "en",
            "tweet_created_at": None,
            "hashtags": [],
            "hashtag_count": None,
            "retweet_count": 0,
            "like_count": 0,
            "compound_score": 0.0,
            "sentiment": "neutral",
            "source": "test",
            "processed_at": AS_OF,
        }
        d.update(r)
        if d["hashtag_count"] is None:
            d["hashtag_count"] = len(d["hashtags"] or [])
        full.append(tuple(d[c] for c in CANONICAL_COLUMNS))
    return spark.createDataFrame(full, POSTS_DDL)


def seed_posts(spark):
    """The three seed posts of the reference schema, times relative to AS_OF."""
    m = dt.timedelta(minutes=1)
    return make_posts(
        spark,
        [
            dict(tweet_id="seed_001", author="sanjay_dev", author_followers=1200, tweet_created_at=AS_OF - 5 * m,
                 hashtags=["kafka", "spark", "python"], retweet_count=10, like_count=45, compound_score=0.82,
                 sentiment="positive", source="seed", processed_at=AS_OF - 1 * m),
            dict(tweet_id="seed_002", author="angry_devops", author_followers=800, tweet_created_at=AS_OF - 4 * m,
                 hashtags=["kafka", "devops"], retweet_count=3, like_count=8, compound_score=-0.72,
                 sentiment="negative", source="seed", processed_at=AS_OF - 1 * m),
            dict(tweet_id="seed_003", author="data_learner", author_followers=300, tweet_created_at=AS_OF - 3 * m,
                 hashtags=["pyspark", "bigdata"], retweet_count=1, like_count=12, compound_score=0.0,
                 sentiment="neutral", source="seed", processed_at=AS_OF - 1 * m),
        ],
    )
