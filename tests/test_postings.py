import datetime as dt
import random
import tempfile

import pytest
from conftest import AS_OF, make_posts
from pyspark.sql import functions as F

from sentiflow.operators.postings import Postings, append_postings
from sentiflow.operators.topk import search_posts


def _rows(df):
    return [tuple(r) for r in df.collect()]


def _posts(n=900):
    rng = random.Random(6)
    rows = []
    for i in range(n):
        tags = rng.choice([None, [], ["a"], ["a", "b"], ["b", "a", "a"], ["c"], ["B", "c", None], ["a"]])
        label = rng.choice(["positive", "negative", "neutral"])
        rows.append(dict(tweet_id=f"{i % 800:04}", hashtags=tags, sentiment=label, processed_at=AS_OF - dt.timedelta(minutes=rng.randint(0, 600)) if i % 97 else None))
    return rows


@pytest.fixture(scope="module")
def index(spark):
    posts = make_posts(spark, _posts()).persist()
    path = tempfile.mkdtemp(prefix="sentiflow-test-") + "/index"
    parts = [posts.filter(F.pmod(F.xxhash64("tweet_id", "processed_at"), F.lit(3)) == i) for i in range(3)]
    for i, part in enumerate(parts):
        append_postings(part, path, files=3, block=16, batch=f"b{i}")
    append_postings(parts[0], path, files=3, block=16, batch="b0")  # delivered again
    return posts, Postings(spark, path)


@pytest.mark.parametrize("tags", [["a"], ["b", "a"], ["a", "b", "c", "B"], ["nosuch"], ["nosuch", "c", ""]])
@pytest.mark.parametrize("label", [None, "negative"])
def test_search_equals_the_posts_table(index, tags, label):
    posts, postings = index
    for limit in (0, 7, 200):
        wanted, got = search_posts(posts, tags, label, limit), postings.search(tags, label, limit)
        assert _rows(got["data"]) == _rows(wanted["data"])
        assert _rows(got["summary"]) == _rows(wanted["summary"])


def test_newest_stops_early_and_the_bound_is_pushed(spark, index):
    _, postings = index
    found = postings.search(["a", "b"], None, 10)["data"]
    found.collect()
    bound = postings.bound(["a", "b"], None, 10)
    assert bound > AS_OF - dt.timedelta(minutes=300)
    plan = spark._jvm.PythonSQLUtils.explainString(found._jdf.queryExecution(), "formatted")
    assert "GreaterThanOrEqual(processed_at" in plan and "In(hashtag" in plan, plan
    assert postings.bound(["a"], None, 10_000) is None


def test_bad_requests(index):
    _, postings = index
    with pytest.raises(ValueError):
        postings.search([""], None)
    with pytest.raises(ValueError):
        postings.search(["a"], "angry")
