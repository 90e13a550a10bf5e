import datetime as dt
import itertools
import random
import tempfile

import pytest
from conftest import AS_OF, make_posts
from pyspark.sql import functions as F

from sentiflow.operators import rollup as R
from sentiflow.operators.aggregates import kpi_summary, rolling_avg

COLUMNS = ["total_tweets", "positive_count", "negative_count", "neutral_count", "positive_pct", "avg_compound_score", "avg_lag_seconds"]


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.fixture(scope="module")
def posts(spark):
    rng, rows = random.Random(2), []
    for i in range(700):
        at = AS_OF - dt.timedelta(seconds=rng.choice([rng.randint(0, 400), rng.randint(0, 9_000), rng.randint(0, 400_000)]), microseconds=rng.choice([0, 1, 500]))
        score = rng.choice([None, round(rng.uniform(-1, 1), 4)])
        label = rng.choice(["positive", "negative", "neutral"])
        made = rng.choice([None, at - dt.timedelta(milliseconds=rng.randint(0, 99_999))])
        rows.append(dict(tweet_id=str(i), processed_at=at if i % 50 else None, compound_score=score, sentiment=label, tweet_created_at=made,
                         source=rng.choice(["x", "y", None]), lang=rng.choice(["en", "es", None]), author=rng.choice("ab")))
    rows += [dict(tweet_id=f"edge{i}", processed_at=AS_OF.replace(minute=0, second=0) - dt.timedelta(hours=i)) for i in range(30)]
    return make_posts(spark, rows).persist()


def _direct(posts, lower, upper=None):
    kept = posts.filter(F.col("processed_at") >= F.lit(lower))
    return kpi_summary(kept if upper is None else kept.filter(F.col("processed_at") <= F.lit(upper))).select(*COLUMNS)


def test_windows_from_nodes_equal_the_direct_aggregate(spark, posts):
    nodes = spark.read.parquet(R.build_nodes(posts, tempfile.mkdtemp(prefix="sentiflow-test-") + "/n")).persist()
    rng = random.Random(3)
    for seconds in (0, 1, 59, 60, 3599, 3600, 86_400, 100_000, 300_000, 10**7):
        now = AS_OF - dt.timedelta(seconds=rng.randint(0, 5000), microseconds=rng.choice([0, 1]))
        width = dt.timedelta(seconds=seconds)
        assert _rows(R.window_kpis(nodes, posts, now, width)) == _rows(_direct(posts, now - width))
        assert _rows(R.window_kpis(nodes, posts, now, width, now)) == _rows(_direct(posts, now - width, now))
    assert _rows(R.rolling_avg_from_nodes(nodes, posts, AS_OF, dt.timedelta(hours=1))) == _rows(rolling_avg(posts, AS_OF, "1 hour"))


def test_cover_leaves_nothing_out_and_takes_nothing_twice():
    rng = random.Random(4)
    base = dt.datetime(2024, 1, 1)
    for _ in range(3000):
        lower = base + dt.timedelta(seconds=rng.choice([rng.randint(0, 200), rng.randint(0, 10_000), rng.randint(0, 400_000)]))
        upper = lower + dt.timedelta(seconds=rng.choice([0, rng.randint(0, 100), rng.randint(0, 9000), rng.randint(0, 400_000)]))
        nodes, edges = R.cover(lower, upper)
        pieces = sorted([(a, b) for _, a, b in nodes] + [(a, b) for a, b, _ in edges])
        assert pieces[0][0] == lower and pieces[-1][1] == upper
        assert all(x[1] == y[0] for x, y in itertools.pairwise(pieces))
        assert all(R._floor(t, level) == t for level, a, b in nodes for t in (a, b))
        assert len(nodes) <= 5 and edges[-1][2]


def test_nodes_of_the_derived_stream(spark):
    from sentiflow.streaming.derive import refresh_derived, time_nodes
    from sentiflow.streaming.sink import PostsLogSink, current_posts

    root, h = tempfile.mkdtemp(prefix="sentiflow-test-"), dt.timedelta(hours=5)
    first = [dict(tweet_id=f"p{i}", compound_score=0.1 * i, sentiment="positive", processed_at=AS_OF + i * h, tweet_created_at=AS_OF) for i in range(8)]
    second = [dict(tweet_id=f"p{i}", compound_score=-0.5, sentiment="negative", processed_at=AS_OF + 9 * h) for i in (1, 4)]
    for i, rows in enumerate((first, second)):
        PostsLogSink(root)(make_posts(spark, rows), i)
        refresh_derived(spark, root, f"{root}/ckpt")
        now = current_posts(spark, root)
        for hours in (3, 26, 200):
            got = R.window_kpis(time_nodes(spark, root), now, AS_OF + 9 * h, dt.timedelta(hours=hours))
            assert _rows(got) == _rows(_direct(now, AS_OF + 9 * h - dt.timedelta(hours=hours)))


def test_cuboids_answer_every_slicer_set(spark, posts):
    path = R.build_cuboids(posts, tempfile.mkdtemp(prefix="sentiflow-test-") + "/c")
    cubes = R.Cuboids(spark.read.parquet(path).persist())
    assert len(cubes.sizes) == len(R.CUBOIDS)
    values = {"source": ["x", None], "lang": ["en"], "sentiment": ["positive", "neutral"], "hour": [AS_OF.replace(minute=0, second=0), None]}
    hours = posts.withColumn("hour", F.date_trunc("hour", "processed_at").cast("timestamp_ntz"))
    for n in range(len(values) + 1):
        for names in itertools.combinations(values, n):
            slicers = {c: values[c] for c in names}
            answer, by = cubes.answer(posts, slicers)
            kept = hours.filter(R._passes(slicers))
            assert by.startswith("cuboid") and _rows(answer) == _rows(kpi_summary(kept).select(*COLUMNS)), names
    assert cubes.answer(posts, {"lang": ["en"]})[1] == f"cuboid {R.grouping_number(['lang', 'sentiment'])}"
    answer, by = cubes.answer(posts, {"author": ["a"], "lang": ["en"]}, ["source"])
    assert by == "posts"
    wanted = [(s, *r) for s in ("x", "y", None, "test") for r in _rows(kpi_summary(posts.filter((F.col("author") == "a") & (F.col("lang") == "en") & F.col("source").eqNullSafe(F.lit(s)))).select(*COLUMNS))]
    assert _rows(answer) == sorted(wanted, key=str)
