import datetime as dt
import random
import tempfile

import pytest
from conftest import AS_OF, make_posts
from pyspark.sql import functions as F

from sentiflow.streaming import levels as L
from sentiflow.streaming.files import children, write_partition

DDL = "k string, n bigint"


def _batch(spark, path, i):
    rows = [(random.Random(i).choice("ab"), i), ("c", 1)]
    write_partition(spark.createDataFrame(rows, DDL).withColumn("batch_id", F.lit(i).cast("bigint")).coalesce(1), path)


def _merge(df):
    return df.groupBy("k").agg(F.sum("n").alias("n"))


def _sums(df):
    return sorted(tuple(r) for r in _merge(df).collect())


def test_folds_keep_sums_and_few_folders(spark):
    """Equal sums before, between and after folds; a batch written again while folds exist; few folders; versions up to a batch."""
    path = tempfile.mkdtemp(prefix="sentiflow-test-") + "/t"
    held = []
    for i in range(30):
        _batch(spark, path, i)
        if i % 3 == 0:
            before = _sums(L.read_levels(spark, path, DDL))
            reader = L.read_levels(spark, path, DDL)
            L.fold(spark, path, DDL, _merge, fan=3)
            assert _sums(reader) == before  # a reader that began before the fold
            _batch(spark, path, i)  # the newest batch is delivered again
            assert _sums(L.read_levels(spark, path, DDL)) == before
        held.append(len(L.live_folders(spark, path)))
    assert _sums(L.read_levels(spark, path, DDL)) == sorted([("c", 30), *[(k, sum(i for i in range(30) if random.Random(i).choice("ab") == k)) for k in "ab"]])
    assert max(held) <= 9 and held[-1] <= 7  # at most two folds a level and the batches since
    assert sum(n.startswith("batch_id=") for n in children(spark, path)) <= 9  # replaced folders are gone


def test_fold_cut_short_does_not_count(spark, monkeypatch):
    path = tempfile.mkdtemp(prefix="sentiflow-test-") + "/t"
    for i in range(7):
        _batch(spark, path, i)
    wanted = _sums(L.read_levels(spark, path, DDL))
    monkeypatch.setattr(L, "_write_manifest", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        L.fold(spark, path, DDL, _merge, fan=3)
    assert _sums(L.read_levels(spark, path, DDL)) == wanted
    monkeypatch.undo()
    assert L.fold(spark, path, DDL, _merge, fan=3) == 2 and L.fold(spark, path, DDL, _merge, fan=3) == 0
    assert _sums(L.read_levels(spark, path, DDL)) == wanted


def test_stream_tables_read_the_same_through_folds(spark):
    from sentiflow.streaming import jobs as SJ

    run, h = tempfile.mkdtemp(prefix="sentiflow-test-"), dt.timedelta(hours=1)
    sink = SJ.BatchLog(f"{run}/partials", lambda b: SJ.series_partials(b, "minute"))
    for i in range(10):
        sink(make_posts(spark, [dict(tweet_id=f"{i}{j}", compound_score=0.1, processed_at=AS_OF + (i % 4) * h) for j in range(2)]), i)
    before = sorted(tuple(r) for r in SJ.stream_per_bucket(spark, run).collect())
    assert SJ.fold_partials(spark, run) == 1 and len(L.live_folders(spark, f"{run}/partials")) == 3
    assert sorted(tuple(r) for r in SJ.stream_per_bucket(spark, run).collect()) == before and len(before) == 4
    spans = SJ.BatchLog(f"{run}/activity", lambda b: b)
    for i in range(9):
        rows = [("x", i % 3, AS_OF + i * h, AS_OF + i * h), (None, None, AS_OF, AS_OF + i * h)]
        spans(spark.createDataFrame(rows, SJ.SPANS_DDL), i)
    before = sorted(tuple(r) for r in SJ.silent_keyword_stream(spark, run, 600).collect())
    assert SJ.fold_activity(spark, run) == 1
    assert sorted(tuple(r) for r in SJ.silent_keyword_stream(spark, run, 600).collect()) == before
