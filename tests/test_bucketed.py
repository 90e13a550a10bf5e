import datetime as dt
import tempfile

import pytest
from conftest import AS_OF, POSTS_DDL, make_posts
from pyspark.sql import functions as F

from sentiflow.operators import merge as M
from sentiflow.operators.bucketed import BucketedSink, BucketedTable
from sentiflow.streaming import files

H = dt.timedelta(hours=1)


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def _table(spark, buckets=8):
    return BucketedTable.create(spark, tempfile.mkdtemp(prefix="sentiflow-test-"), POSTS_DDL, buckets=buckets)


def _base(n=60):
    return [dict(tweet_id=f"p{i}", text=f"t{i}", compound_score=0.5, sentiment="positive", processed_at=AS_OF) for i in range(n)]


def _batch():
    return [
        dict(tweet_id="p3", text="other", compound_score=-0.5, sentiment="negative", processed_at=AS_OF + H),
        dict(tweet_id="new", text="first", compound_score=0.1, sentiment="positive", processed_at=AS_OF + H),
        dict(tweet_id="new", text="second", compound_score=-0.2, sentiment="negative", processed_at=AS_OF + 2 * H),
        dict(tweet_id="p3", text="again", compound_score=None, sentiment="neutral", processed_at=AS_OF + 2 * H),
    ]


@pytest.mark.parametrize("policy, plain", [("update", M.upsert_partial), ("first", M.insert_if_absent)])
def test_upserts_equal_the_plain_merge_and_leave_other_buckets(spark, policy, plain):
    base, batch = make_posts(spark, _base()), make_posts(spark, _batch())
    table = _table(spark)
    assert len(table.upsert(base, policy)) == 8
    before = table.files()
    touched = table.upsert(batch, policy)
    after = table.files()
    assert _rows(table.current()) == _rows(plain(base, batch))
    assert 1 <= len(touched) <= 2 and all(len(f) == 1 for f in after.values())
    assert {b for b in before if before[b] != after[b]} == set(touched)
    assert table.upsert(batch, policy) == touched and _rows(table.current()) == _rows(plain(base, batch))
    assert table.upsert(batch.limit(0), policy) == []
    assert _rows(BucketedTable(spark, table.root).current()) == _rows(plain(base, batch))


def test_target_is_not_shuffled(spark):
    table = _table(spark)
    table.upsert(make_posts(spark, _base()))
    keyed = table._per_key(make_posts(spark, _batch()), "update", M.MUTABLE_COLUMNS, "processed_at").persist()
    keyed.count()
    joined = table.merged(keyed, [1, 2], "update")
    joined.collect()
    plan = joined._jdf.queryExecution().executedPlan().toString()
    final = plan.split("== Initial Plan ==")[0]
    assert "SelectedBucketsCount" in final or "Bucketed: true" in final, final
    above = final.split("InMemoryRelation")[0]
    assert "Exchange" not in above, above
    keyed.unpersist()


def test_interrupted_swap_is_finished(spark, monkeypatch):
    base, batch = make_posts(spark, _base()), make_posts(spark, _batch())
    table = _table(spark)
    table.upsert(base)
    monkeypatch.setattr(BucketedTable, "_finish_journal", lambda self: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError, match="lost"):
        table.upsert(batch)
    monkeypatch.undo()
    assert files.path_exists(spark, f"{table.root}/journal.json")
    again = BucketedTable(spark, table.root)
    assert _rows(again.current()) == _rows(M.upsert_partial(base, batch))
    assert not [n for n in files.children(spark, table.root) if n.startswith(("staging", "journal"))]


def test_null_keys_are_refused_and_rebucketing_keeps_rows(spark):
    table = _table(spark, 4)
    table.upsert(make_posts(spark, _base(20)))
    with pytest.raises(ValueError, match="without tweet_id"):
        table.upsert(make_posts(spark, [dict(tweet_id=None)]))
    other = table.rebucketed(tempfile.mkdtemp(prefix="sentiflow-test-"), 7)
    assert _rows(other.current()) == _rows(table.current()) and len(other.files()) <= 7
    other.upsert(make_posts(spark, _batch()))
    assert other.current().count() == 21


def test_sink_modes(spark):
    base, batch = make_posts(spark, _base(9) + [dict(tweet_id="bad", author=None)]), make_posts(spark, _batch()[:2])
    for policy, plain in (("update", M.upsert_partial), ("first", M.insert_if_absent)):
        sink = BucketedSink(tempfile.mkdtemp(prefix="sentiflow-test-"), policy, buckets=4)
        sink(base, 0)
        sink(batch, 1)
        sink(batch, 1)  # delivered again
        assert _rows(BucketedTable(spark, sink.root).current()) == _rows(plain(base.filter(F.col("tweet_id") != "bad"), batch))
        assert [r["tweet_id"] for r in spark.read.parquet(f"{sink.root}/rejects").collect()] == ["bad"]
