"""Hypothesis properties: incremental refresh == full recompute, zero-filled totals add up,
scores stay in [-1, 1]."""

import datetime as dt

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from conftest import AS_OF, make_posts
from sentiflow.functions.scoring import lexicon_score
from sentiflow.operators import aggregates as A
from sentiflow.operators import merge as M

ROWS = st.lists(
    st.tuples(st.integers(0, 600), st.sampled_from([-0.9, -0.05, 0.0, 0.0499, 0.05, 0.7]), st.integers(0, 9)),
    min_size=1,
    max_size=25,
)


def _posts(spark, rows):
    from sentiflow.functions.expressions import label_expr

    df = make_posts(
        spark,
        [dict(tweet_id=f"p{i}", processed_at=AS_OF + dt.timedelta(seconds=s), compound_score=c, retweet_count=r)
         for i, (s, c, r) in enumerate(rows)],
    )
    return df.withColumn("sentiment", label_expr("compound_score"))


@settings(max_examples=6, deadline=None)
@given(ROWS, st.integers(0, 600))
def test_incremental_refresh_commutes(spark, rows, cut_s):
    df = _posts(spark, rows)
    cut = AS_OF + dt.timedelta(seconds=cut_s)
    inc = M.finish_series(M.refresh_series(M.series_partials(df.filter(F.col("processed_at") < cut)), df.filter(F.col("processed_at") >= cut)))
    full = A.per_bucket_series(df, "minute")
    assert sorted(tuple(r) for r in inc.collect()) == sorted(tuple(r) for r in full.collect())


@settings(max_examples=6, deadline=None)
@given(ROWS)
def test_zero_filled_totals_add_up(spark, rows):
    r = A.class_counts(_posts(spark, rows)).first()
    assert r["total"] == r["positive"] + r["negative"] + r["neutral"] == len(rows)


@settings(max_examples=6, deadline=None)
@given(st.lists(st.sampled_from(["good", "bad", "great", "awful", "meh", "GOOD"]), min_size=0, max_size=40))
def test_score_bounds(spark, words):
    lex = spark.createDataFrame([("good", 1.9), ("great", 3.1), ("bad", -2.5), ("awful", -3.4)], "token string, valence double")
    docs = spark.createDataFrame([(1, " ".join(words))], "doc_id long, text string")
    (r,) = lexicon_score(docs, lex, "doc_id").collect()
    assert -1.0 <= r["compound_score"] <= 1.0
