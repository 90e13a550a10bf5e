"""Scores over a lexicon of any size: lookups by groups of rows (functions.lookup)."""

import datetime as dt

import pytest
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from conftest import AS_OF, SF_SMALL, make_posts
from sentiflow.functions import lookup
from sentiflow.functions import scoring as SC
from sentiflow.functions.rules import rule_score
from sentiflow.plans.catalog import QUERIES

LEX = [("good", 1.0), ("good", 2.5), ("Bad", -2.0), ("not", None), ("très", 3.0), (None, 1.0)]


def _lexicon(spark):
    return spark.createDataFrame(LEX, "token string, valence double")


def _compound(s):
    return round(s / (s * s + 15) ** 0.5, 4)


@pytest.mark.parametrize("group_chars", [1, 2_000_000])
def test_rule_score_entries(spark, monkeypatch, group_chars):
    """A token with several entries counts with each, one without valence is a lexicon word all the same; rows in many groups or one."""
    monkeypatch.setattr(lookup, "GROUP_CHARS", group_chars)
    want = {
        "good": 3.5, "not good": 3.5, "never good": -0.74 * 3.5, "very BAD,": -2.0 - 0.733 - 0.293, "kind of good": 3.5, "": 0.0, None: 0.0,
        "so good": 3.5 + 2 * 0.293, "never so good": 1.25 * (3.5 + 2 * 0.293), "good but bad": 0.5 * 3.5 - 1.5 * 2.0, "(très) ...good...": 6.5, "x y z": 0.0,
    }
    rows = [(i, t) for i, t in enumerate(want)] * 2 + [(None, "good")]
    got = rule_score(spark.createDataFrame(rows, "id long, text string"), _lexicon(spark), "id").collect()
    assert sorted((str(r[0]), r[1]) for r in got) == sorted((str(i), _compound(want[t])) for i, t in rows)


@pytest.mark.parametrize("group_chars", [1, 2_000_000])
def test_udf_rows(spark, monkeypatch, group_chars):
    monkeypatch.setattr(lookup, "GROUP_CHARS", group_chars)
    rows = [(1, "Good, bad good"), (1, "Good, bad good"), (2, None), (None, ""), (3, "nothing")]
    lex = spark.createDataFrame([("good", 1.9), ("bad", -2.5), ("nothing", None)], "token string, valence double")
    got = SC.lexicon_score_udf(spark, lex).rows(spark.createDataFrame(rows, "id long, text string"), key="id").collect()
    assert sorted((str(r["id"]), r["text"] or "", r["compound_score"]) for r in got) == sorted(
        (str(i), t or "", _compound(1.3) if t and "bad" in t else 0.0) for i, t in rows
    )


def test_udf_query_collects_no_lexicon(spark, monkeypatch):
    def refuse(*_, **__):
        raise AssertionError("the lexicon went through the driver")

    monkeypatch.setattr(DataFrame, "toLocalIterator", refuse)
    got = {r[0]: r[1] for r in QUERIES["lexicon_score_udf"](spark, SF_SMALL).collect()}
    assert got == {r["doc_id"]: r["compound_score"] for r in QUERIES["lexicon_score"](spark, SF_SMALL).collect()}


def test_rule_score_shuffles_no_word_rows(spark):
    """What is joined with the lexicon are the distinct words of a group, however often they occur."""
    text = " ".join(["good bad not"] * 2000)
    docs = spark.createDataFrame([(i, text) for i in range(20)], "id long, text string")
    scored = rule_score(docs, _lexicon(spark), "id")
    plan = scored._jdf.queryExecution().optimizedPlan().toString()
    assert "posexplode" not in plan and plan.count("Join Inner") == 1
    joined = plan[plan.index("Join Inner") :].split("\n")[1]
    assert joined.strip(" :+-|").startswith("Aggregate [_group")
    assert scored.select("compound_score").distinct().count() == 1


def test_current_posts_of_some_columns(spark, tmp_path):
    from sentiflow.streaming.sink import current_posts

    late = AS_OF + dt.timedelta(minutes=1)
    for batch, rows in enumerate(([dict(tweet_id="a", lang="en"), dict(tweet_id="b", text="x")], [dict(tweet_id="a", lang="fr", compound_score=0.5, processed_at=late)])):
        make_posts(spark, rows).withColumn("batch_id", F.lit(batch).cast("bigint")).write.mode("append").partitionBy("batch_id").parquet(f"{tmp_path}/posts_log")
    whole = current_posts(spark, str(tmp_path))
    for columns in (("tweet_id", "lang", "compound_score"), ("tweet_id", "lang"), ("compound_score",), ("tweet_id",)):
        some = current_posts(spark, str(tmp_path), columns)
        assert some.columns == list(columns)
        assert sorted(map(tuple, some.collect())) == sorted(map(tuple, whole.select(*columns).collect()))
    plan = current_posts(spark, str(tmp_path), ("tweet_id", "lang"))._jdf.queryExecution().executedPlan().toString()
    assert "struct(lang" in plan and "struct(text" not in plan


def test_state_settings_hold_inside_only(spark):
    from sentiflow.streaming.derive import STATE_CONF, rocksdb_state

    before = {key: spark.conf.get(key, None) for key in STATE_CONF}
    with rocksdb_state(spark):
        assert {key: spark.conf.get(key) for key in STATE_CONF} == STATE_CONF
        assert spark.conf.get("spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled") == "true"
    assert {key: spark.conf.get(key, None) for key in STATE_CONF} == before
