import datetime as dt

from pyspark.sql import functions as F

from conftest import AS_OF, SF_SMALL, make_posts
from sentiflow.functions import scoring as SC
from sentiflow.operators import health as H
from sentiflow.operators import keywords as KW
from sentiflow.plans.inputs import posts as load_posts
from sentiflow.sources.tables import load_table


def _lexicon(spark):
    return spark.createDataFrame([("good", 1.9), ("great", 3.1), ("bad", -2.5), ("awful", -3.4)], "token string, valence double")


def test_lexicon_score_values_and_bounds(spark):
    docs = spark.createDataFrame([(1, "Good, GREAT day"), (2, "bad"), (3, ""), (4, None), (5, "nothing here")], "doc_id long, text string")
    got = {r["doc_id"]: r["compound_score"] for r in SC.lexicon_score(docs, _lexicon(spark), "doc_id").collect()}
    s = 5.0
    assert got[1] == round(s / (s * s + 15) ** 0.5, 4)
    assert got[2] == round(-2.5 / (2.5 * 2.5 + 15) ** 0.5, 4)
    assert got[3] == 0.0 and got[4] == 0.0 and got[5] == 0.0
    assert all(-1 <= v <= 1 for v in got.values())


def test_lexicon_score_odd_symmetry(spark):
    docs = spark.createDataFrame([(1, "good bad great"), (2, "awful awful good")], "doc_id long, text string")
    lex = _lexicon(spark)
    neg = lex.select("token", (-F.col("valence")).alias("valence"))
    a = {r[0]: r[1] for r in SC.lexicon_score(docs, lex, "doc_id").select("doc_id", "compound_score").collect()}
    b = {r[0]: r[1] for r in SC.lexicon_score(docs, neg, "doc_id").select("doc_id", "compound_score").collect()}
    assert all(a[k] == -b[k] for k in a)


def test_scores_every_row(spark):
    """Rows that share an id or have none are scored one by one, by both relational scorers."""
    from sentiflow.functions.rules import rule_score, with_rule_score

    rows = [("1", "good"), ("1", "bad"), ("1", "bad"), (None, "good"), (None, "great"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    one = {t: v / (v * v + 15) ** 0.5 for t, v in {"good": 1.9, "great": 3.1, "bad": -2.5, None: 0.0}.items()}
    want = sorted((str(i), round(one[t], 4)) for i, t in rows)
    assert sorted((str(r[0]), r[1]) for r in SC.lexicon_score(docs, _lexicon(spark), "doc_id").collect()) == want
    assert sorted((str(r[0]), r[1]) for r in rule_score(docs, _lexicon(spark), "doc_id").collect()) == want
    for add in (SC.with_lexicon_score, with_rule_score):
        got = sorted((str(r["doc_id"]), r["compound_score"]) for r in add(docs, _lexicon(spark)).collect())
        assert got == want


def test_udf_scorer_matches_relational(spark):
    docs = load_table(spark, SF_SMALL, "documents").filter("lang = 'en'").select("doc_id", "text")
    lex = SC.corpus_lexicon(docs, 200)
    rel = {r["doc_id"]: r["compound_score"] for r in SC.lexicon_score(docs, lex, "doc_id").collect()}
    for block in (200_000, 90):  # a lexicon larger than a block takes several UDFs
        udf = SC.lexicon_score_udf(spark, lex, block=block)
        row = {r["doc_id"]: r["s"] for r in docs.select("doc_id", udf("text").alias("s")).collect()}
        assert rel == row


def test_keyword_activity_matches_brute_force(spark):
    """Post rows count, also repeated ones; a keyword listed twice counts once; needles of any length."""
    p = load_posts(spark, SF_SMALL)
    p = p.unionByName(p.limit(50))
    words = ["click", "#Purchase", "k3", "ew k", "ck", "k", "nosuchkey", "click"]
    got = {r["keyword"]: (r["matches"], r["last_seen"]) for r in KW.keyword_activity(p, KW.keyword_dim(spark, words)).collect()}
    rows, want = p.select("text", "hashtags", "processed_at").collect(), {}
    for w in set(words):
        needle = w.lower().lstrip("#")
        hits = [r["processed_at"] for r in rows if needle in [h.lower() for h in r["hashtags"]] or needle in r["text"].lower()]
        if hits:
            want[w] = len(hits), max(hits)
    assert got == want and len(got) == 6


def test_rotation_plan_cases(spark):
    status = spark.createDataFrame(
        [("a", 0, True), ("b", 1, False), ("c", 2, True), ("d", 3, True)], "keyword string, position int, silent boolean"
    )
    backups = KW.keyword_dim(spark, ["b", "x", "y"])
    plan = {r["keyword"]: r["new_keyword"] for r in KW.rotation_plan(status, backups, cursor=2).collect()}
    # from cursor 2: a takes y, c passes b (tracked) and takes x, and for d none is left that is not tracked
    assert plan == {"a": "y", "b": "b", "c": "x", "d": "d"}
    # a swapped out keyword is free again for a later one
    free = KW.keyword_dim(spark, ["x", "a"])
    assert [r["new_keyword"] for r in KW.rotation_plan(status, free, 0).orderBy("position").collect()] == ["x", "b", "a", "d"]
    none_left = KW.keyword_dim(spark, ["a", "b"])
    plan2 = {r["keyword"]: r["new_keyword"] for r in KW.rotation_plan(status, none_left, cursor=0).collect()}
    assert plan2 == {"a": "a", "b": "b", "c": "c", "d": "d"}


def test_keyword_machine_blocks_and_overlaps(spark):
    """Needles inside each other, shared needles, tags against texts, many blocks: as the match predicate over all pairs."""
    import random

    from pyspark.sql import functions as F

    from sentiflow.functions.expressions import keyword_hits, keyword_needle

    rng = random.Random(8)
    words = ["a", "ab", "abc", "bc", "#Bc", "bc", "c", "é", "ÉA", "cab c", "##abca", "zz"]
    rows = [dict(tweet_id=str(i), text="".join(rng.choice("abcéÉ ") for _ in range(rng.randint(0, 12))) or None, hashtags=rng.choice([None, [], ["BC", None], ["zz", "Zz"], ["xabc"]])) for i in range(150)]
    posts = make_posts(spark, rows + rows[:9])
    kw = KW.keyword_dim(spark, words)
    pairs = posts.crossJoin(kw.select("keyword").distinct()).filter(keyword_hits(keyword_needle("keyword"), "hashtags", "text"))
    wanted = sorted(tuple(r) for r in pairs.select("keyword", "tweet_id", "processed_at").collect())
    for block in (1 << 20, 4):
        machine = KW.KeywordMachine(kw, block)
        assert sorted(tuple(r) for r in KW.keyword_matches(posts, machine).collect()) == wanted
    assert len(machine.blocks) > 3
    assert "Exchange" not in KW.keyword_matches(posts, machine)._jdf.queryExecution().executedPlan().toString()
    assert KW.keyword_matches(posts, kw.limit(0)).count() == 0


def test_a_hundred_thousand_keywords(spark):
    from pyspark.sql import functions as F

    kw = spark.range(100_000).select(F.concat(F.lit("word"), F.col("id").cast("string"), F.lit("x")).alias("keyword"), F.col("id").cast("int").alias("position"))
    posts = make_posts(spark, [dict(tweet_id=str(i), text=f"says word{i * 37}x and aword{i}x!") for i in range(500)])
    got = KW.keyword_activity(posts, kw)
    assert got.agg(F.sum("matches")).first()[0] == 500 * 2 - 1  # the first text says one word twice


def test_silent_keywords_seeded_clock(spark):
    df = make_posts(spark, [dict(text="click here", processed_at=AS_OF - dt.timedelta(seconds=30))])
    kw = KW.keyword_dim(spark, ["click", "never"])
    act = KW.keyword_activity(df, kw)
    out = {r["keyword"]: r for r in KW.silent_keywords(act, kw, AS_OF, 60, connected_at=AS_OF - dt.timedelta(seconds=90)).collect()}
    assert out["click"]["silent"] is False and out["click"]["idle_seconds"] == 30
    assert out["never"]["silent"] is True and out["never"]["idle_seconds"] == 90


def test_backlog_cases(spark):
    offs = spark.createDataFrame(
        [(0, 10, -1, 100), (1, 0, 50, 50), (2, 0, 80, 60), (3, 5, None, 20)], "partition int, low long, committed long, high long"
    )
    lags = {r["partition"]: r["lag"] for r in H.partition_lag(offs).collect()}
    assert lags == {0: 90, 1: 0, 2: 0, 3: 15}
    r = H.backlog(offs).first()
    assert r["total_lag"] == 105 and r["healthy"] is True and r["partitions"] == 4


def test_running_total_is_prefix_sum(spark):
    prog = spark.createDataFrame([(i, (i * 7) % 5) for i in range(100)], "batch_id long, num_input_rows long")
    got = [r["cumulative_rows"] for r in H.batch_throughput(prog, block_size=8).orderBy("batch_id").collect()]
    expect, acc = [], 0
    for i in range(100):
        acc += (i * 7) % 5
        expect.append(acc)
    assert got == expect


def test_freshness_expected_groups(spark):
    df = make_posts(spark, [dict(source="live", processed_at=AS_OF - dt.timedelta(seconds=10))])
    expected = spark.createDataFrame([("live",), ("mock",)], "source string")
    out = {r["source"]: r for r in H.freshness(df, AS_OF, by=["source"], expected=expected).collect()}
    assert out["live"]["healthy"] is True and out["live"]["age_seconds"] == 10.0
    assert out["mock"]["healthy"] is False and out["mock"]["age_seconds"] is None
