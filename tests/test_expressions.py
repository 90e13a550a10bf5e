from pyspark.sql import functions as F

from sentiflow.functions import expressions as X
from sentiflow.operators.topk import clamp_limit


def test_label_bounds_inclusive(spark):
    df = spark.createDataFrame([(0.05,), (-0.05,), (0.0499,), (-0.0499,), (1.0,), (-1.0,)], "s double")
    got = [r[0] for r in df.select(X.label_expr("s")).collect()]
    assert got == ["positive", "negative", "neutral", "neutral", "positive", "negative"]


def test_parse_tag_list(spark):
    df = spark.createDataFrame([("#a, b,,#c ,  ",), ("##x",), (None,), ("",)], "raw string")
    got = [r[0] for r in df.select(X.parse_tag_list("raw")).collect()]
    assert got == [["a", "b", "c"], ["#x"], [], []]


def test_clamp_limit_python_and_column(spark):
    assert clamp_limit(None) == 50
    assert clamp_limit("500") == 200
    assert clamp_limit("abc") == 50
    assert clamp_limit("12abc") == 12
    assert clamp_limit(30) == 30
    assert clamp_limit("-5") == 0
    df = spark.createDataFrame([("500",), ("abc",), ("12abc",), (None,)], "v string")
    assert [r[0] for r in df.select(X.clamp_int("v", 50, 200)).collect()] == [200, 50, 12, 50]


def test_pct_null_on_empty_and_exact_rounding(spark):
    df = spark.createDataFrame([(1, 3), (0, 0), (1, 8)], "p long, t long")
    got = [r[0] for r in df.select(X.pct(F.col("p"), F.col("t"), 2)).collect()]
    assert got == [33.33, None, 12.5]


def test_exact_avg_half_up(spark):
    # 0.00005 exactly halfway at 4 places: decimal averaging rounds away from zero.
    df = spark.createDataFrame([(0.0001,), (0.0,)], "c double")
    assert df.agg(X.exact_avg("c", 4, 4)).first()[0] == 0.0001
    df = spark.createDataFrame([(-0.0001,), (0.0,)], "c double")
    assert df.agg(X.exact_avg("c", 4, 4)).first()[0] == -0.0001


def test_keyword_hits_case_and_hash(spark):
    df = spark.createDataFrame([(["BITCOIN"], "x"), ([], "I like Bitcoins"), ([], "nothing"), (None, None)], "tags array<string>, text string")
    needle = X.keyword_needle(F.lit("#Bitcoin"))
    assert [r[0] for r in df.select(X.keyword_hits(needle, "tags", "text")).collect()] == [True, True, False, False]


def test_polarity_class(spark):
    df = spark.createDataFrame([(0.2,), (-0.1,), (0.0,)], "a double")
    assert [r[0] for r in df.select(X.polarity_class("a")).collect()] == ["green", "red", None]


def test_lag_seconds_keeps_fraction(spark):
    df = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:01.5' AS p, timestamp_ntz'2024-01-01 00:00:00' AS c, CAST(NULL AS timestamp_ntz) AS n")
    r = df.select(X.lag_seconds("p", "c"), X.lag_seconds("p", "n")).first()
    assert r[0] == 1.5 and r[1] is None


def test_shared_checkpoint_dir_reads_session(spark):
    from sentiflow.session import scratch_path, shared_checkpoint_dir

    base = shared_checkpoint_dir(spark)
    assert base and scratch_path(spark, "x").startswith(base.rstrip("/"))


def test_recommended_shuffle_partitions():
    from sentiflow.session import recommended_shuffle_partitions

    assert recommended_shuffle_partitions(100 * 1024**4, 8000) == 409_600
    assert recommended_shuffle_partitions(10, 8) == 16


def test_parse_tags_param_matches_column_form(spark):
    from sentiflow.operators.topk import parse_tags_param

    raws = ["#a, b,,#c ,  ", "##x", "", None, " #k3,click "]
    df = spark.createDataFrame([(r,) for r in raws], "raw string")
    assert [r[0] for r in df.select(X.parse_tag_list("raw")).collect()] == [parse_tags_param(r) for r in raws]
