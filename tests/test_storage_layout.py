"""Scale properties of the storage layouts: a hot key is spread over several files."""

import datetime as dt
import tempfile

from pyspark.sql import functions as F

from conftest import AS_OF, make_posts
from sentiflow.operators.tag_index import build_tag_index, tag_search
from sentiflow.operators.filters import tag_overlap
from sentiflow.sources.tables import write_posts_table


def _hot_posts(spark, n=600):
    rows = []
    for i in range(n):
        hot = i % 3 == 0  # one hashtag and one day carry a third of all rows
        rows.append(dict(
            tweet_id=f"t{i:04d}",
            hashtags=["hot"] if hot else [f"tag{i % 50}"],
            processed_at=AS_OF if hot else AS_OF - dt.timedelta(days=1 + i % 20, seconds=i),
        ))
    return make_posts(spark, rows)


def test_hot_hashtag_spans_files_and_search_is_exact(spark):
    p = _hot_posts(spark)
    path = build_tag_index(p, tempfile.mkdtemp(prefix="sentiflow-test-") + "/idx", files=8)
    idx = spark.read.parquet(path)
    files = idx.filter(F.col("hashtag") == "hot").select(F.input_file_name()).distinct().count()
    assert files > 1
    got = sorted(r["tweet_id"] for r in tag_search(spark, p, path, ["hot", "tag7"]).collect())
    assert got == sorted(r["tweet_id"] for r in tag_overlap(p, ["hot", "tag7"]).collect())


def test_hot_day_spans_files(spark):
    p = _hot_posts(spark)
    path = write_posts_table(p, tempfile.mkdtemp(prefix="sentiflow-test-") + "/posts", files=8)
    stored = spark.read.parquet(path)
    hot_day = AS_OF.date()
    files = stored.filter(F.col("dt") == F.lit(hot_day)).select(F.input_file_name()).distinct().count()
    assert files > 1
    assert stored.count() == p.count()
