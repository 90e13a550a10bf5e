"""Batch table scans, row-count probes, column evolution and source fallback."""

from __future__ import annotations

import logging
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

log = logging.getLogger(__name__)

TEST_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def load_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one parquet table; column pruning and filters reach the scan."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_posts(spark: SparkSession, path: str, fmt: str = "parquet", schema=None, **options) -> DataFrame:
    """Batch read of a posts table in any built-in format (parquet, json, orc, csv...)."""
    reader = spark.read.format(fmt).options(**options)
    if schema is not None:
        reader = reader.schema(schema)
    return reader.load(path)


def table_counts(tables: dict[str, DataFrame]) -> DataFrame:
    """One ``(table_name, row_count)`` row per table, as one distributed job."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count")).select(F.lit(name).alias("table_name"), "row_count") for name, df in tables.items()]
    return reduce(DataFrame.unionByName, parts)


def ensure_column(df: DataFrame, name: str, expr: Column) -> DataFrame:
    """Add ``name`` computed by ``expr`` only when it is missing (idempotent evolution)."""
    if name in df.columns:
        return df
    return df.withColumn(name, expr)


def column_status(df: DataFrame, names: list[str]) -> list[tuple[str, str]]:
    """``[(name, 'EXISTS'|'MISSING')]`` from the schema alone (no job runs)."""
    present = set(df.columns)
    return [(n, "EXISTS" if n in present else "MISSING") for n in names]


def first_nonempty(sources: list[tuple[str, DataFrame | Callable[[], DataFrame]]]) -> DataFrame:
    """Rows of the first source (by list order) that answers with any rows, tagged with its name.

    A source is a DataFrame or a function that makes one. Each is probed for one row;
    one that fails is logged and passed over, as an empty one is. Only the winner
    is planned, so the others are neither read whole nor evaluated again. If none has rows the last that
    answered is returned; if all fail, the last failure is raised.
    """
    answer, failure = None, None
    for name, source in sources:
        try:
            df = source() if callable(source) else source
            tagged = df.select("*", F.lit(name).alias("source_used"))
            if tagged.take(1):  # a whole row, so that a source that fails in any column is passed over
                return tagged
            answer = tagged
        except Exception as exc:  # noqa: BLE001  any source may fail in its own way
            log.warning("source %s failed: %s", name, str(exc).splitlines()[0] if str(exc) else type(exc).__name__)
            failure = exc
    if answer is None:
        raise failure or ValueError("no source was given")
    return answer


def bound_query(spark: SparkSession, text: str, tables: dict[str, DataFrame], params: dict | list | None = None) -> DataFrame:
    """A parameterised query over named tables: ``:name`` or ``?`` markers are bound, never spliced into the text."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
    return spark.sql(text, args=params or {})


def pin_bounded(df: DataFrame, bound: int, what: str = "dimension") -> DataFrame:
    """Fetch a small dimension once (at most ``bound + 1`` rows) and pin it as a local relation.

    For bounded configuration-sized frames (keyword lists, per-keyword status)
    that a plan uses several times: the pinned copy is not recomputed per use.
    Larger frames are refused rather than pulled to the driver.
    """
    rows = df.limit(bound + 1).collect()
    if len(rows) > bound:
        raise ValueError(f"{what} has more than {bound} rows")
    return df.sparkSession.createDataFrame(rows, df.schema)


def write_posts_table(
    posts: DataFrame, path: str, files: int = 64, ts_col: str = "processed_at", date_col: str = "dt", key: str = "tweet_id"
) -> str:
    """Write posts partitioned by date and sorted by time within each file.

    Date folders let a time bound prune whole partitions; time-sorted files give
    tight row-group min/max for the rest. Rows are range-partitioned by
    ``(date, time, key)`` first, so one hot day -- even a burst of rows with the
    same timestamp -- is spread over several tasks and files instead of one.
    """
    dated = posts.withColumn(date_col, F.to_date(ts_col))
    keys = [date_col, ts_col] + ([key] if key in posts.columns else [])
    (
        dated.repartitionByRange(files, *keys)
        .sortWithinPartitions(ts_col)
        .write.mode("overwrite")
        .partitionBy(date_col)
        .parquet(path)
    )
    return path
