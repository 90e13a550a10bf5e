"""Inputs shared by the registered queries: the posts table derived from the
driver's ``events`` table, and a data-derived ``as_of`` (a scalar subquery,
so nothing is collected to build the plan)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentiflow.functions.expressions import ts_literal
from sentiflow.session import ensure_session_defaults
from sentiflow.sources.fixtures import events_to_posts
from sentiflow.sources.tables import load_table


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One driver table (session time zone pinned to UTC first)."""
    ensure_session_defaults(spark)
    return load_table(spark, sf_dir, name)


def posts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The canonical posts table derived from ``events``."""
    return events_to_posts(table(spark, sf_dir, "events"))


def as_of(posts_df: DataFrame, ts_col: str = "processed_at") -> Column:
    """``max(ts)`` of the table as a literal.

    One column-pruned aggregate job computes the value; as a literal the time
    bound of every trailing-window filter then reaches the parquet scan
    (``PushedFilters``), which a scalar-subquery bound would not. Live jobs
    pass the wall clock instead and skip the job.
    """
    return ts_literal(posts_df.select(F.max(ts_col)).first()[0])


def as_of_subquery(posts_df: DataFrame, ts_col: str = "processed_at") -> Column:
    """``max(ts)`` as a lazily evaluated scalar subquery (no job at plan time)."""
    return posts_df.select(F.max(ts_col)).scalar()
