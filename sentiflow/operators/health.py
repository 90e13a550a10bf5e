"""Freshness, backlog and throughput health metrics (STR-08, STR-09, STR-11)."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentiflow.functions.expressions import as_column

# Alarm thresholds.
STALE_SECONDS = 120
MAX_BACKLOG = 5000


def freshness(df: DataFrame, as_of, ts_col: str = "processed_at", by: list[str] | None = None, stale_seconds: int = STALE_SECONDS, expected: DataFrame | None = None) -> DataFrame:
    """Age of the latest activity per group vs the staleness threshold.

    Groups listed in ``expected`` but without rows are reported unhealthy with NULL age.
    """
    by = by or []
    now = as_column(as_of)
    latest = df.groupBy(*by).agg(F.max(ts_col).alias("last_activity"))
    if expected is not None:
        latest = expected.select(*by).join(latest, by, "left")
    age = F.timestamp_diff("MICROSECOND", F.col("last_activity"), now) / F.lit(1_000_000.0)
    return latest.select(
        *by,
        "last_activity",
        age.alias("age_seconds"),
        F.coalesce(age < F.lit(stale_seconds), F.lit(False)).alias("healthy"),
    )


def backlog(offsets: DataFrame, threshold: int = MAX_BACKLOG, by: list[str] | None = None) -> DataFrame:
    """Consumer backlog from ``(partition, low, committed, high)`` offsets.

    Per partition ``max(0, high - committed)``, where a missing/negative
    committed offset counts from ``low``; summed per group with a health flag.
    """
    by = by or []
    committed = F.when(F.col("committed").isNull() | (F.col("committed") < 0), F.col("low")).otherwise(F.col("committed"))
    per = offsets.withColumn("lag", F.greatest(F.lit(0), F.col("high") - committed).cast("bigint"))
    return per.groupBy(*by).agg(
        F.count(F.lit(1)).alias("partitions"),
        F.sum("lag").cast("bigint").alias("total_lag"),
    ).withColumn("healthy", F.col("total_lag") < F.lit(threshold))


def partition_lag(offsets: DataFrame) -> DataFrame:
    """Per-partition ``lag`` column (``max(0, high - committed)``, missing committed counts from ``low``)."""
    committed = F.when(F.col("committed").isNull() | (F.col("committed") < 0), F.col("low")).otherwise(F.col("committed"))
    return offsets.withColumn("lag", F.greatest(F.lit(0), F.col("high") - committed).cast("bigint"))


def running_total(df: DataFrame, order_col: str, value_col: str, block_col: str, out_col: str = "cumulative", fan: int = 1024) -> DataFrame:
    """Distributed prefix sum in three levels: rows inside their block, blocks inside their group of ``fan`` blocks, and groups.

    ``block_col`` is a number that does not fall as ``order_col`` rises. No task holds more than one block of rows or one group of block
    totals; only the groups' totals (a row for every ``fan`` blocks) are summed in one place.
    """
    before = (Window.unboundedPreceding, -1)

    def ahead(total, window):
        return F.coalesce(F.sum(total).over(window.rowsBetween(*before)), F.lit(0))

    blocks = df.groupBy(block_col).agg(F.sum(value_col).alias("_total")).withColumn("_group", F.floor(F.col(block_col) / F.lit(fan)))
    groups = blocks.groupBy("_group").agg(F.sum("_total").alias("_all"))
    groups = groups.select("_group", ahead("_all", Window.orderBy("_group")).alias("_before_group"))
    blocks = blocks.join(groups, "_group")
    inside = ahead("_total", Window.partitionBy("_group").orderBy(block_col))
    offsets = blocks.select(block_col, (F.col("_before_group") + inside).alias("_offset"))
    within = Window.partitionBy(block_col).orderBy(order_col).rowsBetween(Window.unboundedPreceding, 0)
    return df.join(offsets, block_col).withColumn(out_col, (F.col("_offset") + F.sum(value_col).over(within)).cast("bigint")).drop("_offset")


def batch_throughput(progress: DataFrame, block_size: int = 1024) -> DataFrame:
    """Per micro-batch rows and cumulative rows from ``(batch_id, num_input_rows)`` progress rows."""
    p = progress.withColumn("_block", F.floor(F.col("batch_id") / F.lit(block_size)))
    return running_total(p, "batch_id", "num_input_rows", "_block", "cumulative_rows").drop("_block")
