"""Session construction and the few session settings results depend on."""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

# Settings every sentiflow job relies on for deterministic results.
RESULT_CONF = {
    # Timestamps are compared across engines; pin the zone.
    "spark.sql.session.timeZone": "UTC",
}

# Settings for scale: runtime re-planning, skew splitting, Arrow batches.
SCALE_CONF = {
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    # Coalesce shuffle partitions by target size, not by parallelism (recommended on busy clusters).
    "spark.sql.adaptive.coalescePartitions.parallelismFirst": "false",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    # Broadcast only what the optimizer can size below this bound.
    "spark.sql.autoBroadcastJoinThreshold": str(32 * 1024 * 1024),
    "spark.sql.files.maxPartitionBytes": str(128 * 1024 * 1024),
}


def build_session(
    master: str | None = None,
    app_name: str = "sentiflow",
    shuffle_partitions: int | None = None,
    extra_conf: dict[str, str] | None = None,
) -> SparkSession:
    """Create (or reuse) a session with sentiflow's defaults.

    On a cluster pass ``master=None`` and let spark-submit decide; size
    ``shuffle_partitions`` to the data (AQE coalesces small ones).
    """
    builder = (
        SparkSession.builder.appName(app_name)
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
    )
    if master:
        builder = builder.master(master)
    for key, value in {**SCALE_CONF, **RESULT_CONF}.items():
        builder = builder.config(key, value)
    if shuffle_partitions:
        builder = builder.config("spark.sql.shuffle.partitions", str(shuffle_partitions))
    for key, value in (extra_conf or {}).items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    spark.sparkContext.setLogLevel("WARN")
    return spark


def recommended_shuffle_partitions(input_bytes: int, total_cores: int, target_partition_bytes: int = 256 * 1024 * 1024) -> int:
    """Initial shuffle partition count for a job reading ``input_bytes`` on ``total_cores``.

    Enough partitions that each holds about ``target_partition_bytes`` of
    shuffle input (so tasks fit executor memory without spilling), and at
    least two waves of tasks; AQE then coalesces small ones and splits skewed
    ones at run time. E.g. 100 TB on 1000 executors x 8 cores -> 409,600.
    """
    by_size = -(-int(input_bytes) // int(target_partition_bytes))
    return max(by_size, 2 * int(total_cores), 1)


def ensure_session_defaults(spark: SparkSession) -> SparkSession:
    """Apply the result-affecting settings to a session created elsewhere."""
    for key, value in RESULT_CONF.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def shared_checkpoint_dir(spark: SparkSession) -> str:
    """Return the cluster's shared checkpoint folder (``spark.checkpoint.dir``).

    The setting is read from the session; only when it is unset and the master is
    local (tests) is a fresh scratch folder created and registered. Elsewhere
    executors could not share such a folder, so an unset folder is an error.
    """
    configured = spark.sparkContext.getConf().get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if configured:
        return configured
    if not spark.sparkContext.master.startswith("local["):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    local = tempfile.mkdtemp(prefix="sentiflow-ckpt-")
    spark.sparkContext.setCheckpointDir(local)
    return spark.sparkContext.getCheckpointDir() or local


def scratch_path(spark: SparkSession, name: str) -> str:
    """A subfolder of the shared checkpoint folder for written intermediates."""
    base = shared_checkpoint_dir(spark).rstrip("/")
    return f"{base}/{name}"

