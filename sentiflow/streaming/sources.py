"""Streaming sources (SRC-01) and replayable test input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from sentiflow.schema import POST_PAYLOAD_SCHEMA
from sentiflow.sources.json_codec import decode_json


# Kafka source defaults of the ingest job (start at the latest offsets, tolerate
# retention gaps, one consumer group).
KAFKA_DEFAULTS = {"startingOffsets": "latest", "failOnDataLoss": "false", "kafka.group.id": "spark-sentiment-consumer"}


def kafka_options(bootstrap_servers: str, topic: str = "tweets", **overrides) -> dict[str, str]:
    """Options for ``read_posts_stream(fmt="kafka")``: one subscribed topic plus the defaults above."""
    return {"kafka.bootstrap.servers": bootstrap_servers, "subscribe": topic, **KAFKA_DEFAULTS, **overrides}


def read_posts_stream(spark: SparkSession, fmt: str = "kafka", schema: T.StructType | None = None, path: str | None = None, **options) -> DataFrame:
    """Unbounded posts source.

    ``fmt="kafka"`` subscribes to a topic (options as for the Kafka source,
    e.g. ``kafka.bootstrap.servers``, ``subscribe``, ``startingOffsets``,
    ``failOnDataLoss``) and returns ``(key, value, topic, partition, offset,
    timestamp)``; the connector jar must be on the classpath. Any file format
    (``json``, ``parquet``...) reads ``path`` with a fixed ``schema``.
    """
    reader = spark.readStream.format(fmt).options(**options)
    if fmt == "kafka":
        return reader.load()
    return reader.schema(schema or POST_PAYLOAD_SCHEMA).load(path)


def decode_stream(raw: DataFrame, schema: T.StructType = POST_PAYLOAD_SCHEMA) -> DataFrame:
    """Kafka records -> flattened payload columns plus the record's broker timestamp."""
    keep = [c for c in ("timestamp", "partition", "offset") if c in raw.columns]
    return decode_json(raw, schema, "value", keep=keep)


def write_replay_files(
    df: DataFrame, path: str, order_col: str, n_files: int, spark: SparkSession, fmt: str = "json", tiebreak: str | None = None
) -> list[str]:
    """Write ``df`` as ``n_files`` files holding consecutive ``order_col`` ranges and give the
    files increasing modification times in range order, so a file stream with
    ``maxFilesPerTrigger`` replays them in event-time order.

    Range partitioning samples the key to balance file sizes (no hot range lands in one
    task; ``tiebreak`` splits a run of equal times); modification times are set with the
    Hadoop FileSystem API (local and HDFS paths).
    """
    keys = [order_col] + ([tiebreak] if tiebreak else [])
    df.repartitionByRange(n_files, *keys).sortWithinPartitions(*keys).write.mode("overwrite").format(fmt).save(path)
    jvm = spark._jvm
    root = jvm.org.apache.hadoop.fs.Path(path)
    fs = root.getFileSystem(spark._jsc.hadoopConfiguration())
    files = sorted((s.getPath() for s in fs.listStatus(root) if s.getPath().getName().startswith("part-")), key=lambda p: p.getName())
    base_ms = 1_600_000_000_000
    for i, f in enumerate(files):
        fs.setTimes(f, base_ms + i * 1000, -1)
    return [f.toString() for f in files]
