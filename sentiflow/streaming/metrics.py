"""Stream health from query progress (STR-08, STR-11).

``ProgressRecorder`` is a ``StreamingQueryListener`` that keeps all progress events
(small dicts or files, one per micro-batch, not data);
``progress_frame`` turns progress events (from the recorder or
``query.recentProgress``) into a DataFrame for ``batch_throughput``, and
``offsets_frame`` turns Kafka-style source offsets into
``(partition, low, committed, high)`` rows for ``backlog``.
"""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQueryListener

PROGRESS_DDL = "query_name string, batch_id long, num_input_rows long, input_rows_per_second double, processed_rows_per_second double, trigger_ms long"
OFFSETS_DDL = "topic string, partition int, low long, committed long, high long"


class ProgressRecorder(StreamingQueryListener):
    """Keeps every progress event: in memory (one small dict per micro-batch), or as JSON files in ``path``.

    With ``path`` (a shared folder) each event is one file written through the Hadoop FileSystem API, nothing is held
    in memory, and ``progress_table`` reads them all.
    """

    def __init__(self, spark: SparkSession | None = None, path: str | None = None):
        self.events: list[dict] = []
        self.spark, self.path = spark, path

    def onQueryStarted(self, event):  # noqa: N802
        pass

    def onQueryProgress(self, event):  # noqa: N802
        if self.path:
            p = json.loads(event.progress.json)
            write_text(self.spark, f"{self.path}/{p['runId']}-{p['batchId']}.json", event.progress.json)
        else:
            self.events.append(json.loads(event.progress.json))

    def onQueryIdle(self, event):  # noqa: N802
        pass

    def onQueryTerminated(self, event):  # noqa: N802
        pass


def progress_frame(spark: SparkSession, progresses) -> DataFrame:
    """Progress events (dicts, JSON strings or ``StreamingQueryProgress``) -> one row per micro-batch."""
    rows = []
    for p in progresses:
        if hasattr(p, "json"):
            p = json.loads(p.json)
        elif isinstance(p, str):
            p = json.loads(p)
        rows.append(
            (
                p.get("name"),
                int(p["batchId"]),
                int(p.get("numInputRows", 0)),
                float(p.get("inputRowsPerSecond") or 0.0),
                float(p.get("processedRowsPerSecond") or 0.0),
                int((p.get("durationMs") or {}).get("triggerExecution", 0)),
            )
        )
    return spark.createDataFrame(rows, PROGRESS_DDL)


def write_text(spark: SparkSession, path: str, text: str) -> None:
    """One small file through the Hadoop FileSystem API."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = jpath.getFileSystem(spark._jsc.hadoopConfiguration()).create(jpath, True)
    try:
        out.write(bytearray(" ".join(text.split()).encode()))
    finally:
        out.close()


def progress_table(spark: SparkSession, path: str) -> DataFrame:
    """All progress events that a ``ProgressRecorder`` wrote to ``path``, one row per micro-batch."""
    schema = "name string, batchId long, numInputRows long, inputRowsPerSecond double, processedRowsPerSecond double, durationMs struct<triggerExecution:long>"
    p = spark.read.schema(schema).json(path)
    return p.select(
        F.col("name").alias("query_name"), F.col("batchId").alias("batch_id"), F.col("numInputRows").alias("num_input_rows"),
        F.coalesce("inputRowsPerSecond", F.lit(0.0)).alias("input_rows_per_second"),
        F.coalesce("processedRowsPerSecond", F.lit(0.0)).alias("processed_rows_per_second"),
        F.coalesce("durationMs.triggerExecution", F.lit(0)).alias("trigger_ms"),
    )


def _offsets(obj) -> dict:
    if obj is None:
        return {}
    if isinstance(obj, str):
        try:
            obj = json.loads(obj)
        except ValueError:
            return {}
    return obj if isinstance(obj, dict) else {}


def offsets_frame(spark: SparkSession, progress, starts: dict[str, dict[str, int]] | None = None) -> DataFrame:
    """Kafka source offsets of one progress event -> ``(topic, partition, low, committed, high)``.

    ``committed`` is the source's ``endOffset`` (what the query has consumed),
    ``high`` its ``latestOffset`` (what the broker holds). The progress event does not carry
    the log start offsets: ``starts`` gives them as topic -> partition -> offset (the broker's
    earliest offsets), else ``low`` is the source's start offset of that event, else 0.
    """
    if hasattr(progress, "json"):
        progress = json.loads(progress.json)
    elif isinstance(progress, str):
        progress = json.loads(progress)
    rows = []
    for src in progress.get("sources", []):
        end, latest = _offsets(src.get("endOffset")), _offsets(src.get("latestOffset"))
        for topic, parts in latest.items():
            for part, high in parts.items():
                committed = end.get(topic, {}).get(part)
                first = (starts or {}).get(topic, {}).get(part, _offsets(src.get("startOffset")).get(topic, {}).get(part, 0))
                rows.append((topic, int(part), int(first), None if committed is None else int(committed), int(high)))
    return spark.createDataFrame(rows, OFFSETS_DDL)
