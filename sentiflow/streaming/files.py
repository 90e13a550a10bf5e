"""Small file work of the streaming sinks through the Hadoop FileSystem API: partitions, folders, metadata files."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession


def write_partition(df: DataFrame, path: str) -> None:
    """Replace the ``batch_id`` partitions that ``df`` holds; a replayed micro-batch rewrites its own."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("batch_id").parquet(path)


def filesystem(spark: SparkSession, path: str):
    """(filesystem, path object) of a path."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = filesystem(spark, path)
    return fs.exists(jpath)


def make_folder(spark: SparkSession, path: str) -> None:
    fs, jpath = filesystem(spark, path)
    fs.mkdirs(jpath)


def delete_path(spark: SparkSession, path: str) -> None:
    fs, jpath = filesystem(spark, path)
    fs.delete(jpath, True)


def children(spark: SparkSession, path: str) -> list[str]:
    """Names of what lies in a folder (none if there is no such folder)."""
    fs, jpath = filesystem(spark, path)
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath)) if fs.exists(jpath) else []


def read_json(spark: SparkSession, path: str) -> dict | None:
    """A small metadata file, or None if it is absent or was cut short."""
    fs, jpath = filesystem(spark, path)
    if not fs.exists(jpath):
        return None
    opened = fs.open(jpath)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(opened, "UTF-8"))
    except ValueError:
        return None
    finally:
        opened.close()


def read_newest_json(spark: SparkSession, paths: list[str]) -> dict:
    """The whole file of the highest ``batch_id`` among files that take turns; empty if there is none."""
    found = [read_json(spark, p) for p in paths]
    return max((f for f in found if f), key=lambda f: f["batch_id"], default={})
