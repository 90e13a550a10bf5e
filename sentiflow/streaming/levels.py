"""Levelled merge of per-batch folders (SNK-06, STR-05, STR-06): readers open O(log batches) folders.

Micro-batches write ``batch_id=N`` folders of mergeable rows. ``fold`` merges aligned groups of ``fan`` batches into one folder, ``fan``
of those into one, and so on, so there are at most ``fan`` folders a level. The newest batch is never folded, since it may be
written again. A fold is written first and counts from the moment at which the manifest names it, in place of the folders that
it replaces; these are deleted by the next fold, so readers that began before can end. A fold that was cut short
is not named and is written anew.
"""

from __future__ import annotations

import json
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from sentiflow.streaming.files import children, delete_path, read_newest_json
from sentiflow.streaming.metrics import write_text

FAN = 8


def _manifest(spark: SparkSession, path: str) -> dict:
    """``{"batch_id": turn, "folds": {name: [first, last]}, "dead": [names]}`` of the newest whole file; two files take turns."""
    found = read_newest_json(spark, [f"{path}/_folds-{i}.json" for i in (0, 1)])
    return found or {"batch_id": 0, "folds": {}, "dead": []}


def _write_manifest(spark: SparkSession, path: str, turn: int, folds: dict, dead: list[str]) -> None:
    write_text(spark, f"{path}/_folds-{turn % 2}.json", json.dumps({"batch_id": turn, "folds": folds, "dead": dead}))


def live_folders(spark: SparkSession, path: str) -> dict[str, tuple[int, int]]:
    """Folder names with the (first, last) batch that each holds: the folds of the manifest and the batches in none of them."""
    path = path.rstrip("/")
    manifest = _manifest(spark, path)
    folds = {n: tuple(r) for n, r in manifest["folds"].items()}
    singles = [int(n.split("=", 1)[1]) for n in children(spark, path) if n.startswith("batch_id=")]
    return folds | {f"batch_id={b}": (b, b) for b in singles if not any(lo <= b <= hi for lo, hi in folds.values())}


def read_levels(spark: SparkSession, path: str, schema: str, upto: int | None = None) -> DataFrame:
    """The rows of all live folders (without ``batch_id``), or of those whose batches are ``upto`` at most."""
    path = path.rstrip("/")
    live = [n for n, (_, last) in live_folders(spark, path).items() if upto is None or last <= upto]
    if not live:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(*[f"{path}/{n}" for n in sorted(live)])


def fold(spark: SparkSession, path: str, schema: str, merge: Callable[[DataFrame], DataFrame], fan: int = FAN) -> int:
    """Merge what makes whole groups; returns the number of folds written. One writer of folds at a time."""
    path = path.rstrip("/")
    manifest, live = _manifest(spark, path), live_folders(spark, path)
    for name in manifest["dead"]:
        delete_path(spark, f"{path}/{name}")
    newest = max((last for _, last in live.values()), default=-1)
    folds, dead, made, size = {n: list(r) for n, r in manifest["folds"].items()}, [], 0, fan
    while size <= newest:
        for group in {first // size for first, last in live.values() if last < newest // size * size}:
            low, high = group * size, group * size + size - 1
            members = sorted(n for n, (first, last) in live.items() if low <= first and last <= high)
            if len(members) < 2:
                continue
            name = f"fold={low}-{high}"
            rows = merge(spark.read.schema(schema).parquet(*[f"{path}/{n}" for n in members]))
            rows.write.mode("overwrite").parquet(f"{path}/{name}")
            dead += members
            for n in members:
                live.pop(n)
                folds.pop(n, None)
            live[name] = (low, high)
            folds[name] = [low, high]
            made += 1
        size *= fan
    if made or manifest["dead"]:
        _write_manifest(spark, path, manifest["batch_id"] + 1, folds, dead)
    return made
