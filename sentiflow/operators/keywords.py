"""Tracking-keyword activity, silence and rotation (FLT-07, JON-03, JON-04, STR-07 batch form).

A keyword matches a post when its lower-cased needle (leading ``#`` removed)
equals a lower-cased hashtag or is a substring of the lower-cased text.
"""

from __future__ import annotations

from functools import reduce

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentiflow.functions.expressions import as_column, keyword_needle

# Characters of needles in one broadcast block.
BLOCK_CHARS = 1 << 20


def keyword_dim(spark, keywords: list[str]) -> DataFrame:
    """``(keyword, position)`` rows for an ordered keyword list (a parameter, trimmed).

    A keyword with nothing left after removing ``#`` would match every post; it is refused.
    """
    cleaned = [k.strip() for k in keywords]
    empty = [k for k in cleaned if not k.lstrip("#")]
    if empty:
        raise ValueError(f"empty keywords are not allowed: {empty!r}")
    return spark.createDataFrame([(k, i) for i, k in enumerate(cleaned)], "keyword string, position int")


class KeywordMachine:
    """Keywords as automata over lower-cased text, in blocks of needles; one pass over each text finds every needle in it.

    A block holds at most ``block_chars`` characters of needles (one needle at least) and is broadcast as strings; each task builds the
    automaton (goto and fail links) of its blocks once. The keywords are streamed from Spark block by block. It is made once
    and may then be used on any number of tables, micro-batches and streams.
    """

    def __init__(self, keywords: DataFrame, block_chars: int = BLOCK_CHARS):
        needles = keywords.select("keyword").distinct().withColumn("needle", keyword_needle("keyword")).filter(F.length("needle") > 0)
        self.blocks, held, size = [], {}, 0
        context = keywords.sparkSession.sparkContext
        for r in needles.orderBy("needle", "keyword").toLocalIterator():
            new = r["needle"] not in held
            if new and size + len(r["needle"]) > block_chars and held:
                self.blocks.append(context.broadcast(held))
                held, size = {}, 0
            size += len(r["needle"]) if new else 0
            held.setdefault(r["needle"], []).append(r["keyword"])
        self.blocks.append(context.broadcast(held))

    def matches(self, posts: DataFrame, *columns: str) -> DataFrame:
        """``keyword`` and ``columns`` of each post row once for each distinct keyword that it matches (batch or streaming)."""
        tags = F.transform(F.coalesce("hashtags", F.array().cast("array<string>")), lambda h: F.lower(h))
        read = posts.select(*columns, tags.alias("_tags"), F.lower(F.coalesce(F.col("text"), F.lit(""))).alias("_text"))
        kinds = {f.name: f.dataType.simpleString() for f in posts.schema}
        schema = ", ".join(["keyword string", *[f"`{c}` {kinds[c]}" for c in columns]])
        found = [read.mapInArrow(_scan(block, columns), schema) for block in self.blocks]
        return reduce(DataFrame.unionByName, found)


def _scan(block, columns):
    """Rows of a batch, once for each keyword of the block that they match."""

    def scan(batches):
        keywords = block.value
        machine = ahocorasick.Automaton()
        for needle in keywords:
            machine.add_word(needle, needle)
        if keywords:
            machine.make_automaton()
        for batch in batches:
            row, word = [], []
            if keywords:
                for i, (tags, text) in enumerate(zip(batch.column("_tags").to_pylist(), batch.column("_text").to_pylist())):
                    hits = {needle for _, needle in machine.iter(text)}
                    hits.update(t for t in tags if t in keywords)
                    for needle in hits:
                        word += keywords[needle]
                        row += [i] * len(keywords[needle])
            at = pa.array(row, pa.int64())
            yield pa.RecordBatch.from_arrays([pa.array(word, pa.string()), *[batch.column(c).take(at) for c in columns]], names=["keyword", *columns])

    return scan


def keyword_matches(posts: DataFrame, keywords: DataFrame | KeywordMachine) -> DataFrame:
    """``(keyword, tweet_id, processed_at)``: one row for each distinct keyword and each post row that it matches.

    Texts are read once by the keywords' automata and are not shuffled. Keywords with an empty needle match
    nothing (see ``keyword_dim``).
    """
    machine = keywords if isinstance(keywords, KeywordMachine) else KeywordMachine(keywords)
    return machine.matches(posts, "tweet_id", "processed_at")


def keyword_activity(posts: DataFrame, keywords: DataFrame | KeywordMachine) -> DataFrame:
    """Per keyword: last matching ``processed_at`` and number of matching posts (absent when none)."""
    m = keyword_matches(posts, keywords)
    return m.groupBy("keyword").agg(F.max("processed_at").alias("last_seen"), F.count(F.lit(1)).alias("matches"))


def silent_keywords(activity: DataFrame, keywords: DataFrame, as_of, idle_seconds: int = 60, connected_at=None) -> DataFrame:
    """Idle check per keyword: seconds since last activity (clock seeded at ``connected_at``) and a ``silent`` flag."""
    now = as_column(as_of)
    seed = now if connected_at is None else as_column(connected_at)
    joined = keywords.join(activity, "keyword", "left")
    last = joined.select(
        "keyword",
        "position",
        F.coalesce("matches", F.lit(0)).cast("bigint").alias("matches"),
        F.greatest(F.coalesce(F.col("last_seen"), seed), seed).cast("timestamp_ntz").alias("last_seen"),
    )
    idle = F.timestamp_diff("SECOND", F.col("last_seen"), now)
    return last.select("*", idle.alias("idle_seconds")).withColumn("silent", F.col("idle_seconds") >= F.lit(idle_seconds))


def rotate(keywords: list[str], silent: list[bool], backups: list[str], cursor: int = 0) -> tuple[list[str], int]:
    """One sweep over the tracked list: each silent keyword in turn takes the next backup that is not tracked at that moment.

    A keyword that was swapped out is free again for later ones; with no free backup the keyword stays. The cursor
    moves on past every backup looked at.
    """
    active = list(keywords)
    for i, idle in enumerate(silent):
        for _ in range(len(backups) if idle else 0):
            candidate = backups[cursor % len(backups)]
            cursor += 1
            if candidate not in active:
                active[i] = candidate
                break
    return active, cursor


def rotation_plan(status: DataFrame, backups: DataFrame, cursor: int = 0) -> DataFrame:
    """Swap plan for one sweep: ``(position, keyword, replacement, new_keyword)`` of every tracked keyword.

    The sweep changes the list that it checks, so it runs in list order on the driver over the tracked
    and backup lists, which are configuration (``keyword_dim`` takes them as Python lists); the statuses that decide it
    are computed by Spark.
    """
    spark = status.sparkSession
    rows = status.select("position", "keyword", F.coalesce("silent", F.lit(False)).alias("silent")).orderBy("position").collect()
    pool = [r["keyword"] for r in backups.orderBy("position").collect()]
    active, _ = rotate([r["keyword"] for r in rows], [r["silent"] for r in rows], pool, cursor)
    plan = [(r["position"], r["keyword"], None if new == r["keyword"] else new, new) for r, new in zip(rows, active)]
    return spark.createDataFrame(plan, "position int, keyword string, replacement string, new_keyword string")
