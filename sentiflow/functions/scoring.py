"""Lexicon sentiment scoring (SEN-01..04).

Forms of the same score:

* ``lexicon_score`` -- relational: tokenise, ``explode``, join the lexicon (Spark picks
  the join by size, AQE splits hot tokens), then sum per text with a map-side partial
  aggregate. Pure JVM, oracle-checked.
* ``with_lexicon_score`` -- the same as a column added to the rows, for the ingest job.
* ``lexicon_score_udf`` -- Arrow functions: ``rows`` scores the rows of a table group by group, each with the
  lexicon entries of its group's words, for a lexicon of any size; called with a column it is a row-local UDF over
  broadcast blocks, for a lexicon that every worker can hold.

Every input row gets a score, rows that share an id or have none included.
compound = s / sqrt(s^2 + alpha), s = sum of token valences (exact decimal
sum), rounded to 4 places; texts without lexicon tokens score 0.0.
"""

from __future__ import annotations

import math
import re
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentiflow.functions.lookup import Entries, look_up

# Normalisation constant of the compound score and the token pattern.
ALPHA = 15.0
TOKEN_SPLIT = "[^a-z]+"

# Entries of the lexicon that one scoring UDF of a column holds; a larger lexicon takes several.
BLOCK_ENTRIES = 200_000


def tokens(text: Column | str) -> Column:
    """Lower-cased text split on runs of non-letters."""
    c = F.col(text) if isinstance(text, str) else text
    return F.split(F.lower(c), TOKEN_SPLIT)


def compound_from_sum(s: Column) -> Column:
    """``s / sqrt(s^2 + alpha)`` rounded to 4 places."""
    sd = s.cast("double")
    return F.round(sd / F.sqrt(sd * sd + F.lit(ALPHA)), 4)


def text_key(text_col: str = "text") -> list[Column]:
    """Columns that stand for a text in a grouping: two hashes of it (128 bits)."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    return [F.xxhash64(text).alias("_h1"), F.xxhash64(F.lit(1), text).alias("_h2")]


def lexicon_score(
    df: DataFrame,
    lexicon: DataFrame,
    id_col: str,
    text_col: str = "text",
    token_col: str = "token",
    valence_col: str = "valence",
) -> DataFrame:
    """``(id, compound_score, matched_tokens)`` for every row of ``df`` (NULL text scores 0.0).

    Rows are grouped by id and text; equal rows are one group that counts its rows (each has one first
    token) and is given out as often.
    """
    lex = lexicon.select(F.col(token_col).alias("_tok"), F.col(valence_col).cast("decimal(18,6)").alias("_val"))
    words = tokens(F.coalesce(F.col(text_col), F.lit("")))  # an empty text has one empty token
    exploded = df.select(F.col(id_col).alias("_id"), *text_key(text_col), F.posexplode(words).alias("_pos", "_tok"))
    sums = exploded.join(lex, "_tok", "left").groupBy("_id", "_h1", "_h2").agg(
        F.coalesce(F.sum("_val"), F.lit(0).cast("decimal(18,6)")).alias("_s"),
        F.count("_val").alias("_hits"),
        F.count_if(F.col("_pos") == 0).alias("_rows"),
    )
    one = sums.select(
        F.col("_id").alias(id_col),
        compound_from_sum(F.col("_s") / F.col("_rows").cast("decimal(18,0)")).alias("compound_score"),
        (F.col("_hits") / F.col("_rows")).cast("bigint").alias("matched_tokens"),
        F.col("_rows").cast("int").alias("_rows"),
    )
    return one.withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("_rows")))).drop("_copy", "_rows")


def with_scores(df: DataFrame, scorer: Callable[[DataFrame], DataFrame], text_col: str = "text") -> DataFrame:
    """``df`` with ``compound_score`` from a relational ``scorer`` of ``(_text_key, text)``, row by row.

    Each distinct text is scored once and joined back by its key.
    """
    key = F.concat_ws("-", *[k.cast("string") for k in text_key(text_col)]).alias("_text_key")
    texts = df.select(key, F.col(text_col).alias("text")).dropDuplicates(["_text_key"])
    scores = scorer(texts).select("_text_key", "compound_score")
    return df.withColumn("_text_key", key).join(scores, "_text_key", "left").drop("_text_key")


def with_lexicon_score(df: DataFrame, lexicon: DataFrame, text_col: str = "text", key: str | None = None) -> DataFrame:
    """``df`` with the plain valence-sum score of each row's text (scored once per distinct text, so no ``key`` is needed)."""
    return with_scores(df, lambda texts: lexicon_score(texts, lexicon, "_text_key"), text_col)


def valence_sums(batch: pa.RecordBatch, entries: Entries) -> dict[str, pa.Array]:
    """``_sum``: the valences of each row's words, added exactly and rounded once."""
    _, rows, _, valences = entries.find(batch.column("_words"))
    values, ends = valences.to_pylist(), np.cumsum(np.bincount(rows, minlength=batch.num_rows))
    return {"_sum": pa.array([math.fsum(filter(None, values[a:b])) for a, b in zip([0, *ends[:-1]], ends)], pa.float64())}


class LexiconUdf:
    """Scorer of :func:`lexicon_score_udf`."""

    def __init__(self, spark: SparkSession, lexicon: DataFrame, token_col: str, valence_col: str, block: int):
        self.spark, self.block = spark, block
        self.lexicon = lexicon.select(F.col(token_col).alias("token"), F.col(valence_col).cast("double").alias("valence"))
        self._sums: list | None = None

    def rows(self, df: DataFrame, text_col: str = "text", key: str | None = None) -> DataFrame:
        """``df`` with ``compound_score``: the entries come to the rows by ``lookup.look_up``, so neither the driver nor a worker ever
        holds the lexicon. ``key`` (a column, if any) deals copies of a text to several tasks."""
        words = tokens(F.coalesce(F.col(text_col), F.lit("")))

        def spread(texts: DataFrame) -> DataFrame:
            return texts.select("_group", F.explode(words).alias("token")).distinct()

        summed = look_up(
            df, lambda rows: rows.withColumn("_words", words), spread, self.lexicon, text_col, [key] if key else [], ["_words"], valence_sums, "_sum double"
        )
        return summed.select(*df.columns, compound_from_sum(F.col("_sum")).alias("compound_score"))

    def __call__(self, text: Column | str) -> Column:
        """Score column of a text column; the lexicon is streamed through the driver in blocks of ``block`` entries, each broadcast for
        a UDF of its own that sums the valences it knows."""
        if self._sums is None:
            self._sums = [_valence_udf(b) for b in self._blocks()]
        total = self._sums[0](text)
        for more in self._sums[1:]:
            total = total + more(text)
        return compound_from_sum(total)

    def _blocks(self) -> Iterator:
        own = {}
        for token, valence in self.lexicon.toLocalIterator():
            own[token] = valence
            if len(own) >= self.block:
                yield self.spark.sparkContext.broadcast(own)
                own = {}
        yield self.spark.sparkContext.broadcast(own)


def _valence_udf(shared):
    splitter = re.compile(TOKEN_SPLIT)

    @F.pandas_udf(T.DoubleType())
    def valence_sum(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        get = shared.value.get
        for texts in batches:
            yield pd.Series([math.fsum(filter(None, map(get, splitter.split(t.lower())))) if t else 0.0 for t in texts], dtype="float64")

    return valence_sum


def lexicon_score_udf(
    spark: SparkSession, lexicon: DataFrame, token_col: str = "token", valence_col: str = "valence", block: int = BLOCK_ENTRIES
) -> LexiconUdf:
    """An Arrow scorer: ``.rows(df)`` adds the score to the rows of a table, for a lexicon of any size; as a function from a text
    column to a score column it is row-local, for a lexicon that a worker can hold."""
    return LexiconUdf(spark, lexicon, token_col, valence_col, block)


def corpus_lexicon(documents: DataFrame, n: int | None = None, text_col: str = "text") -> DataFrame:
    """Test lexicon from a corpus: all its tokens, or the ``n`` most frequent (ties by token),
    valence a fixed function of the token: ``(length*7 + ascii(first char)) % 9 - 4``."""
    found = documents.select(F.explode(tokens(text_col)).alias("token")).filter(F.col("token") != "")
    if n is None:
        found = found.distinct()
    else:
        found = found.groupBy("token").agg(F.count(F.lit(1)).alias("freq")).orderBy(F.desc("freq"), F.asc("token")).limit(n)
    return found.select("token", ((F.length("token") * 7 + F.ascii("token")) % 9 - 4).cast("double").alias("valence"))
