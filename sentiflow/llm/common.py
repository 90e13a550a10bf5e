"""Helpers shared by the corpus operators: table reads, written intermediates, ASCII folding, Arrow columns."""

from __future__ import annotations

import contextlib
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from sentiflow.session import scratch_path

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


#: Rows that cross between the JVM and Python at a time. A row holds a whole text, and both sides keep a batch in memory.
BATCH_ROWS = 1000


def small_batches(df: DataFrame) -> DataFrame:
    """``df``, with the session's Arrow batches cut to BATCH_ROWS rows if they are larger."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(df.sparkSession.conf.get(key)) <= BATCH_ROWS:
        df.sparkSession.conf.set(key, str(BATCH_ROWS))
    return df


@contextlib.contextmanager
def arrow_rows(spark: SparkSession, rows: int = BATCH_ROWS):
    """Arrow batches of at most ``rows`` rows for what is written inside the block; the session's setting comes back after it."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(rows))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def written(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` to a fresh folder under the shared checkpoint folder and read it back (cuts the lineage)."""
    return kept(df, tag)[0]


def kept(df: DataFrame, tag: str) -> tuple[DataFrame, str]:
    """As ``written``, with the folder, for ``deleted`` once nothing reads it any more."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm/{tag}-{uuid.uuid4().hex}")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def deleted(spark: SparkSession, path: str) -> None:
    """Delete a folder of written intermediates."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


def crc_fold(id_col: Column, n: int) -> Column:
    """``crc32(id as text) mod n``; null for a null id."""
    return F.pmod(F.crc32(id_col.cast("string").cast("binary")), F.lit(n))


def held_out(id_col: Column, n: int, fold: int = 2) -> Column:
    """True where the fold of the id is the held-out one; a null id has no fold and is not held out."""
    return F.coalesce(crc_fold(id_col, n) == fold, F.lit(False))


def ascii_lower(col: Column) -> Column:
    return F.translate(col, UPPER, UPPER.lower())


def byte_map(keep: Iterable[int]) -> bytes:
    """``bytes.translate`` table: A-Z lower-cased, ``keep`` kept, every other byte a blank."""
    table = bytearray(b" " * 256)
    for b in keep:
        table[b] = b
    for up, low in zip(UPPER.encode(), UPPER.lower().encode()):
        if table[low] == low:
            table[up] = low
    return bytes(table)


#: ASCII digits and letters and every byte of a non-ASCII character.
WORD_BYTES = byte_map([*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)])


def words_of(data: bytes) -> list[bytes]:
    """Lower-cased words ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` of UTF-8 bytes."""
    return data.translate(WORD_BYTES).split()


def utf8_column(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string or binary Arrow column; offsets has one entry more than the column."""
    if pa.types.is_string(col.type) or pa.types.is_binary(col.type):
        kind = np.int32
    else:
        kind = np.int64
    _, offsets, data = col.buffers()
    n = len(col)
    off = np.frombuffer(offsets, kind)[col.offset : col.offset + n + 1].astype(np.int64) if n else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return raw[off[0] : off[-1]], off - off[0]


def by_size(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Slices of ``batches`` that hold at most ``most`` bytes of ``column`` each (one row at least)."""
    for batch in batches:
        if not batch.num_rows:
            continue
        _, off = utf8_column(batch.column(column))
        start = 0
        while start < batch.num_rows:
            stop = int(np.searchsorted(off, off[start] + most, side="right")) - 1
            stop = min(max(stop, start + 1), batch.num_rows)
            yield batch.slice(start, stop - start)
            start = stop
