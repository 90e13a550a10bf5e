"""Benchmark decontamination with an FM-index per shard of the training texts.

Every ``window`` consecutive words of a benchmark item form a phrase (an item with fewer words, but not
none, is one phrase). Each shard of documents is indexed, all phrases are searched backwards through
wavelet-tree ranks at once, occurrences are located by sampled suffix positions, and the words inside
them are merged into removal spans.

Words that no phrase contains cannot be part of an occurrence, so in the index they are separators, and
runs between separators that are shorter than the shortest phrase are left out. The rest is indexed whole.
A shard is at most ``SHARD_BYTES`` of text (or one longer document).

Scale: documents are never shuffled; each task indexes its own shards. Phrases are broadcast in blocks of at most
``BLOCK_WORDS`` benchmark words; a larger benchmark takes one written pass over the documents a block.

Defined results: a null or empty text has no words and is clean; items without words are ignored; items
that share an id count once, a null id reads as the empty text; repeated rows and ids give one result a
row; without items or documents the result is clean or empty; other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentiflow.llm.common import UPPER, by_size, read_table, small_batches, utf8_column, words_of, written

WINDOW = 13
SHARD_BYTES = 4 << 20
BLOCK_WORDS = 1 << 20
#: Every so many text positions one suffix position is kept.
SAMPLE = 8
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans(UPPER, UPPER.lower())


class Bits:
    """A bit vector with constant-time rank."""

    def __init__(self, bits: np.ndarray):
        packed = np.packbits(bits, bitorder="little")
        self.words = np.concatenate([packed, np.zeros(16 - len(packed) % 8, np.uint8)]).view(np.uint64)
        self.before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.words), dtype=np.int64)])
        self.zeros = len(bits) - int(self.before[-1])

    def rank(self, at: np.ndarray) -> np.ndarray:
        """Ones before each position."""
        word, bit = at >> 6, (at & 63).astype(np.uint64)
        return self.before[word] + np.bitwise_count(self.words[word] & ((np.uint64(1) << bit) - np.uint64(1)))

    def get(self, at: np.ndarray) -> np.ndarray:
        return (self.words[at >> 6] >> (at & 63).astype(np.uint64)) & np.uint64(1) != 0


class WaveletTree:
    """Ranks of any symbol in a sequence; the tree's nodes lie level by level, zeros before ones."""

    def __init__(self, symbols: np.ndarray, kinds: int):
        self.levels = []
        for bit in range(max(1, int(kinds - 1).bit_length()) - 1, -1, -1):
            ones = (symbols >> bit) & 1 == 1
            self.levels.append((bit, Bits(ones)))
            symbols = np.concatenate([symbols[~ones], symbols[ones]])
        self.starts = self._down(np.arange(kinds), np.zeros(kinds, np.int64))

    def _down(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        for bit, bits in self.levels:
            ones = bits.rank(at)
            at = np.where((symbol >> bit) & 1 == 1, bits.zeros + ones, at - ones)
        return at

    def rank(self, symbol: np.ndarray, at: np.ndarray) -> np.ndarray:
        """Occurrences of each symbol before each position."""
        return self._down(symbol, at) - self.starts[symbol]

    def get(self, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(symbols at the positions, their ranks there)."""
        symbol = np.zeros(len(at), np.int64)
        for bit, bits in self.levels:
            one = bits.get(at)
            ones = bits.rank(at)
            at = np.where(one, bits.zeros + ones, at - ones)
            symbol |= one.astype(np.int64) << bit
        return symbol, at - self.starts[symbol]


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """Suffixes in order, by doubling the compared length; each separator (0) is a symbol of its own below all words."""
    n = len(symbols)
    breaks = symbols == 0
    rank = np.where(breaks, np.cumsum(breaks) - 1, symbols.astype(np.int64) + int(breaks.sum()))
    order = np.argsort(rank, kind="stable")
    length = 1
    while True:
        head = rank[order]
        rank = np.empty(n, np.int64)
        new = np.concatenate([[0], np.cumsum(head[1:] != head[:-1])])
        rank[order] = new
        if n == 0 or new[-1] == n - 1:
            return order
        key = rank * (n + 1)
        key[:-length] += rank[length:] + 1
        rank = key
        order = np.argsort(rank, kind="stable")
        length *= 2


class FMIndex:
    """Backward search over word numbers; 0 separates texts and must end the sequence."""

    def __init__(self, symbols: np.ndarray, kinds: int):
        order = suffix_array(symbols)
        previous = symbols[order - 1]  # before the first stands the last, a separator
        self.size = len(symbols)
        self.tree = WaveletTree(previous, kinds)
        self.below = np.concatenate([[0], np.cumsum(np.bincount(symbols, minlength=kinds))])[:-1]
        kept = (order % SAMPLE == 0) | (previous == 0)  # a walk never passes a separator
        self.kept = Bits(kept)
        self.positions = order[kept]

    def search(self, phrases: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Row ranges [low, high) of equally long phrases."""
        low = np.zeros(len(phrases), np.int64)
        high = np.full(len(phrases), self.size, np.int64)
        alive = np.arange(len(phrases))
        for step in range(phrases.shape[1] - 1, -1, -1):
            symbol = phrases[alive, step]
            low[alive] = self.below[symbol] + self.tree.rank(symbol, low[alive])
            high[alive] = self.below[symbol] + self.tree.rank(symbol, high[alive])
            alive = alive[low[alive] < high[alive]]
        return low, np.maximum(low, high)

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text positions of rows, walking back to a kept one."""
        out = np.empty(len(rows), np.int64)
        at, steps = np.arange(len(rows)), 0
        rows = rows.copy()
        while len(at):
            here = self.kept.get(rows)
            out[at[here]] = self.positions[self.kept.rank(rows[here])] + steps
            at, rows = at[~here], rows[~here]
            if len(at):
                symbol, rank = self.tree.get(rows)
                rows = self.below[symbol] + rank
                steps += 1
        return out


class Phrases:
    """The phrases of a block of benchmark items, as numbers of a shared vocabulary."""

    def __init__(self, items: list[tuple[str, list[bytes]]], window: int):
        self.vocabulary: dict[bytes, int] = {}
        holders: dict[tuple[int, ...], set[str]] = defaultdict(set)
        for item, words in items:
            ids = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in words]
            size = min(window, len(ids))
            for i in range(len(ids) - size + 1):
                holders[tuple(ids[i : i + size])].add(item)
        #: By phrase length: (matrix of phrases, items of each).
        self.by_length = {}
        for size in sorted({len(p) for p in holders}):
            own = [p for p in holders if len(p) == size]
            self.by_length[size] = np.array(own, np.int64), [sorted(holders[p]) for p in own]
        self.shortest = min(self.by_length, default=0)

    def find(self, docs: list[list[bytes]]) -> tuple[np.ndarray, np.ndarray, list[set[str]]]:
        """(hit flags of all words, first word of each document, items found in each document)."""
        lens = np.fromiter(map(len, docs), np.int64, len(docs))
        first = np.cumsum(lens) - lens
        hit = np.zeros(int(lens.sum()) + 1, np.int64)
        found: list[set[str]] = [set() for _ in docs]
        if not self.by_length:
            return hit[:-1] > 0, first, found
        get = self.vocabulary.get
        ids = np.concatenate([np.zeros(1, np.int64), *(np.fromiter([*map(get, d, repeat(0)), 0], np.int64, len(d) + 1) for d in docs)])
        edges = np.flatnonzero(np.diff(ids != 0))  # before a run, and at its last word
        begin, end = edges[::2] + 1, edges[1::2] + 1
        long = end - begin >= self.shortest
        begin, end = begin[long], end[long]
        if not len(begin):
            return hit[:-1] > 0, first, found
        size = end - begin + 1  # with the separator
        shift = np.cumsum(size) - size
        at = np.repeat(begin - shift, size) + np.arange(int(size.sum()))
        index = FMIndex(ids[at], len(self.vocabulary) + 1)
        doc_of = np.repeat(np.arange(len(docs)), lens + 1)
        for length, (phrases, items) in self.by_length.items():
            low, high = index.search(phrases)
            many = high - low
            phrase = np.repeat(np.arange(len(phrases)), many)
            rows = np.repeat(low - np.cumsum(many) + many, many) + np.arange(int(many.sum()))
            place = at[index.locate(rows)] - 1  # the separator before all
            doc = doc_of[place] if len(place) else place
            word = place - doc  # one separator a document before it
            np.add.at(hit, word, 1)
            np.add.at(hit, word + length, -1)
            for d, p in set(zip(doc.tolist(), phrase.tolist())):
                found[d].update(items[p])
        return np.cumsum(hit)[:-1] > 0, first, found


def spans_of(text: str, hit: np.ndarray) -> list[dict]:
    """Maximal runs of hit words as code-point spans of the text."""
    places = [m.span() for m in WORD.finditer(text.translate(LOWER))]
    edges = np.flatnonzero(np.diff(np.concatenate([[0], hit.astype(np.int8), [0]])))
    return [{"start": places[a][0], "end": places[b - 1][1]} for a, b in zip(edges[::2], edges[1::2])]


SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
FOUND = pa.list_(pa.string())


def _scan(shared, inputs: int):
    """Batches of (the input's columns, text, hits so far, items so far) with the block's finds added."""

    def scan(batches):
        for batch in by_size(batches, "_text", SHARD_BYTES):
            data, off = utf8_column(batch.column(inputs))
            data = data.tobytes()
            docs = [words_of(data[a:b]) for a, b in zip(off[:-1], off[1:])]
            hit, first, found = shared.value.find(docs)
            flags, items = [], []
            earlier = zip(batch.column(inputs + 1).to_pylist(), batch.column(inputs + 2).to_pylist())
            for words, start, new, (old_hit, old_items) in zip(docs, first, found, earlier):
                own = hit[start : start + len(words)]
                if old_hit:
                    own = own | np.unpackbits(np.frombuffer(old_hit, np.uint8), count=len(words)).astype(bool)
                flags.append(np.packbits(own).tobytes() if own.any() else b"")
                items.append(sorted(new.union(old_items or ())))
            n_words = pa.array([len(d) for d in docs], pa.int64())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: inputs + 1], pa.array(flags, pa.binary()), pa.array(items, FOUND), n_words],
                names=[*batch.schema.names[: inputs + 1], "_hit", "_items", "_words"],
            )

    return scan


def item_blocks(benchmark: DataFrame, id_col: str, text_col: str, window: int, block_words: int):
    """Phrases of block after block of items, streamed from Spark."""
    block, size = [], 0
    for item, text in benchmark.select(F.col(id_col).cast("string"), F.col(text_col)).toLocalIterator():
        words = words_of((text or "").encode())
        if words:
            block.append((item or "", words))
            size += len(words)
        if size >= block_words:
            yield Phrases(block, window)
            block, size = [], 0
    yield Phrases(block, window)


def mark_contamination(docs, benchmark, text_col="text", item_col="item_id", item_text_col="text", window=WINDOW, block_words=BLOCK_WORDS):
    """(row, _text, _hit, _items, _words): each row of ``docs`` as one struct, its text, packed flags of hit words, items and number of words."""
    spark = docs.sparkSession
    out = small_batches(docs).select(F.struct("*").alias("row"), F.coalesce(F.col(text_col), F.lit("")).alias("_text"))
    out = out.select("*", F.lit(None).cast("binary").alias("_hit"), F.lit(None).cast("array<string>").alias("_items"))
    inputs = 1
    done = None
    for phrases in item_blocks(benchmark, item_col, item_text_col, window, block_words):
        if done is not None:
            out = written(done, "decontaminated").drop("_words")
        schema = T.StructType([*out.schema.fields, T.StructField("_words", T.LongType())])
        done = out.mapInArrow(_scan(spark.sparkContext.broadcast(phrases), inputs), schema)
    return done


def find_contamination(
    docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    item_col: str = "item_id", item_text_col: str = "text", window: int = WINDOW, block_words: int = BLOCK_WORDS,
) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated, spans) of every row.

    ``contaminated`` holds where at least a twentieth of the words, and one at least, lies in an occurrence.
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text"))
    marked = mark_contamination(rows, benchmark, "text", item_col, item_text_col, window, block_words).select("row.doc_id", "_text", "_hit", "_items", "_words")
    kind = docs.schema[id_col].dataType.simpleString()

    def digest(batches):
        for batch in batches:
            cols = {k: batch.column(k).to_pylist() for k in ("_text", "_hit", "_items", "_words")}
            hits, spans, sums = [], [], []
            for text, flags, items, words in zip(*cols.values()):
                own = np.unpackbits(np.frombuffer(flags, np.uint8), count=words) if flags else None
                hits.append(int(own.sum()) if flags else 0)
                spans.append(spans_of(text, own) if flags else [])
                sums.append(hashlib.sha256(",".join(items).encode()).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("_words"), pa.array(hits, pa.int64()),
                 pa.array([len(x) for x in cols["_items"]], pa.int64()), pa.array(sums, pa.string()),
                 pa.array([h > 0 and 20 * h >= w for h, w in zip(hits, cols["_words"])], pa.bool_()), pa.array(spans, SPANS)],
                names=["doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated", "spans"],
            )

    return marked.mapInArrow(
        digest,
        f"doc_id {kind}, n_words long, n_hit long, n_items long, items_sha256 string, contaminated boolean, "
        "spans array<struct<start:long,end:long>>",
    )


def drop_contaminated(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", window: int = WINDOW) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, all columns as they are."""
    marked = mark_contamination(docs, benchmark, text_col, window=window).select("row", "_hit", "_words")

    def clean(batches):
        for batch in batches:
            keep = []
            for flags, words in zip(batch.column("_hit").to_pylist(), batch.column("_words").to_pylist()):
                own = int(np.unpackbits(np.frombuffer(flags, np.uint8), count=words).sum()) if flags else 0
                keep.append(own == 0 or 20 * own < words)
            yield batch.select(["row"]).filter(pa.array(keep, pa.bool_()))

    return marked.mapInArrow(clean, marked.select("row").schema).select("row.*")


def op2_decontamination(spark, sf_dir):
    return find_contamination(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark")).drop("spans")


ORACLE_SQL = r"""
WITH b AS (
  SELECT item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), bw AS (
  SELECT DISTINCT item_id, least(13, len(w)) AS n, array_to_string(w[i:i + least(13, len(w)) - 1], ' ') AS phrase
  FROM (SELECT item_id, w, unnest(range(1, len(w) - least(13, len(w)) + 2)) AS i FROM b WHERE len(w) > 0)
), d AS (
  SELECT row_number() OVER () AS r, doc_id,
         coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                     '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) AS w FROM documents
), lens AS (SELECT DISTINCT n FROM bw),
dw AS (
  SELECT r, i, n, array_to_string(w[i:i + n - 1], ' ') AS phrase
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, lens WHERE len(w) >= n)
), occ AS (SELECT DISTINCT r, i, bw.n, item_id FROM dw JOIN bw ON dw.n = bw.n AND dw.phrase = bw.phrase),
hit AS (SELECT r, count(DISTINCT k) AS n_hit FROM (SELECT r, unnest(range(i, i + n)) AS k FROM occ) GROUP BY r),
its AS (
  SELECT r, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
  FROM (SELECT DISTINCT r, CAST(item_id AS VARCHAR) AS s FROM occ) GROUP BY r
)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN its USING (r)
"""
