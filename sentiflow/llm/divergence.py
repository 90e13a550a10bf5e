"""Source divergence audit over transducer vocabularies.

Each language keeps the terms of at least ``least`` of its documents. The kept terms, sorted, are built into minimal acyclic
transducers: states with the same continuations are one state, and every arc carries how many terms come before those behind
it, so the sum along a path is the term's lexicographic ordinal. All texts are then streamed through the transducers, all words of
a slice in step, and what reaches a final state is counted by (language, source, ordinal). From then on terms are
ordinals, which also break ties: they ascend as the terms' UTF-8 bytes do.

From the counts come smoothed integer shares of each kept term in each source and language, the summed difference of every two sources
of a language (part ``pair``), and the terms that a source uses more than its language (part ``term``).

Scale: documents are counted by (language, term) in each task before the shuffle. Sorted terms are cut into pieces of ``PIECE`` terms, a
transducer each; a pass over the corpus takes as many pieces as fit ``PASS_BYTES`` as a broadcast, further pieces are further
passes. Counts leave a task summed by (language, source, ordinal). Sources are compared in cells of ``CELL_TERMS`` terms by
two buckets of about ``CELL_SOURCES`` sources, so no task holds a language, however hot; what leaves a cell is a sum for each two sources, which the result
holds anyway. Only pieces of a pass reach the driver.

Defined results: null text, lang and source are ''. Documents without terms still make their group; a language without kept terms
has pairs of value 0 and no terms. A language of one source has no pairs. Repeated rows are documents of their own; ids are not read.
An empty table gives no rows. Terms may be of any length. Other columns are not read.
"""

from __future__ import annotations

import io
from collections import Counter, defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentiflow.llm.common import arrow_rows, by_size, byte_map, deleted, kept, read_table, utf8_column

#: Terms a transducer, bytes of transducers a pass, entries a task holds before it hands them on, bytes of text at a time.
PIECE = 1 << 16
PASS_BYTES = 64 << 20
HELD = 1 << 18
SLICE_BYTES = 4 << 20
#: Terms and (about) sources of a cell.
CELL_TERMS = 1024
CELL_SOURCES = 128
#: Fixed values of the shares: parts, and what is added to every count.
PARTS = 1_000_000_000
ADDED = 5
#: ASCII letters and every byte of a non-ASCII character.
TERM_BYTES = byte_map([*range(0x61, 0x7B), *range(0x80, 0x100)])


# ---------------------------------------------------------------- transducer


class Transducer:
    """A minimal acyclic transducer in arrays: 256-bit sets of labels, and arcs in the order of (state, label)."""

    def __init__(self, root, final, sets, arcs_at, target, before):
        self.root, self.final, self.sets, self.arcs_at, self.target, self.before = root, final, sets, arcs_at, target, before

    @classmethod
    def build(cls, terms) -> Transducer:
        """From distinct terms (bytes) in ascending order: what lies behind the common prefix with the next term is final and is
        merged with an equal state, if there is one."""
        register, states, size = {}, [], []
        path, last = [[False, [], []]], b""

        def frozen(node) -> int:
            key = (node[0], tuple(node[1]), tuple(node[2]))
            found = register.get(key)
            if found is None:
                found = register[key] = len(states)
                states.append(key)
                size.append(key[0] + sum(size[t] for t in key[2]))
            return found

        def shorten(to: int) -> None:
            while len(path) > to + 1:
                done = frozen(path.pop())
                path[-1][2].append(done)

        for term in terms:
            same, most = 0, min(len(term), len(last))
            while same < most and term[same] == last[same]:
                same += 1
            shorten(same)
            for label in term[same:]:
                path[-1][1].append(label)
                path.append([False, [], []])
            path[-1][0], last = True, term
        shorten(0)
        root = frozen(path[0])
        many = np.array([len(s[1]) for s in states])
        labels = np.array([x for s in states for x in s[1]], np.int64)
        target = np.array([x for s in states for x in s[2]], np.int32)
        of = np.repeat(np.arange(len(states)), many)
        sets = np.zeros((len(states), 4), np.uint64)
        np.bitwise_or.at(sets, (of, labels >> 6), np.uint64(1) << (labels & 63).astype(np.uint64))
        per_word = np.bincount(of * 4 + (labels >> 6), minlength=4 * len(states))
        arcs_at = (np.cumsum(per_word) - per_word).reshape(-1, 4).astype(np.int32)
        final = np.array([s[0] for s in states])
        held = np.array(size, np.int64)[target] if len(target) else np.zeros(0, np.int64)
        ahead = np.cumsum(held) - held
        first = (np.cumsum(many) - many)[of] if len(of) else np.zeros(0, np.int64)
        before = (ahead - ahead[first] + final[of]) if len(of) else held
        return cls(root, final, sets, arcs_at, target, before.astype(np.int32))

    def ordinals(self, data: np.ndarray, start: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The ordinal of each word, -1 for words that are no term; all words take a step at a time."""
        out = np.full(len(start), -1, np.int64)
        live, state, total, step = np.arange(len(start)), np.full(len(start), self.root), np.zeros(len(start), np.int64), 0
        while len(live):
            over = size[live] == step
            if over.any():
                ended = over & self.final[state]
                out[live[ended]] = total[ended]
                live, state, total = live[~over], state[~over], total[~over]
            label = data[start[live] + step]
            word, bit = label >> 6, (label & 63).astype(np.uint64)
            have = self.sets[state, word]
            arc = self.arcs_at[state, word] + np.bitwise_count(have & ((np.uint64(1) << bit) - np.uint64(1)))
            goes = (have >> bit) & np.uint64(1) == 1
            live, arc = live[goes], arc[goes]
            state, total, step = self.target[arc], total[goes] + self.before[arc], step + 1
        return out

    def packed(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, root=self.root, final=self.final, sets=self.sets, arcs_at=self.arcs_at, target=self.target, before=self.before)
        return out.getvalue()

    @classmethod
    def unpacked(cls, data: bytes) -> Transducer:
        held = np.load(io.BytesIO(data))
        return cls(int(held["root"]), *[held[k] for k in ("final", "sets", "arcs_at", "target", "before")])


# ---------------------------------------------------------------- vocabulary


def terms_of(data: bytes) -> list[bytes]:
    return data.translate(TERM_BYTES).split()


def term_documents(docs: DataFrame) -> DataFrame:
    """(lang, term, n): in how many documents of the language a term occurs, summed in each task."""

    def count(batches):
        held, size = defaultdict(Counter), 0

        def rows():
            for lang, terms in held.items():
                yield pa.RecordBatch.from_arrays(
                    [pa.array([lang] * len(terms), pa.string()), pa.array(list(terms), pa.binary()), pa.array(list(terms.values()), pa.int64())],
                    names=["lang", "term", "n"],
                )

        for batch in batches:
            for lang, text in zip(batch.column("lang").to_pylist(), batch.column("text")):
                mine = held[lang]
                size -= len(mine)
                mine.update(set(terms_of(text.as_buffer().to_pybytes())))
                size += len(mine)
                if size >= HELD:
                    yield from rows()
                    held, size = defaultdict(Counter), 0
        yield from rows()

    parts = docs.select("lang", "text").mapInArrow(count, "lang string, term binary, n long")
    return parts.groupBy("lang", "term").agg(F.sum("n").alias("n"))


def vocabulary(docs: DataFrame, least: int, piece: int) -> tuple[DataFrame, str]:
    """Kept terms (lang, first, at, term) by place in their piece, and pieces (lang, first, n, machine); with the folder.

    A piece is known by its language and first term.
    """
    terms, folder = kept(term_documents(docs).where(F.col("n") >= least).select("lang", "term"), "terms")
    parts = -(-terms.count() // piece) or 1
    ordered = terms.repartitionByRange(parts, "lang", "term").sortWithinPartitions("lang", "term")
    schema = pa.schema([("lang", pa.string()), ("first", pa.binary()), ("at", pa.int64()), ("term", pa.binary()), ("n", pa.int64()), ("machine", pa.binary())])

    def finished(lang, held):
        rows = [(lang, held[0], i, t, None, None) for i, t in enumerate(held)]
        rows.append((lang, held[0], None, None, len(held), Transducer.build(held).packed()))
        return pa.RecordBatch.from_arrays([pa.array(list(c), f.type) for c, f in zip(zip(*rows), schema)], schema=schema)

    def build(batches):
        lang, held = None, []
        for batch in batches:
            for new, term in zip(batch.column("lang").to_pylist(), batch.column("term").to_pylist()):
                if held and (new != lang or len(held) == piece):
                    yield finished(lang, held)
                    held = []
                lang = new
                held.append(term)
        if held:
            yield finished(lang, held)

    out, at = kept(ordered.mapInArrow(build, "lang string, first binary, at long, term binary, n long, machine binary"), "vocabulary")
    deleted(docs.sparkSession, folder)
    return out, at


def numbered(vocab: DataFrame) -> DataFrame:
    """(lang, first, base, machine) of every piece: ``base`` terms of its language come before it."""
    before = Window.partitionBy("lang").orderBy("first").rowsBetween(Window.unboundedPreceding, -1)  # a row a piece
    pieces = vocab.where(F.col("machine").isNotNull())
    base = pieces.select("lang", "first", "n").withColumn("base", F.coalesce(F.sum("n").over(before), F.lit(0)))
    return pieces.select("lang", "first", "machine").join(base, ["lang", "first"])


# ---------------------------------------------------------------- counts


def words_at(data: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(folded bytes, start, size, row) of every term of texts that lie one after another."""
    folded = np.frombuffer(data.tobytes().translate(TERM_BYTES), np.uint8)
    inside = np.concatenate([[False], folded != 32, [False]])
    edge = np.zeros(len(folded) + 1, bool)
    edge[off] = True
    start = np.flatnonzero(inside[1:-1] & (~inside[:-2] | edge[:-1]))
    end = np.flatnonzero(inside[1:-1] & (~inside[2:] | edge[1:])) + 1
    return folded, start, end - start, np.searchsorted(off, start, side="right") - 1


class Tally:
    """Counts by (language, source, ordinal), held in arrays up to a size."""

    ORDINAL_BITS = 40

    def __init__(self):
        self.names, self.key, self.n, self.waiting, self.size = {}, np.zeros(0, np.int64), np.zeros(0, np.int64), [], 0

    def group(self, lang: str, source: str) -> int:
        return self.names.setdefault((lang, source), len(self.names))

    def add(self, group: np.ndarray, ordinal: np.ndarray) -> None:
        self.waiting.append(group << self.ORDINAL_BITS | ordinal)
        self.size += len(ordinal)
        if self.size >= HELD:
            self.merge()

    def merge(self) -> None:
        key, n = np.unique(np.concatenate([np.zeros(0, np.int64), *self.waiting]), return_counts=True)
        both = np.concatenate([self.key, key])
        order = np.argsort(both, kind="stable")
        both, n = both[order], np.concatenate([self.n, n])[order]
        new = np.flatnonzero(np.diff(both, prepend=-1))
        self.key, self.n = both[new], np.add.reduceat(n, new) if len(new) else n
        self.waiting, self.size = [], 0

    def rows(self) -> pa.RecordBatch:
        """What is held, which is then empty; the groups keep their numbers."""
        self.merge()
        group = pa.array(self.key >> self.ORDINAL_BITS)
        langs, sources = [pa.array([g[i] for g in self.names], pa.string()).take(group) for i in (0, 1)]
        ordinal = pa.array(self.key & ((1 << self.ORDINAL_BITS) - 1))
        out = pa.RecordBatch.from_arrays([langs, sources, ordinal, pa.array(self.n)], names=["lang", "source", "ord", "n"])
        self.key, self.n = self.key[:0], self.n[:0]
        return out


def recount(docs: DataFrame, machines: list[tuple[str, int, bytes]]) -> DataFrame:
    """(lang, source, ord, n) of all texts streamed through some pieces' transducers."""
    shared = docs.sparkSession.sparkContext.broadcast(machines)

    def stream(batches):
        of = defaultdict(list)
        for lang, base, machine in shared.value:
            of[lang].append((base, Transducer.unpacked(machine)))
        tally = Tally()
        for batch in by_size(batches, "text", SLICE_BYTES):
            langs, sources = batch.column("lang").to_pylist(), batch.column("source").to_pylist()
            group = np.array([tally.group(*g) for g in zip(langs, sources)])
            folded, start, size, row = words_at(*utf8_column(batch.column("text")))
            for lang in set(langs) & of.keys():
                mine = np.flatnonzero(np.array([x == lang for x in langs])[row])
                for base, machine in of[lang]:
                    found = machine.ordinals(folded, start[mine], size[mine])
                    hit = found >= 0
                    tally.add(group[row[mine[hit]]], found[hit] + base)
            if len(tally.n) >= HELD:
                yield tally.rows()
        yield tally.rows()

    parts = docs.select("lang", "source", "text").mapInArrow(stream, "lang string, source string, ord long, n long")
    return parts.groupBy("lang", "source", "ord").agg(F.sum("n").alias("n"))


def passes(pieces: DataFrame, most: int):
    """Lists of pieces that fit ``most`` bytes (one piece at least), streamed from Spark."""
    held, size = [], 0
    for r in pieces.select("lang", "base", "machine").toLocalIterator():
        if held and size + len(r["machine"]) > most:
            yield held
            held, size = [], 0
        held.append((r["lang"], r["base"], bytes(r["machine"])))
        size += len(r["machine"])
    if held:
        yield held


# ---------------------------------------------------------------- divergence


def share(count, total, terms):
    """1 + floor(PARTS * (count + 5) / (total + 5 * terms)), exactly."""
    return F.expr(f"1 + CAST(CAST({PARTS} AS DECIMAL(18,0)) * CAST({count} + {ADDED} AS DECIMAL(19,0)) div CAST({total} + {ADDED} * {terms} AS DECIMAL(19,0)) AS BIGINT)")


def source_pairs(counts: DataFrame, stats: DataFrame) -> DataFrame:
    """(lang, source, item, value) of every two different sources of a language.

    ``counts``: (lang, source, ord, n); ``stats``: (lang, source, total, v) of every group.
    """
    many = Window.partitionBy("lang")  # a row a source
    stats = stats.withColumn("buckets", F.ceil(F.count("*").over(many) / CELL_SOURCES).cast("int"))
    stats = stats.withColumn("bucket", F.pmod(F.xxhash64("source"), F.col("buckets")).cast("int"))
    stats = stats.withColumn("p", F.when(F.col("v") > 0, share("0", "total", "v")))
    others = F.sequence(F.lit(0), F.col("buckets") - 1)
    cells = F.transform(others, lambda x: F.struct(F.least("bucket", x).alias("a"), F.greatest("bucket", x).alias("b")))
    keys = ["lang", "block", "a", "b"]

    def placed(df, *columns):
        df = df.withColumn("cell", F.explode(cells))
        return df.select("lang", "block", F.col("cell.a").alias("a"), F.col("cell.b").alias("b"), "source", *columns).groupBy(*keys)

    blocks = F.greatest(F.ceil(F.col("v") / CELL_TERMS), F.lit(1)).cast("int")
    every = placed(stats.withColumn("block", F.explode(F.sequence(F.lit(0), blocks - 1))), "bucket", "v", "p")
    found = counts.join(stats.drop("p"), ["lang", "source"]).withColumn("p", share("n", "total", "v"))
    found = placed(found.withColumn("block", F.floor(F.col("ord") / CELL_TERMS).cast("int")), (F.col("ord") % CELL_TERMS).cast("int").alias("at"), "p")

    def cell(key, left: pa.Table, right: pa.Table) -> pa.Table:
        lang, block, a, b = (k.as_py() for k in key)
        sources, bucket = right.column("source").to_pylist(), np.array(right.column("bucket").to_pylist())
        width = min(CELL_TERMS, right.column("v")[0].as_py() - block * CELL_TERMS)
        p = np.repeat(np.array([x or 0 for x in right.column("p").to_pylist()], np.int64)[:, None], max(0, width), axis=1)
        place = {s: i for i, s in enumerate(sources)}
        p[[place[s] for s in left.column("source").to_pylist()], left.column("at").to_numpy()] = left.column("p").to_numpy()
        one, two, value = [], [], []
        for i in np.flatnonzero(bucket == a):
            rest = np.flatnonzero(bucket == b)
            rest = rest[rest > i] if a == b else rest
            one += [sources[i]] * len(rest)
            two += [sources[j] for j in rest]
            value += np.abs(p[rest] - p[i]).sum(axis=1).tolist()
        columns = [pa.array([lang] * len(one), pa.string()), pa.array(one, pa.string()), pa.array(two, pa.string()), pa.array(value, pa.int64())]
        return pa.Table.from_arrays(columns, names=["lang", "one", "two", "value"])

    parts = found.cogroup(every).applyInArrow(cell, "lang string, one string, two string, value long")
    sums = parts.select("lang", F.least("one", "two").alias("one"), F.greatest("one", "two").alias("two"), "value")
    sums = sums.groupBy("lang", "one", "two").agg(F.sum("value").alias("value"))
    sides = F.array(*[F.struct(F.col(x).alias("source"), F.col(y).alias("item")) for x, y in (("one", "two"), ("two", "one"))])
    return sums.select("lang", F.explode(sides).alias("side"), "value").select("lang", "side.source", "side.item", "value")


def audit(
    docs: DataFrame, least: int = 30, top: int = 50, lang_col: str = "lang", source_col: str = "source", text_col: str = "text",
    piece: int = PIECE, pass_bytes: int = PASS_BYTES,
) -> DataFrame:
    """(lang, source, part, item, value, rank): every two sources of a language, and each source's ``top`` terms."""
    spark = docs.sparkSession
    rows = docs.select(*[F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))])
    with arrow_rows(spark):
        vocab, _ = vocabulary(rows, least, piece)
        pieces = numbered(vocab)
        parts = [kept(recount(rows, held), "recounted")[0] for held in passes(pieces, pass_bytes)]
    counts = parts[0] if parts else spark.createDataFrame([], "lang string, source string, ord long, n long")
    for more in parts[1:]:
        counts = counts.unionByName(more)
    known = vocab.where(F.col("machine").isNotNull()).groupBy("lang").agg(F.sum("n").alias("v"))
    totals = counts.groupBy("lang", "source").agg(F.sum("n").alias("total"))
    stats = rows.select("lang", "source").distinct().join(totals, ["lang", "source"], "left").join(known, "lang", "left")
    stats, _ = kept(stats.select("lang", "source", *[F.coalesce(c, F.lit(0)).cast("long").alias(c) for c in ("total", "v")]), "groups")

    ranked = Window.partitionBy("lang", "source")
    pairs = source_pairs(counts, stats).withColumn("rank", F.row_number().over(ranked.orderBy(F.desc("value"), "item")))
    in_lang = counts.groupBy("lang", "ord").agg(F.sum("n").alias("all"))
    of_lang = stats.groupBy("lang").agg(F.sum("total").alias("lang_total"))
    terms = counts.join(in_lang, ["lang", "ord"]).join(stats, ["lang", "source"]).join(of_lang, "lang")
    terms = terms.withColumn("value", share("n", "total", "v") - share("all", "lang_total", "v")).where(F.col("value") > 0)
    terms = terms.withColumn("rank", F.row_number().over(ranked.orderBy(F.desc("value"), "ord"))).where(F.col("rank") <= top)
    names = vocab.where(F.col("at").isNotNull()).join(pieces.select("lang", "first", "base"), ["lang", "first"])
    names = names.select("lang", (F.col("base") + F.col("at")).alias("ord"), F.col("term").cast("string").alias("item"))
    columns = ["lang", "source", "part", "item", "value", "rank"]
    pairs, terms = pairs.withColumn("part", F.lit("pair")), terms.join(names, ["lang", "ord"]).withColumn("part", F.lit("term"))
    return pairs.select(*columns).unionByName(terms.select(*columns))


def op13_divergence(spark, sf_dir):
    return audit(read_table(spark, sf_dir, "documents"))


ORACLE_SQL = r"""
WITH d AS MATERIALIZED (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
         regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                            '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
  FROM documents
), t AS MATERIALIZED (SELECT r, lang, source, unnest(w) AS term FROM d),
k AS MATERIALIZED (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 30),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
g AS MATERIALIZED (SELECT DISTINCT lang, source FROM d),
c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN k USING (lang, term) GROUP BY lang, source, term),
e AS (SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n FROM g JOIN k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term),
p AS MATERIALIZED (
  SELECT lang, source, term, n, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang, source) + 5 * v) AS p
  FROM e JOIN v USING (lang)
), q AS (
  SELECT lang, term, 1 + (1000000000::HUGEINT * (n + 5)) // (sum(n) OVER (PARTITION BY lang) + 5 * v) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM e GROUP BY lang, term) JOIN v USING (lang)
), f AS (
  SELECT a.lang, a.source, b.source AS item, sum(abs(a.p - b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), pairs AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source
), terms AS (
  SELECT lang, source, 'term' AS part, term AS item, p - q AS value FROM p JOIN q USING (lang, term) WHERE n > 0 AND p > q
), ranked AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms)
)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 50
"""
