"""Language ID by prediction by partial matching over bytes.

Training counts, per language, every byte in its context of the three bytes before it; the counts of the
shorter contexts follow by summing. The model is a context tree of order 3 with frozen statistics. A byte
unseen in its context costs the context's escape probability and is then coded one order lower (method C:
with n occurrences and d distinct successors a seen byte has count/(n+d), the escape d/(n+d); no
exclusions; below order 0 all 256 bytes are equally likely). The code length of a text under a language is
the sum over its bytes, and the prediction is the language with the shortest code; the score is its
posterior under equal priors.

Texts are folded first: Unicode lower case, every run of ASCII characters that are not letters becomes one
blank, and three zero bytes stand before the first byte, so each byte has a full context.

Scale: counting is one pass over the training rows with per-task sums before the shuffle by (language,
gram); the sums of the shorter contexts are made in Spark as well. Every count of every language stays in the
model. The contexts are ordered by their nearest byte first and cut into ranges of about ``MODEL_GRAMS``
(gram, language) cells. Scoring is one pass with a broadcast model and no shuffle if there is one range; otherwise
one pass a range, in which a task codes the bytes whose context is in the range, and the code lengths are
summed by text. The cut changes no code length.

Defined results: a null text, an empty text or one without a letter is ``und`` with score 0 and no code
length; with no training rows everything is ``und``; equal code lengths go to the language that sorts
first; a null id has no fold, trains and is not held out. Rows with a null text or language do not train.
"""

from __future__ import annotations

import re
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentiflow.llm.common import by_size, byte_map, held_out, read_table, small_batches, written

ORDER = 3
#: (gram, language) cells of order 3 that are broadcast at a time; larger models take further passes.
MODEL_GRAMS = 1 << 22
MASKS = (0xFF, 0xFFFF, 0xFFFFFF, 0xFFFFFFFF)
#: Beyond every context of three bytes.
LAST = 1 << 24
#: Bytes of text taken at a time: a code length takes eight bytes a byte and language.
SLICE_BYTES = 1 << 19
UNKNOWN = "und"
#: Texts shorter than this are too short to be told foreign.
JUDGED_BYTES = 32
LETTER_BYTES = byte_map([*range(0x61, 0x7B), *range(0x80, 0x100)])
LETTER = re.compile(r"[^\W\d_]")


def folded(text: str | None) -> bytes | None:
    """The bytes that are coded; None if the text has no letter."""
    if text is None or not LETTER.search(text):
        return None
    return b" ".join(text.lower().encode("utf-8").translate(LETTER_BYTES).split())


def context_keys(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """(keys, starts): of each byte the big-endian number of its three context bytes and itself; starts by text."""
    pad = b"\0" * ORDER
    data = np.frombuffer(pad + pad.join(texts) + pad, np.uint8).astype(np.uint32)
    keys = (data[:-3] << 24) | (data[1:-2] << 16) | (data[2:-1] << 8) | data[3:]
    lens = np.fromiter(map(len, texts), np.int64, len(texts))
    keys = keys[data[3:] != 0] if not any(b"\0" in t for t in texts) else _inside(keys, lens)
    return keys, np.concatenate([[0], np.cumsum(lens)[:-1]]) if len(lens) else np.zeros(0, np.int64)


def _inside(keys: np.ndarray, lens: np.ndarray) -> np.ndarray:
    """Keys at text positions, where texts hold zero bytes themselves."""
    at = np.repeat(np.cumsum(lens + ORDER) - lens - ORDER, lens)
    return keys[at + np.arange(lens.sum()) - np.repeat(np.cumsum(lens) - lens, lens)]


def count_grams(train: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """(lang, gram, n) over all rows of ``train`` whose text and language are not null."""

    def count(batches):
        sums: dict[str, list] = defaultdict(list)
        waiting: dict[str, list[bytes]] = defaultdict(list)
        size: dict[str, int] = defaultdict(int)

        def take(lang):
            keys, n = np.unique(context_keys(waiting.pop(lang))[0], return_counts=True)
            sums[lang].append((keys, n))
            size[lang] = 0
            if len(sums[lang]) >= 16:
                sums[lang] = [merged(sums[lang])]

        for batch in by_size(batches, "text", SLICE_BYTES):
            for text, lang in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                data = folded(text)
                if data:
                    waiting[lang].append(data)
                    size[lang] += len(data)
                    if size[lang] >= SLICE_BYTES:
                        take(lang)
        for lang in list(waiting):
            take(lang)
        for lang, parts in sums.items():
            keys, n = merged(parts)
            yield pa.RecordBatch.from_arrays(
                [pa.array([lang] * len(keys), pa.string()), pa.array(keys.astype(np.int64)), pa.array(n.astype(np.int64))],
                names=["lang", "gram", "n"],
            )

    rows = small_batches(train).select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang")).dropna()
    return rows.mapInArrow(count, "lang string, gram long, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))


def merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, at = np.unique(np.concatenate([k for k, _ in parts]), return_inverse=True)
    return keys, np.bincount(at, np.concatenate([n for _, n in parts]).astype(np.float64), len(keys)).astype(np.int64)


def turned(keys):
    """The three context bytes of order-3 keys (arrays or integer columns), the nearest byte first."""
    if isinstance(keys, np.ndarray):
        keys = keys.astype(np.int64)
        return (keys >> 8 & 0xFF) << 16 | (keys >> 16 & 0xFF) << 8 | keys >> 24
    byte = [F.shiftright(keys, n).bitwiseAND(F.lit(0xFF)) for n in (8, 16, 24)]
    return F.shiftleft(byte[0], 16) + F.shiftleft(byte[1], 8) + byte[2]


class ContextTrees:
    """Code lengths in bits under several languages of bytes whose turned context is in [low, high).

    ``nodes`` has by order (language numbers, keys, counts); those of the range and of all shorter contexts of it.
    """

    def __init__(self, langs: list[str], nodes: list[tuple[np.ndarray, np.ndarray, np.ndarray]], low: int = 0, high: int = LAST):
        self.langs, self.low, self.high = langs, low, high
        self.keys = [np.unique(np.append(own, 0).astype(np.uint32)) for _, own, _ in nodes]
        keys = self.keys
        n = [np.zeros((len(k), len(langs))) for k in keys]
        for k, (lang, own, count) in enumerate(nodes):
            n[k][np.searchsorted(keys[k], own.astype(np.uint32)), lang] = count
        #: By order: contexts and their escape lengths; grams and their lengths.
        self.contexts, self.escape, self.bits = [], [], []
        for k in range(ORDER + 1):
            ctx, at = np.unique(keys[k] >> 8, return_inverse=True)
            total = np.zeros((len(ctx), len(self.langs)))
            kinds = np.zeros_like(total)
            np.add.at(total, at, n[k])
            np.add.at(kinds, at, n[k] > 0)
            with np.errstate(divide="ignore", invalid="ignore"):
                escape = np.where(total > 0, np.log2((total + kinds) / kinds), 0.0)
                seen = np.log2((total + kinds)[at] / n[k])
            lower = np.full(n[k].shape, 8.0) if k == 0 else self._lower(k, keys[k])
            self.contexts.append(ctx)
            self.escape.append(escape)
            self.bits.append(np.where(n[k] > 0, seen, escape[at] + lower))

    def _lower(self, k: int, keys: np.ndarray) -> np.ndarray:
        """Lengths of ``keys`` of order ``k`` when coded at order ``k - 1``; they all occur there."""
        short = keys & np.uint32((1 << 8 * k) - 1)
        return self.bits[k - 1][np.searchsorted(self.keys[k - 1], short)]

    def lengths(self, keys: np.ndarray) -> np.ndarray:
        """(len(keys), languages) bits of each byte in its context."""
        out = np.empty((len(keys), len(self.langs)))
        rest = np.arange(len(keys))
        spent = np.zeros((len(keys), len(self.langs)))
        for k in range(ORDER, -1, -1):
            mine = keys[rest] & np.uint32((1 << 8 * (k + 1)) - 1)
            at = np.minimum(np.searchsorted(self.keys[k], mine), len(self.keys[k]) - 1)
            hit = self.keys[k][at] == mine
            out[rest[hit]] = spent[rest[hit]] + self.bits[k][at[hit]]
            rest, mine = rest[~hit], mine[~hit]
            if not len(rest):
                return out
            ctx = mine >> 8
            at = np.minimum(np.searchsorted(self.contexts[k], ctx), len(self.contexts[k]) - 1)
            spent[rest] += np.where((self.contexts[k][at] == ctx)[:, None], self.escape[k][at], 0.0)
        out[rest] = spent[rest] + 8.0
        return out

    def text_bits(self, texts: list[bytes]) -> np.ndarray:
        """(texts, languages) code lengths in bits; bytes out of the range count nothing."""
        keys, starts = context_keys(texts)
        whole = self.low == 0 and self.high == LAST
        if not whole:
            context = turned(keys)
            inside = np.flatnonzero((context >= self.low) & (context < self.high))
            places, keys = len(keys), keys[inside]
        distinct_first = self.keys[ORDER]
        at = np.minimum(np.searchsorted(distinct_first, keys), len(distinct_first) - 1)
        bits = self.bits[ORDER][at]
        miss = np.flatnonzero(distinct_first[at] != keys)
        if len(miss):
            bits[miss] = self.lengths(keys[miss])
        if not whole:
            spread = np.zeros((places, len(self.langs)))
            spread[inside] = bits
            bits = spread
        return np.add.reduceat(bits, starts, axis=0)


class LanguageModel:
    """All counts of all languages, by ranges of turned contexts; one range is brought to the driver at a time.

    ``nodes`` is (k, lang, gram, n, context): the sums of every order ``k``, a shorter context with zeros for what it lacks.
    """

    def __init__(self, nodes: DataFrame, langs: list[str], ranges: list[tuple[int, int]]):
        self.nodes, self.langs, self.ranges = nodes, langs, ranges
        self._held: tuple[int, ContextTrees] | None = None

    def block(self, i: int) -> ContextTrees:
        if self._held is None or self._held[0] != i:
            self._held = None
            low, high = self.ranges[i]
            least = F.when(F.col("k") == 3, low).when(F.col("k") == 2, low & ~0xFF).when(F.col("k") == 1, low & ~0xFFFF).otherwise(0)
            got = self.nodes.where((F.col("context") >= least) & (F.col("context") < high)).drop("context").toArrow()
            number = pc.index_in(got.column("lang"), pa.array(self.langs, pa.string())).to_numpy()
            order, gram, n = (got.column(c).to_numpy() for c in ("k", "gram", "n"))
            own = [order == k for k in range(ORDER + 1)]
            self._held = i, ContextTrees(self.langs, [(number[x], gram[x], n[x]) for x in own], low, high)
        return self._held[1]

    @property
    def keys(self) -> list[np.ndarray]:
        """By order the grams of the block with the most: what a task holds at a time."""
        return max((self.block(i).keys for i in range(len(self.ranges))), key=lambda keys: len(keys[ORDER]))

    def text_bits(self, texts: list[bytes]) -> np.ndarray:
        """(texts, languages) code lengths in bits."""
        return sum(self.block(i).text_bits(texts) for i in range(len(self.ranges)))


def fit_language_model(train: DataFrame, text_col: str = "text", lang_col: str = "lang", max_grams: int = MODEL_GRAMS):
    """A LanguageModel over all rows of ``train``, in blocks of ``max_grams`` cells; None if there is nothing to learn from."""
    counts = written(count_grams(train, text_col, lang_col), "grams")
    langs = sorted(r["lang"] for r in counts.select("lang").distinct().collect())
    if not langs:
        return None
    nodes = None
    for k, mask in enumerate(MASKS):
        kept = (LAST - 1) ^ ((1 << 8 * (ORDER - k)) - 1)  # bytes of the turned context that order k has
        gram = F.col("gram").bitwiseAND(F.lit(mask))
        own = counts if k == ORDER else counts.groupBy("lang", gram.alias("gram")).agg(F.sum("n").alias("n"))
        own = own.select(F.lit(k).alias("k"), "lang", "gram", "n", turned(F.col("gram")).bitwiseAND(F.lit(kept)).alias("context"))
        nodes = own if nodes is None else nodes.unionByName(own)
    nodes = written(nodes, "nodes")
    return LanguageModel(nodes, langs, context_ranges(nodes.where(F.col("k") == ORDER), len(langs), max_grams))


def context_ranges(grams: DataFrame, langs: int, most: int) -> list[tuple[int, int]]:
    """Ranges [low, high) of turned contexts that cover all, of at most ``most`` cells unless one context has more.

    The driver sees 2^16 contexts of two bytes; only one of more than ``most`` cells comes context by context.
    """
    pair = F.col("context").bitwiseAND(F.lit(LAST - 256))
    cells = grams.groupBy("context").agg((F.count_distinct("gram") * langs).alias("cells"))
    cells = cells.withColumn("together", F.sum("cells").over(Window.partitionBy(pair)))
    pieces = cells.groupBy(F.when(F.col("together") > most, F.col("context")).otherwise(pair).alias("first")).agg(F.sum("cells").alias("cells"))
    edges, held = [0], 0
    for first, own in sorted(pieces.collect()):
        if held and held + own > most:
            edges.append(first)
            held = 0
        held += own
    return list(zip(edges, [*edges[1:], LAST]))


def coded(model: ContextTrees, texts: list[str | None]) -> list[np.ndarray | None]:
    """Bits by language of each text; None where there is nothing to code."""
    out: list[np.ndarray | None] = [None] * len(texts)
    rows, data, size = [], [], 0

    def take():
        for i, bits in zip(rows, model.text_bits(data)):
            out[i] = bits
        rows.clear(), data.clear()

    for i, text in enumerate(texts):
        own = folded(text)
        if own:
            rows.append(i), data.append(own)
            size += len(own)
            if size >= SLICE_BYTES:
                take()
                size = 0
    if rows:
        take()
    return out


def best_languages(known: list[str], lengths: list[np.ndarray | None]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """(language, score, bits of the shortest code; NaN for ``und``) of each text."""
    langs, score, length = [UNKNOWN] * len(lengths), np.zeros(len(lengths)), np.full(len(lengths), np.nan)
    rows = [i for i, bits in enumerate(lengths) if bits is not None]
    if rows:
        bits = np.stack([lengths[i] for i in rows])
        low = bits.min(axis=1)
        score[rows] = 1.0 / np.exp2(np.minimum(0.0, low[:, None] - bits)).sum(axis=1)
        length[rows] = low
        for i, j in zip(rows, bits.argmin(axis=1)):
            langs[i] = known[j]
    return langs, score, length


def with_bits(rows: DataFrame, model: LanguageModel, text_col: str) -> DataFrame:
    """(row, bits): each row as one struct, its code lengths by language summed over all blocks of the model: one pass a block."""
    numbered = written(rows.select(F.struct("*").alias("row"), F.monotonically_increasing_id().alias("id")), "texts")
    parts = None
    for i in range(len(model.ranges)):
        shared = rows.sparkSession.sparkContext.broadcast(model.block(i))

        def code(batches, shared=shared):
            for batch in by_size(batches, "text", SLICE_BYTES):
                bits = coded(shared.value, batch.column("text").to_pylist())
                yield pa.RecordBatch.from_arrays([batch.column("id"), pa.array(bits, pa.list_(pa.float64()))], names=["id", "bits"])

        part = small_batches(numbered).select("id", F.col("row")[text_col].alias("text")).mapInArrow(code, "id long, bits array<double>")
        part = written(part.where("bits is not null").select("id", F.lit(i).alias("block"), "bits"), "bits")
        shared.destroy()
        parts = part if parts is None else parts.unionByName(part)
    ordered = F.transform(F.sort_array(F.collect_list(F.struct("block", "bits"))), lambda x: x["bits"])
    none = F.array_repeat(F.lit(0.0), len(model.langs))
    total = F.aggregate(ordered, none, lambda a, x: F.zip_with(a, x, lambda u, v: u + v))
    return numbered.join(parts.groupBy("id").agg(total.alias("bits")), "id", "left").select("row", "bits")


def judged(rows: DataFrame, model: LanguageModel | None, text_col: str, finish, schema) -> DataFrame:
    """``finish(batch, langs, score, bits)`` of all batches of ``rows``."""
    known = model.langs if model else []
    several = model is not None and len(model.ranges) > 1
    shared = rows.sparkSession.sparkContext.broadcast(model.block(0) if model and not several else None)
    at = rows.columns.index(text_col)

    def judge(batches):
        for batch in batches if several else by_size(batches, text_col, SLICE_BYTES):
            if several:
                lengths = [None if x is None else np.array(x) for x in batch.column("bits").to_pylist()]
                batch = pa.RecordBatch.from_struct_array(batch.column("row"))
            elif shared.value is not None:
                lengths = coded(shared.value, batch.column(at).to_pylist())
            else:
                lengths = [None] * batch.num_rows
            yield finish(batch, *best_languages(known, lengths))

    rows = with_bits(rows, model, text_col) if several else rows
    return small_batches(rows).mapInArrow(judge, schema)


def identify_languages(
    docs: DataFrame, model: LanguageModel | None, id_col: str = "doc_id", text_col: str = "text", folds: int = 4
) -> DataFrame:
    """(doc_id, held_out, lang_pred, score, code_bits) of every row."""

    def predicted(batch, langs, score, bits):
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), pa.array(langs, pa.string()), pa.array(score), pa.array(bits, from_pandas=True)],
            names=["doc_id", "held_out", "lang_pred", "score", "code_bits"],
        )

    rows = docs.select(
        F.col(id_col).alias("doc_id"), held_out(F.col(id_col), folds).alias("held_out"), F.col(text_col).alias("text")
    )
    kind = docs.schema[id_col].dataType.simpleString()
    return judged(rows, model, "text", predicted, f"doc_id {kind}, held_out boolean, lang_pred string, score double, code_bits double")


def keep_identified(docs: DataFrame, model: LanguageModel | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that some language explains, all columns as they are.

    ``und`` goes, and so does a text of ``JUDGED_BYTES`` or more whose shortest code takes 8 bits or more for each of its bytes: no
    language of the model says more about it than none. Languages that share a short text do not reject it.
    """
    at = docs.columns.index(text_col)

    def kept(batch, langs, score, bits):
        size = np.asarray(pc.fill_null(pc.binary_length(batch.column(at)), 0))
        foreign = (size >= JUDGED_BYTES) & (np.nan_to_num(bits) >= 8.0 * size)
        return batch.filter(pa.array([x != UNKNOWN and not f for x, f in zip(langs, foreign)], pa.bool_()))

    return judged(docs, model, text_col, kept, docs.schema)


def keep_explained(docs: DataFrame, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """``keep_identified`` under models that have not seen the text: each half of the texts is judged by the model of the other.

    Halves go by the hash of the text, so copies of a text do not explain each other. A half is judged by the model of all rows if the
    other has nothing to learn from.
    """
    half = F.pmod(F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))), F.lit(2))
    parts = []
    for own in (0, 1):
        model = fit_language_model(docs.where(half != own), text_col, lang_col) or fit_language_model(docs, text_col, lang_col)
        parts.append(keep_identified(docs.where(half == own), model, text_col))
    return parts[0].unionByName(parts[1])


def op4_language_id(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    model = fit_language_model(docs.where(~held_out(F.col("doc_id"), 4)))
    return identify_languages(docs, model)
