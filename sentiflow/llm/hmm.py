"""LM scoring with a hidden Markov model over word classes.

Tokens are lower-cased words and one end a text. With counts c over the training texts, N in all and V distinct,
a token has base probability (c+1)/(N+V+1); any unseen word is the one remaining symbol. In state k a
token w of class C has probability q_k(C) * base(w) / base(C), so every state is a distribution over the
same symbols. Words with ``FREQUENT`` training occurrences have a class by their hash, at any size of the corpus; other
words have too little evidence of their own and back off to one by the hash of their last three characters, the end and the unseen word one each; the unseen
word keeps its base probability in every state, so rare spellings gain nothing from the states.

Baum-Welch: forward and backward recursions over the training texts, with expected counts summed inside each task,
then by class across partitions; the updated model (at most ``CLASSES`` x ``STATES`` numbers) is broadcast.
The start comes from ``SEED_TEXTS`` texts; every pass after that covers all training texts. The scaled
forward recursion then gives the exact log likelihood of every text.

Scale: texts are shuffled once into chunks of about ``CHUNK_BYTES``; a chunk sends each of its distinct words
once to have its corpus count summed, and gets it back as the chunk's own dictionary, so the vocabulary is
never broadcast. Passes read the encoded texts without a shuffle of tokens.

Defined results: a null text is empty and holds only the end; a null id is a training row; without training texts the
score is the base score, with N = V = 0; repeated rows give repeated results; a text of any length is scored whole; other
columns are not read.
"""

from __future__ import annotations

from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentiflow.llm.common import byte_map, held_out, read_table, small_batches, written
from sentiflow.llm.hashing import PrefixHashes, mixed

CHUNK_BYTES = 16 << 20
FREQUENT = 200
STATES = 8
PASSES = 3
SEED_TEXTS = 400
UNSEEN, END, HALF = 0, 1, 8192
CLASSES = 2 + 2 * HALF
#: Share of the base distribution in every state.
SMOOTH = 0.01
BATCH_TOKENS = 400_000
#: Every byte but white space; upper case folds as in ``byte_map``.
TOKEN_BYTES = byte_map(b for b in range(256) if b not in (0x20, *range(0x09, 0x0E)))


def tokens_of(text: str | None) -> list[bytes]:
    return (text or "").encode().translate(TOKEN_BYTES).split()


def word_classes(words: list[bytes], counts: np.ndarray, frequent: int) -> np.ndarray:
    """Class numbers of words with corpus counts."""
    if not words:
        return np.zeros(0, np.int64)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    end = np.cumsum(sizes)
    data = np.frombuffer(b"".join(words), np.uint8)
    hashes = PrefixHashes(data)
    whole = mixed(hashes.of(end - sizes, sizes) + sizes.astype(np.uint64)) % np.uint64(HALF)
    tails = np.frombuffer(b"".join(w.decode()[-3:].encode().ljust(12, b"\0") for w in words), np.uint8)
    tail = mixed(PrefixHashes(tails).of(np.arange(len(words)) * 12, 12)) % np.uint64(HALF)
    classes = np.where(counts >= frequent, whole.astype(np.int64) + 2, tail.astype(np.int64) + 2 + HALF)
    return np.where(counts > 0, classes, UNSEEN)


def count_chunk(table: pa.Table) -> pa.Table:
    """Distinct words of a chunk with their counts in its training texts."""
    seen: Counter = Counter()
    learned: Counter = Counter()
    for text, held in zip(table.column("text").to_pylist(), table.column("held_out").to_pylist()):
        (seen if held else learned).update(tokens_of(text))
    words = list(learned.keys() | seen.keys())
    chunk = table.column("chunk")[0].as_py()
    return pa.table(
        {
            "chunk": pa.array([chunk] * len(words), pa.int64()),
            "word": pa.array(words, pa.binary()),
            "n": pa.array([learned.get(w, 0) for w in words], pa.int64()),
        }
    )


def encode_chunk(frequent: int):
    """(texts of a chunk, its dictionary) -> encoded texts, and one row with class sizes of the words it is first to hold."""

    def encode(docs: pa.Table, entries: pa.Table) -> pa.Table:
        words = entries.column("word").to_pylist()
        counts = entries.column("total").to_numpy()
        classes = word_classes(words, counts, frequent)
        number = dict(zip(words, range(len(words))))
        value = np.log10(counts + 1.0)
        out = {k: [] for k in ("doc_id", "held_out", "n_words", "n_known", "logs", "classes")}
        for doc, held, text in zip(*(docs.column(k).to_pylist() for k in ("doc_id", "held_out", "text"))):
            own = tokens_of(text)
            at = np.fromiter(map(number.__getitem__, own), np.int64, len(own))
            out["doc_id"].append(doc)
            out["held_out"].append(held)
            out["n_words"].append(len(own))
            out["n_known"].append(int((counts[at] > 0).sum()))
            out["logs"].append(float(value[at].sum()))
            out["classes"].append(np.append(classes[at], END).astype(np.uint16).tobytes())
        first = entries.column("first").to_numpy(zero_copy_only=False) & (counts > 0)
        sizes = np.bincount(classes[first], minlength=CLASSES).astype(np.uint32)
        for k, v in (("doc_id", None), ("held_out", None), ("n_words", -1), ("n_known", 0), ("logs", 0.0), ("classes", sizes.tobytes())):
            out[k].append(v)
        kinds = [docs.schema.field("doc_id").type, pa.bool_(), pa.int64(), pa.int64(), pa.float64(), pa.binary()]
        return pa.table({k: pa.array(v, t) for (k, v), t in zip(out.items(), kinds)})

    return encode


class Model:
    """Start and transition probabilities, and by class and state the ratio of emission to base probability."""

    def __init__(self, start: np.ndarray, move: np.ndarray, ratio: np.ndarray):
        self.start, self.move, self.ratio = start, move, ratio

    @classmethod
    def from_counts(cls, start, move, emitted, base) -> Model:
        """From expected counts; ``base`` has the probability of each class under the base distribution."""
        move = (move + 0.1) / (move + 0.1).sum(axis=1, keepdims=True)
        start = (start + 0.1) / (start + 0.1).sum()
        seen = np.arange(len(base)) != UNSEEN
        own = emitted / np.maximum(emitted.sum(axis=0), 1e-300)
        own = (1.0 - SMOOTH) * own + SMOOTH * (base * seen / base[seen].sum())[:, None]
        ratio = np.ones_like(own)
        some = seen & (base > 0)
        ratio[some] = own[some] * (1.0 - base[UNSEEN]) / base[some, None]
        return cls(start, move, ratio)


class Batch:
    """Texts laid out by time, the longest first, so each step of a recursion is one matrix product."""

    def __init__(self, texts: list[np.ndarray]):
        size = np.fromiter(map(len, texts), np.int64, len(texts))
        self.order = np.argsort(-size, kind="stable")
        size = size[self.order]
        time = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
        self.classes = np.concatenate([texts[i] for i in self.order])[np.argsort(time, kind="stable")].astype(np.int64)
        self.live = np.bincount(time)  # texts that have a token at each time
        self.at = np.concatenate([[0], np.cumsum(self.live)])

    def forward(self, model: Model, kind=np.float64, keep: bool = False):
        """Natural log of likelihood over base likelihood, text by text; with ``keep`` also the scaled states."""
        emit = model.ratio.astype(kind)[self.classes]
        move = model.move.astype(kind)
        states = emit if not keep else np.empty_like(emit)
        scale = np.empty(len(emit), kind)
        previous = None
        for t, n in enumerate(self.live.tolist()):
            a, b = self.at[t], self.at[t + 1]
            now = states[a:b]
            np.multiply(model.start.astype(kind) if t == 0 else previous[:n] @ move, emit[a:b], out=now)
            total = now.sum(axis=1)
            now /= total[:, None]
            scale[a:b] = total
            previous = now
        text = np.arange(len(scale)) - np.repeat(self.at[:-1], self.live)
        gain = np.empty(len(self.order))
        gain[self.order] = np.bincount(text, np.log(scale.astype(np.float64)), len(self.order))
        return (gain, emit, states, scale) if keep else gain

    def expect(self, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
        """Expected counts (start, move, emitted) and the log gain over the base."""
        gain, emit, states, scale = self.forward(model, np.float32, keep=True)
        move = model.move.astype(np.float32)
        later = np.ones_like(emit)
        emit /= scale[:, None]
        for t in range(len(self.live) - 2, -1, -1):
            a, b, c = self.at[t], self.at[t + 1], self.at[t + 2]
            emit[b:c] *= later[b:c]  # now emission, scale and all that follows
            later[a : a + c - b] = emit[b:c] @ move.T
        follow = np.arange(self.at[1], len(emit))
        before = follow - np.repeat(self.live[:-1], self.live[1:])
        moves = (states[before].T @ emit[follow]).astype(np.float64) * model.move
        states *= later
        states /= states.sum(axis=1, keepdims=True)
        emitted = np.stack([np.bincount(self.classes, states[:, k], CLASSES) for k in range(states.shape[1])], axis=1)
        return states[: self.at[1]].sum(axis=0, dtype=np.float64), moves, emitted, float(gain.sum())


def in_batches(texts: list[np.ndarray]):
    """Lists of indices of similarly long texts, of at most ``BATCH_TOKENS`` tokens unless one text is longer."""
    size = np.fromiter(map(len, texts), np.int64, len(texts))
    held, total = [], 0
    for i in np.argsort(-size, kind="stable").tolist():
        if held and total + size[i] > BATCH_TOKENS:
            yield held
            held, total = [], 0
        held.append(i)
        total += size[i]
    if held:
        yield held


def class_arrays(batch: pa.RecordBatch) -> list[np.ndarray]:
    return [np.frombuffer(x, np.uint16) for x in batch.column("classes").to_pylist()]


def expectations(encoded: DataFrame, model: Model) -> tuple[np.ndarray, np.ndarray, np.ndarray, float]:
    """Expected counts over all rows of ``encoded``, summed in tasks and then by class."""
    shared = encoded.sparkSession.sparkContext.broadcast(model)
    columns = [f"s{k}" for k in range(STATES)]

    def count(batches):
        total = None
        for batch in batches:
            texts = class_arrays(batch)
            for rows in in_batches(texts):
                start, move, emitted, gain = Batch([texts[i] for i in rows]).expect(shared.value)
                tail = np.zeros((1, STATES))
                tail[0, 0] = gain
                part = np.concatenate([emitted, move, start[None], tail])
                total = part if total is None else total + part
        if total is not None:
            some = np.flatnonzero(total.any(axis=1))
            yield pa.RecordBatch.from_arrays(
                [pa.array(some), *(pa.array(np.ascontiguousarray(total[some, k])) for k in range(STATES))], names=["at", *columns]
            )

    sums = encoded.select("classes").mapInArrow(count, "at long, " + ", ".join(f"{c} double" for c in columns))
    got = sums.groupBy("at").agg(*(F.sum(c).alias(c) for c in columns)).toArrow()
    out = np.zeros((CLASSES + STATES + 2, STATES))
    out[got.column("at").to_numpy()] = np.stack([got.column(c).to_numpy() for c in columns], axis=1)
    return out[CLASSES + STATES], out[CLASSES : CLASSES + STATES], out[:CLASSES], float(out[-1, 0])


def first_model(seeds: list[np.ndarray], base: np.ndarray) -> Model:
    """States that start from texts unlike each other, refined on the seed texts alone."""
    seen = np.stack([np.bincount(x, minlength=CLASSES) for x in seeds]).astype(np.float64)
    shape = np.sqrt(seen / np.maximum(seen.sum(axis=1, keepdims=True), 1))
    chosen = [int(seen.sum(axis=1).argmax())]
    near = shape @ shape[chosen[0]]
    while len(chosen) < STATES:
        chosen.append(int(near.argmin()))
        near = np.maximum(near, shape @ shape[chosen[-1]])
    own = shape @ shape[chosen].T
    emitted = np.stack([seen[own.argmax(axis=1) == k].sum(axis=0) + seen[c] for k, c in enumerate(chosen)], axis=1)
    move = np.full((STATES, STATES), 1.0) + np.eye(STATES) * 20.0 * STATES
    model = Model.from_counts(np.ones(STATES), move, emitted, base)
    for _ in range(4):
        start, move, emitted, _ = Batch(seeds).expect(model)
        model = Model.from_counts(start, move, emitted, base)
    return model


def score_texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", folds: int = 7, passes: int = PASSES) -> DataFrame:
    """(doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score) of every row; log10 probabilities."""
    spark = docs.sparkSession
    rows = small_batches(docs).select(
        F.col(id_col).alias("doc_id"), held_out(F.col(id_col), folds).alias("held_out"), F.coalesce(F.col(text_col), F.lit("")).alias("text")
    )
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    chunks = max(-(-size // CHUNK_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions")))
    rows = rows.withColumn("chunk", F.pmod(F.xxhash64("doc_id", "text"), F.lit(chunks)))
    by_chunk = rows.groupBy("chunk")
    words = by_chunk.applyInArrow(count_chunk, "chunk long, word binary, n long")
    word = Window.partitionBy("word")
    entries = words.select(
        "chunk", "word", F.sum("n").over(word).alias("total"), (F.min("chunk").over(word) == F.col("chunk")).alias("first")
    )
    kind = docs.schema[id_col].dataType.simpleString()
    encoded = written(
        by_chunk.cogroup(entries.groupBy("chunk")).applyInArrow(
            encode_chunk(FREQUENT),
            f"doc_id {kind}, held_out boolean, n_words long, n_known long, logs double, classes binary",
        ),
        "encoded",
    )
    texts = encoded.where("n_words >= 0")
    train = texts.where(~F.col("held_out"))
    total = train.agg(F.count("*").alias("texts"), F.sum("n_words").alias("words")).first()
    ends, n_train = total["texts"], total["texts"] + (total["words"] or 0)
    distinct, kinds = class_sizes(encoded)
    distinct += ends > 0
    kinds[END] += ends > 0
    symbols = n_train + distinct + 1
    end_log = float(np.log10(ends + 1.0))

    model = None
    if ends:
        base = (class_counts(train) + kinds) / symbols
        base[UNSEEN] = 1 / symbols
        seeds = train.where("n_words between 50 and 5000").orderBy(F.xxhash64("doc_id", "classes"), "doc_id").limit(SEED_TEXTS)
        seeds = class_arrays(seeds.select("classes").toArrow())
        if not seeds:  # no text of a usual length: the shortest ones
            shortest = train.orderBy("n_words", F.xxhash64("doc_id", "classes"), "doc_id").limit(STATES)
            seeds = class_arrays(shortest.select("classes").toArrow())
        model = first_model(seeds, base)
        for _ in range(passes):
            start, move, emitted, _ = expectations(train, model)
            model = Model.from_counts(start, move, emitted, base)
    shared = spark.sparkContext.broadcast(model)

    def score(batches):
        for batch in batches:
            gain = np.zeros(batch.num_rows)
            if shared.value is not None:
                own = class_arrays(batch)
                for at in in_batches(own):
                    gain[at] = Batch([own[i] for i in at]).forward(shared.value) / np.log(10)
            n = batch.column("n_words").to_numpy() + 1
            base = batch.column("logs").to_numpy() + end_log - n * np.log10(float(symbols))
            known = batch.column("n_known").to_numpy() + int(ends > 0)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("held_out"), pa.array(n), pa.array(known),
                 pa.array(np.full(len(n), n_train, np.int64)), pa.array(base), pa.array(base + gain)],
                names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"],
            )

    return texts.mapInArrow(
        score,
        f"doc_id {kind}, held_out boolean, n_tokens long, n_known long, train_tokens long, base_score double, score double",
    )


def class_sizes(encoded: DataFrame) -> tuple[int, np.ndarray]:
    """(distinct training words, distinct training words by class)."""

    def spread(batches):
        for batch in batches:
            total = np.zeros(CLASSES, np.int64)
            for x in batch.column("classes").to_pylist():
                total += np.frombuffer(x, np.uint32)
            yield by_class(total)

    got = summed(encoded.where("n_words < 0").select("classes").mapInArrow(spread, "at long, n long"))
    return int(got.sum()), got


def class_counts(train: DataFrame) -> np.ndarray:
    """Training tokens by class."""

    def count(batches):
        total = np.zeros(CLASSES, np.int64)
        for batch in batches:
            own = class_arrays(batch)
            if own:
                total += np.bincount(np.concatenate(own), minlength=CLASSES)
        yield by_class(total)

    return summed(train.select("classes").mapInArrow(count, "at long, n long"))


def by_class(total: np.ndarray) -> pa.RecordBatch:
    some = np.flatnonzero(total)
    return pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], names=["at", "n"])


def summed(rows: DataFrame) -> np.ndarray:
    got = rows.groupBy("at").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(CLASSES, np.int64)
    out[got.column("at").to_numpy()] = got.column("n").to_numpy()
    return out


def op1_hidden_markov_lm(spark, sf_dir):
    return score_texts(read_table(spark, sf_dir, "documents"))
