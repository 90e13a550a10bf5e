"""Personal data: fixed patterns, and terms that reveal the protected values by co-occurrence.

The patterns find e-mail addresses, IP addresses, card and phone numbers. Each distinct value is a protected
entity. A term (a word of three letters or more outside all matches) that stands anywhere in a document of
an entity may disclose it. With document frequencies over the whole corpus, the term's pointwise mutual information with
the entity, PMI = log2(n(t,e) D / (n(t) n(e))), is set against the entity's information content
IC = log2(D / n(e)). The share PMI / IC is the disclosure: 1 if the term occurs with the entity only. Terms
of support ``SUPPORT`` documents are generalised from ``GENERALISE`` on and removed from ``REMOVE`` on (the term
occurs with the entity only), at all their occurrences in the corpus.

Scale: documents with an entity write their distinct terms once. Pairs are counted in tasks before the shuffle, and only
for entities of enough documents and terms that can still reach the threshold: PMI / IC >= g needs
n(t) <= D (n(e)/D)^g, so common words make no pairs. Which words a pass should look at is told by a broadcast bit map
of ``MAP_BITS`` bits; it may let other words through, and an exact join settles them, so nothing unbounded is broadcast.

Defined results: a null text is empty; matches that fail their check (part over 255, Luhn, number of
digits) are dropped without a retry; repeated rows give repeated results; documents are rows, copies count; without
entities no term is found; other columns are not read, and the sanitised table keeps them.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentiflow.llm.common import by_size, read_table, small_batches, written

KINDS = ("email", "ip", "card", "phone", "term")
SUPPORT = 2
GENERALISE, REMOVE = 0.97, 1.0 - 1e-9
MAP_BITS = 1 << 23
#: Distinct words or pairs a task counts before it sends them on.
FLUSH_WORDS = 200_000
#: Bytes of text taken at a time.
SLICE_BYTES = 2 << 20

LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")
DOMAIN = re.compile(r"@[A-Za-z0-9-]++(?:\.[A-Za-z0-9-]++)++")
DIGIT = re.compile(r"[0-9]")
#: A first match starts where a run of digits starts, or where the one before ended, which is after a run.
IP = re.compile(r"(?<![0-9])[0-9]++(?:\.[0-9]++){3}")
CARD = re.compile(r"[0-9](?:[ -]?[0-9])++")
PHONE = re.compile(r"\+[0-9][ ().0-9-]+[0-9]")
TERM = re.compile(r"[^\W\d_]{3,}")

SPAN = "struct<kind:int,start:long,end:long>"
SPAN_ARROW = pa.list_(pa.struct([("kind", pa.int32()), ("start", pa.int64()), ("end", pa.int64())]))


def emails(text: str):
    done, at = 0, text.find("@")
    while at >= 0:
        start = at
        while start > done and text[start - 1] in LOCAL:
            start -= 1
        found = DOMAIN.match(text, at) if start < at else None
        if found:
            done = found.end()
            yield start, done
        at = text.find("@", found.end() if found else at + 1)


def is_ip(value: str) -> bool:
    parts = [p.lstrip("0") for p in value.split(".")]
    return all(len(p) < 3 or (len(p) == 3 and p <= "255") for p in parts)


def is_card(value: str) -> bool:
    digits = digits_of(value)
    if not 14 <= len(digits) <= 19:
        return False
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def digits_of(value: str) -> str:
    return "".join(c for c in value if "0" <= c <= "9")


def base_spans(text: str) -> list[tuple[int, int, int]]:
    """(start, kind, end) of the patterns' matches, in order."""
    out = [(a, 0, b) for a, b in emails(text)] if "@" in text else []
    if DIGIT.search(text):
        out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if is_ip(m[0])]
        out += [(m.start(), 2, m.end()) for m in CARD.finditer(text) if is_card(m[0])]
        if "+" in text:
            out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(digits_of(m[0])) <= 15]
    return sorted(out)


def entity(kind: int, value: str) -> str:
    """One name for all spellings of a protected value."""
    return f"{KINDS[kind]}:{digits_of(value) if kind >= 2 else value.lower()}"


def free_terms(text: str, spans: list[tuple[int, int, int]]):
    """Matches of TERM outside all ``spans``, which are in order."""
    at, reach = 0, 0
    for m in TERM.finditer(text):
        while at < len(spans) and spans[at][0] < m.end():
            reach = max(reach, spans[at][2])
            at += 1
        if reach <= m.start():
            yield m


def listed(spans) -> str:
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in sorted(spans))


def as_structs(spans) -> list[dict]:
    return [{"kind": k, "start": a, "end": b} for a, k, b in spans]


def find_base(rows: DataFrame) -> DataFrame:
    """(doc_id, text_hash, base, entities, terms) of (doc_id, text_hash, text); distinct terms of texts with an entity."""

    def find(batches):
        for batch in by_size(batches, "text", SLICE_BYTES):
            base, entities, terms = [], [], []
            for text in batch.column("text").to_pylist():
                spans = base_spans(text)
                base.append(as_structs(spans))
                entities.append(sorted({entity(k, text[a:b]) for a, k, b in spans}))
                terms.append(sorted({m[0].lower() for m in free_terms(text, spans)}) if spans else [])
            names = pa.list_(pa.string())
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(base, SPAN_ARROW), pa.array(entities, names), pa.array(terms, names)],
                names=["doc_id", "text_hash", "base", "entities", "terms"],
            )

    kind = rows.schema["doc_id"].dataType.simpleString()
    return rows.mapInArrow(
        find, f"doc_id {kind}, text_hash long, base array<{SPAN}>, entities array<string>, terms array<string>"
    )


def bit_map(terms: DataFrame) -> np.ndarray:
    """Bits of the crc32 of all terms; at most MAP_BITS / 64 rows come to the driver."""
    at = F.pmod(F.crc32(F.col("term").cast("binary")), F.lit(MAP_BITS))
    words = terms.select(F.shiftright(at, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(64)).cast("int")).alias("bit"))
    got = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(MAP_BITS // 64, np.int64)
    out[got.column("word").to_numpy()] = got.column("bits").to_numpy()
    return np.unpackbits(out.view(np.uint8), bitorder="little")


def mapped_words(text: str, bits: np.ndarray) -> list[str]:
    """Distinct terms of a text whose bit is set."""
    return mapped(list({w.lower() for w in TERM.findall(text)}), bits)


def mapped(words: list[str], bits: np.ndarray) -> list[str]:
    at = np.fromiter((zlib.crc32(w.encode()) for w in words), np.int64, len(words)) % MAP_BITS
    return [words[i] for i in np.flatnonzero(bits[at])]


def document_counts(rows: DataFrame, terms: DataFrame) -> DataFrame:
    """(term, n_term): documents that hold each of ``terms`` (others may be among them)."""
    shared = rows.sparkSession.sparkContext.broadcast(bit_map(terms))

    def count(batches):
        seen: Counter = Counter()
        for batch in by_size(batches, "text", SLICE_BYTES):
            for text in batch.column("text").to_pylist():
                seen.update(mapped_words(text, shared.value))
            if len(seen) >= FLUSH_WORDS:
                yield counted(seen)
                seen.clear()
        yield counted(seen)

    def counted(seen):
        return pa.RecordBatch.from_arrays([pa.array(list(seen), pa.string()), pa.array(list(seen.values()), pa.int64())], names=["term", "n"])

    return rows.select("text").mapInArrow(count, "term string, n long").groupBy("term").agg(F.sum("n").alias("n_term"))


def pair_counts(found: DataFrame, entities: DataFrame, terms: DataFrame) -> DataFrame:
    """(entity, term, n): documents that hold each of ``entities`` and ``terms`` together (others may be among them)."""
    context = found.sparkSession.sparkContext
    own, words = context.broadcast(bit_map(entities.select(F.col("entity").alias("term")))), context.broadcast(bit_map(terms))

    def counted(seen):
        return pa.RecordBatch.from_arrays(
            [pa.array([e for e, _ in seen], pa.string()), pa.array([t for _, t in seen], pa.string()), pa.array(list(seen.values()), pa.int64())],
            names=["entity", "term", "n"],
        )

    def count(batches):
        seen: Counter = Counter()
        for batch in batches:
            for names, held in zip(batch.column("entities").to_pylist(), batch.column("terms").to_pylist()):
                names = mapped(names, own.value)
                held = mapped(held, words.value) if names else ()
                for name in names:
                    seen.update([(name, t) for t in held])
                    if len(seen) >= FLUSH_WORDS:
                        yield counted(seen)
                        seen.clear()
        yield counted(seen)

    return found.mapInArrow(count, "entity string, term string, n long").groupBy("entity", "term").agg(F.sum("n").alias("n"))


def disclosing_terms(rows: DataFrame, base: DataFrame, support: int, generalise: float) -> DataFrame | None:
    """(term, disclosure) of the terms that reveal an entity to ``generalise`` or more; None without candidates."""
    found = small_batches(base.where(F.size("entities") > 0).select("entities", "terms"))
    total = rows.count()
    entities = found.select(F.explode("entities").alias("entity")).groupBy("entity").agg(F.count("*").alias("n_entity"))
    entities = written(entities.where((F.col("n_entity") >= support) & (F.col("n_entity") < total)), "entities")
    most = entities.agg(F.max("n_entity")).first()[0]
    if most is None:
        return None
    terms = found.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("n"))
    terms = written(terms.where(F.col("n") >= support).select("term"), "candidates")
    if not terms.limit(1).count():
        return None
    limit = total * (most / total) ** generalise * (1 + 1e-9)
    terms = terms.join(document_counts(rows, terms), "term").where(F.col("n_term") <= limit)
    terms = written(terms, "counted")
    pairs = pair_counts(found, entities, terms).where(F.col("n") >= support)
    scored = pairs.join(entities, "entity").join(terms, "term")
    content = F.log2(F.lit(float(total)) / F.col("n_entity"))
    pmi = F.log2(F.col("n") * F.lit(float(total)) / (F.col("n_term") * F.col("n_entity")))
    scored = scored.withColumn("disclosure", pmi / content)
    return written(
        scored.where(F.col("disclosure") >= generalise).groupBy("term").agg(F.max("disclosure").alias("disclosure")), "terms"
    )


def term_spans(rows: DataFrame, terms: DataFrame, remove: float) -> DataFrame:
    """(doc_id, text_hash, terms): spans of disclosing terms in every text that holds some."""
    shared = rows.sparkSession.sparkContext.broadcast(bit_map(terms))
    listing = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def find(batches):
        for batch in by_size(batches, "text", SLICE_BYTES):
            out = {"doc_id": [], "text_hash": [], "term": [], "at": []}
            for doc, key, text in zip(*(batch.column(k).to_pylist() for k in ("doc_id", "text_hash", "text"))):
                words = set(mapped_words(text, shared.value))
                if not words:
                    continue
                places = {}
                for m in free_terms(text, base_spans(text)):
                    word = m[0].lower()
                    if word in words:
                        places.setdefault(word, []).append({"start": m.start(), "end": m.end()})
                for word, own in places.items():
                    for k, v in zip(out, (doc, key, word, own)):
                        out[k].append(v)
            kinds = [batch.schema.field("doc_id").type, pa.int64(), pa.string(), listing]
            yield pa.RecordBatch.from_arrays([pa.array(v, k) for v, k in zip(out.values(), kinds)], names=list(out))

    kind = rows.schema["doc_id"].dataType.simpleString()
    found = rows.mapInArrow(find, f"doc_id {kind}, text_hash long, term string, at array<struct<start:long,end:long>>")
    found = found.join(terms, "term").dropDuplicates(["doc_id", "text_hash", "term"])
    found = found.withColumn("removed", F.col("disclosure") >= remove)
    flat = found.select("doc_id", "text_hash", "removed", F.explode("at").alias("at"))
    return flat.groupBy("doc_id", "text_hash").agg(
        F.sort_array(F.collect_list(F.struct(F.col("at.start").alias("start"), F.col("at.end").alias("end"), "removed"))).alias("terms")
    )


def find_personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", support: int = SUPPORT,
    generalise: float = GENERALISE, remove: float = REMOVE,
) -> DataFrame:
    """(doc_id, text_hash, base, terms) of every row; base and terms hold code-point spans, end exclusive."""
    text = F.coalesce(F.col(text_col), F.lit(""))
    rows = small_batches(docs).select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))
    base = written(find_base(rows), "base")
    terms = disclosing_terms(rows, base, support, generalise)
    base = base.drop("entities", "terms")
    if terms is None:
        return base.withColumn("terms", F.lit(None).cast("array<struct<start:long,end:long,removed:boolean>>"))
    spans = term_spans(rows, terms, remove).withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    return base.join(spans, base["doc_id"].eqNullSafe(spans["_id"]) & (base["text_hash"] == spans["_hash"]), "left").drop("_id", "_hash")


def digest(found: DataFrame) -> DataFrame:
    """Counts by kind, the digest of the base spans and the list of all."""

    def listed_rows(batches):
        for batch in batches:
            base = [[(s["start"], s["kind"], s["end"]) for s in x] for x in batch.column("base").to_pylist()]
            every = [b + [(s["start"], 4, s["end"]) for s in t or ()] for b, t in zip(base, batch.column("terms").to_pylist())]
            counts = [pa.array([sum(k == kind for _, k, _ in x) for x in base], pa.int64()) for kind in range(4)]
            sums = [hashlib.sha256(listed(x).encode()).hexdigest() for x in base]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), *counts, pa.array([len(x) - len(b) for x, b in zip(every, base)], pa.int64()),
                 pa.array(sums, pa.string()), pa.array([listed(x) for x in every], pa.string())],
                names=["doc_id", "n_email", "n_ip", "n_card", "n_phone", "n_term", "base_sha256", "spans"],
            )

    kind = found.schema["doc_id"].dataType.simpleString()
    return found.mapInArrow(
        listed_rows, f"doc_id {kind}, n_email long, n_ip long, n_card long, n_phone long, n_term long, base_sha256 string, spans string"
    )


def redacted(text: str, spans: list[tuple[int, int, str]]) -> str:
    """The text with each span replaced; of overlapping spans the first gives the replacement for all."""
    out, done = [], 0
    for start, end, instead in sorted(spans):
        if start >= done:
            out += [text[done:start], instead]
        done = max(done, end)
    return "".join([*out, text[done:]])


def sanitise(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chars_col: str | None = None, support: int = SUPPORT,
    generalise: float = GENERALISE, remove: float = REMOVE,
) -> DataFrame:
    """``docs`` with personal data replaced: base matches by their kind, disclosing terms by ``[TERM]`` or nothing.

    ``chars_col`` names a column that holds the text's length and follows it. Rows without personal data stay as they are.
    """
    found = find_personal_data(docs, id_col, text_col, support, generalise, remove)
    found = found.where((F.size("base") > 0) | (F.size("terms") > 0)).dropDuplicates(["doc_id", "text_hash"])
    marks = found.select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), "base", "terms")
    inner = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_doc"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_key"))
    held = inner.join(marks, inner["_doc"].eqNullSafe(marks["_id"]) & (inner["_key"] == marks["_hash"]), "left")

    @F.udf("string", useArrow=True)
    def replace(text, base, terms):  # sees every row, also those without marks
        spans = [(s["start"], s["end"], f"[{KINDS[s['kind']].upper()}]") for s in base or ()]
        spans += [(s["start"], s["end"], "" if s["removed"] else "[TERM]") for s in terms or ()]
        return redacted(text, spans) if spans else text

    held = held.withColumn("_new", F.when(F.col("base").isNotNull(), replace(F.col("_row")[text_col], "base", "terms")).otherwise(F.col("_row")[text_col]))
    columns = []
    for name in docs.columns:
        value = F.col("_row")[name]
        if name == text_col:
            value = F.col("_new")
        elif name == chars_col:
            value = F.when(F.col("base").isNotNull(), F.char_length("_new").cast(docs.schema[name].dataType)).otherwise(value)
        columns.append(value.alias(name))
    return held.select(*columns)


def op3_pii(spark, sf_dir):
    return digest(find_personal_data(read_table(spark, sf_dir, "documents")))
