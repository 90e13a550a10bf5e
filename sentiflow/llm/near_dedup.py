"""Near-duplicate groups by BagMinHash over multisets of word shingles.

A text is the multiset of its shingles of five lower-cased words (fewer words, but not none: one shingle).
Each shingle owns Poisson processes over dyadic weight levels [0,1), [1,2), [2,4), ...: a point has a
time, a signature component and a height in its level, and counts where the height is below the shingle's
multiplicity. A component of the signature is the earliest time that any counted point has there; two
texts agree in a component with probability equal to their weighted Jaccard similarity. Points are only
drawn up to the time by which all components are expected to be hit, and again with twice that time where
one is not, so a text costs about ``SIZE`` * ln ``SIZE`` points beyond the first look at each shingle.

Signatures are cut into bands. Texts with equal multisets are one content. In every bucket a leader, one of
``LEADERS`` that its group gets over all bands, is linked to the contents whose signatures agree with its own in
``LIKELY`` of the components; links are verified on the exact multisets, and connected components form. Where a bucket
still holds several components, they are compared within tasks: cells hold a block of the largest
component and a group of the others, and return only verified links that join components. So no list of pairs is
made, and a large bucket costs links but for the members outside its largest component. A class is a connected component of verified
links of similarity ``THRESHOLD`` or more.

A pair of similarity 0.8 shares no band with probability 3e-6 (24 bands of 4), and falls below ``LIKELY``
with about 1e-6.

Scale: texts are read once for signatures and shuffled once more for those that must be verified; a group of copies is
one content after map-side aggregation; large groups of links are salted; components stay distributed.

Defined results: a null text, or one without words, is in a class of its own; the class id is the smallest
id of the class (null if no row of it has one); repeated rows share a class; an empty table gives no rows; other columns are
not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentiflow.llm.common import by_size, read_table, small_batches, utf8_column, written
from sentiflow.llm.hashing import mixed, shingle_hashes, word_hashes

SHINGLE = 5
THRESHOLD = 0.8
BANDS, ROWS = 24, 4
SIZE = BANDS * ROWS
LIKELY = 0.6
SLICE_BYTES = 2 << 20
#: Different leaders that a group of near-copies gets over all bands.
LEADERS = 4
#: Members of a bucket in one block of a cell, and of a leader verified in one task.
BLOCK = 1024
SALT = 1000
#: Size of the broadcast map of texts to fetch.
MAP_BITS = 1 << 23


def multisets(data: np.ndarray, off: np.ndarray, size: int = SHINGLE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, shingle, multiplicity), ordered by row and shingle."""
    words, row = word_hashes(data, off)
    shingles, row = shingle_hashes(words, row, len(off) - 1, size)
    order = np.lexsort((shingles, row))
    row, shingles = row[order], shingles[order]
    new = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (shingles[1:] != shingles[:-1])])[: len(row)])
    return row[new], shingles[new], np.diff(np.concatenate([new, [len(row)]]))


def bags(texts: pa.ChunkedArray):
    """(shingles, multiplicities) of each text, a slice of texts at a time."""
    for batch in by_size(pa.table({"text": texts}).to_batches(), "text", SLICE_BYTES):
        data, off = utf8_column(batch.column("text"))
        row, shingle, weight = multisets(data, off)
        edges = np.searchsorted(row, np.arange(batch.num_rows + 1)).tolist()
        yield from ((shingle[a:b].copy(), weight[a:b].copy()) for a, b in zip(edges[:-1], edges[1:]))


def uniform(x: np.ndarray) -> np.ndarray:
    """In (0, 1), from 64 random bits."""
    return ((x >> np.uint64(11)).astype(np.float64) + 0.5) * 2.0**-53


def bag_minhash(row: np.ndarray, shingle: np.ndarray, weight: np.ndarray, rows: int, size: int = SIZE) -> np.ndarray:
    """(rows, size) earliest times; infinite in rows without shingles."""
    out = np.full((rows, size), np.inf)
    # one process per dyadic level below the multiplicity
    levels = np.ceil(np.log2(np.maximum(weight, 1))).astype(np.int64) + 1
    of = np.repeat(np.arange(len(row)), levels)
    level = np.arange(len(of)) - np.repeat(np.cumsum(levels) - levels, levels)
    rate = np.where(level == 0, 1.0, 2.0 ** (level - 1.0))
    low = np.where(level == 0, 0.0, rate)
    seed = mixed(shingle[of] + mixed(level.astype(np.uint64) + np.uint64(1)))
    row, weight = row[of], weight[of]
    total = np.bincount(row, np.minimum(rate, weight - low), rows)
    until = np.divide(size * (np.log(size) + 6.0), total, out=np.zeros(rows), where=total > 0)
    todo = np.flatnonzero(total > 0)
    while len(todo):
        mine = np.zeros(rows, bool)
        mine[todo] = True
        live = np.flatnonzero(mine[row]) if len(todo) < rows else np.arange(len(row))
        step, time = 0, np.zeros(len(live))
        while len(live):
            draw = mixed(seed[live] + np.uint64(2 * step + 1))
            time = time - np.log(uniform(draw)) / rate[live]
            early = time <= until[row[live]]
            live, time, draw = live[early], time[early], draw[early]
            other = mixed(draw + np.uint64(0x9E3779B97F4A7C15))
            component = ((other & np.uint64(0xFFFFFFFF)) * np.uint64(size) >> np.uint64(32)).astype(np.int64)
            height = low[live] + rate[live] * (other >> np.uint64(32)).astype(np.float64) * 2.0**-32
            counts = height < weight[live]
            np.minimum.at(out, (row[live[counts]], component[counts]), time[counts])
            step += 1
        todo = todo[np.isinf(out[todo]).any(axis=1)]
        until[todo] *= 2
    return out


def band_keys(signature: np.ndarray) -> np.ndarray:
    """(rows, BANDS) hashes of the bands."""
    bits = mixed(signature.view(np.uint64))
    key = np.zeros((len(bits), BANDS), np.uint64)
    for i in range(ROWS):
        key = mixed(key + bits[:, i::ROWS] + np.uint64(i + 1))
    return key.view(np.int64)


def weighted_jaccard(a: tuple[np.ndarray, np.ndarray], b: tuple[np.ndarray, np.ndarray]) -> float:
    """Of two (sorted shingles, multiplicities)."""
    at = np.searchsorted(b[0], a[0])
    inside = at < len(b[0])
    hit = np.zeros(len(a[0]), bool)
    hit[inside] = b[0][at[inside]] == a[0][inside]
    both = int(np.minimum(a[1][hit], b[1][at[hit]]).sum())
    return both / (int(a[1].sum()) + int(b[1].sum()) - both)


def sign(docs: DataFrame) -> DataFrame:
    """(doc_id, text_hash, content, n_shingles, bands, marks) of (doc_id, text_hash, text); content is null without words."""

    def signed(batches):
        for batch in by_size(batches, "text", SLICE_BYTES):
            data, off = utf8_column(batch.column("text"))
            rows = batch.num_rows
            row, shingle, weight = multisets(data, off)
            signature = bag_minhash(row, shingle, weight, rows)
            keys = band_keys(signature)
            marks = (mixed(signature.view(np.uint64)) >> np.uint64(56)).astype(np.uint8)
            edges = np.searchsorted(row, np.arange(rows + 1))
            pairs = np.stack([shingle, weight.astype(np.uint64)], axis=1)
            content = [hashlib.blake2b(pairs[a:b].tobytes(), digest_size=16).digest() if b > a else None for a, b in zip(edges[:-1], edges[1:])]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("text_hash"), pa.array(content, pa.binary()),
                 pa.array(np.bincount(row, weight, rows).astype(np.int64)),
                 pa.ListArray.from_arrays(np.arange(0, rows * BANDS + 1, BANDS, dtype=np.int32), keys.reshape(-1)),
                 pa.array([m.tobytes() for m in marks], pa.binary())],
                names=["doc_id", "text_hash", "content", "n_shingles", "bands", "marks"],
            )

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.mapInArrow(
        signed, f"doc_id {kind}, text_hash long, content binary, n_shingles long, bands array<long>, marks binary"
    )


def cells(left: DataFrame) -> DataFrame:
    """Members of buckets with several components, dealt out to cells in which every pair that matters meets.

    In each bucket the largest component needs comparing with the others only. Its members are cut into
    blocks and met by groups of the others (side 0 and 1); the others meet each other in cells of their own.
    """
    bucket = ["band", "key"]
    sizes = left.groupBy(*bucket, "component").count()
    main = sizes.groupBy(*bucket).agg(
        F.max_by("component", F.struct("count", "component")).alias("main"),
        F.ceil(F.max("count") / BLOCK).cast("int").alias("blocks"),
        F.ceil((F.sum("count") - F.max("count")) / BLOCK).cast("int").alias("groups"),
    )
    left = left.join(main, bucket).withColumn("side", F.when(F.col("component") == F.col("main"), 0).otherwise(1))
    parts = F.when(F.col("side") == 0, F.col("blocks")).otherwise(F.col("groups"))
    left = left.withColumn("mine", F.pmod(F.xxhash64("content"), parts).cast("int"))

    def each(col, cell):
        return F.transform(F.sequence(F.lit(0), F.col(col) - 1), cell)

    def cell(kind, a, b):
        return F.struct(F.lit(kind).alias("kind"), a.alias("a"), b.alias("b"))

    mine = F.col("mine")
    others = F.concat(each("blocks", lambda i: cell(0, i, mine)), each("groups", lambda j: cell(1, F.least(mine, j), F.greatest(mine, j))))
    left = left.withColumn("cell", F.explode(F.when(F.col("side") == 0, each("groups", lambda j: cell(0, mine, j))).otherwise(others)))
    return left.select(F.xxhash64("band", "key", "cell").alias("cell"), "side", "band", "content", "component", "bands", "marks")


def by_cell(batches, least: int = 1):
    """Tables of whole cells from batches sorted by cell; ``least`` rows at least but for the last."""
    held = None
    for batch in batches:
        if not batch.num_rows:
            continue
        table = pa.Table.from_batches([batch])
        held = table if held is None else pa.concat_tables([held, table])
        cell = held.column("cell").to_numpy()
        last = int(np.searchsorted(cell, cell[-1]))
        if last >= least:
            yield held.slice(0, last)
            held = held.slice(last)
    if held is not None:
        yield held


def likely(table: pa.Table):
    """Of each cell (first row, pairs of rows): components differ, signatures agree well, and no earlier band is shared."""
    cell, side = table.column("cell").to_numpy(), table.column("side").to_numpy()
    band = table.column("band").to_numpy()
    _, component = np.unique(np.array(table.column("component").to_pylist(), object), return_inverse=True)
    marks = np.frombuffer(b"".join(table.column("marks").to_pylist()), np.uint8).reshape(-1, SIZE)
    keys = table.column("bands").combine_chunks().flatten().to_numpy().reshape(-1, BANDS)
    edges = np.flatnonzero(np.concatenate([[True], cell[1:] != cell[:-1], [True]]))
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        if b - a < 2:
            continue
        both = side[a:b].min() != side[a:b].max()
        left, right = [], []
        for i in range(a, b):
            if both and side[i] == 0:
                continue
            to = np.arange(a, b)[side[a:b] == 0] if both else np.arange(i + 1, b)
            to = to[component[to] != component[i]]
            to = to[(marks[to] == marks[i]).sum(axis=1) >= LIKELY * SIZE]
            if len(to):
                here = band[i]
                to = to[(keys[to, :here] != keys[i, :here]).all(axis=1)]  # a pair counts in its first shared band
                left.append(np.full(len(to), i))
                right.append(to)
        if left:
            yield a, np.concatenate(left), np.concatenate(right)


def flag(batches):
    """Members of cells that have a likely partner there."""
    for table in by_cell(batches):
        rows = [np.unique(np.concatenate([left, right])) for _, left, right in likely(table)]
        if rows:
            yield from table.take(np.concatenate(rows)).to_batches()


def confirm(threshold: float):
    """Batches of cells with texts -> links between components, checked on the exact multisets, a spanning set a cell."""

    def check(batches):
        for table in by_cell(batches):
            names = table.column("content").to_pylist()
            labels = table.column("component").to_pylist()
            found = []
            for _, left, right in likely(table):
                needed = np.unique(np.concatenate([left, right]))
                bag = dict(zip(needed.tolist(), bags(table.column("text").take(pa.array(needed)))))
                parent: dict[bytes, bytes] = {}

                def root(x, parent=parent):
                    while parent.get(x, x) != x:
                        x = parent[x]
                    return x

                for i, j in zip(left.tolist(), right.tolist()):
                    x, y = root(labels[i]), root(labels[j])
                    if x != y and weighted_jaccard(bag[i], bag[j]) >= threshold:
                        parent[x] = y
                        found.append((names[i], names[j]))
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.binary()) for c in zip(*found)], names=["a", "b"])

    return check


def asked_texts(asked: DataFrame, contents: DataFrame, docs: DataFrame) -> DataFrame:
    """``asked`` with the text of each content. A bit map of the texts' hashes lets a scan drop most others before the shuffle."""
    rep = contents.select("content", F.col("rep")["doc_id"].alias("doc_id"), F.col("rep")["text_hash"].alias("text_hash"))
    asked = written(asked.join(rep, "content"), "asked")
    at = F.pmod(F.col("text_hash"), F.lit(MAP_BITS))
    words = asked.select(F.shiftright(at, 6).alias("word"), F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(at, F.lit(64)).cast("int")).alias("bit"))
    got = words.groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    bits = np.zeros(MAP_BITS // 64, np.int64)
    bits[got.column("word").to_numpy()] = got.column("bits").to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast(np.unpackbits(bits.view(np.uint8), bitorder="little").astype(bool))

    def drop(batches):
        for batch in batches:
            yield batch.filter(pa.array(shared.value[batch.column("text_hash").to_numpy() % MAP_BITS]))

    one = docs.select("doc_id", "text_hash", "text").mapInArrow(drop, docs.select("doc_id", "text_hash", "text").schema)
    one = one.withColumnsRenamed({"doc_id": "_id", "text_hash": "_hash"})
    # rows that repeat a document give its text again, which changes nothing
    return asked.join(one, asked["doc_id"].eqNullSafe(one["_id"]) & (asked["text_hash"] == one["_hash"])).drop("_id", "_hash")


def verify(links: DataFrame, contents: DataFrame, docs: DataFrame, threshold: float) -> DataFrame:
    """The links (a, b) whose exact multisets are similar enough; a's text goes to every salt of its members."""
    sizes = links.groupBy("a").agg(F.ceil(F.count("*") / SALT).cast("int").alias("salts"))
    members = links.join(sizes, "a").select(
        F.col("a").alias("leader"), F.pmod(F.xxhash64("b"), F.col("salts")).cast("int").alias("salt"), F.col("b").alias("content"), F.lit(1).alias("role")
    )
    leaders = sizes.select(
        F.col("a").alias("leader"), F.explode(F.sequence(F.lit(0), F.col("salts") - 1)).alias("salt"), F.col("a").alias("content"), F.lit(0).alias("role")
    )
    asked = leaders.unionByName(members)
    texts = asked_texts(asked, contents, docs)
    dealt = texts.select("leader", "salt", "role", "content", "text").repartition("leader", "salt").sortWithinPartitions("leader", "salt", "role")

    def check(batches):
        leader = own = None
        for batch in by_size(batches, "text", SLICE_BYTES):
            data, off = utf8_column(batch.column("text"))
            row, shingle, weight = multisets(data, off)
            edges = np.searchsorted(row, np.arange(batch.num_rows + 1))
            good_a, good_b = [], []
            names, roles, contents_ = (batch.column(k).to_pylist() for k in ("leader", "role", "content"))
            for i, (name, role, content) in enumerate(zip(names, roles, contents_)):
                mine = shingle[edges[i] : edges[i + 1]], weight[edges[i] : edges[i + 1]]
                if role == 0:
                    leader, own = name, (mine[0].copy(), mine[1].copy())
                elif leader == name and weighted_jaccard(own, mine) >= threshold:
                    good_a.append(name)
                    good_b.append(content)
            if good_a:
                yield pa.RecordBatch.from_arrays([pa.array(good_a, pa.binary()), pa.array(good_b, pa.binary())], names=["a", "b"])

    return dealt.mapInArrow(check, "a binary, b binary").distinct()


def components(links: DataFrame) -> DataFrame:
    """(content, component) of every linked content; the component is its smallest content.

    Labels move to neighbours and jump to their label's label until none changes; every round is written.
    """
    both = written(links.select("a", "b").unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), "edges")
    labels = written(both.groupBy(F.col("a").alias("content")).agg(F.least(F.first("a"), F.min("b")).alias("component")), "labels")
    while True:
        near = both.join(labels.withColumnRenamed("content", "b"), "b").select(F.col("a").alias("content"), "component", F.lit(None).cast("binary").alias("own"))
        near = near.unionByName(labels.withColumn("own", F.col("component")))
        moved = near.groupBy("content").agg(F.min("component").alias("to"), F.min("own").alias("old"))
        to = labels.select(F.col("content").alias("to"), F.col("component").alias("beyond"))
        after = written(moved.join(to, "to").select("content", "old", F.least("to", "beyond").alias("component")), "labels")
        if after.where(F.col("old") != F.col("component")).limit(1).count() == 0:
            return after.select("content", "component")
        labels = after.select("content", "component")


def joined_by(joined: DataFrame, links: DataFrame) -> DataFrame:
    """``joined`` (content, component) after further links; only the graph of components is searched again."""
    of = joined.select("content", F.col("component").alias("known"))
    ends = links.join(of.toDF("a", "known_a"), "a", "left").join(of.toDF("b", "known_b"), "b", "left")
    ends = ends.select(F.coalesce("known_a", "a").alias("a"), F.coalesce("known_b", "b").alias("b")).where("a <> b").distinct()
    ends = written(ends, "edges")
    if not ends.limit(1).count():
        return joined
    top = components(ends).toDF("known", "top")
    moved = joined.join(top, joined["component"] == top["known"], "left").select("content", F.coalesce("top", "component").alias("component"))
    fresh = top.join(joined, top["known"] == joined["content"], "left_anti").toDF("content", "component")
    return written(moved.unionByName(fresh), "joined")


def group_near_duplicates(docs: DataFrame, threshold: float = THRESHOLD) -> tuple[DataFrame, DataFrame]:
    """Of (doc_id, text_hash, text): the signed rows, and (content, component) of every content in a larger class."""
    signed = written(sign(docs), "signed")
    some = signed.where(F.col("content").isNotNull())
    contents = written(
        some.groupBy("content").agg(
            F.min(F.struct("doc_id", "text_hash")).alias("rep"), F.first("bands").alias("bands"), F.first("marks").alias("marks")
        ),
        "contents",
    )
    places = contents.select("content", F.posexplode("bands").alias("band", "key"))
    # a text falls in about ten buckets of its near-copies, and so meets LEADERS of them
    leader = F.min_by("content", F.xxhash64("content", F.pmod("band", F.lit(LEADERS))))
    buckets = places.groupBy("band", "key").agg(leader.alias("leader"), F.count("*").alias("members")).where("members > 1").drop("members")
    crowded = written(places.join(buckets, ["band", "key"]), "buckets")
    marks = contents.select("content", "marks")

    joined = components(verify(starred(crowded, marks), contents, docs, threshold))
    left = still_mixed(crowded, joined)
    if left is None:
        return signed, joined

    # what is left meets in cells
    dealt = cells(left.join(contents.select("content", "bands", "marks"), "content")).repartition("cell").sortWithinPartitions("cell", "side", "content")
    flagged = written(dealt.mapInArrow(flag, dealt.schema), "flagged")
    texts = asked_texts(flagged, contents, docs).dropDuplicates(["cell", "content"])
    ready = texts.select("cell", "side", "band", "content", "component", "bands", "marks", "text").repartition("cell")
    more = written(ready.sortWithinPartitions("cell", "side", "content").mapInArrow(confirm(threshold), "a binary, b binary").distinct(), "links")
    return signed, joined_by(joined, more)


def starred(members: DataFrame, marks: DataFrame) -> DataFrame:
    """Links (a, b) from buckets' leaders to members whose signatures agree well."""
    stars = members.select(F.col("leader").alias("a"), F.col("content").alias("b")).where("a <> b").distinct()
    stars = stars.join(marks.toDF("a", "marks_a"), "a").join(marks.toDF("b", "marks_b"), "b")
    return stars.where(agreement("marks_a", "marks_b") >= LIKELY * SIZE).select("a", "b")


def still_mixed(crowded: DataFrame, joined: DataFrame) -> DataFrame | None:
    """Members, with components, of the buckets that hold more than one; None if there is no such bucket."""
    placed = written(crowded.join(joined, "content", "left").withColumn("component", F.coalesce("component", "content")), "placed")
    several = placed.groupBy("band", "key").agg(F.min("component").alias("low"), F.max("component").alias("high")).where("low <> high")
    left = written(placed.join(several.select("band", "key"), ["band", "key"]), "mixed")
    return left if left.limit(1).count() else None


def agreement(a: str, b: str) -> F.Column:
    """Equal bytes of two signatures' marks, counted on their hexadecimal digits."""
    x, y = F.hex(a), F.hex(b)
    same = [(F.substring(x, 2 * i + 1, 2) == F.substring(y, 2 * i + 1, 2)).cast("int") for i in range(SIZE)]
    total = same[0]
    for s in same[1:]:
        total = total + s
    return total


def hashed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return small_batches(docs).select(F.col(id_col).alias("doc_id"), F.xxhash64(text).alias("text_hash"), text.alias("text"))


def near_duplicate_classes(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, class_id, class_size, n_shingles) of every row."""
    signed, joined = group_near_duplicates(hashed(docs, id_col, text_col), threshold)
    rows = signed.join(joined, "content", "left").withColumn("class", F.coalesce("component", "content"))
    classes = rows.where(F.col("class").isNotNull()).groupBy("class").agg(F.min("doc_id").alias("class_id"), F.count("*").alias("class_size"))
    rows = rows.join(classes, "class", "left")
    alone = F.col("class").isNull()
    return rows.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"),
        F.when(alone, F.lit(1)).otherwise(F.col("class_size")).cast("long").alias("class_size"),
        "n_shingles",
    )


def keep_one_per_class(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", threshold: float = THRESHOLD) -> DataFrame:
    """One row of ``docs`` for each class, that of the smallest id; rows without words all stay. All columns as they are."""
    signed, joined = group_near_duplicates(hashed(docs, id_col, text_col), threshold)
    rows = signed.join(joined, "content", "left").withColumn("class", F.coalesce("component", "content"))
    firsts = rows.where(F.col("class").isNotNull()).groupBy("class").agg(F.min(F.struct("doc_id", "text_hash")).alias("kept"))
    firsts = firsts.select(F.col("kept")["doc_id"].alias("_id"), F.col("kept")["text_hash"].alias("_hash"))
    wordless = rows.where(F.col("class").isNull()).select(F.col("doc_id").alias("_id"), F.col("text_hash").alias("_hash"), F.lit(True).alias("_all"))
    kept = firsts.withColumn("_all", F.lit(False)).unionByName(wordless.distinct())
    inner = docs.select(F.struct("*").alias("_row"), F.col(id_col).alias("_doc"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_text"))
    found = inner.join(kept, inner["_doc"].eqNullSafe(kept["_id"]) & (inner["_text"] == kept["_hash"]))
    once = Window.partitionBy("_doc", "_text").orderBy("_doc")
    found = found.withColumn("_n", F.row_number().over(once)).where(F.col("_all") | (F.col("_n") == 1))
    return found.select("_row.*")


def op8_bagminhash(spark, sf_dir):
    return near_duplicate_classes(read_table(spark, sf_dir, "documents"))
