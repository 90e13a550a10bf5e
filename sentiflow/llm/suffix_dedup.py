"""Exact removal of repeated 100-byte strings with hash-compared suffix sorting.

A byte goes if a ``length``-byte string over it also starts earlier: in a document of smaller id, or in the
same document at an earlier byte. Strings are judged on the input; overlaps count.

1. Every window of ``length`` bytes has an anchor, the ``GRAM`` bytes in it with the smallest polynomial hash
   (rightmost of equals). Equal windows have equal anchors at equal offsets. The windows that share an anchor
   form one context, a stretch of the text; anchors travel as (gram hash, context digest, document, place).
2. By gram hash: equal contexts make all windows of the later ones repeats. Where one gram has several
   contexts, the first of each is asked for its bytes.
3. Those windows are sorted as suffixes, per gram and offset, by a merge sort whose comparisons find the
   common extension by binary search over prefix polynomial hashes. Equal hashes of whole windows are
   verified byte by byte. All but the first of equal windows are repeats.
4. Each document merges its removed runs and hashes what is left.

Scale: only anchors (one in about 35 bytes), the bytes of ambiguous contexts and twice the texts are
shuffled, all in packed arrays in buckets of about ``BUCKET_BYTES`` of text. Repeats inside a task are
settled there, so a context that a third of all rows hold travels once a task. Different contexts of one gram (a common passage in ever
new surroundings) meet in a bucket while they are ``HOT`` at most; those of a hotter gram are cut by ranges of offsets and
dealt by a hash of the bytes that all windows of the range share, so only contexts that agree in over ``length`` - ``OFFSETS`` bytes meet.

Defined results: null text is empty; a null id sorts first; rows that share id and text are one document
and get equal results; other rows that share an id are ordered by the md5 of their text; texts shorter than
``length`` lose nothing; a text of 2**28 bytes or more is scanned in pieces that share no window; an empty table gives no rows;
other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentiflow.llm.common import by_size, read_table, small_batches, utf8_column, written
from sentiflow.llm.hashing import PrefixHashes, mixed

LENGTH = 100
GRAM = 32
SLICE_BYTES = 2 << 20
BUCKET_BYTES = 4 << 20
FLUSH_ANCHORS = 1 << 19
#: Windows sorted at a time; all windows of one gram (of one part of a hot gram) stay together.
SORT_WINDOWS = 1 << 19
PLACE_BITS = 28
PACKED = "bucket long, kind int, payload binary"
ANCHOR = [("h", np.uint64), ("c", np.uint64), ("doc", np.int64), ("place", np.int64), ("before", np.int64), ("after", np.int64)]
RUN = [("doc", np.int64), ("first", np.int64), ("last", np.int64)]
WANTED = [("h", np.uint64), ("doc", np.int64), ("place", np.int64), ("before", np.int64), ("after", np.int64)]
ASKED_FOR = [*WANTED, ("hot", np.int64)]
#: The windows of a gram with more contexts than this are dealt by what they share, in ranges of so many offsets.
HOT = 1024
OFFSETS = 8
FOUND, REPEATS, ASKED = 0, 1, 2


def window_min(values: np.ndarray, width: int) -> np.ndarray:
    """Least of each ``width`` neighbours."""
    size = 1
    while 2 * size <= width:
        values = np.minimum(values[:-size], values[size:])
        size *= 2
    if size < width:
        values = np.minimum(values[: len(values) - (width - size)], values[width - size :])
    return values


def anchors(data: np.ndarray, off: np.ndarray, length: int = LENGTH) -> tuple[np.ndarray, ...]:
    """(row, anchor, first window, last window, gram hash) of every context; places within ``data``."""
    empty = tuple(np.zeros(0, np.int64) for _ in range(4)) + (np.zeros(0, np.uint64),)
    if len(data) < length:
        return empty
    if len(data) >= 1 << PLACE_BITS:
        return _anchors_of_pieces(data, off, length)
    gram = min(GRAM, length)
    hashes = PrefixHashes(data)
    start = np.arange(len(data) - gram + 1)
    grams = mixed(hashes.of(start, gram))
    low = np.uint64((1 << PLACE_BITS) - 1)
    least = window_min((grams & ~low) | (low - start.astype(np.uint64)), length - gram + 1)
    chosen = (low - (least & low)).astype(np.int64)  # rightmost smallest gram of each window
    sizes = np.diff(off)
    fits = np.flatnonzero(np.repeat(off[1:], sizes)[: len(chosen)] - start[: len(chosen)] >= length)
    if not len(fits):
        return empty
    chosen = chosen[fits]
    new = np.flatnonzero(np.concatenate([[True], chosen[1:] != chosen[:-1]]))
    first, last = fits[new], fits[np.concatenate([new[1:], [len(fits)]]) - 1]
    place = chosen[new]
    return np.searchsorted(off, place, side="right") - 1, place, first, last, grams[place]


def _anchors_of_pieces(data: np.ndarray, off: np.ndarray, length: int) -> tuple[np.ndarray, ...]:
    """``anchors`` of more bytes than a place holds, from pieces that share no window; a context over a cut becomes two."""
    step, parts = (1 << PLACE_BITS) - length, []
    for a in range(0, len(data) - length + 1, step):
        b = min(len(data), a + step + length - 1)
        row, place, first, last, grams = anchors(data[a:b], np.clip(off, a, b) - a, length)
        parts.append((row, place + a, first + a, last + a, grams))
    return tuple(np.concatenate(c) for c in zip(*parts))


def pack(fields, columns: dict[str, np.ndarray]) -> bytes:
    """Columns one after another, eight bytes a value by byte planes: high zero bytes then compress away."""
    n = len(columns[fields[0][0]])
    planes = [np.ascontiguousarray(columns[k].astype(kind).view(np.uint8).reshape(n, 8).T).tobytes() for k, kind in fields]
    return b"".join(planes)


def unpack(fields, payload: bytes) -> dict[str, np.ndarray]:
    n = len(payload) // (8 * len(fields))
    planes = np.frombuffer(payload, np.uint8).reshape(len(fields), 8, n)
    return {k: np.ascontiguousarray(planes[i].T).reshape(-1).view(kind) for i, (k, kind) in enumerate(fields)}


def unpack_all(fields, payloads) -> dict[str, np.ndarray]:
    parts = [unpack(fields, p) for p in payloads]
    return {k: np.concatenate([np.zeros(0, kind), *(p[k] for p in parts)]) for k, kind in fields}


def packed_rows(fields, columns: dict[str, np.ndarray], bucket: np.ndarray, kind: int) -> list[tuple[int, int, bytes]]:
    order = np.argsort(bucket, kind="stable")
    bucket = bucket[order]
    columns = {k: columns[k][order] for k, _ in fields}
    edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(bucket) else [0]
    return [(int(bucket[a]), kind, pack(fields, {k: v[a:b] for k, v in columns.items()})) for a, b in zip(edges[:-1], edges[1:])]


def arrow_rows(rows) -> pa.RecordBatch:
    rows = list(rows)
    return pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows], pa.int64()), pa.array([r[1] for r in rows], pa.int32()), pa.array([r[2] for r in rows], pa.binary())],
        names=["bucket", "kind", "payload"],
    )


def doc_bucket(doc: Column, buckets: int) -> Column:
    """A document's bucket; ``doc_buckets`` gives the same for arrays."""
    return F.pmod(F.shiftright(F.pmod(doc, F.lit(1 << 31)) * F.lit(2654435761), 15), F.lit(buckets))


def doc_buckets(doc: np.ndarray, buckets: int) -> np.ndarray:
    return ((doc % (1 << 31)) * 2654435761 >> 15) % buckets


def merged_runs(doc: np.ndarray, first: np.ndarray, last: np.ndarray) -> dict[str, np.ndarray]:
    """Runs of window starts with touching and overlapping ones of a document joined."""
    order = np.lexsort((first, doc))
    doc, first, last = doc[order], first[order], last[order]
    if not len(doc):
        return {"doc": doc, "first": first, "last": last}
    span = int(last.max()) + 2
    rank = np.cumsum(np.concatenate([[0], doc[1:] != doc[:-1]]))  # keeps documents apart in one running maximum
    reach = np.maximum.accumulate(last + rank * span) - rank * span
    new = np.concatenate([[True], (doc[1:] != doc[:-1]) | (first[1:] > reach[:-1] + 1)])
    at = np.flatnonzero(new)
    return {"doc": doc[at], "first": first[at], "last": reach[np.concatenate([at[1:], [len(doc)]]) - 1]}


def first_of_equal(a: dict[str, np.ndarray]) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """Anchors ordered by (h, c, doc, place), and which are the first of their context."""
    order = np.lexsort((a["place"], a["doc"], a["c"], a["h"]))
    a = {k: v[order] for k, v in a.items()}
    same = (a["h"][1:] == a["h"][:-1]) & (a["c"][1:] == a["c"][:-1])
    first = np.concatenate([[True], ~same])[: len(order)]
    begin = np.maximum.accumulate(np.where(first, np.arange(len(order)), 0))
    # rows that hold one document twice are equally early
    return a, first | ((a["doc"] == a["doc"][begin]) & (a["place"] == a["place"][begin]))


def runs_of(a: dict[str, np.ndarray], rows: np.ndarray) -> dict[str, np.ndarray]:
    return merged_runs(a["doc"][rows], (a["place"] - a["before"])[rows], (a["place"] - a["after"])[rows])


def find_anchors(length: int, buckets: int):
    """Batches (doc, text) -> packed first anchors by gram, and the runs that repeat within the task."""

    def settle(parts):
        a = {k: np.concatenate([p[k] for p in parts]) for k, _ in ANCHOR}
        a, first = first_of_equal(a)
        runs = runs_of(a, ~first)
        kept = {k: v[first] for k, v in a.items()}
        yield from packed_rows(ANCHOR, kept, (kept["h"] % np.uint64(buckets)).astype(np.int64), FOUND)
        yield from packed_rows(RUN, runs, doc_buckets(runs["doc"], buckets), REPEATS)

    def scan(batches):
        parts, held = [], 0
        for batch in by_size(batches, "text", SLICE_BYTES):
            data, off = utf8_column(batch.column("text"))
            row, place, first, last, grams = anchors(data, off, length)
            raw = data.tobytes()
            digest = b"".join([hashlib.blake2b(raw[a:b], digest_size=8).digest() for a, b in zip(first.tolist(), (last + length).tolist())])
            doc = batch.column("doc").to_numpy(zero_copy_only=False)[row].astype(np.int64)
            parts.append({"h": grams, "c": np.frombuffer(digest, np.uint64), "doc": doc, "place": place - off[row],
                          "before": place - first, "after": place - last})
            held += len(row)
            if held >= FLUSH_ANCHORS:
                yield arrow_rows(settle(parts))
                parts, held = [], 0
        if parts:
            yield arrow_rows(settle(parts))

    return scan


def compare_contexts(buckets: int, hot: int = HOT):
    """A bucket's packed rows -> runs that repeat, and the contexts that must be seen, by document bucket."""

    def compare(table: pa.Table) -> pa.Table:
        kind, payload = table.column("kind").to_numpy(), table.column("payload").to_pylist()
        runs = [unpack_all(RUN, [p for k, p in zip(kind, payload) if k == REPEATS])]
        a, first = first_of_equal(unpack_all(ANCHOR, [p for k, p in zip(kind, payload) if k == FOUND]))
        runs.append(runs_of(a, ~first))
        reps = {k: v[first] for k, v in a.items()}
        if len(reps["h"]):
            new_h = np.concatenate([[True], reps["h"][1:] != reps["h"][:-1]])
            new_c = new_h | np.concatenate([[True], reps["c"][1:] != reps["c"][:-1]])
            contexts = np.bincount(np.cumsum(new_h) - 1, new_c)
            of = np.cumsum(new_h) - 1
            several = (contexts > 1)[of] & new_c
            reps = {k: v[several] for k, v in reps.items()} | {"hot": (contexts > hot)[of][several].astype(np.int64)}
        else:
            reps["hot"] = np.zeros(0, np.int64)
        runs = merged_runs(*(np.concatenate([r[k] for r in runs]) for k, _ in RUN))
        rows = packed_rows(RUN, runs, doc_buckets(runs["doc"], buckets), REPEATS)
        rows += packed_rows(ASKED_FOR, reps, doc_buckets(reps["doc"], buckets), ASKED)
        return pa.Table.from_batches([arrow_rows(rows)])

    return compare


def dealt(want: dict[str, np.ndarray], row: np.ndarray, data: np.ndarray, off: np.ndarray, length: int) -> tuple[dict[str, np.ndarray], np.ndarray]:
    """``want`` with the contexts of hot grams cut by ranges of offsets, under keys that hold a hash of what their windows share.

    All windows of a range hold the bytes from the first start of the range's least offset to the end of its largest. Windows that are equal
    have the same range and the same such bytes, hence the same key; contexts with other bytes there go other ways.
    """
    is_hot = want.pop("hot") > 0
    if not is_hot.any():
        return want, row
    width = max(1, min(OFFSETS, length // 2))
    hot = {k: v[is_hot] for k, v in want.items()}
    low, high = hot["after"] // width, hot["before"] // width
    many = high - low + 1
    of = np.repeat(np.arange(len(many)), many)
    part = low[of] + np.arange(len(of)) - np.repeat(np.cumsum(many) - many, many)
    pieces = {k: v[of] for k, v in hot.items()}
    shared = PrefixHashes(data).of(off[row[is_hot][of]] + pieces["place"] - part * width, length - width + 1)
    pieces["before"] = np.minimum(pieces["before"], part * width + width - 1)
    pieces["after"] = np.maximum(pieces["after"], part * width)
    pieces["h"] = mixed(mixed(pieces["h"] + part.astype(np.uint64)) ^ shared)
    out = {k: np.concatenate([v[~is_hot], pieces[k]]) for k, v in want.items()}
    return out, np.concatenate([row[~is_hot], row[is_hot][of]])


def cut_contexts(length: int, buckets: int):
    """(documents of a bucket, contexts asked of them) -> the contexts' bytes, by gram."""

    def cut(docs: pa.Table, asked: pa.Table) -> pa.Table:
        want = unpack_all(ASKED_FOR, asked.column("payload").to_pylist())
        if not len(want["h"]) or not docs.num_rows:
            return pa.Table.from_batches([arrow_rows([])])
        data, off = utf8_column(docs.column("text").combine_chunks())
        doc = docs.column("doc").to_numpy()
        order = np.argsort(doc, kind="stable")
        row = order[np.searchsorted(doc[order], want["doc"])]
        want, row = dealt(want, row, data, off, length)
        start = off[row] + want["place"] - want["before"]
        size = want["before"] - want["after"] + length
        bucket = (want["h"] % np.uint64(buckets)).astype(np.int64)
        by = np.argsort(bucket, kind="stable")
        edges = np.flatnonzero(np.concatenate([[True], bucket[by][1:] != bucket[by][:-1], [True]]))
        raw, rows = data.tobytes(), []
        for a, b in zip(edges[:-1], edges[1:]):
            own = by[a:b]
            head = pack(WANTED, {k: v[own] for k, v in want.items()})
            body = b"".join([raw[s : s + n] for s, n in zip(start[own].tolist(), size[own].tolist())])
            rows.append((int(bucket[own[0]]), ASKED, len(own).to_bytes(8, "little") + head + body))
        return pa.Table.from_batches([arrow_rows(rows)])

    return cut


class SuffixOrder:
    """Orders windows of some bytes; comparisons look up common extensions in prefix hashes."""

    def __init__(self, data: np.ndarray, length: int):
        self.data, self.length, self.hashes = data, length, PrefixHashes(data)

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension of the windows at ``a`` and ``b``, at most ``length``."""
        out = np.full(len(a), self.length)
        equal = self.hashes.of(a, self.length) == self.hashes.of(b, self.length)
        for part in np.array_split(np.flatnonzero(equal), max(1, int(equal.sum()) >> 16)):  # verify whole matches
            step = np.arange(self.length)
            same = self.data[a[part, None] + step] == self.data[b[part, None] + step]
            out[part] = np.where(same.all(axis=1), self.length, same.argmin(axis=1))
        rest = np.flatnonzero(~equal)
        low, high = np.zeros(len(rest), np.int64), np.full(len(rest), self.length)
        x, y = a[rest], b[rest]
        while len(rest) and int((high - low).max()) > 1:  # extensions of ``low`` agree, of ``high`` do not
            mid = (low + high) >> 1
            agree = self.hashes.of(x, mid) == self.hashes.of(y, mid)
            low, high = np.where(agree, mid, low), np.where(agree, high, mid)
        out[rest] = low
        return out

    def below(self, a: np.ndarray, b: np.ndarray, or_equal: bool) -> np.ndarray:
        shared = self.common(a, b)
        whole = shared == self.length
        shared = np.minimum(shared, self.length - 1)
        return np.where(whole, or_equal, self.data[a + shared] < self.data[b + shared])

    def sort(self, start: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """Stable order of windows within each segment; equal segments are neighbours."""
        n = len(start)
        order = np.arange(n)
        edges = np.flatnonzero(np.concatenate([[True], segment[1:] != segment[:-1], [True]]))
        begin = np.repeat(edges[:-1], np.diff(edges))
        end = np.repeat(edges[1:], np.diff(edges))
        longest, width = int(np.diff(edges).max(initial=0)), 1
        slot = np.arange(n)
        while width < longest:
            run = (slot - begin) // width
            left = run % 2 == 0
            other = np.where(left, begin + (run + 1) * width, begin + (run - 1) * width)
            paired = np.flatnonzero(other < end)
            low = other[paired]
            high = np.minimum(low + width, end[paired])
            base, is_left = low.copy(), left[paired]
            mine = start[order[paired]]
            open_ = np.arange(len(paired))
            while len(open_):  # how many of the other run stand before me
                mid = (low[open_] + high[open_]) >> 1
                theirs = start[order[mid]]
                me = mine[open_]
                side = is_left[open_]
                before = np.empty(len(open_), bool)
                before[side] = self.below(theirs[side], me[side], False)
                before[~side] = self.below(theirs[~side], me[~side], True)
                low[open_] = np.where(before, mid + 1, low[open_])
                high[open_] = np.where(before, high[open_], mid)
                open_ = open_[low[open_] < high[open_]]
            place = slot.copy()
            own_begin = begin[paired] + run[paired] * width
            target = np.where(is_left, own_begin, base) + (paired - own_begin) + (low - base)
            place[paired] = target
            moved = np.empty(n, np.int64)
            moved[place] = order
            order = moved
            width *= 2
        return order


def gram_groups(want: dict[str, np.ndarray]):
    """Rows of contexts, gram by gram, for about SORT_WINDOWS windows at a time."""
    order = np.argsort(want["h"], kind="stable")
    h = want["h"][order]
    ends = np.flatnonzero(np.concatenate([h[1:] != h[:-1], [True]])[: len(h)]) + 1
    windows = np.cumsum((want["before"] - want["after"] + 1)[order])
    start = done = 0
    for end in ends.tolist():
        if windows[end - 1] - done >= SORT_WINDOWS or end == len(order):
            yield order[start:end]
            start, done = end, windows[end - 1]


def repeated_windows(data: np.ndarray, size: np.ndarray, want: dict[str, np.ndarray], length: int) -> dict[str, np.ndarray]:
    """Runs of windows of the given contexts that equal an earlier one."""
    windows = want["before"] - want["after"] + 1
    of = np.repeat(np.arange(len(size)), windows)
    shift = np.arange(len(of)) - np.repeat(np.cumsum(windows) - windows, windows)
    start = np.repeat(np.cumsum(size) - size, windows) + shift
    offset = want["before"][of] - shift  # from the window's start to its anchor
    first = (want["place"] - want["before"])[of] + shift
    order = np.lexsort((first, want["doc"][of], offset, want["h"][of]))
    h, offset = want["h"][of][order], offset[order]
    new = np.concatenate([[True], (h[1:] != h[:-1]) | (offset[1:] != offset[:-1])])[: len(order)]
    segment = np.cumsum(new) - 1
    several = np.bincount(segment, minlength=1)[segment] > 1
    order, segment = order[several], segment[several]
    sorter = SuffixOrder(data, length)
    # windows whose whole hash no other of the segment has equal none and need no place in the order
    whole = sorter.hashes.of(start[order], length)
    by = np.lexsort((whole, segment))
    alike = (whole[by][1:] == whole[by][:-1]) & (segment[by][1:] == segment[by][:-1])
    kept = np.zeros(len(order), bool)
    kept[by[1:][alike]] = kept[by[:-1][alike]] = True
    order, segment = order[kept], segment[kept]
    ranked = order[sorter.sort(start[order], segment)]
    if not len(ranked):
        return merged_runs(*(np.zeros(0, np.int64) for _ in RUN))
    a, b = start[ranked[:-1]], start[ranked[1:]]
    inside = np.flatnonzero(segment[1:] == segment[:-1])
    again = np.zeros(len(ranked), bool)
    again[1:][inside] = sorter.common(a[inside], b[inside]) == length
    gone = ranked[again]
    return merged_runs(want["doc"][of][gone], first[gone], first[gone])


def sort_contexts(length: int, buckets: int):
    """A bucket's contexts with their bytes -> runs that repeat, by document bucket."""

    def sort(table: pa.Table) -> pa.Table:
        parts, bodies = [], []
        for payload in table.column("payload").to_pylist():
            n = int.from_bytes(payload[:8], "little")
            head = 8 + 8 * len(WANTED) * n
            parts.append(unpack(WANTED, payload[8:head]))
            bodies.append(payload[head:])
        want = {k: np.concatenate([p[k] for p in parts]) for k, _ in WANTED}
        data = b"".join(bodies)
        size = want["before"] - want["after"] + length
        begin = np.cumsum(size) - size
        found = []
        for rows in gram_groups(want):
            own = np.frombuffer(b"".join([data[a : a + n] for a, n in zip(begin[rows].tolist(), size[rows].tolist())]), np.uint8)
            found.append(repeated_windows(own, size[rows], {k: v[rows] for k, v in want.items()}, length))
        runs = merged_runs(*(np.concatenate([np.zeros(0, np.int64), *(f[k] for f in found)]) for k, _ in RUN))
        return pa.Table.from_batches([arrow_rows(packed_rows(RUN, runs, doc_buckets(runs["doc"], buckets), REPEATS))])

    return sort


RESULT = "doc long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>"
SPANS = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))


def cut_texts(length: int):
    """(documents of a bucket, their runs) -> removed spans and the digest of the rest."""

    def cut(docs: pa.Table, runs: pa.Table) -> pa.Table:
        r = unpack_all(RUN, runs.column("payload").to_pylist())
        r = merged_runs(r["doc"], r["first"], r["last"] + length - 1)  # now bytes, not window starts
        doc = docs.column("doc").to_numpy()
        low, high = np.searchsorted(r["doc"], doc, side="left"), np.searchsorted(r["doc"], doc, side="right")
        out = []
        for d, text, a, b in zip(doc.tolist(), docs.column("text").to_pylist(), low.tolist(), high.tolist()):
            kept, at, spans = hashlib.sha256(), 0, []
            for s, e in zip(r["first"][a:b].tolist(), r["last"][a:b].tolist()):
                kept.update(text[at:s])
                at = e + 1
                spans.append({"start": s, "end": at})
            kept.update(text[at:])
            out.append((d, len(text), sum(s["end"] - s["start"] for s in spans), len(spans), kept.hexdigest(), spans))
        columns = list(zip(*out)) or [()] * 6
        kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), SPANS]
        names = ["doc", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=names)

    return cut


def numbered(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(doc long, text binary) in the order of the ids, and the ids by number where a number had to be given."""
    plain = isinstance(docs.schema["doc_id"].dataType, (T.LongType, T.IntegerType, T.ShortType, T.ByteType))
    text = F.coalesce(F.col("text"), F.lit("")).cast("binary").alias("text")
    if plain:
        count = docs.agg(F.count("doc_id").alias("ids"), F.count(F.lit(1)).alias("rows")).first()
        repeated = docs.groupBy("doc_id").count().where("count > 1").limit(1).count()
        if count["ids"] == count["rows"] and not repeated:
            return docs.select(F.col("doc_id").cast("long").alias("doc"), text), None
    keyed = docs.select("doc_id", text).withColumn("sum", F.md5("text"))
    distinct = keyed.select("doc_id", "sum").distinct()
    pairs = distinct.orderBy(F.asc_nulls_first("doc_id"), "sum").rdd.zipWithIndex().map(lambda x: (*x[0], x[1]))
    kind = docs.schema["doc_id"].dataType
    ids = written(
        docs.sparkSession.createDataFrame(
            pairs, T.StructType([T.StructField("doc_id", kind), T.StructField("sum", T.StringType()), T.StructField("doc", T.LongType())])
        ),
        "numbers",
    )
    match = keyed["doc_id"].eqNullSafe(ids["doc_id"]) & (keyed["sum"] == ids["sum"])
    return keyed.join(ids, match).select("doc", "text"), ids.select("doc", "doc_id")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, hot: int = HOT) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans) of every row; spans are byte ranges that go."""
    spark = docs.sparkSession
    rows, ids = numbered(small_batches(docs).select(F.col(id_col).alias("doc_id"), F.col(text_col).alias("text")))
    size = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    buckets = max(-(-size // BUCKET_BYTES), int(spark.conf.get("spark.sql.shuffle.partitions")))
    held = rows.withColumn("bucket", doc_bucket(F.col("doc"), buckets)).groupBy("bucket")

    compared = written(
        rows.mapInArrow(find_anchors(length, buckets), PACKED)
        .groupBy("bucket")
        .applyInArrow(compare_contexts(buckets, hot), PACKED),
        "compared",
    )
    sorted_runs = written(
        held.cogroup(compared.where(F.col("kind") == ASKED).groupBy("bucket"))
        .applyInArrow(cut_contexts(length, buckets), PACKED)
        .groupBy("bucket")
        .applyInArrow(sort_contexts(length, buckets), PACKED),
        "sorted",
    )
    runs = compared.where(F.col("kind") == REPEATS).unionByName(sorted_runs)
    out = held.cogroup(runs.groupBy("bucket")).applyInArrow(cut_texts(length), RESULT)
    if ids is None:
        kind = docs.schema[id_col].dataType
        return out.withColumn("doc", F.col("doc").cast(kind)).withColumnRenamed("doc", "doc_id")
    return out.join(ids, "doc").drop("doc").select("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans")


def op10_suffix_dedup(spark, sf_dir):
    return remove_repeats(read_table(spark, sf_dir, "documents")).drop("spans")
