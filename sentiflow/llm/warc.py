"""WARC archives: a writer with revisits, and a splittable reader.

Writing. Each row is a record, each record a gzip member of its own. Of rows with equal payloads (SHA-256) of at least ``least``
bytes, the one with the smallest id holds the payload (``response``); the others are ``revisit`` records that name it. Members are written by
Spark's text sink, so lost tasks are repeated and committed as any other write: the last byte of a member
travels as the line separator (a member that does not end in a zero byte is followed by an empty one, which does).

Reading. The files are cut into byte ranges, one or a few a task. A task scans its range for the gzip magic. A candidate counts if it
decodes to a WARC header with type and length and then to a whole member whose checksum holds; otherwise the
scan goes on behind its magic. A record belongs to the range in which its first byte lies; its end may be read from the next ones.
Payloads are hashed and counted as they are decoded, in pieces, and never held unless asked for.
The writer decodes its own members at every inner magic and codes a member anew if one would pass for a record, so its archives
read back exactly at any split. In other archives only a payload that itself holds WARC members in stored (uncompressed) form can
be taken for records, by ranges that begin inside it.

Scale: digests and ids are grouped first (equal payloads collapse in each task). Groups that hold more than a thousandth of all
repeated rows are fewer than a thousand and are broadcast; all others are joined by digest, rows without a partner
under keys of their own. The rows are numbered and written once, so that both
reads agree; the payload moves at most once. Reading shuffles (file, range) pairs only.

Defined results: null html is an empty payload; null url is left out; blanks and control characters of an url are percent-coded. Null ids
are larger than any other and are named ``urn:none``. Repeated rows are records of their own, told apart by their place in the
table; an empty table gives empty archives and no records. A damaged member gives no row. Records longer than a range are read by
the task that owns them. A revisit without a stated length has a null one. Other columns are not read.
"""

from __future__ import annotations

import hashlib
import re
import uuid
import zlib
from collections.abc import Iterator
from urllib.parse import quote

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentiflow.llm.common import arrow_rows, by_size, deleted, kept, read_table
from sentiflow.session import scratch_path

MAGIC = b"\x1f\x8b\x08"
#: An empty gzip member, the HTTP head before payloads, the profile of revisits.
EMPTY = zlib.compress(b"", 9, 31)
HTTP = b"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
#: Bytes a range, bytes fed to and taken from the decoder at a time, and most bytes of a header.
SPLIT = 32 << 20
PIECE = 1 << 16
HEADER = 1 << 20
#: A record that holds WARC members is flushed every so many bytes, which breaks up what is stored uncompressed.
BROKEN = 32
#: Groups of equal payloads above this part of all repeated rows are broadcast.
HOT = 1000
CONTROL = re.compile(r"[\x00-\x20\x7f]")


# ------------------------------------------------------------------ records


def record(rid: str, kind: str, url: str | None, payload: bytes, digest: str, n_bytes: int, refers: str | None, date: str) -> bytes:
    """A WARC record; a revisit has no payload, and states its digest and length."""
    block = HTTP if kind == "revisit" else HTTP + payload
    lines = ["WARC/1.1", f"WARC-Type: {kind}", f"WARC-Record-ID: <{rid}>", f"WARC-Date: {date}"]
    if url is not None:
        lines.append("WARC-Target-URI: " + CONTROL.sub(lambda m: f"%{ord(m[0]):02X}", url))
    lines += [f"WARC-Payload-Digest: sha256:{digest}", f"X-Payload-Length: {n_bytes}"]
    if kind == "revisit":
        lines += [f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: <{refers}>"]
    lines += ["Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}"]
    return "\r\n".join(lines).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def member(data: bytes) -> bytes:
    """``data`` as gzip members that end in a zero byte and hold no inner member that passes for a record."""
    for piece in (len(data), BROKEN):
        coder = zlib.compressobj(6, zlib.DEFLATED, 31)
        out = b"".join(coder.compress(data[i : i + piece]) + coder.flush(zlib.Z_FULL_FLUSH) for i in range(0, len(data) - piece, piece))
        out += coder.compress(data[(len(data) - 1) // piece * piece :]) + coder.flush()
        if next(records_in(_Bytes(out), 1, len(out)), None) is None:
            break
    return out if out[-1] == 0 else out + EMPTY


def fields_of(head: bytes) -> dict[str, str] | None:
    """The named fields of a WARC header, or None if it is none."""
    lines = head.split(b"\r\n")
    if not re.fullmatch(rb"WARC/\d+\.\d+", lines[0]):
        return None
    fields = {}
    for line in lines[1:]:
        name, colon, value = line.partition(b":")
        if not colon:
            return None
        fields[name.strip().lower().decode("latin-1")] = value.strip().decode("utf-8", "replace")
    return fields if "warc-type" in fields and fields.get("content-length", "").isdigit() else None


class _Bytes:
    """Random access to bytes in memory."""

    def __init__(self, data: bytes):
        self.data, self.size = data, len(data)

    def at(self, start: int, n: int) -> bytes:
        return self.data[start : start + n]


class _File:
    """Random access to a file of any filesystem that pyarrow opens, a block at a time."""

    BLOCK = 1 << 20

    def __init__(self, path: str, size: int):
        system, where = fs.FileSystem.from_uri(re.sub(r"^file:/(?!/)", "file:///", path))
        self.file, self.size = system.open_input_file(where), size
        self.start, self.block = 0, b""

    def at(self, start: int, n: int) -> bytes:
        if not self.start <= start or start + n > self.start + len(self.block):
            self.start, self.block = start, self.file.read_at(max(0, min(max(n, self.BLOCK), self.size - start)), start)
        return self.block[start - self.start : start - self.start + n]

    def close(self) -> None:
        self.file.close()


def _decoded(source, start: int) -> Iterator[tuple[bytes, int | None]]:
    """Pieces of the member at ``start``; the last is (b"", position behind it). Raises zlib.error or EOFError."""
    decoder, at = zlib.decompressobj(31), start
    fed = 1 << 12
    while not decoder.eof:
        data = decoder.unconsumed_tail
        if not data:
            data = source.at(at, min(fed, source.size - at))
            at, fed = at + len(data), PIECE
            if not data:
                raise EOFError
        yield decoder.decompress(data, PIECE), None
    yield b"", at - len(decoder.unused_data)


def decode(source, start: int, with_payload: bool = False) -> tuple[dict, int] | None:
    """(record, position behind it) of the member at ``start``, or None if no whole WARC record is there."""
    pieces = _decoded(source, start)
    try:
        head = b""
        while b"\r\n\r\n" not in head:
            piece, end = next(pieces)
            head += piece
            if end is not None or len(head) > HEADER or not b"WARC/".startswith(head[:5]):
                return None
        head, _, rest = head.partition(b"\r\n\r\n")
        fields = fields_of(head)
        if fields is None:
            return None
        left, digest, n_bytes, payload = int(fields["content-length"]), hashlib.sha256(), 0, []
        waits = fields.get("content-type", "").startswith("application/http")
        http, tail, end = b"", b"", None
        while True:
            block, rest = rest[:left], rest[left:]
            left -= len(block)
            tail += rest
            if waits:
                http += block
                _, found, block = http.partition(b"\r\n\r\n")
                waits = not found
                if len(http) > HEADER and waits:
                    return None
            if not waits:
                digest.update(block)
                n_bytes += len(block)
                if with_payload:
                    payload.append(block)
            if end is not None:
                break
            rest, end = next(pieces)
    except (zlib.error, EOFError, StopIteration):
        return None
    if left or not tail.startswith(b"\r\n\r\n"):
        return None
    return {"fields": fields, "payload_bytes": n_bytes, "payload_digest": digest.hexdigest(), "payload": b"".join(payload)}, end


def records_in(source, start: int, stop: int, with_payload: bool = False) -> Iterator[tuple[int, int, dict]]:
    """(start, end, record) of the records whose first byte lies in [start, stop)."""
    at = start
    while at < stop:
        window = source.at(at, min(PIECE, stop + len(MAGIC) - 1 - at, source.size - at))
        found = window.find(MAGIC)
        if found < 0:
            at += max(1, len(window) - len(MAGIC) + 1)
            continue
        at += found
        made = decode(source, at, with_payload)
        if made is None:
            at += 1
        else:
            yield at, made[1], made[0]
            at = made[1]


# ------------------------------------------------------------------ tables


def urn(id_col):
    """Name of an id; ids are percent-coded."""
    return F.when(id_col.isNull(), F.lit("urn:none")).otherwise(F.concat(F.lit("urn:page:"), F.url_encode(id_col.cast("string"))))


def id_of(name, kind: str):
    """The id that ``urn`` named."""
    return F.url_decode(F.regexp_extract(name, "^urn:page:(.*)$", 1)).try_cast(kind)


def with_revisits(pages: DataFrame, id_col: str, url_col: str, html_col: str, least: int) -> tuple[DataFrame, list[str]]:
    """(id, url, html, digest, n_bytes, kind, refers) of every row, and the folders of intermediate tables."""
    rows = pages.select(
        F.col(id_col).alias("id"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("binary"), F.lit(b"")).alias("html"),
        F.monotonically_increasing_id().alias("row"),
    )
    rows = rows.select("*", F.sha2("html", 256).alias("digest"), F.octet_length("html").cast("long").alias("n_bytes"))
    rows, numbered = kept(rows, "pages")  # a row's number must be the same wherever it is read
    order = F.struct(F.col("id").isNull().alias("none"), "id", "row")
    groups = rows.where(F.col("n_bytes") >= least).groupBy("digest").agg(F.min(order).alias("first"), F.count("*").alias("n")).where("n > 1")
    groups, folder = kept(groups.select("digest", "first.id", "first.row", "n"), "payloads")
    limit = (groups.agg(F.sum("n")).first()[0] or 0) / HOT
    own = F.concat(F.lit("-"), F.col("row").cast("string"))  # rows that can have no partner are spread by a key of their own
    rows = rows.withColumn("key", F.when(F.col("n_bytes") >= least, F.col("digest")))
    for part, (where, hint) in enumerate((("n > {}", F.broadcast), ("n <= {}", lambda df: df))):
        side = groups.where(where.format(limit)).select(F.col("digest").alias("key"), F.col("id").alias(f"id{part}"), F.col("row").alias(f"row{part}"))
        rows = rows.join(hint(side), "key", "left")
        if not part:
            rows = rows.withColumn("key", F.when(F.col("key").isNull() | F.col("row0").isNotNull(), own).otherwise(F.col("key")))
    first = F.coalesce("row0", "row1")
    revisit = first.isNotNull() & (first != F.col("row"))
    rows = rows.select(
        "id", "url", "html", "digest", "n_bytes", F.when(revisit, "revisit").otherwise("response").alias("kind"),
        F.when(revisit, urn(F.when(F.col("row0").isNotNull(), F.col("id0")).otherwise(F.col("id1")))).alias("refers"),
    )
    return rows, [numbered, folder]


def write_archives(
    pages: DataFrame, path: str, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", least: int = 100,
    date: str = "1970-01-01T00:00:00Z",
) -> None:
    """Write a record a row to gzipped WARC files under ``path``."""
    rows, folders = with_revisits(pages, id_col, url_col, html_col, least)
    rows = rows.withColumn("rid", urn(F.col("id")))

    def members(batches):
        for batch in batches:
            for part in by_size(iter([batch]), "html", 8 << 20):
                cols = [part.column(c).to_pylist() for c in ("rid", "kind", "url", "html", "digest", "n_bytes", "refers")]
                made = [member(record(r, k, u, h, d, n, f, date))[:-1] for r, k, u, h, d, n, f in zip(*cols)]
                yield pa.RecordBatch.from_arrays([pa.array(made, pa.binary())], names=["value"])

    with arrow_rows(pages.sparkSession):
        made = rows.drop("id").mapInArrow(members, "value binary").select(F.col("value").cast("string").alias("value"))
        made.write.option("lineSep", "\0").text(path)
    for folder in folders:
        deleted(pages.sparkSession, folder)


RECORD_DDL = (
    "path string, offset long, length long, record_type string, record_id string, target_uri string, refers_to string, "
    "payload_bytes long, payload_digest string, intact boolean"
)


def read_archives(spark: SparkSession, path: str, split: int = SPLIT, with_payload: bool = False) -> DataFrame:
    """The records of all gzipped WARC files under ``path``.

    For revisits, length and digest are those stated for the payload they refer to. ``intact`` tells whether a payload has the SHA-256
    digest its header states (null if it states none, or for revisits). ``with_payload`` adds the payload.
    """
    files = spark.read.format("binaryFile").load(path).select("path", "length").where("length > 0")
    cut = F.sequence(F.lit(0).cast("long"), F.col("length") - 1, F.lit(split).cast("long"))
    ranges = files.select("path", "length", F.explode(cut).alias("start"))
    tasks = files.agg(F.sum(F.ceil(F.col("length") / split))).first()[0] or 1
    ranges = ranges.repartition(int(tasks), "path", "start")

    def scan(batches):
        for batch in batches:
            for where, size, start in zip(*[batch.column(c).to_pylist() for c in ("path", "length", "start")]):
                source, out = _File(where, size), []
                try:
                    for at, end, found in records_in(source, start, min(start + split, size), with_payload):
                        out.append(_row(where, at, end, found, with_payload))
                        if len(out) >= 1000 or with_payload:
                            yield _rows(out, with_payload)
                            out = []
                finally:
                    source.close()
                yield _rows(out, with_payload)

    return ranges.mapInArrow(scan, RECORD_DDL + (", payload binary" if with_payload else ""))


def _row(path: str, at: int, end: int, found: dict, with_payload: bool) -> tuple:
    f = found["fields"]
    kind, stated = f["warc-type"], f.get("warc-payload-digest", "")
    stated = stated[7:].lower() if stated.lower().startswith("sha256:") else None
    n_bytes, digest, intact = found["payload_bytes"], found["payload_digest"], None
    if kind == "revisit":
        length = f.get("x-payload-length", "")
        n_bytes, digest = int(length) if length.isdigit() else None, stated
    elif stated is not None:
        intact = stated == digest
    names = [f[k].strip("<>") if k in f else None for k in ("warc-record-id", "warc-target-uri", "warc-refers-to")]
    return path, at, end - at, kind, *names, n_bytes, digest, intact, *([found["payload"]] if with_payload else [])


def _rows(rows: list[tuple], with_payload: bool) -> pa.RecordBatch:
    kinds = [pa.string(), pa.int64(), pa.int64(), *[pa.string()] * 4, pa.int64(), pa.string(), pa.bool_(), *[pa.binary()] * with_payload]
    names = [c.split()[0] for c in RECORD_DDL.split(", ")] + ["payload"] * with_payload
    columns = zip(*rows) if rows else [[]] * len(names)
    return pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], names=names)


def op12_warc(spark, sf_dir):
    pages = read_table(spark, sf_dir, "pages")
    path = scratch_path(spark, f"llm/warc-{uuid.uuid4().hex}")
    write_archives(pages, path)
    kind = pages.schema["page_id"].dataType.simpleString()
    return read_archives(spark, path).select(
        id_of(F.col("record_id"), kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type",
        id_of(F.col("refers_to"), kind).alias("refers_to"),
    )


ORACLE_SQL = """
WITH p AS (
  SELECT page_id, row_number() OVER () AS r, CAST(strlen(coalesce(html, '')) AS BIGINT) AS payload_bytes, sha256(coalesce(html, '')) AS payload_digest
  FROM pages
), o AS (
  SELECT *, row_number() OVER (PARTITION BY payload_digest ORDER BY page_id NULLS LAST, r) AS place,
         first(page_id) OVER (PARTITION BY payload_digest ORDER BY page_id NULLS LAST, r) AS head
  FROM p
)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN place > 1 AND payload_bytes >= 100 THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN place > 1 AND payload_bytes >= 100 THEN head END AS refers_to
FROM o
"""
