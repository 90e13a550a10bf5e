import glob
import gzip
import hashlib
import os
import random
import zlib

import pytest

from llm_cases import prose
from sentiflow.llm import warc as W

COLUMNS = "page_id long, url string, html binary, row string, key int, id string, digest string, n_bytes int, kind string, first int, none int"


def pages(spark, rows):
    return spark.createDataFrame([(i, u, h, "x", 1, "y", "z", 2, "k", 3, 4) for i, u, h in rows], COLUMNS)


def odd_pages():
    rows = [(i, f"http://a.net/{i}", prose(i % 7, 40).encode()) for i in range(60)]
    rows += [(100, None, None), (101, "", b""), (102, "http://x/\r\nWARC-Type: a b", b"short"), (103, "http://x", b"short")]
    rows += [(5, "http://again", prose(5, 40).encode())] * 3 + [(None, None, prose(6, 40).encode()), (None, None, prose(77, 40).encode())]
    rows += [(None, None, prose(77, 40).encode()), (104, "u", b"\r\n\r\n" * 40), (105, "u", "é 漢字 🙂 ".encode() * 30), (106, "u", b"x" * 100), (107, "u", b"x" * 100)]
    rows += [(108, "u", b"x" * 99), (109, "u", b"x" * 99)]
    return rows


def brute(rows):
    out, seen = [], {}
    for i, _, h in sorted(rows, key=lambda r: (r[0] is None, r[0] or 0)):
        h = h or b""
        again = len(h) >= 100 and h in seen
        out.append((i, len(h), hashlib.sha256(h).hexdigest(), "revisit" if again else "response", seen[h] if again else None))
        seen.setdefault(h, i)
    return sorted(map(str, out))


def results(spark, path, **more):
    df = W.read_archives(spark, path, **more)
    cols = [W.id_of(df.record_id, "long"), "payload_bytes", "payload_digest", "record_type", W.id_of(df.refers_to, "long")]
    return sorted(str(tuple(r)) for r in df.select(*cols).collect())


def files(path):
    return sorted(glob.glob(f"{path}/part-*"))


@pytest.fixture(scope="module")
def archive(spark, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("warc") / "a")
    W.write_archives(pages(spark, odd_pages()).repartition(3), path)
    return path


def test_round_trip_at_every_split(spark, archive):
    wanted = brute(odd_pages())
    for split in (W.SPLIT, 5000, 997, 64):
        assert results(spark, archive, split=split) == wanted


def test_archives_are_plain_gzip(archive):
    text = b"".join(gzip.open(f).read() for f in files(archive))
    assert text.count(b"WARC/1.1\r\n") == len(odd_pages())
    assert all(open(f, "rb").read()[-1:] == b"\0" for f in files(archive))


def test_every_range_owns_what_begins_in_it(archive):
    for f in files(archive):
        data = open(f, "rb").read()
        whole = [(a, b) for a, b, _ in W.records_in(W._Bytes(data), 0, len(data))]
        assert whole[0][0] == 0 and all(a[1] == b[0] for a, b in zip(whole, whole[1:]))
        for cut in random.Random(1).sample(range(1, len(data)), 40) + [a + d for a, _ in whole[1:4] for d in (-1, 0, 1, 2, 3)]:
            source = W._File(f"file:{f}", len(data))
            parts = [(a, b) for lo, hi in ((0, cut), (cut, len(data))) for a, b, _ in W.records_in(source, lo, hi)]
            assert parts == whole


def test_payloads_and_fields_come_back(spark, archive):
    rows = W.read_archives(spark, archive, with_payload=True).collect()
    assert all(r["intact"] for r in rows if r["record_type"] == "response")
    held = {r["payload"] for r in rows if r["record_type"] == "response"}
    assert held == {h or b"" for _, _, h in odd_pages()}
    assert {r["target_uri"] for r in rows} >= {None, "http://x/%0D%0AWARC-Type:%20a%20b"}


def test_payload_that_holds_an_archive(spark, tmp_path):
    inner = b"".join(W.member(W.record(f"urn:page:{i}", "response", "u", os.urandom(300), "0", 300, None, "d")) for i in range(30))
    rows = [(1, "u", inner), (2, "u", os.urandom(200) + inner), (3, "u", prose(1).encode())]
    W.write_archives(pages(spark, rows), str(tmp_path / "a"))
    for split in (W.SPLIT, 2000, 301):
        assert results(spark, str(tmp_path / "a"), split=split) == brute(rows)


def test_long_records(spark, tmp_path):
    big = b"abc" * (6 << 20)  # a member of over 2**24 bytes does not end in a zero byte
    rows = [(1, "u", big), (2, "u", prose(2).encode()), (3, "u", big), (4, "u", os.urandom(3 << 20))]
    W.write_archives(pages(spark, rows).coalesce(1), str(tmp_path / "a"))
    for split in (W.SPLIT, 100_000):
        assert results(spark, str(tmp_path / "a"), split=split) == brute(rows)


def test_damage_costs_the_damaged_record_only():
    made = [W.member(W.record(f"urn:page:{i}", "response", "u", prose(i).encode(), "0", 1, None, "d")) for i in range(9)]
    made[2] = made[2][:200] + b"?" + made[2][201:]
    made[5] = made[5][: len(made[5]) // 2]
    made[7] = zlib.compress(b"WARC/1.0\r\nWARC-Type: warcinfo\r\n\r\n", 9, 31)  # no length
    data = b"junk\x1f\x8b\x08" + b"".join(made) + b"\x1f\x8b"
    got = [r["fields"]["warc-record-id"] for _, _, r in W.records_in(W._Bytes(data), 0, len(data))]
    assert got == [f"<urn:page:{i}>" for i in (0, 1, 3, 4, 6, 8)]


def test_foreign_members(spark, tmp_path):
    """Other writers' records: no HTTP head, no digest, lower-case names, a revisit without a length."""
    made = b"WARC/1.0\r\nwarc-type: resource\r\nContent-Length: 3\r\n\r\nabc\r\n\r\n", b"WARC/1.0\r\nWARC-Type: revisit\r\nContent-Length: 0\r\n\r\n\r\n\r\n"
    (tmp_path / "b").mkdir()
    (tmp_path / "b" / "x.warc.gz").write_bytes(b"".join(gzip.compress(m) for m in made))
    got = sorted(tuple(r)[3:] for r in W.read_archives(spark, str(tmp_path / "b")).collect())
    assert got == [("resource", None, None, None, 3, hashlib.sha256(b"abc").hexdigest(), None), ("revisit", None, None, None, None, None, None)]


def test_hot_payload_and_empty_table(spark, tmp_path):
    rows = [(i, "u", prose(1, 30).encode()) for i in range(700)] + [(1000 + i, "u", prose(i // 2, 30).encode()) for i in range(2, 400)]
    W.write_archives(pages(spark, rows), str(tmp_path / "a"))
    assert results(spark, str(tmp_path / "a")) == brute(rows)
    W.write_archives(pages(spark, []), str(tmp_path / "b"))
    assert results(spark, str(tmp_path / "b")) == []
