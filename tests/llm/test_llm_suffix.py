import hashlib
import random

import numpy as np

from llm_cases import frame, odd_rows, prose
from sentiflow.llm import suffix_dedup as S


def brute(rows, length=100):
    """Results of (key, text) rows; equal rows are one document, keys in order are (null first, id, md5 of the text)."""
    docs = sorted({(d is not None, d or 0, hashlib.md5((t or "").encode()).hexdigest(), t or "") for d, t in rows})
    seen, out = set(), {}
    for has, d, _, t in docs:
        b = t.encode()
        gone = bytearray(len(b))
        for i in range(len(b) - length + 1):
            w = b[i : i + length]
            if w in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(w)
        kept = bytes(x for x, g in zip(b, gone) if not g)
        runs = sum(1 for i in range(len(b)) if gone[i] and (i == 0 or not gone[i - 1]))
        out[(d if has else None), t] = len(b), sum(gone), runs, hashlib.sha256(kept).hexdigest()
    return out


def results(spark, rows, **more):
    return sorted((str(r["doc_id"]), *r[1:5]) for r in S.remove_repeats(frame(spark, [(d, t, "en", "s") for d, t in rows]), **more).collect())


def wanted(rows, length=100):
    made = brute(rows, length)
    return sorted((str(d), *made[d, t or ""]) for d, t in rows)


def planted():
    passage, other = prose(70, 60), prose(71, 25)
    rows = [(i, prose(100 + i, 40) + passage[i : 200 + 3 * i] + prose(200 + i, 30)) for i in range(25)]
    rows += [(50 + i, prose(110, 40)) for i in range(4)]  # exact copies
    rows += [(60, (other + " ") * 12), (61, "ab" * 900), (62, "ab" * 130 + other), (63, "a" * 99), (64, "a" * 100), (65, "a" * 400)]
    rows += [(66, "é漢" * 60 + passage), (67, passage[:100]), (68, passage[1:100]), (69, passage[50:149] + "Z" + passage[150:260])]
    return rows


def test_matches_brute_force(spark):
    assert results(spark, planted()) == wanted(planted())


def test_odd_rows_match_brute_force(spark):
    rows = [(d, t) for d, t, _, _ in odd_rows()] + planted()[:8] + planted()[:3]
    assert results(spark, rows) == wanted(rows)
    assert S.remove_repeats(frame(spark, [])).count() == 0


def test_random_small_alphabet(spark):
    rng = random.Random(8)
    rows = [(i, "".join(rng.choice("ab") for _ in range(rng.randint(0, 90)))) for i in range(60)]
    assert results(spark, rows, length=12) == wanted(rows, 12)


def test_sort_by_hashes_orders_windows():
    rng = np.random.default_rng(2)
    data = rng.integers(97, 99, 3000).astype(np.uint8)
    start = rng.integers(0, 2900, 400)
    segment = np.sort(rng.integers(0, 7, 400))
    order = S.SuffixOrder(data, 100).sort(start, segment)
    raw = data.tobytes()
    want = sorted(range(400), key=lambda i: (segment[i], raw[start[i] : start[i] + 100]))  # stable, as the sort is
    assert order.tolist() == want


def test_collisions_are_verified():
    data = np.frombuffer(b"x" * 100 + b"y" * 100, np.uint8)
    order = S.SuffixOrder(data, 100)
    order.hashes.sums[:] = 0  # all stretches now collide
    assert order.common(np.array([0]), np.array([100])).tolist() == [0]


def test_texts_longer_than_a_place_are_cut_into_pieces(spark, monkeypatch):
    """With places of nine bits most texts are scanned in pieces; the result is that of brute force."""
    monkeypatch.setattr(S, "PLACE_BITS", 9)
    rows = planted() + odd_rows_short()
    assert results(spark, [r[:2] for r in rows]) == wanted([r[:2] for r in rows])
    data = np.frombuffer((prose(1, 400) * 2).encode(), np.uint8)
    pieces = S.anchors(data, np.array([0, 700, len(data)]), 100)
    monkeypatch.setattr(S, "PLACE_BITS", 28)
    whole = S.anchors(data, np.array([0, 700, len(data)]), 100)
    covered = [{(r, w, g) for r, f, x, g in zip(a[0].tolist(), a[2].tolist(), a[3].tolist(), a[4].tolist()) for w in range(f, x + 1)} for a in (pieces, whole)]
    assert covered[0] == covered[1]


def odd_rows_short():
    return [(900, prose(5, 300)), (901, prose(5, 300)[500:]), (None, prose(6, 30)), (902, None), (903, "")]


def test_hot_grams_are_dealt_by_what_their_windows_share(spark):
    """With every gram hot, and with a common passage in ever new surroundings: as brute force."""
    rows = planted() + odd_rows_short()
    pairs = [r[:2] for r in rows]
    assert results(spark, pairs, hot=0) == wanted(pairs)
    passage = prose(8, 40)[:95]
    pairs = [(i, prose(1000 + i, 8) + passage + prose(2000 + i, 8)) for i in range(120)] + [(500 + i, prose(1000 + i, 8)[-4:] + passage + prose(2000 + i, 8)[:9]) for i in range(40)]
    assert results(spark, pairs, hot=10) == wanted(pairs)
    assert any(r[2] for r in wanted(pairs))


def test_parts_of_a_hot_gram_hold_few_windows():
    """Contexts around one passage: no part of the gram holds more than those that agree almost everywhere."""
    passage = prose(8, 40)[:95]
    texts = [(prose(1000 + i, 9) + passage + prose(9000 + i, 9)).encode() for i in range(1500)]
    data, off = np.frombuffer(b"".join(texts), np.uint8), np.concatenate([[0], np.cumsum([len(t) for t in texts])])
    row, place, first, last, grams = S.anchors(data, off, 100)
    values, counts = np.unique(grams, return_counts=True)
    assert counts.max() >= 1000
    mine = grams == values[counts.argmax()]
    want = {"h": grams[mine], "doc": row[mine], "place": (place - off[row])[mine], "before": (place - first)[mine], "after": (place - last)[mine], "hot": np.ones(mine.sum(), np.int64)}
    windows = (want["before"] - want["after"] + 1).sum()
    pieces, at = S.dealt(want, row[mine], data, off, 100)
    assert (pieces["before"] - pieces["after"] + 1).sum() == windows
    # only contexts that agree in 93 bytes meet; the passage has 95, so some agree by chance
    sizes = np.unique(pieces["h"], return_counts=True)[1]
    assert sizes.max() < counts.max() / 5 and len(sizes) > 0.5 * len(pieces["h"])
