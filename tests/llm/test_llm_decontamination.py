import hashlib
import random

import numpy as np
import pytest

from llm_cases import frame, odd_rows, prose
from sentiflow.llm import decontamination as D


def brute(text, items, window=13):
    words = [m[0] for m in D.WORD.finditer((text or "").translate(D.LOWER))]
    hit, found = set(), set()
    for item, t in items:
        own = [m[0] for m in D.WORD.finditer((t or "").translate(D.LOWER))]
        n = min(window, len(own))
        phrases = {tuple(own[i : i + n]) for i in range(len(own) - n + 1)} if own else set()
        for i in range(len(words) - n + 1):
            if n and tuple(words[i : i + n]) in phrases:
                hit.update(range(i, i + n))
                found.add(item)
    ids = ",".join(sorted(map(str, found)))
    return len(words), len(hit), len(found), hashlib.sha256(ids.encode()).hexdigest(), bool(hit) and 20 * len(hit) >= len(words)


ITEMS = [(10, prose(500, 30)), (9, prose(501, 5)), (11, None), (12, ""), (13, "..."), (14, prose(500, 30)), (15, "Word")]


def planted():
    a = prose(500, 30).split()
    rows = odd_rows()
    rows += [
        (20, prose(7, 300) + " " + " ".join(a) + " " + prose(8, 20), "en", "a"),  # whole item
        (21, prose(9, 40) + " " + " ".join(a[3:16]).upper() + "! " + prose(10, 10), "en", "a"),  # one window
        (22, prose(11, 40) + " " + " ".join(a[3:15]), "en", "a"),  # a word short
        (23, prose(501, 5), "en", "a"),  # a short item is one window
        (24, (" ".join(a) + "; ") * 30, "en", "a"),  # overlaps
        (25, " ".join(a[:12]), "en", "a"),
        (26, " ".join(a[12:]), "en", "a"),  # its first window is at its own start, not in the text before
    ]
    return rows


@pytest.mark.parametrize("block_words", [1, 1 << 20])
def test_contamination_matches_brute_force(spark, block_words):
    rows = planted()
    items = spark.createDataFrame([(i, t, 1) for i, t in ITEMS], "item_id long, text string, _words int")
    got = D.find_contamination(frame(spark, rows), items, block_words=block_words).collect()
    assert len(got) == len(rows)
    want = sorted((str(d), *brute(t, ITEMS)) for d, t, _, _ in rows)
    assert sorted((str(r["doc_id"]), *r[1:6]) for r in got) == want
    texts = {d: t for d, t, _, _ in rows}
    for r in got:
        for s in r["spans"]:
            assert r["doc_id"] in (7, 20, 21, 23, 24, 26) and texts[r["doc_id"]][s["start"] : s["end"]].strip(" ;!") != ""
    spans = {r["doc_id"]: r["spans"] for r in got}
    (only,) = spans[21]
    assert texts[21][only["start"] : only["end"]].lower() == " ".join(prose(500, 30).split()[3:16])


def test_drop_keeps_clean_rows_and_columns(spark):
    rows = planted()
    docs = frame(spark, rows)
    items = spark.createDataFrame(ITEMS, "item_id long, text string")
    kept = D.drop_contaminated(docs, items)
    assert kept.columns == docs.columns
    want = sorted(str(d) for d, t, _, _ in rows if not brute(t, ITEMS)[-1])
    assert sorted(str(r["doc_id"]) for r in kept.collect()) == want
    assert D.find_contamination(docs.limit(0), items).count() == 0
    assert not any(r["contaminated"] for r in D.find_contamination(docs, items.limit(0)).collect())


def test_index_finds_all_occurrences():
    rng = random.Random(3)
    for kinds, size in ((2, 400), (5, 700), (40, 300)):
        symbols = np.array([rng.choice([0, *range(1, kinds)]) if rng.random() < 0.1 else rng.randint(1, kinds - 1) for _ in range(size)] + [0])
        index = D.FMIndex(symbols, kinds)
        for length in (1, 2, 3, 7):
            phrases = np.array([symbols[i : i + length] for i in rng.sample(range(size - length), 30) if (symbols[i : i + length] > 0).all()] + [[1] * length])
            low, high = index.search(phrases)
            for p, a, b in zip(phrases, low, high):
                want = [i for i in range(len(symbols) - length + 1) if (symbols[i : i + length] == p).all()]
                assert sorted(index.locate(np.arange(a, b)).tolist()) == want


def test_suffix_array_and_wavelet_ranks():
    rng = np.random.default_rng(4)
    symbols = np.append(rng.integers(0, 4, 500), 0)
    order = D.suffix_array(symbols)
    assert sorted(order.tolist()) == list(range(501))
    tree = D.WaveletTree(symbols, 4)
    for c in range(4):
        at = np.arange(502)
        assert tree.rank(np.full(502, c), at).tolist() == [int((symbols[:i] == c).sum()) for i in at]
    got, ranks = tree.get(np.arange(501))
    assert got.tolist() == symbols.tolist()
