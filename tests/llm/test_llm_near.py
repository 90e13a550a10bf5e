import random
from collections import Counter

import numpy as np
import pytest

from llm_cases import frame, odd_rows, prose, rows_of
from sentiflow.llm import near_dedup as N
from sentiflow.llm.decontamination import LOWER, WORD


def bag(text):
    w = [m[0] for m in WORD.finditer((text or "").translate(LOWER))]
    return Counter(tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))) if w else None


def brute_classes(rows, threshold=0.8):
    """Class number of each row by all pairs."""
    bags = [bag(t) for _, t in rows]
    parent = list(range(len(rows)))

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            if bags[i] and bags[j]:
                both = sum((bags[i] & bags[j]).values())
                if both >= threshold * (sum(bags[i].values()) + sum(bags[j].values()) - both):
                    parent[root(i)] = root(j)
    return [root(i) for i in range(len(rows))]


def planted():
    rng = random.Random(5)
    rows = [(i, prose(i, 80)) for i in range(20)]
    for i in range(60):  # a large group of near copies of one text, some close to each other only
        words = prose(0, 80).split()
        for _ in range(rng.randint(0, 3)):
            words[rng.randrange(80)] = f"edit{rng.randrange(10**6)}"
        rows.append((100 + i, " ".join(words)))
    rows += [(200 + i, prose(3, 80)) for i in range(5)]
    passage = prose(900, 40)
    rows += [(300 + i, passage + " " + prose(901 + i, 30)) for i in range(60)]  # a common passage alone is no near copy
    rows += [(400, "again and again " * 200), (401, "again and again " * 190), (402, "one two"), (403, "One, two!"), (404, "one three")]
    return rows


@pytest.mark.parametrize("block", [7, 1024])
def test_classes_match_brute_force(spark, monkeypatch, block):
    monkeypatch.setattr(N, "BLOCK", block)
    rows = planted()
    rng = random.Random(1)
    rng.shuffle(rows)
    want = brute_classes(rows)
    first = {}
    for (d, _), c in zip(rows, want):
        first[c] = min(first.get(c, d), d)
    docs = frame(spark, [(d, t, "en", "s") for d, t in rows])
    got = {r["doc_id"]: (r["class_id"], r["class_size"]) for r in N.near_duplicate_classes(docs).collect()}
    sizes = Counter(want)
    assert got == {d: (first[c], sizes[c]) for (d, _), c in zip(rows, want)}
    kept = N.keep_one_per_class(docs)
    assert kept.columns == docs.columns
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(first.values())


def test_odd_rows(spark):
    docs = frame(spark, odd_rows())
    got = rows_of(N.near_duplicate_classes(docs).select("doc_id", "class_id", "class_size"))
    assert len(got) == len(odd_rows())
    assert got.count((1, 1, 2)) == 2 and got.count((1, 1, 1)) == 1 and (None, None, 1) in got and (2, 2, 1) in got
    kept = N.keep_one_per_class(docs)
    assert kept.count() == len(odd_rows()) - 1 and kept.columns == docs.columns
    assert N.near_duplicate_classes(docs.limit(0)).count() == 0
    assert N.keep_one_per_class(docs.limit(0)).count() == 0


def test_signatures_estimate_weighted_jaccard():
    rng = np.random.default_rng(0)
    shared = rng.integers(0, 1 << 60, 300).astype(np.uint64)
    agree = want = 0.0
    for trial in range(12):
        keys = np.sort(shared + np.uint64(trial))
        a, b = rng.integers(1, 9, 300), rng.integers(1, 9, 300)
        row = np.repeat([0, 1], 300)
        signature = N.bag_minhash(row, np.concatenate([keys, keys]), np.concatenate([a, b]), 2)
        agree += float((signature[0] == signature[1]).mean())
        want += np.minimum(a, b).sum() / np.maximum(a, b).sum()
    assert abs(agree - want) / 12 < 0.05


def test_components_of_a_chain(spark):
    pairs = [(bytes([i]), bytes([i + 1])) for i in range(30)] + [(b"x", b"y")]
    got = {bytes(r[0]): bytes(r[1]) for r in N.components(spark.createDataFrame(pairs, "a binary, b binary")).collect()}
    assert len(got) == 33 and {got[bytes([i])] for i in range(31)} == {b"\0"} and got[b"y"] == b"x"
