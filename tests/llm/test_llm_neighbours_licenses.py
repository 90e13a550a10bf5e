import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from llm_cases import frame, odd_rows, prose
from sentiflow.llm import licenses as C
from sentiflow.llm import neighbours as N

VECTORS = "vec_id long, embedding array<float>, part int, score string"


def vectors(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [None if x is None else float(x) for x in v], 1, "s") for i, v in rows], VECTORS)


def exact(rows, query, k=10):
    q = np.float32(dict(rows)[query]).astype(float)
    d = [(float(np.sqrt(((np.float32(v).astype(float) - q) ** 2).sum())), i) for i, v in rows if i != query]
    return [(i, s) for s, i in sorted(d)[:k]]


def found(df):
    out = {}
    for r in df.collect():
        out.setdefault(r["query_id"], []).append((r["rank"], r["vec_id"], r["score"]))
    assert all([r for r, _, _ in sorted(v)] == list(range(1, len(v) + 1)) for v in out.values())
    return {q: [(i, s) for _, i, s in sorted(v)] for q, v in out.items()}


def test_recall_and_exact_scores(spark):
    rng = np.random.default_rng(1)
    centres = rng.normal(size=(12, 16)) * 4
    points = centres[rng.integers(0, 12, 1500)] + rng.normal(size=(1500, 16))
    points[700:900] = points[700]  # a hot vector
    rows = list(enumerate(points.tolist()))
    df = vectors(spark, rows)
    got = found(N.search(df, df.where(F.col("vec_id") % 100 == 0)))
    hit = total = 0
    for q in range(0, 1500, 100):
        want = exact(rows, q)
        assert len(got[q]) == 10
        hit += len({round(s, 9) for _, s in want} & {round(s, 9) for _, s in got[q]}) if q != 700 else len(set(want) & set(got[q]))
        total += len({round(s, 9) for _, s in want}) if q != 700 else 10
        for i, s in got[q]:
            assert s == pytest.approx(float(np.sqrt(((np.float32(points[i]).astype(float) - np.float32(points[q]).astype(float)) ** 2).sum())), abs=1e-12)
    assert hit >= 0.9 * total
    assert [i for i, _ in got[700]] == list(range(701, 711))  # equal distances: smaller ids first


def test_odd_vectors(spark):
    good = [(100 * i, [1.0 + i, 2.0, 0.5 * i]) for i in range(4)]
    bad = [(1, None), (2, []), (3, [0, 0, 0]), (4, [1, None, 2]), (5, [float("nan"), 1, 1]), (6, [float("inf"), 1, 1]), (7, [1.0, 2.0]), (None, [1, 2, 3]), (400, None)]
    df = vectors(spark, good + bad)
    got = found(N.search(df, df.where(F.col("vec_id") % 100 == 0)))
    assert got == {q: [(i, pytest.approx(s)) for i, s in exact(good, q)] for q in (0, 100, 200, 300)}
    assert N.search(df.limit(0), df.limit(0)).count() == 0
    twice = vectors(spark, good + good)
    assert all(len(v) == 7 for v in found(N.search(twice, vectors(spark, good[:1]))).values())


def test_repeated_ids_are_ranked_row_by_row(spark):
    """Rows that share an id, equal or not, as queries and as candidates: as by brute force over rows."""
    rng = random.Random(5)
    rows = [(i, [float(np.float32(rng.gauss(0, 1))) for _ in range(4)]) for i in range(300)]
    rows += [(100, rows[7][1]), (100, rows[100][1]), (200, rows[200][1])]
    queries = [r for r in rows if r[0] % 100 == 0]
    want = []
    for at, (query, vector) in enumerate(rows):
        if query % 100 == 0:
            others = rows[:at] + rows[at + 1 :]
            far = sorted((float(np.sqrt(((np.array(v) - np.array(vector)) ** 2).sum())), i) for i, v in others)[:10]
            want += [(query, rank, i, round(s, 9)) for rank, (s, i) in enumerate(far, 1)]
    got = N.search(vectors(spark, rows), vectors(spark, queries), recall=1.0).collect()
    assert sorted((r["query_id"], r["rank"], r["vec_id"], round(r["score"], 9)) for r in got) == sorted(want)


def test_queries_are_held_to_the_length_of_the_table(spark):
    table = vectors(spark, [(i, [float(i + 1)] * 8) for i in range(20)])
    queries = vectors(spark, [(100, [1.0] * 4), (200, [2.0] * 4), (300, [3.5] * 8)])
    assert {r["query_id"] for r in N.search(table, queries).collect()} == {300}


def test_parts_are_balanced_and_cut_few_edges():
    rng = np.random.default_rng(2)
    x = rng.normal(size=(640, 8)) + rng.normal(size=(8, 8))[rng.integers(0, 8, 640)] * 5
    graph = N.neighbour_graph(x, 10)
    label = N.balanced_parts(x, graph, 8)
    assert np.bincount(label).tolist() == [80] * 8
    start = N.median_parts(x, 8)
    assert (label[graph] != label[:, None]).mean() <= (start[graph] != start[:, None]).mean()


NOTICE = C.TEMPLATES["GPL-notice"]


def brute_align(template, words, start):
    """Most template words matched in order within the band, by plain recursion over (template, document)."""
    best = {}
    for j in range(len(template) - 1, -2, -1):
        for i in range(start - C.BAND - 1, start + len(template) + C.BAND + 1):
            options = [best.get((j + 1, i), 0)] if j + 1 < len(template) else [0]
            best[j, i] = max(options)
    n, m = len(template), len(words)
    grid = {}
    for j in range(n + 1):
        for i in range(start + j - C.BAND, start + j + C.BAND + 1):
            options = [0]
            if j:
                options.append(grid.get((j - 1, i), 0))
                if 0 <= i - 1 < m and words[i - 1] == template[j - 1]:
                    options.append(grid.get((j - 1, i - 1), 0) + 1)
            options.append(grid.get((j, i - 1), 0))
            grid[j, i] = max(options)
    return max(grid.values())


def test_licenses_found_with_spans(spark):
    edited = NOTICE.replace("redistribute it", "share it widely")
    half = " ".join(NOTICE.split()[:10])
    rows = [
        (20, prose(1) + "\n" + NOTICE + "\n" + prose(2), "en", "s"), (21, edited.upper(), "en", "s"), (22, half + prose(3), "en", "s"),
        (23, "é 🙂 Released under the MIT License. Released under the MIT License.", "en", "s"), (24, "mit lizenz", "de", "s"),
        (25, "Licensed under CC BY-NC 4.0", "en", "s"), (26, C.TEMPLATES["Apache-2.0-notice"], "en", "s"),
    ]
    rows += odd_rows()
    got = C.scan_licenses(frame(spark, rows)).collect()
    texts = {d: t for d, t, _, _ in rows}
    by = {}
    for r in got:
        by.setdefault(r["doc_id"], []).append((r["license"], texts[r["doc_id"]][r["start"] : r["end"]], r["coverage"]))
    assert by.pop(20) == [("GPL-notice", NOTICE, 1.0)]
    ((name, span, coverage),) = by.pop(21)
    assert name == "GPL-notice" and span == edited.upper() and 0.8 <= coverage < 1
    assert [(a, b) for a, b, _ in sorted(by.pop(23))] == [("MIT", "Released under the MIT License")] * 2
    assert by.pop(25) == [("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0", 1.0)]
    assert {a for a, _, _ in by.pop(26)} == {"Apache-2.0", "Apache-2.0-notice"}
    assert not by
    assert C.scan_licenses(frame(spark, [])).count() == 0
    assert C.scan_licenses(frame(spark, rows), {}).count() == 0


def test_alignment_matches_brute_force():
    rng = random.Random(4)
    for _ in range(200):
        template = [rng.randint(1, 6) for _ in range(rng.randint(3, 14))]
        words = [rng.randint(0, 6) for _ in range(rng.randint(0, 5))] + [w for w in template if rng.random() < 0.85] + [rng.randint(0, 6) for _ in range(5)]
        start = rng.randint(0, 6)
        got = C.align(np.array(template), np.array(words), start)
        assert (got[2] if got else 0) <= brute_align(template, words, start)
    whole = C.align(np.array([1, 2, 3, 4]), np.array([9, 1, 2, 7, 3, 4]), 1)
    assert whole == (1, 5, 4)


def test_any_long_shared_stretch_is_a_candidate():
    index = C.TemplateIndex({"t": " ".join(f"w{i}" for i in range(30))})
    for size in range(C.GRAM + C.WINNOW - 1, 12):
        for start in range(30 - size):
            ids = np.array([0, 0, *range(start + 1, start + size + 1), 0])
            assert index.find(ids, 0.0), (size, start)
