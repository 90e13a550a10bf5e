import random
import re
from collections import Counter, defaultdict

import numpy as np

from llm_cases import frame, odd_rows, prose, rows_of
from sentiflow.llm import divergence as D

UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def brute(rows, least=30, top=50):
    docs = [(la or "", s or "", re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", (t or "").translate(UPPER))) for _, t, la, s in rows]
    in_docs, count = defaultdict(Counter), defaultdict(Counter)
    for lang, source, words in docs:
        in_docs[lang].update(set(words))
        count[lang, source].update(words)
    out = []
    for lang in {d[0] for d in docs}:
        kept = [t for t, n in in_docs[lang].items() if n >= least]
        sources = {s for la, s in count if la == lang}

        def shares(counts):
            total = sum(counts[t] for t in kept)
            return {t: 1 + 1_000_000_000 * (counts[t] + 5) // (total + 5 * len(kept)) for t in kept}

        p = {s: shares(count[lang, s]) for s in sources}
        q = shares(sum((count[lang, s] for s in sources), Counter()))
        for s in sources:
            pairs = [(-sum(abs(p[s][t] - p[o][t]) for t in kept), o) for o in sources - {s}]
            terms = [(q[t] - p[s][t], t) for t in kept if count[lang, s][t] and p[s][t] > q[t]]
            for part, found, most in (("pair", pairs, None), ("term", terms, top)):
                ranked = sorted(found, key=lambda f: (f[0], f[1].encode()))[:most]
                out += [(lang, s, part, item, -value, i) for i, (value, item) in enumerate(ranked, 1)]
    return sorted(out, key=str)


def corpus(seed=1, sources=9):
    rng = random.Random(seed)
    words = {la: [prose(seed + i, 1, la * 2 + "éß漢zabcd", (1, 6)) for i in range(120)] for la in ("xy", "uv", "w")}
    rows = []
    for i in range(260):
        lang = rng.choice(["xy", "uv", "w"])
        source = f"s{rng.choice([0] * 5 + list(range(sources)))}" if lang != "w" else "only"
        picked = rng.choices(words[lang][: 40 + 7 * int(source[1:]) if lang != "w" else 60], k=rng.randint(0, 90))
        rows.append((i, " ".join(w.upper() if rng.random() < 0.1 else w for w in picked), lang, source))
    return rows + odd_rows()


def test_ordinals_are_ranks():
    rng = random.Random(3)
    terms = sorted({bytes(rng.choice(b"ab\xc3\xa9\xff") for _ in range(rng.randint(1, 7))) for _ in range(3000)} | {b"a", b"a" * 300})
    machine = D.Transducer.unpacked(D.Transducer.build(terms).packed())
    asked = terms + [t + b"a" for t in terms] + [t[:-1] for t in terms] + [b"zz", b"a" * 299, b"a" * 5000]
    size = np.array([len(a) for a in asked])
    data = np.frombuffer(b"".join(asked), np.uint8)
    got = machine.ordinals(data, np.cumsum(size) - size, size)
    rank = {t: i for i, t in enumerate(terms)}
    assert got.tolist() == [rank.get(a, -1) for a in asked]


def test_transducer_is_minimal():
    rng = random.Random(4)
    terms = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 5))).encode() for _ in range(150)})
    behind = defaultdict(set)
    for t in terms:
        for i in range(len(t) + 1):
            behind[t[:i]].add(t[i:])
    assert len(D.Transducer.build(terms).final) == len({frozenset(b) for b in behind.values()})


def test_against_brute_force(spark):
    rows = corpus()
    assert rows_of(D.audit(frame(spark, rows))) == brute(rows)
    assert rows_of(D.audit(frame(spark, rows).repartition(5), least=3, top=4)) == brute(rows, 3, 4)


def test_many_pieces_passes_and_cells(spark, monkeypatch):
    monkeypatch.setattr(D, "CELL_TERMS", 7)
    monkeypatch.setattr(D, "CELL_SOURCES", 2)
    monkeypatch.setattr(D, "HELD", 50)
    rows = corpus(2)
    assert rows_of(D.audit(frame(spark, rows), piece=29, pass_bytes=6000)) == brute(rows)


def test_no_terms_one_source_and_empty(spark):
    rows = [(1, None, None, "a"), (2, "", None, None), (3, "one two", "", "b"), (4, "x", "la", "s")]
    assert rows_of(D.audit(frame(spark, rows))) == brute(rows)
    assert {r[4] for r in brute(rows)} == {0} and len(brute(rows)) == 6
    assert rows_of(D.audit(frame(spark, []))) == []


def test_repeated_rows_count_and_ties_go_by_bytes(spark):
    rows = [(1, "B aa z é Z", "la", s) for s in ("s", "t", "é", "z") for _ in range(10)] + [(2, "aa aa", "la", "s")]
    got = rows_of(D.audit(frame(spark, rows)))
    assert got == brute(rows)
    assert [r[3] for r in sorted(got, key=lambda r: r[5]) if r[1] == "t" and r[2] == "pair"] == ["s", "z", "é"]
