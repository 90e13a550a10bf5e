import zlib
from collections import Counter

import numpy as np
import pytest

from llm_cases import frame, odd_rows, prose
from sentiflow.llm import hmm as H


def tokens(text):
    lowered = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    for c in "\t\n\x0b\x0c\r":
        lowered = lowered.replace(c, " ")
    return [w for w in lowered.split(" ") if w]


def base_scores(rows):
    """(held out, tokens, known, training tokens, base score) of each (id, text) by straight counting."""
    held = [d is not None and zlib.crc32(str(d).encode()) % 7 == 2 for d, _ in rows]
    seqs = [[*tokens(t), None] for _, t in rows]
    counts = Counter(w for s, h in zip(seqs, held) if not h for w in s)
    n, v = sum(counts.values()), len(counts)
    return [
        (h, len(s), sum(counts[w] > 0 for w in s), n, float(sum(np.log10((counts[w] + 1) / (n + v + 1)) for w in s))) for s, h in zip(seqs, held)
    ]


def corpus():
    rows = [(i, prose(i % 13, 40, "abcdef") + f" Common{i % 3}", "xx", "s") for i in range(60)]
    return rows + [(100 + i, prose(i % 11, 50, "stuvwx") + "\tcommon0", "yy", "s") for i in range(60)]


def test_base_matches_and_states_help(spark):
    rows = corpus() + odd_rows()
    got = H.score_texts(frame(spark, rows)).collect()
    want = base_scores([r[:2] for r in rows])
    assert len(got) == len(rows)
    key = lambda r: (str(r[0]), *r[1:5], round(r[5], 6))
    assert sorted(map(key, got)) == sorted((str(d), *w[:4], round(w[4], 6)) for (d, *_), w in zip(rows, want))
    held = [r for r in got if r["held_out"] and (r["doc_id"] or 0) not in (1, 2, 3, 4, 5, 6, 7, 8)]
    assert len(held) > 5 and sum(r["score"] for r in held) > sum(r["base_score"] for r in held)
    assert all(r["score"] < 0 for r in got)


def brute_gain(model, classes):
    """Log of the sum over all state paths, by plain dynamic programming without scaling."""
    alpha = model.start * model.ratio[classes[0]]
    for c in classes[1:]:
        alpha = (alpha @ model.move) * model.ratio[c]
    return float(np.log(alpha.sum()))


def some_model(rng):
    base = np.zeros(H.CLASSES)
    base[: 40] = rng.random(40)
    base /= base.sum()
    emitted = np.zeros((H.CLASSES, H.STATES))
    emitted[1:40] = rng.random((39, H.STATES))
    return H.Model.from_counts(rng.random(H.STATES), rng.random((H.STATES, H.STATES)), emitted, base), base


def test_forward_and_expectations_match_brute_force():
    rng = np.random.default_rng(3)
    model, _ = some_model(rng)
    texts = [rng.integers(0, 40, n).astype(np.uint16) for n in (1, 2, 7, 7, 30, 3)]
    got = H.Batch(texts).forward(model)
    assert got == pytest.approx([brute_gain(model, t) for t in texts])
    start, move, emitted, gain = H.Batch(texts).expect(model)
    assert gain == pytest.approx(float(got.sum()), rel=1e-4)
    want_move, want_emit, want_start = np.zeros_like(move), np.zeros_like(emitted), np.zeros_like(start)
    for t in texts:
        n = len(t)
        f, b = np.zeros((n, H.STATES)), np.ones((n, H.STATES))
        f[0] = model.start * model.ratio[t[0]]
        for i in range(1, n):
            f[i] = (f[i - 1] @ model.move) * model.ratio[t[i]]
        for i in range(n - 2, -1, -1):
            b[i] = model.move @ (model.ratio[t[i + 1]] * b[i + 1])
        post = f * b / f[-1].sum()
        want_start += post[0]
        np.add.at(want_emit, t, post)
        for i in range(n - 1):
            want_move += f[i][:, None] * model.move * (model.ratio[t[i + 1]] * b[i + 1])[None] / f[-1].sum()
    assert start == pytest.approx(want_start, rel=1e-3)
    assert move == pytest.approx(want_move, rel=1e-3, abs=1e-4)
    assert emitted == pytest.approx(want_emit, rel=1e-3, abs=1e-4)


def test_states_are_distributions_over_the_same_symbols():
    model, base = some_model(np.random.default_rng(5))
    assert (model.ratio * base[:, None]).sum(axis=0) == pytest.approx(np.ones(H.STATES))
    assert model.ratio[H.UNSEEN] == pytest.approx(np.ones(H.STATES))
    assert model.move.sum(axis=1) == pytest.approx(np.ones(H.STATES))


def test_passes_raise_the_likelihood(spark):
    docs = frame(spark, corpus())
    few, more = (sum(r["score"] for r in H.score_texts(docs, passes=p).collect() if not r["held_out"]) for p in (1, 4))
    assert more > few


def test_without_training_texts(spark):
    held = next(i for i in range(100) if zlib.crc32(str(i).encode()) % 7 == 2)
    (r,) = H.score_texts(frame(spark, [(held, "a b", "en", "s")])).collect()
    assert (r["n_tokens"], r["n_known"], r["train_tokens"], r["base_score"], r["score"]) == (3, 0, 0, 0.0, 0.0)
    assert H.score_texts(frame(spark, [])).count() == 0
