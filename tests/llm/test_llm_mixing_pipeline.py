import math
import os
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
import corpus_pipeline
from conftest import SF_SMALL
from llm_cases import frame, odd_rows, prose
from sentiflow.llm import mixing as M

SIZES = {"a": 40, "b": 12, "c": 3}


def corpus():
    rows = []
    for s, n in SIZES.items():
        rows += [(len(rows) + i, prose(len(rows) + i, 20 + i % 7), "en", s) for i in range(n)]
    return rows


def words(text):
    return len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))


def tempered(tokens, exponent):
    raised = {s: t**exponent for s, t in tokens.items()}
    return {s: r / sum(raised.values()) for s, r in raised.items()}


def entropy(weights):
    return -sum(w * math.log(w) for w in weights.values())


def drawn(df):
    return df.collect()


@pytest.mark.parametrize("target,repeats,budget", [(0.9, 100.0, None), (0.99, 1.5, None), (0.5, 4.0, 300), (0.9, 2.0, 5000)])
def test_mix_meets_target_and_budget(spark, target, repeats, budget):
    rows = corpus()
    got = drawn(M.mix(frame(spark, rows), budget, target, repeats))
    tokens = defaultdict(int)
    for _, t, _, s in rows:
        tokens[s] += words(t)
    spend = budget or sum(tokens.values())
    weights = {r["source"]: r["weight"] for r in got}
    assert sum(weights.values()) == pytest.approx(1)
    # brute force over a fine grid of exponents
    goal, limit = target * math.log(3), repeats
    ok = [e / 4000 for e in range(4001) if entropy(tempered(tokens, e / 4000)) >= goal]
    exponent = max(ok)
    rare = lambda e: max(w * spend / tokens[s] for s, w in tempered(tokens, e).items()) <= limit
    if not rare(exponent):
        exponent = min([e / 4000 for e in range(4001) if e / 4000 >= exponent and rare(e / 4000)], default=1.0)
    for s, w in tempered(tokens, exponent).items():
        assert weights[s] == pytest.approx(w, abs=2e-3)
    size = {d: words(t) for d, t, _, _ in rows}
    used, times = defaultdict(int), defaultdict(Counter)
    for r in got:
        assert r["n_tokens"] == size[r["doc_id"]] and 0 <= r["block"] < M.BLOCKS
        used[r["source"]] += r["n_tokens"]
        times[r["source"]][r["doc_id"]] += 1
    for s, w in weights.items():
        share = w * spend
        assert share <= used[s] < share + 40 or used[s] == pytest.approx(share, abs=40)
        assert max(times[s].values()) - min([*times[s].values()] + [0] * (SIZES[s] - len(times[s]))) <= 1  # whole epochs, then a part


def test_mix_is_repeatable_and_blocks_are_alike(spark):
    rows = [(i, prose(i, 30), "en", "ab"[i % 2]) for i in range(400)]
    docs = frame(spark, rows)
    one = drawn(M.mix(docs, blocks=4))
    again = drawn(M.mix(docs.repartition(5), blocks=4))
    assert sorted(map(str, one)) == sorted(map(str, again))
    share = Counter((r["block"], r["source"]) for r in one)
    assert all(45 <= share[b, s] <= 55 for b in range(4) for s in "ab")


def test_mix_odd_rows(spark):
    got = drawn(M.mix(frame(spark, odd_rows())))
    assert {r["doc_id"] for r in got} <= {None, 1, 5, 6, 7, 8} and {r["source"] for r in got} == {None, "a", "b", "c"}
    assert M.mix(frame(spark, [])).count() == 0
    assert M.mix(frame(spark, [(1, "", "en", "s"), (2, None, "en", "s")])).count() == 0


def test_slots_give_the_same_running_sums(spark, monkeypatch):
    rows = corpus()
    whole = drawn(M.mix(frame(spark, rows)))
    monkeypatch.setattr(M, "SLOT_ROWS", 3)
    slots = drawn(M.mix(frame(spark, rows)))
    for s in SIZES:  # another order within a source, the same tokens up to one document
        a, b = (sum(r["n_tokens"] for r in x if r["source"] == s) for x in (whole, slots))
        assert abs(a - b) < 40


def test_stages_work_on_what_the_last_kept(spark, tmp_path):
    """Every stage on a small corpus with planted cases, and run() over the written tables."""
    a, b = prose(1, 80, "abcdef"), prose(2, 80, "abcdef")
    passage = prose(9, 40, "abcdef")
    rows = [(i, prose(100 + i, 60, "abcdef"), "xx", f"s{i % 2}") for i in range(30)]
    rows += [(40, a, "xx", "s0"), (41, a, "xx", "s1"), (42, a.replace(a.split()[40], "edited"), "xx", "s0")]
    rows += [(50, b + " " + passage, "xx", "s0"), (51, "write to a.b@c.example.com " + prose(77, 30, "abcdef"), "xx", "s1")]
    rows += [(60, None, "xx", "s0"), (61, "?!", "xx", "s0")]
    docs = frame(spark, rows)
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, passage)], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    kept = {}
    for name, stage in corpus_pipeline.STAGES:
        out = stage(spark, docs, str(tmp_path))
        if name != "mixing":
            assert out.columns == docs.columns and out.dtypes == docs.dtypes
        kept[name] = {r["doc_id"]: r for r in out.collect()}
        docs = out
    everything = {d for d, *_ in rows}
    assert set(kept["language_id"]) == everything - {60, 61}
    assert set(kept["near_dedup"]) == everything - {60, 61, 41, 42}
    assert set(kept["decontamination"]) == everything - {60, 61, 41, 42, 50}
    clean = kept["personal_data"]
    assert clean[51]["text"].startswith("write to [EMAIL] ") and clean[51]["n_chars"] == len(clean[51]["text"])
    assert all(clean[i]["text"] == t for i, t, _, _ in rows[:30])
    assert set(kept["mixing"]) <= set(clean)
    got = corpus_pipeline.run(spark, str(tmp_path))
    assert sorted(map(str, got.collect())) == sorted(map(str, docs.collect()))


def test_registered_names():
    names = E.queries()
    assert "pipeline" in names and [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10
    assert [name for name, _ in corpus_pipeline.STAGES] == ["language_id", "near_dedup", "decontamination", "personal_data", "mixing"]
    assert os.path.isdir(SF_SMALL)
