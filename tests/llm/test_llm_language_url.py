import math
import zlib
from collections import Counter

import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from llm_cases import frame, odd_rows, prose
from sentiflow.llm import language_id as L
from sentiflow.llm import url_filter as U


def corpus():
    rows = [(i, prose(i, 30, "abcdef"), "xx", "s") for i in range(40)]
    rows += [(100 + i, prose(i, 30, "stuvwx"), "yy", "s") for i in range(40)]
    return rows


def brute_bits(train, text):
    """Code length of a text under counts of (context, byte) by order, with escapes; straight dictionaries."""
    counts = [Counter() for _ in range(4)]
    for t in train:
        data = b"\0\0\0" + L.folded(t)
        for i in range(3, len(data)):
            for k in range(4):
                counts[k][data[i - k : i + 1]] += 1
    total, kinds = Counter(), Counter()
    for k in range(4):
        for gram, n in counts[k].items():
            total[k, gram[:-1]] += n
            kinds[k, gram[:-1]] += 1
    bits, data = 0.0, b"\0\0\0" + L.folded(text)
    for i in range(3, len(data)):
        for k in range(3, -1, -1):
            gram, context = data[i - k : i + 1], (k, data[i - k : i])
            if counts[k][gram]:
                bits -= math.log2(counts[k][gram] / (total[context] + kinds[context]))
                break
            if total[context]:
                bits -= math.log2(kinds[context] / (total[context] + kinds[context]))
        else:
            bits += 8
    return bits


def test_code_lengths_match_brute_force(spark):
    rows = corpus()
    model = L.fit_language_model(frame(spark, rows))
    for text in (rows[0][1], "abc stu zzz", "é q", "a"):
        got = model.text_bits([L.folded(text)])[0]
        want = [brute_bits([t for _, t, la, _ in rows if la == lang], text) for lang in ("xx", "yy")]
        assert got == pytest.approx(want)


def test_held_out_texts_are_recognised(spark):
    docs = frame(spark, corpus())
    model = L.fit_language_model(docs.where(~L.held_out(F.col("doc_id"), 4)))
    got = L.identify_languages(docs, model).where("held_out").join(docs.select("doc_id", "lang"), "doc_id").collect()
    assert len(got) > 5 and all(r["lang"] == r["lang_pred"] and r["score"] > 0.9 for r in got)


def test_language_odd_rows(spark):
    docs = frame(spark, odd_rows())
    model = L.fit_language_model(docs)
    got = L.identify_languages(docs, model).collect()
    assert len(got) == len(odd_rows())
    assert {r["lang_pred"] for r in got if r["doc_id"] in (2, 3, 4, 6)} == {"und"}
    assert all(0 <= r["score"] <= 1 and r["held_out"] is not None for r in got)
    kept = L.keep_identified(docs, model)
    assert kept.columns == docs.columns and kept.count() == 7
    empty = docs.limit(0)
    assert L.fit_language_model(empty) is None
    assert {r["lang_pred"] for r in L.identify_languages(docs, None).collect()} == {"und"}
    assert L.identify_languages(empty, model).count() == 0


def test_model_bound_prunes_rare_grams(spark):
    docs = frame(spark, corpus())
    small = L.fit_language_model(docs, max_grams=300)
    whole = L.fit_language_model(docs)
    assert len(small.keys[3]) <= 301 < len(whole.keys[3])
    assert small.text_bits([L.folded(corpus()[0][1])]).argmin() == 0


def test_small_language_keeps_its_grams_beside_a_large_one(spark):
    """More grams than a block holds: further blocks, the code lengths and predictions of the whole model."""
    rows = [(i, prose(i, 60, "abcdefgh"), "hot", "s") for i in range(60)] + [(900, "tuv xyz tux vyz", "rare", "s")]
    docs = frame(spark, rows)
    model = L.fit_language_model(docs, max_grams=5000)
    assert 1 < len(model.ranges) < 9 and model.langs == ["hot", "rare"]
    for text in (rows[0][1], "tuv xyz", "xyz abc é"):
        want = [brute_bits([t for _, t, la, _ in rows if la == lang], text) for lang in ("hot", "rare")]
        assert model.text_bits([L.folded(text)])[0] == pytest.approx(want)
    odd = docs.union(frame(spark, [(901, None, "hot", "s"), (None, "tux", "rare", "s"), (900, "?!", "rare", "s")]))
    whole = L.fit_language_model(docs)
    assert len(whole.ranges) == 1
    got, want = (sorted(L.identify_languages(odd, m).collect(), key=str) for m in (model, whole))
    assert [r[:3] for r in got] == [r[:3] for r in want] and sum(r["lang_pred"] == "rare" for r in got) == 2
    for a, b in zip(got, want):
        assert a["score"] == pytest.approx(b["score"]) and a["code_bits"] == (b["code_bits"] and pytest.approx(b["code_bits"]))
    kept = L.keep_identified(odd, model)
    assert kept.columns == odd.columns and kept.count() == 62


def test_stage_keeps_short_texts_that_languages_share(spark):
    """A name that four languages have alike stays; a language of held-out rows only is learned by the stage."""
    out = [d for d in range(100) if zlib.crc32(str(d).encode()) % 4 == 2][:2]
    rows = [(1000 + i, "anna", lang, "s") for i, lang in enumerate(("da", "de", "en", "sv"))] + [(out[0], "quux quux", "zz", "s"), (out[1], "?!", "zz", "s")]
    docs = frame(spark, rows)
    got = corpus_pipeline.language_id(spark, docs, None)
    assert sorted(r["doc_id"] for r in got.collect()) == sorted([1000, 1001, 1002, 1003, out[0]])
    shared = L.identify_languages(docs, L.fit_language_model(docs)).where("doc_id = 1000").first()
    assert shared["lang_pred"] == "da" and shared["score"] < 0.5


def test_stage_drops_what_no_language_explains(spark):
    """Random bytes and an unlearned script go, also where their own rows are labelled; short texts and the learned languages stay."""
    import random

    rng = random.Random(3)
    rows = corpus()
    noise = "".join(chr(rng.randint(0x400, 0x2FFF)) for _ in range(300))
    script = " ".join("".join(chr(rng.randint(0x10D0, 0x10F0)) for _ in range(6)) for _ in range(30))
    odd = [(5000, noise, "en", "s"), (5001, script, "de", "s"), (5002, script, "fr", "s"), (5003, "\u10d0\u10d1", "de", "s"), (5004, "a name", None, "s")]
    kept = {r["doc_id"] for r in corpus_pipeline.language_id(spark, frame(spark, rows + odd), None).collect()}
    assert kept == {r[0] for r in rows} | {5003, 5004}


def brute_rule(rules, host, path):
    fits = [r for r in rules if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fits, key=lambda r: (len(r.host.split(".")), len(r.path), r.verdict), default=None)


URLS = [
    "http://a.net/", "http://a.net", "http://www.example.net/en/x?q#f", "HTTP://WWW.EXAMPLE.NET/EN/", "https://example.net/en", "http://x.example.com/de/1",
    "http://example.org/fr/", "http://org/fr/a//b", "x://net/", "no scheme", "", None, "http://?a", "http://#", "http://a.b.org/fr", "://example.com/de/", "http://fooexample.com/de/",
    "http://.net/", "http://a.net/en/://b.org/fr/", "ftp://user@example.com/de/" + "a" * 10_000,
]


@pytest.mark.parametrize("block", [1, 3, 100_000])
def test_urls_match_brute_force(spark, block):
    more = [U.Rule.parse("block", "example.net/en/deep"), U.Rule.parse("allow", "a.net/e"), U.Rule("block", "a.net", ""), U.Rule.parse("block", "org/fr/")]
    rules = [*U.RULES, *more]
    pages = spark.createDataFrame([(i, u, "h") for i, u in enumerate(URLS + ["http://a.net/en/1", "http://example.net/en/deeper"])], "page_id long, url string, rule string")
    got = U.judge_urls(pages, rules, block_rules=block).collect()
    assert len(got) == len(URLS) + 2
    for r in got:
        want = brute_rule(rules, r["host"], r["path"])
        assert (r["rule"], r["verdict"]) == ((want.text, want.verdict) if want else (None, "allow")), r


def test_url_parts_and_empty_tables(spark):
    pages = spark.createDataFrame(list(enumerate(URLS)), "page_id long, url string")
    got = {r["page_id"]: (r["host"], r["path"]) for r in U.judge_urls(pages).collect()}
    assert got[3] == ("www.example.net", "/EN/") and got[9] == got[10] == got[11] == got[12] == got[13] == ("", "")
    assert got[2] == ("www.example.net", "/en/x") and got[18] == ("a.net", "/en/://b.org/fr/")
    assert U.judge_urls(pages.limit(0)).count() == 0
    assert {r["verdict"] for r in U.judge_urls(pages, []).collect()} == {"allow"}
