import hashlib
import random
import re

from llm_cases import frame, odd_rows, prose
from sentiflow.llm import pii as P

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(digits):
    return sum(sum(divmod(int(d) * (1 + i % 2), 10)) for i, d in enumerate(reversed(digits))) % 10 == 0


def brute(text):
    """The patterns as they are stated, leftmost and non-overlapping."""
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(text)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(text) if all(len(p.lstrip("0")) < 4 and int(p[-5:]) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        digits = re.sub("[^0-9]", "", m[0])
        if 14 <= len(digits) <= 19 and luhn(digits):
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(text) if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return sorted(out)


TEXTS = [
    "mail a.b@c.de, x@y and p@q.r@s.t. or @a.b a@b.c-d.e.f", "é漢 joe@x.example.com 🙂 152.143.123.131 999.1.1.1 1.2.3.4.5.6.7.8 0001.2.3.4",
    "card 4111 1111 1111 1111 or 4111-1111-1111-1112, 4785380592391139", "call +49 (30) 123-4567 890 or +1 2, ++1234567890123, +1.(2)3456789 0-1x",
    "1.2.3.4@x.y 1..2.3.4 5", "+" * 50 + "1" * 12, "4111111111111111 4111111111111111", "a@b.c" * 30, "@" * 40 + "a@b@c.d", "1" * 5000 + ".1.1.1",
]


def test_base_spans_match_the_patterns():
    rng = random.Random(6)
    texts = TEXTS + ["".join(rng.choice("ab1234567890.@+- ()9") for _ in range(rng.randint(0, 200))) for _ in range(3000)]
    for t in texts:
        assert P.base_spans(t) == brute(t), t


def test_query_rows(spark):
    rows = [(100 + i, t, "en", "s") for i, t in enumerate(TEXTS)] + odd_rows()
    got = P.digest(P.find_personal_data(frame(spark, rows))).collect()
    assert len(got) == len(rows)
    want = []
    for d, t, _, _ in rows:
        spans = brute(t or "")
        names = ",".join(f"{('email', 'ip', 'card', 'phone')[k]}:{a}:{b}" for a, k, b in spans)
        want.append((str(d), *(sum(k == x for _, k, _ in spans) for x in range(4)), hashlib.sha256(names.encode()).hexdigest()))
    assert sorted((str(r["doc_id"]), r["n_email"], r["n_ip"], r["n_card"], r["n_phone"], r["base_sha256"]) for r in got) == sorted(want)
    assert P.digest(P.find_personal_data(frame(spark, []))).count() == 0


def disclosing():
    rows = [(i, prose(i, 30), "en", "s") for i in range(30)]
    rows += [(100 + i, f"{prose(50 + i, 9)} Zorblax Quill writes to z.q@x.example.com from {prose(60 + i, 9)}", "en", "s") for i in range(3)]
    rows += [(110, "the zorblax is away " + prose(80, 12), "en", "s"), (111, prose(81, 5) + " writes letters", "en", "s")]
    return rows


def test_terms_that_reveal_an_entity(spark):
    """With PMI / IC by hand: "quill" occurs with the entity only, "zorblax" once without it."""
    rows = disclosing()
    docs = frame(spark, rows)
    texts = {d: t for d, t, _, _ in rows}
    found = {r["doc_id"]: [texts[r["doc_id"]][s["start"] : s["end"]] for s in r["terms"] or ()] for r in P.find_personal_data(docs, generalise=0.8).collect()}
    assert found[100][:2] == ["Zorblax", "Quill"] and found[110] == ["zorblax"] and found[0] == []
    strict = {r["doc_id"]: [texts[r["doc_id"]][s["start"] : s["end"]] for s in r["terms"] or ()] for r in P.find_personal_data(docs).collect()}
    assert "Quill" in strict[101] and "Zorblax" not in strict[101] and not strict[110] and not strict[111]


def test_terms_count_anywhere_in_the_document(spark):
    """Far from the entity, behind long words, and behind the pieces of another entity's spelling."""
    far = "Zorblax " + prose(90, 40, sizes=(20, 30))
    rows = [(i, prose(i, 30), "en", "s") for i in range(30)]
    rows += [(100 + i, f"{far} {prose(70 + i, 9)} q@x.example.com", "en", "s") for i in range(2)]
    rows += [(200 + i, f"Quill {prose(75 + i, 5)} a.long.first.name@mail{i}.example.com +49 30 1234567{i // 2}", "en", "s") for i in range(2)]
    docs = frame(spark, rows)
    texts = {d: t for d, t, _, _ in rows}
    found = {r["doc_id"]: {texts[r["doc_id"]][s["start"] : s["end"]] for s in r["terms"] or ()} for r in P.find_personal_data(docs).collect()}
    assert all("Zorblax" in found[d] for d in (100, 101)) and all(found[d] == {"Quill"} for d in (200, 201))
    assert not any(found[i] for i in range(30))


def test_sanitise_replaces_and_keeps_the_rest(spark):
    rows = disclosing() + [(200, "a@b.cd and 1.2.3.4", "en", "s")]
    docs = frame(spark, rows)
    out = P.sanitise(docs, chars_col="n_chars", generalise=0.8)
    assert out.columns == docs.columns and out.dtypes == docs.dtypes
    got = {r["doc_id"]: r for r in out.collect()}
    assert got[200]["text"] == "[EMAIL] and [IP]" and got[200]["n_chars"] == len("[EMAIL] and [IP]")
    assert "[EMAIL]" in got[100]["text"] and "Quill" not in got[100]["text"] and "[TERM]" in got[100]["text"]
    assert got[110]["text"].startswith("the [TERM] is away")
    assert all(got[d]["text"] == t and got[d]["n_chars"] == len(t) for d, t, _, _ in rows[:30])
    odd = frame(spark, odd_rows())
    assert sorted(map(str, P.sanitise(odd).collect())) == sorted(map(str, odd.collect()))
    assert P.sanitise(odd.limit(0)).count() == 0


def test_redacted_overlaps():
    assert P.redacted("0123456789", [(2, 5, "A"), (4, 7, "B"), (8, 9, "C")]) == "01A7C9"
