"""Rule scorer: properties on literal sentences and a brute-force check on a small fixture."""

import math
import string

from pyspark.sql import functions as F

from conftest import SF_SMALL
from sentiflow.functions.rules import DEFAULT_PARAMS as P
from sentiflow.functions.rules import rule_score
from sentiflow.functions.scoring import corpus_lexicon
from sentiflow.sources.tables import load_table


def round_half_up(x, digits):
    """Like Spark's round: half up on the shortest decimal form."""
    from decimal import ROUND_HALF_UP, Decimal

    return float(Decimal(repr(x)).quantize(Decimal(1).scaleb(-digits), rounding=ROUND_HALF_UP))


LEX = {"good": 1.9, "great": 3.1, "bad": -2.5, "awful": -3.4, "love": 3.2, "hate": -2.7}


def _lex_df(spark, lex):
    return spark.createDataFrame(list(lex.items()), "token string, valence double")


def brute(text, lex, p=P):
    """Straight per-text evaluation of the same rules (test oracle)."""
    def strip(t):
        s = t.strip(string.punctuation)
        return t if len(s) <= 2 else s

    words = [w for w in (strip(t) for t in (text or "").strip().split()) if len(w) > 1]
    lw = [w.lower() for w in words]
    caps = [w.isupper() for w in words]
    mixed = any(caps) and not all(caps)
    boost = {**{w: p.booster_increment for w in p.boosters_up}, **{w: p.booster_decrement for w in p.boosters_down}}

    def negated(w):
        return w in p.negations or "n't" in w

    but = lw.index("but") + 1 if "but" in lw else 0
    total = 0.0
    for i, w in enumerate(lw):
        if w not in lex:
            continue
        if w in boost or (w == "kind" and i + 1 < len(lw) and lw[i + 1] == "of"):
            continue
        v = lex[w]
        sign = (v > 0) - (v < 0)
        if caps[i] and mixed:
            v += sign * p.caps_increment
        for k, d in ((1, 1.0), (2, 0.95), (3, 0.9)):
            if i >= k and lw[i - k] not in lex and lw[i - k] in boost:
                s = boost[lw[i - k]] * sign
                if caps[i - k] and mixed:
                    s += sign * p.caps_increment
                v += s * d
        prev = lambda k: lw[i - k] if i >= k else None
        if prev(1) is not None and prev(1) not in lex and negated(prev(1)):
            v *= p.negation_scalar
        if prev(2) == "never" and prev(1) in ("so", "this"):
            v *= p.never_so_scalar
        elif prev(2) is not None and prev(2) not in lex and negated(prev(2)):
            v *= p.negation_scalar
        if prev(3) == "never" and (prev(2) in ("so", "this") or prev(1) in ("so", "this")):
            v *= p.never_so_scalar
        elif prev(3) is not None and prev(3) not in lex and negated(prev(3)):
            v *= p.negation_scalar
        if prev(1) == "least" and prev(1) not in lex and prev(2) not in ("at", "very"):
            v *= p.negation_scalar
        if but:
            v = v * p.but_before if i + 1 < but else (v * p.but_after if i + 1 > but else v)
        total += v
    t = text or ""
    ep = min(t.count("!"), p.exclamation_max) * p.exclamation_step
    q = t.count("?")
    ep += p.question_max_value if q > 3 else (q * p.question_step if q > 1 else 0.0)
    if total > 0:
        total += ep
    elif total < 0:
        total -= ep
    return max(-1.0, min(1.0, round_half_up(total / math.sqrt(total * total + p.alpha), 4)))


SENTENCES = [
    "The food is good",
    "The food is not good",
    "The food is very good",
    "The food is VERY good",
    "The food is GOOD",
    "The food is good!!!",
    "The food is good, but the service is awful",
    "I never so love this",
    "Not bad at all",
    "It was kind of good",
    "At least it is good",
    "This is the least good",
    "Is it good??",
    "",
    None,
]


def test_rule_properties(spark):
    df = spark.createDataFrame(list(enumerate(SENTENCES)), "id long, text string")
    got = {r["id"]: r["compound_score"] for r in rule_score(df, _lex_df(spark, LEX), "id").collect()}
    base, neg, very, caps_very, caps, excl = (got[i] for i in range(6))
    assert neg < 0 < base
    assert base < very < caps_very
    assert base < caps and base < excl
    assert got[6] < 0  # the clause after "but" dominates
    assert got[8] > 0  # negated negative
    assert got[13] == 0.0 and got[14] == 0.0
    for i, t in enumerate(SENTENCES):
        assert got[i] == brute(t, LEX), t


def test_rule_score_matches_brute_force_on_documents(spark):
    docs = load_table(spark, SF_SMALL, "documents").filter(F.col("lang") == "en").select("doc_id", "text")
    lex = corpus_lexicon(docs, 300)
    lex_map = {r["token"]: r["valence"] for r in lex.collect()}
    got = {r["doc_id"]: r["compound_score"] for r in rule_score(docs, lex, "doc_id").collect()}
    texts = {r["doc_id"]: r["text"] for r in docs.collect()}
    bad = [d for d, t in texts.items() if not math.isclose(got[d], brute(t, lex_map), abs_tol=1e-4)]
    assert not bad, bad[:5]
