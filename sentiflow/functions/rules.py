"""Rule-based lexicon scoring (SEN-01, full-rule form) as a relational Spark job.

The heuristics follow the published rule set for lexicon-and-rule sentiment
scoring of short social text (Hutto & Gilbert, ICWSM 2014): degree modifiers
("boosters") in the three preceding words with distance damping, ALL-CAPS
emphasis when the text mixes case, negation in the three preceding words
(with the "never so/this" intensifier and "least"), contrastive "but"
re-weighting, and exclamation/question-mark emphasis; the summed valence is
normalised by ``s / sqrt(s^2 + alpha)``.

Plan shape (row-local but for the lookup):
  words per text (array ops)
  -> the lexicon entries of each row's words (``lookup.look_up``: the distinct words of a
     group of rows are joined with the lexicon, whatever its size; no word row is shuffled)
  -> adjusted valence of each entry by CASE expressions over the neighbouring words; rules
     apply only to modifiers that are not lexicon words themselves
  -> exact decimal sum over the row, then the punctuation emphasis.
All word lists and constants are parameters (``RuleParams``).
"""

from __future__ import annotations

import string
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentiflow.functions.lookup import look_up


# Fixed values (public rule set; configurable): constants and word lists.
@dataclass(frozen=True)
class RuleParams:
    alpha: float = 15.0
    booster_increment: float = 0.293
    booster_decrement: float = -0.293
    caps_increment: float = 0.733
    negation_scalar: float = -0.74
    never_so_scalar: float = 1.25
    but_before: float = 0.5
    but_after: float = 1.5
    exclamation_step: float = 0.292
    exclamation_max: int = 4
    question_step: float = 0.18
    question_max_value: float = 0.96
    boosters_up: tuple[str, ...] = (
        "absolutely", "amazingly", "awfully", "completely", "considerably", "decidedly", "deeply",
        "enormously", "entirely", "especially", "exceptionally", "extremely", "fabulously", "greatly",
        "highly", "hugely", "incredibly", "intensely", "majorly", "more", "most", "particularly",
        "purely", "quite", "really", "remarkably", "so", "substantially", "thoroughly", "totally",
        "tremendously", "uber", "unbelievably", "unusually", "utterly", "very",
    )
    boosters_down: tuple[str, ...] = (
        "almost", "barely", "hardly", "kinda", "kindof", "less", "little", "marginally",
        "occasionally", "partly", "scarcely", "slightly", "somewhat", "sorta", "sortof",
    )
    negations: tuple[str, ...] = (
        "aint", "arent", "cannot", "cant", "couldnt", "darent", "didnt", "doesnt", "dont", "hadnt",
        "hasnt", "havent", "isnt", "mightnt", "mustnt", "neither", "never", "none", "nope", "nor",
        "not", "nothing", "nowhere", "oughtnt", "shant", "shouldnt", "wasnt", "werent", "without",
        "wont", "wouldnt", "rarely", "seldom", "despite",
    )


DEFAULT_PARAMS = RuleParams()

# Punctuation stripped from both ends of a whitespace token.
_EDGE_PUNCT = string.punctuation


def _is_caps(w: Column) -> Column:
    return (F.upper(w) == w) & (F.lower(w) != w)


def _negated(w: Column, p: RuleParams) -> Column:
    return F.coalesce(w.isin(list(p.negations)) | w.contains("n't"), F.lit(False))


def _booster(w: Column, p: RuleParams) -> Column:
    return (
        F.when(w.isin(list(p.boosters_up)), F.lit(p.booster_increment))
        .when(w.isin(list(p.boosters_down)), F.lit(p.booster_decrement))
    )


def rule_score(
    df: DataFrame,
    lexicon: DataFrame,
    id_col: str,
    text_col: str = "text",
    params: RuleParams = DEFAULT_PARAMS,
) -> DataFrame:
    """``(id, compound_score)`` for every row of ``df`` with the full rule set."""
    rows = df.select(F.col(id_col), F.col(text_col).alias("text"))
    return with_rule_score(rows, lexicon, "text", params, key=id_col).select(id_col, "compound_score")


# Edge punctuation is stripped only when a word of 3+ characters remains (keeps ":)"-like tokens).
def _strip_word(t: Column) -> Column:
    stripped = F.btrim(t, F.lit(_EDGE_PUNCT))
    return F.when(F.length(stripped) <= 2, t).otherwise(stripped)


def _pieces(text: Column) -> Column:
    return F.split(F.trim(text), r"\s+")


def _spread_words(text: Column) -> Callable[[DataFrame], DataFrame]:
    """The distinct (_group, token) of the words of texts."""

    def spread(df: DataFrame) -> DataFrame:
        pieces = df.select("_group", F.explode(_pieces(text)).alias("_piece")).distinct()
        stripped = pieces.select("_group", _strip_word(F.col("_piece")).alias("_word")).filter(F.length("_word") > 1)
        return stripped.select("_group", F.lower("_word").alias("token")).distinct()

    return spread


def _ruled_words(text: Column, p: RuleParams) -> Callable[[DataFrame], DataFrame]:
    """Adds a text's words in lower case, whether each is in capitals, whether a rule names it, whether the text mixes case, and the place
    of its "but" (from 1)."""
    words = F.filter(F.transform(_pieces(text), _strip_word), lambda t: F.length(t) > 1)
    rule_words = [*p.boosters_up, *p.boosters_down, *p.negations, "never", "least", "kind"]

    def add(df: DataFrame) -> DataFrame:
        cased = df.withColumn("_cased", words).withColumn("_caps", F.transform("_cased", _is_caps))
        lower = cased.withColumn("_words", F.transform("_cased", lambda w: F.lower(w))).drop("_cased")
        mixed = F.exists("_caps", lambda c: c) & F.exists("_caps", lambda c: ~c)
        named = F.transform("_words", lambda w: w.isin(rule_words) | w.contains("n't"))
        return lower.withColumns({"_named": named, "_mixed": mixed, "_but": F.array_position("_words", "but")})

    return add


def with_rule_score(
    df: DataFrame, lexicon: DataFrame, text_col: str = "text", params: RuleParams = DEFAULT_PARAMS, key: str | None = None
) -> DataFrame:
    """``df`` with the full-rule score of each row's text; ``key`` (a column, if any) deals copies of a text to several tasks."""
    p = params
    lex = lexicon.select(F.lower("token").alias("token"), F.col("valence").cast("double").alias("valence"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    found = look_up(df, _ruled_words(text, p), _spread_words(text), lex, text_col, [key] if key else [])
    damp = {1: 1.0, 2: 0.95, 3: 0.9}
    so_this = ["so", "this"]
    neg, zero, one = F.lit(p.negation_scalar), F.lit(0.0), F.lit(1.0)

    # Adjusted valence = (valence + caps + boosters) * negation and contrast factors. Each
    # rule is its own term, so the expression stays linear in size (no nested re-use).
    def adjusted(hit: Column) -> Column:
        at, v = hit["_at"], hit["_valence"]
        word, following = F.get("_words", at), F.get("_words", at + 1)
        p1, p2, p3 = (F.get("_words", at - k) for k in (1, 2, 3))
        plain = {k: ~F.coalesce(F.get("_known", at - k), F.lit(False)) for k in (1, 2, 3)}  # not a lexicon word itself
        sign = F.signum(v)
        caps = F.when(F.get("_caps", at) & F.col("_mixed"), sign * F.lit(p.caps_increment)).otherwise(zero)
        boost_terms = []
        for k, pk in ((1, p1), (2, p2), (3, p3)):
            shout = F.when(F.get("_caps", at - k) & F.col("_mixed"), sign * F.lit(p.caps_increment)).otherwise(zero)
            scalar = _booster(pk, p) * sign + shout
            applies = pk.isNotNull() & plain[k] & _booster(pk, p).isNotNull()
            boost_terms.append(F.when(applies, scalar * F.lit(damp[k])).otherwise(zero))
        f1 = F.when(plain[1] & _negated(p1, p), neg).otherwise(one)
        f2 = (
            F.when((p2 == "never") & p1.isin(so_this), F.lit(p.never_so_scalar))
            .when(plain[2] & _negated(p2, p), neg)
            .otherwise(one)
        )
        f3 = (
            F.when((p3 == "never") & (p2.isin(so_this) | p1.isin(so_this)), F.lit(p.never_so_scalar))
            .when(plain[3] & _negated(p3, p), neg)
            .otherwise(one)
        )
        least = (p1 == "least") & plain[1] & ~F.coalesce(p2.isin(["at", "very"]), F.lit(False))
        f_least = F.when(least, neg).otherwise(one)
        position = at + 1
        f_but = (
            F.when((F.col("_but") > 0) & (position < F.col("_but")), F.lit(p.but_before))
            .when((F.col("_but") > 0) & (position > F.col("_but")), F.lit(p.but_after))
            .otherwise(one)
        )
        # A booster word, or "kind" in "kind of", carries no valence of its own.
        silent = word.isin(list(p.boosters_up) + list(p.boosters_down)) | ((word == "kind") & (following == "of"))
        value = (v + caps + boost_terms[0] + boost_terms[1] + boost_terms[2]) * f1 * f2 * f3 * f_least * f_but
        # Most words have no rule word at or before them and no caps to weigh: the terms above are then zeros and ones.
        ruled = (F.get("_caps", at) & F.col("_mixed")) | reduce(lambda a, b: a | b, [F.coalesce(F.get("_named", at - k), F.lit(False)) for k in range(4)])
        value = F.when(~ruled, v * f_but).when(silent, zero).otherwise(value)
        return F.coalesce(value.cast("decimal(20,9)"), F.lit(0).cast("decimal(20,9)"))

    total = F.aggregate(F.arrays_zip("_at", "_valence"), F.lit(0).cast("decimal(28,9)"), lambda s, hit: (s + adjusted(hit)).cast("decimal(28,9)"))
    summed = found.select(
        *df.columns,
        total.cast("double").alias("_s"),
        F.least(F.length(text) - F.length(F.regexp_replace(text, "!", "")), F.lit(p.exclamation_max)).alias("_excl"),
        (F.length(text) - F.length(F.regexp_replace(text, r"\?", ""))).alias("_ques"),
    )
    s = F.col("_s")
    ques = F.col("_ques")
    ep = F.col("_excl") * F.lit(p.exclamation_step) + (
        F.when(ques > 3, F.lit(p.question_max_value)).when(ques > 1, ques * F.lit(p.question_step)).otherwise(F.lit(0.0))
    )
    summed = summed.withColumn("_total", F.when(s > 0, s + ep).when(s < 0, s - ep).otherwise(s))
    total = F.col("_total")
    compound = F.round(total / F.sqrt(total * total + F.lit(p.alpha)), 4)
    compound = F.greatest(F.lit(-1.0), F.least(F.lit(1.0), compound))
    return summed.select(*df.columns, compound.alias("compound_score"))
