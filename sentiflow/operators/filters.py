"""Row filters over the posts table (FLT-*). All are plain Catalyst predicates,
so column pruning and, where the predicate allows, parquet pushdown apply."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sentiflow.functions.expressions import all_of, as_column, interval, keyword_hits, keyword_needle
from sentiflow.schema import SENTIMENT_CLASSES


def filter_text_lang(df: DataFrame, langs: Iterable[str] = ("en",), text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """Keep rows with non-NULL, non-empty text (whitespace kept) in one of ``langs`` (exact match)."""
    langs = list(langs)
    cond = F.col(text_col).isNotNull() & (F.col(text_col) != F.lit(""))
    if langs:
        cond = cond & F.col(lang_col).isin(langs)
    return df.filter(cond)


def trailing_window(df: DataFrame, as_of, width: str, ts_col: str = "processed_at", date_col: str | None = None) -> DataFrame:
    """``ts >= as_of - width``: closed lower bound, no upper bound (as the reference).

    With ``date_col`` (a date partition column of ``ts``) the implied bound
    ``date_col >= to_date(as_of - width)`` is added so whole partitions are pruned.
    """
    lower = as_column(as_of) - interval(width)
    cond = F.col(ts_col) >= lower
    if date_col:
        cond = cond & (F.col(date_col) >= F.to_date(lower))
    return df.filter(cond)


def tag_overlap_predicate(tags: Iterable[str], tags_col: str = "hashtags", case_insensitive: bool = False) -> Column:
    """True when the tag array shares an element with ``tags`` (NULL for NULL arrays)."""
    tags = list(tags)
    if case_insensitive:
        wanted = F.array(*[F.lit(t.lower()) for t in tags])
        return F.arrays_overlap(F.transform(F.col(tags_col), lambda h: F.lower(h)), wanted)
    return F.arrays_overlap(F.col(tags_col), F.array(*[F.lit(t) for t in tags]))


def tag_overlap(df: DataFrame, tags: Iterable[str], tags_col: str = "hashtags", case_insensitive: bool = False) -> DataFrame:
    """Rows whose tag array shares at least one element with ``tags`` (NULL arrays drop out)."""
    return df.filter(tag_overlap_predicate(tags, tags_col, case_insensitive))


def validate_class(label: str | None) -> str | None:
    """Return the label, or raise ``ValueError`` for anything but the three classes."""
    if label is not None and label not in SENTIMENT_CLASSES:
        raise ValueError(f"Invalid sentiment filter: {label!r}")
    return label


def by_class(df: DataFrame, label: str | None, col: str = "sentiment") -> DataFrame:
    """Filter to one sentiment class; ``None`` keeps all; unknown labels raise."""
    label = validate_class(label)
    if label is None:
        return df
    return df.filter(F.col(col) == F.lit(label))


def search_predicate(tags: Iterable[str] | None = None, label: str | None = None) -> Column:
    """AND of the optional conjuncts (tag overlap, class); no conjunct -> TRUE."""
    conds: list[Column] = []
    tags = [t for t in (tags or []) if t]
    if tags:
        conds.append(tag_overlap_predicate(tags))
    if validate_class(label) is not None:
        conds.append(F.col("sentiment") == F.lit(label))
    return all_of(conds)


def keyword_match(df: DataFrame, keyword: str, tags_col: str = "hashtags", text_col: str = "text") -> DataFrame:
    """Posts matched by one tracking keyword (tag equality or text substring, case-insensitive)."""
    return df.filter(keyword_hits(keyword_needle(F.lit(keyword)), tags_col, text_col))
