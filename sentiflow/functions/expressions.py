"""Column expressions shared by operators (all JVM-side built-ins)."""

from __future__ import annotations

import datetime as _dt
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from sentiflow.schema import NEGATIVE_THRESHOLD, POSITIVE_THRESHOLD, SENTIMENT_CLASSES


def ts_literal(value: _dt.datetime | str | None) -> Column:
    """A ``timestamp_ntz`` literal built from ISO text, independent of the driver's time zone."""
    if value is None:
        return F.lit(None).cast("timestamp_ntz")
    if isinstance(value, _dt.datetime):
        value = value.replace(tzinfo=None).isoformat(sep=" ")
    return F.lit(value).cast("timestamp_ntz")


def as_column(value) -> Column:
    """Literal, datetime, SQL string in ``expr:`` form or Column -> Column."""
    if isinstance(value, Column):
        return value
    if isinstance(value, str) and value.startswith("expr:"):
        return F.expr(value[5:])
    if isinstance(value, (str, _dt.datetime)):
        return ts_literal(value)
    return F.lit(value)


def interval(spec: str) -> Column:
    """``'5 minutes'`` -> an INTERVAL literal column."""
    return F.expr(f"INTERVAL {spec}")


def label_expr(score: Column | str) -> Column:
    """Sentiment label from a compound score; both bounds inclusive."""
    s = F.col(score) if isinstance(score, str) else score
    return (
        F.when(s >= POSITIVE_THRESHOLD, F.lit("positive"))
        .when(s <= NEGATIVE_THRESHOLD, F.lit("negative"))
        .otherwise(F.lit("neutral"))
    )


def polarity_class(avg: Column | str) -> Column:
    """Colour class by the sign of a group average (NULL when exactly 0)."""
    a = F.col(avg) if isinstance(avg, str) else avg
    return F.when(a > 0, F.lit("green")).when(a < 0, F.lit("red"))


def exact_avg(col: Column | str, scale: int = 4, digits: int | None = 4) -> Column:
    """Order-independent average of a ``scale``-decimal value.

    Averages through ``decimal`` so parallel partial sums cannot change the
    result, rounds HALF_UP to ``digits`` (None keeps the decimal average's
    own 4 extra digits) and returns double.
    """
    c = F.col(col) if isinstance(col, str) else col
    avg = F.avg(c.cast(f"decimal(18,{scale})"))
    if digits is not None:
        avg = F.round(avg, digits)
    return avg.cast("double")


def pct(part: Column, total: Column, digits: int) -> Column:
    """``round(100 * part / total, digits)`` exactly; NULL when total is 0."""
    ratio = (part.cast("decimal(20,0)") * F.lit(100)) / F.nullif(total, F.lit(0)).cast("decimal(20,0)")
    return F.round(ratio, digits).cast("double")


def count_class(label: str, col: str = "sentiment") -> Column:
    """Number of rows of one class (``count_if``)."""
    return F.count_if(F.col(col) == F.lit(label))


def class_count_columns(col: str = "sentiment", suffix: str = "") -> list[Column]:
    """One count column per class, named after the class."""
    return [count_class(c, col).alias(f"{c}{suffix}") for c in SENTIMENT_CLASSES]


def minute_bucket(ts: Column | str, unit: str = "minute") -> Column:
    """``date_trunc(unit, ts)`` kept as ``timestamp_ntz``."""
    c = F.col(ts) if isinstance(ts, str) else ts
    return F.date_trunc(unit, c).cast("timestamp_ntz")


def lag_seconds(processed: Column | str, created: Column | str) -> Column:
    """End-to-end latency in seconds with microsecond fractions; NULL if either is NULL."""
    p = F.col(processed) if isinstance(processed, str) else processed
    c = F.col(created) if isinstance(created, str) else created
    return F.timestamp_diff("MICROSECOND", c, p) / F.lit(1_000_000.0)


def all_of(conditions: list[Column]) -> Column:
    """AND of the supplied predicates; ``lit(True)`` when none is given."""
    return reduce(lambda a, b: a & b, conditions, F.lit(True))


def parse_tag_list(raw: Column | str) -> Column:
    """``'#a, b,,#c'`` -> ``['a','b','c']``: split on commas, trim, strip one ``#``, drop empties."""
    c = F.col(raw) if isinstance(raw, str) else raw
    parts = F.transform(F.split(F.coalesce(c, F.lit("")), ","), lambda x: F.regexp_replace(F.regexp_replace(x, r"^\s+|\s+$", ""), "^#", ""))
    return F.filter(parts, lambda x: x != F.lit(""))


def clamp_int(raw: Column | str, default: int, maximum: int) -> Column:
    """``min(parseInt(raw) or default, maximum)`` for request parameters."""
    c = F.col(raw) if isinstance(raw, str) else raw
    leading = F.regexp_extract(c, r"^\s*([+-]?[0-9]+)", 1)
    number = F.when(leading == F.lit(""), F.lit(None)).otherwise(leading.try_cast("int"))
    return F.least(F.coalesce(number, F.lit(default)), F.lit(maximum))


def keyword_needle(kw: Column | str) -> Column:
    """Lower-case keyword with leading ``#`` characters removed."""
    c = F.col(kw) if isinstance(kw, str) else kw
    return F.regexp_replace(F.lower(c), "^#+", "")


def keyword_hits(needle: Column, tags: Column | str, text: Column | str) -> Column:
    """True when the needle equals a lower-cased tag or is a substring of lower(text)."""
    t = F.col(tags) if isinstance(tags, str) else tags
    x = F.col(text) if isinstance(text, str) else text
    tag_hit = F.coalesce(F.array_contains(F.transform(t, lambda h: F.lower(h)), needle), F.lit(False))
    text_hit = F.coalesce(F.lower(x).contains(needle), F.lit(False))
    return tag_hit | text_hit
