"""JSON decode / encode of post payloads and envelope routing (SRC-02, SRC-03, SNK-01)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sentiflow.schema import POST_PAYLOAD_SCHEMA

CORRUPT_COL = "_corrupt_record"

ENVELOPE_SCHEMA = T.StructType(
    [
        T.StructField("type", T.StringType(), True),
        T.StructField("data", T.StructType([T.StructField("id", T.StringType()), T.StructField("id_str", T.StringType()),
                                            T.StructField("text", T.StringType()), T.StructField("full_text", T.StringType())]), True),
        T.StructField("message", T.StringType(), True),
    ]
)


def decode_json(
    df: DataFrame,
    schema: T.StructType = POST_PAYLOAD_SCHEMA,
    value_col: str = "value",
    keep: list[str] | None = None,
    corrupt_col: str | None = CORRUPT_COL,
) -> DataFrame:
    """Parse a (binary or string) JSON column with a fixed schema and flatten it.

    Malformed records become all-NULL rows; with ``corrupt_col`` the raw text
    of such records is kept in that column (NULL for good records). A
    field-level type error (e.g. a string in a bigint field) nulls only that
    field, keeps the siblings, and also flags the raw record in ``corrupt_col``.
    """
    keep = keep or []
    text = F.col(value_col).cast("string")
    if corrupt_col:
        parse_schema = T.StructType(list(schema.fields) + [T.StructField(corrupt_col, T.StringType(), True)])
        parsed = F.from_json(text, parse_schema, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": corrupt_col})
    else:
        parsed = F.from_json(text, schema)
    out = df.select(*keep, parsed.alias("_t"))
    return out.select(*keep, "_t.*")


def encode_json(df: DataFrame, key_col: str = "id", value_cols: list[str] | None = None) -> DataFrame:
    """``(key, value)`` rows for a keyed JSON sink: key = id string, value = compact JSON with nulls kept."""
    cols = value_cols or df.columns
    return df.select(
        F.col(key_col).cast("string").alias("key"),
        F.to_json(F.struct(*[F.col(c) for c in cols]), {"ignoreNullFields": "false"}).alias("value"),
    )


def route_envelopes(raw: DataFrame, value_col: str = "value", keep: list[str] | None = None) -> DataFrame:
    """Decode ``{type, data}`` envelopes and tag each with a route.

    Routes: ``publish`` (tweet with non-empty text), ``empty`` (tweet without
    text), ``error`` (error message; ``rate_limited`` if the lower-cased
    message contains "rate limit"), ``ignored`` (other types), ``dropped``
    (undecodable).
    """
    keep = keep or []
    dec = decode_json(raw, ENVELOPE_SCHEMA, value_col, keep=keep + [value_col])
    text = F.coalesce(F.nullif(F.col("data.text"), F.lit("")), F.col("data.full_text"), F.lit(""))
    route = (
        F.when(F.col(CORRUPT_COL).isNotNull() | F.col("type").isNull(), F.lit("dropped"))
        .when((F.col("type") == "tweet") & (text != ""), F.lit("publish"))
        .when(F.col("type") == "tweet", F.lit("empty"))
        .when(F.col("type") == "error", F.lit("error"))
        .otherwise(F.lit("ignored"))
    )
    rate_limited = (F.col("type") == "error") & F.lower(F.col(value_col).cast("string")).contains("rate limit")
    return dec.select(*keep, F.col(value_col), route.alias("route"), F.coalesce(rate_limited, F.lit(False)).alias("rate_limited"), "data")


def split_routes(routed: DataFrame) -> dict[str, DataFrame]:
    """``{route: rows}`` views of one routed frame (each a filter; no extra scan is cached)."""
    return {r: routed.filter(F.col("route") == r) for r in ("publish", "empty", "error", "ignored", "dropped")}


def route_counts(routed: DataFrame) -> DataFrame:
    """Messages and rate-limit errors per route."""
    return routed.groupBy("route").agg(F.count(F.lit(1)).alias("n"), F.count_if("rate_limited").alias("rate_limited"))
