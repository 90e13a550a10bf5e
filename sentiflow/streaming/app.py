"""The ingest job: raw JSON posts -> decode -> filter -> score -> label -> keyed log.

Library use: ``ingest_transform(...)`` is the per-micro-batch transform for
``PostsLogSink``; ``start_ingest(...)`` wires source, transform, sink and
trigger. Command line (Kafka or a file folder of JSON lines)::

    python -m sentiflow.streaming.app --bootstrap host:9092 --topic tweets \
        --lexicon /shared/lexicon.parquet --root /shared/sentiflow --checkpoint /shared/ckpt/ingest
    python -m sentiflow.streaming.app --files /shared/incoming --lexicon ... --root ... --checkpoint ...
"""

from __future__ import annotations

import argparse
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sentiflow.functions.rules import with_rule_score
from sentiflow.functions.scoring import with_lexicon_score
from sentiflow.operators.quality import canonical_posts
from sentiflow.sources.json_codec import decode_json
from sentiflow.streaming.jobs import run_stream
from sentiflow.streaming.sink import PostsLogSink
from sentiflow.streaming.sources import kafka_options, read_posts_stream


# Scorers of the ingest job by name.
SCORERS = {"rules": with_rule_score, "lexicon": with_lexicon_score}


def ingest_transform(
    spark: SparkSession, lexicon: DataFrame, langs=("en",), processed_at=None, scorer: str = "rules"
) -> Callable[[DataFrame], DataFrame]:
    """Micro-batch transform: decode the ``value`` JSON, keep non-empty texts in ``langs``, score each and label it.

    ``scorer`` is ``"rules"`` (the full rule set) or ``"lexicon"`` (the plain valence sum); both are relational.
    """
    add_score = SCORERS[scorer]

    def transform(raw: DataFrame) -> DataFrame:
        payload = decode_json(raw, value_col="value")
        return canonical_posts(payload, lambda df: add_score(df, lexicon, key="id"), processed_at, langs)

    return transform


def start_ingest(
    spark: SparkSession, raw_stream: DataFrame, lexicon: DataFrame, root: str, checkpoint: str, trigger: str = "10 seconds", scorer: str = "rules"
):
    """Start the ingest stream; returns the running query."""
    sink = PostsLogSink(root, transform=ingest_transform(spark, lexicon, scorer=scorer), as_of="now")
    return run_stream(raw_stream.select(F.col("value").cast("string").alias("value")), sink=sink, checkpoint=checkpoint, trigger=trigger)


def main(argv: list[str] | None = None) -> None:
    """Command-line entry point (see the module docstring)."""
    from sentiflow.session import build_session

    ap = argparse.ArgumentParser(description="Raw JSON posts -> scored, labelled, keyed posts log")
    ap.add_argument("--bootstrap", help="Kafka bootstrap servers (Kafka source)")
    ap.add_argument("--topic", default="tweets")
    ap.add_argument("--files", help="folder of JSON-lines files with a 'value' field (file source)")
    ap.add_argument("--lexicon", required=True, help="parquet table (token, valence)")
    ap.add_argument("--root", required=True, help="output folder (shared storage)")
    ap.add_argument("--checkpoint", required=True, help="checkpoint folder (shared storage)")
    ap.add_argument("--trigger", default="10 seconds")
    ap.add_argument("--scorer", choices=sorted(SCORERS), default="rules")
    args = ap.parse_args(argv)
    spark = build_session()
    if args.bootstrap:
        raw = read_posts_stream(spark, "kafka", **kafka_options(args.bootstrap, args.topic))
    elif args.files:
        raw = spark.readStream.schema("value string").json(args.files)
    else:
        ap.error("one of --bootstrap or --files is required")
    query = start_ingest(spark, raw, spark.read.parquet(args.lexicon), args.root, args.checkpoint, args.trigger, args.scorer)
    try:
        query.awaitTermination()
    except KeyboardInterrupt:
        query.stop()


if __name__ == "__main__":
    main()
