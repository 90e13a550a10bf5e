"""Temperature mixing of sources, realised as budgeted block permutations.

Source weights are token shares raised to an exponent and normalised. At exponent 1 the mix follows the shares, at
0 all sources weigh the same; entropy grows as the exponent falls, and so does the repetition of the smallest
sources. ``fit_exponent`` bisects for the largest exponent that reaches a target entropy, but does not go below the
smallest one at which no source is repeated more than a limit. Spark sums over the sources at each step.

The weights then share out a token budget. Each source's documents are permuted by a seeded hash, again
in each epoch, and read until its budget is used; the last document may cross it. A document's place
in its source's budget decides its block, so every block has about the same mix, and inside a block the
order is a seeded hash.

Scale: one aggregation by source (token counts only), then a two-level running sum: documents fall in slots of
about ``SLOT_ROWS`` by their hash, slots are summed first, and only documents of one slot meet in a task. A source
with a third of all rows is many slots. Texts are joined by the caller; only ids and counts move here.

Defined results: a null source is a source of its own; a null or empty text has no tokens, counts for nothing and is not
drawn; without tokens nothing is drawn; equal hashes are ordered by id; repeated rows are drawn as rows of their own;
other columns are not read.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentiflow.llm.common import read_table, written

#: Share of the greatest possible entropy to reach, and most epochs of any source.
ENTROPY = 0.98
REPEATS = 4.0
BLOCKS = 64
SLOT_ROWS = 2000
SEED = 17


def curve(sources: DataFrame, exponents: list[float], top: float) -> list[tuple[float, float]]:
    """At each exponent (sum, sum of x ln x) of the sources' raised shares x = (tokens / top) ** exponent; one job."""
    log = F.log(F.col("tokens") / F.lit(top))
    columns = []
    for i, e in enumerate(exponents):
        raised = F.exp(log * F.lit(e))
        columns += [F.sum(raised).alias(f"z{i}"), F.sum(raised * log * F.lit(e)).alias(f"s{i}")]
    row = sources.agg(*columns).first()
    return [(row[f"z{i}"], row[f"s{i}"]) for i in range(len(exponents))]


def bisect(good, low: float, high: float) -> float:
    """The good side of where ``good`` changes between a good ``low`` and a bad ``high``, to nine digits.

    ``good`` judges a list of exponents at once: five steps of the bisection a job.
    """
    for _ in range(6):
        points = [low + (high - low) * i / 32 for i in range(33)]
        last = 0
        for i, fine in enumerate(good(points[1:-1]), 1):
            if not fine:
                break
            last = i
        low, high = points[last], points[last + 1]
    return low


def fit_exponent(sources: DataFrame, budget: float, target: float = ENTROPY, repeats: float = REPEATS) -> float:
    """The exponent between 0 and 1 that meets the entropy target as far as the repetition limit lets it."""
    ends = sources.agg(F.min("tokens").alias("low"), F.max("tokens").alias("top"), F.count("*").alias("n")).first()
    low, top = float(ends["low"]), float(ends["top"])
    goal = target * math.log(ends["n"])

    def even(exponents):
        return [math.log(z) - s / z >= goal for z, s in curve(sources, exponents, top)]

    def rare(exponents):  # the smallest source repeats most
        sums = curve(sources, exponents, top)
        return [budget / z * (low / top) ** e / low <= repeats for e, (z, _) in zip(exponents, sums)]

    exponent = 1.0 if even([1.0])[0] else bisect(even, 0.0, 1.0)
    at, whole = rare([exponent, 1.0])
    if not at and whole:
        exponent = 1.0 - bisect(lambda points: rare([1.0 - p for p in points]), 0.0, 1.0 - exponent)
    elif not whole:
        exponent = 1.0  # the budget itself asks for more repetition
    return round(exponent, 8)


def n_tokens(text) -> F.Column:
    """Words between white space, counted where one begins."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def mix(
    docs: DataFrame, budget: int | None = None, target: float = ENTROPY, repeats: float = REPEATS, blocks: int = BLOCKS,
    seed: int = SEED, id_col: str = "doc_id", source_col: str = "source", text_col: str = "text",
) -> DataFrame:
    """(doc_id, source, epoch, block, place, n_tokens, weight) of every draw; ``budget`` is all tokens unless given.

    Draws are ordered by (block, place, source, doc_id, epoch).
    """
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(source_col).cast("string").alias("source"), n_tokens(F.col(text_col)).alias("n_tokens"))
    rows = written(rows.where(F.col("n_tokens") > 0), "tokens")
    sources = written(rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), F.count("*").alias("rows")), "sources")
    plan = plan_sources(sources, budget, target, repeats)
    key = F.xxhash64(F.lit(seed), "source", "epoch", "doc_id", "n_tokens")
    source_is = rows["source"].eqNullSafe(plan["of"])
    drawn = rows.join(plan, source_is).drop("of").where(F.col("share") > 0)
    drawn = drawn.withColumn("epoch", F.explode(F.sequence(F.lit(0), F.col("epochs") - 1))).withColumn("key", key)
    slots = F.ceil(F.col("rows") / SLOT_ROWS).cast("long")
    drawn = drawn.withColumn("slot", F.floor((F.shiftrightunsigned("key", 11).cast("double") * 2.0**-53) * slots).cast("long"))
    order = ["source", "epoch"]
    sums = drawn.groupBy(*order, "slot").agg(F.sum("n_tokens").alias("held"))
    before = Window.partitionBy(*order).orderBy("slot").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(F.col("source").alias("s"), F.col("epoch").alias("e"), F.col("slot").alias("l"), F.coalesce(F.sum("held").over(before), F.lit(0)).alias("ahead"))
    found = drawn.join(sums, drawn["source"].eqNullSafe(sums["s"]) & (drawn["epoch"] == sums["e"]) & (drawn["slot"] == sums["l"]))
    inside = Window.partitionBy(*order, "slot").orderBy("key", "doc_id").rowsBetween(Window.unboundedPreceding, -1)
    start = F.col("epoch") * F.col("tokens") + F.col("ahead") + F.coalesce(F.sum("n_tokens").over(inside), F.lit(0))
    found = found.withColumn("start", start).where(F.col("start") < F.col("share"))
    return found.select(
        "doc_id",
        "source",
        F.col("epoch").cast("int").alias("epoch"),
        F.least(F.floor(F.col("start") * F.lit(float(blocks)) / F.col("share")), F.lit(blocks - 1)).cast("int").alias("block"),
        F.xxhash64(F.lit(seed + 1), "source", "epoch", "doc_id", "n_tokens").alias("place"),
        "n_tokens",
        "weight",
    )


def plan_sources(sources: DataFrame, budget: int | None, target: float, repeats: float) -> DataFrame:
    """(of, tokens, rows, share, epochs, weight) of every source; only sums over the sources reach the driver."""
    ends = sources.agg(F.max("tokens").alias("top"), F.sum("tokens").alias("all")).first()
    if ends["top"] is None:
        return sources.select(
            F.col("source").alias("of"), "tokens", "rows", F.lit(0.0).alias("share"), F.lit(0).alias("epochs"), F.lit(0.0).alias("weight")
        )
    spend = float(ends["all"] if budget is None else budget)
    exponent, top = fit_exponent(sources, spend, target, repeats), float(ends["top"])
    total = curve(sources, [exponent], top)[0][0]
    weight = F.round(F.exp(F.log(F.col("tokens") / F.lit(top)) * F.lit(exponent)) / F.lit(total), 12)  # sums differ in the last digits
    plan = sources.withColumn("weight", weight).withColumn("share", F.col("weight") * F.lit(spend))
    return plan.select(
        F.col("source").alias("of"), "tokens", "rows", "share", F.ceil(F.col("share") / F.col("tokens")).cast("int").alias("epochs"), "weight"
    )


def op9_temperature_mixing(spark, sf_dir):
    return mix(read_table(spark, sf_dir, "documents"))
