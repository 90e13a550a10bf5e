"""Centroid clustering with ns-bounds.

Every vector keeps an upper bound of the distance to its own centroid and a lower bound to each other one, with the round
in which each was last measured. Centroids of all rounds are retained, so a bound is loosened by the norm of its
centroid's total displacement since that round; that is never more than the sum of the moves in between. Where the
loosened bounds leave one nearest centroid, nothing is measured. Where they fail, the vector's own centroid is measured
and then, exactly, every centroid whose bound still fails; its bound starts anew. Bounds are rounded outwards and must
differ strictly, so the result, ties included, is that of measuring everything.

Vectors are integers (floor of a multiple of each component), distances and sums are exact, and an updated centroid is the
componentwise floor of the mean.

Scale: a round reads the vectors' table once (in tasks, no shuffle) and writes the next one with the bounds beside the
vectors; the one before is deleted. What a batch moves between clusters is a row for each cluster in the same table, so the sums of
the next centroids come from (clusters x batches) short rows, summed in Spark before ``k`` rows reach the driver. The centroid
history (rounds x k x dims) and the final k-row table are all that is broadcast. A cluster with any share of the rows is
never grouped.

Defined results: only vectors with exactly ``dims`` components, none null or non-finite, take part; others are not
returned. A vector with a component beyond +-2**27 after scaling (no long holds its squared distances) is returned with
null cluster and distance and moves no centroid. Repeated rows and ids are vectors of their own; seeds with equal ids are
ordered by their components; a null id counts as a vector, and comes last among the seeds. With fewer vectors than ``k`` there are
fewer centroids; an empty table gives no rows. Inertias beyond a long are null. Other columns are not read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sentiflow.llm.common import deleted, kept, read_table

#: Largest size of a scaled component: 64 squared differences of twice this fit in a long.
WIDEST = 1 << 27
#: Outward margin for sums of bounds in double precision.
MARGIN = 1e-12


def scaled(vectors: pa.Array, dims: int, scale: int) -> tuple[np.ndarray, np.ndarray]:
    """(integer vectors, which of them are too wide) of a list column whose lists have ``dims`` components."""
    flat = np.asarray(vectors.flatten().to_numpy(zero_copy_only=False), np.float64).reshape(-1, dims)
    wide = (np.abs(flat) > WIDEST / scale).any(axis=1)
    flat = np.where(wide[:, None], 0.0, flat)
    return np.floor(flat * scale).astype(np.int64), wide


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of rows to one centroid or to a centroid each."""
    off = x - c
    return np.einsum("ij,ij->i", off, off)


class History:
    """Centroids of all rounds so far, and how far each of the last round has come from where it was."""

    def __init__(self, rounds: list[np.ndarray]):
        self.rounds = rounds
        last = rounds[-1].astype(np.float64)
        moved = [np.sqrt(((last - old) ** 2).sum(axis=1)) for old in rounds]
        self.moved = np.stack(moved, axis=1) * (1 + MARGIN)  # (k, rounds)

    @property
    def now(self) -> int:
        return len(self.rounds) - 1

    @property
    def centroids(self) -> np.ndarray:
        return self.rounds[-1]


class Bounds:
    """Clusters, bounds and their rounds of some vectors; ``pack`` and ``unpack`` carry them through a binary column."""

    def __init__(self, cluster, upper, lower, upper_at, lower_at):
        self.cluster, self.upper, self.lower, self.upper_at, self.lower_at = cluster, upper, lower, upper_at, lower_at

    def pack(self) -> list[bytes]:
        rows = np.concatenate(
            [
                np.nextafter(self.upper.astype(np.float32), np.float32(np.inf))[:, None].view(np.uint8),
                np.ascontiguousarray(np.nextafter(self.lower.astype(np.float32), np.float32(-np.inf))).view(np.uint8),
                self.upper_at.astype(np.uint16)[:, None].view(np.uint8),
                np.ascontiguousarray(self.lower_at.astype(np.uint16)).view(np.uint8),
            ],
            axis=1,
        )
        return [r.tobytes() for r in rows]

    @classmethod
    def unpack(cls, cluster: np.ndarray, packed: np.ndarray, k: int) -> Bounds:
        """From the (rows, bytes) form of ``pack``."""
        floats = np.ascontiguousarray(packed[:, : 4 * (k + 1)]).view(np.float32).astype(np.float64)
        rounds = np.ascontiguousarray(packed[:, 4 * (k + 1) :]).view(np.uint16).astype(np.int64)
        return cls(cluster, floats[:, 0].copy(), floats[:, 1:].copy(), rounds[:, 0].copy(), rounds[:, 1:].copy())


def measured(x: np.ndarray, history: History) -> Bounds:
    """Bounds of vectors that are measured against every centroid."""
    d2 = np.stack([squared(x, c) for c in history.centroids], axis=1)
    cluster = d2.argmin(axis=1)
    far = np.sqrt(d2.astype(np.float64))
    at = np.full(len(x), history.now)
    return Bounds(cluster, far[np.arange(len(x)), cluster], far, at, np.repeat(at[:, None], d2.shape[1], axis=1))


def reassigned(x: np.ndarray, b: Bounds, history: History) -> int:
    """Bring ``b`` up to the last centroids; returns how many distances were measured."""
    rows, now = np.arange(len(x)), history.now
    k = len(history.centroids)
    gone = history.moved[np.arange(k)[None, :], b.lower_at]
    lower = (b.lower - gone) - (b.lower + gone) * MARGIN
    lower[rows, b.cluster] = np.inf
    upper = (b.upper + history.moved[b.cluster, b.upper_at]) * (1 + MARGIN)
    failed = np.flatnonzero((lower <= upper[:, None]).any(axis=1))
    own = b.cluster[failed]
    best2 = squared(x[failed], history.centroids[own])
    b.upper[failed], b.upper_at[failed] = np.sqrt(best2.astype(np.float64)), now
    b.lower[failed, own], b.lower_at[failed, own] = b.upper[failed], now
    row, other = np.nonzero(lower[failed] <= b.upper[failed][:, None] * (1 + MARGIN))
    other2 = squared(x[failed[row]], history.centroids[other])
    b.lower[failed[row], other], b.lower_at[failed[row], other] = np.sqrt(other2.astype(np.float64)), now
    # the smallest (distance, number) of each failed vector, its own centroid included
    row = np.concatenate([np.arange(len(failed)), row])
    number, d2 = np.concatenate([own, other]), np.concatenate([best2, other2])
    order = np.lexsort((number, d2, row))
    first = order[np.flatnonzero(np.concatenate([[True], np.diff(row[order]) != 0])[: len(order)])]
    b.cluster[failed] = number[first]
    b.upper[failed] = np.sqrt(d2[first].astype(np.float64))
    return len(d2)


def fixed_bytes(col: pa.Array, size: int) -> np.ndarray:
    """(rows, size) bytes of a binary column whose values have one size."""
    return np.frombuffer(b"".join(col.to_pylist()), np.uint8).reshape(-1, size)


def moves(x: np.ndarray, old: np.ndarray | None, new: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(rows, component sums) that come to each cluster, less what leaves it."""
    count, total = np.zeros(k, np.int64), np.zeros((k, x.shape[1]), np.int64)
    changed = np.arange(len(x)) if old is None else np.flatnonzero(old != new)
    for sign, where in ((1, new), (-1, old)):
        if where is not None:
            np.add.at(count, where[changed], sign)
            np.add.at(total, where[changed], sign * x[changed])
    return count, total


def _state(vec_id, vec, cluster, bounds, count=None, total=None) -> list[pa.RecordBatch]:
    """State rows, and a row for every cluster that gained or lost vectors."""
    names = ["vec_id", "vec", "cluster", "bounds", "n", "sums"]
    longs = pa.list_(pa.int64())
    out = [
        pa.RecordBatch.from_arrays(
            [vec_id, pa.array(vec, pa.binary()), pa.array(cluster, pa.int32()), pa.array(bounds, pa.binary()), pa.nulls(len(vec_id), pa.int64()), pa.nulls(len(vec_id), longs)],
            names=names,
        )
    ]
    if count is not None:
        some = np.flatnonzero((count != 0) | total.any(axis=1))
        out.append(
            pa.RecordBatch.from_arrays(
                [pa.nulls(len(some), vec_id.type), pa.nulls(len(some), pa.binary()), pa.array(some, pa.int32()), pa.nulls(len(some), pa.binary()),
                 pa.array(count[some], pa.int64()), pa.array(total[some].tolist(), longs)],
                names=names,
            )
        )
    return out


def _first(shared, dims: int, scale: int):
    """State of vectors that are read for the first time; too wide ones have no cluster."""

    def scan(batches):
        history = shared.value
        k = len(history.centroids)
        for batch in batches:
            x, wide = scaled(batch.column("vec"), dims, scale)
            if wide.any():
                none = pa.array([None] * int(wide.sum()), pa.null())
                yield from _state(batch.column("vec_id").filter(pa.array(wide)), none, none, none)
            x, ids = x[~wide], batch.column("vec_id").filter(pa.array(~wide))
            if not len(x):
                continue
            b = measured(x, history)
            vec = [v.tobytes() for v in x.astype(np.int32)]
            yield from _state(ids, vec, b.cluster, b.pack(), *moves(x, None, b.cluster, k))

    return scan


def _next(shared, dims: int):
    """State of the next round."""

    def scan(batches):
        history = shared.value
        k = len(history.centroids)
        for batch in batches:
            live = pa.array(np.asarray(batch.column("vec").is_valid()))
            if live.false_count:
                gone = batch.filter(pc.invert(live))
                yield from _state(gone.column("vec_id"), gone.column("vec"), gone.column("cluster"), gone.column("bounds"))
            batch = batch.filter(live)
            if not batch.num_rows:
                continue
            x, b = _read(batch, dims, k)
            old = b.cluster.copy()
            reassigned(x, b, history)
            yield from _state(batch.column("vec_id"), batch.column("vec"), b.cluster, b.pack(), *moves(x, old, b.cluster, k))

    return scan


def _read(batch: pa.RecordBatch, dims: int, k: int) -> tuple[np.ndarray, Bounds]:
    x = fixed_bytes(batch.column("vec"), 4 * dims).view(np.int32).astype(np.int64)
    cluster = batch.column("cluster").to_numpy(zero_copy_only=False).astype(np.int64)
    return x, Bounds.unpack(cluster, fixed_bytes(batch.column("bounds"), 6 * (k + 1)), k)


def _last(shared, dims: int):
    """(vec_id, cluster, distance) by the last centroids, and each batch's inertia by cluster in two 31-bit halves."""

    def scan(batches):
        history = shared.value
        k = len(history.centroids)
        names = ["vec_id", "cluster", "distance", "high", "low"]
        for batch in batches:
            ids, n = batch.column("vec_id"), batch.num_rows
            live = np.asarray(batch.column("vec").is_valid())
            cluster, d2 = np.zeros(n, np.int64), np.zeros(n, np.int64)
            if live.any():
                x, b = _read(batch.filter(pa.array(live)), dims, k)
                reassigned(x, b, history)
                cluster[live], d2[live] = b.cluster, squared(x, history.centroids[b.cluster])
            none = pa.nulls(n, pa.int64())
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(cluster, pa.int32(), mask=~live), pa.array(d2, pa.int64(), mask=~live), none, none], names=names
            )
            held = np.flatnonzero(np.bincount(cluster[live], minlength=k))
            halves = [np.zeros(k, np.int64) for _ in range(2)]
            np.add.at(halves[0], cluster[live], d2[live] >> 31)
            np.add.at(halves[1], cluster[live], d2[live] & ((1 << 31) - 1))
            yield pa.RecordBatch.from_arrays(
                [pa.nulls(len(held), ids.type), pa.array(held, pa.int32()), pa.nulls(len(held), pa.int64()), *[pa.array(h[held], pa.int64()) for h in halves]],
                names=names,
            )

    return scan


def usable(col, dims: int):
    """Vectors with exactly ``dims`` components, none null or non-finite."""
    odd = F.exists(col, lambda x: x.isNull() | F.isnan(x) | (F.abs(x.cast("double")) == float("inf")))
    return F.coalesce((F.size(col) == dims) & ~odd, F.lit(False))


def cluster(
    vectors: DataFrame, k: int = 16, rounds: int = 3, dims: int = 64, scale: int = 64, seed: int = 1, id_col: str = "vec_id", vec_col: str = "embedding"
) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every usable vector after ``rounds`` updates."""
    spark = vectors.sparkSession
    sc = spark.sparkContext
    rows = vectors.select(F.col(id_col).alias("vec_id"), F.col(vec_col).alias("vec")).where(usable(F.col("vec"), dims))
    kind = rows.schema["vec_id"].dataType.simpleString()
    hashed = F.sha2(F.concat(F.lit(f"{seed}:"), F.col("vec_id").cast("string")), 256)
    fits = ~F.exists("vec", lambda x: F.abs(x.cast("double")) > float(WIDEST) / scale)
    seeds = rows.where(fits).orderBy(hashed.asc_nulls_last(), "vec").limit(k).collect()
    if not seeds:
        wide = rows.select("vec_id", F.lit(None).cast("int").alias("cluster"), *[F.lit(None).cast("long").alias(c) for c in ("distance", "cluster_inertia", "inertia")])
        return wide.withColumn("centroid_sha256", F.lit(None).cast("string"))
    start = np.floor(np.array([r["vec"] for r in seeds], np.float64) * scale).astype(np.int64)
    history, k = [start], len(start)
    state_ddl = f"vec_id {kind}, vec binary, cluster int, bounds binary, n long, sums array<long>"
    table, path = kept(rows.mapInArrow(_first(sc.broadcast(History(history)), dims, scale), state_ddl), "centroids-0")
    count, total = [0] * k, [[0] * dims for _ in range(k)]
    for at in range(1, rounds + 1):
        parts = table.where(F.col("n").isNotNull()).select("cluster", "n", F.posexplode("sums").alias("i", "part"))
        parts = parts.groupBy("cluster", "i").agg(F.sum("n").alias("n"), F.sum(F.col("part").cast("decimal(38,0)")).alias("part"))
        for r in parts.collect():  # k x dims rows
            count[r["cluster"]] += int(r["n"]) if r["i"] == 0 else 0
            total[r["cluster"]][r["i"]] += int(r["part"])
        moved = [[t // count[j] for t in total[j]] if count[j] else history[-1][j].tolist() for j in range(k)]
        history.append(np.array(moved, np.int64))
        if at < rounds:
            state = table.where(F.col("n").isNull()).mapInArrow(_next(sc.broadcast(History(history)), dims), state_ddl)
            (table, path), used = kept(state, f"centroids-{at}"), path
            deleted(spark, used)
    last = table.where(F.col("n").isNull()).mapInArrow(
        _last(sc.broadcast(History(history)), dims), f"vec_id {kind}, cluster int, distance long, high long, low long"
    )
    table = kept(last, "clusters")[0]
    deleted(spark, path)
    return _finished(table, history[-1])


def _finished(table: DataFrame, centroids: np.ndarray) -> DataFrame:
    """The vectors' rows with the figures of their clusters, a table of k rows."""
    inertia = dict.fromkeys(range(len(centroids)), 0)
    halves = [F.sum(F.col(c).cast("decimal(38,0)")).alias(c) for c in ("high", "low")]
    for r in table.where(F.col("high").isNotNull()).groupBy("cluster").agg(*halves).collect():  # k rows
        inertia[r["cluster"]] = (int(r["high"]) << 31) + int(r["low"])

    def as_long(n: int):
        return n if n < 1 << 63 else None

    figures = [
        (j, as_long(inertia[j]), as_long(sum(inertia.values())), hashlib.sha256(",".join(map(str, c.tolist())).encode()).hexdigest())
        for j, c in enumerate(centroids)
    ]
    of = table.sparkSession.createDataFrame(figures, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    rows = table.where(F.col("high").isNull()).select("vec_id", "cluster", "distance")
    return rows.join(F.broadcast(of), "cluster", "left").select("vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")


def op11_ns_bounds(spark, sf_dir):
    return cluster(read_table(spark, sf_dir, "embeddings"))


def _oracle(k: int = 16, rounds: int = 3) -> str:
    steps = [
        f"""v AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, embedding FROM embeddings
  WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
), x AS MATERIALIZED (
  SELECT r, unnest(range(64)) AS i, unnest(list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS HUGEINT))) AS x FROM v
), seeds AS MATERIALIZED (
  SELECT r, row_number() OVER (ORDER BY sha256('1:' || vec_id) NULLS LAST, embedding) - 1 AS j FROM v QUALIFY j < {k}
), c0 AS MATERIALIZED (SELECT j, i, x AS c FROM seeds JOIN x USING (r))"""
    ]
    for t in range(rounds + 1):
        steps.append(
            f"""a{t} AS MATERIALIZED (
  SELECT r, min(d * {k} + j) % {k} AS j, min(d * {k} + j) // {k} AS d
  FROM (SELECT r, j, sum((x - c) * (x - c)) AS d FROM x JOIN c{t} USING (i) GROUP BY r, j) GROUP BY r
)"""
        )
        if t < rounds:
            steps.append(
                f"""c{t + 1} AS MATERIALIZED (
  SELECT c{t}.j, c{t}.i, coalesce((s - ((s % n) + n) % n) // n, c) AS c
  FROM c{t} LEFT JOIN (SELECT j, i, sum(x) AS s, count(*) AS n FROM a{t} JOIN x USING (r) GROUP BY j, i) g ON g.j = c{t}.j AND g.i = c{t}.i
)"""
            )
    return (
        "WITH "
        + ",\n".join(steps)
        + f""",
f AS (SELECT j, sum(d) AS own FROM a{rounds} GROUP BY j),
h AS (SELECT j, sha256(string_agg(CAST(CAST(c AS BIGINT) AS VARCHAR), ',' ORDER BY i)) AS centroid_sha256 FROM c{rounds} GROUP BY j)
SELECT vec_id, CAST(j AS INTEGER) AS cluster, CAST(d AS BIGINT) AS distance, CAST(own AS BIGINT) AS cluster_inertia,
       CAST((SELECT sum(d) FROM a{rounds}) AS BIGINT) AS inertia, centroid_sha256
FROM v JOIN a{rounds} USING (r) JOIN f USING (j) JOIN h USING (j)"""
    )


ORACLE_SQL = _oracle()
