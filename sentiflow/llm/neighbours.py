"""Approximate nearest neighbours over learned partitions.

A bounded sample of distinct vectors gives a neighbour graph. The graph is cut into equally large parts:
median splits along main directions start, then pairs of vertices swap parts while more graph edges
come to lie inside parts. A small network with one hidden layer learns, from a vector, how its graph
neighbours spread over the parts. Every vector is indexed under its most probable part; a query goes to its
most probable parts, and what they hold is ranked by exact distance. How many parts that is, the data tell:
as many as give a recall of ``RECALL`` for sample vectors that the fit did not see. Vectors without any
structure need most of the parts; clustered ones a few.

Scale: the model is fitted on at most ``SAMPLE`` vectors and holds at most ``PARTS`` parts, so its broadcast
is bounded. All rows are indexed. A part is dealt out in cells of about ``CELL`` rows and its queries in
groups of about ``CELL_QUERIES``, so a part that holds a third of all rows is many tasks; each cell returns its best
``k`` a query.

Defined results: vectors that are null, zero, of another length than most (the shorter of equals), or
hold a null or a non-finite component take no part, nor do rows without an id; equal distances rank the smaller id first;
a query with fewer than ``k`` other rows gets them all; an empty table gives no rows; other columns are
not read. The usual length is that of the searched table. Query rows are ranked each for itself, also those that share an id;
of the table one row that equals the query in id and vector is left out as its own, other rows of its id are candidates.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sentiflow.llm.common import read_table, written

SAMPLE = 4096
NEIGHBOURS = 10
PARTS = 32
#: A query goes to as many parts as gave this recall on HELD sample vectors that the fit did not see.
RECALL = 0.95
HELD = 256
HIDDEN = 128
EPOCHS = 60
CELL = 4096
CELL_QUERIES = 1024


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """(n, k) nearest other rows."""
    out = []
    norms = (x * x).sum(axis=1)
    for start in range(0, len(x), 512):
        block = x[start : start + 512]
        far = norms[None] - 2 * block @ x.T
        far[np.arange(len(block)), start + np.arange(len(block))] = np.inf
        out.append(np.argpartition(far, k - 1, axis=1)[:, :k] if k < len(x) - 1 else np.argsort(far, axis=1)[:, :k])
    return np.concatenate(out)


def median_parts(x: np.ndarray, parts: int) -> np.ndarray:
    """Equal parts by repeated halving along the direction of largest spread."""
    label = np.zeros(len(x), np.int64)

    def split(rows, low, many):
        if many == 1:
            label[rows] = low
            return
        own = x[rows] - x[rows].mean(axis=0)
        _, axes = np.linalg.eigh(own.T @ own)
        order = np.argsort(own @ axes[:, -1], kind="stable")
        left = many // 2
        cut = len(rows) * left // many
        split(rows[order[:cut]], low, left)
        split(rows[order[cut:]], low + left, many - left)

    split(np.arange(len(x)), 0, parts)
    return label


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 20) -> np.ndarray:
    """Equal parts with few graph edges between them: vertices of two parts swap while that gains edges."""
    label = median_parts(x, parts)
    n = len(x)
    for _ in range(rounds):
        inside = np.zeros((n, parts))
        for column in graph.T:
            inside[np.arange(n), label[column]] += 1
            np.add.at(inside, (column, label), 1)  # edges count both ways
        gain = inside - inside[np.arange(n), label][:, None]
        gain[np.arange(n), label] = -np.inf
        wish = gain.argmax(axis=1)
        best = gain[np.arange(n), wish]
        moved = 0
        for a in range(parts):
            for b in range(a + 1, parts):
                there = np.flatnonzero((label == a) & (wish == b))
                back = np.flatnonzero((label == b) & (wish == a))
                there, back = there[np.argsort(-best[there], kind="stable")], back[np.argsort(-best[back], kind="stable")]
                m = min(len(there), len(back))
                m = int((best[there[:m]] + best[back[:m]] > 0).sum())
                label[there[:m]], label[back[:m]] = b, a
                moved += m
        if not moved:
            break
    return label


class Router:
    """Probabilities of the parts for a vector: one hidden layer, trained on where graph neighbours lie."""

    def __init__(self, x: np.ndarray, target: np.ndarray, epochs: int = EPOCHS):
        rng = np.random.default_rng(7)
        self.mean, self.spread = x.mean(axis=0), x.std() + 1e-12
        d, parts = x.shape[1], target.shape[1]
        self.weights = [
            rng.normal(0, np.sqrt(2 / d), (d, HIDDEN)), np.zeros(HIDDEN),
            rng.normal(0, np.sqrt(1 / HIDDEN), (HIDDEN, parts)), np.zeros(parts),
        ]
        z = (x - self.mean) / self.spread
        first = [np.zeros_like(w) for w in self.weights]
        second = [np.zeros_like(w) for w in self.weights]
        step = 0
        for _ in range(epochs):
            order = rng.permutation(len(z))
            for start in range(0, len(z), 128):
                rows = order[start : start + 128]
                a = z[rows]
                hidden = np.maximum(a @ self.weights[0] + self.weights[1], 0)
                p = softmax(hidden @ self.weights[2] + self.weights[3])
                out = (p - target[rows]) / len(rows)
                back = (out @ self.weights[2].T) * (hidden > 0)
                step += 1
                for i, g in enumerate((a.T @ back, back.sum(axis=0), hidden.T @ out, out.sum(axis=0))):
                    first[i] = 0.9 * first[i] + 0.1 * g
                    second[i] = 0.999 * second[i] + 0.001 * g * g
                    rate = 0.003 * np.sqrt(1 - 0.999**step) / (1 - 0.9**step)
                    self.weights[i] = self.weights[i] - rate * first[i] / (np.sqrt(second[i]) + 1e-8)

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        hidden = np.maximum((x - self.mean) / self.spread @ self.weights[0] + self.weights[1], 0)
        return softmax(hidden @ self.weights[2] + self.weights[3])


def softmax(x: np.ndarray) -> np.ndarray:
    x = np.exp(x - x.max(axis=1, keepdims=True))
    return x / x.sum(axis=1, keepdims=True)


def fit_router(x: np.ndarray, parts: int, neighbours: int = NEIGHBOURS, recall: float = RECALL) -> Router:
    """A router of ``parts`` parts; its ``routed`` is the number of parts that reach ``recall`` on held-out vectors."""
    held, x = x[: min(HELD, len(x) // 4)], x[min(HELD, len(x) // 4) :]
    graph = neighbour_graph(x, min(neighbours, len(x) - 1))
    label = balanced_parts(x, graph, parts)
    target = np.zeros((len(x), parts))
    rows = np.arange(len(x))
    target[rows, label] += 1
    for column in graph.T:
        target[rows, label[column]] += 1
    router = Router(x, target / target.sum(axis=1, keepdims=True))
    far = (x * x).sum(axis=1)[None] - 2 * held @ x.T
    near = np.argsort(far, axis=1, kind="stable")[:, :neighbours]
    part = router.probabilities(x).argmax(axis=1)
    place = np.argsort(np.argsort(-router.probabilities(held), axis=1, kind="stable"), axis=1)
    needed = np.take_along_axis(place, part[near], axis=1)
    router.routed = next(m for m in range(1, parts + 1) if (needed < m).mean() >= recall or m == parts)
    return router


def usable(vectors: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(vec_id, vector array<double>) of the rows that may take part, of any length."""
    rows = vectors.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("vector"))
    finite = F.forall("vector", lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) < float("inf")))
    return rows.where(F.col("vec_id").isNotNull() & F.coalesce(finite & F.exists("vector", lambda v: v != 0), F.lit(False)))


def usual_length(rows: DataFrame) -> int:
    """The length of most vectors, the shorter of equals; 0 without vectors."""
    size = rows.groupBy(F.size("vector").alias("size")).count().orderBy(F.desc("count"), "size").first()
    return size["size"] if size else 0


def matrix(column: pa.Array) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def search(
    vectors: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding",
    sample: int = SAMPLE, parts: int = PARTS, recall: float = RECALL,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the ``k`` nearest found rows of each query, by Euclidean distance, itself left out."""
    spark = vectors.sparkSession
    rows = usable(vectors, id_col, vector_col)
    length = F.size("vector") == usual_length(rows)  # queries are held to the length of the table
    rows, asked = rows.where(length), usable(queries, id_col, vector_col).where(length)
    distinct = rows.select("vector").distinct().orderBy(F.xxhash64("vector"), "vector").limit(sample).toArrow()
    x = matrix(distinct.column("vector").combine_chunks()) if distinct.num_rows else np.zeros((0, 1))
    parts = max(1, min(parts, len(x) // 32))
    router = spark.sparkContext.broadcast(fit_router(x, parts, recall=recall) if parts > 1 else None)

    def place(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            own = np.zeros(batch.num_rows, np.int32)
            if router.value is not None:
                own = router.value.probabilities(matrix(batch.column("vector"))).argmax(axis=1).astype(np.int32)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(own)], names=["vec_id", "vector", "part"])

    indexed = written(rows.mapInArrow(place, "vec_id long, vector array<double>, part int"), "indexed")
    sizes = {r["part"]: r["count"] for r in indexed.groupBy("part").count().collect()}
    held = np.array([sizes.get(p, 0) for p in range(parts)])

    def route(batches):
        for batch in batches:
            if not batch.num_rows:
                continue
            chosen = [[0]] * batch.num_rows
            if router.value is not None:
                order = np.argsort(-router.value.probabilities(matrix(batch.column("vector"))), axis=1, kind="stable")
                filled = np.cumsum(held[order], axis=1)
                # the most probable parts, and on until they hold k rows besides the query
                many = np.minimum(np.maximum(router.value.routed, (filled < k + 1).sum(axis=1) + 1), parts)
                chosen = [o[:m].tolist() for o, m in zip(order, many)]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(chosen, pa.list_(pa.int32()))], names=["vec_id", "vector", "row", "parts"]
            )

    # query rows are numbered once, as they are written: rows that share an id are ranked apart
    asked = asked.withColumn("row", F.monotonically_increasing_id())
    routes = asked.mapInArrow(route, "vec_id long, vector array<double>, row long, parts array<int>")
    routes = written(routes.select("row", "vec_id", "vector", F.explode("parts").alias("part")), "routes")
    cells = indexed.groupBy("part").agg(F.ceil(F.count("*") / CELL).cast("int").alias("cells"))
    groups = routes.groupBy("part").agg(F.ceil(F.count("*") / CELL_QUERIES).cast("int").alias("groups"))
    deal = cells.join(groups, "part")
    cell = F.pmod(F.xxhash64("vec_id"), F.col("cells")).cast("int")
    group = F.pmod(F.xxhash64("vec_id"), F.col("groups")).cast("int")
    candidates = indexed.join(deal, "part").select(
        "part", cell.alias("cell"), F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("group"), "vec_id", "vector"
    )
    questions = routes.join(deal, "part").select(
        "part", F.explode(F.sequence(F.lit(0), F.col("cells") - 1)).alias("cell"), group.alias("group"), "row", "vec_id", "vector"
    )

    def nearest(own: pa.Table, asked: pa.Table) -> pa.Table:
        out = [], [], [], []
        if own.num_rows and asked.num_rows:
            ids = own.column("vec_id").to_numpy()
            points = matrix(own.column("vector").combine_chunks())
            rows = asked.column("row").to_numpy()
            for row, query, vector in zip(rows, asked.column("vec_id").to_numpy(), matrix(asked.column("vector").combine_chunks())):
                far = np.sqrt(((points - vector) ** 2).sum(axis=1))
                itself = np.flatnonzero((ids == query) & (points == vector).all(axis=1))[:1]  # equal rows lie in one cell
                far[itself] = np.inf
                best = np.lexsort((ids, far))[: k + 1]
                best = best[~np.isin(best, itself)][:k]
                out[0].append(np.full(len(best), row))
                out[1].append(np.full(len(best), query))
                out[2].append(ids[best])
                out[3].append(far[best])
        kinds = pa.int64(), pa.int64(), pa.int64(), pa.float64()
        columns = [pa.array(np.concatenate(c) if c else [], t) for c, t in zip(out, kinds)]
        return pa.Table.from_arrays(columns, names=["row", "query_id", "vec_id", "score"])

    keys = ["part", "cell", "group"]
    found = candidates.groupBy(*keys).cogroup(questions.groupBy(*keys)).applyInArrow(nearest, "row long, query_id long, vec_id long, score double")
    order = Window.partitionBy("row").orderBy("score", "vec_id")
    ranked = found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
    return ranked.select("query_id", "rank", "vec_id", "score")


def op7_learned_partitions(spark, sf_dir):
    vectors = read_table(spark, sf_dir, "embeddings")
    return search(vectors, vectors.where(F.col("vec_id") % 100 == 0))
