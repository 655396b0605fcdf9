"""Nearest neighbours by learned partitions.

From a bounded sample of vectors: link each one to its nearest in the sample, cut this graph into parts of equal size
with few links between parts, and train a small classifier that tells from a vector in which parts its neighbours lie.
Every vector of the table is then filed under its most probable part, and a query is compared with all vectors in its
most probable parts.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfscope.llm.blocks import whole_keys
from shelfscope.llm.vector_dedup import clean_vectors, matrix
from shelfscope.session import materialize

#: Vectors that the index is fitted on at most: the first ones by a hash of their id.
FIT_ROWS = 8192
PARTS = 32
NEIGHBOURS = 16
HIDDEN = 128
EPOCHS = 25
#: A query is compared with as many of its most probable parts as hold a mass of probability together. The mass is the
#: least one that reaches this recall for sample rows that the classifier was not trained on.
RECALL = 0.95
MASSES = (0.3, 0.4, 0.5, 0.6, 0.7, 0.75, 0.8, 0.85, 0.9, 0.925, 0.95, 0.965, 0.98, 0.99, 1.0)
LEAST_PARTS = 2
#: Dimensions with fewer sample rows are searched whole.
LEAST_FIT = 512
TOP = 20
BLOCK_ROWS = 4096
BLOCK_QUERIES = 1024


def neighbour_graph(x: np.ndarray, k: int) -> np.ndarray:
    """The k rows with the largest inner product for each row, itself left out."""
    k = min(k, len(x) - 1)
    out = np.empty((len(x), k), np.int64)
    for at in range(0, len(x), 1024):
        scores = x[at : at + 1024] @ x.T
        scores[np.arange(len(scores)), np.arange(at, at + len(scores))] = -np.inf
        out[at : at + 1024] = np.argpartition(-scores, k - 1, axis=1)[:, :k] if k else 0
    return out


def balanced_parts(x: np.ndarray, graph: np.ndarray, parts: int, rounds: int = 12, room: float = 1.05) -> np.ndarray:
    """A part for every row: halved along principal directions at first, then rows move to where most of their links go.

    No part grows beyond `room` times the mean, so the parts stay balanced.
    """
    part = np.zeros(len(x), np.int64)
    width = 1
    while width < parts:
        new = part * 2
        for p in range(width):
            at = np.flatnonzero(part == p)
            if len(at) > 1:
                y = x[at] - x[at].mean(0)
                axis = np.linalg.eigh(y.T @ y)[1][:, -1]
                new[at[np.argsort(y @ axis, kind="stable")[len(at) // 2 :]]] += 1
        part, width = new, width * 2
    most = int(np.ceil(room * len(x) / parts))
    size = np.bincount(part, minlength=parts)
    rows = np.repeat(np.arange(len(x)), graph.shape[1])
    ends = graph.ravel()
    for _ in range(rounds):
        votes = np.zeros((len(x), parts))
        np.add.at(votes, (rows, part[ends]), 1)
        np.add.at(votes, (ends, part[rows]), 1)
        gain = votes.max(1) - votes[np.arange(len(x)), part]
        moved = 0
        for i in np.argsort(-gain, kind="stable")[: int((gain > 0).sum())]:
            for p in np.argsort(-votes[i])[:3]:
                if votes[i, p] > votes[i, part[i]] and size[p] < most:
                    size[part[i]] -= 1
                    size[p] += 1
                    part[i] = p
                    moved += 1
                    break
        if not moved:
            break
    return part


@dataclass
class Router:
    """A classifier with one hidden layer."""

    w1: np.ndarray
    b1: np.ndarray
    w2: np.ndarray
    b2: np.ndarray

    def probabilities(self, x: np.ndarray) -> np.ndarray:
        z = np.maximum(x @ self.w1 + self.b1, 0) @ self.w2 + self.b2
        z = np.exp(z - z.max(1, keepdims=True))
        return z / z.sum(1, keepdims=True)


def train_router(x: np.ndarray, target: np.ndarray, hidden: int = HIDDEN, epochs: int = EPOCHS, seed: int = 3) -> Router:
    """Cross entropy against the shares of each row's links by part, by Adam steps on small batches."""
    random = np.random.default_rng(seed)
    d, parts = x.shape[1], target.shape[1]
    p = [random.normal(0, (2 / d) ** 0.5, (d, hidden)), np.zeros(hidden), random.normal(0, (1 / hidden) ** 0.5, (hidden, parts)), np.zeros(parts)]
    m, v, t = [np.zeros_like(a) for a in p], [np.zeros_like(a) for a in p], 0
    for epoch in range(epochs):
        rate = 0.004 * (1 - epoch / epochs) + 1e-4
        order = random.permutation(len(x))
        for at in range(0, len(x), 256):
            rows = order[at : at + 256]
            a = x[rows]
            h = np.maximum(a @ p[0] + p[1], 0)
            z = h @ p[2] + p[3]
            z = np.exp(z - z.max(1, keepdims=True))
            dz = (z / z.sum(1, keepdims=True) - target[rows]) / len(rows)
            dh = (dz @ p[2].T) * (h > 0)
            t += 1
            for i, g in enumerate((a.T @ dh, dh.sum(0), h.T @ dz, dz.sum(0))):
                m[i] = 0.9 * m[i] + 0.1 * g
                v[i] = 0.999 * v[i] + 0.001 * g * g
                p[i] = p[i] - rate * (m[i] / (1 - 0.9**t)) / (np.sqrt(v[i] / (1 - 0.999**t)) + 1e-8)
    return Router(*p)


def probes(p: np.ndarray, mass: float, rows: np.ndarray, wanted: int) -> tuple[np.ndarray, np.ndarray]:
    """(row of p, part): the most probable parts up to the mass, and on until `wanted` vectors are in them.

    rows: the number of vectors in each part.
    """
    order = np.argsort(-p, axis=1, kind="stable")
    before = np.cumsum(np.take_along_axis(p, order, 1), 1) - np.take_along_axis(p, order, 1)
    held = np.cumsum(rows[order], 1) - rows[order]
    take = (before < mass - 1e-12) | (held < wanted) | (np.arange(p.shape[1]) < LEAST_PARTS)
    i, k = np.nonzero(take)
    return i, order[i, k]


def fit_router(x: np.ndarray, parts: int = PARTS) -> tuple[Router, float]:
    """Graph, partition and classifier from sample vectors, and the mass of probability that queries need."""
    test = np.arange(len(x)) % 8 == 7
    train = x[~test]
    graph = neighbour_graph(train, NEIGHBOURS)
    part = balanced_parts(train, graph, parts)
    target = np.zeros((len(train), parts))
    np.add.at(target, (np.repeat(np.arange(len(train)), graph.shape[1]), part[graph.ravel()]), 1.0)
    target[np.arange(len(train)), part] += 1
    scale = x.shape[1] ** 0.5 / max(float(np.sqrt((train**2).sum(1)).mean()), 1e-300)
    router = train_router(train * scale, target / target.sum(1, keepdims=True))
    router.w1 *= scale
    filed = router.probabilities(train).argmax(1)
    p = router.probabilities(x[test])
    nearest = np.argsort(-(x[test] @ train.T), axis=1)[:, :NEIGHBOURS]
    for mass in MASSES:
        i, k = probes(p, mass, np.bincount(filed, minlength=parts), 1)
        probed = np.zeros(p.shape, bool)
        probed[i, k] = True
        if np.take_along_axis(probed, filed[nearest], 1).mean() >= RECALL:
            return router, mass
    return router, 1.0


def nearest_vectors(
    rows: DataFrame, is_query: str, id_column: str = "vec_id", vector_column: str = "embedding", top: int = TOP,
    fit_rows: int = FIT_ROWS, parts: int = PARTS, block_rows: int = BLOCK_ROWS, block_queries: int = BLOCK_QUERIES,
) -> DataFrame:
    """(query_id, rank, vec_id, score): the `top` largest inner products found for the rows with SQL condition `is_query` on vec_id.

    A query meets every vector but its own id's in its parts, at least `top` of them if there are as many. Unusable vectors (NULL, empty,
    zero, a NULL or non-finite component) and rows without id take no part; of rows that repeat an id the smallest
    vector counts. Vectors of other dimensions are no candidates. Ties go to the smaller id. Parts are cut into
    blocks of rows and of queries, so hot parts are many tasks.
    """
    spark = rows.sparkSession
    vectors = materialize(
        clean_vectors(rows, id_column, vector_column).groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dim", F.size("v")), "vectors"
    )
    sample: dict[int, list] = {}
    for r in vectors.orderBy(F.xxhash64("vec_id"), "vec_id").limit(fit_rows).collect():
        sample.setdefault(r["dim"], []).append(r["v"])
    routers = spark.sparkContext.broadcast({d: fit_router(np.array(x), parts) for d, x in sample.items() if len(x) >= LEAST_FIT})

    def file(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            part = np.zeros(len(dims), np.int32)
            for d in np.unique(dims):
                if d in routers.value:
                    part[dims == d] = routers.value[d][0].probabilities(matrix(batch.column("v").filter(pa.array(dims == d)))).argmax(1)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(part)], [*batch.schema.names, "part"])

    index = materialize(vectors.mapInArrow(file, "vec_id long, v array<double>, dim int, part int"), "vector-index")
    held: dict[int, np.ndarray] = {}
    for r in index.groupBy("dim", "part").count().collect():  # dimensions * parts rows
        held.setdefault(r["dim"], np.zeros(parts, np.int64))[r["part"]] = r["count"]
    sizes = spark.sparkContext.broadcast(held)

    def route(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            at, part = [], []
            for d in np.unique(dims):
                own = np.flatnonzero(dims == d)
                i, k = np.arange(len(own)), np.zeros(len(own), np.int64)
                if d in routers.value:
                    router, mass = routers.value[d]
                    p = router.probabilities(matrix(batch.column("v").take(pa.array(own))))
                    i, k = probes(p, mass, sizes.value[d], top + 1)
                at.append(own[i])
                part.append(k)
            at, part = np.concatenate([*at, np.empty(0, np.int64)]), np.concatenate([*part, np.empty(0, np.int64)])
            yield pa.RecordBatch.from_arrays([*batch.take(pa.array(at)).columns, pa.array(part.astype(np.int32))], [*batch.schema.names, "part"])

    queries = materialize(
        vectors.where(is_query).mapInArrow(route, "vec_id long, v array<double>, dim int, part int"), "vector-queries"
    )
    per_part = (
        index.groupBy("dim", "part").agg(F.ceil(F.count("*") / block_rows).cast("int").alias("n_rows"))
        .join(queries.groupBy("dim", "part").agg(F.ceil(F.count("*") / block_queries).cast("int").alias("n_queries")), ["dim", "part"])
    )

    def dealt(side: DataFrame, own: str, other: str, number: int) -> DataFrame:
        block = F.pmod(F.xxhash64("vec_id"), F.col(own)).cast("int")
        all_blocks = F.explode(F.sequence(F.lit(0), F.col(other) - 1))
        pair = (block, all_blocks) if number == 0 else (all_blocks, block)
        return (
            side.join(F.broadcast(per_part), ["dim", "part"])
            .select("vec_id", "v", "dim", "part", pair[0].alias("x"), pair[1].alias("y"), F.lit(number).alias("side"))
            .select(F.xxhash64("dim", "part", "x", "y").alias("unit"), "side", "vec_id", "v")
        )

    def compare(batches):
        for table in whole_keys(batches, "unit"):
            keys = table.column("unit").to_numpy()
            for key in np.unique(keys):
                yield from compare_unit(table.filter(pa.array(keys == key)))

    def compare_unit(table):
        side, ids, v = table.column("side").to_numpy(), table.column("vec_id").to_numpy(), matrix(table.column("v"))
        x, x_ids, q, q_ids = v[side == 0], ids[side == 0], v[side == 1], ids[side == 1]
        if not len(x) or not len(q):
            return
        scores = q @ x.T
        k = min(top + 1, len(x))
        least = np.partition(scores, len(x) - k, axis=1)[:, len(x) - k]
        slack = 1e-9 * np.sqrt((q**2).sum(1)) * np.sqrt((x**2).sum(1).max())
        i, j = np.nonzero(scores >= (least - slack)[:, None])
        other = q_ids[i] != x_ids[j]
        i, j = i[other], j[other]
        exact = np.einsum("ij,ij->i", q[i], x[j])
        order = np.lexsort((x_ids[j], -exact, i))
        i, j, exact = i[order], j[order], exact[order]
        first = np.searchsorted(i, i, "left")
        good = np.arange(len(i)) - first < top
        yield pa.RecordBatch.from_arrays(
            [pa.array(q_ids[i[good]]), pa.array(x_ids[j[good]]), pa.array(exact[good])], ["query_id", "vec_id", "score"]
        )

    found = (
        dealt(index, "n_rows", "n_queries", 0).union(dealt(queries, "n_queries", "n_rows", 1))
        .repartition("unit").sortWithinPartitions("unit").mapInArrow(compare, "query_id long, vec_id long, score double")
    )
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.col("score").desc(), "vec_id"))
    return found.withColumn("rank", rank).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
