"""Exact top-k search by segment statistics at several resolutions.

A vector is cut into segments; of each only mean and deviation are known. For a segment of length L the squared distance of
two vectors is at least L ((m - m')**2 + (s - s')**2), and with |q|**2 = sum of L (m**2 + s**2) this lower bound on the distance
is the upper bound sum of L (m m' + s s') on the inner product. Bounds are taken from coarse to fine; a pair whose bound
stays below the score that the query already has in its k-th place is dropped, the rest are computed in whole numbers.

Rows lie in tiles ordered by the signs of their segment means. A query's first k scores come from its own tile. Boxes over
the statistics of a tile and of a block of queries say whether the two must meet at all.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shelfscope.llm.blocks import whole_keys
from shelfscope.session import materialize

TOP = 5
SCALE = 256
#: Rows in a tile, queries in a block.
TILE, BLOCK = 4096, 4096
#: Segments at each resolution; boxes use the middle one.
LEVELS = (2, 8, 32)
BOX = LEVELS[1]
#: Pairs looked at together, and the share of pairs above which a level takes whole rows instead of single pairs.
QUERIES_AT_ONCE, ROWS_AT_ONCE, DENSE = 256, 1024, 0.05
#: Room for rounding in a bound, relative to the terms that were added; whole scores decide.
SLACK = 1e-9


def statistics(x: np.ndarray, segments: int) -> tuple[np.ndarray, np.ndarray]:
    """(means, deviations) of the segments of each row; a vector shorter than that has empty segments, all zero."""
    means, deviations = np.zeros((len(x), segments)), np.zeros((len(x), segments))
    for i, part in enumerate(np.array_split(x, segments, axis=1)):
        if part.shape[1]:
            means[:, i], deviations[:, i] = part.mean(axis=1), part.std(axis=1)
    return means, deviations


def features(x: np.ndarray, segments: int) -> np.ndarray:
    """Rows whose products are the bounds on the inner products of the rows of x."""
    lengths = np.sqrt([part.shape[0] for part in np.array_split(np.empty(x.shape[1]), segments)])
    means, deviations = statistics(x, segments)
    return np.concatenate([means * lengths, deviations * lengths], axis=1)


def whole_scores(q: np.ndarray, v: np.ndarray) -> np.ndarray:
    """Inner products row by row, exact; values past 64 bits are the largest or smallest long."""
    size = max(1.0, np.abs(q).max(initial=0)) * max(1.0, np.abs(v).max(initial=0)) * max(1, q.shape[1])
    if size < 2**53:
        return np.einsum("ij,ij->i", q, v).astype(np.int64)
    exact = [sum(int(a) * int(b) for a, b in zip(x, y, strict=True)) for x, y in zip(q.tolist(), v.tolist(), strict=True)]
    return np.array([min(max(s, -(2**63)), 2**63 - 1) for s in exact], np.int64)


def best_products(
    q: np.ndarray, q_ids: np.ndarray, floors: np.ndarray, v: np.ndarray, v_ids: np.ndarray, top: int
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(query, row, score): for each row of q its best rows of v with another id and a score of `floors` or more."""
    found = []
    with np.errstate(over="ignore", invalid="ignore"):
        levels = [(features(q, s), features(v, s)) for s in LEVELS if s < q.shape[1]]
        q_length, v_length = np.sqrt((q * q).sum(1)), np.sqrt((v * v).sum(1))
        for low in range(0, len(q), QUERIES_AT_ONCE):
            mine = slice(low, low + QUERIES_AT_ONCE)
            ids, limit = q_ids[mine], floors[mine].copy()
            held = (np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64))
            for at in range(0, len(v), ROWS_AT_ONCE):
                rows = slice(at, at + ROWS_AT_ONCE)
                i, j = survivors([(a[mine], b[rows]) for a, b in levels], q_length[mine], v_length[rows], limit)
                other = ids[i] != v_ids[rows][j]
                i, j = i[other], j[other] + at
                score = whole_scores(q[mine][i], v[j])
                good = score >= limit[i]
                i, j, score = (np.append(a, b[good]) for a, b in zip(held, (i, j, score), strict=True))
                order = np.lexsort((v_ids[j], -score.astype(object) if (score == -(2**63)).any() else -score, i))
                i, j, score = i[order], j[order], score[order]
                place = np.arange(len(i)) - np.searchsorted(i, i)
                held = tuple(a[place < top] for a in (i, j, score))
                full = place == top - 1
                limit[i[full]] = np.maximum(limit[i[full]], score[full])
            found.append((held[0] + low, held[1], held[2]))
    return tuple(np.concatenate([f[k] for f in found]) for k in range(3))


def survivors(levels: list, q_length: np.ndarray, v_length: np.ndarray, limit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Pairs whose bounds at all levels reach the limits of their queries."""
    need = limit - 1 - SLACK * q_length * v_length.max(initial=0)
    alive, i, j = np.ones((len(q_length), len(v_length)), bool), None, None
    for a, b in levels:
        if i is None:
            # a bound that is not a number says nothing
            alive &= ~(a @ b.T < need[:, None])
            if alive.mean() <= DENSE:
                i, j = np.nonzero(alive)
        else:
            stay = ~(np.einsum("ij,ij->i", a[i], b[j]) < need[i])
            i, j = i[stay], j[stay]
    return (i, j) if i is not None else np.nonzero(alive)


def box_bound(left: str, right: str) -> tuple[Column, Column]:
    """Two columns for a row with boxes of both sides: the largest inner product, and the size of the terms in it."""
    bound, size = F.lit(0.0), F.lit(0.0)
    for s in range(BOX):
        corners = [F.col(f"{left}_{x}{s}") * F.col(f"{right}_{y}{s}") for x in ("low", "high") for y in ("low", "high")]
        length = F.floor(F.col("dim") / BOX) + (F.lit(s) < F.col("dim") % BOX).cast("int")
        spread = F.col(f"{left}_dev{s}") * F.col(f"{right}_dev{s}")
        bound = bound + length * (F.greatest(*corners) + spread)
        size = size + length * (F.greatest(*[F.abs(c) for c in corners]) + spread)
    return bound, size


def boxes(rows: DataFrame, key: str, name: str, *more: Column) -> DataFrame:
    spans = []
    for s in range(BOX):
        mean, deviation = F.col("means")[s], F.col("deviations")[s]
        spans += [F.min(mean).alias(f"{name}_low{s}"), F.max(mean).alias(f"{name}_high{s}"), F.max(deviation).alias(f"{name}_dev{s}")]
    return rows.groupBy("dim", key).agg(*spans, *more)


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


VECTOR = "dim int, vec_id long, v array<double>, asks boolean, means array<double>, deviations array<double>, shape int"


def shaped(rows: DataFrame, id_column: str, vector_column: str, asks: Column, scale: int) -> DataFrame:
    """Usable rows as whole numbers with their segment statistics."""

    def shape(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for d in np.unique(dims):
                part = batch.filter(pa.array(dims == d))
                with np.errstate(over="ignore", invalid="ignore"):
                    x = np.floor(scale * matrix(part.column("v"))) + 0.0
                    good = np.isfinite(x).all(axis=1)
                    part, x = part.filter(pa.array(good)), x[good]
                    means, deviations = statistics(x, BOX)
                    signs = np.concatenate([statistics(x, s)[0] >= 0 for s in LEVELS[:2]], axis=1)
                code = signs @ (1 << np.arange(signs.shape[1])[::-1])
                lists = [pa.FixedSizeListArray.from_arrays(m.ravel(), m.shape[1]).cast(pa.list_(pa.float64())) for m in (x, means, deviations)]
                yield pa.RecordBatch.from_arrays(
                    [part.column("dim"), part.column("vec_id"), lists[0], part.column("asks"), lists[1], lists[2], pa.array(code.astype(np.int32))],
                    ["dim", "vec_id", "v", "asks", "means", "deviations", "shape"],
                )

    rows = rows.select(
        F.col(id_column).cast("long").alias("vec_id"), F.col(vector_column).cast("array<double>").alias("v"), F.coalesce(asks, F.lit(False)).alias("asks")
    ).where("vec_id is not null and size(v) > 0").where(~F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf"))))
    return rows.select(F.size("v").alias("dim"), "vec_id", "v", "asks").mapInArrow(shape, VECTOR)


def tiled(vectors: DataFrame, tile: int, top: int) -> DataFrame:
    """Rows in tiles; a row that asks has the k-th best score in its own tile as floor, NULL if the tile has fewer others."""

    def cut(batches):
        from pyspark import TaskContext

        part, number, kept, filled, now = TaskContext.get().partitionId(), 0, [], 0, None
        for batch in batches:
            dims, at = batch.column("dim").to_numpy(), 0
            while at < len(dims):
                if filled and (filled == tile or dims[at] != now):
                    yield finished(kept, (part << 32) + number)
                    number, kept, filled = number + 1, [], 0
                now = dims[at]
                end = min(int(np.searchsorted(dims, now, "right")), at + tile - filled)
                kept.append(batch.slice(at, end - at))
                filled, at = filled + end - at, end
        if filled:
            yield finished(kept, (part << 32) + number)

    def finished(batches, number):
        rows = pa.Table.from_batches(batches).combine_chunks()
        ids, v = rows.column("vec_id").to_numpy(), matrix(rows.column("v"))
        asks = np.flatnonzero(rows.column("asks").to_numpy())
        i, _, score = best_products(v[asks], ids[asks], np.full(len(asks), -np.inf), v, ids, top) if len(asks) else ([],) * 3
        floors, known = np.zeros(len(ids)), np.ones(len(ids), bool)
        full = np.flatnonzero(np.bincount(i, minlength=len(asks)) == top) if len(asks) else []
        for k in full:
            floors[asks[k]], known[asks[k]] = score[np.searchsorted(i, k) + top - 1], False
        rows = rows.append_column("tile", pa.array(np.full(len(ids), number))).append_column("floor", pa.array(floors, mask=known))
        return rows.drop_columns("shape").to_batches()[0]

    ordered = vectors.repartitionByRange("dim", "shape", "vec_id").sortWithinPartitions("dim", "shape", "vec_id")
    return ordered.mapInArrow(cut, VECTOR.removesuffix(", shape int") + ", tile long, floor double")


def nearest_products(
    rows: DataFrame, queries: str, top: int = TOP, id_column: str = "vec_id", vector_column: str = "embedding", scale: int = SCALE,
    tile: int = TILE, block: int = BLOCK,
) -> DataFrame:
    """The `top` highest integer inner products of each row for which the condition `queries` holds: query_id, rank, vec_id, score.

    Components x count as floor(scale * x). Vectors that are NULL or empty, hold a NULL or non-finite component (also once scaled) and rows
    without id take no part; zero vectors do. Only vectors of one dimension meet. Candidates are all rows but those with the query's id; ties go to the
    smaller id; with fewer candidates all are returned, without any the query has no row. Rows that repeat an id are candidates
    each; a query that repeats an id is asked once, with its smallest vector. Scores past 64 bits are the largest or smallest
    long. Empty tables give no rows. Other columns are read only where `queries` names them.
    """
    tiles = materialize(tiled(shaped(rows, id_column, vector_column, F.expr(queries), scale), tile, top), "search-tiles")
    first = tiles.where("asks").groupBy("vec_id").agg(F.min(F.struct("dim", "v", "tile", "floor", "means", "deviations")).alias("q"))

    def place(batches):
        from pyspark import TaskContext

        part, filled = TaskContext.get().partitionId(), 0
        for batch in batches:
            places = [pa.array(np.full(batch.num_rows, part, np.int32)), pa.array(filled + np.arange(batch.num_rows))]
            filled += batch.num_rows
            yield pa.RecordBatch.from_arrays([*batch.columns, *places], [*batch.schema.names, "part", "place"])

    asked = first.select("q.dim", "q.tile", "vec_id", "q.v", "q.floor", "q.means", "q.deviations")
    asked = materialize(
        asked.repartitionByRange("dim", "tile", "vec_id").sortWithinPartitions("dim", "tile", "vec_id").mapInArrow(
            place, "dim int, tile long, vec_id long, v array<double>, floor double, means array<double>, deviations array<double>, part int, place long"
        ), "search-queries",
    )
    # blocks are full whatever the number of partitions; one count per partition reaches the driver
    before, offsets = 0, []
    for part, filled in sorted(asked.groupBy("part").count().collect()):
        offsets.append((part, before))
        before += filled
    offsets = rows.sparkSession.createDataFrame(offsets, "part int, before long")
    asked = asked.join(F.broadcast(offsets), "part").withColumn("block", F.floor((F.col("before") + F.col("place")) / block))
    bound, size = box_bound("tile", "block")
    lowest = F.min(F.coalesce("floor", F.lit(float("-inf")))).alias("floor")
    pairs = (
        boxes(tiles, "tile", "tile").join(boxes(asked, "block", "block", lowest), "dim")
        .where(~(bound + SLACK * size + 1 < F.col("floor"))).select("dim", "tile", "block", F.xxhash64("dim", "tile", "block").alias("unit"))
    )
    dealt = tiles.select("dim", "tile", "vec_id", "v").join(pairs, ["dim", "tile"]).select(
        "unit", F.lit(1).alias("side"), "vec_id", "v", F.lit(None).cast("double").alias("floor")
    ).union(asked.select("dim", "block", "vec_id", "v", "floor").join(pairs, ["dim", "block"]).select("unit", F.lit(0).alias("side"), "vec_id", "v", "floor"))

    def compare(batches):
        for table in whole_keys(batches, "unit"):
            keys = table.column("unit").to_numpy()
            for key in np.unique(keys):
                yield compare_unit(table.filter(pa.array(keys == key)).combine_chunks())

    def compare_unit(table):
        side, ids, v = table.column("side").to_numpy(), table.column("vec_id").to_numpy(), matrix(table.column("v"))
        ask, own = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        floors = table.column("floor").fill_null(float("-inf")).to_numpy()
        i, j, score = best_products(v[ask], ids[ask], floors[ask], v[own], ids[own], top)
        return pa.RecordBatch.from_arrays([pa.array(ids[ask][i]), pa.array(ids[own][j]), pa.array(score)], ["query_id", "vec_id", "score"])

    found = dealt.repartition("unit").sortWithinPartitions("unit").mapInArrow(compare, "query_id long, vec_id long, score long")
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), F.asc("vec_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top).select("query_id", "rank", "vec_id", "score")
