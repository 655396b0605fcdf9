"""Embedding near-dedup: PCA-ordered tiled comparison, exact.

Vectors are scaled to length one and turned into the principal axes of all of them, so that the leading coordinates
carry most of the length. Those of one group (label and dimension) are cut into tiles along the first axis; every pair of
tiles that can hold a link is one unit of work. In a unit, products of the leading coordinates are summed first; what
the rest can add is at most the product of the suffix norms, and a pair is dropped as soon as sum and bound stay under
the threshold. Survivors are decided by the cosine of the original vectors in double precision.

Equal vectors are one row with a count. A unit returns at most two rows per vector (how many it links to, and its
root inside the unit), never its pairs.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscope.llm.blocks import whole_keys
from shelfscope.llm.components import components
from shelfscope.session import materialize

THRESHOLD = 0.93
TILE = 2048
#: Coordinates summed before each check of the bound.
STEPS = (16, 32)
#: Room for rounding in the bound; the exact cosine decides.
SLACK = 1e-9


def clean_vectors(rows: DataFrame, id_column: str, vector_column: str, *keep: str) -> DataFrame:
    """(vec_id, v, *keep): rows with an id and a vector that is not NULL, empty or zero and has finite components only."""
    vector = F.col(vector_column).cast("array<double>")
    bad = F.exists("v", lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return (
        rows.select(F.col(id_column).cast("long").alias("vec_id"), vector.alias("v"), *keep)
        .where("vec_id is not null and v is not null").where(~bad & F.exists("v", lambda x: x != 0))
    )


def matrix(column: pa.ChunkedArray | pa.Array) -> np.ndarray:
    """Vectors of one dimension as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def unit(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(1, keepdims=True)
    return x / np.sqrt(np.einsum("ij,ij->i", x, x))[:, None]


def cosines(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Row by row, the same for equal vectors wherever they stand."""
    return np.einsum("ij,ij->i", x, y) / (np.sqrt(np.einsum("ij,ij->i", x, x)) * np.sqrt(np.einsum("ij,ij->i", y, y)))


def principal_axes(vectors: DataFrame) -> dict[int, np.ndarray]:
    """For every dimension that occurs, the principal axes of all unit vectors, strongest first.

    Tasks send sums of products; a table of dimension squared numbers per dimension reaches the driver.
    """

    def moments(batches):
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            for d in np.unique(dims):
                u = unit(matrix(batch.column("v").filter(pa.array(dims == d))))
                sums[d] = sums.get(d, 0) + u.T @ u
        for d, s in sums.items():
            for i, row in enumerate(s):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.full(d, d, np.int32)), pa.array(np.full(d, i, np.int32)), pa.array(np.arange(d, dtype=np.int32)), pa.array(row)],
                    ["dim", "i", "j", "s"],
                )

    rows = vectors.select("dim", "v").mapInArrow(moments, "dim int, i int, j int, s double")
    sums: dict[int, np.ndarray] = {}
    for d, i, j, s in rows.groupBy("dim", "i", "j").agg(F.sum("s")).collect():
        sums.setdefault(d, np.zeros((d, d)))[i, j] = s
    return {d: np.linalg.eigh((s + s.T) / 2)[1][:, ::-1] for d, s in sums.items()}


def linked_pairs(x: np.ndarray, y: np.ndarray, threshold: float) -> tuple[np.ndarray, np.ndarray]:
    """Indices of rows of x and y (unit vectors in principal axes) whose product may reach the threshold."""
    limit, d = threshold - SLACK, x.shape[1]
    cuts = [c for c in STEPS if c < d] + [d]

    def suffix(z: np.ndarray, c: int) -> np.ndarray:
        return np.sqrt(np.maximum(np.einsum("ij,ij->i", z[:, c:], z[:, c:]), 0))

    part = x[:, : cuts[0]] @ y[:, : cuts[0]].T
    i, j = np.nonzero(part + np.outer(suffix(x, cuts[0]), suffix(y, cuts[0])) >= limit)
    total = part[i, j]
    for low, high in zip(cuts, cuts[1:], strict=False):
        total = total + np.einsum("ij,ij->i", x[i, low:high], y[j, low:high])
        stay = total + suffix(x, high)[i] * suffix(y, high)[j] >= limit
        i, j, total = i[stay], j[stay], total[stay]
    return i, j


def near_vectors(
    rows: DataFrame, id_column: str = "vec_id", vector_column: str = "embedding", label_column: str = "label",
    threshold: float = THRESHOLD, tile: int = TILE,
) -> DataFrame:
    """One row per row of `rows`: vec_id, n_links, component_id, kept.

    Rows link if their labels are equal and not NULL, their vectors have the same dimension and a cosine of `threshold` (> 0) or more.
    n_links counts other rows, copies included. Rows without label, with an unusable vector (NULL, empty, zero, a NULL or non-finite
    component) link with nothing. component_id is the smallest id that links lead to. A row without id links nothing
    and has no component. Rows that repeat an id count each as a row of its own.
    """
    vectors = clean_vectors(rows, id_column, vector_column, F.col(label_column).alias("label")).where("label is not null")
    vectors = vectors.withColumn("dim", F.size("v"))
    # one row per different vector; -0.0 and 0.0 are the same number
    vectors = vectors.withColumn("v", F.transform("v", lambda x: x + F.lit(0.0)))
    vectors = vectors.withColumn("same", F.sha2(F.array_join(F.col("v").cast("array<string>"), ","), 256))
    members = materialize(vectors.select("vec_id", "label", "dim", "same", "v"), "vectors")
    one = (
        members.groupBy("label", "dim", "same").agg(F.min(F.struct("vec_id", "v")).alias("m"), F.count("*").alias("copies"))
        .select("label", "dim", "same", "m.vec_id", "m.v", "copies")
    )
    axes = rows.sparkSession.sparkContext.broadcast(principal_axes(members))

    def cut(batches):
        """Rows come in order of label, dimension and first coordinate; a tile ends with its label or when it is full."""
        from pyspark import TaskContext

        part = TaskContext.get().partitionId()
        number, filled, now = 0, 0, None
        for batch in batches:
            numbers = []
            for group in zip(batch.column("label").to_pylist(), batch.column("dim").to_pylist(), strict=True):
                if group != now or filled == tile:
                    number, filled, now = number + 1, 0, group
                filled += 1
                numbers.append((part << 32) + number)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(numbers, pa.int64())], [*batch.schema.names, "tile"])

    def turn(batches):
        for batch in batches:
            dims = batch.column("dim").to_numpy()
            turned = np.empty(batch.num_rows, object)
            for d in np.unique(dims):
                at = np.flatnonzero(dims == d)
                turned[at] = list(unit(matrix(batch.column("v").filter(pa.array(dims == d)))) @ axes.value[d])
            columns = [*batch.columns, pa.array(list(turned), pa.list_(pa.float64())), pa.array([t[0] for t in turned], pa.float64())]
            yield pa.RecordBatch.from_arrays(columns, [*batch.schema.names, "u", "lead"])

    schema = "label string, dim int, same string, vec_id long, v array<double>, copies long, u array<double>, lead double"
    turned = one.withColumn("label", F.col("label").cast("string")).mapInArrow(turn, schema)
    tiles = materialize(
        turned.repartitionByRange("label", "dim", "lead", "vec_id").sortWithinPartitions("label", "dim", "lead", "vec_id")
        .mapInArrow(cut, schema + ", tile long"), "tiles",
    )
    spans = tiles.groupBy("label", "dim", "tile").agg(F.min("lead").alias("low"), F.max("lead").alias("high"))
    other = spans.select("label", "dim", F.col("tile").alias("other"), F.col("low").alias("other_low"), F.col("high").alias("other_high"))
    # |x1 - y1| <= |x - y| = sqrt(2 - 2 cosine)
    reach = max(2 - 2 * threshold, 0.0) ** 0.5 + SLACK
    pairs = (
        spans.join(other, ["label", "dim"])
        .where((F.col("tile") <= F.col("other")) & (F.col("other_low") - F.col("high") <= reach) & (F.col("low") - F.col("other_high") <= reach))
        .select("tile", "other", F.xxhash64("tile", "other").alias("unit"))
    )
    dealt = pairs.select("tile", "unit", F.lit(0).alias("side")).union(
        pairs.where("tile <> other").select(F.col("other").alias("tile"), "unit", F.lit(1).alias("side"))
    )

    def compare(batches):
        for table in whole_keys(batches, "unit"):
            keys = table.column("unit").to_numpy()
            for key in np.unique(keys):
                yield from compare_tiles(table.filter(pa.array(keys == key)))

    def compare_tiles(table):
        side = table.column("side").to_numpy()
        ids, copies = table.column("vec_id").to_numpy(), table.column("copies").to_numpy()
        u, v = matrix(table.column("u")), matrix(table.column("v"))
        left, right = np.flatnonzero(side == 0), np.flatnonzero(side == 1)
        alone = not len(right)
        right = left if alone else right
        i, j = linked_pairs(u[left], u[right], threshold)
        i, j = left[i], right[j]
        if alone:
            i, j = i[i < j], j[i < j]
        good = cosines(v[i], v[j]) >= threshold
        i, j = i[good], j[good]
        if not len(i):
            return
        links = np.bincount(i, copies[j], len(ids)) + np.bincount(j, copies[i], len(ids))
        root = np.arange(len(ids))
        while True:  # smallest index over links, with pointer jumping
            new = root.copy()
            np.minimum.at(new, i, root[j])
            np.minimum.at(new, j, root[i])
            new = new[new]
            if (new == root).all():
                break
            root = new
        at = np.flatnonzero(links)
        yield pa.RecordBatch.from_arrays(
            [pa.array(ids[at]), pa.array(links[at].astype(np.int64)), pa.array(ids[root[at]])], ["vec_id", "links", "root"]
        )

    found = materialize(
        tiles.select("tile", "vec_id", "copies", "u", "v").join(dealt, "tile").select("unit", "side", "vec_id", "copies", "u", "v")
        .repartition("unit").sortWithinPartitions("unit").mapInArrow(compare, "vec_id long, links long, root long"), "vector-links",
    )
    links = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    roots = components(found, "vec_id", "root")
    by_copy = (
        tiles.select("label", "dim", "same", "copies", F.col("vec_id").alias("first_id"))
        .join(links.withColumnRenamed("vec_id", "first_id"), "first_id", "left").join(roots.withColumnRenamed("id", "first_id"), "first_id", "left")
        .select("label", "dim", "same", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n"), F.coalesce("component", "first_id").alias("c"))
    )
    per_row = members.select("vec_id", F.col("label").cast("string").alias("label"), "dim", "same").join(by_copy, ["label", "dim", "same"])
    # rows that repeat an id: each has its own links, the id has the smallest component
    per_id = per_row.groupBy("vec_id").agg(F.max("n").alias("n"), F.min("c").alias("c"))
    return (
        rows.select(F.col(id_column).cast("long").alias("vec_id")).join(per_id, "vec_id", "left")
        .select("vec_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_links"), F.coalesce("c", "vec_id").alias("component_id"))
        .withColumn("kept", F.coalesce(F.col("vec_id") == F.col("component_id"), F.lit(False)))
    )
