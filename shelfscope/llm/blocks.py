"""Small tables of counters or bits that all tasks add to, and rows in key order."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BLOCK_SCHEMA = "block int, cells binary"
#: Cells in one row of such a table.
CELLS = 1 << 16


def block_rows(cells: np.ndarray) -> pa.RecordBatch:
    """The table of one task as rows of BLOCK_SCHEMA; blocks without content are left out."""
    parts = [(i, cells[at : at + CELLS]) for i, at in enumerate(range(0, len(cells), CELLS))]
    parts = [(i, c.tobytes()) for i, c in parts if c.any()]
    return pa.RecordBatch.from_arrays(
        [pa.array([i for i, _ in parts], pa.int32()), pa.array([c for _, c in parts], pa.binary())], ["block", "cells"]
    )


def summed_blocks(rows: DataFrame, kind: str, bits: bool = False) -> DataFrame:
    """Adds up (with `bits`, ORs) the tables of all tasks, block by block on the executors: sums are int64, ORed words stay `kind`."""

    def merge(batches):
        now, total = None, None
        for batch in batches:
            for block, cells in zip(batch.column("block").to_pylist(), batch.column("cells"), strict=True):
                part = np.frombuffer(cells.as_buffer(), kind)
                if block != now:
                    if total is not None:
                        yield row(now, total)
                    now, total = block, np.zeros(len(part), kind if bits else np.int64)
                if bits:
                    total |= part
                else:
                    total += part
        if total is not None:
            yield row(now, total)

    def row(block, total):
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([total.tobytes()])], ["block", "cells"])

    return rows.repartition("block").sortWithinPartitions("block").mapInArrow(merge, BLOCK_SCHEMA)


def collected_blocks(rows: DataFrame, size: int, kind) -> np.ndarray:
    """The table that merged blocks make up. `size` cells arrive at the driver: a parameter of the caller, whatever the input."""
    out = np.zeros(size, kind)
    for block, cells in rows.collect():
        part = np.frombuffer(cells, out.dtype)
        out[block * CELLS : block * CELLS + len(part)] = part
    return out


def merged_blocks(rows: DataFrame, size: int, kind: str, bits: bool = False) -> np.ndarray:
    """The tables of all tasks added up (with `bits`, ORed), at the driver."""
    return collected_blocks(summed_blocks(rows, kind, bits), size, kind if bits else np.int64)


def whole_keys(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Rows that come in order of `key`, regrouped so that no key's rows are parted between two tables."""
    kept: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        values = batch.column(key).to_numpy(zero_copy_only=False)
        if kept and values[-1] == kept[-1].column(key)[-1].as_py():
            kept.append(batch)
            continue
        cut = int(np.searchsorted(values, values[-1], "left"))
        if kept or cut:
            yield pa.Table.from_batches([*kept, batch.slice(0, cut)])
        kept = [batch.slice(cut)]
    if kept:
        yield pa.Table.from_batches(kept)


def free_name(columns: list[str], name: str) -> str:
    """`name`, or with underscores behind it, so that it is none of `columns` in any case."""
    taken = {c.lower() for c in columns}
    while name.lower() in taken:
        name += "_"
    return name


# ---- a Bloom filter over ids: a fixed number of bits, may let others pass, never stops a member

FILTER_BITS = 1 << 24
FILTER_WORDS = FILTER_BITS // 64


def _places(ids: np.ndarray) -> list[np.ndarray]:
    h = ids.astype(np.uint64)
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0xBF58476D1CE4E5B9)
    return [(h >> np.uint64(s)) % np.uint64(FILTER_BITS) for s in (0, 20, 40)]


def id_filter(ids: DataFrame, column: str) -> np.ndarray:
    """2 MB of bits over the long values of a column."""

    def fill(batches):
        cells = np.zeros(FILTER_WORDS, np.uint64)
        for batch in batches:
            for place in _places(batch.column(0).to_numpy(zero_copy_only=False)):
                np.bitwise_or.at(cells, place >> np.uint64(6), np.uint64(1) << (place & np.uint64(63)))
        yield block_rows(cells)

    rows = ids.select(F.col(column).cast("long")).where(f"{column} is not null").mapInArrow(fill, BLOCK_SCHEMA)
    return merged_blocks(rows, FILTER_WORDS, "uint64", bits=True)


def may_hold(cells: np.ndarray, ids: np.ndarray) -> np.ndarray:
    found = np.ones(len(ids), bool)
    for place in _places(ids):
        found &= (cells[place >> np.uint64(6)] >> (place & np.uint64(63))) & np.uint64(1) == 1
    return found
