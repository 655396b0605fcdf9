"""Substring dedup: removes every passage of 50 words that also begins in a document with a smaller id.

Two passes over the texts, with a count-min sketch of fixed size between them.

* Every window of 50 words is filed under the smallest hash of the 8-word grams in it. Equal windows have equal
  smallest grams, and neighbours mostly share theirs, so a text has about one file key for 22 windows. A key occurs at
  least as often as each of its windows, so the sketch of the keys overestimates the windows' counts.
* Pass 1: each task sketches its keys; the merged sketches become bits "counted twice or more", broadcast.
* Pass 2: windows whose key passes every row of bits are compared exactly. A task first settles its own (a window
  that a smaller id of the same task holds is removed at once), so a passage comes at most once from each task,
  however many documents hold it. The rest meet by key.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfscope.llm.blocks import CELLS, whole_keys
from shelfscope.llm.words import WordHasher, grams, inside_documents, mix, odd_numbers, word_blocks
from shelfscope.session import materialize

WINDOW = 50
GRAM = 8
#: The sketch: rows, and bits in each row of the broadcast form.
ROWS = 2
WIDTH = 1 << 26
#: Windows that a task holds before it settles them.
HELD = 1 << 21


def _smallest(values: np.ndarray, n: int) -> np.ndarray:
    """The minimum of every n consecutive values."""
    part, width = values, 1
    while 2 * width <= n:
        part = np.minimum(part[:-width], part[width:])
        width *= 2
    return np.minimum(part[: len(values) - n + 1], part[n - width : n - width + len(values) - n + 1])


def _windows(texts: pa.Array, hasher: WordHasher, window: int, gram: int) -> Iterator[tuple]:
    """Per block of texts: the windows' file keys, their row, their first word in that row's text, and all words."""
    for first, _, words, bounds in word_blocks(texts, hasher):
        if len(words) < window:
            continue
        good = np.flatnonzero(inside_documents(bounds, len(words), window))
        if not len(good):
            continue
        keys = _smallest(grams(words, gram), window - gram + 1)[good]
        row = np.searchsorted(bounds, good, "right") - 1
        yield keys, row + first, good - bounds[row], words, good


def _cells(keys: np.ndarray, row: int, width: int) -> np.ndarray:
    return (mix(keys * odd_numbers(61 + row, 1)[0]) % np.uint64(width)).astype(np.int64)


def _repeated_bits(docs: DataFrame, window: int, gram: int, width: int) -> list[np.ndarray]:
    """For each row of the sketch, the bits of the cells that all tasks together counted twice or more."""

    def sketch(batches):
        hasher = WordHasher(lower=False)
        held, size = [], 0
        for batch in batches:
            for keys, row, at, *_ in _windows(batch.column("text"), hasher, window, gram):
                begins = np.ones(len(keys), bool)
                begins[1:] = (keys[1:] != keys[:-1]) | (row[1:] != row[:-1]) | (at[1:] != at[:-1] + 1)
                held.append(keys[begins])
                size += len(held[-1])
                if size > HELD:
                    yield from counted(np.concatenate(held))
                    held, size = [], 0
        if held:
            yield from counted(np.concatenate(held))

    def counted(keys):
        for k in range(ROWS):
            cells, count = np.unique(_cells(keys, k, width), return_counts=True)
            block = cells // CELLS
            edges = np.searchsorted(block, np.arange(width // CELLS + 1))
            rows = np.flatnonzero(np.diff(edges))
            place = (cells % CELLS).astype(np.uint16)
            parts = [(place[edges[b] : edges[b + 1]], count[edges[b] : edges[b + 1]] > 1) for b in rows]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(rows * ROWS + k, pa.int32()), pa.array([p.tobytes() for p, _ in parts], pa.binary()),
                    pa.array([p[more].tobytes() for p, more in parts], pa.binary()),
                ],
                ["block", "cells", "again"],
            )

    def merge(batches):
        now, total = None, None
        for batch in batches:
            for block, cells, again in zip(batch.column("block").to_pylist(), batch.column("cells"), batch.column("again"), strict=True):
                if block != now:
                    if now is not None:
                        yield row(now, total)
                    now, total = block, np.zeros(CELLS, np.uint8)
                for part in (cells, again):
                    place = np.frombuffer(part.as_buffer(), np.uint16)
                    total[place] = np.minimum(total[place] + 1, 2)
        if now is not None:
            yield row(now, total)

    def row(block, total):
        bits = np.packbits(total > 1).tobytes()
        return pa.RecordBatch.from_arrays([pa.array([block], pa.int32()), pa.array([bits])], ["block", "bits"])

    counts = docs.select("text").mapInArrow(sketch, "block int, cells binary, again binary")
    merged = counts.repartition("block").sortWithinPartitions("block").mapInArrow(merge, "block int, bits binary")
    bits = [np.zeros(width // 8, np.uint8) for _ in range(ROWS)]
    for block, found in merged.collect():  # ROWS * WIDTH / 8 bytes at most
        at = block // ROWS * (CELLS // 8)
        bits[block % ROWS][at : at + CELLS // 8] = np.frombuffer(found, np.uint8)
    return bits


def _runs(ids: np.ndarray, marks: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """First and last index of every run of consecutive windows of one text; the input is in that order."""
    begins = np.ones(len(at), bool)
    begins[1:] = (ids[1:] != ids[:-1]) | (marks[1:] != marks[:-1]) | (at[1:] != at[:-1] + 1)
    first = np.flatnonzero(begins)
    return first, np.append(first[1:], len(at)) - 1


def _held_by_smaller(hashes: np.ndarray, ids: np.ndarray) -> np.ndarray:
    """For every window: is an equal one in a document with a smaller id?"""
    order = np.lexsort((ids, hashes))
    sorted_hashes, sorted_ids = hashes[order], ids[order]
    begins = np.ones(len(order), bool)
    begins[1:] = sorted_hashes[1:] != sorted_hashes[:-1]
    first = np.flatnonzero(begins)
    smallest = np.repeat(sorted_ids[first], np.diff(np.append(first, len(order))))
    out = np.empty(len(order), bool)
    out[order] = sorted_ids > smallest
    return out


RUN_SCHEMA = "key long, doc_id long, mark long, start long, stop long, hashes binary"


def _removed_rows(ids, marks, at, window):
    first, last = _runs(ids, marks, at)
    n = len(first)
    return pa.RecordBatch.from_arrays(
        [
            pa.nulls(n, pa.int64()), pa.array(ids[first]), pa.array(marks[first]), pa.array(at[first]),
            pa.array(at[last] + window), pa.nulls(n, pa.binary()),
        ],
        ["key", "doc_id", "mark", "start", "stop", "hashes"],
    )


def repeated_passages(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", window: int = WINDOW, gram: int = GRAM,
    width: int = WIDTH, held: int = HELD,
) -> DataFrame:
    """(doc_id, mark, start, stop): word ranges to remove; mark is xxhash64 of the text, ranges may overlap.

    The input decides, not what is left of it. Documents without id, NULL texts and texts of fewer than `window` words have
    no ranges. Rows that repeat an id never remove each other's words.
    """
    gram = min(gram, window)
    docs = docs.where(F.col(id_column).isNotNull()).select(
        F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")
    ).withColumn("mark", F.xxhash64("text"))
    bits = docs.sparkSession.sparkContext.broadcast(_repeated_bits(docs, window, gram, width))

    def compare(batches):
        hasher = WordHasher(lower=False)
        store, size = [], 0
        for batch in batches:
            all_ids, all_marks = batch.column("doc_id").to_numpy(), batch.column("mark").to_numpy()
            for keys, row, at, words, good in _windows(batch.column("text"), hasher, window, gram):
                keep = np.ones(len(keys), bool)
                for k, row_bits in enumerate(bits.value):
                    cell = _cells(keys, k, width)
                    keep &= (row_bits[cell >> 3] >> (7 - (cell & 7)).astype(np.uint8)) & 1 == 1
                if keep.any():
                    hashes = grams(words, window)[good[keep]]
                    row = row[keep]
                    store.append((hashes, keys[keep].view(np.int64), all_ids[row], all_marks[row], at[keep].astype(np.int64)))
                    size += len(hashes)
                if size > held:
                    yield from settle(store)
                    store, size = [], 0
        if store:
            yield from settle(store)

    def settle(store):
        hashes, keys, ids, marks, at = (np.concatenate(x) for x in zip(*store, strict=True))
        gone = _held_by_smaller(hashes, ids)
        if gone.any():
            yield _removed_rows(ids[gone], marks[gone], at[gone], window)
        stay = ~gone
        hashes, keys, ids, marks, at = hashes[stay], keys[stay], ids[stay], marks[stay], at[stay]
        begins = np.ones(len(at), bool)
        begins[1:] = (ids[1:] != ids[:-1]) | (marks[1:] != marks[:-1]) | (at[1:] != at[:-1] + 1) | (keys[1:] != keys[:-1])
        first = np.flatnonzero(begins)
        ends = np.append(first[1:], len(at))
        for part in range(0, len(first), 10_000):
            f, e = first[part : part + 10_000], ends[part : part + 10_000]
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(keys[f]), pa.array(ids[f]), pa.array(marks[f]), pa.array(at[f]), pa.array(at[e - 1] + window),
                    pa.array([hashes[i:j].tobytes() for i, j in zip(f, e, strict=True)], pa.binary()),
                ],
                ["key", "doc_id", "mark", "start", "stop", "hashes"],
            )

    def meet(batches):
        for table in whole_keys(batches, "key"):
            parts = [np.frombuffer(x.as_buffer(), np.uint64) for x in table.column("hashes").combine_chunks()]
            count = np.array([len(p) for p in parts])
            ids, marks, start = (np.repeat(table.column(c).to_numpy(), count) for c in ("doc_id", "mark", "start"))
            at = start + np.arange(len(start)) - np.repeat(np.cumsum(count) - count, count)
            gone = _held_by_smaller(np.concatenate(parts), ids)
            if gone.any():
                yield _removed_rows(ids[gone], marks[gone], at[gone], window)

    found = materialize(docs.mapInArrow(compare, RUN_SCHEMA), "windows")
    met = found.where("hashes is not null").repartition("key").sortWithinPartitions("key").mapInArrow(meet, RUN_SCHEMA)
    return found.where("hashes is null").union(met).select("doc_id", "mark", "start", "stop")


def drop_repeated_passages(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", **settings) -> DataFrame:
    """One row per row of `docs`: doc_id, n_words, n_removed, text (kept words joined by one space).

    A NULL or empty text has no words and gives an empty text. Other columns play no part.
    """
    ranges = (
        repeated_passages(docs, id_column, text_column, **settings)
        .groupBy("doc_id", "mark").agg(F.collect_list(F.struct("start", "stop")).alias("ranges"))
        .select("doc_id", "mark", "ranges.start", "ranges.stop")
    )
    texts = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.coalesce(F.col(text_column).cast("string"), F.lit("")).alias("text")
    ).withColumn("mark", F.xxhash64("text"))

    def cut(batches):
        for batch in batches:
            n_words, n_removed, kept = [], [], []
            for text, starts, stops in zip(
                batch.column("text").cast(pa.large_binary()), batch.column("start").to_pylist(), batch.column("stop").to_pylist(), strict=True
            ):
                words = text.as_py().split()
                n_words.append(len(words))
                if starts:
                    gone = np.zeros(len(words) + 1, np.int32)
                    np.add.at(gone, starts, 1)
                    np.add.at(gone, stops, -1)
                    stay = np.cumsum(gone[:-1]) == 0
                    words = [w for w, s in zip(words, stay.tolist(), strict=True) if s]
                n_removed.append(n_words[-1] - len(words))
                kept.append(b" ".join(words))
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string())],
                ["doc_id", "n_words", "n_removed", "text"],
            )

    return (
        texts.join(ranges, ["doc_id", "mark"], "left").select("doc_id", "text", "start", "stop")
        .mapInArrow(cut, "doc_id long, n_words long, n_removed long, text string")
    )
