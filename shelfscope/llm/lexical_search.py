"""Ranked lexical search: documents of an item grouped by the mask of terms they hold, masks taken in order of their maximum score.

Two passes over the documents for a block of items. The first keeps, for every document, how often it holds which of the
block's terms. The second works on lots of documents: one row of presence bits per term, and for an item the rows of its
terms laid side by side, so that a document is a bit mask. Documents with one mask share one bound: the sum of their
terms' largest parts in the lot. Masks are evaluated in descending order of it, until no further one can reach the score
that an item's `top`-th document already has.
"""

from __future__ import annotations

import math
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfscope.llm.blocks import BLOCK_SCHEMA, block_rows, merged_blocks
from shelfscope.llm.words import WordHasher, word_blocks
from shelfscope.session import materialize

TOP = 50
#: (item, term) pairs, on average, that are searched for in one pass. They go to the driver and to every task.
BLOCK_TERMS = 1 << 17
#: One document in so many sets the score to beat before all are evaluated.
SEED_SHARE = 64
#: Cells of a lot's table of terms and documents.
LOT_CELLS = 1 << 23

#: Characters that end a term: all of ASCII but digits and letters.
BETWEEN_TERMS = [*range(0x00, 0x30), *range(0x3A, 0x41), *range(0x5B, 0x61), *range(0x7B, 0x80)]


class TermHasher(WordHasher):
    """Hashes maximal runs of digits, letters and non-ASCII characters; A-Z count as a-z."""

    def __init__(self):
        super().__init__(lower=True)
        self.values[BETWEEN_TERMS] = 0


def item_terms(items: DataFrame, item_column: str, text_column: str) -> DataFrame:
    """(item_id, term): the different term hashes of every item; rows that repeat an id add their terms to it."""

    def terms(batches):
        hasher = TermHasher()
        for batch in batches:
            for first, last, hashes, bounds in word_blocks(batch.column("text"), hasher):
                ids = batch.column("item_id").slice(first, last - first).take(pa.array(np.repeat(np.arange(last - first), np.diff(bounds))))
                yield pa.RecordBatch.from_arrays([ids, pa.array(hashes.view(np.int64))], ["item_id", "term"])

    rows = items.select(F.col(item_column).cast("long").alias("item_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(terms, "item_id long, term long").distinct()


def term_counts(docs: DataFrame, doc_column: str, text_column: str, terms) -> DataFrame:
    """(doc_id, n, terms, counts): documents with a term, which of the sorted term hashes they hold, and how often."""

    def count(batches):
        hasher, known = TermHasher(), terms.value
        for batch in batches:
            for first, last, hashes, bounds in word_blocks(batch.column("text"), hasher):
                lengths = np.diff(bounds)
                place = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
                hit = known[place] == hashes
                document = np.repeat(np.arange(last - first), lengths)[hit]
                keys, times = np.unique(document * len(known) + place[hit], return_counts=True)
                full = np.flatnonzero(lengths)
                offsets = np.append(np.searchsorted(keys, full * len(known)), len(keys)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id").slice(first, last - first).take(pa.array(full)), pa.array(lengths[full].astype(np.int64)),
                        pa.ListArray.from_arrays(offsets, (keys % len(known)).astype(np.int32)),
                        pa.ListArray.from_arrays(offsets, times.astype(np.int64)),
                    ],
                    ["doc_id", "n", "terms", "counts"],
                )

    rows = docs.select(F.col(doc_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    return rows.mapInArrow(count, "doc_id long, n long, terms array<int>, counts array<long>")


def document_frequencies(counted: DataFrame, terms: int) -> np.ndarray:
    def tally(batches):
        cells = np.zeros(terms, np.int64)
        for batch in batches:
            cells += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=terms)
        yield block_rows(cells)

    return merged_blocks(counted.select("terms").mapInArrow(tally, BLOCK_SCHEMA), terms, "int64")


class Best:
    """The best documents of one item so far. Ties go to the smaller id, documents without id come last among them."""

    def __init__(self, top: int, floor: int):
        self.top, self.floor = top, floor
        self.scores, self.ids, self.no_id = np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, bool)

    def add(self, scores: np.ndarray, ids: np.ndarray, no_id: np.ndarray) -> None:
        good = scores >= self.floor
        scores, ids, no_id = (np.append(a, b[good]) for a, b in ((self.scores, scores), (self.ids, ids), (self.no_id, no_id)))
        order = np.lexsort((ids, no_id, -scores))[: self.top]
        self.scores, self.ids, self.no_id = scores[order], ids[order], no_id[order]
        if len(order) == self.top:
            self.floor = max(self.floor, int(self.scores[-1]))


def mask_groups(present: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(masks, group): the different columns of a table of bits as rows, and the number of each column's mask."""
    packed = np.packbits(present, axis=0)
    words = np.zeros((present.shape[1], -(-len(packed) // 8) * 8), np.uint8)
    words[:, : len(packed)] = packed.T
    keys = words.view(np.uint64)
    keys = keys[:, 0] if keys.shape[1] == 1 else keys.view(np.dtype((np.void, keys.shape[1] * 8)))[:, 0]
    _, first, group = np.unique(keys, return_index=True, return_inverse=True)
    return present[:, first].T, group


def search_lot(parts: np.ndarray, present: np.ndarray, ids: np.ndarray, no_id: np.ndarray, items: list[np.ndarray], best: list[Best]) -> None:
    """`parts[t, d]` is what term t adds to the score of document d, `present[t, d]` whether d holds it."""
    largest = parts.max(axis=1)
    for own, found in zip(items, best, strict=True):
        if largest[own].sum() < found.floor:
            continue
        bits = present[own]
        some = np.flatnonzero(bits.any(axis=0))
        masks, group = mask_groups(bits[:, some])
        bound = masks @ largest[own]
        order = np.argsort(-bound, kind="stable")
        rank = np.empty(len(order), np.int64)
        rank[order] = np.arange(len(order))
        rows = some[np.argsort(rank[group], kind="stable")]
        ends = np.cumsum(np.bincount(group, minlength=len(order))[order])
        bound, at, want = bound[order], 0, found.top
        while at < len(order) and bound[at] >= found.floor:
            start = ends[at - 1] if at else 0
            at = min(int(np.searchsorted(ends, start + want)) + 1, int(np.searchsorted(-bound, -found.floor, "right")))
            now = rows[start : ends[at - 1]]
            found.add(parts[np.ix_(own, now)].sum(axis=0), ids[now], no_id[now])
            want *= 2


def best_documents(counted: DataFrame, block, corpus: tuple[int, int], top: int, floors: np.ndarray | None = None) -> DataFrame:
    """(item_id, doc_id, score): every task's best documents of each item; `block` holds ids, terms and weights of the items."""
    n_docs, n_terms = corpus

    def search(batches):
        item_ids, items, weights = block.value
        best = [Best(top, 1 if floors is None else max(1, int(f))) for f in (floors if floors is not None else items)]
        lot = max(16, LOT_CELLS // max(1, len(weights)))
        for whole in batches:
            for at in range(0, whole.num_rows, lot):
                batch = whole.slice(at, lot)
                held = batch.column("terms")
                document = np.repeat(np.arange(batch.num_rows), held.value_lengths().to_numpy())
                term, times = held.flatten().to_numpy(), batch.column("counts").flatten().to_numpy()
                m = 50 + 50 * batch.column("n").to_numpy() * n_docs // n_terms
                parts = np.zeros((len(weights), batch.num_rows), np.int64)
                present = np.zeros(parts.shape, bool)
                parts[term, document] = weights[term] * (1_000_000_000 * times // (1000 * times + 20 * m[document]))
                present[term, document] = True
                ids = batch.column("doc_id")
                no_id = ids.is_null().to_numpy(zero_copy_only=False)
                search_lot(parts, present, ids.fill_null(0).to_numpy(), no_id, items, best)
        for item, found in zip(item_ids, best, strict=True):
            if len(found.ids):
                yield pa.RecordBatch.from_arrays(
                    [pa.array([item] * len(found.ids), pa.int64()), pa.array(found.ids, mask=found.no_id), pa.array(found.scores)],
                    ["item_id", "doc_id", "score"],
                )

    return counted.mapInArrow(search, "item_id long, doc_id long, score long")


def ranked(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)


def search_documents(
    docs: DataFrame, items: DataFrame, top: int = TOP, doc_column: str = "doc_id", text_column: str = "text",
    item_column: str = "item_id", item_text_column: str = "text", block_terms: int = BLOCK_TERMS,
) -> DataFrame:
    """The `top` best documents of every item: item_id, rank (from 1), doc_id, score (above 0).

    NULL and empty texts have no terms and are neither found nor counted; an item without terms finds nothing. Texts are read whole.
    Equal scores rank by doc_id, rows without doc_id behind those with one. Every row is a document, also one that repeats an id.
    Rows that repeat an item_id are one item with the terms of all of them; items without id are one item whose id is NULL.
    Empty tables give no rows. Other columns are not read.

    The score is a sum over an item's terms in whole numbers; `n` words, `tf` times the term, N documents with L terms:
    floor(1000 ln((2N + 2) / (2df + 1))) * (10**9 tf div (1000 tf + 20 (50 + 50 n N div L))). Terms are told apart by 64 bits.
    """
    spark = docs.sparkSession
    asked = materialize(item_terms(items, item_column, item_text_column), "item-terms")
    blocks = max(1, math.ceil(asked.count() / block_terms))
    asked = asked.withColumn("block", F.pmod(F.xxhash64("item_id"), F.lit(blocks)))
    results = []
    for number in range(blocks):
        pairs = asked.where(F.col("block") == number).select("item_id", "term").toArrow()
        if not pairs.num_rows:
            continue
        known, place = np.unique(pairs.column("term").to_numpy().view(np.uint64), return_inverse=True)
        ids = pairs.column("item_id").combine_chunks().dictionary_encode(null_encoding="encode")
        if isinstance(ids, pa.ChunkedArray):
            ids = ids.combine_chunks()
        code, item_ids = ids.indices.to_numpy(), ids.dictionary.to_pylist()
        order = np.argsort(code, kind="stable")
        own = np.split(place[order], np.cumsum(np.bincount(code, minlength=len(item_ids)))[:-1])

        counted = materialize(term_counts(docs, doc_column, text_column, spark.sparkContext.broadcast(known)), "term-counts")
        n_docs, n_terms = counted.agg(F.count("*"), F.coalesce(F.sum("n"), F.lit(0))).first()
        if not n_docs:
            continue
        df = document_frequencies(counted, len(known))
        weights = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        block = spark.sparkContext.broadcast((item_ids, own, weights))
        some = counted.where(F.pmod(F.xxhash64("doc_id", "n"), F.lit(SEED_SHARE)) == 0)
        seeds = ranked(best_documents(some, block, (n_docs, n_terms), top), top).where(F.col("rank") == top).select("item_id", "score").collect()
        scores = {r.item_id: r.score for r in seeds}
        floors = np.array([scores.get(i, 1) for i in item_ids], np.int64)
        results.append(ranked(best_documents(counted, block, (n_docs, n_terms), top, floors), top))
    if not results:
        return spark.createDataFrame([], "item_id long, rank int, doc_id long, score long")
    return reduce(DataFrame.union, results).select("item_id", "rank", "doc_id", "score")
