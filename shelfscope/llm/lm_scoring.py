"""Language-model scores from a log-frequency Bloom filter.

The filter holds the counts of words and word pairs as powers of two: an n-gram with count c is entered under its levels
1 to floor(log2(c)) + 1. A count is read by probing level 1, 2, .. until a level is missing; a chance hit adds a
level, never removes one. Each n-gram's bits lie in the section of the filter that its hash names, so the
task that has gathered all counts of a section also writes it. It knows the section's entries by then and makes the section
as wide as they need, so the rate of chance hits is the same for every corpus. Ranges of sections are broadcast, each of at
most RANGE_BYTES; where there are several, a task holds one at a time and asks it for the n-grams of many texts at once.

Pair probabilities are mixed with word probabilities. The mixing weights (one per level of the left word) are those that
explain the training texts best when each pair is counted without itself.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscope.llm.words import WordHasher, mix, odd_numbers, word_blocks
from shelfscope.session import materialize

#: Bits of the filter for an entry; two places each leave a chance hit at (1 - exp(-2 / 10))^2, 1 in 30.
ENTRY_BITS = 10
#: Most bytes of the filter that are broadcast as one piece and that a task holds at a time.
RANGE_BYTES = 1 << 25
#: Bytes of text that are hashed, and looked up where the filter is one range, at once; the work arrays take some 60 for each.
TEXT_BYTES = 1 << 18
#: Tokens that are looked up together where the filter has several ranges.
PROBED = 1 << 18
#: N-grams that a task gathers before it passes their counts on, and n-grams per section of the filter.
HELD = 1 << 20
SECTION_GRAMS = 1 << 19
#: Keys that are probed at once; the work arrays take some 80 bytes for each.
SLICE = 1 << 17
#: Slots of the table of frequent words with exact counts (16 bytes each); all other words are joined.
SLOTS = 1 << 20
LEVELS = 40
MIXES = np.array([0.0, 0.002, 0.01, 0.03, 0.07, 0.15, 0.25, 0.4, 0.55, 0.7, 0.85, 0.95])
END, BEGIN = (np.uint64(x) for x in odd_numbers(71, 2))


def token_blocks(texts: pa.Array, hasher: WordHasher):
    """(first row, tokens, left neighbours, bounds) per block of texts; every text ends with END."""
    for first, last, words, bounds in word_blocks(texts, hasher):
        tokens = np.insert(words, bounds[1:], END)
        bounds = bounds + np.arange(last - first + 1)
        left = np.empty_like(tokens)
        left[1:] = tokens[:-1]
        left[bounds[:-1]] = BEGIN
        yield first, tokens, left, bounds


def pair_keys(left: np.ndarray, tokens: np.ndarray) -> np.ndarray:
    a, b = odd_numbers(73, 2)
    return mix(left * a + tokens * b)


def _counted(held: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    return np.unique(np.concatenate(held), return_counts=True)


def word_counts(docs: DataFrame) -> DataFrame:
    """(h, c): the count of every token of the texts, by hash."""

    def count(batches):
        hasher = WordHasher(lower=True, block=TEXT_BYTES)
        held, size = [], 0
        for batch in batches:
            for _, tokens, _, _ in token_blocks(batch.column("text"), hasher):
                held.append(tokens)
                size += len(tokens)
                if size > HELD:
                    yield rows(held)
                    held, size = [], 0
        if held:
            yield rows(held)

    def rows(held):
        keys, counts = _counted(held)
        return pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), pa.array(counts.astype(np.int64))], ["h", "c"])

    return materialize(docs.mapInArrow(count, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")), "word-counts")


class FilterRange(NamedTuple):
    """Neighbouring sections of the filter: section first + i has the bytes starts[i] to starts[i + 1] of `cells`."""

    first: int
    starts: np.ndarray
    cells: np.ndarray


def _bit_places(keys: np.ndarray, level: int, width: np.ndarray | np.uint64) -> tuple[np.ndarray, np.ndarray]:
    """Two places inside the section of each key, which has `width` (below 2^32) bits."""
    h = mix(keys + np.uint64(level * int(odd_numbers(79, 1)[0]) % 2**64))
    return ((h & np.uint64(2**32 - 1)) * width) >> np.uint64(32), ((h >> np.uint64(32)) * width) >> np.uint64(32)


def _section(keys: np.ndarray, sections: int) -> np.ndarray:
    return keys >> np.uint64(64 - (sections.bit_length() - 1)) if sections > 1 else np.zeros(len(keys), np.uint64)


def filter_sections(docs: DataFrame, sections: int, bits: int | None = None) -> DataFrame:
    """(section, bits): the filter over the texts' words and pairs; as wide as its entries need, or of `bits` bits in all."""

    def gather(batches):
        hasher = WordHasher(lower=True, block=TEXT_BYTES)
        held, size = [], 0
        for batch in batches:
            for _, tokens, left, bounds in token_blocks(batch.column("text"), hasher):
                held += [tokens, np.full(len(bounds) - 1, BEGIN), pair_keys(left, tokens)]
                size += 2 * len(tokens)
                if size > HELD:
                    yield from dealt(held)
                    held, size = [], 0
        if held:
            yield from dealt(held)

    def dealt(held):
        keys, counts = _counted(held)
        once = counts == 1
        parts = []
        for part in (keys[once], keys[~once]):
            section = _section(part, sections)
            parts.append((part, np.searchsorted(section, np.arange(sections + 1, dtype=np.uint64))))
        more = counts[~once].astype(np.uint32)
        (ones, at), (many, by) = parts
        for low in range(0, sections, 256):
            some = range(low, min(low + 256, sections))
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(some, pa.int32()), pa.array([ones[at[s] : at[s + 1]].tobytes() for s in some], pa.binary()),
                    pa.array([many[by[s] : by[s + 1]].tobytes() for s in some], pa.binary()),
                    pa.array([more[by[s] : by[s + 1]].tobytes() for s in some], pa.binary()),
                ],
                ["section", "ones", "many", "counts"],
            )

    def fill(batches):
        now, keys, counts = None, [], []
        for batch in batches:
            for section, ones, many, more in zip(batch.column("section").to_pylist(), *batch.columns[1:], strict=True):
                if section != now:
                    if now is not None:
                        yield filled(now, keys, counts)
                    now, keys, counts = section, [], []
                ones = np.frombuffer(ones.as_buffer(), np.uint64)
                keys += [ones, np.frombuffer(many.as_buffer(), np.uint64)]
                counts += [np.ones(len(ones), np.uint32), np.frombuffer(more.as_buffer(), np.uint32)]
        if now is not None:
            yield filled(now, keys, counts)

    def filled(section, keys, counts):
        keys, inverse = np.unique(np.concatenate(keys), return_inverse=True)
        total = np.bincount(inverse, np.concatenate(counts), len(keys))
        width = bits // sections if bits else -(-ENTRY_BITS * int(np.frexp(total)[1].sum()) // 8) * 8  # frexp: floor(log2) + 1
        cells = np.zeros(width, bool)
        level = 1
        while len(keys):
            for place in _bit_places(keys, level, np.uint64(width)):
                cells[place] = True
            level += 1
            more = total >= 2 ** (level - 1)
            keys, total = keys[more], total[more]
        return pa.RecordBatch.from_arrays([pa.array([section], pa.int32()), pa.array([np.packbits(cells).tobytes()])], ["section", "bits"])

    rows = docs.mapInArrow(gather, "section int, ones binary, many binary, counts binary")
    return rows.repartition("section").sortWithinPartitions("section").mapInArrow(fill, "section int, bits binary")


def _read_range(rows: DataFrame, first: int, sizes: np.ndarray) -> FilterRange:
    """The sections first .. first + len(sizes) - 1 of (section, bits) rows; sections without a row have no bytes."""
    starts = np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)
    cells = np.zeros(starts[-1], np.uint8)
    for batch in rows.where(F.col("section").between(first, first + len(sizes) - 1)).toArrow().to_batches():  # RANGE_BYTES, or one section
        for section, found in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
            cells[starts[section - first] : starts[section - first + 1]] = np.frombuffer(found.as_buffer(), np.uint8)
    return FilterRange(first, starts, cells)


def filter_ranges(rows: DataFrame, sections: int, most: int):
    """The FilterRanges of a filter, in order, each of at most `most` bytes or one section."""
    sizes = np.zeros(sections, np.int64)
    for section, n in rows.select("section", F.length("bits")).collect():  # two numbers per SECTION_GRAMS n-grams
        sizes[section] = n
    first = 0
    while first < sections:
        last = max(first + 1, int(np.searchsorted(np.cumsum(sizes[first:]), most, "right")) + first)
        yield _read_range(rows, first, sizes[first:last])
        first = last


def build_filter(docs: DataFrame, sections: int, bits: int | None = None) -> FilterRange:
    """The whole filter as one range."""
    return next(filter_ranges(materialize(filter_sections(docs, sections, bits), "filter"), sections, 1 << 62))


def read_levels(held: FilterRange, keys: np.ndarray, sections: int) -> np.ndarray:
    """The highest level of each key up to which no level is missing; 0 for keys not held or of other ranges."""
    parts = [_slice_levels(held, keys[at : at + SLICE], sections) for at in range(0, len(keys), SLICE)]
    return np.concatenate(parts) if parts else np.zeros(0, np.int8)


def _slice_levels(held: FilterRange, keys: np.ndarray, sections: int) -> np.ndarray:
    out = np.zeros(len(keys), np.int8)
    section = _section(keys, sections).astype(np.int64) - held.first
    alive = np.flatnonzero((section >= 0) & (section < len(held.starts) - 1))
    base = held.starts[section[alive]]
    width = (held.starts[section[alive] + 1] - base).astype(np.uint64) * np.uint64(8)
    base = base.astype(np.uint64) * np.uint64(8)
    there = width > 0
    alive, base, width = alive[there], base[there], width[there]
    for level in range(1, LEVELS):
        for k in (0, 1):
            place = _bit_places(keys[alive], level, width)[k] + base
            there = (held.cells[place >> np.uint64(3)] >> (7 - (place & np.uint64(7))).astype(np.uint8)) & 1 == 1
            alive, base, width = alive[there], base[there], width[there]
        if not len(alive):
            break
        out[alive] = level
    return out


def _expected(levels: np.ndarray) -> np.ndarray:
    """The count that a level stands for: the middle of 2^(level - 1) .. 2^level - 1."""
    table = np.concatenate([[0.0], (3 * 2.0 ** np.arange(LEVELS) - 1) / 2])
    return table[levels]


class HeldRanges:
    """The ranges of the filter, one after the other; of several, only the one in use is kept.

    Every second turn goes backwards, so a turn begins with the range that the one before has left in memory.
    """

    def __init__(self, shared: list):
        self.shared, self.order, self.now, self.held = shared, list(range(len(shared))), None, None

    def __iter__(self):
        for i in self.order:
            if i != self.now:
                self.held, one = None, self.shared[i]
                # value would keep all of them
                self.held, self.now = one.load_from_path(one._path) if one._path and len(self.shared) > 1 else one.value, i
            yield self.held
        self.order.reverse()


def _levels_of(ranges: HeldRanges, sections: int, tokens: np.ndarray, left: np.ndarray) -> tuple[np.ndarray, ...]:
    """Levels of the tokens, of their left neighbours and of the pairs; each different word is probed once."""
    words, place = np.unique(np.concatenate([tokens, left]), return_inverse=True)
    place = place.astype(np.int32)
    pairs = pair_keys(left, tokens)
    level, pair = np.zeros(len(words), np.int8), np.zeros(len(pairs), np.int8)
    for held in ranges:  # a key is in one of them, the others give 0
        level += read_levels(held, words, sections)
        pair += read_levels(held, pairs, sections)
    level = level[place]
    return level[: len(tokens)], level[len(tokens) :], np.minimum(pair, np.minimum(level[: len(tokens)], level[len(tokens) :]))


def _lots(batches, hasher: WordHasher, shared: list):
    """(rows without their texts, tokens, left neighbours, bounds): blocks of texts, PROBED tokens together if there are several ranges."""
    held, size = [], 0
    for batch in batches:
        rows = batch.select([c for c in batch.schema.names if c != "text"])
        for first, tokens, left, bounds in token_blocks(batch.column("text"), hasher):
            held.append((rows.slice(first, len(bounds) - 1), tokens, left, bounds))
            size += len(tokens)
            if len(shared) == 1 or size >= PROBED:
                yield _one_lot(held)
                held, size = [], 0
    if held:
        yield _one_lot(held)


def _one_lot(held: list[tuple]) -> tuple:
    rows, tokens, left, bounds = zip(*held, strict=True)
    before = np.cumsum([0, *(b[-1] for b in bounds)])
    return (
        pa.Table.from_batches(rows).combine_chunks(), np.concatenate(tokens), np.concatenate(left),
        np.concatenate([[0], *(b[1:] + n for b, n in zip(bounds, before[:-1], strict=True))]),
    )


def _fit_mixes(docs: DataFrame, shared: list, sections: int, total: int, distinct: int) -> np.ndarray:
    """For each level of the left word, the mixing weight that explains the texts best, each pair taken out of its own count."""

    def explain(batches):
        hasher = WordHasher(lower=True, block=TEXT_BYTES)
        gain, ranges = np.zeros((LEVELS, len(MIXES))), HeldRanges(shared)
        for _, tokens, left, _ in _lots(batches, hasher, shared):
            word, before, pair = _levels_of(ranges, sections, tokens, left)
            kinds, n = np.unique(word.astype(np.int64) * 10_000 + before.astype(np.int64) * 100 + pair, return_counts=True)
            word, before, pair = kinds // 10_000, kinds // 100 % 100, kinds % 100
            single = np.maximum(_expected(word) - 1, 0) + 1
            single = np.minimum(single / (total + distinct + 1), 1)
            seen = np.maximum(_expected(pair) - 1, 0) / np.maximum(_expected(before) - 1, 1)
            value = np.log10(MIXES * np.minimum(seen, 1)[:, None] + (1 - MIXES) * single[:, None]) * n[:, None]
            np.add.at(gain, before, value)
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.repeat(np.arange(LEVELS), len(MIXES))), pa.array(np.tile(np.arange(len(MIXES)), LEVELS)), pa.array(gain.ravel())],
            ["level", "mix", "gain"],
        )

    rows = docs.mapInArrow(explain, "level long, mix long, gain double").groupBy("level", "mix").agg(F.sum("gain").alias("gain"))
    gain = np.zeros((LEVELS, len(MIXES)))
    for level, k, value in rows.collect():  # LEVELS * len(MIXES) rows
        gain[level, k] = value
    return MIXES[gain.argmax(1)]


def score_texts(
    docs: DataFrame, held_out: Column, id_column: str = "doc_id", text_column: str = "text", bits: int | None = None,
    section_grams: int = SECTION_GRAMS, slots: int = SLOTS, range_bytes: int = RANGE_BYTES,
) -> DataFrame:
    """One row per row of `docs`: doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score.

    Learns from the rows where `held_out` is not true. Every text has an end token, so a NULL or empty text has one
    token. base_score is add-one smoothed over exact word counts; score is the filter model's log10 probability. An empty
    table gives no rows; without training rows all counts are 0. The filter has ENTRY_BITS bits for each entry of the corpus, or
    `bits` in all. `section_grams`, `slots` and `range_bytes` steer speed and memory only.
    """
    spark = docs.sparkSession
    rows = docs.select(
        F.col(id_column).cast("long").alias("doc_id"), F.coalesce(held_out, F.lit(False)).alias("held_out"),
        F.col(text_column).cast("string").alias("text"),
    )
    train = rows.where("not held_out").select("text")
    counts = word_counts(train)
    total, distinct = (x or 0 for x in counts.agg(F.sum("c"), F.count("*")).first())
    sections = 1 << max(4, (2 * total // section_grams).bit_length())
    if bits:
        sections = min(sections, 1 << (bits.bit_length() - 15))
    filled = materialize(filter_sections(train, sections, bits), "filter")
    shared = [spark.sparkContext.broadcast(held) for held in filter_ranges(filled, sections, range_bytes)]
    mixes = _fit_mixes(train, shared, sections, total, distinct)

    slot = F.pmod(F.col("h"), F.lit(slots))
    hashes, logs = np.zeros(slots, np.int64), np.full(slots, -1.0)
    top = counts.groupBy(slot.alias("slot")).agg(F.max(F.struct("c", "h")).alias("top")).select("slot", "top.h", "top.c")
    for batch in top.toArrow().to_batches():  # one word per slot, as numbers
        at = batch.column(0).to_numpy()
        hashes[at], logs[at] = batch.column(1).to_numpy(), np.log10(batch.column(2).to_numpy() + 1)
    frequent = spark.sparkContext.broadcast((hashes, logs))

    def score(batches):
        hasher = WordHasher(lower=True, block=TEXT_BYTES)
        (words, word_logs), ranges = frequent.value, HeldRanges(shared)
        for rows, tokens, left, bounds in _lots(batches, hasher, shared):
            word, before, pair = _levels_of(ranges, sections, tokens, left)
            single = np.minimum((_expected(word) + 1) / (total + distinct + 1), 1)
            seen = np.minimum(_expected(pair) / np.maximum(_expected(before), 1), 1)
            weight = mixes[before]
            model = np.add.reduceat(np.log10(weight * seen + (1 - weight) * single), bounds[:-1])
            signed = tokens.view(np.int64)
            at = signed % slots
            known = (words[at] == signed) & (word_logs[at] >= 0)
            part = np.add.reduceat(np.where(known, word_logs[at], 0.0), bounds[:-1])
            n_known = np.add.reduceat(known.astype(np.int64), bounds[:-1])
            lost = np.flatnonzero(~known)
            rest = pa.LargeListArray.from_arrays(np.searchsorted(lost, bounds), pa.array(signed[lost])).cast(pa.list_(pa.int64()))
            yield from pa.table(
                [*rows.columns, pa.array(np.diff(bounds)), pa.array(n_known), pa.array(part), pa.array(model), rest],
                [*rows.column_names, "n_tokens", "n_known", "part", "score", "rest"],
            ).to_batches()

    scored = materialize(
        rows.select(F.monotonically_increasing_id().alias("uid"), "*").mapInArrow(
            score, "uid long, doc_id long, held_out boolean, n_tokens long, n_known long, part double, score double, rest array<long>"
        ),
        "scored",
    )
    for used in (*shared, frequent):  # the scores are written, so the executors need not hold these any longer
        used.destroy()
    rare = (
        scored.select("uid", F.explode("rest").alias("h")).groupBy("uid", "h").agg(F.count("*").alias("n")).join(counts, "h")
        .groupBy("uid").agg(F.sum("n").alias("more_known"), F.sum(F.col("n") * F.log10(F.col("c") + 1)).alias("more"))
    )
    lower = float(np.log10(total + distinct + 1))
    return scored.join(rare, "uid", "left").select(
        "doc_id", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
        F.lit(total).cast("long").alias("train_tokens"),
        (F.col("part") + F.coalesce("more", F.lit(0.0)) - F.col("n_tokens") * F.lit(lower)).alias("base_score"), "score",
    )
