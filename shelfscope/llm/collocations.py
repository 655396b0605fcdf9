"""Collocations by best-first branch and bound over prefixes.

A phrase grows word by word. All phrases that begin with p occur at most f(p) times, so none of them can score more than
2000000 f(p) / (f(first word of p) + f(p)): the count of a prefix bounds all of its extensions. Words are expanded first (their
bound is the highest score there is), which gives all pairs. From then on every language has a score to settle, first
that of its 2 * top-th pair. Only prefixes whose bound reaches that score are expanded, best first, by counting their extensions in the
texts, and with them those prefixes that a decision about such phrases needs: neighbours that may drop a phrase, and
the inner counts of its cuts. If fewer than `top` phrases of a language survive at its score, the score goes down and the
next part of the frontier is expanded; a language without further pairs has its whole frontier expanded.

Counting is a pass over the texts. Tasks count 64-bit word hashes in Arrow batches and send one row per phrase; Bloom
filters over the frontier, sized by its length up to a bound, keep other phrases from being counted, and joins on the
counted rows make that exact.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfscope.llm.blocks import BLOCK_SCHEMA, block_rows, merged_blocks
from shelfscope.llm.words import WordHasher, mix, odd_numbers
from shelfscope.session import materialize

TOP, AT_LEAST, LONGEST = 2000, 30, 4
FULL = 2_000_000
#: A phrase goes if a longer one that holds it has this many hundredths of its count.
COVERED = 80
NO_LANGUAGE = "und"
#: Bytes that end a piece, and those that only end a word.
PIECE_ENDS, WORD_ENDS = b".,;:!?\n\v\f\r", b" \t"
#: Bytes of text that are hashed at once; the work arrays take some 60 for each.
BLOCK = 1 << 18
#: Different phrases that a task holds before it sends them, and how many it sends in one batch.
HELD, SENT = 1 << 17, 1 << 16
#: Bits of a broadcast filter: ten for each key, 32 MB at most. Beyond that it lets more pass, and the join does the rest.
MIN_BITS, MAX_BITS = 1 << 16, 1 << 28

POSITIONS = odd_numbers(37, 64)


class PieceHasher(WordHasher):
    """Hashes words between white space and punctuation; A-Z count as a-z."""

    def __init__(self):
        super().__init__(lower=True, block=BLOCK)
        self.values[list(PIECE_ENDS + WORD_ENDS)] = 0
        self.ends = np.zeros(256, bool)
        self.ends[list(PIECE_ENDS)] = True

    def pieces(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(hashes, first byte, piece) of all words; documents that begin at `starts` share no piece."""
        hashes, first = self.hashes(data, starts)
        ends = self.ends[data].astype(np.int64)
        np.add.at(ends, starts[starts < len(data)], 1)
        return hashes, first, np.cumsum(ends)[first]


def piece_blocks(texts: pa.Array, hasher: PieceHasher) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """(bytes, starts of documents, hashes, first bytes, pieces) of some documents at a time; long texts are hashed in sections."""
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    row = 0
    while row < len(texts):
        last = max(row + 1, int(np.searchsorted(offsets, offsets[row] + BLOCK, "right")) - 1)
        part, starts = data[offsets[row] : offsets[last]], offsets[row:last] - offsets[row]
        if len(part) <= BLOCK:
            yield (part, starts, *hasher.pieces(part, starts))
        else:
            found, at, piece = [], 0, 0
            while at < len(part):
                end = min(at + BLOCK, len(part))
                while end < len(part):
                    gap = np.flatnonzero(hasher.values[part[end : end + BLOCK]] == 0)
                    end = end + int(gap[0]) if len(gap) else min(end + BLOCK, len(part))
                    if len(gap):
                        break
                section = part[at:end]
                hashes, first, pieces = hasher.pieces(section, np.empty(0, np.int64))
                found.append((hashes, first + at, pieces + piece))
                piece += int(hasher.ends[section].sum())
                at = end
            yield (part, starts, *(np.concatenate([f[k] for f in found]) for k in range(3)))
        row = last


def language_number(lang: str) -> np.uint64:
    return np.frombuffer(hashlib.blake2b(lang.encode("utf-8", "surrogatepass"), digest_size=8).digest(), np.uint64)[0]


def phrase_keys(words: list[np.ndarray], language: np.ndarray | np.uint64) -> np.ndarray:
    """One 64-bit key per phrase of a language, told apart by length, words and their order."""
    with np.errstate(over="ignore"):
        total = words[0] * POSITIONS[8 * len(words)] + language * POSITIONS[0]
        for i, w in enumerate(words[1:], 1):
            total = total + w * POSITIONS[8 * len(words) + i]
        return mix(total)


# ---- filters


def _places(keys: np.ndarray, bits: int) -> list[np.ndarray]:
    again = mix(keys * np.uint64(0x9E3779B97F4A7C15))
    return [(h >> np.uint64(8)) & np.uint64(bits - 1) for h in (keys, again, keys + again)]


def key_filter(keys: DataFrame, column: str = "key") -> np.ndarray:
    """A Bloom filter over long values; its width follows their number up to MAX_BITS."""
    rows = keys.select(F.col(column).alias("key"))
    bits = min(MAX_BITS, max(MIN_BITS, 1 << math.ceil(math.log2(10 * max(1, rows.count())))))

    def fill(batches):
        cells = np.zeros(bits // 8, np.uint8)
        for batch in batches:
            for place in _places(batch.column(0).to_numpy().view(np.uint64), bits):
                np.bitwise_or.at(cells, place >> np.uint64(3), np.uint8(1) << (place & np.uint64(7)).astype(np.uint8))
        yield block_rows(cells)

    return merged_blocks(rows.mapInArrow(fill, BLOCK_SCHEMA), bits // 8, "uint8", bits=True)


def passes(cells: np.ndarray, keys: np.ndarray) -> np.ndarray:
    found = np.ones(len(keys), bool)
    for place in _places(keys, 8 * len(cells)):
        found &= (cells[place >> np.uint64(3)] >> (place & np.uint64(7)).astype(np.uint8)) & np.uint8(1) == 1
    return found


# ---- counting


class Tally:
    """Counts per phrase key with what belongs to the key; what has grown too long is handed out."""

    def __init__(self):
        self.parts, self.length = [], 0

    def add(self, keys: np.ndarray, counts: np.ndarray, *columns: np.ndarray) -> None:
        self.parts.append((keys, counts, *columns))
        self.length += len(keys)
        if self.length > 2 * HELD:
            self.parts = [self.merged()]
            self.length = len(self.parts[0][0])

    def full(self) -> bool:
        return self.length > HELD

    def merged(self) -> tuple[np.ndarray, ...]:
        keys, counts, *columns = (np.concatenate([p[i] for p in self.parts]) for i in range(len(self.parts[0])))
        keys, first, place = np.unique(keys, return_index=True, return_inverse=True)
        total = np.zeros(len(keys), np.int64)
        np.add.at(total, place, counts)
        return (keys, total, *(c[first] for c in columns))

    def take(self) -> tuple[np.ndarray, ...] | None:
        if not self.parts:
            return None
        out, self.parts, self.length = self.merged(), [], 0
        return out


def by_language(batch: pa.RecordBatch) -> Iterator[tuple[str, pa.Array]]:
    langs = batch.column("lang").dictionary_encode()
    for code, lang in enumerate(langs.dictionary.to_pylist()):
        yield lang, batch.column("text").filter(pc.equal(langs.indices, code))


def count_words(texts: DataFrame) -> DataFrame:
    """(lang, w, word, f): every word of every language."""

    def count(batches):
        hasher, names, tally = PieceHasher(), [], Tally()
        lower = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))

        def rows():
            taken = tally.take()
            if taken is not None:
                _, counts, lang, w, word = taken
                for at in range(0, len(w), SENT):
                    some = slice(at, at + SENT)
                    yield pa.RecordBatch.from_arrays(
                        [
                            pa.array([names[i] for i in lang[some]], pa.string()), pa.array(w[some].view(np.int64)),
                            pa.array(word[some], pa.string()), pa.array(counts[some]),
                        ],
                        ["lang", "w", "word", "f"],
                    )

        for batch in batches:
            for lang, part in by_language(batch):
                names.append(lang)
                number = language_number(lang)
                for data, starts, hashes, first, _ in piece_blocks(part, hasher):
                    if not len(hashes):
                        continue
                    w, at, counts = np.unique(hashes, return_index=True, return_counts=True)
                    stops = np.union1d(np.flatnonzero(hasher.values[data] == 0), np.append(starts, len(data)))
                    begin = first[at]
                    end = stops[np.searchsorted(stops, begin, "right")]
                    raw = data.tobytes()
                    word = np.array(
                        [raw[b:e].translate(lower).decode("utf-8", "replace") for b, e in zip(begin.tolist(), end.tolist(), strict=True)], object
                    )
                    tally.add(phrase_keys([w], number), counts, np.full(len(w), len(names) - 1), w, word)
                    if tally.full():
                        yield from rows()
        yield from rows()

    return texts.mapInArrow(count, "lang string, w long, word string, f long").groupBy("lang", "w").agg(F.min("word").alias("word"), F.sum("f").alias("f"))


def count_phrases(texts: DataFrame, size: int, begins: np.ndarray, ends: np.ndarray, end_size: int, at_least: int) -> DataFrame:
    """(lang, w1 .. w{size}, a): phrases of `size` words counted `at_least` times.

    Only those count whose first size - 1 words pass the filter `begins` and whose last `end_size` words pass `ends`.
    """
    spark = texts.sparkSession
    shared = spark.sparkContext.broadcast((begins, ends))
    words = [f"w{i}" for i in range(1, size + 1)]

    def count(batches):
        hasher, names, tally = PieceHasher(), [], Tally()
        first_ok, last_ok = shared.value

        def rows():
            taken = tally.take()
            if taken is not None:
                _, counts, lang, *w = taken
                for at in range(0, len(counts), SENT):
                    some = slice(at, at + SENT)
                    yield pa.RecordBatch.from_arrays(
                        [pa.array([names[i] for i in lang[some]], pa.string()), *(pa.array(x[some].view(np.int64)) for x in w), pa.array(counts[some])],
                        ["lang", *words, "a"],
                    )

        for batch in batches:
            for lang, part in by_language(batch):
                names.append(lang)
                number = language_number(lang)
                for _, _, hashes, _, piece in piece_blocks(part, hasher):
                    if len(hashes) < size:
                        continue
                    at = np.flatnonzero(piece[: len(piece) - size + 1] == piece[size - 1 :])
                    at = at[passes(first_ok, phrase_keys([hashes[at + i] for i in range(size - 1)], number))]
                    at = at[passes(last_ok, phrase_keys([hashes[at + i] for i in range(size - end_size, size)], number))]
                    if not len(at):
                        continue
                    keys, some, counts = np.unique(phrase_keys([hashes[at + i] for i in range(size)], number), return_index=True, return_counts=True)
                    at = at[some]
                    tally.add(keys, counts, np.full(len(at), len(names) - 1), *(hashes[at + i] for i in range(size)))
                    if tally.full():
                        yield from rows()
        yield from rows()

    schema = "lang string, " + ", ".join(f"{w} long" for w in words) + ", a long"
    found = texts.mapInArrow(count, schema).groupBy("lang", *words).agg(F.sum("a").alias("a"))
    return found.where(F.col("a") >= at_least)


def keyed(phrases: DataFrame, size: int) -> DataFrame:
    """Phrases with the keys of themselves and of the two parts of every cut: left1, right1, .. (NULL where there is no cut)."""
    words, cuts = [f"w{i}" for i in range(1, size + 1)], range(1, LONGEST)

    def add(batches):
        for batch in batches:
            langs = np.array([language_number(x) for x in batch.column("lang").to_pylist()], np.uint64)
            w = [batch.column(x).to_numpy().view(np.uint64) for x in words]

            def keys(low, high):
                if not low < high <= size:
                    return pa.nulls(batch.num_rows, pa.int64())
                return pa.array(phrase_keys(w[low:high], langs).view(np.int64))

            whole = pa.array(phrase_keys(w, langs).view(np.int64)) if batch.num_rows else pa.nulls(0, pa.int64())
            sides = [k for c in cuts for k in ((keys(0, c), keys(c, size)) if c < size else (keys(1, 1), keys(1, 1)))]
            padded = [*(pa.array(x.view(np.int64)) for x in w), *[pa.nulls(batch.num_rows, pa.int64())] * (LONGEST - size)]
            yield pa.RecordBatch.from_arrays([batch.column("lang"), whole, batch.column("a"), *padded, *sides], names)

    names = ["lang", "key", "a", *(f"w{i}" for i in range(1, LONGEST + 1)), *(n for c in cuts for n in (f"left{c}", f"right{c}"))]
    schema = "lang string, " + ", ".join(f"{n} long" for n in names[1:])
    return phrases.mapInArrow(add, schema)


# ---- bounds and decisions; products are decimals, they may pass 64 bits


def _wide(name: str) -> str:
    return f"cast({name} as decimal(20, 0))"


def scored(phrases: DataFrame, counts: DataFrame, size: int) -> DataFrame:
    """Phrases with k, l, r and score of their lowest cut; those with a cut whose parts are not counted are left out."""
    cuts = F.explode(F.array(*[F.struct(F.lit(c).alias("k"), F.col(f"left{c}").alias("left"), F.col(f"right{c}").alias("right")) for c in range(1, size)]))
    parts = phrases.select("key", "a", cuts.alias("cut")).select("key", "a", "cut.*")
    left, right = counts.select(F.col("key").alias("left"), F.col("f").alias("l")), counts.select(F.col("key").alias("right"), F.col("f").alias("r"))
    score = F.expr(f"({_wide(str(FULL))} * {_wide('a')}) div ({_wide('l')} + {_wide('r')})")
    lowest = (
        parts.join(left, "left").join(right, "right").withColumn("score", score)
        .groupBy("key").agg(F.count("*").alias("cuts"), F.min(F.struct("score", "k", "l", "r")).alias("lowest"))
        .where(F.col("cuts") == size - 1)
    )
    return phrases.join(lowest.select("key", "lowest.*"), "key")


def reaching(prefixes: DataFrame) -> DataFrame:
    """Prefixes one of whose extensions may have a score of `goal`, by their counts a and that of their first word, `first`."""
    return prefixes.where(f"{_wide(str(FULL))} * a >= {_wide('goal')} * ({_wide('first')} + {_wide('a')})")


def pairs_to_expand(pairs: DataFrame) -> DataFrame:
    """Keys of the pairs whose extensions have to be counted; `pairs` has first, score and goal."""
    reach = reaching(pairs).select("key", "left1", "right1", "first", "goal")
    high = pairs.where("score >= goal")
    # any phrase w1 .. with a score of `goal` has a count x with x (FULL - goal) >= goal * f(w1)
    least = f"a * ({_wide(str(FULL))} - {_wide('goal')}) >= "
    inner = reach.groupBy(F.col("right1").alias("left1")).agg(F.min("first").alias("smallest"))
    before = reach.select(F.col("left1").alias("right1"), F.col("first").alias("own")).distinct()
    rival = high.groupBy(F.col("left1").alias("right1")).agg(F.min("a").alias("smallest"))
    needed = [
        reach.select("key"),
        high.select("key"),
        # (w2, w3) of a phrase w1 w2 w3 w4: its counts are the right parts of cuts
        pairs.join(inner, "left1").where(least + f"{_wide('goal')} * {_wide('smallest')}").select("key"),
        # (x, w1) before a longer phrase w1 ..: x w1 .. may cover it
        pairs.join(before, "right1").where(f"100 * {least} {COVERED} * {_wide('goal')} * {_wide('own')}").select("key"),
        # (x, w1) before a pair w1 w2
        pairs.join(rival, "right1").where(f"100 * {_wide('a')} >= {COVERED} * {_wide('smallest')}").select("key"),
    ]
    return reduce(DataFrame.union, needed).distinct()


def triples_to_expand(triples: DataFrame) -> DataFrame:
    """The same for triples: what may score, what may be covered, and x w1 w2 before a triple w1 w2 w3."""
    high = triples.where("score >= goal")
    rival = high.groupBy(F.col("left2").alias("right1")).agg(F.min("a").alias("smallest"))
    needed = [
        reaching(triples).select("key"), high.select("key"),
        triples.join(rival, "right1").where(f"100 * {_wide('a')} >= {COVERED} * {_wide('smallest')}").select("key"),
    ]
    return reduce(DataFrame.union, needed).distinct()


def not_covered(phrases: DataFrame, longer: DataFrame, size: int) -> DataFrame:
    """Phrases that no phrase of one more word covers. A still longer one has no higher count than one of these."""
    around = longer.select(F.col(f"left{size}").alias("key"), "a").union(longer.select(F.col("right1").alias("key"), "a"))
    most = around.groupBy("key").agg(F.max("a").alias("most"))
    return phrases.join(most, "key", "left").where(f"most is null or 100 * {_wide('most')} < {COVERED} * {_wide('a')}").drop("most")


def mine_phrases(
    docs: DataFrame, text_column: str = "text", lang_column: str = "lang", top: int = TOP, at_least: int = AT_LEAST, rounds: list | None = None,
) -> DataFrame:
    """The `top` best phrases of two to four words of every language: lang, rank, phrase, a, l, r, n, score.

    NULL texts are empty, a NULL language is `und`. A-Z are lower-cased; pieces end at `.,;:!?` and line ends, words at blanks and tabs.
    f counts occurrences inside pieces, overlaps and repeated rows included. Score, cut, coverage and order are those of the module's
    query: floor(2000000 a / (l + r)) of the lowest cut, phrases covered by a longer one with 0.8 of their count go, equal scores rank by a
    and then by the phrase's bytes. A language with fewer phrases returns all, an empty table gives no rows. Whole texts are
    read; other columns are not. Words and phrases are told apart by 64 bits. `rounds` receives what each round expanded.
    """
    texts = docs.select(F.coalesce(F.col(lang_column).cast("string"), F.lit(NO_LANGUAGE)).alias("lang"), F.col(text_column).cast("string").alias("text"))
    words = materialize(count_words(texts), "words")
    totals = words.groupBy("lang").agg(F.sum("f").alias("n"))

    def key_words(batches):
        for batch in batches:
            langs = np.array([language_number(x) for x in batch.column("lang").to_pylist()], np.uint64)
            keys = phrase_keys([batch.column("w").to_numpy().view(np.uint64)], langs) if batch.num_rows else np.empty(0, np.uint64)
            yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64)), *batch.columns], ["key", *batch.schema.names])

    common = materialize(words.where(F.col("f") >= at_least).mapInArrow(key_words, "key long, lang string, w long, word string, f long"), "common-words")
    firsts = common.select(F.col("key").alias("left1"), F.col("f").alias("first"))
    word_filter = key_filter(common)
    pairs = keyed(count_phrases(texts, 2, word_filter, word_filter, 1, at_least), 2)
    counts = common.select("key", "f")
    pairs = materialize(scored(pairs, counts, 2).join(firsts, "left1"), "pairs")
    counts = counts.union(pairs.select("key", F.col("a").alias("f")))
    pair_filter = key_filter(pairs)

    known: dict[int, DataFrame | None] = {3: None, 4: None}
    expanded: dict[int, DataFrame | None] = {2: None, 3: None}
    place = Window.partitionBy("lang").orderBy(F.desc("score"))
    settled, depth = None, 2 * top
    while True:
        best = pairs.select("lang", "score", F.row_number().over(place).alias("place")).where(F.col("place") <= depth)
        goals = best.groupBy("lang").agg(F.when(F.max("place") == depth, F.min("score")).otherwise(0).alias("goal"))
        if settled is not None:
            old = settled.select("lang", F.col("goal").alias("settled"))
            goals = goals.join(old, "lang", "left").select("lang", F.coalesce("settled", "goal").alias("goal"))
        goals = materialize(goals, "goals")

        for size, choose in ((3, pairs_to_expand), (4, triples_to_expand)):
            shorter = pairs if size == 3 else scored(known[3].drop("first"), counts, 3).join(firsts, "left1")
            keys = choose(shorter.join(goals, "lang"))
            if expanded[size - 1] is not None:
                keys = keys.join(expanded[size - 1], "key", "left_anti")
            keys = materialize(keys, f"expand-{size - 1}")
            if rounds is not None:
                rounds.append((size, keys.count()))
            found = count_phrases(texts, size, key_filter(keys), pair_filter, 2, at_least)
            new = keyed(found, size).join(keys.withColumnRenamed("key", f"left{size - 1}"), f"left{size - 1}", "left_semi")
            new = materialize(new, f"phrases-{size}")
            known[size] = new if known[size] is None else known[size].unionByName(new)
            expanded[size - 1] = keys if expanded[size - 1] is None else expanded[size - 1].union(keys)
            if size == 3:
                counts = counts.union(new.select("key", F.col("a").alias("f")))

        columns = ["lang", "key", "a", "l", "r", "score", *(f"w{i}" for i in range(1, LONGEST + 1))]
        survivors = reduce(DataFrame.union, [
            not_covered(rows.join(goals, "lang").where("score >= goal"), longer, size).select(*columns) if longer is not None
            else rows.join(goals, "lang").where("score >= goal").select(*columns)
            for size, rows, longer in (
                (2, pairs, known[3]), (3, scored(known[3], counts, 3), known[4]), (4, scored(known[4], counts, 4), None),
            )
        ])
        survivors = materialize(survivors, "survivors")
        left = goals.join(survivors.groupBy("lang").agg(F.count("*").alias("survive")), "lang", "left")
        done = (F.col("goal") == 0) | (F.coalesce("survive", F.lit(0)) >= top)
        if left.where(~done).isEmpty():
            break
        settled, depth = left.where(done).select("lang", "goal"), 4 * depth

    # rows at or above the score of the top-th, before their words are looked up
    ranks = survivors.withColumn("place", F.rank().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a")))).where(F.col("place") <= top)
    for i in range(1, LONGEST + 1):
        text = common.select("lang", F.col("w").alias(f"w{i}"), F.col("word").alias(f"text{i}"))
        ranks = ranks.join(text, ["lang", f"w{i}"], "left")
    ranks = ranks.withColumn("phrase", F.concat_ws(" ", *[f"text{i}" for i in range(1, LONGEST + 1)])).join(totals, "lang")
    order = Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase")
    return (
        ranks.withColumn("rank", F.row_number().over(order).cast("long")).where(F.col("rank") <= top)
        .select("lang", "rank", "phrase", "a", "l", "r", "n", F.col("score").cast("long").alias("score"))
    )
