"""N-gram Jaccard join: documents whose sets of word shingles overlap by a given share, exactly.

Method: prefix filters under several global token orders. If two sets reach the similarity, then under *every*
order of all tokens they share a token among the first n - ceil(share * n) + 1 of each. Candidates have to pass this
for order 0, by which they are found, then for orders 1 and 2, whose prefixes are joined to the pairs; what passes all of
them is verified by counting the whole sets.

* All orders put tokens that many documents hold last, so prefixes consist of rare tokens wherever a document has them.
  How common a token is comes from a merged sketch of fixed size over all documents; any sketch gives a right order.
* A row of order 0 carries the parities of its set's tokens in SIGNATURE classes. Two sets differ in at least as many
  tokens as their parities do, so most pairs that are alike but not alike enough are never listed. In sets far larger than
  the signature it stops nothing and the other filters are left.
* A row of order 0 also carries the BEFORE tokens that stand before its own in its set. A pair that shares one of them is
  listed there or earlier, so it is not listed again; its first common token always lists it.
* Equal sets are one node. Sets that share a min-hash are tried first against one pivot each; what is linked by
  that is one component, and pairs inside a component need not be listed or verified again. So a group of thousands
  of near copies costs a pair per copy, not one per pair of copies; links between different components are all tried.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfscope.llm.blocks import BLOCK_SCHEMA, block_rows, collected_blocks, id_filter, may_hold, summed_blocks, whole_keys
from shelfscope.llm.components import components
from shelfscope.llm.words import WordHasher, grams, inside_documents, mix, odd_numbers, word_blocks
from shelfscope.session import materialize

WIDTH = 5
SHARE = (80, 100)
#: Counters of the frequency sketch, merged over all tasks (bytes on each executor).
SKETCH = 1 << 22
MIN_HASHES = 4
#: Parities in the signature of a set; a multiple of 64.
SIGNATURE = 512
#: Tokens of a prefix that a row knows to stand before its own, by which repeated listings of a pair are told.
BEFORE = 8
#: Groups of a token up to this size are paired by arrays of equal size, larger ones component by component.
SMALL = 32
#: Pairs that are looked at together.
PAIRS = 1 << 18
#: Partners of one document that are verified in one group.
PARTNERS = 64


def least_overlap(n: np.ndarray, m: np.ndarray, share: tuple[int, int]) -> np.ndarray:
    """The smallest |A & B| with |A & B| / |A | B| >= share, for set sizes n and m."""
    part, whole = share
    return -(-part * (n + m) // (part + whole))


def prefix_length(n: int, share: tuple[int, int]) -> int:
    part, whole = share
    return n - -(-part * n // whole) + 1


def shingle_sets(texts: pa.Array, hasher: WordHasher, width: int) -> Iterator[np.ndarray]:
    """The set of every text as sorted 64-bit hashes. Fewer than `width` words are one shingle, none are none."""
    salt = odd_numbers(31, width + 1)
    for first, last, words, bounds in word_blocks(texts, hasher):
        all_grams = grams(words, width)
        for i in range(last - first):
            low, high = bounds[i], bounds[i + 1]
            if high - low >= width:
                yield np.unique(all_grams[low : high - width + 1])
            elif high > low:
                short = words[low:high]
                yield mix((short * salt[: len(short)]).sum(keepdims=True) + salt[width:] * np.uint64(len(short)))
            else:
                yield np.empty(0, np.uint64)


def _as_long(h: np.ndarray) -> pa.Array:
    return pa.array(h.view(np.int64))


def _order(tokens: np.ndarray, k: int) -> np.ndarray:
    """The tokens' places in order k among tokens equally common; one to one."""
    return mix(tokens * odd_numbers(41 + k, 1)[0] + np.uint64(k))


def _prefix(tokens: np.ndarray, k: int, ranks: np.ndarray, share: tuple[int, int]) -> np.ndarray:
    """The first tokens of a set under order k, as keys."""
    keys = _order(tokens, k)
    common = ranks[(tokens >> np.uint64(40)) % np.uint64(len(ranks))]
    return keys[np.lexsort((keys, common))[: prefix_length(len(keys), share)]]


def _signatures(docs: DataFrame, width: int, sketch: int) -> DataFrame:
    """One pass over the texts: a row per document, and the frequency sketch of every task."""
    schema = f"doc_id long, n int, digest binary, sid long, anchors array<long>, {BLOCK_SCHEMA}"

    def sign(batches):
        hasher, salts = WordHasher(lower=True), odd_numbers(43, MIN_HASHES)
        counts, seen = np.zeros(sketch, np.uint8), set()

        def note(held: list[np.ndarray]) -> None:
            add = np.bincount(np.concatenate(held).astype(np.int64), minlength=sketch)
            np.minimum(add + counts, 255, out=add)
            counts[:] = add

        held, size = [], 0
        for batch in batches:
            n, digests, sids, anchors = [], [], [], []
            for tokens in shingle_sets(batch.column("text"), hasher, width):
                digest = hashlib.blake2b(tokens.tobytes(), digest_size=16).digest()
                n.append(len(tokens))
                digests.append(digest)
                sids.append(int.from_bytes(digest[:8], "little", signed=True))
                anchors.append(
                    [int(mix(tokens ^ s).min().view(np.int64)) for s in salts] if len(tokens) else None
                )
                if digest not in seen and len(tokens):
                    seen.add(digest)
                    held.append(((tokens >> np.uint64(40)) % np.uint64(sketch)).astype(np.uint32))
                    size += len(tokens)
                    if size > 1 << 22:
                        note(held)
                        held, size = [], 0
            rows = batch.num_rows
            yield pa.RecordBatch.from_arrays(
                [
                    batch.column("doc_id"), pa.array(n, pa.int32()), pa.array(digests, pa.binary()), pa.array(sids, pa.int64()),
                    pa.array(anchors, pa.list_(pa.int64())), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary()),
                ],
                ["doc_id", "n", "digest", "sid", "anchors", "block", "cells"],
            )
        if held:
            note(held)
        table = block_rows(counts)
        rows = table.num_rows
        yield pa.RecordBatch.from_arrays(
            [
                pa.nulls(rows, pa.int64()), pa.nulls(rows, pa.int32()), pa.nulls(rows, pa.binary()), pa.nulls(rows, pa.int64()),
                pa.nulls(rows, pa.list_(pa.int64())), table.column(0), table.column(1),
            ],
            ["doc_id", "n", "digest", "sid", "anchors", "block", "cells"],
        )

    return materialize(docs.mapInArrow(sign, schema), "shingle-sets")


def _common(rows: DataFrame, sketch: int) -> np.ndarray:
    """How common the tokens of each counter are: 0 up to what chance gives, then in doublings.

    Counters become these ranks on the executors, so a byte for each arrives at the driver.
    """
    totals = materialize(summed_blocks(rows.where("block is not null").select("block", "cells"), "uint8"), "token-counts")

    def add_up(batches):
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array([int(c.sum()) for c in counters(batch)], pa.int64())], ["n"])

    def rank(batches):
        for batch in batches:
            ranks = [np.where(c > usual, np.log2(np.maximum(c, 1) / usual) + 1, 0).astype(np.uint8).tobytes() for c in counters(batch)]
            yield pa.RecordBatch.from_arrays([batch.column("block"), pa.array(ranks, pa.binary())], ["block", "cells"])

    def counters(batch):
        return (np.frombuffer(cells.as_buffer(), np.int64) for cells in batch.column("cells"))

    usual = (totals.mapInArrow(add_up, "n long").agg(F.sum("n").alias("n")).first()["n"] or 0) / sketch
    usual = max(8.0, usual + 8 * usual**0.5)
    return collected_blocks(totals.mapInArrow(rank, BLOCK_SCHEMA), sketch, np.uint8)


def signature(tokens: np.ndarray) -> np.ndarray:
    """Whether the number of tokens in each of SIGNATURE classes is odd, as bits of 64-bit words."""
    classes = mix(tokens ^ odd_numbers(47, 1)[0]) % np.uint64(SIGNATURE)
    odd = np.bincount(classes.astype(np.int64), minlength=SIGNATURE) & 1
    return np.packbits(odd.astype(np.uint8)).view(np.int64)


PREFIX_SCHEMA = "token long, sid long, place long"


def _prefix_rows(docs: DataFrame, ranks, width: int, share: tuple[int, int]) -> DataFrame:
    """(token, sid, place): the prefix of every set under order 0; place is size * 2**32 + position.

    Equal sets of one task are listed once.
    """

    def list_prefixes(batches):
        hasher, seen, common = WordHasher(lower=True), set(), ranks.value
        for batch in batches:
            tokens, sids, places, held = [], [], [], 0
            for found in shingle_sets(batch.column("text"), hasher, width):
                if not len(found):
                    continue
                digest = hashlib.blake2b(found.tobytes(), digest_size=16).digest()
                if digest in seen:
                    continue
                seen.add(digest)
                first = _prefix(found, 0, common, share)
                tokens.append(first)
                sids.append(np.full(len(first), int.from_bytes(digest[:8], "little", signed=True), np.int64))
                places.append((np.int64(len(found)) << np.int64(32)) + np.arange(len(first), dtype=np.int64))
                held += len(first)
                if held > 1 << 18:
                    yield _rows(tokens, sids, places)
                    tokens, sids, places, held = [], [], [], 0
            if tokens:
                yield _rows(tokens, sids, places)

    def _rows(tokens, sids, places):
        return pa.RecordBatch.from_arrays(
            [_as_long(np.concatenate(tokens)), pa.array(np.concatenate(sids)), pa.array(np.concatenate(places))],
            ["token", "sid", "place"],
        )

    return docs.mapInArrow(list_prefixes, PREFIX_SCHEMA)


MARKS_SCHEMA = "sid long, signature array<long>, first array<long>, second array<long>"


def _marks(docs: DataFrame, ids: DataFrame, ranks, width: int, share: tuple[int, int]) -> DataFrame:
    """Signature and prefixes under orders 1 and 2 of the sets of (at least) the documents `ids`."""
    wanted = _broadcast(docs, id_filter(ids, "doc_id"))

    def mark(batches):
        hasher, common = WordHasher(lower=True), ranks.value
        for batch in batches:
            texts = batch.column("text").filter(pa.array(may_hold(wanted.value, batch.column("doc_id").fill_null(-1).to_numpy())))
            sids, signatures, prefixes, held = [], [], ([], []), 0
            for found in shingle_sets(texts, hasher, width):
                if not len(found):
                    continue
                sids.append(int.from_bytes(hashlib.blake2b(found.tobytes(), digest_size=16).digest()[:8], "little", signed=True))
                signatures.append(signature(found))
                for k in (0, 1):
                    prefixes[k].append(_prefix(found, k + 1, common, share).view(np.int64))
                held += len(prefixes[0][-1])
                if held > 1 << 18:
                    yield _rows(sids, signatures, *prefixes)
                    sids, signatures, prefixes, held = [], [], ([], []), 0
            if sids:
                yield _rows(sids, signatures, *prefixes)

    def _rows(sids, *arrays):
        lists = [
            pa.ListArray.from_arrays(np.concatenate([[0], np.cumsum([len(x) for x in a])]).astype(np.int32), pa.array(np.concatenate(a)))
            for a in arrays
        ]
        return pa.RecordBatch.from_arrays([pa.array(sids, pa.int64()), *lists], ["sid", "signature", "first", "second"])

    return materialize(docs.mapInArrow(mark, MARKS_SCHEMA).dropDuplicates(["sid", "signature"]), "marks")


def _may_link(place_a: np.ndarray, place_b: np.ndarray, share: tuple[int, int]) -> np.ndarray:
    """Size and position filter. It holds at the first token that both share, and one hit is enough."""
    n, i = place_a >> 32, place_a & 0xFFFFFFFF
    m, j = place_b >> 32, place_b & 0xFFFFFFFF
    return np.minimum(n - i, m - j) >= least_overlap(n, m, share)


def _candidates(docs: DataFrame, nodes: DataFrame, ranks, width: int, share: tuple[int, int]) -> DataFrame:
    """(a, b): pairs of nodes of different components that pass the prefix filters of all orders, a < b, each pair once.

    Rows are told their component before any pair is made: tokens of one document and tokens of one component drop out, so
    what a group of near copies shares stays as many rows as it has.
    """

    def shared_tokens(batches):
        for table in whole_keys(batches, "token"):
            token, sid, place = (table.column(c).to_numpy() for c in ("token", "sid", "place"))
            once = np.ones(len(token), bool)
            once[1:] = (token[1:] != token[:-1]) | (sid[1:] != sid[:-1])
            token, sid, place = token[once], sid[once], place[once]
            first, end = _spans(token)
            more = np.repeat(end - first > 1, end - first)
            if more.any():
                yield pa.RecordBatch.from_arrays([pa.array(x[more]) for x in (token, sid, place)], ["token", "sid", "place"])

    def list_across(batches):
        for table in whole_keys(batches, "token"):
            token, node, place, part = (table.column(c).to_numpy() for c in ("token", "node", "place", "component"))
            odd = table.column("signature").combine_chunks().flatten().to_numpy().view(np.uint64).reshape(len(token), -1)
            before = table.column("before").combine_chunks()
            counts = np.diff(before.offsets.to_numpy())
            known = np.zeros((len(token), BEFORE), np.int64)  # 0: no token
            known[np.arange(BEFORE) < counts[:, None]] = before.flatten().to_numpy()
            size = place >> 32

            def listed_before(i, j):
                again = np.zeros(len(i), bool)
                for k in range(BEFORE):
                    mine = known[i, k]
                    again |= (mine != 0) & (known[j] == mine[:, None]).any(1)
                return again

            def pairs(i, j):
                good = (part[i] != part[j]) & _may_link(place[i], place[j], share)
                i, j = i[good], j[good]
                both = size[i] + size[j]
                differ = np.zeros(len(i), np.int64)
                for word in range(odd.shape[1]):
                    differ += np.bitwise_count(odd[i, word] ^ odd[j, word])
                good = differ <= both - 2 * least_overlap(size[i], size[j], share)
                i, j = i[good], j[good]
                new = ~listed_before(i, j)
                i, j = node[i[new]], node[j[new]]
                return np.stack([np.minimum(i, j), np.maximum(i, j)], 1)

            first, end = _spans(token)
            count = end - first
            found = [np.empty((0, 2), np.int64)]
            for group in np.unique(count[count <= SMALL]):
                starts = first[count == group]
                i, j = np.triu_indices(group, 1)
                for at in range(0, len(starts), PAIRS // group**2 + 1):
                    rows = starts[at : at + PAIRS // group**2 + 1, None] + np.arange(group)
                    found.append(pairs(rows[:, i].ravel(), rows[:, j].ravel()))
            found = np.unique(np.concatenate(found), axis=0)
            if len(found):
                yield _as_pairs(found)
            for low, high in zip(first[count > SMALL], end[count > SMALL], strict=True):
                order = np.argsort(part[low:high], kind="stable") + low
                for s, e in zip(*_spans(part[order]), strict=True):
                    mine, later = order[s:e], order[e:]
                    step = max(1, PAIRS // max(1, len(later)))
                    for at in range(0, len(mine) if len(later) else 0, step):
                        some = mine[at : at + step]
                        across = pairs(np.repeat(some, len(later)), np.tile(later, len(some)))
                        if len(across):
                            yield _as_pairs(across)

    def _as_pairs(found):
        return pa.RecordBatch.from_arrays([pa.array(found[:, 0].copy()), pa.array(found[:, 1].copy())], ["a", "b"])

    shared = materialize(
        _prefix_rows(docs, ranks, width, share).repartition("token").sortWithinPartitions("token", "sid").mapInArrow(shared_tokens, PREFIX_SCHEMA)
        .join(nodes, "sid").select("token", "sid", "node", "place", "component"), "shared-tokens",
    )
    mixed = shared.groupBy("token").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x <> y").select("token")
    across = materialize(shared.join(mixed, "token"), "across")
    marks = _marks(docs, across.select(F.col("node").alias("doc_id")).distinct(), ranks, width, share)
    earlier = Window.partitionBy("sid").orderBy("place").rowsBetween(-BEFORE, -1)
    pairs = materialize(
        across.withColumn("before", F.collect_list("token").over(earlier))
        .join(marks.select("sid", "signature"), "sid").select("token", "node", "place", "component", "signature", "before")
        .repartition("token").sortWithinPartitions("token").mapInArrow(list_across, "a long, b long").distinct(), "pairs-0",
    )
    orders = marks.join(nodes, "sid")
    return (
        pairs.join(orders.select(F.col("node").alias("a"), F.col("first").alias("first_a"), F.col("second").alias("second_a")), "a")
        .join(orders.select(F.col("node").alias("b"), F.col("first").alias("first_b"), F.col("second").alias("second_b")), "b")
        .where(F.arrays_overlap("first_a", "first_b") & F.arrays_overlap("second_a", "second_b"))
        .select("a", "b").distinct()
    )


def _spans(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    first = np.flatnonzero(np.concatenate(([True], values[1:] != values[:-1]))) if len(values) else np.empty(0, int)
    return first, np.append(first[1:], len(values))


def _broadcast(frame: DataFrame, value):
    return frame.sparkSession.sparkContext.broadcast(value)


def _linked(docs: DataFrame, pairs: DataFrame, width: int, share: tuple[int, int]) -> DataFrame:
    """Of pairs (a, b) of document ids, those that reach the similarity.

    Each document's text goes once to every group of up to PARTNERS pairs that it is in.
    """
    pairs = materialize(pairs, "pairs")
    groups = pairs.groupBy("a").agg(F.ceil(F.count("*") / PARTNERS).cast("int").alias("parts"))
    dealt = pairs.join(groups, "a").withColumn("lot", F.pmod(F.xxhash64("b"), F.col("parts")).cast("int"))
    need = (
        dealt.select(F.col("b").alias("doc_id"), "a", "lot", F.lit(1).alias("side"))
        .union(dealt.select(F.col("a").alias("doc_id"), "a", "lot", F.lit(0).alias("side")).distinct())
        .withColumn("lot_id", F.xxhash64("a", "lot"))
    )
    wanted = _broadcast(docs, id_filter(need.select("doc_id").distinct(), "doc_id"))

    def involved(batches):
        for batch in batches:
            ids = batch.column("doc_id").fill_null(-1).to_numpy()
            yield batch.filter(pa.array(may_hold(wanted.value, ids)))

    def count(batches):
        hasher = WordHasher(lower=True)
        for table in whole_keys(batches, "lot_id"):
            a, side, ids = (table.column(c).to_pylist() for c in ("a", "side", "doc_id"))
            pivots: dict[int, list] = {}
            ones, others = [], []
            for sets, owner, right, doc_id in zip(shingle_sets(table.column("text"), hasher, width), a, side, ids, strict=True):
                if not right:
                    pivots.setdefault(owner, []).append(sets)
                    continue
                for other in pivots.get(owner, ()):
                    n, m = len(sets), len(other)
                    least = least_overlap(n, m, share)
                    if not n or not m or min(n, m) < least:
                        continue
                    at = np.searchsorted(other, sets)
                    at[at == m] = 0
                    if (other[at] == sets).sum() >= least:
                        ones.append(owner)
                        others.append(doc_id)
                        break
            if ones:
                yield pa.RecordBatch.from_arrays([pa.array(ones, pa.int64()), pa.array(others, pa.int64())], ["a", "b"])

    texts = docs.mapInArrow(involved, "doc_id long, text string")
    return (
        texts.join(need.hint("shuffle_hash"), "doc_id")
        .select("lot_id", "a", "side", "doc_id", "text")
        .repartition("lot_id").sortWithinPartitions("lot_id", "a", "side").mapInArrow(count, "a long, b long")
    )


def jaccard_groups(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", width: int = WIDTH,
    share: tuple[int, int] = SHARE, sketch: int = SKETCH,
) -> DataFrame:
    """One row per row of `docs`: doc_id, n_shingles, component_id, set_id (equal for equal sets).

    Two documents are linked when `share` of the union of their shingle sets is in both; component_id is the smallest
    id that links lead to, the document's own included. A NULL or empty text, or one without words, has no shingles
    and no links. A row without id has no component (NULL) and links nothing. Rows that repeat an id are one node
    with all their texts. Other columns of `docs` play no part. An empty table gives no rows.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text"))
    rows = _signatures(docs, width, sketch)
    ranks = spark.sparkContext.broadcast(_common(rows, sketch))
    signed = rows.where("block is null")
    sets = materialize(
        signed.where("n > 0 and doc_id is not null").groupBy("digest")
        .agg(F.min("doc_id").alias("node"), F.first("sid").alias("sid"), F.first("n").alias("n"), F.first("anchors").alias("anchors")),
        "sets",
    )
    copies = signed.where("n > 0 and doc_id is not null").join(
        sets.select("digest", "node"), "digest"
    ).where("doc_id <> node").select(F.col("node").alias("a"), F.col("doc_id").alias("b"))

    anchored = sets.select("node", "n", F.posexplode("anchors").alias("k", "anchor"))
    pivots = anchored.groupBy("k", "anchor").agg(F.min_by("node", "node").alias("pivot"), F.count("*").alias("c")).where("c > 1")
    first_pairs = (
        anchored.join(pivots, ["k", "anchor"]).where("node <> pivot")
        .groupBy("node", "pivot").agg(F.count("*").alias("c"))
        .groupBy("node").agg(F.max_by("pivot", F.struct("c", -F.col("pivot"))).alias("pivot"))
    )
    first_links = materialize(
        _linked(docs, first_pairs.select(F.col("pivot").alias("a"), F.col("node").alias("b")), width, share), "first-links"
    )
    merged = components(first_links, "a", "b")
    nodes = materialize(
        sets.join(merged, sets["node"] == merged["id"], "left")
        .select("sid", "node", F.coalesce("component", "node").alias("component")), "nodes",
    )
    links = materialize(_linked(docs, _candidates(docs, nodes, ranks, width, share), width, share), "links")
    found = components(first_links.union(links).union(copies), "a", "b")
    out = signed.select("doc_id", F.col("n").cast("long").alias("n_shingles"), F.col("sid").alias("set_id"))
    return (
        out.join(found.withColumnRenamed("id", "doc_id"), "doc_id", "left")
        .select("doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"), "set_id")
    )


def one_of_each_group(docs: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """The rows of `docs` whose document has the smallest id of its group; rows without id stay."""
    groups = jaccard_groups(docs, id_column, text_column)
    stay = groups.where("doc_id = component_id").select(F.col("doc_id").alias("_stay_id")).distinct()
    ids = docs[id_column].cast("long")
    return docs.join(stay, ids == stay["_stay_id"], "left_semi").union(docs.where(ids.isNull()))
