"""Best-fit packing of tokenised documents into sequences of a fixed capacity, large items matched first.

Only the lengths decide how items go together, and there are no more lengths than the capacity. So the plan is made
on the counts of the lengths, whatever the number of documents: items above a third of the capacity are matched in
pairs (the longest takes the longest that still fits), then shorter ones go, longest first, where they leave the
smallest gap. The plan says which pattern of lengths fills how many sequences; the k-th item of a length takes the
k-th place for that length. Ranks inside a length come from counts per lot, so no length meets in one task.
"""

from __future__ import annotations

import json
import os
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from shelfscope.session import materialize

CAPACITY = 1024
END_ID = 2
#: Rows of one length that are ranked in one task, about.
LOT_ROWS = 500_000


#: Fixed value: how byte-level BPE files of this kind cut a text before merging.
BYTE_LEVEL_CUT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


def byte_level_ranks(file: dict) -> dict[bytes, int] | None:
    """The byte strings of a byte-level BPE file whose ids are its merge order; None for files of another kind."""
    model, cut = file["model"], file.get("pre_tokenizer") or {}
    plain = not file.get("normalizer") and not model.get("ignore_merges") and not model.get("dropout")
    if not (plain and model.get("type", "BPE") == "BPE" and cut.get("type") == "ByteLevel" and cut.get("use_regex", True) and not cut["add_prefix_space"]):
        return None
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]  # bytes that stand for themselves; the others follow from 256 on
    byte = {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(b for b in range(256) if b not in shown)}
    added = {t["content"] for t in file["added_tokens"]}
    ranks = {bytes(byte[c] for c in t): i for t, i in model["vocab"].items() if t not in added}
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["merges"]]
    in_order = [ranks.get(bytes(byte[c] for c in a + b)) for a, b in pairs]
    return ranks if None not in in_order and in_order == sorted(in_order) else None


def plain_added_tokens(file: dict) -> dict[str, int] | None:
    """The file's added tokens with their ids; None if they are not simply matched as they stand."""
    added = {t["content"]: t["id"] for t in file["added_tokens"]}
    odd = any(t.get(k) for t in file["added_tokens"] for k in ("lstrip", "rstrip", "single_word"))
    return None if odd or any(a != b and a in b for a in added for b in added) else added


class Encoder:
    """Token ids of a tokenizer file as little-endian 32-bit bytes; strings of special tokens are ordinary text, or have their ids if `special`.

    Byte-level BPE files run in the faster of the two public encoders, which gives the same ids; any other file runs in the library
    that it is made for.
    """

    def __init__(self, tokenizer_json: str, special: bool = False):
        self.file, self.special, self.library = tokenizer_json, special, None
        file = json.loads(tokenizer_json)
        ranks, added = byte_level_ranks(file), plain_added_tokens(file) if special else {}
        if ranks and added is not None:
            import tiktoken

            encoding = tiktoken.Encoding("file", pat_str=BYTE_LEVEL_CUT, mergeable_ranks=ranks, special_tokens=added)
            self.fast = lambda text: encoding.encode_to_numpy(text, allowed_special="all", disallowed_special=()).astype("<u4").tobytes()
        else:
            self.fast = None

    def ids(self, text: str) -> bytes:
        if self.fast:
            try:
                return self.fast(text)
            except ValueError:  # its pattern matcher gives up on a million blanks in a row; the library has the same ids for them
                pass
        if self.library is None:
            from tokenizers import Tokenizer

            self.library = Tokenizer.from_str(self.file)
            self.library.encode_special_tokens = not self.special
        return np.array(self.library.encode(text, add_special_tokens=False).ids, "<u4").tobytes()


def token_pieces(
    docs: DataFrame, tokenizer_path: str, id_column: str = "doc_id", text_column: str = "text", capacity: int = CAPACITY, end_id: int = END_ID
) -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32): every document's ids and `end_id`, cut only if longer than `capacity`.

    All pieces but the first are full. Ids are those of the `tokenizers` library with add_special_tokens=False: a special token's string in
    a text has that token's id. A NULL text is an empty one: a piece of one id. The tokenizer file is read
    here and sent to the executors.
    """
    with open(tokenizer_path, encoding="utf-8") as file:
        tokenizer = docs.sparkSession.sparkContext.broadcast(file.read())
    end = np.array([end_id], "<u4").tobytes()

    def encode(batches):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        encoder = Encoder(tokenizer.value, special=True)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = encoder.ids(text.as_py() or "") + end
                n = len(ids) // 4
                start, piece = 0, 0
                length = n % capacity or min(n, capacity)
                while start < n:
                    rows.append((doc_id, piece, start, length, zlib.crc32(ids[4 * start : 4 * (start + length)])))
                    start, piece, length = start + length, piece + 1, capacity
            columns = list(zip(*rows, strict=True)) or [()] * 5
            types = (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["doc_id", "piece", "start", "length", "ids_crc32"]
            )

    return docs.select(F.col(id_column).cast("long"), F.col(text_column).cast("string")).mapInArrow(
        encode, "doc_id long, piece int, start long, length long, ids_crc32 long"
    )


def packing_plan(counts: dict[int, int], capacity: int) -> list[tuple[tuple[int, ...], int]]:
    """[(lengths in one sequence, number of such sequences)] that together use every item once."""
    left = Counter({length: n for length, n in counts.items() if n})
    filled: list[tuple[tuple[int, ...], int]] = []
    open_bins: dict[int, list[list]] = {}

    def put(pattern: tuple[int, ...], n: int) -> None:
        gap = capacity - sum(pattern)
        if gap:
            open_bins.setdefault(gap, []).append([pattern, n])
        elif n:
            filled.append((pattern, n))

    for length in sorted((x for x in left if 3 * x > capacity), reverse=True):
        while left[length]:
            n = left[length]
            partner = next((p for p in range(min(length, capacity - length), capacity // 3, -1) if left[p] > (p == length)), 0)
            pairs = (n // 2 if partner == length else min(n, left[partner])) if partner else n
            put((length, partner) if partner else (length,), pairs)
            left[length] -= pairs
            if partner:
                left[partner] -= pairs
    for length in sorted((x for x in left if 3 * x <= capacity), reverse=True):
        n = left[length]
        while n:
            gap = min((g for g in open_bins if g >= length), default=0)
            each = (gap or capacity) // length
            pattern, bins = open_bins[gap].pop() if gap else ((), -(-n // each))
            if gap and not open_bins[gap]:
                del open_bins[gap]
            full = min(bins, n // each)
            if full:
                put(pattern + (length,) * each, full)
            n -= full * each
            rest = bins - full
            if rest and n:
                some = min(n, each)
                put(pattern + (length,) * some, 1)
                n, rest = n - some, rest - 1
            if rest and pattern:
                put(pattern, rest)
    return filled + [(p, n) for bins in open_bins.values() for p, n in bins if p]


def plan_places(plan: list[tuple[tuple[int, ...], int]], capacity: int) -> list[np.ndarray]:
    """Arrays, in order of code: code = length * 2**48 + first rank, first sequence, offset."""
    rows, used, sequence = [], Counter(), 0
    for pattern, n in plan:
        offset = 0
        for length in pattern:
            rows.append(((length << 48) + used[length], sequence, offset))
            used[length] += n
            offset += length
        sequence += n
    rows.sort()
    return [np.array(c, np.int64) for c in zip(*rows, strict=True)] or [np.empty(0, np.int64)] * 3


def pack(pieces: DataFrame, capacity: int = CAPACITY, lot_rows: int = LOT_ROWS) -> DataFrame:
    """Adds sequence_id and offset to rows with doc_id, piece and length (1 to `capacity`)."""
    pieces = materialize(pieces, "pieces")
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    lots = 1 + max(counts.values(), default=0) // lot_rows
    places = pieces.sparkSession.sparkContext.broadcast(plan_places(packing_plan(counts, capacity), capacity))

    dealt = pieces.withColumn("lot", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(lots)).cast("int"))
    before = (
        dealt.groupBy("length", "lot").agg(F.count("*").alias("n"))
        .select("length", "lot", (F.sum("n").over(Window.partitionBy("length").orderBy("lot")) - F.col("n")).alias("before"))
    )
    rank = F.row_number().over(Window.partitionBy("length", "lot").orderBy("doc_id", "piece", "ids_crc32")) - 1
    ranked = dealt.withColumn("rank", rank).join(before, ["length", "lot"]).withColumn("rank", F.col("rank") + F.col("before"))
    names = pieces.columns

    def place(batches):
        code, sequence, offset = places.value
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            wanted = (batch.column("length").to_numpy() << 48) + rank
            at = np.searchsorted(code, wanted, "right") - 1
            yield pa.RecordBatch.from_arrays(
                [*[batch.column(c) for c in names], pa.array(sequence[at] + wanted - code[at]), pa.array(offset[at])],
                [*names, "sequence_id", "offset"],
            )

    schema = pieces.schema.add("sequence_id", "long").add("offset", "long")
    return ranked.select(*names, "rank").mapInArrow(place, schema)


def pack_documents(docs: DataFrame, tokenizer_path: str, **settings) -> DataFrame:
    """One row per piece: doc_id, piece, start, length, ids_crc32, sequence_id, offset.

    Documents repeat in the result as often as in the input; empty tables give no rows.
    """
    return pack(token_pieces(docs, tokenizer_path, **settings), settings.get("capacity", CAPACITY))
