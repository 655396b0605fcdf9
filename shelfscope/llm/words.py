"""Words of whole texts as 64-bit hashes, computed for many documents at once.

A word is a longest run of bytes outside `[\\x20\\x09-\\x0D]`. All of these are single bytes in UTF-8, so the
rules work on the bytes of an Arrow string column without decoding them.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes hashed at once. A longer text is cut at white space, so memory does not follow its length 60-fold.
BLOCK = 1 << 20

SPACES = b" \t\n\v\f\r"


def odd_numbers(seed: int, n: int) -> np.ndarray:
    return np.random.Generator(np.random.PCG64(seed)).integers(0, 2**63, n, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(h: np.ndarray) -> np.ndarray:
    """Spreads every input bit over the 64 bits of the result; one to one."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int, inverse: bool = False) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, or of the base's inverse."""
    base = int(odd_numbers(11, 1)[0])
    out = np.full(n, pow(base, -1, 2**64) if inverse else base, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def byte_values(lower: bool) -> np.ndarray:
    """A random number for every byte value, 0 for white space; with `lower`, A-Z count as a-z."""
    values = odd_numbers(7, 256)
    values[list(SPACES)] = 0
    if lower:
        values[ord("A") : ord("Z") + 1] = values[ord("a") : ord("z") + 1]
    return values


class WordHasher:
    """Made once per task; `hashes` needs a block of bytes and the places in it where documents start."""

    def __init__(self, lower: bool, block: int | None = None):
        self.block = block or BLOCK
        self.values, self.power, self.back = byte_values(lower), powers(self.block), powers(self.block, inverse=True)

    def hashes(self, data: np.ndarray, starts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of all words, and the byte where each begins."""
        if len(data) > len(self.power):
            self.power, self.back = powers(2 * len(data)), powers(2 * len(data), inverse=True)
        value = self.values[data]
        inside = value != 0
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        at = starts[starts < len(data)]
        begins[at] = inside[at]
        first = np.flatnonzero(begins)
        if not len(first):
            return np.empty(0, np.uint64), first
        return mix(np.add.reduceat(value * self.power[: len(data)], first) * self.back[first]), first

    def long_text(self, data: np.ndarray) -> np.ndarray:
        """The hashes of one text of any length, cut before white space."""
        parts, at = [], 0
        while at < len(data):
            end = min(at + self.block, len(data))
            while end < len(data):
                gap = np.flatnonzero(self.values[data[end : end + self.block]] == 0)
                end = min(end + int(gap[0]), len(data)) if len(gap) else min(end + self.block, len(data))
                if len(gap):
                    break
            parts.append(self.hashes(data[at:end], np.zeros(1, np.int64))[0])
            at = end
        return np.concatenate(parts)


def word_blocks(texts: pa.Array | pa.ChunkedArray, hasher: WordHasher) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(first row, row after the last, word hashes, bounds): row first + i has hashes[bounds[i]:bounds[i + 1]].

    A NULL text has no words.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    _, offsets, data = texts.buffers()
    n = len(texts)
    offsets = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.empty(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + hasher.block, "right")) - 1)
        low, high = offsets[first], offsets[last]
        if high - low > hasher.block:
            hashes = hasher.long_text(data[low:high])
            bounds = np.array([0, len(hashes)])
        else:
            hashes, begins = hasher.hashes(data[low:high], offsets[first:last] - low)
            bounds = np.searchsorted(begins, offsets[first : last + 1] - low)
        yield first, last, hashes, bounds
        first = last


def grams(hashes: np.ndarray, n: int) -> np.ndarray:
    """A hash of every n consecutive words, document bounds not regarded; built from grams of half the length."""
    if len(hashes) < n:
        return np.empty(0, np.uint64)
    factor = odd_numbers(23, 128)
    total, have, part, width = None, 0, hashes, 1
    left = n
    while left:
        if left & 1:
            piece = part[have : have + len(hashes) - n + 1] * factor[2 * width.bit_length()]
            total, have = piece if total is None else total * factor[0] + piece, have + width
        left >>= 1
        if left:
            part = part[:-width] * factor[2 * width.bit_length() + 1] + part[width:]
            width *= 2
    return mix(total)


def inside_documents(bounds: np.ndarray, n_words: int, n: int) -> np.ndarray:
    """Of the n-grams beginning at words 0, 1, ..: does it end in the document where it begins?"""
    if n_words < n:
        return np.empty(0, bool)
    document = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    return document[: n_words - n + 1] == document[n - 1 :]
