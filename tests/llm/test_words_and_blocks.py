import re

import numpy as np
import pyarrow as pa
from hypothesis import given, settings
from hypothesis import strategies as st

from shelfscope.llm import words as words_module
from shelfscope.llm.blocks import whole_keys
from shelfscope.llm.words import WordHasher, grams, inside_documents, word_blocks

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
texts = st.lists(st.none() | st.text(alphabet="aAbB \t\n\x0b\x0c\r\x1céÉ .", max_size=12), min_size=1, max_size=8)


def split(text, lower):
    text = text or ""
    return re.findall(r"[^\x20\x09-\x0D]+", text.translate(LOWER) if lower else text)


def hashed(values, lower):
    out = []
    for first, last, hashes, bounds in word_blocks(pa.array(values, pa.string()), WordHasher(lower)):
        assert first == len(out)
        out += [hashes[bounds[i] : bounds[i + 1]].tolist() for i in range(last - first)]
    return out


@settings(max_examples=60, deadline=None)
@given(texts, st.booleans())
def test_equal_words_have_equal_hashes(values, lower):
    known = {}
    for text, found in zip(values, hashed(values, lower), strict=True):
        want = split(text, lower)
        assert len(found) == len(want)
        for word, h in zip(want, found, strict=True):
            assert known.setdefault(word, h) == h
    assert len(set(known.values())) == len(known)


def test_long_texts_are_cut_between_words(monkeypatch):
    long = " ".join(f"w{i}" for i in range(3000)) + " " + "x" * 500 + "  y"
    whole = hashed([long], False)[0]
    monkeypatch.setattr(words_module, "BLOCK", 64)
    assert hashed(["a", long, None, "b b"], False) == [hashed(["a"], False)[0], whole, [], hashed(["b b"], False)[0]]


def test_grams_depend_on_words_and_order():
    h = np.random.default_rng(1).integers(0, 2**63, 200, dtype=np.uint64)
    for n in (1, 2, 5, 8, 50):
        g = grams(np.concatenate([h, h]), n)
        assert len(g) == 401 - n and (g[: 201 - n] == g[200:]).all() and len(set(g[:200].tolist())) == 200
    assert grams(np.array([1, 2], np.uint64), 2) != grams(np.array([2, 1], np.uint64), 2)
    assert len(grams(h[:3], 5)) == 0


def test_grams_stay_inside_documents():
    assert inside_documents(np.array([0, 2, 2, 5]), 5, 2).tolist() == [True, False, True, True]


def test_rows_of_a_key_stay_together():
    keys = [1, 1, 2, 3, 3, 3, 3, 3, 4, 5, 5]
    for size in range(1, 12):
        batches = [pa.RecordBatch.from_arrays([pa.array(keys[i : i + size])], ["k"]) for i in range(0, len(keys), size)]
        tables = [t.column("k").to_pylist() for t in whole_keys(iter(batches), "k")]
        assert [k for t in tables for k in t] == keys
        assert all(not set(a) & set(b) for a, b in zip(tables, tables[1:], strict=False))
