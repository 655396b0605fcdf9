"""Lexical search against a plain evaluation of the score over all documents."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from shelfscope.llm.lexical_search import Best, mask_groups, search_documents, search_lot

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "rank string, doc_id long, text string, n string, terms int, score string, item_id int"
ITEMS = "score int, item_id long, text string, term string, block string"


def terms_of(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain(docs, items, top):
    bags = [(i, Counter(terms_of(t))) for i, t in docs if terms_of(t)]
    n_docs, n_terms = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(t for _, b in bags for t in b)
    asked = {}
    for i, text in items:
        asked.setdefault(i, set()).update(terms_of(text))
    out = set()
    for item, own in asked.items():
        scores = []
        for i, bag in bags:
            m = 50 + 50 * sum(bag.values()) * n_docs // n_terms
            score = sum(
                math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * bag[t] // (1000 * bag[t] + 20 * m)) for t in own if t in bag
            )
            if score > 0:
                scores.append((-score, i is None, i or 0))
        out |= {(item, k, None if none else i, -s) for k, (s, none, i) in enumerate(sorted(scores)[:top], 1)}
    return out


@pytest.fixture(scope="module")
def docs():
    pick = random.Random(5)
    words = [f"w{i}" for i in range(60)] + ["É", "straße", "x-y", "a_b", "don't", "ZIP", "日本"]
    out = [(3 * i, " ".join(pick.choices(words, k=pick.choice([1, 5, 20, 90])))) for i in range(300)]
    out += [(2000 + i, out[4][1]) for i in range(40)]
    out += [(5000, None), (5001, ""), (5002, " .,;"), (None, out[0][1]), (None, "w1 w2"), (7, out[8][1]), (7, out[8][1])]
    out += [(6000, "w3 " * 60_000 + "W4"), (6001, "x" * 2_000_000)]
    pick.shuffle(out)
    return out


ASKED = [(1, "w1 W2, w3;w4"), (2, "zip É STRASSE straße w5"), (3, None), (4, ""), (5, "unheard of"), (6, "w7"), (None, "w1 w50"), (None, "w9"), (8, "x y a_b"), (8, "日本")]


@pytest.mark.parametrize("block_terms", [3, 1 << 17])
def test_search_equals_plain_evaluation(spark, docs, block_terms):
    table = spark.createDataFrame([("r", i, t, "n", 1, "s", 1) for i, t in docs], SCHEMA).repartition(3)
    items = spark.createDataFrame([(0, i, t, "t", "b") for i, t in ASKED], ITEMS)
    got = search_documents(table, items, top=20, block_terms=block_terms).collect()
    assert [r for r in got if r.item_id == 6 and r["rank"] == 20]
    assert sorted(map(repr, (tuple(r) for r in got))) == sorted(map(repr, plain(docs, ASKED, 20)))


def test_masks_are_left_out_only_when_they_cannot_win():
    pick = np.random.default_rng(2)
    parts = pick.integers(0, 1000, (40, 500)) * (pick.random((40, 500)) < 0.2)
    ids = pick.permutation(500)
    items = [pick.choice(40, k, replace=False) for k in (1, 3, 12, 40)]
    best = [Best(10, 1) for _ in items]
    for half in (slice(0, 250), slice(250, 500)):
        search_lot(parts[:, half], parts[:, half] > 0, ids[half], np.zeros(250, bool), items, best)
    for own, found in zip(items, best, strict=True):
        want = sorted((-int(s), int(i)) for s, i in zip(parts[own].sum(axis=0), ids, strict=True) if s)[:10]
        assert [(-int(s), int(i)) for s, i in zip(found.scores, found.ids, strict=True)] == want


@pytest.mark.parametrize("terms", [1, 8, 9, 64, 65, 200])
def test_a_group_has_one_mask(terms):
    present = np.random.default_rng(terms).random((terms, 90)) < 0.5
    present[:, 45:] = present[:, :45]
    masks, group = mask_groups(present)
    assert (masks[group] == present.T).all() and len(masks) == len({tuple(c) for c in present.T.tolist()})


def test_empty_tables(spark):
    none, items = spark.createDataFrame([], SCHEMA), spark.createDataFrame([], ITEMS)
    some = spark.createDataFrame([("r", 1, "w1", "n", 1, "s", 1)], SCHEMA)
    assert search_documents(none, items).collect() == []
    assert search_documents(some, items).collect() == []
    assert search_documents(none, spark.createDataFrame([(0, 1, "w1", "t", "b")], ITEMS)).collect() == []
