"""Exact search against all products."""

import math

import numpy as np
import pytest

from shelfscope.llm.exact_search import LEVELS, best_products, features, nearest_products, whole_scores

SCHEMA = "tile string, block int, vec_id long, embedding array<double>, unit long, v int, floor string, dim string"


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v)


def plain(rows, every, top, scale=256):
    good = [(i, [math.floor(scale * x) for x in v]) for i, v in rows if i is not None and usable(v)]
    asked = {}
    for i, v in good:
        if i % every == 0:
            asked[i] = min(asked.get(i, (len(v), v)), (len(v), v))
    out = set()
    for q, (_, x) in asked.items():
        scores = sorted((-sum(a * b for a, b in zip(x, y, strict=True)), i) for i, y in good if i != q and len(x) == len(y))
        out |= {(q, k, i, -s) for k, (s, i) in enumerate(scores[:top], 1)}
    return out


@pytest.fixture(scope="module")
def vectors():
    pick = np.random.default_rng(3)
    waves = np.sin(np.arange(24) / 4)[None, :] * pick.normal(size=(12, 1)) * 2 + pick.normal(size=(12, 1))
    out = [(i, (waves[i % 12] + pick.normal(size=24) * 0.2).tolist()) for i in range(400)]
    out += [(500 + i, pick.normal(size=24).tolist()) for i in range(150)]
    out += [(700 + i, out[10 * (i // 8)][1]) for i in range(40)]
    out += [(900, [0.0] * 24), (901, [-0.0] * 24), (902, None), (903, []), (904, [1.0] * 23 + [math.nan]), (905, [math.inf] * 24), (906, [None] + [1.0] * 23)]
    out += [(None, out[0][1]), (7, out[9][1]), (7, out[9][1]), (50, out[3][1]), (1000, [1.0, 2.0, 3.0]), (1001, [1.0, 2.0, 2.5]), (1050, [0.5])]
    return out


@pytest.mark.parametrize(("tile", "block"), [(7, 3), (64, 5), (4096, 4096)])
def test_search_equals_all_products(spark, vectors, tile, block):
    rows = spark.createDataFrame([("t", 1, i, v, 1, 1, "f", "d") for i, v in vectors], SCHEMA).repartition(3)
    got = nearest_products(rows, "vec_id % 50 = 0", tile=tile, block=block).collect()
    want = plain(vectors, 50, 5)
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    assert {r.query_id for r in got} >= {0, 50, 900, 1000} and 1050 not in {r.query_id for r in got}


def test_bounds_hold_at_every_level():
    pick = np.random.default_rng(1)
    for d in (1, 3, 8, 33, 64):
        x, y = np.floor(pick.normal(size=(30, d)) * 300) + 50, np.floor(pick.normal(size=(40, d)) * 300)
        for s in LEVELS:
            assert (features(x, s) @ features(y, s).T >= x @ y.T - 1e-6).all()


def test_pruning_loses_nothing_whatever_the_limits():
    pick = np.random.default_rng(9)
    x = np.floor(np.cumsum(pick.normal(size=(1500, 40)), axis=1) * 256)
    q, ids = x[:300], np.arange(1500)
    for floors in (np.full(300, -np.inf), np.sort(q @ x.T, axis=1)[:, -4]):
        i, j, score = best_products(q, ids[:300], floors, x, ids, 3)
        for k in range(300):
            want = sorted((-int(s), n) for n, s in enumerate(q[k] @ x.T) if n != k)[:3]
            want = [(s, n) for s, n in want if -s >= floors[k]]
            assert list(zip((-score[i == k]).tolist(), j[i == k].tolist(), strict=True)) == want


def test_scores_are_whole_numbers_at_any_size(spark):
    assert whole_scores(np.array([[2.0**40, 1.0]]), np.array([[2.0**20, 3.0]])).tolist() == [2**60 + 3]
    assert whole_scores(np.array([[2.0**80], [2.0**80]]), np.array([[2.0**20], [-(2.0**20)]])).tolist() == [2**63 - 1, -(2**63)]
    rows = [(0, [1e300, 1.0]), (1, [1e30, 1.0]), (2, [-1e30, 3.0]), (50, [1e307, 1e307])]
    rows = spark.createDataFrame([("t", 1, i, v, 1, 1, "f", "d") for i, v in rows], SCHEMA)
    got = nearest_products(rows, "vec_id % 50 = 0").collect()
    assert [tuple(r) for r in got] == [(0, 1, 1, 2**63 - 1), (0, 2, 2, -(2**63))]


def test_empty_tables(spark):
    assert nearest_products(spark.createDataFrame([], SCHEMA), "vec_id % 50 = 0").collect() == []
