import math
import random

import numpy as np
import pytest

from shelfscope.llm.graph_index import nearest_vectors
from shelfscope.llm.vector_dedup import linked_pairs, near_vectors

SCHEMA = "tile string, label int, vec_id long, embedding array<float>, unit long, v int"


@pytest.fixture(scope="module")
def rows():
    pick = np.random.default_rng(4)
    out = []
    for i in range(160):
        base = pick.normal(size=12)
        out.append(("t", i % 3, 2 * i, base, 1, 1))
        for j in range(i % 4):
            near = base + (pick.normal(size=12) * 0.1 if j else 0)
            out.append(("t", i % 3, 1000 + 10 * i + j, near * (1 + j), 1, 1))
    chain = pick.normal(size=12)
    for j in range(12):
        chain = chain / np.linalg.norm(chain) + pick.normal(size=12) * 0.07
        out.append(("t", 1, 5000 - j, chain, 1, 1))
    out = [(a, b, c, [float(np.float32(x)) for x in d], e, f) for a, b, c, d, e, f in out]
    out += [
        ("t", None, 7000, out[0][3], 1, 1), ("t", 1, 7001, None, 1, 1), ("t", 1, 7002, [0.0] * 12, 1, 1), ("t", 1, 7003, [1.0] * 11 + [math.nan], 1, 1),
        ("t", 1, 7004, [1.0] * 11 + [math.inf], 1, 1), ("t", 1, 7005, [None] + [1.0] * 11, 1, 1), ("t", 1, 7006, [], 1, 1), ("t", 0, None, out[0][3], 1, 1),
        ("t", 1, 7007, [1.0, 0.0, 0.0], 1, 1), ("t", 1, 7008, [1.0, -0.0, 0.0], 1, 1), ("t", 1, 7009, [3.0, 0.0, 0.1], 1, 1),
    ]
    random.Random(1).shuffle(out)
    return out


def usable(v):
    return bool(v) and all(x is not None and math.isfinite(x) for x in v) and any(v)


@pytest.mark.parametrize("tile", [5, 2048])
def test_near_vectors_equal_brute_force(spark, rows, tile):
    good = [r for r in rows if usable(r[3]) and r[1] is not None and r[2] is not None]
    links = {r[2]: set() for r in rows if r[2] is not None}
    for a in good:
        for b in good:
            if a[2] != b[2] and a[1] == b[1] and len(a[3]) == len(b[3]):
                x, y = np.array(a[3]), np.array(b[3])
                if x @ y / (np.sqrt(x @ x) * np.sqrt(y @ y)) >= 0.93:
                    links[a[2]].add(b[2])
    want = set()
    for i, own in links.items():
        seen, todo = {i}, [i]
        while todo:
            new = links[todo.pop()] - seen
            seen |= new
            todo += new
        want.add((i, len(own), min(seen), i == min(seen)))
    got = near_vectors(spark.createDataFrame(rows, SCHEMA), tile=tile).collect()
    assert {tuple(r) for r in got if r.vec_id is not None} == want and len(got) == len(rows)
    assert [tuple(r) for r in got if r.vec_id is None] == [(None, 0, None, False)]
    assert max(n for _, n, _, _ in want) > 2


def test_the_bound_never_loses_a_pair():
    pick = np.random.default_rng(6)
    x = pick.normal(size=(80, 40))
    x = np.concatenate([x, x + pick.normal(size=x.shape) * 0.3])
    x /= np.linalg.norm(x, axis=1)[:, None]
    for threshold in (0.5, 0.9, 0.97):
        found = set(zip(*(z.tolist() for z in linked_pairs(x, x, threshold)), strict=True))
        assert set(zip(*(z.tolist() for z in np.nonzero(x @ x.T >= threshold)), strict=True)) <= found


def nearest(rows, top):
    best = {}
    good = {}
    for r in rows:
        if usable(r[3]) and r[2] is not None:
            good[r[2]] = min(good.get(r[2], r[3]), r[3])
    for q, x in good.items():
        if q % 20 == 0:
            scores = [(-float(np.dot(x, y)), i) for i, y in good.items() if i != q and len(x) == len(y)]
            best[q] = sorted(scores)[:top]
    return best


def test_small_tables_are_searched_whole(spark, rows):
    got = {}
    for r in nearest_vectors(spark.createDataFrame(rows, SCHEMA), "vec_id % 20 = 0", top=7, block_rows=16, block_queries=3).collect():
        got.setdefault(r.query_id, []).append((r["rank"], r.vec_id, r.score))
    want = nearest(rows, 7)
    assert got.keys() == {q for q, x in want.items() if x}
    for q, found in got.items():
        found.sort()
        assert [k for k, _, _ in found] == list(range(1, len(want[q]) + 1))
        assert [i for _, i, _ in found] == [i for _, i in want[q]]
        assert np.allclose([s for *_, s in found], [-s for s, _ in want[q]])


def test_recall_over_learned_partitions(spark):
    pick = np.random.default_rng(8)
    centres = pick.normal(size=(40, 16))
    vectors = (centres[pick.integers(0, 40, 3000)] + pick.normal(size=(3000, 16)) * 0.6).tolist()
    rows = [("t", 0, i, v, 1, 1) for i, v in enumerate(vectors)]
    got = nearest_vectors(spark.createDataFrame(rows, SCHEMA), "vec_id % 20 = 0", fit_rows=1500, parts=8).collect()
    want = nearest([(*r[:3], [float(np.float32(x)) for x in r[3]], 1, 1) for r in rows], 20)
    hits = sum((r.query_id, r.vec_id) in {(q, i) for q in [r.query_id] for _, i in want[q]} for r in got)
    assert len(got) == 20 * len(want) and hits / len(got) >= 0.9


def test_empty_tables(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert near_vectors(none).collect() == []
    assert nearest_vectors(none, "vec_id % 20 = 0").collect() == []
