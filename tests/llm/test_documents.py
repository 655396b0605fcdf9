"""Joins and dedup over documents against brute force, on rows with NULLs, empty texts, copies and repeated ids."""

import hashlib
import random
import re
import tracemalloc
from collections import Counter, defaultdict

import numpy as np
import pytest

from shelfscope.llm import ngram_join
from shelfscope.llm.blocks import BLOCK_SCHEMA, block_rows
from shelfscope.llm.components import components
from shelfscope.llm.line_dedup import LineRuns, dedup_lines
from shelfscope.llm.ngram_join import jaccard_groups, one_of_each_group
from shelfscope.llm.substring_dedup import drop_repeated_passages
from shelfscope.session import scratch_path

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "lang string, doc_id long, text string, component_id long, key string, n_lines string"


def split(text):
    return re.findall(r"[^\x20\x09-\x0D]+", text or "")


@pytest.fixture(scope="module")
def rows():
    pick = random.Random(7)
    vocabulary = [f"w{i}" for i in range(300)]
    passage = [pick.choice(vocabulary) for _ in range(30)]
    out = []
    for i in range(90):
        body = [pick.choice(vocabulary) for _ in range(pick.choice([3, 8, 40, 120]))]
        if i % 3 == 0:
            body = body[:10] + passage + body[10:]
        text = " ".join(body).replace("w1 ", "W1\n").replace("w2 ", "w2 \t")
        out.append((i, text))
        for j in range(pick.choice([0, 0, 1, 5])):  # exact and near copies
            copy = text.split(" ")
            if j % 2 and len(copy) > 30:
                copy[pick.randrange(len(copy))] = "changed"
            out.append((100 + 10 * i + j, " ".join(copy)))
    long_line = "This is one line that many documents of the table share."
    out = [(i, t + ("\n" + "  " * (i % 2) + (long_line.upper() if i % 5 == 0 else long_line) if i % 4 == 0 else "")) for i, t in out]
    out += [(5000, None), (5001, ""), (5002, " \n\t "), (5003, "one"), (5004, "ONE"), (None, out[0][1]), (None, None)]
    out += [(5005, " ".join(f"v{i}" for i in range(40_000))), (7, out[8][1]), (7, out[8][1])]
    pick.shuffle(out)
    return [("en", i, t, 3, "k", "x") for i, t in out]


def components_of(nodes, links):
    parent = {n: n for n in nodes}

    def top(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = top(a), top(b)
        parent[max(a, b)] = min(a, b)
    return {n: top(n) for n in nodes}


def shingles(text):
    w = split((text or "").translate(LOWER))
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or ({tuple(w)} if w else set())


@pytest.mark.parametrize("small", [1, 4, 1000])
def test_jaccard_groups_equal_brute_force(spark, rows, small, monkeypatch):
    monkeypatch.setattr(ngram_join, "SMALL", small)
    monkeypatch.setattr(ngram_join, "PARTNERS", 3)
    sets = [(r[1], shingles(r[2])) for r in rows]
    links = [
        (a, b) for a, x in sets for b, y in sets
        if a is not None and b is not None and a < b and x and y and 100 * len(x & y) >= 80 * len(x | y)
    ]
    component = components_of({a for a, _ in sets if a is not None}, links)
    got = Counter((r.doc_id, r.n_shingles, r.component_id) for r in jaccard_groups(spark.createDataFrame(rows, SCHEMA), sketch=1 << 12).collect())
    assert got == Counter((a, len(x), component.get(a)) for a, x in sets)


def test_signatures_never_differ_more_than_their_sets():
    random = np.random.default_rng(3)
    for size in (1, 5, 60, 700, 5000):
        tokens = np.unique(random.integers(0, 2**64, size, dtype=np.uint64))
        for share in (0.0, 0.1, 0.5, 1.0):
            other = np.unique(np.concatenate([tokens[random.random(len(tokens)) < share], random.integers(0, 2**64, 3, dtype=np.uint64)]))
            bits = [ngram_join.signature(x).view(np.uint64) for x in (tokens, other)]
            assert np.bitwise_count(bits[0] ^ bits[1]).sum() <= len(np.setxor1d(tokens, other))


def test_families_of_many_components_equal_brute_force(spark):
    """Chains of small edits: most members are alike, few of them alike enough, and pivots tie only some of these."""
    random = np.random.default_rng(9)
    rows = []
    for family in range(6):
        base = [f"w{family}_{i}" for i in range(70)]
        for _ in range(25):
            words = list(base)
            for at in random.integers(0, len(words), random.integers(0, 5)):
                words[at] = f"x{random.integers(0, 10**9)}"
            rows.append((len(rows), " ".join(words)))
    sets = [(i, shingles(text)) for i, text in rows]
    links = [(a, b) for a, x in sets for b, y in sets if a < b and 100 * len(x & y) >= 80 * len(x | y)]
    component = components_of({a for a, _ in sets}, links)
    got = {(r.doc_id, r.component_id) for r in jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string"), sketch=1 << 12).collect()}
    assert got == set(component.items())
    assert 1 < len({c for i, c in component.items() if i < 25}) < 25


def test_one_document_of_each_group_stays(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    got = one_of_each_group(docs)
    assert got.columns == docs.columns
    sets = [(r[1], shingles(r[2])) for r in rows]
    links = [(a, b) for a, x in sets for b, y in sets if None not in (a, b) and a < b and x and y and 100 * len(x & y) >= 80 * len(x | y)]
    component = components_of({a for a, _ in sets if a is not None}, links)
    assert Counter(r.doc_id for r in got.collect()) == Counter(a for a, _ in sets if a is None or component[a] == a)


@pytest.mark.parametrize("held", [50, 1 << 20])
def test_repeated_passages_equal_brute_force(spark, rows, held):
    window = 6
    first = {}
    for r in rows:
        w = split(r[2])
        for i in range(len(w) - window + 1):
            if r[1] is not None:
                key = tuple(w[i : i + window])
                first[key] = min(first.get(key, r[1]), r[1])
    want = Counter()
    for r in rows:
        w = split(r[2])
        gone = set()
        for i in range(len(w) - window + 1):
            if r[1] is not None and first[tuple(w[i : i + window])] < r[1]:
                gone.update(range(i, i + window))
        want[(r[1], len(w), len(gone), " ".join(x for i, x in enumerate(w) if i not in gone))] += 1
    got = drop_repeated_passages(spark.createDataFrame(rows, SCHEMA), window=window, gram=3, width=1 << 16, held=held)
    assert Counter(map(tuple, got.collect())) == want


@pytest.mark.parametrize("settings", [{}, {"batches": 7, "fanout": 3, "hot_documents": 6}])
def test_repeated_lines_equal_brute_force(spark, rows, settings):
    def key(line):
        k = line.strip(" \t\n\v\f\r")
        return k.translate(LOWER) if len(k) >= 40 else None

    holders = defaultdict(set)
    for r in rows:
        for line in (r[2] or "").split("\n"):
            if key(line) and r[1] is not None:
                holders[key(line)].add(r[1])
    want = Counter()
    for r in rows:
        lines = (r[2] or "").split("\n")
        kept = [x for x in lines if r[1] is None or len(holders[key(x)]) < 5 or max(holders[key(x)]) == r[1]]
        want[(r[1], "\n".join(kept), len(lines), len(lines) - len(kept))] += 1
    got = dedup_lines(spark.createDataFrame(rows, SCHEMA), **settings)
    assert got.columns == ["lang", "doc_id", "text", "component_id", "key", "n_lines", "n_dropped"]
    assert Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in got.collect()) == want
    assert any(n for *_, n in want)


def test_runs_are_compacted_and_know_what_is_new(spark):
    runs = LineRuns(spark, fanout=2)
    key = lambda n: hashlib.md5(str(n).encode()).digest()
    for batch in range(5):
        new = runs.add(spark.createDataFrame([(10 * batch + i, key(i)) for i in range(batch + 1)], "doc_id long, key binary"))
        assert [bytes(r["key"]) for r in new.collect()] == [key(batch)]
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    assert {bytes(r["key"]): (r.n_docs, r.last_id) for r in runs.totals().collect()} == {key(i): (5 - i, 40 + i) for i in range(5)}


def test_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert jaccard_groups(docs, sketch=1 << 10).collect() == []
    assert drop_repeated_passages(docs, width=1 << 16).collect() == []
    assert dedup_lines(docs).collect() == []
    assert one_of_each_group(docs).collect() == []


def test_components_of_chains_and_stars(spark):
    pick = random.Random(3)
    chain = [(i, i + 1) for i in range(60)]
    star = [(100, i) for i in range(101, 160)]
    loose = [(pick.randrange(200, 300), pick.randrange(200, 300)) for _ in range(60)]
    links = chain + star + loose + chain[:5]
    pick.shuffle(links)
    links = [(b, a) if pick.random() < 0.5 else (a, b) for a, b in links]
    want = components_of({n for a, b in links if a != b for n in (a, b)}, [x for x in links if x[0] != x[1]])
    got = {r.id: r.component for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert got == want


def test_ranks_of_the_sketch_are_made_on_the_executors(spark):
    random = np.random.default_rng(7)
    tables = [np.minimum(random.exponential(20, ngram_join.SKETCH), 255).astype(np.uint8) for _ in range(3)]
    tables[0][:70_000] = tables[1][:70_000] = tables[2][:70_000] = 0  # a block that no task has
    for a in (5, 1 << 20, ngram_join.SKETCH - 1):
        tables[1][a : a + 9] = 255
    rows = [(i, c) for t in tables for i, c in zip(*(block_rows(t).column(k).to_pylist() for k in ("block", "cells")), strict=True)]
    path = scratch_path(spark, "sketches")
    spark.createDataFrame(rows, BLOCK_SCHEMA).write.parquet(path)
    totals = np.sum(tables, 0, np.int64)
    usual = totals.mean() + 8 * totals.mean() ** 0.5
    wanted = np.where(totals > usual, np.log2(np.maximum(totals, 1) / usual) + 1, 0).astype(np.uint8)
    tracemalloc.start()
    ranks = ngram_join._common(spark.read.parquet(path), ngram_join.SKETCH)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert ranks.dtype == np.uint8 and (ranks == wanted).all() and wanted.max() > 1
    assert most < 16 << 20  # before: eight bytes a counter came to the driver, and several arrays of them


def test_ranks_of_an_empty_sketch(spark):
    assert not ngram_join._common(spark.createDataFrame([], BLOCK_SCHEMA), 100).any()
