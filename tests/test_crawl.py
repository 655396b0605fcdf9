"""Following stored pages, against a breadth-first walk."""

import random

import pytest
from pyspark.sql import functions as F

from shelfscope.operators.crawl import SeenRuns, follow_pages


def walk(seeds, stored, rounds=None):
    seen, out, new, number = set(), {}, sorted({s for s in seeds if s is not None}), 0
    while new and (rounds is None or number < rounds):
        seen |= set(new)
        before = set(seen)
        found = set()
        for u in new:
            rows = [r for r in stored if r[0] == u]
            target = next((f for _, f, _ in rows if f and f != u), None)
            opened = bool(rows) and (target is None or target not in before and target not in seen)
            out[u] = (number, opened)
            if opened:
                seen |= {target} - {None}
                found |= {x for r in rows for x in r[2]}
        new, number = sorted(found - seen - {None}), number + 1
    return out


@pytest.mark.parametrize("redirects", [False, True])
def test_follow_equals_a_walk(spark, redirects):
    pick = random.Random(4)
    names = [f"u{i:03}" for i in range(120)]
    stored = []
    for i, name in enumerate(names[:100]):
        links = pick.choices(names, k=pick.choice([0, 1, 3])) + ["u000"] + ([None] if i % 9 == 0 else [])
        final = pick.choice([None, name, f"r{i % 4}", names[i - 1]]) if redirects and i % 3 == 0 else None
        stored.append((name, final, links))
        if i % 10 == 0:  # stored twice, with other links
            stored.append((name, final, [names[-1 - i // 10]]))
    seeds = ["u017", "u031", "u017", None, "nowhere"]
    pages = spark.createDataFrame(stored, "address string, answer string, links array<string>")
    starts = spark.createDataFrame([(s,) for s in seeds], "address string")

    def expand(opened):
        return opened.select(F.explode("links").alias("found_url"))

    for rounds in (None, 2):
        got = follow_pages(starts, pages, expand, "address", "answer" if redirects else None, rounds).collect()
        want = walk(seeds, [(u, f if redirects else None, x) for u, f, x in stored], rounds)
        assert len(got) == len(want) and {r.url: (r["round"], r.opened) for r in got} == want
    assert len({n for n, _ in walk(seeds, [(u, None, x) for u, _, x in stored]).values()}) > 3


def test_nothing_to_follow(spark):
    none = spark.createDataFrame([], "url string, links array<string>")
    some = spark.createDataFrame([("a",)], "url string")
    assert follow_pages(none.select("url"), none, lambda p: p).collect() == []
    got = follow_pages(some, none, lambda p: p.select(F.explode("links").alias("found_url"))).collect()
    assert [tuple(r) for r in got] == [("a", 0, False)]


def test_runs_stay_few(spark):
    runs = SeenRuns("u")
    for i in range(6):
        batch = spark.createDataFrame([(f"{i}-{j}",) for j in range(3)], "u string")
        runs.add(runs.unseen(batch.union(batch.limit(0))))
    assert len(runs.runs) <= 3 and sum(n for _, n in runs.runs) == 18
    assert runs.unseen(spark.createDataFrame([("0-1",), ("x",)], "u string")).collect() == [("x",)]
