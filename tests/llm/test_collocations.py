"""Collocations against counting all phrases."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from shelfscope.llm import collocations, words
from shelfscope.llm.collocations import PieceHasher, mine_phrases, piece_blocks

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "w1 string, key long, text string, lang string, a string, first int"


def pieces(text):
    return [re.findall(r"[^\x20\x09]+", p) for p in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(LOWER))]


def plain(rows, top, at_least):
    total, f = Counter(), {}
    for lang, text in rows:
        own = f.setdefault(lang or "und", Counter())
        for w in pieces(text):
            total[lang or "und"] += len(w)
            for size in (1, 2, 3, 4):
                own.update(tuple(w[i : i + size]) for i in range(len(w) - size + 1))
    out = set()
    for lang, own in f.items():
        found = {p: a for p, a in own.items() if len(p) > 1 and a >= at_least}
        covered = set()
        for longer, a in found.items():
            for size in range(2, len(longer)):
                covered |= {p for i in range(len(longer) - size + 1) if 100 * a >= 80 * found[p := longer[i : i + size]]}
        best = []
        for p, a in found.items():
            if p not in covered:
                score, _, l, r = min((2_000_000 * a // (own[p[:k]] + own[p[k:]]), k, own[p[:k]], own[p[k:]]) for k in range(1, len(p)))
                best.append((-score, -a, " ".join(p).encode(), l, r))
        out |= {(lang, i, p.decode(), -a, l, r, total[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(best)[:top], 1)}
    return out


@pytest.fixture(scope="module")
def rows():
    pick = random.Random(11)
    out = []
    for lang, share in (("en", 260), ("de", 60), (None, 30)):
        vocabulary = [f"{lang}{i}" for i in range(40)] + ["É", "x-y", "don't", "日本"]
        fixed = [[pick.choice(vocabulary) for _ in range(pick.choice([2, 3, 4, 5]))] for _ in range(25)]
        for _ in range(share):
            text = []
            for _ in range(pick.choice([0, 3, 12])):
                text += pick.choices(vocabulary, weights=[1 / (i + 1) for i in range(len(vocabulary))], k=pick.choice([1, 4])) if pick.random() < 0.5 else pick.choice(fixed)
                text += [pick.choice(["", ".", "\n", " ; ", "!", "\t"])]
            out.append((lang, " ".join(text).replace("en1 ", "EN1 ")))
    out += [("en", None), ("en", ""), ("fr", " \t.\n"), (None, None), ("x", "one"), ("en", "en1 en2 . " * 3000)] + [out[3]] * 5
    out.append(("long", " ".join(pick.choices(["a", "b", "c", "d", "e,"], k=400_000))))
    # the pairs of highest score are covered by phrases of low score
    out += [("hidden", " . ".join(f"the x{i} y{i} . the z{i % 7} . p{i} q{i % 3}" for i in range(40)))] * 6
    pick.shuffle(out)
    return out


@pytest.mark.parametrize(("top", "at_least"), [(4, 3), (2000, 5), (30, 1)])
def test_mining_equals_counting_everything(spark, rows, top, at_least):
    rounds = []
    table = spark.createDataFrame([("w", 1, t, lang, "a", 1) for lang, t in rows], SCHEMA).repartition(3)
    got = mine_phrases(table, top=top, at_least=at_least, rounds=rounds).collect()
    want = plain(rows, top, at_least)
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    if top == 4:  # the frontier is not expanded whole
        everything = []
        mine_phrases(table, top=2000, at_least=at_least, rounds=everything).count()
        assert rounds[0][1] < 0.8 * everything[0][1]
        assert len(rounds) > 2  # and goes on where too few phrases survive


def test_sections_of_a_long_text_share_pieces(monkeypatch):
    text = "ab cd, ef gh ij. kl " * 40
    hasher = PieceHasher()
    (_, _, h, first, piece), = piece_blocks(pa.array([text]), hasher)
    monkeypatch.setattr(collocations, "BLOCK", 16)
    found = [b[2:] for b in piece_blocks(pa.array([text, None, text]), hasher)]
    found = [f for f in found if len(f[0])]
    assert len(found) == 2
    for part in found:
        assert (part[0] == h).all() and (part[1] == first).all()
        assert (np.diff(part[2]) == np.diff(piece)).all()
    assert words.BLOCK == 1 << 20


def test_counts_are_the_same_when_tasks_send_early(spark, rows, monkeypatch):
    monkeypatch.setattr(collocations, "HELD", 50)
    table = spark.createDataFrame([("w", 1, t, lang, "a", 1) for lang, t in rows if lang != "long"], SCHEMA)
    got = mine_phrases(table, top=30, at_least=3).collect()
    assert {tuple(r) for r in got} == plain([r for r in rows if r[0] != "long"], 30, 3)


def test_empty_tables(spark):
    assert mine_phrases(spark.createDataFrame([], SCHEMA)).collect() == []
    assert mine_phrases(spark.createDataFrame([("w", 1, None, None, "a", 1)], SCHEMA)).collect() == []


def test_a_hasher_gives_words_with_their_pieces():
    data = np.frombuffer(b"ab CD,ef\n\ngh" + b"ab cd", np.uint8)
    hashes, first, piece = PieceHasher().pieces(data, np.array([0, 12]))
    assert first.tolist() == [0, 3, 6, 10, 12, 15] and (hashes[:2] == hashes[4:]).all()
    assert len(set(hashes[:4].tolist())) == 4 and piece.tolist()[:2] == [piece[0]] * 2 and len(set(piece.tolist())) == 4
