"""Classifier, language model, mixing and packing."""

import math
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from shelfscope.llm import packing
from shelfscope.llm.lm_scoring import MIXES, build_filter, read_levels, score_texts
from shelfscope.llm.mixing import mix_margins, mix_sources, probabilities, rake
from shelfscope.llm.packing import Encoder, pack, pack_documents, packing_plan
from shelfscope.llm.quality import fit_quality, score_quality
from shelfscope.llm.words import WordHasher, mix

public_tokenizers = pytest.importorskip("public_tokenizers")
TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
SCHEMA = "score string, doc_id long, text string, lang string, source string, kept string"


@pytest.fixture(scope="module")
def rows():
    pick = random.Random(5)
    good = ["the", "river", "house", "of", "green", "walks", "And", "light"]
    out = []
    for i in range(400):
        words = [pick.choice(good) + (pick.choice(["$$$", "###"]) if i % 4 == 0 else "") for _ in range(pick.choice([1, 5, 60]))]
        out.append(("x", i, " ".join(words), pick.choice(["en", "de", None]), pick.choice(["a", "a", "a", "b", None]), "y"))
    out += [("x", 900, None, None, None, None), ("x", 901, "", "en", "a", None), ("x", None, "no id", "en", "a", None)]
    return [*out, *out[:3], ("x", 950, "long " * 50_000, "en", "b", None)]


def test_quality_on_held_out_rows(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    labels = [(i, int(i % 4 > 0)) for i in range(400)]
    train = spark.createDataFrame([x for x in labels if x[0] % 5] + [(None, 1), (3, None), (4, 7)], "doc_id long, quality int")
    got = score_quality(docs, fit_quality(docs, train)).collect()
    assert len(got) == len(rows) and all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got)
    held = {r.doc_id: r.predicted for r in got if r.doc_id is not None and r.doc_id < 400 and r.doc_id % 5 == 0}
    assert np.mean([p == (i % 4 > 0) for i, p in held.items()]) > 0.97
    assert {r.predicted for r in got if r.doc_id in (900, 901)} == {1}


def test_quality_without_labels_or_rows(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r.score for r in score_quality(docs, fit_quality(docs, none)).collect()} == {0.5}
    assert score_quality(docs.limit(0), fit_quality(docs.limit(0), none)).collect() == []


def test_base_scores_equal_brute_force_and_the_model_beats_them(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    got = score_texts(docs, F.col("doc_id") % 7 == 2, bits=1 << 20, section_grams=256, slots=4).collect()
    tokens = [re.findall(r"[^\x20\x09-\x0D]+", (r[2] or "").translate(LOWER)) + [None] for r in rows]
    count = Counter(t for r, ts in zip(rows, tokens, strict=True) if r[1] is None or r[1] % 7 != 2 for t in ts)
    total = sum(count.values())
    want = Counter()
    for r, ts in zip(rows, tokens, strict=True):
        base = sum(math.log10((count[t] + 1) / (total + len(count) + 1)) for t in ts)
        want[(r[1], r[1] is not None and r[1] % 7 == 2, len(ts), sum(count[t] > 0 for t in ts), total, round(base, 6))] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 6)) for r in got) == want
    held = [r for r in got if r.held_out]
    assert sum(r.score for r in held) > sum(r.base_score for r in held) and all(r.score <= 0 for r in got)


def test_scores_equal_a_dictionary_of_the_same_levels(spark, rows):
    """With a filter so wide that nothing is found by chance; counts are known by their binary length only."""
    texts = [(r[1], re.findall(r"[^\x20\x09-\x0D]+", (r[2] or "").translate(LOWER)) + ["\n"]) for r in rows]
    words, pairs = Counter(), Counter()
    for i, ts in texts:
        if i is None or i % 7 != 2:
            words.update([" ", *ts])
            pairs.update(zip([" ", *ts], ts, strict=False))
    total, distinct = sum(words.values()) - words[" "], len(words) - 1

    def middle(count, less=0):
        return max((3 * 2 ** (count.bit_length() - 1) - 1) / 2 - less, 0) if count else 0.0

    def parts(a, b, less):
        pair = min((pairs[a, b], words[a], words[b]), key=int.bit_length)
        single = min((middle(words[b], less) + 1) / (total + distinct + 1), 1)
        return min(middle(pair, less) / max(middle(words[a], less), 1), 1), single

    gains = {}
    for i, ts in texts:
        if i is None or i % 7 != 2:
            for a, b in zip([" ", *ts], ts, strict=False):
                seen, single = parts(a, b, 1)
                gains[words[a].bit_length()] = gains.get(words[a].bit_length(), 0) + np.log10(MIXES * seen + (1 - MIXES) * single)
    mixes = {k: MIXES[v.argmax()] for k, v in gains.items()}
    want = Counter()
    for i, ts in texts:
        score = 0.0
        for a, b in zip([" ", *ts], ts, strict=False):
            seen, single = parts(a, b, 0)
            weight = mixes.get(words[a].bit_length(), 0.0)
            score += math.log10(weight * seen + (1 - weight) * single)
        want[i, round(score, 5)] += 1
    docs = spark.createDataFrame(rows, SCHEMA)
    for range_bytes in (1 << 26, 1 << 20):
        got = score_texts(docs, F.col("doc_id") % 7 == 2, bits=1 << 26, section_grams=256, range_bytes=range_bytes).collect()
        assert Counter((r.doc_id, round(r.score, 5)) for r in got) == want


def test_filter_levels_are_never_too_low(spark):
    words = [f"w{i}" for i in range(200)]
    text = " ".join(w for i, w in enumerate(words) for _ in range(1 + i % 9))
    docs = spark.createDataFrame([(text,), (text,), (None,)], "text string")
    for sections in (1, 16):
        cells = build_filter(docs, sections, 1 << 20)
        hasher = WordHasher(lower=True)
        keys = np.concatenate([hasher.hashes(np.frombuffer(w.encode(), np.uint8), np.zeros(1, int))[0] for w in words])
        want = [math.floor(math.log2(2 * (1 + i % 9))) + 1 for i in range(200)]
        levels = read_levels(cells, keys, sections)
        assert (levels >= want).all() and (levels == want).mean() > 0.98
        assert (read_levels(cells, mix(keys), sections) > 0).mean() < 0.05


def test_chance_hits_do_not_grow_with_the_corpus(spark):
    for n in (2_000, 200_000):
        docs = spark.range(n // 100).select(F.concat_ws(" ", F.transform(F.sequence(F.lit(0), F.lit(99)), lambda i: F.hash("id", i).cast("string"))).alias("text"))
        held = build_filter(docs, 16)
        assert (read_levels(held, mix(np.arange(50_000, dtype=np.uint64)), 16) > 0).mean() < 0.05
        assert 8 * len(held.cells) < 11 * 2.1 * n + 1000


def test_scores_are_the_same_from_one_range_or_many(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA).repartition(2)
    one, many = (score_texts(docs, F.col("doc_id") % 7 == 2, section_grams=256, range_bytes=n).collect() for n in (1 << 26, 40))
    assert Counter(one) == Counter(many) and len(one) == len(rows) and all(r.score <= 0 for r in one)


def test_language_model_of_empty_tables(spark):
    docs = spark.createDataFrame([], SCHEMA)
    assert score_texts(docs, F.lit(False), bits=1 << 16).collect() == []
    one = spark.createDataFrame([("x", 1, "a b", None, None, None)], SCHEMA)
    assert [(r.n_tokens, r.n_known, r.train_tokens) for r in score_texts(one, F.lit(True), bits=1 << 16).collect()] == [(3, 0, 0)]


def test_raking_reaches_all_margins():
    random_state = np.random.default_rng(2)
    shape = (4, 3, 2)
    members = [x.ravel() for x in np.indices(shape)]
    tokens = random_state.integers(1, 1000, 24).astype(float)
    targets = [np.array([0.4, 0.3, 0.2, 0.1]), np.array([0.5, 0.25, 0.25]), np.array([0.6, 0.4])]
    weight = rake(tokens, members, targets, rounds=100)
    for member, target in zip(members, targets, strict=True):
        assert np.allclose(np.bincount(member, weight * tokens) / tokens.sum(), target)
    for share in (0.2, 0.7, 0.95, 1.0):
        p = probabilities(tokens, weight, share * tokens.sum())
        assert ((p >= 0) & (p <= 1)).all() and math.isclose((p * tokens).sum(), share * tokens.sum())
        assert np.allclose(p[p < 1] / weight[p < 1], (p[p < 1] / weight[p < 1])[:1]) if (p < 1).any() else True


def test_mixing_keeps_columns_and_treats_repeats_alike(spark, rows):
    docs = spark.createDataFrame(rows, SCHEMA)
    targets = {"source": {"a": 0.5, "b": 0.4, "(other)": 0.1}, "lang": {"en": 0.6, "fr": 0.4}, "topic": {"t": 1.0}}
    out = mix_sources(docs, F.lit("t"), targets, 0.5)
    assert out.columns == ["score", "doc_id", "text", "lang", "source", "mix_source", "mix_lang", "mix_topic", "mix_tokens", "probability", "kept"]
    got = out.collect()
    assert len(got) == len(rows) and {r.mix_lang for r in got} == {"en", "(other)"} and {r.mix_source for r in got} == {"a", "b", "(other)"}
    by_id = defaultdict(set)
    for r in got:
        by_id[r.doc_id].add(r.kept)
    assert all(len(x) == 1 for x in by_id.values())
    assert mix_sources(docs.limit(0), F.lit("t"), targets, 0.5).collect() == []


def test_targets_are_met_or_the_miss_is_shown(spark):
    docs = spark.range(900).selectExpr("id AS doc_id", "'a b c' AS text", "'en' AS lang", "if(id % 3 = 0, 'src0', concat('src', id % 7 + 1)) AS source")
    targets = {"source": {"src0": 0.1, **{f"src{i}": 0.9 / 7 for i in range(1, 8)}}, "lang": {"en": 1.0}, "topic": {"t": 1.0}}
    share = {}
    for follow in (False, True):
        got = mix_sources(docs, F.lit("t"), targets, 0.8, follow_targets=follow)
        share[follow] = {c: (target, sample) for margin, c, target, sample, _ in mix_margins(got, targets) if margin == "source"}
    assert share[False]["src0"] == pytest.approx((0.1, 0.1667), abs=0.005)
    assert all(target == pytest.approx(sample, abs=1e-6) for target, sample in share[True].values())
    empty = mix_sources(docs.limit(0), F.lit("t"), targets, 0.8, follow_targets=True)
    assert empty.collect() == [] and mix_margins(empty, targets) == []


def test_plan_uses_every_item_once():
    pick = random.Random(1)
    for _ in range(150):
        capacity = pick.choice([7, 12, 30, 100])
        counts = {n: pick.choice([0, 1, 2, 3, 10, 50]) for n in range(1, capacity + 1)}
        used = Counter()
        for pattern, n in packing_plan(counts, capacity):
            assert n > 0 and sum(pattern) <= capacity and sum(3 * x > capacity for x in pattern) <= 2
            for length in pattern:
                used[length] += n
        assert used == Counter({k: v for k, v in counts.items() if v})


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_encoder_equals_the_tokenizer(name):
    from tokenizers import Tokenizer

    path = public_tokenizers.path(name)
    plain = Tokenizer.from_file(path)
    plain.encode_special_tokens = True
    with open(path, encoding="utf-8") as file:
        encoder = Encoder(file.read())
    pick = random.Random(2)
    parts = [" ", "  ", "\n", "a", "'s", "é", "1", "!", "\t", "\x1c", "<|endoftext|>", "Bc", "-", "\xa0", "ß", "漢", "\u0301", "\U0001f600", "\r\n"]
    texts = ["".join(pick.choice(parts) for _ in range(pick.randint(0, 10))) for _ in range(1500)] + ["ab" * 20_000]
    for text in texts:
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == plain.encode(text, add_special_tokens=False).ids, repr(text)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_special_tokens_in_texts_have_their_ids(spark, name):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(public_tokenizers.path(name))
    pick = random.Random(3)
    parts = ["<|endoftext|>", "<|startoftext|>", "<|endof", " ", "  ", "\n", "a", "'s", "é", "1", "!"]
    texts = ["<|endoftext|>", *("".join(pick.choice(parts) for _ in range(pick.randint(1, 8))) for _ in range(300))]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: (r.length, r.ids_crc32) for r in packing.token_pieces(docs, public_tokenizers.path(name)).collect()}
    for i, text in enumerate(texts):
        ids = np.array(plain.encode(text, add_special_tokens=False).ids + [2], "<u4")
        assert got[i] == (len(ids), zlib.crc32(ids.tobytes())), repr(text)


@pytest.mark.parametrize("capacity", [16, 1024])
def test_packed_pieces_fill_sequences_without_gaps(spark, rows, capacity, monkeypatch):
    from tokenizers import Tokenizer

    monkeypatch.setattr(packing, "LOT_ROWS", 7)
    docs = spark.createDataFrame(rows, SCHEMA)
    got = pack_documents(docs, TOKENIZER, capacity=capacity).collect()
    plain = Tokenizer.from_file(TOKENIZER)
    want = Counter()
    for r in rows:
        ids = np.array(plain.encode(r[2] or "", add_special_tokens=False).ids + [2], "<u4")
        first = len(ids) % capacity or min(capacity, len(ids))
        starts = [0, *range(first, len(ids), capacity)]
        for i, (a, b) in enumerate(zip(starts, [*starts[1:], len(ids)], strict=True)):
            want[(r[1], i, a, b - a, zlib.crc32(ids[a:b].tobytes()))] += 1
    assert Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in got) == want
    sequences = defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length))
    for places in sequences.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    assert len(sequences) <= -(-sum(r.length for r in got) // capacity) * 1.05 + 1


def test_packing_an_empty_table(spark):
    assert pack(spark.createDataFrame([], "doc_id long, piece int, length long, ids_crc32 long")).collect() == []
