"""Columns named like those that the operators use themselves, and texts of one character two million times."""

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from shelfscope.llm.line_dedup import dedup_lines
from shelfscope.llm.packing import Encoder, pack_documents
from shelfscope.llm.page_text import extract_pages
from shelfscope.llm.quality import fit_quality, score_quality

NAMES = ["quality", "_label_id", "_doc_id", "columns", "_text", "_TEXT_", "_drop_id", "_drop_keys", "key", "last_id", "h", "_html", "uid", "score", "predicted", "n_lines", "n_dropped"]
LINE = "this line has more than forty characters, surely"


@pytest.fixture
def clashing(spark):
    rows = [(i, f"good words here {i}\n{LINE}" if i % 3 else f"bad ### {i}\n{LINE}", *[f"{n}{i}" for n in NAMES]) for i in range(60)]
    return spark.createDataFrame([*rows, (None, None, *[None] * len(NAMES))], "doc_id long, text string, " + ", ".join(f"{n} string" for n in NAMES))


def kept(frame, row, but):
    return all(row[n] == f"{n}{row['doc_id']}" for n in NAMES if n not in but) or row["doc_id"] is None


def test_quality(spark, clashing):
    labels = spark.createDataFrame([(i, int(i % 3 > 0), "x", "y") for i in range(60)], "doc_id long, quality int, text string, _doc_id string")
    got = score_quality(clashing, fit_quality(clashing, labels))
    rows = got.collect()
    assert set(got.columns) == {"doc_id", "text", *NAMES} and len(rows) == 61
    assert all(kept(got, r, ("score", "predicted")) and 0 <= r["score"] <= 1 for r in rows)


def test_lines(clashing):
    got = dedup_lines(clashing)
    rows = got.collect()
    assert set(got.columns) == {"doc_id", "text", *NAMES} and len(rows) == 61
    assert all(kept(got, r, ("n_lines", "n_dropped")) for r in rows)
    assert sorted(r["doc_id"] for r in rows if r["doc_id"] is not None and LINE in r["text"]) == [59]


def test_pages(spark):
    names = ["page_id", "_html", "_HTML_", "text", "html"]
    pages = spark.createDataFrame([(1, "a", "b", "old", "<article><p>Some words of it.</p></article>"), (2, None, None, None, None)], "page_id int, _html string, _HTML_ string, text string, html string")
    got = extract_pages(pages, "html", *names)
    assert sorted(got.columns) == sorted(names)
    assert {(r["page_id"], r["_html"], r["text"]) for r in got.collect()} == {(1, "a", "Some words of it."), (2, None, "")}


@pytest.mark.parametrize("one", [" ", "\n", " ", "a", "!", "7"])
def test_two_million_equal_characters(one):
    path = public_tokenizers.path("byte_bpe_50k.json")
    with open(path, encoding="utf-8") as file:
        encoder = Encoder(file.read(), special=True)
    for text in (one * 2_000_000, "a b " + one * 2_000_000 + "c <|endoftext|> d"):
        assert np.frombuffer(encoder.ids(text), "<u4").tolist() == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_packing_a_very_long_blank_text(spark):
    docs = spark.createDataFrame([(1, " " * 1_500_000, 7), (2, "a word", 8), (None, None, None)], "doc_id long, text string, length int")
    got = pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json")).collect()
    assert {r["doc_id"] for r in got} == {1, 2, None}
    assert sum(r["length"] for r in got if r["doc_id"] == 1) == max(r["start"] + r["length"] for r in got if r["doc_id"] == 1)
