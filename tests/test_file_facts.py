import gzip
import hashlib
import random
import zlib

import pytest

from shelfscope.sources.file_facts import BLOCK, GzipLines, facts_of, file_facts, file_system


def blocks(data, size):
    return (data[i : i + size] for i in range(0, len(data), size))


TEXTS = [b"", b"a", b"a\n", b"a\nb", b"\r\n\r", b"a\r\nb\rc\n\n", b"\n" * 5, "é\n".encode() * 1000]


@pytest.mark.parametrize("size", [1, 3, 1000])
def test_lines_whatever_the_blocks(size):
    for text in TEXTS:
        want = len(text.splitlines())
        assert facts_of(blocks(text, size), False) == (len(text), hashlib.md5(text).hexdigest(), hashlib.sha256(text).hexdigest(), want, None)
        packed = gzip.compress(text)
        assert facts_of(blocks(packed, size), True)[3:] == (want, None)
        both = packed + gzip.compress(b"x\ny\n")
        assert facts_of(blocks(both + b"\0" * 7, size), True)[3:] == (len((text + b"x\ny\n").splitlines()), None)
        assert facts_of(blocks(both[:-4], size), True)[3:] == (None, "unexpected end")
        assert facts_of(blocks(packed[:9], size), True)[3:] == (None, "unexpected end")
        assert facts_of(blocks(packed + b"\0\0x", size), True)[3:] == (None, "data after the padding")
    assert facts_of(iter(()), True)[3:] == (None, "empty file")
    assert facts_of(blocks(b"plain\n", size), True)[4]
    broken = bytearray(gzip.compress(b"some text\n" * 50))
    broken[-6] ^= 1
    assert facts_of(blocks(bytes(broken), size), True)[4]


def test_a_small_file_of_a_long_text_is_unpacked_in_parts(monkeypatch):
    packed = zlib.compress(b"\n" * (20 * BLOCK), wbits=31)
    longest = 0
    counter = GzipLines()
    feed = counter.counter.feed

    def watched(text):
        nonlocal longest
        longest = max(longest, len(text))
        feed(text)

    monkeypatch.setattr(counter.counter, "feed", watched)
    counter.feed(packed)
    assert counter.result() == (20 * BLOCK, None) and longest <= BLOCK


def test_files_of_folders(spark, tmp_path):
    pick, want = random.Random(3), {}
    for i in range(40):
        text = b"line\n" * pick.randrange(100)
        path = tmp_path / ["a", "b %20c"][i % 2] / f"f{i}.{'txt.gz' if i % 3 else 'txt'}"
        path.parent.mkdir(exist_ok=True)
        data = gzip.compress(text) if i % 3 else text
        path.write_bytes(data)
        want[str(path)] = (len(data), hashlib.sha256(data).hexdigest(), text.count(b"\n"))
    for name in ("_SUCCESS", ".f.txt.crc"):
        (tmp_path / "a" / name).write_bytes(b"x")
    (tmp_path / "_tmp").mkdir()
    (tmp_path / "_tmp" / "f.txt").write_bytes(b"x")
    got = file_facts(spark, str(tmp_path), task_bytes=500)
    assert got.rdd.getNumPartitions() > 1
    assert {r.path: (r.bytes, r.sha256, r.lines) for r in got.collect()} == want
    some = file_facts(spark, [f"file:{tmp_path}/a", f"file://{tmp_path}/none", str(next(iter(want)))], "*.gz", skip_missing=True).collect()
    assert {r.path.removeprefix("file:") for r in some} == {p for p in want if "/a/" in p and p.endswith(".gz")}
    with pytest.raises(Exception, match="none"):
        file_facts(spark, str(tmp_path / "none")).collect()
    assert file_facts(spark, str(tmp_path / "none"), skip_missing=True).collect() == []


def test_paths_are_not_unescaped():
    assert file_system("file:/x/a %20b")[1:] == ("/x/a %20b", "file:") and file_system("/x/y:z")[1:] == ("/x/y:z", "")
