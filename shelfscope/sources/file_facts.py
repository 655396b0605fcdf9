"""Size, digests and line counts of stored files, read in blocks: a batch data source, `spark.read.format("file_facts")`.

Memory is a block per task whatever a file's size, and there is no 2 GB limit, as no file becomes a value of a row. Paths are those of
`pyarrow.fs` (local and mounted folders, hdfs, s3, gs); listing and reading go through the same file system.
"""

from __future__ import annotations

import fnmatch
import hashlib
import re
import zlib
from collections.abc import Iterator
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

BLOCK = 1 << 20
SCHEMA = "path string, bytes bigint, md5 string, sha256 string, lines bigint, problem string"
#: Files are dealt to tasks until a task has this many bytes; a longer one is a task of its own.
TASK_BYTES = 128 << 20
GZIP = ".gz"
LISTED_AT_ONCE = 16


class LineCounter:
    """LF, CR and CR LF each end a line; text after the last of them is a line too."""

    def __init__(self):
        self.lines, self.last = 0, b""

    def feed(self, text: bytes) -> None:
        if text:
            self.lines += text.count(b"\n") + text.count(b"\r") - text.count(b"\r\n") - (self.last == b"\r" and text[:1] == b"\n")
            self.last = text[-1:]

    def total(self) -> int:
        return self.lines + (self.last not in (b"", b"\n", b"\r"))


class GzipLines:
    """Lines of a gzip file of any number of members, fed in blocks; zero bytes may follow the last member."""

    def __init__(self):
        self.counter, self.member, self.problem, self.begun, self.padding = LineCounter(), None, None, False, False

    def feed(self, block: bytes) -> None:
        while block and self.problem is None:
            if self.member is None:
                if self.begun and (self.padding or block[:1] == b"\0"):
                    self.padding = True
                    if block.strip(b"\0"):
                        self.problem = "data after the padding"
                    return
                self.member, self.begun = zlib.decompressobj(wbits=31), True
            try:
                while True:
                    text = self.member.decompress(block, BLOCK)
                    self.counter.feed(text)
                    block = self.member.unconsumed_tail
                    # a full part may leave text behind although all input is taken
                    if self.member.eof or not block and len(text) < BLOCK:
                        break
            except zlib.error as error:
                self.problem = str(error)
                return
            if self.member.eof:
                block, self.member = self.member.unused_data, None

    def result(self) -> tuple[int | None, str | None]:
        if self.problem is None and not self.begun:
            self.problem = "empty file"
        if self.problem is None and self.member is not None:
            self.problem = "unexpected end"
        return (None, self.problem) if self.problem else (self.counter.total(), None)


def facts_of(blocks: Iterator[bytes], compressed: bool) -> tuple[int, str, str, int | None, str | None]:
    """(bytes, md5, sha256, lines, problem) of a file; digests are those of the stored bytes."""
    size, md5, sha256, lines = 0, hashlib.md5(), hashlib.sha256(), GzipLines() if compressed else LineCounter()
    for block in blocks:
        size += len(block)
        md5.update(block)
        sha256.update(block)
        lines.feed(block)
    found = lines.result() if compressed else (lines.total(), None)
    return (size, md5.hexdigest(), sha256.hexdigest(), *found)


def file_system(path: str) -> tuple[fs.FileSystem, str, str]:
    """(file system, path on it, prefix to put before what it lists). Nothing in a path is escaped."""
    found = re.match(r"([a-z][a-z0-9+.-]*):(//[^/]*)?(/.*)", path)
    if not found:
        return fs.LocalFileSystem(), path, ""
    scheme, host, rest = found[1], found[2] or "//", found[3]
    if scheme == "file":
        return fs.LocalFileSystem(), rest, "file:"
    if host == "//":
        raise ValueError(f"{path}: name the host or bucket")
    store, base = fs.FileSystem.from_uri(f"{scheme}:{host}/")
    # object stores list bucket and key, the others a path from the root
    inner = (base.rstrip("/") + rest) if base.strip("/") else rest
    return store, inner, f"{scheme}://" if base.strip("/") else f"{scheme}:{host}"


@dataclass
class Files(InputPartition):
    paths: list[tuple[str, str]]


def _hidden(name: str) -> bool:
    return any(part[:1] == "." or part[:1] == "_" and "=" not in part for part in name.split("/"))


class FileFactsReader(DataSourceReader):
    def __init__(self, options: dict[str, str]):
        self.roots = options["path"].split("\n")
        self.pattern = options.get("pathglobfilter", "*")
        self.task_bytes = int(options.get("taskbytes", TASK_BYTES))
        self.skip_missing = options.get("skipmissing") == "true"

    def partitions(self) -> list[Files]:
        with ThreadPoolExecutor(LISTED_AT_ONCE) as pool:
            found = {path: (root, size) for files in pool.map(self.listed, self.roots) for path, root, size in files}
        parts, filled = [], 0
        for path, (root, size) in sorted(found.items()):
            if not parts or filled + size > self.task_bytes:
                parts.append(Files([]))
                filled = 0
            parts[-1].paths.append((path, root))
            filled += size
        return parts or [Files([])]

    def listed(self, root: str) -> list[tuple[str, str, int]]:
        store, inner, prefix = file_system(root.rstrip("/") or "/")
        info = store.get_file_info(inner)
        if info.type == fs.FileType.NotFound:
            if self.skip_missing:
                return []
            raise FileNotFoundError(root)
        files = [info] if info.is_file else store.get_file_info(fs.FileSelector(inner, recursive=True))
        return [
            (prefix + f.path, root, f.size or 0) for f in files
            if f.is_file and not _hidden(f.path[len(inner) :].strip("/")) and fnmatch.fnmatchcase(f.base_name, self.pattern)
        ]

    def read(self, partition: Files) -> Iterator[pa.RecordBatch]:
        for path, root in partition.paths:
            store, _, prefix = file_system(root)
            try:
                with store.open_input_stream(path[len(prefix) :], compression=None) as stream:
                    facts = facts_of(iter(lambda: stream.read(BLOCK), b""), path.endswith(GZIP))
            except OSError as error:
                facts = (None, None, None, None, f"cannot be read: {type(error).__name__}")
            columns = [[path], *([x] for x in facts)]
            types = [pa.string(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, types, strict=True)], ["path", "bytes", "md5", "sha256", "lines", "problem"]
            )


class FileFacts(DataSource):
    """Options: path (one per line), pathGlobFilter on the file name, taskBytes, skipMissing."""

    @classmethod
    def name(cls) -> str:
        return "file_facts"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> FileFactsReader:
        return FileFactsReader({k.lower(): v for k, v in self.options.items()})


def file_facts(spark: SparkSession, path: str | list[str], name_filter: str = "*", task_bytes: int = TASK_BYTES, skip_missing: bool = False) -> DataFrame:
    """(path, bytes, md5, sha256, lines, problem): one row per file below `path`.

    Digests are of the bytes as stored, lines of the decompressed text where the name ends in .gz. A file that is cut, damaged or no gzip has a
    problem and no line count, one that cannot be read has a problem only. Names with a leading `_` or `.` are left out.
    """
    spark.dataSource.register(FileFacts)
    roots = [path] if isinstance(path, str) else path
    options = {"pathGlobFilter": name_filter, "taskBytes": str(task_bytes), "skipMissing": str(skip_missing).lower(), "path": "\n".join(roots)}
    return spark.read.format("file_facts").options(**options).load()
