"""Line dedup over levelled sorted runs of line hashes.

Documents come in batches. What is known of all earlier lines lies in runs: tables sorted by line hash with, per hash,
the number of documents and the largest document id. A new batch is anti-joined with the runs (which of its lines were
never seen) and then adds a run of its own on level 0; when a level holds `fanout` runs, they are merged into one run
of the next level. So there are about fanout * log(batches) runs, and a line is rewritten once per level.
"""

from __future__ import annotations

import hashlib

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope.llm.blocks import free_name
from shelfscope.session import materialize

MIN_LENGTH = 40
MIN_DOCUMENTS = 5
FANOUT = 2
BATCHES = 4
#: A line in more documents than this is joined by broadcast. N lines have at most N / HOT_DOCUMENTS such keys.
HOT_DOCUMENTS = 1_000_000
BLANKS = " \t\n\v\f\r"


def line_key(line: str, min_length: int) -> bytes | None:
    """The hash of a line's key; None for a key that is too short to count. Bytes lower only A-Z."""
    bare = line.strip(BLANKS)
    return hashlib.blake2b(bare.encode("utf-8", "surrogatepass").lower(), digest_size=16).digest() if len(bare) >= min_length else None


def document_lines(docs: DataFrame, min_length: int = MIN_LENGTH) -> DataFrame:
    """(doc_id, key): every long line of every document (doc_id, text), once per document row."""

    def split(batches):
        for batch in batches:
            ids, keys = [], []
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                found = {line_key(line, min_length) for line in (text.as_py() or "").split("\n")} - {None}
                ids.extend([doc_id] * len(found))
                keys.extend(found)
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()), pa.array(keys, pa.binary())], ["doc_id", "key"])

    return docs.mapInArrow(split, "doc_id long, key binary")


class LineRuns:
    """The runs of all lines seen so far."""

    def __init__(self, spark: SparkSession, fanout: int = FANOUT):
        self.spark, self.fanout = spark, fanout
        self.levels: list[list[DataFrame]] = []

    def rows(self) -> DataFrame:
        """(key, n_docs, last_id) of all runs together; a key is in one run or in several."""
        out = self.spark.createDataFrame([], "key binary, n_docs long, last_id long")
        for level in self.levels:
            for run in level:
                out = out.union(run)
        return out

    def totals(self) -> DataFrame:
        return self.rows().groupBy("key").agg(F.sum("n_docs").alias("n_docs"), F.max("last_id").alias("last_id"))

    def add(self, lines: DataFrame) -> DataFrame:
        """Takes a batch's (doc_id, key), each pair once; returns its keys that no earlier batch had, with their largest doc_id.

        A document must not be spread over two batches, or it counts twice.
        """
        run = materialize(
            lines.groupBy("key").agg(F.count("*").alias("n_docs"), F.max("doc_id").alias("last_id")).sortWithinPartitions("key"),
            "line-run",
        )
        new = run.join(self.rows().select("key").distinct(), "key", "left_anti").select("key", "last_id")
        new = materialize(new, "new-lines") if self.levels else new
        self._put(run, 0)
        return new

    def _put(self, run: DataFrame, level: int) -> None:
        if len(self.levels) == level:
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) >= self.fanout:
            merged = self.levels[level][0]
            for other in self.levels[level][1:]:
                merged = merged.union(other)
            merged = merged.groupBy("key").agg(F.sum("n_docs").alias("n_docs"), F.max("last_id").alias("last_id"))
            self.levels[level] = []
            self._put(materialize(merged.sortWithinPartitions("key"), "line-run"), level + 1)


def lines_to_drop(
    docs: DataFrame, min_length: int = MIN_LENGTH, min_documents: int = MIN_DOCUMENTS, batches: int = BATCHES,
    fanout: int = FANOUT, hot_documents: int = HOT_DOCUMENTS,
) -> DataFrame:
    """(doc_id, key): lines that at least `min_documents` documents hold, but for the largest document id of each.

    Batches go from large ids to small ones, so the batch in which a key is new has its keeper.
    """
    spark = docs.sparkSession
    cuts = docs.select(
        F.percentile_approx("doc_id", F.array(*[F.lit(i / batches) for i in range(1, batches)]), F.lit(10_000)).alias("c")
    ).first()["c"] or []
    batch = sum((F.when(F.col("doc_id") <= c, 1).otherwise(0) for c in cuts), F.lit(0))
    lines = materialize(
        document_lines(docs.where("doc_id is not null"), min_length).distinct().withColumn("batch", batch), "document-lines"
    )
    runs = LineRuns(spark, fanout)
    keepers = None
    for i in range(batches):
        new = runs.add(lines.where(F.col("batch") == i).select("doc_id", "key"))
        keepers = new if keepers is None else keepers.union(new)
    often = materialize(
        runs.totals().where(F.col("n_docs") >= min_documents).select("key", "n_docs").join(keepers, "key"), "frequent-lines"
    )
    hot = often.where(F.col("n_docs") > hot_documents)
    by_hash = lines.join(F.broadcast(hot.select("key")), "key", "left_anti").join(often.where(F.col("n_docs") <= hot_documents), "key")
    by_copy = lines.join(F.broadcast(hot), "key")
    return by_hash.select("doc_id", "key", "last_id").union(by_copy.select("doc_id", "key", "last_id")).where("doc_id <> last_id").select("doc_id", "key")


def dedup_lines(
    docs: DataFrame, id_column: str = "doc_id", text_column: str = "text", min_length: int = MIN_LENGTH, **settings
) -> DataFrame:
    """All columns of `docs` with the text without its repeated lines, and n_lines (before) and n_dropped.

    A line's key is the line without white space at its ends, A-Z as a-z; only keys of `min_length` code points count.
    A NULL or empty text is one empty line, and becomes or stays empty. Rows that repeat an id are one document. Rows without id
    neither count nor lose a line. Existing columns n_lines and n_dropped are replaced.
    """
    drop_id = free_name(docs.columns, "_drop_id")
    drops = (
        lines_to_drop(
            docs.select(F.col(id_column).cast("long").alias("doc_id"), F.col(text_column).cast("string").alias("text")), min_length, **settings
        )
        .groupBy(F.col("doc_id").alias(drop_id)).agg(F.collect_list("key").alias(free_name(docs.columns, "_drop_keys")))
    )
    names = [c for c in docs.columns if c not in ("n_lines", "n_dropped")]
    text_at = names.index(text_column)

    def cut(batches):
        for batch in batches:
            n_lines, n_dropped, kept = [], [], []
            for text, keys in zip(batch.column(text_at), batch.column(batch.num_columns - 1), strict=True):
                lines = (text.as_py() or "").split("\n")
                n_lines.append(len(lines))
                gone = keys.as_py()
                if gone:
                    gone = set(gone)
                    lines = [line for line in lines if line_key(line, min_length) not in gone]
                n_dropped.append(n_lines[-1] - len(lines))
                kept.append("\n".join(lines))
            columns = list(batch.columns[:-1])
            columns[text_at] = pa.array(kept, pa.string())
            yield pa.RecordBatch.from_arrays(
                [*columns, pa.array(n_lines, pa.int64()), pa.array(n_dropped, pa.int64())], [*names, "n_lines", "n_dropped"]
            )

    rows = docs.select(*[F.col(f"`{c}`") for c in names]).withColumn(text_column, F.col(text_column).cast("string"))
    joined = rows.join(drops, rows[id_column].cast("long") == drops[drop_id], "left").drop(drop_id)
    schema = rows.schema.add("n_lines", "long").add("n_dropped", "long")
    return joined.mapInArrow(cut, schema)
