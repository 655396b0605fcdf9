"""Facts of files that tasks write from the document table."""

from __future__ import annotations

import gzip

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope.checks.registry import query, table
from shelfscope.session import scratch_path
from shelfscope.sources import file_facts as facts
from shelfscope.sources import tables

KINDS = ["plain", "gzip", "members", "cut"]


def written(texts: DataFrame, path: str) -> None:
    """(name, kind, text) rows as files, each written by the task that has its row."""

    def write(batches):
        store, inner, _ = facts.file_system(path)
        store.create_dir(inner)
        for batch in batches:
            for name, kind, text in zip(*(batch.column(i).to_pylist() for i in range(3)), strict=True):
                data, half = text.encode(), len(text.encode()) // 2
                if kind == "members":
                    data = gzip.compress(data[:half]) + gzip.compress(data[half:]) + bytes(5)
                elif kind != "plain":
                    data = gzip.compress(data)
                with store.open_output_stream(f"{inner}/{name}", compression=None) as out:
                    out.write(data[:-6] if kind == "cut" else data)
            yield pa.RecordBatch.from_arrays([pa.array([batch.num_rows])], ["n"])

    texts.select("name", "kind", "text").mapInArrow(write, "n long").agg(F.sum("n")).collect()


@query("""
WITH f AS (SELECT doc_id // 25 AS file, string_agg(coalesce(text, ''), chr(10) ORDER BY doc_id) AS c FROM documents GROUP BY 1)
SELECT file, ['plain', 'gzip', 'members', 'cut'][file % 4 + 1] AS kind, CASE WHEN file % 4 = 0 THEN strlen(c) END AS bytes,
  CASE WHEN file % 4 = 0 THEN sha256(c) END AS sha256, CASE WHEN file % 4 = 0 THEN md5(c) END AS md5,
  CASE WHEN file % 4 < 3 THEN len(regexp_extract_all(c, '\\r\\n|\\r|\\n')) + CASE WHEN c = '' OR right(c, 1) IN (chr(10), chr(13)) THEN 0 ELSE 1 END END AS lines,
  CASE WHEN file % 4 = 3 THEN 'unexpected end' END AS problem, TRUE AS digests_agree FROM f
""")
def file_facts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Size, digests, lines and damage of plain, packed, many-member and cut files; digests also against those of whole contents."""
    path = scratch_path(spark, "facts")
    file = F.floor(F.col("doc_id") / 25)
    texts = table(spark, sf_dir, "documents").groupBy(file.alias("file")).agg(F.array_sort(F.collect_list(F.struct("doc_id", F.coalesce("text", F.lit("")).alias("t")))).alias("d"))
    kind = F.element_at(F.array(*map(F.lit, KINDS)), (F.col("file") % 4 + 1).cast("int"))
    name = F.concat(F.col("file").cast("string"), F.when(kind == "plain", ".jsonl").otherwise(".jsonl.gz"))
    written(texts.select(name.alias("name"), kind.alias("kind"), F.array_join("d.t", "\n").alias("text")), path)
    whole = tables.read_blobs(spark, path).select(
        F.substring_index("path", "/", -1).alias("name"), F.md5("content").alias("m"), F.sha2("content", 256).alias("s"), "length")
    found = facts.file_facts(spark, path).withColumn("name", F.substring_index("path", "/", -1)).join(whole, "name")
    number = F.substring_index("name", ".", 1).cast("long")
    plain = number % 4 == 0
    return found.select(
        number.alias("file"), F.element_at(F.array(*map(F.lit, KINDS)), (number % 4 + 1).cast("int")).alias("kind"),
        F.when(plain, F.col("bytes")).alias("bytes"), F.when(plain, F.col("sha256")).alias("sha256"), F.when(plain, F.col("md5")).alias("md5"),
        "lines", "problem", ((F.col("m") == F.col("md5")) & (F.col("s") == F.col("sha256")) & (F.col("length") == F.col("bytes"))).alias("digests_agree"),
    )
