"""JSON-lines tables, markers, partitions, exports."""

from __future__ import annotations

import json
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope.functions import urls
from shelfscope.operators.assets import new_contents
from shelfscope.operators.keyed import keep_keys

CREATE_COLUMNS = {
    "crawl_manifest_raw": ("run_id STRING, raw_json STRING", "site STRING, dt STRING, run STRING"),
    "crawl_quality_raw": ("run_id STRING, raw_json STRING", "site STRING, dt STRING, run STRING"),
    "image_download_log": (
        "site STRING, primary_key STRING, url STRING, run_id STRING, status STRING, reason STRING, "
        "error_message STRING, http_status INT, s3_blob_key STRING",
        "dt STRING, run STRING",
    ),
    "image_validated": (
        "site STRING, primary_key STRING, image_url STRING, s3_blob_key STRING, sha256 STRING, width INT, "
        "height INT, format STRING, run_id STRING",
        "dt STRING, run STRING",
    ),
}


def append_records(records: DataFrame, path: str, by: list[str] = []) -> None:
    """JSON lines, explicit nulls kept, UTF-8 unescaped."""
    records.write.mode("append").option("ignoreNullFields", "false").partitionBy(*by).json(path)


def append_batch(records: DataFrame, path: str, batch: str, by: list[str] = []) -> bool:
    """Appends the records of a batch once, however often it is run; says whether it did.

    An attempt writes to a folder of its own and is entered in the ledger under the batch's name when all of it is written; the entry is
    written aside and renamed, so it is there whole or not at all. What a lost attempt left is in no ledger and is never read.
    """
    spark, attempt = records.sparkSession, uuid.uuid4().hex
    if _LedgerEntry(spark, path, batch).exists():
        return False
    append_records(records, os.path.join(path, "data", f"batch={batch}", f"attempt={attempt}"), by)
    return _LedgerEntry(spark, path, batch).create(json.dumps({"batch": batch, "attempt": attempt}))


class _LedgerEntry:
    def __init__(self, spark: SparkSession, path: str, batch: str):
        self.path = spark._jvm.org.apache.hadoop.fs.Path(os.path.join(path, "ledger", f"{batch}.json"))
        self.files = self.path.getFileSystem(spark._jsc.hadoopConfiguration())

    def exists(self) -> bool:
        return self.files.exists(self.path)

    def create(self, text: str) -> bool:
        aside = self.path.suffix(f".{uuid.uuid4().hex}.tmp")
        stream = self.files.create(aside, False)
        stream.write(bytearray(text.encode("utf-8")))
        stream.close()
        return not self.exists() and self.files.rename(aside, self.path)


def read_appended(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """All batches in the ledger, with `batch`. Folders of other attempts are pruned, as both names are partitions."""
    ledger = spark.read.schema("batch string, attempt string").option("pathGlobFilter", "*.json").json(os.path.join(path, "ledger"))
    rows = spark.read.schema(f"{schema}, batch string, attempt string").json(os.path.join(path, "data"))
    return rows.join(ledger, ["batch", "attempt"], "left_semi").select(*[c for c in rows.columns if c != "attempt"])


def write_lines(lines: DataFrame, path: str) -> None:
    """One text column as gzip lines."""
    lines.write.mode("overwrite").option("compression", "gzip").text(path)


def write_document(spark: SparkSession, document: str, path: str) -> None:
    """One small text as one file of this name, in whatever file system the path is."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    stream = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    try:
        stream.write(bytearray(document.encode("utf-8")))
    finally:
        stream.close()


def write_run_partitions(rows: DataFrame, path: str, by: tuple[str, ...] = ("dt", "run")) -> None:
    """Gzip JSON lines partitioned by run. A repeated run overwrites its own partition only."""
    (
        rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("compression", "gzip")
        .option("ignoreNullFields", "false").partitionBy(*by).json(path)
    )


def write_if_any(rows: DataFrame, path: str, by: tuple[str, ...] = ("dt", "run")) -> bool:
    """Same, but leaves no trace of an empty result."""
    if rows.isEmpty():
        return False
    write_run_partitions(rows, path, by)
    return True


def write_markers(markers: DataFrame, path: str) -> None:
    """Markers are rows of a table: files that start with '_' are invisible to file streams."""
    by = ["site", "dt", "run_id"]
    columns = [c for c in markers.columns if c not in by]
    markers.select(*columns, *by).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).json(path)


def create_table(spark: SparkSession, table: str, path: str, kind: str) -> None:
    columns, partitions = CREATE_COLUMNS[kind]
    spark.sql(
        f"CREATE TABLE IF NOT EXISTS {table} ({columns}, {partitions}) USING json "
        f"OPTIONS (path '{path}') PARTITIONED BY ({', '.join(p.split()[0] for p in partitions.split(', '))})"
    )


def register_partitions(spark: SparkSession, table: str, partitions: DataFrame, batch: int = 500) -> int:
    """ALTER TABLE .. ADD IF NOT EXISTS for every distinct row of `partitions`; repeats do nothing.

    The statement runs on the driver, so the distinct partitions (not data rows) are streamed to
    it and added in batches. The run is always one of the partition columns: a partition that
    points at a folder of run folders would read as empty.
    """
    names, done, specs = partitions.columns, 0, []

    def add() -> None:
        spark.sql(f"ALTER TABLE {table} ADD IF NOT EXISTS " + " ".join(specs))

    for row in partitions.distinct().toLocalIterator():
        values = ", ".join(f"{n}='" + str(row[n]).replace("'", "''") + "'" for n in names)
        specs.append(f"PARTITION ({values})")
        done += 1
        if len(specs) == batch:
            add()
            specs = []
    if specs:
        add()
    return done


def store_contents(
    blobs: DataFrame, id_col: str, stored: DataFrame | None, path: str, prefix: str, suffix: str = "", run: str = "all"
) -> None:
    """Writes content that is not stored yet as (blob_key, sha256, content) rows of partition `run`, one per digest.

    Digests are compared first; bytes are then read again for the chosen ids. A repeated run finds its own earlier
    output (or gets the same `stored`) and leaves the same rows: what the partition already holds is written again with the rest.
    """
    keys = blobs.select(id_col, F.sha2("content", 256).alias("sha256"), F.octet_length("content").alias("bytes"))
    chosen = new_contents(keys, id_col, stored).select(id_col)
    (
        keep_keys(blobs, chosen, id_col)
        .withColumn("sha256", F.sha2("content", 256))
        .select(urls.blob_key(prefix, F.col("sha256"), F.lit(suffix)).alias("blob_key"), "sha256", "content", F.lit(run).alias("run"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run").parquet(path)
    )


def write_seed_csv(candidates: DataFrame, path: str, url: str = "pdp_url", max_records: int = 1_000_000) -> None:
    """One-column URL lists. Split over files when large; readers take the folder."""
    candidates.select(url).write.mode("overwrite").option("maxRecordsPerFile", max_records).csv(path)


def write_silver(records: DataFrame, path: str, by: tuple[str, ...] = ("site", "crawl_date")) -> None:
    """Typed product records as Parquet, partitioned.

    The rebalance hint gathers small partitions and splits large ones, so a site with most of
    the rows is written by many tasks.
    """
    (
        records.hint("rebalance", *by)
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
    )
