"""Partitioned tables, artifacts, manifests and single jobs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope import schemas


def read_run_partition(spark: SparkSession, base: str, schema: str, dt: str, run: str) -> DataFrame:
    """One (dt, run) partition of a JSON table; the filter prunes directories.

    The explicit schema keeps `dt` text (it would be inferred as a date) and gives NULL for
    columns older files do not have.
    """
    return spark.read.schema(schema).json(base).where((F.col("dt") == dt) & (F.col("run") == run))


def read_blobs(spark: SparkSession, path: str, name_filter: str | None = None) -> DataFrame:
    """(path, modificationTime, length, content); `content` is only read where it is used."""
    reader = spark.read.format("binaryFile").option("recursiveFileLookup", "true")
    if name_filter:
        reader = reader.option("pathGlobFilter", name_filter)
    return reader.load(path)


def read_manifests(spark: SparkSession, base: str) -> DataFrame:
    """(path, raw): every manifest.json below `base`, one row per file; the path is as stored, nothing in it escaped."""
    return read_blobs(spark, base, "manifest.json").select("path", F.decode("content", "UTF-8").alias("raw"))


def single_job(
    spark: SparkSession, site: str, primary_key: str, image_url: str, source_run_id: str | None = None
) -> DataFrame:
    """An inline job as a one-row table of the job schema."""
    for name, value in (("site", site), ("primary_key", primary_key), ("image_url", image_url)):
        if not value:
            raise ValueError(f"{name} is required")
    return spark.createDataFrame([(site, primary_key, image_url, source_run_id, None)], schemas.IMAGE_JOB)


def read_query_csv(spark: SparkSession, path: str) -> DataFrame:
    """An exported query result: all text, empty cells are NULL."""
    raw = spark.read.option("header", "true").csv(path)
    return raw.select(*[F.nullif(F.col(f"`{c}`"), F.lit("")).alias(c) for c in raw.columns])
