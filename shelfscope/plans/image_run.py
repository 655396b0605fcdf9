"""One image run: pending rows -> jobs -> outcomes -> log partition -> marker, and its validation."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope import schemas
from shelfscope.operators import assets, jobs, outcomes, pending
from shelfscope.session import materialize
from shelfscope.sinks import tables as sinks
from shelfscope.sources.tables import read_run_partition


def run_images(
    catalogue: DataFrame, log: DataFrame, responses: DataFrame, run_id: str, dt: str, log_path: str,
    marker_path: str, blob_prefix: str, limit: int | None = None,
) -> DataFrame:
    """Writes the run's log partition and marker; returns the log rows as written."""
    spark = catalogue.sparkSession
    todo = pending.usable_rows(pending.pending_work(catalogue, log, limit=limit)).select(
        "site", "primary_key", F.col("url").alias("image_url"), F.lit(None).cast("string").alias("source_run_id"),
    )
    planned = materialize(jobs.plan_jobs(todo.distinct(), ["site", "primary_key", "image_url"]), "planned")
    results = outcomes.job_outcomes(planned, responses, run_id, blob_prefix=blob_prefix)
    sinks.write_run_partitions(outcomes.log_rows(outcomes.loggable(results), dt, run_id), log_path)
    written = read_run_partition(spark, log_path, schemas.IMAGE_DOWNLOAD_LOG, dt, run_id)
    marker = outcomes.run_marker(written).select(
        F.lit("images").alias("site"), F.lit(dt).alias("dt"), F.lit(run_id).alias("run_id"), "marker", F.lit("").alias("body"),
    )
    sinks.write_markers(marker, marker_path)
    return written


def validate_run(spark: SparkSession, log_path: str, blobs: DataFrame, dt: str, run_id: str, validated_path: str) -> DataFrame:
    """Validates one (dt, run) partition; returns its counters. Nothing is written if nothing passed."""
    log = read_run_partition(spark, log_path, schemas.IMAGE_DOWNLOAD_LOG, dt, run_id)
    checked = assets.validate_images(log, blobs)
    sinks.write_if_any(assets.validated_rows(checked), validated_path)
    return assets.validation_counters(checked)
