"""Session settings and the shared scratch folder."""

from __future__ import annotations

import os
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Runtime SQL settings the operators rely on for speed or exactness.
# `allowDuplicateKeys` makes JSON parsing keep the last of two equal keys
# instead of rejecting the line.
SQL_SETTINGS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.execution.arrow.maxRecordsPerBatch": "1000",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
}


#: Temporary folders of local sessions, by application.
LOCAL_ROOTS: dict[str, str] = {}


def build_session(master: str | None = None, app_name: str = "shelfscope", **extra: str) -> SparkSession:
    """A session with the settings above; `master=None` leaves it to spark-submit."""
    builder = SparkSession.builder.appName(app_name).config("spark.ui.enabled", "false")
    if master:
        builder = builder.master(master)
    for key, value in {**SQL_SETTINGS, **extra}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def allow_duplicate_json_keys(spark: SparkSession) -> None:
    """Needed by every job that parses JSON text, also in a session we did not build."""
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")


def scratch_root(spark: SparkSession) -> str:
    """The shared folder for written intermediate tables.

    A cluster names it in `spark.checkpoint.dir`. Only a local master, whose tasks run on this machine, may do
    without: then a temporary folder is made once for the session.
    """
    root = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if root:
        return root
    if not re.fullmatch(r"local(\[[^\]]*\])?", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    app = spark.sparkContext.applicationId
    if app not in LOCAL_ROOTS:
        LOCAL_ROOTS[app] = tempfile.mkdtemp(prefix="shelfscope-")
    return LOCAL_ROOTS[app]


def materialize(rows: DataFrame, name: str) -> DataFrame:
    """Writes a costly intermediate result to the shared folder once and reads it from there.

    Survives lost executors, and steps that use the result twice do not compute it twice.
    """
    path = scratch_path(rows.sparkSession, name)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new path under the shared folder, never reused."""
    return os.path.join(scratch_root(spark), "shelfscope", f"{name}-{uuid.uuid4().hex}")
