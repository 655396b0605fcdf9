"""Content-addressed blobs and validated images."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscope import fixed_values as fv
from shelfscope.functions import images, urls
from shelfscope.operators.keyed import join_spread, keep_keys, latest_per_key


def content_keys(blobs: DataFrame, id_col: str, content: str = "content") -> DataFrame:
    """(id, sha256, bytes). The content itself goes no further than this projection."""
    return blobs.select(
        id_col, F.sha2(F.col(content), 256).alias("sha256"), F.octet_length(content).cast("bigint").alias("bytes")
    )


def new_contents(keys: DataFrame, id_col: str, stored: DataFrame | None = None) -> DataFrame:
    """One id per distinct content not stored yet: the lowest id stands for all copies.

    Works on hashes only. The bytes are read once more for the chosen ids when they are written,
    which is far less than shuffling all copies.
    """
    chosen = keys.groupBy("sha256").agg(F.min(id_col).alias(id_col), F.min("bytes").alias("bytes"))
    return chosen.join(stored.select("sha256").distinct(), "sha256", "left_anti") if stored is not None else chosen


def shared_contents(keys: DataFrame, owner: str) -> DataFrame:
    """(sha256, owner, owners) for content that several owners share, one row per owner.

    Rows, not a collected list: content that half of all products share stays distributed.
    """
    pairs = keys.select("sha256", owner).distinct()
    sizes = pairs.groupBy("sha256").agg(F.count("*").alias("owners")).where("owners > 1")
    return join_spread(pairs, sizes, ["sha256"], [owner], how="inner")


def rows_to_validate(log: DataFrame) -> DataFrame:
    return log.where((F.col("status") == fv.STATUS_OK) & (F.col("s3_blob_key") != ""))


def judge(sha_expected: Column, sha_actual: Column, info: Column) -> Column:
    """Reason text, 'ok' for a valid image; hash first, then structure, then size."""
    small = (info["width"] < fv.MIN_IMAGE_SIDE) | (info["height"] < fv.MIN_IMAGE_SIDE)
    size = F.concat(info["width"].cast("string"), F.lit("x"), info["height"].cast("string"))
    return (
        F.when(sha_actual.isNull(), "fetch_error")
        .when(sha_actual != sha_expected, "sha256_mismatch")
        .when(info["problem"].isNotNull(), F.concat(F.lit("invalid_image: "), info["problem"]))
        .when(small, F.concat(F.lit("too_small: "), size))
        .otherwise("ok")
    )


def inspect_blobs(blobs: DataFrame) -> DataFrame:
    """(blob_key, content) -> (blob_key, actual_sha256, info). Each blob is opened once, where it is read."""
    return blobs.select(
        "blob_key", F.sha2("content", 256).alias("actual_sha256"), images.image_info(F.col("content")).alias("info")
    )


def validate_images(log: DataFrame, blobs: DataFrame) -> DataFrame:
    """Log rows of one or more runs + blobs (one per key) -> every ok row with its `verdict` and image facts.

    Only wanted blobs are hashed and opened, once each; what is joined to the rows (many may share a blob) are the facts.
    """
    rows = rows_to_validate(log).withColumn("sha256", urls.sha_from_blob_key(F.col("s3_blob_key")))
    wanted = rows.select(F.col("s3_blob_key").alias("blob_key"))
    facts = inspect_blobs(keep_keys(blobs, wanted, "blob_key")).withColumnRenamed("blob_key", "s3_blob_key")
    joined = join_spread(rows, facts, ["s3_blob_key"], ["site", "primary_key", "url"])
    reason = judge(F.col("sha256"), F.col("actual_sha256"), F.col("info"))
    return joined.withColumn("verdict", reason)


def validated_rows(checked: DataFrame) -> DataFrame:
    return checked.where("verdict = 'ok'").select(
        "site", "primary_key", F.col("url").alias("image_url"), "s3_blob_key", "sha256",
        F.col("info.width").alias("width"), F.col("info.height").alias("height"), F.col("info.format").alias("format"),
        "run_id", "dt", "run",
    )


def validation_counters(checked: DataFrame, by: list[str] = []) -> DataFrame:
    """ok / rejected / fetch_error"""
    kind = F.when(F.col("verdict").isin("ok", "fetch_error"), F.col("verdict")).otherwise("rejected")
    return checked.groupBy(*by, kind.alias("outcome")).agg(F.count("*").alias("n"))


def serving_status(catalogue: DataFrame, validated: DataFrame, log: DataFrame) -> DataFrame:
    """Catalogue rows with the latest attempt and whether a validated image exists."""
    keys = ["site", "primary_key", "url"]
    have = latest_per_key(
        validated.withColumnRenamed("image_url", "url"), keys, ["run_id"], ["s3_blob_key"]
    ).select(*keys, "s3_blob_key")
    tried = latest_per_key(log, keys, ["run_id"], ["status"]).select(*keys, F.col("status").alias("last_status"))
    # Both lookups have one row per key, so their union is joined to the rows in one step.
    known = have.join(tried, keys, "full")
    return join_spread(catalogue, known, keys, catalogue.columns).withColumn(
        "is_downloaded", F.col("s3_blob_key").isNotNull()
    )
