"""Outcomes of image jobs over a table of stored responses, and the download log."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscope import fixed_values as fv
from shelfscope.functions import text, urls
from shelfscope.operators.jobs import input_problem
from shelfscope.operators.keyed import join_spread


def result_blob(**parts: Column) -> Column:
    """The nested result record; parts that are not given are NULL. `error` is NULL without a message."""

    def part(name: str, kind: str = "string") -> Column:
        return parts.get(name, F.lit(None)).cast(kind)

    error = F.struct(part("error_type").alias("type"), part("error_message").alias("message"))
    return F.struct(
        F.lit(fv.RESULT_SCHEMA_VERSION).alias("schema_version"),
        part("status").alias("status"),
        part("reason").alias("reason"),
        part("event_time_utc").alias("event_time_utc"),
        part("download_run_id").alias("download_run_id"),
        F.struct(
            part("job_id").alias("job_id"), part("site").alias("site"), part("primary_key").alias("primary_key"),
            part("source_run_id").alias("source_run_id"),
            part("input_source", "struct<jsonl_path:string,line_no:bigint>").alias("input_source"),
        ).alias("job"),
        F.struct(
            part("image_url").alias("image_url"), part("normalized_image_url").alias("normalized_image_url")
        ).alias("request"),
        F.struct(
            part("output_path").alias("output_path"), part("canonical_blob_key").alias("canonical_blob_key")
        ).alias("storage"),
        F.struct(
            part("bytes", "bigint").alias("bytes"), part("content_sha256").alias("content_sha256"),
            part("content_type").alias("content_type"), part("http_status", "int").alias("http_status"),
        ).alias("transfer"),
        F.when(part("error_message").isNotNull() | part("error_type").isNotNull(), error).alias("error"),
        F.coalesce(part("details", "map<string,string>"), F.create_map().cast("map<string,string>")).alias("details"),
    )


def responses_with_digest(responses: DataFrame) -> DataFrame:
    """Responses without their bytes: length and SHA-256 instead, so no join moves content.

    One row per URL. Of several the latest by `fetched_at` counts, where there is such a column; ties and tables without it
    go to the highest remaining values, so the result never depends on row order.
    """
    facts = ["http_status", "content_type", "bytes", "content_sha256", "error_type", "error_message"]
    time = F.col("fetched_at") if "fetched_at" in responses.columns else F.lit(None).cast("timestamp")
    found = responses.select(
        F.col("url").alias("norm_url"), "http_status", "content_type",
        F.length("content").cast("bigint").alias("bytes"), F.sha2("content", 256).alias("content_sha256"),
        "error_type", "error_message", time.alias("fetched_at"),
    )
    return found.groupBy("norm_url").agg(F.max(F.struct("fetched_at", *facts)).alias("r")).select("norm_url", *[f"r.{c}" for c in facts])


def job_outcomes(
    planned: DataFrame, responses: DataFrame, run_id: str, root: str = "output/images", blob_prefix: str = "",
    event_time: Column | None = None,
) -> DataFrame:
    """Planned jobs + stored responses (the latest per URL) -> one result record per job, skips included.

    A refused request (no response, transport error, HTTP status >= 400) is request_failed; a
    response of another content type is rejected before its bytes count.
    """
    spread_by = ["job_id", "norm_site", "norm_key"]
    rows = join_spread(planned, responses_with_digest(responses), ["norm_url"], spread_by)
    skipped = F.col("status").isNotNull()
    failed = F.col("http_status").isNull() | (F.col("http_status") >= 400) | F.col("error_type").isNotNull()
    wrong_type = ~text.is_image_content_type(F.col("content_type"))
    reason = (
        F.when(skipped, F.col("reason")).when(failed, "request_failed").when(wrong_type, "non_image_content_type")
        .otherwise("downloaded")
    )
    stored = reason == "downloaded"
    known = F.col("job_id").isNotNull()
    suffix = F.coalesce(
        urls.suffix_from_content_type(F.col("content_type")), urls.suffix_from_url(F.col("norm_url"))
    )
    message = (
        F.when(reason == "invalid_job_input", input_problem(F.col("site"), F.col("image_url")))
        .when(reason == "non_image_content_type",
              F.concat(F.lit("Expected image content type, got "), F.col("content_type")))
        .when(reason == "request_failed", F.coalesce(
            F.col("error_message"),
            F.concat(F.lit("HTTP status "), F.col("http_status").cast("string")), F.lit("no stored response")))
    )
    error_type = (
        F.when(reason == "invalid_job_input", "ValueError")
        .when(reason == "request_failed", F.coalesce(F.col("error_type"), F.lit("HTTPError")))
    )
    has_source = "input_source" in planned.columns
    return rows.select(
        result_blob(
            status=F.when(skipped, F.col("status")).when(stored, fv.STATUS_OK).otherwise(fv.STATUS_ERROR),
            reason=reason,
            event_time_utc=text.utc_iso(event_time if event_time is not None else F.current_timestamp()),
            download_run_id=F.lit(run_id),
            job_id=F.col("job_id"),
            site=F.when(known, F.col("norm_site")),
            primary_key=F.when(known, F.col("norm_key")),
            source_run_id=F.when(known, F.col("source_run_id")),
            input_source=F.when(known, F.col("input_source")) if has_source else F.lit(None),
            image_url=F.when(known, F.col("image_url")),
            normalized_image_url=F.when(known, F.col("norm_url")),
            output_path=F.when(stored, urls.output_path(
                root, F.col("norm_site"), F.col("norm_key"), F.col("norm_url"), F.col("source_run_id"), F.lit(run_id))),
            canonical_blob_key=F.when(stored, urls.blob_key(blob_prefix, F.col("content_sha256"), suffix)),
            bytes=F.when(stored, F.col("bytes")),
            content_sha256=F.when(stored, F.col("content_sha256")),
            content_type=F.when(stored | (reason == "non_image_content_type"), F.col("content_type")),
            http_status=F.when(stored | (reason == "non_image_content_type"), F.col("http_status")),
            error_type=error_type,
            error_message=message,
            details=F.when(reason == "invalid_job_input", F.create_map(
                F.lit("site"), F.col("site"), F.lit("primary_key"), F.col("primary_key"),
                F.lit("image_url"), F.col("image_url"))),
        ).alias("result")
    ).select("result.*")


def skip_results(skips: DataFrame, run_id: str, event_time: Column | None = None) -> DataFrame:
    """Rejected input lines (`read_job_lines`) as result records."""
    bad = skips.where("status IS NOT NULL")
    return bad.select(
        result_blob(
            status=F.col("status"), reason=F.col("reason"), download_run_id=F.lit(run_id),
            event_time_utc=text.utc_iso(event_time if event_time is not None else F.current_timestamp()),
            input_source=F.struct(F.col("file").alias("jsonl_path"), F.col("line_no").alias("line_no")),
            details=F.when(F.col("missing_fields").isNotNull(), F.create_map(
                F.lit("missing_fields"), F.to_json("missing_fields"))),
        ).alias("result")
    ).select("result.*")


def upload_outcomes(results: DataFrame, failed_keys: DataFrame) -> DataFrame:
    """Turns stored results whose blob could not be written into s3_upload_failed errors.

    `failed_keys(canonical_blob_key, error_type, error_message)` has one row per key.
    """
    failed = failed_keys.select(
        F.col("canonical_blob_key").alias("_key"), F.col("error_type").alias("_type"),
        F.col("error_message").alias("_message"),
    )
    keyed = results.withColumn("_key", F.col("storage.canonical_blob_key"))
    rows = join_spread(keyed, failed, ["_key"], ["job.job_id"])
    hit = F.col("_message").isNotNull()
    empty_transfer = F.struct(
        F.lit(None).cast("bigint").alias("bytes"), F.lit(None).cast("string").alias("content_sha256"),
        F.lit(None).cast("string").alias("content_type"), F.lit(None).cast("int").alias("http_status"),
    )
    return rows.withColumns({
        "status": F.when(hit, fv.STATUS_ERROR).otherwise(F.col("status")),
        "reason": F.when(hit, "s3_upload_failed").otherwise(F.col("reason")),
        "storage": F.when(hit, F.struct(
            F.lit(None).cast("string").alias("output_path"), F.col("_key").alias("canonical_blob_key"),
        )).otherwise(F.col("storage")),
        "transfer": F.when(hit, empty_transfer).otherwise(F.col("transfer")),
        "error": F.when(hit, F.struct(F.col("_type").alias("type"), F.col("_message").alias("message"))).otherwise(F.col("error")),
    }).drop("_key", "_type", "_message")


def loggable(results: DataFrame) -> DataFrame:
    """Duplicates are bookkeeping, not outcomes; a NULL status stays."""
    return results.where(~F.col("status").eqNullSafe(fv.STATUS_SKIPPED_DUPLICATE))


def log_rows(results: DataFrame, dt: str | Column, run_id: str | Column) -> DataFrame:
    """Result records flattened to the download log; missing structs give NULLs."""
    dt = F.lit(dt) if isinstance(dt, str) else dt
    run = F.lit(run_id) if isinstance(run_id, str) else run_id
    return results.select(
        F.col("job.site").alias("site"),
        F.col("job.primary_key").alias("primary_key"),
        F.col("request.image_url").alias("url"),
        run.alias("run_id"),
        "status",
        "reason",
        F.col("error.message").alias("error_message"),
        F.col("transfer.http_status").alias("http_status"),
        F.col("storage.canonical_blob_key").alias("s3_blob_key"),
        dt.alias("dt"),
        run.alias("run"),
    )


def status_histogram(rows: DataFrame, by: list[str] = []) -> DataFrame:
    known = F.coalesce(text.none_if_empty(F.col("status")), F.lit("unknown"))
    return rows.groupBy(*by, known.alias("status")).agg(F.count("*").alias("n"))


def summary_line(histogram: DataFrame, by: list[str] = []) -> DataFrame:
    """'error=1, ok=5': one text per group over the few distinct statuses."""
    pairs = F.collect_list(F.struct(F.col("status").alias("key"), F.col("n").alias("n")))
    return histogram.groupBy(*by).agg(text.count_summary(pairs).alias("summary"))


def run_marker(rows: DataFrame, by: list[str] = []) -> DataFrame:
    """_SUCCESS if no row is an error, else _FAILED."""
    errors = F.count_if(F.col("status") == fv.STATUS_ERROR)
    return rows.groupBy(*by).agg(
        errors.alias("errors"), F.when(errors == 0, fv.MARKER_SUCCESS).otherwise(fv.MARKER_FAILED).alias("marker")
    )
