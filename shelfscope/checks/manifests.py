"""Manifests, verification and the models over them, from documents and events."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope.checks.registry import query, table
from shelfscope.functions import urls
from shelfscope.operators import manifest, verify
from shelfscope.plans import models

META = "bronze/dev/crawls/metadata/"


@query("""
WITH s AS (SELECT strftime(ts, '%Y-%m-%d') AS dt, event_type AS code, count(*) AS n FROM events GROUP BY ALL),
d AS (SELECT strftime(ts, '%Y-%m-%d') AS dt, count(*) AS requests_made, (epoch_us(max(ts)) - epoch_us(min(ts))) / 1e6 AS duration_seconds FROM events GROUP BY 1)
SELECT dt, code, n, requests_made, duration_seconds FROM s JOIN d USING (dt)
""")
def run_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests per day: total, seconds, count per status."""
    events = table(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("dt"), "ts", "event_type")
    stats = manifest.duration(manifest.count_requests(events, ["dt"], "event_type"))
    return stats.select("dt", F.explode("status_code_counts").alias("code", "n"), "requests_made", "duration_seconds")


def daily_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counter map of each day, keyed as the crawler keys its statistics."""
    events = table(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("dt"), "ts", "event_type")
    counted = manifest.count_requests(events, ["dt"], "event_type")
    prefixed = F.transform_keys("status_code_counts", lambda k, v: F.concat(F.lit("downloader/response_status_count/"), k))
    others = F.create_map(
        F.lit("downloader/request_count"), F.col("requests_made"),
        F.lit("log_count/ERROR"), F.coalesce(F.try_element_at("status_code_counts", F.lit("error")), F.lit(0)),
    )
    return counted.select("dt", "start_time", "finish_time", F.map_concat(prefixed, others).alias("counters"))


@query("""
WITH s AS (SELECT strftime(ts, '%Y-%m-%d') AS dt, event_type AS code, count(*) AS n FROM events GROUP BY ALL)
SELECT dt, CAST(sum(n) AS BIGINT) AS requests_made, CAST(coalesce(sum(n) FILTER (WHERE code = 'error'), 0) AS BIGINT) AS errors_count,
  string_agg(code || '=' || n, ', ' ORDER BY code) AS codes, 'finished' AS exit_reason, '{"urls":"a"}' AS entry_points FROM s GROUP BY dt
""")
def manifest_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stats block of a manifest built from counters, read back from its JSON text."""
    days = daily_counters(spark, sf_dir)
    runs = days.select(
        F.col("dt").alias("run_id"), F.lit("shop").alias("crawler_name"), F.lit("finished").alias("exit_reason"),
        F.create_map(F.lit("urls"), F.lit("a"), F.lit("password"), F.lit("b")).alias("arguments"), "start_time", "finish_time",
        manifest.manifest_stats(F.col("counters"), F.lit(5)).alias("stats"),
        F.struct(F.lit(5).cast("bigint").alias("file_size_bytes"), F.struct(F.lit("x").alias("sha256")).alias("hashes")).alias("artifacts"),
        F.lit(None).cast("struct<status:string>").alias("gate"),
    )
    docs = manifest.manifest_documents(manifest.build_manifest(runs))
    codes = F.from_json(F.get_json_object("raw", "$.stats.status_code_counts"), "map<string,bigint>")
    return docs.select(
        F.get_json_object("raw", "$.run_id").alias("dt"),
        models.json_column("raw", "$.stats.requests_made", "bigint").alias("requests_made"),
        models.json_column("raw", "$.stats.errors_count", "bigint").alias("errors_count"),
        manifest.run_summary(codes).alias("codes"),
        F.get_json_object("raw", "$.exit_reason").alias("exit_reason"),
        F.get_json_object("raw", "$.entry_points").alias("entry_points"),
    )


@query("""
SELECT doc_id, 'f' || doc_id || CASE WHEN lang = 'en' THEN '.jsonl.gz' ELSE '.jsonl' END AS file_path, strlen(text) AS file_size_bytes,
  sha256(text) AS sha256, md5(text) AS md5, CASE WHEN lang = 'en' THEN 'jsonl.gz' ELSE 'jsonl' END AS file_format, lang = 'en' AS compressed FROM documents
""")
def artifact_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Artifact block of every document taken as a file."""
    name = F.concat(F.lit("f"), F.col("doc_id").cast("string"), F.when(F.col("lang") == "en", ".jsonl.gz").otherwise(".jsonl"))
    files = table(spark, sf_dir, "documents").select(
        "doc_id", name.alias("path"), F.octet_length("text").alias("length"), F.encode("text", "UTF-8").alias("content")
    )
    blocks = manifest.artifact_blocks(files, files.select("path", F.lit(1).alias("rows")))
    return blocks.select(
        F.regexp_extract("path", r"^f(\d+)", 1).cast("bigint").alias("doc_id"), "artifacts.file_path", "artifacts.file_size_bytes",
        "artifacts.hashes.sha256", "artifacts.hashes.md5", "artifacts.file_format", "artifacts.compressed",
    )


# One run per (source, language). Some manifests expect another count or hash, some gates failed, some are unreadable.
VERIFIED_SQL = """
WITH r AS (SELECT source AS site, lang AS run_id, count(*) AS n, CAST(sum(n_chars) AS BIGINT) AS chars, max(n_chars) AS longest FROM documents GROUP BY ALL),
m AS (SELECT *, site LIKE '%7' AND run_id = 'es' AS unreadable, site LIKE '%3' AS bad_hash, n % 5 = 0 AS bad_rows, n > 25 AS bad_gate FROM r),
v AS (SELECT site, run_id, n, chars, unreadable, bad_gate,
  CASE WHEN unreadable THEN 'manifest is not readable' WHEN bad_hash THEN 'Hash mismatch' WHEN bad_rows THEN 'Row count mismatch' END AS verification_error,
  CASE WHEN unreadable THEN NULL WHEN bad_gate THEN 'fail_quality' ELSE 'pass' END AS gate_status FROM m),
o AS (SELECT *, CASE WHEN coalesce(gate_status, '') <> 'pass' THEN 'FAIL_QUALITY' WHEN verification_error IS NULL THEN 'SUCCESS' ELSE 'FAILED' END AS outcome FROM v),
x AS (SELECT *, CASE outcome WHEN 'FAIL_QUALITY' THEN CASE WHEN NOT unreadable THEN 'too blank' END WHEN 'FAILED' THEN verification_error END AS failure_reason FROM o)
"""


def run_documents(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(manifests, observed files) of the runs above."""
    runs = table(spark, sf_dir, "documents").groupBy("source", "lang").agg(F.count("*").alias("n"), F.sum("n_chars").alias("chars"))
    sha = F.sha2(F.col("chars").cast("string"), 256)
    bad_gate = F.col("n") > 25
    body = F.to_json(F.struct(
        F.concat_ws("/", "source", "lang").alias("run_id"),
        F.struct(F.when(bad_gate, "fail_quality").otherwise("pass").alias("status"), F.when(bad_gate, "too blank").otherwise("fine").alias("reason")).alias("quality_gate"),
        F.struct(
            F.lit("out/a/data.jsonl.gz").alias("file_path"), (F.col("n") + F.when(F.col("n") % 5 == 0, 1).otherwise(0)).alias("rows"),
            F.struct(F.when(F.col("source").endswith("3"), "other").otherwise(sha).alias("sha256")).alias("hashes"),
        ).alias("artifacts"),
    ))
    raw = F.when(F.col("source").endswith("7") & (F.col("lang") == "es"), F.substring(body, 1, 30)).otherwise(body)
    manifests = runs.select(urls.run_key(META, F.col("source"), F.lit("2024-01-01"), F.col("lang"), "manifest.json").alias("key"), raw.alias("raw"))
    observed = runs.select(
        F.col("source").alias("site"), F.lit("2024-01-01").alias("dt"), F.col("lang").alias("run_id"),
        F.lit("data.jsonl.gz").alias("file_name"), sha.alias("sha256"), F.col("n").alias("row_count"),
    )
    return manifests, observed


def verified(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifests, observed = run_documents(spark, sf_dir)
    return verify.verify(verify.manifest_facts(manifests, META), observed)


@query(VERIFIED_SQL + "SELECT site, '2024-01-01' AS dt, run_id, gate_status, verification_error, outcome, failure_reason FROM x")
def verify_manifests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcome of every run by hash, row count and gate."""
    return verified(spark, sf_dir).select("site", "dt", "run_id", "gate_status", "verification_error", "outcome", "failure_reason")


@query(VERIFIED_SQL + """
SELECT site, run_id, '_FAIL_QUALITY' AS marker FROM x WHERE coalesce(gate_status, '') <> 'pass'
UNION ALL SELECT site, run_id, '_FAILED' FROM x WHERE verification_error IS NOT NULL
UNION ALL SELECT site, run_id, '_SUCCESS' FROM x WHERE outcome = 'SUCCESS'
""")
def run_markers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.markers(verified(spark, sf_dir)).select("site", "run_id", "marker")


@query(VERIFIED_SQL + """
SELECT site, run_id, CASE outcome WHEN 'SUCCESS' THEN 'ok' ELSE 'error' END AS status,
  CASE WHEN outcome <> 'SUCCESS' THEN coalesce(verification_error, 'Quality gate status is not pass') END AS message FROM x
""")
def verification_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    return verify.verification_results(verified(spark, sf_dir)).select("site", "run_id", "status", "message")


@query(VERIFIED_SQL + """
SELECT CASE WHEN NOT unreadable THEN site || '/' || run_id END AS run_id, site, run_id AS run, CASE WHEN NOT unreadable THEN n + CASE WHEN n % 5 = 0 THEN 1 ELSE 0 END END AS row_count,
  gate_status, outcome, failure_reason, '2024-01-02T00:00:00Z' AS verified_at FROM x
""")
def silver_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Verified documents written as JSON text and read back into columns."""
    at = F.lit("2024-01-02 00:00:00").cast("timestamp_ntz")
    raw = verify.verified_documents(verified(spark, sf_dir), at)
    silver = models.verified_only(models.silver_manifest(raw.withColumn("dt", F.col("run"))))
    return silver.select(
        "run_id", "site", F.col("dt").alias("run"), "row_count", "gate_status", "outcome", "failure_reason", "verified_at"
    )


@query(VERIFIED_SQL + "SELECT CASE WHEN NOT unreadable THEN site || '/' || run_id END AS run_id, site, run_id AS run FROM x WHERE site NOT LIKE 'src1%'")
def backfill_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Wrappers of manifests that have no document yet."""
    manifests, observed = run_documents(spark, sf_dir)
    existing = observed.where(F.col("site").startswith("src1")).select("site", "dt", F.col("run_id").alias("run"))
    return verify.missing_documents(manifests, existing, META).select("run_id", "site", "run")


@query(VERIFIED_SQL + "SELECT DISTINCT site, '2024-01-01' AS dt FROM x WHERE site NOT LIKE 'src1%'")
def touched_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifests, observed = run_documents(spark, sf_dir)
    existing = observed.where(F.col("site").startswith("src1")).select("site", "dt", F.col("run_id").alias("run"))
    return verify.touched_partitions(verify.missing_documents(manifests, existing, META))


@query("""
WITH r AS (SELECT DISTINCT source AS site, lang AS run FROM documents)
SELECT site, run, CASE WHEN site LIKE '%5' THEN 'missing' ELSE 'pass' END AS status FROM r
""")
def quality_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Runs with their report text, and the runs that have none."""
    runs = table(spark, sf_dir, "documents").select(
        F.col("source").alias("site"), F.lit("2024-01-01").alias("dt"), F.col("lang").alias("run"), F.col("lang").alias("run_id")
    ).distinct()
    reports = runs.where(~F.col("site").endswith("5")).withColumn("raw", F.lit('{"status":"pass"}'))
    found = models.quality_documents(runs, reports).select("site", "run", F.get_json_object("raw_json", "$.status").alias("status"))
    return found.unionByName(models.runs_without_report(runs, reports).select("site", "run", F.lit("missing").alias("status")))
