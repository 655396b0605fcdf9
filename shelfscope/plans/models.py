"""Observability and serving models."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscope.functions.text import is_blank_text
from shelfscope.operators.keyed import latest_per_key

SITES_TYPE = (
    "map<string,struct<row_count:bigint,blank_rule_checked:boolean,blank_rule_skipped_reason:string,"
    "exceptions:array<string>,checked_fields:bigint,violations:array<struct<rule:string,field:string,"
    "blank_count:bigint,row_count:bigint,blank_ratio:double,threshold:double>>>>"
)


def json_column(raw: str, path: str, kind: str = "string") -> Column:
    """Scalar at a JSON path, NULL when missing or not of that type."""
    return F.get_json_object(F.col(raw), path).try_cast(kind)


def silver_manifest(raw: DataFrame) -> DataFrame:
    """Columns of the raw manifest table. Rows without a verification block have NULLs there."""
    return raw.select(
        "run_id", "site", "dt",
        json_column("raw_json", "$.crawler_name").alias("crawler_name"),
        json_column("raw_json", "$.exit_reason").alias("exit_reason"),
        json_column("raw_json", "$.start_time").alias("start_time"),
        json_column("raw_json", "$.finish_time").alias("finish_time"),
        json_column("raw_json", "$.duration_seconds", "double").alias("duration_seconds"),
        json_column("raw_json", "$.artifacts.rows", "bigint").alias("row_count"),
        json_column("raw_json", "$.stats.requests_made", "bigint").alias("requests_made"),
        json_column("raw_json", "$.stats.errors_count", "bigint").alias("errors_count"),
        json_column("raw_json", "$.quality_gate.status").alias("gate_status"),
        json_column("raw_json", "$.verification.outcome").alias("outcome"),
        json_column("raw_json", "$.verification.failure_reason").alias("failure_reason"),
        json_column("raw_json", "$.verification.verified_at").alias("verified_at"),
    )


def verified_only(silver: DataFrame) -> DataFrame:
    return silver.where("verified_at IS NOT NULL")


def quality_documents(manifests: DataFrame, reports: DataFrame) -> DataFrame:
    """Raw quality table: manifests (site, dt, run, run_id) with their report text; runs without one are skipped."""
    keys = ["site", "dt", "run"]
    text = reports.select(*keys, F.col("raw").alias("raw_json"))
    return manifests.select("run_id", *keys).join(text, keys).select("run_id", "raw_json", *keys)


def runs_without_report(manifests: DataFrame, reports: DataFrame) -> DataFrame:
    """The warnings that go with `quality_documents`."""
    keys = ["site", "dt", "run"]
    return manifests.select("run_id", *keys).join(reports.select(*keys), keys, "left_anti")


def silver_quality(raw: DataFrame) -> DataFrame:
    return raw.select(
        "run_id",
        json_column("raw_json", "$.status").alias("status"),
        json_column("raw_json", "$.event_time_utc").alias("event_time_utc"),
        json_column("raw_json", "$.reason").alias("reason"),
        json_column("raw_json", "$.total_rows", "bigint").alias("total_rows"),
        json_column("raw_json", "$.violations_count", "bigint").alias("violations_count"),
        json_column("raw_json", "$.blank_threshold", "double").alias("blank_threshold"),
        "raw_json", "site", "dt",
    )


def quality_violations(raw: DataFrame) -> DataFrame:
    """One row per violation and run, read back from the report text."""
    sites = F.from_json(F.get_json_object("raw_json", "$.sites"), SITES_TYPE)
    return (
        raw.select("run_id", F.explode(sites).alias("report_site", "report"))
        .select("run_id", "report_site", F.inline("report.violations"))
    )


def recrawl_candidates(
    observations: DataFrame, today: Column, stale_days: int = 7, keys: list[str] = ["site", "primary_key"]
) -> DataFrame:
    """Products to look at again: out of stock, on sale, or last seen too long ago (first reason counts).

    `observations`: keys, country, pdp_url, seen_at, out_of_stock, price_discount.
    """
    latest = latest_per_key(observations, keys, ["seen_at"], ["country", "pdp_url", "out_of_stock", "price_discount"])
    age = F.date_diff(today, F.to_date("seen_at"))
    reason = (
        F.when(F.col("out_of_stock"), "oos_recheck")
        .when(~is_blank_text(F.col("price_discount")), "sale_recheck")
        .when(age >= stale_days, "stale_fact")
    )
    return latest.withColumn("reason_code", reason).where("reason_code IS NOT NULL").select(
        *keys, "country", "pdp_url", "reason_code"
    )
