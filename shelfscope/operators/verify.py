"""Verification of run manifests against the stored data files."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope import fixed_values as fv
from shelfscope.functions import jsons, text, urls
from shelfscope.session import allow_duplicate_json_keys
from shelfscope.sources.file_facts import file_facts

RUN = ["site", "dt", "run_id"]
EXPECTED_FILE = "struct<file_path string, rows bigint, hashes struct<sha256 string>>"
EXPECTED_FILES = f"array<{EXPECTED_FILE}>"


def manifest_facts(manifests: DataFrame, prefix: str) -> DataFrame:
    """(key, raw) -> run columns of the key plus what verification needs from the document.

    Keys outside '<prefix>site/dt/run/' are dropped; unreadable documents keep their row with NULLs.
    """
    allow_duplicate_json_keys(manifests.sparkSession)
    doc = F.col("doc")
    return (
        manifests.withColumn("run", urls.parse_run_key(F.col("key"), prefix))
        .where("run IS NOT NULL")
        .select("key", F.col("run.*"), jsons.parse_whole(text.strip(F.col("raw"))).alias("doc"))
        .select(
            "key", *RUN, "doc",
            jsons.path_text(doc, "$.run_id").alias("doc_run_id"),
            jsons.path_text(doc, "$.quality_gate.status").alias("gate_status"),
            jsons.path_text(doc, "$.quality_gate.reason").alias("gate_reason"),
            F.coalesce(
                F.try_variant_get(doc, "$.artifacts.files", EXPECTED_FILES),
                F.array(F.try_variant_get(doc, "$.artifacts", EXPECTED_FILE)),
            ).alias("expected_files"),
        )
    )


def observed_files(spark: SparkSession, path: str | list[str], prefix: str, name_filter: str = "*.gz") -> DataFrame:
    """(site, dt, run_id, file_name, sha256, row_count, problem) of stored data files.

    Hash and count come from one reading in blocks, so no two readings of a path have to be matched and a file may have any size.
    Lines are counted over the decompressed bytes, blank ones included. A file that is no gzip, is cut or damaged has no count but a problem.
    Folders that do not exist hold nothing.
    """
    found = file_facts(spark, path, name_filter, skip_missing=True)
    # The key is what follows the storage root: cut at the prefix wherever it starts.
    key = F.concat(F.lit(prefix), F.substring_index("path", "/" + prefix, -1))
    return (
        found.select(
            urls.parse_run_key(key, prefix).alias("run"), urls.last_segment(F.col("path")).alias("file_name"),
            "sha256", F.col("lines").alias("row_count"), "problem",
        )
        .where("run IS NOT NULL").select("run.*", "file_name", "sha256", "row_count", "problem")
    )


def verify(facts: DataFrame, observed: DataFrame) -> DataFrame:
    """One row per manifest: outcome, failure reason, both checks.

    SUCCESS needs matching hash, matching row count and a passed gate. Otherwise a gate that did
    not pass decides the outcome (its reason may be NULL), else the check error does. A manifest may list
    several files; the first bad one by name gives the error.
    """
    if "problem" not in observed.columns:
        observed = observed.withColumn("problem", F.lit(None).cast("string"))
    files = facts.select("key", *RUN, F.explode("expected_files").alias("x")).select(
        "key", *RUN, urls.last_segment(F.col("x.file_path")).alias("file_name"),
        F.col("x.hashes.sha256").alias("expected_sha256"), F.col("x.rows").alias("expected_rows"),
    )
    found = files.join(observed, [*RUN, "file_name"], "left")
    file_error = (
        F.when(F.coalesce(F.col("file_name"), F.lit("")) == "", "manifest names no data file")
        .when(F.col("sha256").isNull(), "data file not found")
        .when(~F.col("sha256").eqNullSafe(F.col("expected_sha256")), "Hash mismatch")
        .when(F.col("problem").isNotNull(), F.concat(F.lit("data file is damaged: "), F.col("problem")))
        .when(~F.col("row_count").eqNullSafe(F.col("expected_rows")), "Row count mismatch")
    )
    errors = (
        found.withColumn("e", file_error).groupBy("key", *RUN)
        .agg(F.count("*").alias("n_files"), F.min_by("e", F.when(F.col("e").isNotNull(), F.coalesce("file_name", F.lit("")))).alias("file_error"))
    )
    error = (
        F.when(F.col("doc").isNull(), "manifest is not readable")
        .when(F.col("n_files").isNull(), "manifest names no data file").otherwise(F.col("file_error"))
    )
    gate_ok = F.col("gate_status").eqNullSafe(fv.GATE_PASS)
    return (
        facts.join(errors, ["key", *RUN], "left").withColumn("verification_error", error).drop("n_files", "file_error")
        .withColumn("verification_ok", F.col("verification_error").isNull())
        .withColumn("gate_ok", gate_ok)
        .withColumn("outcome", outcome_of(F.col("verification_ok"), F.col("gate_ok")))
        .withColumn(
            "failure_reason",
            F.when(F.col("outcome") == "FAIL_QUALITY", F.col("gate_reason"))
            .when(F.col("outcome") == "FAILED", F.col("verification_error")),
        )
    )


def outcome_of(checks_ok: Column, gate_ok: Column) -> Column:
    return F.when(checks_ok & gate_ok, "SUCCESS").when(~gate_ok, "FAIL_QUALITY").otherwise("FAILED")


def markers(verified: DataFrame) -> DataFrame:
    """Run markers. A failed gate and a failed check are independent: both may be set."""
    gate_note = F.to_json(F.struct(
        F.col("gate_status").alias("quality_gate_status"), F.col("gate_reason").alias("quality_gate_reason"),
        F.col("key").alias("manifest_key"),
    ), {"ignoreNullFields": "false"})

    def marker(condition: Column, name: str, body: Column) -> Column:
        return F.when(condition, F.struct(F.lit(name).alias("marker"), body.alias("body")))

    found = F.array_compact(F.array(
        marker(~F.col("gate_ok"), fv.MARKER_FAIL_QUALITY, gate_note),
        marker(~F.col("verification_ok"), fv.MARKER_FAILED, F.lit("")),
        marker(F.col("gate_ok") & F.col("verification_ok"), fv.MARKER_SUCCESS, F.lit("")),
    ))
    return verified.select(*RUN, F.inline(found))


def verified_documents(verified: DataFrame, verified_at: Column | None = None) -> DataFrame:
    """(run_id, raw_json, site, dt, run): the manifest with its verification block as JSON text.

    The block replaces one already in the document. An unreadable document counts as empty.
    """
    at = text.utc_iso(verified_at if verified_at is not None else F.current_timestamp())
    block = F.to_variant_object(F.struct(at.alias("verified_at"), "outcome", "failure_reason"))
    fields = F.coalesce(jsons.as_object(F.col("doc")), F.create_map().cast(jsons.ANY_OBJECT))
    merged = F.map_concat(
        F.map_filter(fields, lambda k, v: k != "verification"), F.create_map(F.lit("verification"), block)
    )
    return verified.select(
        F.col("doc_run_id").alias("run_id"), F.to_json(merged).alias("raw_json"),
        "site", "dt", F.col("run_id").alias("run"),
    )


def verification_results(verified: DataFrame) -> DataFrame:
    """Status row per manifest, as an event handler would answer."""
    ok = F.col("outcome") == "SUCCESS"
    return verified.select(
        "key", *RUN, F.when(ok, "ok").otherwise("error").alias("status"),
        F.lit("verify_manifest").alias("action"),
        F.when(~ok, F.coalesce("verification_error", F.lit("Quality gate status is not pass"))).alias("message"),
    )


def missing_documents(manifests: DataFrame, existing: DataFrame, prefix: str) -> DataFrame:
    """Backfill: wrappers of manifests whose (site, dt, run) has no document yet, raw text kept."""
    allow_duplicate_json_keys(manifests.sparkSession)
    found = manifests.withColumn("key_run", urls.parse_run_key(F.col("key"), prefix)).where("key_run IS NOT NULL").select(
        jsons.path_text(jsons.parse_whole(text.strip(F.col("raw"))), "$.run_id").alias("run_id"),
        F.col("raw").alias("raw_json"), "key_run.site", "key_run.dt", F.col("key_run.run_id").alias("run"),
    )
    keys = ["site", "dt", "run"]
    return found.join(existing.select(*keys).distinct(), keys, "left_anti")


def touched_partitions(documents: DataFrame) -> DataFrame:
    return documents.select("site", "dt").distinct()


def route_event(key: Column) -> Column:
    """What an object-created event asks for."""
    return F.when(key.endswith("manifest.json"), "verify_manifest").when(
        key.endswith(fv.MARKER_SUCCESS), "register_partition"
    ).otherwise("ignored")
