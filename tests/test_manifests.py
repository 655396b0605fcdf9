"""Manifest verification, documents, backfill, models."""

import gzip
import hashlib
import json

from pyspark.sql import functions as F

from shelfscope import schemas
from shelfscope.operators import verify
from shelfscope.plans import models
from shelfscope.sinks import tables as sinks
from shelfscope.sources.tables import read_manifests
from shelfscope.streaming import streams

META, DATA = "bronze/dev/crawls/metadata/", "bronze/dev/crawls/"


def write_run(root, run, gate="pass", sha=None, rows=2, body=None, data=b'{"a":1}\n{"a":2}\n'):
    folder = root / DATA / "ounass" / "2026-03-03" / run
    meta = root / META / "ounass" / "2026-03-03" / run
    folder.mkdir(parents=True)
    meta.mkdir(parents=True)
    packed = gzip.compress(data)
    (folder / "ounass.jsonl.gz").write_bytes(packed)
    manifest = {
        "run_id": run, "artifacts": {"file_path": f"output/{run}/ounass.jsonl.gz", "rows": rows, "hashes": {"sha256": sha or hashlib.sha256(packed).hexdigest()}},
        "quality_gate": {"status": gate, "reason": f"reason {gate}"}, "verification": {"outcome": "old"},
    }
    (meta / "manifest.json").write_text(body if body is not None else json.dumps(manifest, indent=4))


CASES = {
    "ok": dict(want="SUCCESS", markers={"_SUCCESS"}),
    "gate": dict(gate="fail_quality", want="FAIL_QUALITY", markers={"_FAIL_QUALITY"}),
    "both": dict(gate="fail_quality", sha="0", want="FAIL_QUALITY", markers={"_FAIL_QUALITY", "_FAILED"}),
    "hash": dict(sha="0", want="FAILED", markers={"_FAILED"}),
    "rows": dict(rows=3, want="FAILED", markers={"_FAILED"}),
    "unreadable": dict(body="{oops", want="FAIL_QUALITY", markers={"_FAIL_QUALITY", "_FAILED"}),
    "blank-lines": dict(rows=3, data=b"{}\n\n{}", want="SUCCESS", markers={"_SUCCESS"}),
}


def make_runs(root):
    for run, case in CASES.items():
        write_run(root, run, **{k: v for k, v in case.items() if k not in ("want", "markers")})


def check(documents, markers):
    silver = {r["run"]: r for r in documents.select("run", models.json_column("raw_json", "$.verification.outcome").alias("outcome"),
                                                    models.json_column("raw_json", "$.verification.failure_reason").alias("why"), "run_id").collect()}
    assert {k: r["outcome"] for k, r in silver.items()} == {k: c["want"] for k, c in CASES.items()}
    assert silver["unreadable"]["why"] is None and silver["unreadable"]["run_id"] is None
    assert silver["gate"]["why"] == "reason fail_quality" and silver["rows"]["why"] == "Row count mismatch"
    got = {}
    for r in markers.collect():
        got.setdefault(r["run_id"], set()).add(r["marker"])
    assert got == {k: c["markers"] for k, c in CASES.items()}


def test_verification(spark, tmp_path):
    make_runs(tmp_path)
    found = read_manifests(spark, str(tmp_path / META))
    keyed = found.select(F.concat(F.lit(META), F.substring_index("path", "/" + META, -1)).alias("key"), "raw")
    observed = verify.observed_files(spark, str(tmp_path / DATA), DATA)
    assert observed.count() == len(CASES)
    verified = verify.verify(verify.manifest_facts(keyed, META), observed)
    check(verify.verified_documents(verified), verify.markers(verified))
    note = verify.markers(verified).where("run_id = 'unreadable' AND marker = '_FAIL_QUALITY'").first()["body"]
    assert json.loads(note)["quality_gate_status"] is None and json.loads(note)["manifest_key"].endswith("unreadable/manifest.json")
    assert verify.verification_results(verified).where("status = 'ok'").count() == 2


def test_manifest_and_marker_streams(spark, tmp_path):
    make_runs(tmp_path)
    paths = {n: str(tmp_path / n) for n in ("documents", "markers", "cp1", "cp2")}

    def run():
        streams.verify_manifests(spark, str(tmp_path), "dev", paths["documents"], paths["markers"], paths["cp1"]).awaitTermination()

    run()
    documents = spark.read.schema(schemas.RAW_DOCUMENT).json(paths["documents"])
    markers = spark.read.schema(schemas.RUN_MARKER).json(paths["markers"])
    check(documents, markers)
    write_run(tmp_path, "late")
    run()
    assert spark.read.schema(schemas.RUN_MARKER).json(paths["markers"]).where("run_id = 'late'").first()["marker"] == "_SUCCESS"
    sinks.create_table(spark, "crawl_manifest_raw_t", paths["documents"], "crawl_manifest_raw")
    for _ in range(2):
        streams.register_on_success(spark, paths["markers"], ["crawl_manifest_raw_t"], paths["cp2"]).awaitTermination()
    assert {r["run"] for r in spark.table("crawl_manifest_raw_t").collect()} == {"ok", "blank-lines", "late"}
    again = spark.createDataFrame([("ounass", "2026-03-03", "ok")], "site string, dt string, run string")
    sinks.register_partitions(spark, "crawl_manifest_raw_t", again)
    assert spark.sql("SHOW PARTITIONS crawl_manifest_raw_t").count() == 3


def test_backfill_is_idempotent(spark, tmp_path):
    make_runs(tmp_path)
    found = read_manifests(spark, str(tmp_path / META)).select(F.concat(F.lit(META), F.substring_index("path", "/" + META, -1)).alias("key"), "raw")
    target = str(tmp_path / "docs")
    existing = spark.createDataFrame([("ounass", "2026-03-03", "ok")], "site string, dt string, run string")
    missing = verify.missing_documents(found, existing, META)
    assert missing.count() == len(CASES) - 1
    sinks.append_records(missing, target, ["site", "dt", "run"])
    written = spark.read.schema(schemas.RAW_DOCUMENT).json(target)
    left = verify.missing_documents(found, written.unionByName(existing.select(F.lit(None).alias("run_id"), F.lit(None).alias("raw_json"), "site", "dt", "run")), META)
    assert left.count() == 0
    silver = models.silver_manifest(written)
    assert models.verified_only(silver).count() == 0 and silver.where("row_count IS NOT NULL").count() == len(CASES) - 2


def test_event_routes(spark):
    events = spark.createDataFrame([("m/a+b/manifest.json",), ("x/_SUCCESS",), ("x/_FAILED",)], "key string")
    assert [r[0] for r in events.select(verify.route_event(F.col("key"))).collect()] == ["verify_manifest", "register_partition", "ignored"]
    routed = streams.route_marker_events(events.select(F.concat(F.lit("p/"), "key").alias("key")), "p/")
    assert [r["status"] for r in routed.collect()] == ["ignored", "error", "ignored"]
