"""The steps after a crawl run, in their fixed order: sample, gate, compress, manifest, upload layout."""

from __future__ import annotations

import json
import os
from dataclasses import dataclass, field
from datetime import UTC, datetime

from py4j.protocol import Py4JJavaError
from pyspark.errors import PySparkException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope.operators import blanks, manifest
from shelfscope.sinks import tables as sinks
from shelfscope.sources import config, lines
from shelfscope.sources.file_facts import file_facts


@dataclass
class Run:
    run_id: str
    site: str
    exit_reason: str = "finished"
    start_time: str | None = None
    finish_time: str | None = None
    counters: dict[str, int] = field(default_factory=dict)
    arguments: dict[str, str] = field(default_factory=dict)

    @property
    def date(self) -> str:
        return self.run_id.split("T")[0]


def gate_report(
    spark: SparkSession, path: str, params: blanks.GateParams, exceptions_file: str | None = None
) -> DataFrame:
    """Report as one JSON text row; a gate that cannot run (bad line, missing file) reports an error."""
    try:
        exceptions = config.exception_rows(spark, exceptions_file=exceptions_file or None)
        records = lines.strict_records(lines.read_lines(spark, path))
        report = blanks.run_gate(records, exceptions, params).select(
            F.to_json(F.struct("*", F.lit(path).alias("input_jsonl_path")), {"ignoreNullFields": "false"}).alias("raw")
        )
        # The report is one row; running it here turns any failure into an error report.
        return spark.createDataFrame([(report.first()["raw"],)], "raw string")
    except (PySparkException, Py4JJavaError) as problem:
        text = json.dumps(blanks.error_report(str(problem).splitlines()[0], path, datetime.now(UTC).strftime("%Y-%m-%dT%H:%M:%SZ")), ensure_ascii=False)
        return spark.createDataFrame([(text,)], "raw string")


def close_run(
    spark: SparkSession, run: Run, records_path: str, root: str, params: blanks.GateParams | None = None,
    exceptions_file: str | None = None, env: str = "dev",
) -> dict[str, str]:
    """Runs the steps over the run's JSON lines and returns where each result lies.

    The record file is never held on the driver; only the one-row report passes through it.
    """
    params = params or blanks.GateParams()
    base = os.path.join(config.Environment(env, root).path("crawls"), "{}", run.site, run.date, run.run_id)
    out = {
        "sample": base.format("metadata") + "/sample",
        "report": base.format("metadata") + "/quality_report",
        "data": os.path.join(config.Environment(env, root).path("crawls"), run.site, run.date, run.run_id),
        "manifest": base.format("metadata") + "/manifest.json",
    }
    numbered = lines.read_numbered_lines(spark, records_path)
    manifest.sample_lines(numbered).select("value").write.mode("overwrite").text(out["sample"])
    report = gate_report(spark, records_path, params, exceptions_file)
    report.write.mode("overwrite").text(out["report"])
    sinks.write_lines(lines.read_lines(spark, records_path).select("value"), out["data"])
    sinks.write_document(spark, run_manifest(spark, run, out, report).first()["raw"], out["manifest"])
    return out


def run_manifest(spark: SparkSession, run: Run, out: dict[str, str], report: DataFrame) -> DataFrame:
    """The run's manifest text, one row: the totals of its data files and, if there are several, each of them."""
    files = file_facts(spark, out["data"], "*.gz")
    counters = F.from_json(F.lit(json.dumps(run.counters)), "map<string,bigint>")
    gate = report.select(
        F.get_json_object("raw", "$.status").alias("status"), F.get_json_object("raw", "$.reason").alias("reason"),
        F.get_json_object("raw", "$.violations_count").try_cast("bigint").alias("violations_count"),
        F.lit(out["report"]).alias("report_path"),
    )
    facts = manifest.run_artifacts(files, out["data"]).select(
        F.lit(run.run_id).alias("run_id"), F.lit(run.site).alias("crawler_name"),
        F.lit(run.exit_reason).alias("exit_reason"),
        F.from_json(F.lit(json.dumps(run.arguments)), "map<string,string>").alias("arguments"),
        F.lit(run.start_time).cast("timestamp").alias("start_time"),
        F.coalesce(F.lit(run.finish_time).cast("timestamp"), F.current_timestamp()).alias("finish_time"),
        manifest.manifest_stats(counters, F.col("artifacts.rows")).alias("stats"),
        "artifacts",
        gate.select(F.struct("*")).scalar().alias("gate"),
    )
    return manifest.manifest_documents(manifest.build_manifest(facts)).select("raw")
