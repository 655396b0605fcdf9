"""Times the headline queries and prints one JSON line.

Each query is built and run `BENCH_REPEATS` times after one warm-up run; the result is forced
with a `noop` write, the median counts. The given tables are single row groups, which no scan can split, so they are
first laid out as one file per core, untimed; the queries themselves never spread a scan.
"""

from __future__ import annotations

import json
import os
import statistics
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from shelfscope.checks import QUERIES  # noqa: E402
from shelfscope.session import build_session  # noqa: E402

HEADLINE = [
    "pending_work", "latest_status", "serving_status", "job_dedupe", "build_jobs", "job_plan", "job_counters", "job_outcomes",
    "status_histogram", "blank_profile", "column_profile", "blank_violations", "quality_verdict", "run_manifest",
    "verify_manifests", "content_addressed", "shared_content", "image_checks", "backoff_replay", "recrawl_candidates",
    "page_links", "html_title_text", "page_plain_text", "dom_products", "state_products", "api_products", "storage_keys",
    "stock_status", "frontier", "page_fanout",
]


def laid_out(spark, sf_dir: str, files: int) -> str:
    """The tables of `sf_dir` again, each as a folder of `files` files."""
    out = os.path.join(tempfile.mkdtemp(prefix="bench-"), os.path.basename(sf_dir.rstrip("/")))
    for name in os.listdir(sf_dir):
        if name.endswith(".parquet"):
            spark.read.parquet(os.path.join(sf_dir, name)).repartition(files).write.parquet(os.path.join(out, name))
    return out


def main() -> None:
    cpus = os.environ.get("BENCH_CPUS", "8")
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
    repeats = int(os.environ.get("BENCH_REPEATS", "1"))
    spark = build_session(
        f"local[{cpus}]", "bench", **{
            "spark.sql.shuffle.partitions": cpus, "spark.driver.memory": "8g", "spark.ui.showConsoleProgress": "false",
        }
    )
    spark.sparkContext.setLogLevel("ERROR")
    given, sf_dir = sf_dir, laid_out(spark, sf_dir, int(cpus))
    times = {}
    for name in HEADLINE:
        runs = []
        for turn in range(repeats + 1):
            start = time.perf_counter()
            QUERIES[name](spark, sf_dir).write.format("noop").mode("overwrite").save()
            if turn:
                runs.append(time.perf_counter() - start)
        times[name] = round(statistics.median(runs), 3)
    print(json.dumps({
        "metric": "headline_queries_total", "value": round(sum(times.values()), 3), "unit": "sec", "queries": times,
        "sf": float(os.path.basename(given.rstrip("/")).removeprefix("sf") or 0),
    }))
    spark.stop()


if __name__ == "__main__":
    main()
