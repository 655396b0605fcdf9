"""Lines, job building, planning, outcomes."""

import gzip
import json

import pytest
from pyspark.errors import PySparkException
from pyspark.sql import functions as F

from shelfscope import schemas
from shelfscope.operators import jobs, keyed, outcomes, pending
from shelfscope.sources import config, lines, seeds, tables

SMOKE = [
    {"site": "level-shoes", "primary_key": "A_level-shoes", "image_urls": "https://i.example/a.jpg?ts=1", "run_id": "r"},
    {"site": "level_shoes", "primary_key": "A_level-shoes", "image_urls": "https://i.example/a.jpg?ts=1", "run_id": "r"},
    {"site": "level_shoess", "primary_key": "B", "image_urls": "https://i.example/b.jpg"},
    {"site": "farfetch", "primary_key": "C", "image_url": "https://dead.example/c.jpg"},
    {"site": "farfetch", "primary_key": "D", "image_url": "https://i.example/page"},
    {"site": "level-shoes", "image_urls": "https://i.example/e.jpg"},
    {"site": "ounass", "primary_key": "F/1", "image_urls": "i.example/f.jpg"},
    {"site": "ounass", "primary_key": "G", "image_urls": ["i.example/g.jpg"]},
]


@pytest.fixture
def job_file(tmp_path):
    path = tmp_path / "jobs.jsonl"
    body = [json.dumps(r) for r in SMOKE]
    path.write_text("\n".join([*body[:3], "", "{bad", *body[3:]]) + "\n")
    return str(path)


def test_line_numbers_count_blank_lines(spark, job_file, tmp_path):
    numbered = {r["line_no"]: r["value"] for r in lines.read_numbered_lines(spark, job_file).collect()}
    assert sorted(numbered) == list(range(1, 11)) and numbered[4] == "" and numbered[5] == "{bad"


def test_line_numbers_of_a_file_read_in_many_splits(spark, tmp_path):
    path = tmp_path / "big.txt"
    path.write_text("".join(f"line {i}\n" for i in range(1, 20001)))
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    try:
        assert spark.read.text(str(path)).rdd.getNumPartitions() > 4
        wrong = lines.read_numbered_lines(spark, str(path)).where(F.col("value") != F.concat(F.lit("line "), F.col("line_no").cast("string")))
        assert wrong.count() == 0
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_strict_reading_fails_on_bad_lines(spark, tmp_path):
    good, bad, shape = tmp_path / "g", tmp_path / "b", tmp_path / "s"
    good.write_text('{"a": 1}\n\n{"b": []}\n')
    bad.write_text('{"a": 1}\n{oops\n')
    shape.write_text("[1]\n")
    assert lines.strict_records(lines.read_lines(spark, str(good))).count() == 2
    for path in (bad, shape):
        with pytest.raises(PySparkException):
            lines.strict_records(lines.read_numbered_lines(spark, str(path))).collect()


def test_smoke_scenarios(spark, job_file):
    numbered = lines.read_numbered_lines(spark, job_file)
    read = jobs.read_job_lines(numbered)
    skips = {r["line_no"]: (r["reason"], r["missing_fields"]) for r in read.where("status IS NOT NULL").collect()}
    assert skips == {5: ("invalid_json", None), 8: ("missing_required_fields", ["primary_key"])}
    planned = jobs.plan_jobs(read.where("status IS NULL").drop("status", "reason"), ["file", "line_no"])
    responses = spark.createDataFrame([
        ("https://i.example/a.jpg?ts=1", 200, "image/webp", b"AA", None, None),
        ("https://i.example/page", 200, "text/html", b"<html>", None, None),
        ("https://i.example/f.jpg", 200, None, b"AA", None, None),
    ], schemas.IMAGE_RESPONSE)
    results = outcomes.job_outcomes(planned, responses, "run-9", blob_prefix="images/by-hash")
    got = {(r["job"]["primary_key"], r["reason"]): r for r in results.collect()}
    assert sorted(k[1] for k in got if k[0] is None) == ["invalid_job_input"]
    assert results.where("reason = 'invalid_job_input'").count() == 2
    ok = got[("A_level-shoes", "downloaded")]
    assert ok["storage"]["canonical_blob_key"].startswith("images/by-hash/") and ok["storage"]["canonical_blob_key"].endswith(".webp")
    assert got[("A_level-shoes", "duplicate_job")]["status"] == "skipped_duplicate"
    assert got[("C", "request_failed")]["error"]["message"] == "no stored response"
    assert got[("D", "non_image_content_type")]["error"]["message"] == "Expected image content type, got text/html"
    f = got[("F/1", "downloaded")]
    assert f["request"]["normalized_image_url"] == "https://i.example/f.jpg" and "/F_1_" in f["storage"]["output_path"]
    logged = outcomes.log_rows(outcomes.loggable(results), "2024-01-01", "run-9")
    assert logged.count() == results.count() - 1
    assert outcomes.run_marker(logged).first()["marker"] == "_FAILED"
    assert outcomes.skip_results(read, "run-9").count() == 2
    histogram = outcomes.status_histogram(results)
    assert outcomes.summary_line(histogram).first()["summary"] == "error=2, ok=2, skipped_duplicate=1, skipped_invalid=2"


def test_build_jobs_from_gzip(spark, tmp_path):
    rows = [
        {"site": " s ", "unique_id": "u", "image_url": "a"}, {"site": "s", "unique_id": "u", "image_url": ["a", " b ", ""]},
        {"site": "s", "portal_itemid": "i", "image_urls": "a"}, {"site": "s", "image_url": "a"}, {"unique_id": "u", "image_url": "a"},
        {"site": "s", "unique_id": "u", "image_url": {"x": 1}},
    ]
    path = tmp_path / "in.jsonl.gz"
    with gzip.open(path, "wt") as f:
        f.write("\n".join([*map(json.dumps, rows), "", "[1]", "nope"]) + "\n")
    built = jobs.build_jobs(lines.read_numbered_lines(spark, str(path)))
    counts = {r["outcome"]: r["n"] for r in jobs.job_counters(built).collect()}
    assert counts == {
        "rows_total": 9, "jobs_written": 3, "skipped_duplicate_job": 1, "skipped_missing_primary_key": 1, "skipped_missing_site": 1,
        "skipped_missing_image_url": 1, "skipped_empty_line": 1, "skipped_invalid_shape": 1, "skipped_invalid_json": 1,
    }
    job = jobs.jobs_of(built).where("primary_key = 'i_s'").first()
    assert (job["site"], job["image_url"], job["input_source"]["line_no"]) == ("s", "a", 3)
    loose = jobs.build_jobs(lines.read_numbered_lines(spark, str(path)), site_override="o", dedupe=False)
    assert loose.where("outcome = 'jobs_written'").count() == 5 and loose.where("site = 'o'").count() == 7


def test_first_wins_with_a_hot_key(spark):
    rows = spark.range(5000).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.col("id").cast("string")).alias("k"), F.col("id").alias("pos"))
    marked = keyed.first_wins(rows, ["k"], ["pos"])
    assert marked.count() == 5000
    assert marked.where("is_first AND k = 'hot'").select("pos").collect()[0][0] == 0
    assert marked.where("is_first").count() == rows.select("k").distinct().count()


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_spread_join_equals_plain_join(spark, how):
    rows = spark.range(3000).select(F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 50).alias("k"), "id")
    rows = rows.unionByName(spark.sql("SELECT CAST(NULL AS BIGINT) AS k, 9999L AS id"))
    lookup = spark.range(0, 50, 2).select(F.col("id").alias("k"), (F.col("id") * 10).alias("v"))
    got = keyed.join_spread(rows, lookup, ["k"], ["id"], how, hot_rows=100)
    want = rows.join(lookup, ["k"], how)
    assert got.columns == want.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, want.collect()))


def test_pending_rules(spark):
    catalogue = spark.createDataFrame(
        [("s", "a", "u1", "2024-01-02"), ("s", "b", "u", "2024-01-02"), ("s", "c", "u", "2024-01-02"), ("s", "d", "u", "2024-01-02"),
         ("s", "old", "u", "2024-01-01"), ("", "x", "u", "2024-01-02")], "site string, primary_key string, url string, dt string")
    log = spark.createDataFrame(
        [("s", "a", "u2", "r1", "ok"), ("s", "b", "u", "r2", "error"), ("s", "b", "u", "r1", "ok"), ("s", "c", "u", "r1", "skipped_invalid"),
         ("s", "d", "u", "r1", "error"), ("s", "d", "u", "r2", "ok")],
        "site string, primary_key string, url string, run_id string, status string")
    found = pending.pending_work(catalogue, log)
    assert {r["primary_key"] for r in found.collect()} == {"a", "b", "x"}
    assert {r["primary_key"] for r in pending.usable_rows(found).collect()} == {"a", "b"}
    assert [r["primary_key"] for r in pending.pending_work(catalogue, log, limit=2).collect()] == ["x", "a"]


def test_seeds(spark, tmp_path):
    path = tmp_path / "seeds.csv"
    path.write_text("﻿url,label\nhttps://example.com/a,A\n\n https://example.com/b ,B\n")
    assert [r.url for r in seeds.read_seed_csv(spark, str(path)).collect()] == ["https://example.com/a", "https://example.com/b"]
    assert [r.url for r in seeds.seed_urls(spark, "a,b").collect()] == ["a", "b"]
    assert [r.url for r in seeds.seed_urls(spark, ["c"], str(path)).collect()] == ["c"]
    assert seeds.seed_urls(spark, None, str(path)).count() == 3
    assert seeds.seed_urls(spark).count() == 0
    with pytest.raises(ValueError):
        seeds.read_seed_csv(spark, "s3://bucket")


def test_small_sources(spark, tmp_path):
    assert tables.single_job(spark, "s", "p", "u").first()["primary_key"] == "p"
    with pytest.raises(ValueError):
        tables.single_job(spark, "s", "", "u")
    (tmp_path / "q.csv").write_text("a,b\n1,\n")
    assert tuple(tables.read_query_csv(spark, str(tmp_path / "q.csv")).first()) == ("1", None)
    env = config.Environment("dev", "s3://bucket/base")
    assert (env.bronze, env.key_prefix) == ("s3://bucket/base/bronze/dev/", "base/bronze/dev/")
    with pytest.raises(ValueError):
        config.Environment("test", "/x")
