"""A crawl run from its records to its registered partition, over real files, and steps that are repeated."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfscope.checks.images import part_images
from shelfscope.checks.registry import query, table
from shelfscope.functions import markup, urls
from shelfscope.operators import jobs, outcomes, products, verify
from shelfscope.plans import post_run
from shelfscope.session import scratch_path
from shelfscope.sinks import tables as sinks
from shelfscope.sources import tables
from shelfscope.streaming import streams

SITE, DAY = "shop", "2024-03-01"
META, DATA = "bronze/dev/crawls/metadata/", "bronze/dev/crawls/"
#: What each run of the chain is for. Names with a blank and a percent sign are names like any other.
RUNS = ["2024-03-01T a%20b", "2024-03-01T-cut", "2024-03-01T-plain", "2024-03-01T-blank"]


def cut_file(spark: SparkSession, path: str, drop: int, to: str | None = None) -> None:
    """Copies a file without its last bytes over itself or to another name."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path
    conf = spark._jsc.hadoopConfiguration()
    source, spare = fs_path(path), fs_path(path + ".part")
    fs = source.getFileSystem(conf)
    size = fs.getFileStatus(source).getLen()
    reading, writing = fs.open(source), fs.create(spare, True)
    spark._jvm.org.apache.commons.io.IOUtils.copyLarge(reading, writing, 0, size - drop)
    reading.close()
    writing.close()
    target = fs_path(to or path)
    fs.delete(target, False)
    fs.rename(spare, target)


@query(f"""
WITH r AS (SELECT doc_id % 4 AS i, count(*) AS n, count(*) FILTER (WHERE doc_id % 4 <> 3) AS filled FROM documents GROUP BY 1)
SELECT ['{RUNS[0]}', '{RUNS[1]}', '{RUNS[2]}', '{RUNS[3]}'][i + 1] AS run,
  CASE i WHEN 1 THEN 'FAILED' WHEN 3 THEN 'FAIL_QUALITY' ELSE 'SUCCESS' END AS outcome,
  CASE i WHEN 1 THEN 'Hash mismatch' WHEN 3 THEN 'blank_field_threshold_breach' END AS failure_reason,
  n AS expected_rows, i IN (0, 2) AS registered FROM r
""")
def run_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four runs closed, verified by the manifest stream and registered by the marker stream; one file is cut in between."""
    root = scratch_path(spark, "chain")
    docs = table(spark, sf_dir, "documents")
    for i, run_id in enumerate(RUNS):
        label = F.when(F.col("doc_id") % 4 != 3, F.col("lang"))
        records = docs.where(F.col("doc_id") % 4 == i).select(
            F.lit(SITE).alias("site"), F.col("doc_id").cast("string").alias("primary_key"), label.alias("label"))
        records.write.option("ignoreNullFields", "false").json(f"{root}/in/{i}")
        out = post_run.close_run(spark, post_run.Run(run_id, SITE), f"{root}/in/{i}", root)
        if i == 1:
            cut_file(spark, tables.read_blobs(spark, out["data"], "*.gz").select(F.min("path")).first()[0], 6)
    documents, markers = f"{root}/documents", f"{root}/markers"
    streams.verify_manifests(spark, root, "dev", documents, markers, f"{root}/c1").awaitTermination()
    name = "chain_" + os.path.basename(root).rsplit("-", 1)[-1]
    sinks.create_table(spark, name, documents, "crawl_manifest_raw")
    streams.register_on_success(spark, markers, [name], f"{root}/c2").awaitTermination()
    found = spark.read.schema("run_id string, raw_json string, site string, dt string, run string").json(documents)
    part = F.split("partition", "/run=")
    registered = spark.sql(f"SHOW PARTITIONS {name}").select(F.regexp_replace(F.get(part, 1), "[^A-Za-z0-9]", "").alias("key"), F.lit(True).alias("r"))
    return found.select(
        "run", F.get_json_object("raw_json", "$.verification.outcome").alias("outcome"),
        F.get_json_object("raw_json", "$.verification.failure_reason").alias("failure_reason"),
        F.get_json_object("raw_json", "$.artifacts.rows").cast("bigint").alias("expected_rows"),
        # SHOW PARTITIONS escapes some characters, so names are compared by their letters and digits
        F.regexp_replace(F.regexp_replace(F.regexp_replace("run", "%", "%25"), " ", ""), "[^A-Za-z0-9]", "").alias("key"),
    ).join(registered, "key", "left").select("run", "outcome", "failure_reason", "expected_rows", F.coalesce("r", F.lit(False)).alias("registered"))


@query("""
WITH c AS (SELECT unnest(['good', 'cut', 'plain', 'other count', 'other hash', 'lost']) AS c)
SELECT c AS run, CASE c WHEN 'good' THEN 'SUCCESS' ELSE 'FAILED' END AS outcome,
  CASE c WHEN 'cut' THEN 'data file is damaged' WHEN 'plain' THEN 'data file is damaged' WHEN 'other count' THEN 'Row count mismatch'
    WHEN 'other hash' THEN 'Hash mismatch' WHEN 'lost' THEN 'data file not found' END AS reason,
  CASE WHEN c NOT IN ('cut', 'plain', 'lost') THEN (SELECT count(*) FROM documents) END AS rows_found FROM c
""")
def damaged_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files whose manifests carry the hash of what is stored, so that only reading them to the end shows the damage."""
    root = scratch_path(spark, "files")
    lines = table(spark, sf_dir, "documents").select(F.col("doc_id").cast("string"))
    cases = ["good", "cut", "plain", "other count", "other hash", "lost"]
    for case in cases[:-1]:
        folder = f"{root}/{DATA}{SITE}/{DAY}/{case}"
        sinks.write_lines(lines, folder)
        if case == "cut":
            cut_file(spark, tables.read_blobs(spark, folder, "*.gz").select(F.min("path")).first()[0], 6)
        if case == "plain":
            lines.where("doc_id < '5'").write.mode("append").text(folder)
            text = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt").load(folder).select(F.min("path")).first()[0]
            cut_file(spark, text, 0, text + ".gz")
    seen = verify.observed_files(spark, f"{root}/{DATA}", DATA)
    # a run has as many files as its writing had tasks; one of them is listed with another count or hash
    one = F.row_number().over(Window.partitionBy("run_id").orderBy("file_name")) == 1
    parts = seen.withColumn("one", one).select("run_id", F.struct(
        F.col("file_name").alias("file_path"),
        F.when((F.col("run_id") == "other count") & F.col("one"), F.col("row_count") + 1).otherwise(F.col("row_count")).alias("rows"),
        F.struct(F.when((F.col("run_id") == "other hash") & F.col("one"), "0").otherwise(F.col("sha256")).alias("sha256")).alias("hashes"),
    ).alias("part"))
    expected = parts.groupBy("run_id").agg(F.collect_list("part").alias("files")).select("run_id", F.struct(
        F.struct("files").alias("artifacts"), F.struct(F.lit("pass").alias("status")).alias("quality_gate")).alias("doc"))
    lost = spark.createDataFrame([("lost", '{"artifacts":{"file_path":"x.gz","rows":1},"quality_gate":{"status":"pass"}}')], "run_id string, raw string")
    manifests = expected.select("run_id", F.to_json("doc").alias("raw")).union(lost).select(
        urls.run_key(META, F.lit(SITE), F.lit(DAY), F.col("run_id"), "manifest.json").alias("key"), "raw")
    verified = verify.verify(verify.manifest_facts(manifests, META), seen)
    counts = seen.groupBy(F.col("run_id").alias("run")).agg(
        F.when(F.count("problem") == 0, F.sum("row_count")).alias("rows_found"))
    return verified.select(
        F.col("run_id").alias("run"), "outcome", F.split_part("verification_error", F.lit(":"), F.lit(1)).alias("reason")
    ).join(counts, "run", "left")


@query("""
SELECT p_partkey AS item, CASE WHEN p_size % 6 < 5 THEN 'bags' END AS category, CASE WHEN p_size % 6 < 5 THEN 'mini-' || p_size END AS subcategory FROM part
""")
def nested_crumbs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Breadcrumbs one to five containers deep, lists and @graph in turn; every sixth page has none."""
    trail = F.concat(
        F.lit('{"@type":"BreadcrumbList","itemListElement":[{"item":"https://x.example/women/bags/mini-'), F.col("p_size").cast("string"), F.lit('"}]}')
    )
    depth = F.col("p_size") % 6
    body = F.aggregate(
        F.sequence(F.lit(0), depth), trail,
        lambda inner, i: F.when(i % 2 == 0, F.concat(F.lit('{"@graph":['), inner, F.lit("]}"))).otherwise(F.concat(F.lit("["), inner, F.lit(',{"@type":"Thing"}]'))),
    )
    html = F.concat(F.lit('<script type="application/ld+json">'), F.when(depth < 5, body).otherwise(F.lit("{}")), F.lit("</script>"))
    pages = table(spark, sf_dir, "part").select("p_partkey", markup.of_type(markup.ld_nodes(markup.ld_json_blocks(html)), "BreadcrumbList").alias("trails"))
    pair = products.category_pair(F.col("trails"))
    return pages.select(F.col("p_partkey").alias("item"), pair["category"].alias("category"), pair["subcategory"].alias("subcategory"))


@query("SELECT count(DISTINCT p_partkey) AS n_keys, count(*) AS n_rows FROM part WHERE p_brand NOT LIKE '%3'")
def stored_twice(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Contents stored by the same run twice: as many rows as keys."""
    path = scratch_path(spark, "store")
    blobs = part_images(spark, sf_dir)[1].select("blob_key", F.concat(F.encode("blob_key", "UTF-8"), F.col("content")).alias("content"))
    for _ in range(2):
        sinks.store_contents(blobs, "blob_key", None, path, "by-hash/", ".png", run="run-1")
    return spark.read.parquet(path).agg(F.count_distinct("blob_key").alias("n_keys"), F.count("*").alias("n_rows"))


@query("""
SELECT CAST(page_id AS VARCHAR) AS primary_key, 'ok' AS status, 'downloaded' AS reason, sha256('new' || page_id) AS content_sha256, CAST(NULL AS BIGINT) AS line_no FROM pages
UNION ALL SELECT NULL, 'skipped_invalid', 'invalid_job_input', NULL, page_id FROM pages WHERE page_id % 10 = 0
""")
def results_of_repeated_responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two responses per URL give one outcome, the later one; rejected lines are part of the same result table."""
    pages = table(spark, sf_dir, "pages").select("page_id")
    url = F.concat(F.lit("https://img.example/"), F.col("page_id").cast("string"), F.lit(".png"))
    wanted = pages.select(
        F.lit("level").alias("site"), F.col("page_id").cast("string").alias("primary_key"), url.alias("image_url"), F.lit("r").alias("source_run_id"), "page_id")
    times = pages.select("page_id", F.explode(F.array(
        F.struct(F.lit("old").alias("body"), F.lit("2024-01-01 00:00:00").alias("at")), F.struct(F.lit("new").alias("body"), F.lit("2024-01-02 00:00:00").alias("at"))
    )).alias("t")).select("page_id", "t.*")
    responses = times.select(
        url.alias("url"), F.lit(200).alias("http_status"), F.lit("image/png").alias("content_type"),
        F.encode(F.concat("body", F.col("page_id").cast("string")), "UTF-8").alias("content"), F.lit(None).cast("string").alias("error_type"),
        F.lit(None).cast("string").alias("error_message"), F.col("at").cast("timestamp").alias("fetched_at"))
    done = outcomes.job_outcomes(jobs.plan_jobs(wanted, ["page_id"]), responses, "run-1")
    bad = pages.where("page_id % 10 = 0").select(
        F.lit("skipped_invalid").alias("status"), F.lit("invalid_job_input").alias("reason"), F.lit("f").alias("file"), F.col("page_id").alias("line_no"),
        F.lit(None).cast("array<string>").alias("missing_fields"))
    both = done.unionByName(outcomes.skip_results(bad, "run-1"))
    return both.select(
        "job.primary_key", "status", "reason", "transfer.content_sha256", F.col("job.input_source.line_no").alias("line_no"))
