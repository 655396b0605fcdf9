"""Streams and written tables. Each query runs a stream or a write to its end and returns what it left."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope import schemas
from shelfscope.checks.extraction import dom_pages
from shelfscope.checks.images import CHECK_SQL, part_images
from shelfscope.checks.registry import query, table
from shelfscope.checks.work import BACKOFF_STEP, request_steps
from shelfscope.operators import products
from shelfscope.plans import image_run as plan
from shelfscope.session import scratch_path
from shelfscope.sinks import tables as sinks
from shelfscope.sources import lines
from shelfscope.streaming import streams


def event_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = table(spark, sf_dir, "events").schema
    return spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_distinct(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Streaming de-duplication; which row stays is open, the set of keys is not."""
    base = scratch_path(spark, "distinct")
    rows = streams.distinct_stream(event_stream(spark, sf_dir).select("user_id", "event_type"), ["user_id", "event_type"])
    running = (
        rows.writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start(f"{base}/rows")
    )
    running.awaitTermination()
    return spark.read.parquet(f"{base}/rows")


@query(f"""
WITH e AS ({BACKOFF_STEP}),
s AS (SELECT *, sum(step) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS total FROM e)
SELECT event_id, CAST(total - least(0, min(total) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS BIGINT) AS penalty FROM s
""")
def stream_penalty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Penalties replayed by a stream."""
    base = scratch_path(spark, "penalty")
    running = streams.penalty_stream(
        request_steps(event_stream(spark, sf_dir)), f"{base}/rows", f"{base}/state", f"{base}/checkpoint", slice_seconds=86400
    )
    running.awaitTermination()
    return spark.read.option("basePath", f"{base}/rows").parquet(f"{base}/rows").select("event_id", "penalty")


@query("SELECT strftime(ts, '%Y-%m-%d') AS dt, event_type, count(*) AS n FROM events GROUP BY ALL")
def stream_refresh(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily counts kept up to date partition by partition."""
    base = scratch_path(spark, "refresh")
    day = F.date_format("ts", "yyyy-MM-dd").alias("dt")

    def model() -> DataFrame:
        return table(spark, sf_dir, "events").groupBy(day, "event_type").agg(F.count("*").alias("n"))

    running = streams.refresh_partitions(event_stream(spark, sf_dir).select(day), model, f"{base}/rows", ("dt",), f"{base}/checkpoint")
    running.awaitTermination()
    return spark.read.schema("event_type string, n bigint, dt string").json(f"{base}/rows").select("dt", "event_type", "n")


@query(CHECK_SQL + "SELECT CAST(p_partkey AS VARCHAR) AS primary_key, w AS width, h AS height, '2024-02-01' AS dt FROM c WHERE verdict = 'ok'")
def stream_validate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A success marker makes a stream validate that run's images."""
    base = scratch_path(spark, "validate")
    log, blobs = part_images(spark, sf_dir)
    other = log.withColumns({"dt": F.lit("2024-02-02"), "run": F.lit("run-2")})
    sinks.write_run_partitions(log.unionByName(other).withColumns({"reason": F.lit("x"), "error_message": F.lit(None).cast("string"), "http_status": F.lit(200)}), f"{base}/log")
    blobs.write.parquet(f"{base}/blobs")
    markers = spark.createDataFrame([("images", "2024-02-01", "run-1", "_SUCCESS", ""), ("images", "2024-02-02", "run-2", "_FAILED", "")], schemas.RUN_MARKER)
    sinks.write_markers(markers, f"{base}/markers")
    streams.validate_on_success(spark, f"{base}/markers", f"{base}/log", f"{base}/blobs", f"{base}/validated", f"{base}/checkpoint").awaitTermination()
    return spark.read.schema(schemas.IMAGE_VALIDATED).json(f"{base}/validated").select("primary_key", "width", "height", "dt")


@query("""
SELECT event_id, CASE WHEN event_type = 'view' THEN 'ignored' WHEN event_type = 'click' THEN 'error' ELSE 'ok' END AS status,
  CASE WHEN event_type NOT IN ('view', 'click') THEN strftime(ts, '%Y-%m-%d') END AS dt,
  CASE WHEN event_type NOT IN ('view', 'click') THEN 'r ' || event_id END AS run_id FROM events
""")
def marker_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event keys routed: handled, ignored or malformed."""
    prefix = "bronze/dev/images/download_log/meta/"
    day, run = F.date_format("ts", "yyyy-MM-dd"), F.concat(F.lit("r "), F.col("event_id").cast("string"))
    name = F.when(F.col("event_type") == "view", "_FAILED").otherwise("_SUCCESS")
    key = F.when(F.col("event_type") == "click", F.concat(F.lit("other/"), run, F.lit("/_SUCCESS"))).otherwise(
        F.concat(F.lit(prefix), F.concat_ws("/", day, run, name)))
    events = table(spark, sf_dir, "events").select("event_id", F.url_encode(key).alias("key"))
    routed = streams.route_marker_events(events, prefix)
    event = F.regexp_extract("key", r"r (\d+)/", 1).cast("bigint")
    return routed.select(event.alias("event_id"), "status", "dt", "run_id")


@query("SELECT event_type AS dt, 'r' AS run, user_id, event_id FROM events")
def table_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows written as gzip JSON run partitions and read back with an explicit schema."""
    base = scratch_path(spark, "table")
    sinks.write_run_partitions(table(spark, sf_dir, "events").select("user_id", "event_id", F.col("event_type").alias("dt"), F.lit("r").alias("run")), base)
    return spark.read.schema("user_id bigint, event_id bigint, dt string, run string").json(base).select("dt", "run", "user_id", "event_id")


@query("SELECT count(*) AS n, count(*) AS n_numbers, CAST(sum(user_id) AS BIGINT) AS users FROM events")
def numbered_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines written as text files and numbered on reading: every number of every file exactly once."""
    base = scratch_path(spark, "lines")
    table(spark, sf_dir, "events").repartition(3, "user_id").select(F.to_json(F.struct("user_id", "props")).alias("value")).write.text(base)
    numbered = lines.read_numbered_lines(spark, base)
    parsed = lines.strict_records(numbered).withColumn("user_id", F.try_variant_get(F.col("fields")["user_id"], "$", "bigint"))
    per_file = parsed.groupBy("file").agg(
        F.count("*").alias("n"), F.countDistinct("line_no").alias("seen"), F.min("line_no").alias("low"), F.max("line_no").alias("high"),
        F.sum("user_id").alias("users"),
    )
    whole = F.when((F.col("low") == 1) & (F.col("high") == F.col("n")), F.col("seen")).otherwise(0)
    return per_file.agg(F.sum("n").alias("n"), F.sum(whole).alias("n_numbers"), F.sum("users").alias("users"))


@query("SELECT 'farfetch' AS site, CAST(p_partkey AS VARCHAR) AS portal_itemid, CASE WHEN p_size % 7 <> 0 THEN p_retailprice END AS price FROM part")
def silver_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed records written as partitioned Parquet and read back."""
    base = scratch_path(spark, "silver")
    sinks.write_silver(products.dom_products(dom_pages(spark, sf_dir), "2024-02-01T00-00-00-000", "2024-02-01"), base)
    return spark.read.schema(schemas.PRODUCT).parquet(base).select("site", "portal_itemid", "price")


@query("SELECT DISTINCT 'by-hash/' || sha256(text) || '.txt' AS blob_key, sha256(text) AS sha256, strlen(text) AS bytes FROM documents WHERE sha256(text) NOT IN (SELECT sha256(text) FROM documents WHERE lang = 'de')")
def content_store(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every new content stored once under its digest; contents of one language count as stored."""
    base = scratch_path(spark, "contents")
    docs = table(spark, sf_dir, "documents").select("doc_id", "lang", F.encode("text", "UTF-8").alias("content"))
    stored = docs.where("lang = 'de'").select(F.sha2("content", 256).alias("sha256"))
    sinks.store_contents(docs.select("doc_id", "content"), "doc_id", stored, base, "by-hash", ".txt")
    return spark.read.parquet(base).select("blob_key", "sha256", F.octet_length("content").cast("bigint").alias("bytes"))


@query("""
WITH j AS (SELECT page_id, url, strlen(html) AS n FROM pages)
SELECT CAST(page_id AS VARCHAR) AS primary_key, CASE WHEN url LIKE '%#top' THEN 'error' ELSE 'ok' END AS status,
  CASE WHEN url LIKE '%#top' THEN 'request_failed' ELSE 'downloaded' END AS reason, '2024-02-02' AS dt FROM j
""")
def image_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A whole image run: pending rows, jobs, outcomes, log partition, marker."""
    base = scratch_path(spark, "image-run")
    pages = table(spark, sf_dir, "pages")
    catalogue = pages.select(F.lit("ounass").alias("site"), F.col("page_id").cast("string").alias("primary_key"), "url", F.lit("2024-02-01").alias("dt"))
    log = spark.createDataFrame([], "site string, primary_key string, url string, run_id string, status string")
    responses = pages.where(~F.col("url").endswith("#top")).dropDuplicates(["url"]).select(
        "url", F.lit(200).alias("http_status"), F.lit("image/png").alias("content_type"), F.encode("html", "UTF-8").alias("content"),
        F.lit(None).cast("string").alias("error_type"), F.lit(None).cast("string").alias("error_message"),
    )
    written = plan.run_images(catalogue, log, responses, "run-2", "2024-02-02", f"{base}/log", f"{base}/markers", "by-hash")
    return written.select("primary_key", "status", "reason", "dt")
