"""Files that are written from the tables and read again by the library's readers, and rules that need their own input."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from shelfscope import fixed_values as fv
from shelfscope.checks.registry import query, table
from shelfscope.checks.work import BACKOFF_STEP, request_steps
from shelfscope.operators import backoff, listings
from shelfscope.session import scratch_path
from shelfscope.sinks import tables as sinks
from shelfscope.sources import lines, seeds, tables
from shelfscope.streaming import streams

#: Document ids that share a file.
LOT = 10_000


@query("SELECT lang, CAST(doc_id AS VARCHAR) AS value, row_number() OVER (PARTITION BY lang ORDER BY doc_id) AS line_no FROM documents")
def numbered_gzip_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line numbers of gzip files, a language in many files; those of a language go on from file to file."""
    path = scratch_path(spark, "gzip-lines")
    rows = table(spark, sf_dir, "documents").select("lang", F.floor(F.col("doc_id") / LOT).alias("lot"), "doc_id")
    rows = rows.repartition("lang", "lot").sortWithinPartitions("lang", "lot", "doc_id")
    rows.select("lang", "lot", F.col("doc_id").cast("string")).write.option("compression", "gzip").partitionBy("lang", "lot").text(path)
    found = lines.read_numbered_lines(spark, path).select(
        F.regexp_extract("file", "lang=([^/]+)/", 1).alias("lang"), F.regexp_extract("file", "lot=([^/]+)/", 1).cast("long").alias("lot"), "value", "line_no")
    # one row per file: how many lines the files before it have
    sizes = found.groupBy("lang", "lot").agg(F.count("*").alias("n"))
    before = Window.partitionBy("lang").orderBy("lot").rowsBetween(Window.unboundedPreceding, -1)
    offsets = sizes.select("lang", "lot", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("offset"))
    return found.join(offsets, ["lang", "lot"]).select("lang", "value", (F.col("line_no") + F.col("offset")).alias("line_no"))


@query("SELECT url FROM pages")
def seed_file(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed lists written in several files and read by folder."""
    path = scratch_path(spark, "seeds")
    sinks.write_seed_csv(table(spark, sf_dir, "pages").select(F.col("url").alias("pdp_url")), path, max_records=100)
    return seeds.read_seed_csv(spark, path)


@query("SELECT ' ' || url AS url FROM pages WHERE page_id % 3 <> 0")
def seed_file_as_it_is(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The configured default file: cells with their padding, empty ones left out."""
    path = scratch_path(spark, "seeds")
    cell = F.when(F.col("page_id") % 3 != 0, F.concat(F.lit(" "), F.col("url")))
    table(spark, sf_dir, "pages").select(cell.alias("c"), "page_id").write.option("ignoreLeadingWhiteSpace", "false").csv(path)
    return seeds.seed_urls(spark, default_csv_path=path)


@query("""
SELECT page_id, CASE WHEN page_id % 4 = 0 THEN 'listing' WHEN page_id % 4 = 1 THEN 'product' ELSE 'other' END AS page_kind FROM pages
""")
def state_page_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing or not by the body of a page, product by its URL."""
    kind = F.col("page_id") % 4
    body = F.when(kind == 0, '{"routeType":"plp","page":1}').when(kind == 2, '{"routeType":"cms"}').otherwise(F.col("html"))
    name = F.concat(F.lit("https://www.ounass.ae/p"), F.col("page_id").cast("string"), F.when(kind == 1, ".html").otherwise(""))
    pages = table(spark, sf_dir, "pages").select("page_id", name.alias("url"), body.alias("html"))
    return listings.page_kinds(pages, fv.STATE_SITE).select("page_id", "page_kind")


@query(f"""
WITH e AS ({BACKOFF_STEP}),
s AS (SELECT *, sum(step) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS total FROM e),
p AS (SELECT event_id, step, CAST(total - least(0, min(total) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS BIGINT) AS penalty FROM s)
SELECT event_id, CASE WHEN step > 0 AND event_id % 3 = 0 THEN (event_id % 50)::DOUBLE WHEN penalty <= 0 THEN 1.0::DOUBLE
  ELSE least(300.0::DOUBLE, pow(2.0, penalty - 1)) END AS delay FROM p
""")
def retry_after(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Delays where a third of the responses ask for one and a third ask for something unreadable."""
    wish = F.when(F.col("event_id") % 3 == 0, (F.col("event_id") % 50).cast("string")).when(F.col("event_id") % 3 == 1, "soon")
    replayed = backoff.replay(request_steps(table(spark, sf_dir, "events")), slice_seconds=86400)
    return backoff.with_delay(replayed.withColumn("wish", wish), retry_after="wish").select("event_id", "delay")


@query("SELECT DISTINCT user_id, event_type FROM events")
def stream_distinct_by_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """De-duplication that forgets a key some time after the watermark; the table's time span is shorter than that."""
    base = scratch_path(spark, "distinct-by-time")
    schema = table(spark, sf_dir, "events").schema
    events = spark.readStream.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir).select("user_id", "event_type", F.col("ts").cast("timestamp"))
    rows = streams.distinct_stream(events, ["user_id", "event_type"], "ts", "3650 days")
    running = rows.writeStream.format("parquet").option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start(f"{base}/rows")
    running.awaitTermination()
    return spark.read.parquet(f"{base}/rows").select("user_id", "event_type")


@query("SELECT CAST(c_custkey AS VARCHAR) AS c_custkey, CASE WHEN c_custkey % 5 <> 0 THEN c_mktsegment END AS segment FROM customer")
def query_export(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An exported query result: text columns, empty cells as NULL."""
    path = scratch_path(spark, "export")
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 5 != 0, F.col("c_mktsegment")).otherwise("").alias("segment"))
    rows.write.option("header", "true").csv(path)
    return tables.read_query_csv(spark, path)


@query("SELECT n_regionkey AS part, count(*) AS n, count(*) AS empty FROM nation GROUP BY 1")
def appended_records(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records appended in two goes, with explicit nulls, one folder per region."""
    path = scratch_path(spark, "appended")
    rows = table(spark, sf_dir, "nation").select("n_name", F.lit(None).cast("string").alias("note"), F.col("n_regionkey").alias("part"))
    for go in (0, 1):
        sinks.append_records(rows.where(F.length("n_name") % 2 == go), path, ["part"])
    found = spark.read.text(path)
    return found.groupBy(F.col("part")).agg(F.count("*").alias("n"), F.count_if(F.col("value").contains('"note":null')).alias("empty"))


@query("""
SELECT strftime(ts, '%Y-%m-%d') AS dt, event_type AS run, count(*) AS n, count(*) FILTER (WHERE event_type = 'view') AS ok FROM events GROUP BY ALL
""")
def registered_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The image log as a table: written twice by run, its partitions registered twice, read by name."""
    path = scratch_path(spark, "log")
    name = "image_log_" + path.rsplit("-", 1)[-1]
    events = table(spark, sf_dir, "events")
    status = F.when(F.col("event_type") == "view", fv.STATUS_OK).otherwise(fv.STATUS_ERROR)
    rows = events.select(
        F.lit("shop").alias("site"), F.col("event_id").cast("string").alias("primary_key"), status.alias("status"),
        F.date_format("ts", "yyyy-MM-dd").alias("dt"), F.col("event_type").alias("run"))
    sinks.create_table(spark, name, path, "image_download_log")
    for _ in (0, 1):
        sinks.write_run_partitions(rows, path)
        sinks.register_partitions(spark, name, rows.select("dt", "run"))
    return spark.table(name).groupBy("dt", "run").agg(F.count("*").alias("n"), F.count_if(F.col("status") == fv.STATUS_OK).alias("ok"))
