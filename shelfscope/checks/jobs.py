"""Image jobs and outcomes, derived from events and pages."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope import fixed_values as fv
from shelfscope.checks.registry import query, table
from shelfscope.operators import jobs, outcomes
from shelfscope.operators.keyed import first_wins
from shelfscope.operators.products import fill_missing
from shelfscope.sources import lines

# Every event becomes one input line: each kind shows another way a line can look.
LINES_SQL = """
e AS (SELECT event_id, event_type AS t, user_id AS u, value, CAST(json_extract_string(props, '$.k') AS INTEGER) AS k FROM events),
l AS (SELECT 'events' AS file, event_id + 1 AS line_no, u, k,
  CASE WHEN value < 1 THEN 'empty' WHEN t = 'error' THEN 'broken' WHEN t = 'click' THEN 'list'
       WHEN t = 'signup' THEN 'no_key' WHEN t = 'view' AND k < 10 THEN 'no_site'
       WHEN t = 'view' AND u = 0 THEN 'zero_key' ELSE t END AS kind FROM e)
"""
BUILT_SQL = f"""WITH {LINES_SQL},
j AS (
  SELECT line_no, 0 AS url_no, 'farfetch' AS site, u || '_farfetch' AS primary_key, 'cdn.example.com/' || k || '.jpg' AS image_url FROM l WHERE kind = 'view'
  UNION ALL SELECT line_no, 0, 'Level', 'u' || u, '//img.example.com/a' || k || '.png' FROM l WHERE kind = 'purchase'
  UNION ALL SELECT line_no, 1, 'Level', 'u' || u, 'img.example.com/' || u || '.webp' FROM l WHERE kind = 'purchase'),
r AS (SELECT *, row_number() OVER (PARTITION BY site, primary_key, image_url ORDER BY line_no, url_no) AS rn FROM j)
"""


def input_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    user, k = F.col("user_id").cast("string"), F.get_json_object("props", "$.k")
    view = F.to_json(F.struct(
        F.when(k.cast("int") < 10, F.lit(" ")).otherwise(F.lit("farfetch")).alias("site"),
        F.col("user_id").alias("portal_itemid"), F.concat(F.lit("cdn.example.com/"), k, F.lit(".jpg")).alias("image_url"),
        F.lit("run-0").alias("run_id"),
    ))
    purchase = F.to_json(F.struct(
        F.lit("Level").alias("site"), F.lit("").alias("primary_key"), F.concat(F.lit("u"), user).alias("unique_id"),
        F.array(F.concat(F.lit(" //img.example.com/a"), k, F.lit(".png")), F.lit(" "),
                F.concat(F.lit("img.example.com/"), user, F.lit(".webp"))).alias("image_urls"),
    ))
    kind = F.col("event_type")
    value = (
        F.when(F.col("value") < 1, " ").when(kind == "error", F.concat(F.lit('{"site": "a"} '), "props"))
        .when(kind == "click", F.concat(F.lit("["), F.col("props"), F.lit("]")))
        .when(kind == "signup", F.lit('{"site": "ounass", "image_url": "x.example.com/a.jpg"}'))
        .when(kind == "view", view).otherwise(purchase)
    )
    events = table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", "value", "props")
    return events.select(
        F.lit("events").alias("file"), (F.col("event_id") + 1).alias("line_no"), value.alias("value")
    )


@query(BUILT_SQL + """
SELECT line_no, url_no, site, primary_key, image_url, CASE WHEN rn = 1 THEN 'jobs_written' ELSE 'skipped_duplicate_job' END AS outcome FROM r
UNION ALL SELECT line_no, 0, CASE kind WHEN 'no_key' THEN 'ounass' WHEN 'zero_key' THEN 'farfetch' END, NULL, NULL,
  CASE kind WHEN 'empty' THEN 'skipped_empty_line' WHEN 'broken' THEN 'skipped_invalid_json' WHEN 'list' THEN 'skipped_invalid_shape'
    WHEN 'no_key' THEN 'skipped_missing_primary_key' WHEN 'zero_key' THEN 'skipped_missing_primary_key' ELSE 'skipped_missing_site' END FROM l WHERE kind NOT IN ('view', 'purchase')
""")
def build_jobs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs and rejected lines, first of equal jobs wins."""
    built = jobs.build_jobs(input_lines(spark, sf_dir))
    key = F.when(F.col("outcome").isin("jobs_written", "skipped_duplicate_job"), F.col("primary_key"))
    return built.select("line_no", "url_no", "site", key.alias("primary_key"), "image_url", "outcome")


@query(BUILT_SQL + """
SELECT CASE WHEN rn = 1 THEN 'jobs_written' ELSE 'skipped_duplicate_job' END AS outcome, count(*) AS n FROM r GROUP BY ALL
UNION ALL SELECT CASE kind WHEN 'empty' THEN 'skipped_empty_line' WHEN 'broken' THEN 'skipped_invalid_json' WHEN 'list' THEN 'skipped_invalid_shape'
    WHEN 'no_key' THEN 'skipped_missing_primary_key' WHEN 'zero_key' THEN 'skipped_missing_primary_key' ELSE 'skipped_missing_site' END AS outcome, count(*) FROM l WHERE kind NOT IN ('view', 'purchase') GROUP BY ALL
UNION ALL SELECT 'rows_total', count(*) FROM l
""")
def job_counters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jobs.job_counters(jobs.build_jobs(input_lines(spark, sf_dir)))


@query(f"""WITH {LINES_SQL}
SELECT line_no, CASE WHEN kind IN ('broken', 'list', 'no_key', 'zero_key') OR (kind = 'no_site' AND u = 0) THEN 'skipped_invalid' END AS status,
  CASE WHEN kind IN ('broken', 'list') THEN 'invalid_json' WHEN kind IN ('no_key', 'zero_key') OR (kind = 'no_site' AND u = 0) THEN 'missing_required_fields' END AS reason,
  CASE WHEN kind IN ('no_key', 'zero_key') OR (kind = 'no_site' AND u = 0) THEN 'primary_key' END AS missing FROM l WHERE kind <> 'empty'
""")
def tolerant_job_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tolerant reading: bad lines are skip rows with a reason."""
    read = jobs.read_job_lines(input_lines(spark, sf_dir))
    return read.select("line_no", "status", "reason", F.array_join("missing_fields", ",").alias("missing"))


@query(f"""WITH {LINES_SQL},
j AS (SELECT line_no, 'farfetch' AS site, u || '_farfetch' AS pk, 'https://cdn.example.com/' || k || '.jpg' AS url FROM l WHERE kind = 'view'),
i AS (SELECT line_no, sha1(site || '|' || pk || '|' || url) AS job_id FROM j),
r AS (SELECT *, row_number() OVER (PARTITION BY job_id ORDER BY line_no) AS rn FROM i)
SELECT line_no, job_id, CASE WHEN rn > 1 THEN 'skipped_duplicate' END AS status, CASE WHEN rn > 1 THEN 'duplicate_job' END AS reason FROM r
UNION ALL SELECT line_no, NULL, 'skipped_invalid', 'invalid_job_input' FROM l WHERE kind = 'purchase' OR (kind = 'no_site' AND u <> 0)
""")
def job_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Canonical site, URL and id per job; duplicates and unusable jobs marked."""
    read = jobs.read_job_lines(input_lines(spark, sf_dir)).where("status IS NULL").drop("status", "reason")
    return jobs.plan_jobs(read, ["file", "line_no"]).select("line_no", "job_id", "status", "reason")


@query("""
SELECT l_orderkey, l_linenumber, sha1('s|' || l_partkey || '|' || l_suppkey) AS job_id,
  row_number() OVER (PARTITION BY l_partkey, l_suppkey ORDER BY l_orderkey, l_linenumber, l_shipdate, l_extendedprice) = 1 AS is_first FROM lineitem
""")
def job_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First wins over all line items."""
    order = ["l_orderkey", "l_linenumber", "l_shipdate", "l_extendedprice"]
    items = table(spark, sf_dir, "lineitem").select(*order, "l_partkey", "l_suppkey").select(*order, F.sha1(F.concat(
        F.lit("s|"), F.col("l_partkey").cast("string"), F.lit("|"), F.col("l_suppkey").cast("string"))).alias("job_id"))
    return first_wins(items, ["job_id"], order).select("l_orderkey", "l_linenumber", "job_id", "is_first")


PAGE_SQL = """
p AS (SELECT page_id, url, html, split_part(url, '/', 4) AS lang, CASE WHEN url LIKE 'http%' THEN url END AS norm FROM pages),
f AS (SELECT url, min(page_id) AS page_id FROM p WHERE url NOT LIKE '%#top' GROUP BY url),
s AS (SELECT p.url, p.html, CASE p.lang WHEN 'en' THEN 'image/png' WHEN 'fr' THEN 'text/html' WHEN 'de' THEN 'IMAGE/WEBP; q=1' END AS ct,
        CASE WHEN p.url LIKE '%?page=%' THEN 404 ELSE 200 END AS http FROM p JOIN f ON p.page_id = f.page_id),
o AS (SELECT p.page_id, sha1('ounass|' || p.page_id || '|' || p.url) AS job_id, s.ct, s.http, sha256(s.html) AS sha, strlen(s.html) AS bytes,
        CASE WHEN s.http IS NULL OR s.http >= 400 THEN 'request_failed' WHEN s.ct = 'text/html' THEN 'non_image_content_type' ELSE 'downloaded' END AS reason
      FROM p LEFT JOIN s ON p.url = s.url)
"""


def page_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages as image jobs, and one stored response per URL for most of them."""
    pages = table(spark, sf_dir, "pages")
    lang = F.split_part("url", F.lit("/"), F.lit(4))
    wanted = pages.select(
        "page_id", F.lit("ounass").alias("site"), F.col("page_id").cast("string").alias("primary_key"),
        F.col("url").alias("image_url"), F.lit("run-0").alias("source_run_id"),
    )
    stored = first_wins(pages.where(~F.col("url").endswith("#top")), ["url"], ["page_id"]).where("is_first")
    responses = stored.select(
        "url", F.when(F.col("url").contains("?page="), 404).otherwise(200).alias("http_status"),
        F.when(lang == "en", "image/png").when(lang == "fr", "text/html").when(lang == "de", "IMAGE/WEBP; q=1").alias("content_type"),
        F.encode("html", "UTF-8").alias("content"), F.lit(None).cast("string").alias("error_type"),
        F.lit(None).cast("string").alias("error_message"),
    )
    return outcomes.job_outcomes(jobs.plan_jobs(wanted, ["page_id"]), responses, "run-1", blob_prefix="by-hash/")


@query(f"""WITH {PAGE_SQL}
SELECT job_id, CAST(page_id AS VARCHAR) AS primary_key, CASE reason WHEN 'downloaded' THEN 'ok' ELSE 'error' END AS status, reason,
  CASE reason WHEN 'downloaded' THEN sha END AS content_sha256, CASE reason WHEN 'downloaded' THEN bytes END AS bytes,
  CASE WHEN reason = 'downloaded' THEN 'by-hash/' || sha || CASE ct WHEN 'image/png' THEN '.png' WHEN 'IMAGE/WEBP; q=1' THEN '.webp' ELSE '.jpg' END END AS blob_key,
  CASE reason WHEN 'non_image_content_type' THEN 'Expected image content type, got text/html'
    WHEN 'request_failed' THEN CASE WHEN http = 404 THEN 'HTTP status 404' ELSE 'no stored response' END END AS message FROM o
""")
def job_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Result records over stored responses."""
    return page_results(spark, sf_dir).select(
        "job.job_id", "job.primary_key", "status", "reason", "transfer.content_sha256", "transfer.bytes",
        F.col("storage.canonical_blob_key").alias("blob_key"), F.col("error.message").alias("message"),
    )


@query(f"""WITH {PAGE_SQL}
SELECT job_id, CASE WHEN reason = 'downloaded' AND bytes > 2000 THEN 'error' WHEN reason = 'downloaded' THEN 'ok' ELSE 'error' END AS status,
  CASE WHEN reason = 'downloaded' AND bytes > 2000 THEN 's3_upload_failed' ELSE reason END AS reason FROM o
""")
def upload_outcomes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Outcomes after some blobs could not be written."""
    results = page_results(spark, sf_dir)
    failed = results.where("transfer.bytes > 2000").select(
        F.col("storage.canonical_blob_key").alias("canonical_blob_key"), F.lit("IOError").alias("error_type"), F.lit("full").alias("error_message")
    ).distinct()
    return outcomes.upload_outcomes(results, failed).select("job.job_id", "status", "reason")


RESULT_SQL = "CASE event_type WHEN 'view' THEN 'ok' WHEN 'click' THEN 'skipped_duplicate' WHEN 'signup' THEN '' WHEN 'purchase' THEN NULL ELSE 'error' END"


def event_results(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    status = (
        F.when(kind == "view", fv.STATUS_OK).when(kind == "click", fv.STATUS_SKIPPED_DUPLICATE)
        .when(kind == "error", fv.STATUS_ERROR).when(kind == "signup", "")
    )
    blob = outcomes.result_blob(
        status=status, reason=kind, primary_key=F.col("user_id").cast("string"), site=F.lit("shop"),
        image_url=F.concat(F.lit("u"), F.col("event_id").cast("string")),
        http_status=F.when(kind == "error", 500), error_message=F.when(kind == "error", F.col("props")),
    )
    return table(spark, sf_dir, "events").select(F.date_format("ts", "yyyy-MM-dd").alias("dt"), blob.alias("r")).select("dt", "r.*")


@query(f"""
SELECT 'shop' AS site, CAST(user_id AS VARCHAR) AS primary_key, 'u' || event_id AS url, 'run-1' AS run_id, {RESULT_SQL} AS status, event_type AS reason,
  CASE WHEN event_type = 'error' THEN props END AS error_message, CAST(CASE WHEN event_type = 'error' THEN 500 END AS INTEGER) AS http_status,
  CAST(NULL AS VARCHAR) AS s3_blob_key, '2024-02-01' AS dt, 'run-1' AS run FROM events WHERE event_type <> 'click'
""")
def status_flatten(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Download log rows; duplicates are not logged, rows without a status are."""
    return outcomes.log_rows(outcomes.loggable(event_results(spark, sf_dir)), "2024-02-01", "run-1")


@query(f"""
SELECT strftime(ts, '%Y-%m-%d') AS dt, coalesce(nullif({RESULT_SQL}, ''), 'unknown') AS status, count(*) AS n FROM events GROUP BY ALL
""")
def status_histogram(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcomes.status_histogram(event_results(spark, sf_dir), ["dt"])


@query(f"""
WITH h AS (SELECT strftime(ts, '%Y-%m-%d') AS dt, coalesce(nullif({RESULT_SQL}, ''), 'unknown') AS status, count(*) AS n FROM events GROUP BY ALL)
SELECT dt, string_agg(status || '=' || n, ', ' ORDER BY status) AS summary FROM h GROUP BY dt
""")
def status_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return outcomes.summary_line(outcomes.status_histogram(event_results(spark, sf_dir), ["dt"]), ["dt"])


@query("""
SELECT strftime(ts, '%Y-%m-%d') AS dt, count(*) FILTER (WHERE event_type = 'error') AS errors,
  CASE WHEN count(*) FILTER (WHERE event_type = 'error') = 0 THEN '_SUCCESS' ELSE '_FAILED' END AS marker FROM events GROUP BY 1
""")
def all_ok(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run marker by day."""
    return outcomes.run_marker(event_results(spark, sf_dir), ["dt"])


@query("""
SELECT d.doc_id, coalesce(l.q, CASE WHEN d.n_chars > 500 THEN 1 END) AS quality, d.lang FROM documents d
LEFT JOIN (SELECT doc_id, max(quality) AS q FROM labels GROUP BY doc_id) l ON d.doc_id = l.doc_id
""")
def fill_missing_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Given values kept, gaps filled from the row itself."""
    base = table(spark, sf_dir, "documents").select("doc_id", F.when(F.col("n_chars") > 500, 1).alias("quality"), "lang")
    given = table(spark, sf_dir, "labels").groupBy("doc_id").agg(F.max("quality").alias("quality"))
    return fill_missing(base, given, "doc_id", ["quality"], ["doc_id"])


@query("""
WITH t AS (SELECT role AS kind, text FROM conversations UNION ALL SELECT 'props', props FROM events UNION ALL SELECT 'list', '[' || props || ']' FROM events)
SELECT kind, CASE WHEN text IS NULL OR NOT regexp_matches(text, '[^\\s]') THEN 'empty_line' WHEN NOT json_valid(text) THEN 'invalid_json'
  WHEN json_type(text) <> 'OBJECT' THEN 'invalid_shape' ELSE 'object' END AS problem, count(*) AS n FROM t GROUP BY ALL
""")
def line_problems(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What tolerant parsing says of prose, objects and lists."""
    events = table(spark, sf_dir, "events")
    rows = (
        table(spark, sf_dir, "conversations").select(F.col("role").alias("kind"), F.col("text").alias("value"))
        .unionByName(events.select(F.lit("props").alias("kind"), F.col("props").alias("value")))
        .unionByName(events.select(F.lit("list").alias("kind"), F.concat(F.lit("["), "props", F.lit("]")).alias("value")))
    )
    return lines.parse_lines(rows).groupBy("kind", F.coalesce("problem", F.lit("object")).alias("problem")).agg(F.count("*").alias("n"))
