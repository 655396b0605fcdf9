"""Pending work, latest outcomes, anti joins, listings, backoff, recrawl."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope.checks.registry import query, table
from shelfscope.functions import arrays, urls
from shelfscope.operators import assets, backoff, keyed, listings, pending
from shelfscope.plans import models


def order_catalogue(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as a dated catalogue: one snapshot per year, keyed by customer."""
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.col("o_custkey").cast("string").alias("primary_key"),
        F.date_format("o_orderdate", "yyyy").alias("dt"),
    )


def event_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events as an outcome log: one row per attempt, ordered by event id."""
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("primary_key"), F.col("event_id").alias("run_id"),
        F.col("event_type").alias("status"),
    )


PENDING_SQL = """
WITH c AS (SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS primary_key, strftime(o_orderdate, '%Y') AS dt FROM orders),
s AS (SELECT CAST(user_id AS VARCHAR) AS primary_key, event_type AS status,
             row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events)
SELECT c.o_orderkey, c.primary_key, s.status AS last_status
FROM c LEFT JOIN s ON c.primary_key = s.primary_key AND s.rn = 1
WHERE c.dt = (SELECT max(dt) FROM c) AND (s.status IS NULL OR s.status = 'error')
"""


@query(PENDING_SQL)
def pending_work(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Snapshot rows never tried or last seen failing."""
    found = pending.pending_work(
        order_catalogue(spark, sf_dir), event_log(spark, sf_dir), ["primary_key"], spread_by=["o_orderkey"]
    )
    return found.select("o_orderkey", "primary_key", "last_status")


@query(PENDING_SQL + " ORDER BY c.primary_key, c.o_orderkey LIMIT 25")
def pending_first_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with a row limit over a total order."""
    found = pending.pending_work(
        order_catalogue(spark, sf_dir), event_log(spark, sf_dir), ["primary_key"], spread_by=["o_orderkey"], limit=25
    )
    return found.select("o_orderkey", "primary_key", "last_status")


@query("""
SELECT CAST(user_id AS VARCHAR) AS primary_key, event_id AS run_id, event_type AS status FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events) WHERE rn = 1
""")
def latest_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pending.latest_status(event_log(spark, sf_dir), ["primary_key"])


@query("""
SELECT doc_id, source, row_no FROM (
  SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS row_no FROM documents)
WHERE row_no <= 3
""")
def first_three_per_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sample of a run's output: its first three rows."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source")
    return keyed.first_rows(docs, ["source"], ["doc_id"], 3).withColumn("row_no", F.col("row_no").cast("bigint"))


@query("""
WITH f AS (SELECT DISTINCT split_part(url, '?', 1) AS found_url FROM pages),
s AS (SELECT url AS u FROM pages WHERE url LIKE '%/fr/%'
      UNION SELECT replace(url, 'http://', 'https://') FROM pages WHERE url LIKE '%/fr/%')
SELECT found_url FROM f WHERE NOT EXISTS (SELECT 1 FROM s WHERE s.u = f.found_url)
""")
def frontier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """URLs not requested yet, redirect targets included."""
    pages = table(spark, sf_dir, "pages").select("url")
    seen = pages.where(F.col("url").contains("/fr/")).select(
        "url", F.replace(F.col("url"), F.lit("http://"), F.lit("https://")).alias("final_url")
    )
    return listings.frontier(pages.select(urls.before_query(F.col("url")).alias("found_url")), seen)


@query("""
SELECT page_id, target FROM (
  SELECT page_id, replace(split_part(url, '?', 1), 'http://', 'https://') AS target,
         row_number() OVER (PARTITION BY replace(split_part(url, '?', 1), 'http://', 'https://') ORDER BY page_id) AS rn
  FROM pages) WHERE rn = 1
""")
def redirect_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Responses that reach an address for the first time."""
    target = F.replace(urls.before_query(F.col("url")), F.lit("http://"), F.lit("https://"))
    pages = table(spark, sf_dir, "pages").select("page_id", target.alias("final_url"))
    return listings.distinct_targets(pages, ["page_id"]).select("page_id", F.col("final_url").alias("target"))


@query("SELECT c_custkey, c_nationkey FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey AND o_orderpriority = '1-URGENT')")
def not_stored_yet(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Existence anti join: customers without urgent orders."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")
    urgent = table(spark, sf_dir, "orders").where("o_orderpriority = '1-URGENT'")
    return keyed.not_seen(customers, urgent, "c_custkey", "o_custkey")


@query("""
WITH p AS (SELECT 'https://shop.example/' || doc_id AS url, CAST(n_chars // 500 AS INTEGER) AS total FROM documents)
SELECT url, url AS page_url FROM p WHERE total > 1
UNION ALL
SELECT url, url || '?page=' || g AS page_url FROM (SELECT url, unnest(generate_series(2, least(total, 9))) AS g FROM p WHERE total > 1)
""")
def page_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages 1..N of the markup site, at most nine."""
    total = F.floor(F.col("n_chars") / 500).cast("int")
    docs = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("https://shop.example/"), F.col("doc_id").cast("string")).alias("url"), total.alias("total")
    )
    return docs.select("url", F.explode(arrays.dom_page_urls(F.col("url"), F.col("total"), 9)).alias("page_url"))


@query("""
WITH p AS (SELECT 'https://shop.example/' || doc_id AS url, CAST(n_chars // 500 AS INTEGER) AS total FROM documents)
SELECT url, url AS page_url FROM p WHERE total > 1
UNION ALL
SELECT url, url || '?page=' || g AS page_url FROM (SELECT url, unnest(generate_series(2, total)) AS g FROM p WHERE total > 1)
""")
def page_fanout_unlimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing pages 1..N of the markup site, all of them."""
    docs = table(spark, sf_dir, "documents").select(
        F.concat(F.lit("https://shop.example/"), F.col("doc_id").cast("string")).alias("url"), F.floor(F.col("n_chars") / 500).cast("int").alias("total")
    )
    return docs.select("url", F.explode(arrays.dom_page_urls(F.col("url"), F.col("total"), None)).alias("page_url"))


@query("""
WITH p AS (SELECT doc_id, lang = 'en' AS is_sorted, CAST(n_chars // 1000 AS INTEGER) AS total FROM documents)
SELECT doc_id, 'https://shop.example/list?fh_sort_by=-newness_ae&p=' || g AS page_url FROM (
  SELECT doc_id, unnest(generate_series(CASE WHEN is_sorted THEN 1 ELSE 0 END, total - 1)) AS g FROM p)
""")
def sorted_page_fanout(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pages of a sortable listing: 1..N-1 when sorted already, 0..N-1 otherwise."""
    docs = table(spark, sf_dir, "documents").select(
        "doc_id",
        F.when(F.col("lang") == "en", "https://shop.example/list?fh_sort_by=-newness_ae")
        .otherwise("https://shop.example/list?colour=red").alias("url"),
        F.floor(F.col("n_chars") / 1000).cast("int").alias("total"),
    )
    return docs.select("doc_id", F.explode(arrays.state_page_urls(F.col("url"), F.col("total"))).alias("page_url"))


@query("""
SELECT DISTINCT page_id, link FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href="([^"]*)"', 1)) AS link FROM pages)
""")
def page_links(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Distinct link targets of every page."""
    pages = table(spark, sf_dir, "pages")
    return pages.select("page_id", F.explode(listings.link_targets(F.col("html"))).alias("link"))


BACKOFF_STEP = """
SELECT event_id, user_id, ts,
  CASE WHEN event_type = 'purchase' AND value > 5 THEN 1
       WHEN event_type = 'purchase' THEN 0
       WHEN event_type IN ('error', 'signup') AND value > 5 THEN 1
       ELSE -2 END AS step FROM events
"""


def request_steps(events: DataFrame) -> DataFrame:
    """Events as request outcomes: two retryable codes, two others, one transport exception."""
    codes = F.create_map(*[F.lit(x) for x in ("error", 503, "signup", 429, "view", 200, "click", 404)])
    step = backoff.step_of(
        F.try_element_at(codes, F.col("event_type")), F.col("value") > 5, F.col("event_type") == "purchase", decay=2
    )
    return events.select(F.col("user_id").cast("string").alias("domain"), "ts", "event_id", step.cast("bigint").alias("step"))


@query(f"""
WITH e AS ({BACKOFF_STEP}),
s AS (SELECT *, sum(step) OVER (PARTITION BY user_id ORDER BY ts, event_id) AS total FROM e),
p AS (SELECT event_id, CAST(total - least(0, min(total) OVER (PARTITION BY user_id ORDER BY ts, event_id)) AS BIGINT) AS penalty FROM s)
SELECT event_id, penalty, CASE WHEN penalty <= 0 THEN 1.0::DOUBLE ELSE least(300.0::DOUBLE, pow(2.0, penalty - 1)) END AS delay FROM p
""")
def backoff_replay(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Per-domain penalty and delay after every request."""
    steps = request_steps(table(spark, sf_dir, "events"))
    return backoff.with_delay(backoff.replay(steps, slice_seconds=86400)).select("event_id", "penalty", "delay")


@query("""
WITH o AS (SELECT user_id, ts, event_type, props, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC) AS rn FROM events),
l AS (SELECT CAST(user_id AS VARCHAR) AS primary_key, 'https://shop.example/' || user_id || '.html' AS pdp_url, event_type,
             date_diff('day', CAST(ts AS DATE), DATE '2024-02-02') AS age FROM o WHERE rn = 1),
r AS (SELECT primary_key, pdp_url, CASE WHEN event_type = 'error' THEN 'oos_recheck' WHEN event_type = 'purchase' THEN 'sale_recheck'
             WHEN age >= 3 THEN 'stale_fact' END AS reason_code FROM l)
SELECT primary_key, pdp_url, reason_code FROM r WHERE reason_code IS NOT NULL
""")
def recrawl_candidates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Products whose newest observation asks for another look."""
    events = table(spark, sf_dir, "events")
    observations = events.select(
        F.lit("shop").alias("site"), F.col("user_id").cast("string").alias("primary_key"), F.lit("ae").alias("country"),
        F.concat(F.lit("https://shop.example/"), F.col("user_id").cast("string"), F.lit(".html")).alias("pdp_url"),
        F.col("ts").alias("seen_at"), (F.col("event_type") == "error").alias("out_of_stock"),
        F.when(F.col("event_type") == "purchase", F.col("props")).alias("price_discount"),
    )
    today = F.lit("2024-02-02").cast("date")
    return models.recrawl_candidates(observations, today, stale_days=3).select("primary_key", "pdp_url", "reason_code")


@query("""
WITH c AS (SELECT c_custkey, CAST(c_custkey AS VARCHAR) AS k FROM customer),
v AS (SELECT CAST(o_custkey AS VARCHAR) AS k, o_orderkey, sha256(CAST(o_orderkey AS VARCHAR)) AS blob,
             row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey DESC) AS rn FROM orders WHERE o_orderstatus = 'F'),
l AS (SELECT CAST(user_id AS VARCHAR) AS k, event_type, row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) AS rn FROM events)
SELECT c.c_custkey, v.blob AS s3_blob_key, l.event_type AS last_status, v.blob IS NOT NULL AS is_downloaded
FROM c LEFT JOIN v ON c.k = v.k AND v.rn = 1 LEFT JOIN l ON c.k = l.k AND l.rn = 1
""")
def serving_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Catalogue with last attempt and whether a validated image exists."""

    def keyed_by(c: str) -> list:
        return [F.lit("shop").alias("site"), F.col(c).cast("string").alias("primary_key"), F.lit("u").alias("url")]

    catalogue = table(spark, sf_dir, "customer").select(*keyed_by("c_custkey"), "c_custkey")
    validated = table(spark, sf_dir, "orders").where("o_orderstatus = 'F'").select(
        *keyed_by("o_custkey"), F.col("o_orderkey").alias("run_id"),
        F.sha2(F.col("o_orderkey").cast("string"), 256).alias("s3_blob_key"),
    ).withColumnRenamed("url", "image_url")
    log = table(spark, sf_dir, "events").select(
        *keyed_by("user_id"), F.col("event_id").alias("run_id"), F.col("event_type").alias("status")
    )
    found = assets.serving_status(catalogue, validated, log)
    return found.select("c_custkey", "s3_blob_key", "last_status", "is_downloaded")
