"""Stored pages followed to the end: over links of the page table, and over the listings of the state site."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope import fixed_values as fv
from shelfscope.checks.registry import query, table
from shelfscope.operators import crawl, listings

#: Page i links to 2i + 1 and 2i + 2 (a tree), to i div 3 (cycles) and to page 0, which so all pages link to; every seventh page also
#: to an address that is not stored.
LINKS_SQL = """
SELECT page_id, 2 * page_id + 1 AS target FROM pages UNION ALL SELECT page_id, 2 * page_id + 2 FROM pages
UNION ALL SELECT page_id, page_id // 3 FROM pages UNION ALL SELECT page_id, 0 FROM pages
UNION ALL SELECT page_id, -page_id - 1 FROM pages WHERE page_id % 7 = 0
"""


@query(f"""
WITH RECURSIVE links AS (SELECT DISTINCT * FROM ({LINKS_SQL}))
, reached(page, round) AS (
    SELECT page_id, 0 FROM pages WHERE page_id % 100 = 17
    UNION SELECT target, round + 1 FROM reached JOIN links ON page_id = page WHERE round < 40
)
SELECT 'https://crawl.example/' || page AS url, min(round)::INT AS round, page IN (SELECT page_id FROM pages) AS opened FROM reached GROUP BY page
""")
def frontier_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages that links lead to from every hundredth page on, and in which round."""
    pages = table(spark, sf_dir, "pages")

    def address(number):
        return F.concat(F.lit("https://crawl.example/"), number.cast("string"))

    i = F.col("page_id")
    lost = F.when(i % 7 == 0, F.concat(F.lit("<a href='"), address(-i - 1), F.lit("'>gone</a>"))).otherwise("")
    anchors = F.concat(*[
        F.concat(F.lit('<a class="x" href="'), address(t), F.lit('">next</a>'))
        for t in (2 * i + 1, 2 * i + 2, F.floor(i / 3), F.lit(0))
    ], lost)
    stored = pages.select("page_id", address(i).alias("url"), F.concat("html", anchors).alias("html"))

    def expand(opened: DataFrame) -> DataFrame:
        links = opened.select(F.explode(listings.link_targets(F.col("html"))).alias("found_url"))
        return links.where(F.col("found_url").startswith("https://crawl.example/"))

    return crawl.follow_pages(stored.where("page_id % 100 = 17").select("url"), stored, expand)


@query(f"""
WITH brands AS (SELECT p_brand, '{fv.LISTING_SORT_VALUE}' AS sorted, count(DISTINCT p_size) AS total FROM part GROUP BY p_brand)
, numbered AS (SELECT DISTINCT p_brand, p_size, dense_rank() OVER (PARTITION BY p_brand ORDER BY p_size) - 1 AS page FROM part)
, bases AS (SELECT *, 'https://www.ounass.ae/' || lower(replace(p_brand, '#', '-')) AS base FROM brands)
SELECT base AS url, 0 AS round, TRUE AS opened FROM bases
UNION ALL SELECT base || '?{fv.LISTING_SORT_KEY}=' || sorted || '&p=' || page, 1, TRUE FROM bases JOIN numbered USING (p_brand)
UNION ALL SELECT DISTINCT 'https://www.ounass.ae/' || p_partkey || '.html', 2, p_partkey % 4 <> 0 FROM part
""")
def listing_closure(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Seed listings to their sorted pages, and these to their products; some product pages are not stored."""
    part = table(spark, sf_dir, "part").select("p_partkey", "p_brand", "p_size")
    base = F.concat(F.lit("https://www.ounass.ae/"), F.lower(F.replace("p_brand", F.lit("#"), F.lit("-"))))
    sizes = part.select("p_brand", "p_size").distinct()
    totals = part.groupBy("p_brand").agg(F.count_distinct("p_size").alias("total"))
    # numbers by counting smaller sizes, of which there are few per brand
    smaller = sizes.withColumnRenamed("p_size", "other")
    pages = (
        sizes.join(smaller, "p_brand").groupBy("p_brand", "p_size").agg(F.count_if(F.col("other") < F.col("p_size")).alias("page"))
        .join(totals, "p_brand")
    )
    hits = part.groupBy("p_brand", "p_size").agg(F.collect_list(F.struct(F.col("p_partkey").cast("string").alias("slug"))).alias("hits"))
    payload = F.to_json(F.struct(
        F.col("page"), F.lit("PLP").alias("routeType"), F.struct(F.col("total").alias("totalPages")).alias("pagination"), F.col("hits")))
    listed = pages.join(hits, ["p_brand", "p_size"])
    sort = f"?{fv.LISTING_SORT_KEY}={fv.LISTING_SORT_VALUE}&p="
    stored = (
        listed.select(F.concat(base, F.lit(sort), F.col("page").cast("string")).alias("url"), payload.alias("html"))
        .union(listed.where("page = 0").select(base.alias("url"), payload.alias("html")))
        .union(part.where("p_partkey % 4 <> 0").select(F.concat(F.lit("https://www.ounass.ae/"), F.col("p_partkey").cast("string"), F.lit(".html")), F.lit("<html>")))
    )
    return crawl.follow_pages(part.select(base.alias("url")), stored, listings.expand_state_listings)
