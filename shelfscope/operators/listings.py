"""Listing pages: product URLs, further pages, the frontier."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscope import fixed_values as fv
from shelfscope import schemas
from shelfscope.functions import arrays, markup, text, urls
from shelfscope.functions.rows import compute_once
from shelfscope.operators.keyed import first_wins, join_spread, not_seen


def page_kinds(pages: DataFrame, site: str) -> DataFrame:
    """Adds `page_kind`: listing, product or other, by URL or body as the site needs it."""
    url, body = F.col("url"), F.col("html")
    tests = {
        fv.DOM_SITE: (urls.dom_is_listing(url), urls.dom_is_product(url)),
        fv.STATE_SITE: (urls.state_is_listing(body), urls.state_is_product(url)),
        fv.API_SITE: (urls.api_is_listing(url), urls.api_is_product(url)),
    }
    listing, product = tests[site]
    return pages.withColumn("page_kind", F.when(listing, "listing").when(product, "product").otherwise("other"))


def expand_dom_listings(pages: DataFrame, limit: int | None = None) -> DataFrame:
    """(url, html) listing pages -> (url, found_url, kind). Only a first page names the other pages."""
    lists = F.filter(markup.ld_json_blocks(F.col("html")), lambda b: b.contains('"@type":"ItemList"'))
    parsed = pages.select(
        "url", arrays.item_list_urls(F.get(lists, F.lit(0))).alias("products"),
        text.last_page_number(markup.page_signals(F.col("html"))["pagination_text"]).alias("total"),
    )
    more = F.when(urls.dom_is_first_page(F.col("url")), arrays.dom_page_urls(F.col("url"), F.col("total"), limit))
    return _found(parsed, F.col("products"), more)


def expand_state_listings(pages: DataFrame) -> DataFrame:
    """(url, html = JSON payload) -> found URLs. An unsorted first page only leads to the sorted pages."""
    parsed = pages.select("url", F.from_json("html", schemas.LISTING_PAYLOAD_STATE).alias("p"))
    first = F.col("p.page") == 0
    sorted_ = F.col("url").contains(fv.LISTING_SORT_VALUE)
    products = F.when(first & ~sorted_, arrays.no_texts()).otherwise(arrays.state_product_urls(F.col("p"), F.col("url")))
    more = F.when(first, arrays.state_page_urls(F.col("url"), F.col("p.pagination.totalPages")))
    return _found(parsed, products, more)


def _found(parsed: DataFrame, products: Column, more: Column) -> DataFrame:
    def tagged(found: Column, kind: str) -> Column:
        return F.transform(
            F.coalesce(found, arrays.no_texts()), lambda u: F.struct(u.alias("found_url"), F.lit(kind).alias("kind"))
        )

    return parsed.select("url", F.inline(F.concat(tagged(products, "product"), tagged(more, "listing"))))


def api_items(payloads: DataFrame) -> DataFrame:
    """(url, page, payload) -> (url, page, item_no, item). Pages count up to the first empty one.

    A payload that cannot be read counts as empty.
    """
    read = F.from_json("payload", schemas.LISTING_PAYLOAD_API)["products"]
    parsed = compute_once(payloads.select("url", "page", "payload"), {"items": read}).drop("payload")
    stops = (
        parsed.where(F.coalesce(F.size("items"), F.lit(0)) <= 0).groupBy("url").agg(F.min("page").alias("stop"))
    )
    return (
        join_spread(parsed, stops, ["url"], ["page"]).where(F.col("stop").isNull() | (F.col("page") < F.col("stop")))
        .select("url", "page", F.posexplode("items").alias("item_no", "item"))
    )


def frontier(found: DataFrame, seen: DataFrame, key: str = "found_url") -> DataFrame:
    """Distinct URLs to request next: not asked for before, not the target of an earlier redirect.

    `seen(url, final_url)`: both the requested and the final address count.
    """
    both = seen.select(F.explode(F.array("url", "final_url")).alias("u")).where("u IS NOT NULL")
    return not_seen(found.select(key).where(F.col(key).isNotNull()).distinct(), both, key, "u", unique=True)


def distinct_targets(responses: DataFrame, position: list[str]) -> DataFrame:
    """Responses whose final address was not reached by an earlier one (redirect aliases)."""
    return first_wins(responses, ["final_url"], position).where("is_first").drop("is_first")


def request_plan(
    seeds: DataFrame, site: str, backend: str = "auto", direct_hosts: tuple[str, ...] = (), page: int = 0
) -> DataFrame:
    """What would be requested and how: route, request kind, delay, headers, API parameters. No fetching."""
    url = F.col("url")
    plan = seeds.withColumns({
        "host": urls.hostname(url),
        "delay": urls.slot_delay(url),
        "headers": urls.site_headers(F.lit(site)),
    })
    if site == fv.STATE_SITE:
        return plan.withColumns({
            "fetch_route": urls.fetch_route(url, backend, direct_hosts), "request_kind": urls.state_request_kind(url),
        }).dropDuplicates(["url"])
    if site == fv.API_SITE:
        # Listings go to the API, product pages are requested as they are, other URLs are left out.
        kind = F.when(urls.api_is_listing(url), "listing_api").when(urls.api_is_product(url), "page")
        return plan.withColumns({
            "fetch_route": F.lit("requests"), "request_kind": kind, "api": urls.api_request(url, F.lit(page)),
        }).where("request_kind IS NOT NULL")
    return plan.withColumns({"fetch_route": F.lit("requests"), "request_kind": F.lit("page")})


def link_targets(html: Column) -> Column:
    """Sorted distinct link targets of a page: href values in double, single or no quotes, names in any case."""
    found = F.regexp_extract_all(html, F.lit(r"""(?i)\shref\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""), F.lit(1))
    return F.array_sort(F.array_distinct(F.transform(found, lambda u: F.regexp_replace(u, r"""^["']|["']$""", ""))))

