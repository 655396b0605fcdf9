"""Array and listing functions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfscope import fixed_values as fv
from shelfscope.functions import jsons, urls
from shelfscope.functions.text import last_word, none_if_empty


def no_texts() -> Column:
    return F.array().cast("array<string>")


def nth(arr: Column, n: int) -> Column:
    """0-based, NULL when the array is short."""
    return F.get(arr, F.lit(n))


def crumb_category(crumbs: Column) -> Column:
    return nth(crumbs, 2)


def crumb_subcategory(crumbs: Column) -> Column:
    return nth(crumbs, 3)


def numbers(first: Column, last: Column) -> Column:
    """first..last, empty when last < first (a bare `sequence` would count down)."""
    return F.when(last >= first, F.sequence(first, F.greatest(first, last))).otherwise(F.array().cast("array<int>"))


def dom_page_urls(url: Column, total: Column, limit: int | None = None) -> Column:
    """Page 1 plus pages 2..N of a listing; nothing at all for a single page."""
    capped = F.least(total, F.lit(limit)) if limit else total
    more = F.transform(numbers(F.lit(2), capped), lambda p: F.concat(url, F.lit("?page="), p.cast("string")))
    return F.when(total > 1, F.concat(F.array(url), more)).otherwise(no_texts())


def state_page_urls(url: Column, total: Column) -> Column:
    """All pages 0..N-1 from an unsorted listing, 1..N-1 from a sorted one."""
    base = F.concat(urls.before_query(url), F.lit(f"?{fv.LISTING_SORT_KEY}={fv.LISTING_SORT_VALUE}&p="))
    start = F.when(url.contains(fv.LISTING_SORT_VALUE), F.lit(1)).otherwise(F.lit(0))
    pages = F.transform(numbers(start, total - 1), lambda p: F.concat(base, p.cast("string")))
    return F.when(total.isNotNull(), pages).otherwise(no_texts())


def state_product_urls(payload: Column, url: Column) -> Column:
    """Distinct sorted product URLs of main and variant slugs."""
    empty = no_texts()
    main = F.transform(payload["hits"], lambda h: h["slug"])
    variants = F.flatten(
        F.transform(
            payload["hits"],
            lambda h: F.coalesce(
                F.flatten(
                    F.transform(
                        h["configurableAttributes"],
                        lambda a: F.coalesce(
                            F.transform(a["options"], lambda o: o["attributeSpecificProperties"]["slug"]), empty
                        ),
                    )
                ),
                empty,
            ),
        )
    )
    slugs = F.array_distinct(
        F.filter(F.concat(F.coalesce(main, empty), F.coalesce(variants, empty)), lambda s: s != "")
    )
    return F.array_sort(
        F.transform(slugs, lambda s: F.concat(urls.scheme_and_host(url), F.lit("/"), s, F.lit(".html")))
    )


def item_list_urls(block: Column) -> Column:
    """Product URLs of an ItemList block whose offers are one object or a list; relative URLs only."""

    def list_in(value: Column) -> Column:
        lists = F.filter(jsons.as_list(value), lambda d: jsons.path_text(d, "$['@type']") == "ItemList")
        return F.coalesce(nth(lists, 0), value)

    top = jsons.bind(jsons.parse_whole(block), list_in)
    elements = F.try_variant_get(top, "$.itemListElement", jsons.ANY_LIST)

    def offer_urls(element: Column) -> Column:
        offers = jsons.path_value(element, "$.offers")
        many = F.transform(jsons.as_list(offers), lambda o: jsons.path_text(o, "$.url"))
        return F.coalesce(many, F.array(jsons.path_text(offers, "$.url")))

    found = F.filter(F.flatten(F.transform(elements, offer_urls)), lambda u: u.startswith("/"))
    return F.coalesce(F.transform(found, lambda u: F.concat(F.lit(fv.SITE_HOME[fv.DOM_SITE]), u)), no_texts())


def api_item_fields(item: Column) -> dict[str, Column]:
    """Fields of one listing API item, in the order of the product record."""
    tags = item["analytics"]
    url = none_if_empty(item["action"]["url"])
    badges = item["badges"]
    return {
        "url": url,
        "language": urls.api_language(url),
        "country": urls.api_country(url),
        "portal_itemid": tags["item_id"],
        "product_name": none_if_empty(item["name"]),
        "gender": tags["gender"],
        "brand": tags["brand"],
        "color": none_if_empty(F.lower(item["color"])),
        "category": F.lower(tags["category1"]),
        "subcategory": F.lower(tags["category2"]),
        "price": tags["price"],
        "currency": none_if_empty(last_word(none_if_empty(item["originalPrice"]))),
        "price_discount": none_if_empty(item["discountPercentage"]),
        "primary_label": F.when(F.size(badges) > 0, F.transform(badges, lambda b: b["text"])),
        "image_urls": F.when(
            F.size(item["imagePreviewGallery"]) > 0, F.array(nth(item["imagePreviewGallery"], 0)["url"])
        ),
    }


def missing_names(checks: dict[str, Column]) -> Column:
    """Names whose column is NULL or ''."""
    return F.array_compact(F.array(*[F.when(F.coalesce(c == "", F.lit(True)), F.lit(n)) for n, c in checks.items()]))
