"""Product records of the three site shapes, and the typed record they share.

Each site function takes pages (url, html) and returns the shared record, columns a site does
not have as NULL. Which function serves which site is a dictionary (`EXTRACTORS`).
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfscope import fixed_values as fv
from shelfscope import schemas
from shelfscope.functions import arrays, jsons, markup, text, urls
from shelfscope.functions.rows import compute_once
from shelfscope.functions.text import none_if_empty, strip
from shelfscope.operators.keyed import first_wins, join_spread


def shared_record(rows: DataFrame, fields: dict[str, Column]) -> DataFrame:
    """Projects to the shared schema; missing fields become typed NULLs."""
    columns = []
    for part in schemas.PRODUCT.split(", "):
        name, kind = part.split()
        columns.append(fields.get(name, F.lit(None)).cast(kind).alias(name))
    return rows.select(*columns)


def _run(site: str, run_id: str, crawl_date: str) -> dict[str, Column]:
    return {"run_id": F.lit(run_id), "site": F.lit(site), "crawl_date": F.lit(crawl_date)}


# --- fields in page markup ----------------------------------------------------------------


def dom_products(pages: DataFrame, run_id: str, crawl_date: str) -> DataFrame:
    """Product pages of the markup site. Sold-out pages have no price, discount or image."""
    parsed = pages.where(urls.dom_is_product(F.col("url"))).withColumn("s", markup.page_signals(F.col("html"))).drop("html")
    return shared_record(parsed, {**_run(fv.DOM_SITE, run_id, crawl_date), **dom_fields(F.col("s"), F.col("url"))})


def dom_fields(s: Column, url: Column) -> dict[str, Column]:
    sold_out = text.is_sold_out(s["label_text"])
    price = text.price_and_currency(markup.meta_content(s, ("property", "twitter:data1")))
    image = F.coalesce(markup.meta_content(s, ("property", "og:image")), F.lit(""))
    on_sale = ~sold_out
    return {
        "url": urls.before_query(url),
        "country": urls.dom_country(url),
        "portal_itemid": urls.dom_item_id(url),
        "product_name": none_if_empty(s["short_description"]),
        "gender": urls.dom_gender(url),
        "brand": s["brand_text"],
        "category": arrays.crumb_category(s["crumbs"]),
        "subcategory": arrays.crumb_subcategory(s["crumbs"]),
        "price": F.when(on_sale, price["price"]),
        "currency": F.when(on_sale, price["currency"]),
        "price_discount": F.when(on_sale, s["discount_text"]),
        "out_of_stock": sold_out,
        "primary_label": F.when(s["label_text"].isNotNull(), F.array(s["label_text"])),
        "image_urls": F.when(on_sale & (image != ""), F.array(image)),
        "text": text.join_details(s["highlights"], s["composition"]),
    }


# --- fields in an embedded state object -----------------------------------------------------


def state_products(pages: DataFrame, run_id: str, crawl_date: str) -> DataFrame:
    """Product pages of the state site. Pages without a readable, complete state give no record."""
    found = pages.where(urls.state_is_product(F.col("url"))).select("url", "html")
    parsed = compute_once(found, {"state": markup.embedded_state(F.col("html"))}).select("url", "state")
    parsed = compute_once(parsed, state_tabs(F.col("state")))
    complete = parsed.where("design IS NOT NULL AND fit IS NOT NULL").withColumns(
        {"design": markup.plain_text(F.col("design")), "fit": markup.plain_text(F.col("fit"))}
    )
    fields = state_fields(F.col("state"), F.col("url"), F.col("design"), F.col("fit"))
    return shared_record(complete, {**_run(fv.STATE_SITE, run_id, crawl_date), **fields})


def state_tabs(state: Column) -> dict[str, Column]:
    tabs = F.try_variant_get(state, "$.pdp.contentTabs", "array<struct<tabId:string,html:string>>")

    def tab_html(tab_id: str) -> Column:
        return F.get(F.filter(tabs, lambda t: t["tabId"] == tab_id), F.lit(0))["html"]

    return {"design": tab_html("designDetails"), "fit": tab_html("sizeAndFit")}


def state_fields(st: Column, url: Column, design: Column, fit: Column) -> dict[str, Column]:
    def read(path: str) -> Column:
        return jsons.path_text(st, path)

    label = read("$.pdp.badge.value")
    image = none_if_empty(F.split_part(read("$.pdp.images[0].oneX"), F.lit("//"), F.lit(2)))
    return {
        "url": url,
        "language": urls.state_language(url),
        "country": read("$.country"),
        "portal_itemid": read("$.pdp.visibleSku"),
        "product_name": read("$.pdp.name"),
        "gender": read("$.pdp.gender"),
        "brand": read("$.pdp.designerCategoryName"),
        "brand_id": read("$.pdp.designerId"),
        "color": read("$.pdp.colorInEnglish"),
        "category": read("$.pdp.department"),
        "subcategory": read("$.pdp.class"),
        "price": jsons.path_double(st, "$.pdp.price"),
        "currency": read("$.currency"),
        "price_discount": read("$.pdp.discountPercent"),
        "out_of_stock": jsons.sold_out(st),
        "primary_label": F.when(label.isNotNull(), F.array(label)),
        "image_urls": F.when(image.isNotNull(), F.array(image)),
        "text_parts": F.create_map(F.lit("design_details"), design, F.lit("size_fit"), fit),
    }


def state_rejects(pages: DataFrame) -> DataFrame:
    """Product pages of the state site that give no record, with the reason."""
    pages = pages.where(urls.state_is_product(F.col("url")))
    state = markup.embedded_state(F.col("html"))
    ids = F.transform(jsons.as_list(jsons.path_value(F.col("state"), "$.pdp.contentTabs")), lambda t: jsons.path_text(t, "$.tabId"))
    reason = F.when(F.col("state").isNull(), "no_state").when(
        ~F.coalesce(F.array_contains(ids, "designDetails") & F.array_contains(ids, "sizeAndFit"), F.lit(False)), "no_details"
    )
    parsed = compute_once(pages.select("url", "html"), {"state": state}).select("url", "state")
    return compute_once(parsed, {"reason": reason}).where("reason IS NOT NULL").select("url", "reason")


# --- listing API items completed by page fields ------------------------------------------------


def api_item_records(items: DataFrame, run_id: str, crawl_date: str) -> DataFrame:
    """Items of `listings.api_items` as records; items without a URL cannot be followed and are left out."""
    records = shared_record(items, {**_run(fv.API_SITE, run_id, crawl_date), **arrays.api_item_fields(F.col("item"))})
    return records.where("url IS NOT NULL")


def page_fields(
    signals: Column, product: Column, trails: Column, all_trails: Column, script_text: Column, url: Column
) -> dict[str, Column]:
    """Page-side value of every field: the first of its fallbacks that gives something.

    JSON-LD objects (`product`, `trails`: top level; `all_trails`: also below @graph) and script
    text are read natively; meta, image, crumb and badge texts come from `signals`.
    """
    og_title = markup.meta_content(signals, ("property", "og:title"))
    title_head = F.substring_index(og_title, " for ", 1)

    def ld(path: str) -> Column:
        return strip(markup.first_value(product, path))

    def meta(*wanted: tuple[str, str]) -> Column:
        return none_if_empty(strip(markup.meta_content(signals, *wanted)))

    def whole_amount(c: Column) -> Column:
        return F.substring_index(F.replace(strip(c), F.lit(","), F.lit("")), " ", 1).try_cast("bigint")

    image_token = F.filter(
        F.transform(signals["images"], lambda u: F.upper(F.regexp_extract(u, fv.IMAGE_SKU_PATTERN, 1))),
        lambda t: (t != "") & text.sku_in(t).isNotNull(),
    )
    crumb_items = F.flatten(F.transform(
        trails, lambda b: F.coalesce(F.try_variant_get(b, "$.itemListElement", jsons.ANY_LIST), F.array().cast(jsons.ANY_LIST))
    ))
    second = F.filter(crumb_items, lambda e: (F.try_variant_get(e, "$.position", "int") == 2)
                      & (strip(jsons.path_text(e, "$.name")) != ""))
    nav_gender = F.get(F.filter(F.transform(signals["nav_texts"], strip), lambda t: t.isin(fv.GENDER_CRUMBS)), F.lit(0))
    path_pair = category_pair(all_trails)
    brand_name = F.get(F.filter(F.transform(product, _brand_of), lambda b: b.isNotNull()), F.lit(0))
    brand_guess = F.array_join(F.slice(F.split(text.collapse_spaces(title_head), " "), 1, 3), " ")
    images = F.get(F.filter(F.transform(product, _image_of), lambda u: u.isNotNull()), F.lit(0))
    numbered = F.get(F.filter(signals["img_srcs"], lambda u: F.rlike(u, F.lit(fv.FIRST_IMAGE_PATTERN))), F.lit(0))
    available = F.lower(meta(("name", "product:availability")))
    card = F.lower(meta(("name", "twitter:data2")))
    card_is_stock = F.lower(meta(("name", "twitter:label2"))) == "availability"
    badges = text.clean_badges(F.when(
        F.size(_visible(signals["ribbon_badges"])) > 0, _visible(signals["ribbon_badges"])
    ).otherwise(_visible(signals["badge_spans"])))
    bullets = _visible(F.transform(signals["detail_bullets"], text.collapse_spaces))
    paragraph = text.collapse_spaces(F.array_join(signals["detail_texts"], " "))
    return {
        "url": url,
        "country": urls.api_country(url),
        "portal_itemid": F.coalesce(
            ld("$.sku"),
            meta(("itemprop", "sku"), ("property", "product:retailer_item_id")),
            strip(none_if_empty(F.regexp_extract(script_text, fv.SCRIPT_SKU_PATTERN, 1))),
            F.get(image_token, F.lit(0)),
            text.sku_in(urls.last_segment(url)),
        ),
        "product_name": F.coalesce(ld("$.name"), strip(title_head)),
        "gender": F.coalesce(strip(jsons.path_text(F.get(second, F.lit(0)), "$.name")), nav_gender),
        "brand": F.coalesce(brand_name, brand_guess),
        "category": path_pair["category"],
        "subcategory": path_pair["subcategory"],
        "price": F.coalesce(
            whole_amount(meta(("property", "product:price:amount"))),
            F.get(F.filter(F.transform(product, _offer_price), lambda p: p.isNotNull()), F.lit(0)),
            whole_amount(meta(("name", "twitter:data1"))),
        ),
        "currency": F.coalesce(
            meta(("property", "product:price:currency")), ld("$.offers.priceCurrency"), meta(("name", "twitter:data2"))
        ),
        "price_discount": none_if_empty(F.regexp_extract(script_text, fv.DISCOUNT_PATTERN, 1)),
        "primary_label": badges,
        "image_urls": F.array_compact(F.array(F.coalesce(
            meta(("property", "og:image")), images, meta(("name", "twitter:image")), strip(numbered)
        ))),
        "text": F.when(~signals["details_found"], "").otherwise(F.array_join(F.concat(
            bullets, F.when(paragraph != "", F.array(paragraph)).otherwise(arrays.no_texts())), "\n")),
        "out_of_stock": F.when(available.isNotNull(), available == "out of stock")
        .when(card_is_stock & card.isNotNull(), card == "out of stock").otherwise(F.lit(False)),
        "level_category_id": F.get(F.filter(F.transform(product, _category_id), lambda c: c.isNotNull()), F.lit(0)),
    }


def _visible(texts: Column) -> Column:
    return F.filter(F.transform(texts, text.collapse_spaces), lambda t: t != "")


def _brand_of(product: Column) -> Column:
    brand = jsons.path_value(product, "$.brand")
    name = jsons.truthy_text(jsons.path_value(product, "$.brand.name"))
    return F.coalesce(strip(name), F.when(jsons.is_string(brand), strip(jsons.as_text(brand))))


def _image_of(product: Column) -> Column:
    image = jsons.path_value(product, "$.image")
    return F.coalesce(
        strip(jsons.path_text(F.get(jsons.as_list(image), F.lit(0)), "$")),
        F.when(jsons.is_string(image), strip(jsons.as_text(image))),
    )


def _offer_price(product: Column) -> Column:
    """Whole part of a non-zero price."""
    return F.floor(text.parse_number(jsons.truthy_text(jsons.path_value(product, "$.offers.price")))).cast("bigint")


def _category_id(product: Column) -> Column:
    value = jsons.path_value(product, "$.category")
    digits = strip(jsons.as_text(value))
    is_id = F.rlike(digits, F.lit(r"^-?\d+$")) & (
        (jsons.json_type(value) == "BIGINT") | (jsons.is_string(value) & ~digits.startswith("-"))
    )
    return F.when(is_id, digits.try_cast("bigint"))


def category_pair(trails: Column) -> Column:
    """struct(category, subcategory): the two path segments after men, women or kids in a crumb URL."""

    def pair_of(element: Column) -> Column:
        address = F.coalesce(jsons.path_text(element, "$.item['@id']"), jsons.path_text(element, "$.item"))
        parts = F.filter(F.split(F.lower(urls.url_path(address)), "/"), lambda p: p != "")
        # Positions of a gender segment that has two more segments behind it.
        at = F.filter(
            F.transform(parts, lambda p, i: F.when(p.isin(fv.GENDER_SEGMENTS) & (i + 2 < F.size(parts)), i)),
            lambda i: i.isNotNull(),
        )
        first = F.get(at, F.lit(0))
        return F.when(first.isNotNull(), F.struct(
            F.get(parts, first + 1).alias("category"), F.get(parts, first + 2).alias("subcategory")))

    elements = F.flatten(F.transform(
        trails, lambda b: F.coalesce(F.try_variant_get(b, "$.itemListElement", jsons.ANY_LIST), F.array().cast(jsons.ANY_LIST))
    ))
    return F.get(F.filter(F.transform(elements, pair_of), lambda p: p.isNotNull()), F.lit(0))


def api_page_records(pages: DataFrame, run_id: str, crawl_date: str) -> DataFrame:
    """Product pages of the API site as records, page values only."""
    parsed = pages.select(
        "url", markup.page_signals(F.col("html")).alias("s"), markup.ld_items(markup.ld_json_blocks(F.col("html"))).alias("items"),
        markup.ld_nodes(markup.ld_json_blocks(F.col("html"))).alias("nodes"), F.array_join(markup.scripts(F.col("html")), " ").alias("script_text"),
    )
    parsed = compute_once(parsed, {
        "product": markup.of_type(F.col("items"), "Product"), "trails": markup.of_type(F.col("items"), "BreadcrumbList"),
        "all_trails": markup.of_type(F.col("nodes"), "BreadcrumbList"),
    })
    names = ["s", "product", "trails", "all_trails", "script_text", "url"]
    fields = page_fields(*[F.col(c) for c in names])
    fields["image_urls"] = F.when(F.size(fields["image_urls"]) > 0, fields["image_urls"])
    return shared_record(parsed, {**_run(fv.API_SITE, run_id, crawl_date), **fields})


def fill_missing(base: DataFrame, given: DataFrame, key: str, fields: list[str], spread_by: list[str]) -> DataFrame:
    """Per row of `base` the value of `given` (one row per key) where it has one, else the own value."""
    renamed = given.select(key, *[F.col(c).alias(f"_given_{c}") for c in fields])
    joined = join_spread(base, renamed, [key], spread_by)
    return joined.select(*[
        F.coalesce(f"_given_{c}", c).alias(c) if c in fields else F.col(c) for c in base.columns
    ])


def api_products(items: DataFrame, pages: DataFrame, run_id: str, crawl_date: str) -> DataFrame:
    """API items completed by the page they link to; pages without an item stand on their own.

    Several items may link to one page: the first in listing order counts, as its request is the
    one that is made. The language comes from the item only.
    """
    first = first_wins(
        items.withColumn("target", none_if_empty(F.col("item.action.url"))), ["target"], ["url", "page", "item_no"]
    ).where("is_first")
    given = api_item_records(first, run_id, crawl_date)
    fields = [c for c in schemas.PRODUCT_FIELDS if c != "url"]
    return fill_missing(api_page_records(pages, run_id, crawl_date), given, "url", fields, ["url"])


EXTRACTORS: dict[str, Callable[[DataFrame, str, str], DataFrame]] = {
    fv.DOM_SITE: dom_products,
    fv.STATE_SITE: state_products,
    fv.API_SITE: api_page_records,
}


def extract_products(pages: DataFrame, site: str, run_id: str, crawl_date: str) -> DataFrame:
    """Records of one site's pages by the registered extractor."""
    return EXTRACTORS[site](pages, run_id, crawl_date)


def mixed_products(pages: DataFrame, run_id: str, crawl_date: str) -> DataFrame:
    """(site, url, html) pages of all sites -> records, each by the rules of its site, from one scan.

    A page is parsed once and only in the way of its site; the parsers of the others get NULL. Pages of other sites, or that
    are no product page of their site, give no record.
    """
    site, url = F.col("site"), F.col("url")
    is_dom, is_state, is_api = (site == s for s in (fv.DOM_SITE, fv.STATE_SITE, fv.API_SITE))
    wanted = pages.where((is_dom & urls.dom_is_product(url)) | (is_state & urls.state_is_product(url)) | is_api)
    blocks = markup.ld_json_blocks(F.when(is_api, F.col("html")))
    parsed = wanted.select(
        "site", "url", markup.page_signals(F.when(~is_state, F.col("html"))).alias("s"), markup.ld_items(blocks).alias("items"),
        markup.ld_nodes(blocks).alias("nodes"), F.array_join(markup.scripts(F.when(is_api, F.col("html"))), " ").alias("script_text"),
        F.when(is_state, markup.embedded_state(F.col("html"))).alias("state"),
    )
    parsed = compute_once(parsed, {
        "product": markup.of_type(F.col("items"), "Product"), "trails": markup.of_type(F.col("items"), "BreadcrumbList"),
        "all_trails": markup.of_type(F.col("nodes"), "BreadcrumbList"), **state_tabs(F.col("state")),
    }).where(~is_state | F.col("design").isNotNull() & F.col("fit").isNotNull())
    parsed = parsed.withColumns({"design": markup.plain_text(F.col("design")), "fit": markup.plain_text(F.col("fit"))})
    api = page_fields(*[F.col(c) for c in ("s", "product", "trails", "all_trails", "script_text", "url")])
    api["image_urls"] = F.when(F.size(api["image_urls"]) > 0, api["image_urls"])
    records = {
        fv.DOM_SITE: dom_fields(F.col("s"), url), fv.API_SITE: api,
        fv.STATE_SITE: state_fields(F.col("state"), url, F.col("design"), F.col("fit")),
    }
    kinds = [part.split() for part in schemas.PRODUCT.split(", ")]
    record = F.coalesce(*[
        F.when(site == name, F.struct(*[
            {**_run(name, run_id, crawl_date), **fields}.get(n, F.lit(None)).cast(kind).alias(n) for n, kind in kinds
        ])) for name, fields in records.items()
    ])
    return compute_once(parsed, {"record": record}).select("record.*")
