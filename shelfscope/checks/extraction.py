"""Product extraction. Pages are written from the part table, so every expected field is a column of it."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope import fixed_values as fv
from shelfscope.checks.registry import query, spread, table
from shelfscope.functions import arrays
from shelfscope.operators import listings, products

PART = ("p_partkey", "p_name", "p_brand", "p_type", "p_size", "p_retailprice")
DAY, RUN = "2024-02-01", "2024-02-01T00-00-00-000"


def parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows that pages are made of: a few MB of them become pages that take the parsers minutes."""
    return spread(table(spark, sf_dir, "part").select(*PART), "p_partkey")


def text_of(*parts) -> Column:
    """Concatenation; plain strings are markup, columns are values."""
    return F.concat(*[p.cast("string") if isinstance(p, Column) else F.lit(p) for p in parts])


def even_price() -> Column:
    return F.floor("p_retailprice").cast("bigint")


# --- markup site --------------------------------------------------------------------------

DOM_SQL = """
SELECT p_partkey AS item, 'https://www.farfetch.com/ae/shopping/women/bag-item-' || p_partkey || '.aspx' AS url, 'ae' AS country,
  CAST(p_partkey AS VARCHAR) AS portal_itemid, trim(p_name) AS product_name, 'women' AS gender, p_brand AS brand,
  split_part(p_type, ' ', 1) AS category, p_type AS subcategory, CASE WHEN p_size % 7 <> 0 THEN p_retailprice END AS price,
  CASE WHEN p_size % 7 <> 0 THEN 'AED' END AS currency, CASE WHEN p_size % 7 <> 0 THEN '-20%' END AS price_discount,
  p_size % 7 = 0 AS out_of_stock, CASE WHEN p_size % 7 = 0 THEN 'Sold Out' ELSE 'New' END AS primary_label,
  CASE WHEN p_size % 7 <> 0 THEN 'https://img.example/' || p_partkey || '.jpg' END AS image, 'soft, light, ' || p_type AS text FROM part
"""


def dom_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    sold = F.col("p_size") % 7 == 0
    html = text_of(
        "<html><head><meta property='twitter:data1' content='AED ", F.format_number("p_retailprice", 2), "'>",
        "<meta property='og:image' content='https://img.example/", F.col("p_partkey"), ".jpg'></head><body><ol>",
        "<li data-component='BreadcrumbWrapper'><a>Home</a><li data-component='BreadcrumbWrapper'><a>Women</a>",
        "<li data-component='BreadcrumbWrapper'><a>", F.split_part("p_type", F.lit(" "), F.lit(1)), "</a>",
        "<li data-component='BreadcrumbWrapper'><a>", F.col("p_type"), "</a></ol>",
        "<a data-ffref='pp_infobrd' href='#'>", F.col("p_brand"), "</a>",
        "<p data-testid='product-short-description'> ", F.replace("p_name", F.lit(" "), F.lit("  <b> </b>")), " </p>",
        "<p data-component='PriceDiscount'>-20%</p><p data-component='LabelPrimary'>", F.when(sold, "Sold Out").otherwise("New"), "</p>",
        "<div><h4> Highlights </h4><ul><li> soft <li>light</ul><h4>Composition</h4><p>", F.col("p_type"), " </p></div></body></html>",
    )
    url = text_of("https://www.farfetch.com/ae/shopping/women/bag-item-", F.col("p_partkey"), ".aspx?storeid=9")
    return parts(spark, sf_dir).select(url.alias("url"), html.alias("html"))


@query(DOM_SQL)
def dom_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the markup site."""
    found = products.dom_products(dom_pages(spark, sf_dir), RUN, DAY)
    return found.select(
        F.col("portal_itemid").cast("bigint").alias("item"), "url", "country", "portal_itemid", "product_name", "gender", "brand", "category",
        "subcategory", "price", "currency", "price_discount", "out_of_stock", F.array_join("primary_label", "|").alias("primary_label"),
        F.get("image_urls", F.lit(0)).alias("image"), "text",
    )


# --- state site ---------------------------------------------------------------------------

STATE_SQL = """
SELECT 'https://ar.ounass.ae/' || p_partkey || '.html' AS url, 'AR' AS language, 'AE' AS country, 'S' || p_partkey AS portal_itemid,
  p_name AS product_name, p_brand AS brand, CAST(p_size AS VARCHAR) AS brand_id, p_type AS category, p_retailprice AS price, 'AED' AS currency,
  p_size % 2 = 0 AS out_of_stock, CASE WHEN p_size % 2 = 0 THEN 'Out of Stock' ELSE 'NEW' END AS primary_label,
  'img.example/' || p_partkey || '.jpg' AS image, p_type || ' & more' AS design, 'Fits ' || p_size AS fit FROM part WHERE p_size % 5 <> 0
"""


def state_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    tab = "array<struct<tabId:string,html:string>>"
    fit = F.struct(F.lit("sizeAndFit").alias("tabId"), text_of("<i>Fits</i>\n", F.col("p_size"), " ").alias("html"))
    design = F.struct(F.lit("designDetails").alias("tabId"), text_of("<p>", F.col("p_type"), " &amp; more</p>").alias("html"))
    state = F.to_json(F.struct(
        F.lit("new-pdp").alias("routeType"), F.lit("AE").alias("country"), F.lit("AED").alias("currency"),
        F.struct(
            text_of("S", F.col("p_partkey")).alias("visibleSku"), F.col("p_name").alias("name"), F.col("p_brand").alias("designerCategoryName"),
            F.col("p_size").alias("designerId"), F.col("p_type").alias("department"), F.col("p_retailprice").alias("price"),
            F.struct(F.when(F.col("p_size") % 2 == 0, "Out of Stock").otherwise("NEW").alias("value")).alias("badge"),
            F.array(F.struct(text_of("//img.example/", F.col("p_partkey"), ".jpg").alias("oneX"))).alias("images"),
            F.when(F.col("p_size") % 5 == 0, F.array(fit).cast(tab)).otherwise(F.array(fit, design).cast(tab)).alias("contentTabs"),
        ).alias("pdp"),
    ))
    html = text_of("<html><script>var a = 1;</script><script>\nwindow.initialState = ", state, ";\nwindow.b = {};</script></html>")
    url = text_of("https://ar.ounass.ae/", F.col("p_partkey"), ".html")
    return parts(spark, sf_dir).select(url.alias("url"), html.alias("html"))


@query(STATE_SQL)
def state_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Records of the state site; pages without all details give none."""
    found = products.state_products(state_pages(spark, sf_dir), RUN, DAY)
    return found.select(
        "url", "language", "country", "portal_itemid", "product_name", "brand", "brand_id", "category", "price", "currency", "out_of_stock",
        F.array_join("primary_label", "|").alias("primary_label"), F.get("image_urls", F.lit(0)).alias("image"),
        F.col("text_parts")["design_details"].alias("design"), F.trim(F.col("text_parts")["size_fit"]).alias("fit"),
    )


@query("SELECT 'https://ar.ounass.ae/' || p_partkey || '.html' AS url, 'no_details' AS reason FROM part WHERE p_size % 5 = 0")
def state_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    return products.state_rejects(state_pages(spark, sf_dir))


# --- API site -----------------------------------------------------------------------------

API_PAGE_SQL = """
SELECT 'https://www.levelshoes.com/ab' || p_partkey || '-red.html' AS url, 'ae' AS country,
  CASE p_size % 4 WHEN 0 THEN 'S-' || p_partkey WHEN 1 THEN 'M-' || p_partkey WHEN 2 THEN 'J-' || p_partkey ELSE 'AB' || p_partkey || '-RED' END AS portal_itemid,
  CASE WHEN p_size % 4 = 0 THEN p_name ELSE 'One two three four' END AS product_name,
  CASE WHEN p_size % 4 = 0 THEN 'Women' ELSE 'Kids' END AS gender, CASE WHEN p_size % 4 = 0 THEN p_brand ELSE 'One two three' END AS brand,
  CASE WHEN p_size % 4 = 0 THEN 'bags' END AS category, CASE WHEN p_size % 4 = 0 THEN 'mini-' || p_size END AS subcategory,
  CASE p_size % 4 WHEN 0 THEN CAST(floor(p_retailprice) AS DOUBLE) WHEN 1 THEN 2650.0 WHEN 2 THEN 47.0 END AS price,
  CASE p_size % 4 WHEN 0 THEN 'USD' WHEN 1 THEN 'AED' WHEN 2 THEN 'in stock' ELSE 'Out of Stock' END AS currency,
  CASE WHEN p_size % 4 = 2 THEN '25% OFF' END AS price_discount, p_size % 4 = 3 AS out_of_stock,
  CASE WHEN p_size % 4 = 1 THEN 'VEGAN|HANDMADE' WHEN p_size % 4 = 2 THEN 'LAST PAIRS' END AS badges,
  CASE p_size % 4 WHEN 0 THEN 'https://img.example/j' || p_partkey WHEN 1 THEN 'https://img.example/o' || p_partkey WHEN 3 THEN 'https://img.example/x_1.jpg' END AS image,
  CASE WHEN p_size % 4 = 0 THEN 'Cork insole' || chr(10) || 'Two straps ' || p_size || chr(10) || 'Woven as ' || p_type ELSE '' END AS text,
  CASE WHEN p_size % 4 = 0 THEN CAST(p_size AS BIGINT) END AS level_category_id FROM part
"""


def api_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Four page layouts, so that every fallback of every field is used somewhere."""
    kind = F.col("p_size") % 4
    key = F.col("p_partkey")
    product = F.to_json(F.struct(
        F.lit("Product").alias("@type"), text_of(" S-", key).alias("sku"), F.col("p_name").alias("name"),
        F.struct(F.col("p_brand").alias("name")).alias("brand"), F.col("p_size").cast("string").alias("category"),
        F.array(text_of("https://img.example/j", key)).alias("image"),
        F.struct(F.col("p_retailprice").alias("price"), F.lit("USD ").alias("priceCurrency")).alias("offers"),
    ))
    trail = text_of(
        '{"@graph":[{"@type":"BreadcrumbList","itemListElement":[{"position":2,"name":" Women ","item":"https://x.example/sale/women"},',
        '{"position":3,"item":{"@id":"https://x.example/sale/Women/bags/mini-', F.col("p_size"), '"}}]}]}',
    )
    flat_trail = '[{"@type":"BreadcrumbList","itemListElement":[{"position":"2","name":" Women "}]}, 7]'
    with_json = text_of(
        '<script type="application/ld+json">not json</script><script type="application/ld+json">', product, "</script>",
        '<script type="application/ld+json">', trail, '</script><script type="application/ld+json">', flat_trail, "</script>",
        '<div class="accordion-root"><ul data-testid="lineitems"><li> Cork insole <li>Two  straps ', F.col("p_size"), '</ul><button>+<span>Product  Details</span></button>',
        '<div class="accordion-details-root"><p>Woven as</p><p> ', F.col("p_type"), "</p></div></div>",
    )
    with_meta = text_of(
        '<meta property="product:retailer_item_id" content=" M-', key, ' "><meta property="product:price:amount" content="2,650 AED">',
        '<meta property="product:price:currency" content="AED"><meta property="og:image" content="https://img.example/o', key, '">',
        f'<div class="{" ".join(fv.BADGE_RIBBON_CLASSES)}"><span class="badge"> VEGAN<svg><text>leaf</text></svg></span>',
        '<b></b><span class="badge-large">HANDMADE </span><span class="badge">VEGAN</span></div>',
    )
    with_script = text_of(
        '<script>{"sku" : "J-', key, '", "discountPercentage":"25% OFF"}</script><meta name="twitter:data1" content="47 AED">',
        '<meta name="twitter:data2" content="in stock"><span class="my-badge">LAST PAIRS</span>',
    )
    with_url = text_of(
        '<meta name="twitter:label2" content="Availability"><meta name="twitter:data2" content="Out of Stock">',
        '<img src="https://img.example/x_1.jpg">',
    )
    common = '<meta property="og:title" content="One two three four for Women - x"><nav><ul><li><a>Home</a></li><li><a> Kids </a></li></ul></nav>'
    html = text_of("<html>", F.when(kind == 0, with_json).when(kind == 1, with_meta).when(kind == 2, with_script).otherwise(with_url), common, "</html>")
    url = text_of("https://www.levelshoes.com/ab", key, "-red.html")
    return parts(spark, sf_dir).select(url.alias("url"), html.alias("html"))


def shown(records: DataFrame) -> DataFrame:
    return records.select(
        "url", "country", "portal_itemid", "product_name", "gender", "brand", "category", "subcategory", "price", "currency", "price_discount",
        "out_of_stock", F.array_join("primary_label", "|").alias("badges"), F.get("image_urls", F.lit(0)).alias("image"), "text", "level_category_id",
    )


@query(API_PAGE_SQL)
def api_page_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page-side records of the API site: JSON-LD, meta, script, image and URL legs."""
    return shown(products.api_page_records(api_pages(spark, sf_dir), RUN, DAY))


def api_payloads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One listing per brand, one item per page; a page of the largest size is empty and ends the listing."""
    item = F.struct(
        text_of(F.col("p_name")).alias("name"), F.lit("Red").alias("color"), text_of(even_price(), " AED").alias("originalPrice"),
        F.struct(text_of("https://www.levelshoes.com/ab", F.col("p_partkey"), "-red.html").alias("url")).alias("action"),
        F.struct(
            text_of("I", F.col("p_partkey")).alias("item_id"), F.col("p_brand").alias("brand"), F.lit("Shoes").alias("category1"),
            F.lit("Flats").alias("category2"), F.lit("women").alias("gender"), F.col("p_retailprice").alias("price"),
        ).alias("analytics"),
        F.array(F.struct(F.lit("NEW").alias("text"))).alias("badges"),
    )
    empty = F.lit('{"products": []}')
    payload = F.when(F.col("p_size") == 50, empty).otherwise(F.to_json(F.struct(F.array(item).alias("products"))))
    return parts(spark, sf_dir).select(F.col("p_brand").alias("url"), F.col("p_partkey").alias("page"), payload.alias("payload"))


ITEMS_SQL = """
i AS (SELECT p.* FROM part p LEFT JOIN (SELECT p_brand, min(p_partkey) AS stop FROM part WHERE p_size = 50 GROUP BY p_brand) s
      ON p.p_brand = s.p_brand WHERE p_size <> 50 AND (stop IS NULL OR p_partkey < stop))
"""


@query(f"""WITH {ITEMS_SQL}
SELECT 'https://www.levelshoes.com/ab' || p_partkey || '-red.html' AS url, 'EN' AS language, 'I' || p_partkey AS portal_itemid, p_name AS product_name,
  p_brand AS brand, 'red' AS color, 'shoes' AS category, p_retailprice AS price, 'AED' AS currency, 'NEW' AS badges FROM i
""")
def api_listing_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Items of numbered listing pages up to the first empty page."""
    found = products.api_item_records(listings.api_items(api_payloads(spark, sf_dir)), RUN, DAY)
    return found.select(
        "url", "language", "portal_itemid", "product_name", "brand", "color", "category", "price", "currency",
        F.array_join("primary_label", "|").alias("badges"),
    )


@query(f"""WITH {ITEMS_SQL}, p AS ({API_PAGE_SQL}),
g AS (SELECT 'https://www.levelshoes.com/ab' || p_partkey || '-red.html' AS url, 'I' || p_partkey AS item, p_name, p_brand, p_retailprice FROM i)
SELECT p.url, coalesce(g.item, p.portal_itemid) AS portal_itemid, coalesce(g.p_name, p.product_name) AS product_name,
  CASE WHEN g.url IS NULL THEN p.gender ELSE 'women' END AS gender, CASE WHEN g.url IS NULL THEN p.category ELSE 'shoes' END AS category,
  coalesce(g.p_retailprice, p.price) AS price, p.out_of_stock, p.image, p.text FROM p LEFT JOIN g ON p.url = g.url
""")
def api_products(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Listing items completed by their pages."""
    items = listings.api_items(api_payloads(spark, sf_dir))
    return shown(products.api_products(items, api_pages(spark, sf_dir), RUN, DAY)).select(
        "url", "portal_itemid", "product_name", "gender", "category", "price", "out_of_stock", "image", "text"
    )


# --- listing pages ------------------------------------------------------------------------

LINKS_SQL = "l AS (SELECT page_id, url, unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) AS link FROM pages)"


def page_link_column() -> Column:
    return F.regexp_extract_all(F.col("html"), F.lit('href="([^"]*)"'), F.lit(1))


def dom_listing_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Markup listings with the links of each page and page totals up to 29."""
    offers = F.transform(page_link_column(), lambda u: F.named_struct(F.lit("offers"), F.named_struct(F.lit("url"), u)))
    block = F.to_json(F.struct(F.lit("ItemList").alias("@type"), offers.alias("itemListElement")))
    html = text_of(
        '<script type="application/ld+json">[{"@type":"Other"}, ', block, "]</script><div data-component='Pagination'><b>",
        "<span data-component='PaginationLabel'>1 of ", F.col("page_id") % 30, "</span></b></div>",
    )
    return table(spark, sf_dir, "pages").select("page_id", "url", "html").select(text_of(F.col("url"), "/items.aspx").alias("url"), html.alias("html"))


@query(f"""WITH {LINKS_SQL}, b AS (SELECT page_id, url || '/items.aspx' AS url, CAST(page_id % 30 AS INTEGER) AS total, url LIKE '%?%' AS has_query FROM pages)
SELECT b.url, 'https://www.farfetch.com' || link AS found_url, 'product' AS kind FROM l JOIN b ON l.page_id = b.page_id WHERE link LIKE '/%'
UNION ALL SELECT url, url, 'listing' FROM b WHERE total > 1 AND NOT has_query
UNION ALL SELECT url, url || '?page=' || g, 'listing' FROM (SELECT url, unnest(generate_series(2, least(total, 4))) AS g FROM b WHERE total > 1 AND NOT has_query)
""")
def dom_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product URLs and further pages of the markup site's listings."""
    return listings.expand_dom_listings(dom_listing_pages(spark, sf_dir), limit=4)


@query(f"""WITH {LINKS_SQL}, b AS (SELECT page_id, url || '/items.aspx' AS url, CAST(page_id % 30 AS INTEGER) AS total, url LIKE '%?%' AS has_query FROM pages)
SELECT b.url, 'https://www.farfetch.com' || link AS found_url, 'product' AS kind FROM l JOIN b ON l.page_id = b.page_id WHERE link LIKE '/%'
UNION ALL SELECT url, url, 'listing' FROM b WHERE total > 1 AND NOT has_query
UNION ALL SELECT url, url || '?page=' || g, 'listing' FROM (SELECT url, unnest(generate_series(2, total)) AS g FROM b WHERE total > 1 AND NOT has_query)
""")
def dom_listings_unlimited(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same with all further pages."""
    return listings.expand_dom_listings(dom_listing_pages(spark, sf_dir))


@query(f"""WITH {LINKS_SQL}, b AS (SELECT page_id, url, split_part(url, '?', 1) AS base, CAST(page_id % 4 AS INTEGER) AS total, page_id % 3 = 0 AS first FROM pages)
SELECT DISTINCT b.page_id, split_part(b.url, '://', 1) || '://' || split_part(b.url, '/', 3) || '/' || link || '.html' AS found_url, 'product' AS kind
  FROM l JOIN b ON l.page_id = b.page_id WHERE NOT first AND link <> ''
UNION ALL SELECT page_id, base || '?fh_sort_by=-newness_ae&p=' || g, 'listing' FROM (SELECT page_id, base, unnest(generate_series(0, total - 1)) AS g FROM b WHERE first)
""")
def state_listings(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product URLs of listing payloads with main and variant slugs; unsorted first pages only lead to sorted ones."""
    links = page_link_column()
    variant = F.array(F.struct(F.array(
        F.struct(F.struct(F.get(links, F.lit(0)).alias("slug")).alias("attributeSpecificProperties")),
        F.struct(F.struct(F.lit(None).cast("string").alias("slug")).alias("attributeSpecificProperties")),
    ).alias("options")))
    hits = F.transform(links, lambda u: F.named_struct(F.lit("slug"), u, F.lit("configurableAttributes"), variant))
    payload = F.to_json(F.struct(
        F.when(F.col("page_id") % 3 == 0, 0).otherwise(1).alias("page"), F.lit("plp").alias("routeType"),
        F.struct((F.col("page_id") % 4).alias("totalPages")).alias("pagination"), hits.alias("hits"),
    ))
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html").select("page_id", "url", payload.alias("html"))
    found = listings.expand_state_listings(pages.withColumn("url", F.concat_ws(" ", "url", F.col("page_id").cast("string"))))
    return found.select(
        F.substring_index("url", " ", -1).cast("bigint").alias("page_id"), F.regexp_replace("found_url", r" \d+(?=\?)", "").alias("found_url"), "kind"
    )


@query("SELECT page_id, link FROM (SELECT page_id, unnest(regexp_extract_all(html, 'href=\"([^\"]*)\"', 1)) AS link FROM pages) WHERE link LIKE '/%'")
def item_list_offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """ItemList blocks whose offers are lists; relative URLs only."""
    offers = F.transform(page_link_column(), lambda u: F.named_struct(F.lit("url"), u))
    block = F.to_json(F.struct(F.lit("ItemList").alias("@type"), F.array(F.struct(offers.alias("offers"))).alias("itemListElement")))
    pages = table(spark, sf_dir, "pages").select("page_id", "url", "html").select("page_id", F.explode(arrays.item_list_urls(block)).alias("u"))
    return pages.select("page_id", F.replace("u", F.lit("https://www.farfetch.com"), F.lit("")).alias("link"))
