"""URL, site, label, number and key functions over whole columns of the tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfscope import fixed_values as fv
from shelfscope.checks.registry import query, table
from shelfscope.functions import arrays, jsons, markup, text, urls
from shelfscope.operators import listings, manifest, verify
from shelfscope.sources import seeds


@query(r"""
SELECT page_id, regexp_extract(url, '^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)', 1) AS host,
  regexp_extract(url, '^[a-z]+://[^/?#]*([^?#;]*)', 1) AS path, split_part(url, '/', 4) AS country,
  split_part(split_part(url, '://', 2), '/', -1) AS tail, split_part(split_part(url, '/', 3), '.', 1) AS sub,
  CASE WHEN regexp_matches(url, '\.(png|gif)$') THEN right(url, 4) ELSE '.jpg' END AS suffix,
  split_part(url, '.', -1) = 'html' AS is_html
FROM pages
""")
def url_parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    url = F.col("url")
    return table(spark, sf_dir, "pages").select(
        "page_id", urls.netloc(url).alias("host"), urls.url_path(url).alias("path"), urls.dom_country(url).alias("country"),
        urls.last_segment(url).alias("tail"), urls.api_subdomain(url).alias("sub"),
        urls.suffix_from_url(url).alias("suffix"), urls.state_is_product(url).alias("is_html"),
    )


@query("""
WITH u AS (SELECT page_id, lang_path, CASE lang_path WHEN 'en' THEN url WHEN 'fr' THEN replace(replace(url, 'http://', '//'), 'https://', '//')
    ELSE replace(replace(url, 'http://', ' /'), 'https://', ' ') END AS raw, url FROM (SELECT *, split_part(url, '/', 4) AS lang_path FROM pages)),
n AS (SELECT page_id, CASE lang_path WHEN 'en' THEN url ELSE 'https://' || split_part(url, '://', 2) END AS norm FROM u)
SELECT page_id, norm, sha1('ounass|' || page_id || '|' || norm) AS job_id,
  'out/ounass/run-1/' || page_id || '_x_' || left(sha1(norm), 10) || '.jpg' AS output_path FROM n
""")
def url_normalise(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Image URLs with and without scheme, their job ids and output paths."""
    url, lang = F.col("url"), urls.segment(F.col("url"), 3)
    bare = F.regexp_replace(url, "^https?://", "")
    slash = F.when(url.startswith("http://"), " /").otherwise(" ")
    raw = F.when(lang == "en", url).when(lang == "fr", F.concat(F.lit("//"), bare)).otherwise(F.concat(slash, bare))
    key = F.col("page_id").cast("string")
    rows = table(spark, sf_dir, "pages").select("page_id", urls.normalize_image_url(raw).alias("norm"))
    norm = F.col("norm")
    path = urls.output_path("out", F.lit(fv.STATE_SITE), F.concat(key, F.lit("/x ")), norm, F.lit(""), F.lit("run-1"))
    return rows.select("page_id", "norm", urls.job_id(F.lit(fv.STATE_SITE), key, norm).alias("job_id"), path.alias("output_path"))


@query(r"""
WITH u AS (SELECT page_id, url, CASE WHEN url LIKE '%.html' THEN 'https://www.shop.example/ae/shopping/women/bag-item-' || page_id || '.aspx?size=1'
   WHEN url LIKE '%/' THEN url || 'items.aspx' WHEN url LIKE '%?page%' THEN split_part(url, '?', 1) || '/items.aspx?page=2' ELSE url END AS d FROM pages)
SELECT page_id, CASE WHEN url LIKE '%.html' THEN 'product' WHEN url LIKE '%/' OR url LIKE '%?page%' THEN 'listing' ELSE 'other' END AS page_kind,
  coalesce(url LIKE '%/', false) AS first_page, CASE WHEN url LIKE '%.html' THEN CAST(page_id AS VARCHAR) END AS item_id,
  CASE WHEN url LIKE '%.html' THEN 'women' END AS gender, CASE WHEN url LIKE '%.html' THEN 'bag-item-' || page_id END AS subfolder,
  split_part(d, '/', 4) AS country FROM u
""")
def dom_page_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page kinds and URL fields of the markup site."""
    url = F.col("url")
    pages = table(spark, sf_dir, "pages").select(
        "page_id", F.when(url.endswith(".html"), F.concat(
            F.lit("https://www.shop.example/ae/shopping/women/bag-item-"), F.col("page_id").cast("string"), F.lit(".aspx?size=1")))
        .when(url.endswith("/"), F.concat(url, F.lit("items.aspx")))
        .when(url.contains("?page"), F.concat(urls.before_query(url), F.lit("/items.aspx?page=2"))).otherwise(url).alias("url"),
        "html",
    )
    kinds = listings.page_kinds(pages, fv.DOM_SITE)
    return kinds.select(
        "page_id", "page_kind", urls.dom_is_first_page(url).alias("first_page"), urls.dom_item_id(url).alias("item_id"),
        urls.dom_gender(url).alias("gender"), urls.dom_subfolder(url).alias("subfolder"), urls.dom_country(url).alias("country"),
    )


@query("""
WITH u AS (SELECT page_id, replace(replace(replace(url, '/en/', '/women/'), '/fr/', '/men/'), '/de/', '/ar/kids/') AS url FROM pages),
f AS (SELECT *, CASE WHEN url LIKE '%/men/%' THEN 'men' WHEN url LIKE '%/women/%' THEN 'women' WHEN url LIKE '%/kids/%' THEN 'kids' END AS gender,
   url LIKE '%.html%' AS html FROM u)
SELECT page_id, gender, CASE WHEN url LIKE '%/ar/%' THEN 'AR' ELSE 'EN' END AS language,
  CASE WHEN split_part(split_part(url, '/', 3), '.', 1) = 'www' THEN 'ae' END AS country,
  CASE WHEN NOT html AND gender IS NOT NULL THEN 'listing' WHEN html AND gender IS NULL THEN 'product' ELSE 'other' END AS page_kind,
  nullif(regexp_extract(url, '/(men|women)/(.+?)(?:\\?|$)', 2), '') AS listing_path FROM f
""")
def api_page_kind(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Page kinds and URL fields of the API site."""
    url = F.col("url")
    for old, new in (("/en/", "/women/"), ("/fr/", "/men/"), ("/de/", "/ar/kids/")):
        url = F.replace(url, F.lit(old), F.lit(new))
    pages = listings.page_kinds(table(spark, sf_dir, "pages").select("page_id", url.alias("url"), "html"), fv.API_SITE)
    url = F.col("url")
    return pages.select(
        "page_id", urls.api_gender(url).alias("gender"), urls.api_language(url).alias("language"),
        urls.api_country(url).alias("country"), "page_kind", urls.api_listing_path(url).alias("listing_path"),
    )


@query("""
SELECT doc_id, CASE lang WHEN 'en' THEN 'level-shoes' WHEN 'fr' THEN 'level-shoes' WHEN 'de' THEN 'ounass' END AS image_site,
  CASE lang WHEN 'en' THEN 'level-shoes' WHEN 'fr' THEN 'level-shoes' WHEN 'de' THEN 'ounass' ELSE '__missing_site__' END AS gate_site,
  CASE lang WHEN 'en' THEN 'https://www.levelshoes.com/' WHEN 'fr' THEN 'https://www.levelshoes.com/' WHEN 'de' THEN 'https://www.ounass.ae/' END AS referer
FROM documents
""")
def site_alias(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Site names with case, padding, aliases and blanks."""
    raw = F.when(F.col("lang") == "en", " Level ").when(F.col("lang") == "fr", "level_shoes").when(F.col("lang") == "de", "OUNASS").otherwise(" \t")
    rows = table(spark, sf_dir, "documents").select("doc_id", raw.alias("site"))
    site = F.col("site")
    return rows.select(
        "doc_id", urls.image_site(site).alias("image_site"), urls.gate_site(site).alias("gate_site"),
        F.try_element_at(urls.site_headers(urls.image_site(site)), F.lit("referer")).alias("referer"),
    )


@query("""
SELECT page_id, CASE WHEN url LIKE 'https://www%' THEN 'EN' WHEN url LIKE 'https://blog%' THEN 'AR' END AS language FROM pages
""")
def state_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language by host of the state site."""
    url = F.regexp_replace(F.regexp_replace("url", r"^https://www[^/]*", "https://www.ounass.ae"), r"^https://blog[^/]*", "https://saudi.ounass.com")
    return table(spark, sf_dir, "pages").select("page_id", urls.state_language(url).alias("language"))


@query("""
SELECT p_partkey, p_retailprice AS price, 'AED' AS currency, CAST(NULL AS DOUBLE) AS bad_price,
  CAST(p_size AS INTEGER) AS last_page, 'AED' AS last_word FROM part
""")
def price_parse(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Prices, pagination labels and currencies from display text."""
    shown = F.format_number("p_retailprice", 2)
    rows = table(spark, sf_dir, "part").select(
        "p_partkey", text.price_and_currency(F.concat(F.lit("AED "), shown)).alias("good"),
        text.price_and_currency(F.concat("p_brand", F.lit(" "), "p_name")).alias("bad"),
        text.last_page_number(F.concat(F.lit("Page 1 of "), F.col("p_size").cast("string"))).alias("last_page"),
        text.last_word(F.concat(shown, F.lit(" AED"))).alias("last_word"),
    )
    return rows.select(
        "p_partkey", F.col("good.price").alias("price"), F.col("good.currency").alias("currency"),
        F.col("bad.price").alias("bad_price"), "last_page", "last_word",
    )


@query("""
SELECT p_partkey, list_aggregate(list_sort(list_distinct([p_brand, p_type, '*'])), 'string_agg', '|') AS badges,
  split_part(p_name, ' ', 1) || ', ' || p_type AS details, 'c-' || p_brand AS category, CAST(NULL AS VARCHAR) AS subcategory,
  replace(p_name, ' ', '_') AS safe_key FROM part
""")
def part_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Badges, detail texts, crumbs and safe keys."""
    brand = F.col("p_brand")
    badges = F.array(
        F.concat(F.lit("★ "), brand), F.lit("  "), F.col("p_type"), F.concat(F.lit(" *"), brand), F.lit("*"), F.concat(brand, F.lit(" "))
    )
    crumbs = F.array(F.lit("Home"), F.lit("Women"), F.concat(F.lit("c-"), brand))
    return table(spark, sf_dir, "part").select(
        "p_partkey", F.array_join(F.array_sort(text.clean_badges(badges)), "|").alias("badges"),
        text.join_details(F.array(F.concat(F.lit(" "), F.split_part("p_name", F.lit(" "), F.lit(1)))), F.col("p_type")).alias("details"),
        arrays.crumb_category(crumbs).alias("category"), arrays.crumb_subcategory(crumbs).alias("subcategory"),
        text.safe_primary_key(F.concat(F.lit(" "), F.replace("p_name", F.lit(" "), F.lit("/")))).alias("safe_key"),
    )


@query("""
SELECT event_id, event_type IN ('view', 'purchase', 'error', 'signup') AS is_image,
  CASE event_type WHEN 'view' THEN '.jpg' WHEN 'purchase' THEN '.webp' END AS suffix FROM events
""")
def content_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.col("event_type")
    ct = F.when(kind == "view", "image/JPEG; charset=x").when(kind == "purchase", " Image/webp ").when(kind == "click", "text/html").when(kind == "error", "")
    rows = table(spark, sf_dir, "events").select("event_id", ct.alias("ct"))
    return rows.select(
        "event_id", text.is_image_content_type(F.col("ct")).alias("is_image"), urls.suffix_from_content_type(F.col("ct")).alias("suffix")
    )


@query("""
SELECT o_orderkey, lower(regexp_replace(regexp_replace(o_orderpriority, '[^a-zA-Z0-9]+', '_', 'g'), '^_+|_+$', '', 'g')) AS slug,
  o_orderpriority AS site, strftime(o_orderdate, '%Y-%m-%d') AS dt, CAST(o_orderkey AS VARCHAR) AS run_id,
  'verify_manifest' AS route, sha256(CAST(o_orderkey AS VARCHAR)) AS sha, 'bucket-x' AS bucket,
  'out/' || strftime(o_orderdate, '%Y/%m/%d') || '/' || o_orderkey || '/f' AS basename FROM orders
""")
def storage_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run keys built, encoded as events carry them, decoded and parsed again."""
    prefix = "bronze/dev/crawls/metadata/"
    run = F.col("o_orderkey").cast("string")
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    key = urls.run_key(prefix, F.col("o_orderpriority"), day, run, "manifest.json")
    rows = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderpriority", day.alias("day"), run.alias("run"), F.url_encode(key).alias("event_key")
    )
    decoded = urls.decode_event_key(F.col("event_key"))
    parsed = urls.parse_run_key(decoded, prefix)
    blob = urls.blob_key("images/by-hash/", F.sha2(F.col("run"), 256), F.lit(".jpg"))
    return rows.select(
        "o_orderkey", F.regexp_extract(urls.table_slug(F.col("o_orderpriority")), "^bronze_(.*)_raw$", 1).alias("slug"),
        parsed["site"].alias("site"), parsed["dt"].alias("dt"), parsed["run_id"].alias("run_id"),
        verify.route_event(decoded).alias("route"), urls.sha_from_blob_key(blob).alias("sha"),
        urls.parse_bucket_uri(F.concat(F.lit("s3://bucket-x/"), decoded))["bucket"].alias("bucket"),
        urls.dated_basename("out", F.col("day"), F.col("run"), "f").alias("basename"),
    )


@query("""
SELECT event_id, strftime(ts, '%Y-%m-%dT%H-%M-%S-%g') AS run_id, strftime(ts, '%Y-%m-%d') AS dt, strftime(ts, '%Y-%m-%dT%H:%M:%SZ') AS iso,
  event_type IN ('view', 'click') AS is_on, event_type = 'view' AS is_on_setting FROM events
""")
def run_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run ids, their date, ISO times and text switches."""
    word = F.when(F.col("event_type") == "view", " YES ").when(F.col("event_type") == "click", "y").when(F.col("event_type") == "error", "0")
    run = text.run_id_of(F.col("ts"))
    return table(spark, sf_dir, "events").select(
        "event_id", run.alias("run_id"), text.run_date(run).alias("dt"), text.utc_iso(F.col("ts")).alias("iso"),
        text.to_bool(word).alias("is_on"), text.to_bool(word, words=fv.TRUE_WORDS_SETTINGS).alias("is_on_setting"),
    )


@query("""
SELECT event_id, event_type IN ('error', 'signup') AS sold_out,
  CASE event_type WHEN 'view' THEN false WHEN 'click' THEN false WHEN 'error' THEN true END AS flag,
  CASE WHEN event_type NOT IN ('error', 'signup') THEN value END AS price FROM events
""")
def stock_status(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Sold-out rule over state objects, and the price it hides."""
    pdp = {
        "view": '{"isOutOfStock": false, "stockStatus": "sold out"}', "click": '{"isSoldOut": null, "stockStatus": " In  Stock "}',
        "error": '{"outOfStock": 1}', "signup": '{"badge": {"value": "SOLD  out"}}', "purchase": '{"availability": "unknown"}',
    }
    body = F.create_map(*[F.lit(x) for pair in pdp.items() for x in pair])[F.col("event_type")]
    state = jsons.parse_whole(F.concat(F.lit('{"pdp": '), body, F.lit("}")))
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", "value").select("event_id", "value", state.alias("state"))
    st = F.col("state")
    flags = [jsons.stock_flag(jsons.path_value(st, f"$.pdp.{p}")) for p in fv.STOCK_PATHS]
    return rows.select(
        "event_id", jsons.sold_out(st).alias("sold_out"), F.coalesce(*flags).alias("flag"),
        F.when(~jsons.sold_out(st), F.col("value")).alias("price"),
    )


@query("""
SELECT page_id, trim(regexp_replace(regexp_extract(html, '(?is)<title[^>]*>(.*?)</title>', 1), '\\s+', ' ', 'g')) AS title,
  trim(regexp_replace(regexp_extract(html, '(?is)<h1[^>]*>(.*?)</h1>', 1), '\\s+', ' ', 'g')) AS heading,
  len(regexp_extract_all(html, '(?is)<script[^>]*>(.*?)</script *>', 1)) AS n_scripts FROM pages
""")
def html_title_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    html = F.col("html")
    return table(spark, sf_dir, "pages").select(
        "page_id", text.collapse_spaces(markup.page_title(html)).alias("title"),
        text.collapse_spaces(F.regexp_extract(html, r"(?is)<h1[^>]*>(.*?)</h1>", 1)).alias("heading"),
        F.size(markup.scripts(html)).cast("bigint").alias("n_scripts"),
    )


@query("""
WITH h AS (SELECT page_id, html, strpos(html, '<script>') AS a, strpos(html, '</script>') AS b FROM pages),
t AS (SELECT page_id, regexp_replace(substr(html, 1, a - 1), '<[^>]*>', '', 'g') || substr(html, a + 8, b - a - 8)
  || regexp_replace(substr(html, b + 9), '<[^>]*>', '', 'g') AS t FROM h)
SELECT page_id, replace(replace(replace(replace(replace(replace(replace(replace(replace(t, '&nbsp;', chr(160)), '&copy;', chr(169)), '&middot;', chr(183)),
  '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&amp;', '&'), chr(10), ' '), chr(160), '') AS plain FROM t
""")
def page_plain_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Text nodes of every page. The pages have one script element and no tag inside an attribute, so SQL can say the same."""
    clean = markup.plain_text(F.col("html"))
    return table(spark, sf_dir, "pages").select("page_id", "html").select("page_id", clean.alias("plain"))


@query("SELECT doc_id, len(string_split(text, chr(10))) AS n_lines, sha1(text) AS sha1, md5(text) AS md5, sha256(text) AS sha256 FROM documents")
def text_digests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line counts and digests of whole texts."""
    return table(spark, sf_dir, "documents").select(
        "doc_id", F.size(F.split("text", "\n")).cast("bigint").alias("n_lines"), F.sha1("text").alias("sha1"),
        F.md5("text").alias("md5"), F.sha2("text", 256).alias("sha256"),
    )


@query("SELECT url FROM pages WHERE url NOT LIKE '%#top'")
def seed_list(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First CSV column: padding, a byte-order mark, headings and empty cells."""
    url = F.col("url")
    cell = F.when(url.endswith("#top"), F.when(url.contains("/en/"), " URL ").otherwise("  ")).when(
        url.contains("/fr/"), F.concat(F.lit("﻿"), url)).otherwise(F.concat(F.lit(" "), url, F.lit("\t")))
    return seeds.clean_seed_column(table(spark, sf_dir, "pages").select(cell.alias("c0")))


@query(r"""
SELECT DISTINCT url, split_part(split_part(url, '://', 2), '/', 1) AS host, 0.5::DOUBLE AS delay,
  CASE WHEN split_part(split_part(url, '://', 2), '/', 1) LIKE 'm.ththth.example.net' THEN 'requests' ELSE 'api' END AS fetch_route,
  CASE WHEN split_part(url, '?', 1) LIKE '%.html' THEN 'rendered_html' ELSE 'http_response' END AS request_kind,
  'https://www.ounass.ae/' AS referer FROM pages
""")
def state_request_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Routes of the state site's seeds, duplicates once."""
    plan = listings.request_plan(table(spark, sf_dir, "pages").select("url"), fv.STATE_SITE, direct_hosts=(" M.ththth.example.net ",))
    return plan.select("url", "host", "delay", "fetch_route", "request_kind", F.col("headers")["referer"].alias("referer"))


@query(r"""
WITH u AS (SELECT page_id, replace(replace(url, '/en/', '/women/'), '/fr/', '/men/') AS url FROM pages),
f AS (SELECT *, CASE WHEN url LIKE '%/men/%' THEN 'men' WHEN url LIKE '%/women/%' THEN 'women' END AS gender, url LIKE '%.html%' AS html,
  CASE WHEN split_part(split_part(url, '/', 3), '.', 1) = 'www' THEN '/ae' ELSE '' END AS country FROM u)
SELECT page_id, CASE WHEN html THEN 'page' ELSE 'listing_api' END AS request_kind,
  CASE WHEN NOT html THEN 'https://api.levelshoes.digital/catalog' || country || '/en/products/urlPath/v1' END AS api,
  CASE WHEN NOT html THEN gender END AS gender_type, CASE WHEN NOT html THEN nullif(regexp_extract(url, '/(men|women)/(.+?)(?:\?|$)', 2), '') END AS url_path
FROM f WHERE (html AND gender IS NULL) OR (NOT html AND gender IS NOT NULL)
""")
def api_request_plan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """API calls of the API site's listings; product pages stay page requests, other URLs drop out."""
    url = F.replace(F.replace("url", F.lit("/en/"), F.lit("/women/")), F.lit("/fr/"), F.lit("/men/"))
    plan = listings.request_plan(table(spark, sf_dir, "pages").select("page_id", url.alias("url")), fv.API_SITE)
    return plan.select(
        "page_id", "request_kind", F.col("api.api").alias("api"), F.col("api.params")["genderType"].alias("gender_type"),
        F.col("api.params")["urlPath"].alias("url_path"),
    )


@query("""
WITH p AS (SELECT page_id, url, split_part(url, '/', 4) AS lang FROM pages)
SELECT page_id, CASE WHEN lang = 'en' THEN 'bronze/dev/crawls/metadata/ounass/2024-02-01/' || page_id || '/manifest.json'
  ELSE 'bronze/dev/crawls/ounass/2024-02-01/' || page_id || '/ounass.jsonl.gz' END AS file_key,
  CASE WHEN lang = 'fr' THEN 2.0::DOUBLE ELSE 0.5::DOUBLE END AS delay,
  CASE WHEN page_id % 10 < 2 THEN 2.0::DOUBLE WHEN page_id % 10 < 7 THEN pow(2.0, page_id % 10 - 1) ELSE 60.0::DOUBLE END AS slot FROM p
""")
def file_keys_and_delays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Storage branch of run files, request delay by host, domain delay held in its slot range."""
    lang = urls.segment(F.col("url"), 3)
    name = F.when(lang == "en", "metadata/manifest.json").otherwise("ounass.jsonl.gz")
    image = F.when(lang == "fr", F.concat(F.lit("https://cdn-images.farfetch-contents.com/"), "url")).otherwise(F.col("url"))
    domain_delay = text.backoff_delay((F.col("page_id") % 10).cast("int"))
    key = manifest.crawl_file_key("dev", F.lit("ounass"), F.lit("2024-02-01"), F.col("page_id").cast("string"), name)
    return table(spark, sf_dir, "pages").select(
        "page_id", key.alias("file_key"), urls.slot_delay(image).alias("delay"), text.clamp_delay(domain_delay, 2.0, 60.0).alias("slot")
    )
