"""URL, site and storage-key functions.

Hosts and paths are cut with plain patterns instead of `parse_url`: crawled URLs often hold
characters a strict URI parser rejects, and those rows must still get a host.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfscope import fixed_values as fv
from shelfscope.functions.text import none_if_empty, safe_primary_key, strip


def lookup(c: Column, table: dict[str, str]) -> Column:
    """Literal map lookup, NULL for unknown keys."""
    return F.try_element_at(F.create_map(*[F.lit(x) for pair in table.items() for x in pair]), c)


def segment(url: Column, n: int) -> Column:
    """n-th '/'-separated piece, 0-based, NULL if short."""
    return F.get(F.split(url, "/"), F.lit(n))


def before_query(url: Column) -> Column:
    return F.substring_index(url, "?", 1)


def last_segment(c: Column) -> Column:
    return F.substring_index(c, "/", -1)


def netloc(url: Column) -> Column:
    """Host with port as written, '' if the URL has none."""
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?//([^/?#]*)", 1)


def hostname(url: Column) -> Column:
    """Lower-case host without credentials and port, NULL if there is none."""
    return none_if_empty(F.lower(F.regexp_replace(netloc(url), r"^.*@|:\d*$", "")))


def scheme_and_host(url: Column) -> Column:
    return F.concat(F.regexp_extract(F.lower(url), r"^([a-z][a-z0-9+.\-]*):", 1), F.lit("://"), netloc(url))


def url_path(url: Column) -> Column:
    """Path without query, fragment and ';' parameters."""
    return F.regexp_extract(url, r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#;]*)", 1)


# --- sites -----------------------------------------------------------------------------


def image_site(site: Column) -> Column:
    """Canonical site of an image job, NULL when unknown (the caller rejects the row)."""
    return lookup(F.lower(strip(site)), fv.IMAGE_SITE_ALIASES)


def gate_site(site: Column) -> Column:
    """Canonical site for profiling: unknown names pass, missing ones get their own bucket."""
    key = F.lower(strip(site))
    return F.coalesce(lookup(key, fv.GATE_SITE_ALIASES), none_if_empty(key), F.lit(fv.MISSING_SITE))


def site_headers(site: Column) -> Column:
    """Request headers as a map column (planning only, nothing is fetched)."""
    referer = lookup(site, fv.SITE_HOME)
    agent = F.create_map(F.lit("user-agent"), F.lit(fv.DEFAULT_USER_AGENT))
    return F.when(
        referer.isNotNull(),
        F.create_map(F.lit("user-agent"), F.lit(fv.DEFAULT_USER_AGENT), F.lit("referer"), referer),
    ).otherwise(agent)


# --- image jobs ------------------------------------------------------------------------


def normalize_image_url(url: Column) -> Column:
    """Absolute URL: http(s) kept, '//x' and 'x' get https. Blank -> NULL."""
    raw = none_if_empty(strip(url))
    return (
        F.when(raw.startswith("http://") | raw.startswith("https://"), raw)
        .when(raw.startswith("//"), F.concat(F.lit("https:"), raw))
        .otherwise(F.concat(F.lit("https://"), F.regexp_replace(raw, "^/+", "")))
    )


def job_id(site: Column, primary_key: Column, url: Column) -> Column:
    """NULL if a part is NULL (`concat`, not `concat_ws`, which would skip it)."""
    return F.sha1(F.concat(site, F.lit("|"), primary_key, F.lit("|"), url))


def suffix_from_url(url: Column) -> Column:
    suffix = F.lower(F.regexp_extract(url_path(url), r"[^/](\.[^./]+)/*$", 1))
    return F.when(suffix.isin(fv.IMAGE_SUFFIXES), suffix).otherwise(F.lit(fv.DEFAULT_IMAGE_SUFFIX))


def suffix_from_content_type(ct: Column) -> Column:
    return lookup(strip(F.substring_index(F.lower(ct), ";", 1)), fv.CONTENT_TYPE_SUFFIX)


def output_path(
    root: str | Column, site: Column, primary_key: Column, url: Column, source_run: Column, run: Column
) -> Column:
    root = F.lit(root) if isinstance(root, str) else root
    name = F.concat(
        safe_primary_key(primary_key), F.lit("_"), F.substring(F.sha1(url), 1, 10), suffix_from_url(url)
    )
    return F.concat_ws("/", root, site, F.coalesce(none_if_empty(source_run), run), name)


def blob_key(prefix: str, sha256: Column, suffix: Column) -> Column:
    return F.concat(F.lit(prefix.rstrip("/") + "/"), sha256, suffix)


# --- page URLs of the markup site ---------------------------------------------------------


def dom_file(url: Column) -> Column:
    return before_query(last_segment(url))


def dom_is_listing(url: Column) -> Column:
    return dom_file(url) == fv.LISTING_FILE


def dom_is_first_page(url: Column) -> Column:
    return ~url.contains("?") & dom_is_listing(url)


def dom_is_product(url: Column) -> Column:
    return F.rlike(dom_file(url), F.lit(fv.PRODUCT_FILE_PATTERN))


def dom_country(url: Column) -> Column:
    return segment(url, 3)


def dom_item_id(url: Column) -> Column:
    stem = F.substring_index(last_segment(before_query(url)), ".", 1)
    tail = F.substring_index(stem, "-", -1)
    return F.when(dom_is_product(url) & F.rlike(tail, F.lit(r"^\d+$")), tail)


def dom_gender(url: Column) -> Column:
    return F.when(dom_is_product(url), segment(url, 5))


def dom_subfolder(url: Column) -> Column:
    return F.when(dom_is_product(url), F.substring_index(last_segment(url), ".", 1))


# --- page URLs of the API site ------------------------------------------------------------


def api_subdomain(url: Column) -> Column:
    return F.substring_index(segment(url, 2), ".", 1)


def api_country(url: Column) -> Column:
    sub = api_subdomain(url)
    return (
        F.when(sub.contains("saudi"), "sa")
        .when(sub.contains("kuwait"), "kw")
        .when(sub.contains("qatar"), "qa")
        .when(sub.contains("www"), "ae")
    )


def api_gender(url: Column) -> Column:
    return (
        F.when(url.contains("/men/"), "men").when(url.contains("/women/"), "women").when(url.contains("/kids/"), "kids")
    )


def api_language(url: Column) -> Column:
    return F.when(url.contains("/ar/") | api_subdomain(url).contains("ar-"), "AR").when(url.isNotNull(), "EN")


def api_listing_language(url: Column) -> Column:
    """Lower-case language of a listing URL; NULL for any other URL."""
    return F.when(api_is_listing(url), F.lower(api_language(url)))


def api_is_listing(url: Column) -> Column:
    return ~url.contains(".html") & api_gender(url).isNotNull()


def api_is_product(url: Column) -> Column:
    return url.contains(".html") & api_gender(url).isNull()


def api_listing_path(url: Column) -> Column:
    return none_if_empty(F.regexp_extract(url, r"/(men|women)/(.+?)(?:\?|$)", 2))


def api_request(url: Column, page: Column) -> Column:
    """API address and parameters of one listing page, NULL for non-listing URLs."""
    api = fv.LISTING_API
    address = F.concat_ws("/", F.lit(api["base"]), api_country(url), api_listing_language(url), F.lit(api["endpoint"]))
    params = F.create_map(
        F.lit("urlPath"), api_listing_path(url),
        F.lit("groupID"), F.lit(api["groupID"]),
        F.lit("museTier"), F.lit(api["museTier"]),
        F.lit("count"), F.lit(api["count"]),
        F.lit("genderType"), api_gender(url),
        F.lit("mediaGender"), api_gender(url),
        F.lit("page"), page.cast("string"),
    )
    return F.when(api_is_listing(url), F.struct(address.alias("api"), params.alias("params")))


# --- page URLs of the state site ------------------------------------------------------------


def state_language(url: Column) -> Column:
    return lookup(F.substring_index(F.substring_index(url, "https://", -1), "/", 1), fv.HOST_LANGUAGE)


def state_is_product(url: Column) -> Column:
    return F.substring_index(url, ".", -1) == "html"


def state_is_listing(body: Column) -> Column:
    """JSON body whose route is a listing; bodies that are not JSON count as 'no'."""
    return F.get_json_object(body, "$.routeType").eqNullSafe("plp")


def state_request_kind(url: Column, page_kind: str = "rendered_html", listing_kind: str = "http_response") -> Column:
    return F.when(before_query(url).endswith(".html"), page_kind).otherwise(listing_kind)


def fetch_route(url: Column, backend: str = "auto", direct_hosts: tuple[str, ...] = ()) -> Column:
    """Configured route, or by host allow-list when it is 'auto'."""
    backend = backend.strip().lower()
    if backend not in {"auto", "api", "requests"}:
        raise ValueError(f"unknown fetch backend: {backend}")
    if backend != "auto":
        return F.lit(backend)
    hosts = [h.strip().lower() for h in direct_hosts if h.strip()]
    if not hosts:
        return F.lit("api")
    return F.when(hostname(url).isin(hosts), "requests").otherwise("api")


def slot_delay(url: Column) -> Column:
    return F.when(url.contains(fv.IMAGE_CDN_HOST), F.lit(fv.IMAGE_CDN_DELAY)).otherwise(F.lit(fv.PAGE_DELAY))


# --- storage keys -----------------------------------------------------------------------


def decode_event_key(key: Column) -> Column:
    """Percent- and plus-decoding of an object-created event key."""
    return F.try_url_decode(key)


def parse_run_key(key: Column, prefix: str) -> Column:
    """'<prefix><site>/<dt>/<run_id>/...' -> struct(site, dt, run_id); NULL for any other key."""
    parts = F.split(F.substr(key, F.lit(len(prefix) + 1)), "/")
    return F.when(
        key.startswith(prefix) & (F.size(parts) >= 4),
        F.struct(F.get(parts, 0).alias("site"), F.get(parts, 1).alias("dt"), F.get(parts, 2).alias("run_id")),
    )


def parse_marker_key(key: Column, prefix: str) -> Column:
    """'<prefix><dt>/<run_id>/<marker>' -> struct(dt, run_id); NULL for any other key."""
    parts = F.split(F.substr(key, F.lit(len(prefix) + 1)), "/")
    return F.when(
        key.startswith(prefix) & (F.size(parts) >= 3),
        F.struct(F.get(parts, 0).alias("dt"), F.get(parts, 1).alias("run_id")),
    )


def parse_bucket_uri(uri: Column) -> Column:
    return F.struct(
        F.regexp_extract(uri, "^s3://([^/]*)", 1).alias("bucket"),
        F.regexp_extract(uri, "^s3://[^/]*/?(.*)$", 1).alias("key"),
    )


def run_key(prefix: str | Column, site: Column, dt: Column, run_id: Column, name: str | Column) -> Column:
    """Inverse of `parse_run_key`."""
    prefix = F.lit(prefix) if isinstance(prefix, str) else prefix
    name = F.lit(name) if isinstance(name, str) else name
    return F.concat(prefix, F.concat_ws("/", site, dt, run_id, name))


def sha_from_blob_key(key: Column) -> Column:
    return F.regexp_replace(last_segment(key), r"\.[^.]*$", "")


def table_slug(site: Column) -> Column:
    """bronze_<slug>_raw with runs of other characters as '_'."""
    slug = F.lower(F.regexp_replace(F.regexp_replace(site, "[^a-zA-Z0-9]+", "_"), "^_+|_+$", ""))
    return F.when(slug == "", "bronze_raw_scrape").otherwise(F.concat(F.lit("bronze_"), slug, F.lit("_raw")))


def dated_basename(root: str, date: Column, run_id: Column, name: str) -> Column:
    """out/yyyy/mm/dd/run_id/name"""
    return F.concat_ws("/", F.lit(root), F.replace(date, F.lit("-"), F.lit("/")), run_id, F.lit(name))
