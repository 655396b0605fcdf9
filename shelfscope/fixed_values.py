"""Values that must equal the existing data and contracts for results to be right.

FIXED VALUES: site names, aliases, host tables, labels, patterns and reason codes below
are part of the data contract. They are listed as plain text in natural order.
"""

# --- sites ---------------------------------------------------------------------------
DOM_SITE = "farfetch"        # product fields sit in page markup
STATE_SITE = "ounass"        # product fields sit in an embedded state object
API_SITE = "level-shoes"     # product fields come from a listing API, pages fill the gaps

IMAGE_SITE_ALIASES = {
    "farfetch": "farfetch",
    "level": "level-shoes",
    "level-shoes": "level-shoes",
    "level_shoes": "level-shoes",
    "ounass": "ounass",
}
GATE_SITE_ALIASES = {"level": "level-shoes", "level_shoes": "level-shoes"}
MISSING_SITE = "__missing_site__"

SITE_HOME = {
    "farfetch": "https://www.farfetch.com",
    "level-shoes": "https://www.levelshoes.com/",
    "ounass": "https://www.ounass.ae/",
}
DEFAULT_USER_AGENT = "Mozilla/5.0"

# --- URLs ----------------------------------------------------------------------------
IMAGE_CDN_HOST = "cdn-images.farfetch-contents.com"
IMAGE_CDN_DELAY = 2.0
PAGE_DELAY = 0.5
HOST_LANGUAGE = {
    "www.ounass.ae": "EN",
    "saudi.ounass.com": "AR",
    "kuwait.ounass.com": "EN",
    "www.ounass.qa": "EN",
    "ar.ounass.ae": "AR",
    "ar-kuwait.ounass.com": "AR",
    "ar.ounass.qa": "AR",
    "ar.ounass.sa": "AR",
    "en-saudi.ounass.com": "EN",
}
LISTING_SORT_KEY = "fh_sort_by"
LISTING_SORT_VALUE = "-newness_ae"
LISTING_API = {
    "base": "https://api.levelshoes.digital/catalog",
    "endpoint": "products/urlPath/v1",
    "groupID": "1000",
    "museTier": "-1",
    "count": "48",
}
IMAGE_SUFFIXES = [".jpg", ".jpeg", ".png", ".webp", ".gif", ".avif"]
DEFAULT_IMAGE_SUFFIX = ".jpg"
CONTENT_TYPE_SUFFIX = {
    "image/jpeg": ".jpg",
    "image/jpg": ".jpg",
    "image/png": ".png",
    "image/webp": ".webp",
    "image/gif": ".gif",
    "image/avif": ".avif",
}
PRODUCT_FILE_PATTERN = r"-item-\d+\.aspx(?:\?.*)?$"
LISTING_FILE = "items.aspx"

# --- labels --------------------------------------------------------------------------
SOLD_OUT_LABEL = "Sold Out"
IN_STOCK_WORDS = ["in stock", "available", "instock"]
SOLD_OUT_BADGES = ["out of stock", "sold out", "نفدت الكمية"]
SOLD_OUT_WORDS = SOLD_OUT_BADGES + ["outofstock"]
STOCK_PATHS = ["isOutOfStock", "outOfStock", "isSoldOut", "stockStatus", "stock_status", "availability"]
GENDER_CRUMBS = ["Women", "Men", "Kids"]
GENDER_SEGMENTS = ["men", "women", "kids"]
BADGE_RIBBON_CLASSES = ["absolute", "z-10", "mt-4", "gap-1"]
DETAILS_HEADINGS = ["Product Details", "تفاصيل المنتج"]
TRUE_WORDS = ["1", "true", "yes", "y", "on"]
TRUE_WORDS_SETTINGS = ["1", "true", "yes", "on"]

# --- patterns ------------------------------------------------------------------------
SKU_PATTERN = r"\b[A-Z0-9]{2,}(?:-[A-Z0-9]{2,})+\b|\b[A-Z]{2}\d{4,}[A-Z0-9]+\b"
STATE_PATTERN = r"(?s)window\.initialState\s*=\s*(\{.*?\});"
STATE_SCRIPT_MARK = '"routeType":"new-pdp"'
DISCOUNT_PATTERN = r'(?i)"discountPercentage"\s*:\s*"(\d{1,3}%\s*OFF)"'
SCRIPT_SKU_PATTERN = r'(?i)"sku"\s*:\s*"([^"]+)"'
IMAGE_SKU_PATTERN = r"(?i)/([a-z0-9\-]+)_\d+\.(?:jpg|png|webp)"
FIRST_IMAGE_PATTERN = r"(?i)_1\.(jpg|png|webp)"
RUN_ID_FORMAT = "yyyy-MM-dd'T'HH-mm-ss-SSS"
STATUS_COUNT_PREFIX = "downloader/response_status_count/"
REQUEST_COUNT_KEY = "downloader/request_count"
ERROR_COUNT_KEY = "log_count/ERROR"

# --- outcomes ------------------------------------------------------------------------
RESULT_SCHEMA_VERSION = "image_download_result_v1"
STATUS_OK = "ok"
STATUS_ERROR = "error"
STATUS_SKIPPED_INVALID = "skipped_invalid"
STATUS_SKIPPED_DUPLICATE = "skipped_duplicate"
MARKER_SUCCESS = "_SUCCESS"
MARKER_FAILED = "_FAILED"
MARKER_FAIL_QUALITY = "_FAIL_QUALITY"
GATE_PASS = "pass"
GATE_FAIL = "fail_quality"
GATE_ERROR = "error"
GATE_RULE_SET = "default"
BLANK_RULE = "field_blankness_threshold"
ENTRY_POINT_KEYS = ["start_urls", "url", "urls", "urlpath", "urls_file", "urls_source"]
RETRY_HTTP_CODES = [429, 500, 502, 503, 504, 522, 524, 408]
MIN_IMAGE_SIDE = 10
