"""Table schemas as Spark DDL. Every reader passes one of these; nothing is inferred."""

# One typed record per product page, the common shape of all three sites.
PRODUCT = (
    "run_id string, site string, crawl_date string, url string, language string, country string, "
    "portal_itemid string, product_name string, gender string, brand string, brand_id string, "
    "color string, category string, subcategory string, price double, currency string, "
    "price_discount string, out_of_stock boolean, primary_label array<string>, "
    "image_urls array<string>, text string, text_parts map<string,string>, level_category_id bigint"
)
PRODUCT_FIELDS = [part.split()[0] for part in PRODUCT.split(", ")]

IMAGE_JOB = (
    "site string, primary_key string, image_url string, source_run_id string, "
    "input_source struct<jsonl_path:string,line_no:bigint>"
)

IMAGE_RESULT = (
    "schema_version string, status string, reason string, event_time_utc string, download_run_id string, "
    "job struct<job_id:string,site:string,primary_key:string,source_run_id:string,"
    "input_source:struct<jsonl_path:string,line_no:bigint>>, "
    "request struct<image_url:string,normalized_image_url:string>, "
    "storage struct<output_path:string,canonical_blob_key:string>, "
    "transfer struct<bytes:bigint,content_sha256:string,content_type:string,http_status:int>, "
    "error struct<type:string,message:string>, details map<string,string>"
)

IMAGE_RESPONSE = (
    "url string, http_status int, content_type string, content binary, error_type string, error_message string"
)

IMAGE_DOWNLOAD_LOG = (
    "site string, primary_key string, url string, run_id string, status string, reason string, "
    "error_message string, http_status int, s3_blob_key string, dt string, run string"
)

IMAGE_VALIDATED = (
    "site string, primary_key string, image_url string, s3_blob_key string, sha256 string, "
    "width int, height int, format string, run_id string, dt string, run string"
)

RAW_DOCUMENT = "run_id string, raw_json string, site string, dt string, run string"
RUN_MARKER = "site string, dt string, run_id string, marker string, body string"

STATE_TABLE = "domain string, penalty bigint"

LISTING_PAYLOAD_API = (
    "products array<struct<name:string,color:string,originalPrice:string,discountPercentage:string,"
    "action:struct<url:string>,"
    "analytics:struct<item_id:string,brand:string,category1:string,category2:string,gender:string,price:double>,"
    "badges:array<struct<text:string>>,imagePreviewGallery:array<struct<url:string>>>>"
)

LISTING_PAYLOAD_STATE = (
    "page int, routeType string, pagination struct<totalPages:int>, "
    "hits array<struct<slug:string,configurableAttributes:array<struct<options:array<struct<"
    "attributeSpecificProperties:struct<slug:string>>>>>>>"
)
