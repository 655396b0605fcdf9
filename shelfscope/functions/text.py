"""Strings, numbers, labels, hashes, run ids."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfscope import fixed_values as fv

# All of Unicode white space plus the four ASCII separators; `trim` alone knows only U+0020.
_WS = r"[\s\x1c-\x1f]"


def strip(c: Column) -> Column:
    """Trim every kind of white space on both ends."""
    return F.regexp_replace(c, rf"(?U)^{_WS}+|{_WS}+$", "")


def none_if_empty(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def is_blank_text(c: Column) -> Column:
    """NULL or white space only. Stops at the first visible character."""
    return c.isNull() | ~F.rlike(c, F.lit(r"(?U)[^\s\x1c-\x1f]"))


def collapse_spaces(c: Column) -> Column:
    """NULL reads as ''; runs of white space become one space; ends trimmed."""
    return F.trim(F.regexp_replace(F.coalesce(c, F.lit("")), rf"(?U){_WS}+", " "))


def label_key(c: Column) -> Column:
    """Form used to compare labels. NULL stays NULL."""
    return F.when(c.isNotNull(), F.lower(collapse_spaces(c)))


def parse_number(c: Column) -> Column:
    """Text to double by the number grammar of a JSON-like literal; anything else is NULL.

    The guard keeps out Java-only forms such as '1d' that a plain cast would take.
    """
    plain = F.regexp_replace(c, r"(?<=\d)_(?=\d)", "")
    shape = r"(?i)^\s*[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|inf|infinity|nan)\s*$"
    return F.when(F.rlike(plain, F.lit(shape)), F.trim(plain).try_cast("double"))


def price_and_currency(c: Column) -> Column:
    """'AED 3,746' -> struct(price=3746.0, currency='AED'); both NULL if either part fails."""
    amount = parse_number(F.replace(F.regexp_extract(c, r"(?s)^[^ ]* (.*)$", 1), F.lit(","), F.lit("")))
    return F.when(
        amount.isNotNull(),
        F.struct(amount.alias("price"), F.substring_index(c, " ", 1).alias("currency")),
    )


def last_page_number(c: Column) -> Column:
    """Last run of digits in a pagination label, 1 when there is none, NULL label -> NULL.

    '1 of 1,234' gives 234: the comma ends the run.
    """
    digits = none_if_empty(F.regexp_extract(c, r"(?s)(\d+)[^\d]*$", 1))
    return F.when(c.isNotNull(), F.coalesce(digits.try_cast("int"), F.lit(1)))


def last_word(c: Column) -> Column:
    return F.substring_index(c, " ", -1)


def clean_badges(badges: Column) -> Column:
    """Collapse spaces, drop a leading star or asterisk glued to text, keep pure symbols, first wins."""
    tidy = F.filter(F.transform(badges, collapse_spaces), lambda b: b != "")
    bare = F.transform(
        tidy, lambda b: F.when(b.isin("*", "★"), b).otherwise(F.regexp_replace(b, r"(?U)^[★*]+\s*", ""))
    )
    unique = F.array_distinct(F.filter(bare, lambda b: b != ""))
    return F.when(F.size(unique) > 0, unique)


def sku_in(c: Column) -> Column:
    """First SKU-shaped token of an upper-cased text."""
    return none_if_empty(F.regexp_extract(F.upper(c), fv.SKU_PATTERN, 0))


def join_details(highlights: Column, composition: Column) -> Column:
    return F.concat_ws(", ", F.transform(highlights, strip), none_if_empty(composition))


def run_id_of(ts: Column) -> Column:
    """Sortable run id, millisecond precision."""
    return F.date_format(ts, fv.RUN_ID_FORMAT)


def run_date(run_id: Column) -> Column:
    return F.split_part(run_id, F.lit("T"), F.lit(1))


def utc_iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'Z'")


def to_bool(c: Column, default: bool = False, words: list[str] | None = None) -> Column:
    """Text switch: one of the true words, any case, padding ignored."""
    return F.coalesce(F.lower(strip(c)).isin(words or fv.TRUE_WORDS), F.lit(default))


def display_ratio(c: Column) -> Column:
    """Four digits, ties to even. Only for display: comparisons use the unrounded ratio."""
    return F.bround(c, 4)


def backoff_delay(penalty: Column, base: float = 1.0, cap: float = 300.0) -> Column:
    """base for penalty 0, then base * 2^(penalty-1) up to the cap."""
    # 2^63 already exceeds any cap, so the exponent is limited to stay finite.
    grown = F.lit(float(base)) * F.pow(F.lit(2.0), F.least(penalty, F.lit(64)) - 1)
    return F.when(penalty <= 0, F.lit(float(base))).otherwise(F.least(F.lit(float(cap)), grown))


def retry_delay(penalty: Column, retry_after: Column, base: float = 1.0, cap: float = 300.0) -> Column:
    """A readable Retry-After value replaces the computed delay."""
    return F.coalesce(parse_number(retry_after), backoff_delay(penalty, base, cap))


def clamp_delay(delay: Column, low: float, high: float) -> Column:
    return F.least(F.lit(float(high)), F.greatest(F.lit(float(low)), delay))


def is_sold_out(label: Column) -> Column:
    return label.eqNullSafe(fv.SOLD_OUT_LABEL)


def safe_primary_key(c: Column) -> Column:
    return F.replace(strip(c), F.lit("/"), F.lit("_"))


def is_image_content_type(ct: Column) -> Column:
    """Absent passes; otherwise it must be an image type."""
    return F.coalesce(ct == "", F.lit(True)) | F.lower(strip(ct)).startswith("image/")


def count_summary(pairs: Column) -> Column:
    """array<struct<key,n>> -> 'a=1, b=2' sorted by key."""
    return F.array_join(
        F.transform(F.array_sort(pairs), lambda p: F.concat(p["key"], F.lit("="), p["n"].cast("string"))), ", "
    )
