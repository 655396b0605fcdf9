"""JSON text: parsing, blankness, typed reads.

Values stay VARIANT until a field is read, because presence and type of a key both matter:
`[]`, `"[]"`, a missing key and a null are four different things.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfscope import fixed_values as fv
from shelfscope.functions.text import is_blank_text, label_key, strip

ANY_OBJECT = "map<string,variant>"
ANY_LIST = "array<variant>"


def bind(value: Column, use: Callable[[Column], Column]) -> Column:
    """use(value) with `value` computed once, however often `use` mentions it.

    Without it the tree of a nested rule repeats the parse at every mention.
    """
    return F.get(F.transform(F.array(value), use), F.lit(0))


def parse_whole(c: Column) -> Column:
    """VARIANT of a text that is exactly one JSON value, else NULL.

    The built-in parser stops after the first value and ignores what follows, so the text is
    parsed inside a list that ends with the text's own length; leftovers break that list.
    """
    size = F.length(c)
    listed = F.try_variant_get(F.try_parse_json(F.concat(F.lit("["), c, F.lit(","), size, F.lit("]"))), "$", ANY_LIST)

    def first_of_two(parts: Column) -> Column:
        ends_well = F.try_variant_get(F.get(parts, F.lit(1)), "$", "int") == size
        return F.when((F.size(parts) == 2) & ends_well, F.get(parts, F.lit(0)))

    return bind(listed, first_of_two)


def as_object(v: Column) -> Column:
    """map<string, variant> of an object, NULL for any other JSON type."""
    return F.try_variant_get(v, "$", ANY_OBJECT)


def as_list(v: Column) -> Column:
    return F.try_variant_get(v, "$", ANY_LIST)


def as_text(v: Column) -> Column:
    return F.try_variant_get(v, "$", "string")


def json_type(v: Column) -> Column:
    return F.schema_of_variant(v)


def is_string(v: Column) -> Column:
    return json_type(v) == "STRING"


def is_blank(v: Column) -> Column:
    """NULL, white-space-only string, empty list or empty object. 0 and false are values."""
    return bind(as_text(v), lambda t: is_blank_text(t) | (t.isin("[]", "{}") & ~F.coalesce(is_string(v), F.lit(False))))


def truthy_text(v: Column) -> Column:
    """Text of a JSON value that counts as present: not null, '', 0, false, [] or {}."""

    def keep(t: Column, value: Column) -> Column:
        # A pattern instead of a cast: a failed cast costs an exception per row.
        hollow = F.rlike(t, F.lit(r"^(false|\[\]|\{\}|-?0+(\.0*)?(E.*)?)$"))
        return F.when(is_string(value), F.nullif(t, F.lit(""))).when(~hollow, t)

    return bind(v, lambda value: bind(as_text(value), lambda t: keep(t, value)))


def path_text(v: Column, path: str) -> Column:
    """Null-safe path read as text."""
    return F.try_variant_get(v, path, "string")


def path_double(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "double")


def path_value(v: Column, path: str) -> Column:
    return F.try_variant_get(v, path, "variant")


def stock_flag(v: Column) -> Column:
    """Tri-state: booleans as they are, numbers by non-zero, known labels; anything else NULL."""

    def by_type(value: Column, kind: Column) -> Column:
        label = label_key(as_text(value))
        return (
            F.when(kind == "BOOLEAN", F.try_variant_get(value, "$", "boolean"))
            .when(F.rlike(kind, F.lit("^(BIGINT|DOUBLE|DECIMAL)")), F.try_variant_get(value, "$", "double") != 0)
            .when((kind == "STRING") & label.isin(fv.IN_STOCK_WORDS), F.lit(False))
            .when((kind == "STRING") & label.isin(fv.SOLD_OUT_WORDS), F.lit(True))
        )

    return bind(v, lambda value: bind(json_type(value), lambda kind: by_type(value, kind)))


def sold_out(state: Column) -> Column:
    """First readable stock field of the state object, else the badge label, else false."""
    flags = [stock_flag(path_value(state, f"$.pdp.{name}")) for name in fv.STOCK_PATHS]
    badge = path_value(state, "$.pdp.badge.value")
    by_badge = F.when(is_string(badge), label_key(as_text(badge)).isin(fv.SOLD_OUT_BADGES))
    return F.coalesce(*flags, by_badge, F.lit(False))


def image_urls_of(fields: Column) -> Column:
    """`image_urls` is read only when `image_url` is null; a string is one URL, a list its non-empty entries."""
    none = F.array().cast("array<string>")

    def urls_in(value: Column) -> Column:
        # A list entry is turned to text as it is, so a null entry reads 'None'.
        many = F.transform(as_list(value), lambda x: F.coalesce(strip(as_text(x)), F.lit("None")))
        texts = F.when(is_string(value), F.array(strip(as_text(value)))).otherwise(many)
        return F.filter(F.coalesce(texts, none), lambda s: s != "")

    return bind(F.coalesce(present(fields, "image_url"), present(fields, "image_urls")), urls_in)


def present(fields: Column, key: str) -> Column:
    """Value of a key, NULL when missing or JSON null."""
    return bind(F.try_element_at(fields, F.lit(key)), lambda v: F.when(~F.is_variant_null(v), v))


def primary_key_of(fields: Column, site: Column) -> Column:
    """primary_key, else unique_id, else <portal_itemid>_<site>."""
    item = truthy_text(present(fields, "portal_itemid"))
    return F.coalesce(
        truthy_text(present(fields, "primary_key")),
        truthy_text(present(fields, "unique_id")),
        F.concat(item, F.lit("_"), site),
    )


def source_run_of(fields: Column) -> Column:
    return F.coalesce(truthy_text(present(fields, "source_run_id")), truthy_text(present(fields, "run_id")))

