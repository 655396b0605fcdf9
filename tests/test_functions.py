"""Scalar rules against literal cases and, where Python has the rule, against Python."""

import json

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from shelfscope import fixed_values as fv
from shelfscope.functions import arrays, jsons, markup, text, urls

X = "x"


def rows_of(spark, values, expression):
    frame = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    return [r["out"] for r in frame.select("i", expression.alias("out")).orderBy("i").collect()]


def test_price_and_currency(spark):
    cases = {
        "AED 3,746": (3746.0, "AED"), "AED 1,234.50": (1234.5, "AED"), "3746": None, "": None, None: None,
        "AED abc": None, "AED 1d": None, "USD  5": (5.0, "USD"), "X 1e3": (1000.0, "X"),
    }
    got = rows_of(spark, list(cases), text.price_and_currency(F.col(X)))
    assert [tuple(g) if g else None for g in got] == list(cases.values())


def test_last_page_number(spark):
    cases = {"1 of 51": 51, "1 of 1,234": 234, "no digits": 1, "7 pages": 7, None: None}
    assert rows_of(spark, list(cases), text.last_page_number(F.col(X))) == list(cases.values())


def test_blank_text_knows_unicode_space(spark):
    values = ["", " ", "\t\n", "\xa0", " \x1c", "a", " a ", None]
    want = [not (v or "").strip() for v in values]
    assert rows_of(spark, values, text.is_blank_text(F.col(X))) == want
    stripped = rows_of(spark, [v for v in values if v is not None], text.strip(F.col(X)))
    assert stripped == [v.strip() for v in values if v is not None]


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.text(alphabet=" \t\n\xa0\x1c ab★*", max_size=8), min_size=1, max_size=20))
def test_strip_and_collapse_match_python(spark, values):
    assert rows_of(spark, values, text.strip(F.col(X))) == [v.strip() for v in values]
    assert rows_of(spark, values, text.collapse_spaces(F.col(X))) == [" ".join(v.split()) for v in values]


JSON_VALUES = st.recursive(
    st.none() | st.booleans() | st.integers(-5, 5) | st.text(alphabet=' \n"\\{}[]a', max_size=4),
    lambda inner: st.lists(inner, max_size=3) | st.dictionaries(st.text(alphabet="ab", max_size=2), inner, max_size=3),
    max_leaves=6,
)


def python_blank(value):
    if value is None:
        return True
    if isinstance(value, str):
        return not value.strip()
    return value in ([], {})


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(JSON_VALUES, min_size=1, max_size=15))
def test_blank_and_truthy_match_python(spark, values):
    docs = [json.dumps({"v": v}) for v in values]
    value = F.try_element_at(jsons.as_object(jsons.parse_whole(F.col(X))), F.lit("v"))
    assert rows_of(spark, docs, jsons.is_blank(value)) == [python_blank(v) for v in values]
    present = jsons.present(jsons.as_object(jsons.parse_whole(F.col(X))), "v")
    assert [t is not None for t in rows_of(spark, docs, jsons.truthy_text(present))] == [bool(v) for v in values]


def test_parse_whole_rejects_leftovers(spark):
    cases = {
        '{"a":1}': True, ' {"a":1} ': True, "[1]": True, "3": True, '{"a":1} x': False, '{"a":1} {"b":2}': False,
        '{"a":1},{"b":2}': False, '{"a":1}] x': False, "bad": False, "": False, None: False,
    }
    assert rows_of(spark, list(cases), jsons.parse_whole(F.col(X)).isNotNull()) == list(cases.values())


def test_duplicate_keys_keep_the_last(spark):
    spark.conf.set("spark.sql.variant.allowDuplicateKeys", "true")
    assert rows_of(spark, ['{"a":1,"a":2}'], jsons.path_text(jsons.parse_whole(F.col(X)), "$.a")) == ["2"]


@pytest.mark.parametrize("raw, want", [
    ('{"image_url": " a "}', ["a"]), ('{"image_url": ["a ", " ", null, 3]}', ["a", "None", "3"]), ('{"image_url": {"b": 1}}', []),
    ('{"image_url": "", "image_urls": "b"}', []), ('{"image_url": null, "image_urls": "b"}', ["b"]), ("{}", []),
])
def test_image_urls_of(spark, raw, want):
    assert rows_of(spark, [raw], jsons.image_urls_of(jsons.as_object(jsons.parse_whole(F.col(X))))) == [want]


def test_primary_key_falls_through_falsy_values(spark):
    cases = {
        '{"primary_key": "p"}': "p", '{"primary_key": "", "unique_id": 7}': "7", '{"portal_itemid": "i"}': "i_s",
        '{"portal_itemid": 0}': None, '{"primary_key": "0"}': "0",
    }
    got = rows_of(spark, list(cases), jsons.primary_key_of(jsons.as_object(jsons.parse_whole(F.col(X))), F.lit("s")))
    assert got == list(cases.values())


def test_sold_out_order(spark):
    cases = {
        '{"pdp":{"isOutOfStock":true}}': True, '{"pdp":{"isOutOfStock":0,"stockStatus":"sold out"}}': False,
        '{"pdp":{"stockStatus":" In  Stock "}}': False, '{"pdp":{"availability":"OutOfStock"}}': True,
        '{"pdp":{"availability":"soon","badge":{"value":"Sold Out"}}}': True, '{"pdp":{"badge":{"value":"outofstock"}}}': False,
        '{"pdp":{}}': False, '{"pdp":{"badge":{"value":"نفدت الكمية"}}}': True,
    }
    assert rows_of(spark, list(cases), jsons.sold_out(jsons.parse_whole(F.col(X)))) == list(cases.values())


def test_image_url_normalisation(spark):
    cases = {
        "https://a/b": "https://a/b", "http://a": "http://a", "//a/b": "https://a/b", " /a/b": "https://a/b", "a/b": "https://a/b", " ": None,
    }
    got = rows_of(spark, list(cases), F.when(~text.is_blank_text(F.col(X)), urls.normalize_image_url(F.col(X))))
    assert got == list(cases.values())


def test_sites(spark):
    cases = {" Level ": ("level-shoes", "level-shoes"), "ounass": ("ounass", "ounass"), "shop": (None, "shop"), " ": (None, fv.MISSING_SITE), None: (None, fv.MISSING_SITE)}
    assert rows_of(spark, list(cases), urls.image_site(F.col(X))) == [c[0] for c in cases.values()]
    assert rows_of(spark, list(cases), urls.gate_site(F.col(X))) == [c[1] for c in cases.values()]


def test_dom_urls(spark):
    item = "https://www.farfetch.com/ae/shopping/women/some-bag-item-123.aspx?storeid=1"
    listing = "https://www.farfetch.com/ae/shopping/women/items.aspx"
    assert rows_of(spark, [item, listing], urls.dom_is_product(F.col(X))) == [True, False]
    assert rows_of(spark, [item, listing], urls.dom_item_id(F.col(X))) == ["123", None]
    assert rows_of(spark, [item, listing], urls.dom_gender(F.col(X))) == ["women", None]
    assert rows_of(spark, [item, listing], urls.dom_subfolder(F.col(X))) == ["some-bag-item-123", None]
    assert rows_of(spark, [item, listing, listing + "?page=2"], urls.dom_is_first_page(F.col(X))) == [False, True, False]


def test_api_urls(spark):
    cases = {
        "https://www.levelshoes.com/women/shoes/flats?x=1": ("ae", "women", "EN", "shoes/flats", True, False),
        "https://ar-saudi.levelshoes.com/men/bags": ("sa", "men", "AR", "bags", True, False),
        "https://kuwait.levelshoes.com/kids/a": ("kw", "kids", "EN", None, True, False),
        "https://qatar.levelshoes.com/ar/name.html": ("qa", None, "AR", None, False, True),
    }
    got = rows_of(spark, list(cases), F.struct(
        urls.api_country(F.col(X)), urls.api_gender(F.col(X)), urls.api_language(F.col(X)), urls.api_listing_path(F.col(X)),
        urls.api_is_listing(F.col(X)), urls.api_is_product(F.col(X))))
    assert [tuple(g) for g in got] == list(cases.values())


def test_suffixes(spark):
    cases = {"https://a/b.PNG?x=.gif": ".png", "https://a/b.tiff": ".jpg", "https://a.webp": ".jpg", "a/b.webp/": ".webp", "https://a/.png": ".jpg"}
    assert rows_of(spark, list(cases), urls.suffix_from_url(F.col(X))) == list(cases.values())


def test_run_keys(spark):
    prefix = "bronze/dev/crawls/metadata/"
    cases = {prefix + "s/2024-01-01/r/manifest.json": ("s", "2024-01-01", "r"), prefix + "s/manifest.json": None, "other/s/d/r/m": None}
    got = rows_of(spark, list(cases), urls.parse_run_key(F.col(X), prefix))
    assert [tuple(g) if g else None for g in got] == list(cases.values())
    assert rows_of(spark, ["Level-Shoes", "--", "a b"], urls.table_slug(F.col(X))) == ["bronze_level_shoes_raw", "bronze_raw_scrape", "bronze_a_b_raw"]


def test_badges(spark):
    badges = F.array(*[F.lit(b) for b in ["★EXCLUSIVE", " NEW ", "NEW", "*", "★", "", "** A"]])
    assert rows_of(spark, ["x"], text.clean_badges(badges)) == [["EXCLUSIVE", "NEW", "*", "★", "A"]]
    assert rows_of(spark, ["x"], text.clean_badges(F.array(F.lit(" ")))) == [None]


def test_page_fanout(spark):
    url = "https://s/items.aspx"
    got = rows_of(spark, ["1", "2", "4"], arrays.dom_page_urls(F.lit(url), F.col(X).cast("int"), 3))
    assert got == [[], [url, url + "?page=2"], [url, url + "?page=2", url + "?page=3"]]
    plain, done = "https://s/l?c=1", "https://s/l?fh_sort_by=-newness_ae&p=0"
    assert rows_of(spark, ["1"], F.size(arrays.state_page_urls(F.lit(plain), F.col(X).cast("int")))) == [1]
    assert rows_of(spark, ["1"], F.size(arrays.state_page_urls(F.lit(done), F.col(X).cast("int")))) == [0]
    assert rows_of(spark, ["3"], arrays.state_page_urls(F.lit(done), F.col(X).cast("int"))) == [
        [f"https://s/l?fh_sort_by=-newness_ae&p={p}" for p in (1, 2)]]


def test_item_list_offers(spark):
    block = json.dumps([{"@type": "Other"}, {"@type": "ItemList", "itemListElement": [
        {"offers": {"url": "/a"}}, {"offers": [{"url": "/b"}, {"url": "https://x"}, 3]}, {}]}])
    assert rows_of(spark, [block, "bad"], arrays.item_list_urls(F.col(X))) == [["https://www.farfetch.com/a", "https://www.farfetch.com/b"], []]


def test_backoff_delay(spark):
    got = rows_of(spark, ["0", "1", "2", "5", "9", "10", "2000"], text.backoff_delay(F.col(X).cast("int")))
    assert got == [1.0, 1.0, 2.0, 16.0, 256.0, 300.0, 300.0]
    assert rows_of(spark, ["7.5", "soon", None], text.retry_delay(F.lit(3), F.col(X))) == [7.5, 4.0, 4.0]


def test_plain_text(spark):
    cases = {"<p>a\n<b>b</b>&amp;\xa0c</p>": "a b&c", "<script>var t='</p>';</script>x": "var t='</p>';x", None: None, "": ""}
    assert rows_of(spark, list(cases), markup.plain_text(F.col(X))) == list(cases.values())


def test_run_id_and_switches(spark):
    ts = F.lit("2024-03-04 05:06:07.089").cast("timestamp")
    assert rows_of(spark, ["x"], text.run_id_of(ts)) == ["2024-03-04T05-06-07-089"]
    assert rows_of(spark, [" Yes ", "y", "0", None], text.to_bool(F.col(X))) == [True, True, False, False]
    assert rows_of(spark, ["y"], text.to_bool(F.col(X), words=fv.TRUE_WORDS_SETTINGS)) == [False]


def test_fetch_route_checks_backend(spark):
    with pytest.raises(ValueError):
        urls.fetch_route(F.col(X), "carrier pigeon")
    url = ["https://WWW.a.ae:443/x", "https://b.ae/x"]
    assert rows_of(spark, url, urls.fetch_route(F.col(X), "auto", ("www.a.ae",))) == ["requests", "api"]
