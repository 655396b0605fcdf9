"""Product extraction and listings on literal pages."""

import random
from html.parser import HTMLParser
from xml.etree.ElementTree import tostring

from pyspark.sql import functions as F

from shelfscope import fixed_values as fv
from shelfscope.checks import extraction
from shelfscope.functions import markup
from shelfscope.operators import listings, products

DAY = "2024-01-01"


def page(spark, html, url="https://www.levelshoes.com/product.html"):
    return spark.createDataFrame([(url, html)], "url string, html string")


def ld(body):
    return f'<script type="application/ld+json">{body}</script>'


# One small page per leg: what it holds, the field it should fill, and with what.
PAGE_CASES = [
    (ld('{"@type":"Product","sku":"QX-77-OLIVE"}'), "portal_itemid", "QX-77-OLIVE"),
    ('<meta itemprop="sku" content=" LOAF9 ">', "portal_itemid", "LOAF9"),
    ('<script>var cart = {"sku": "mrl-204"};</script>', "portal_itemid", "mrl-204"),
    ('<img src="https://pics.example/zz1204az00019977_3.jpg">', "portal_itemid", "ZZ1204AZ00019977"),
    (ld('{"@type":"Product","name":"  Marlow loafer"}'), "product_name", "Marlow loafer"),
    ('<meta property="og:title" content="Marlow loafer for Men - Olive">', "product_name", "Marlow loafer"),
    (ld('{"@type":"Product","brand":{"name":"Harrow & Pike"}}'), "brand", "Harrow & Pike"),
    (ld('{"@type":"Product","brand":" Tilda"}'), "brand", "Tilda"),
    ('<meta property="og:title" content="Anna van Dijk olive loafer for Women">', "brand", "Anna van Dijk"),
    (ld('{"@type":"BreadcrumbList","itemListElement":[{"position":2,"name":"Kids "},{"position":3,"name":"Sandals"}]}'), "gender", "Kids"),
    ("<nav><a>Start</a><a> Women </a></nav>", "gender", "Women"),
    (ld('[{"@type":"BreadcrumbList","itemListElement":[{"item":"https://shop.example/kids"},{"item":"https://shop.example/kids/hats/straw"}]}]'), "subcategory", "straw"),
    (ld('{"@graph":[{"@type":"WebPage"},{"@type":"BreadcrumbList","itemListElement":[{"item":{"@id":"https://shop.example/women/belts/wide"}}]}]}'), "category", "belts"),
    (ld('{"@graph":[[{"@graph":[{"@graph":{"@type":"Thing"}},[[{"@graph":[{"@type":"BreadcrumbList",'
        '"itemListElement":[{"item":"https://shop.example/men/socks/long"}]}]}]]]}]]}'), "category", "socks"),
    ('<meta property="product:price:amount" content="2,650 USD">', "price", 2650.0),
    (ld('{"@type":"Product","offers":{"price":"47.5","priceCurrency":"KWD "}}'), "price", 47.0),
    (ld('{"@type":"Product","offers":{"price":"47.5","priceCurrency":"KWD "}}'), "currency", "KWD"),
    ('<meta property="product:price:currency" content="SAR">', "currency", "SAR"),
    ('<script>{"discountPercentage":"25% OFF"}</script>', "price_discount", "25% OFF"),
    (f'<div class="{" ".join(fv.BADGE_RIBBON_CLASSES)}"><span class="badge">VEGAN</span><i></i><span class="badge-large">HANDMADE</span><span class="badge">VEGAN</span></div>',
     "primary_label", ["VEGAN", "HANDMADE"]),
    ("<em>no label</em>", "primary_label", None),
    ('<meta property="og:image" content="https://pics.example/front.webp">', "image_urls", ["https://pics.example/front.webp"]),
    (ld('{"@type":"Product","image":["side.png "]}'), "image_urls", ["side.png"]),
    ('<img src="heel_4.jpg"><img src="heel_1.JPG">', "image_urls", ["heel_1.JPG"]),
    ('<meta name="product:availability" content="Out Of Stock">', "out_of_stock", True),
    ('<meta name="twitter:label2" content="Availability"><meta name="twitter:data2" content="OUT OF STOCK"><meta name="product:availability" content="in stock">',
     "out_of_stock", False),
    ("<main></main>", "out_of_stock", False),
    (ld('{"@type":"Product","category":"518"}'), "level_category_id", 518),
    (ld('{"@type":"Product","category":7}'), "level_category_id", 7),
    (ld('{"@type":"Product","category":"loafers"}'), "level_category_id", None),
    ("<section>no panel</section>", "text", ""),
    ('<div class="accordion-root"><div class="accordion-details-root"><p>Woven by hand</p><p>in Porto</p></div>'
     '<button>More<span>Product Details</span></button><ul data-testid="lineitems"><li>Cork insole<li>Two  straps</ul></div>',
     "text", "Cork insole\nTwo straps\nWoven by hand in Porto"),
]


def test_page_fields(spark):
    pages = [(f"https://www.levelshoes.com/product{i}.html", case[0]) for i, case in enumerate(PAGE_CASES)]
    records = products.api_page_records(spark.createDataFrame(pages, "url string, html string"), "run", DAY)
    by_url = {r["url"]: r for r in records.collect()}
    assert [by_url[url][case[1]] for (url, _), case in zip(pages, PAGE_CASES)] == [case[2] for case in PAGE_CASES]


def test_sku_from_url(spark):
    url = "https://www.levelshoes.com/marlow-qx77-olive.html"
    assert products.api_page_records(page(spark, "<p>", url), "run", DAY).first()["portal_itemid"] == "MARLOW-QX77-OLIVE"


def test_sold_out_page_hides_price(spark):
    html = ("<meta property='twitter:data1' content='AED 5,108'><meta property='og:image' content='i.jpg'>"
            "<p data-component='LabelPrimary'>Sold Out</p><p data-testid='product-short-description'> Big  bag </p>")
    url = "https://www.farfetch.com/ae/shopping/women/big-bag-item-77.aspx?x=1"
    record = products.extract_products(page(spark, html, url), fv.DOM_SITE, "run", DAY).first()
    assert (record["price"], record["currency"], record["image_urls"], record["out_of_stock"]) == (None, None, None, True)
    assert (record["url"], record["portal_itemid"], record["country"], record["gender"], record["product_name"]) == (
        url.split("?")[0], "77", "ae", "women", "Big bag")


def test_state_record_and_rejects(spark):
    state = ('{"country":"AE","currency":"AED","pdp":{"visibleSku":"1","name":"N","price":10.5,"discountPercent":20,"images":[{"oneX":"//i/x.jpg"}],'
             '"contentTabs":[{"tabId":"designDetails","html":"<b>D</b>"},{"tabId":"sizeAndFit","html":"F\\n"}]}}')
    script = '<script>var x = {"routeType":"new-pdp"}; window.initialState = ' + state + ";</script>"
    pages = spark.createDataFrame(
        [("https://www.ounass.ae/a.html", script), ("https://www.ounass.ae/b.html", "<p>"), ("https://www.ounass.ae/list", script)], "url string, html string")
    records = products.state_products(pages, "run", DAY).collect()
    assert len(records) == 1 and records[0]["price"] == 10.5 and records[0]["price_discount"] == "20"
    assert records[0]["text_parts"] == {"design_details": "D", "size_fit": "F "} and records[0]["language"] == "EN"
    assert records[0]["image_urls"] == ["i/x.jpg"]
    assert [tuple(r) for r in products.state_rejects(pages).collect()] == [("https://www.ounass.ae/b.html", "no_state")]


def test_listing_payload_slugs(spark):
    payload = ('{"page":0,"routeType":"plp","pagination":{"totalPages":2},"hits":[{"slug":"b"},{"slug":"a","configurableAttributes":'
               '[{"options":[{"attributeSpecificProperties":{"slug":"c"}},{"attributeSpecificProperties":null},{}]}]},{"slug":"a"}]}')
    done = "https://www.ounass.ae/l?fh_sort_by=-newness_ae&p=0"
    found = listings.expand_state_listings(page(spark, payload, done)).collect()
    assert [r["found_url"] for r in found if r["kind"] == "product"] == [f"https://www.ounass.ae/{s}.html" for s in "abc"]
    assert [r["found_url"] for r in found if r["kind"] == "listing"] == ["https://www.ounass.ae/l?fh_sort_by=-newness_ae&p=1"]
    plain = listings.expand_state_listings(page(spark, payload, "https://www.ounass.ae/l")).collect()
    assert {r["kind"] for r in plain} == {"listing"} and len(plain) == 2


def test_api_pages_stop_at_the_first_empty_one(spark):
    item = '{"products":[{"name":"n","action":{"url":"https://www.levelshoes.com/a.html"}}]}'
    rows = [("l", 0, item), ("l", 1, item), ("l", 2, '{"products":[]}'), ("l", 3, item), ("m", 0, item), ("m", 1, "broken")]
    items = listings.api_items(spark.createDataFrame(rows, "url string, page int, payload string"))
    assert sorted((r["url"], r["page"]) for r in items.collect()) == [("l", 0), ("l", 1), ("m", 0)]
    record = products.api_item_records(items, "run", DAY).first()
    assert (record["country"], record["language"], record["category"], record["primary_label"]) == ("ae", "EN", None, None)
    pages = page(spark, '<meta property="product:price:amount" content="7 AED">', "https://www.levelshoes.com/a.html")
    merged = products.api_products(items, pages, "run", DAY).collect()
    assert len(merged) == 1 and merged[0]["product_name"] == "n" and merged[0]["price"] == 7.0


ODD = ["", "<", "<p", "</p></p>", "<![bad", "<!--", "<a" * 3000, "<div>" * 3000, "<script>", "&#x110000;", "<meta content>"]


def test_odd_markup_never_fails(spark):
    pages = spark.createDataFrame([(html,) for html in ODD], "html string")
    found = pages.select(markup.page_signals(F.col("html")).alias("s"), markup.plain_text(F.col("html")).alias("t")).collect()
    assert [r["s"]["details_found"] for r in found] == [False] * len(ODD)


class Standard(markup._Tree):
    """Every tag by the rules of the standard library."""

    parse_starttag, parse_endtag, updatepos = HTMLParser.parse_starttag, HTMLParser.parse_endtag, HTMLParser.updatepos


def test_plain_tags_are_read_as_the_standard_parser_reads_them():
    pick = random.Random(5)
    some = [
        "<p>", "</p>", "<li>", "<div class='a b'>", '<a href="x" id=\'\'>', "</a>", "<br>", "<br/>", "<B>", "</B >", "<p class=x>", "<a title='a>b'>", "<a b>", "<p\ta='1'>",
        "<p  a='1'>", "<p a='&amp;'>", "<p a='1' a='2'>", "<p a='1'b='2'>", "<script>", "</script>", "<title>", "</title>", "<style>", "</style>", "<textarea>", "</textarea>",
        "<!-- x -->", "<!doctype html>", "<", ">", "&lt;", "&", "text", "\n", "<p a='", "</", "</ p>", "<svg:a x:href='1'>", "<a data-b-c=\"it's\">", "<h1\na='1'>", "</h1>", "<É>",
    ]
    for _ in range(4000):
        page = "".join(pick.choices(some, k=pick.randint(1, 14)))
        trees = []
        for kind in (markup._Tree, Standard):
            parser = kind()
            parser.feed(page)
            parser.close()
            trees.append(tostring(parser.root))
        assert trees[0] == trees[1], page


def test_pages_made_of_a_small_table_are_parsed_on_all_cores(spark, monkeypatch):
    monkeypatch.setattr(extraction, "table", lambda *_: spark.createDataFrame([(1, "n", "b", "t u", 1, 1.0)], ", ".join(
        f"{name} {kind}" for name, kind in zip(extraction.PART, ("long", "string", "string", "string", "int", "double"), strict=True)
    )).coalesce(1))
    for made in (extraction.dom_pages, extraction.state_pages, extraction.api_pages, extraction.api_payloads):
        assert made(spark, "").rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism > 1
