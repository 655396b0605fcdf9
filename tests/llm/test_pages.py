import numpy as np
import pytest

from shelfscope.llm.page_text import cluster_threshold, extract_pages, main_text, smoothed

LONG = "Plain words that make up a long enough line of an article about rivers and the towns along them."
MENU = '<ul><li><a href="/a">Home</a></li><li><a href="/b">News</a></li><li><a href="/c">About us</a></li></ul>'

CASES = [
    ("nothing", "", ""),
    ("plain text", "just  text\n here", "just text here"),
    ("only menus", f"<nav>{MENU}</nav>", ""),
    ("article", f"<header><h1>Site</h1></header><nav>{MENU}</nav><article><h1>T &amp; t</h1><p>{LONG}</p><p>Yes.</p></article><footer>&copy;</footer>",
     f"T & t {LONG} Yes."),
    ("unclosed paragraphs", f"<article><p><b>One<br><p>{LONG}<p>Two  <i>thr</i>ee</article><div class=ad>Buy now, buy now, buy now and more</div>", f"One {LONG} Two three"),
    ("scripts and comments", f"<article><script>var a = '<p>x</p>';</script><!-- note --><style>p {{}}</style><p>{LONG}</p></article>", LONG),
    ("sidebar and notice", f"<div id=main><p>{LONG}</p><p>{LONG}</p></div><div class='left sidebar'><p>{LONG}</p></div><div class=cookie-notice>{LONG}</div>",
     f"{LONG} {LONG}"),
    ("reader comments inside", f"<article><p>{LONG}</p><section id=comments><p>{LONG}</p></section></article>", LONG),
    ("form", f"<main><p>{LONG}</p><form><label>Name</label><input><button>Send</button></form></main>", LONG),
    ("character references", f"<article><p>&lt;b&gt; &eacute;&#233;&nbsp;x {LONG}</p></article>", f"<b> éé x {LONG}"),
    ("no containers", f"<body><div>{MENU}</div><p>{LONG}</p><p>Short.</p><p>{LONG}</p></body>", f"{LONG} Short. {LONG}"),
    ("stray end tags", f"</div></p><article></b><p>{LONG}</span></p></article></article>", LONG),
    ("upper case and odd quotes", f"<ARTICLE><P CLASS=x>{LONG}</P></ARTICLE><DIV CLASS='AD'>{LONG}</DIV>", LONG),
    ("marked section", f"<article><![odd[x]]><p>{LONG}</p></article>", None),
    ("unfinished tag", f"<article><p>{LONG}</p></article><div class=", LONG),
]


@pytest.mark.parametrize("name, html, want", CASES, ids=[c[0] for c in CASES])
def test_main_text(name, html, want):
    got = main_text(html)
    assert got == want if want is not None else LONG in got


WRAPPERS = ["content no-sidebar", "with-sidebar", "has-comments", "elementor-widget elementor-widget-theme-post-content", "widget-area-content", "sidebar"]


@pytest.mark.parametrize("name", WRAPPERS)
def test_wrappers_keep_their_article(name):
    comments = f"<div id=comments><article class=comment><p>{LONG}</p><p>{LONG}</p><p>{LONG}</p></article></div>"
    assert main_text(f"<body><div class='{name}'><article><p>{LONG}</p><p>Yes.</p></article></div></body>") == f"{LONG} Yes."
    assert main_text(f"<body><div class='{name}'><article><p>{LONG}</p></article>{comments}</div></body>") == LONG
    assert main_text(f"<body><div class='{name}'><p>{LONG}</p><p>{LONG}</p></div></body>") == f"{LONG} {LONG}"


@pytest.mark.parametrize("attribute", ["id=discussion", "class=social-history", "class=share-price", "id=ad-hoc"])
def test_sections_with_ordinary_names_stay(attribute):
    assert main_text(f"<article><p>{LONG}</p><section {attribute}><p>{LONG}</p></section></article>") == f"{LONG} {LONG}"


@pytest.mark.parametrize("name", ["ad", "ad-slot", "left sidebar", "sidebar-right", "cookie-notice", "comments-area", "social-share", "share-buttons", "sponsored-content"])
def test_marked_elements_go(name):
    assert main_text(f"<article><p>{LONG}</p><div class='{name}'><p>{LONG}</p><p>{LONG}</p></div></article>") == LONG


@pytest.mark.parametrize("tag", ["div", "section", "p", "td"])
def test_one_very_long_block_among_short_ones(tag):
    short = [f"{i} " + " ".join([LONG] * 3) for i in range(20)]
    blocks = [*short[:9], LONG * 200, *short[9:]]
    inner = f"<h1>Head</h1><{tag}>" + f"</{tag}><{tag}>".join(blocks) + f"</{tag}><p>The end.</p>"
    if tag == "td":
        inner = "<h1>Head</h1><table><tr>" + "".join(f"<td>{b}</td>" for b in blocks) + "</tr></table><p>The end.</p>"
    want = " ".join(["Head", *blocks, "The end."])
    assert main_text(f"<body><div>{MENU}</div>{inner}<div>{MENU}</div></body>") == want
    assert main_text(f"<body><div>{MENU}</div><div>{inner}</div><nav>{MENU}</nav></body>") == want


def test_siblings_and_links_inside_stay():
    html = f"<body>Site<div>{MENU}</div><div><h2>A</h2><p>{LONG}</p>{MENU}<p>Short.</p></div><div><p>{LONG}</p></div><div>{MENU}</div></body>"
    assert main_text(html) == f"Site A {LONG} Home News About us Short. {LONG}"


def test_deep_and_long_pages_end():
    assert main_text("<div>" * 5000 + LONG + "</div>" * 5000) == LONG
    assert main_text("<p><b>x" * 20_000 + "</i>" * 20_000).startswith("x x x")


def test_smoothing_and_threshold():
    values = np.array([1.0, 1, 1, 50, 60, 55, 1, 1])
    near = smoothed(values)
    assert near.max() < 60 and near.argmax() == 4 and np.allclose(smoothed(np.full(5, 3.0)), 3)
    assert 1 < cluster_threshold(values) < 50 and cluster_threshold(np.full(3, 2.0)) == 2


def test_tables(spark):
    pages = spark.createDataFrame([(1, "u", None, "x"), (None, None, f"<article><p>{LONG}</p></article>", "y"), (1, "u", None, "x")], "page_id long, url string, html string, n_chars string")
    got = extract_pages(pages, "html", "page_id", "url")
    assert got.columns == ["page_id", "url", "text"]
    assert sorted(map(tuple, got.collect()), key=str) == sorted([(1, "u", ""), (1, "u", ""), (None, None, LONG)], key=str)
    assert extract_pages(pages.limit(0), "html", "page_id", "url").collect() == []
