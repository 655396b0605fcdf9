"""Page markup.

Script bodies and the JSON inside them are read natively. What needs a document tree (meta
tags, breadcrumbs, badges, accordions) comes from one small Arrow helper, `page_signals`,
which parses a page once and returns raw texts; every rule and fallback over those texts is a
Column expression again.
"""

from __future__ import annotations

import json
import re
from html.parser import HTMLParser
from xml.etree.ElementTree import Element, SubElement

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F

from shelfscope import fixed_values as fv
from shelfscope.functions import jsons
from shelfscope.functions.text import none_if_empty, strip

SIGNALS = (
    "metas array<struct<attr:string,key:string,content:string>>, images array<string>, img_srcs array<string>, "
    "crumbs array<string>, nav_texts array<string>, ribbon_badges array<string>, badge_spans array<string>, "
    "details_found boolean, detail_bullets array<string>, detail_texts array<string>, "
    "short_description string, brand_text string, discount_text string, label_text string, "
    "pagination_text string, highlights array<string>, composition string"
)
_SIGNAL_NAMES = [
    "metas", "images", "img_srcs", "crumbs", "nav_texts", "ribbon_badges", "badge_spans", "details_found",
    "detail_bullets", "detail_texts", "short_description", "brand_text", "discount_text", "label_text",
    "pagination_text", "highlights", "composition",
]

_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
# Opening one of these ends an open sibling of the listed kinds.
_ENDS = {
    "li": {"li"}, "option": {"option"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"},
    "dt": {"dt", "dd"}, "dd": {"dt", "dd"},
    **{tag: {"p"} for tag in ("p", "div", "ul", "ol", "h1", "h2", "h3", "h4", "table", "section", "article", "nav")},
}


#: Tags without anything that the standard parser would decode, mend or read on from: most tags of a page.
_PLAIN_START = re.compile(r"""<([a-z][a-z0-9]*)((?:[ \n][a-z][a-z0-9:-]*=(?:"[^"<>&]*"|'[^'<>&]*'))*)>""")
_PLAIN_VALUE = re.compile(r"""[ \n]([a-z][a-z0-9:-]*)=(?:"([^"]*)"|'([^']*)')""")
_PLAIN_END = re.compile(r"</([a-z][a-z0-9]*)>")
#: What these hold is no markup, or not in every release of the standard parser.
_RAW = {"script", "style", "textarea", "title", "iframe", "noembed", "noframes", "noscript", "xmp", "plaintext"}


class _Tree(HTMLParser):
    """Markup to an element tree; tolerant of missing and stray end tags.

    Plain tags are read by one pattern, which is faster; all others by the standard rules.
    """

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.root = Element("root")
        self.open = [self.root]

    def updatepos(self, i, j):
        return j  # line numbers are not asked for

    def parse_starttag(self, i):
        plain = _PLAIN_START.match(self.rawdata, i)
        if plain is None or plain[1] in _RAW:
            return super().parse_starttag(i)
        self.handle_starttag(plain[1], [(name, a or b) for name, a, b in _PLAIN_VALUE.findall(plain[2])])
        return plain.end()

    def parse_endtag(self, i):
        plain = None if self.cdata_elem else _PLAIN_END.match(self.rawdata, i)
        if plain is None:
            return super().parse_endtag(i)
        self.handle_endtag(plain[1])
        return plain.end()

    def handle_starttag(self, tag, attrs):
        if self.open[-1].tag in _ENDS.get(tag, ()):
            self.open.pop()
        node = SubElement(self.open[-1], tag, {k: v or "" for k, v in attrs})
        if tag not in _VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        SubElement(self.open[-1], tag, {k: v or "" for k, v in attrs})

    def handle_endtag(self, tag):
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].tag == tag:
                del self.open[depth:]
                return

    def handle_data(self, data):
        parent = self.open[-1]
        if len(parent):
            parent[-1].tail = (parent[-1].tail or "") + data
        else:
            parent.text = (parent.text or "") + data


def _own_texts(node: Element) -> list[str]:
    return [t for t in [node.text, *(child.tail for child in node)] if t]


def _squeeze(text: str) -> str:
    return re.sub(r"[ \t\r\n]+", " ", text).strip(" ")


def _text_outside_svg(node: Element) -> str:
    if node.tag == "svg":
        return ""
    return (node.text or "") + "".join(_text_outside_svg(c) + (c.tail or "") for c in node)


def _first_text(root: Element, path: str) -> str | None:
    return next((t for node in root.iterfind(path) for t in _own_texts(node)), None)


def _next_sibling(root: Element, heading: str, tag: str) -> Element | None:
    """First following `tag` sibling of the h4 with this text."""
    for parent in root.iter():
        if parent.find("h4") is None:
            continue
        seen = False
        for child in parent:
            if seen and child.tag == tag:
                return child
            seen = seen or (child.tag == "h4" and _squeeze("".join(child.itertext())) == heading)
    return None


def _classed(root: Element, tag: str, *parts: str) -> list[Element]:
    found = [(n, n.get("class")) for n in root.iter(tag)]
    return [n for n, own in found if own and all(p in own for p in parts)]


def _signals(html: str) -> dict:
    parser = _Tree()
    parser.feed(html)
    parser.close()
    root = parser.root
    metas, images, of_kind = [], [], {}
    for node in root.iter():
        of_kind.setdefault(node.tag, []).append(node)
        if node.tag == "meta":
            metas += [
                {"attr": a, "key": node.get(a), "content": node.get("content")}
                for a in ("name", "property", "itemprop") if node.get(a)
            ]
            if node.get("property") == "og:image" and node.get("content") is not None:
                images.append(node.get("content"))
        elif node.tag == "img" and node.get("src") is not None:
            images.append(node.get("src"))

    def with_value(tag: str, attr: str, value: str) -> list[Element]:
        return [n for n in of_kind.get(tag, ()) if n.get(attr) == value]

    def first_text(nodes: list[Element]) -> str | None:
        return next((t for node in nodes for t in _own_texts(node)), None)

    ribbons = [
        d for d in _classed(root, "div", *fv.BADGE_RIBBON_CLASSES) if _classed(d, "span", "badge")
    ]
    panel = next(
        (
            d for d in _classed(root, "div", "accordion-root")
            if any(
                _squeeze("".join(x.itertext())) in fv.DETAILS_HEADINGS
                for b in d.iter("button") for x in b.iter() if x is not b
            )
        ),
        None,
    )
    panel_texts, bullets = [], []
    if panel is not None:
        for d in panel.iter("div"):
            if "accordion-details-root" in d.get("class", "").split():
                panel_texts += [t for p in d.findall("p") for t in _own_texts(p)]
        bullets = [t for li in panel.iterfind(".//ul[@data-testid='lineitems']//li") for t in _own_texts(li)]
    highlights, made_of = _next_sibling(root, "Highlights", "ul"), _next_sibling(root, "Composition", "p")
    short = next(iter(with_value("p", "data-testid", "product-short-description")), None)
    return {
        "metas": metas,
        "images": images,
        "img_srcs": [n.get("src") for n in of_kind.get("img", ()) if n.get("src") is not None],
        "crumbs": [
            t for li in with_value("li", "data-component", "BreadcrumbWrapper") for a in li.findall("a") for t in _own_texts(a)
        ],
        "nav_texts": [
            t for nav in of_kind.get("nav", ()) for x in nav.iter() if x.tag in ("a", "span", "li") for t in _own_texts(x)
        ],
        "ribbon_badges": [_text_outside_svg(s) for d in ribbons for s in d.iter("span")],
        "badge_spans": [_text_outside_svg(s) for s in _classed(root, "span", "badge")],
        "details_found": panel is not None,
        "detail_bullets": bullets,
        "detail_texts": panel_texts,
        "short_description": None if short is None else _squeeze("".join(short.itertext())),
        "brand_text": first_text(with_value("a", "data-ffref", "pp_infobrd")),
        "discount_text": first_text(with_value("p", "data-component", "PriceDiscount")),
        "label_text": first_text(with_value("p", "data-component", "LabelPrimary")),
        "pagination_text": _first_text(
            root, ".//div[@data-component='Pagination']//span[@data-component='PaginationLabel']"
        ),
        "highlights": [] if highlights is None else [t for li in highlights.iter("li") for t in _own_texts(li)],
        "composition": None if made_of is None else _squeeze("".join(made_of.itertext())),
    }


def page_signals(html: Column) -> Column:
    """Struct of raw texts per page. Only the markup column goes through Arrow."""

    def one(page: str | None) -> dict:
        try:
            return _signals(page or "")
        except (AssertionError, RecursionError):  # markup the parser cannot follow: no signals, not a failed job
            return _signals("")

    def parse(pages: pd.Series) -> pd.DataFrame:
        return pd.DataFrame([one(page) for page in pages], columns=_SIGNAL_NAMES)

    return F.pandas_udf(parse, SIGNALS)(html)


def _plain_text(html: str | None) -> str | None:
    if html is None:
        return None
    parts: list[str] = []
    parser = HTMLParser(convert_charrefs=True)
    parser.handle_data = parts.append
    parser.feed(html)
    # No close(): text after an unfinished tag or entity at the very end is left out.
    return "".join(parts)


def plain_text(html: Column) -> Column:
    """Text nodes of a fragment: newlines to spaces, NBSP and RLM removed."""

    def clean(fragments: pd.Series) -> pd.Series:
        return fragments.map(_plain_text)

    # A newline becomes a space; the other two have no counterpart and are removed.
    return F.translate(F.pandas_udf(clean, "string")(html), "\n\u00a0\u200f", " ")


# --- native legs ------------------------------------------------------------------------


def scripts(html: Column) -> Column:
    """Bodies of all script elements."""
    return F.regexp_extract_all(html, F.lit(r"(?is)<script\b[^>]*>(.*?)</script\s*>"), F.lit(1))


def ld_json_blocks(html: Column) -> Column:
    return F.regexp_extract_all(
        html,
        F.lit(r"""(?is)<script\b[^>]*type\s*=\s*["']?application/ld\+json["']?[^>]*>(.*?)</script\s*>"""),
        F.lit(1),
    )


def ld_items(blocks: Column) -> Column:
    """Top-level objects of all readable blocks, in page order."""
    return F.flatten(
        F.transform(
            blocks, lambda b: jsons.bind(jsons.parse_whole(b), lambda v: F.coalesce(jsons.as_list(v), F.array(v)))
        )
    )


def _leaf_objects(blocks: list[str] | None) -> list[str]:
    """JSON texts of all objects that are not mere containers, in page order; works off a stack, so depth does not matter."""
    found: list[str] = []
    for block in [] if blocks is None else blocks:
        try:
            todo = [json.loads(block)]
        except (ValueError, RecursionError):
            continue
        while todo:
            value = todo.pop()
            graph = value.get("@graph") if isinstance(value, dict) else None
            if isinstance(value, list) or isinstance(graph, list):
                todo += reversed(value if isinstance(value, list) else graph)
            elif isinstance(value, dict):
                found.append(json.dumps(value, ensure_ascii=False))
    return found


def ld_nodes(blocks: Column) -> Column:
    """Objects of JSON-LD blocks at any depth of lists and @graph containers.

    Columns cannot descend without a limit, so one Arrow function lays the nesting flat.
    """

    def flat(pages: pd.Series) -> pd.Series:
        return pages.map(_leaf_objects)

    return F.transform(F.pandas_udf(flat, "array<string>")(blocks), jsons.parse_whole)


def of_type(items: Column, name: str) -> Column:
    return F.filter(items, lambda v: jsons.path_text(v, "$['@type']") == name)


def first_value(items: Column, path: str) -> Column:
    """First non-empty text at a path over a list of objects."""
    return F.get(
        F.filter(F.transform(items, lambda v: jsons.truthy_text(jsons.path_value(v, path))), lambda s: s.isNotNull()),
        F.lit(0),
    )


def meta_content(signals: Column, *wanted: tuple[str, str]) -> Column:
    """Content of the first meta tag whose (attribute, value) is one of `wanted`."""

    def hit(m: Column) -> Column:
        test = F.lit(False)
        for attr, key in wanted:
            test = test | ((m["attr"] == attr) & (m["key"] == key))
        return test & m["content"].isNotNull()

    return F.get(F.filter(signals["metas"], hit), F.lit(0))["content"]


def embedded_state(html: Column) -> Column:
    """VARIANT of the state object in the product script, NULL if absent or unreadable."""
    script = F.get(F.filter(scripts(html), lambda s: s.contains(fv.STATE_SCRIPT_MARK)), F.lit(0))
    return jsons.parse_whole(none_if_empty(F.regexp_extract(script, fv.STATE_PATTERN, 1)))


def page_title(html: Column) -> Column:
    return none_if_empty(strip(F.regexp_extract(html, r"(?is)<title[^>]*>(.*?)</title>", 1)))
