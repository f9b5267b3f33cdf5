"""Main text of web pages: flat blocks classified by a small decision tree.

A page is read once into flat text blocks (text between block-level tags).
Each block has its word count and link density, those of the blocks before and
after, whether it stands in the article, and weak hints: a container that by its
tag holds no article text, one that by its class or id may not, and the share of
the page's words in it.  A container around an article or ``main`` hints
at nothing, whatever it is called.  A CART tree, trained on the blocks of the
small marked pages below, says which blocks are main text; no hint decides alone.

Defined results: a null or empty page has empty text; unclosed tags end with
the page; an unclosed comment, script or style swallows the rest, as browsers
do; ``<br>`` is white space; a page in which no block is main text has empty
text.  Null ids and repeated rows are kept; other columns are ignored.  Reading
takes time in proportion to the page, however deep or broken it is.
"""
from __future__ import annotations

import html as entities
import re
from collections import Counter
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import arrow_schema, pick, schema, small_batches

_TAG = re.compile(r"""<(/?)([a-zA-Z][^\s/>"'<]*)((?:"[^"]*"|'[^']*'|[^'"<>])*+)>""")
_LOOSE = re.compile(r"<(/?)([a-zA-Z][^\s/>\"'<]*)([^<>]*)>")
_ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
_RAW = frozenset("script style noscript template textarea title iframe select svg math object noembed noframes xmp".split())
_CLOSERS = {t: re.compile(rf"</{t}(?=[\s/>])", re.I) for t in _RAW}
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr br picture source track audio video embed input".split()
)
_BOILER_TAGS = frozenset("nav footer aside form dialog menu button fieldset".split())
_BOILER_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog menu menubar form".split())
_HINTS = frozenset(
    "ad ads adv advert adverts advertisement advertising adbox sponsor sponsored promo promotion banner cookie cookies consent gdpr notice notification alert popup modal overlay "
    "comment comments commentlist disqus respond replies reply sidebar sidebars widget widgets related recommended share sharing social menu nav navbar navigation breadcrumb breadcrumbs "
    "footer masthead topbar toolbar newsletter subscribe subscription signup paywall pagination hidden".split()
)
#: Words that make a name tell of a state of something else: ``has-sidebar``, ``comments-open``.
_STATES = frozenset("has with is no not without open opened closed enabled disabled active inactive on off show shows layout".split())
_HEADERS = frozenset("header site-header page-header main-header global-header site-head".split())
_SPLIT = re.compile(r"[^a-z0-9]+")
_CAMEL = re.compile(r"(?<=[a-z0-9])(?=[A-Z])")
_UNSEEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)


class _Box:
    """An open container.  hint: 0, 0.5 if a state of it is named, 1."""

    __slots__ = ("tag", "parent", "article", "boiler", "hint", "holds", "words")

    def __init__(self, tag: str, parent: _Box | None, attributes: dict[str, str]):
        self.tag, self.parent, self.holds, self.words = tag, parent, False, 0
        role = attributes.get("role", "").lower()
        own = tag in ("article", "main") or role in ("main", "article") or attributes.get("itemprop", "").lower() == "articlebody"
        self.article = own or parent is not None and parent.article
        self.boiler = tag in _BOILER_TAGS or tag == "header" and not self.article or role in _BOILER_ROLES or _hidden(attributes)
        self.hint = 0.0 if tag in ("html", "body") or own or not attributes else _hint(attributes, self.article)
        if own:
            above = parent
            while above is not None and not above.holds:
                above.holds = True
                above = above.parent


@dataclass
class Block:
    text: str
    words: int
    link_density: float
    box: _Box | None


def _attributes(source: str) -> dict[str, str]:
    return {m[1].lower(): (m[2] or "").strip("\"'") for m in _ATTRIBUTE.finditer(source)}


def _hidden(attributes: dict[str, str]) -> bool:
    return "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or bool(_UNSEEN.search(attributes.get("style", "")))


def _hint(attributes: dict[str, str], in_article: bool) -> float:
    most = 0.0
    for name in (*attributes.get("class", "").split(), attributes.get("id", "")):
        words = {*_SPLIT.split(_CAMEL.sub("-", name).lower())}
        if words & _HINTS or not in_article and name.lower() in _HEADERS:
            most = max(most, 0.5 if words & _STATES else 1.0)
    return most


def blocks(page: str) -> tuple[list[Block], list[_Box]]:
    """The flat text blocks of a page and its containers, both in order."""
    found: list[Block] = []
    boxes: list[_Box] = []
    stack: list[_Box] = []
    open_tags: Counter = Counter()
    parts: list[tuple[str, bool]] = []
    links, at, end = 0, 0, len(page)

    def flush() -> None:
        if parts:
            text = " ".join(entities.unescape("".join(p for p, _ in parts)).split())
            if text:
                words = text.count(" ") + 1
                linked = sum(len(entities.unescape(p).split()) for p, link in parts if link)
                found.append(Block(text, words, min(1.0, linked / words), stack[-1] if stack else None))
                if stack:
                    stack[-1].words += words
            parts.clear()

    def enter(tag: str, attributes: dict[str, str]) -> None:
        stack.append(_Box(tag, stack[-1] if stack else None, attributes))
        boxes.append(stack[-1])
        open_tags[tag] += 1

    def leave() -> str:
        tag = stack.pop().tag
        open_tags[tag] -= 1
        return tag

    while at < end:
        lt = page.find("<", at)
        if lt < 0:
            lt = end
        if lt > at:
            parts.append((page[at:lt], links > 0))
        if lt == end:
            break
        if page.startswith("<!--", lt):
            close = page.find("-->", lt + 4)
            at = end if close < 0 else close + 3
            continue
        if page.startswith(("<!", "<?"), lt):
            close = page.find(">", lt)
            at = end if close < 0 else close + 1
            continue
        m = _TAG.match(page, lt) or _LOOSE.match(page, lt)
        if not m:
            parts.append(("<", links > 0))
            at = lt + 1
            continue
        at, closing, tag = m.end(), m[1] == "/", m[2].lower()
        if tag in _RAW:
            if not closing and not m[3].endswith("/"):
                close = _CLOSERS[tag].search(page, at)
                if not close:
                    at = end
                else:
                    gt = page.find(">", close.end())
                    at = end if gt < 0 else gt + 1
            if tag in ("title", "iframe", "select", "textarea", "object"):
                flush()
            continue
        if tag == "br":
            parts.append((" ", False))
            continue
        if tag in _INLINE:
            if tag == "a":
                links = 0 if closing else 1
                if closing:
                    parts.append(("", False))
                continue
            if tag in _VOID or (tag != "span" or not closing and not m[3]) and not (stack and stack[-1].tag == tag):
                continue
        if closing:
            if open_tags[tag]:
                flush()
                while leave() != tag:
                    pass
                links = 0
            elif tag not in _INLINE:
                flush()
            continue
        attributes = _attributes(m[3]) if m[3] else {}
        if tag == "span":
            # Only a span that may be no text is a container.
            if _hidden(attributes) or _hint(attributes, bool(stack) and stack[-1].article):
                flush()
                enter(tag, attributes)
            continue
        flush()
        links = 0
        while stack and stack[-1].tag == "p":
            leave()
        if tag not in _VOID and not m[3].endswith("/"):
            enter(tag, attributes)
    flush()
    return found, boxes


def features(found: list[Block], boxes: list[_Box]) -> list[tuple]:
    """Per block: words, link density; those of the block before and of the block after
    (0, 0 at an end of the page); in the article; in a container that by its tag is
    none; hint of the containers around it; the least share of the page's words that
    such a container holds (1 without one); 1 if the page has an article and this
    block is outside."""
    for box in reversed(boxes):
        if box.parent:
            box.parent.words += box.words
    total = sum(b.words for b in found) or 1
    around: dict[_Box | None, tuple] = {None: (0, 0.0, 1.0)}
    for box in boxes:
        boiler, hint, share = around[box.parent]
        if not box.holds and (box.boiler or box.hint):
            boiler, hint, share = boiler or int(box.boiler), max(hint, box.hint), min(share, box.words / total)
        around[box] = boiler, hint, share
    any_article = any(b.box is not None and b.box.article for b in found)
    sides = [(0, 0.0), *((b.words, b.link_density) for b in found), (0, 0.0)]
    return [
        (b.words, b.link_density, *sides[i], *sides[i + 2], int(article := b.box is not None and b.box.article), *around[b.box], int(any_article and not article))
        for i, b in enumerate(found)
    ]


#: The labelled table: small pages; {n} stands for n words, and * begins main text.
MARKED = (
    # An article between a menu, adverts and a footer; paragraphs of all lengths.
    "<body><nav><ul><li><a>{1}</a><li><a>{1}</a><li><a>{2}</a><li><a>{1}</a></ul></nav><div class=ad>{9}</div><article><h1>*{9}</h1><p>*{80}<br>{40}<p>*{120}</p><p>*{2}</p><p>*{18}</p>"
    "<p>*{1}</p><p>*{240}</p><p>*{1}</p><p>*{3}</p><p>*{44} <a>{4}</a></p><p>*{7}</p></article><footer>{9}</footer>",
    "<body><nav><a>{1}</a> <a>{1}</a></nav><div class=ad>{14}</div><article><h1>*{3}</h1><p>*{1}</p><p>*{5}</p><p>*{1}</p></article><footer>{3} <a>{1}</a></footer>",
    "<body><ul class=menu><li><a>{2}</a><li><a>{1}</a></ul><article><p>*{300}</p><h2>*{4}</h2><p>*{1}</p><p>*{64}</p></article><footer><p>{30}</p></footer>",
    # Names that tell of states, around and on the article; bars, forms and lists of links in it.
    "<body class='single comments-open'><div id=header><h1>{1}</h1><p>{6}</p></div><div class='breadcrumb'><a>{1}</a> <a>{2}</a> {3}</div><div class='layout has-sidebar'><main><article class='post comments-open'>"
    "<header><h1>*{8}</h1><p>*{5}</p></header><div class=share-bar><a>{1}</a> <a>{1}</a></div><p>*{60}</p><p>*{12} <a>{8}</a></p><p><a>*{4}</a></p><p>*{90}</p><aside>{25}</aside><p>*{30}</p>"
    "<div class='ad-slot'><p>{12}</p></div><p>*{6}</p><form><label>{2}</label><button>{1}</button></form><div class=related-posts><h3>{2}</h3><ul><li><a>{6}</a><li><a>{7}</a></ul></div></article>"
    "<section id=comments><h3>{2}</h3><div class=comment><p>{70}</p></div><div class=comment><p>{4}</p></div></section></main><div class=sidebar><div class=widget><h3>{2}</h3><ul><li><a>{3}</a><li><a>{5}</a></ul></div>"
    "<div class=widget><p>{24}</p></div></div></div><div class=site-footer>{11} <a>{2}</a></div>",
    "<body><div class='cookie-consent'><p>{45}</p><button>{1}</button></div><div class='page sidebar-open'><article class='no-comments'><h1>*{6}</h1><p>*{150}</p><blockquote><p>*{26}</p></blockquote><p>*{2}</p>"
    "<ul><li><a>{4}</a><li><a>{3}</a><li><a>{5}</a></ul></article><ol class=commentlist><li><p>{160}</p><li><p>{20}</p><li><p>{1}</p></ol></div><div class=newsletter-signup><p>{30}</p><form>{3}</form></div>",
    # Pages without an article: columns, tables, menus of bare links, notices.
    "<body><div id=header>{4}</div><ul><li><a>{1}</a><li><a>{2}</a><li><a>{3}</a><li><a>{1}</a></ul><div class='layout has-sidebar'><div id=content><h1>*{6}</h1><p>*{40}</p><p>*{55} <a>{3}</a></p><h2>*{4}</h2>"
    "<p>*{30} <a>{3}</a></p><p>*{90}</p></div><div class=sidebar><h3>{2}</h3><ul><li><a>{4}</a><li><a>{4}</a></ul><p>{35}</p></div></div><div class=footer>{8} <a>{1}</a></div>",
    "<table><tr><td><a>{1}</a><br><a>{2}</a><br><a>{2}</a><td><p>*{70}</p><p>*{25}</p><p>*{6}</p><p>*{80}</p></table>",
    "<a>{1}</a><p>*{60}</p><p>*{28}</p><p>*{12}</p>",
    "<div><a>{2}</a></div><p>*{45}</p><p>*{8}</p><p>*{70}</p><div><a>{3}</a> <a>{2}</a></div>",
    "<p>*{60}</p>",
    "<p>*{24}</p><p>*{5}</p><p>*{33}</p>",
    "<h1>*{7}</h1><p>*{35}</p><ul><li><a>{6}</a><li><a>{5}</a><li><a>{7}</a></ul><p>*{50}</p><div class=ads><p>{15}</p></div><p>*{20}</p><div>{2} <a>{4}</a></div>",
    "<div class=modal><p>{18}</p></div><div><h2>*{5}</h2><div>*{200} <a>{9}</a></div></div><div class='related'><a>{6}</a> <a>{6}</a></div><div class=comments><p>{50}</p><p>{12}</p></div>",
    # More words beside a short article than in it.
    "<article><h1>*{3}</h1><p>*{8}</p></article><div class=comments><p>{90}</p><p>{60}</p><p>{4}</p></div>",
    "<body><main><p>*{5}</p><p>*{2}</p></main><footer><p>{70}</p><p>{12}</p></footer>",
    # Names and tags around nearly all of a page; lines that are links between text.
    "<body><form id=aspnet><div><a>{2}</a> <a>{1}</a></div><h1>*{6}</h1><p>*{75}</p><p>*{3}</p><p>*{110}</p><div class=ad>{9}</div><p>*{48}</p></form>",
    "<div class=widget-page><h1>*{4}</h1><p>*{66}</p><p>*{1}</p><p>*{130}</p><div class=comments><p>{22}</p></div></div><div>{2} <a>{5}</a></div>",
    "<div class='promo theme'><h2>*{5}</h2><p>*{40}</p><p>*{90}</p><div class=share><a>{1}</a> <a>{1}</a></div></div>",
    "<div class=widget-page><h1>*{3}</h1><p>*{50}</p><p>*{2}</p><p>*{85}</p></div><div class=footer>{25}</div><div class=sidebar><p>{20}</p><p>{9}</p></div>",
    "<article><p>*{50}</p><p><a>*{6}</a></p><p>*{44}</p><p><a>*{3}</a></p><p>*{80}</p><ul><li><a>{5}</a><li><a>{4}</a><li><a>{6}</a></ul></article><div class=comments><p>{31}</p><p>{2}</p></div>",
    "<p>*{33}</p><p><a>*{5}</a></p><p>*{52}</p><p><a>*{9}</a></p><p>*{71}</p><div><a>{2}</a></div><div><a>{3}</a></div>",
    "<ul><li><a>{3}</a><li><a>{2}</a></ul><div>{3} <a>{8}</a></div><div>{4} <a>{4}</a> <a>{5}</a></div>",
    "<div><a>{1}</a> <a>{1}</a> <a>{1}</a></div><div>*{38}</div><div>*{16} <a>{2}</a></div><div><a>{5}</a> <a>{4}</a></div>",
)


def labelled() -> list[tuple]:
    """Features and label of the blocks of ``MARKED``."""
    rows = []
    for page in MARKED:
        found, boxes = blocks(re.sub(r"\{(\d+)\}", lambda m: " ".join(["word"] * int(m[1])), page))
        rows += [(*f, int(b.text.startswith("*"))) for f, b in zip(features(found, boxes), found)]
    return rows


@lru_cache(maxsize=4)
def train(depth: int = 8, least: int = 2):
    """A CART tree by Gini impurity: nested (feature, cut, low, high) or a leaf's label."""
    data = np.array(labelled(), float)

    def grow(some: np.ndarray, level: int):
        label = some[:, -1]
        if level == depth or len(some) < 2 * least or label.min() == label.max():
            return bool(label.mean() > 0.5)
        best = None
        for f in range(some.shape[1] - 1):
            values = np.unique(some[:, f])
            for cut in (values[1:] + values[:-1]) / 2:
                low = some[:, f] <= cut
                if least <= low.sum() <= len(some) - least:
                    impurity = sum(part.sum() * label[part].mean() * (1 - label[part].mean()) for part in (low, ~low))
                    if best is None or impurity < best[0] - 1e-12:
                        best = impurity, f, float(cut), low
        if best is None:
            return bool(label.mean() > 0.5)
        _, f, cut, low = best
        return f, cut, grow(some[low], level + 1), grow(some[~low], level + 1)

    return grow(data, 0)


def is_main(tree, values: tuple) -> bool:
    while not isinstance(tree, bool):
        f, cut, low, high = tree
        tree = low if values[f] <= cut else high
    return tree


def main_text(page: str, tree) -> str:
    found, boxes = blocks(page)
    return "\n".join(b.text for b, f in zip(found, features(found, boxes)) if is_main(tree, f))


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """``id_col``, ``url_col``, text, n_chars."""
    small_batches(pages.sparkSession)
    base = pick(pages, id=id_col, url=url_col, html=html_col)
    out = schema(("id", base.schema["id"].dataType), ("url", base.schema["url"].dataType), ("text", "string"))
    tree = train()

    def run(batches):
        to = arrow_schema(out)
        for batch in batches:
            texts = [main_text(page or "", tree) for page in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("url").cast(to.field(1).type), pa.array(texts, to.field(2).type)], schema=to)

    return base.mapInArrow(run, out).select(F.col("id").alias(id_col), F.col("url").alias(url_col), "text", F.length("text").cast("long").alias("n_chars"))
