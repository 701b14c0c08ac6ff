"""Main text of web pages: flat text blocks classified by a decision tree.

A page becomes a flat list of text blocks, each with its word count and link density, those of its neighbours, and what
the elements around it are. A decision tree, trained here on the blocks of the small labelled pages below, keeps or
drops each block.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Iterator
from itertools import product
from typing import NamedTuple

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame

# a tag with quoted attributes; failing that, up to the next > or to the end of a page that breaks off
_TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)([^>]*)(?:>|\Z)""", re.S)
_NAMES = re.compile(r"""(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]+))""", re.I)

# fixed values: HTML elements by how they are read
RAW = {"script", "style", "title", "textarea", "template", "noscript", "iframe", "svg", "math", "object", "canvas", "select"}
INLINE = {"a", "abbr", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "img", "ins", "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
ASIDES = {"nav", "footer", "aside", "form", "menu", "dialog", "button", "fieldset"}
ARTICLES = {"article", "main"}
CONTAINERS = ASIDES | ARTICLES | {"header", "section", "div", "ul", "ol", "dl", "table", "figure", "blockquote", "details", "body", "span"}
PROSE = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "figcaption", "td"}
#: Parts of a container's class, id or role that name an aside; those that hint at one, but stand on main text as well;
#: and those that say nothing either way.
NAMED = {"ad", "ads", "advert", "adverts", "advertisement", "adsense", "sponsored", "sidebar", "comment", "comments", "commentlist", "disqus", "respond", "replies", "cookie", "cookies", "consent", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "masthead", "newsletter", "subscribe", "contentinfo", "complementary", "pagination", "pager"}
HINTED = {"banner", "promo", "notice", "popup", "modal", "menu", "share", "sharing", "social", "related", "recommended", "widget", "toolbar", "login", "search"}
NEUTRAL = {"list", "section", "area", "box", "slot", "unit", "container", "wrapper", "wrap", "block", "inner", "outer", "item", "items", "thread", "top", "bottom", "left", "right", "user", "users", "reader", "readers", "site", "page", "posts", "articles", "links", "buttons", "icons", "form", "bar", "js", "id"}
#: Words of text outside of hinted containers from which hints count; they also do beside shorter hinted text. Where there
#: is less, the hinted text is the page.
ENOUGH = 25


def _name_kind(rest: str) -> int:
    """2 if a token of a tag's class, id or role names an aside, 1 if one hints at it, else 0.

    A token is read by its parts: those that say nothing are left out, and all others must be known ones.
    """
    kind = 0
    for v in _NAMES.findall(rest):
        for token in "".join(v).lower().replace("_", "-").split():
            parts = {x for x in token.split("-") if x and not x.isdigit() and x not in NEUTRAL}
            if parts and parts <= NAMED | HINTED:
                kind = max(kind, 1 if parts.isdisjoint(NAMED) else 2)
    return kind


class Block(NamedTuple):
    """words and linked words of a text block, the elements around it and its text."""

    text: str
    words: int
    linked: int
    article: bool
    aside: bool
    named: int
    prose: bool


class Container(NamedTuple):
    """An open container: its element, whether it lies in an article or in an aside, and how it is named (_name_kind)."""

    element: str
    article: bool
    aside: bool
    named: int


PAGE_ = Container("", False, False, 0)


def blocks(page: str) -> list[Block]:
    """The non-empty text blocks of a page in order. White space inside a block is one space. Linear in the page."""
    out: list[Block] = []
    parts: list[str] = []
    linked = links = 0
    prose = False
    stack = [PAGE_]
    open_: Counter[str] = Counter()

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                n, at = text.count(" ") + 1, stack[-1]
                out.append(Block(text, n, min(linked, n), at.article, at.aside, at.named, prose))
            parts.clear()
        linked = 0

    def say(raw: str) -> None:
        nonlocal linked
        text = html.unescape(raw) if "&" in raw else raw
        parts.append(text)
        if links:
            linked += len(text.split())

    at, match = 0, _TAG.search
    while (m := match(page, at)) is not None:
        if m.start() > at:
            say(page[at : m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:  # a comment or declaration
            continue
        closing, rest = m[1] or m[4], m[3] or m[6] or ""
        if name in RAW:
            if not closing and not rest.endswith("/"):
                end = re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(page, at)
                at = end.end() if end else len(page)
            if name not in INLINE:
                flush()
            continue
        if name == "br":
            parts.append(" ")
            continue
        if name == "a":
            links = max(0, links + (-1 if closing else 1))
        if name not in INLINE:
            flush()
            links = 0 if name in CONTAINERS else links
            prose = not closing and name in PROSE
        if name not in CONTAINERS or name in VOID:
            continue
        if closing:
            while open_[name]:  # elements left open inside it end with it
                last = stack.pop()
                open_[last.element] -= 1
                if last.element == name:
                    break
        elif not rest.endswith("/"):
            around = stack[-1]
            # a name on the page, or on an article that is no reply within another one, says nothing of its text
            whole = name in {"body", "main"} or (name == "article" and not around.article)
            named = 0 if whole or not rest else _name_kind(rest)
            aside = name in ASIDES or (name == "header" and not around.article)
            if name == "span" and named and not around.named:
                flush()
            stack.append(Container(name, around.article or (name in ARTICLES and not around.aside), around.aside or aside, max(around.named, named)))
            open_[name] += 1
    if at < len(page):
        say(page[at:])
    flush()
    return out


#: What the tree sees of a block.
FEATURES = ("words", "link_density", "words_before", "density_before", "words_after", "density_after", "article", "aside", "named", "prose", "page_has_article")


def features(found: list[Block]) -> np.ndarray:
    """One row of FEATURES for each block; beyond the page's ends neighbours have no words and no links."""
    n = len(found)
    out = np.zeros((n, len(FEATURES)))
    if n:
        out[:, 0] = [b.words for b in found]
        out[:, 1] = [b.linked / b.words for b in found]
        out[1:, 2:4], out[:-1, 4:6] = out[:-1, 0:2], out[1:, 0:2]
        # a hint counts beside enough text that has none, in the article if there is one
        article = any(b.article and not b.aside for b in found)
        plain, hinted = (sum(b.words - b.linked for b in found if b.named == k and not b.aside and b.article == article) for k in (0, 1))
        bar = 1 if plain >= min(ENOUGH, hinted) else 2
        out[:, 6:10] = [(b.article, b.aside, b.named >= bar, b.prose) for b in found]
        out[:, 10] = out[:, 6].max()
    return out


# The labelled pages. T40 stands for 40 words, L3 for a link of 3 words; * before a block says that it is main text. Each
# page counts as it is and with blocks of over FEW words made shorter and longer (SCALES), as their kinds come in all lengths.
FEW, SCALES = 10, (0.4, 1.0, 3.0)
PAGES = [
    # news: menus, advert, article with links, share bar, comments, sidebar, footer
    "<header><h1>T2</h1><p>T6</p></header><nav><ul><li>L1</li><li>L1</li><li>L2</li><li>L1</li></ul></nav><div class=ad>T8</div><div>T5</div><article><header><h1>*T8</h1><p>*T4</p></header><p>*T62</p><p>*T3</p><p>*T25 L2 T30</p><h2>*T4</h2><p>*L5</p><ul><li>*T6</li><li>*L3</li><li>*L4</li><li>*T2 L3</li></ul><div class=share><span>T2</span><ul><li>L1</li><li>L1</li></ul></div><p>*T140</p><section class=comments><h3>T2</h3><p>T30</p><p>T4</p><p>T85</p></section></article><aside><h3>T2</h3><p>T24</p><ul><li>L5</li><li>L6</li></ul></aside><form>T3</form><footer><p>T9</p><p>L1</p><p>T40</p></footer>",
    # essay in main, loose text, table, notice inside
    "<nav>L1 L1 L2</nav><div class=cookie-notice><p>T30</p></div><main><h1>*T3</h1>*T40<div>*T12</div><div>*L3</div><table><tr><td>*T2</td><td>*L2</td></tr></table><div class=related><p>T6</p><a>L4</a><p>T35</p></div><p>*T5</p><blockquote>*T33</blockquote><ol><li>*L2</li><li>*L9</li></ol><div class=newsletter><p>T14</p></div></main><div><p>T18</p></div><div>T3</div><footer>T6</footer>",
    # poem in an article: short lines
    "<nav>L1</nav><article><div>*T4</div><div>*T6</div><div>*T5</div><div>*T1</div><div>*T7</div></article><p>T50</p><footer>T3</footer>",
    # text of all lengths inside an article, and around it
    "<div>T1</div><div>T22</div><p>T55</p><div>L1</div><div>T7</div><article><h1>*T9</h1><p>*T1</p><p>*T250</p><p>*T18</p><h2>*T2</h2><p>*T33</p><div>*T3</div><div>*T70</div><div>*L2</div><p>*L12</p><p>*T5 L5</p><p>*T11</p><p>*T2</p><p>*T400</p><p>*T90</p></article><div>T4</div><p>T120</p><div>T2</div><p>L30</p><div>T35</div><div>T14 L3</div>",
    "<p>T12</p><p>T2</p><main><div>*L1</div><div>*T2</div><div>*T27</div><p>*T160</p><p>*T4</p><p>*T8 L2</p><h3>*T1</h3><div>*T16</div><ul><li>*L1</li><li>*T48</li><li>*T2</li></ul></main><div>T60</div><p>T3</p><p>T44</p>",
    "<article><p>*T6</p><div class=ad>T1</div><p>*T37</p><div class=promo><p>T64</p><p>T2</p><div>L2</div></div><p>*T2</p><aside>T12</aside><p>*T210</p><div class=ad>T19</div><h2>*T3</h2><p>*T23</p><nav>L2</nav><p>*T13</p><form><p>T3</p></form></article>",
    # a page that marks nothing: menu, text in divs, links, imprint
    "<div><div>L1</div><div>L1</div><div>L2</div><div>L1</div><div>L1</div></div><div><div>*T9</div><div>*T55</div><div>*T80</div><div>*T7</div><div>*T46 L3 T20</div></div><div><div>L3</div><div>L4</div><div>L6</div></div>",
    # short lines in divs, and nothing else
    "<div>*T3</div><div>*T5</div><div>*T4</div><div>*T2</div><div>*T6</div><div>*T3</div>",
    "<div>*T1</div><div>*T1</div><div>*T2</div>",
    "<div>*T8</div>",
    "*T30",
    # short lines beside a menu
    "<ul><li>L1</li><li>L2</li><li>L1</li><li>L1</li></ul><div>*T6</div><div>*T4</div><div>*T7</div><div>*T5</div><div>*T9</div><ul><li>L3</li><li>L2</li></ul>",
    # labels and dates amid links
    "<div>L2</div><div>T1</div><div>L3</div><div>T2</div><div>L2</div><div>T1</div><div>L4</div><div>L1</div><p>*T60</p><p>*T3</p><p>*T90</p><div>L2</div><div>T2</div><div>L5</div>",
    # paragraphs between headings, asides marked by elements only
    "<header>T3 L1</header><nav>L1 L1</nav><h1>*T5</h1><p>*T44</p><h2>*T2</h2><p>*T7</p><p>*T2</p><p>*T88</p><aside><p>T33</p></aside><p>*T31 L2 T3</p><footer><p>T12</p><p>T30</p></footer>",
    # asides named only by their classes
    "<div class=navbar><div>L1</div><div>T2</div></div><div class=sidebar><p>T28</p><div>T9</div><p>L3</p></div><div><p>*T52</p><p>*T6</p><div>*T38</div></div><div class=comments><p>T41</p><div>T7</div></div><div class=ads>T15</div><div class=footer><p>T20</p></div>",
    # nothing but links
    "<div>L2</div><div>L3</div><p>L1</p><div>L2</div><p>L5</p><ul><li>L8</li><li>L25</li></ul><td>L3</td>",
    # paragraphs with many links, and a paragraph of one
    "<p>*T40 L8 T30</p><p>*T12 L6</p><p>L4</p><p>L7</p><div>*T45 L12</div><h2>L3</h2>",
    # marked by nothing: a heading stands between links and text, a label between text and links (a paragraph there is text)
    "<div>L2</div><div>L1</div><div>L3</div><div>*T5</div><div>*T60</div><div>*T4</div><div>*T45</div><div>T2</div><div>L4</div><div>L6</div><div>L5</div>",
    "<p>L1</p><p>L2</p><p>*T9</p><p>*T30</p><p>*T8</p><p>*T120</p><p>*T6</p><p>L7</p><p>L5</p><p>T1</p><p>L3</p>",
    "<div>L3</div><div>L2</div><div>*T3</div><div>*T50</div><div>T9</div><div>L2</div><div>L8</div><div>T3</div><div>L2</div>",
    "<div>L1</div><div>T3</div><div>L2</div><div>*T10</div><div>*T90</div><div>*T2</div><div>*T33</div><div>*T12</div><div>T5</div><div>L9</div><div>L4</div>",
    "<p>*T7</p><p>*T80</p><p>*T6</p><p>*T40 L3</p><p>*T70</p><p>*T1</p><p>L2</p><p>L2</p><p>L3</p><p>T7</p><p>L1</p>",
    "<ul><li>L2</li><li>L2</li><li>L1</li></ul><div>*T6</div><div>*T48 L4</div><div>*T9</div><div>*T64</div><div>L6</div><div>T2</div><div>L6</div><div>T2</div><div>L5</div>",
    "<div>L1</div><div>L1</div><div>*T4</div><div>*T35</div><div>*T75</div><div>*T3</div><div>*T28</div><div>T8</div><div>L3</div><div>L3</div>",
    "<p>L4</p><p>T2</p><p>L2</p><p>*T7</p><p>*T55</p><p>*T60</p><p>*T2</p><p>*T1</p><p>L5</p><p>L2</p>",
    # hints on what is all the text there is
    "<article><section class=related><h2>*T4</h2><p>*T60</p></section></article>",
    "<nav>L1 L1</nav><main><div class=social><p>*T44</p><p>*T7</p></div></main><footer>T8</footer>",
    "<table><tr><td>L1</td><td>L1</td></tr></table><table><tr><td>*T70</td></tr><tr><td>*T15</td></tr></table><table><tr><td>L1</td></tr></table>",
]
_SPELLED = re.compile(r"([TL])(\d+)")
MAIN = "\u2605"


def labelled() -> tuple[np.ndarray, np.ndarray]:
    """The labelled pages' blocks: rows of FEATURES, and whether they are main text."""

    def spell(m: re.Match, scale: float) -> str:
        n = int(m[2])
        words = " ".join(["w"] * (n if n <= FEW else max(FEW, round(n * scale))))
        return words if m[1] == "T" else f"<a href=x>{words}</a>"

    x, y = [], []
    for page, scale in product(PAGES, SCALES):
        marked = blocks(_SPELLED.sub(lambda m, by=scale: spell(m, by), page.replace("*", MAIN)))
        x.append(features(marked))
        y.append([b.text.startswith(MAIN) for b in marked])
    return np.vstack(x), np.concatenate(y).astype(float)


Tree = tuple


def grow(x: np.ndarray, y: np.ndarray, depth: int = 10) -> Tree:
    """A binary tree by Gini impurity: (feature, threshold, below or equal, above), or (label,) for a leaf.

    Of equally good splits the first feature and lowest threshold count, so equal tables give equal trees.
    """
    share = y.mean()
    if depth == 0 or share in (0.0, 1.0):
        return (bool(share >= 0.5),)
    best = None
    for k in range(x.shape[1]):
        values = np.unique(x[:, k])
        for cut in (values[:-1] + values[1:]) / 2:
            left = x[:, k] <= cut
            a, b = y[left], y[~left]
            impurity = len(a) * a.mean() * (1 - a.mean()) + len(b) * b.mean() * (1 - b.mean())
            if best is None or impurity < best[0] - 1e-12:
                best = (impurity, k, cut)
    if best is None:
        return (bool(share >= 0.5),)
    _, k, cut = best
    left = x[:, k] <= cut
    return (k, float(cut), grow(x[left], y[left], depth - 1), grow(x[~left], y[~left], depth - 1))


def classify(tree: Tree, x: np.ndarray) -> np.ndarray:
    out = np.zeros(len(x), bool)

    def go(node: Tree, rows: np.ndarray) -> None:
        if len(node) == 1:
            out[rows] = node[0]
        elif len(rows):
            low = x[rows, node[0]] <= node[1]
            go(node[2], rows[low])
            go(node[3], rows[~low])

    go(tree, np.arange(len(x)))
    return out


def trained_tree() -> Tree:
    return grow(*labelled())


def main_text(page: str | None, tree: Tree) -> str:
    """The kept blocks of a page, joined by newlines."""
    found = blocks(page or "")
    keep = classify(tree, features(found))
    return "\n".join(b.text for b, k in zip(found, keep, strict=True) if k)


def extract_text(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """Every row of pages, without its html, with text and n_chars (code points).

    A null or empty page, and one without main text, has an empty text. Markup that breaks off, is not closed or nests
    wrongly is read as far as it goes, in a time that grows with the page's length. Repeated rows are extracted each;
    an empty table gives an empty result. Columns of pages called text or n_chars give way to the results.
    """
    tree = trained_tree()
    others = [c for c in pages.columns if c.lower() not in {"text", "n_chars", html_col.lower()}]

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for pdf in batches:
            source = pdf.pop("html_page_")
            pdf["text"] = [main_text(p, tree) for p in source.array]
            pdf["n_chars"] = pdf["text"].str.len().astype("int64")
            yield pdf

    kept = pages.select(*[pages[f"`{c}`"] for c in others], pages[f"`{html_col}`"].alias("html_page_"))
    kinds = [(f.name, f.dataType.simpleString()) for f in kept.schema.fields[:-1]]
    return kept.mapInPandas(run, ", ".join([f"`{n}` {t}" for n, t in kinds] + ["text string", "n_chars long"]))
