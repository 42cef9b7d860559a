"""Main text of web pages by tag-path ratios.

A page is cut into text blocks with their tag paths. Text length and punctuation per block are smoothed
along the page, averaged per path and fused; paths whose density is a share of the best one's, or
that of a sentence, hold the content. How much text a path has does not matter.

What else is known of a page weighs in that density or bounds what it is computed from: blocks in an article count
more, and small parts that are named for what they are (a menu, an advert) are left out. An element that holds the
bulk of the text, or an article, is no such part, whatever its name.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

# A path is content from this share of the best path's density on, and from that of a sentence of 90 characters
# with two marks on in any case, so that one very dense path does not shut out the others.
SHARE = 0.5
SENTENCE = 15.0
# The weight of a path in an article or main, if these hold at least a part MARKED of the text.
ARTICLE = 10.0
MARKED = 0.3
# A part of a chosen element that is no prose element itself is content from this share of the densest element's
# own prose on; text that stands in it without a paragraph needs BARE of it.
NESTED, BARE = 0.2, 0.7

# Element names of the HTML standard and customary names of page parts.
RAW = {"script", "style", "noscript", "template", "textarea", "title", "iframe", "noframes"}
# Drawings: their elements may close themselves and nest; an HTML element ends them unless it is in a HOLDER.
FOREIGN = {"svg"}
HOLDERS = {"foreignobject", "desc", "title"}
ENDS_FOREIGN = {
    "b", "big", "blockquote", "body", "br", "center", "code", "dd", "div", "dl", "dt", "em", "embed", "h1", "h2", "h3",
    "h4", "h5", "h6", "head", "hr", "i", "img", "li", "listing", "menu", "meta", "nobr", "ol", "p", "pre", "ruby", "s",
    "small", "span", "strong", "strike", "sub", "sup", "table", "tt", "u", "ul", "var",
}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
    "kbd", "label", "mark", "nobr", "output", "q", "ruby", "rb", "rp", "rt", "s", "samp", "small", "span", "strike",
    "strong", "sub", "sup", "time", "tt", "u", "var",
}
# Formulas: a space parts their symbols.
SYMBOLS = {"mi", "mn", "mo", "ms", "mtext", "annotation", "annotation-xml"}
FORMULA = SYMBOLS | {
    "math", "semantics", "mrow", "mfrac", "msqrt", "mroot", "mstyle", "merror", "mpadded", "mphantom", "mfenced",
    "menclose", "msub", "msup", "msubsup", "munder", "mover", "munderover", "mmultiscripts", "mprescripts", "none",
    "mtable", "mtr", "mlabeledtr", "mtd", "maction", "mspace", "mglyph", "maligngroup", "malignmark",
}
INLINE |= FORMULA
BOILERPLATE = {"nav", "footer", "aside", "button", "select", "option", "menu", "head", "canvas", "audio", "video"}
# These may also hold the whole page.
WRAPPERS = {"form", "fieldset", "dialog", "object"}
ROLES = {
    "navigation", "banner", "contentinfo", "complementary", "search", "dialog", "alertdialog", "alert", "menu",
    "menubar", "form",
}
PARTS = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "adsbygoogle", "sponsor", "sponsored",
    "promo", "banner", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "notification", "alert", "popup",
    "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "sidebar", "sidebars", "widget",
    "widgets", "menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "footer", "masthead", "topbar",
    "toolbar", "comment", "comments", "commentlist", "disqus", "respond", "replies", "share", "sharing", "social",
    "related", "recommended", "recommendations", "teaser", "teasers", "pagination", "pager", "search", "searchbox",
    "hidden", "copyright", "disclaimer", "discussion", "talkback", "popular", "trending",
}
# Words that may follow a part's name: "related-posts", "share-buttons", "ad-container".
FRAME = {
    "area", "bar", "block", "body", "bottom", "box", "button", "buttons", "card", "cards", "container", "content",
    "form", "group", "header", "heading", "holder", "icon", "icons", "inner", "item", "items", "label", "left", "link",
    "links", "list", "main", "panel", "popup", "posts", "primary", "region", "right", "row", "secondary", "section",
    "slot", "stories", "text", "title", "toggle", "top", "unit", "wrap", "wrapper", "articles",
}
# What an article can be as a whole, and a list by its id; other names are what they are about.
ARTICLE_PARTS = PARTS - {
    "social", "search", "share", "sharing", "alert", "notice", "notices", "notification", "menu", "login", "copyright",
    "banner", "cookie", "cookies", "consent", "gdpr", "subscription", "navigation", "disclaimer", "widget", "widgets",
}
LIST_PARTS = {"menu", "nav", "navbar", "navigation", "breadcrumb", "breadcrumbs", "pagination", "pager", "toolbar"}
ROOTS = {"html", "body", "main"}
CONTENT = {"article", "main"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
PROSE = HEADINGS | {
    "p", "li", "ul", "ol", "dl", "dt", "dd", "blockquote", "pre", "table", "tbody", "thead", "tr", "td", "th",
    "caption", "figure", "figcaption", "xmp",
}
LISTS = {"ul", "ol"}
# Start tags that end an open element of the given names.
CLOSES = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"},
    "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "tbody": {"tbody", "thead", "tr", "td", "th"},
}
SCOPES = {"ul", "ol", "dl", "table", "select"}

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)", re.S)
# The end of a tag, or an attribute with its value; the fifth group is a quote that is never closed.
_ATTRIBUTE = re.compile(
    r"""[\s/]*+(?:(>)|(=?[^\s/>=]*+)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|(["'])|([^\s>]*+)))?)"""
)
_XMP = re.compile(r"</xmp(?=[\s/>])", re.I)
_PUNCTUATION = re.compile(r"[.,;:!?…。，、；：！？]")
_NAME = re.compile(r"[^\W\d_]+")
# "has-sidebar" names the page around a sidebar, "category-social" what a page is about.
_AROUND = re.compile(r"(?:has|with|no|without|is|show|hide|category|cat|tag|topic|taxonomy|format|type|status)[-_]")


@dataclass
class Block:
    path: tuple[str, ...]
    elements: tuple[int, ...]  # numbers of the elements around it
    inside: bool = True
    parts: list[str] = field(default_factory=list)
    linked: int = 0
    text: str = ""  # white space as one space, when all parts are there


# Why an element may be left out: a page part by its nature, or by its name unless it holds the bulk of the text.
PART, NAMED = 2, 1


@dataclass
class Element:
    name: str
    left: int = 0
    size: int = 0  # characters of text outside links
    blocks: int = 0
    article: bool = False  # holds an article or main


class Tag(NamedTuple):
    """A tag's place in the page; comments and declarations have no ``name``."""

    start: int
    end: int
    name: str = ""
    closing: bool = False
    alone: bool = False  # closes itself
    attributes: dict[str, str] = {}


class _Tags:
    """Finds the tags of a page in time linear in its length.

    A tag may have any number of attributes of any length. It ends at the first ``>`` outside a quoted value, or at
    the first one at all if a quote is never closed.
    """

    def __init__(self, page: str) -> None:
        self.page, self.last, self.comments = page, page.rfind(">"), "<!--" in page
        self.unclosed: set[int] = set()  # attributes from which on a quote is never closed

    def after(self, at: int) -> Tag | None:
        """The first tag from ``at`` on."""
        while at <= self.last or self.comments:
            found = _TAG.search(self.page, at)
            if not found:
                return None
            if not found[2]:
                return Tag(found.start(), found.end())
            at = found.end()
            if at <= self.last:
                attributes, end = self._attributes(at)
                alone = self.page[end - 2] == "/" and end - 2 >= at
                return Tag(found.start(), end, found[2].lower(), found[1] == "/", alone, attributes)
        return None

    def _attributes(self, at: int) -> tuple[dict[str, str], int]:
        first, found, begun = self.page.find(">", at), {}, []
        while at <= first or at not in self.unclosed:
            part = _ATTRIBUTE.match(self.page, at)
            if part[1]:
                return {k: v for k, (v, _) in found.items()}, part.end()
            if part[5] or not part[2]:
                break
            begun.append(at)
            at = part.end()
            found.setdefault(part[2].lower(), (part[3] or part[4] or part[6] or "", at))
        self.unclosed.update(begun)
        return {k: v for k, (v, end) in found.items() if end <= first}, first + 1


def _part(labels: str, names: set[str], whole: bool = False) -> bool:
    """Whether a label is one of the names or, unless ``whole``, ends in one, up to words of FRAME."""
    for label in labels.lower().split():
        words = [] if _AROUND.match(label) else _NAME.findall(label)
        while len(words) > 1 and words[-1] in FRAME and words[-1] not in names:
            words.pop()
        if words and words[-1] in names and (len(words) == 1 or not whole):
            return True
    return False


def _named_part(name: str, classes: str, id: str) -> bool:
    """Whether class or id name a part to leave out. Ids of headings and prose are slugs of their text."""
    if name in CONTENT:
        return _part(classes, ARTICLE_PARTS, True)
    if name in LISTS:
        return _part(classes, PARTS) or _part(id, LIST_PARTS, True)
    return _part(classes, PARTS) or (name not in PROSE and _part(id, PARTS, name == "section"))


def _left_out(name: str, attributes: dict[str, str], above: set[str]) -> tuple[int, str]:
    """Whether an element may be a page part to leave out, and its name in the path."""
    found = {k: entities.unescape(v) for k, v in attributes.items() if k in ("class", "id", "style", "role", "aria-hidden")}
    labels = f"{found.get('class', '')} {found.get('id', '')}".lower().split()
    names = [n for x in labels if not _AROUND.match(x) for n in _NAME.findall(x)]
    shown = f"{name}.{'.'.join(names)}" if names else name
    if name in ROOTS:
        return 0, shown
    style = found.get("style", "").replace(" ", "").lower()
    if (
        name in BOILERPLATE
        or (name == "header" and not CONTENT & above)
        or found.get("aria-hidden", "").lower() == "true"
        or "display:none" in style
        or "hidden" in attributes
    ):
        return PART, shown
    named = (
        name in WRAPPERS
        or _named_part(name, found.get("class", ""), found.get("id", ""))
        or found.get("role", "").lower() in ROLES
    )
    return (NAMED if named else 0), shown


def _behind_foreign(tags: _Tags, at: int, name: str, stack: list[tuple[str, str, int]]) -> int:
    """Where a drawing ends whose start tag ends at ``at``, by the rules of the HTML standard.

    That is behind its own end tag, or else before an HTML element or before the end of an element on the ``stack``.
    """
    inner, opened, around = [name], Counter([name]), None
    while tag := tags.after(at):
        at, name = tag.end, tag.name
        if not name:
            continue
        held = any(opened[h] for h in HOLDERS)
        if tag.closing:
            if opened[name]:
                while True:
                    last = inner.pop()
                    opened[last] -= 1
                    if last == name:
                        break
                if not inner:
                    return tag.end
            elif not held:
                around = around or {"p", "br", *(s[0] for s in stack)}
                if name in around:
                    return tag.start
        elif not held and name in ENDS_FOREIGN:
            return tag.start
        elif name not in VOID and not tag.alone:
            inner.append(name)
            opened[name] += 1
    return len(tags.page)


def _settle(found: list[Block], elements: list[Element]) -> None:
    """Marks the blocks that lie in page parts.

    By name alone an element is one unless it holds an article, or, on pages without any, several blocks with half of
    the text that is in no part by its nature. Paragraphs, headings and the like are never that much.
    """
    out = {i for i, e in enumerate(elements) if e.left == PART}
    for b in found:
        b.inside = out.isdisjoint(b.elements)
        if b.inside:
            for i in b.elements:
                elements[i].size += max(len(b.text) - b.linked, 0)
                elements[i].blocks += 1
    marked = any(e.name in CONTENT and e.blocks for e in elements)
    total = sum(max(len(b.text) - b.linked, 0) for b in found if b.inside)
    for i, e in enumerate(elements):
        bulk = e.article or (not marked and e.blocks > 1 and 0 < total <= 2 * e.size)
        if e.left == NAMED and (e.name in PROSE or not bulk):
            out.add(i)
    for b in found:
        b.inside = out.isdisjoint(b.elements)


def blocks(page: str) -> list[Block]:
    """The page's text blocks in order; those of left-out parts are not ``inside``."""
    out: list[Block] = []
    elements: list[Element] = []
    stack: list[tuple[str, str, int]] = []  # element, name in the path, number or -1 for inline ones
    links = 0
    block: Block | None = None

    def add(text: str, plain: bool = False) -> None:
        nonlocal block
        if not text:
            return
        if block is None:
            if text.isspace():
                return
            path = tuple(s[1] for s in stack if s[0] not in INLINE)
            block = Block(path, tuple(s[2] for s in stack if s[2] >= 0))
            out.append(block)
        block.parts.append(text if plain else entities.unescape(text))
        block.linked += len(text) if links else 0

    def pop_to(i: int) -> None:
        nonlocal block, links
        if any(s[2] >= 0 for s in stack[i:]):
            block = None
        del stack[i:]
        links = sum(s[0] == "a" for s in stack)

    at, end, tags = 0, len(page), _Tags(page)
    while at < end:
        tag = tags.after(at)
        if not tag:
            add(page[at:])
            break
        add(page[at : tag.start])
        at, name = tag.end, tag.name
        if not name:
            continue
        if tag.closing:
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] == name:
                    pop_to(i)
                    break
                if name in INLINE and stack[i][0] not in INLINE:
                    break
            continue
        if name in RAW:
            stop = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(page, at)
            at = stop.start() if stop else end
            continue
        if name in FOREIGN:
            if not tag.alone:
                at = _behind_foreign(tags, at, name, stack)
            continue
        if name == "br" or name == "hr":
            if block is not None:
                block.parts.append(" ")
        if name in VOID:
            continue
        if name not in INLINE:
            # A block ends an open paragraph with its inline elements, list items end each other, and so on.
            wanted = CLOSES.get(name, set()) | {"p"} | (HEADINGS if name in HEADINGS else set())
            for i in range(len(stack) - 1, -1, -1):
                if stack[i][0] in wanted:
                    pop_to(i)
                    if stack and stack[-1][0] in wanted:
                        continue
                    break
                if stack[i][0] in SCOPES or (stack[i][0] not in INLINE and stack[i][0] not in PROSE):
                    break
            block = None
        above = {x[0] for x in stack} if name == "header" else set()
        left, shown = _left_out(name, tag.attributes, above)
        if left:
            block = None
        if name in SYMBOLS and block is not None:
            block.parts.append(" ")
        if tag.alone:
            continue
        number = -1
        if name not in INLINE or left:
            number = len(elements)
            elements.append(Element(name, left))
            if name in CONTENT:
                for x in stack:
                    if x[2] >= 0:
                        elements[x[2]].article = True
        stack.append((name, shown if number >= 0 else name, number))
        links += name == "a"
        if name == "xmp":  # its text holds no tags
            stop = _XMP.search(page, at)
            add(page[at : stop.start() if stop else end], True)
            at = stop.start() if stop else end
    for b in out:
        b.text = " ".join("".join(b.parts).split())
    found = [b for b in out if b.text]
    _settle(found, elements)
    return found


_RIGHTS = re.compile(r"\s*(?:©|\(c\)\s|copyright\b)", re.I)


def _sizes(found: list[Block]) -> np.ndarray:
    """Share of each block that is not in links, and its characters and punctuation marks outside links.

    A line that begins with a copyright mark has none.
    """
    size = np.array([len(b.text) for b in found], float)
    marks = np.array([len(_PUNCTUATION.findall(b.text)) for b in found], float)
    plain = np.array([0.0 if _RIGHTS.match(b.text) else 1 - min(b.linked / max(len(b.text), 1), 1) for b in found])
    return np.array([plain, size * plain, marks * plain])


def _marked(path: tuple[str, ...]) -> bool:
    return any(e.split(".")[0] in CONTENT for e in path)


def scores(found: list[Block]) -> dict[tuple[str, ...], float]:
    """Fused density of each tag path of the blocks that are ``inside``: length and punctuation per node.

    What a block has from its neighbours counts by its own share outside links, so text lends nothing to menus.
    Paths in an article or main weigh more, if these hold a good part of the text.
    """
    some = [b for b in found if b.inside]
    if not some:
        return {}
    smooth = lambda x: np.convolve(np.pad(x, 1, "edge"), [0.25, 0.5, 0.25], "valid")
    plain, size, marks = _sizes(some)
    sums: dict[tuple[str, ...], np.ndarray] = defaultdict(lambda: np.zeros(3))
    for b, s, m in zip(some, plain * smooth(size), plain * smooth(marks)):
        sums[b.path] += (s, m, 1)
    marked = sum(s for b, s in zip(some, size) if _marked(b.path))
    weight = ARTICLE if marked >= MARKED * size.sum() else 1.0
    return {p: float(np.sqrt(s / n * (m / n + 0.5))) * (weight if _marked(p) else 1) for p, (s, m, n) in sums.items()}


def _around(block: Block) -> int:
    """How many of a block's elements are the nearest article or main and those above, else those that are no prose."""
    names = [e.split(".")[0] for e in block.path]
    for i in range(len(names) - 1, -1, -1):
        if names[i] in CONTENT:
            return i + 1
    i = len(names)
    while i > 1 and names[i - 1] in PROSE:
        i -= 1
    return i


def main_text(page: str | None) -> str:
    """The content blocks of a page, white space within a block as one space, joined by one space.

    Blocks of dense paths are content. So are, in the elements around them, headings and prose, and further parts
    that are dense by themselves; within an article, a dense path in a sparse part is not.
    """
    found = blocks(page or "")
    ranked = scores(found)
    if not ranked:
        return ""
    best = max(ranked.values())
    strong = any(_marked(p) for p, s in ranked.items() if s == best)
    least = SHARE * best if strong else min(SHARE * best, SENTENCE)
    chosen = {p for p, s in ranked.items() if s >= least}
    plain, size, marks = _sizes(found)

    # Elements around dense blocks, by number: equal paths elsewhere on the page are not theirs.
    around: set[int] = set()
    for b in found:
        if b.inside and b.path in chosen:
            n = _around(b)
            if 0 < n <= len(b.elements):
                around.add(b.elements[n - 1])
    # Of each such element its own prose, and each part of it that is none.
    own: dict[int, list[int]] = defaultdict(list)
    parts: dict[tuple[int, int], list[int]] = defaultdict(list)
    place: list[tuple[int, int] | None] = [None] * len(found)
    for k, b in enumerate(found):
        if not b.inside:
            continue
        for i in range(len(b.elements) - 1, -1, -1):
            if b.elements[i] in around:
                names = [e.split(".")[0] for e in b.path[i + 1 :]]
                below = next((j for j, n in enumerate(names) if n not in PROSE), None)
                place[k] = (b.elements[i], -1 if below is None else b.elements[i + 1 + below])
                (own[b.elements[i]] if below is None else parts[place[k]]).append(k)
                break
    dense = lambda ks: float(np.sqrt(size[ks].mean() * (marks[ks].mean() + 0.5))) if ks else 0.0
    level = max((dense(ks) for ks in own.values()), default=0.0)
    parted = {key: dense(ks) for key, ks in parts.items()}

    def content(k: int, b: Block) -> bool:
        if not b.inside or (_RIGHTS.match(b.text) and not plain[k]):
            return False
        if place[k] is None:
            return b.path in chosen
        if place[k][1] < 0:
            return True
        if not level:
            return b.path in chosen
        bare = b.path[-1].split(".")[0] not in PROSE
        return parted[place[k]] >= min((BARE if bare else NESTED) * level, SENTENCE)

    kept = [content(k, b) for k, b in enumerate(found)]
    if True in kept:  # a title before the content, in an element that holds it
        first = kept.index(True)
        for k, b in enumerate(found[:first]):
            if b.inside and plain[k] and b.path and b.path[-1].split(".")[0] == "h1":
                n = _around(b)
                kept[k] = n < len(b.path) and b.elements[:n] == found[first].elements[:n]
    return " ".join(b.text for b, k in zip(found, kept) if k)


def extract_text(pages: DataFrame, html: str = "html", columns: Sequence[str] | None = None) -> DataFrame:
    """``pages`` (or some ``columns``) with ``text`` and ``n_chars`` (code points).

    Left out are scripts, styles, drawings, hidden elements, and by their element navigation, page headers and
    footers, asides and controls. Forms, and elements whose role, class or id names a page part (as the whole label
    or its last word: "related-posts" counts as "related"), are left out too unless they hold an article or, on a page
    without any, several blocks with half of the text. Ids of headings and prose are not looked at, those of sections, of
    lists as menus, and classes of an article only as a whole.

    Among the other blocks, tag paths are scored by length and punctuation, an article's paths higher; those
    near the best, or as dense as long sentences, are content. So are headings and prose in the elements around
    them, a title before them, and nested parts of some density; lists of links and short lines outside
    paragraphs are not, nor are lines that begin with a copyright mark. Character references are decoded. A null or empty
    page, or one without content, gives an empty text. Input columns of the new names are replaced. One
    pass over the rows, no shuffle.
    """
    kept = [c for c in (columns or pages.columns) if c.lower() not in ("text", "n_chars")]

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [main_text(p.as_py()) for p in batch.columns[-1]]
            new = [pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *new], [*kept, "text", "n_chars"])

    rows = pages.select(*kept, pages[html].alias("_html"))
    types = "".join(f"`{c}` {pages.schema[c].dataType.simpleString()}, " for c in kept)
    return rows.mapInArrow(extract, f"{types}text string, n_chars long")
