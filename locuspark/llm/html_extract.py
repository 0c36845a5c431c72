"""The main text of web pages by two-pass block rules.

A page is cut into blocks at the borders of block elements. Pass one decides
blocks by themselves: blocks within menus, headers, footers, sidebars, adverts, forms,
comments and the like are out; blocks with many link characters are out; long blocks
with enough stop words, with hardly a link, or of the page's article, are in; where no block of a page has enough, all long blocks count. An element or class that names the article
counts if it holds at least half of the long dense text; outside it such text is in, with short blocks within it, and all else is out. Short blocks
and those between the bounds stay undecided. In pass two each of them takes the
label of the nearest decided neighbours in its region of the page: before and after count by their
distance, and at equal distance "in" wins within an article. A region
with no decided block is in.

Each page is handled by itself in one pass without a shuffle, in time and memory proportional to its length, however its tags are broken.
Defined results: a null or empty page has the empty
text; a very long page is cut into blocks like any other; repeated rows give equal results; null ids and urls are passed through; an empty table gives
an empty result; other columns are kept by ``extract``, and where ``text`` or ``n_chars`` is taken the new column gets an underscore in front.
"""

from __future__ import annotations

import html
import re
import string
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import fresh, numbered, quoted
from .quality_rules import STOP_WORDS

MAX_LINK_SHARE = 0.5
#: A long block with at most this share of link characters is text in whatever language.
FEW_LINKS = 0.1
LONG_CHARS = 140
SHORT_CHARS = 60
MIN_STOP_SHARE = 0.2

# Element names of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
#: What these hold is not markup; an end tag that is missing takes the rest of the page.
RAW = frozenset("script style iframe textarea title".split())
#: What these hold is not text of the page; they end with their parent at the latest.
DROPPED = frozenset("noscript template svg math object select option button canvas audio video map".split())
#: Of those, the ones that may hold an article of their own, and the ones that an open p or li does not end through.
HOLDS_ARTICLE = frozenset("noscript template svg math".split())
BOUNDARY = HOLDS_ARTICLE | frozenset("object select button".split())
OUT = frozenset("nav aside footer form menu dialog head".split())
ARTICLE = {"article": 3, "main": 2}
#: Class and id words of a container that holds the article where neither element is used, and the last words of their compounds.
CONTENT = frozenset("article content entry post story".split())
CONTENT_ENDS = CONTENT | frozenset("body text main".split())
#: Class and id words of page furniture, alone or in a compound such as top-nav.
FURNITURE = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navbar navigation breadcrumb breadcrumbs "
    "sidebar aside footer masthead topbar cookie cookies consent gdpr popup modal overlay newsletter subscribe signup login "
    "share sharing social comment comments commentlist reply replies respond disqus related recommended widget pagination pager toolbar".split()
)
#: Words that are furniture alone or at the end of a compound (search-form, cookie-notice), not before other words (form-factor).
FURNITURE_ENDS = frozenset("menu notice notices alert search form skip header".split())
HIDDEN = frozenset("hidden is-hidden visually-hidden visuallyhidden sr-only screen-reader-text".split())
FURNITURE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alert form menu menubar".split())

_PLAIN = re.compile(r"<(/?)([a-zA-Z][^\s/><]*)\s*(/?)>")
_NAME = re.compile(r"<(/?)([a-zA-Z][^\s/><]*)")
_ATTRIBUTE = re.compile(r"[\s/]*([^\s=></][^\s=></]*)(\s*=\s*)?")
_BARE = re.compile(r"[^\s><]*")
_GAP = re.compile(r"[\s/=]*")
_MARKUP = re.compile(r"<[/a-zA-Z]")
_LINK = re.compile(r"<(/?)a(?=[\s>/])", re.I)
_RAW_END = {name: re.compile(rf"</{name}\b[^>]*>", re.I) for name in RAW}
#: Names such as has-sidebar say what stands beside the content.
_WRAPPED = frozenset("with has no without".split())
_PARTS = re.compile(r"[^a-z]+")
_STOPS = frozenset(STOP_WORDS)


@dataclass(slots=True)
class Tag:
    name: str
    ends: bool
    attributes: dict[str, str]
    #: Whether it says that it has no content.
    closed: bool = False


def _quoted(page: str, at: int, last: dict[str, int]) -> tuple[str, int] | None:
    """A quoted value and where it ends; None if the quote is left open, which shows at the end of the page or by markup within."""
    quote = page[at]
    if at >= last[quote]:
        return None
    end = page.index(quote, at + 1)
    value = page[at + 1 : end]
    close = value.find(">")
    if close >= 0 and _MARKUP.search(value, close):
        return None
    return value, end + 1


def tokens(page: str) -> Iterator[str | Tag]:
    """Text and tags in order, in time proportional to the page's length. A tag ends at ">", or before the next tag if that is missing.

    Comments, declarations and what RAW elements hold are left out; an end of these that is missing takes the rest of the page.
    """
    at = begin = 0
    last = {q: page.rfind(q) for q in "\"'"}
    while True:
        at = page.find("<", at)
        if at < 0:
            break
        m = _PLAIN.match(page, at)
        if m:
            tag, end = Tag(m[2].lower(), bool(m[1]), {}, bool(m[3])), m.end()
        elif m := _NAME.match(page, at):
            tag, end = _tag(page, m, last)
        elif page.startswith("<!--", at):
            tag, end = None, page.find("-->", at + 2)
            end = len(page) if end < 0 else end + 3
        elif page[at + 1 : at + 2] in ("!", "?") or page.startswith("</", at):
            tag, end = None, page.find(">", at)
            end = len(page) if end < 0 else end + 1
        else:
            at += 1
            continue
        if at > begin:
            yield page[begin:at]
        if tag:
            if tag.name in RAW and not tag.ends:
                if not (tag.closed and tag.name == "iframe"):
                    found = _RAW_END[tag.name].search(page, end)
                    end = found.end() if found else len(page)
                tag = None
                yield " "
            elif tag.name == "a" and not tag.ends:
                # An end tag that is missing: the link ends with the block it is in.
                found = _LINK.search(page, end)
                tag.closed = not (found and found[1])
        if tag:
            yield tag
        at = begin = end
    if begin < len(page):
        yield page[begin:]


def _tag(page: str, m: re.Match, last: dict[str, int]) -> tuple[Tag, int]:
    tag, at = Tag(m[2].lower(), bool(m[1]), {}), m.end()
    while x := _ATTRIBUTE.match(page, at):
        at = x.end()
        value = ""
        if x[2]:
            found = _quoted(page, at, last) if page[at : at + 1] in ("'", '"') else None
            if found is None:
                y = _BARE.match(page, at)
                found = y[0], y.end()
            value, at = found
        tag.attributes.setdefault(x[1].lower(), value)
    gap = _GAP.match(page, at)
    at = gap.end()
    if page[at : at + 1] == ">":
        tag.closed = page[at - 1] == "/"
        at += 1
    return tag, at


@dataclass
class Block:
    text: str
    links: int
    furniture: bool
    region: int
    #: How plainly the markup says that this is the article, 0 to 3; after pass one 1 or 0.
    article: int
    label: bool | None = None


def _names(attributes: dict[str, str]) -> Iterator[list[str]]:
    """The words of each class name and of the id."""
    for key in ("class", "id"):
        for name in attributes.get(key, "").lower().split():
            yield [x for x in _PARTS.split(name) if x]


def _is_furniture(tag: Tag, in_article: bool) -> bool:
    name, attributes = tag.name, tag.attributes
    if name in OUT or (name == "header" and not in_article):
        return True
    if not attributes:
        return False
    if attributes.get("role", "").lower() in FURNITURE_ROLES or "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    if "style" in attributes and re.search(r"(?:^|;)(?:display:none|visibility:hidden)", re.sub(r"\s", "", attributes["style"].lower())):
        return True
    if not HIDDEN.isdisjoint(attributes.get("class", "").lower().split()):
        return True
    if name in ("html", "body"):
        return False
    for words in _names(attributes):
        words = [w for i, w in enumerate(words) if not (i and words[i - 1] in _WRAPPED)]
        if name in ARTICLE and not {"comment", "comments"} & set(words):
            continue
        if not FURNITURE.isdisjoint(words):
            return True
        # The header of an article holds its title.
        if words and words[-1] in FURNITURE_ENDS and not (words[-1] == "header" and (in_article or not CONTENT.isdisjoint(words))):
            return True
    return False


def _article_level(tag: Tag) -> int:
    if tag.name in ARTICLE:
        return ARTICLE[tag.name]
    if tag.name in ("div", "section", "td") and tag.attributes:
        if tag.attributes.get("role", "").lower() == "main":
            return 2
        return int(any(words and words[-1] in CONTENT_ENDS and not CONTENT.isdisjoint(words) for words in _names(tag.attributes)))
    return 0


@dataclass(slots=True)
class Open:
    """An open element."""

    name: str
    furniture: bool
    region: int
    article: int


class Stack:
    """Open elements. Every article begins a scope, which the end tags of other elements don't reach out of; a dropped element begins one as well.

    Scopes count their open names, so an end tag without a start is passed over at once.
    """

    def __init__(self) -> None:
        self.items = [Open("", False, 0, 0)]
        self.scopes: list[Counter] = [Counter()]
        self.starts = [0]
        self.total: Counter = Counter()
        #: Where the outermost dropped element is, and its scope; within it no further scope begins.
        self.drop: int | None = None
        self.drop_scope = 0

    @property
    def top(self) -> Open:
        return self.items[-1]

    def push(self, item: Open, drop: bool = False) -> None:
        if drop:
            self.drop, self.drop_scope = len(self.items), len(self.scopes)
        if drop or (item.name in ARTICLE and self.drop is None):
            self.scopes.append(Counter())
            self.starts.append(len(self.items))
        self.items.append(item)
        self.scopes[-1][item.name] += 1
        self.total[item.name] += 1

    def cut(self, size: int) -> None:
        """Only the first ``size`` elements stay open."""
        while len(self.items) > size:
            name = self.items.pop().name
            self.scopes[-1][name] -= 1
            self.total[name] -= 1
            if self.starts[-1] == len(self.items):
                self.scopes.pop()
                self.starts.pop()
        if self.drop is not None and size <= self.drop:
            self.drop = None

    def reaches(self, name: str, scope: int = -1) -> bool:
        """Whether an end tag seen in a scope closes something."""
        return self.total[name] > 0 if name in ARTICLE or name in ("body", "html") else self.scopes[scope][name] > 0

    def close(self, name: str) -> bool:
        if not self.reaches(name):
            return False
        while self.top.name != name:
            self.cut(len(self.items) - 1)
        self.cut(len(self.items) - 1)
        return True

    def drop_holds(self, name: str) -> bool:
        """Whether a dropped element, or what is open within it, has the name."""
        return self.scopes[-1][name] > 0

    def ends_drop(self, tag: Tag) -> bool:
        """Whether a tag ends the dropped element, whose own end tag is missing then."""
        root, parent = self.items[self.drop].name, self.items[self.drop - 1].name
        if tag.ends:
            return self.reaches(tag.name, self.drop_scope - 1)
        if tag.name == "body" or (tag.name in ARTICLE and root not in HOLDS_ARTICLE) or (root == "option" and tag.name in ("option", "optgroup")):
            return True
        return root not in BOUNDARY and ((parent == "p" and tag.name not in INLINE and tag.name not in DROPPED) or parent == tag.name == "li")


class _Builder:
    """Cuts a page into blocks at the borders of block elements."""

    def __init__(self) -> None:
        self.out: list[Block] = []
        self.parts: list[tuple[str, bool]] = []
        self.stack = Stack()
        self.regions = self.breaks = 0
        #: (how many elements were open when the open link began, whether it ends with its block), if there is one.
        self.link: tuple[int, bool] | None = None

    def flush(self) -> None:
        if self.parts:
            top = self.stack.top
            text = " ".join(html.unescape("".join(x for x, _ in self.parts)).split())
            if text:
                links = sum(len(" ".join(html.unescape(x).split())) for x, linked in self.parts if linked)
                self.out.append(Block(text, links, top.furniture, top.region, top.article))
            self.parts = []

    def cut(self, size: int) -> None:
        self.stack.cut(size)
        self._unlink()

    def _unlink(self) -> None:
        if self.link and self.link[0] > len(self.stack.items):
            self.link = None

    def text(self, text: str) -> None:
        if self.stack.drop is None:
            self.parts.append((text, self.link is not None))
            if self.breaks and text.strip():
                self.breaks = 0

    def tag(self, tag: Tag) -> None:
        stack = self.stack
        if tag.name in VOID:
            if stack.drop is None:
                self.void(tag.name)
            return
        if stack.drop is not None:
            if self.dropped(tag):
                return
            self.cut(stack.drop)
        top = stack.top
        if tag.name in DROPPED and not tag.ends:
            self.parts.append((" ", False))
            if not (tag.closed and tag.name in ("svg", "math")):
                stack.push(Open(tag.name, True, top.region, top.article), True)
        elif tag.name == "a":
            if tag.ends:
                self.link = None
            elif "href" in tag.attributes:
                self.link = (len(stack.items), tag.closed)
        elif tag.name in INLINE:
            if tag.ends:
                if top.name == tag.name:
                    self.flush()
                    self.cut(len(stack.items) - 1)
            elif _is_furniture(tag, bool(top.article)):
                self.flush()
                stack.push(Open(tag.name, True, top.region, top.article))
        else:
            self.block(tag)

    def void(self, name: str) -> None:
        if name == "br":
            self.breaks += 1
            self.parts.append((" ", False))
            if self.breaks == 2:
                self.flush()
        elif name == "hr":
            self.flush()

    def dropped(self, tag: Tag) -> bool:
        """Handle a tag within a dropped element; False if it ends the element and is still to be handled."""
        stack = self.stack
        if tag.ends:
            if stack.drop_holds(tag.name):
                while stack.top.name != tag.name:
                    self.cut(len(stack.items) - 1)
                self.cut(len(stack.items) - 1)
                return True
            return not stack.ends_drop(tag)
        if stack.ends_drop(tag):
            return False
        if not tag.closed:
            if tag.name == "option" and stack.top.name == "option":
                self.cut(len(stack.items) - 1)
            stack.push(Open(tag.name, True, stack.top.region, stack.top.article), stack.drop is None)
        return True

    def block(self, tag: Tag) -> None:
        stack, name = self.stack, tag.name
        self.flush()
        self.breaks = 0
        if self.link and self.link[1]:
            self.link = None
        if tag.ends:
            stack.close(name)
            self._unlink()
            if name in ("article", "main", "section", "div"):
                self.regions += 1
            return
        if stack.top.name == "p" or (name == "li" and stack.top.name == "li"):
            self.cut(len(stack.items) - 1)
        if name == "body":
            stack.close("head")
        top = stack.top
        level, region, article = _article_level(tag), top.region, top.article
        if level > article:
            article, self.regions = level, self.regions + 1
            region = self.regions
        stack.push(Open(name, top.furniture or _is_furniture(tag, bool(top.article)), region, article))

    def finish(self) -> list[Block]:
        if self.stack.drop is not None:
            self.cut(self.stack.drop)
        self.flush()
        return self.out


def blocks(page: str) -> list[Block]:
    """The blocks of a page in order, with what pass one needs to know of each."""
    builder = _Builder()
    for x in tokens(page):
        if isinstance(x, str):
            builder.text(x)
        else:
            builder.tag(x)
    return builder.finish()


def _is_dense(b: Block) -> bool:
    words = b.text.lower().split()
    return sum(w.strip(string.punctuation) in _STOPS for w in words) >= MIN_STOP_SHARE * len(words)


def decide(found: list[Block]) -> None:
    """Pass one."""
    own = [b for b in found if not b.furniture]
    linkless = [b for b in own if b.links <= MAX_LINK_SHARE * len(b.text)]
    # In a language that the stop words do not cover no block is dense, and length alone counts.
    known = any(len(b.text) >= SHORT_CHARS and _is_dense(b) for b in linkless)
    solid = {id(b): len(b.text) for b in linkless if len(b.text) >= LONG_CHARS and (not known or _is_dense(b))}
    # A container is the article only if it holds most of the long dense text.
    top = 0
    for level in sorted({b.article for b in own if b.article}, reverse=True):
        if 2 * sum(solid.get(id(b), 0) for b in own if b.article >= level) >= sum(solid.values()):
            top = level
            break
    for b in found:
        b.article = int(top > 0 and b.article >= top)
        size = len(b.text)
        if b.furniture:
            b.label = False
        elif top and not b.article:
            b.label = id(b) in solid
        elif b.links > MAX_LINK_SHARE * size:
            b.label = None if b.article and size >= LONG_CHARS else False
        elif size >= SHORT_CHARS:
            if id(b) in solid or (size >= LONG_CHARS and (b.article or b.links <= FEW_LINKS * size)) or (b.article and _is_dense(b)):
                b.label = True
    if top:
        _join(own)


def _join(own: list[Block]) -> None:
    """Outside the article, blocks with few links between two that are in, or just before one, are in as well."""
    last: int | None = None
    for i, b in enumerate(own):
        if b.article:
            last = None
        elif b.label:
            for x in own[max(i - 1, 0) if last is None else last + 1 : i]:
                if not x.article and x.links <= MAX_LINK_SHARE * len(x.text):
                    x.label = True
            last = i


def inherit(found: list[Block]) -> None:
    """Pass two. Page furniture stands apart: it is passed over, and gives no label to its neighbours."""
    rows = [b for b in found if not b.furniture]
    region_of: dict[tuple[int, int], list[Block]] = {}
    for b in rows:
        region_of.setdefault((b.article, b.region if b.article else 0), []).append(b)
    for (article, _), own in region_of.items():
        n = len(own)
        before: list[int | None] = []
        last = None
        for i, b in enumerate(own):
            before.append(last)
            if b.label is not None:
                last = i
        after: list[int | None] = [None] * n
        last = None
        for i in range(n - 1, -1, -1):
            after[i] = last
            if own[i].label is not None:
                last = i
        labels = [b.label for b in own]
        for i, b in enumerate(own):
            if labels[i] is None:
                x, y = before[i], after[i]
                if x is None and y is None:
                    b.label = True
                elif x is None or y is None:
                    b.label = labels[y if x is None else x]
                elif i - x != y - i:
                    b.label = labels[x] if i - x < y - i else labels[y]
                else:
                    b.label = (labels[x] or labels[y]) if article else (labels[x] and labels[y])


def main_text(page: str) -> str:
    found = blocks(page)
    decide(found)
    inherit(found)
    return "\n".join(b.text for b in found if b.label)


def _extract(at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            texts = [main_text(x or "") for x in columns[at].to_pylist()]
            columns[at] = pa.array(texts, batch.schema.field(at).type)
            yield pa.RecordBatch.from_arrays([*columns, pa.array(list(map(len, texts)), pa.int64())], [*batch.schema.names, "_n"])

    return run


def extract(pages: DataFrame, html_col: str = "html") -> DataFrame:
    """``pages`` without the html, with ``text`` and its length ``n_chars``."""
    names = fresh(pages.drop(html_col), "text", "n_chars")
    rows = pages.select(*numbered(pages, html_col), quoted(html_col).cast("string").alias("_html"))
    schema = ", ".join([*[f"`{c}` {t}" for c, t in rows.dtypes], "_n long"])
    out = rows.mapInArrow(_extract(len(rows.columns) - 1), schema)
    return out.select(*[F.col(f"_c{i}").alias(c) for i, c in enumerate(pages.columns) if c != html_col], F.col("_html").alias(names[0]), F.col("_n").alias(names[1]))
