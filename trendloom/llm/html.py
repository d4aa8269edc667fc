"""Main text of web pages by text-to-tag ratios.

A page is read as the events of the standard library's streaming parser. They make *lines*: runs of
text between block-level tags, each with its characters, its tags and the elements around it.
Elements that never hold an article (menus, headers, footers, sidebars, notices, adverts, forms,
scripts, comments of readers) are left out by their tag, role, class or id. The ratio of text to tags
per line is smoothed with a Gaussian, and a threshold cuts the lines into two clusters, content and
the rest. The lines themselves only vote: the elements that hold the content cluster are the page's
content *regions*, and all their lines are returned, short ones too.
"""

from __future__ import annotations

import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from html.parser import HTMLParser

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from trendloom.llm.common import picked, prepare

SIGMA = 1.0  # of the smoothing, in lines
THRESHOLD = 0.5  # of the standard deviation of the smoothed ratios
OUTLIER = 0.25  # of the cluster's median ratio: lines below it don't widen the region, where no element is marked as article
OUT_CHARS = 8 << 20  # characters of a result batch

VOID = set("area base br col embed hr img input link meta param source track wbr".split())
INLINE = set(
    "a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd label mark q rp rt ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
# Elements without text of the page.
MUTE = set("script style noscript template head title svg math canvas audio video object iframe embed map".split())
SKIPPED = set("nav header footer aside form button select textarea input menu dialog fieldset datalist option label".split())
# Elements that can be a content region.
CONTAINERS = set("html body main article section div td center".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
# A start of the key ends an open element of the value, as end tags are optional.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
BLOCKERS = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table", "tr"}, "th": {"table", "tr"}, "option": {"select"}}
SKIPPED_ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar status".split())
# Words of a class or id that mark an element as no part of the article.
SKIPPED_WORDS = set(
    "ad ads advert adverts advertisement advertisements advertising adsense adbox banner sponsor sponsored promo promotion "
    "nav navbar navigation menu breadcrumb breadcrumbs topbar toolbar pagination pager sidebar aside rail footer masthead "
    "cookie cookies consent gdpr notice notices notification alert popup modal overlay newsletter subscribe subscription signup login "
    "comment comments commentlist reply replies respond discussion disqus share sharing social related recommended recommendations teaser teasers widget widgets copyright disclaimer".split()
)
# Of these, the words of text that isn't the page's own, or about the site: kept out while anything else is left.
OTHER_WORDS = set(
    "ad ads advert adverts advertisement advertisements advertising adsense adbox sponsor sponsored menu breadcrumb breadcrumbs pagination pager sidebar footer "
    "cookie cookies consent gdpr newsletter comment comments commentlist reply replies respond discussion disqus related recommended recommendations teaser teasers copyright disclaimer".split()
)
COMMENT_WORDS = {"comment", "reply"}  # the first word of a class that makes an article a reader's comment
ARTICLE_WORDS = set("article content post entry story main body text".split())
# A class name with one of these tells of a page's layout, not of the element itself: ``has-sidebar``.
LAYOUT_WORDS = set("has have with without no not layout open closed".split())
# These say what an element is of, and that it is a box, at the begin and the end of a name: ``site-footer``,
# ``ad-container``. Elsewhere they too tell of the layout: ``sidebar-page-container``.
OF_WORDS, BOX_WORDS = {"page", "site"}, {"wrapper", "container"}
# Elements that pages leave open by mistake; their end tags aren't optional.
LEFT_OPEN = set("nav header footer aside form menu dialog fieldset".split())
NO, YES, ALWAYS = 0, 1, 2  # whether an element is skipped; in a lenient reading only what is always skipped holds an article back
STRICT, LENIENT, LAST = 0, 1, 2
STRAY = 0.2  # of the page's text outside links: with less of it left than this, the strict reading has only stray lines


@dataclass(eq=False)
class Container:
    """A container element: elements are numbered as they begin, so all it holds is from ``number`` to ``last``."""

    number: int
    parent: Container | None
    last: int = 0


@dataclass
class Line:
    text: str
    tags: int
    container: Container
    article: int  # the element that is marked as an article, or 0
    heading: bool = False


@dataclass
class Element:
    """An open element, with what is known of the elements around it, so that no text walks the stack."""

    tag: str
    number: int
    skipped: int
    article: int
    container: Container
    link: bool
    heading: bool
    own_header: bool  # in a header of an article
    own_heading: bool  # in a heading of such a header


@dataclass
class Reader(HTMLParser):
    """Collects the lines of a page that are in no skipped element.

    A lenient reader goes by the classes and ids of ``OTHER_WORDS`` only, reads forms and the elements
    ``opened``, which an earlier reading found never closed, and lets an article out of a skipped
    element. The last one, for pages that hold nothing else, goes by no class or id.
    """

    lines: list[Line] = field(default_factory=list)
    level: int = STRICT
    opened: frozenset[int] = frozenset()

    def __post_init__(self):
        super().__init__(convert_charrefs=True)
        self.stack: list[Element] = []
        self.places: dict[str, list[int]] = defaultdict(list)  # of the open elements of each tag
        self.blocks: list[int] = []  # places of the open elements that are not inline
        self.root = Container(0, None)
        self.count = 0
        self.pieces: list[str] = []
        self.tags = 0
        self.left_open: set[int] = set()  # skipped elements that were never closed
        self.kept = self.missed = 0  # characters outside links, read and skipped
        self.missed_article = False

    def cut(self) -> None:
        text = " ".join("".join(self.pieces).split())
        if text:
            top = self.stack[-1] if self.stack else None
            self.lines.append(Line(text, self.tags, top.container if top else self.root, top.article if top else 0, bool(top and top.heading)))
            self.tags = 0
        self.pieces = []

    def is_skipped(self, tag: str, attrs: dict[str, str]) -> int:
        if tag in ("html", "body", "main"):
            return NO
        if tag in MUTE:
            return ALWAYS
        within = bool(self.stack and self.stack[-1].article)
        if self.count + 1 in self.opened or tag == "form" and self.level:
            return NO
        if tag in SKIPPED and not (tag in ("header", "label") and within):
            return YES
        if attrs.get("role", "").lower() in SKIPPED_ROLES and tag not in HEADINGS:
            return YES
        if tag in INLINE or tag in HEADINGS or self.level == LAST:
            return NO
        marked = is_marked(tag, attrs)
        found = NO
        for name in f"{attrs.get('class', '')} {attrs.get('id', '')}".split():
            words = re.findall(r"[a-z]+", re.sub(r"([a-z])([A-Z])", r"\1 \2", name).lower())
            if marked:  # classes hold the categories of a post as well
                if words and words[0] in COMMENT_WORDS:
                    return ALWAYS
                continue
            of_page = words[:1] == ["page"]
            words = own_words(words)
            if words & OTHER_WORDS:
                return ALWAYS
            if self.level == STRICT and (words & SKIPPED_WORDS or "header" in words and not of_page and not words & ARTICLE_WORDS and not within):
                found = YES
        return found

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        known = {k.lower(): v or "" for k, v in attrs}
        if tag not in INLINE:
            self.cut()
        self.tags += 1
        if tag in VOID:
            if tag == "br":
                self.pieces.append(" ")
            return
        if tag not in INLINE:
            self.end_open({"p"}, {"button", "td", "th", "table", "article", "section", "div", "li", "body"})
        if tag in CLOSES:
            for own in CLOSES[tag]:
                self.end_open({own}, BLOCKERS[tag])
        parent = self.stack[-1] if self.stack else None
        freed = self.level and (tag == "main" or is_marked(tag, known)) and parent and parent.skipped < ALWAYS
        skipped = max(parent.skipped if parent and not freed else NO, self.is_skipped(tag, known))
        article = parent.article if parent else 0
        self.count += 1
        if tag == "article" or known.get("itemprop") == "articleBody":
            article = article or self.count
        elif (tag == "main" or known.get("role") == "main") and not article:
            article = -self.count
        if article < 0 and (tag == "article" or known.get("itemprop") == "articleBody"):
            article = self.count
        self.push(tag, parent, skipped, article)

    def push(self, tag: str, parent: Element | None, skipped: int, article: int) -> None:
        container = parent.container if parent else self.root
        if tag in CONTAINERS:
            container = Container(self.count, container)
        heading, own_header = tag in HEADINGS, bool(tag == "header" and article)
        self.places[tag].append(len(self.stack))
        if tag not in INLINE:
            self.blocks.append(len(self.stack))
        self.stack.append(
            Element(
                tag,
                self.count,
                skipped,
                article,
                container,
                tag == "a" or bool(parent and parent.link),
                heading or bool(parent and parent.heading),
                own_header or bool(parent and parent.own_header),
                bool(parent and (parent.own_heading or parent.own_header and heading)),
            )
        )

    def last_of(self, tags: set[str]) -> int:
        """The place of the innermost open element of these tags, or -1."""
        return max((self.places[tag][-1] for tag in tags if self.places[tag]), default=-1)

    def end_open(self, tags: set[str], until: set[str]) -> None:
        """End an open element of ``tags`` unless one of ``until`` is opened inside it."""
        at = self.last_of(tags)
        if at > self.last_of(until - tags):
            self.cut()
            self.leave(at)

    def leave(self, i: int, closed: int = 1) -> None:
        """Leave the elements from the ``i``-th on; only the first of them was closed."""
        self.left_open.update(e.number for e in self.stack[i + closed :] if e.skipped and e.tag in LEFT_OPEN)
        for element in reversed(self.stack[i:]):
            self.places[element.tag].pop()
            if element.container.number == element.number:
                element.container.last = self.count
        del self.stack[i:]
        while self.blocks and self.blocks[-1] >= i:
            self.blocks.pop()

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)  # as browsers do, the slash is ignored

    def handle_endtag(self, tag: str) -> None:
        if tag in VOID:
            return
        self.tags += 1
        if tag not in INLINE:
            self.cut()
        at = self.last_of({tag})
        if at >= 0 and (tag not in INLINE or not self.blocks or at > self.blocks[-1]):
            self.leave(at)

    def handle_data(self, data: str) -> None:
        if self.stack:
            top = self.stack[-1]
            if top.skipped == ALWAYS:
                return
            size = 0 if top.link else len("".join(data.split()))
            if top.skipped:
                self.missed += size
                self.missed_article |= bool(size and top.article)
                return
            if top.own_header and not top.own_heading:
                return  # of an article's own header only its headings count
            self.kept += size
        self.pieces.append(data)

    def read(self, page: str) -> Reader:
        self.feed(page)
        self.close()
        self.cut()
        self.leave(0, 0)
        self.root.last = self.count
        return self

    @property
    def is_stray(self) -> bool:
        """Whether the lines may be no more than what stands around the article."""
        if any(line.article > 0 for line in self.lines):
            return False
        return self.missed_article or self.kept < STRAY * (self.kept + self.missed)


def own_words(words: list[str]) -> set[str]:
    """The words of a class name that tell what its element is."""
    first, last = 0, len(words)
    while first < last and words[first] in OF_WORDS:
        first += 1
    while first < last and words[last - 1] in BOX_WORDS:
        last -= 1
    own = set(words[first:last])
    return set() if own & (LAYOUT_WORDS | OF_WORDS | BOX_WORDS) else own


def is_marked(tag: str, attrs: dict[str, str]) -> bool:
    return tag == "article" or attrs.get("itemprop") == "articleBody" or attrs.get("role") == "main"


def ratios(lines: list[Line]) -> np.ndarray:
    """Characters of each line to its tags, smoothed over the neighbouring lines."""
    raw = np.array([len(line.text) / max(1, line.tags) for line in lines], dtype=float)
    reach = int(np.ceil(3 * SIGMA))
    kernel = np.exp(-0.5 * (np.arange(-reach, reach + 1) / SIGMA) ** 2)
    padded = np.pad(raw, reach, mode="edge")
    return np.convolve(padded, kernel / kernel.sum(), mode="valid")


def content_lines(lines: list[Line]) -> np.ndarray:
    """The lines of the content cluster; the line of the largest ratio is always one."""
    smooth = ratios(lines)
    return (smooth >= THRESHOLD * smooth.std()) | (smooth == smooth.max())


def outliers(lines: list[Line], chosen: np.ndarray) -> np.ndarray:
    """Lines that are in the cluster by their neighbours only; a heading before a line of the cluster's own isn't one."""
    raw = np.array([len(line.text) / max(1, line.tags) for line in lines])
    low = raw < OUTLIER * np.median(raw[chosen])
    for i in range(len(lines) - 2, -1, -1):
        if lines[i].heading and chosen[i + 1] and not low[i + 1]:
            low[i] = False
    low[np.flatnonzero(chosen)[raw[chosen].argmax()]] = False
    return low


def regions(lines: list[Line]) -> list[Line]:
    """All lines of the elements that hold the content cluster."""
    if not lines:
        return []
    chosen = content_lines(lines)
    for marked in (lambda a: a > 0, lambda a: a < 0):  # an article, else the main element
        if any(marked(line.article) for line in lines):
            held = {line.article for line, c in zip(lines, chosen, strict=True) if marked(line.article) and c}
            held = held or {line.article for line in lines if marked(line.article)}
            return [line for line in lines if line.article in held]
    voters = [line.container for line, c in zip(lines, chosen & ~outliers(lines, chosen), strict=True) if c]
    # the innermost element that holds all of the cluster
    numbers = [c.number for c in voters]
    inner = voters[0]
    while inner.number > min(numbers) or inner.last < max(numbers):
        inner = inner.parent
    own = [line for line in lines if inner.number <= line.container.number <= inner.last]
    # an element that is a single line of several is no region
    if len(own) == 1 and len(lines) > 1 and inner.parent is not None:
        outer = inner.parent
        return [line for line in lines if outer.number <= line.container.number <= outer.last]
    if inner in voters:
        return own
    # an article in several elements: from the first to the last of them, with what stands between
    parts: list[Container] = []
    for container in voters:
        while not parts or not parts[-1].number <= container.number <= parts[-1].last:
            part = container
            while part.parent is not inner:
                part = part.parent
            parts.append(part)
    first, last = parts[0].number, parts[-1].last
    at = [i for i, line in enumerate(own) if first <= line.container.number <= last and line.container is not inner]
    return own[at[0] : at[-1] + 1]


def main_text(page: str | None) -> str:
    """The article's text: white space inside a block as one space, blocks joined by one space."""
    if not page:
        return ""
    strict = Reader().read(page)
    text = " ".join(line.text for line in regions(strict.lines))
    if not strict.lines or strict.is_stray:
        lenient = Reader(level=LENIENT, opened=frozenset(strict.left_open)).read(page)
        wider = " ".join(line.text for line in regions(lenient.lines))
        if len(text) < len(wider) / 2:
            return wider
    if not text:
        last = Reader(level=LAST, opened=frozenset(strict.left_open)).read(page)
        text = " ".join(line.text for line in regions(last.lines))
    return text


def extracted(pages: DataFrame, html: str = "html", text: str = "text") -> DataFrame:
    """``pages`` with the column ``html`` replaced by ``text`` and ``n_chars``, its code points.

    A null or empty page, or one without content, has an empty text. Columns of those names, in any
    letter case, that ``pages`` has already are replaced; all others are kept; every row gives one row.
    The work on a page grows with its length, however deep its elements are or how many stay open.
    """
    prepare(pages.sparkSession)
    replaced = {html.lower(), text.lower(), "n_chars"}
    kept = [c for c in pages.columns if c.lower() not in replaced]
    rows = picked(pages, html, *kept).withColumn(html, F.col(f"`{html}`").cast("string"))
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.schema.fields[1:]), f"`{text}` string", "n_chars long"])

    def extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts: list[str] = []
            first = size = 0

            def part(first: int, texts: list[str], batch=batch) -> pa.RecordBatch:
                columns = [c.slice(first, len(texts)) for c in batch.columns[1:]]
                return pa.RecordBatch.from_arrays([*columns, pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=[*batch.schema.names[1:], text, "n_chars"])

            for page in batch.column(0):
                texts.append(main_text(page.as_py()))
                size += len(texts[-1])
                if size >= OUT_CHARS:
                    yield part(first, texts)
                    first, texts, size = first + len(texts), [], 0
            if texts:
                yield part(first, texts)

    return rows.mapInArrow(extract, schema)
