"""Main text of web pages by the distribution of text over line blocks."""

from __future__ import annotations

import html
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import takewhile

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from galenus.llm.shared import bounded_batches

#: Lines of a sliding window, and the characters up to which a line adds to it: a long paragraph is no denser than a full line.
WINDOW, FULL_LINE = 3, 80

#: A stretch must surge to this share of the page's largest window sum; it dives where the sums return to 0.
SURGE = 0.25

#: Articles that a page marks are its main text if they hold this share of what is no boilerplate.
ARTICLE_SHARE = 0.25

# Fixed values of the HTML language and of common page templates.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp noscript".split())  # their content is no markup
SILENT = frozenset("template svg select datalist object canvas audio video".split())  # their content is no text of the page
BLOCK = frozenset(
    "address article aside blockquote body button caption center col colgroup dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main "
    "menu nav ol option p pre search section select summary table tbody td template tfoot th thead tr ul video audio canvas object svg".split()
)
CLOSES_P = BLOCK - frozenset("body button caption col colgroup dd dt head html legend li option select summary tbody td template tfoot th thead tr video audio canvas object svg".split())
#: Elements that end an open one of the given names, unless one of the containers lies between.
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "td": ("td", "th"), "th": ("td", "th"), "tr": ("tr",), "option": ("option",)}
CONTAINERS = ("ul", "ol", "menu", "dl", "table", "select")
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
BOILERPLATE = frozenset("nav header footer aside button dialog menu search".split())
ROLES = frozenset("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog".split())
NAMES = frozenset(
    "ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments commentlist cookie cookies consent disqus footer footnav header masthead menu nav navbar "
    "navigation newsletter notice notices pager pagination popup promo promoted related replies respond share sharing sidebar signup skip social sponsor sponsored subscribe subscription toolbar widget".split()
)
#: Words that may stand beside one of NAMES in a class or id. Others change the meaning: related-work, social-history.
NEUTRAL = frozenset(
    "area articles bar block bottom box buttons col column container content desktop fixed form global google group icons inner item items layout left links list main mobile module outer page panel pages posts primary "
    "right row secondary section site slot stories sticky text thread top unit widgets wrap wrapper".split()
)
STATES = frozenset("has no with without".split())  # has-sidebar says what a layout holds, not what the element is
THREADS = frozenset("comment comments commentlist disqus related replies respond".split())  # lists of texts, never a layout
CONTENT = frozenset("article post entry content story page body".split())

#: A tag up to its end, or to the next < if that comes first; quotes count only as the first character of a value.
TAG = re.compile(r"""<(/?)([A-Za-z][^\s/><]*+)((?:[^<>=]++|=\s*+(?:"[^"]*+"|'[^']*+'|[^\s<>"'][^\s<>]*+)?+)*+)(>|(?=<)|\Z)""")
ATTRIBUTE = re.compile(r"""([^\s=/>"']++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s>]++)))?+""")
SPACE = re.compile(r"\s+")


@dataclass
class Line:
    """A block's text with white space folded. ``plain`` counts its characters outside links (a heading's links are its
    text); ``within`` numbers the innermost open element that looks like boilerplate, -1 for none."""

    text: str
    plain: int
    article: bool
    within: int = -1


@dataclass
class Suspect:
    """An open element that looks like boilerplate: by tag, role or state ("element"), as a form ("part"), as a list of texts
    ("thread"), by a whole class or id ("name") or by a piece of one ("part")."""

    kind: str
    parent: int
    holds_main: bool = False


@dataclass
class _Reader:
    """Blocks and open elements of a page; each step takes constant time on average."""

    lines: list[Line] = field(default_factory=list)
    suspects: list[Suspect] = field(default_factory=list)
    tags: list[tuple[str, int]] = field(default_factory=list)  # open elements: tag, suspect around what follows
    at: dict[str, list[int]] = field(default_factory=lambda: defaultdict(list))  # places in ``tags`` by tag
    blocks: list[int] = field(default_factory=lambda: [-1])
    parts: list[tuple[str, int]] = field(default_factory=list)  # text of the open block, suspect around it
    linked: int = 0
    link_depth: int | None = None  # of the open link
    heading: bool = False

    @property
    def within(self) -> int:
        return self.tags[-1][1] if self.tags else -1

    @property
    def in_article(self) -> bool:
        return bool(self.at["article"] or self.at["main"])

    def text(self, s: str) -> None:
        if s:
            self.parts.append((s, self.within))
            if self.link_depth is not None:
                self.linked += len(s.strip())

    def flush(self) -> None:
        """End the block: its text, and apart from it that of inline elements in it that look like boilerplate."""
        own = self.tags[self.blocks[-1]][1] if self.blocks[-1] >= 0 else -1
        texts: dict[int, list[str]] = {}
        for s, within in self.parts:
            texts.setdefault(within, []).append(s)
        for within, parts in texts.items():
            if text := SPACE.sub(" ", "".join(parts)).strip():
                plain = len(text) if self.heading else max(0, len(text) - self.linked) if within == own else 0
                self.lines.append(Line(text, plain, self.in_article, within))
        self.parts.clear()
        self.linked, self.heading = 0, False

    def start(self, tag: str, attributes: str) -> None:
        block = tag in BLOCK
        if block:
            self.flush()
        if tag in CLOSES_P and self.at["p"]:
            self.close(self.at["p"][-1])
        if tag in SIBLINGS:
            least = max((self.at[c][-1] for c in CONTAINERS if self.at[c]), default=-1)
            for name in SIBLINGS[tag]:
                if self.at[name] and self.at[name][-1] > least:
                    self.close(self.at[name][-1])
        if tag in VOID or attributes.endswith("/") and tag not in BLOCK:
            return
        kind, within = _suspicion(tag, attributes, self.in_article), self.within
        if tag == "main":
            k = within
            while k >= 0 and not self.suspects[k].holds_main:
                self.suspects[k].holds_main = True
                k = self.suspects[k].parent
        if kind:
            self.suspects.append(Suspect(kind, within))
            within = len(self.suspects) - 1
        if tag == "a" and re.search(r"\bhref\b", attributes):
            self.link_depth = len(self.tags)
        if tag in HEADINGS:
            self.heading = True
        self.at[tag].append(len(self.tags))
        if block:
            self.blocks.append(len(self.tags))
        self.tags.append((tag, within))

    def close(self, i: int) -> None:
        """End the open elements from place ``i`` on."""
        while len(self.tags) > i:
            tag, _ = self.tags.pop()
            self.at[tag].pop()
            if self.blocks[-1] == len(self.tags):
                self.blocks.pop()
        if self.link_depth is not None and len(self.tags) <= self.link_depth:
            self.link_depth = None

    def end(self, tag: str) -> None:
        """An end tag without its start counts for nothing; one of an inline element ends no block."""
        if tag in BLOCK:
            self.flush()
        if self.at[tag] and (tag in BLOCK or self.at[tag][-1] > self.blocks[-1]):
            self.close(self.at[tag][-1])


def _named(name: str) -> tuple[bool, bool]:
    """Whether a class or id holds one of NAMES beside neutral words only, and whether that is one of THREADS."""
    words = list(takewhile(lambda w: w not in STATES, re.split(r"[-_]+", name)))
    hits = [w for w in words if w in NAMES]
    if not hits or any(w not in NAMES and w not in NEUTRAL and w not in CONTENT and not re.fullmatch(r"\d*x?\d*", w) for w in words):
        return False, False
    own = bool(CONTENT.intersection(words))  # an article-header holds the headline
    hits = [w for w in hits if not (own and w in ("header", "masthead"))]
    return bool(hits), bool(THREADS.intersection(hits))


def _suspicion(tag: str, attributes: str, inside: bool) -> str:
    """The kind of Suspect that an element is, or ""."""
    if tag in SILENT:
        return "silent"
    if tag in BOILERPLATE and not (tag == "header" and inside):
        return "element"
    if tag == "form":
        return "part"
    if not attributes:
        return ""
    names: set[str] = set()
    for m in ATTRIBUTE.finditer(attributes):
        key, value = m[1].lower(), (m[2] or m[3] or m[4] or "").lower()
        if key == "hidden":
            return "silent"
        if key == "role" and value.strip() in ROLES or key == "aria-hidden" and value == "true":
            return "element"
        if key in ("class", "id"):
            names.update(value.split())
    if tag in ("html", "body", "main"):
        return ""
    found = [_named(n) for n in names]
    if any(thread for _, thread in found):
        return "part" if tag == "article" else "thread"
    if names & NAMES:
        return "part" if tag == "article" else "name"
    return "part" if any(hit for hit, _ in found) and tag != "article" else ""


def page_lines(page: str) -> tuple[list[Line], list[Suspect]]:
    """The page's blocks in order. Comments and raw elements go; unclosed tags close with their parents, a tag that the
    page's end cuts goes."""
    reader, at, n, unclosed = _Reader(), 0, len(page), set()
    while at < n:
        lt = page.find("<", at)
        if lt < 0:
            reader.text(html.unescape(page[at:]))
            break
        mark = page[lt + 1 : lt + 2]
        if mark in ("!", "?"):
            reader.text(html.unescape(page[at:lt]))
            last = "-->" if page.startswith("<!--", lt) else ">"
            end = page.find(last, lt + 2)
            if end < 0:
                break
            at = end + len(last)
            continue
        m = TAG.match(page, lt)
        if m is None:  # a lone < is text
            reader.text(html.unescape(page[at : lt + 1]))
            at = lt + 1
            continue
        reader.text(html.unescape(page[at:lt]))
        at, tag = m.end(), m[2].lower()
        if not m[4] and at == n:
            break
        if tag in ("br", "img"):
            reader.text(" ")
        if m[1]:
            reader.end(tag)
        elif tag in RAW:
            end = None if tag in unclosed else re.compile(rf"</{tag}\b[^>]*>", re.I).search(page, at)
            if end:
                at = end.end()
            elif tag in ("script", "style"):
                break
            else:
                unclosed.add(tag)
        else:
            reader.start(tag, m[3])
    reader.flush()
    return reader.lines, reader.suspects


def text_lines(lines: list[Line], suspects: list[Suspect]) -> list[Line]:
    """The lines that are in no boilerplate.

    A suspect element is boilerplate unless it proves to be layout: it holds a
    <main>, or most of the page's text and (if its tag or a whole name speaks
    against it) all the text of articles there is. Threads are never layout.
    """
    size, article = [0] * len(suspects), [0] * len(suspects)
    for x in lines:
        if x.within >= 0:
            size[x.within] += len(x.text)
            article[x.within] += len(x.text) if x.article else 0
    for k in range(len(suspects) - 1, -1, -1):
        if (parent := suspects[k].parent) >= 0:
            size[parent] += size[k]
            article[parent] += article[k]
    total, articles = sum(len(x.text) for x in lines), sum(len(x.text) for x in lines if x.article)
    out: list[bool] = []
    for s, n, a in zip(suspects, size, article, strict=True):
        most, whole = 2 * n > total, 0 < articles == a
        layout = s.holds_main or most and (s.kind == "part" or s.kind in ("name", "element") and whole)
        out.append(s.kind == "silent" or not layout or s.parent >= 0 and out[s.parent])
    return [x for x in lines if x.within < 0 or not out[x.within]]


def stretches(density: list[int], window: int = WINDOW) -> list[tuple[int, int]]:
    """(surge, dive) of each stretch of lines, the dive exclusive.

    ``window`` neighbouring densities are summed. A stretch is a run of sums
    above 0, of which one reaches SURGE times the page's largest sum; its ends
    are its first and last line with a density.
    """
    n = len(density)
    sums, total = [], sum(density[: window - 1])
    for i in range(n):
        total += density[i + window - 1] if i + window - 1 < n else 0
        sums.append(total)
        total -= density[i]
    peak, out, start = max(sums, default=0), [], None
    for i in range(n + 1):
        if i < n and sums[i] > 0:
            start = i if start is None else start
        elif start is not None:
            lines = [k for k in range(start, i) if density[k]]
            if lines and max(sums[start:i]) >= SURGE * peak:
                out.append((lines[0], lines[-1] + 1))
            start = None
    return out


def main_lines(lines: list[Line], suspects: list[Suspect]) -> list[Line]:
    """Lines between the surge and the dive of each stretch.

    Lines in boilerplate are stripped with the markup, so an aside within the
    text parts nothing. If the page marks articles that hold a fair share of the
    rest, all their text counts and what is outside them is stripped too; else
    only text outside links counts, so menus and link lists without a name are
    dives, and a short stretch among them never surges.
    """
    rest = text_lines(lines, suspects)
    marked = [x for x in rest if x.article]
    if marked and sum(len(x.text) for x in marked) >= ARTICLE_SHARE * sum(x.plain for x in rest):
        rest, density = marked, [min(len(x.text), FULL_LINE) for x in marked]
    else:
        density = [min(x.plain, FULL_LINE) for x in rest]
        if not any(density):  # nothing but links
            density = [min(len(x.text), FULL_LINE) for x in rest]
    return [x for surge, dive in stretches(density) for x in rest[surge:dive]]


def main_text(page: str | None) -> str:
    return "\n".join(x.text for x in main_lines(*page_lines(page or "")))


def _extract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        texts = [main_text(p) for p in b.column(2).to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


def extract_main_text(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) of every row of ``pages`` (page_id, url, html).

    Blocks are joined by one line feed. A null or empty page, or one without
    main text, gives an empty text; repeated rows each get their result; other
    columns are not read.
    """
    bounded_batches(pages.sparkSession)
    return pages.select(F.col("page_id").cast("long"), "url", "html").mapInArrow(_extract, "page_id long, url string, text string, n_chars long")
