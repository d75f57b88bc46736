"""Main-text extraction by consensus host paths.

1. Each page is cut into text blocks under its containers; menus, page
   headers, footers, sidebars, notices, adverts, forms, scripts, styles and
   reader comments are dropped by tag and class.  A container's score is its
   own text without links, and a share of what its inner containers hold.
2. The best container of a page votes for its path of tags and classes, with
   numbers generalised.  Spark counts the votes per host with partial
   aggregation and keeps the path with most votes.
3. Every page is extracted again from the container on its host's winning
   path; a page without that path keeps its own best container.

What a path stands for is an article whole (``selected``): the outermost
``article`` around the container, title and sections included; without one,
every container on the path, widened to the outermost ancestor marked as an
article, and the text that its ancestors hold themselves.

Whatever these hold is kept, whole: character references are decoded, white
space inside a block becomes one space, blocks are trimmed and joined in page
order by one space.  Inline and void elements other than ``br`` and ``hr`` are no break.

Defined results: null or empty html gives an empty text; a null url, or one
without a host, has no consensus and uses its own best container; ties of
votes go to the higher summed score, then the smaller path; repeated rows vote
and are extracted each; an empty table gives an empty result.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.tables import materialize
from .shipping import shipped

# Elements by their role on a page.
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins",
          "kbd", "label", "mark", "q", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var"}
CONTAINERS = {"body", "article", "main", "section", "div", "td", "center"}
DROPPED = {"head", "nav", "footer", "aside", "form", "button", "select", "textarea", "iframe", "dialog", "menu",
           "noscript", "template", "svg", "object", "canvas", "audio", "video"}
DROPPED_CLASSES = {
    "ad", "ads", "advert", "adverts", "advertisement", "sponsored", "sponsor", "promo", "banner", "cookie", "cookies",
    "consent", "gdpr", "notice", "notices", "alert", "popup", "modal", "overlay", "newsletter", "subscribe", "signup",
    "paywall", "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "pagination", "pager", "sidebar",
    "aside", "widget", "related", "recommended", "share", "sharing", "social", "comment", "comments", "disqus",
    "footer", "masthead", "topbar", "toolbar", "login", "search", "hidden", "skip",
}
DROPPED_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "alert", "dialog", "form", "menu"}
GOOD_CLASSES = {"article", "content", "post", "entry", "story", "main", "body", "text"}
#: Layout words: the word before them says what a class or id name stands for.
NEUTRAL = {"area", "articles", "author", "bar", "block", "body", "bottom", "box", "button", "buttons", "card", "col", "column",
           "container", "content", "desktop", "dialog", "form", "group", "holder", "icon", "icons", "info", "inner", "item",
           "items", "left", "link", "links", "list", "main", "message", "meta", "mobile", "outer", "panel", "placeholder",
           "posts", "primary", "right", "row", "secondary", "section", "sections", "slot", "stories", "success", "text",
           "title", "top", "unit", "warning", "widgets", "wrap", "wrapper", "x", "zone"}
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"},
          "th": {"td", "th"}, "option": {"option"}}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(script|style)\b.*?(?:</\1\s*>|\Z)|<[!?][^>]*>"
    r"|<(/?)([a-zA-Z][a-zA-Z0-9:-]*+)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+'|[\"'])*+)>", re.S | re.I)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)")
_PIECES = re.compile(r"[a-z]+|[0-9]+", re.I)


@dataclass
class Page:
    """Containers (parent, path, tag, weight, marked as an article) and text blocks (container, text, characters outside links)."""
    parents: list[int] = field(default_factory=lambda: [-1])
    paths: list[str] = field(default_factory=lambda: [""])
    tags: list[str] = field(default_factory=lambda: [""])
    marked: list[bool] = field(default_factory=lambda: [False])
    weights: list[float] = field(default_factory=lambda: [0.5])
    blocks: list[tuple[int, str, int]] = field(default_factory=list)


def _attributes(text: str) -> dict[str, str]:
    """Attributes by name, read one after another; of a repeated one, the first."""
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        out.setdefault(m[1].lower(), m[2] or m[3] or m[4] or "")
    return out


def _stands_for_dropped(name: str) -> bool:
    """Whether a class or id name stands for a dropped part, as ``cookie-notice`` and ``ad-slot-2`` do.

    Its last word that is no layout word tells: ``social-story`` is a story.
    """
    words = [w for w in _PIECES.findall(name) if not w.isdigit()]
    while words and words[-1] in NEUTRAL:
        words.pop()
    return bool(words) and words[-1] in DROPPED_CLASSES


def _dropped(tag: str, attributes: dict[str, str], inside_article: bool) -> bool:
    if tag in DROPPED or (tag == "header" and not inside_article):
        return True
    if "hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true":
        return True
    if attributes.get("role", "").lower() in DROPPED_ROLES:
        return True
    if tag in ("body", "html", "article", "main"):
        return False
    return any(map(_stands_for_dropped, f"{attributes.get('class', '')} {attributes.get('id', '')}".lower().split()))


def parse(html: str) -> Page:
    """Containers and blocks of a page, dropped parts left out."""
    page = Page()
    stack: list[tuple[str, int, bool]] = [("", 0, False)]       # tag, container, dropped
    pieces: list[str] = []
    links = [0, 0]                                               # open links, characters inside them
    at = 0

    def flush() -> None:
        text = " ".join("".join(pieces).split())
        pieces.clear()
        if text:
            page.blocks.append((stack[-1][1], text, max(len(text) - links[1], 0)))
        links[1] = 0

    def add(text: str) -> None:
        if text and not stack[-1][2]:
            text = entities.unescape(text)
            pieces.append(text)
            if links[0]:
                links[1] += len(text)

    for m in _TOKEN.finditer(html):
        add(html[at:m.start()])
        at = m.end()
        tag = (m[3] or "").lower()
        if not tag:
            continue
        if tag in INLINE:
            if tag == "a":
                links[0] = 0 if m[2] else 1
            top, container, gone = stack[-1]
            if m[2]:
                if top == tag:
                    stack.pop()
            elif top == tag if gone else m[4] and _dropped(tag, _attributes(m[4]), True):
                stack.append((tag, container, True))
            continue
        if tag in VOID and tag not in ("br", "hr"):
            continue
        flush()
        if m[2]:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] == tag:
                    del stack[i:]
                    break
            continue
        if tag in VOID:
            continue
        ends = CLOSES.get(tag, set())
        while len(stack) > 1 and (stack[-1][0] in ends or stack[-1][0] == "p" and tag != "p" and tag not in INLINE
                                  or stack[-1][0] == "p" == tag):
            stack.pop()
        attributes = _attributes(m[4])
        _, container, gone = stack[-1]
        gone = gone or _dropped(tag, attributes, any(s[0] in ("article", "main") for s in stack))
        if not gone and tag in CONTAINERS:
            name = re.sub(r"[0-9]+", "#", (attributes.get("class", "").split() or [""])[0].lower())
            page.parents.append(container)
            page.paths.append(f"{page.paths[container]}>{tag}{'.' + name if name else ''}")
            page.tags.append(tag)
            good = bool(GOOD_CLASSES & set(_PIECES.findall(f"{name} {attributes.get('id', '')}".lower())))
            page.marked.append(tag not in ("body", "article") and (good or tag == "main"))
            page.weights.append((2.0 if tag == "article" else 1.5 if tag == "main" else 1.0) * (1.5 if good else 1.0))
            container = len(page.parents) - 1
        if not m[4].rstrip().endswith("/") or tag in CONTAINERS:
            stack.append((tag, container, gone))
    add(html[at:])
    flush()
    return page


def scores(page: Page) -> list[float]:
    """Score of each container: unlinked text, halved with each container in between."""
    out = [0.0] * len(page.parents)
    for container, text, plain in page.blocks:
        value, c = float(2 * plain - len(text)), container
        while c >= 0:
            out[c] += value
            value, c = value / 2, page.parents[c]
    return [s * w for s, w in zip(out, page.weights)]


def best_container(page: Page, path: str | None = None) -> tuple[int, float]:
    """(container, score) of the best one, on ``path`` if given; (-1, 0) if there is none."""
    found = [(s, -i) for i, s in enumerate(scores(page)) if path is None or page.paths[i] == path]
    if not found:
        return -1, 0.0
    score, i = max(found)
    return -i, score


def text_under(page: Page, *containers: int, own: frozenset[int] = frozenset()) -> str:
    """Blocks of containers and of all inside them, and those that ``own`` hold themselves, in page order."""
    inside = [False] * len(page.parents)
    for i, parent in enumerate(page.parents):                    # parents come first
        inside[i] = i in containers or (parent >= 0 and inside[parent])
    return " ".join(text for c, text, _ in page.blocks if inside[c] or c in own)


def _above(page: Page, container: int) -> list[int]:
    """The container and what it lies in, without the page itself."""
    out = []
    while container > 0:
        out.append(container)
        container = page.parents[container]
    return out


def selected(page: Page, path: str | None = None) -> str:
    """The article that ``path`` stands for, or the page's own best path if the page has no such container."""
    best = best_container(page, path)[0] if path is not None else -1
    if best < 0:
        best = best_container(page)[0]
    articles = [c for c in _above(page, best) if page.tags[c] == "article"]
    if articles:
        return text_under(page, articles[-1])
    chosen, own = set(), set()
    for c in (i for i, p in enumerate(page.paths) if p == page.paths[best]):
        around = _above(page, c)
        chosen.add(next((a for a in reversed(around) if page.marked[a]), c))
        own.update(around)
    return text_under(page, *chosen, own=frozenset(own))


def host_of(url: str | None) -> str | None:
    m = _HOST.match(url or "")
    return m[1].lower() if m else None


def _vote_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for url, html in zip(batch.column("url").to_pylist(), batch.column("html").to_pylist()):
            host = host_of(url)
            if host and html:
                page = parse(html)
                best, score = best_container(page)
                if best >= 0 and score > 0:
                    rows.append((host, page.paths[best], score))
        yield pa.RecordBatch.from_arrays(
            [pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.string()),
             pa.array([round(r[2]) for r in rows], pa.int64())], names=["host", "path", "score"])


def consensus(pages: DataFrame) -> DataFrame:
    """(host, path): the path with most votes of each host."""
    votes = pages.select("url", "html").mapInArrow(_vote_batches, "host string, path string, score long")
    counted = votes.groupBy("host", "path").agg(F.count("*").alias("votes"), F.sum("score").alias("score"))
    first = F.struct((-F.col("votes")).alias("v"), (-F.col("score")).alias("s"), "path")
    return counted.groupBy("host").agg(F.min(first).alias("w")).select("host", F.col("w.path").alias("path"))


def _host_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        yield pa.RecordBatch.from_arrays(
            [*batch.columns, pa.array([host_of(u) for u in batch.column("url").to_pylist()], pa.string())],
            names=[*batch.schema.names, "host"])


def _extract_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = []
        for html, path in zip(batch.column("html").to_pylist(), batch.column("path").to_pylist()):
            text = ""
            if html:
                text = selected(parse(html), path)
            texts.append(text)
        yield pa.RecordBatch.from_arrays(
            [batch.column("page_id"), batch.column("url"), pa.array(texts, pa.string()),
             pa.array([len(t) for t in texts], pa.int64())], names=["page_id", "url", "text", "n_chars"])


@shipped
def extract(pages: DataFrame) -> DataFrame:
    """(page_id, url, text, n_chars) for every page.

    The pages meet their host's path in a join on the host; the join splits a
    host that holds many pages.
    """
    source = pages.select(F.col("page_id").cast("long").alias("page_id"), "url", "html")
    winners = materialize(consensus(source), "host-paths")
    hosted = source.mapInArrow(_host_batches, "page_id long, url string, html string, host string")
    return hosted.join(winners, "host", "left").select("page_id", "url", "html", "path").mapInArrow(
        _extract_batches, "page_id long, url string, text string, n_chars long")
