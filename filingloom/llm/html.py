"""Main text of web pages by line-block distribution.

Markup is stripped into lines: one per block of text, and an empty one wherever a container begins or
ends. A line weighs its letters outside links; a region that is no article (menus, headers, footers,
asides, forms, adverts, comments and the like, by tag, role or class) is one empty line. The weights are summed over sliding windows of lines; text starts where the sums surge and stops where they
dive to nothing. In a marked article, every line of an article that has text outside links is kept, and
the sums decide nothing. Elsewhere the richest stretch between surge and dive is kept, with every other
stretch of at least a share of its weight, and with whatever stretch lies in the container around it.

Defined cases: NULL or empty html gives an empty text; a page whose every line lies in such a region
gives an empty text, unless only a class, an id or a form says so and the region wraps the article or most
of the text; rows that repeat are read on their own; an empty table gives no rows; other columns
pass through. A page is handled whole by one task and nothing of it is cut.
"""

from __future__ import annotations

import html as entities
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
from pyspark.sql import DataFrame, functions as F

#: Lines in a window, and the sum with which a surge begins (at most this share of the page's peak).
WINDOW = 3
SURGE, SURGE_SHARE = 60, 0.2
#: Of the richest stretch, outside a marked article and outside the container around it.
STRETCH_SHARE = 0.3

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>|"
    r"<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<rest>(?>(?:[^>\"']|\"[^\"]*\"|'[^']*')*)(?=>)|[^>]*)>",
    re.S,
)
_ARTICLE_END = re.compile(r"</(?:article|main|body)\s*>", re.I)
_ATTRIBUTE = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
#: Elements without text of the article, from the start tag to the end tag. Only the first kind, in which markup
#: is no markup, runs to the end of the page where the end tag is missing; other start tags are then passed over.
_RAW = {"script", "style", "textarea", "iframe", "title"}
_SILENT = {"noscript", "template", "svg", "select", "object", "canvas", "annotation", "head"}
_VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
_CONTAINER = {
    "article", "aside", "body", "center", "details", "dialog", "div", "fieldset", "figure", "footer", "form", "header",
    "html", "main", "menu", "nav", "section", "table",
}
_BLOCK = _CONTAINER | {
    "address", "blockquote", "caption", "dd", "dl", "dt", "figcaption", "h1", "h2", "h3", "h4", "h5", "h6", "hr", "li",
    "ol", "p", "pre", "summary", "tbody", "td", "tfoot", "th", "thead", "tr", "ul",
}
_ASIDE_TAGS = {"nav", "header", "footer", "aside", "form", "button", "dialog", "menu"}
_ASIDE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "alert", "alertdialog", "dialog", "menu", "menubar"}
_ASIDE_WORDS = {
    "ad", "ads", "advert", "adverts", "advertisement", "advertising", "adsense", "sponsor", "sponsored", "promo",
    "promotion", "banner", "nav", "navbar", "navigation", "menu", "menubar", "breadcrumb", "breadcrumbs", "sidebar",
    "aside", "widget", "widgets", "footer", "header", "masthead", "topbar", "comment", "comments", "disqus",
    "discussion", "reply", "replies", "respond", "cookie", "cookies", "consent", "gdpr", "notice", "notices", "alert",
    "popup", "modal", "overlay", "newsletter", "subscribe", "subscription", "signup", "login", "share", "sharing",
    "social", "related", "recommended", "recommendations", "pagination", "pager", "toolbar", "search", "copyright",
    "skip",
}
#: Words that with the above make up whole names of such regions ("share-buttons", "related-posts").
_PLAIN_WORDS = {
    "area", "bar", "block", "bottom", "box", "button", "buttons", "container", "form", "icon", "icons", "inner", "item", "items",
    "label", "left", "link", "links", "list", "media", "outer", "panel", "posts", "right", "section", "slot", "stories", "thread",
    "tools", "top", "unit", "wrap", "wrapper",
}
#: Words that are headings of ordinary articles, too.
_TOPIC_WORDS = {
    "alert", "advertising", "consent", "copyright", "discussion", "footer", "header", "notice", "notices", "promotion", "related",
    "search", "share", "social", "subscription",
}
_TEXT_TAGS = {"p", "h1", "h2", "h3", "h4", "h5", "h6", "blockquote", "pre", "q", "em", "strong", "b", "i", "code", "td", "th", "dt", "dd"}
_COMMENT_WORDS = {"comment", "comments", "reply", "replies"}
_COMMENT_REGIONS = _COMMENT_WORDS | {"disqus", "discussion", "respond"}
#: Kinds of asides: a supposed one may turn out to wrap the article.
FIRM, SUPPOSED = 1, 2
_ARTICLE_WORDS = {"article", "post", "entry", "content", "story", "main", "body", "text"}


@dataclass
class Line:
    text: str
    weight: int
    article: int
    box: int = 0


def _attributes(rest: str) -> dict[str, str]:
    return {m[1].lower(): entities.unescape(m[2] or m[3] or m[4] or "") for m in _ATTRIBUTE.finditer(rest)}


def _is_aside(tag: str, rest: str, in_article: bool) -> int:
    """Whether an element is a region that is no part of an article's text: 0, or the kind of aside.

    A form, and what only its class or id tells, are ``SUPPOSED``, but not regions of comments.
    """
    if tag in _ASIDE_TAGS and tag != "form" and not (tag == "header" and in_article):
        return FIRM
    if "=" not in rest and "hidden" not in rest:
        return SUPPOSED if tag == "form" else 0
    found = _attributes(rest)
    if "hidden" in found or found.get("aria-hidden") == "true":
        return FIRM
    if re.search(r"display\s*:\s*none|visibility\s*:\s*hidden", found.get("style", "")):
        return FIRM
    if found.get("role", "").lower() in _ASIDE_ROLES:
        return FIRM
    outermost = tag in ("html", "body", "article", "main") and not in_article
    words = re.sub(r"([a-z])([A-Z])", r"\1 \2", f"{found.get('class', '')} {found.get('id', '')}").lower()
    words = [re.findall(r"[a-z]+", name) for name in words.split()]
    # A name that also says article ("post-header", "entry-content") counts only outside headings.
    if outermost:
        return FIRM if any(_COMMENT_WORDS.intersection(name) for name in words) and tag == "article" else 0
    kind = SUPPOSED if tag == "form" else 0
    if in_article:
        return max(kind, _named_aside(tag, words))
    for name in words:
        if _ASIDE_WORDS.intersection(name):
            if _ARTICLE_WORDS.intersection(name) and name[-1] in ("header", "body", "content", "text") and "comment" not in name:
                continue
            if _COMMENT_REGIONS.intersection(name):
                return FIRM
            kind = SUPPOSED
    return kind


def _named_aside(tag: str, names: list[list[str]]) -> int:
    """Whether names say that an element inside an article is none of it.

    One word of a name is no evidence there: ids are made of headings. A heading or paragraph is the
    article's own whatever its name; of other elements all words of one name must speak of such regions,
    and on a section not of a topic alone.
    """
    if tag in _TEXT_TAGS:
        return 0
    kind = 0
    for name in names:
        told = _ASIDE_WORDS.intersection(name)
        if not told or not told | _PLAIN_WORDS >= set(name) or "discussion" in name and len(name) == 1:
            continue
        if tag == "section" and told <= _TOPIC_WORDS and len(name) == 1:
            continue
        if _COMMENT_REGIONS.intersection(name):
            return FIRM
        kind = SUPPOSED
    return kind


@dataclass
class Boxes:
    """Containers by number, in the order they open; 0 is the page. ``last`` is the last one within each."""

    outer: list[int]
    last: list[int]

    def around(self, own: list[int]) -> int:
        """The innermost container that holds all of these."""
        low, high = min(own), max(own)
        while not low <= high <= self.last[low]:
            low = self.outer[low]
        return low


def lines_of(page: str) -> tuple[list[Line], Boxes]:
    """The page's lines in order. ``article`` numbers the marked article a line lies in, 0 for none.

    ``box`` numbers the innermost container around a line.

    A supposed aside that holds more of the text of articles than lies outside, or on a page without
    any outside most of all text beside links, is no aside but a wrapper; the page is then read again.
    """
    lines, boxes, wrappers = _read(page, frozenset())
    return _read(page, wrappers)[:2] if wrappers else (lines, boxes)


def _read(page: str, wrappers: frozenset[int]) -> tuple[list[Line], Boxes, frozenset[int]]:
    """Lines, and which supposed asides are wrappers; ``wrappers`` (numbers of start tags) are no asides."""
    lines: list[Line] = []
    stack: list[tuple[str, int, bool, int, tuple[int, int, int]]] = []  # tag, aside, article, box outside, totals at the start
    parts: list[str] = []
    linked = asides = links = articles = number = starts = 0
    firm = total = told = 0  # firm asides on the stack; weight outside them, and of it in articles
    supposed: list[tuple[int, int, int]] = []  # start tag, weight, weight in its articles or -1 if inside one
    opened: Counter[str] = Counter()  # names on the stack
    boxes, box = Boxes([0], [0]), 0
    endless: set[str] = set()  # names without a further end tag

    def flush() -> None:
        nonlocal linked, total, told
        text = " ".join("".join(parts).split())
        weight = max(0, len(text) - linked)
        if not firm:
            total += weight
            told += weight if opened["article"] or opened["main"] else 0
        if text and not asides:
            lines.append(Line(text, weight, number if articles else 0, box))
        parts.clear()
        linked = 0

    def close(depth: int) -> None:
        """Close all open elements from this one on."""
        nonlocal asides, links, articles, firm, box
        for tag, aside, article, outer, at in reversed(stack[depth:]):
            opened[tag] -= 1
            asides -= aside > 0
            firm -= aside == FIRM
            if aside == SUPPOSED:
                supposed.append((at[0], total - at[1], told - at[2] if at[2] >= 0 else -1))
            articles -= article
            links -= tag == "a"
            if outer != box:
                boxes.last[box] = len(boxes.last) - 1
                box = outer
        del stack[depth:]

    def add(raw: str) -> None:
        nonlocal linked
        if raw:
            text = entities.unescape(raw)
            parts.append(text)
            if links:
                linked += len(text.strip())

    # No tag ends after the last ">", so the search stops there.
    at, last = 0, page.rfind(">") + 1
    while found := _TOKEN.search(page, at, last):
        add(page[at : found.start()])
        at = found.end()
        if found["tag"] is None:
            if found[0].startswith("<![CDATA["):
                parts.append(found[0][9:-3])
            elif found[0].startswith("<!--") and not found[0].endswith("-->"):
                at = len(page)
            continue
        tag = found["tag"].lower()
        if found["close"]:
            if tag in _BLOCK:
                flush()
            if opened[tag]:
                depth = next(i for i in reversed(range(len(stack))) if stack[i][0] == tag)
                inside = asides
                close(depth)
                if tag in _CONTAINER and not inside:
                    lines.append(Line("", 0, number if articles else 0))
            continue
        if (tag in _RAW or tag in _SILENT) and not found["rest"].endswith("/"):
            body = r"(?=<body[\s>])|" if tag == "head" else ""
            end = None if tag in endless else re.compile(rf"{body}</{tag}\s*>", re.I).search(page, at)
            if not end:
                endless.add(tag)
                at = len(page) if tag in _RAW else at
            elif tag in _RAW or tag == "head" or not _ARTICLE_END.search(page, at, end.start()):
                at = end.end()
            parts.append(" ")
            continue
        if tag == "br":
            parts.append(" ")
            continue
        if tag in _BLOCK:
            flush()
            if tag == "p" or tag in _CONTAINER or tag in ("h1", "h2", "h3", "h4", "h5", "h6"):
                near = (i for i in reversed(range(len(stack))) if stack[i][0] == "p" or stack[i][0] in _CONTAINER)
                depth = next(near, None) if opened["p"] else None
                if depth is not None and stack[depth][0] == "p":
                    close(depth)
        if tag in _CONTAINER and not asides:
            lines.append(Line("", 0, number if articles else 0))
        if tag in _VOID or found["rest"].endswith("/"):
            continue
        opens = tag in ("article", "main") and not articles
        if opens:
            # An article does not lie in a menu or a header: those were left open.
            while stack and any(e[1] and e[0] in ("nav", "header", "footer", "form", "menu", "button") for e in stack):
                close(next(i for i, e in enumerate(stack) if e[1] and e[0] in ("nav", "header", "footer", "form", "menu", "button")))
        starts += 1
        aside = 0 if starts in wrappers else _is_aside(tag, found["rest"], bool(articles))
        article = opens and not aside and not asides
        inside = opened["article"] + opened["main"]
        stack.append((tag, aside, article, box, (starts, total, -1 if inside else told)))
        if tag in _CONTAINER and tag not in ("html", "body"):
            boxes.outer.append(box)
            boxes.last.append(0)
            box = len(boxes.last) - 1
        opened[tag] += 1
        asides += aside > 0
        firm += aside == FIRM
        links += tag == "a"
        articles += article
        number += article
    add(page[at:].split("<!--", 1)[0])
    flush()
    close(0)
    boxes.last[0] = len(boxes.last) - 1
    outside = sum(line.weight for line in lines if line.article)
    return lines, boxes, frozenset(
        start for start, weight, own in supposed if own > outside or 2 * weight > total and (own < 0 or not outside)
    )


def window_sums(weights: list[int], size: int = WINDOW) -> list[int]:
    """Sum of each line's weight and those of the lines that follow it in its window."""
    total, sums = 0, [0] * len(weights)
    for i in reversed(range(len(weights))):
        total += weights[i] - (weights[i + size] if i + size < len(weights) else 0)
        sums[i] = total
    return sums


def stretches(weights: list[int], size: int = WINDOW, least: int | None = None) -> list[tuple[int, int]]:
    """Ranges of lines between a surge and the dive after it; ``least`` is the sum that is a surge."""
    sums, found, start = window_sums(weights, size), [], None
    level = min(SURGE, SURGE_SHARE * max(sums, default=0)) if least is None else least
    surged = False
    for i, total in enumerate(sums):
        if total == 0:
            if surged:
                found.append((start, i))
            start, surged = None, False
            continue
        start = i if start is None else start
        surged |= total >= level
    if surged:
        found.append((start, len(sums)))
    return found


def main_text(page: str | None) -> str:
    """The article of a page: its blocks in order, joined by two line ends."""
    lines, boxes = lines_of(page) if page else ([], Boxes([0], [0]))
    told = {line.article for line in lines if line.article and line.weight}
    if told:
        return "\n\n".join(line.text for line in lines if line.text and line.article in told)
    weights = [line.weight for line in lines]
    found = stretches(weights)
    if not found:
        return ""
    mass = [sum(weights[a:b]) for a, b in found]
    best = mass.index(max(mass))
    # What lies beside the richest stretch's own container belongs to it, on the bare page if it surges.
    around = boxes.outer[boxes.around([line.box for line in lines[slice(*found[best])] if line.text])]
    within = [around <= line.box <= boxes.last[around] for line in lines]
    kept = [False] * len(lines)
    for (a, b), m in zip(found, mass):
        share = m >= STRETCH_SHARE * mass[best]
        for i in range(a, b):
            kept[i] = share or within[i]
    if around:
        for a, b in stretches(weights, least=1):
            for i in range(a, b):
                kept[i] |= within[i]
    return "\n\n".join(line.text for line, keep in zip(lines, kept) if keep and line.text)


def with_main_text(pages: DataFrame, column: str = "text") -> DataFrame:
    """Add the main text of ``html`` to every row."""

    def extract(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        for texts in batches:
            yield texts.map(main_text)

    return pages.withColumn(column, F.pandas_udf(extract, "string")(F.coalesce("html", F.lit(""))))
