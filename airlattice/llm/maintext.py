"""Main text of web pages by minimum-cut labelling.

A page becomes a row of text blocks. A block classifier gives each block a cost of being content and a cost
of being boilerplate: its capacities to the two terminals. Neighbours in page order, and blocks of one
container, are tied by smoothness edges. The minimum cut (maximum flow) is the cheapest labelling.
"""

from __future__ import annotations

import html
import re
from collections import deque
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from airlattice.llm.common import col, fresh

#: Element names of HTML by the part they play here. Fixed values.
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
HIDDEN = frozenset("head template svg math canvas object audio video select datalist button".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset(("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
                   "footer form h1 h2 h3 h4 h5 h6 header hgroup html legend li main menu nav ol p pre search section summary "
                   "table tbody td tfoot th thead tr ul").split())
HEADING = frozenset("h1 h2 h3 h4 h5 h6".split())
CHROME = frozenset("nav footer aside form menu dialog search".split())
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar".split())
#: Words of class and id attributes that name something other than the article. Fixed values.
CHROME_WORDS = frozenset(("ad ads advert adverts advertisement advertising banner breadcrumb breadcrumbs comment comments cookie "
                          "cookies consent copyright disclaimer disqus footer form gdpr header login masthead menu modal nav "
                          "navbar navigation newsletter notice notices notification pagination popup promo promotion related "
                          "reply replies respond share sharing sidebar signup social sponsor sponsored subscribe tags toolbar "
                          "widget").split())
#: Words beside them that leave their meaning; any other word makes it doubtful. Words that negate what follows. Fixed values.
BESIDE = frozenset(("area bar block bottom box btn button buttons container global icons inner item items left links list "
                    "outer right secondary section site top wrap wrapper").split())
NEGATES = frozenset("has no not with without".split())
#: Elements whose own class and id say nothing about their text.
UNNAMED = HEADING | {"html", "body", "main", "article"}
#: Cost of calling content what a class or id names as chrome: clearly, and beside other words. Content evidence and ties outweigh both.
NAMED, DOUBTFUL = 6.0, 0.5
TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([A-Za-z][^\s/>]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)[^>]*(?:>|\Z)", re.S)
MARKS = re.compile(r"\b(class|id|role|hidden|aria-hidden)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
WORDS_IN = re.compile(r"[A-Za-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
CLOSES_P = BLOCK - {"body", "html", "td", "th", "tr", "tbody", "thead", "tfoot"}

#: Edge weights: neighbours in page order, and neighbours within one container.
NEAR, KIN = 0.6, 1.6


class Block:
    __slots__ = ("box", "chrome", "heading", "inside", "linked", "mark", "named", "parts")

    def __init__(self, box: int, chrome: bool, inside: bool, heading: bool, mark: int = 0):
        self.parts: list[str] = []
        self.linked, self.mark, self.named = 0, mark, 0.0
        self.box, self.chrome, self.inside, self.heading = box, chrome, inside, heading


def _is_chrome(name: str, attrs: str, inside: bool) -> bool:
    if name in CHROME or name == "header" and not inside:
        return True
    if not attrs or "=" not in attrs and "hidden" not in attrs:
        return False
    for key, value in MARKS.findall(attrs):
        key, value = key.lower(), value.strip("\"'")
        if key == "role":
            if value.lower() in ROLES:
                return True
        elif key == "hidden":
            return True
        elif key == "aria-hidden":
            if value.lower() == "true":
                return True
    return False


def _named(attrs: str, inside: bool) -> float:
    """How much class and id speak for chrome. A header inside an article is that of the article."""
    most = 0.0
    for key, value in MARKS.findall(attrs) if "=" in attrs else ():
        if key.lower() not in ("class", "id"):
            continue
        for token in value.strip("\"'").split():
            parts = [w.lower() for w in WORDS_IN.findall(CAMEL.sub(" ", token))]
            parts = parts[:next((k for k, w in enumerate(parts) if w in NEGATES), len(parts))]
            if any(w in CHROME_WORDS and not (inside and w == "header") for w in parts):
                most = max(most, NAMED if all(w in CHROME_WORDS or w in BESIDE for w in parts) else DOUBTFUL)
    return most


class Mark:
    """An element whose class or id speaks for chrome, in the marked element ``up``. holds: 1 an article, 2 main."""

    __slots__ = ("cost", "holds", "up", "words")

    def __init__(self, up: int, cost: float):
        self.up, self.cost, self.holds, self.words = up, cost, 0, 0.0


def _settle(blocks: list[Block], marks: list[Mark]) -> None:
    """Gives each block the highest cost of its marks, without those of elements that hold what the page is about.

    Those hold main, or over half of the unlinked words (of articles, where there are some), or an article on a page
    whose articles are all marked.
    """
    if len(marks) == 1:
        return
    for base in ([b for b in blocks if b.inside and not b.chrome], [b for b in blocks if not b.chrome]):
        whole = 0.0
        for b in base:
            text = "".join(b.parts)
            n = len(text.split()) * (1 - min(1.0, b.linked / max(1, len(text))))
            marks[b.mark].words += n
            whole += n
        if whole:
            break
    for m in reversed(marks[1:]):
        marks[m.up].words += m.words
        marks[m.up].holds = max(marks[m.up].holds, m.holds)

    def spread() -> list[float]:
        most = [0.0] * len(marks)
        for k, m in enumerate(marks[1:], 1):
            most[k] = max(most[m.up], m.cost)
        return most

    for m in marks:
        if m.holds == 2 or m.words > whole / 2:
            m.cost = 0.0
    most = spread()
    if not any(b.inside and not b.chrome and most[b.mark] < NAMED for b in blocks):
        for m in marks:
            if m.holds:
                m.cost = 0.0
        most = spread()
    for b in blocks:
        b.named = most[b.mark]


def blocks_of(page: str) -> list[Block]:
    """Text blocks in page order. Open elements are a stack of (name, box, chrome, inside article, hidden, mark)."""
    out: list[Block] = []
    stack: list[tuple[str, int, bool, bool, bool, int]] = [("", 0, False, False, False, 0)]
    marks = [Mark(0, 0.0)]
    now: Block | None = None
    links, boxes, at, n = 0, 0, 0, len(page)

    def text(chunk: str) -> None:
        nonlocal now
        if not chunk or stack[-1][4]:
            return
        if "&" in chunk:
            chunk = html.unescape(chunk)
        if now is None:
            if chunk.isspace():
                return
            name, box, chrome, inside, _, mark = stack[-1]
            now = Block(box, chrome, inside, any(s[0] in HEADING for s in stack[-2:]), mark)
            out.append(now)
        now.parts.append(chunk)
        if links:
            now.linked += len(chunk)

    while at < n:
        m = TAG.search(page, at)
        if not m:
            text(page[at:])
            break
        text(page[at:m.start()])
        at = m.end()
        name = (m[2] or m[5] or "").lower()
        if not name:
            continue
        if m[1] or m[4]:
            if name == "a":
                links = max(0, links - 1)
            for k in range(len(stack) - 1, 0, -1):
                if stack[k][0] == name:
                    del stack[k:]
                    if name in BLOCK:
                        now, links = None, 0
                    break
            continue
        if name in RAW:
            close = re.compile(rf"</{name}\b", re.I).search(page, at)
            at = n if not close else close.start()
            continue
        if name == "br":
            text(" ")
        if name in VOID:
            continue
        if name == "a":
            links += 1
        if name in BLOCK:
            now, links = None, 0
            if name in CLOSES_P and stack[-1][0] == "p":
                stack.pop()
            elif name == stack[-1][0] and name in ("li", "dd", "dt", "td", "th", "tr", "option"):
                stack.pop()
        elif name not in HIDDEN:
            continue
        _, box, chrome, inside, hidden, mark = stack[-1]
        attrs = m[3] or ""
        cost = _named(attrs, inside or name in ("article", "main")) if attrs else 0.0
        opens = name == "main" or name == "article" and not (mark and cost >= NAMED)  # an article of class comment among comments is none
        inside = inside or opens
        chrome = chrome or _is_chrome(name, attrs, inside)
        if opens:
            marks[mark].holds = max(marks[mark].holds, 1 + (name == "main"))
        if cost and name not in UNNAMED:
            marks.append(Mark(mark, cost))
            mark = len(marks) - 1
        if name in BLOCK and name not in HEADING and name not in ("p", "li", "dt", "dd", "tr", "td", "th", "pre"):
            boxes += 1
            box = boxes
        stack.append((name, box, chrome, inside, hidden or name in HIDDEN, mark))
    _settle(out, marks)
    return out


def costs(block: Block, text: str) -> tuple[float, float]:
    """(cost of calling it boilerplate, cost of calling it content): evidence for, and against, content."""
    n = text.count(" ") + 1
    good, bad = min(n, 40) * 0.05, 0.4
    if block.inside:
        good += 3.0
    if text[-1] in ".!?…\"”»":
        good += 0.4
    if block.heading:
        good += 0.3
    if block.linked:
        bad += 4.0 * min(1.0, block.linked / max(1, len(text))) * (1.0 if n < 30 else 0.5)
    bad += 12.0 if block.chrome else block.named
    if text[0] in "©" or "©" in text[:40] and n < 20:
        bad += 2.0
    return good, bad


def minimum_cut(source: list[float], sink: list[float], edges: list[tuple[int, int, float]]) -> list[bool]:
    """Which nodes stay with the source. Shortest augmenting paths; edges carry their capacity both ways.

    Each node's two terminal edges first cancel to the surplus of one, which shifts every cut by the same amount.
    Of several minimum cuts the one with the fewest nodes at the source is taken.
    """
    n = len(source)
    surplus = [a - b for a, b in zip(source, sink)]
    if all(x > 0 for x in surplus):
        return [True] * n
    if not any(x > 0 for x in surplus):
        return [False] * n
    room: list[dict[int, float]] = [{} for _ in range(n)]
    for a, b, c in edges:
        room[a][b] = room[a].get(b, 0.0) + c
        room[b][a] = room[b].get(a, 0.0) + c
    give = [max(x, 0.0) for x in surplus]
    need = [max(-x, 0.0) for x in surplus]
    eps = 1e-9
    while True:
        came = {k: -1 for k in range(n) if give[k] > eps}
        queue, end = deque(came), -1
        while queue:
            a = queue.popleft()
            if need[a] > eps:
                end = a
                break
            for b, c in room[a].items():
                if c > eps and b not in came:
                    came[b] = a
                    queue.append(b)
        if end < 0:
            return [k in came for k in range(n)]
        flow, k = need[end], end
        while came[k] >= 0:
            flow, k = min(flow, room[came[k]][k]), came[k]
        flow = min(flow, give[k])
        give[k] -= flow
        need[end] -= flow
        k = end
        while came[k] >= 0:
            room[came[k]][k] -= flow
            room[k][came[k]] += flow
            k = came[k]


def main_text(page: str | None) -> str:
    """Content blocks in page order, joined by an empty line."""
    found = []
    for block in blocks_of(page or ""):
        text = " ".join("".join(block.parts).split())
        if text:
            found.append((block, text))
    if not found:
        return ""
    source, sink = zip(*(costs(b, t) for b, t in found))
    edges, last = [], {}
    for k, (block, _) in enumerate(found):
        if k:
            edges.append((k - 1, k, NEAR))
        if block.box in last:
            edges.append((last[block.box], k, KIN))
        last[block.box] = k
    keep = minimum_cut(list(source), list(sink), edges)
    return "\n\n".join(t for (_, t), kept in zip(found, keep) if kept)


@F.pandas_udf(T.StringType())
def main_text_of(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
    for pages in batches:
        yield pd.Series([main_text(p) for p in pages], dtype=object)


def extract_main_text(pages: DataFrame, page: str = "html", out: str = "main_text") -> DataFrame:
    """The frame with one more column, the main text; null or empty html gives an empty string.

    Every row gives one row, repeated ones too; ``out`` gets a number where the frame has such a column.
    """
    return pages.withColumn(fresh(pages, out)[0], F.coalesce(main_text_of(col(page)), F.lit("")))
