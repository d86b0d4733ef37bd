"""Main text of web pages by a minimum cut between content and boilerplate (operator 5).

A page is cut into blocks of text. Each block gets a score from its place in the page (elements around it,
their class, id and role) and its own form (length, links, end of sentence). The scores are the
capacities to the two terminals; blocks next to each other, and the next block of the same kind under
the same parent, are tied by smoothness edges that are stronger the more ancestors they share. The
maximum flow saturates the cheapest cut: blocks still reached from the content side are content.

A quote opens an attribute's value only behind `=`. Elements with text of another kind (scripts, drawings, choices) are left
out up to their end tag; without one, scripts and the like go to the end of the page, of others the tag alone is left out.

Null, empty and text-less pages give an empty text. Very long pages are handled whole; the flow
only looks near a block that still has something to give. Repeated rows get equal texts; an empty
table gives no rows; other columns are not looked at.
"""

from __future__ import annotations

import re
from collections import Counter, deque
from html import unescape

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tagloom.llm.common import exact, fresh

#: HTML elements, by what they do to the text in them.
RAW = frozenset("script style title textarea iframe noembed noframes noscript template svg object canvas audio video select".split())
#: Those that hold no elements, so that one without an end tag goes to the end of the page.
TO_END = frozenset("script style title textarea iframe noembed noframes".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCKS = frozenset(
    "html head body article section nav aside header footer main div p h1 h2 h3 h4 h5 h6 ul ol li dl dt dd table thead "
    "tbody tfoot tr td th caption blockquote pre form fieldset legend address figure figcaption details summary "
    "dialog menu button label option center hgroup search".split()
)
#: An open element that the start of another one ends, up to the nearest boundary.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select"}),
}
ENDS_P = BLOCKS - {"button", "label", "option", "legend", "summary", "caption", "td", "th", "tr"}

#: Evidence for content (above zero) or boilerplate of an element around a block.
TAG_SCORE = {
    "article": 3.0, "main": 2.5, "blockquote": 0.5, "pre": 0.5, "h1": 1.0, "h2": 0.3, "p": 0.6, "nav": -7.0, "footer": -7.0,
    "aside": -6.0, "header": -4.0, "form": -4.0, "menu": -7.0, "dialog": -6.0, "button": -6.0, "label": -3.0,
    "option": -7.0, "search": -6.0, "fieldset": -4.0, "legend": -3.0, "address": -1.5, "head": -9.0,
}
GOOD_NAMES = frozenset("article content post entry story body main text prose".split())
BAD_NAMES = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner nav navbar navigation menu "
    "sidebar footer header masthead comment comments commentlist reply replies disqus respond discussion cookie cookies "
    "consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription signup login share sharing social "
    "breadcrumb breadcrumbs related recommended widget toolbar pagination pager copyright legal search form skip "
    "complementary contentinfo navigation tags hidden".split()
)
BAD_NAME_SCORE, GOOD_NAME_SCORE, MOST_GOOD = -6.0, 1.5, 4.0
SCALE = 100

_TOKEN = re.compile(
    r"""<!--.*?(?:--!?>|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*(?:"[^"]*"|'[^']*'|[^\s"'>][^\s>]*)|[^>])*+)>"""
    r"""|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)|<[!?/][^>]*(?:>|\Z)""",
    re.S,
)
_NAMED = re.compile(r"""(?:^|\s)(class|id|role)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_COPYRIGHT = re.compile(r"©|\(c\)\s|copyright\b|all rights reserved", re.I)


class Element:
    """An open element: what it adds to the elements around it, so that a block need not list them."""

    __slots__ = ("name", "serial", "parent", "depth", "good", "bad")

    def __init__(self, name: str, serial: int, parent: Element | None, evidence: float):
        self.name, self.serial, self.parent = name, serial, parent
        self.depth = parent.depth + 1 if parent else 1
        self.good = (parent.good if parent else 0.0) + max(0.0, evidence)
        self.bad = (parent.bad if parent else 0.0) + min(0.0, evidence)


class Block:
    """A run of text without block borders in it, the element it stands in, and the number of elements around both it and the
    block before."""

    __slots__ = ("text", "element", "shared", "linked")

    def __init__(self, text: str, element: Element | None, shared: int, linked: int):
        self.text, self.element, self.shared, self.linked = text, element, shared, linked

    @property
    def depth(self) -> int:
        return self.element.depth if self.element else 0


def _evidence(name: str, attributes: str) -> float:
    score = TAG_SCORE.get(name, 0.0)
    if name in ("html", "body") or not attributes:
        return score
    names = set()
    for _, value in _NAMED.findall(attributes):
        for word in value.strip("\"'").lower().split():
            if not word.startswith(("has-", "with-", "no-", "is-")):
                names.update(re.split(r"[-_:]+", word))
    if names & BAD_NAMES:
        return min(score, 0.0) + BAD_NAME_SCORE
    return score + (GOOD_NAME_SCORE if names & GOOD_NAMES else 0.0)


def blocks_of(html: str) -> list[Block]:
    """The blocks of a page in order, in time that does not grow with the depth of its elements."""
    found: list[Block] = []
    stack: list[Element] = []
    is_open: Counter[str] = Counter()  # open elements by name
    endless: set[str] = set()  # names with no end tag in the rest of the page
    words: list[str] = []
    links, linked, serial, at, lowest = 0, 0, 0, 0, 0  # lowest: the least depth since the block before

    def flush() -> None:
        nonlocal linked, lowest
        text = " ".join(unescape("".join(words)).split())
        if text:
            found.append(Block(text, stack[-1] if stack else None, lowest, linked))
            lowest = len(stack)
        words.clear()
        linked = 0

    def close(depth: int) -> None:
        nonlocal lowest
        is_open.subtract(element.name for element in stack[depth:])
        del stack[depth:]
        lowest = min(lowest, depth)

    def pop_to(names: set, borders: set) -> None:
        if not any(is_open[name] for name in names):
            return
        for i in range(len(stack) - 1, -1, -1):
            if stack[i].name in names:
                close(i)
                return
            if stack[i].name in borders:
                return

    def add(text: str) -> None:
        nonlocal linked
        words.append(text)
        if links:
            linked += len(text)

    end = len(html)
    while at < end:
        token = _TOKEN.search(html, at)
        if not token:
            add(html[at:])
            break
        if token.start() > at:
            add(html[at : token.start()])
        at = token.end()
        name = token[2] or token[5]
        if not name:
            if token[0].startswith("<![CDATA["):
                add(token[0][9:].removesuffix("]]>"))
            continue
        name, closing, attributes = name.lower(), bool(token[1] or token[4]), token[3] or token[6] or ""
        if name in RAW:
            if not closing and not attributes.endswith("/"):
                ended = None if name in endless else re.compile(rf"</{name}\b[^>]*(?:>|\Z)", re.I).search(html, at)
                if ended:
                    at = ended.end()
                elif name in TO_END:
                    at = end
                else:
                    endless.add(name)
            words.append(" ")
        elif name == "a":
            links = 0 if closing else 1
        elif name == "br" or name == "hr":
            words.append(" ")
            if name == "hr":
                flush()
        elif name in BLOCKS:
            flush()
            links = 0
            if closing:
                if is_open[name]:
                    close(next(i for i in range(len(stack) - 1, -1, -1) if stack[i].name == name))
                continue
            if name in ENDS_P:
                pop_to({"p"}, BLOCKS - {"p"})
            if name in ENDS:
                pop_to(*ENDS[name])
            if not attributes.endswith("/"):
                serial += 1
                is_open[name] += 1
                stack.append(Element(name, serial, stack[-1] if stack else None, _evidence(name, attributes)))
    flush()
    return found


def score_of(block: Block) -> float:
    """Evidence that a block is content; below zero for boilerplate."""
    good, bad = (block.element.good, block.element.bad) if block.element else (0.0, 0.0)
    size = len(block.text)
    own = min(1.5, size / 120) - 0.6
    if block.text[-1] in ".!?…\"”»:;。":
        own += 0.6
    own -= 2.5 * min(1.0, block.linked / size)
    if size < 200 and _COPYRIGHT.search(block.text):
        own -= 2.0
    return min(good, MOST_GOOD) + bad + own


def _ties(blocks: list[Block]) -> list[tuple[int, int, int]]:
    """Smoothness edges: neighbours, and the next block of the same kind under the same parent."""
    ties, last_of = [], {}
    for i, block in enumerate(blocks):
        if i:
            near = block.shared / max(1, blocks[i - 1].depth, block.depth)
            ties.append((i - 1, i, int(SCALE * (0.1 + 0.9 * near))))
        own = block.element
        kind = (own.parent.serial if own and own.parent else 0, own.name if own else "")
        if kind in last_of and last_of[kind] < i - 1:
            ties.append((last_of[kind], i, SCALE // 2))
        last_of[kind] = i
    return ties


def content_side(scores: list[int], ties: list[tuple[int, int, int]]) -> list[bool]:
    """The blocks on the content side of a minimum cut.

    The flow from terminal to terminal through one block is taken off at once, so a block is left with
    what it can still give (above zero) or take. Then shortest paths with room are filled up.
    """
    left, room = list(scores), [{} for _ in scores]
    for a, b, capacity in ties:
        room[a][b] = room[a].get(b, 0) + capacity
        room[b][a] = room[b].get(a, 0) + capacity
    dead = [False] * len(left)  # no way to a block that can take, now or later
    for source in range(len(left)):
        while left[source] > 0 and not dead[source]:
            came, queue, sink = {source: source}, deque([source]), -1
            while queue and sink < 0:
                a = queue.popleft()
                for b, capacity in room[a].items():
                    if capacity > 0 and not dead[b] and b not in came:
                        came[b] = a
                        if left[b] < 0:
                            sink = b
                            break
                        queue.append(b)
            if sink < 0:
                for a in came:
                    dead[a] = True
                break
            path, b = [], sink
            while b != source:
                path.append((came[b], b))
                b = came[b]
            flow = min(left[source], -left[sink], *(room[a][b] for a, b in path))
            left[source] -= flow
            left[sink] += flow
            for a, b in path:
                room[a][b] -= flow
                room[b][a] += flow
    reached = [x > 0 for x in left]
    queue = deque(i for i, r in enumerate(reached) if r)
    while queue:
        a = queue.popleft()
        for b, capacity in room[a].items():
            if capacity > 0 and not reached[b]:
                reached[b] = True
                queue.append(b)
    return reached


def extract(html: str | None) -> str:
    """The main text of a page: blocks in order, two line ends between them."""
    blocks = blocks_of(html or "")
    kept = content_side([round(SCALE * score_of(b)) for b in blocks], _ties(blocks))
    return "\n\n".join(b.text for b, keep in zip(blocks, kept) if keep)


def main_text(html: Column) -> Column:
    """The main text of a page; empty if there is none."""

    def texts(pages: pd.Series) -> pd.Series:
        return pd.Series([extract(p) for p in pages], dtype=object)

    return F.pandas_udf(texts, "string")(html)


def with_main_text(pages: DataFrame, html_col: str = "html", out_col: str = "text") -> DataFrame:
    """`pages` with one more column, the main text."""
    (name,) = fresh(pages, out_col)
    return pages.withColumn(name, main_text(exact(html_col)))
