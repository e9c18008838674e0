"""Operator 5: main text of web pages from flat text blocks and a decision tree.

A page is cut into a flat list of text blocks, as block elements begin and end. Each
block has its words, its link density (share of its words inside links), those of the
blocks before and after it, and how it lies: the sort of element it stands in, whether a
class or id on the way there names side matter, and whether it lies outside the page's
main element, or outside its articles if those hold most of the words that are in no
menu, form or side matter. A decision tree, grown here from a small table of labelled
blocks, each in every place (``EXAMPLES``), says which blocks are main text. Where the
elements do not tell, words and links of the block and of its neighbours decide: a label
among links is a menu's, a link between paragraphs the text's.

Script, style and other elements without readable text, hidden ones (inline ones too),
comments and markup are never part of a block. Inline markup does not part words.
Character references are decoded once; white space inside a block becomes one blank;
kept blocks are joined by a blank.

Nothing is shuffled; a task holds one page at a time and time grows with its length.
Defined cases: null or empty html has no text (empty, 0 characters); text outside any
block element is a block; unclosed elements end with their parent, and the page; an
unclosed head ends at the first text or start tag that cannot stand in it; an svg or math
element, or one inside these, that ends in ``/>`` holds nothing (elsewhere the slash means
nothing, as in browsers); a hidden inline element that is not closed ends with its block;
a repeated page is a row of its own; all columns of the input are kept, and ``text``,
``n_chars`` and ``blocks`` replace columns of those names, whatever their case.
"""

from __future__ import annotations

import html as references
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql.types import ArrayType, BooleanType, LongType, StringType, StructField, StructType

# Elements by what they mean for the text.
SILENT = {
    "script", "style", "template", "noscript", "svg", "math", "canvas", "object", "iframe", "textarea",
    "select", "option", "head", "title", "audio", "video", "map", "noembed", "noframes", "xmp", "datalist",
}
RAW = {"script", "style", "textarea", "title", "iframe", "noscript", "noembed", "noframes", "xmp"}
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
HEAD = {"base", "basefont", "bgsound", "head", "html", "link", "meta", "noframes", "noscript", "script", "style", "template", "title"}
FOREIGN = {"svg", "math"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i",
    "ins", "kbd", "label", "mark", "nobr", "q", "rb", "rp", "rt", "ruby", "s", "samp", "small", "span", "strike",
    "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img",
}
# The sort of the nearest telling element around a block.
PLAIN, ARTICLE, SIDE, CHROME, FORM = range(5)
SORTS = {
    "article": ARTICLE, "main": ARTICLE, "aside": SIDE, "nav": CHROME, "footer": CHROME, "header": CHROME,
    "menu": CHROME, "form": FORM, "button": FORM, "fieldset": FORM, "dialog": FORM,
}
SIDE_NAMES = (
    "ad ads adv advert advertisement advertising advertorial banner sponsor sponsored promo promoted promotion "
    "comment comments disqus reply replies respond discussion sidebar widget aside rail menu menubar nav navbar "
    "navigation breadcrumb breadcrumbs pagination pager toolbar header masthead topbar footer foot copyright "
    "cookie cookies consent gdpr notice notices alert popup modal overlay newsletter subscribe subscription "
    "signup login register form search share sharing social related recommended recommendations "
    "trending popular skip legal disclaimer responses feedback toast paywall teaser teasers sponsors adverts "
    "advertisements adbox adslot adsense topnav sidenav subnav sitenav commentlist"
).split()
MAIN_NAMES = "article main content post entry story body".split()
FRAMES = "wrap wrapper container layout grid row columns page".split()
SIDE_ROLES = "navigation banner contentinfo complementary search form alert dialog menu menubar toolbar".split()

# Fixed values. Labelled blocks that no element tells of: words, link density, words and link density of the block before
# and of the block after, and whether it is main text.
BLOCKS = [
    # Paragraphs, headings and short lines of a text.
    (60, 0.0, 50, 0.0, 70, 0.0, 1), (30, 0.1, 5, 0.0, 40, 0.0, 1), (25, 0.0, 60, 0.0, 0, 0.0, 1), (18, 0.0, 30, 0.0, 1, 1.0, 1),
    (80, 0.2, 1, 1.0, 1, 1.0, 1), (6, 0.0, 2, 0.0, 50, 0.0, 1), (4, 0.0, 60, 0.0, 60, 0.0, 1), (12, 0.0, 0, 0.0, 0, 0.0, 1),
    (2, 0.0, 0, 0.0, 30, 0.0, 1), (9, 0.0, 0, 0.0, 2, 0.0, 1), (1, 0.0, 0, 0.0, 0, 0.0, 1), (3, 0.0, 1, 0.0, 1, 0.0, 1),
    (5, 0.0, 3, 0.0, 4, 0.0, 1), (1, 0.0, 1, 1.0, 3, 0.0, 1), (3, 0.0, 2, 1.0, 40, 0.0, 1), (6, 0.0, 1, 1.0, 12, 0.0, 1),
    (30, 0.0, 2, 1.0, 2, 1.0, 1), (14, 0.0, 3, 1.0, 4, 1.0, 1), (4, 0.0, 60, 0.0, 2, 1.0, 1), (3, 0.0, 5, 0.0, 1, 1.0, 1),
    (50, 0.4, 30, 0.0, 60, 0.0, 1), (6, 0.5, 40, 0.0, 40, 0.0, 1), (25, 0.0, 1, 1.0, 0, 0.0, 1), (2, 0.0, 2, 1.0, 2, 0.0, 1),
    # A link between paragraphs.
    (3, 1.0, 30, 0.0, 25, 0.0, 1), (5, 1.0, 60, 0.0, 40, 0.1, 1), (8, 0.9, 20, 0.0, 70, 0.0, 1), (2, 1.0, 15, 0.0, 18, 0.0, 1),
    (6, 1.0, 45, 0.2, 12, 0.0, 1), (4, 1.0, 80, 0.0, 60, 0.0, 1),
    # Menus: links after links, and labels among them.
    (1, 1.0, 1, 1.0, 1, 1.0, 0), (3, 1.0, 0, 0.0, 2, 1.0, 0), (9, 0.9, 3, 0.0, 60, 0.0, 0), (20, 0.8, 10, 0.7, 10, 0.7, 0),
    (40, 0.7, 10, 0.7, 10, 0.0, 0), (2, 0.6, 1, 1.0, 1, 1.0, 0), (3, 1.0, 2, 1.0, 40, 0.0, 0), (2, 1.0, 50, 0.0, 2, 1.0, 0),
    (1, 1.0, 1, 0.0, 1, 1.0, 0), (10, 1.0, 10, 1.0, 10, 1.0, 0), (2, 1.0, 0, 0.0, 0, 0.0, 0), (2, 1.0, 3, 1.0, 0, 0.0, 0),
    (2, 0.0, 2, 1.0, 2, 1.0, 0), (1, 0.0, 1, 1.0, 3, 1.0, 0), (4, 0.0, 3, 1.0, 2, 1.0, 0), (6, 0.2, 4, 1.0, 2, 1.0, 0),
    (3, 0.0, 2, 1.0, 5, 1.0, 0),
]
# Fixed values. How a block may lie: sort of element, inside an article, side name, outside the page's articles, and whether
# it is main text whatever its words (None: as its words and neighbours say).
PLACES = [
    (PLAIN, 0, 0, 0, None), (ARTICLE, 1, 0, 0, 1), (ARTICLE, 1, 1, 0, 0), (PLAIN, 0, 0, 1, 0), (PLAIN, 0, 1, 0, 0), (PLAIN, 0, 1, 1, 0),
    (CHROME, 0, 0, 0, 0), (CHROME, 1, 0, 0, 0), (CHROME, 0, 1, 0, 0), (CHROME, 0, 0, 1, 0),
    (SIDE, 0, 0, 0, 0), (SIDE, 1, 0, 0, 0), (SIDE, 0, 1, 0, 0), (SIDE, 0, 0, 1, 0),
    (FORM, 0, 0, 0, 0), (FORM, 1, 0, 0, 0), (FORM, 0, 1, 0, 0), (FORM, 0, 0, 1, 0),
]
#: Every block in every place.
EXAMPLES = [
    (sort, article, side, *block[:6], outside, block[6] if main is None else main)
    for sort, article, side, outside, main in PLACES
    for block in BLOCKS
]
TITLES = ("sort", "in_article", "side_name", "words", "links", "words_before", "links_before", "words_after", "links_after", "outside")

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)(?:((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)|([^>]*))>", re.S)
_NAMES = re.compile(r"(?:^|\s)(class|id|role|style|hidden|aria-hidden)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?", re.I)
_PARTS = re.compile(r"[a-z]+")
_VALUE = re.compile(r"=\s*[^\s\"'>]*/\Z")  # a slash that ends a value without quotes


class Block(NamedTuple):
    text: str
    sort: int
    in_article: int  # 2: in the page's main element
    side_name: int
    words: int
    links: float


class Node(NamedTuple):
    """A leaf (``feature`` -1) with its label, or a question: is the feature at most ``cut``?"""

    feature: int
    cut: float
    label: bool
    low: Node | None = None
    high: Node | None = None


def grow(rows: np.ndarray, labels: np.ndarray, depth: int = 12) -> Node:
    """A tree of least Gini impurity; of equal cuts the first feature and the least value."""
    label = bool(labels.mean() >= 0.5)
    if depth == 0 or labels.min() == labels.max():
        return Node(-1, 0.0, label)
    best = None
    for feature in range(rows.shape[1]):
        values = np.unique(rows[:, feature])
        for cut in (values[:-1] + values[1:]) / 2:
            low = rows[:, feature] <= cut
            cost = sum(side.mean() * labels[side].var() for side in (low, ~low))
            if best is None or cost < best[0] - 1e-12:
                best = (cost, feature, cut, low)
    if best is None:
        return Node(-1, 0.0, label)
    _, feature, cut, low = best
    return Node(
        feature, float(cut), label, grow(rows[low], labels[low], depth - 1), grow(rows[~low], labels[~low], depth - 1)
    )


@lru_cache(1)
def tree() -> Node:
    table = np.array(EXAMPLES, float)
    return grow(_features(table[:, :-1]), table[:, -1])


def _features(rows: np.ndarray) -> np.ndarray:
    """The sort of element as one yes or no for each sort but plain, then the rest."""
    sorts = [(rows[:, 0] == k).astype(float) for k in (CHROME, SIDE, FORM)]
    return np.column_stack([*sorts, rows[:, 1:]])


def _hints(attributes: str) -> tuple[bool, bool]:
    """Whether a class, id or role names side matter, and whether the element is hidden.

    One part that names side matter is enough in a name of several (promo-story,
    post-comments), unless the name is that of a frame (content-sidebar-wrap) or says what
    the page has (has-sidebar).
    """
    side = main = hidden = False
    for name, a, b, c in _NAMES.findall(attributes):
        name, value = name.lower(), (a or b or c).lower()
        if name == "hidden" or name == "aria-hidden" and value == "true":
            hidden = True
        elif name == "style":
            hidden |= "display:none" in value.replace(" ", "")
        elif name == "role":
            side |= value in _ROLES
        elif name in ("class", "id"):
            for token in value.split():
                parts = _PARTS.findall(token)
                if not parts or parts[0] in ("has", "with", "no"):
                    continue
                of_main, of_side = not _MAIN.isdisjoint(parts), not _SIDE.isdisjoint(parts)
                side |= of_side and not (of_main and not _FRAMES.isdisjoint(parts))
                main |= of_main and not of_side
    return side and not main, hidden


_SIDE, _MAIN, _ROLES, _FRAMES = map(frozenset, (SIDE_NAMES, MAIN_NAMES, SIDE_ROLES, FRAMES))


def blocks(page: str) -> list[Block]:
    """The text blocks of a page in order."""
    out: list[Block] = []
    parts: list[str] = []
    linked: list[str] = []
    # Of each open element: name, sort, in an article, side name, silent.
    stack: list[tuple[str, int, int, int, bool]] = [("", PLAIN, 0, 0, False)]
    opened: Counter[str] = Counter()
    in_link = 0

    def close() -> None:
        if parts:
            text = " ".join("".join(parts).split())
            if text:
                words = text.count(" ") + 1
                inside = len("".join(linked).split())
                _, sort, article, side, _ = stack[-1]
                out.append(Block(text, sort, article, side, words, min(inside / words, 1.0)))
            parts.clear()
            linked.clear()

    def leave_head() -> None:
        if stack[-1][0] == "head":
            opened[stack.pop()[0]] -= 1

    def read(text: str) -> None:
        if stack[-1][0] == "head" and not text.isspace() and text:
            leave_head()
        if text and not stack[-1][4]:
            text = references.unescape(text) if "&" in text else text
            parts.append(text)
            if in_link:
                linked.append(text)

    at = 0
    while True:
        found = _TAG.search(page, at)
        if found is None:
            read(page[at:])
            break
        read(page[at : found.start()])
        at = found.end()
        name = (found[2] or "").lower()
        if not name:
            if found[0].startswith("<![CDATA["):
                read(found[0][9:].removesuffix("]]>"))
            continue
        if found[1]:
            if name in INLINE:
                if name == "a":
                    in_link = max(in_link - 1, 0)
                    linked.append(" ")
                if opened[name]:  # of inline elements only hidden ones and those in them are kept open
                    while stack[-1][0] in INLINE:
                        last = stack.pop()[0]
                        opened[last] -= 1
                        if last == name:
                            break
                continue
            close()
            if opened[name]:
                in_link = 0
                while True:
                    last = stack.pop()[0]
                    opened[last] -= 1
                    if last == name:
                        break
            continue
        if name not in HEAD:
            leave_head()
        told = found[3] or found[4] or ""
        if name in INLINE:
            in_link += name == "a"
            if name not in VOID and (stack[-1][0] in INLINE or len(told) > 3 and _hints(told)[1]):
                stack.append((name, *stack[-1][1:4], True))
                opened[name] += 1
            continue
        close()
        if told.endswith("/") and (name in FOREIGN or opened["svg"] or opened["math"]) and not _VALUE.search(told):
            continue
        if name in VOID:
            continue
        if name in ("p", "li", "td", "th", "tr", "dt", "dd", "option") and stack[-1][0] == name:
            opened[stack.pop()[0]] -= 1
            in_link = 0
        own = SORTS.get(name)
        _, sort, article, side, silent = stack[-1]
        hint, hidden = _hints(told) if len(told) > 3 and name not in ("html", "body") else (False, False)
        if own == CHROME and name == "header" and article:
            own = None  # an article's own header holds its title
        stack.append(
            (
                name,
                own if own is not None and (own != ARTICLE or sort == PLAIN) else sort,
                2 if name == "main" or article == 2 else int(article or own == ARTICLE),
                int(side or hint),
                silent or hidden or name in SILENT,
            )
        )
        opened[name] += 1
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}\s*>|\Z", re.I).search(page, at)
            at = end.end()
            opened[stack.pop()[0]] -= 1
    close()
    return out


def chosen(found: list[Block]) -> list[bool]:
    """Which blocks are main text."""
    root, out = tree(), []
    plain = [b for b in found if b.sort in (PLAIN, ARTICLE) and not b.side_name]
    inside = sum(b.words for b in plain if b.sort == ARTICLE)
    has_main = any(b.in_article == 2 and b.sort == ARTICLE for b in plain)
    has_article = has_main or inside > 0 and 2 * inside >= sum(b.words for b in plain)
    for k, b in enumerate(found):
        before = found[k - 1] if k else None
        after = found[k + 1] if k + 1 < len(found) else None
        row = (
            b.sort == CHROME, b.sort == SIDE, b.sort == FORM, min(b.in_article, 1), b.side_name, b.words, b.links,
            before.words if before else 0, before.links if before else 0.0,
            after.words if after else 0, after.links if after else 0.0, has_article and not b.in_article,
        )
        node = root
        while node.feature >= 0:
            node = node.low if row[node.feature] <= node.cut else node.high
        out.append(node.label)
    return out


def main_text(page: str | None) -> tuple[str, list[str], list[bool]]:
    """Main text, all blocks, and which of them are in it."""
    found = blocks(page or "")
    keep = chosen(found)
    return " ".join(b.text for b, k in zip(found, keep) if k), [b.text for b in found], keep


def extract(pages: DataFrame, html: str = "html") -> DataFrame:
    """``pages`` with text, n_chars (code points) and blocks (text, main) of the whole html."""
    made = ("text", "n_chars", "blocks")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block = pa.struct([("text", pa.string()), ("main", pa.bool_())])
        for batch in batches:
            for first in range(0, batch.num_rows, 64):
                some = batch.slice(first, 64)
                rows = [main_text(page.as_py()) for page in some.column(some.num_columns - 1)]
                columns = [
                    pa.array([r[0] for r in rows], pa.string()),
                    pa.array([len(r[0]) for r in rows], pa.int64()),
                    pa.array([[{"text": t, "main": k} for t, k in zip(r[1], r[2])] for r in rows], pa.list_(block)),
                ]
                yield pa.RecordBatch.from_arrays([*some.columns[:-1], *columns], names=[*some.schema.names[:-1], *made])

    kept = pages.select(*(f"`{c}`" for c in pages.columns if c.lower() not in made))
    block = StructType([StructField("text", StringType()), StructField("main", BooleanType())])
    kinds = (StringType(), LongType(), ArrayType(block))
    fields = [*kept.schema.fields, *(StructField(n, k) for n, k in zip(made, kinds))]
    return pages.select(*(pages[c] for c in kept.columns), pages[html].cast("string").alias("_page")).mapInArrow(
        run, StructType(fields)
    )
