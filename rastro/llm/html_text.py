"""Main text of web pages by tag-path ratios.

A page is read as a row of text blocks, each with its path of tags from the root. For every
path the lengths and the punctuation of its blocks are added up; both ratios, per block of the
path, are smoothed along the page, fused, and the paths above the threshold are content. What
stands beside them in the same element (a title, a short line) belongs to the text too. Paths
through elements that are never content (menus, footers, forms, scripts …) have the ratio 0.
"""

from __future__ import annotations

import re
from collections import Counter
from html import unescape
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

RESULT = "text string, n_chars long"

# Element names of HTML by what they do to a path.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe template xmp noembed noframes svg math".split())
BLOCKS = set(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset "
    "figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li "
    "main menu nav ol optgroup option p pre search section select summary table tbody td tfoot th "
    "thead tr ul caption button".split()
)
NEVER = set(
    "head nav header footer aside form menu dialog button select option fieldset search script style "
    "title noscript iframe template textarea".split()
)
# An open element of the first column ends when one of the second begins.
ENDS = {
    "p": BLOCKS - {"button", "option", "optgroup"},
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "option": {"option", "optgroup"},
    "tr": {"tr", "tbody", "tfoot"},
    "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"},
    "head": {"body"},
}
# Within these an open element of that name stays open.
SCOPES = {"li": {"ul", "ol", "menu", "dir"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}}
# Words of class, id and role that mark an element as no content.
MARKS = set(
    "ad ads advert advertisement advertising banner sponsor sponsored promo promotion sidebar sidenav "
    "aside nav navbar navigation menu breadcrumb breadcrumbs header masthead footer foot notice notices "
    "cookie cookies consent gdpr alert popup modal overlay newsletter subscribe subscription signup "
    "login comment comments commentlist respond reply replies disqus discussion share sharing social "
    "related recommended recommendations pagination pager toolbar widget skip complementary "
    "contentinfo search hidden".split()
)

# Names that begin so tell what stands beside an element, not what it is.
LAYOUT = {"has", "no", "with", "without"}
# The header of one of these has its title.
TITLED = set("article post entry story content".split())
# A mark does not count on an element with this share of the page's text or more.
MOST = 0.8

_TAG = re.compile(
    r"<(?:(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*\"|'[^']*'|[\"'])*+)(?:>|\Z)"
    r"|!--.*?(?:-->|\Z)|[!?][^>]*(?:>|\Z))",
    re.S,
)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""")
_NO_DISPLAY = re.compile(r"display\s*:\s*none", re.I)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
PUNCTUATION = ".,;:!?。，、؟…"


class Block(NamedTuple):
    #: Its path by number, and the innermost open element that makes paths, see Tree.
    path: int
    element: int
    never: bool
    text: str


class Tree:
    """The elements that make paths, by number in page order; each knows the one around it and
    its path, so that deep pages cost what they have of elements. Number 0 stands for the page."""

    def __init__(self) -> None:
        self.parents, self.names, self.paths = [0], [""], [0]
        self._known: dict[tuple[int, str], int] = {}

    def add(self, parent: int, name: str) -> int:
        self.parents.append(parent)
        self.names.append(name)
        self.paths.append(self._known.setdefault((self.paths[parent], name), len(self._known) + 1))
        return len(self.parents) - 1


def summed_upwards(parents: list[int], own: dict[int, int]) -> list[int]:
    """For each number its own value and those of all below it; parents come before children."""
    total = [own.get(i, 0) for i in range(len(parents))]
    for i in range(len(parents) - 1, 0, -1):
        total[parents[i]] += total[i]
    return total


class _Open(NamedTuple):
    name: str
    #: The innermost element that makes paths.
    element: int
    never: bool
    #: Number of the innermost open element whose class, id or role is marked.
    mark: int
    #: Whether the element itself is marked.
    own: bool


_ROOT = _Open("", 0, False, 0, False)


def _never(name: str, attributes: str) -> tuple[bool, bool]:
    """Whether an element is never content, and whether it is marked as none."""
    if name in NEVER:
        return True, False
    if not attributes or name in ("html", "body"):
        return False, False
    given: dict[str, str] = {}
    for key, *values in _ATTRIBUTE.findall(attributes):
        given.setdefault(key.lower(), "".join(values))
    if "hidden" in given or given.get("aria-hidden", "").strip().lower() == "true":
        return True, False
    if _NO_DISPLAY.search(given.get("style", "")):
        return True, False
    for token in " ".join(given.get(key, "") for key in ("class", "id", "role")).split():
        parts = _WORD.findall(_CAMEL.sub("-", token).lower())
        if not parts or parts[0] in LAYOUT or (parts[0] in TITLED and parts[-1] == "header"):
            continue
        # The first and the last part name a thing; those between only describe it.
        if parts[0] in MARKS or parts[-1] in MARKS:
            return False, True
    return False, False


def blocks_of(html: str) -> tuple[list[Block], Tree]:
    """The text blocks of a page in their order, white space inside them made one space."""
    blocks: list[Block] = []
    tree = Tree()
    #: The mark around each mark, and that of each block.
    around, marks = [0], []
    opened: Counter[str] = Counter()
    stack: list[_Open] = [_ROOT]
    held: list[str] = []

    def end_block() -> None:
        if held:
            text = "".join(held)
            text = " ".join((unescape(text) if "&" in text else text).split())
            held.clear()
            if text:
                top = stack[-1]
                blocks.append(Block(tree.paths[top.element], top.element, top.never, text))
                marks.append(top.mark)

    def close(at: int) -> None:
        opened.subtract(x.name for x in stack[at:])
        del stack[at:]

    low, n = 0, len(html)
    while low < n:
        tag = _TAG.search(html, low)
        if tag is None:
            held.append(html[low:])
            break
        if tag.start() > low:
            held.append(html[low : tag.start()])
        low = tag.end()
        if tag[2] is None:
            continue
        name = tag[2].lower()
        if tag[1]:
            at = len(stack) - 1 if opened[name] > 0 else 0
            while at and stack[at].name != name:
                at -= 1
            # An inline element that was marked ends its own text.
            if name in BLOCKS or stack[at].own:
                end_block()
            if at:
                close(at)
            continue
        if name == "br":
            held.append(" ")
            continue
        if name in RAW:
            end = re.compile(rf"</{re.escape(name)}(?=[\s/>])[^>]*(?:>|\Z)", re.I).search(html, low)
            if not tag[3].rstrip().endswith("/") or name not in ("svg", "math"):
                low = end.end() if end else n
            continue
        if name in VOID:
            if name in BLOCKS:
                end_block()
            continue
        never, own = _never(name, tag[3])
        if name in BLOCKS or never or own:
            end_block()
        if name in BLOCKS:
            for i in range(len(stack) - 1, 0, -1):
                open_name = stack[i].name
                if name in ENDS.get(open_name, ()):
                    scope = SCOPES.get(open_name, ())
                    if not scope or not any(x.name in scope for x in stack[i + 1 :]):
                        close(i)
                elif open_name in BLOCKS and open_name not in ENDS:
                    break
        top = stack[-1]
        element = tree.add(top.element, name) if name in BLOCKS else top.element
        mark = top.mark
        if own:
            around.append(mark)
            mark = len(around) - 1
        stack.append(_Open(name, element, top.never or never, mark, never or own))
        opened[name] += 1
    end_block()
    return _without_marked(blocks, marks, around), tree


def _without_marked(blocks: list[Block], marks: list[int], around: list[int]) -> list[Block]:
    """The blocks, those under a mark never content, unless most of the page's text is there."""
    own: Counter[int] = Counter()
    for b, mark in zip(blocks, marks):
        if not b.never:
            own[mark] += len(b.text)
    held = summed_upwards(around, own)
    total = held[0]
    # If a page has no other text, there is nothing to tell it from a mere notice.
    counts = [False]
    for i in range(1, len(around)):
        counts.append(counts[around[i]] or 0 < held[i] < MOST * total or held[i] == total > 0)
    return [b._replace(never=b.never or counts[mark]) for b, mark in zip(blocks, marks)]


_NEAR = np.exp(-0.5 * np.arange(-3, 4) ** 2.0)


def _smoothed(values: np.ndarray, there: np.ndarray) -> np.ndarray:
    """A Gaussian mean of each value and those near it."""
    return np.convolve(values, _NEAR)[3:-3] / there


def content(blocks: list[Block], tree: Tree, threshold: float = 0.5) -> list[Block]:
    """Blocks of paths whose fused ratio reaches ``threshold`` deviations of all, and what stands
    with them in one element."""
    usable = [b for b in blocks if not b.never]
    if not usable:
        return []
    paths = {p: i for i, p in enumerate(dict.fromkeys(b.path for b in blocks))}
    which = np.array([paths[b.path] for b in blocks])
    weight = np.array([0.0 if b.never else 1.0 for b in blocks])
    lengths = weight * [len(b.text) for b in blocks]
    marks = weight * [sum(map(b.text.count, PUNCTUATION)) for b in blocks]
    count = np.bincount(which, minlength=len(paths)).astype(float)
    there = np.convolve(np.ones(len(blocks)), _NEAR)[3:-3]
    ratios = []
    for values in (lengths, marks):
        by_path = np.bincount(which, values, len(paths)) / count
        along = _smoothed(by_path[which], there)
        ratios.append(np.bincount(which, along * weight, len(paths)) / count)
    text_ratio, mark_ratio = (r / r.max() if r.max() > 0 else r for r in ratios)
    # Text without punctuation still counts, as half.
    fused = text_ratio * (1 + mark_ratio) / 2
    least = min(threshold * fused[which].std(), fused.max())
    # The element that holds most of the kept text holds the rest of it, too.
    kept = [b for b, i in zip(blocks, which) if not b.never and fused[i] >= least and fused[i] > 0]
    total = sum(len(b.text) for b in kept)
    own: Counter[int] = Counter()
    for b in kept:
        # An element holds what is in others below it, or stands right on the page.
        own[tree.parents[b.element] or b.element] += len(b.text)
    held = summed_upwards(tree.parents, own)
    # No two elements side by side have so much, so the last one is the innermost.
    holder = max((i for i in range(1, len(held)) if held[i] >= 0.9 * total), default=0)
    # The body and what is above it hold the page, not the article alone.
    if not holder or tree.names[holder] in ("html", "body"):
        return kept
    inside = [False] * len(held)
    for i in range(holder, len(held)):
        inside[i] = i == holder or inside[tree.parents[i]]
    return [b for b in usable if inside[b.element]]


def main_text(html: str | None) -> str:
    return "\n".join(b.text for b in content(*blocks_of(html or "")))


def extract(df: DataFrame, html: str = "html", key: str = "page_id", keep: tuple[str, ...] = ("url",)) -> DataFrame:
    """key, the columns of ``keep``, text and n_chars (code points) of every page.

    Null and empty pages, and pages with nothing but menus and the like, have the empty text.
    Every row gives one row, repeated ones too; null keys stay null; equal ratios are kept or
    left together; pages are read one at a time, so a very long one costs its own size; an
    empty table gives an empty table. Other columns are not read, whatever their names.
    """

    def pages(batches):
        for batch in batches:
            texts = [main_text(page.as_py()) for page in batch.column(batch.num_columns - 1)]
            yield pa.RecordBatch.from_arrays(
                [
                    *batch.columns[:-1],
                    pa.array(texts, pa.string()),
                    pa.array([len(t) for t in texts], pa.int64()),
                ],
                names=[key, *keep, "text", "n_chars"],
            )

    named = ", ".join(f"`{c}` {df.schema[c].dataType.simpleString()}" for c in (key, *keep))
    return df.select(key, *keep, html).mapInArrow(pages, f"{named}, {RESULT}")
