"""Main text of web pages by the maximum-scoring stretch of a page.

A page is read as words and tags. Words score positive, tags negative, and an element whose name or
class is one of menus, adverts and the like is closed off: its words are no part of the text and it
scores nothing. One scan finds the contiguous stretch with the highest sum; the blocks in it are
the main text, and so are the other blocks of the article, content or main element that the stretch
begins or ends in: what is not closed off there is never cut. All weights are counted on labelled pages: a
tag costs more the more often it stands outside the main text, and an element is closed off if its name or
a word of its class, id or role is found outside only. In a text, a name that says header closes nothing
off, and neither does a word inside a longer name that was not seen itself, as in elementor-widget-text.
Longer names are weak, and so are forms: such an element is opened again if it holds an article or main
element or more words than the text found without it. If there is no text at all, the elements that whole
class names close off are opened as well.

Of several articles, that of the best stretch is taken. Without article, main and content elements the text
is the best stretch alone. Markup may be broken in any way; the time is linear in the page's length
for a bounded number of openings (each makes the text longer).

Null or empty html, and a page without words: empty text. Character references are decoded, white
space inside a block becomes one space, blocks are joined in page order by one line end; nothing is
cut off however long. Repeated rows and a null id are kept. Empty table: no rows. Other columns are
not read.
"""

from __future__ import annotations

import html as entities
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from typing import NamedTuple

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dossierlake.llm.frames import prepared
from dossierlake.llm.labelled_pages import PAGES

RESULT = "page_id bigint, url string, text string, n_chars bigint"

# Fixed values of HTML: elements without content, whose content is no markup, and inside a line.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = "script|style|template|noscript|iframe|textarea|title|svg|math|canvas|object|xmp|noembed|noframes"
INLINE = set(
    "a abbr acronym b bdi bdo big br cite code data del dfn em font i img ins kbd label mark nobr q rp rt "
    "ruby s samp small span strike strong sub sup time tt u var wbr".split()
)
# Elements that are never closed off by their class, and those that open a text inside one.
ROOTS = {"html", "body"}
TEXTS = {"article", "main"}
# Words that make the name of an element around a text when one of each stands side by side.
WHAT, PART = set("article entry post story main".split()), set("content body text".split())

_OPEN = re.compile(r"<(/?)([a-zA-Z][^\s/>]*)")
_RAW = re.compile(rf"<({RAW})\b", re.I)
_RAW_END = {name: re.compile(rf"</{name}\s*>", re.I) for name in RAW.split("|")}
# What may stand in a tag before its end: quoted values hide a >.
_TO_END = re.compile(r"(?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>")
_UNFINISHED = re.compile(r"</?[a-zA-Z]")
# Raw elements that a slash may end.
FOREIGN = {"svg", "math"}
_NAMED = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


class Tag(NamedTuple):
    """A piece of markup; without a name: comments, declarations and raw elements with their content."""

    start: int
    end: int
    name: str = ""
    close: bool = False
    attrs: str = ""
    raw: str = ""


def tags(page: str) -> Iterator[Tag]:
    """All markup of a page, in linear time however broken it is.

    A tag ends at the first > outside quotes. Once no such > follows a tag, quotes mean nothing in the
    rest of the page. A comment or raw element without an end takes the rest of the page, and so does a
    tag without an end if no other begins after it; before that, it is text.
    """
    last, cdata = page.rfind(">"), page.rfind("]]>")
    quotes, at = True, 0
    while True:
        start = page.find("<", at)
        if start < 0 or start > last:
            break
        at = start + 1
        if page.startswith("<!--", start):
            at = page.find("-->", start + 4)
            at = len(page) if at < 0 else at + 3
            yield Tag(start, at)
            continue
        if page.startswith("<![CDATA[", start) and start < cdata:
            at = page.index("]]>", start) + 3
            yield Tag(start, at)
            continue
        if page[at] in "!?":
            at = page.index(">", start) + 1
            yield Tag(start, at)
            continue
        m = _OPEN.match(page, start)
        if not m:
            continue
        end = _TO_END.match(page, m.end()) if quotes else None
        quotes = end is not None
        at = end.end() if end else page.find(">", m.end()) + 1
        attrs, raw = page[m.end() : at - 1], None if m[1] else _RAW.match(page, start)
        if not raw or (raw[1].lower() in FOREIGN and attrs.endswith("/")):
            yield Tag(start, at, m[2].lower(), bool(m[1]), attrs)
            continue
        close = _RAW_END[raw[1].lower()].search(page, at)
        at = close.end() if close else len(page)
        yield Tag(start, at, raw=raw[1].lower())
    rest = page.rfind("<")
    if rest >= at and page.find("<!--", at) < 0 and _UNFINISHED.match(page, rest):
        yield Tag(rest, len(page))
    elif 0 <= (rest := page.find("<!--", at)):
        yield Tag(rest, len(page))


@dataclass(frozen=True)
class Weights:
    word: float
    tags: dict[str, float]
    other_tag: float
    closed: frozenset[str]
    names: frozenset[str]  # whole names of class, id and role, seen outside only


def marks(attrs: str) -> list[str]:
    """Lower-case words of class, id and role."""
    if "=" not in attrs:
        return []
    return [part.lower() for name in _names(attrs) for part in _PART.findall(name)]


def _names(attrs: str) -> list[str]:
    """Whole names of class, id and role."""
    if "=" not in attrs:
        return []
    return [name for a, b, c in _NAMED.findall(attrs) for name in (a or b or c).split()]


def _telling(attrs: str, w: Weights, inside: bool) -> int:
    """2 if a whole name closes off, 1 if a word of a longer name does, else 0.

    In a text, a word inside a longer name that was not seen itself tells nothing; its first and last do.
    """
    found = 0
    for name in _names(attrs):
        words = [part.lower() for part in _PART.findall(name)]
        if inside and "header" in words:
            continue
        whole = len(words) == 1 or name.lower() in w.names
        if inside and not whole:
            words = [words[0], words[-1]] if words else []
        if any(f".{word}" in w.closed for word in words):
            found = max(found, 2 if whole else 1)
    return found


def _texts_around(name: str, attrs: str, around: tuple[int, int, int], number: int) -> tuple[int, int, int]:
    """Numbers of the outermost article and content element and of the innermost main, or -1."""
    article, content, main = around
    if name == "article":
        return (number if article < 0 else article), content, main
    if name == "main":
        return article, content, number
    if content < 0 and name not in ROOTS and "=" in attrs:
        words = marks(attrs)
        if any(a in WHAT and b in PART for a, b in zip(words, words[1:])):
            return article, number, main
    return around


def _owner(around: tuple[int, int, int]) -> int:
    return next((n for n in around if n >= 0), -1)


def fit(pages: Iterable[list[tuple[str, int]]]) -> Weights:
    """Weights from labelled pages."""
    seen, signs, words = (Counter(), Counter()), (Counter(), Counter()), [0, 0]
    names: tuple[set[str], set[str]] = (set(), set())
    for page in pages:
        depth = 0  # of article and main
        for markup, label in page:
            at = 0
            for tag in tags(markup):
                words[label] += len(markup[at : tag.start].split())
                at = tag.end
                name = tag.name or tag.raw
                if not name or tag.close:
                    depth -= tag.close and name in TEXTS
                    continue
                depth += name in TEXTS
                seen[label][name] += 1
                names[label].update(x.lower() for x in _names(tag.attrs))
                signs[label].update({_kind(name, depth > 0)} | {f".{s}" for s in marks(tag.attrs)})
            words[label] += len(markup[at:].split())
    odds = {
        name: math.log((seen[0][name] + 0.5) / words[0]) - math.log((seen[1][name] + 0.5) / words[1])
        for name in {*seen[0], *seen[1]}
    }
    cost = {name: max(0.5, x + 1.0) for name, x in odds.items()}
    closed = {s for s, n in signs[0].items() if not signs[1][s] and (n >= 2 or s[0] != ".")}
    return Weights(1.0, cost, 1.0, frozenset(closed), frozenset(names[0] - names[1]))


def _kind(name: str, inside: bool) -> str:
    """Headers and footers of a text are another kind than those of a page."""
    return f"text {name}" if inside and name in ("header", "footer") else name


def main_blocks(page: str, w: Weights) -> list[str]:
    """Blocks of the best stretch, in page order."""
    found = list(tags(page))
    opened: set[int] = set()
    while True:
        blocks, hidden = _scan(page, found, w, opened)
        n = sum(len(block.split()) for block in blocks)
        again = {at for at, (strength, words) in hidden.items() if strength == 1 and words > n}
        if not again and not n:
            again = {at for at, (_, words) in hidden.items() if words}
        if not again:
            return blocks
        opened |= again


class _Element(NamedTuple):
    name: str
    opens: bool  # closed off, but a text inside opens it again
    around: tuple[int, int, int]  # the texts around what is in it
    hidden: tuple[int, int] | None  # place and words hidden before, if closed off by class or a form


def _scan(page: str, found: list[Tag], w: Weights, opened: set[int]) -> tuple[list[str], dict[int, tuple[int, int]]]:
    """Blocks of the best stretch; strength and words of what may be opened, by place.

    Those are the elements closed off by class and forms, at any depth. They are not closed off if they
    begin at a place in ``opened``.
    """
    hidden: dict[int, tuple[int, int]] = {}
    blocks: list[list[str]] = [[]]
    owners = [-1]  # number of the element around a text that a block stands in
    stack: list[_Element] = []
    depth: Counter[str] = Counter()  # open elements by name
    nowhere = (-1, -1, -1)
    shut = 0  # index + 1 in the stack of the element that closes off now
    texts = 0
    unseen = 0  # words closed off so far
    total = best = 0.0
    begin, stretch = 0, (0, -1)  # first block of the current stretch, and those of the best one
    at = 0

    def words(raw: str) -> None:
        nonlocal total, best, begin, stretch, unseen
        n = len(raw.split())
        if shut:
            unseen += n
            return
        if raw:
            blocks[-1].append(raw)
        if n:
            owners[-1] = _owner(stack[-1].around if stack else nowhere)
            if total <= 0:
                total, begin = 0.0, len(blocks) - 1
            total += w.word * n
            if total > best:
                best, stretch = total, (begin, len(blocks) - 1)

    def leave(until: int) -> None:
        """Ends the open elements from this one on."""
        nonlocal texts
        for element in stack[until:]:
            depth[element.name] -= 1
            texts -= element.name in TEXTS
            if element.hidden:
                place, before = element.hidden
                hidden[place] = hidden[place][0], unseen - before
        del stack[until:]

    for tag in found:
        if tag.start > at:
            words(page[at : tag.start])
        at, name = tag.end, tag.name
        if not name:
            continue
        if name == "br":
            if not shut:
                blocks[-1].append(" ")
        elif name not in INLINE and not shut and blocks[-1]:
            blocks.append([])
            owners.append(-1)
        if tag.close:
            ended = False  # a closed-off element's own end
            if depth[name]:
                i = next(i for i in range(len(stack) - 1, -1, -1) if stack[i].name == name)
                if shut > i:
                    shut, ended = 0, shut == i + 1
                leave(i)
            if not shut and not ended:
                total -= w.tags.get(name, w.other_tag) / 2
            continue
        if shut and name in TEXTS and stack[shut - 1].opens:
            shut = 0  # a wrapper with a telling class, or a form, around the text itself
        cost = 0.0 if shut else w.tags.get(name, w.other_tag) / 2
        if name in VOID or tag.attrs.endswith("/"):
            total -= cost
            continue
        around = stack[-1].around if stack else nowhere
        strength, by_name = 0, False
        if name not in ROOTS and tag.start not in opened:
            if name not in TEXTS:
                strength = _telling(tag.attrs, w, _owner(around) >= 0)
            by_name = _kind(name, texts > 0) in w.closed
            if by_name and name == "form" and not strength:
                strength, by_name = 1, False
        if name == "p" and stack and stack[-1].name == "p":
            leave(len(stack) - 1)
            if shut > len(stack):
                shut = 0
        around = _texts_around(name, tag.attrs, around, tag.start)
        opens = strength > 0 and not by_name
        if opens:
            hidden[tag.start] = strength, 0
        stack.append(_Element(name, opens, around, (tag.start, unseen) if opens else None))
        depth[name] += 1
        texts += name in TEXTS
        if not shut and (opens or by_name):
            shut, cost = len(stack), 0.0
            if blocks[-1] and name not in INLINE:
                blocks.append([])
                owners.append(-1)
        total -= cost
    words(page[at:])
    leave(0)
    if best:
        first, last = owners[stretch[0]], owners[stretch[1]]
        if first >= 0:
            stretch = owners.index(first), stretch[1]
        if last >= 0:
            stretch = stretch[0], len(owners) - 1 - owners[::-1].index(last)
    joined = (" ".join(entities.unescape("".join(b)).split()) for b in blocks[stretch[0] : stretch[1] + 1])
    return [block for block in joined if block], hidden


_weights: Weights | None = None


def default_weights() -> Weights:
    global _weights
    if _weights is None:
        _weights = fit(PAGES)
    return _weights


def main_text(page: str | None, w: Weights | None = None) -> str:
    return "\n".join(main_blocks(page or "", w or default_weights()))


def extract(
    pages: DataFrame,
    weights: Weights | None = None,
    id_col: str = "page_id",
    url_col: str = "url",
    html_col: str = "html",
) -> DataFrame:
    """page_id, url, text, n_chars."""
    prepared(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        w = weights or default_weights()
        for batch in batches:
            texts = [main_text(page, w) for page in batch.column(2).to_pylist()]
            counts = pa.array([len(t) for t in texts], pa.int64())
            columns = [batch.column(0), batch.column(1), pa.array(texts, pa.string()), counts]
            yield pa.RecordBatch.from_arrays(columns, ["page_id", "url", "text", "n_chars"])

    rows = pages.select(
        F.col(id_col).cast("bigint"), F.col(url_col).cast("string"), F.col(html_col).cast("string")
    )
    return rows.mapInArrow(run, RESULT)
