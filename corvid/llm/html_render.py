"""HTML extraction by layout-aware rendering.

A tolerant tree builder (implied end tags, implied table rows, void and raw-text
elements, visibility rules) drives a small renderer that keeps what a reader sees: all
visible text, blank lines between paragraphs, line breaks between blocks, list markers
with nested indents, preformatted text, and table cells in aligned columns.  One pass
over the tags, no recursion; visibility holds at any depth.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corvid.llm import text_np as tn
from corvid.llm.common import ship_package

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<[!?/][^>]*>|[^<]+|<""",
                 re.DOTALL)
ATTRIBUTE = re.compile(r"""([^\s=/"'>]+)\s*(?:=\s*("[^"]*"|'[^']*'|[^\s"'>]+))?""")
NO_DISPLAY = re.compile(r"display\s*:\s*none", re.IGNORECASE)
VISIBILITY = re.compile(r"visibility\s*:\s*(visible|hidden|collapse)", re.IGNORECASE)
NUMBER = re.compile(r"\s*([+-]?[0-9]{1,9})")
MAX_BOXES = 512  # list items and cells nested deeper are laid out as plain blocks
MAX_PADDED = 8_000_000  # characters of a table with padding; beyond it, its widest columns are not padded

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("head script style template noscript iframe noframes noembed object audio video canvas svg "
                   "datalist".split())
RAW = {t: re.compile(f"</{t}(?=[\\s/>])", re.IGNORECASE) for t in "script style title textarea xmp iframe noframes noembed".split()}
# Lines of space around a block: 2 leaves a blank line.
SPACE = {**dict.fromkeys("address article aside body center details dialog dd div dt fieldset figcaption footer form "
                         "header hgroup html legend li main menu nav option optgroup section summary tr caption "
                         "tbody thead tfoot".split(), 1),
         **dict.fromkeys("blockquote dl figure h1 h2 h3 h4 h5 h6 hr ol p pre table ul xmp".split(), 2)}
ENDS_P = frozenset(SPACE) - frozenset("body html option optgroup tr caption tbody thead tfoot legend".split())
# start tag -> (open elements it ends, elements it does not look beyond)
_TABLE = frozenset(["table"])
ENDS = {"li": (frozenset(["li"]), frozenset("ul ol menu td th".split())),
        **dict.fromkeys(("dt", "dd"), (frozenset(["dt", "dd"]), frozenset("dl td th".split()))),
        **dict.fromkeys(("option", "optgroup"), (frozenset(["option"]), frozenset(["select"]))),
        **dict.fromkeys(("td", "th"), (frozenset(["td", "th"]), _TABLE)),
        "tr": (frozenset("tr caption".split()), _TABLE),
        **dict.fromkeys(("tbody", "thead", "tfoot"), (frozenset("tbody thead tfoot tr caption".split()), _TABLE))}
P_SCOPE = frozenset("td th caption table button li dd dt".split())
LISTS = frozenset("ul ol menu".split())


class _Box:
    """Text of one flow: collapses white space and keeps at most one blank line between blocks."""

    def __init__(self):
        self.parts: list[str] = []
        self.lines = 0  # line breaks owed before the next text
        self.blank = False  # a space is owed

    def block(self, lines: int) -> None:
        self.lines, self.blank = max(self.lines, lines), False

    def text(self, s: str, pre: bool = False) -> None:
        if pre:
            self._put(s)
            return
        words = s.split(None) if s.isascii() else re.split("[ \t\n\r\f]+", s.strip(" \t\n\r\f"))
        if s[0] in " \t\n\r\f":
            self.blank = True
        if words and words[0]:
            self._put(" ".join(words))
            self.blank = s[-1] in " \t\n\r\f"

    def _put(self, s: str) -> None:
        if self.parts:
            if self.lines:
                self.parts.append("\n" * self.lines)
            elif self.blank:
                self.parts.append(" ")
        self.lines, self.blank = 0, False
        self.parts.append(s)

    def value(self) -> str:
        return "".join(self.parts).strip("\n")


class _Open:
    """An open element."""
    __slots__ = ("tag", "box", "hidden", "unseen", "closed", "pre", "number", "rows", "span", "depth", "own")

    def __init__(self, tag: str, box: _Box, hidden: bool, pre: bool, unseen: bool = False, depth: int = 0):
        self.tag, self.box, self.hidden, self.pre = tag, box, hidden, pre
        self.unseen = unseen  # by visibility, which elements inside may lift
        self.closed = False  # details without ``open``
        self.number: int | None = None  # next number of an ordered list, or a list item's own
        self.depth, self.own = depth, False  # boxes around the element, and whether it has one itself
        self.rows: list[list[tuple[str, int, int]]] = []  # of a table: (text, columns, rows) per cell
        self.span = (1, 1)


def _columns(rows: list[list[tuple[str, int, int]]]) -> str:
    """Cells in aligned columns; a cell may span columns and rows and have several lines."""
    grid: list[list[tuple[int, int, str]]] = []
    held: dict[int, int] = {}  # column -> rows it is still covered from above
    for row in rows:
        placed, at, held_next = [], 0, {c: n - 1 for c, n in held.items() if n > 1}
        for text, wide, deep in row:
            while at in held:
                at += 1
            placed.append((at, wide, text))
            if deep > 1:
                held_next |= {c: deep - 1 for c in range(at, at + wide)}
            at += wide
        grid.append(placed)
        held = held_next
    width: dict[int, int] = {}
    for row in grid:
        for at, wide, text in row:
            if wide == 1:
                width[at] = max(width.get(at, 0), *(len(x) for x in text.split("\n")))
    lines = sum(max((text.count("\n") + 1 for _, _, text in row), default=0) for row in grid)
    padded = lines * sum(width.values())
    for c in sorted(width, key=width.get, reverse=True):
        if padded > MAX_PADDED:
            padded, width[c] = padded - lines * width[c], 0
    out = []
    for row in grid:
        cells = [(at, wide, text.split("\n")) for at, wide, text in row]
        for k in range(max((len(x) for _, _, x in cells), default=0)):
            line, column = [], 0
            for at, wide, x in cells:
                line += [" " * width.get(c, 0) for c in range(column, at)]
                column = at + wide
                line.append((x[k] if k < len(x) else "").ljust(
                    sum(width.get(c, 0) for c in range(at, column)) + 3 * (wide - 1)))
            out.append(" | ".join(line).rstrip())
    return "\n".join(out)


class _Renderer:
    def __init__(self):
        self.stack = [_Open("", _Box(), False, False)]
        self.at: dict[str, list[int]] = {}  # tag -> places of its open elements in the stack

    def text(self, s: str) -> None:
        top = self.stack[-1]
        if not (top.hidden or top.closed or top.unseen):
            top.box.text(html.unescape(s) if "&" in s else s, top.pre)

    def start(self, tag: str, attributes: str) -> None:
        if tag in ENDS_P and self.at.get("p"):
            self._end_open(frozenset(["p"]), P_SCOPE)
        if tag in ENDS:
            self._end_open(*ENDS[tag])
        if tag in ("td", "th") and self.at.get("table") and self._place(("tr",)) < self._place(_TABLE):
            self._push("tr", {})
        self._push(tag, {a.lower(): (v or "").strip("\"'") for a, v in ATTRIBUTE.findall(attributes)}
                   if attributes.strip(" /") else {})

    def _push(self, tag: str, given: dict[str, str]) -> None:
        top = self.stack[-1]
        hidden = top.hidden or (top.closed and tag != "summary") or tag in UNSEEN or "hidden" in given \
            or (tag == "dialog" and "open" not in given) or bool(NO_DISPLAY.search(given.get("style", "")))
        seen = VISIBILITY.findall(given.get("style", ""))
        unseen = seen[-1].lower() != "visible" if seen else top.unseen
        if not hidden:
            if tag == "br":
                top.box.lines, top.box.blank = min(top.box.lines + 1, 2), False
            elif tag in SPACE:
                nested = tag in LISTS and any(e.tag == "li" for e in self.stack[-3:])
                top.box.block(1 if nested else SPACE[tag])
        if tag in VOID:
            return
        new = _Open(tag, top.box, hidden, top.pre or tag in ("pre", "textarea", "xmp"), unseen, top.depth)
        number = NUMBER.match(given.get("value" if tag == "li" else "start", "")) if tag in ("li", "ol") else None
        new.number = int(number.group(1)) if number else 1 if tag == "ol" else None
        if tag in ("li", "td", "th", "caption") and top.depth < MAX_BOXES:
            new.box, new.own, new.depth = _Box(), True, top.depth + 1
            new.span = tuple(min(int(given[a]), 1000) if given.get(a, "").isdigit() and int(given[a]) else 1
                             for a in ("colspan", "rowspan"))
        elif tag == "details":
            new.closed = "open" not in given
        self.stack.append(new)
        self.at.setdefault(tag, []).append(len(self.stack) - 1)
        if tag == "tr" and (table := self._nearest(_TABLE)):
            table.rows.append([])

    def end(self, tag: str) -> None:
        if tag == "p" and not self.at.get("p"):
            self._push("p", {})
        if tag == "br":
            self._push("br", {})
        elif self.at.get(tag):
            self._end_open(frozenset([tag]), frozenset() if tag in ("table", "body", "html") else
                           _TABLE if tag in ("td", "th", "tr", "tbody", "thead", "tfoot", "caption") else
                           frozenset(("td", "th")))

    def _end_open(self, tags: frozenset, scope: frozenset) -> None:
        """End the innermost open element of ``tags`` and all inside it, unless an element of ``scope`` is nearer."""
        k = self._place(tags)
        if k > 0 and k >= self._place(scope):
            while len(self.stack) > k:
                self._pop()

    def _place(self, tags) -> int:
        """Place of the innermost open element of ``tags`` in the stack, or -1."""
        return max((self.at[t][-1] for t in tags if self.at.get(t)), default=-1)

    def _nearest(self, tags: frozenset) -> _Open | None:
        k = self._place(tags)
        return self.stack[k] if k >= 0 else None

    def _pop(self) -> None:
        e = self.stack.pop()
        if e.tag:
            self.at[e.tag].pop()
        outer = self.stack[-1].box
        if e.hidden:
            return
        if e.tag == "li" and e.own:
            holder = self._nearest(LISTS)
            mark = "- "
            if holder is not None and holder.tag == "ol":
                holder.number = holder.number if e.number is None else e.number
                mark = f"{holder.number}. "
                holder.number += 1
            if value := e.box.value():
                outer.text(mark + value.replace("\n", "\n" + " " * len(mark)).replace("\n" + " " * len(mark) + "\n", "\n\n"),
                           True)
        elif e.tag in ("td", "th") and not e.own:
            outer.blank = True
        elif e.tag in ("td", "th"):
            table = self._nearest(_TABLE)
            if table is None or not table.rows:
                outer.text(e.box.value() or " ", True)
                outer.blank = True
            else:
                table.rows[-1].append((e.box.value(), *e.span))
        elif e.tag == "caption" and e.own and (value := e.box.value()):
            (self.stack[-2].box if len(self.stack) > 1 else outer).text(value, True)
            outer.block(1)
        elif e.tag == "table" and (value := _columns(e.rows)):
            outer.text(value, True)
        if e.tag in SPACE:
            outer.block(1 if e.tag in LISTS and any(x.tag == "li" for x in self.stack[-3:]) else SPACE[e.tag])

    def value(self) -> str:
        while len(self.stack) > 1:
            self._pop()
        return self.stack[0].box.value().strip()


def _tag_ends(page: str) -> Callable[[int], bool]:
    """Whether a tag that starts at a place ends at all, quotes taken into account: one pass over the page."""
    marks = [m.start() for m in re.finditer("[\"'>]", page)]
    outside = single = double = False  # is there an end, from here on, outside quotes and inside either kind?
    ends = [False] * (len(marks) + 1)
    for k in range(len(marks) - 1, -1, -1):
        c = page[marks[k]]
        if c == ">":
            outside = True
        elif c == '"':
            outside, double = double, outside
        else:
            outside, single = single, outside
        ends[k] = outside
    return lambda at: ends[bisect_left(marks, at)]


def render(page: str) -> str:
    """The visible text of one page."""
    out, at, last, ends = _Renderer(), 0, page.rfind(">"), None
    while at < len(page):
        if page[at] == "<" and (at > last or ends and page[at + 1:at + 2] not in "!?" and not ends(at)):
            if page.startswith("<!--", at):
                break
            out.text("<")
            at += 1
            continue
        m = TAG.match(page, at)
        at = m.end()
        if tag := m.group(2):
            tag = tag.lower()
            if m.group(1):
                out.end(tag)
                continue
            out.start(tag, m.group(3))
            if tag in RAW:
                close = RAW[tag].search(page, at)
                stop = close.start() if close else len(page)
                if tag in ("textarea", "xmp") and stop > at:
                    out.text(page[at:stop].strip("\n"))
                at = stop
        elif page[m.start()] != "<" or at - m.start() == 1:
            out.text(m.group())
            if ends is None and m.group() == "<":
                ends = _tag_ends(page)  # an unclosed quote: do not read on to the page's end for every tag
    return out.value()


def _page_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for lo, hi, raw, off in tn.slices(batch.column(1)):
            data = raw.tobytes()
            texts = [render(data[off[i]:off[i + 1]].decode("utf-8", "replace")) for i in range(hi - lo)]
            yield pa.RecordBatch.from_arrays([batch.column(0).slice(lo, hi - lo), pa.array(texts, type=pa.string())],
                                             ["page_id", "text"])


def render_pages(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """The visible text of every page: ``page_id, text``.

    Null and empty pages give an empty text; pages without markup are text with collapsed
    white space; broken markup is read as far as it makes sense.  Repeated rows are
    rendered one by one, a null id is kept, an empty table gives an empty result, other
    columns are not read.
    """
    ship_package(pages.sparkSession)
    base = pages.select(F.col(id_col).cast("long").alias("page_id"), F.col(html_col).alias("html"))
    return base.mapInArrow(_page_batches, "page_id long, text string")
