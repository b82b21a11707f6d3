"""Layout-aware text of HTML pages.

A tokenizer and a tree builder with implied tags read what real pages hold; a renderer emits every visible text, with blank
lines between blocks, list markers and indents, preformatted text as it is, and table cells in aligned columns.
"""

from __future__ import annotations

import html
import re
import sys
import unicodedata
from bisect import bisect_left
from collections import Counter
from collections.abc import Iterator
from heapq import heappop, heappush

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from concordat.llm.common import ship

# Fixed values of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes plaintext".split())
CLOSES_P = frozenset("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr main menu nav ol p pre listing search section summary table ul li dd dt".split())
# start tag -> (open elements that it ends, elements at which the search for them stops)
IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir", "table", "td", "th"}),
    "dt": ({"dt", "dd"}, {"dl", "table", "td", "th"}),
    "dd": ({"dt", "dd"}, {"dl", "table", "td", "th"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "tr": ({"tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "thead": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "tfoot": ({"tbody", "thead", "tfoot", "tr", "td", "th", "caption", "colgroup"}, {"table"}),
    "caption": ({"caption"}, {"table"}),
    "colgroup": ({"colgroup", "caption"}, {"table"}),
    "body": ({"head"}, {"html"}),
    "rt": ({"rt", "rp"}, {"ruby"}),
    "rp": ({"rt", "rp"}, {"ruby"}),
}
SCOPE = frozenset("table td th caption html template object button".split())
HIDDEN = frozenset("head script style template noscript noembed noframes iframe object audio video canvas datalist title meta link param area rp".split())
HIDDEN_IN_DRAWINGS = frozenset("desc defs metadata symbol clippath mask pattern annotation annotation-xml".split())  # within svg and math
# blocks with the number of blank lines around them
BLOCKS = dict.fromkeys("address article aside body center div details dialog dd dt fieldset figcaption footer form header hgroup html legend li main nav optgroup option search section summary tr caption thead tbody tfoot".split(), 0)
BLOCKS |= dict.fromkeys("blockquote dl dir figure h1 h2 h3 h4 h5 h6 hr menu ol p pre listing xmp plaintext table ul".split(), 1)

FOREIGN = frozenset("svg math foreignobject annotation-xml".split())
OWN_LINES = frozenset("ul ol menu dir li table caption td th dd blockquote select thead tbody tfoot tr".split())
_TOKEN = re.compile(r"<!--(?:>|->|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*>?|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"'=]+|=\s*\"[^\"]*\"|=\s*'[^']*'|[=\"'])*+)(?:>|\Z)", re.S)
_ATTRIBUTE = re.compile(r"([^\s\"'<>/=]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?", re.S)
_SPACE = re.compile(r"[ \t\n\r\f]+")


class Element:
    __slots__ = ("attributes", "children", "name")

    def __init__(self, name: str, attributes: dict[str, str]):
        self.name, self.attributes, self.children = name, attributes, []


def tokens(text: str) -> Iterator[tuple[str, str, str]]:
    """("text", t, ""), ("start", name, attributes), ("end", name, ""); a raw element's content is one text. A CDATA section is text within svg and
    math, elsewhere a comment up to the next >."""
    at = 0
    foreign: list[tuple[str, bool]] = []  # elements that lead into svg and math, and those that lead out of them
    while at < len(text):
        m = _TOKEN.search(text, at)
        if not m:
            yield "text", text[at:], ""
            return
        if m.start() > at:
            yield "text", text[at : m.start()], ""
        at = m.end()
        if not m[2]:
            if m[0].startswith("<![CDATA["):
                if foreign and foreign[-1][1]:
                    yield "text", html.escape(m[0][9:].removesuffix("]]>"), quote=False), ""
                else:
                    end = text.find(">", m.start())
                    at = end + 1 if end >= 0 else len(text)
            continue
        name = m[2].lower()
        if m[1]:
            if name in FOREIGN and any(name == n for n, _ in foreign):
                while foreign.pop()[0] != name:
                    pass
            yield "end", name, ""
            continue
        if name in FOREIGN and not m[3].endswith("/"):
            foreign.append((name, name in ("svg", "math")))
        yield "start", name, m[3]
        if name in RAW:
            end = re.compile(rf"</{name}(?=[\s/>])|\Z", re.I).search(text, at) if name != "plaintext" else None
            stop = end.start() if end else len(text)
            body = text[at:stop]
            yield "text", body if name in ("textarea", "title") else html.escape(body, quote=False), ""
            at = stop


def attributes(text: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(text):
        out.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return out


def parse(text: str) -> Element:
    """The tree of a page, of any depth. Unclosed and misplaced tags are mended."""
    root = Element("html", {})
    stack = [root]
    opened: Counter[str] = Counter()  # names on the stack: it is searched for those that are there only

    def cut_at(i: int) -> None:
        for e in stack[i:]:
            opened[e.name] -= 1
        del stack[i:]

    def close(names, stops) -> None:
        if any(opened[n] for n in names):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name in names:
                    cut_at(i)
                    return
                if stack[i].name in stops:
                    return

    def close_all(names, stops) -> None:
        low = 0
        if any(opened[n] for n in names):
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].name in stops:
                    break
                if stack[i].name in names:
                    low = i
        if low:
            cut_at(low)

    def push(name: str, attrs: dict[str, str]) -> None:
        node = Element(name, attrs)
        stack[-1].children.append(node)
        if name not in VOID:
            stack.append(node)
            opened[name] += 1

    for kind, name, rest in tokens(text):
        if kind == "text":
            # text right inside a table's rows stands before the table in browsers; here it stays in place, in a cell of its own
            stack[-1].children.append(html.unescape(name))
        elif kind == "start":
            if name == "html":
                continue
            if name in CLOSES_P:
                close({"p"}, SCOPE)
            if name in IMPLIED:
                close_all(*IMPLIED[name])
            elif stack[-1].name == "head" and name not in HIDDEN | {"base"}:
                cut_at(len(stack) - 1)
            if name in ("td", "th") and stack[-1].name in ("table", "tbody", "thead", "tfoot"):
                push("tr", {})
            if re.fullmatch("h[1-6]", name) and re.fullmatch("h[1-6]", stack[-1].name):
                cut_at(len(stack) - 1)
            if name in ("a", "button"):
                close({name}, SCOPE)
            push(name, attributes(rest))
        elif name == "br":
            push("br", {})
        elif name == "p" and not opened["p"]:
            push("p", {})
            cut_at(len(stack) - 1)
        elif name not in ("html", "body"):
            stops = {"table"} if name in IMPLIED else {"td", "th", "table"} if name not in ("table", "tbody", "thead", "tfoot", "tr") else {"table"} - {name}
            if re.fullmatch("h[1-6]", name):
                close({f"h{k}" for k in range(1, 7)}, stops)
            else:
                close({name}, stops)
    return root


_RULE = re.compile(r"([^{}]*)\{([^{}]*)\}")
_SIMPLE = re.compile(r"([a-z][\w-]*|\*)?((?:[.#][\w-]+)*)")
_STYLE = re.compile(r"(?:^|;)(display|visibility|content-visibility):([a-z-]+)(!important)?(?=;|$)")


def declared(text: str) -> list[tuple[str, str, bool]]:
    """What a list of declarations says of visibility: [(property, value, whether it is important)]."""
    return [(m[1], m[2], bool(m[3])) for m in _STYLE.finditer(re.sub(r"/\*.*?\*/|\s", "", text.lower(), flags=re.S))]


class Sheet:
    """The rules of a page's style elements that hide or show, for selectors of one element: a name, classes and an id, in lists.

    Rules for other selectors, and those in @-blocks other than @media all and screen, do not count.
    """

    def __init__(self, sheets: list[str]):
        self.rules: dict[str, list[tuple]] = {}  # by id, class or name, the most telling part of the selector
        for order, (selectors, body) in enumerate(r for t in sheets for r in _rules(t)):
            if found := declared(body):
                for selector in selectors.split(","):
                    m = _SIMPLE.fullmatch(selector.strip())
                    if m and m[0]:
                        name, parts = (m[1] or "*").lower(), re.findall(r"[.#][\w-]+", m[2])
                        ids, classes = (frozenset(p[1:] for p in parts if p[0] == c) for c in "#.")
                        key = f"#{min(ids)}" if ids else f".{min(classes)}" if classes else name
                        weight = (len(ids), len(classes), name != "*", order)
                        self.rules.setdefault(key, []).append((name, ids, classes, weight, found))

    def of(self, e: Element) -> dict[str, str]:
        """The values that hold for an element, its own style attribute included."""
        best: dict[str, tuple] = {}
        a = e.attributes
        if self.rules:
            own, classes = a.get("id", ""), a.get("class", "").split()
            for key in ("*", e.name, *([f"#{own}"] if own else []), *(f".{c}" for c in classes)):
                for name, ids, wanted, weight, found in self.rules.get(key, ()):
                    if name in ("*", e.name) and ids <= {own} and wanted <= set(classes):
                        for prop, value, important in found:
                            best[prop] = max(best.get(prop, ((),)), ((important, 0, *weight), value))
        if "style" in a:
            for prop, value, important in declared(a["style"]):
                best[prop] = max(best.get(prop, ((),)), ((important, 1), value), key=lambda x: x[0])
        return {p: v[1] for p, v in best.items()}


def _rules(text: str) -> Iterator[tuple[str, str]]:
    text, at = re.sub(r"/\*.*?(?:\*/|\Z)|<!--|-->", "", text, flags=re.S), 0
    while at < len(text):
        m = re.compile(r"[^{};]*[{;}]").match(text, at)
        if not m:
            return
        lead = m[0][:-1].strip()
        if m[0][-1] != "{":  # @import and the like, or the end of a block that was entered
            at = m.end()
        elif lead.startswith("@"):
            if re.fullmatch(r"@media\s+(only\s+)?(all|screen)", lead, re.I):
                at = m.end()
            else:
                depth, at = 1, m.end()
                while depth and (k := re.compile("[{}]").search(text, at)):
                    depth, at = depth + (1 if k[0] == "{" else -1), k.end()
                if depth:
                    return
        else:
            end = text.find("}", m.end())
            yield lead, text[m.end() : end if end >= 0 else len(text)]
            at = end + 1 if end >= 0 else len(text)


def strip_hidden(root: Element, sheet: Sheet) -> None:
    """Take out what is not shown: elements that are never, are not displayed, or are hidden and hold nothing that is shown again.

    Visibility is inherited: a hidden element's texts go, and descendants that say `visible` stay.
    """

    def entered(e: Element, hidden: bool, drawing: bool) -> tuple[bool, bool] | None:
        """Whether what is in an element is hidden, and is part of a drawing; None if the element is not shown at all."""
        a = e.attributes
        if e.name in HIDDEN or (drawing and e.name in HIDDEN_IN_DRAWINGS) or (e.name == "dialog" and "open" not in a) or (e.name == "input" and a.get("type", "text").lower() == "hidden"):
            return None
        said = sheet.of(e)
        shown = said.get("display", "none" if "hidden" in a and a["hidden"].lower() != "until-found" else "")
        if shown == "none" or said.get("content-visibility") == "hidden":
            return None
        return {"visible": False, "hidden": True, "collapse": True}.get(said.get("visibility", ""), hidden), drawing or e.name in ("svg", "math")

    first = entered(root, False, False)
    if first is None:
        root.children = []
        return
    stack = [(root, iter(root.children), *first, [])]
    while stack:
        e, rest, hidden, drawing, kept = stack[-1]
        for c in rest:
            if isinstance(c, str):
                if not hidden:
                    kept.append(c)
            elif inside := entered(c, hidden, drawing):
                stack.append((c, iter(c.children), *inside, []))
                break
        else:
            stack.pop()
            e.children = kept
            if stack and (not hidden or kept):
                stack[-1][4].append(e)


def _elements(e: Element) -> Iterator[Element]:
    """All elements in an element, in the page's order."""
    stack = [iter(e.children)]
    while stack:
        for c in stack[-1]:
            if isinstance(c, Element):
                yield c
                stack.append(iter(c.children))
                break
        else:
            stack.pop()


def page_sheet(e: Element) -> Sheet:
    shown = lambda c, name, values: c.attributes.get(name, values[1]).strip().lower() in values
    return Sheet(["".join(t for t in c.children if isinstance(t, str)) for c in _elements(e) if c.name == "style" and shown(c, "media", ("", "all", "screen")) and shown(c, "type", ("", "text/css"))])


def width(text: str) -> int:
    return len(text) if text.isascii() else sum(0 if unicodedata.combining(c) else 2 if unicodedata.east_asian_width(c) in "WF" else 1 for c in text)


class Lines:
    """Lines being written: pending blank lines, an open line with collapsed spaces, and a margin."""

    def __init__(self):
        self.done: list[str] = []
        self.open: list[str] = []
        self.space = False
        self.blank = 0
        self.marker = ""  # waits for the first line of a list item

    def text(self, t: str, pre: bool = False) -> None:
        if pre:
            first, *rest = t.replace("\r\n", "\n").replace("\r", "\n").split("\n")
            self._put(first)
            for line in rest:
                self.line(keep=True)
                self._put(line)
            return
        words = _SPACE.split(t)
        for i, word in enumerate(words):
            if i:
                self.space = True
            if word:
                self._put(word)

    def _put(self, t: str) -> None:
        if not t:
            return
        if self.space and self.open:
            self.open.append(" ")
        self.space = False
        self.open.append(t)

    def line(self, keep: bool = False) -> None:
        """End the open line; keep also ends an empty one."""
        self.space = False
        if self.open or keep:
            if self.blank and self.done:
                self.done += [""] * self.blank
            self.blank = 0
            self.done.append("".join(self.open).rstrip())
            self.open = []

    def gap(self, n: int) -> None:
        self.line()
        self.blank = max(self.blank, n)

    def add(self, lines: list[str], before: str = "", after: str = "") -> None:
        """Lines of an inner block; `before` leads the first, `after` the others."""
        self.line()
        for i, t in enumerate(lines):
            if self.blank and self.done:
                self.done += [""] * self.blank
            self.blank = 0
            self.done.append(((before if i == 0 else after) + t).rstrip() if t or i == 0 else "")


def _number(k: int, kind: str) -> str:
    if kind in ("a", "A") and k > 0:
        out = ""
        while k > 0:
            k, r = divmod(k - 1, 26)
            out = chr(97 + r) + out
        return out.upper() if kind == "A" else out
    if kind in ("i", "I") and 0 < k < 4000:
        out = ""
        for v, s in ((1000, "m"), (900, "cm"), (500, "d"), (400, "cd"), (100, "c"), (90, "xc"), (50, "l"), (40, "xl"), (10, "x"), (9, "ix"), (5, "v"), (4, "iv"), (1, "i")):
            out += s * (k // v)
            k %= v
        return out.upper() if kind == "I" else out
    return str(k)


def _int(text: str | None, default: int) -> int:
    m = re.match(r"\s*([+-]?\d{1,9})", text or "")
    return int(m[1]) if m else default


def render(e: Element, out: Lines, pre: bool = False) -> None:
    """Write a visible element's content. Elements that are only opened and closed may nest to any depth; those with lines of their own (lists,
    tables, quotes) are written by themselves."""
    stack: list[tuple] = [(iter(e.children), pre, None)]
    end = object()

    def quoted() -> None:
        out.space = False
        out.text('"')

    def spaced() -> None:
        out.space = True

    while stack:
        children, pre, leave = stack[-1]
        child = next(children, end)
        if child is end:
            stack.pop()
            if leave:
                leave()
        elif isinstance(child, str):
            out.text(child, pre)
        elif child.name == "br":
            out.line(keep=True)
        elif child.name == "hr":
            out.gap(1)
            out.add(["---"])
            out.gap(1)
        elif child.name == "input":
            if child.attributes.get("type", "text").lower() in ("submit", "button", "reset", "text", "search", "email", "url", "tel", "number"):
                out.text(f" {child.attributes.get('value', '')} ")
        elif child.name == "select":
            options = [o for o in _inside(child, "option") if "selected" in o.attributes] or _inside(child, "option")[: 1 if "multiple" not in child.attributes else None]
            for o in options:
                render(o, out)
                out.text(" ")
        elif child.name == "table":
            out.gap(1)
            table(child, out, pre)
            out.gap(1)
        elif child.name in ("ul", "ol", "menu", "dir"):
            listing(child, out, pre)
        elif child.name == "details" and "open" not in child.attributes:
            for inner in child.children:
                if isinstance(inner, Element) and inner.name == "summary":
                    out.gap(0)
                    stack.append((iter(inner.children), pre, lambda: out.gap(0)))
                    break
        elif child.name in ("dd", "blockquote"):
            out.gap(BLOCKS[child.name])
            out.add(block(child, pre), "    ", "    ")
            out.gap(BLOCKS[child.name])
        elif child.name == "q":
            out.text('"')
            stack.append((iter(child.children), pre, quoted))
        elif child.name in BLOCKS:
            out.gap(BLOCKS[child.name])
            inner_pre = pre or child.name in ("pre", "listing", "xmp", "plaintext", "textarea")
            if inner_pre and not pre and child.children and isinstance(child.children[0], str):
                child.children[0] = re.sub(r"^\r?\n", "", child.children[0], count=1)
            stack.append((iter(child.children), inner_pre, lambda n=BLOCKS[child.name]: out.gap(n)))
        elif child.name in ("textarea", "button"):
            out.space = True
            stack.append((iter(child.children), pre or child.name == "textarea", spaced))
        else:
            stack.append((iter(child.children), pre, None))


def block(e: Element, pre: bool = False) -> list[str]:
    """The lines of an element by itself, without blank lines at its ends."""
    own = Lines()
    render(e, own, pre)
    own.line()
    lines = own.done
    while lines and not lines[-1]:
        lines.pop()
    while lines and not lines[0]:
        lines.pop(0)
    return lines


def _inside(e: Element, name: str) -> list[Element]:
    """The elements of a name in an element, without those that are in another of them."""
    found, stack = [], [iter(e.children)]
    while stack:
        for c in stack[-1]:
            if isinstance(c, Element):
                if c.name == name:
                    found.append(c)
                else:
                    stack.append(iter(c.children))
                    break
        else:
            stack.pop()
    return found


def _indented(e: Element) -> int:
    """How deep elements that are written by themselves are nested."""
    deepest, stack = 0, [(iter(e.children), 0)]
    while stack:
        children, depth = stack[-1]
        for c in children:
            if isinstance(c, Element):
                inner = depth + (c.name in OWN_LINES)
                deepest = max(deepest, inner)
                stack.append((iter(c.children), inner))
                break
        else:
            stack.pop()
    return deepest


def listing(e: Element, out: Lines, pre: bool) -> None:
    items = [c for c in e.children if isinstance(c, Element) and c.name == "li"]
    down = "reversed" in e.attributes
    k = _int(e.attributes.get("start"), len(items) if down else 1)
    out.gap(1)
    for child in e.children:
        if isinstance(child, Element) and child.name == "li":
            if e.name == "ol":
                k = _int(child.attributes.get("value"), k)
                mark = f"{_number(k, child.attributes.get('type', e.attributes.get('type', '1')))}. "
                k += -1 if down else 1
            else:
                mark = "- "
            inner = block(child, pre)
            out.add(_tight(inner) or [""], mark, " " * len(mark))
        else:
            wrap = Element("div", {})
            wrap.children = [child]
            if inner := block(wrap, pre):
                out.add(inner, "  ", "  ")
    out.gap(1)


def _tight(lines: list[str]) -> list[str]:
    """No blank line before a nested list in an item."""
    return [t for i, t in enumerate(lines) if t or not (i + 1 < len(lines) and re.match(r"\s*(-|\w+\.) ", lines[i + 1]))]


def table(e: Element, out: Lines, pre: bool) -> None:
    """Cells in columns as wide as their widest line, parted by ` | `; a cell that spans columns takes their width, one that spans rows leaves
    blanks below. Content outside of rows comes before the rows, captions first."""
    rows: list[list[Element]] = []
    heads: list[list[Element]] = []
    feet: list[list[Element]] = []

    def gather(node: Element, into: list) -> None:
        for c in node.children:
            if isinstance(c, str):
                if c.strip():
                    out.text(c)
                    out.line()
            elif c.name == "tr":
                cells = []
                for d in c.children:
                    if isinstance(d, Element) and d.name in ("td", "th"):
                        cells.append(d)
                    elif isinstance(d, Element) or d.strip():
                        own = Element("td", {})
                        own.children = [d]
                        cells.append(own)
                into.append(cells)
            elif c.name in ("thead", "tbody", "tfoot"):
                gather(c, {"thead": heads, "tfoot": feet}.get(c.name, rows))
            elif c.name == "caption":
                out.add(block(c, pre))
            elif c.name not in ("colgroup", "col"):
                wrap = Element("div", {})
                wrap.children = [c]
                out.add(block(wrap, pre))

    gather(e, rows)
    above: list[list[int]] = []  # [start, end, rows to come] of cells that reach down into the next row, in order, apart from each other
    grid: list[list[tuple[int, int, list[str]]]] = []  # (first column, column after the last, lines)
    for row in heads + rows + feet:
        at, line, held, reach = 0, [], 0, []
        for cell in row:
            while held < len(above) and above[held][0] <= at:
                at = max(at, above[held][1])
                held += 1
            wide = min(1000, max(1, _int(cell.attributes.get("colspan"), 1)))
            deep = min(65534, max(1, _int(cell.attributes.get("rowspan"), 1)))
            line.append((at, at + wide, block(cell, pre)))
            if deep > 1:
                reach.append([at, at + wide, deep - 1])
            at += wide
        # where a wide cell runs over one that reaches down, both keep their columns and the longer reach holds
        above = _apart(sorted([s, t, n - 1] for s, t, n in above if n > 1) + reach)
        grid.append(line)
    # columns between two neighbouring edges of cells are as one; they are numbered by their place among all edges
    edges = {x: i for i, x in enumerate(sorted({x for line in grid for s, t, _ in line for x in (s, t)}))}
    grid = [[(edges[s], edges[t], text) for s, t, text in line] for line in grid]
    size = max(len(edges) - 1, 0)
    gaps = [b - a for a, b in zip(edges, list(edges)[1:], strict=False)]  # plain columns in each
    widths = [0] * size
    for spans in (False, True):
        for line in grid:
            for s, t, text in line:
                if (sum(gaps[s:t]) > 1) == spans and any(text):
                    filled = [k for k in range(s, t) if widths[k]]
                    need = max(map(width, text)) - sum(widths[k] for k in filled) - 3 * (len(filled) - 1)
                    if not filled:
                        widths[s] = need - 3
                    elif need > 0:
                        widths[filled[-1]] += need
    used = [k for k in range(size) if widths[k]]
    sums = [0]
    for k in used:
        sums.append(sums[-1] + widths[k])
    for line in grid:
        cells, at = [], 0  # (room, lines) from left to right; columns without a cell are blank
        for s, t, text in sorted(line, key=lambda c: c[0]):
            lo, hi = bisect_left(used, s), bisect_left(used, t)
            cells += [(widths[k], []) for k in used[at:lo]]
            if max(lo, at) < hi:
                cells.append((sums[hi] - sums[max(lo, at)] + 3 * (hi - max(lo, at) - 1), text))
            at = max(at, hi)
        cells += [(widths[k], []) for k in used[at:]]
        for i in range(max((len(text) for _, text in cells), default=0)):
            out.add([" | ".join((text[i] if i < len(text) else "") + " " * (room - (width(text[i]) if i < len(text) else 0)) for room, text in cells)])


def _apart(spans: list[list[int]]) -> list[list[int]]:
    """Spans [start, end, rows] as spans in order that do not overlap; where some do, the most rows count."""
    spans.sort()
    if all(a[1] <= b[0] for a, b in zip(spans, spans[1:], strict=False)):
        return spans
    out: list[list[int]] = []
    points = sorted({x for s in spans for x in s[:2]})
    waiting, k = [], 0  # (-rows, end) of the spans that have begun
    for lo, hi in zip(points, points[1:], strict=False):
        while k < len(spans) and spans[k][0] <= lo:
            heappush(waiting, (-spans[k][2], spans[k][1]))
            k += 1
        while waiting and waiting[0][1] <= lo:
            heappop(waiting)
        if waiting:
            out.append([lo, hi, -waiting[0][0]])
    return out


def page_text(page: str | None) -> str:
    """The visible text of a page; a null or empty one has none."""
    if not page:
        return ""
    root = parse(page.replace("\0", ""))
    strip_hidden(root, page_sheet(root))
    # calls of Python functions are no deeper than lists, tables and quotes are nested, and need no C stack
    sys.setrecursionlimit(max(sys.getrecursionlimit(), 1000 + 6 * _indented(root)))
    return "\n".join(block(root))


def extract(pages: DataFrame) -> DataFrame:
    """page_id, text, n_lines of every row of pages (page_id, html).

    A null or empty html, and a page without visible text, give an empty text. Every row stays, repeated ones too; other columns
    of pages do not matter. Pages are rendered one by one, whole.
    """

    ship(pages.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, batch.num_rows, 64):
                part = batch.slice(lo, 64)
                texts = [page_text(h) for h in part.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(texts, pa.string()), pa.array([t.count("\n") + 1 if t else 0 for t in texts], pa.int64())], names=["page_id", "text", "n_lines"])

    return pages.select(F.col("page_id").cast("long"), F.col("html").cast("string")).mapInArrow(run, "page_id long, text string, n_lines long")
