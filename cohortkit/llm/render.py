"""Layout-aware rendering of HTML pages to text.

A tree builder reads the page: it implies ``html``, ``head`` and ``body``,
closes paragraphs, list items, table parts and options where a start tag
implies it, and lets an end tag close what was left open inside its element.
The renderer then walks the tree and emits all visible text: blocks on lines
of their own with blank lines where a page shows a margin, list items with
markers and indents, preformatted text as it stands, table cells in aligned
columns, and the text of formulas, drawings and image maps.

Not visible: the head, scripts, styles, templates, ``hidden`` elements and closed
dialogs that no style shows, ``display: none``, what has ``visibility: hidden``,
the closed part of ``details``, lists of suggestions, what stands in for frames,
media and scripts a browser runs; of a drawing its title, description and
metadata; of a formula its annotations, phantoms and all but the first form of
``semantics`` and ``maction``.

Styles are the page's own sheets and ``style`` attributes, read as a screen
``SCREEN`` pixels wide does: by importance, specificity and order; ``visibility``
is inherited and may be set anew.  Selectors of tags, classes, ids, attributes and
``:not``, below one another by blank or ``>``; rules with any other selector are
passed over, as they depend on siblings or on what a reader does.

Defined results: NULL stays NULL, an empty page or one without visible text
gives an empty string; broken markup never fails; nesting beyond ``MAX_DEPTH``
levels is read as if its elements stood side by side; tables nested deeper than
``TABLES`` keep their text but not their columns.  Every page is rendered
in place, whole.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortkit.llm.common import with_column

MAX_DEPTH = 400
MAX_COLSPAN, MAX_ROWSPAN = 1_000, 65_534  # HTML's own limits
MAX_START = (1 << 31) - 1  # likewise: a list that starts beyond starts at 1
PAD = 80  # cells wider than this do not widen their column
TABLES = 6  # tables nested deeper are rendered as plain blocks
SCREEN = 1280  # width that styles are chosen for

#: Element groups of HTML.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
HEAD = frozenset("base basefont link meta noscript script style template title".split())
UNSEEN = frozenset("head script style template title noscript iframe noembed noframes datalist object audio video canvas "
                   "param".split())
FOREIGN = frozenset("svg math foreignobject".split())
FOREIGN_UNSEEN = {"svg": frozenset("title desc metadata".split()),
                  "math": frozenset("annotation annotation-xml mphantom".split()), "foreignobject": frozenset()}
BLOCK = frozenset("address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure "
                  "footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre "
                  "search section summary table ul xmp caption thead tbody tfoot tr td th select".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure hr fieldset menu dir xmp".split())
CLOSES_P = (BLOCK - frozenset("body html option optgroup caption thead tbody tfoot tr td th select legend".split()))
#: Parts of drawings and formulas that stand at a place of their own.
APART = {"svg": frozenset(["text"]), "math": frozenset(["mtd", "mfrac"])}
#: Start tag -> open elements it closes, up to one of the bounds.
IMPLIED = {
    "li": (("li",), ("ul", "ol", "menu", "dir")),
    "dt": (("dt", "dd"), ("dl",)),
    "dd": (("dt", "dd"), ("dl",)),
    "option": (("option",), ("select", "datalist")),
    "optgroup": (("option", "optgroup"), ("select",)),
    "td": (("td", "th"), ("table", "tr")),
    "th": (("td", "th"), ("table", "tr")),
    "tr": (("tr",), ("table",)),
    "thead": (("thead", "tbody", "tfoot", "caption", "colgroup"), ("table",)),
    "tbody": (("thead", "tbody", "tfoot", "caption", "colgroup"), ("table",)),
    "tfoot": (("thead", "tbody", "tfoot", "caption", "colgroup"), ("table",)),
}

# quoted attribute values may hold ">"; with a quote left open the tag ends at the next one
_MARKUP = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+(?=>)|[^>]*)>", re.S)
_ATTRIBUTE = re.compile(r"([^\s=/\"'<>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_STYLE_MARK = re.compile(r"[{};]|\"[^\"]*\"|'[^']*'")
_STYLE_COMMENT = re.compile(r"/\*.*?(?:\*/|\Z)", re.S)
_DECLARATION = re.compile(r"\s*(display|visibility)\s*:\s*([a-z][a-z -]*?)\s*(!\s*important)?\s*\Z", re.I)
_WIDTH = re.compile(r"(min|max)-width\s*:\s*([0-9.]+)(px|em|rem)\Z")
_SIMPLE = re.compile(r"(?P<tag>\*|[A-Za-z][\w-]*)|\.(?P<cls>-?[A-Za-z_][\w-]*)|#(?P<id>[\w-]+)"
                     r"|\[\s*(?P<attr>[\w-]+)\s*(?:(?P<op>[~^$*]?=)\s*(?P<value>\"[^\"]*\"|'[^']*'|[^\s\"'\]]+)\s*)?\]"
                     r"|:not\(\s*(?P<no>[^()]*?)\s*\)")
_COMBINATOR = re.compile(r"\s*(>)\s*|\s+")
_UNQUOTED_SLASH = re.compile(r"=\s*[^\s\"']*/\Z")  # belongs to the value, closes nothing
_INTEGER = re.compile(r"[ \t\n\r\f]*([+-]?)(?=[0-9])0*([0-9]*)")
_SPACE = re.compile(r"[ \t\n\r\f]+")


class Element:
    __slots__ = ("attrs", "children", "name", "parent")

    def __init__(self, name: str, attrs: dict[str, str]):
        self.name, self.attrs, self.children, self.parent = name, attrs, [], None


def _attributes(source: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in _ATTRIBUTE.finditer(source):
        value = m[2] if m[2] is not None else m[3] if m[3] is not None else m[4] or ""
        found.setdefault(m[1].lower(), html.unescape(value) if "&" in value else value)
    return found


class TreeBuilder:
    """Elements and text of a page, with the tags a browser would imply."""

    def __init__(self, page: str):
        self.root = Element("html", {})
        self.open: list[Element] = [self.root]
        self.styles: list[str] = []
        self.body_seen = False
        at, last = 0, page.rfind(">") + 1
        while at < len(page):
            m = _MARKUP.search(page, at, last) if at < last else None
            if m is None:
                self._text(page[at:])
                break
            if m.start() > at:
                self._text(page[at:m.start()])
            at = m.end()
            if m[2] is None:
                continue
            name = m[2].lower()
            if m[1]:
                self._end(name)
                continue
            attrs = _attributes(m[3]) if m[3].strip(" \t\n\r\f/") else {}
            if m[3][-1:] == "/" and not _UNQUOTED_SLASH.search(m[3]) and (name in FOREIGN or self._in_foreign()):
                self._empty(name, attrs)
                continue
            self._start(name, attrs)
            if name in RAW:
                close = re.compile(f"</{re.escape(name)}(?=[\\s/>])[^>]*>", re.I).search(page, at)
                body = page[at:close.start() if close else len(page)]
                at = close.end() if close else len(page)
                if name == "style":
                    if _on_screen(attrs.get("media", "")):
                        self.styles.append(body)
                elif name == "textarea" or name == "xmp":
                    self.open[-1].children.append(html.unescape(body) if name == "textarea" else body)
                self._end(name)

    def _in_foreign(self) -> bool:
        return next((e.name for e in reversed(self.open) if e.name in FOREIGN), "foreignobject") != "foreignobject"

    def _empty(self, name: str, attrs: dict[str, str]) -> None:
        """``<name/>`` of a drawing or formula."""
        if not self.body_seen:
            self._body()
        self._push(Element(name, attrs), stays=False)

    def _body(self) -> None:
        if not self.body_seen:
            self.body_seen = True
            while len(self.open) > 1:
                self.open.pop()
            self._push(Element("body", {}))

    def _push(self, element: Element, stays: bool = True) -> None:
        element.parent = self.open[-1]
        self.open[-1].children.append(element)
        if stays:
            self.open.append(element)

    def _close(self, names, bounds) -> None:
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth].name in names:
                del self.open[depth:]
                return
            if self.open[depth].name in bounds:
                return

    def _start(self, name: str, attrs: dict[str, str]) -> None:
        if name == "html":
            self.root.attrs = {**attrs, **self.root.attrs}
            return
        if name == "head":
            if not self.body_seen and len(self.open) == 1:
                self._push(Element("head", attrs))
            return
        if name == "body":
            self._body()
            self.open[1].attrs = {**attrs, **self.open[1].attrs}
            return
        if not self.body_seen and not (name in HEAD and (len(self.open) == 1 or self.open[1].name == "head")):
            self._body()
        if name in CLOSES_P:
            self._close(("p",), ("table", "td", "th", "button", "object", "caption", "li", "div"))
        if name in IMPLIED:
            names, bounds = IMPLIED[name]
            self._close(names, bounds)
            if name in ("tr", "thead", "tbody", "tfoot"):
                self._close(("caption", "colgroup"), ("table",))
            if name == "tr" and self.open[-1].name == "table":
                self._push(Element("tbody", {}))
            if name in ("td", "th") and self.open[-1].name in ("table", "tbody", "thead", "tfoot"):
                self._start("tr", {})
        if name in ("thead", "tbody", "tfoot"):
            self._close(("tr",), ("table",))
        if name[0] == "h" and len(name) == 2 and self.open[-1].name[0] == "h" and self.open[-1].name[1:].isdigit() \
                and name[1].isdigit():
            self.open.pop()
        self._push(Element(name, attrs), name not in VOID and len(self.open) < MAX_DEPTH)

    def _end(self, name: str) -> None:
        if name in ("html", "body"):
            return
        if name == "br":
            self._start("br", {})
            return
        if name == "p" and not any(e.name == "p" for e in self.open):
            self._start("p", {})
        # a cell's or item's end tags do not reach out of its table or list
        bounds = () if name in ("table", "ul", "ol") else ("table",) if name in ("tr", "td", "th", "tbody", "thead", "tfoot") \
            else ("td", "th", "table") if name not in BLOCK else ("table",)
        self._close((name,), bounds)

    def _text(self, text: str) -> None:
        if not self.body_seen:
            if not text.strip(" \t\n\r\f"):
                return
            self._body()
        self.open[-1].children.append(html.unescape(text) if "&" in text else text)


def _on_screen(media: str) -> bool:
    """Whether a media query holds for a screen ``SCREEN`` pixels wide."""
    return not media.strip() or any(_query_holds(q) for q in media.lower().split(","))


def _query_holds(query: str) -> bool:
    negated = query.strip().startswith("not ")
    holds = True
    for part in re.split(r"\band\b", query.strip().removeprefix("not ").removeprefix("only ")):
        part = part.strip().strip("()").strip()
        width = _WIDTH.match(part)
        if width:
            try:
                at = float(width[2]) * (1 if width[3] == "px" else 16)
            except ValueError:
                return False
            holds = holds and (at <= SCREEN if width[1] == "min" else at >= SCREEN)
        else:
            holds = holds and part in ("screen", "all", "", "orientation: landscape", "orientation:landscape")
    return holds != negated


def _style_rules(sheet: str) -> Iterator[tuple[str, list[str]]]:
    """(selector list, declarations) of each rule a screen applies, in order."""
    sheet = _STYLE_COMMENT.sub(" ", sheet)
    around: list = []  # open braces: a rule as a pair, a group as whether its rules apply
    at = 0
    for m in _STYLE_MARK.finditer(sheet):
        if len(m[0]) > 1:
            continue
        part, at = sheet[at:m.start()].strip(), m.end()
        top = around[-1] if around else True
        if m[0] == "{":
            if part[:1] != "@" and top is True:
                around.append((part, []))
            else:  # a rule inside a rule belongs to another element
                around.append(top is True and (part[:9].lower() == "@supports" or part[:6].lower() == "@layer"
                                               or (part[:6].lower() == "@media" and _on_screen(part[6:]))))
            continue
        if isinstance(top, tuple):
            top[1].append(part)
        if m[0] == "}" and around:
            around.pop()
            if isinstance(top, tuple):
                yield top
    if around and isinstance(around[-1], tuple):  # the sheet ends within a rule
        yield around[-1][0], [*around[-1][1], sheet[at:]]


def _compound(source: str, at: int) -> tuple[list, int]:
    """Tests of the compound selector at ``at`` and where it ends."""
    tests = []
    while m := _SIMPLE.match(source, at):
        if m["tag"] and tests:
            break
        at = m.end()
        if m["no"] is not None:
            inner, end = _compound(m["no"], 0)
            if not inner or end < len(m["no"]):
                return [], at
            tests.append(("no", inner, None))
        elif m["attr"]:
            value = (m["value"] or "").strip("\"'")
            tests.append(("attr", m["attr"].lower(), (m["op"], value)))
        else:
            tests.append((m.lastgroup, m["tag"].lower() if m["tag"] else m["cls"] or m["id"], None))
    return tests, at


def _selector(source: str) -> tuple[list, list] | None:
    """Compounds and the combinators between them, or None if any part is unknown."""
    compounds, joins, at = [], [], 0
    while True:
        tests, at = _compound(source, at)
        if not tests:
            return None
        compounds.append(tests)
        if at == len(source):
            return compounds, joins
        m = _COMBINATOR.match(source, at)
        if m is None:
            return None
        joins.append(m[1] or " ")
        at = m.end()


def _weight(tests: list) -> tuple[int, int, int]:
    ids = classes = tags = 0
    for kind, value, _ in tests:
        if kind == "no":
            i, c, t = _weight(value)
            ids, classes, tags = ids + i, classes + c, tags + t
        elif kind == "tag":
            tags += value != "*"
        else:
            ids, classes = ids + (kind == "id"), classes + (kind != "id")
    return ids, classes, tags


def _fits(e: Element, tests: list) -> bool:
    for kind, value, more in tests:
        if kind == "tag":
            ok = value == "*" or e.name == value
        elif kind == "cls":
            ok = value in e.attrs.get("class", "").split()
        elif kind == "id":
            ok = e.attrs.get("id") == value
        elif kind == "no":
            ok = not _fits(e, value)
        else:
            has, (op, want) = e.attrs.get(value), more
            ok = has is not None and (op is None or (op == "=" and has == want) or (op == "~=" and want in has.split()) or bool(want) and (
                (op == "^=" and has.startswith(want)) or (op == "$=" and has.endswith(want)) or (op == "*=" and want in has)))
        if not ok:
            return False
    return True


def _walk(e: Element | None, compounds: list, joins: list) -> tuple[list, list]:
    """One walk down from the root to ``e``: which prefixes of the selector end above or
    at it, and which at it."""
    path = []
    while e is not None:
        path.append(e)
        e = e.parent
    above, here = [False] * len(compounds), [False] * len(compounds)
    for node in reversed(path):
        above, here = _below(node, compounds, joins, above, here)
    return above, here


def _below(node: Element, compounds: list, joins: list, above: list, parent: list) -> tuple[list, list]:
    here = [(not i or (above if joins[i - 1] == " " else parent)[i - 1]) and _fits(node, tests)
            for i, tests in enumerate(compounds)]
    return [a or h for a, h in zip(above, here)], here


class Styles:
    """``display`` and ``visibility`` as a page's sheets set them."""

    def __init__(self, sheets: list[str]):
        self.rules: dict[tuple, list] = {}  # by an id, class or tag the element itself must have
        self.parent, self.walks = None, {}  # what the last element's rules found above it, for its siblings
        order = 0
        for sheet in sheets:
            for selectors, declarations in _style_rules(sheet):
                found = [m for m in map(_DECLARATION.match, declarations) if m]
                if not found:
                    continue
                for source in re.split(r",(?![^(\[]*[)\]])", selectors):
                    parsed = _selector(source.strip())
                    if parsed is None:
                        continue
                    weight = tuple(map(sum, zip(*map(_weight, parsed[0]))))
                    own = [t[:2] for t in parsed[0][-1] if t[0] in ("id", "cls", "tag")]
                    key = min(own, key=lambda t: ("id", "cls", "tag").index(t[0]), default=("tag", "*"))
                    for m in found:
                        order += 1
                        self.rules.setdefault(key, []).append(
                            (m[1].lower(), m[2].lower(), (bool(m[3]), False, weight, order), parsed))

    def of(self, e: Element) -> tuple[str | None, str | None]:
        best: dict[str, tuple] = {}
        if self.rules:
            keys = [("tag", "*"), ("tag", e.name)]
            if e.attrs:
                keys += [("cls", c) for c in set(e.attrs.get("class", "").split())] + [("id", e.attrs.get("id"))]
            for key in keys:
                for name, value, rank, parsed in self.rules.get(key, ()):
                    if (name not in best or rank > best[name][0]) and self._matches(e, *parsed):
                        best[name] = (rank, value)
        if e.attrs and "style" in e.attrs:
            for i, part in enumerate(e.attrs["style"].split(";")):
                m = _DECLARATION.match(part)
                if m:
                    name, rank = m[1].lower(), (bool(m[3]), True, (0, 0, 0), i)
                    if name not in best or rank > best[name][0]:
                        best[name] = (rank, m[2].lower())
        return tuple(best[name][1] if name in best else None for name in ("display", "visibility"))

    def _matches(self, e: Element, compounds: list, joins: list) -> bool:
        if not _fits(e, compounds[-1]):
            return False
        if not joins:
            return True
        if self.parent is not e.parent:
            self.parent, self.walks = e.parent, {}
        state = self.walks.get(id(compounds))
        if state is None:
            state = self.walks[id(compounds)] = _walk(e.parent, compounds, joins)
        return _below(e, compounds, joins, *state)[1][-1]


def _shown(e: Element, styles: Styles, inherited: bool) -> bool | None:
    """Whether the element's own text is shown; None if the element is not there at all."""
    if e.name in UNSEEN or (e.name == "input" and e.attrs.get("type", "").lower() == "hidden"):
        return None
    display, visibility = styles.of(e)
    if display == "none" or (display is None and (
            "hidden" in e.attrs or (e.name == "dialog" and "open" not in e.attrs))):
        return None
    return inherited if visibility in (None, "inherit", "unset") else visibility not in ("hidden", "collapse")


class Flow:
    """Lines under construction: inline text is collapsed, blocks break lines."""

    def __init__(self):
        self.lines: list[str] = []
        self.inline: list[str] = []
        self.indent = 0
        self.marker = ""
        self.gap = False

    def text(self, text: str, preformatted: bool) -> None:
        if not preformatted:
            self.inline.append(text)
            return
        first, *rest = text.replace("\r\n", "\n").split("\n")
        self.inline.append("\0" + first)
        for line in rest:
            self._line(keep=True)
            self.inline.append("\0" + line)

    def _line(self, keep: bool = False) -> None:
        raw = "".join(self.inline)
        self.inline = []
        body = raw.replace("\0", "").rstrip() if "\0" in raw else _SPACE.sub(" ", raw).strip(" ")
        if not body and not keep:
            return
        if self.gap and self.lines and body:
            self.lines.append("")
        self.gap = self.gap and not body
        pad = " " * (2 * min(self.indent, 20))
        if self.marker and body:
            pad, self.marker = pad[:-2] + self.marker, ""
        self.lines.append(pad + body if body else "")

    def newline(self) -> None:
        self._line(keep=bool(self.inline))

    def block(self, spaced: bool) -> None:
        self._line()
        self.gap = self.gap or spaced

    def finish(self) -> list[str]:
        self._line()
        while self.lines and not self.lines[-1]:
            self.lines.pop()
        return self.lines


def _integer(value: str | None, default: int) -> int:
    """The integer that ``value`` begins with, as HTML reads it."""
    m = _INTEGER.match(value or "")
    if m is None:
        return default
    return int(m[1] + (m[2][:20] or "0"))


def _span(value: str | None, most: int) -> int:
    return min(most, max(1, _integer(value, 1)))


def _number_in(value: str | None, default: int) -> int:
    """The number of a list item that ``value`` sets, if it is one."""
    number = _integer(value, default)
    return number if abs(number) <= MAX_START else default


def _table_lines(rows: list[list[tuple[list[str], int, int]]]) -> list[str]:
    """Rows of cells (lines, colspan, rowspan) in aligned columns, two blanks apart."""
    placed: list[dict[int, tuple[list[str], int]]] = []
    taken: list[tuple[int, int, int]] = []  # columns [from, to) that cells from above hold, up to a row
    for y, row in enumerate(rows):
        cells, x, i, more = {}, 0, 0, []
        for lines, across, down in row:
            while i < len(taken) and taken[i][0] <= x:
                x = max(x, taken[i][1])
                i += 1
            cells[x] = (lines, across)
            last = min(y + down, len(rows))
            if last > y + 1:
                if more and more[-1][1:] == (x, last):
                    more[-1] = (more[-1][0], x + across, last)
                else:
                    more.append((x, x + across, last))
            x += across
        placed.append(cells)
        if taken or more:
            taken = sorted([t for t in taken if t[2] > y + 1] + more)
    width: dict[int, int] = {}
    for cells in placed:
        for x, (lines, across) in cells.items():
            if across == 1:
                width[x] = max(width.get(x, 0), max((len(s) for s in lines if len(s) <= PAD), default=0))
    used = sorted({x for cells in placed for x, (lines, _) in cells.items() if lines} | {x for x, w in width.items() if w})
    start, at = {}, 0
    for x in used:
        start[x] = at
        at += width.get(x, 0) + 2
    out = []
    for cells in placed:
        shown = [(start[x], lines) for x, (lines, _) in sorted(cells.items()) if lines]
        for i in range(max((len(lines) for _, lines in shown), default=0)):
            line = ""
            for left, lines in shown:
                if i < len(lines) and lines[i]:
                    line = (line.ljust(left) if len(line) < left else line + "  " if line.strip() else line) + lines[i]
            out.append(line.rstrip())
    return out


def render(page: str | None) -> str | None:
    """The visible text of an HTML page."""
    if page is None:
        return None
    tree = TreeBuilder(page)
    styles = Styles(tree.styles)
    flows, tables, lists, foreign = [Flow()], [], [], []
    todo: list = [(tree.root, False, False, True)]
    while todo:
        node, leaving, pre, shown = todo.pop()
        flow = flows[-1]
        if isinstance(node, str):
            if shown and not (tables and tables[-1] is flow and not node.strip()):
                flow.text(node, pre)
            continue
        name = node.name
        in_table = bool(tables) and len(tables) <= TABLES
        kind = foreign[-1] if foreign else ""
        if leaving:
            if name in FOREIGN:
                foreign.pop()
            if name in APART.get(kind, ()):
                flow.text(" ", False)
            if name in ("ul", "ol", "menu", "dir"):
                flow.indent -= 1
                lists.pop()
                flow.block(not lists)
            elif name == "li":
                flow.block(False)
                flow.marker = ""
            elif name in ("dd", "blockquote"):
                flow.block(name in SPACED)
                flow.indent -= 1
            elif name in ("td", "th") and in_table:
                lines = flows.pop().finish()
                rows = tables[-1]
                if not rows:
                    rows.append([])
                rows[-1].append((lines, _span(node.attrs.get("colspan"), MAX_COLSPAN),
                                 _span(node.attrs.get("rowspan"), MAX_ROWSPAN)))
            elif name == "table":
                rows = tables.pop()
                flow.block(True)
                for line in _table_lines(rows) if rows else ():
                    flow.text(line, True)
                    flow.newline()
                flow.gap = True
            elif name in BLOCK:
                flow.block(name in SPACED)
            continue
        shown = _shown(node, styles, shown)
        if shown is None or (kind and name in FOREIGN_UNSEEN[kind]):
            continue
        if name in FOREIGN:
            foreign.append(name)
        if name in APART.get(kind, ()):
            flow.text(" ", False)
        if name == "br":
            flow.newline()
            continue
        if name in VOID:
            if name == "hr":
                flow.block(True)
            elif shown and name == "input" and node.attrs.get("type", "").lower() in ("submit", "button", "reset"):
                flow.text(node.attrs.get("value", ""), False)
            continue
        if name in BLOCK and not (name in ("td", "th", "tr", "thead", "tbody", "tfoot") and in_table):
            flow.block(name in SPACED and not (name in ("ul", "ol", "menu", "dir") and lists))
        if name in ("ul", "ol", "menu", "dir"):
            flow.indent += 1
            back = name == "ol" and "reversed" in node.attrs
            items = sum(isinstance(c, Element) and c.name == "li" for c in node.children) if back else 1
            lists.append([name, _number_in(node.attrs.get("start"), items) - (-1 if back else 1), -1 if back else 1])
        elif name == "li":
            if lists and lists[-1][0] == "ol":
                lists[-1][1] = _number_in(node.attrs.get("value"), lists[-1][1] + lists[-1][2])
                flow.marker = f"{lists[-1][1]}. "
            else:
                flow.marker = "- "
        elif name in ("dd", "blockquote"):
            flow.indent += 1
        elif name == "table":
            tables.append([])
        elif name == "tr" and in_table:
            tables[-1].append([])
        elif name in ("td", "th") and in_table:
            flows.append(Flow())
        todo.append((node, True, pre, shown))
        keep = pre or name in ("pre", "textarea", "xmp")
        children = node.children
        if name == "details" and "open" not in node.attrs:
            children = [c for c in children if isinstance(c, Element) and c.name == "summary"][:1]
        if kind == "math" and name in ("semantics", "maction"):
            children = [c for c in children if isinstance(c, Element)][:1]
        elif kind == "math" and name == "mfrac":
            children = [part for c in children for part in (" ", c)]
        if in_table and name in ("table", "tr", "thead", "tbody", "tfoot"):
            children = [c for c in children if not isinstance(c, str) or c.strip()]
        if name == "pre" and children and isinstance(children[0], str) and children[0][:1] == "\n":
            children = [children[0][1:], *children[1:]]
        todo.extend((c, False, keep, shown) for c in reversed(children))
    return "\n".join(flows[0].finish())


def rendered(pages: DataFrame, source: str = "html", name: str = "text") -> DataFrame:
    """``pages`` with the visible text of ``source`` in column ``name``."""
    kept = pages.select(*[c for c in pages.columns if c not in (source, name)], F.col(source).alias(source))

    def run(values):
        return [None if v is None else render(v.decode("utf-8", "replace")) for v in values]

    return with_column(kept, source, name, T.StringType(), run)
