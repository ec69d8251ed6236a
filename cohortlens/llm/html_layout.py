"""Layout-aware rendering of HTML as plain text.

A scanner and a tree builder (void elements, implied end tags, implied rows,
raw text) make a tree; a walk over it writes the text that a reader sees:
invisible elements, `hidden`, and what the style attribute or the page's own
style sheets hide on a screen (see `css_cascade`) are left out, closed `details`
show their summary, paragraphs and headings stand apart by an empty line,
list boxes show all options and formulas their text, lists get markers and indents, table cells are aligned in columns, and
preformatted text keeps its white space. The page's own `display` and
`white-space` rules go before the elements' usual ones: a span shown as a block
has its own lines, a list item shown inline has no marker, items of a flex or
grid box and form fields stand apart by a space. No text is cut: a cell or an indent
beyond `WIDE` or `DEEP` only stops to widen the layout.

Null and empty pages give an empty text. No recursion follows the nesting of
the page, so pages may be nested and long as they like.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Generator, Iterator

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortlens.llm.css_cascade import ASKED, Sheet, on_screen, relate

WIDE = 60
DEEP = 16

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes noscript".split())
UNSEEN = frozenset("head title script style template noscript iframe noembed noframes datalist audio video canvas object colgroup col".split())
IN_HEAD = frozenset("head title meta link style script base noscript template html".split())
BLOCKS = frozenset("address article aside body center dd details dialog div dt fieldset figcaption figure footer form header hgroup html legend li main menu nav option optgroup search section summary tr tbody thead tfoot caption td th".split())
APART = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl table blockquote pre figure hr fieldset xmp".split())
CLOSES_P = BLOCKS - {"body", "html", "option", "optgroup", "tr", "tbody", "thead", "tfoot", "td", "th", "caption", "legend"} | APART
#: start tag: (open elements it ends, elements beyond which it doesn't look)
IMPLIED_END = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
    "td": ({"td", "th", "caption"}, {"tr", "table"}), "th": ({"td", "th", "caption"}, {"tr", "table"}), "tr": ({"tr", "td", "th", "caption"}, {"table"}),
    **dict.fromkeys(("thead", "tbody", "tfoot"), ({"thead", "tbody", "tfoot", "tr", "td", "th", "caption"}, {"table"})),
    "option": ({"option"}, {"select", "optgroup"}), "optgroup": ({"option", "optgroup"}, {"select"}), "body": ({"head"}, {"html"}),
}
SCOPE = frozenset("table td th caption button".split())

QUOTE_OR_END = re.compile(r"[>\"']")
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s>]*)))?""")
SPACE = re.compile(r"[ \t\n\f\r]+")
BLANKS = re.compile(r"[ \t\f\r]+")
FIELDS = frozenset("input button select textarea".split())


class Node:
    __slots__ = ("at", "attributes", "children", "formula", "kin", "name", "parent", "shape", "white")

    def __init__(self, name: str, attributes: dict[str, str]):
        self.name, self.attributes, self.children = name, attributes, []
        self.parent = self.kin = None
        self.formula = False  # within <math>
        self.shape = self.white = ""  # what the page's rules make of it, set by `shown`


def scan(page: str) -> Iterator[tuple[str, str, str]]:
    """("text", text, ""), ("start", name, attributes) or ("end", name, "")."""
    at, size, unclosed = 0, len(page), set()
    while at < size:
        tag = page.find("<", at)
        if tag < 0:
            tag = size
        if tag > at:
            yield "text", page[at:tag], ""
        if tag == size:
            return
        if page.startswith("<!--", tag):
            end = page.find("-->", tag + 4)
            at = size if end < 0 else end + 3
            continue
        close = page.startswith("</", tag)
        name = NAME.match(page, tag + 1 + close)
        if not name:
            if page[tag + 1 : tag + 2] in ("!", "?", "/"):
                end = page.find(">", tag)
                at = size if end < 0 else end + 1
            else:
                yield "text", "<", ""
                at = tag + 1
            continue
        end = name.end()
        while (m := QUOTE_OR_END.search(page, end)) and m[0] != ">":
            end = m.end()
            if m[0] not in unclosed and page[name.end() : m.start()].rstrip().endswith("="):
                to = page.find(m[0], end)
                if to < 0:
                    unclosed.add(m[0])  # a quote without an end is an ordinary character
                else:
                    end = to + 1
        end = m.start() if m else size
        word = name[0].lower()
        yield ("end", word, "") if close else ("start", word, page[name.end() : end])
        at = end + 1
        if not close and word in RAW:
            stop = re.compile(rf"</{word}(?=[\s/>])", re.I).search(page, at)
            if page[at : stop.start() if stop else size]:
                yield "text", page[at : stop.start() if stop else size], ""
            at = stop.start() if stop else size


def attributes(text: str) -> dict[str, str]:
    found: dict[str, str] = {}
    for m in ATTRIBUTE.finditer(text):
        found.setdefault(m[1].lower(), html.unescape(m[2] or m[3] or m[4] or ""))
    return found


def build(page: str) -> Node:
    root = Node("#root", {})
    stack, open_ = [root], Counter()

    def pop_to(depth: int) -> None:
        while len(stack) > depth:
            open_[stack.pop().name] -= 1

    def close(names: set[str] | frozenset[str], beyond: set[str] | frozenset[str]) -> None:
        """Ends the outermost of these elements that is open inside `beyond`."""
        if not any(open_[n] for n in names):
            return
        found = 0
        for depth in range(len(stack) - 1, 0, -1):
            if stack[depth].name in beyond:
                break
            if stack[depth].name in names:
                found = depth
        if found:
            pop_to(found)

    def push(name: str, attrs: dict[str, str]) -> None:
        node = Node(name, attrs)
        node.formula = open_["math"] > 0
        stack[-1].children.append(node)
        stack.append(node)
        open_[name] += 1

    for kind, word, rest in scan(page):
        if kind == "text":
            if open_["head"] and stack[-1].name == "head" and word.strip():
                close({"head"}, set())
            name = stack[-1].name
            stack[-1].children.append(word if name in RAW and name not in ("textarea", "title") else html.unescape(word) if "&" in word else word)
        elif kind == "start":
            if open_["head"] and word not in IN_HEAD:
                close({"head"}, set())
            if word in ("html", "body", "head") and open_[word]:
                continue
            if word in CLOSES_P and open_["p"]:
                close({"p"}, SCOPE)
            if word in IMPLIED_END:
                close(*IMPLIED_END[word])
            if word in ("td", "th") and open_["table"] and stack[-1].name in ("table", "thead", "tbody", "tfoot"):
                push("tr", {})
            if word in VOID:
                stack[-1].children.append(Node(word, attributes(rest)))
            else:
                push(word, attributes(rest) if rest else {})
        elif open_[word]:
            inner = SCOPE - {word} if word not in ("table", "tr", "tbody", "thead", "tfoot") else frozenset({"table"} - {word})
            for depth in range(len(stack) - 1, 0, -1):
                if stack[depth].name == word:
                    pop_to(depth)
                    break
                if stack[depth].name in inner:
                    break
        elif word == "br":
            stack[-1].children.append(Node("br", {}))
    return root


def style_sheet(root: Node) -> Sheet:
    """The rules of the page's style elements about what is shown."""
    sheet, stack = Sheet(), [root]
    while stack:
        node = stack.pop()
        if node.name == "style":
            css = "".join(c for c in node.children if isinstance(c, str))
            if ASKED.search(css) and node.attributes.get("type", "").lower() in ("", "text/css") and on_screen(node.attributes.get("media", "")):
                sheet.add(css)
        elif node.name != "template":
            stack += [c for c in reversed(node.children) if isinstance(c, Node)]
    if sheet.rules:
        relate(root)
    return sheet


def shape(display: str) -> str:
    """The kind of box that a `display` value asks for; "" is the element's usual one."""
    words = display.split()
    if not words or words[0] in ("inherit", "revert", "revert-layer") or "var(" in display:
        return ""
    if "list-item" in words:
        return "list"
    if words[0] == "table-cell":
        return "cell"
    if words[0].startswith(("inline", "ruby")) or words[0] in ("contents", "initial", "unset", "math", "-webkit-inline-box", "-webkit-inline-flex"):
        return "inline"
    return "flex" if "flex" in words or "grid" in words or "-webkit-box" in words or "-webkit-flex" in words else "block"


def box(node: Node) -> str:
    """How it stands to its neighbours: "apart" (empty lines), "block" (own lines) or "inline"."""
    if node.shape in ("inline", "cell"):
        return "inline"
    return "apart" if node.name in APART else "block" if node.shape or node.name in BLOCKS else "inline"


def keeps(node: Node, keep: bool | str) -> bool | str:
    """Whether its white space is kept ("lines": only line ends are)."""
    if node.white in ("pre", "pre-wrap", "break-spaces"):
        return True
    if node.white in ("normal", "nowrap", "initial"):
        return False
    if node.white == "pre-line":
        return "lines"
    return True if node.white not in ("inherit", "unset") and node.name in ("pre", "textarea", "xmp") else keep


def shown(node: Node, rules: Sheet, visible: bool) -> bool | None:
    """None: no box at all; else whether its own text can be seen."""
    a = node.attributes
    if node.name in UNSEEN or (node.formula and node.name in ("annotation", "annotation-xml")) or (node.name == "input" and a.get("type", "").lower() == "hidden"):
        return None
    won = rules.won(node) if rules.rules or "style" in a else {}
    display = won.get("display", "revert")
    if display == "none" or display.startswith("table-column"):
        return None
    node.shape, node.white = shape(display), won.get("white-space", "")
    # a browser's own rules give way to any of the page's
    if display.startswith("revert") and (("hidden" in a and a["hidden"] != "until-found") or (node.name == "dialog" and "open" not in a)):
        return None
    how = won.get("visibility", "hidden" if node.formula and node.name == "mphantom" else "inherit")
    return how in ("visible", "initial") if how in ("visible", "initial", "hidden", "collapse") else visible


class Out:
    """Lines of text under construction."""

    def __init__(self) -> None:
        self.lines: list[str] = []
        self.line: list[str] = []
        self.blank = False  # an empty line is due before the next one
        self.space = False  # a space is due before the next word
        self.indents: list[str] = []
        self.marker = ""

    def end_line(self) -> None:
        if self.line:
            text = "".join(self.line).rstrip(" ")
            self.line = []
            self.write(text)
        self.space = False

    def write(self, text: str) -> None:
        if self.blank and self.lines:
            self.lines.append("")
        self.blank = False
        deep = self.indents[: -1 if self.marker else None]
        self.lines.append(("".join(deep[:DEEP]) + self.marker + text).rstrip(" "))
        self.marker = ""

    def apart(self) -> None:
        self.end_line()
        self.blank = True

    def flow(self, text: str) -> None:
        words = SPACE.split(text)
        if len(words) == 1 and not words[0]:
            return
        for i, word in enumerate(words):
            if i:
                self.space = bool(self.line)
            if word:
                if self.space:
                    self.line.append(" ")
                    self.space = False
                self.line.append(word)

    def kept(self, text: str) -> None:
        first, *others = text.split("\n")
        if first and self.space:
            self.line.append(" ")
        self.space = False
        self.line.append(first)
        for x in others:
            if "".join(self.line).strip():
                self.end_line()
            else:
                self.line = []
                if self.lines:
                    self.lines.append("")
            self.line.append(x)


def span(node: Node, name: str, most: int) -> int:
    m = re.match(r"\s*(\d{1,9})", node.attributes.get(name, ""))
    return min(most, max(1, int(m[1]))) if m else 1


def marker(parent: Node, item: Node, count: dict[int, int]) -> str:
    if parent.name != "ol":
        return "- "
    number = lambda node, key: int(m[0]) if (m := re.match(r"-?\d{1,9}", node.attributes.get(key, "").strip())) else None
    down = "reversed" in parent.attributes
    if id(parent) not in count:
        first = number(parent, "start")
        count[id(parent)] = first if first is not None else sum(isinstance(c, Node) and c.name == "li" for c in parent.children) if down else 1
    own = number(item, "value")
    now = count[id(parent)] if own is None else own
    count[id(parent)] = now + (-1 if down else 1)
    return f"{now}. "


def walk(root: Node, rules: Sheet, out: Out, visible: bool = True, keep: bool | str = False) -> Generator[tuple, None, None]:
    """Writes the children of `root`; yields (walk of a cell) to be run first."""
    count: dict[int, int] = {}
    stack: list[tuple] = [("in", c, root, visible, keep) for c in reversed(root.children)]
    while stack:
        step, node, parent, visible, keep = stack.pop()
        if step == "out":
            how = box(node)
            if node.name == "li" and node.shape in ("", "list"):
                out.end_line()
                out.indents.pop()
                out.marker = ""
            elif node.name in ("blockquote", "dd") and how != "inline":
                out.end_line()
                out.indents.pop()
            if how == "apart":
                if node.name in ("ul", "ol") and parent.name == "li":
                    out.end_line()
                else:
                    out.apart()
            elif how == "block":
                out.end_line()
            elif node.shape == "cell" or parent.shape == "flex" or node.name in FIELDS:
                out.space = bool(out.line)
            continue
        if isinstance(node, str):
            if visible:
                if keep == "lines":
                    node = "\n".join(BLANKS.sub(" ", x).strip(" ") if at else BLANKS.sub(" ", x) for at, x in enumerate(node.split("\n")))
                (out.kept if keep else out.flow)(node)
            continue
        seen = shown(node, rules, visible)
        if seen is None:
            continue
        name = node.name
        if name == "br":
            if out.line:
                out.end_line()
            elif out.lines:
                out.blank = True
            continue
        if node.shape == "cell" or parent.shape == "flex" or name in FIELDS:
            out.space = bool(out.line)
        if name == "input":
            if seen and node.attributes.get("type", "text").lower() in ("text", "submit", "button", "reset", "search", "email", "url", "tel", "number"):
                out.flow(node.attributes.get("value", ""))
                out.space = bool(out.line)
            continue
        if name == "details" and "open" not in node.attributes:
            inner = [c for c in node.children if isinstance(c, Node) and c.name == "summary"][:1]
        elif name == "select" and ("multiple" in node.attributes or span(node, "size", 1000) > 1):
            inner = [c for c in node.children if isinstance(c, Node)]
        elif name == "select":
            options = [c for c in node.children if isinstance(c, Node) for c in ([c] if c.name == "option" else [x for x in c.children if isinstance(x, Node)])]
            inner = ([c for c in options if "selected" in c.attributes] or options)[:1]
        else:
            inner = node.children
        how = box(node)
        if how == "apart":
            if name in ("ul", "ol") and parent.name == "li":
                out.end_line()
            else:
                out.apart()
        elif how == "block":
            out.end_line()
        if name == "optgroup" and seen:
            out.flow(node.attributes.get("label", ""))
            out.end_line()
        elif name == "mtd":
            out.space = bool(out.line)
        if name == "li" and node.shape in ("", "list"):
            mark = marker(parent, node, count)
            out.marker = ("".join(out.indents[-1:]) if out.marker and len(out.indents) > DEEP else out.marker) + mark if out.marker else mark
            out.indents.append(" " * len(mark))
        elif name in ("blockquote", "dd") and how != "inline":
            out.indents.append("  ")
        if name == "table":
            yield from table(node, rules, out, seen, keeps(node, keep))
            inner = []
        keep = keeps(node, keep)
        if name == "pre" and inner and isinstance(inner[0], str) and inner[0].startswith("\n"):
            inner = [inner[0][1:], *inner[1:]]
        stack.append(("out", node, parent, visible, keep))
        stack += [("in", c, node, seen, keep) for c in reversed(inner)]
    out.end_line()


def table(node: Node, rules: Sheet, out: Out, visible: bool, keep: bool | str) -> Generator[tuple, None, None]:
    """Rows of cells, aligned; captions and stray content go before."""
    rows: list[tuple[Node, bool]] = []
    groups: list[tuple[int, Node, bool]] = []
    for c in node.children:
        if isinstance(c, str):
            if visible and c.strip():
                out.flow(c)
            continue
        seen = shown(c, rules, visible)
        if seen is None:
            continue
        if c.name in ("thead", "tbody", "tfoot"):
            groups.append(({"thead": 0, "tbody": 1, "tfoot": 2}[c.name], c, seen))
        elif c.name == "tr":
            groups.append((1, c, seen))
        else:
            stray = Node("#stray", {})
            stray.children = [c] if c.name != "caption" else c.children
            yield (walk(stray, rules, out, seen, keep),)
            out.end_line()
    out.end_line()
    for _, c, seen in sorted(groups, key=lambda g: g[0]):
        if c.name == "tr":
            rows.append((c, seen))
        else:
            for r in c.children:
                if isinstance(r, Node) and (s := shown(r, rules, seen)) is not None:
                    rows.append((r, s))
                elif isinstance(r, str) and seen and r.strip():
                    out.flow(r)
    out.end_line()
    busy: dict[int, int] = {}  # column: first row that is free again
    grid: list[dict[int, list[str]]] = []
    widths: dict[int, int] = {}
    for at, (row, seen) in enumerate(rows):
        cells: dict[int, list[str]] = {}
        column = 0
        inside = [c for c in row.children if isinstance(c, Node) and c.name in ("td", "th")] if row.name == "tr" else []
        loose = [c for c in row.children if isinstance(c, str) and c.strip() or isinstance(c, Node) and c.name not in ("td", "th")] if row.name == "tr" else [row]
        if loose:
            cell = Node("#cell", {})
            cell.children = loose
            inside.append(cell)
        for cell in inside:
            s = shown(cell, rules, seen)
            if s is None:
                continue
            while busy.get(column, 0) > at:
                column += 1
            inner = Out()
            yield (walk(cell, rules, inner, s, keeps(cell, keep)),)
            cells[column] = inner.lines
            wide, high = span(cell, "colspan", 1000), span(cell, "rowspan", 65534)
            if wide == 1:
                widths[column] = max(widths.get(column, 0), max((len(x) for x in inner.lines if len(x) <= WIDE), default=0))
            if high > 1:
                for k in range(column, column + wide):
                    busy[k] = at + high
            column += wide
        grid.append(cells)
    columns = sorted({c for cells in grid for c, lines in cells.items() if lines})
    for cells in grid:
        for i in range(max((len(lines) for lines in cells.values()), default=0)):
            parts, due = [], ""
            for c in columns:
                text = cells[c][i] if c in cells and i < len(cells[c]) else ""
                if text:
                    parts.append(due + text)
                    due = ""
                else:
                    text = ""
                due += " " * (max(widths.get(c, 0) - len(text), 0) + 2)
            out.write("".join(parts))


def render(page: str | None) -> str:
    """The visible text of a page."""
    root, out = build(page or ""), Out()
    running = [walk(root, style_sheet(root), out)]
    while running:  # cells are walked as they come up, without recursion
        try:
            running.append(next(running[-1])[0])
        except StopIteration:
            running.pop()
    return "\n".join(out.lines).strip("\n")


def rendered(pages: Column) -> Column:
    """The visible text of each page."""

    def of(arr: pa.Array) -> pa.Array:
        return pa.array([render(x.as_py()) for x in arr], pa.string())

    return F.arrow_udf(of, "string")(pages)
