"""HTML extraction by layout: a tree with implied tags, visibility rules, and a renderer that keeps the look of blocks, lists and tables."""

from __future__ import annotations

import re
from bisect import bisect_right
from html import unescape

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows

#: Element names by behaviour.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style xmp iframe noembed noframes plaintext".split())
RCDATA = frozenset("textarea title".split())
HIDDEN = frozenset("head script style template noscript iframe noembed noframes object audio video canvas svg math datalist title".split())
SPACED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure hr".split())
BLOCK = SPACED | frozenset("address article aside body center details dialog dd div dt fieldset figcaption footer form header html legend li main nav option optgroup search section select summary textarea tr caption thead tbody tfoot".split())
CLOSES_P = (SPACED | BLOCK) - frozenset("body html li option optgroup select textarea tr caption thead tbody tfoot legend table td th dd dt".split()) | frozenset(["table"])
#: A start tag ends these open elements, up to but not beyond the second set.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "option": ({"option"}, {"select", "datalist"}),
    "optgroup": ({"option", "optgroup"}, {"select"}),
    "td": ({"td", "th", "caption"}, {"table"}),
    "th": ({"td", "th", "caption"}, {"table"}),
    "tr": ({"td", "th", "tr", "caption"}, {"table"}),
    "thead": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tbody": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption"}, {"table"}),
    "tfoot": ({"td", "th", "tr", "thead", "tbody", "tfoot", "caption"}, {"table"}),
    "body": ({"head"}, set()),
}
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
P_WALLS = frozenset("table td th button caption".split())
#: End tags that no wall stops; what stops the search for the element that another one ends.
ENDS_WALLS = frozenset("table tr thead tbody tfoot td th body html".split())
WALLS = frozenset("table td th html".split())
IN_HEAD = frozenset("base link meta script style title template noscript head html".split())
_TAG = re.compile(r"(/?)([a-zA-Z][^\s/>]*)")
_VALUE = re.compile(r"=\s*[\"']|>")
_ATTR = re.compile(r"([^\s=/\"'>]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_NONE = re.compile(r"(?:^|;)\s*(?:display\s*:\s*none|visibility\s*:\s*(?:hidden|collapse))\b", re.I)
_SPACES = re.compile(r"[ \t\n\r\f]+")
#: Fixed value of the markup language: most columns a cell spans.
SPAN = 1000


class Node:
    __slots__ = ("tag", "attrs", "children")

    def __init__(self, tag: str, attrs: dict[str, str] | None = None):
        self.tag, self.attrs, self.children = tag, attrs or {}, []


class _Scan:
    """Tags of a page, each character looked at a bounded number of times: what is searched for and not there is remembered."""

    def __init__(self, html: str):
        self.html, self.missing = html, {}

    def find(self, what: str, at: int) -> int:
        if self.missing.get(what, len(self.html) + 1) <= at:
            return -1
        found = self.html.find(what, at)
        if found < 0:
            self.missing[what] = min(at, self.missing.get(what, at))
        return found

    def tag(self, at: int) -> tuple[int, str, str, str] | None:
        """(end, slash, name, attributes) of what opens with the '<' at `at`, name '' for comments and declarations; None where it is text."""
        html = self.html
        if html.startswith("<!--", at):
            end = self.find("-->", at + 4)
            return len(html) if end < 0 else end + 3, "", "", ""
        if html[at + 1 : at + 2] in ("!", "?"):
            end = self.find(">", at)
            return None if end < 0 else (end + 1, "", "", "")
        m = _TAG.match(html, at + 1)
        if not m or self.find(">", m.end()) < 0:
            return None
        here = m.end()
        while v := _VALUE.search(html, here):
            if v[0] == ">":
                return v.end(), m[1], m[2].lower(), html[m.end() : v.start()]
            end = self.find(v[0][-1], v.end())
            here = v.end() if end < 0 else end + 1  # a quote that never closes is a character
        return None


    def close(self, name: str, at: int) -> tuple[int, int]:
        """Where the end tag of a raw element begins and ends; the page's end where there is none."""
        if name not in self.missing:
            for m in re.compile(rf"</{re.escape(name)}(?=[\\s/>])[^>]*>", re.I).finditer(self.html, at):
                return m.span()
            self.missing[name] = 0
        return len(self.html), len(self.html)


class _Open:
    """The open elements: a stack that knows where each name lies on it, so that no search walks over it."""

    def __init__(self, root: Node):
        self.stack, self.at = [root], {}

    def push(self, node: Node) -> None:
        self.at.setdefault(node.tag, []).append(len(self.stack))
        self.stack.append(node)

    def cut(self, i: int) -> None:
        while len(self.stack) > i:
            self.at[self.stack.pop().tag].pop()

    def last(self, names) -> int:
        """Where the innermost element of these names is; 0 for none."""
        return max((self.at[x][-1] for x in names if self.at.get(x)), default=0)

    def first_above(self, names, floor: int) -> int:
        """Where the outermost element of these names above `floor` is; 0 for none."""
        places = [self.at[x][k] for x in names if self.at.get(x) and (k := bisect_right(self.at[x], floor)) < len(self.at[x])]
        return min(places, default=0)


def parse(html: str) -> Node:
    """The element tree. Unclosed and misnested tags end where their parents or successors imply it; text is unescaped. Time is linear in the page."""
    root, scan = Node("#root"), _Scan(html)
    open_ = _Open(root)
    stack = open_.stack
    plain = 0  # where text not yet added begins

    def text(until: int) -> None:
        if until > plain:
            piece = unescape(html[plain:until])
            if stack[-1].tag == "head" and piece.strip():
                open_.cut(len(stack) - 1)
            stack[-1].children.append(piece)

    at = 0
    while (at := scan.find("<", at)) >= 0:
        found = scan.tag(at)
        if found is None:
            at += 1
            continue
        text(at)
        at, slash, tag, rest = found
        plain = at
        if not tag:
            continue
        if slash:
            if tag == "p" and not open_.at.get("p"):
                stack[-1].children.append(Node("p"))
            wall = 0 if tag in ENDS_WALLS else open_.last(WALLS - {tag})
            if (own := open_.last((tag,))) > wall:
                open_.cut(own)
            continue
        if tag in ("html", "body") and open_.at.get(tag):
            continue
        if stack[-1].tag == "head" and tag not in IN_HEAD:
            open_.cut(len(stack) - 1)
        if tag in ENDS and (cut := open_.first_above(ENDS[tag][0], open_.last(ENDS[tag][1]))):
            open_.cut(cut)
        if tag in CLOSES_P and (cut := open_.first_above(("p",), open_.last(P_WALLS))):
            open_.cut(cut)
        if tag in HEADINGS and stack[-1].tag in HEADINGS:
            open_.cut(len(stack) - 1)
        if tag in ("td", "th") and stack[-1].tag in ("table", "thead", "tbody", "tfoot"):
            row = Node("tr")
            stack[-1].children.append(row)
            open_.push(row)
        attrs: dict[str, str] = {}
        if rest and not rest.isspace():
            for a in _ATTR.finditer(rest):
                attrs.setdefault(a[1].lower(), unescape(a[2] or a[3] or a[4] or ""))
        node = Node(tag, attrs)
        stack[-1].children.append(node)
        if tag in VOID or (rest.endswith("/") and tag in ("svg", "math", "path")):
            continue
        if tag in RAW or tag in RCDATA:
            close, end = scan.close(tag, at)
            body = html[at:close]
            node.children.append(unescape(body) if tag in RCDATA else body)
            at = plain = end
            continue
        open_.push(node)
    text(len(html))
    return root


def visible(node: Node) -> bool:
    a = node.attrs
    if node.tag in HIDDEN or "hidden" in a and a["hidden"].lower() != "until-found":
        return False
    if node.tag == "input" and a.get("type", "").lower() == "hidden" or node.tag == "dialog" and "open" not in a:
        return False
    return not ("style" in a and _NONE.search(a["style"]))


class Box:
    """Lines of one flow of text: the page's, or a cell's."""

    def __init__(self):
        self.lines: list[str] = []
        self.line: list[str] = []
        self.gap = 0  # blank lines owed before the next one
        self.first: list[tuple[int, str]] = []  # indent and marker owed to the next line of a list item
        self.indent = 0

    def add(self, text: str, keep: bool = False) -> None:
        if keep:
            for i, part in enumerate(text.split("\n")):
                if i:
                    self.end(True)
                if part:
                    self.line.append(part)
            return
        text = _SPACES.sub(" ", text)
        if text.startswith(" ") and (not self.line or self.line[-1].endswith(" ")):
            text = text[1:]
        if text:
            self.line.append(text)

    def end(self, force: bool = False) -> None:
        """End the line; an empty one shows only where a break forces it."""
        text = "".join(self.line).rstrip(" ")
        self.line = []
        if not text and not force:
            return
        if self.lines:
            self.lines += [""] * self.gap
        self.gap = 0
        indent, mark = self.first.pop() if self.first and text else (self.indent, "")
        self.lines.append((" " * indent + mark + text).rstrip() if text else "")

    def block(self, spaced: bool) -> None:
        self.end()
        if spaced and self.lines:
            self.gap = 1


def _number(text: str, other: int) -> int:
    return int(text) if re.fullmatch(r"[+-]?[0-9]{1,9}", text or "") else other


class Table:
    def __init__(self):
        self.rows: list[list[list[str]]] = []
        self.taken: dict[int, int] = {}  # column -> rows that a cell from above still covers

    def row(self) -> None:
        self.rows.append([])
        self._covered()

    def _covered(self) -> None:
        row = self.rows[-1]
        while self.taken.get(len(row), 0) > 0:
            self.taken[len(row)] -= 1
            row.append([])

    def cell(self, lines: list[str], attrs: dict[str, str]) -> None:
        if not self.rows:
            self.row()
        wide = max(1, min(SPAN, _number(attrs.get("colspan", ""), 1)))
        deep = max(1, _number(attrs.get("rowspan", ""), 1))
        for k in range(wide):
            if deep > 1:
                self.taken[len(self.rows[-1])] = deep - 1
            self.rows[-1].append(lines if k == 0 else [])
        self._covered()

    def text(self) -> list[str]:
        widths: list[int] = []
        for row in self.rows:
            widths += [0] * (len(row) - len(widths))
            for i, cell in enumerate(row):
                widths[i] = max([widths[i], *map(len, cell)])
        out = []
        for row in self.rows:
            for k in range(max((len(c) for c in row), default=0)):
                out.append("  ".join((c[k] if k < len(c) else "").ljust(w) for c, w in zip(row, widths, strict=False)).rstrip())
        return out


def render(root: Node) -> str:
    """All visible text. Blocks begin on their own lines, paragraphs and their like a blank line apart; list items carry bullets or numbers and
    indent what is below them; cells stand in columns, two spaces apart; preformatted text keeps its spaces."""
    boxes, tables, lists = [Box()], [], []
    pre = 0
    work: list[tuple[str, Node | str | int]] = [("in", root)]
    while work:
        step, node = work.pop()
        box = boxes[-1]
        if isinstance(node, str):
            box.add(node, pre > 0)
            continue
        if isinstance(node, int):  # the indent of before
            box.block(False)
            box.indent, box.first = node, []
            continue
        tag = node.tag
        if step == "in":
            if not visible(node):
                continue
            if tag == "br":
                box.end(True)
                continue
            if tag == "hr":
                box.block(True)
                box.add("---")
                box.block(True)
                continue
            if tag in VOID:
                if tag == "input" and node.attrs.get("type", "").lower() in ("submit", "button", "reset"):
                    box.add(node.attrs.get("value", ""))
                continue
            if tag in ("td", "th"):
                boxes.append(Box())
            elif tag == "tr" and tables:
                tables[-1].row()
            elif tag in BLOCK:
                box.block(tag in SPACED and not (tag in ("ul", "ol", "dl") and lists))
                if tag == "table":
                    tables.append(Table())
                elif tag in ("ul", "ol"):
                    lists.append([tag, _number(node.attrs.get("start", ""), 1)])
                elif tag == "li":
                    kind = lists[-1] if lists else ["ul", 1]
                    if kind[0] == "ol":
                        kind[1] = _number(node.attrs.get("value", ""), kind[1])
                    mark = f"{kind[1]}. " if kind[0] == "ol" else "- "
                    kind[1] += 1
                    box.first = [(box.indent, mark)]
                    work.append(("indent", box.indent))
                    box.indent += len(mark)
                elif tag in ("dd", "blockquote"):
                    work.append(("indent", box.indent))
                    box.indent += 4
                elif tag in ("pre", "textarea"):
                    pre += 1
            work.append(("out", node))
            if tag in ("li", "dd", "blockquote"):  # the indent is put back after the element's own end
                work[-1], work[-2] = work[-2], work[-1]
            work.extend(("in", c) for c in reversed(node.children))
        elif tag in ("td", "th"):
            done = boxes.pop()
            done.end()
            if tables:
                tables[-1].cell(done.lines, node.attrs)
            else:
                boxes[-1].add(" ".join(done.lines) + " ")
        elif tag == "table":
            box.end()
            for line in tables.pop().text():
                box.line = [line]
                box.end(True)
            box.block(True)
        elif tag in ("pre", "textarea"):
            pre -= 1
            box.block(tag == "pre")
        elif tag in BLOCK and tag != "tr":
            if tag in ("ul", "ol"):
                lists.pop()
            box.block(tag in SPACED and not (tag in ("ul", "ol", "dl") and lists))
    boxes[0].end()
    return "\n".join(boxes[0].lines).strip("\n")


def html_to_text(html: str | None) -> str | None:
    return None if html is None else render(parse(html.replace("\r\n", "\n").replace("\0", "")))


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html") -> DataFrame:
    """pages -> (page_id, text, n_chars, n_lines), one row per row of `pages`.

    Null markup: null text, zeros. Empty or invisible pages: empty text, 0 lines. Broken markup never fails: what cannot be a tag is text.
    Repeated rows each get a row, null ids stay. Empty table: no rows. Other columns are not read, whatever their names. Very long pages take time in
    proportion, and pages nested however deep are walked without recursion. A column is as wide as its longest cell line.
    """

    def make():
        def one(page_id, html):
            text = html_to_text(html)
            yield page_id, text, len(text or ""), text.count("\n") + 1 if text else 0

        return one

    return map_rows(pages.select(F.col(id_col).cast("bigint").alias("page_id"), F.col(html_col).alias("html")), make, "page_id bigint, text string, n_chars bigint, n_lines bigint")
