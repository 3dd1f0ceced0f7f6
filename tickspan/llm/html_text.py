"""Layout-aware text of HTML pages.

A page is cut into tags and text, built into a tree with the tags that HTML
implies (a paragraph ends at the next block, a list item at the next item, a cell
at the next cell or row), and rendered without recursion: invisible elements are
left out, blocks are set apart by line breaks or blank lines as their kind asks,
list items get bullets or numbers and are indented by depth, preformatted text
keeps its spaces, and the cells of a table are aligned in columns, over rows
they span as well. Visibility follows inline styles, the ``hidden`` attribute and
the page's style sheets, as far as their selectors are a tag, classes and ids
(rules below ``@`` are not read); what is hidden by ``visibility`` may hold what is
visible again, closed details show their summary, closed dialogs nothing. An open head
ends where its content cannot be the head's. Drawings show their text elements
and embedded HTML, formulas all but annotations.

Defined results: null or empty pages, and pages without visible text, give an
empty text; text after unclosed tags is kept; rows that repeat an id each return
a row; an empty table gives no rows; columns other than id and html are ignored.
"""

from __future__ import annotations

import html
import re
from bisect import bisect_left

import pyarrow as pa
from pyspark.sql import DataFrame, functions as F, types as T

# A quote delimits only right after "="; elsewhere it is a character like others.
_TAG = re.compile(r"""<!--(?:>|.*?(?:-->|\Z))|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)"""
                  r"""((?:=\s*+"[^"]*+"|=\s*+'[^']*+'|=\s*+[^\s"'>][^\s>]*+|[^>=]++|=)*+)>""", re.S)
_LOOSE = re.compile(r"<!--(?:>|.*?(?:-->|\Z))|<[!?][^>]*>|<(/?)([A-Za-z][^\s/>]*)([^>]*)>", re.S)
_SPACE = re.compile(r"[ \t\n\r\f]+")
_VALUE = r"""\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)"""
_STYLE, _CLASS, _ID = (re.compile(rf"(?:^|[\s/\"']){a}{_VALUE}", re.I) for a in ("style", "class", "id"))
_HIDDEN_FLAG, _OPEN_FLAG = (re.compile(rf"(?:^|\s){a}(?:\s|=|/|$)", re.I) for a in ("hidden", "open"))
_DECLARED = re.compile(r"(?:^|;)\s*(display|visibility)\s*:\s*([a-z-]+)\s*(!\s*important)?", re.I)
_SELECTOR = re.compile(r"\s*([a-z][a-z0-9]*|\*)?((?:[.#][\w-]+)*)\s*\Z", re.I)
_QUOTED = re.compile(r'''=\s*(?:"[^"]*"|'[^']*')''')
_START = re.compile(r"""(?:^|\s)start\s*=\s*["']?(-?\d{1,9})""", re.I)
_ITEM = re.compile(r"""(?:^|\s)value\s*=\s*["']?(-?\d{1,9})""", re.I)
_SPAN, _ROWS = (re.compile(rf"""(?:^|\s){a}\s*=\s*["']?(\d{{1,5}})""", re.I) for a in ("colspan", "rowspan"))

# Element kinds of the HTML standard.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp iframe noembed noframes".split())
UNSEEN = frozenset("head script style template noscript iframe noembed noframes title datalist object video audio canvas "
                   "annotation annotation-xml mphantom".split())
HEAD = frozenset("base basefont bgsound link meta noframes noscript script style template title".split())
# In drawings only text elements and embedded HTML show text, except in what is only defined or described.
DRAWN = frozenset("text foreignobject".split())
UNDRAWN = frozenset("defs symbol desc metadata clippath mask pattern marker".split())
FOREIGN = frozenset("svg math".split())
EMBEDS = frozenset("foreignobject desc title mi mo mn ms mtext annotation-xml".split())
# A start tag of HTML ends a drawing or formula that is left open.
BREAKS = frozenset("b big blockquote body br center code dd div dl dt em embed h1 h2 h3 h4 h5 h6 head hr i img li listing menu "
                   "meta nobr ol p pre ruby s small span strong strike sub sup table tt u ul var".split())
PARTED = frozenset("p h1 h2 h3 h4 h5 h6 ul ol dl blockquote pre table figure hr fieldset menu".split())
BLOCK = PARTED | frozenset("html body address article aside center details dialog dd dir div dt fieldset figcaption footer "
                           "form header hgroup li main nav option optgroup search section summary caption thead tbody "
                           "tfoot tr td th xmp legend".split())
WALLS = frozenset("table td th caption html template".split())
TABLE_PARTS = frozenset("table thead tbody tfoot tr".split())
# A start tag closes the nearest open element of these names, unless one of the walls lies between.
CLOSES = {"li": (("li",), ("ul", "ol", "menu", "dir")), "dt": (("dt", "dd"), ("dl",)), "dd": (("dt", "dd"), ("dl",)),
          "option": (("option",), ("select",)), "optgroup": (("optgroup", "option"), ("select",)),
          "td": (("td", "th"), ("table",)), "th": (("td", "th"), ("table",)), "tr": (("tr", "caption"), ("table",)),
          "thead": (("thead", "tbody", "tfoot", "tr", "caption"), ("table",)),
          "tbody": (("thead", "tbody", "tfoot", "tr", "caption"), ("table",)),
          "tfoot": (("thead", "tbody", "tfoot", "tr", "caption"), ("table",))}
DEEPEST = 512   # as browsers do, deeper elements become siblings
MOST_COLUMNS = 1000     # of a cell, by the standard
WIDEST = 60     # default: cells before others are wrapped at this width
BULLETS = "-"


class Node:
    __slots__ = ("name", "attrs", "kids", "up", "depth", "foreign")

    def __init__(self, name, attrs="", up=None):
        self.name, self.attrs, self.kids, self.up = name, attrs, [], up
        self.depth = up.depth + 1 if up else 0
        self.foreign = name in FOREIGN or (up is not None and up.foreign and name not in EMBEDS)


class Tree:
    """Builds the tree of one page from its tags and texts."""

    def __init__(self, page: str):
        self.root = self.at = Node("body")
        self.css: list[str] = []
        self.head, self.begun = None, False    # the open head; whether there is an element or text
        pos, tags, last = 0, _TAG, page.rfind(">")
        while True:
            cut = page.find("<", pos)
            if cut < 0:
                self.text(page[pos:])
                break
            tag = tags.match(page, cut) if cut < last or page.startswith("<!--", cut) else None
            if tag is None and cut < last and tags is _TAG:   # a quote without end: from here on quotes do not count
                if (loose := _LOOSE.match(page, cut)) is not None:
                    tags, tag = _LOOSE, loose
            if tag is None:                    # a lone "<" is text
                self.text(page[pos:cut + 1])
                pos = cut + 1
                continue
            self.text(page[pos:cut])
            pos = tag.end()
            if not tag.group(2):
                continue
            name = tag.group(2).lower()
            if tag.group(1):
                self.end(name)
                continue
            closed = self.at.foreign and tag.group(3).endswith("/")
            self.start(name, tag.group(3))
            if closed and name in RAW:
                self.end(name)
            elif name in RAW:
                close = re.compile(rf"</{name}(?=[\s/>])[^>]*>|\Z", re.I).search(page, pos)
                if name == "style":
                    self.css.append(page[pos:close.start()])
                elif name not in UNSEEN:
                    self.at.kids.append(html.unescape(page[pos:close.start()]))
                self.end(name)
                pos = close.end()

    def close(self, names, walls) -> bool:
        """Close the nearest open element of these names, if no wall is before it."""
        node = self.at
        while node is not None and node.name not in names:
            if node.name in walls:
                return False
            node = node.up
        if node is None or node.up is None:
            return False
        self.at = node.up
        return True

    def leave_head(self):
        """Close an open head with all that is open in it, unless in a template."""
        node = self.at
        while node is not self.head:
            if node.name == "template":
                return
            node = node.up
        self.at, self.head = self.head.up, None

    def start(self, name, attrs):
        if self.head is not None and (name in ("body", "frameset") or (
                self.at is self.head and name not in HEAD and name not in ("html", "head"))):
            self.leave_head()
        if name in ("html", "body") or (name == "head" and self.begun):
            return
        if self.at.foreign and name in BREAKS:
            while self.at.foreign:
                self.at = self.at.up
        if name in CLOSES:
            names, walls = CLOSES[name]
            while self.close(names, walls) and name in ("tr", "thead", "tbody", "tfoot"):
                pass
        elif name in BLOCK:
            self.close(("p",), WALLS)
            if name[0] == "h" and len(name) == 2 and self.at.name[0] == "h" and len(self.at.name) == 2:
                self.at = self.at.up or self.at
        if name in ("td", "th") and self.at.name in ("table", "thead", "tbody", "tfoot"):
            self.push("tr", "")
        self.push(name, attrs)
        if name in VOID or (attrs.endswith("/") and name not in BLOCK and name not in RAW):
            self.at = self.at.up

    def push(self, name, attrs):
        if self.at.depth >= DEEPEST:
            self.at = self.at.up
        node = Node(name, attrs, self.at)
        self.at.kids.append(node)
        self.at = node
        self.begun = True
        if name == "head":
            self.head = node

    def end(self, name):
        if name in ("html", "body") or name in VOID:
            if name == "br":
                self.start("br", "")
            return
        if name == "head":
            if self.head is not None:
                self.leave_head()
            return
        if name in ("table", "td", "th", "tr", "thead", "tbody", "tfoot", "caption"):
            self.close((name,), ("table",) if name != "table" else ())
        elif name in BLOCK:
            self.close((name,), WALLS)
        else:
            self.close((name,), BLOCK)    # formatting does not close the blocks inside it

    def text(self, text):
        if not text:
            return
        if "&" in text:
            text = html.unescape(text)
        if (self.at is self.head or not self.begun) and text.strip(" \t\n\r\f"):
            self.begun = True
            if self.head is not None:
                self.leave_head()
        at = self.at
        if at.name in TABLE_PARTS:
            if not text.strip(" \t\n\r\f"):
                return
            while at.name in TABLE_PARTS and at.name != "table" and at.up is not None:
                at = at.up
            if at.name == "table":        # text between cells stands before the table
                at.up.kids.insert(len(at.up.kids) - 1, text)
                return
        at.kids.append(text)


def without_at_rules(css: str) -> str:
    """A style sheet without comments and without rules below ``@``."""
    css, out, pos = re.sub(r"/\*.*?(?:\*/|\Z)", " ", css, flags=re.S), [], 0
    while (at := css.find("@", pos)) >= 0:
        out.append(css[pos:at])
        depth, pos = 0, len(css)
        for m in re.compile("[{};]").finditer(css, at):
            depth += {"{": 1, "}": -1}.get(m[0], 0)
            if depth <= 0:
                pos = m.end()
                break
    return "".join(out) + css[pos:]


class Styles:
    """What a page's style sheets say on display and visibility, for selectors
    of a tag, classes and ids."""

    def __init__(self, css: list[str]):
        self.rules: dict[str, list] = {}      # by the last class or id, or the tag
        order = 0
        for text in css:
            for rule in without_at_rules(text).split("}")[:-1]:
                head, _, body = rule.rpartition("{")
                selectors, said = head.rpartition(";")[2], _DECLARED.findall(body)
                for one in selectors.split(",") if said else ():
                    m = _SELECTOR.match(one)
                    if not m or not m[0].strip():
                        continue
                    marks = re.findall(r"[.#][\w-]+", m[2])
                    tag = (m[1] or "*").lower()
                    ids = sum(x[0] == "#" for x in marks)
                    order += 1
                    for prop, value, strong in said:
                        weight = (bool(strong), ids, len(marks) - ids, tag != "*", order)
                        self.rules.setdefault(marks[-1] if marks else tag, []).append((prop.lower(), value.lower(), weight, tag, set(marks)))

    def of(self, node: Node) -> dict[str, str]:
        """The values of display and visibility that the node itself is given."""
        attrs = node.attrs
        said: dict[str, tuple] = {}

        def say(prop, value, weight):
            if prop not in said or weight >= said[prop][0]:
                said[prop] = (weight, value)
        if attrs and "hidden" in attrs.lower() and _HIDDEN_FLAG.search(_QUOTED.sub('=""', attrs)):
            say("display", "none", (False, -1))
        if self.rules:
            marks = set()
            if attrs and (m := _CLASS.search(attrs)):
                marks |= {"." + c for c in html.unescape(m[1].strip("\"'")).split()}
            if attrs and (m := _ID.search(attrs)):
                marks.add("#" + html.unescape(m[1].strip("\"'")))
            for key in (*marks, node.name, "*"):
                for prop, value, weight, tag, needs in self.rules.get(key, ()):
                    if tag in ("*", node.name) and needs <= marks:
                        say(prop, value, weight)
        if attrs and "style" in attrs.lower() and (m := _STYLE.search(attrs)):
            for prop, value, strong in _DECLARED.findall(html.unescape(m[1].strip("\"'"))):
                say(prop.lower(), value.lower(), (bool(strong), 1 << 30))
        return {prop: value for prop, (_, value) in said.items()}


class Lines:
    """Lines of a block, filled with inline text."""

    def __init__(self):
        self.done, self.line, self.gap, self.lead = [], [], 0, ""

    def text(self, text: str):
        text = _SPACE.sub(" ", text)
        if text[:1] == " " and (not self.line or self.line[-1][-1:] == " "):
            text = text[1:]
        if text:
            self.line.append(text)

    def flush(self, keep=False):
        line = "".join(self.line).rstrip(" ")
        self.line = []
        if line or keep:
            self.put(line)

    def put(self, line: str):
        """One finished line, after the blank line that is due."""
        if self.gap and self.done:
            self.done.append("")
        self.gap = 0
        self.done.append(line)

    def part(self, blank: bool):
        self.flush()
        if blank:
            self.gap = 1


def wrapped(line: str, width: int) -> list[str]:
    """A line cut at spaces into lines of at most ``width`` where words allow."""
    if len(line) <= width:
        return [line]
    out, now = [], ""
    for word in line.split(" "):
        if now and len(now) + 1 + len(word) > width:
            out.append(now)
            now = word
        else:
            now = f"{now} {word}" if now else word
    return [*out, now]


def aligned(rows: list[list[tuple[list[str], int, int]]], widest: int = WIDEST) -> list[str]:
    """Lines of a table; a cell is its lines and the columns and rows it spans
    (0 rows: to the end). Cells with others after them are wrapped at ``widest``,
    so columns start alike in all rows."""
    placed, held = [], {}          # by row the cells with their column; columns held by cells of rows above
    for r, row in enumerate(rows):
        col, cells = 0, []
        for lines, span, down in row:
            while held.get(col, 0) > r:
                col += 1
            cells.append((lines, col, span))
            for c in range(col, col + span if down != 1 else col):
                held[c] = r + down if down else len(rows)
            col += span
        placed.append([(x if i == len(cells) - 1 else [w for line in x for w in wrapped(line, widest)], c, n)
                       for i, (x, c, n) in enumerate(cells)])
    # Columns in which no cell starts take no room.
    used = sorted({col for row in placed for _, col, _ in row})
    placed = [[(x, bisect_left(used, col), bisect_left(used, col + span) - bisect_left(used, col)) for x, col, span in row] for row in placed]
    widths: dict[int, int] = {}
    for many in (False, True):     # cells over several columns widen the last of them
        for row in placed:
            for i, (lines, col, span) in enumerate(row):
                need = max((len(x) for x in lines if len(x) <= widest or i < len(row) - 1), default=0)
                have = sum(widths.get(c, 0) for c in range(col, col + span)) + 2 * (span - 1)
                if (span > 1) == many and need > have:
                    widths[col + span - 1] = widths.get(col + span - 1, 0) + need - have
    starts, at = [0], 0
    for c in range(max((col + span for row in placed for _, col, span in row), default=0)):
        at += widths.get(c, 0) + 2
        starts.append(at)
    out = []
    for row in placed:
        for i in range(max((len(lines) for lines, _, _ in row), default=0)):
            text = ""
            for lines, col, _ in row:
                if i < len(lines):
                    text = text.ljust(starts[col]) + lines[i] + "  "
            out.append(text.rstrip())
    return [x for x in out if x]


def rendered(page: str | None, widest: int = WIDEST) -> str:
    """The visible text of a page, laid out."""
    if not page:
        return ""
    sinks = [Lines()]
    tables: list[list] = []
    lists: list[list] = []        # [is numbered, next number]
    pre = 0
    drawn: list[bool] = []        # for each open drawing, text element and embedded HTML: whether text shows
    tree = Tree(page)
    styles, shown = Styles(tree.css), [True]     # for each open element, whether its text shows
    todo: list = [(tree.root, True)]
    while todo:
        node, enter = todo.pop()
        sink = sinks[-1]
        if isinstance(node, str):
            if (drawn and not drawn[-1]) or not shown[-1]:
                continue
            if pre:
                first, *more = node.replace("\r\n", "\n").split("\n")
                sink.line.append(first)
                for x in more:
                    sink.flush(keep=bool(sink.done or sink.line))
                    sink.line.append(x)
            else:
                sink.text(node)
            continue
        name = node.name
        if enter:
            if name in UNSEEN or (drawn and name in UNDRAWN):
                continue
            given = styles.of(node) if node.attrs or styles.rules else {}
            if given.get("display") == "none":
                continue
            closed = name in ("details", "dialog") and not _OPEN_FLAG.search(_QUOTED.sub('=""', node.attrs))
            if closed and name == "dialog":
                continue
            kids = node.kids
            if closed:
                kids = [k for k in kids if not isinstance(k, str) and k.name == "summary"][:1]
            seen = given.get("visibility", "inherit")
            shown.append({"visible": True, "hidden": False, "collapse": False}.get(seen, shown[-1]))
            todo.append((node, False))
            if name == "svg":
                drawn.append(False)
            elif drawn and name in DRAWN:
                drawn.append(True)
                if name == "text":
                    sink.text(" ")
            if name == "br":
                sink.flush(keep=bool(sink.line or sink.done))
            elif name == "hr" and shown[-1]:
                sink.part(True)
                sink.put("---")
                sink.gap = 1
            elif name == "table":
                sink.part(True)
                tables.append([])
            elif name == "tr" and tables:
                tables[-1].append([])
            elif name in ("td", "th") and tables:
                sinks.append(Lines())
            elif name in ("ul", "ol", "menu", "dir"):
                sink.part(not lists)
                start = _START.search(node.attrs) if name == "ol" else None
                lists.append([name == "ol", int(start.group(1)) if start else 1])
            elif name in ("li", "dd", "blockquote"):
                sink.part(name == "blockquote")
                sinks.append(Lines())
            elif name in BLOCK:
                sink.part(name in PARTED)
            pre += name in ("pre", "xmp", "textarea")
            todo.extend((kid, True) for kid in reversed(kids))
            continue
        shown.pop()
        pre -= name in ("pre", "xmp", "textarea")
        if name == "svg" or (drawn and name in DRAWN):
            drawn.pop()
            if name == "text":
                sink.text(" ")
        if name == "table":
            sink.flush()
            for line in aligned(tables.pop(), widest):
                sink.put(line)
            sink.gap = 1
        elif name in ("td", "th") and tables:
            sinks.pop()
            sink.flush()
            cell = [x for x in sink.done if x]
            if not tables[-1]:
                tables[-1].append([])
            span, down = _SPAN.search(node.attrs), _ROWS.search(node.attrs)
            tables[-1][-1].append((cell, min(max(int(span.group(1)), 1), MOST_COLUMNS) if span else 1, int(down.group(1)) if down else 1))
        elif name in ("ul", "ol", "menu", "dir"):
            sink.part(False)
            lists.pop()
            if not lists:
                sink.gap = 1
        elif name in ("li", "dd", "blockquote"):
            sinks.pop()
            sink.flush()
            if name == "li":
                numbered = lists and lists[-1][0]
                if numbered and (value := _ITEM.search(node.attrs)):
                    lists[-1][1] = int(value.group(1))
                lead = f"{lists[-1][1]}. " if numbered else BULLETS + " "
                if numbered:
                    lists[-1][1] += 1
            else:
                lead = "    " if name == "dd" else "> "
            rest = lead if name == "blockquote" else " " * len(lead)
            for i, line in enumerate(sink.done):
                sinks[-1].put(((lead if i == 0 else rest) + line).rstrip())
            if name == "blockquote":
                sinks[-1].gap = 1
        elif name in BLOCK:
            sink.part(name in PARTED)
    sinks[0].flush()
    return "\n".join(sinks[0].done).strip("\n")


def extract(pages: DataFrame, id_col: str = "page_id", html_col: str = "html", widest: int = WIDEST) -> DataFrame:
    """One row per page: ``<id>, text, n_chars, n_lines``. ``widest``: width at
    which table cells before others are wrapped."""
    src = pages.select(F.col(id_col).alias("id"), F.col(html_col).cast("string").alias("html"))
    kind = T.StructType([src.schema["id"], T.StructField("text", T.StringType())])

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array([rendered(x, widest) for x in b.column(1).to_pylist()], pa.string())], names=["id", "text"])
    out = src.mapInArrow(run, kind)
    n = F.char_length("text").cast("long")
    return out.select(F.col("id").alias(id_col), "text", n.alias("n_chars"), F.when(n == 0, 0).otherwise(
        F.size(F.split("text", "\n"))).cast("long").alias("n_lines"))
