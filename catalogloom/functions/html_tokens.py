"""One reader of HTML: a state machine whose tokens feed evidence, links, scores, texts and tables.

States: data, tag name, attributes (bare or quoted values), comment, and the raw text of elements whose content is no
markup. The machine jumps to the next character that can end a state, so that text costs no step for each character.
Pages are read once, in Arrow batches of bounded size; what is found comes as columns for Catalyst.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructField, StructType, _parse_datatype_string

#: Elements without content, those whose content is raw text, and those whose text is not the page's.
VOID = frozenset("area base br col embed hr img input keygen link menuitem meta param source track wbr basefont bgsound command frame image isindex nextid spacer".split())
RAW = frozenset(["script", "style"])
HIDDEN = frozenset(["script", "style", "template", "rt", "rp"])

SPACE = " \t\n\r\f"
NAME_END = re.compile(r"[\s/>]")
VALUE_END = re.compile(r"[\s>]")
NOT_SPACE = re.compile(r"[^\s/]")
ATTRIBUTE_END = re.compile(r"[\s/>=]")
CLOSING = {name: re.compile(rf"</{name}(?=[\s/>])", re.IGNORECASE) for name in RAW}
#: A reference without a semicolon in an attribute is none if a letter, digit or '=' follows.
REFERENCE = re.compile(r"&(?:#(?:[xX][0-9a-fA-F]+|[0-9]+);?|[A-Za-z][A-Za-z0-9]*(?:;|(?![=A-Za-z0-9])))")

TAG = "struct<name:string,attributes:map<string,string>,label:string>"
#: Bytes of pages that are Python values at once (a page at least); their tags and fields are many times as large.
AT_ONCE = 1 << 18


def _attributes(page: str, at: int) -> tuple[dict[str, str] | None, int]:
    """The attributes from ``at`` to the tag's end and the place after it; none if the page ends before. Of a name given twice the last counts."""
    found, n = {}, len(page)
    while True:
        m = NOT_SPACE.search(page, at)
        if not m:
            return None, n
        at = m.start()
        if page[at] == ">":
            return found, at + 1
        m = ATTRIBUTE_END.search(page, at + 1)  # a leading '=' is part of a name
        if not m:
            return None, n
        name, at, value = page[at : m.start()].lower(), m.start(), ""
        while at < n and page[at].isspace():
            at += 1
        if at < n and page[at] == "=":
            while at < n and (page[at] == "=" or page[at].isspace()):
                at += 1
            if at >= n:
                return None, n
            if page[at] in "\"'":
                end = page.find(page[at], at + 1)
                if end < 0:
                    return None, n
                value, at = page[at + 1 : end], end + 1
            else:
                m = VALUE_END.search(page, at)
                if not m:
                    return None, n
                value, at = page[at : m.start()], m.start()
            if "&" in value:
                value = REFERENCE.sub(lambda r: html.unescape(r[0]), value)
        found[name] = value


def events(page: str) -> Iterator[tuple[str, str, dict | None]]:
    """('text', words, None), ('start', name, attributes) and ('end', name, None) in the page's order. A tag, comment or script that never ends runs to the page's end."""
    at, n, begun = 0, len(page), 0
    while at < n:
        at = page.find("<", at)
        if at < 0 or at + 1 >= n:
            break
        mark = page[at + 1]
        closing = mark == "/"
        named = page[at + 2 : at + 3] if closing else mark
        if not (named.isascii() and named.isalpha()) and mark not in "!?/":
            at += 1  # a '<' that opens nothing is text
            continue
        if closing and at + 2 >= n:
            break
        if begun < at:
            yield "text", html.unescape(page[begun:at]), None
        if named.isascii() and named.isalpha():
            m = NAME_END.search(page, at + 1 + closing + 1)
            if not m:
                return
            name = page[at + 1 + closing : m.start()].lower()
            attributes, at = _attributes(page, m.start())
            if attributes is None:
                return
            yield ("end", name, None) if closing else ("start", name, attributes)
            if not closing and name in RAW:
                m = CLOSING[name].search(page, at)
                end = m.start() if m else n
                if end > at:
                    yield "text", page[at:end], None
                at = end
        elif page.startswith("!--", at + 1):
            at = _after_comment(page, at + 4)
        else:
            end = page.find(">", at + 2)
            at = end + 1 if end >= 0 else n
        begun = at
    if begun < n:
        yield "text", html.unescape(page[begun:]), None


def _after_comment(page: str, at: int) -> int:
    if page.startswith(">", at) or page.startswith("->", at):
        return page.index(">", at) + 1
    ends = [end + len(mark) for mark in ("-->", "--!>") if (end := page.find(mark, at)) >= 0]
    return min(ends, default=len(page))


def join_words(pieces: list[str]) -> str:
    return " ".join(x for x in map(str.strip, pieces) if x)


class Elements:
    """The open elements, and where the text inside each began; an end tag closes the nearest of its name and all within."""

    def __init__(self):
        self.open: list[tuple[str, int, int]] = []
        self.pieces: list[str] = []
        self.hidden = 0

    def start(self, name: str, ticket: int) -> None:
        self.open.append((name, ticket, len(self.pieces)))
        self.hidden += name in HIDDEN

    def text(self, words: str) -> None:
        if not self.hidden:
            self.pieces.append(words)

    def end(self, name: str) -> Iterator[tuple[str, int, list[str]]]:
        """The elements that an end tag closes, innermost first; none if none of its name is open ('' closes all)."""
        if name and all(x[0] != name for x in reversed(self.open)):
            return
        while self.open:
            top, ticket, since = self.open.pop()
            self.hidden -= top in HIDDEN
            yield top, ticket, self.pieces[since:] if ticket >= 0 else []
            if top == name:
                return


def read_page(page: str) -> tuple[list[dict], str]:
    """The tags that have attributes, in order, with the text inside those that link (``href``); and the page's text."""
    tags, elements = [], Elements()
    for kind, name, attributes in events(page):
        if kind == "text":
            elements.text(name)
        elif kind == "start":
            ticket = -1
            if attributes:
                tags.append({"name": name, "attributes": list(attributes.items()), "label": ""})
                ticket = len(tags) - 1 if "href" in attributes else -1
            if name not in VOID:
                elements.start(name, ticket)
        elif name not in VOID:
            _label(tags, elements.end(name))
    _label(tags, elements.end(""))
    return tags, join_words(elements.pieces)


def _label(tags: list[dict], closed) -> None:
    for _, ticket, pieces in closed:
        if ticket >= 0:
            tags[ticket]["label"] = join_words(pieces)


def read_tables(page: str) -> list[dict]:
    """All tables of a page in order of their start, nested ones apart: class, and rows of cells (header or not, text, address of the first anchor).

    Open tables stand on a stack; a row or cell belongs to the innermost one, and a new row, cell or table end closes what is open there.
    A cell's text is that of all within it, nested tables included.
    """
    found: list[dict] = []
    tables: list[dict] = []  # each with its open row and cell
    cells: list[dict] = []  # all open cells, outermost first
    hidden = 0

    def close_cell(table):
        cells[:] = [c for c in cells if c is not table["cell"]]
        table["cell"] = None

    for kind, name, attributes in events(page):
        if kind == "text":
            for cell in () if hidden else cells:
                cell["pieces"].append(name)
        elif name in HIDDEN:
            hidden = max(0, hidden + (1 if kind == "start" else -1))
        elif kind == "start" and name == "table":
            tables.append({"class": attributes.get("class", ""), "rows": [], "row": None, "cell": None})
            found.append(tables[-1])
        elif tables and name in ("tr", "td", "th", "table"):
            table = tables[-1]
            close_cell(table)
            if name == "tr" or name == "table":
                table["row"] = None
            if kind == "end" and name == "table":
                tables.pop()
            elif kind == "start" and name == "tr":
                table["row"] = []
                table["rows"].append(table["row"])
            elif kind == "start" and table["row"] is not None:
                table["cell"] = {"header": name == "th", "pieces": []}
                table["row"].append(table["cell"])
                cells.append(table["cell"])
        elif kind == "start" and name == "a":
            for cell in cells:
                cell.setdefault("link", attributes.get("href"))
    cell_of = lambda c: {"header": c["header"], "words": "".join(map(str.strip, c["pieces"])), "link": c.get("link")}
    return [{"class": t["class"], "rows": [[cell_of(c) for c in row] for row in t["rows"]]} for t in found]


def sliced(batches, column: str):
    """Batches of at most ``AT_ONCE`` bytes of ``column`` (a row at least)."""
    for b in batches:
        size = pc.fill_null(pc.binary_length(b.column(column)), 0).to_numpy(zero_copy_only=False)
        lo, held = 0, 0
        for k, n in enumerate(size.tolist()):
            if held and held + n > AT_ONCE:
                yield b.slice(lo, k - lo)
                lo, held = k, 0
            held += n
        if lo < b.num_rows:
            yield b.slice(lo)


def _with(df: DataFrame, column: str, new: StructType, fn) -> DataFrame:
    """``df`` with the columns ``new`` that ``fn`` makes from each text of ``column`` (null: empty)."""
    clash = set(df.columns) & set(new.names)
    if clash:
        raise ValueError(f"columns {sorted(clash)} are there already")
    arrow = to_arrow_schema(new)

    def run(batches):
        for b in sliced(batches, column):
            made = [fn(x or "") for x in b.column(column).to_pylist()]
            fresh = [pa.array([row[i] for row in made], type=f.type) for i, f in enumerate(arrow)]
            yield pa.RecordBatch.from_arrays([*b.columns, *fresh], names=[*b.schema.names, *new.names])

    return df.mapInArrow(run, StructType([*df.schema.fields, *new.fields]))


def read_pages(df: DataFrame, column: str) -> DataFrame:
    """``df`` with ``tags`` (name, attributes, label: see ``read_page``) and ``words`` of each page."""
    new = StructType([StructField("tags", _parse_datatype_string(f"array<{TAG}>")), StructField("words", _parse_datatype_string("string"))])
    return _with(df, column, new, read_page)


def read_all_tables(df: DataFrame, column: str) -> DataFrame:
    """``df`` with ``tables``: of each page its tables, as ``read_tables`` finds them."""
    kind = "array<struct<class:string,rows:array<array<struct<header:boolean,words:string,link:string>>>>>"
    return _with(df, column, StructType([StructField("tables", _parse_datatype_string(kind))]), lambda page: (read_tables(page),))
