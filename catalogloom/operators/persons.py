"""The person template of a page, read off the page's bracket tree.

A page is a tree: texts, templates and links, whose parts are lists of nodes again. Fields, links and names are judged by
the kind and name of a node, not by its wording. Trees are made and read in Arrow batches; only what they tell leaves them.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructType

from ..functions.cells import text

#: Kinds of persons, templates that wrap a name's parts or a list of names, prefixes and template of links to articles, address of the English ones.
KINDS = ["person", "composer", "performer"]
NAME_TEMPLATES = ["fn", "rfn", "rfnspace"]
LIST_TEMPLATE = "altnames"
ARTICLE_PREFIXES, ARTICLE_TEMPLATE, ARTICLE_ADDRESS = ["wikipedia", "w"], "wp", "//en.wikipedia.org/wiki/"
#: What stands between names.
NAME_BREAKS = [",", ";", "|", "\n", "<br>", "<br/>", "<br />"]
FOUND = StructType().add("kind", StringType()).add("born", IntegerType()).add("died", IntegerType()).add("title", StringType()).add("names", ArrayType(StringType()))

MARK = re.compile(r"<!--|-->|\{\{|\}\}|\[\[|\]\]|\|")
ENDS = {"}}": "{{", "]]": "[["}


@dataclass
class Node:
    """A template ('{{'), a link ('[[') or the page (''); parts hold texts and nodes. ``whole``: it was closed by its own end."""

    kind: str
    parts: list[list] = field(default_factory=lambda: [[]])
    whole: bool = False

    def source(self) -> str:
        inner = "|".join(map(source_of, self.parts))
        return f"{self.kind}{inner}{dict(map(reversed, ENDS.items())).get(self.kind, '') if self.whole else ''}"


def source_of(part: list) -> str:
    return "".join(x if isinstance(x, str) else x.source() for x in part)


def tree(page: str) -> Node:
    """The page's tree. Comments are left out; an end without a beginning is text; a link that never ends closes with its template."""
    root = Node("")
    open_, at, hidden = [root], 0, False
    for m in MARK.finditer(page):
        if not hidden and m.start() > at:
            open_[-1].parts[-1].append(page[at : m.start()])
        at, mark = m.end(), m[0]
        if hidden or mark in ("<!--", "-->"):
            hidden = mark == "<!--" or (hidden and mark != "-->")
            continue
        top = open_[-1]
        if mark in ("{{", "[["):
            node = Node(mark)
            top.parts[-1].append(node)
            open_.append(node)
        elif mark == "|" and top is not root:
            top.parts.append([])
        elif mark in ENDS and (top.kind == ENDS[mark] or (mark == "}}" and any(x.kind == "{{" for x in open_))):
            while (node := open_.pop()).kind != ENDS[mark]:
                pass
            node.whole = True
        else:
            top.parts[-1].append(mark)
    if not hidden and at < len(page):
        open_[-1].parts[-1].append(page[at:])
    return root


def nodes(part: list, kind: str) -> Iterator[Node]:
    """All nodes of a kind, a node before those in it."""
    for x in part:
        if isinstance(x, Node):
            if x.kind == kind:
                yield x
            for inner in x.parts:
                yield from nodes(inner, kind)


def person_kind(node: Node) -> tuple[str, str] | None:
    """The kind of a person's template, and what its first part holds behind the name."""
    name, colon, rest = source_of(node.parts[0]).partition(":")
    name, word = "".join(name.split()).casefold(), re.match(r"\s*(\w*)", rest)
    if colon and name == "#imslpcomposer":
        return "imslpcomposer", rest
    if colon and name == "#fte" and word[1].casefold() in KINDS:
        return word[1].casefold(), rest[word.end() :]
    return None


def fields_of(node: Node, rest: str) -> dict[str, list]:
    """Name -> value (a part) of a template's named parts; of a name given twice the last stands."""
    out = {}
    for part in [[rest], *node.parts[1:]]:
        if part and isinstance(part[0], str) and "=" in part[0]:
            name, _, value = part[0].partition("=")
            out[name.strip().casefold()] = [value, *part[1:]]
    return out


def exact_year(part: list) -> int | None:
    """A year that stands alone; what is about, between years or in a template is none."""
    told = source_of(part).strip()
    return int(told) if told.isdecimal() and len(told) <= 4 else None


def own_title(title: str) -> str:
    """A title without the prefix of English; '' if another language's stands before it."""
    language, colon, rest = title.partition(":")
    if colon and language.casefold() == "en":
        title, (language, colon, _) = rest, rest.partition(":")
    known = colon and 2 <= len(language) <= 12 and all(c == "-" or (c.isascii() and c.isalpha()) for c in language)
    return "" if known else title


def article(part: list) -> str:
    """The English article that a part links to: by its first link with a prefix of articles, else by template, else by address."""
    for link in nodes(part, "[["):
        prefix, colon, title = source_of(link.parts[0]).strip().removeprefix(":").partition(":")
        if colon and prefix.strip().casefold() in ARTICLE_PREFIXES:
            return own_title(title.strip())
    for template in nodes(part, "{{"):
        if source_of(template.parts[0]).strip().casefold() == ARTICLE_TEMPLATE and len(template.parts) > 1 and source_of(template.parts[1]).strip():
            return own_title(source_of(template.parts[1]).strip())
    _, found, title = source_of(part).partition(ARTICLE_ADDRESS)
    return re.split(r"[\s\]]", title, maxsplit=1)[0] if found else ""


def shown(part: list) -> str:
    """A part as a reader sees it: names put together, lists a line for each, links by their label; other templates as they stand."""
    out = []
    for x in part:
        if isinstance(x, str):
            out.append(x)
            continue
        name = source_of(x.parts[0]).strip().casefold()
        if x.kind == "[[":
            out.append("|".join(map(shown, x.parts[1:])) or shown(x.parts[0]))
        elif name in NAME_TEMPLATES:
            out.append(" ".join(filter(None, (shown(p).strip() for p in x.parts[1:]))))
        elif name == LIST_TEMPLATE:
            out.append("\n".join(map(shown, x.parts[1:])))
        else:
            out.append(x.source())
    return "".join(out)


def names_in(part: list) -> list[str]:
    """Distinct names of a part, in order."""
    breaks = re.compile("|".join(map(re.escape, NAME_BREAKS)), re.IGNORECASE)
    return list(dict.fromkeys(filter(None, map(str.strip, breaks.split(shown(part))))))


def person(page: str | None) -> tuple[str, int | None, int | None, str, list[str]]:
    """Kind, years, article and names by a page's first person template; ('none', None, None, '', []) without one."""
    for node in nodes(tree(page or "").parts[0], "{{"):
        if told := person_kind(node):
            had = fields_of(node, told[1])
            part = lambda name: had.get(name, [])  # noqa: E731, B023
            return told[0], exact_year(part("born year")), exact_year(part("died year")), article(part("biography link")), names_in(part("alternate names"))
    return "none", None, None, "", []


@F.pandas_udf(FOUND)
def _persons(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for pages in batches:
        found = pd.DataFrame([person(p) for p in pages], columns=FOUND.names)
        yield found.astype({"born": "Int32", "died": "Int32"})


def person_pages(df: DataFrame, key: str, source: str) -> DataFrame:
    """(key, template_kind, born_year, died_year, wikipedia_title, alternate_names) of each page; 'none' without a template."""
    read = df.select(key, _persons(text(source)).alias("t"))
    return read.select(key, F.col("t.kind").alias("template_kind"), F.col("t.born").alias("born_year"), F.col("t.died").alias("died_year"), F.col("t.title").alias("wikipedia_title"), F.col("t.names").alias("alternate_names"))
