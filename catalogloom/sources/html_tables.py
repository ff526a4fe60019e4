"""Rows of HTML tables: the header's names over the cells of each row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.html_tokens import read_all_tables
from ..operators.homepages import absolute


def table_rows(pages: DataFrame, key: str, html: str, base: str, css: str = "wikitable sortable") -> DataFrame:
    """(key, row, header, values, url): the rows of each page's first table of class ``css``; rows of tables nested in it are not its own.

    The header is the first row's header cells. A row without a data cell is left out, a short one is filled with '', a
    long one cut. ``url`` is the address of the first anchor in the row's first data cell, as seen from ``base``; null
    without one. A page without such a table has no row.
    """
    spaced = lambda c: F.trim(F.regexp_replace(c, r"\s+", " "))
    tables = F.filter("tables", lambda x: spaced(x["class"]) == css)
    read = read_all_tables(pages.select(key, html), html).select(key, F.try_element_at(tables, F.lit(1))["rows"].alias("rows")).where(F.size("rows") > 0)
    header = F.transform(F.filter(F.element_at("rows", 1), lambda c: c["header"]), lambda c: c["words"])
    rows = read.select(key, header.alias("header"), F.posexplode(F.slice("rows", 2, F.size("rows"))).alias("row", "cells"))
    data = rows.withColumn("cells", F.filter("cells", lambda c: ~c["header"])).where(F.size("cells") > 0)
    n = F.size("header")
    filled = F.concat(F.transform("cells", lambda c: c["words"]), F.array_repeat(F.lit(""), n))
    link = F.element_at("cells", 1)["link"]
    return data.select(key, "row", "header", F.slice(filled, F.lit(1), n).alias("values"), F.when(F.coalesce(link, F.lit("")) != "", absolute(F.lit(base), link)).alias("url"))


def cell(name: str) -> Column:
    """The value under a header's name in a row; null if the table has no such name, the last one's if it has two."""
    at = F.array_position(F.reverse("header"), name)
    return F.when(at > 0, F.element_at(F.reverse("values"), at.cast("int")))
