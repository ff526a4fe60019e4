"""Answers of search runs as rows: ranked lines of batch files, and events of tool calls.

A batch file is a stream of lines: a header ('# name=value') begins a session, ranked lines ('key, rank, address,
title' by tabs) belong to the session above them, and a run that tries again appends further sessions. Lines
are placed by (file, block, line) over ranges, headers are counted per bucket of places, and a line's session is the
count of session heads up to it: no file is read by one task because it is one file.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..functions.cells import let, text
from ..operators.statistics import places
from .tables import checkpointed

#: Fixed value: how a key looks.
KEY = r"^Q\d+$"
HEADER = r"^#\s*([a-z_]+)=(.*)$"
#: The header that begins a session, and the one that lists keys without an answer.
HEAD, MISSING = "tokens_used", "missing"
#: Lines that one task orders to count heads.
BUCKET = 100_000
EVENT = "type string, subtype string, usage map<string,bigint>, tool_call map<string,struct<args:struct<searchTerm:string>,result:struct<success:struct<references:array<struct<chunk:string>>>>>>"
#: The tool whose results are read, and those that may succeed beside it.
SEARCH_TOOL, HARMLESS_TOOLS = "webSearchToolCall", ["getMcpToolsToolCall"]


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(batch, file, block, line, value): lines of text files with their order; the batch is the file's name without its ending."""
    m = F.col("_metadata")
    lines = spark.read.text(path).select(F.regexp_replace(m["file_name"], r"\.[^.]*$", "").alias("batch"), m["file_name"].alias("file"), m["file_block_start"].alias("block"), F.monotonically_increasing_id().alias("line"), F.regexp_replace("value", r"\r$", "").alias("value"))
    return lines


def sessions(lines: DataFrame, head: Column) -> DataFrame:
    """``lines`` with ``place`` over all files and ``session``: in each file the number of heads up to the line (0: before the first).

    lines: file, block, line and others. Counts per (file, bucket of places) are summed up; rows are ordered within buckets only.
    """
    placed, _ = places(lines.withColumn("_head", F.coalesce(head, F.lit(False)).cast("int")), ["file", "block", "line"])
    placed = placed.withColumn("_bucket", F.floor(F.col("_place") / BUCKET))
    counts = placed.groupBy("file", "_bucket").agg(F.sum("_head").alias("_n"))
    before = counts.withColumn("_before", F.coalesce(F.sum("_n").over(Window.partitionBy("file").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    within = F.sum("_head").over(Window.partitionBy("file", "_bucket").orderBy("_place"))
    return placed.join(before, ["file", "_bucket"]).withColumn("session", (F.col("_before") + within).cast("long")).withColumnRenamed("_place", "place").drop("_head", "_bucket", "_before")


def parsed(lines: DataFrame) -> DataFrame:
    """Lines with their session and parts: ``name``/``told`` of headers, ``key``, ``rank``, ``url``, ``title`` of ranked lines; ``kind`` is header, row, blank or other."""
    part = lambda i: F.regexp_extract("value", HEADER, i)
    cells = F.split("value", "\t", 4)
    cell = lambda i: F.coalesce(F.try_element_at(cells, F.lit(i)), F.lit(""))
    is_header = F.col("value").rlike(HEADER)
    is_row = (F.size(cells) > 2) & cell(1).rlike(KEY) & cell(2).rlike(r"^\d+$") & ~cell(3).rlike(r"\s")
    kind = F.when(F.trim("value") == "", "blank").when(is_header, "header").when(is_row, "row").otherwise("other")
    rows = sessions(lines, is_header & (part(1) == HEAD)).withColumn("kind", kind)
    of = lambda k, c: F.when(F.col("kind") == k, c)
    return rows.withColumns({"name": of("header", part(1)), "told": of("header", F.trim(part(2))), "key": of("row", cell(1)), "rank": of("row", cell(2).try_cast("int")), "url": of("row", cell(3)), "title": of("row", F.trim(cell(4)))})


def answers(lines: DataFrame, asked: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows (batch, session, key, rank, url, title, place), and faults (batch, place, value, fault).

    asked: batch, key. A key that several sessions of a batch answer has the rows of the last of them. Faults: lines of no known form, keys
    that the batch did not ask for, ranks that are no number, addresses that are none.
    """
    rows = checkpointed(parsed(lines))
    wanted = asked.select("batch", "key", F.lit(True).alias("_asked")).distinct()
    judged = rows.where("kind = 'row' OR kind = 'other'").join(wanted, ["batch", "key"], "left")
    address = (F.col("url") == "") | F.col("url").startswith("http://") | F.col("url").startswith("https://")
    fault = F.when(F.col("kind") == "other", "no row").when(F.col("_asked").isNull(), "unknown key").when(F.col("rank").isNull(), "bad rank").when(~address, "bad address")
    judged = judged.withColumn("fault", fault)
    good = judged.where("fault IS NULL")
    last = good.groupBy("batch", "key").agg(F.max("session").alias("session"))
    return good.join(last, ["batch", "key", "session"]).select("batch", "session", "key", "rank", "url", "title", "place"), judged.where("fault IS NOT NULL").select("batch", "place", "value", "fault")


def session_report(lines: DataFrame, asked: DataFrame) -> DataFrame:
    """(batch, sessions, tokens, answered, missing): headers of all sessions of a batch, keys answered in any, and keys asked for that none answered."""
    rows = checkpointed(parsed(lines))
    tokens = F.expr("try_cast(regexp_replace(told, ',', '') AS bigint)")
    heads = rows.where("kind = 'header'").groupBy("batch").agg(F.max("session").alias("sessions"), F.coalesce(F.sum(F.when(F.col("name") == HEAD, tokens)), F.lit(0)).alias("tokens"))
    found = rows.where("kind = 'row'").select("batch", "key", F.lit(1).alias("_found")).distinct()
    keys = asked.select("batch", "key").distinct().join(found, ["batch", "key"], "left").groupBy("batch").agg(F.count("_found").alias("answered"), F.count_if(F.col("_found").isNull()).alias("missing"))
    return keys.join(heads, "batch", "left").select("batch", F.coalesce("sessions", F.lit(0)).alias("sessions"), F.coalesce("tokens", F.lit(0)).alias("tokens"), "answered", "missing")


def plain_query(c) -> Column:
    """A query without quotes and case, white space as single spaces."""
    return F.trim(F.regexp_replace(F.lower(F.replace(text(c), F.lit('"'), F.lit(" "))), r"\s+", " "))


def numbered_links(chunk: Column) -> Column:
    """array<struct<url, title>> of the numbered lines right below a line 'Links:'."""
    numbered = r"^\d+\.\s+\["

    def link(line: Column) -> Column:
        """The parts of a line '1. [title](address)'; null for another."""
        end = F.substring_index(line, "](", -1)
        title = F.regexp_replace(F.left(line, F.char_length(line) - F.char_length(end) - 2), numbered, "")
        fits = line.rlike(numbered) & F.contains(line, F.lit("](")) & end.rlike(r"^https?://\S+\)$")
        return F.when(fits, F.struct(F.left(end, F.char_length(end) - 1).alias("url"), F.trim(F.regexp_replace(title, r"\s+", " ")).alias("title")))

    # Each step is a lambda's variable, so that what later steps name again is computed once.
    def below(lines: Column) -> Column:
        return let(F.array_position(lines, "Links:"), lambda at: F.when(at > 0, F.slice(lines, at.cast("int") + 1, F.size(lines))).otherwise(F.array().cast("array<string>")))

    def unbroken(found: Column) -> Column:
        return let(F.array_position(F.transform(found, lambda x: x.isNull()), True), lambda stop: F.when(stop > 0, F.slice(found, F.lit(1), stop.cast("int") - 1)).otherwise(found))

    trimmed = F.transform(F.split(F.coalesce(chunk, F.lit("")), r"\r\n|\r|\n"), lambda x: F.trim(x))
    return let(F.transform(let(trimmed, below), link), unbroken)


def tool_calls(events: DataFrame) -> DataFrame:
    """(batch, place, call): the tool calls that succeeded. An event is read once: filters on what was read do not pass an outer generator, so none reads it again."""
    completed = F.filter(F.array(F.from_json("value", EVENT)), lambda e: (e["type"] == "tool_call") & (e["subtype"] == "completed"))
    read = events.select("batch", "place", F.explode_outer(completed).alias("e")).where("e IS NOT NULL")
    return read.select("batch", "place", F.element_at(F.map_entries("e.tool_call"), 1).alias("call")).where(F.col("call.value.result.success").isNotNull())


def names_held(terms: DataFrame, asked: DataFrame) -> DataFrame:
    """(batch, term, n, named) of the terms that hold names of their batch: how many rows of ``asked`` they hold, and the least key of these.

    terms: batch, term, each once; asked: batch, key, name. Parts of a term as long as some name is join names by equality, so
    the rows are as many as a term has such parts, whatever the number of names: no term meets every name.
    """
    names = asked.where("name <> ''").groupBy("batch", "name").agg(F.count(F.lit(1)).alias("_n"), F.min("key").alias("_key"))
    sizes = asked.agg(F.collect_set(F.char_length("name")).alias("_sizes"))
    long = F.char_length("term")
    sized = terms.crossJoin(F.broadcast(sizes)).select("batch", "term", F.explode("_sizes").alias("_size")).where((F.col("_size") > 0) & (F.col("_size") <= long))
    parts = sized.select("batch", "term", "_size", F.explode(F.sequence(F.lit(1), long - F.col("_size") + 1)).alias("_at")).select("batch", "term", F.substr("term", "_at", "_size").alias("name"))
    held = parts.join(names, ["batch", "name"]).groupBy("batch", "term", "name").agg(F.max("_n").alias("_n"), F.min("_key").alias("_key"))
    return held.groupBy("batch", "term").agg(F.sum("_n").alias("n"), F.min("_key").alias("named"))


def search_events(events: DataFrame, queries: DataFrame, top: int = 10) -> tuple[DataFrame, DataFrame]:
    """Rows (batch, key, rank, url, title) of the first successful search for each key, rank 0 without links; and faults (batch, place, fault, term).

    events: batch, place, value (JSON). queries: batch, key, query, name. A search's key is that of its query or, if the term is no
    query, of the one name that it holds. Faults: ``no key`` for terms of no or several keys, ``tool`` for other tools that succeeded.
    """
    calls = tool_calls(events)
    breach = calls.where(~F.col("call.key").isin(SEARCH_TOOL, *HARMLESS_TOOLS)).select("batch", "place", F.lit("tool").alias("fault"), F.col("call.key").alias("term"))
    done = checkpointed(calls.where(F.col("call.key") == SEARCH_TOOL).select("batch", "place", plain_query("call.value.args.searchTerm").alias("term"), F.transform(F.coalesce("call.value.result.success.references", F.array().cast("array<struct<chunk:string>>")), lambda r: r["chunk"]).alias("chunks")))
    asked = checkpointed(queries.select("batch", "key", plain_query("query").alias("term"), plain_query("name").alias("name")))
    direct = asked.groupBy("batch", "term").agg(F.max("key").alias("direct"))
    named = names_held(done.select("batch", "term").join(direct, ["batch", "term"], "left_anti").distinct(), asked)
    keyed = done.join(direct, ["batch", "term"], "left").join(named, ["batch", "term"], "left").withColumn("key", F.coalesce("direct", F.when(F.col("n") == 1, F.col("named"))))
    first = keyed.where("key IS NOT NULL").groupBy("batch", "key").agg(F.min_by("chunks", "place").alias("chunks"))
    links = F.slice(F.flatten(F.transform("chunks", numbered_links)), 1, top)
    rows = first.select("batch", "key", F.posexplode_outer(links).alias("at", "link")).select("batch", "key", F.coalesce(F.col("at") + 1, F.lit(0)).alias("rank"), text("link.url").alias("url"), text("link.title").alias("title"))
    return rows, keyed.where("key IS NULL").select("batch", "place", F.lit("no key").alias("fault"), "term").unionByName(breach)
