"""Queries of canonical records, answers of searches, lists that came in parts and pages stored by address, over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.canonical import canonical_json, input_hash
from ..sources import search_answers, tables
from .registry import query, t

# Records as canonical JSON: names in order, quotes, backslashes and control characters escaped.

_NAME = """'"' || replace(replace(replace(c_name || x, '\\', '\\\\'), '"', '\\"'), chr(10), '\\n') || '"'"""
_JSON = f"""'{{"balance":' || c_acctbal || ',"keys":[' || c_custkey || ',' || CASE WHEN c_custkey % 2 = 0 THEN 'null' ELSE CAST(c_nationkey AS VARCHAR) END || '],"name":' || {_NAME} || ',"odd":' || (c_custkey % 2 = 1) || ',"segment":{{"' || lower(c_mktsegment) || '":true}}}}'"""


@query(f"""SELECT c_custkey, j AS json, sha256('{{"prompt_version":"v1 \\"x\\"","record":' || j || '}}') AS hash FROM (SELECT c_custkey, {_JSON} AS j FROM (SELECT *, CASE c_custkey % 4 WHEN 0 THEN '' WHEN 1 THEN '"\\' WHEN 2 THEN chr(10) || 'é' ELSE chr(7) END AS x FROM customer) WHERE c_custkey % 4 <> 3
    UNION ALL SELECT c_custkey, replace({_JSON}, chr(7), '\\u0007') FROM (SELECT *, chr(7) AS x FROM customer WHERE c_custkey % 4 = 3))""")
def canonical_records(spark, sf):
    k = F.col("c_custkey")
    more = F.when(k % 4 == 0, "").when(k % 4 == 1, '"\\').when(k % 4 == 2, "\né").otherwise("\x07")
    record = F.struct(F.concat("c_name", more).alias("name"), F.array(k, F.when(k % 2 == 1, F.col("c_nationkey"))).alias("keys"), F.col("c_acctbal").cast("double").alias("balance"), (k % 2 == 1).alias("odd"), F.create_map(F.lower("c_mktsegment"), F.lit(True)).alias("segment"))
    rows = t(spark, sf, "customer").select("c_custkey", record.alias("r"))
    kind = rows.schema["r"].dataType
    return rows.select("c_custkey", canonical_json(F.col("r"), kind).alias("json"), input_hash(F.col("r"), kind, 'v1 "x"').alias("hash"))


# Batch files of a search: every order gives a line, some a header before it and some a broken line after it.

_LINES = r"""SELECT 'b' || (o_custkey % 20) AS batch, o_orderkey * 3 + j AS line, j, o_custkey AS c, o_orderkey AS k FROM orders, (SELECT unnest([0, 1, 2]) AS j) WHERE j = 1 OR (j = 0 AND o_orderkey % 7 = 0) OR (j = 2 AND o_orderkey % 11 = 0)"""
_SESSIONS = f"SELECT *, sum((j = 0)::INT) OVER (PARTITION BY batch ORDER BY line) AS session, row_number() OVER (ORDER BY batch, line) - 1 AS place FROM ({_LINES})"
_GOOD = f"SELECT * FROM ({_SESSIONS}) WHERE j = 1 AND c % 9 <> 0 AND k % 6 <> 0"


def _answer_lines(spark, sf):
    k, tab = F.col("o_orderkey"), F.lit("\t")
    url = F.when(k % 6 == 0, "ftp://h/x").when(k % 4 == 0, "").otherwise(F.concat(F.lit("https://h.org/"), k))
    row = F.concat(F.lit("Q"), "o_custkey", tab, (k % 5).cast("string"), tab, url, tab, F.lit(" title "), k)
    each = F.array(F.when(k % 7 == 0, F.concat(F.lit("# tokens_used="), F.format_number(k, 0))), row, F.when(k % 11 == 0, F.lit("Q1 no tabs")))
    lines = t(spark, sf, "orders").select(F.concat(F.lit("b"), F.col("o_custkey") % 20).alias("batch"), (k * 3).alias("k"), "o_custkey", F.posexplode(each).alias("j", "value")).where("value IS NOT NULL")
    asked = lines.where("o_custkey % 9 <> 0").select("batch", F.concat(F.lit("Q"), "o_custkey").alias("key"))
    return lines.select("batch", F.col("batch").alias("file"), F.lit(0).cast("long").alias("block"), (F.col("k") + F.col("j")).alias("line"), "value"), asked


@query(f"SELECT batch, CAST(session AS BIGINT) AS session, 'Q' || c AS key, CAST(k % 5 AS INTEGER) AS rank, CASE WHEN k % 4 = 0 THEN '' ELSE 'https://h.org/' || k END AS url, 'title ' || k AS title, place FROM (SELECT *, max(session) OVER (PARTITION BY batch, c) AS last FROM ({_GOOD})) WHERE session = last")
def search_rows(spark, sf):
    return search_answers.answers(*_answer_lines(spark, sf))[0]


@query(f"SELECT batch, place, CASE WHEN j = 2 THEN 'no row' WHEN c % 9 = 0 THEN 'unknown key' ELSE 'bad address' END AS fault FROM ({_SESSIONS}) WHERE j = 2 OR (j = 1 AND (c % 9 = 0 OR k % 6 = 0))")
def search_faults(spark, sf):
    return search_answers.answers(*_answer_lines(spark, sf))[1].drop("value")


@query(f"SELECT batch, CAST(max(session) AS BIGINT) AS sessions, CAST(coalesce(sum(k) FILTER (j = 0), 0) AS BIGINT) AS tokens, count(DISTINCT c) FILTER (j = 1 AND c % 9 <> 0) AS answered, 0 AS missing FROM ({_SESSIONS}) GROUP BY 1")
def search_sessions(spark, sf):
    return search_answers.session_report(*_answer_lines(spark, sf))


# Tool calls of a search run: a customer's orders search for its name, the least order first.

_EVENTS = "SELECT o_custkey AS c, min(o_orderkey) AS k FROM orders WHERE o_orderkey % 5 <> 0 GROUP BY 1"


@query(f"SELECT 'b' AS batch, 'Q' || c AS key, CAST(r AS INTEGER) AS rank, CASE WHEN r = 0 THEN '' ELSE 'https://h.org/' || k || '/' || r END AS url, CASE WHEN r = 0 THEN '' ELSE 'a b' || r END AS title FROM (SELECT c, k, unnest(CASE WHEN k % 3 = 0 THEN [0] ELSE [1, 2, 3] END) AS r FROM ({_EVENTS}))")
def search_call_rows(spark, sf):
    k, name = F.col("o_orderkey"), F.concat(F.lit("Name "), F.col("o_custkey"), F.lit(" X"))
    link = lambda i: F.concat(F.lit(f"{i}. [a  b{i}](https://h.org/"), k, F.lit(f"/{i})"))
    chunk = F.when(k % 3 == 0, "nothing\n1. [no](https://h.org/no)").otherwise(F.concat_ws("\n", F.lit("found"), F.lit(" Links: "), *(link(i) for i in range(1, 5)), F.lit("that is all"), F.lit("9. [no](https://h.org/no)")))
    done = F.when(k % 5 == 0, F.lit(None)).otherwise(F.struct(F.array(F.struct(chunk.alias("chunk"))).alias("references")))
    call = F.struct(F.struct(F.concat(F.lit('"'), F.upper(name), F.lit('"  score')).alias("searchTerm")).alias("args"), F.struct(done.alias("success")).alias("result"))
    event = F.to_json(F.struct(F.lit("tool_call").alias("type"), F.lit("completed").alias("subtype"), F.struct(call.alias("webSearchToolCall")).alias("tool_call")))
    orders = t(spark, sf, "orders")
    events = orders.select(F.lit("b").alias("batch"), k.alias("place"), event.alias("value"))
    queries = orders.select(F.lit("b").alias("batch"), F.concat(F.lit("Q"), F.col("o_custkey")).alias("key"), F.concat(name, F.lit(" score")).alias("query"), name.alias("name")).distinct()
    return search_answers.search_events(events, queries, 3)[0]


# Lists of an order that came in parts, line by line.

_PARTS = "SELECT l_orderkey AS k, l_linenumber AS part, unnest(['s' || (l_suppkey % 4), l_returnflag, 's' || (l_suppkey % 4)]) AS v, unnest([0, 1, 2]) AS pos FROM lineitem"


@query(f"""WITH f AS (SELECT k, v, min(part * 10 + pos) AS first FROM ({_PARTS}) GROUP BY 1, 2) SELECT o_orderkey, coalesce('t' || (SELECT min(l_linenumber) FROM lineitem WHERE l_orderkey = o_orderkey), '') AS title, coalesce(l, '') AS categories, n IS NULL OR coalesce(m, false) AS missing, coalesce(r, false) AS redirect
    FROM orders LEFT JOIN (SELECT k, string_agg(v, '|' ORDER BY first, v) AS l, count(*) AS n FROM f GROUP BY 1) ON k = o_orderkey LEFT JOIN (SELECT l_orderkey, bool_or(l_linenumber = 3 AND l_orderkey % 5 = 0) AS m, bool_or(l_linenumber = 2) AS r FROM lineitem GROUP BY 1) ON l_orderkey = o_orderkey""")
def page_lists_merged(spark, sf):
    n, named = F.col("l_linenumber"), lambda c: F.concat(F.lit("Category:"), c)
    mode = F.concat(F.lit("s"), F.col("l_suppkey") % 4)
    parts = t(spark, sf, "lineitem").select(F.col("l_orderkey").alias("o_orderkey"), n.alias("part"), F.concat(F.lit("t"), n).alias("title"), F.array(named(mode), F.col("l_returnflag"), named(mode)).alias("categories"), ((n == 3) & (F.col("l_orderkey") % 5 == 0)).alias("missing"), F.when(n == 2, True).alias("redirect"))
    out = tables.merge_page_lists(parts.unionByName(parts), "o_orderkey", "categories", "Category:", t(spark, sf, "orders"))
    return out.withColumn("categories", F.array_join("categories", "|"))


# Pages stored by address under a hash of one digit, so that many addresses share one.


@query("""SELECT url, md5(CASE WHEN hit THEN arg_max(html, page_id) END) AS digest, hit AS found FROM (SELECT url || CASE WHEN i = 1 THEN '' ELSE '#never' END AS url, i = 1 AS hit, html, page_id FROM pages, (SELECT unnest([1, 2]) AS i)) GROUP BY url, hit""")
def pages_by_url(spark, sf):
    pages = t(spark, sf, "pages")
    weak = lambda url: F.substring(F.sha2(url, 256), 1, 1)
    path = f"{tables.shared_folder(spark)}/pages-{uuid.uuid4().hex}"
    tables.write_by_url(pages.select("url", F.col("html").alias("payload"), F.timestamp_seconds("page_id").alias("stored_at")), path, weak)
    wanted = pages.select("url").unionByName(pages.select(F.concat("url", F.lit("#never")).alias("url")))
    return tables.read_by_url(wanted, path, weak).select("url", F.md5("payload").alias("digest"), "found")
