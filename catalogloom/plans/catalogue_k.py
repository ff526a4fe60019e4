"""Queries of typed cells, stored answers, the order of results, pilot samples and prepared results, over whole tables."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..operators import audits, facets
from ..sources import revisions, tables
from .catalogue_d import pick, sql_pick
from .registry import query, t

# Cells written as text and read under a schema; some are not of their type.

ODD = ["12", "1.0", "x", "", " 7 "]


def _cells(spark, sf):
    rows = t(spark, sf, "customer").select(F.col("c_custkey").alias("id"), pick(ODD, "c_custkey").alias("n"), F.col("c_acctbal").alias("balance"), F.concat("c_name", F.lit('\t"q"\nx')).alias("name"), F.when(F.col("c_custkey") % 3 == 0, "maybe").otherwise("true").alias("flag"))
    path = f"{tables.shared_folder(spark)}/cells-{uuid.uuid4().hex}"
    tables.write_tsv(rows, path)
    return tables.typed(tables.read_tsv(spark, path), "id long, n int, balance double, name string, flag boolean, later date", ["id"])


@query(f"SELECT c_custkey AS id, CAST({sql_pick(['12', '1', '-1', '-1', '7'], 'c_custkey')} AS INTEGER) AS n, c_acctbal AS balance, md5(c_name || chr(9) || '\"q\"' || chr(10) || 'x') AS name, c_custkey % 3 <> 0 AS flag FROM customer")
def typed_cells(spark, sf):
    cells = _cells(spark, sf)[0]
    return cells.where("later IS NULL").select("id", F.coalesce("n", F.lit(-1)).alias("n"), "balance", F.md5("name").alias("name"), F.coalesce("flag", F.lit(False)).alias("flag"))


@query("SELECT CAST(c_custkey AS VARCHAR) AS id, 'n' AS \"column\", 'x' AS cell FROM customer WHERE c_custkey % 5 = 2 UNION ALL SELECT CAST(c_custkey AS VARCHAR), 'flag', 'maybe' FROM customer WHERE c_custkey % 3 = 0")
def untyped_cells(spark, sf):
    return _cells(spark, sf)[1]


# Views by stored answers: each customer's orders are its article's months.


@query("""SELECT c_custkey, CASE WHEN c_custkey % 6 = 0 OR c_custkey % 6 = 2 OR c_custkey % 6 = 3 THEN 'nan' WHEN c_custkey % 6 = 1 THEN '0' ELSE CAST(coalesce(v, 0) AS VARCHAR) END AS views FROM customer LEFT JOIN (SELECT o_custkey, CAST(sum(o_orderkey % 100) AS BIGINT) AS v FROM orders GROUP BY 1) ON o_custkey = c_custkey""")
def stored_views(spark, sf):
    k = F.col("c_custkey")
    months = t(spark, sf, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.collect_list(F.struct((F.col("o_orderkey") % 100).alias("views"))).alias("items"))
    rows = t(spark, sf, "customer").join(months, "c_custkey", "left")
    body = F.when(k % 6 == 3, '{"items": [').otherwise(F.to_json(F.struct("items")))
    status = F.when(k % 6 == 1, 404).when(k % 6 == 2, 500).otherwise(200)
    views = tables.page_views(F.when(k % 6 == 0, "").otherwise(F.concat(F.lit("https://h/wiki/C"), k)), status, body)
    return rows.select("c_custkey", F.when(F.isnan(views), "nan").otherwise(views.cast("long").cast("string")).alias("views"))


# Entities of stored answers, a batch for each customer; one that a batch misses may be in another.


@query("SELECT 'Q' || (o_orderkey % 500) AS id, CASE WHEN count(*) FILTER (o_orderkey % 3 <> 0) > 0 THEN '{\"claims\":{},\"id\":\"Q' || (o_orderkey % 500) || '\"}' END AS entity, count(*) FILTER (o_orderkey % 3 <> 0) = 0 AS missing FROM orders GROUP BY o_orderkey % 500")
def stored_entities(spark, sf):
    k = F.col("o_orderkey")
    key = F.concat(F.lit("Q"), k % 500)
    entity = F.concat(F.lit('"'), key, F.lit('":'), F.when(k % 3 == 0, F.concat(F.lit('{"id":"'), key, F.lit('","missing":""}'))).otherwise(F.concat(F.lit('{"claims":{},"id":"'), key, F.lit('"}'))))
    one = t(spark, sf, "orders").select("o_custkey", key.alias("key"), k, entity.alias("e")).groupBy("o_custkey", "key").agg(F.max_by("e", F.struct(k % 3 != 0, k)).alias("e"))
    bodies = one.groupBy("o_custkey").agg(F.concat(F.lit('{"entities":{'), F.array_join(F.collect_list("e"), ","), F.lit("}}")).alias("body"))
    return tables.entities_of(bodies, "body")


# The order of results, both ways, missing values last.


def _sorted(way):
    return f"SELECT c_custkey, row_number() OVER (ORDER BY CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE round(c_acctbal / 500) END {way} NULLS LAST, c_name, c_custkey) - 1 AS place FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD')"


def _in_order(spark, sf, descending):
    people = t(spark, sf, "customer").withColumn("worth", F.when(F.col("c_custkey") % 7 != 0, F.round(F.col("c_acctbal").cast("double") / 500)))
    asked = facets.FacetQuery(parent_in={"c_mktsegment": ("BUILDING", "MACHINERY", "HOUSEHOLD")}, sort="worth", descending=descending)
    return facets.run_numbered(asked, people, t(spark, sf, "orders"), "c_custkey", "o_custkey", "c_name").select("c_custkey", "place")


@query(_sorted("ASC"))
def results_in_order(spark, sf):
    return _in_order(spark, sf, False)


@query(_sorted("DESC"))
def results_in_reverse(spark, sf):
    return _in_order(spark, sf, True)


# A pilot sample of people made of orders.

_PEOPLE = "SELECT o_orderkey AS k, md5('pilot:' || o_orderkey) AS h, o_orderkey % 3 = 0 AS wd, o_orderkey % 4 = 0 AND o_custkey % 3 <> 0 AND o_orderkey % 3 <> 0 AS pd, o_orderkey % 5 <> 0 AS wiki FROM orders WHERE o_orderkey % 8 <> 1"
_WD = f"SELECT k FROM ({_PEOPLE}) WHERE wd ORDER BY h, k LIMIT 40"
_PD = f"SELECT k FROM ({_PEOPLE}) WHERE pd AND k NOT IN ({_WD}) ORDER BY h, k LIMIT 40"


@query(f"SELECT k AS o_orderkey, 'wikidata' AS \"group\" FROM ({_WD}) UNION ALL SELECT k, 'pd' FROM ({_PD}) UNION ALL SELECT k, 'other' FROM (SELECT k FROM ({_PEOPLE}) WHERE wiki AND k NOT IN ({_WD}) AND k NOT IN ({_PD}) ORDER BY wd OR pd, h, k LIMIT 20)")
def pilot_people(spark, sf):
    k = F.col("o_orderkey")
    people = t(spark, sf, "orders").select(k, F.when(k % 8 == 1, "x|not_human").otherwise("x").alias("qa_flags"), F.when(k % 3 == 0, "wikidata").otherwise("").alias("style_tags_src"), F.when(k % 3 == 0, "romantic").otherwise("").alias("style_tags"), F.when(k % 4 == 0, "pd").otherwise("not_pd").alias("eu_pd_status"), (F.col("o_custkey") % 3).cast("string").alias("imslp_works_count"), F.when(k % 5 != 0, "w").otherwise("").alias("wikipedia_url"))
    return audits.pilot_of_people(people, "o_orderkey", "pilot")


# A result under its source's contract: columns in order, an addition behind, the date stamped.


@query("SELECT c_custkey, c_name, 'r7' AS dump_date, c_nationkey * 2 AS n_players, 'k' || c_custkey AS note FROM customer")
def prepared_result(spark, sf):
    source = t(spark, sf, "customer").select("c_custkey", "c_name", F.lit("r6").alias("dump_date"))
    changed = revisions.with_columns_after(source, "c_custkey", {"note": F.concat(F.lit("k"), "c_custkey")}).join(t(spark, sf, "customer").select("c_custkey", (F.col("c_nationkey") * 2).alias("n_players")), "c_custkey")
    return revisions.prepared(changed, source.columns, "r7", ["note", "n_players"])
