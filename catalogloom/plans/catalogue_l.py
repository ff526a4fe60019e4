"""The nine stages of a derivation over all customers and orders."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import derive
from .catalogue_d import pick, sql_pick
from .registry import query, t

VOCABULARY = ["orchestral", "choral", "piano_solo"]
_WORKS = f"""SELECT o_orderkey AS k, o_custkey AS c, CASE WHEN o_orderkey % 3 = 1 AND o_orderkey % 2 = 0 THEN 'choral' ELSE {sql_pick(['orchestral', 'unclassified', 'piano_solo'], 'o_orderkey')} END AS family, CASE WHEN o_orderkey % 3 <> 1 THEN 'imslp_tags' WHEN o_orderkey % 2 = 0 THEN 'llm_x' ELSE 'empty' END AS src,
    CASE WHEN o_custkey % 10 = 1 THEN 1990 ELSE 1900 + c_nationkey * 5 END AS died FROM orders JOIN customer ON c_custkey = o_custkey"""
_PEOPLE = "SELECT *, CASE WHEN c_custkey % 10 = 1 THEN 1990 ELSE 1900 + c_nationkey * 5 END AS died FROM customer WHERE c_custkey % 50 <> 7"


def _derived(spark, sf):
    customers, orders = t(spark, sf, "customer"), t(spark, sf, "orders")
    c, k, o = F.col("c_custkey"), F.col("o_orderkey"), F.col("o_custkey")
    none, q = F.lit(""), lambda x: F.concat(F.lit("Q"), x)
    people = customers.select(q(c).alias("id"), (1900 + F.col("c_nationkey") * 5).cast("string").alias("death_year"), none.alias("qa_flags"), none.alias("eu_pd_status"), F.lit(0).alias("eu_pd_year"), none.alias("present"), F.lit(0).cast("long").alias("n_works"), none.alias("authority_id"), F.lit("matched").alias("imslp_match_status"), none.alias("category"))
    works = orders.select(q(o).alias("id"), k.alias("work_id"), none.alias("title"), none.alias("instrumentation"), pick(["For orchestra", "", "For piano"], "o_orderkey").alias("cell"), none.alias("family"), none.alias("src"))
    given = F.array_compact(F.array(F.when(c % 10 == 1, F.struct(F.lit("death_year").alias("field"), F.lit("1990").alias("value"))), F.when(c % 50 == 7, F.struct(F.lit("_drop").alias("field"), none.alias("value")))))
    ledger = F.explode(F.array(F.struct(F.lit("a").alias("labeller"), F.array(F.lit("romantic"), F.lit("x")).alias("tags")), F.struct(F.lit("b").alias("labeller"), F.when(c % 2 == 0, F.array(F.lit("romantic"))).otherwise(F.array(F.lit("y"))).alias("tags"))))
    tables = {
        "people": people,
        "works": works,
        "base_works": works.where(F.col("work_id") % 2 == 0).withColumns({"family": F.lit("choral"), "src": F.lit("llm_x")}),
        "overrides": customers.select(q(c).alias("key"), F.explode(given).alias("x")).select("key", "x.*", F.lit("2024-01-01").alias("date")),
        "entities": people.select("id", F.struct("category").alias("e")),
        "authorities": customers.select(q(c).alias("id"), F.lit(True).alias("has_entity"), F.when(c % 2 == 0, F.concat(F.lit("G"), c)).otherwise("").alias("own"), F.lit(True).alias("has_record"), (1900 + F.col("c_nationkey") * 5).alias("record_death"), (c % 3 == 0).alias("has_search"), F.concat(F.lit("F"), c).alias("found"), F.lit(None).cast("int").alias("found_death")),
        "links": customers.where(c % 9 == 0).select(q(c).alias("id"), F.lit("rejected_p839").alias("match_after")),
        "pages": orders.where(k % 7 != 0).select(k.alias("work_id"), F.array(F.concat(F.lower("o_orderstatus"), F.lit(" style")), F.lit("Works first published in 1901")).alias("categories"), F.when(k % 5 == 0, F.array().cast("array<string>")).otherwise(F.array(F.lit("PMLP1-a.pdf"))).alias("files")),
        "blocks": orders.where(k % 6 == 0).select(k.alias("work_id"), F.lit("score").alias("kind"), F.lit("CC-BY-4.0").alias("licence"), F.lit(True).alias("open_licence"), F.lit("").alias("image_type"), none.alias("arranger"), F.lit("pdf").alias("formats")),
        "ledger": customers.select(q(c).alias("id"), ledger.alias("x"), F.lit("2024-01-01").alias("at"), F.lit(1).alias("line")).select("id", "x.*", "at", "line"),
    }
    return derive.run(tables, derive.offline_stages(2026, VOCABULARY, ("a", "b")))


@query(
    f"""SELECT 'Q' || c AS id, k AS work_id, family, src, CASE WHEN k % 7 = 0 THEN '' ELSE lower(o_orderstatus) END AS imslp_style, CASE WHEN k % 7 = 0 THEN '' ELSE '1901' END AS imslp_first_published, CASE WHEN k % 7 = 0 THEN '' WHEN k % 5 = 0 THEN 'false' ELSE 'true' END AS has_files, CASE WHEN k % 7 = 0 OR k % 5 = 0 THEN '' ELSE 'ca' END AS hosts,
    CASE WHEN k % 6 = 0 THEN 'CC-BY-4.0' ELSE '' END AS licences, CASE WHEN k % 6 = 0 THEN 'edition' ELSE '' END AS scope FROM ({_WORKS}) JOIN orders ON o_orderkey = k WHERE c % 50 <> 7 AND c % 9 <> 0"""
)
def derived_works(spark, sf):
    works = _derived(spark, sf)[0]["works"]
    return works.select("id", "work_id", "family", "src", "imslp_style", "imslp_first_published", "has_files", F.col("imslp_file_hosts").alias("hosts"), F.col("imslp_open_licences").alias("licences"), F.col("imslp_open_scope").alias("scope"))


@query(
    f"""SELECT 'Q' || c_custkey AS id, CAST(died AS VARCHAR) AS death_year, CASE WHEN died + 71 <= 2026 THEN 'pd' ELSE 'not_pd' END AS eu_pd_status, CAST(died + 71 AS INTEGER) AS eu_pd_year, coalesce(array_to_string(list_filter(['orchestral', 'choral', 'piano_solo'], lambda x: list_contains(f, x)), '|'), '') AS present, coalesce(n, 0) AS n_works,
    concat_ws('|', CASE WHEN c_custkey % 10 = 1 THEN 'manual_override' END, CASE WHEN c_custkey % 2 = 1 AND c_custkey % 3 = 0 THEN 'gnd_from_lobid' END, CASE WHEN c_custkey % 2 = 0 AND died <> 1900 + c_nationkey * 5 THEN 'gnd_death_conflict' END) AS qa_flags,
    CASE WHEN c_custkey % 2 = 0 THEN 'G' || c_custkey WHEN c_custkey % 3 = 0 THEN 'F' || c_custkey ELSE '' END AS authority_id, CASE WHEN c_custkey % 9 = 0 THEN 'rejected_p839' ELSE 'matched' END AS imslp_match_status, CASE WHEN c_custkey % 2 = 0 THEN 'romantic' ELSE '' END AS llm_style_tags
    FROM ({_PEOPLE}) LEFT JOIN (SELECT c, list(DISTINCT family) AS f, count(*) AS n FROM ({_WORKS}) WHERE family <> 'unclassified' GROUP BY 1) ON c = c_custkey"""
)
def derived_people(spark, sf):
    return _derived(spark, sf)[0]["people"].drop("category")


@query(
    f"""SELECT stage, "table", rows FROM (SELECT unnest([{{'stage': 'remap_force', 't': 'works', 'n': a}}, {{'stage': 'carry_forward', 't': 'works', 'n': a}}, {{'stage': 'remap_people', 't': 'people', 'n': p}}, {{'stage': 'apply_overrides', 't': 'people', 'n': q}}, {{'stage': 'apply_overrides', 't': 'works', 'n': b}}, {{'stage': 'remap_authorities', 't': 'people', 'n': q}},
    {{'stage': 'remap_matches', 't': 'works', 'n': d}}, {{'stage': 'remap_matches', 't': 'people', 'n': q}}, {{'stage': 'remap_matches', 't': 'match_report', 'n': 1}}, {{'stage': 'remap_evidence', 't': 'works', 'n': d}}, {{'stage': 'remap_open_licences', 't': 'works', 'n': d}}, {{'stage': 'apply_styles', 't': 'people', 'n': q}}]) AS x FROM
    (SELECT count(*) AS a, count(*) FILTER (o_custkey % 50 <> 7) AS b, count(*) FILTER (o_custkey % 50 <> 7 AND o_custkey % 9 <> 0) AS d FROM orders), (SELECT count(*) AS p, count(*) FILTER (c_custkey % 50 <> 7) AS q FROM customer)) CROSS JOIN LATERAL (SELECT x.stage AS stage, x.t AS "table", x.n AS rows)"""
)
def derivation_records(spark, sf):
    rows = [(r["stage"], table, n) for r in _derived(spark, sf)[1] for table, n in r["row_counts"].items()]
    return spark.createDataFrame(rows, "stage string, table string, rows long")
