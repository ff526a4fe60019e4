"""Queries over the driver's tables: audits, pooled answers, agreement, report heads."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import audits
from .catalogue_b import _LATEST, _latest
from .catalogue_d import pick, sql_pick
from .registry import query, t

# A registry of one row for each supplier, with faults by its key.

LICENCES, URLS, COUNTS = ["CC-BY-4.0", "PD-note", "CC0-1.0", ""], ["https://a.org/x", "ftp://a.org/x", "http://b.org", ""], ["12", "-1", "many"]
_ROWS = f"SELECT CASE WHEN s_suppkey % 13 = 0 THEN '' WHEN s_suppkey % 10 = 1 THEN 'Q' || (s_suppkey // 20) ELSE 'S' || s_suppkey END AS id, {sql_pick(LICENCES, 's_suppkey')} AS l, {sql_pick(URLS, 's_suppkey // 4')} AS u, {sql_pick(COUNTS, 's_suppkey')} AS n FROM supplier"


@query(
    f"""WITH r AS ({_ROWS}), k AS (SELECT * FROM r WHERE id <> '') SELECT '' AS id, 'missing key' AS error, 'id' AS "column" FROM r WHERE id = '' UNION ALL SELECT id, 'missing field', 'licence' FROM k WHERE l = '' UNION ALL SELECT id, 'missing field', 'url' FROM k WHERE u = ''
    UNION ALL SELECT id, 'licence is not open', 'licence' FROM k WHERE l = 'PD-note' UNION ALL SELECT id, 'not an http url', 'url' FROM k WHERE u LIKE 'ftp%' UNION ALL SELECT id, 'not a count', 'n_links' FROM k WHERE n <> '12' UNION ALL SELECT id, 'duplicate key', 'id' FROM k GROUP BY id HAVING count(*) > 1"""
)
def registry_errors(spark, sf):
    k = F.col("s_suppkey")
    key = F.when(k % 13 == 0, " ").when(k % 10 == 1, F.concat(F.lit("Q"), F.expr("s_suppkey div 20"))).otherwise(F.concat(F.lit("S"), k))
    rows = t(spark, sf, "supplier").select(key.alias("id"), pick(LICENCES, "s_suppkey").alias("licence"), pick(URLS, "s_suppkey div 4").alias("url"), pick(COUNTS, "s_suppkey").alias("n_links"))
    return audits.registry_errors(rows, "id", ["licence", "url"], "licence", ["url"], ["n_links"])


# A crosswalk of one row for each part, against a vocabulary of the parts' types and the nations' names.

SCHEMES, RELATIONS, URIS = ["x", "", "z"], ["exactMatch", "sameAs", "", "closeMatch"], ["http://x.org/gf0000000001", "http://y.org/gf0000000001", "http://x.org/1", ""]
_CROSS = f"SELECT CASE WHEN p_partkey % 5 = 0 THEN 'mood' ELSE 'type' END AS facet, p_type || CASE WHEN p_partkey % 7 = 0 THEN '?' ELSE '' END AS value, {sql_pick(SCHEMES, 'p_partkey')} AS s, {sql_pick(RELATIONS, 'p_partkey')} AS r, CASE WHEN p_partkey % 11 = 0 THEN '' ELSE 'L' END AS l, {sql_pick(URIS, 'p_partkey // 3')} AS u FROM part"


@query(
    f"""WITH c AS ({_CROSS}), f AS (SELECT * FROM c WHERE facet = 'type') SELECT facet, value, 'unknown facet' AS error, 'facet' AS "column" FROM c WHERE facet = 'mood' UNION ALL SELECT facet, value, 'unknown value', 'value' FROM f WHERE value LIKE '%?' UNION ALL SELECT facet, value, 'filled without a scheme', 'scheme' FROM f WHERE s = '' AND r || l || u <> ''
    UNION ALL SELECT facet, value, 'unknown scheme', 'scheme' FROM f WHERE s = 'z' UNION ALL SELECT facet, value, 'unknown relation', 'relation' FROM f WHERE s = 'x' AND r NOT LIKE '%Match' UNION ALL SELECT facet, value, 'uri of another scheme', 'uri' FROM f WHERE s = 'x' AND u <> 'http://x.org/gf0000000001' UNION ALL SELECT facet, value, 'empty label', 'label' FROM f WHERE s = 'x' AND l = ''
    UNION ALL SELECT DISTINCT 'type', v, 'unmapped value', 'value' FROM (SELECT n_name AS v FROM nation UNION ALL SELECT p_type FROM part) WHERE v NOT IN (SELECT value FROM f)"""
)
def crosswalk_errors(spark, sf):
    k, parts = F.col("p_partkey"), t(spark, sf, "part")
    vocabulary = parts.select(F.lit("type").alias("facet"), F.col("p_type").alias("value")).unionByName(t(spark, sf, "nation").select(F.lit("type").alias("facet"), F.col("n_name").alias("value")))
    rows = parts.select(
        F.when(k % 5 == 0, "mood").otherwise("type").alias("facet"), F.concat("p_type", F.when(k % 7 == 0, "?").otherwise("")).alias("value"), pick(SCHEMES, "p_partkey").alias("scheme"), pick(RELATIONS, "p_partkey").alias("relation"),
        F.when(k % 11 == 0, "").otherwise("L").alias("label"), pick(URIS, "p_partkey div 3").alias("uri"),
    )
    return audits.crosswalk_errors(rows, vocabulary, {"x": "http://x.org/"}, ["exactMatch", "closeMatch"], r"(?:mp|gf)\d{10}")


@query("SELECT user_id, event_type, event_id FROM (SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY NOT value > 50, event_type, event_id) AS rn FROM events) WHERE rn = 1")
def pooled_answers(spark, sf):
    return audits.pooled_answers(t(spark, sf, "events"), "user_id", ["event_type", "event_id"], F.col("value") > 50, ["event_type", "event_id"])


@query("SELECT CAST(y AS VARCHAR) AS label, n FROM (SELECT year(o_orderdate) AS y, count(*) AS n FROM orders GROUP BY 1) ORDER BY n DESC, y LIMIT 1")
def common_window(spark, sf):
    year = F.year("o_orderdate").cast("string")
    windows = t(spark, sf, "orders").select(F.concat(year, F.lit("-01.."), year, F.lit("-12")).alias("w"))
    return audits.most_common(windows, "w").select(audits.period_label(F.col("value")).alias("label"), "n")


@query(
    """SELECT * FROM (SELECT 'removed' AS change, o_custkey, count(*) AS n FROM orders WHERE o_orderkey % 17 = 0 GROUP BY 2 ORDER BY n DESC, o_custkey LIMIT 20)
    UNION ALL SELECT * FROM (SELECT 'added', o_custkey, count(*) AS n FROM orders WHERE o_orderkey % 23 = 0 AND o_orderkey % 17 <> 0 GROUP BY 2 ORDER BY n DESC, o_custkey LIMIT 20)"""
)
def owners_of_changes(spark, sf):
    orders = t(spark, sf, "orders").select("o_orderkey", "o_custkey")
    old, new = orders.where("o_orderkey % 23 <> 0 or o_orderkey % 17 = 0"), orders.where("o_orderkey % 17 <> 0")
    return audits.owners_of_changes(old, new, ["o_orderkey"], "o_custkey")


@query(
    f"""WITH l AS ({_LATEST}) SELECT a.event_type AS a, b.event_type AS b, count(*) AS n, CAST(0 AS BIGINT) AS both_empty, round(avg(len(list_intersect(a.tags, b.tags)) / (len(a.tags) + len(b.tags) - len(list_intersect(a.tags, b.tags)))), 6) AS mean_jaccard
    FROM l a JOIN l b ON a.user_id = b.user_id AND a.event_type < b.event_type GROUP BY 1, 2"""
)
def pair_agreement(spark, sf):
    return audits.pair_agreement(_latest(spark, sf), "user_id", "event_type", "tags").withColumn("mean_jaccard", F.round("mean_jaccard", 6))


@query(
    """SELECT metric, lang, count(*) FILTER (e) AS eligible, count(*) FILTER (e AND w) AS errors, round(count(*) FILTER (e AND w) / nullif(count(*) FILTER (e), 0), 6) AS rate FROM (
    SELECT 'toxic' AS metric, lang, true AS e, toxic = 1 AS w FROM documents JOIN labels USING (doc_id) UNION ALL SELECT 'quality', lang, toxic = 0, quality = 0 FROM documents JOIN labels USING (doc_id)) GROUP BY 1, 2"""
)
def error_rates(spark, sf):
    rows = t(spark, sf, "documents").select("doc_id", "lang").join(t(spark, sf, "labels"), "doc_id")
    metrics = {"toxic": (F.lit(True), F.col("toxic") == 1), "quality": (F.col("toxic") == 0, F.col("quality") == 0)}
    return audits.error_rates(rows, "lang", metrics).withColumn("rate", F.round("rate", 6))


@query("SELECT c_custkey, concat_ws('|', a.n_name, b.n_name) AS \"values\" FROM customer LEFT JOIN nation a ON a.n_nationkey = c_nationkey LEFT JOIN nation b ON b.n_nationkey = c_nationkey + 1")
def ordered_lookup(spark, sf):
    k = F.col("c_nationkey").cast("int")
    rows = t(spark, sf, "customer").select("c_custkey", F.array(k, k + 1, k, F.lit(999)).alias("codes"))
    return audits.ordered_lookup(rows, "c_custkey", "codes", t(spark, sf, "nation"), "n_nationkey", "n_name")


@query(
    """SELECT doc_id, "group" FROM (SELECT *, row_number() OVER (PARTITION BY "group" ORDER BY md5('pilot:' || doc_id), doc_id) AS rn FROM (
    SELECT doc_id, CASE WHEN n_chars > 2000 THEN 'long' WHEN lang = 'en' THEN 'english' ELSE 'rest' END AS "group" FROM documents)) WHERE rn <= CASE "group" WHEN 'rest' THEN 20 ELSE 40 END"""
)
def pilot_sample(spark, sf):
    groups = [("long", F.col("n_chars") > 2000, 40), ("english", F.col("lang") == "en", 40), ("rest", F.lit(True), 20)]
    return audits.pilot_sample(t(spark, sf, "documents"), groups, "doc_id", "pilot")
