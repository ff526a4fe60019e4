"""Queries of works, gold sets, gates and reports over the driver's tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cells
from ..functions.html_tokens import read_pages
from ..operators import audits, entities, facets, gold, homepages, markup, resolve, snapshots, status, works
from .catalogue_d import pick, sql_list, sql_pick
from .registry import query, t

# Licence blocks: a customer's page holds a block for each order.

RIGHTS = ["Public Domain", "Creative Commons Attribution 4.0", "Creative Commons Attribution-NonCommercial 3.0", "ask the author", "Performance Restricted Attribution 3.0", "EFF Open Audio License"]
LICENCES = ["PD", "CC-BY-4.0", "CC-BY-NC-3.0", "unparsed", "LicenseRef-IMSLP-PR-BY-3.0", "LicenseRef-EFF-OAL"]
OPEN = [1, 2, 5]
ARRANGERS = ["", "Composer", "Somebody [[else]]"]
_BLOCK = f"""SELECT o_custkey, o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN 'audio' ELSE 'score' END AS kind, {sql_pick(LICENCES, 'o_orderkey // 2')} AS licence, (o_orderkey // 2) % 6 IN (1, 2, 5) AS open_licence, o_orderkey % 7 < 3 AS is_new, {sql_pick(ARRANGERS, 'o_orderkey // 3')} AS arranger, CASE WHEN o_orderkey % 2 = 0 THEN 'pdf' ELSE 'pdf|midi' END AS formats FROM orders"""


def _pages(spark, sf):
    k = F.col("o_orderkey")
    name = F.concat(F.lit("\n|File Name 1=o"), k.cast("string"), F.lit(".pdf"), F.when(k % 2 == 1, F.concat(F.lit("\n|File Name 2=o"), k.cast("string"), F.lit(".MID"))).otherwise(""))
    kind = F.when(k % 5 == 0, "{{#fte:imslpaudio").otherwise("{{#fte:imslpfile")
    image = F.when(k % 7 < 3, "New Composition").otherwise("Typeset")
    block = F.concat(kind, name, F.lit("\n|Copyright="), pick(RIGHTS, "o_orderkey div 2"), F.lit("\n|Image Type="), image, F.lit("\n|Arranger="), pick(ARRANGERS, "o_orderkey div 3"), F.lit("\n|Date Submitted={{date|1"), F.lit("\n}}\n}}\n"))
    listed = t(spark, sf, "orders").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("o_orderkey", block.alias("b")))).alias("s"))
    return listed.select("o_custkey", F.concat(F.lit("== Sheet Music ==\n"), F.array_join(F.transform("s", lambda x: x["b"]), "\n"), F.lit("{{#fte:imslppage\n|Key=C\n}}")).alias("source"))


@query(f"SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS block, kind, 'Sheet Music' AS section, CAST(1 + o_orderkey % 2 AS BIGINT) AS n_files, formats, licence, open_licence, arranger FROM ({_BLOCK})")
def licence_blocks(spark, sf):
    return works.block_rows(_pages(spark, sf), "o_custkey", "source").select("o_custkey", F.col("block").cast("long").alias("block"), "kind", "section", F.col("n_files").cast("long").alias("n_files"), "formats", "licence", "open_licence", "arranger")


@query(
    f"""SELECT c_custkey, coalesce(licences, '') AS licences, CASE WHEN licences IS NULL THEN '' WHEN own AND c_nationkey % 3 <> 0 THEN 'composition' ELSE 'edition' END AS scope, coalesce(formats, '') AS formats FROM customer LEFT JOIN (SELECT o_custkey, string_agg(DISTINCT licence, '|' ORDER BY licence) AS licences,
    bool_or(is_new AND arranger IN ('', 'Composer')) AS own, CASE WHEN bool_or(formats <> 'pdf') THEN 'midi|pdf' ELSE 'pdf' END AS formats FROM ({_BLOCK}) WHERE kind = 'score' AND open_licence GROUP BY 1) ON o_custkey = c_custkey"""
)
def open_licence_cells(spark, sf):
    people = t(spark, sf, "customer").select("c_custkey", F.when(F.col("c_nationkey") % 3 == 0, "pd").otherwise("not_pd").alias("status"))
    blocks = works.block_rows(_pages(spark, sf), "o_custkey", "source").withColumnRenamed("o_custkey", "c_custkey")
    return works.open_cells(people, blocks, "c_custkey", "status")


@query(f"SELECT kind, licence, count(*) AS n FROM ({_BLOCK}) GROUP BY 1, 2")
def licence_block_counts(spark, sf):
    return works.licence_counts(works.block_rows(_pages(spark, sf), "o_custkey", "source"))


@query(
    f"""SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) - 1 AS place, CASE WHEN o_orderkey % 5 = 0 THEN '#fte:imslpaudio' ELSE '#fte:imslpfile' END AS name, 'Sheet Music' AS section, {sql_pick(RIGHTS, 'o_orderkey // 2')} AS copyright, '{{{{date|1 }}}}' AS submitted FROM orders
    UNION ALL SELECT o_custkey, count(*), '#fte:imslppage', 'Sheet Music', NULL, NULL FROM orders GROUP BY 1"""
)
def template_blocks(spark, sf):
    found = markup.template_blocks(_pages(spark, sf), "o_custkey", "source")
    cell = lambda k: F.try_element_at("fields", F.lit(k))
    return found.select("o_custkey", F.col("place").cast("long").alias("place"), "name", "section", cell("Copyright").alias("copyright"), cell("Date Submitted").alias("submitted"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 4 = 0 THEN '' ELSE lower(c_mktsegment) || ' and ' || c_nationkey END AS instrumentation, CASE WHEN c_custkey % 4 = 0 OR c_custkey % 3 = 0 THEN '' ELSE CAST(1900 + c_nationkey AS VARCHAR) END AS year FROM customer")
def geninfo_fields(spark, sf):
    k, n = F.col("c_custkey"), F.col("c_nationkey").cast("string")
    dated = F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("\n|Year/Date of Composition="), (1900 + F.col("c_nationkey")).cast("string")))
    page = F.concat(F.lit("{{#fte:imslppage\n|Instrumentation=[[Category:x|"), F.lower("c_mktsegment"), F.lit("]]  {{note}}and <b>"), n, F.lit("</b>"), dated, F.lit("\n}}"))
    rows = t(spark, sf, "customer").select("c_custkey", F.when(k % 4 == 0, "nothing").otherwise(page).alias("w"))
    return rows.select("c_custkey", markup.geninfo("w", "Instrumentation").alias("instrumentation"), markup.geninfo("w", "Year/Date of Composition").alias("year"))


# Entities: a document per customer, with claims of several ranks and precisions.

_BORN = "SELECT c_custkey, 1800 + c_custkey % 120 AS y, ([7, 8, 9, 11])[CAST(c_custkey % 4 + 1 AS INTEGER)] AS p, 1860 + c_nationkey * 3 AS d, c_custkey % 5 AS kind, c_custkey % 7 <> 0 AS human FROM customer"
_READ = f"SELECT *, CASE p WHEN 7 THEN (y - 1) // 100 * 100 + 100 WHEN 8 THEN y // 10 * 10 + 9 ELSE y END AS birth, CASE WHEN kind = 4 THEN NULL WHEN kind = 3 THEN d + 1 ELSE d END AS death FROM ({_BORN})"


@query(
    f"""SELECT 'Q' || c_custkey AS id, CAST(birth AS BIGINT) AS birth, CASE p WHEN 7 THEN 'century' WHEN 8 THEN 'decade' WHEN 9 THEN 'year' ELSE 'day' END AS precision, CAST(death AS BIGINT) AS death, CASE WHEN kind = 4 THEN NULL WHEN kind = 2 THEN CAST(d AS VARCHAR) || '-02' ELSE CAST(death AS VARCHAR) END AS death_iso,
    array_to_string(list_filter([CASE WHEN kind = 1 THEN 'death_rank_conflict' END, CASE WHEN p < 9 THEN 'birth_imprecise' END, CASE WHEN NOT human THEN 'not_human' END, CASE WHEN death - birth < 15 OR death - birth > 110 THEN 'implausible_lifespan' END, CASE WHEN death < birth THEN 'death_before_birth' END, CASE WHEN c_custkey % 3 <> 0 THEN 'no_composer_occupation' END], lambda x: x IS NOT NULL), '|') AS flags,
    CASE WHEN c_custkey % 3 = 0 THEN 'pianist|composer' ELSE 'conductor' END AS occupations FROM ({_READ})"""
)
def entity_flatten(spark, sf):
    k, d = F.col("c_custkey"), 1860 + F.col("c_nationkey") * 3

    def claim(value, rank="normal"):
        return F.concat(F.lit('{"rank":"' + rank + '","mainsnak":{"snaktype":"value","datavalue":{"value":'), value, F.lit("}}}"))

    def time(year, precision, rank="normal", day="-00-00"):
        return claim(F.concat(F.lit('{"time":"+'), year.cast("string"), F.lit(day + 'T00:00:00Z","precision":'), precision.cast("string"), F.lit("}")), rank)

    item = lambda q: claim(F.lit('{"id":"' + q + '"}'))
    precision = F.element_at(F.array(*map(F.lit, (7, 8, 9, 11))), (k % 4 + 1).cast("int"))
    nine, kind = F.lit(9), k % 5
    deaths = F.when(kind == 0, time(d, nine)).when(kind == 1, F.concat_ws(",", time(d, nine), time(d + 5, nine))).when(kind == 2, time(d, F.lit(10), day="-02-00")).when(kind == 3, F.concat_ws(",", time(d, nine), time(d + 1, nine, "preferred"))).otherwise(time(d, nine, "deprecated"))
    work = F.when(k % 3 == 0, F.concat_ws(",", item("Q486748"), item("Q36834"), item("Q486748"))).otherwise(item("Q158852"))
    kindred = F.when(k % 7 != 0, item("Q5")).otherwise(item("Q6"))
    json = F.concat(F.lit('{"id":"Q'), k.cast("string"), F.lit('","claims":{"P31":['), kindred, F.lit('],"P106":['), work, F.lit('],"P569":['), time(1800 + k % 120, precision, day="-03-04"), F.lit('],"P570":['), deaths, F.lit("]}}"))
    e = t(spark, sf, "customer").select(entities.flatten(json).alias("e"))
    return e.select("e.id", F.col("e.birth.year").alias("birth"), F.col("e.birth.precision").alias("precision"), F.col("e.death.year").alias("death"), F.col("e.death.iso").alias("death_iso"), "e.flags", "e.occupations")


@query("SELECT c_custkey, CASE WHEN c_custkey % 6 = 0 THEN CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE f END ELSE y // 10 * 10 + 9 END AS plain, CASE WHEN c_custkey % 4 = 0 THEN CASE WHEN c_custkey % 6 = 0 THEN NULL ELSE y // 10 * 10 + 9 END WHEN c_custkey % 6 = 0 THEN f WHEN f BETWEEN y // 10 * 10 AND y // 10 * 10 + 9 THEN f ELSE y // 10 * 10 + 9 END AS refined FROM (SELECT c_custkey, 1850 + c_custkey % 40 AS y, 1850 + c_nationkey AS f FROM customer)")
def year_fallbacks(spark, sf):
    k, y, f = F.col("c_custkey"), 1850 + F.col("c_custkey") % 40, 1850 + F.col("c_nationkey")

    def claim(year, precision, rank):
        told = F.to_json(F.struct(F.concat(F.lit("+"), year.cast("string"), F.lit("-00-00T00:00:00Z")).alias("time"), F.lit(precision).alias("precision")))
        return F.struct(F.lit(rank).alias("rank"), F.struct(F.lit("value").alias("snaktype"), F.struct(told.alias("value")).alias("datavalue")).alias("mainsnak"))

    claims = F.array_compact(F.array(F.when(k % 6 != 0, claim(y, 8, "normal")), F.when(k % 4 == 0, claim(f, 9, "deprecated"))))
    at, old = entities.time_claim(claims), entities.deprecated_years(claims)
    return t(spark, sf, "customer").select("c_custkey", *(entities.fallback_year(at, old, f, refine).alias(name) for name, refine in (("plain", False), ("refined", True))))


# Category refresh.

CATEGORIES = ["For piano", "Sonatas", "Scores in A", "Bach, J./Editor", "Own, Name", "Pages with x", "Nocturnes", "For 2 players"]
KEPT = ["For piano", "Sonatas", "Nocturnes", "For 2 players"]
_CATS = f"SELECT p_partkey, [{sql_pick(CATEGORIES, 'p_partkey')}, {sql_pick(CATEGORIES, 'p_partkey // 8')}, {sql_pick(CATEGORIES, 'p_size')}] AS c FROM part"
_NEW = f"SELECT p_partkey, coalesce((SELECT string_agg(x, '|' ORDER BY i) FROM (SELECT x, min(i) AS i FROM (SELECT unnest(c) AS x, unnest([1, 2, 3]) AS i) WHERE x IN {tuple(KEPT)} GROUP BY x)), '') AS fresh FROM ({_CATS})"
_REFRESHED = f"SELECT p_partkey, CASE WHEN p_partkey % 5 = 0 THEN 'absent' WHEN p_partkey % 5 = 1 THEN 'missing' WHEN p_partkey % 5 = 2 AND p_partkey % 2 = 0 THEN 'redirect' ELSE 'refreshed' END AS state, fresh FROM ({_NEW})"
_CELL = f"SELECT p_partkey, state, CASE WHEN state = 'refreshed' THEN fresh ELSE 'Songs' END AS cell FROM ({_REFRESHED})"


def _refreshed(spark, sf):
    k = F.col("p_partkey")
    parts = t(spark, sf, "part")
    listed = F.array(pick(CATEGORIES, "p_partkey"), pick(CATEGORIES, "p_partkey div 8"), pick(CATEGORIES, "p_size"))
    pages = parts.where("p_partkey % 5 <> 0").select("p_partkey", (k % 5 == 1).alias("missing"), ((k % 5 == 2) & (k % 2 == 0)).alias("redirect"), listed.alias("categories"))
    rows = parts.select("p_partkey", F.lit("Songs").alias("cell"), F.lit("Category:Own,_Name").alias("own"))
    return works.refresh_categories(rows, pages, "p_partkey", "cell", "own")


@query(f"SELECT p_partkey, state, cell, cell <> 'Songs' AS changed FROM ({_CELL})")
def category_refresh(spark, sf):
    return _refreshed(spark, sf).select("p_partkey", "state", "cell", "changed")


@query(f"SELECT state, count(*) AS n, count(*) FILTER (cell <> 'Songs') AS changed, count(*) FILTER (cell = '') AS empty FROM ({_CELL}) GROUP BY 1")
def category_refresh_statistics(spark, sf):
    return works.refresh_statistics(_refreshed(spark, sf), "cell")


@query("SELECT DISTINCT o_custkey, o_orderkey AS pageid, o_orderpriority AS title FROM orders WHERE o_orderkey % 4 <> 1")
def category_members(spark, sf):
    member = F.struct(F.when(F.col("o_orderkey") % 4 == 0, None).otherwise((F.col("o_orderkey") % 4 == 1).cast("int")).alias("ns"), F.col("o_orderkey").alias("pageid"), F.col("o_orderpriority").alias("title"))
    return works.category_members(t(spark, sf, "orders").groupBy("o_custkey").agg(F.collect_list(member).alias("m")), "o_custkey", "m")


@query("SELECT c_custkey, 'g' || c_custkey AS id, c_name AS name, '' AS died, CASE WHEN c_custkey % 3 = 0 THEN '' ELSE c_mktsegment END AS labels FROM customer")
def authority_records(spark, sf):
    jobs = F.when(F.col("c_custkey") % 3 != 0, F.array(F.struct(F.lit("").alias("id"), F.col("c_mktsegment").alias("label"))))
    json = F.to_json(F.struct(F.concat(F.lit("g"), F.col("c_custkey")).alias("gndIdentifier"), F.col("c_name").alias("preferredName"), jobs.alias("professionOrOccupation"), F.lit(1).alias("other")))
    r = works.authority_record(json)
    return t(spark, sf, "customer").select("c_custkey", r["id"].alias("id"), r["name"].alias("name"), F.array_join(r["died"], "|").alias("died"), F.array_join(r["profession_labels"], "|").alias("labels"))


@query("SELECT doc_id FROM documents WHERE (text IS NULL OR n_chars % 3 = 0) AND n_chars % 4 <> 0 AND n_chars % 5 <> 0")
def pages_without_content(spark, sf):
    n = F.col("n_chars")
    pages = t(spark, sf, "documents").select("doc_id", F.when(n % 3 != 0, F.col("text")).alias("wikitext"), (n % 4 == 0).alias("missing"), (n % 5 == 0).alias("redirect"))
    return works.without_content(pages).select("doc_id")


# Gold sets.

MATCH = ["matched", "not_found", "unverified_heuristic", "rejected_p839", "matched"]
_PERSON = f"SELECT c_custkey, CASE WHEN c_custkey % 9 = 0 THEN 'not_human' ELSE '' END AS qa, {sql_pick(MATCH, 'c_custkey')} AS m, CASE WHEN c_custkey % 2 = 0 THEN 'wikidata_p839' ELSE 'exact_name' END AS method, CASE WHEN c_nationkey % 2 = 0 THEN 'pd' ELSE 'not_pd' END AS pd, CASE WHEN c_nationkey % 3 = 0 THEN 'wikidata' ELSE 'none' END AS src, CASE WHEN c_nationkey % 5 = 0 THEN 'modern' ELSE '' END AS voted FROM customer"


def _people(spark, sf):
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    return t(spark, sf, "customer").select(
        "c_custkey", F.when(k % 9 == 0, "not_human").otherwise("").alias("qa_flags"), pick(MATCH, "c_custkey").alias("imslp_match_status"), F.when(k % 2 == 0, "wikidata_p839").otherwise("exact_name").alias("imslp_match_method"), F.when(n % 2 == 0, "pd").otherwise("not_pd").alias("eu_pd_status"),
        F.when(n % 3 == 0, "wikidata").otherwise("none").alias("style_tags_src"), F.when(n % 5 == 0, "modern").otherwise("").alias("llm_style_tags"),
    )


@query(
    f"""SELECT c_custkey, CASE WHEN qa <> '' THEN 'qa_flagged' WHEN m IN ('unverified_heuristic', 'rejected_p839') THEN 'imslp_rejected_or_unverified' ELSE pd || '/' || CASE WHEN m <> 'matched' THEN 'not_found' WHEN method = 'wikidata_p839' THEN 'p839' ELSE 'name' END END AS v1,
    CASE WHEN qa <> '' OR m IN ('unverified_heuristic', 'rejected_p839') THEN 'qa_or_unstable' ELSE CASE WHEN src = 'wikidata' THEN 'wikidata' WHEN voted <> '' THEN 'consensus' ELSE 'no_consensus' END || '/' || pd END AS v2 FROM ({_PERSON})"""
)
def person_strata(spark, sf):
    return _people(spark, sf).select("c_custkey", gold.person_stratum().alias("v1"), gold.person_stratum_by_style().alias("v2"))


@query("SELECT CASE o_orderkey % 5 WHEN 0 THEN 'imslp/' || CASE o_custkey % 3 WHEN 0 THEN 'eu_warning' WHEN 1 THEN 'other_rights' ELSE 'none' END WHEN 1 THEN 'title' WHEN 2 THEN 'llm' ELSE 'unlabelled' END AS stratum, count(*) AS n FROM orders GROUP BY 1")
def work_strata(spark, sf):
    rows = t(spark, sf, "orders").select(pick(["imslp_tags", "title", "llm_pass", "", "other"], "o_orderkey").alias("force_family_src"), pick(["nonpd_eu|wima", "wima", ""], "o_custkey").alias("imslp_copyright_flags"))
    return rows.groupBy(gold.work_stratum().alias("stratum")).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT c_custkey, c_mktsegment, n AS stratum_size, round(n / least(n, 4), 6) AS weight FROM (SELECT *, row_number() OVER (PARTITION BY c_mktsegment ORDER BY md5('two:' || c_custkey), c_custkey) AS rn, count(*) OVER (PARTITION BY c_mktsegment) AS n FROM customer) WHERE rn <= 4")
def annotator_subset(spark, sf):
    people = t(spark, sf, "customer")
    sizes = people.groupBy("c_mktsegment").agg(F.count(F.lit(1)).alias("stratum_size"))
    out = gold.subset(people.join(sizes, "c_mktsegment"), "c_mktsegment", "c_custkey", 4, "two")
    return out.select("c_custkey", "c_mktsegment", "stratum_size", F.round("weight", 6).alias("weight"))


_SHEET = "SELECT o_orderkey, CASE WHEN o_orderkey % 4 = 0 THEN '' WHEN o_orderkey % 4 = 1 THEN 'maybe' ELSE 'yes' END AS files, CASE WHEN o_orderkey % 6 = 0 THEN '' ELSE o_orderstatus END AS kind FROM orders"


@query(f"SELECT o_orderkey, 'files' AS field, 'invalid' AS fault FROM ({_SHEET}) WHERE files = 'maybe' UNION ALL SELECT o_orderkey, 'kind', 'invalid' FROM ({_SHEET}) WHERE kind = 'P' UNION ALL SELECT o_orderkey, 'kind', 'empty' FROM ({_SHEET}) WHERE kind = ''")
def sheet_faults(spark, sf):
    k = F.col("o_orderkey")
    rows = t(spark, sf, "orders").select("o_orderkey", F.when(k % 4 == 0, "").when(k % 4 == 1, "maybe").otherwise("yes").alias("files"), F.when(k % 6 == 0, "").otherwise(F.col("o_orderstatus")).alias("kind"))
    return gold.sheet_faults(rows, "o_orderkey", {"files": ["yes", "no"], "kind": ["F", "O"]}, ["kind"])


_ANSWERS = "SELECT c_mktsegment AS s, CASE c_custkey % 3 WHEN 0 THEN 'yes' WHEN 1 THEN 'no' ELSE 'unsure' END AS same, CASE c_custkey % 5 WHEN 0 THEN 'living' WHEN 1 THEN '' ELSE 'dead' END AS st, CASE WHEN c_custkey % 7 = 0 THEN NULL ELSE 1960 + c_custkey % 60 END AS said, CASE WHEN c_custkey % 4 = 0 THEN NULL ELSE 1960 + c_nationkey END AS known, c_nationkey < 12 AS pd FROM customer"
_TRUTH = f"SELECT *, CASE WHEN st = 'living' THEN 'not_pd' WHEN st = 'dead' AND said IS NOT NULL THEN CASE WHEN said <= 1995 THEN 'pd' ELSE 'not_pd' END END AS truth FROM ({_ANSWERS})"
_RULES = {
    "identity_wrong": ("same IN ('yes', 'no')", "same = 'no'"),
    "imslp_link_wrong": ("false", "false"),
    "imslp_link_missed": ("false", "false"),
    "death_year_wrong": ("st = 'dead' AND said IS NOT NULL AND known IS NOT NULL", "said <> known"),
    "death_year_off_by_2plus": ("st = 'dead' AND said IS NOT NULL AND known IS NOT NULL", "abs(said - known) >= 2"),
    "death_missing": ("known IS NULL AND st <> ''", "st = 'dead'"),
    "false_pd": ("pd AND truth IS NOT NULL", "truth = 'not_pd'"),
    "missed_pd": ("NOT pd AND truth IS NOT NULL", "truth = 'pd'"),
}
_EACH = " UNION ALL ".join(f"SELECT '{k}' AS metric, s, ({e}) AS e, ({e}) AND ({w}) AS w FROM ({_TRUTH})" for k, (e, w) in _RULES.items())


@query(f"SELECT metric, stratum, eligible, errors, round(errors / nullif(eligible, 0), 6) AS rate FROM (SELECT metric, coalesce(s, '') AS stratum, count(*) FILTER (e) AS eligible, count(*) FILTER (w) AS errors FROM ({_EACH}) GROUP BY GROUPING SETS ((metric, s), (metric)))")
def gold_scores(spark, sf):
    k = F.col("c_custkey")
    answers = t(spark, sf, "customer").select(
        k.alias("item"), k, F.col("c_mktsegment").alias("stratum"), pick(["yes", "no", "unsure"], "c_custkey").alias("wikidata_same_person"), F.lit("").alias("imslp_url"), F.lit("").alias("imslp_check"),
        pick(["living", "", "dead", "dead", "dead"], "c_custkey").alias("death_status"), F.when(k % 7 != 0, (1960 + k % 60).cast("string")).otherwise("").alias("death_year"),
    )
    dump = t(spark, sf, "customer").select("c_custkey", F.when(k % 4 != 0, (1960 + F.col("c_nationkey")).cast("string")).otherwise("").alias("death_year"), F.when(F.col("c_nationkey") < 12, "pd").otherwise("not_pd").alias("eu_pd_status"))
    rows = gold.with_design(answers.drop("stratum"), answers.select("item", "stratum", "c_custkey"), dump, "item", "c_custkey")
    return gold.scores(rows, "stratum", gold.person_metrics(2066)).withColumn("rate", F.round("rate", 6))


@query(
    """WITH p AS (SELECT CASE WHEN o_orderkey % 3 = 0 THEN '' ELSE o_orderstatus END AS a, CASE WHEN o_orderkey % 4 = 0 THEN 'F' ELSE o_orderstatus END AS b, 'x|' || (o_orderkey % 2) AS c, 'x|' || (o_custkey % 2) AS d FROM orders), q AS (SELECT * FROM p WHERE a <> ''), n AS (SELECT count(*) AS n, avg(CASE WHEN a = b THEN 1.0 ELSE 0 END) AS po FROM q),
    e AS (SELECT sum(x.n * y.n) AS e FROM (SELECT a AS v, count(*) AS n FROM q GROUP BY 1) x JOIN (SELECT b AS v, count(*) AS n FROM q GROUP BY 1) y USING (v))
    SELECT 'status' AS field, n AS pairs, round(po, 6) AS agree, round((po - e / (n * n)) / (1 - e / (n * n)), 6) AS kappa, NULL AS jaccard FROM n, e UNION ALL SELECT 'styles', count(*), round(avg(CASE WHEN c = d THEN 1.0 ELSE 0 END), 6), NULL, round(avg(CASE WHEN c = d THEN 1.0 ELSE 1 / 3 END), 6) FROM p"""
)
def pass_agreement(spark, sf):
    orders = t(spark, sf, "orders")
    k = F.col("o_orderkey")
    a = orders.select("o_orderkey", F.when(k % 3 == 0, "").otherwise(F.col("o_orderstatus")).alias("status"), F.concat(F.lit("x|"), k % 2).alias("styles"))
    b = orders.select("o_orderkey", F.when(k % 4 == 0, "F").otherwise(F.col("o_orderstatus")).alias("status"), F.concat(F.lit("x|"), F.col("o_custkey") % 2).alias("styles"))
    out = gold.pass_agreement(a, b, "o_orderkey", ["status", "styles"], ["styles"])
    return out.select("field", "pairs", *(F.round(c, 6).alias(c) for c in ("agree", "kappa", "jaccard")))


@query(
    """WITH r AS (SELECT ['a', 'b' || (o_custkey % 3)] AS w, ['a', 'c'] AS x, CASE WHEN o_orderkey % 5 = 0 THEN [] ELSE ['b' || (o_orderkey % 3)] END AS y FROM orders), s AS (SELECT 'model' AS source, w, x AS g FROM r UNION ALL SELECT 'tags', w, y FROM r WHERE len(y) > 0), z AS (SELECT source, len(list_intersect(w, g)) AS i, len(w) AS nw, len(g) AS ng FROM s)
    SELECT source, count(*) AS n, round(sum(i) / sum(ng), 6) AS precision, round(sum(i) / sum(nw), 6) AS recall, count(*) FILTER (i = 0) AS none_shared, round(avg(i / (nw + ng - i)), 6) AS mean_jaccard FROM z GROUP BY 1"""
)
def source_scores(spark, sf):
    k = F.col("o_orderkey")
    rows = t(spark, sf, "orders").select(F.concat(F.lit("a|b"), F.col("o_custkey") % 3).alias("w"), F.lit("a|c").alias("x"), F.when(k % 5 == 0, "").otherwise(F.concat(F.lit("b"), k % 3)).alias("y"))
    out = gold.source_scores(rows, {"model": "x", "tags": "y"}, "w")
    return out.select("source", "n", "none_shared", *(F.round(c, 6).alias(c) for c in ("precision", "recall", "mean_jaccard")))


# Facets.

TYPES = ["click", "view", "purchase", "error", "signup"]
_VOTE = "SELECT user_id, event_type, unnest(list_distinct(['t' || (v % 3), 't' || (v % 4), 't' || (v % 5)])) AS tag FROM (SELECT user_id, event_type, CAST(floor(value) AS INTEGER) AS v, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1"
_NEED = "SELECT 'pair' AS rule, ['click', 'view'] AS who, 2 AS need UNION ALL SELECT '3of5', {all}, 3 UNION ALL SELECT 'all', {all}, 5 UNION ALL SELECT 'any', {all}, 1 UNION ALL SELECT k, [k], 1 FROM (SELECT unnest({all}) AS k)"


@query(f"SELECT user_id, rule, string_agg(tag, '|' ORDER BY tag) AS tags FROM (SELECT user_id, tag, rule, need, count(*) AS n FROM ({_VOTE}) JOIN ({_NEED.format(all=sql_list(TYPES))}) ON list_contains(who, event_type) GROUP BY ALL) WHERE n >= need GROUP BY 1, 2")
def tags_by_rule(spark, sf):
    from .catalogue_b import _latest

    return facets.tags_by_rule(_latest(spark, sf), "user_id", "event_type", "tags", TYPES, ("click", "view"))


@query("SELECT c_custkey, CASE WHEN c_custkey % 2 = 0 THEN lower(c_mktsegment) ELSE '' END AS wikidata, 'm' || (c_nationkey % 4) AS llm, coalesce(s, '') AS imslp FROM customer LEFT JOIN (SELECT o_custkey, string_agg(DISTINCT x, '|' ORDER BY x) AS s FROM (SELECT o_custkey, unnest(['p' || (o_orderkey % 3), o_orderstatus]) AS x FROM orders) GROUP BY 1) ON o_custkey = c_custkey")
def styles_by_source(spark, sf):
    people = t(spark, sf, "customer").select("c_custkey", F.lower("c_mktsegment").alias("own"), F.when(F.col("c_custkey") % 2 == 0, "wikidata").otherwise("llm").alias("src"), F.concat(F.lit("m"), F.col("c_nationkey") % 4).alias("voted"))
    pieces = t(spark, sf, "orders").select("o_custkey", F.concat(F.lit("p"), F.col("o_orderkey") % 3, F.lit("|"), F.col("o_orderstatus")).alias("st"))
    return facets.styles_by_source(people, pieces, "c_custkey", "o_custkey", "own", "src", "voted", "st")


@query(
    """SELECT 'facet' AS section, 'segment' AS name, c_mktsegment AS value, count(*) AS n FROM customer GROUP BY 3 UNION ALL SELECT 'facet', 'tag', x, count(*) FROM (SELECT unnest(['n' || (c_nationkey % 5), 'k' || (c_custkey % 2)]) AS x FROM customer) GROUP BY 3 UNION ALL SELECT 'count', 'parents', '', count(*) FROM customer UNION ALL SELECT 'count', 'children', '', count(*) FROM orders
    UNION ALL SELECT 'filled', 'c_name', '', count(*) FROM customer UNION ALL SELECT 'filled', 'note', '', count(*) FROM customer WHERE c_custkey % 3 = 0"""
)
def viewer_manifest(spark, sf):
    people = t(spark, sf, "customer").withColumn("note", F.when(F.col("c_custkey") % 3 == 0, "x"))
    tags = F.array(F.concat(F.lit("n"), F.col("c_nationkey") % 5), F.concat(F.lit("k"), F.col("c_custkey") % 2))
    return facets.manifest(people, t(spark, sf, "orders"), {"segment": F.array("c_mktsegment"), "tag": tags}, ["c_name", "note"])


@query("SELECT c_custkey, array_to_string(list_filter(['Free', 'Licensed', 'Warning'], lambda x: (x = 'Free' AND c_custkey % 2 = 0) OR (x = 'Licensed' AND c_nationkey % 3 = 0) OR (x = 'Warning' AND c_custkey % 5 = 0)), '|') AS badges FROM customer")
def badges(spark, sf):
    k = F.col("c_custkey")
    tokens = F.array_compact(F.array(F.when(k % 5 == 0, "nonpd"), F.when(k % 2 == 0, "pd"), F.when(F.col("c_nationkey") % 3 == 0, "cc"), F.lit("other")))
    return t(spark, sf, "customer").select("c_custkey", F.array_join(facets.badges(tokens, {"pd": "Free", "cc": "Licensed", "nonpd": "Warning"}), "|").alias("badges"))


TAGGED = facets.FacetQuery(parent_in={"c_mktsegment": ("BUILDING", "MACHINERY", "HOUSEHOLD")}, tags_in={("own", "voted"): ("n1", "k1x")}, sort="c_acctbal")


@query("SELECT c_custkey, n AS n_matches FROM (SELECT c_custkey, c_mktsegment, c_nationkey FROM customer) JOIN (SELECT c_custkey AS k, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1) ON k = c_custkey WHERE c_mktsegment IN ('BUILDING', 'MACHINERY', 'HOUSEHOLD') AND (c_nationkey % 5 = 1 OR (c_custkey % 2 = 1 AND c_nationkey % 2 = 0))")
def facet_query_any_source(spark, sf):
    people = t(spark, sf, "customer").withColumns({"own": F.concat(F.lit("n"), F.col("c_nationkey") % 5), "voted": F.concat(F.lit("z|k"), F.col("c_custkey") % 2, F.when(F.col("c_nationkey") % 2 == 0, "x").otherwise(""))})
    return facets.run(TAGGED, people, t(spark, sf, "orders"), "c_custkey", "o_custkey", "c_name").select("c_custkey", "n_matches")


# Snapshots and gates.


def _two(spark, sf):
    old = t(spark, sf, "orders").select("o_orderkey", F.concat(F.col("o_orderstatus"), F.lit("|a")).alias("flags"), "o_orderstatus", F.when(F.col("o_custkey") % 3 == 0, "llm_x").otherwise("title").alias("src"), F.col("o_totalprice").alias("views"))
    new = old.where("o_orderkey % 19 <> 0").withColumns({"flags": F.when(F.col("o_orderkey") % 4 == 0, "a|b").otherwise(F.col("flags")), "o_orderstatus": F.when(F.col("o_orderkey") % 6 == 0, "F").otherwise(F.col("o_orderstatus")), "views": F.lit(0.0)})
    return old, new


@query("SELECT flag, CAST(sum(a) AS BIGINT) AS added, CAST(sum(r) AS BIGINT) AS removed FROM (SELECT 'b' AS flag, 1 AS a, 0 AS r FROM orders WHERE o_orderkey % 19 <> 0 AND o_orderkey % 4 = 0 UNION ALL SELECT o_orderstatus, 0, 1 FROM orders WHERE o_orderkey % 19 = 0 OR o_orderkey % 4 = 0 UNION ALL SELECT 'a', 0, 1 FROM orders WHERE o_orderkey % 19 = 0) GROUP BY 1")
def flag_changes(spark, sf):
    return snapshots.flag_changes(*_two(spark, sf), "o_orderkey", "flags")


@query(
    """SELECT * FROM (SELECT unnest(['added', 'removed', 'changed', 'flips', 'by_model_old', 'by_model_new']) AS measure, unnest([0, count(*) FILTER (o_orderkey % 19 = 0), count(*) FILTER (o_orderkey % 19 <> 0 AND (o_orderkey % 4 = 0 OR (o_orderkey % 6 = 0 AND o_orderstatus <> 'F'))),
    count(*) FILTER (o_orderkey % 19 <> 0 AND o_orderkey % 6 = 0 AND o_orderstatus <> 'F'), count(*) FILTER (o_custkey % 3 = 0), count(*) FILTER (o_custkey % 3 = 0 AND o_orderkey % 19 <> 0)]) AS n FROM orders)"""
)
def change_report(spark, sf):
    return snapshots.change_report(*_two(spark, sf), "o_orderkey", "o_orderstatus", "src", ["views"])


@query('SELECT \'text\' AS "column", round(avg(CASE WHEN text <> \'\' THEN 1.0 ELSE 0 END), 6) AS old, round(avg(CASE WHEN text <> \'\' AND doc_id % 8 <> 0 THEN 1.0 ELSE 0 END), 6) AS new, false AS ok FROM documents UNION ALL SELECT \'lang\', 1.0, round(avg(CASE WHEN doc_id % 50 <> 0 THEN 1.0 ELSE 0 END), 6), true FROM documents')
def coverage_gates(spark, sf):
    old = t(spark, sf, "documents").select("doc_id", "text", "lang")
    new = old.withColumns({"text": F.when(F.col("doc_id") % 8 != 0, F.col("text")), "lang": F.when(F.col("doc_id") % 50 != 0, F.col("lang"))})
    out = snapshots.coverage_gates(old, new, {"text": 0.05, "lang": 0.05})
    return out.select("column", F.round("old", 6).alias("old"), F.round("new", 6).alias("new"), "ok")


@query("SELECT c_custkey, n + CASE WHEN c_custkey % 30 = 0 THEN 1 ELSE 0 END AS told, n AS counted FROM (SELECT c_custkey, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1) WHERE c_custkey % 30 = 0")
def rollup_gate(spark, sf):
    counts = t(spark, sf, "orders").groupBy("o_custkey").agg(F.count(F.lit(1)).alias("n"))
    people = t(spark, sf, "customer").join(counts, F.col("c_custkey") == F.col("o_custkey"), "left").select("c_custkey", (F.coalesce("n", F.lit(0)) + (F.col("c_custkey") % 30 == 0).cast("int")).alias("told"))
    return snapshots.rollup_gate(people, t(spark, sf, "orders"), "c_custkey", "o_custkey", "told")


@query("SELECT o_orderkey, 'term' AS \"column\", CAST(year(o_orderdate) + 70 AS VARCHAR) AS told, CAST(year(o_orderdate) + 71 AS VARCHAR) AS rule FROM orders WHERE o_orderkey % 25 = 0")
def recomputed_gate(spark, sf):
    rows = t(spark, sf, "orders").select("o_orderkey", F.year("o_orderdate").cast("string").alias("death"), (F.year("o_orderdate") + F.when(F.col("o_orderkey") % 25 == 0, 70).otherwise(71)).alias("term"))
    return snapshots.recomputed_gate(rows, "o_orderkey", {"term": status.term(F.col("death"), 2066)["year"]})


@query(
    """SELECT 'works' AS "table", 'repeated key' AS error, count(*) AS n FROM (SELECT l_orderkey FROM lineitem GROUP BY 1 HAVING count(*) > 1) UNION ALL SELECT 'works', 'denied key', count(*) FROM lineitem WHERE l_orderkey IN (1, 2, 3) UNION ALL SELECT 'works', 'row count', count(*) - 7 FROM lineitem UNION ALL SELECT 'people', 'row count', count(*) - 5 FROM customer"""
)
def release_errors(spark, sf):
    return snapshots.release_errors({"people": t(spark, sf, "customer"), "works": t(spark, sf, "lineitem")}, {"people": "c_custkey", "works": "l_orderkey"}, {"people": 5, "works": 7}, {"works": ["1", "2", "3"]}).where("n > 0")


# Identity.


@query(
    """SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 OR s_suppkey % 2 = 0 THEN 'Category:' || CASE WHEN s_suppkey % 3 = 0 THEN 'Own_' || s_suppkey ELSE s_nationkey || ',_No_' || s_suppkey END ELSE '' END AS category, CASE WHEN s_suppkey % 2 <> 0 THEN 'not_found' WHEN s_suppkey % 3 = 0 THEN 'matched' ELSE 'unverified_heuristic' END AS match_status,
    CASE WHEN s_suppkey % 3 = 0 THEN 'wikidata_p839' WHEN s_suppkey % 2 = 0 THEN 'exact_name' ELSE '' END AS match_method FROM supplier"""
)
def category_match(spark, sf):
    k, n = F.col("s_suppkey").cast("string"), F.col("s_nationkey").cast("string")
    rows = t(spark, sf, "supplier").select("s_suppkey", F.concat(F.lit("No "), k, F.lit("  "), n).alias("name"), F.when(F.col("s_suppkey") % 3 == 0, F.concat(F.lit("Own "), k)).otherwise("").alias("stated"))
    there = t(spark, sf, "supplier").where("s_suppkey % 2 = 0").select(F.explode(F.array(F.concat(F.lit("Category:Own_"), k), F.concat(F.lit("Category:"), n, F.lit(",_No_"), k))).alias("category"))
    return resolve.match_category(rows, there, "name", "stated").select("s_suppkey", "category", "match_status", "match_method")


_YEARS = "SELECT c_custkey, 1800 + c_custkey % 50 AS b, CASE WHEN c_custkey % 4 <> 0 THEN 1870 + c_custkey % 30 END AS d, 1800 + c_nationkey * 2 AS lb, 1870 + c_nationkey AS ld, c_custkey % 6 = 0 AS flagged, c_custkey % 10 <> 0 AS listed FROM customer"
_SIGNALS = f"SELECT c_custkey, CASE WHEN listed THEN greatest(abs(b - lb), coalesce(abs(d - ld), 0)) END AS gap, flagged FROM ({_YEARS})"
_SUSPECTS = f"SELECT c_custkey, gap, array_to_string(list_filter([CASE WHEN gap >= 30 THEN 'list_years_gap_' || gap END, CASE WHEN flagged THEN 'not_human' END], lambda x: x IS NOT NULL), '|') AS signals FROM ({_SIGNALS}) WHERE gap >= 30 OR flagged"


@query(f"SELECT s.c_custkey, CAST(gap AS BIGINT) AS gap, signals, CASE WHEN f = 1 THEN 'rekey' WHEN f > 1 THEN 'ambiguous' WHEN signals LIKE 'list%' THEN 'no_candidate' ELSE 'check_occupation' END AS proposal FROM ({_SUSPECTS}) s JOIN (SELECT c_custkey, count(*) FILTER (o_orderstatus = 'P') AS f FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY 1) c USING (c_custkey)")
def identity_suspects(spark, sf):
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    url = F.concat(F.lit("https://en.wikipedia.org/wiki/p"), k.cast("string"))
    people = t(spark, sf, "customer").select("c_custkey", url.alias("url"), (1800 + k % 50).alias("birth"), F.when(k % 4 != 0, 1870 + k % 30).alias("death"), F.when(k % 6 == 0, "aa|not_human").otherwise("").alias("flags"))
    listed = t(spark, sf, "customer").where("c_custkey % 10 <> 0").select(F.concat(F.lit("https://en.wikipedia.org/wiki/P"), k.cast("string"), F.lit("#x")).alias("url"), (1800 + n * 2).alias("list_birth"), (1870 + n).alias("list_death"))
    found = resolve.suspects(people, listed, "c_custkey", "url", 30)
    candidates = t(spark, sf, "orders").select(F.col("o_custkey").alias("c_custkey"), (F.col("o_orderstatus") == "P").alias("fits"))
    return resolve.proposals(found, candidates, "c_custkey").select("c_custkey", F.col("gap").cast("long").alias("gap"), "signals", "proposal")


@query("SELECT c_custkey, min(s_suppkey) AS id FROM customer JOIN supplier ON s_nationkey = c_nationkey AND s_suppkey % 20 = c_custkey % 20 AND (c_custkey % 3 = 0 OR s_suppkey % 3 = 0 OR s_suppkey % 5 = c_custkey % 5) WHERE (c_custkey % 3 <> 0 AND s_suppkey % 3 <> 0) OR s_suppkey % 2 = 0 GROUP BY 1 HAVING count(DISTINCT s_suppkey) = 1")
def unique_authority(spark, sf):
    k, s = F.col("c_custkey"), F.col("s_suppkey")
    people = t(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("name"), (k % 20).alias("birth"), F.when(k % 3 != 0, k % 5).alias("death"))
    records = t(spark, sf, "supplier").select(F.col("s_nationkey").alias("name"), s.alias("id"), (s % 20).alias("born"), F.when(s % 3 != 0, s % 5).alias("died"), (s % 2 == 0).alias("composes"))
    return resolve.unique_authority(people, records, "name", "c_custkey")


# Cells and lists of people.


@query("SELECT c_custkey, 'dump r' || c_nationkey || CASE WHEN c_custkey % 3 = 0 THEN '' ELSE ' · built 2024-0' || (c_custkey % 9 + 1) || '-05' END AS label, 'Op. ' || c_custkey || '|No. 2|No. 3' AS titles, c_custkey % 2 = 0 AS named FROM customer")
def labels_and_titles(spark, sf):
    k = F.col("c_custkey")
    built = F.when(k % 3 == 0, "").otherwise(F.concat(F.lit("2024-0"), (k % 9 + 1).cast("string"), F.lit("-05T10:00:00Z")))
    titles = F.concat(F.lit(" Op. "), k.cast("string"), F.lit(". ;No. 2andNo. 3;;"))
    page = F.concat(F.lit("<p>Works of <b>Antonín DVOŘÁK</b> No"), F.lit("</p>"))
    return t(spark, sf, "customer").select("c_custkey", cells.dump_label(F.concat(F.lit("r"), F.col("c_nationkey").cast("string")), built).alias("label"), cells.clean_titles(titles).alias("titles"), cells.named_on(page, F.when(k % 2 == 0, "A. Dvorak").otherwise("A. Smetana")).alias("named"))


@query("SELECT o_orderkey, c_mktsegment AS parent_c_mktsegment FROM orders LEFT JOIN (SELECT * FROM customer WHERE c_custkey % 8 <> 0) ON o_custkey = c_custkey")
def parent_attributes(spark, sf):
    return status.with_attributes(t(spark, sf, "orders"), t(spark, sf, "customer").where("c_custkey % 8 <> 0"), "o_custkey", "c_custkey", ["c_mktsegment"]).select("o_orderkey", "parent_c_mktsegment")


@query("SELECT 'person' AS side, c_custkey, CASE WHEN c_custkey % 7 = 0 THEN 'u' || c_custkey ELSE '' END AS url FROM customer UNION ALL SELECT 'registry', c_custkey + 1000000, 'x' FROM customer WHERE c_custkey % 50 = 0")
def registry_rows(spark, sf):
    people = t(spark, sf, "customer").select("c_custkey")
    known = people.where("c_custkey % 7 = 0").select("c_custkey", F.concat(F.lit("u"), F.col("c_custkey").cast("string")).alias("url"))
    registry = known.unionByName(people.where("c_custkey % 50 = 0").select((F.col("c_custkey") + 1000000).alias("c_custkey"), F.lit("x").alias("url")))
    joined, alone = status.registry_join(people, registry, "c_custkey", ["url"])
    return joined.select(F.lit("person").alias("side"), "c_custkey", "url").unionByName(alone.select(F.lit("registry").alias("side"), "c_custkey", "url"))


@query("SELECT c_custkey FROM customer WHERE c_custkey % 3 = 0 AND c_nationkey % 2 = 0 ORDER BY c_acctbal DESC NULLS LAST, c_custkey LIMIT 40")
def style_gaps(spark, sf):
    k = F.col("c_custkey")
    people = t(spark, sf, "customer").select("c_custkey", "c_acctbal", F.when(k % 3 == 0, "").otherwise("x").alias("styles"), F.when(F.col("c_nationkey") % 2 == 0, "classical_core").otherwise("popular").alias("scope"))
    return status.style_gaps(people, "styles", "scope", "c_acctbal", "c_custkey", 40).select("c_custkey")


@query("SELECT c_custkey FROM customer WHERE c_custkey IN (3, 5, 8) AND c_nationkey % 2 <> 0 UNION ALL SELECT * FROM (SELECT c_custkey FROM customer WHERE c_custkey NOT IN (3, 5, 8) AND c_nationkey % 2 <> 0 ORDER BY md5('sweep:' || c_custkey), c_custkey LIMIT 17)")
def not_free_sample(spark, sf):
    people = t(spark, sf, "customer").select("c_custkey", F.when(F.col("c_nationkey") % 2 == 0, "pd").otherwise("not_pd").alias("status"))
    return status.not_free(people, "c_custkey", "status", [3, 5, 8], 20, "sweep").select("c_custkey")


@query("SELECT c_custkey, CASE WHEN c_nationkey < 20 AND (c_custkey % 4 = 0 OR c_custkey % 4 = 1) THEN 'new' WHEN c_custkey % 4 = 0 THEN '' ELSE 'old' END AS styles FROM customer")
def remapped_styles(spark, sf):
    k = F.col("c_custkey")
    people = t(spark, sf, "customer").select("c_custkey", F.when(k % 4 == 0, "").otherwise("old").alias("styles"), pick(["", "wikidata", "llm_consensus", "override"], "c_custkey").alias("src"))
    table = t(spark, sf, "customer").where("c_nationkey < 20").select("c_custkey", F.lit("new").alias("tags"))
    return status.remap_styles(people, table, "c_custkey", "styles", "src", overwrite=True).select("c_custkey", "styles")


# Agreement under two conditions, periods with ties, scanned pages, remapped links.

_COND = "SELECT user_id AS u, event_type AS m, c, list_distinct(list_transform(list_filter(t, lambda x: x < 2), lambda x: 't' || x)) AS tags FROM (SELECT user_id, event_type, CASE WHEN event_id % 2 = 0 THEN 'closed' ELSE 'grounded' END AS c, [v % 3, v % 4] AS t, row_number() OVER (PARTITION BY user_id, event_type, event_id % 2 ORDER BY event_id) AS rn FROM (SELECT *, CAST(floor(value) AS INTEGER) AS v FROM events)) WHERE rn = 1"


@query(f"""WITH r AS ({_COND}), p AS (SELECT a.m, a.tags AS x, b.tags AS y, len(list_intersect(a.tags, b.tags)) AS i FROM r a JOIN r b ON a.u = b.u AND a.m = b.m WHERE a.c = 'closed' AND b.c = 'grounded')
    SELECT m AS event_type, count(*) AS n, count(*) FILTER (len(x) = 0 AND len(y) = 0) AS both_empty, round(avg(CASE WHEN len(x) + len(y) > 0 THEN i / (len(x) + len(y) - i) END), 6) AS mean_jaccard FROM p GROUP BY 1""")
def condition_agreement(spark, sf):
    v = F.floor("value").cast("int")
    some = F.array_distinct(F.transform(F.filter(F.array(v % 3, v % 4), lambda x: x < 2), lambda x: F.concat(F.lit("t"), x.cast("string"))))
    rows = t(spark, sf, "events").select("user_id", "event_type", F.when(F.col("event_id") % 2 == 0, "closed").otherwise("grounded").alias("c"), "event_id", some.alias("tags"))
    once = rows.groupBy("user_id", "event_type", "c").agg(F.min_by("tags", "event_id").alias("tags"))
    return audits.condition_agreement(once, "user_id", "event_type", "c", "tags").withColumn("mean_jaccard", F.round("mean_jaccard", 6))


@query("""WITH c AS (SELECT o_custkey AS k, o_orderpriority AS p, count(*) AS c FROM orders GROUP BY 1, 2), b AS (SELECT k, p FROM (SELECT *, max(c) OVER (PARTITION BY k) AS m FROM c) WHERE c = m)
    SELECT seg AS c_mktsegment, count(*) AS n, count(*) FILTER (hit) AS hits, round(count(*) FILTER (hit) / count(*), 6) AS share FROM (SELECT c_mktsegment AS seg, EXISTS (SELECT 1 FROM b WHERE b.k = c_custkey AND b.p = (['1-URGENT', '2-HIGH', '3-MEDIUM', '4-NOT SPECIFIED', '5-LOW'])[CAST(c_custkey % 5 + 1 AS INTEGER)]) AS hit FROM customer WHERE c_custkey IN (SELECT k FROM b) AND c_custkey % 6 <> 0) GROUP BY 1""")
def period_scores(spark, sf):
    said = F.when(F.col("c_custkey") % 6 != 0, pick(["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"], "c_custkey")).otherwise("")
    answers = t(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_mktsegment", said.alias("period"))
    return audits.period_scores(answers, t(spark, sf, "orders"), "o_custkey", "c_mktsegment", "period", "o_orderpriority").withColumn("share", F.round("share", 6))


@query("""SELECT page_id, array_to_string(string_split(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1), '.')[-2:], '.') AS site, len(l) + (page_id % 4 <> 0)::INT + (page_id % 3 = 0)::INT AS n_links, CAST((page_id % 4 <> 0) AS BIGINT) AS n_score, CASE WHEN page_id % 3 = 0 THEN 'CC-BY-4.0' ELSE '' END AS licences, page_id % 4 <> 0 AND page_id % 3 = 0 AS candidate
    FROM (SELECT *, regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>') AS l FROM pages)""")
def page_scan(spark, sf):
    k = F.col("page_id")
    more = F.concat(F.col("html"), F.when(k % 4 != 0, '<a href="/x.pdf">score</a>').otherwise(""), F.when(k % 3 == 0, '<a href="https://creativecommons.org/licenses/by/4.0/">free</a>').otherwise(""))
    read = read_pages(t(spark, sf, "pages").withColumn("html", more), "html")
    links = F.size(F.filter("tags", lambda tag: (tag["name"] == "a") & tag["attributes"]["href"].isNotNull())).cast("long")
    licences = F.array_join(F.array_sort(F.array_distinct(F.transform(homepages.told("url", "tags", "words"), lambda e: e["spdx"]))), "|")
    out = read.select("page_id", markup.site(F.col("url")).alias("site"), links.alias("n_links"), F.size(homepages.scores("url", "tags")).cast("long").alias("n_score"), licences.alias("licences"))
    return out.withColumn("candidate", (F.col("licences") != "") & (F.col("n_score") > 0))


@query("SELECT 'works' AS part, '' AS transition, count(*) AS n FROM orders WHERE o_custkey % 4 <> 0 UNION ALL SELECT 'report', 'matched → rejected_p839', count(*) FILTER (c_custkey % 4 = 0) FROM customer")
def remapped_matches(spark, sf):
    people = t(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), F.lit("matched").alias("a"), F.when(F.col("c_custkey") % 4 == 0, "rejected_p839").otherwise("matched").alias("b"))
    kept, report = resolve.remap_matches(people, t(spark, sf, "orders"), "o_custkey", "a", "b")
    return kept.agg(F.count(F.lit(1)).alias("n")).select(F.lit("works").alias("part"), F.lit("").alias("transition"), "n").unionByName(report.select(F.lit("report").alias("part"), "transition", "n"))
