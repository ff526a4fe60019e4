"""Queries of the bitmap index, sheets of gold sets and their agreement, exports and release gates, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.cells import split_cell
from ..operators import bitmaps, facets, gold, parity, snapshots
from ..sources.tables import checkpointed
from .catalogue_d import pick, sql_pick
from .registry import query, t

# Live counts: styles of each customer by three sources, and its segment.

_STYLES = "SELECT c_custkey, c_mktsegment, unnest([{'s': 'wikidata', 'v': CASE WHEN c_custkey % 3 <> 0 THEN 'n' || (c_nationkey % 5) END}, {'s': 'llm', 'v': 'k' || (c_custkey % 2)}, {'s': 'llm', 'v': 'n0'}, {'s': 'imslp', 'v': 'n' || (c_custkey % 7)}]) AS x FROM customer"
_CHOSEN = f"SELECT c_custkey FROM customer WHERE c_mktsegment IN ('BUILDING', 'MACHINERY') AND c_custkey IN (SELECT c_custkey FROM ({_STYLES}) WHERE x.s IN ('wikidata', 'llm') AND x.v IN ('k1', 'n3'))"
CHOICES = {"segment": (None, ["BUILDING", "MACHINERY"]), "style": (["wikidata", "llm"], ["k1", "n3"]), "unasked": (None, [])}


def _indexed(spark, sf):
    k = F.col("c_custkey")
    numbered = bitmaps.number(t(spark, sf, "customer"), "c_custkey")
    styles = {
        "wikidata": F.array(F.when(k % 3 != 0, F.concat(F.lit("n"), F.col("c_nationkey") % 5))),
        "llm": split_cell(F.concat(F.lit("k"), k % 2, F.lit("|n0"))),
        "imslp": F.array(F.concat(F.lit("n"), k % 7)),
    }
    return numbered, checkpointed(bitmaps.build(numbered, {"style": styles, "segment": {"": F.array("c_mktsegment")}}))


def _sql_live(sources, extra=""):
    return f"SELECT v AS value, count(DISTINCT c_custkey) FILTER (hit) AS n FROM (SELECT c_custkey, x.v AS v, x.s IN ({', '.join(map(repr, sources))}) {extra} AS hit FROM ({_STYLES}) WHERE x.v IS NOT NULL) GROUP BY 1"


@query(_sql_live(["wikidata", "imslp"]))
def live_counts(spark, sf):
    return bitmaps.live_counts(_indexed(spark, sf)[1], "style", ["wikidata", "imslp"])


@query(_sql_live(["wikidata", "llm", "imslp"], f"AND c_custkey IN ({_CHOSEN})"))
def live_counts_of_choice(spark, sf):
    return bitmaps.live_counts(_indexed(spark, sf)[1], "style", None, CHOICES)


@query(f"SELECT s AS source, count(DISTINCT c_custkey) AS n FROM (SELECT c_custkey, unnest([x.s, '']) AS s FROM ({_STYLES}) WHERE x.v IS NOT NULL) GROUP BY 1")
def style_source_coverage(spark, sf):
    return bitmaps.coverage(_indexed(spark, sf)[1], "style")


@query(_CHOSEN)
def parents_of_choice(spark, sf):
    numbered, index = _indexed(spark, sf)
    return bitmaps.fitting(numbered, index, CHOICES).select("c_custkey")


# The manifest: windows, coverage of tags, styles of children.


@query(
    """SELECT 'count' AS section, 'parents' AS name, '' AS value, count(*) AS n FROM customer UNION ALL SELECT 'count', 'children', '', count(*) FROM orders UNION ALL SELECT 'facet', 'segment', c_mktsegment, count(*) FROM customer GROUP BY 3
    UNION ALL SELECT 'window', '', CASE WHEN c_custkey % 4 = 0 THEN '2024-01..2024-12' ELSE '2025-01..2025-12' END, count(*) FROM customer WHERE c_custkey % 5 <> 0 GROUP BY 3 UNION ALL SELECT 'covered', 'tagged', '', count(*) FROM customer WHERE c_custkey % 2 = 0 OR c_custkey % 3 = 0
    UNION ALL SELECT 'covered', 'wikidata', '', count(*) FROM customer WHERE c_custkey % 2 = 0 UNION ALL SELECT 'covered', 'llm', '', count(*) FROM customer WHERE c_custkey % 3 = 0 UNION ALL SELECT 'child_facet', 'style', x, count(*) FROM (SELECT unnest([o_orderstatus, 'p' || (o_orderkey % 3)]) AS x FROM orders) GROUP BY 3
    UNION ALL SELECT 'label', '2025', '', 1"""
)
def viewer_manifest_in_full(spark, sf):
    k = F.col("c_custkey")
    window = F.when(k % 5 == 0, "").when(k % 4 == 0, "2024-01..2024-12").otherwise("2025-01..2025-12")
    covered = {"tagged": (k % 2 == 0) | (k % 3 == 0), "wikidata": k % 2 == 0, "llm": k % 3 == 0}
    styles = F.array("o_orderstatus", F.concat(F.lit("p"), F.col("o_orderkey") % 3))
    entries = checkpointed(facets.manifest(t(spark, sf, "customer"), t(spark, sf, "orders"), {"segment": F.array("c_mktsegment")}, [], covered, window, {"style": styles}))
    label = spark.range(1).select(F.lit("label").alias("section"), F.lit(facets.window_label(entries)).alias("name"), F.lit("").alias("value"), F.lit(1).cast("long").alias("n"))
    return entries.unionByName(label)


# Sheets of a gold set.


def sql_allocation(source: str, total: int, minimum: int) -> str:
    """CTEs ``s`` (stratum, id, ...: ``source``) and ``a`` (h, n, g): rows of each stratum and how many are drawn."""
    return f"""s AS ({source}), z AS (SELECT stratum AS h, count(*) AS n FROM s GROUP BY 1), i AS (SELECT h, n, least({total}, sum(n) OVER ()) * sqrt(n) / sum(sqrt(n)) OVER () AS ideal, least({total}, sum(n) OVER ()) AS aim FROM z),
    g0 AS (SELECT h, n, ideal, aim, least(n, greatest({minimum}, CAST(round_even(ideal, 0) AS BIGINT))) AS g FROM i), st(gs, step) AS (SELECT list({{h: h, n: n, ideal: ideal, g: g}} ORDER BY h), 0 FROM g0 UNION ALL SELECT list_transform(gs, lambda x: {{h: x.h, n: x.n, ideal: x.ideal, g: x.g + CASE WHEN x.h = pick.h THEN sgn ELSE 0 END}}), step + 1 FROM (
    SELECT gs, step, sgn, list_sort(list_transform(list_filter(gs, lambda x: CASE WHEN sgn > 0 THEN x.g < x.n ELSE x.g > least({minimum}, x.n) END), lambda x: {{d: x.ideal - x.g, h: x.h}}))[CASE WHEN sgn > 0 THEN -1 ELSE 1 END] AS pick FROM (SELECT gs, step, sign((SELECT max(aim) FROM g0) - list_sum(list_transform(gs, lambda x: x.g))) AS sgn FROM st)) WHERE sgn <> 0 AND step < 200),
    a AS (SELECT x.h AS h, x.n AS n, CAST(x.g AS BIGINT) AS g FROM (SELECT unnest(gs) AS x FROM st WHERE step = (SELECT max(step) FROM st)))"""


_PICKED = "p AS (SELECT stratum, id, n, g, (row_number() OVER (ORDER BY stratum, md5('gold:' || id), id) - 1) % 3 + 1 AS package FROM (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY md5('gold:' || id), id) AS rn FROM s) JOIN a ON h = stratum WHERE rn <= g)"
_SHEETS = f"WITH RECURSIVE {sql_allocation('SELECT c_mktsegment AS stratum, CAST(c_custkey AS VARCHAR) AS id FROM customer', 60, 5)}, {_PICKED}, r AS (SELECT id FROM p ORDER BY md5('gold-again:' || id), id LIMIT 10) SELECT stratum AS c_mktsegment, id, n AS stratum_size, g AS stratum_sample, n / g AS weight, package, id IN (SELECT id FROM r) AS recheck FROM p"


@query(_SHEETS)
def gold_sheets(spark, sf):
    rows = t(spark, sf, "customer").select("c_mktsegment", F.col("c_custkey").cast("string").alias("id"))
    return gold.build_sheets(rows, "c_mktsegment", "id", 60, 5, 3, 10, "gold")


_SPREAD = f"""WITH RECURSIVE {sql_allocation("SELECT o_orderpriority AS stratum, CAST(o_orderkey AS VARCHAR) AS id, o_orderstatus AS spread FROM orders", 90, 10)},
    o AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY spread, md5('gold:' || id), id) - 1 AS pos FROM s JOIN a ON h = stratum), d AS (SELECT stratum, id, spread, n, g FROM o WHERE pos IN (SELECT CAST(floor(0.5 * (b.n / b.g) + j * (b.n / b.g)) AS BIGINT) FROM a b, (SELECT unnest(range(90)) AS j) WHERE b.h = o.stratum AND j < b.g)),
    p AS (SELECT *, (row_number() OVER (ORDER BY stratum, md5('gold:' || id), id) - 1) % 4 + 1 AS package FROM d), r AS (SELECT id FROM p WHERE package = 1 ORDER BY md5('gold-again:' || id), id LIMIT 8)
    SELECT stratum AS o_orderpriority, id, spread AS o_orderstatus, n AS stratum_size, g AS stratum_sample, round(n / g, 4) AS weight, package, id IN (SELECT id FROM r) AS recheck, 'W' || lpad(CAST(row_number() OVER (ORDER BY package, md5('gold-items:' || id), id) AS VARCHAR), 3, '0') AS item FROM p"""


@query(_SPREAD)
def systematic_sheets(spark, sf):
    rows = t(spark, sf, "orders").select("o_orderpriority", F.col("o_orderkey").cast("string").alias("id"), "o_orderstatus")
    design = checkpointed(gold.build_sheets(rows, "o_orderpriority", "id", 90, 10, 4, 8, "gold", spread="o_orderstatus", core=True))
    return gold.numbered_items(design, "id", "W", "gold").withColumn("weight", F.round("weight", 4))


# Metrics of works: answers and cells made from the order's key.

FORMS, FAMILIES = ["sonata", "song", "mass", "none"], ["piano", "choir", "unsure"]
CELLS = ["sonata", "", "arrangement", "song", "mass"]
_K = "o_orderkey"
_WORKS = f"SELECT o_orderpriority AS s, {sql_pick(FORMS, _K)} AS form, {sql_pick(CELLS, 'o_custkey')} AS had, {sql_pick(FAMILIES, _K)} AS fam, {sql_pick(['piano', 'choir'], 'o_custkey')} AS fam_had, {sql_pick(['yes', 'no', 'unsure'], _K)} AS files, {sql_pick(['true', 'false', '', 'true'], 'o_custkey')} AS files_had, {sql_pick(['none', 'eu_warning', 'unsure'], _K)} AS basis, {sql_pick(['none', 'eu_warning', 'us_only'], 'o_custkey')} AS basis_had FROM orders"
_WORK_RULES = {
    "force_family_wrong": ("fam IN ('piano', 'choir')", "fam <> fam_had"),
    "genre_form_wrong": ("true", "form <> CASE WHEN had = '' THEN 'none' ELSE had END"),
    "genre_form_missed": ("had = ''", "form <> 'none'"),
    "genre_form_spurious": ("had NOT IN ('', 'arrangement')", "form = 'none'"),
    "genre_form_arrangement": ("had = 'arrangement'", "form <> 'none'"),
    "has_files_wrong": ("files IN ('yes', 'no') AND files_had IN ('true', 'false')", "(files = 'yes') <> (files_had = 'true')"),
    "rights_basis_wrong": ("basis IN ('none', 'eu_warning')", "basis <> basis_had"),
}
_WORK_EACH = " UNION ALL ".join(f"SELECT '{k}' AS metric, s, ({e}) AS e, ({e}) AND ({w}) AS w FROM ({_WORKS})" for k, (e, w) in _WORK_RULES.items())


@query(f"SELECT metric, coalesce(s, '') AS stratum, count(*) FILTER (e) AS eligible, count(*) FILTER (w) AS errors, round(count(*) FILTER (w) / nullif(count(*) FILTER (e), 0), 6) AS rate FROM ({_WORK_EACH}) GROUP BY GROUPING SETS ((metric, s), (metric))")
def gold_scores_of_works(spark, sf):
    orders = t(spark, sf, "orders")
    said = orders.select("o_orderkey", F.col("o_orderpriority").alias("stratum"), pick(FORMS, _K).alias("genre_form"), pick(FAMILIES, _K).alias("force_family"), pick(["yes", "no", "unsure"], _K).alias("has_files"), pick(["none", "eu_warning", "unsure"], _K).alias("rights_basis"), pick(["", "nonpd_eu|x", "pd_us_only"], "o_custkey").alias("dump_imslp_copyright_flags"))
    had = orders.select("o_orderkey", pick(CELLS, "o_custkey").alias("dump_genre_form"), pick(["piano", "choir"], "o_custkey").alias("dump_force_family"), pick(["true", "false", "", "true"], "o_custkey").alias("dump_has_files"))
    return gold.scores(said.join(had, "o_orderkey"), "stratum", gold.work_metrics(FAMILIES[:2], FORMS, ["none", "eu_warning"])).withColumn("rate", F.round("rate", 6))


# Three annotators over orders; the third leaves every third order out. One field is nominal, one a set.

_GIVEN = """SELECT o_orderkey AS u, o_orderstatus AS s, unnest([{'a': 'a1', 'f': 'form', 'v': 'f' || (o_orderkey % 4)}, {'a': 'a2', 'f': 'form', 'v': 'f' || (CASE WHEN o_orderkey % 5 = 0 THEN o_custkey % 4 ELSE o_orderkey % 4 END)}, {'a': 'a3', 'f': 'form', 'v': CASE WHEN o_orderkey % 3 <> 0 THEN 'f' || (o_custkey % 4) END},
    {'a': 'a1', 'f': 'styles', 'v': '1|x'}, {'a': 'a2', 'f': 'styles', 'v': CASE WHEN o_custkey % 2 = 0 THEN '1|x' ELSE '1|2|x' END}, {'a': 'a3', 'f': 'styles', 'v': CASE WHEN o_orderkey % 3 = 0 THEN NULL WHEN o_custkey % 5 = 0 THEN 'y' ELSE '2|x' END}]) AS r FROM orders"""
_ROWS = f"v AS (SELECT u, s, r.a AS a, r.f AS f, r.v AS v, count(*) OVER (PARTITION BY u, r.f) AS m FROM ({_GIVEN}) WHERE r.v IS NOT NULL), p AS (SELECT unnest([x.s, '']) AS s, x.f AS f, x.a AS a, y.a AS b, x.v AS va, y.v AS vb, 1 / (x.m - 1) AS w FROM v x JOIN v y ON x.u = y.u AND x.f = y.f AND x.a < y.a)"
_SHARED = "len(list_intersect(string_split({0}, '|'), string_split({1}, '|')))"
_SIZES = "len(string_split({0}, '|')) + len(string_split({1}, '|'))"


def _sql_jaccard(a, b):
    shared = _SHARED.format(a, b)
    return f"({shared} / ({_SIZES.format(a, b)} - {shared}))"


def _sql_distance(a, b):
    shared = _SHARED.format(a, b)
    return f"CASE WHEN f = 'form' THEN ({a} <> {b})::INT WHEN {a} = {b} THEN 0 WHEN {shared} = 0 THEN 1 ELSE 1 - {_sql_jaccard(a, b)} * CASE WHEN {shared} = least(len(string_split({a}, '|')), len(string_split({b}, '|'))) THEN 2 / 3 ELSE 1 / 3 END END"


def _cube(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    f = lambda x: F.concat(F.lit("f"), x % 4)
    form = {"a1": f(k), "a2": F.when(k % 5 == 0, f(c)).otherwise(f(k)), "a3": F.when(k % 3 != 0, f(c)).otherwise("")}
    styles = {"a1": F.lit("x|1|x"), "a2": F.when(c % 2 == 0, "1|x").otherwise("x|2|1"), "a3": F.when(k % 3 == 0, "").when(c % 5 == 0, "y").otherwise("2|x")}
    sheets = F.explode(F.array(*(F.struct(F.lit(a).alias("by"), form[a].alias("form"), styles[a].alias("styles")) for a in form)))
    said = t(spark, sf, "orders").select("o_orderkey", "o_orderstatus", sheets.alias("x")).select("o_orderkey", "o_orderstatus", "x.*")
    return gold.coincidences(gold.answers(said, "o_orderkey", F.col("by"), ["form", "styles"], F.col("o_orderstatus")), ["styles"])


@query(
    f"""WITH {_ROWS}, n AS (SELECT s, f, a, b, count(*) AS pairs, avg((va = vb)::INT) AS agree, CASE WHEN f = 'styles' THEN avg({_sql_jaccard('va', 'vb')}) END AS jaccard FROM p GROUP BY s, f, a, b), e AS (SELECT s, f, a, b, sum(x.n * y.n) AS e FROM (SELECT s, f, a, b, va AS v, count(*) AS n FROM p GROUP BY ALL) x JOIN (SELECT s, f, a, b, vb AS v, count(*) AS n FROM p GROUP BY ALL) y USING (s, f, a, b, v) GROUP BY ALL)
    SELECT s AS stratum, f AS field, a, b, pairs, round(agree, 6) AS agree, CASE WHEN f = 'form' THEN round((agree - coalesce(e, 0) / (pairs * pairs)) / (1 - coalesce(e, 0) / (pairs * pairs)), 6) END AS kappa, round(jaccard, 6) AS jaccard FROM n LEFT JOIN e USING (s, f, a, b)"""
)
def annotator_agreement(spark, sf):
    out = gold.pair_agreement(_cube(spark, sf), ["styles"])
    return out.withColumns({c: F.round(c, 6) for c in ("agree", "kappa", "jaccard")})


@query(
    f"""WITH {_ROWS}, o AS (SELECT s, f, count(*) AS pairs, avg((va = vb)::INT) AS agree, 2 * sum(w * ({_sql_distance('va', 'vb')})) AS o, 2 * sum(w) AS t FROM p GROUP BY s, f), m AS (SELECT s, f, v, sum(w) AS m FROM (SELECT s, f, unnest([va, vb]) AS v, w FROM p) GROUP BY ALL),
    e AS (SELECT s, f, sum(x.m * y.m * ({_sql_distance('x.v', 'y.v')})) AS e FROM m x JOIN m y USING (s, f) GROUP BY s, f) SELECT s AS stratum, f AS field, pairs, round(agree, 6) AS agree, round(1 - (t - 1) * o / e, 6) AS alpha FROM o JOIN e USING (s, f)"""
)
def annotator_alpha(spark, sf):
    out = gold.field_alpha(_cube(spark, sf), ["styles"])
    return out.withColumns({c: F.round(c, 6) for c in ("agree", "alpha")})


# Periods of three sources against an annotator's, kappa by source.

PERIODS = ["baroque", "classical", "romantic", ""]
_PERIODS = f"SELECT unnest([{{'q': 'llm', 'v': {sql_pick(PERIODS, 'c_custkey')}}}, {{'q': 'pages', 'v': {sql_pick(PERIODS[::-1], 'c_custkey + c_nationkey')}}}]) AS x, {sql_pick(PERIODS, 'c_custkey + (CASE WHEN c_nationkey > 9 THEN 1 ELSE 0 END)')} AS h FROM customer"


@query(
    f"""WITH p AS (SELECT x.q AS source, x.v AS v, h FROM ({_PERIODS}) WHERE x.v <> '' AND h <> ''), n AS (SELECT source, count(*) AS pairs, avg((v = h)::INT) AS agree FROM p GROUP BY 1), e AS (SELECT source, sum(x.n * y.n) AS e FROM (SELECT source, v, count(*) AS n FROM p GROUP BY ALL) x JOIN (SELECT source, h AS v, count(*) AS n FROM p GROUP BY ALL) y USING (source, v) GROUP BY 1)
    SELECT source, pairs, round(agree, 6) AS agree, round((agree - coalesce(e, 0) / (pairs * pairs)) / (1 - coalesce(e, 0) / (pairs * pairs)), 6) AS kappa FROM n LEFT JOIN e USING (source)"""
)
def period_kappas(spark, sf):
    k = F.col("c_custkey")
    wide = t(spark, sf, "customer").select(k, pick(PERIODS, "c_custkey").alias("llm"), pick(PERIODS[::-1], "c_custkey + c_nationkey").alias("pages"), pick(PERIODS, "c_custkey + (CASE WHEN c_nationkey > 9 THEN 1 ELSE 0 END)").alias("human"))
    out = gold.period_kappas(wide, "c_custkey", {"llm": "llm", "pages": "pages"}, "human")
    return out.withColumns({c: F.round(c, 6) for c in ("agree", "kappa")})


# A release: the export read back against the flat table, spot rules, the manifest's counts.


@query("SELECT error, n FROM (SELECT unnest([{'error': 'lost', 'n': count(*) FILTER (k % 97 = 0)}, {'error': 'extra', 'n': count(*) FILTER (k % 97 <> 0 AND k % 89 = 0)}, {'error': 'changed', 'n': count(*) FILTER (k % 97 <> 0 AND k % 83 = 0)}], recursive := true) FROM (SELECT o_orderkey AS k FROM orders WHERE o_custkey IN (SELECT c_custkey FROM customer))) WHERE n > 0")
def export_parity(spark, sf):
    orders, customers, k = t(spark, sf, "orders"), t(spark, sf, "customer"), F.col("o_orderkey")
    nested = facets.export(customers, orders, "c_custkey", "o_custkey", ["o_orderkey", "o_orderstatus", "o_orderpriority"], "o_orderkey")
    exported = facets.flat_children(nested, "c_custkey", "o_orderkey string, o_orderstatus string, o_orderpriority string")
    flat = orders.withColumnRenamed("o_custkey", "c_custkey").join(customers.select("c_custkey"), "c_custkey", "left_semi").where(k % 97 != 0)
    flat = flat.withColumn("o_orderstatus", F.when(k % 83 == 0, "X").otherwise(F.col("o_orderstatus"))).withColumn("copy", F.explode(F.when(k % 89 == 0, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
    return parity.parity_errors(exported, flat, "o_orderkey", ["c_custkey", "o_orderstatus", "o_orderpriority"], 256)


GENRES = ["Operas ; For voices", "For orchestra ; Symphonies", "For orchestra (arr) ; Symphonies", "For orchestra ; Overtures", "Songs"]
FORCES = ["concerto", "piano_ensemble", "orchestra"]


@query(f"SELECT rule, n FROM (SELECT unnest([{{'rule': 'opera as concerto', 'n': count(*) FILTER (f = 'concerto' AND g LIKE '%Operas%')}}, {{'rule': 'orchestra as piano ensemble', 'n': count(*) FILTER (f = 'piano_ensemble' AND g LIKE 'For orchestra ;%')}}], recursive := true) FROM (SELECT {sql_pick(GENRES, 'o_orderkey')} AS g, {sql_pick(FORCES, 'o_custkey')} AS f FROM orders)) UNION ALL SELECT 'living without death year', count(*) FILTER (c_custkey % 2 = 0 AND c_custkey % 3 = 0) FROM customer")
def spot_rules(spark, sf):
    works = t(spark, sf, "orders").select(pick(GENRES, "o_orderkey").alias("imslp_genre_categories"), pick(FORCES, "o_custkey").alias("force_family"))
    k = F.col("c_custkey")
    people = t(spark, sf, "customer").select(F.when(k % 2 == 0, "living").otherwise("pd").alias("eu_pd_status"), F.when(k % 3 != 0, "1900").otherwise("").alias("death_year"))
    return snapshots.violations(works, snapshots.spot_rules()).unionByName(snapshots.violations(people, [snapshots.living_without_year()]))


@query("SELECT 'manifest of another snapshot' AS error, 1 AS n UNION ALL SELECT 'count of works', 3")
def manifest_errors(spark, sf):
    orders, customers = t(spark, sf, "orders"), t(spark, sf, "customer")
    entries = {r["name"]: r["n"] for r in facets.manifest(customers, orders, {}, []).collect()}  # one row for each fact
    return snapshots.manifest_errors({"people": entries["parents"], "works": entries["children"] + 3}, "r1", "r2", {"people": customers, "works": orders})
