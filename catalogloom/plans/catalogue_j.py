"""Queries of style vocabularies, merged people, summaries of licence blocks, the matrix of rights, queues and the report of two snapshots, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions import cells, styles
from ..operators import resolve, snapshots, status, works
from .catalogue_d import pick, sql_list, sql_pick
from .registry import query, t

# Style tags of each part.

TAGS = ["late_romantic", "national_folk", "free_jazz_music", "Romantic", "", "Romántico"]
SHOWN = ["Late Romantic", "National / folk", "Free Jazz Music", "Romantic", "", "Romántico"]
SLUGS = ["late_romantic", "national_folk", "", "", "", ""]
PERIOD_SLUGS = ["", "", "", "romantic", "", "romantic"]
CATEGORIES = ["Category:A b", " C d ", "E"]
TITLES = ["Sonata (Bell, Ann)", "Sonata (a) No.1 (Bell (x), Ann)", "Sonata ", "(odd)", "x) (y"]


@query(f"""SELECT p_partkey, {sql_pick(SHOWN, 'p_partkey')} AS shown, nullif({sql_pick(SLUGS, 'p_partkey')}, '') AS tag_slug, nullif({sql_pick(PERIOD_SLUGS, 'p_partkey')}, '') AS period_slug, 'https://w/' || {sql_pick(['Category:A_b', 'Category:C_d', 'Category:E'], 'p_partkey')} AS url, {sql_pick(['Sonata', 'Sonata (a) No.1 (Bell', 'Sonata', '', 'x) (y'], 'p_partkey')} AS title FROM part""")
def style_names(spark, sf):
    tag = pick(TAGS, "p_partkey")
    return t(spark, sf, "part").select("p_partkey", styles.shown_tag(tag).alias("shown"), styles.tag_slug(tag).alias("tag_slug"), styles.period_slug(tag).alias("period_slug"), cells.category_url(pick(CATEGORIES, "p_partkey"), "https://w/").alias("url"), cells.without_composer(pick(TITLES, "p_partkey")).alias("title"))


VOTES = ["a=romantic|jazz;b=unknown", "b=serialism", "", "c=x;a=traditional_folk"]
OLD = ["within5|now", "soon|nothing", "", "later"]
STATUSES = ["pd|not_pd", "unknown_death", "x", ""]
VALUES = ["zz|Jazz|romantic|Baroque|Jazz|aa", "late_romantic|Romantic", "", "Modern|Ancient|B"]


@query(f"""SELECT c_custkey, {sql_pick(['Romantic,Jazz//unknown', '~//serialism', '', 'Traditional (folk)//~'], 'c_custkey')} AS votes, {sql_pick(['Romantic,Jazz//', '~//serialism', '', 'Traditional (folk)//~'], 'c_custkey')} AS periods, {sql_pick(['next|soon|now|later', 'soon|unknown', '', 'later'], 'c_custkey')} AS buckets,
    {sql_pick(['Baroque|Jazz|aa|romantic|zz', 'Romantic|late_romantic', '', 'Ancient|Modern|B'], 'c_custkey')} AS vocabulary, {sql_pick(['Romantic|Traditional (folk)', 'Traditional (folk)', '', 'x'], 'c_custkey')} AS merged FROM customer""")
def style_votes_and_order(spark, sf):
    cell = pick(VOTES, "c_custkey")
    flat = lambda v: F.array_join(F.transform(v, lambda x: F.coalesce(F.array_join(x, ","), F.lit("~"))), "//")
    votes, periods = styles.votes_by_labeller(cell, ["a", "b"]), styles.period_votes_by_labeller(cell, ["a", "b"])
    return t(spark, sf, "customer").select(
        "c_custkey", flat(votes).alias("votes"), F.array_join(F.transform(periods, lambda x: F.coalesce(F.replace(x, F.lit("|"), F.lit(",")), F.lit("~"))), "//").alias("periods"),
        F.array_join(styles.buckets_of_old_address(cells.split_cell(pick(OLD, "c_custkey")), cells.split_cell(pick(STATUSES, "c_custkey"))), "|").alias("buckets"),
        F.array_join(styles.in_order(cells.split_cell(pick(VALUES, "c_custkey"))), "|").alias("vocabulary"), F.array_join(styles.canonical_styles(pick(["Romántico|Traditional|Romantic", "Traditional|Traditional (folk)", "", "x|x"], "c_custkey")), "|").alias("merged"),
    )


# People that repeat: a customer for each of its orders.

_PEOPLE = "SELECT o_custkey AS k, o_orderkey AS o, 'n' || (o_orderkey % 4) AS name, CASE WHEN o_orderkey % 3 = 0 THEN ['a' || (o_orderkey % 5), 'n1'] ELSE [] END AS al, 'w/' || CASE WHEN o_orderkey % 6 = 0 THEN 'X_and_Y' ELSE 'Z' END || o_orderkey AS url, o_orderkey % 6 = 0 AS pair, year(o_orderdate) AS y, o_orderkey % 7 AS v FROM orders"


@query(f"""WITH r AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY v DESC, o) AS i, count(*) OVER (PARTITION BY k) AS n FROM ({_PEOPLE})), cur AS (SELECT *, coalesce(last_value(CASE WHEN pair THEN name END IGNORE NULLS) OVER (PARTITION BY k ORDER BY i ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), first_value(name) OVER (PARTITION BY k ORDER BY i)) AS now FROM r),
    f AS (SELECT k, max(n) AS n, coalesce(arg_max(name, i) FILTER (pair), arg_min(name, i)) AS name, coalesce(arg_max(url, i) FILTER (pair), arg_min(url, i)) AS url, min(y) AS b, max(y) AS d FROM r GROUP BY k), a AS (SELECT k, name AS x FROM cur WHERE name <> now UNION SELECT k, unnest(al) FROM r)
    SELECT f.k AS o_custkey, CASE WHEN f.n = 1 THEN array_to_string(max(one.al), '|') ELSE coalesce(string_agg(DISTINCT x, '|' ORDER BY x) FILTER (x <> f.name), '') END AS name_aliases, f.name AS name_display, f.url AS wikipedia_url, f.b AS birth_year, f.d AS death_year, f.n AS n_merged FROM f LEFT JOIN a USING (k) LEFT JOIN r one ON one.k = f.k AND one.i = 1 GROUP BY f.k, f.name, f.url, f.b, f.d, f.n""")
def merge_people(spark, sf):
    k = F.col("o_orderkey")
    aliases = F.when(k % 3 == 0, F.concat(F.lit("a"), k % 5, F.lit("|n1"))).otherwise("")
    url = F.concat(F.lit("w/"), F.when(k % 6 == 0, "X_and_Y").otherwise("Z"), k)
    rows = t(spark, sf, "orders").select("o_custkey", k.alias("o"), F.concat(F.lit("n"), k % 4).alias("name_display"), aliases.alias("name_aliases"), url.alias("wikipedia_url"), F.year("o_orderdate").alias("birth_year"), F.year("o_orderdate").alias("death_year"))
    return resolve.merge_people(rows, "o_custkey", [-(F.col("o") % 7), F.col("o")]).drop("o")


# Licence blocks of pages.

RIGHTS = ["Public Domain", "Creative Commons Attribution 4.0", "odd words", "Creative Commons Attribution-ShareAlike 3.0"]
LICENCES = ["PD", "CC-BY-4.0", "unparsed", "CC-BY-SA-3.0"]
_BLOCKS = f"SELECT o_custkey AS c, o_orderkey AS k, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS block, o_orderkey % 5 = 0 AS audio, {sql_pick(RIGHTS, 'o_orderkey')} AS raw, {sql_pick(LICENCES, 'o_orderkey')} AS l, o_orderkey % 4 IN (1, 3) AS open, CASE WHEN o_orderkey % 2 = 0 THEN 'Typeset' ELSE 'Normal Scan' END AS image FROM orders WHERE o_custkey % 10 NOT IN (3, 4)"


def _blocks(spark, sf):
    k, c = F.col("o_orderkey"), F.col("o_custkey")
    line = lambda n, v: F.concat(F.lit(f"\n|{n}="), v)
    block = F.concat(F.when(k % 5 == 0, "{{#fte:imslpaudio").otherwise("{{#fte:imslpfile"), line("File Name 1", F.concat(F.lit("f"), k, F.lit(".pdf"))), F.when(k % 3 == 0, line("File Name 2", F.lit("g.mid"))).otherwise(""), line("Copyright", pick(RIGHTS, "o_orderkey")), line("Image Type", F.when(k % 2 == 0, "Typeset").otherwise("Normal Scan")), line("Editor", F.lit("{{x|y}}")), F.lit("\n}}\n"))
    pages = t(spark, sf, "orders").select(c, k, block.alias("b")).groupBy("o_custkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "b"))), lambda x: x["b"]), "").alias("blocks"))
    source = F.concat(F.lit("== Files ==\n{{other|x=1}}\n{{wrap|of=\n"), "blocks", F.lit("\n}}"))
    documents = pages.select(F.col("o_custkey").alias("imslp_pageid"), source.alias("wikitext"), (c * 2).alias("revid"), (c % 10 == 3).alias("missing"), F.when(c % 10 == 4, True).alias("redirect"))
    people = t(spark, sf, "customer").select(F.concat(F.lit("w"), F.col("c_custkey")).alias("work_id"), F.concat(F.lit("Q"), F.col("c_nationkey")).alias("composer_id"), F.col("c_custkey").alias("imslp_pageid"))
    return works.full_block_rows(people, documents)


@query(f"""SELECT 'w' || c AS work_id, 'Q' || c_nationkey AS composer_id, c AS imslp_pageid, CAST(block AS INTEGER) AS block, CASE WHEN audio THEN 'audio' ELSE 'score' END AS kind, 'Files' AS section, CASE WHEN k % 3 = 0 THEN 2 ELSE 1 END AS n_files, CASE WHEN k % 3 = 0 THEN 'pdf|midi' ELSE 'pdf' END AS formats, image AS image_type, raw AS copyright_raw, l AS licence, open AS open_licence, '{{{{x|y}}}}' AS editor, '' AS arranger, '' AS uploader, '' AS date_submitted, 'f' || k || '.pdf' || CASE WHEN k % 3 = 0 THEN '|g.mid' ELSE '' END AS file_names, c * 2 AS revid FROM ({_BLOCKS}) JOIN customer ON c_custkey = c""")
def block_rows_in_full(spark, sf):
    return _blocks(spark, sf)


@query(f"""SELECT 'w' || c AS work_id, count(*) AS n_score_blocks, string_agg(DISTINCT l, '|' ORDER BY l) AS score_licences, count(*) FILTER (open) AS n_open_score_blocks, coalesce(string_agg(DISTINCT l, '|' ORDER BY l) FILTER (open), '') AS open_score_licences, bool_or(image = 'Typeset') FILTER (open) AS open_score_typeset, CASE WHEN bool_or(k % 3 = 0) FILTER (open) THEN 'midi|pdf' WHEN count(*) FILTER (open) > 0 THEN 'pdf' ELSE '' END AS open_score_formats FROM ({_BLOCKS}) JOIN customer ON c_custkey = c WHERE NOT audio GROUP BY c""")
def work_licences(spark, sf):
    return works.work_summary(_blocks(spark, sf))


@query(f"""SELECT 'licence' AS section, CASE WHEN audio THEN 'audio' ELSE 'score' END AS name, l AS value, count(*) AS n FROM ({_BLOCKS}) JOIN customer ON c_custkey = c GROUP BY 2, 3 UNION ALL SELECT 'unparsed', '', raw, count(*) FROM ({_BLOCKS}) JOIN customer ON c_custkey = c WHERE l = 'unparsed' GROUP BY 3
    UNION ALL SELECT 'open', unnest(['works', 'owners']), '', unnest([count(DISTINCT c), count(DISTINCT c_nationkey)]) FROM ({_BLOCKS}) JOIN customer ON c_custkey = c WHERE open AND NOT audio""")
def block_report(spark, sf):
    return works.block_report(_blocks(spark, sf))


# Rights by band of years.

HOSTS = ["ca", "ca|asia", "us", ""]
GROUPS = ["ca (main server only)", "asia (life+50 server)", "us (US-only server)", "unknown"]
BANDS = ["≤ 1995", "1996–1997", "1998–1999", "2000+", "unknown"]
KEYS = ["eu_warning", "us_only", "licensed", "wima", "us_routes", "none"]
_CUBE = f"SELECT CASE WHEN o_orderkey % 9 = 0 THEN 'unknown' WHEN y <= 1995 THEN '≤ 1995' WHEN y <= 1997 THEN '1996–1997' WHEN y <= 1999 THEN '1998–1999' ELSE '2000+' END AS b, {sql_pick(['eu_warning', 'us_only', 'none'], 'o_orderkey')} AS k, {sql_pick(GROUPS, 'o_custkey')} AS h FROM (SELECT *, year(o_orderdate) AS y FROM orders)"


@query(f"""WITH c AS ({_CUBE}), b AS (SELECT unnest({sql_list(BANDS)}) AS b), k AS (SELECT unnest({sql_list(KEYS)}) AS k) SELECT 'basis' AS section, b.b AS row, k.k AS col, count(c.b) AS n FROM b CROSS JOIN k LEFT JOIN c ON c.b = b.b AND c.k = k.k GROUP BY 2, 3 UNION ALL SELECT 'works', b.b, '', count(c.b) FROM b LEFT JOIN c USING (b) GROUP BY 2
    UNION ALL SELECT 'warned', b.b, '', count(c.b) FILTER (k = 'eu_warning') FROM b LEFT JOIN c USING (b) GROUP BY 2 UNION ALL SELECT 'unflagged', b, h, count(*) FROM c WHERE k = 'none' AND b NOT IN ('≤ 1995', 'unknown') GROUP BY 2, 3 UNION ALL SELECT 'hosts', h.h, b.b, count(c.b) FROM (SELECT DISTINCT h FROM c) h CROSS JOIN b LEFT JOIN c ON c.b = b.b AND c.h = h.h GROUP BY 2, 3""")
def rights_matrix(spark, sf):
    flags = pick(["nonpd_eu|wima", "pd_us_only", ""], "o_orderkey")
    year = F.when(F.col("o_orderkey") % 9 == 0, "").otherwise(F.year("o_orderdate").cast("string"))
    return status.basis_report(t(spark, sf, "orders"), status.death_band(year, 2066, 1997), status.rights_basis(flags), status.host_group(F.lit(""), pick(HOSTS, "o_custkey")), 2066, 1997)


# A queue of weak labels, and the owners in it.

_WEAK = "SELECT * FROM orders WHERE o_orderpriority IN ('5-LOW', '4-NOT SPECIFIED') AND o_custkey % 11 <> 0"


def _queue(spark, sf):
    orders = t(spark, sf, "orders").withColumn("context", F.when(F.col("o_orderkey") % 3 == 0, "c").otherwise("")).withColumn("title", F.concat(F.lit("t"), "o_orderkey"))
    return status.residual_queue(orders, "o_orderkey", "o_custkey", "o_orderpriority", "context", "title", ["5-LOW", "4-NOT SPECIFIED"], orders.where("o_custkey % 11 = 0"), 100, 5)


@query(f"SELECT o_orderkey, o_orderkey % 3 = 0 AS has_context FROM ({_WEAK}) ORDER BY has_context DESC, o_orderkey LIMIT 100")
def weak_labels(spark, sf):
    return _queue(spark, sf)[0].select("o_orderkey", "has_context")


@query(f"SELECT o_custkey, array_to_string(list('t' || o_orderkey ORDER BY o_orderkey)[1:5], '|') AS titles, count(*) AS n FROM ({_WEAK}) GROUP BY 1")
def owners_of_weak_labels(spark, sf):
    return _queue(spark, sf)[1]


# Two snapshots of the orders: rows that went and came, statuses, years, sources and flags that changed.

_OLD = "SELECT o_orderkey AS k, o_custkey AS c, o_orderstatus AS st, CAST(year(o_orderdate) AS VARCHAR) AS y, CASE WHEN o_orderkey % 2 = 0 THEN 'llm_a' ELSE 'title' END AS src, 'a|b' AS fl, 'x' AS dump_date FROM orders WHERE o_orderkey % 13 <> 0"
_NEW = "SELECT o_orderkey AS k, o_custkey AS c, CASE WHEN o_orderkey % 7 = 0 THEN '' ELSE o_orderstatus END AS st, CASE WHEN o_orderkey % 5 = 0 THEN '1' ELSE CAST(year(o_orderdate) AS VARCHAR) END AS y, CASE WHEN o_orderkey % 4 = 0 THEN 'title' WHEN o_orderkey % 2 = 0 THEN 'llm_a' ELSE 'title' END AS src, CASE WHEN o_orderkey % 3 = 0 THEN 'b|c' ELSE 'a|b' END AS fl, 'z' AS dump_date FROM orders WHERE o_orderkey % 17 <> 0"


@query(f"""WITH o AS ({_OLD}), n AS ({_NEW}), j AS (SELECT o.k AS ok, n.k AS nk, coalesce(o.c, n.c) AS c, o.st AS st, n.st AS st2, o.y AS y, n.y AS y2, o.src AS src, n.src AS src2, coalesce(o.fl, '') AS fl, coalesce(n.fl, '') AS fl2 FROM o FULL JOIN n ON o.k = n.k), b AS (SELECT * FROM j WHERE ok IS NOT NULL AND nk IS NOT NULL),
    f AS (SELECT 'rows' AS section, 'old' AS name, '' AS value, count(ok) AS n FROM j UNION ALL SELECT 'rows', 'new', '', count(nk) FROM j UNION ALL SELECT 'rows', 'added', '', count(*) FROM j WHERE ok IS NULL UNION ALL SELECT 'rows', 'removed', '', count(*) FROM j WHERE nk IS NULL UNION ALL SELECT 'rows', 'changed', '', count(*) FROM b WHERE st <> st2 OR y <> y2 OR src <> src2 OR fl <> fl2
    UNION ALL SELECT 'cells', unnest(['st', 'y', 'src', 'fl']), '', unnest([count(*) FILTER (st <> st2), count(*) FILTER (y <> y2), count(*) FILTER (src <> src2), count(*) FILTER (fl <> fl2)]) FROM b UNION ALL SELECT 'flip', 'st', st || ' → (empty)', count(*) FROM b WHERE st <> st2 GROUP BY 3 UNION ALL SELECT 'years', 'changed', '', count(*) FROM b WHERE y <> y2
    UNION ALL SELECT 'transition', 'src', src || ' → ' || src2, count(*) FROM b WHERE src <> src2 GROUP BY 3 UNION ALL SELECT 'by_model', 'llm', 'old', count(*) FROM o WHERE src LIKE 'llm%' UNION ALL SELECT 'by_model', 'llm', 'new', count(*) FROM n WHERE src LIKE 'llm%' UNION ALL SELECT 'added by', CAST(c AS VARCHAR), '', count(*) FROM j WHERE ok IS NULL GROUP BY 2 UNION ALL SELECT 'removed by', CAST(c AS VARCHAR), '', count(*) FROM j WHERE nk IS NULL GROUP BY 2
    UNION ALL SELECT 'flag added', x, '', count(*) FROM (SELECT unnest(list_filter(string_split(fl2, '|'), lambda x: x <> '' AND NOT list_contains(string_split(fl, '|'), x))) AS x FROM j) GROUP BY 2 UNION ALL SELECT 'flag removed', x, '', count(*) FROM (SELECT unnest(list_filter(string_split(fl, '|'), lambda x: x <> '' AND NOT list_contains(string_split(fl2, '|'), x))) AS x FROM j) GROUP BY 2
    UNION ALL SELECT 'column', 'only_old', 'removed', 1 UNION ALL SELECT 'column', 'only_new', 'added', 1) SELECT * FROM f WHERE n > 0""")
def snapshot_report(spark, sf):
    k = F.col("o_orderkey")
    rows = t(spark, sf, "orders").select(k.alias("k"), F.col("o_custkey").alias("c"), F.col("o_orderstatus").alias("st"), F.year("o_orderdate").cast("string").alias("y"), F.when(k % 2 == 0, "llm_a").otherwise("title").alias("src"), F.lit("a|b").alias("fl"))
    old = rows.where("k % 13 <> 0").withColumns({"dump_date": F.lit("x"), "only_old": F.lit("1")})
    at = F.col("k")
    new = rows.where("k % 17 <> 0").withColumns({"st": F.when(at % 7 == 0, None).otherwise(F.col("st")), "y": F.when(at % 5 == 0, "1").otherwise(F.col("y")), "src": F.when(at % 4 == 0, "title").otherwise(F.col("src")), "fl": F.when(at % 3 == 0, "b|c").otherwise(F.col("fl")), "dump_date": F.lit("z"), "only_new": F.lit("1")})
    return snapshots.diff_report(old, new, ["k"], ["st"], ["y"], ["src"], {"llm": F.col("src").startswith("llm")}, "fl", "c")
