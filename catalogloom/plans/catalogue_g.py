"""Queries of homepages (decoding, owners, evidence, scores, targets, scans), person templates and whole chains of overrides, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.html_tokens import read_pages
from ..operators import homepages, markup, overlay, persons
from ..sources import html_tables
from .catalogue_d import pick, sql_list, sql_pick
from .catalogue_f import WORKS, _entities
from .registry import query, t

# Each page's bytes are made in one of four encodings, told by a mark, the header, the page itself or nothing.


@query("""SELECT page_id, CASE page_id % 5 WHEN 0 THEN 'utf-8' WHEN 1 THEN 'utf-16-le' WHEN 2 THEN 'utf-8' WHEN 3 THEN 'utf-16-be' ELSE '' END AS charset, CASE WHEN page_id % 5 = 4 THEN md5('') ELSE md5(html) END AS digest FROM pages""")
def decoded_pages(spark, sf):
    k, html = F.col("page_id"), F.col("html")
    content = F.when(k % 5 == 1, F.concat(F.unhex(F.lit("FFFE")), F.encode(html, "UTF-16LE"))).when(k % 5 == 2, F.concat(F.unhex(F.lit("EFBBBF")), F.encode(html, "UTF-8"))).when(k % 5 == 3, F.encode(html, "UTF-16BE")).otherwise(F.encode(html, "UTF-8"))
    kind = F.when(k % 5 == 3, "text/html; charset=UTF-16-BE").when(k % 5 == 4, "application/pdf").when(k % 5 == 0, "text/html").otherwise("")
    made = t(spark, sf, "pages").select("page_id", content.alias("content"), kind.alias("type"))
    return homepages.decoded(made, "content", "type").select("page_id", "charset", F.md5("html").alias("digest"))


HOSTS = ["anna.wordpress.com", "www.body.co.uk", "x.anna.github.io", "m.youtube.com", "a.blogspot.co.at", "shop.amazon.de", "plain.org"]
OWNERS = ["anna.wordpress.com", "body.co.uk", "anna.github.io", "youtube.com", "a.blogspot.co.at", "amazon.de", "plain.org"]
REASONS = ["", "", "", "youtube.com", "", "amazon", ""]


@query(f"SELECT owner, reason, count(*) AS n FROM (SELECT {sql_pick(OWNERS, 's_suppkey')} AS owner, {sql_pick(REASONS, 's_suppkey')} AS reason FROM supplier UNION ALL SELECT array_to_string(string_split(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1), '.')[-2:], '.'), '' FROM pages) GROUP BY 1, 2")
def owners_of_sites(spark, sf):
    urls = t(spark, sf, "supplier").select(F.concat(F.lit("https://"), pick(HOSTS, "s_suppkey"), F.lit("/p?x#y")).alias("url")).unionByName(t(spark, sf, "pages").select("url"))
    return urls.groupBy(homepages.owner_site(F.col("url")).alias("owner"), homepages.denied(F.col("url")).alias("reason")).agg(F.count(F.lit(1)).alias("n"))


# Tags added to each page by its id: a licence by link, badge or wording, and links to scores.

BY = ["by", "by-sa", "by-nc-nd"]
_ADDED = f"SELECT page_id, regexp_replace(url, '[?#].*$', '') AS page, {sql_pick(BY, 'page_id')} AS code FROM pages"


def _with_tags(spark, sf):
    k, code = F.col("page_id"), pick(BY, "page_id")
    trap = '<!-- <a href="https://creativecommons.org/licenses/by/1.0/">CC BY 1.0</a> <a href="/s/trap.pdf">x</a> --><script>var s = "<a href=\'/trap.pdf\'>CC BY 1.0</a>";</script>'
    link = F.concat(F.lit('<a title="x > y" rel="x license" href="&#104;ttps://creativecommons.org/licenses/'), code, F.lit('/4.0/">l</a>'))
    plain = F.concat(F.lit("<LINK HREF = '//creativecommons.org/licenses/"), code, F.lit("/3.0/' />"))
    badge = F.concat(F.lit("<img alt=c src=https://licensebuttons.net/l/"), code, F.lit("/2.0/88x31.png>"))
    worded = F.concat(F.lit("<p>CC "), F.upper(F.regexp_replace(code, "^by-?", "BY ")), F.lit(" 2.5|=</p>"))
    scores = F.concat(F.lit('<a href="/s/'), k.cast("string"), F.lit('.pdf#p">one</a><a href="/s/'), k.cast("string"), F.lit('.PDF">two</a><a href="/f.xml">Partitur</a><a href="/sitemap.xml">score</a>'))
    added = F.concat(F.lit(trap), F.when(k % 2 == 0, link).otherwise(""), F.when(k % 3 == 0, plain).otherwise(""), F.when(k % 5 == 0, badge).otherwise(""), F.when(k % 7 == 0, worded).otherwise(""), F.when(k % 4 != 1, scores).otherwise(""))
    return t(spark, sf, "pages").withColumn("html", F.concat(F.col("html"), added))


_EVIDENCE = f"""SELECT page_id, 'CC-' || upper(code) || '-4.0' AS spdx, 'rel_license' AS kind FROM ({_ADDED}) WHERE page_id % 2 = 0 UNION ALL SELECT page_id, 'CC-' || upper(code) || '-3.0', 'cc_link' FROM ({_ADDED}) WHERE page_id % 3 = 0
    UNION ALL SELECT page_id, 'CC-' || upper(code) || '-2.0', 'cc_badge' FROM ({_ADDED}) WHERE page_id % 5 = 0 UNION ALL SELECT page_id, 'CC-' || upper(code) || '-2.5', 'cc_text' FROM ({_ADDED}) WHERE page_id % 7 = 0"""


@query(_EVIDENCE)
def page_evidence(spark, sf):
    return homepages.evidence(_with_tags(spark, sf), "page_id", "url", "html").select("page_id", "spdx", "kind")


_ROOT = "regexp_extract(url, '^([a-z]+://[^/?#]+)', 1)"


@query(f"SELECT page_id, unnest(['pdf', 'pdf', 'musicxml']) AS format, unnest([{_ROOT} || '/s/' || page_id || '.pdf', {_ROOT} || '/s/' || page_id || '.PDF', {_ROOT} || '/f.xml']) AS address FROM pages WHERE page_id % 4 <> 1")
def page_scores(spark, sf):
    return homepages.score_links(_with_tags(spark, sf), "page_id", "url", "html")


# What the pages' own markup says.

_BARE = r"regexp_replace(regexp_replace(html, '<!--.*?-->|<script.*?</script>|<style.*?</style>', chr(1), 'gs'), '<[^>]*>', chr(1), 'g')"


@query(r"""SELECT name, count(*) AS n, count(DISTINCT page_id) AS n_pages FROM (SELECT page_id, unnest(regexp_extract_all(regexp_replace(html, '<!--.*?-->|<script.*?</script>', '', 'gs'), '<([a-z][a-z0-9]*) [^>]*>', 1)) AS name FROM pages) GROUP BY 1""")
def page_tags(spark, sf):
    read = read_pages(t(spark, sf, "pages").select("page_id", "html"), "html").select("page_id", F.explode("tags.name").alias("name"))
    return read.groupBy("name").agg(F.count(F.lit(1)).alias("n"), F.count_distinct("page_id").alias("n_pages"))


@query(f"SELECT page_id, md5(array_to_string(list_filter(list_transform(string_split({_BARE}, chr(1)), lambda x: trim(replace(replace(replace(replace(replace(replace(x, '&copy;', '©'), '&middot;', '·'), '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), '&amp;', '&'), chr(32) || chr(10) || chr(9) || chr(13))), lambda x: x <> ''), ' ')) AS digest FROM pages")
def page_words(spark, sf):
    return read_pages(t(spark, sf, "pages").select("page_id", "html"), "html").select("page_id", F.md5("words").alias("digest"))


@query(r"""SELECT page_id, place, href, label FROM (SELECT page_id, unnest(l).a AS href, unnest(l).b AS label, unnest(l).i AS place FROM (SELECT page_id, list_transform(x, lambda y, i: {'a': regexp_extract(y, '"([^"]*)"', 1), 'b': trim(regexp_extract(y, '>([^<]*)<', 1)), 'i': CAST(i - 1 AS INTEGER)}) AS l FROM (SELECT page_id, regexp_extract_all(regexp_replace(html, '<!--.*?-->|<script.*?</script>', '', 'gs'), '<a href="[^"]*">[^<]*</a>') AS x FROM pages)))""")
def page_links(spark, sf):
    return markup.links(t(spark, sf, "pages"), "page_id", "html")


# Links to follow: a licence page, pages of works, a page of another site, a file, the page itself.


@query(
    f"""SELECT page_id, CAST(place - 1 AS INTEGER) AS place, {_ROOT} || path AS url FROM (SELECT page_id, url, unnest(paths) AS path, generate_subscripts(paths, 1) AS place FROM (
    SELECT page_id, url, list_concat(CASE WHEN page_id % 3 = 0 THEN ['/terms'] ELSE [] END, CASE WHEN page_id % 2 = 0 THEN ['/sheet-music-works', '/a/work' || page_id] ELSE ['/b/noten'] END) AS paths FROM pages))"""
)
def pages_to_follow(spark, sf):
    k = F.col("page_id")
    works = F.concat(F.lit('<a href="/a/work'), k.cast("string"), F.lit('#x">list</a><a href="/sheet-music-works"><b>Sheet</b> music</a><a href="/a/work'), k.cast("string"), F.lit('">scores</a>'))
    odd = F.lit('<a href="/b/noten">x</a><a href="https://elsewhere.test/scores">scores</a><a href="/scores.pdf">scores</a>')
    added = F.concat(F.when(k % 2 == 0, works).otherwise(odd), F.when(k % 3 == 0, '<a href="/terms"><i>Copyright</i> notes</a>').otherwise(""), F.lit('<!-- <a href="/works">works</a> --><a href="mailto:a@b">score</a>'), F.concat(F.lit('<a href="'), F.replace("url", F.lit("&"), F.lit("&amp;")), F.lit('">works</a>')))
    only = F.regexp_replace("html", "(?s)<nav>.*?</nav>", "")
    return homepages.pages_to_follow(t(spark, sf, "pages").withColumn("html", F.concat(only, added)), "page_id", "url", "html")


# A table for each customer, a row for each order: short and long rows, and a table within a cell.


@query("SELECT o_custkey, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS place, 'k' || o_orderkey AS name, o_orderstatus || CASE WHEN o_orderkey % 5 = 0 THEN 'no' ELSE '' END AS status, CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE o_orderpriority END AS priority, CASE WHEN o_orderkey % 3 <> 0 THEN 'https://lists.test/o/' || o_orderkey END AS url FROM orders")
def listed_rows(spark, sf):
    o = F.col("o_orderkey").cast("string")
    first = F.concat(F.lit("<tr><td> k<b>"), o, F.lit("</b>"), F.when(F.col("o_orderkey") % 3 != 0, F.concat(F.lit("<a href='/o/"), o, F.lit("'></a><a href=/p>"))).otherwise(""), F.lit("<td>"), F.col("o_orderstatus"))
    nested = F.lit("<table class='wikitable sortable'><tr><th>no</th><tr><td></table>")
    last = F.when(F.col("o_orderkey") % 5 == 0, nested).otherwise(F.concat(F.lit("<td>"), F.col("o_orderpriority"), F.when(F.col("o_orderkey") % 7 == 0, "<td>more</td>").otherwise("")))
    rows = t(spark, sf, "orders").select("o_custkey", "o_orderkey", F.concat(first, last).alias("tr"))
    pages = rows.groupBy("o_custkey").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("o_orderkey", "tr"))), lambda x: x["tr"]), "\n").alias("trs"))
    page = F.concat(F.lit("<table class=other><tr><td>x</table><!-- <table class='wikitable sortable'> --><table class='wikitable sortable'><tr><th>name<th>status<th>priority</tr><tr><th>sub</tr>"), "trs", F.lit("</table>"))
    found = html_tables.table_rows(pages.select("o_custkey", page.alias("html")), "o_custkey", "html", "https://lists.test/")
    return found.select("o_custkey", F.col("row").alias("place"), *(html_tables.cell(c).alias(c) for c in ("name", "status", "priority")), "url")


# Each three pages are a job: a start page and two reached from it, one of them gone.


@query(
    f"""WITH e AS ({_EVIDENCE}), p AS (SELECT page_id, page_id // 3 AS job, page_id % 3 AS place, url, page_id % 3 <> 2 OR page_id % 2 = 0 AS ok FROM pages),
    l AS (SELECT job, string_agg(DISTINCT spdx, '|' ORDER BY spdx) AS licences FROM e JOIN p USING (page_id) WHERE ok GROUP BY 1)
    SELECT job, 'ok' AS fetch_status, count(*) FILTER (ok) AS pages_fetched, coalesce(any_value(licences), '') AS licences, 2 * count(*) FILTER (ok AND page_id % 4 <> 1) AS n_pdf, count(DISTINCT {_ROOT}) FILTER (ok AND page_id % 4 <> 1) AS n_musicxml,
      coalesce(string_agg(url, '|' ORDER BY place) FILTER (ok AND page_id % 4 <> 1), '') AS score_pages, coalesce(string_agg(url, '|' ORDER BY place) FILTER (place > 0), '') AS hop_urls, count(*) FILTER (ok AND page_id % 4 <> 1) > 0 AND any_value(licences) IS NOT NULL AS candidate, job % 2 = 0 AS name_on_page
    FROM p LEFT JOIN l USING (job) GROUP BY job"""
)
def site_scan(spark, sf):
    k = F.col("page_id")
    pages = _with_tags(spark, sf).select(F.expr("page_id div 3").alias("job"), (k % 3).alias("place"), "url", F.concat("html", F.lit("<p>Dvořáková</p>")).alias("html"), F.when((k % 3 != 2) | (k % 2 == 0), 200).otherwise(410).alias("status"), F.lit("").alias("error"))
    jobs = pages.where("place = 0").select("job", F.when(F.col("job") % 2 == 0, "Anna Dvorakova").otherwise("Zz Qqqqq").alias("name"))
    keep = ["job", "fetch_status", "pages_fetched", "licences", "n_pdf", "n_musicxml", "score_pages", "hop_urls", "candidate", "name_on_page"]
    return homepages.scan_sites(jobs, pages).select(*keep)


# Results of a search: a person's orders, each a page of one of the hosts.

_R = f"SELECT o_custkey AS k, CAST(o_orderkey % 7 AS INTEGER) AS rank, o_orderkey AS place, {sql_pick(HOSTS, 'o_orderkey')} AS h, CASE WHEN o_orderkey % 11 = 0 THEN '' ELSE 'https://' || {sql_pick(HOSTS, 'o_orderkey')} || '/' || CASE WHEN o_orderkey % 5 = 0 THEN '' ELSE CAST(o_orderkey % 4 AS VARCHAR) END END AS url, 't' || o_orderkey AS title FROM orders"
_LEFT = f"SELECT *, row_number() OVER (PARTITION BY k, url ORDER BY rank, place) = 1 AS fresh FROM ({_R}) WHERE url <> '' AND h NOT IN ('m.youtube.com', 'shop.amazon.de')"
_JUDGED = f"SELECT *, coalesce(sum(fresh::INT) OVER (PARTITION BY k, h ORDER BY rank, place ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM ({_LEFT})"


def _results(spark, sf):
    o = F.col("o_orderkey")
    page = F.concat(F.lit("https://"), pick(HOSTS, "o_orderkey"), F.lit("/"), F.when(o % 5 == 0, "").otherwise((o % 4).cast("string")), F.when(o % 2 == 0, "#top").otherwise(""))
    return t(spark, sf, "orders").select(F.col("o_custkey").alias("k"), (o % 7).cast("string").alias("rank"), o.alias("place"), F.when(o % 11 == 0, None).otherwise(page).alias("url"), F.concat(F.lit("t"), o.cast("string")).alias("title"))


@query(
    f"""WITH j AS ({_JUDGED}), a AS (SELECT * FROM j WHERE fresh AND before < 3) SELECT k, url, 'search_result' AS source, rank, title FROM a
    UNION ALL SELECT k, 'https://' || h || '/', 'search_site_root', NULL, arg_min(title, (rank, place)) FROM a WHERE (k, h) NOT IN (SELECT k, h FROM a WHERE url = 'https://' || h || '/') GROUP BY k, h"""
)
def search_targets(spark, sf):
    return homepages.search_targets(_results(spark, sf), "k")[0]


@query(
    f"""SELECT reason, count(*) AS n FROM (SELECT CASE WHEN url = '' AND rank = 0 THEN 'rank0_no_results' WHEN url = '' THEN 'empty_url' WHEN h = 'm.youtube.com' THEN 'denied:youtube.com' WHEN h = 'shop.amazon.de' THEN 'denied:amazon' END AS reason FROM ({_R})
    UNION ALL SELECT CASE WHEN before >= 3 THEN 'per_host_cap' WHEN NOT fresh THEN 'dup_url' END FROM ({_JUDGED})) WHERE reason IS NOT NULL GROUP BY 1"""
)
def search_skips(spark, sf):
    return homepages.search_targets(_results(spark, sf), "k")[1]


SITES = ["http://a.org/", "http://b.org/x"]


@query(f"SELECT c_custkey, CAST(i AS INTEGER) AS place, ({sql_list(SITES)})[(c_custkey + i) % 2 + 1] AS url FROM customer, (SELECT unnest([0, 1]) AS i) WHERE c_custkey % 3 <> 0 OR i = 0")
def stated_homepages(spark, sf):
    from ..operators.entities import ENTITY

    k = F.col("c_custkey")
    claim = lambda v, rank: F.concat(F.lit(f'{{"rank":"{rank}","mainsnak":{{"snaktype":"value","datavalue":{{"value":"'), v, F.lit('"}}}'))
    listed = F.concat_ws(",", claim(F.lit("http://old.org"), "deprecated"), claim(pick(SITES, "c_custkey"), "normal"), claim(pick(SITES, "c_custkey"), "preferred"), F.when(k % 3 != 0, claim(pick(SITES, "c_custkey + 1"), "normal")))
    entity = F.from_json(F.concat(F.lit('{"claims":{"P856":['), listed, F.lit("]}}")), ENTITY)
    return homepages.stated_homepages(t(spark, sf, "customer").select(k, entity.alias("e")), "c_custkey")


# Person templates: years, links and names that the key varies.


@query(
    """SELECT p_partkey, CASE p_partkey % 4 WHEN 0 THEN 'none' WHEN 1 THEN 'person' WHEN 2 THEN 'imslpcomposer' ELSE 'performer' END AS template_kind, CASE WHEN p_partkey % 4 <> 0 AND p_partkey % 3 <> 0 THEN CAST(1700 + p_partkey % 200 AS INTEGER) END AS born_year,
    CASE WHEN p_partkey % 4 = 0 OR p_partkey % 7 = 0 THEN '' ELSE replace(p_name, ' ', '_') END AS wikipedia_title, CASE WHEN p_partkey % 4 = 0 THEN '' ELSE array_to_string([p_type, p_brand, p_type || ' ' || p_brand], ';') END AS names FROM part"""
)
def person_pages(spark, sf):
    k, name = F.col("p_partkey"), F.regexp_replace("p_name", " ", "_")
    kind = F.when(k % 4 == 0, "{{#fte:place").when(k % 4 == 1, "{{#fte:Person").when(k % 4 == 2, "{{ #imslpcomposer:").otherwise("{{#FTE: performer")
    born = F.concat(F.when(k % 3 == 0, "c. ").otherwise(" "), (1700 + k % 200).cast("string"))
    link = F.when(k % 7 == 0, F.concat(F.lit("[[w:de:"), name, F.lit("]]"))).when(k % 2 == 0, F.concat(F.lit("[[wikipedia:en:"), name, F.lit("|it]]"))).when(k % 5 == 0, F.concat(F.lit("{{wp|"), name, F.lit("|it}}"))).otherwise(F.concat(F.lit("[https://en.wikipedia.org/wiki/"), name, F.lit(" it]")))
    names = F.concat(F.lit("{{AltNames|"), F.col("p_type"), F.lit("|[["), F.lit("x|"), F.col("p_brand"), F.lit("]]|{{FN|"), F.col("p_type"), F.lit("| "), F.col("p_brand"), F.lit("}}}}"))
    page = F.concat(F.lit("{{a|Born Year=1}}<!-- {{#fte:person|Born Year=2}} -->"), kind, F.lit("\n|Born Year="), born, F.lit("\n|Biography Link="), link, F.lit("|Alternate Names="), names, F.lit("|Note={{x|Born Year=3}}}} |Born Year=4"))
    out = persons.person_pages(t(spark, sf, "part").select("p_partkey", page.alias("page")), "p_partkey", "page")
    return out.select("p_partkey", "template_kind", "born_year", "wikipedia_title", F.array_join("alternate_names", ";").alias("names"))


# Overrides of every kind over all customers and their orders.

_MOVED, _SET, _DIED, _GONE = "c_custkey % 6 = 0", "c_custkey % 4 = 0", "c_custkey % 10 = 1", "c_custkey % 9 = 0"
_TOUCHED = f"({_MOVED} OR {_SET} OR {_DIED})"
_NEW = f"'Q' || (c_custkey + CASE WHEN {_MOVED} THEN 1000000 ELSE 0 END)"


def _overridden(spark, sf):
    k = F.col("c_custkey")
    q = lambda c: F.concat(F.lit("Q"), c)
    customers, none = t(spark, sf, "customer"), F.lit("")
    people = customers.select(q(k).alias("id"), F.lit("old").alias("occupations"), F.lit("1960").alias("death_year"), F.lit("f").alias("qa_flags"), F.concat(F.lit("Category:C"), k, F.lit(",_A")).alias("category"), F.lit("x").alias("eu_pd_status"), F.lit(0).alias("eu_pd_year"), F.lit(-1).cast("long").alias("n_works"), none.alias("present"))
    works = t(spark, sf, "orders").select(q(F.col("o_custkey")).alias("id"), F.col("o_orderstatus").alias("category"))
    cell = lambda when, field, value: F.when(F.expr(when), F.struct(F.lit(field).alias("field"), value.alias("value")))
    given = F.array_compact(F.array(cell(_MOVED, overlay.REKEY, q(k + 1000000)), cell(_SET, "occupations", F.lit("set")), cell(_DIED, "death_year", F.lit("1900")), cell(_GONE, overlay.DROP, none)))
    overrides = customers.select(q(k).alias("key"), F.explode(given).alias("o")).select("key", "o.*", F.lit("2024-01-01").alias("date"))
    documents = _entities(spark, sf).select(q(F.substring("id", 2, 20).cast("long") + 1000000).alias("id"), "e")
    return overlay.apply_in_order(people, works, overrides, documents, "id", ["occupations", "death_year"], {"occupations": "occupations", "qa_flags": "flags"}, 2026, "category", ["F", "O", "P"])


@query(
    f"""WITH w AS (SELECT o_custkey AS c_custkey, count(*) AS n, string_agg(DISTINCT o_orderstatus, '|' ORDER BY o_orderstatus) AS s FROM orders GROUP BY 1)
    SELECT {_NEW} AS id, CASE WHEN {_SET} THEN 'set' WHEN {_MOVED} THEN {sql_pick(WORKS, 'c_custkey')} ELSE 'old' END AS occupations, CASE WHEN {_DIED} THEN '1900' ELSE '1960' END AS death_year, CASE WHEN NOT {_TOUCHED} THEN 'f' WHEN {_MOVED} THEN 'manual_override' ELSE 'manual_override|f' END AS qa_flags, 'Category:C' || c_custkey || ',_A' AS category,
    CASE WHEN NOT {_TOUCHED} THEN 'x' WHEN {_DIED} THEN 'pd' ELSE 'not_pd' END AS eu_pd_status, CAST(CASE WHEN NOT {_TOUCHED} THEN 0 WHEN {_DIED} THEN 1971 ELSE 2031 END AS INTEGER) AS eu_pd_year, CASE WHEN {_TOUCHED} THEN coalesce(n, 0) ELSE -1 END AS n_works, CASE WHEN {_TOUCHED} THEN coalesce(s, '') ELSE '' END AS present FROM customer LEFT JOIN w USING (c_custkey) WHERE NOT {_GONE}"""
)
def overrides_in_order(spark, sf):
    return _overridden(spark, sf)[0]


@query(f"SELECT {_NEW} AS id, count(*) AS n FROM (SELECT o_custkey AS c_custkey FROM orders) WHERE NOT {_GONE} GROUP BY 1")
def works_after_overrides(spark, sf):
    return _overridden(spark, sf)[1].groupBy("id").agg(F.count(F.lit(1)).alias("n"))
