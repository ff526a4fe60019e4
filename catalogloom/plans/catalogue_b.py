"""Queries over the driver's tables: ledgers, facets, licences, statistics, gates, markup."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.canonical import input_hash
from ..functions import cells
from ..operators import facets, ledger, markup, resolve, rollups, snapshots, statistics
from .registry import query, t

STATUSES = ["F", "O", "P"]


def _votes(spark: SparkSession, sf: str) -> DataFrame:
    """Events as decisions: the event type labels a user by three tags of the value."""
    e = t(spark, sf, "events")
    v = F.floor("value").cast("int")
    tags = F.array_distinct(F.transform(F.array(v % 3, v % 4, v % 5), lambda x: F.concat(F.lit("t"), x.cast("string"))))
    return e.select("user_id", "event_type", "ts", "event_id", tags.alias("tags"))


_TAGS = "list_distinct(['t' || (v % 3), 't' || (v % 4), 't' || (v % 5)])"
_LATEST = f"SELECT user_id, event_type, {_TAGS} AS tags FROM (SELECT user_id, event_type, CAST(floor(value) AS INTEGER) AS v, row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1"


def _latest(spark, sf):
    return ledger.latest(_votes(spark, sf), ["user_id", "event_type"], "ts", "event_id")


@query(f"SELECT user_id, event_type, array_to_string(list_sort(tags), '|') AS tags FROM ({_LATEST})")
def ledger_latest(spark, sf):
    return _latest(spark, sf).select("user_id", "event_type", F.array_join(F.array_sort("tags"), "|").alias("tags"))


@query(
    f"""WITH l AS ({_LATEST}), b AS (SELECT user_id, max(tags) FILTER (event_type = 'click') AS a, max(tags) FILTER (event_type = 'view') AS b FROM l GROUP BY 1)
    SELECT user_id, CAST(len(list_intersect(a, b)) AS BIGINT) AS n_shared, array_to_string(list_sort(list_intersect(a, b)), '|') AS tags FROM b WHERE a IS NOT NULL AND b IS NOT NULL"""
)
def ledger_consensus(spark, sf):
    both = ledger.consensus(_latest(spark, sf), "user_id", "event_type", "tags", ("click", "view"))
    shared = cells.split_cell("tags")
    return both.select("user_id", F.size(shared).cast("long").alias("n_shared"), F.array_join(F.array_sort(shared), "|").alias("tags"))


@query(
    f"""WITH l AS ({_LATEST}), x AS (SELECT user_id, tag, count(*) AS n FROM (SELECT user_id, event_type, unnest(tags) AS tag FROM l) GROUP BY 1, 2), k AS (SELECT user_id, string_agg(tag, '|' ORDER BY tag) AS tags FROM x WHERE n >= 3 GROUP BY 1)
    SELECT u.user_id, coalesce(k.tags, '') AS tags FROM (SELECT DISTINCT user_id FROM events) u LEFT JOIN k USING (user_id)"""
)
def vote_k_of_n(spark, sf):
    return ledger.by_rule(_latest(spark, sf), "user_id", "event_type", "tags", 3)


@query(f"SELECT user_id, string_agg(event_type || '=' || array_to_string(list_sort(tags), '|'), ';' ORDER BY event_type) AS votes FROM ({_LATEST}) GROUP BY 1")
def ledger_votes(spark, sf):
    return ledger.votes(_latest(spark, sf).withColumn("tags", F.array_sort("tags")), "user_id", "event_type", "tags")


# What each labeller was shown: for every third user the clicks' labeller had a lead text too.


@query("""SELECT user_id FROM (SELECT user_id, event_type, sha256('{"prompt_version":"p1","record":{"composer_id":"Q' || user_id || '","wikipedia_lead":' || CASE WHEN user_id % 3 = 0 AND event_type = 'click' THEN '"A \\"lead\\""' ELSE 'null' END || '}}') AS h FROM events) GROUP BY user_id HAVING count(DISTINCT event_type) = 5 AND count(DISTINCT h) = 1""")
def answered_by_all(spark, sf):
    u = F.col("user_id")
    lead = F.when((u % 3 == 0) & (F.col("event_type") == "click"), 'A "lead"')
    rows = t(spark, sf, "events").withColumn("record", F.struct(lead.alias("wikipedia_lead"), F.concat(F.lit("Q"), u).alias("composer_id")))
    return ledger.answered_by_all(rows.withColumn("input", input_hash(F.col("record"), rows.schema["record"].dataType, "p1")), "user_id", "event_type", "input", 5)


@query("SELECT DISTINCT c_custkey AS user_id FROM customer WHERE c_custkey NOT IN (SELECT user_id FROM events)")
def pending_keys(spark, sf):
    return ledger.pending(t(spark, sf, "customer").select(F.col("c_custkey").alias("user_id")), t(spark, sf, "events"), ["user_id"])


@query("SELECT token, count(*) AS n FROM (SELECT unnest(string_split(p_name, ' ')) AS token FROM part) WHERE token <> '' GROUP BY 1 ORDER BY n DESC, token LIMIT 10")
def token_counts_topk(spark, sf):
    return rollups.top(rollups.token_counts(t(spark, sf, "part"), F.filter(F.split("p_name", " "), lambda x: x != "")), 10)


@query("SELECT o_orderpriority, count(*) FILTER (o_orderstatus = 'F') AS n_f, count(*) FILTER (o_orderstatus = 'O') AS n_o, count(*) FILTER (o_orderstatus = 'P') AS n_p, count(*) AS total FROM orders GROUP BY 1")
def crosstab_zero_fill(spark, sf):
    return rollups.matrix(t(spark, sf, "orders"), "o_orderpriority", "o_orderstatus", STATUSES)


@query(
    """WITH c AS (SELECT user_id, event_type, count(*) AS n FROM events GROUP BY 1, 2), m AS (SELECT user_id, max(n) AS m FROM c GROUP BY 1)
    SELECT c.user_id, string_agg(event_type, '|' ORDER BY event_type) AS dominant, max(n) AS n, count(*) AS n_tied FROM c JOIN m ON c.user_id = m.user_id AND n = m GROUP BY 1"""
)
def dominant_with_ties(spark, sf):
    return rollups.dominant(t(spark, sf, "events"), "user_id", "event_type")


@query("SELECT l_shipmode_key AS key, array_to_string(list_sort(list(v)[1:15]), '|') AS examples FROM (SELECT DISTINCT l_returnflag || l_linestatus AS l_shipmode_key, CAST(l_partkey AS VARCHAR) AS v FROM lineitem ORDER BY 1, 2) GROUP BY 1")
def capped_examples(spark, sf):
    rows = t(spark, sf, "lineitem").select(F.concat("l_returnflag", "l_linestatus").alias("key"), F.col("l_partkey").cast("string").alias("v"))
    return rollups.capped_examples(rows, "key", "v", 15)


@query("SELECT 'source' AS \"column\", count(*) AS filled, 100.0 AS percent FROM documents UNION ALL SELECT 'text', count(*) FILTER (text <> ''), round(100.0 * count(*) FILTER (text <> '') / count(*), 1) FROM documents")
def coverage(spark, sf):
    return rollups.coverage(t(spark, sf, "documents"), ["source", "text"])


FACETS = facets.FacetQuery(contains="00", parent_in={"c_mktsegment": ("BUILDING", "MACHINERY")}, child_in={"o_orderstatus": ("F",), "o_orderpriority": ("1-URGENT", "2-HIGH")}, sort="c_acctbal", descending=True)


@query(
    """SELECT c_custkey, c_name, c_mktsegment, c_acctbal, count(*) AS n_matches FROM customer JOIN orders ON c_custkey = o_custkey WHERE c_name LIKE '%00%' AND c_mktsegment IN ('BUILDING', 'MACHINERY')
    AND o_orderstatus = 'F' AND o_orderpriority IN ('1-URGENT', '2-HIGH') GROUP BY ALL"""
)
def facet_query(spark, sf):
    found = facets.run(FACETS, t(spark, sf, "customer"), t(spark, sf, "orders"), "c_custkey", "o_custkey", "c_name")
    return found.select("c_custkey", "c_name", "c_mktsegment", "c_acctbal", "n_matches")


@query("SELECT 'segment' AS facet, c_mktsegment AS value, count(*) AS n FROM customer GROUP BY 2 UNION ALL SELECT 'nation', CAST(c_nationkey AS VARCHAR), count(*) FROM customer GROUP BY 2")
def facet_counts(spark, sf):
    return facets.facet_counts(t(spark, sf, "customer"), {"segment": F.array("c_mktsegment"), "nation": F.array("c_nationkey")})


@query("SELECT c_custkey, c_acctbal FROM (SELECT *, row_number() OVER (ORDER BY c_acctbal, c_custkey) AS rn, count(*) OVER () AS n FROM customer) WHERE rn <= (n + 1) // 2")
def half_pool(spark, sf):
    return facets.less_viewed_half(t(spark, sf, "customer"), "c_acctbal", "c_custkey").select("c_custkey", "c_acctbal")


@query("SELECT c_custkey FROM customer WHERE c_custkey % 10 <> 0 ORDER BY md5('pick:' || c_custkey), c_custkey LIMIT 20")
def random_picks(spark, sf):
    c = t(spark, sf, "customer").select("c_custkey")
    return facets.random_picks(c, "c_custkey", "pick", 20, c.where("c_custkey % 10 = 0"))


@query(
    """SELECT c_custkey, CAST(count(o_orderkey) AS BIGINT) AS n, CASE WHEN count(o_orderkey) = 0 THEN '[]' ELSE '[' || string_agg('{"o_orderkey":' || o_orderkey || ',"o_orderpriority":"' || o_orderpriority || '"}', ',' ORDER BY o_orderkey) || ']' END AS children
    FROM customer LEFT JOIN orders ON c_custkey = o_custkey GROUP BY 1"""
)
def nested_export(spark, sf):
    return facets.export(t(spark, sf, "customer"), t(spark, sf, "orders"), "c_custkey", "o_custkey", ["o_orderkey", "o_orderpriority"], "o_orderkey")


@query(
    """SELECT source, count(*) AS n_docs, count(*) FILTER (s LIKE '%cc by%') AS n_cc, bool_or(s LIKE '%mit license%') AS has_mit, string_agg(DISTINCT CASE WHEN s LIKE '%mit license%' THEN 'MIT' WHEN s LIKE '%cc by%' THEN 'CC' WHEN s LIKE '%apache license%' THEN 'Apache' END, '|' ORDER BY CASE WHEN s LIKE '%mit license%' THEN 'MIT' WHEN s LIKE '%cc by%' THEN 'CC' WHEN s LIKE '%apache license%' THEN 'Apache' END) AS found
    FROM (SELECT source, lower(text) AS s FROM documents) GROUP BY 1"""
)
def licence_summary(spark, sf):
    s = F.lower("text")
    found = F.when(s.contains("mit license"), "MIT").when(s.contains("cc by"), "CC").when(s.contains("apache license"), "Apache")
    docs = t(spark, sf, "documents").select("source", found.alias("found"), s.contains("mit license").alias("mit"), s.contains("cc by").alias("cc"))
    out = docs.groupBy("source").agg(F.count(F.lit(1)).alias("n_docs"), F.count_if("cc").alias("n_cc"), F.bool_or("mit").alias("has_mit"), F.array_join(F.array_sort(F.collect_set("found")), "|").alias("found"))
    return out.withColumn("found", F.when(F.col("found") != "", F.col("found")))


@query(
    """SELECT page_id, CAST(len(regexp_extract_all(html, '<a href="[^"]*">[^<]*</a>')) AS BIGINT) AS n_links, array_to_string(string_split(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1), '.')[-2:], '.') AS site FROM pages"""
)
def html_links(spark, sf):
    pages = t(spark, sf, "pages")
    counts = markup.links(pages, "page_id", "html").groupBy("page_id").agg(F.count(F.lit(1)).alias("n_links"))
    return pages.select("page_id", "url").join(counts, "page_id", "left").select("page_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), markup.site(F.col("url")).alias("site"))


@query("SELECT link, count(*) AS n FROM (SELECT unnest(regexp_extract_all(html, '<a href=\"([^\"]*)\">[^<]*</a>', 1)) AS link FROM pages) GROUP BY 1")
def link_targets(spark, sf):
    return markup.links(t(spark, sf, "pages"), "page_id", "html").groupBy(F.col("href").alias("link")).agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT k, url FROM (SELECT *, row_number() OVER (PARTITION BY k, url ORDER BY page_id) AS u FROM (SELECT *, row_number() OVER (PARTITION BY k, host ORDER BY page_id, url) AS h FROM (
    SELECT page_id % 3 AS k, page_id, url, regexp_replace(lower(regexp_extract(url, '^[a-z]+://([^/:?#]+)', 1)), '^www\\.', '') AS host FROM pages)) WHERE h <= 3) WHERE u = 1"""
)
def per_host_cap(spark, sf):
    pages = t(spark, sf, "pages").select((F.col("page_id") % 3).alias("k"), "page_id", "url")
    return markup.per_host_cap(pages, "k", "url", "page_id").select("k", "url")


def _strata(spark, sf):
    return t(spark, sf, "documents").select(F.concat_ws("-", "lang", F.when(F.col("n_chars") > 2000, "long").otherwise("short")).alias("stratum"), F.col("doc_id").cast("string").alias("id"), "doc_id")


@query("SELECT stratum, count(*) AS size FROM (SELECT lang || '-' || CASE WHEN n_chars > 2000 THEN 'long' ELSE 'short' END AS stratum FROM documents) GROUP BY 1")
def stratum_sizes(spark, sf):
    return _strata(spark, sf).groupBy("stratum").agg(F.count(F.lit(1)).alias("size"))


@query(
    """WITH s AS (SELECT lang || '-' || CASE WHEN n_chars > 2000 THEN 'long' ELSE 'short' END AS stratum, doc_id FROM documents), r AS (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY md5('gold:' || doc_id), CAST(doc_id AS VARCHAR)) AS rn, count(*) OVER (PARTITION BY stratum) AS size FROM s)
    SELECT doc_id, stratum, size AS stratum_size FROM r WHERE rn <= 5"""
)
def stratified_equal_sample(spark, sf):
    from pyspark.sql import Window

    docs = _strata(spark, sf)
    rank = F.row_number().over(Window.partitionBy("stratum").orderBy(statistics.hash_order("gold", "id"), "id"))
    sizes = docs.groupBy("stratum").agg(F.count(F.lit(1)).alias("stratum_size"))
    return docs.withColumn("rn", rank).where("rn <= 5").join(sizes, "stratum").select("doc_id", "stratum", "stratum_size")


@query("SELECT c_custkey, CAST((row_number() OVER (ORDER BY c_mktsegment, md5('deal:' || c_custkey), c_custkey) - 1) % 7 + 1 AS BIGINT) AS package FROM customer")
def deal_packages(spark, sf):
    return statistics.deal(t(spark, sf, "customer"), "c_mktsegment", "c_custkey", 7, "deal").select("c_custkey", F.col("package").cast("long").alias("package"))


@query("WITH o AS (SELECT c_custkey, row_number() OVER (ORDER BY c_acctbal, c_custkey) - 1 AS i, count(*) OVER () AS n FROM customer) SELECT c_custkey FROM o, range(50) AS r(k) WHERE i = CAST(floor(0.5 * n / 50.0 + k * (n / 50.0)) AS BIGINT)")
def systematic_sample(spark, sf):
    return statistics.systematic(t(spark, sf, "customer"), "c_acctbal", "c_custkey", 50).select("c_custkey")


@query(
    """SELECT quality, n, round(lo, 6) AS lo, round(hi, 6) AS hi FROM (SELECT quality, n, greatest(0, (p + 3.8416 / (2 * n) - 1.96 * sqrt(p * (1 - p) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n)) AS lo, least(1, (p + 3.8416 / (2 * n) + 1.96 * sqrt(p * (1 - p) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n)) AS hi
    FROM (SELECT CAST(quality AS BIGINT) AS quality, count(*) AS n, avg(toxic) AS p FROM labels GROUP BY 1))"""
)
def wilson_interval(spark, sf):
    rows = t(spark, sf, "labels").groupBy(F.col("quality").cast("long").alias("quality")).agg(F.count(F.lit(1)).alias("n"), F.avg("toxic").alias("p"))
    ci = statistics.wilson(F.col("p"), F.col("n"))
    return rows.select("quality", "n", F.round(ci["lo"], 6).alias("lo"), F.round(ci["hi"], 6).alias("hi"))


@query(
    """WITH d AS (SELECT lang AS h, 1.0 AS e, CAST(toxic AS DOUBLE) AS x, CAST(c.n AS DOUBLE) AS big FROM documents JOIN labels USING (doc_id) JOIN (SELECT lang, count(*) AS n FROM documents GROUP BY 1) c USING (lang)),
    w AS (SELECT *, big / count(*) OVER (PARTITION BY h) AS wt FROM d), r AS (SELECT sum(x * wt) / sum(e * wt) AS r, sum(e * wt) AS ew, sum(e) AS el, sum(x) AS er FROM w),
    v AS (SELECT sum(part) AS v FROM (SELECT max(big) * max(big) * (1 - count(*) / max(big)) * var_samp(x - r * e) / count(*) AS part FROM d, r GROUP BY h)),
    f AS (SELECT el, er, r, r * (1 - r) / (v / (ew * ew)) AS n FROM r, v)
    SELECT CAST(el AS BIGINT) AS eligible, CAST(er AS BIGINT) AS errors, round(er / el, 6) AS rate, round(r, 6) AS weighted_rate, round(greatest(0, (r + 3.8416 / (2 * n) - 1.96 * sqrt(r * (1 - r) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n)), 6) AS lo, round(least(1, (r + 3.8416 / (2 * n) + 1.96 * sqrt(r * (1 - r) / n + 3.8416 / (4 * n * n))) / (1 + 3.8416 / n)), 6) AS hi FROM f"""
)
def stratified_rate(spark, sf):
    docs = t(spark, sf, "documents")
    sizes = docs.groupBy("lang").agg(F.count(F.lit(1)).alias("stratum_size"))
    rows = docs.select("doc_id", "lang").join(t(spark, sf, "labels"), "doc_id").join(F.broadcast(sizes), "lang").select(F.col("lang").alias("stratum"), "stratum_size", F.lit(1).alias("eligible"), F.col("toxic").alias("error"))
    out = statistics.stratified_rate(rows)
    return out.select("eligible", "errors", *(F.round(c, 6).alias(c) for c in ("rate", "weighted_rate", "lo", "hi")))


@query(
    """SELECT count(*) AS n, round(avg(CASE WHEN quality = toxic THEN 1.0 ELSE 0 END), 6) AS agreement, round((avg(CASE WHEN quality = toxic THEN 1.0 ELSE 0 END) - (avg(quality) * avg(toxic) + (1 - avg(quality)) * (1 - avg(toxic)))) / (1 - (avg(quality) * avg(toxic) + (1 - avg(quality)) * (1 - avg(toxic)))), 6) AS kappa FROM labels"""
)
def kappa(spark, sf):
    return statistics.kappa(t(spark, sf, "labels"), "quality", "toxic").select("n", F.round("agreement", 6).alias("agreement"), F.round("kappa", 6).alias("kappa"))


@query(
    f"""WITH l AS ({_LATEST}), p AS (SELECT a.user_id, a.tags AS x, b.tags AS y FROM l a JOIN l b ON a.user_id = b.user_id WHERE a.event_type = 'click' AND b.event_type = 'view'), s AS (SELECT user_id, len(list_intersect(x, y)) AS i, len(x) AS nx, len(y) AS ny FROM p)
    SELECT user_id, round(i / (nx + ny - i), 6) AS jaccard, round(CASE WHEN i = nx AND i = ny THEN 0 WHEN i = 0 THEN 1 ELSE 1 - i / (nx + ny - i) * CASE WHEN i = nx OR i = ny THEN 2 / 3 ELSE 1 / 3 END END, 6) AS masi FROM s"""
)
def jaccard_masi(spark, sf):
    l = _latest(spark, sf)
    a, b = (l.where(F.col("event_type") == k).select("user_id", F.col("tags").alias(n)) for k, n in (("click", "x"), ("view", "y")))
    x, y = F.col("x"), F.col("y")
    return a.join(b, "user_id").select("user_id", F.round(statistics.jaccard(x, y), 6).alias("jaccard"), F.round(statistics.masi_distance(x, y), 6).alias("masi"))


@query(
    """WITH e AS (SELECT user_id AS u, CAST(floor(value) AS INTEGER) % 3 AS v FROM events), c AS (SELECT u, v, count(*) AS n, sum(count(*)) OVER (PARTITION BY u) AS m FROM e GROUP BY 1, 2), k AS (SELECT * FROM c WHERE m > 1),
    o AS (SELECT sum(a.n * b.n / (a.m - 1.0)) AS o FROM k a JOIN k b ON a.u = b.u WHERE a.v <> b.v), t AS (SELECT v, sum(n) AS n FROM k GROUP BY 1), x AS (SELECT sum(a.n * b.n) AS x FROM t a, t b WHERE a.v <> b.v), s AS (SELECT sum(n) AS n FROM t)
    SELECT CAST(n AS BIGINT) AS n, round(1 - (o / n) / (x / (n * (n - 1.0))), 6) AS alpha FROM o, x, s"""
)
def krippendorff_alpha(spark, sf):
    rows = t(spark, sf, "events").select("user_id", (F.floor("value").cast("int") % 3).alias("v"))
    return statistics.krippendorff_alpha(rows, "user_id", "v").select("n", F.round("alpha", 6).alias("alpha"))


@query(
    f"""WITH l AS ({_LATEST}), p AS (SELECT a.tags AS x, b.tags AS y FROM l a JOIN l b ON a.user_id = b.user_id WHERE a.event_type = 'click' AND b.event_type = 'error'), s AS (SELECT sum(len(list_intersect(x, y))) AS tp, sum(len(x) - len(list_intersect(x, y))) AS fp, sum(len(y) - len(list_intersect(x, y))) AS fn FROM p)
    SELECT CAST(tp AS BIGINT) AS tp, CAST(fp AS BIGINT) AS fp, CAST(fn AS BIGINT) AS fn, round(tp / (tp + fp), 6) AS precision, round(tp / (tp + fn), 6) AS recall, round(2 * (tp / (tp + fp)) * (tp / (tp + fn)) / (tp / (tp + fp) + tp / (tp + fn)), 6) AS f1 FROM s"""
)
def micro_prf(spark, sf):
    l = _latest(spark, sf)
    a, b = (l.where(F.col("event_type") == k).select("user_id", F.col("tags").alias(n)) for k, n in (("click", "x"), ("error", "y")))
    out = statistics.micro_prf(a.join(b, "user_id"), "x", "y")
    return out.select("tp", "fp", "fn", *(F.round(c, 6).alias(c) for c in ("precision", "recall", "f1")))


@query(
    """SELECT 'price is positive' AS rule, count(*) FILTER (NOT l_extendedprice > 0) AS n FROM lineitem UNION ALL SELECT 'discount is a share', count(*) FILTER (l_discount < 0 OR l_discount > 0.05) FROM lineitem UNION ALL SELECT 'known flag', count(*) FILTER (l_returnflag NOT IN ('A', 'N')) FROM lineitem"""
)
def quality_gates(spark, sf):
    rules = [("price is positive", ~(F.col("l_extendedprice") > 0)), ("discount is a share", (F.col("l_discount") < 0) | (F.col("l_discount") > 0.05)), ("known flag", ~F.col("l_returnflag").isin("A", "N"))]
    return snapshots.violations(t(spark, sf, "lineitem"), rules)


@query("SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS n FROM lineitem GROUP BY 1, 2 HAVING count(*) > 1")
def duplicate_keys(spark, sf):
    return snapshots.duplicate_keys(t(spark, sf, "lineitem").withColumn("l_linenumber", F.col("l_linenumber").cast("long")), ["l_orderkey", "l_linenumber"])


@query("SELECT l_partkey, count(DISTINCT l_suppkey) AS n_owners, min(l_suppkey) AS first_owner FROM lineitem GROUP BY 1 HAVING count(DISTINCT l_suppkey) > 1")
def shared_owners(spark, sf):
    return snapshots.shared_owners(t(spark, sf, "lineitem"), "l_partkey", "l_suppkey")


@query("SELECT o_orderkey, o_custkey FROM orders WHERE o_custkey NOT IN (SELECT c_custkey FROM customer WHERE c_custkey % 4 <> 0)")
def orphan_children(spark, sf):
    parents = t(spark, sf, "customer").where("c_custkey % 4 <> 0")
    return snapshots.orphans(t(spark, sf, "orders"), parents, "o_custkey", "c_custkey").select("o_orderkey", "o_custkey")


@query(
    """SELECT measure, round(old, 4) AS old, round(new, 4) AS new, (new - old) / old BETWEEN -0.05 AND 0.03 AS ok FROM (SELECT 'rows' AS measure, CAST(count(*) AS DOUBLE) AS old, CAST(count(*) FILTER (o_orderkey % 17 <> 0) AS DOUBLE) AS new FROM orders
    UNION ALL SELECT 'finished', CAST(count(*) FILTER (o_orderstatus = 'F') AS DOUBLE), CAST(count(*) FILTER (o_orderstatus = 'F' AND o_orderkey % 40 <> 0 AND o_orderkey % 17 <> 0) AS DOUBLE) FROM orders)"""
)
def regression_gates(spark, sf):
    orders = t(spark, sf, "orders")
    new = orders.where("o_orderkey % 17 <> 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 40 == 0, "X").otherwise(F.col("o_orderstatus")))
    out = snapshots.regression(orders, new, {"rows": F.count(F.lit(1)), "finished": F.count_if(F.col("o_orderstatus") == "F")})
    return out.select("measure", F.round("old", 4).alias("old"), F.round("new", 4).alias("new"), "ok")


@query("SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN 'A' || c_custkey WHEN c_custkey % 3 = 1 THEN 'F' || c_custkey ELSE '' END AS authority_id, CASE WHEN c_custkey % 5 = 4 THEN 'gnd_death_conflict' WHEN c_custkey % 3 = 1 THEN 'gnd_from_lobid' ELSE '' END AS flag FROM customer")
def authority_ids(spark, sf):
    k = F.col("c_custkey")
    rows = t(spark, sf, "customer").select("c_custkey", F.when(k % 3 == 0, F.concat(F.lit("A"), k)).otherwise("").alias("own"), F.when(k % 3 == 1, F.concat(F.lit("F"), k)).otherwise("").alias("found"), F.lit(1900).alias("death"), (1900 + F.when(k % 5 == 4, 5).otherwise(1)).alias("known_death"))
    return resolve.authority(rows).select("c_custkey", "authority_id", "flag")


@query(
    """SELECT o_custkey, array_to_string(list(CAST(o_orderkey AS VARCHAR) ORDER BY o_orderkey)[1:5], '|') AS head FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS rn FROM orders WHERE o_orderstatus = 'P' AND o_orderpriority = '5-LOW') WHERE rn <= 5 GROUP BY 1"""
)
def residual_queue(spark, sf):
    from pyspark.sql import Window

    weak = t(spark, sf, "orders").where("o_orderstatus = 'P' and o_orderpriority = '5-LOW'")
    rank = F.row_number().over(Window.partitionBy("o_custkey").orderBy("o_orderkey"))
    head = weak.withColumn("rn", rank).where("rn <= 5").groupBy("o_custkey").agg(F.array_sort(F.collect_list(F.struct("rn", F.col("o_orderkey").cast("string").alias("k")))).alias("s"))
    return head.select("o_custkey", F.array_join(F.transform("s", lambda s: s["k"]), "|").alias("head"))


@query("SELECT user_id, count(*) AS n, round(sum(value), 2) AS total FROM events GROUP BY 1")
def view_sums(spark, sf):
    cents = F.round(F.col("value") * 100).cast("long")
    sums = t(spark, sf, "events").groupBy("user_id").agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(cents), F.lit(0)).alias("cents"))
    return sums.select("user_id", "n", F.round(F.col("cents") / 100, 2).alias("total"))


@query(f"SELECT p_brand, {', '.join(f'count(*) FILTER (p_type = {chr(39)}{v}{chr(39)}) AS n_{v.lower()}' for v in ('ECONOMY', 'PROMO'))}, count(*) AS total FROM part GROUP BY 1")
def label_matrix(spark, sf):
    return rollups.matrix(t(spark, sf, "part"), "p_brand", "p_type", ["ECONOMY", "PROMO"])


@query(
    """WITH f AS (SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey FROM lineitem GROUP BY 1, 2), r AS (SELECT l_orderkey, count(*) AS n FROM f GROUP BY 1)
    SELECT o_orderkey, coalesce(n, 0) AS n_lines, CASE WHEN year(o_orderdate) + 71 <= 2066 THEN 'pd' ELSE 'not_pd' END AS term_status FROM orders LEFT JOIN r ON o_orderkey = l_orderkey"""
)
def stage_pipeline(spark, sf):
    from ..operators import status
    from ..sources.revisions import run_stages

    def dedupe(tabs):
        lines = tabs["lineitem"].groupBy("l_orderkey", "l_linenumber").agg(F.min("l_partkey").alias("l_partkey"))
        return {"lineitem": lines}

    def terms(tabs):
        return {"orders": status.with_term(tabs["orders"].withColumn("death", F.year("o_orderdate").cast("string")), "death", 2066)}

    def roll(tabs):
        n = tabs["lineitem"].groupBy(F.col("l_orderkey").alias("o_orderkey")).agg(F.count(F.lit(1)).alias("n_lines"))
        return {"orders": tabs["orders"].join(n, "o_orderkey", "left").withColumn("n_lines", F.coalesce("n_lines", F.lit(0)).cast("long"))}

    # Each stage again on its own result changes nothing.
    done = run_stages({x: t(spark, sf, x) for x in ("orders", "lineitem")}, [("dedupe", dedupe), ("dedupe again", dedupe), ("terms", terms), ("roll", roll)])
    return done["orders"].select("o_orderkey", "n_lines", "term_status")


@query(
    """WITH RECURSIVE s AS (SELECT lang || '-' || CASE WHEN n_chars > 2000 THEN 'long' ELSE 'short' END AS stratum, CAST(doc_id AS VARCHAR) AS id, doc_id FROM documents), z AS (SELECT stratum AS h, count(*) AS n FROM s GROUP BY 1), i AS (SELECT h, n, least(120, sum(n) OVER ()) * sqrt(n) / sum(sqrt(n)) OVER () AS ideal, least(120, sum(n) OVER ()) AS aim FROM z),
    g0 AS (SELECT h, n, ideal, aim, least(n, greatest(10, CAST(round_even(ideal, 0) AS BIGINT))) AS g FROM i), st(gs, step) AS (SELECT list({h: h, n: n, ideal: ideal, g: g} ORDER BY h), 0 FROM g0 UNION ALL SELECT list_transform(gs, lambda x: {h: x.h, n: x.n, ideal: x.ideal, g: x.g + CASE WHEN x.h = pick.h THEN sgn ELSE 0 END}), step + 1 FROM (
    SELECT gs, step, sgn, list_sort(list_transform(list_filter(gs, lambda x: CASE WHEN sgn > 0 THEN x.g < x.n ELSE x.g > least(10, x.n) END), lambda x: {d: (x.ideal - x.g) * sgn, h: x.h}))[-1] AS pick FROM (SELECT gs, step, sign((SELECT max(aim) FROM g0) - list_sum(list_transform(gs, lambda x: x.g))) AS sgn FROM st)) WHERE sgn <> 0 AND step < 200),
    f AS (SELECT unnest(gs) AS x FROM st WHERE step = (SELECT max(step) FROM st)), a AS (SELECT x.h AS h, x.n AS n, CAST(x.g AS BIGINT) AS g FROM f)
    SELECT doc_id, stratum, n AS stratum_size, g AS stratum_sample, n / g AS weight FROM (SELECT *, row_number() OVER (PARTITION BY stratum ORDER BY md5('gold:' || id), id) AS rn FROM s) JOIN a ON h = stratum WHERE rn <= g"""
)
def stratified_allocation_sample(spark, sf):
    return statistics.stratified_sample(_strata(spark, sf), "stratum", "id", 120, 10, "gold").select("doc_id", "stratum", "stratum_size", "stratum_sample", "weight")
