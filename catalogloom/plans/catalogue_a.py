"""Queries over the driver's tables: terms, rollups, rules, overlays, snapshots, resolution."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import overlay, resolve, rollups, snapshots, status
from .registry import inline, query, t

PRIORITIES = ["1-URGENT", "2-HIGH", "3-MEDIUM", "4-NOT SPECIFIED", "5-LOW"]
YEAR = 2066


def picked(values: list, key: str):
    return F.element_at(F.array(*map(F.lit, values)), (F.col(key) % len(values) + 1).cast("int"))


@query(
    """SELECT o_orderkey, CASE WHEN y IS NULL THEN 'unknown_death' WHEN y + 71 <= 2066 THEN 'pd' ELSE 'not_pd' END AS term_status, CAST(y + 71 AS BIGINT) AS term_year,
    CAST(greatest(y + 71 - 2066, 0) AS BIGINT) * (CASE WHEN y IS NULL THEN NULL ELSE 1 END) AS term_remaining
    FROM (SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN NULL ELSE year(o_orderdate) END AS y FROM orders)"""
)
def term_status(spark: SparkSession, sf: str) -> DataFrame:
    orders = t(spark, sf, "orders").withColumn("death", F.when(F.col("o_orderstatus") != "P", F.year("o_orderdate").cast("string")))
    out = status.with_term(orders, "death", YEAR)
    return out.select("o_orderkey", "term_status", F.col("term_year").cast("long").alias("term_year"), F.col("term_remaining").cast("long").alias("term_remaining"))


@query(
    """SELECT bucket, count(*) AS n FROM (SELECT CASE WHEN y <= 2068 THEN 'now' WHEN y = 2069 THEN 'next' WHEN y <= 2073 THEN 'soon' WHEN y IS NULL THEN 'unknown' ELSE 'later' END AS bucket
    FROM (SELECT CASE WHEN o_orderstatus = 'P' THEN NULL ELSE year(o_orderdate) + 71 END AS y FROM orders)) GROUP BY bucket"""
)
def live_bucket(spark, sf):
    ends = F.when(F.col("o_orderstatus") != "P", F.year("o_orderdate") + 71)
    return t(spark, sf, "orders").groupBy(status.live_bucket(ends, 2068).alias("bucket")).agg(F.count(F.lit(1)).alias("n"))


@query(
    """WITH c AS (SELECT o_custkey, o_orderpriority p, count(*) n FROM orders GROUP BY 1, 2),
    r AS (SELECT o_custkey, string_agg(p, '|' ORDER BY p) present, '{' || string_agg('"' || p || '": ' || n, ', ' ORDER BY p) || '}' counts, sum(n) total FROM c GROUP BY 1)
    SELECT c_custkey, coalesce(present, '') AS present, coalesce(counts, '') AS counts, CAST(coalesce(total, 0) AS BIGINT) AS total FROM customer LEFT JOIN r ON c_custkey = o_custkey"""
)
def rollup_present_counts(spark, sf):
    return rollups.present_counts(t(spark, sf, "customer"), t(spark, sf, "orders"), "c_custkey", "o_custkey", "o_orderpriority", PRIORITIES)


@query(
    """SELECT md5(text) AS key, arg_min(doc_id, doc_id) AS doc_id, arg_min(lang, doc_id) AS lang, min(n_chars) AS n_chars, string_agg(DISTINCT source, '|' ORDER BY source) AS aliases, count(*) AS n_merged FROM documents GROUP BY 1"""
)
def merge_duplicates(spark, sf):
    docs = t(spark, sf, "documents").withColumn("key", F.md5(F.col("text").cast("binary")))
    return resolve.merge_duplicates(docs, ["key"], [F.col("doc_id")], ["doc_id", "lang"], ["n_chars"], [], "source")


@query("SELECT l_orderkey, l_linenumber, min(l_partkey) AS l_partkey, count(*) AS copies FROM lineitem GROUP BY 1, 2")
def dedupe_counts(spark, sf):
    first = F.min("l_partkey").alias("l_partkey")
    return t(spark, sf, "lineitem").groupBy("l_orderkey", "l_linenumber").agg(first, F.count(F.lit(1)).alias("copies"))


@query(
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey, l_quantity FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity, l_extendedprice) AS rn FROM lineitem) WHERE rn = 1"""
)
def dedupe_keep_first(spark, sf):
    lines = t(spark, sf, "lineitem")
    keep = lines.groupBy("l_orderkey", "l_linenumber").agg(rollups.first_by(["l_partkey", "l_suppkey", "l_quantity"], [F.col(c) for c in ("l_partkey", "l_suppkey", "l_quantity", "l_extendedprice")]).alias("r"))
    return keep.select("l_orderkey", F.col("l_linenumber").cast("long").alias("l_linenumber"), "r.*")


@query(
    """SELECT d.doc_id, CASE WHEN l.doc_id IS NULL THEN 'absent' WHEN l.toxic = 1 THEN 'missing' ELSE 'present' END AS state,
    CASE WHEN l.doc_id IS NULL THEN d.lang WHEN l.toxic = 1 THEN '' ELSE CAST(l.quality AS VARCHAR) END AS cell FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id"""
)
def keep_prior_three_state(spark, sf):
    labels = t(spark, sf, "labels").select("doc_id", "quality", (F.col("toxic") == 1).alias("is_missing"))
    return overlay.keep_prior(t(spark, sf, "documents").select("doc_id", "lang"), labels, "doc_id", "quality", "lang", "is_missing").select("doc_id", "state", "cell")


def _labelled(orders: DataFrame) -> DataFrame:
    label = F.when(F.col("o_orderkey") % 4 == 0, "other").when(F.col("o_orderkey") % 4 == 1, "").otherwise("choral")
    return orders.select("o_custkey", "o_orderkey", label.alias("label"), F.when(F.col("o_orderkey") % 4 == 2, "imslp_tags").otherwise("title").alias("src"), F.lit("").alias("note"))


@query(
    """SELECT o_orderkey, CASE WHEN carried THEN 'solo_voice' ELSE label END AS label, CASE WHEN carried THEN 'llm_pass' ELSE src END AS src, CASE WHEN b THEN o_orderpriority ELSE '' END AS note, carried FROM (
    SELECT *, b AND o_orderkey % 6 < 3 AND label IN ('', 'other') AND src <> 'imslp_tags' AS carried FROM (SELECT o_orderkey, o_orderpriority, o_orderkey % 5 <> 0 AS b,
    CASE o_orderkey % 4 WHEN 0 THEN 'other' WHEN 1 THEN '' ELSE 'choral' END AS label, CASE WHEN o_orderkey % 4 = 2 THEN 'imslp_tags' ELSE 'title' END AS src FROM orders))"""
)
def carry_forward(spark, sf):
    orders = t(spark, sf, "orders")
    decided = F.col("o_orderkey") % 6 < 3
    base = orders.where("o_orderkey % 5 <> 0").select("o_custkey", "o_orderkey", F.when(decided, "solo_voice").otherwise("other").alias("label"), F.when(decided, "llm_pass").otherwise("title").alias("src"), F.col("o_orderpriority").alias("note"))
    out = overlay.carry_forward(_labelled(orders), base, ["o_custkey", "o_orderkey"], "label", "src", ["note"], ["unclassified", "other"])
    return out.select("o_orderkey", "label", "src", "note", "carried")


@query("SELECT o_custkey, o_orderkey FROM orders WHERE o_orderkey % 17 = 0 AND o_orderkey % 3 <> 0")
def lost_rows(spark, sf):
    orders = t(spark, sf, "orders").select("o_custkey", "o_orderkey")
    return overlay.lost_rows(orders.where("o_orderkey % 17 <> 0"), orders.where("o_orderkey % 3 <> 0"), ["o_custkey", "o_orderkey"])


def _snapshots(spark, sf):
    old = t(spark, sf, "orders").select("o_orderkey", "o_orderstatus", "o_orderpriority", F.col("o_custkey").cast("string").alias("o_custkey"))
    new = old.where("o_orderkey % 17 <> 0").withColumn("o_orderstatus", F.when(F.col("o_orderkey") % 5 == 0, "X").otherwise(F.col("o_orderstatus")))
    new = new.withColumn("o_custkey", F.when(F.col("o_orderkey") % 7 == 0, F.concat(F.lit("0"), "o_custkey")).otherwise(F.col("o_custkey")))
    added = old.where("o_orderkey % 23 = 0").withColumn("o_orderkey", F.col("o_orderkey") + 1_000_000_000)
    return old, new.unionByName(added)


@query(
    """SELECT o_orderkey, 'removed' AS change, '' AS "column", NULL AS old, NULL AS new FROM orders WHERE o_orderkey % 17 = 0
    UNION ALL SELECT o_orderkey + 1000000000, 'added', '', NULL, NULL FROM orders WHERE o_orderkey % 23 = 0
    UNION ALL SELECT o_orderkey, 'changed', 'o_orderstatus', o_orderstatus, 'X' FROM orders WHERE o_orderkey % 17 <> 0 AND o_orderkey % 5 = 0
    UNION ALL SELECT o_orderkey, 'changed', 'o_custkey', CAST(o_custkey AS VARCHAR), '0' || o_custkey FROM orders WHERE o_orderkey % 17 <> 0 AND o_orderkey % 7 = 0"""
)
def snapshot_diff_cells(spark, sf):
    return snapshots.cell_changes(*_snapshots(spark, sf), ["o_orderkey"], ["o_orderstatus", "o_orderpriority", "o_custkey"])


@query("SELECT o_orderstatus || ' → X' AS transition, count(*) AS n FROM orders WHERE o_orderkey % 17 <> 0 AND o_orderkey % 5 = 0 GROUP BY 1")
def transitions(spark, sf):
    old, new = _snapshots(spark, sf)
    both = old.join(new.select("o_orderkey", F.col("o_orderstatus").alias("now")), "o_orderkey")
    return rollups.transitions(both, "o_orderstatus", "now")


@query(
    """SELECT dates, count(*) AS n FROM (SELECT CASE WHEN g1 IS NULL AND g2 IS NULL THEN 'unknown' WHEN greatest(coalesce(g1, g2), coalesce(g2, g1)) <= 1 THEN 'agree'
    WHEN least(coalesce(g1, g2), coalesce(g2, g1)) > 1 AND greatest(coalesce(g1, g2), coalesce(g2, g1)) > 10 THEN 'conflict_strong' ELSE 'conflict_weak' END AS dates
    FROM (SELECT abs(1800 + s_suppkey % 40 - (1800 + c_custkey % 40)) AS g1, CASE WHEN c_custkey % 3 = 0 THEN NULL ELSE abs(1870 + s_suppkey % 30 - (1870 + c_custkey % 29)) END AS g2
    FROM supplier JOIN customer ON s_suppkey = c_custkey % 97 + 1)) GROUP BY dates"""
)
def identity_compare(spark, sf):
    pairs = t(spark, sf, "supplier").join(t(spark, sf, "customer"), F.col("s_suppkey") == F.col("c_custkey") % 97 + 1)
    died = F.when(F.col("c_custkey") % 3 != 0, 1870 + F.col("c_custkey") % 29)
    dates = resolve.compare_dates(1800 + F.col("s_suppkey") % 40, 1870 + F.col("s_suppkey") % 30, 1800 + F.col("c_custkey") % 40, died)
    return pairs.groupBy(dates.alias("dates")).agg(F.count(F.lit(1)).alias("n"))


def _claims(spark, sf) -> DataFrame:
    k = F.col("c_custkey")
    return t(spark, sf, "customer").select(
        k.alias("id"),
        F.concat_ws("-", "c_mktsegment", F.col("c_nationkey").cast("string"), (k % 13).cast("string")).alias("category"),
        F.when(k % 11 == 0, "not_found").when(k % 3 == 0, "unverified_heuristic").otherwise("matched").alias("status"),
        F.when(k % 50 == 1, "wikidata_p839").otherwise("exact_name").alias("method"),
        F.when(k % 5 == 0, "conflict_strong").when(k % 5 < 3, "conflict_weak").otherwise("agree").alias("dates"),
        F.when(k % 2 == 0, "agree").otherwise("differs").alias("wikilink"),
    )


_CLAIMS_SQL = """SELECT c_custkey AS id, c_mktsegment || '-' || c_nationkey || '-' || (c_custkey % 13) AS category, CASE WHEN c_custkey % 11 = 0 THEN 'not_found' WHEN c_custkey % 3 = 0 THEN 'unverified_heuristic' ELSE 'matched' END AS status,
 CASE WHEN c_custkey % 50 = 1 THEN 'wikidata_p839' ELSE 'exact_name' END AS method, CASE WHEN c_custkey % 5 = 0 THEN 'conflict_strong' WHEN c_custkey % 5 < 3 THEN 'conflict_weak' ELSE 'agree' END AS dates, CASE WHEN c_custkey % 2 = 0 THEN 'agree' ELSE 'differs' END AS wikilink FROM customer"""


@query(
    f"""WITH d AS ({_CLAIMS_SQL}), a AS (SELECT *, status IN ('matched', 'unverified_heuristic') AS active FROM d),
    g AS (SELECT category, count(*) n, count(*) FILTER (status = 'matched' AND method = 'wikidata_p839' AND dates <> 'conflict_strong') nt, min(id) FILTER (status = 'matched' AND method = 'wikidata_p839' AND dates <> 'conflict_strong') tr,
      count(*) FILTER (dates = 'agree') na, min(id) FILTER (dates = 'agree') ag, count(*) FILTER (dates = 'agree' AND wikilink = 'agree') nl, min(id) FILTER (dates = 'agree' AND wikilink = 'agree') li FROM a WHERE active GROUP BY category HAVING count(*) > 1),
    w AS (SELECT category, CASE WHEN nt = 1 THEN tr WHEN nt > 1 THEN NULL WHEN na = 1 THEN ag WHEN nl = 1 THEN li END AS winner FROM g),
    s AS (SELECT a.*, w.category IS NOT NULL AND active AS contested, winner, CASE WHEN status = 'unverified_heuristic' AND (dates = 'agree' OR (dates = 'conflict_weak' AND wikilink = 'agree')) THEN 'matched'
      WHEN active AND dates = 'conflict_strong' AND status = 'matched' AND method = 'wikidata_p839' THEN 'rejected_p839' WHEN active AND dates = 'conflict_strong' THEN 'rejected_heuristic' ELSE status END AS ns FROM a LEFT JOIN w USING (category))
    SELECT id, CASE WHEN contested AND winner IS DISTINCT FROM id AND ns <> 'rejected_p839' THEN 'rejected_heuristic' ELSE ns END AS new_status, CASE WHEN contested AND winner IS DISTINCT FROM id THEN 'collision_lost' WHEN contested THEN 'collision_won' ELSE '' END AS outcome FROM s"""
)
def collision_resolution(spark, sf):
    return resolve.resolve_collisions(_claims(spark, sf)).select("id", "new_status", "outcome")


@query(f"SELECT category, count(*) AS n, min(id) AS first FROM ({_CLAIMS_SQL}) WHERE status = 'matched' AND method = 'wikidata_p839' AND dates <> 'conflict_strong' GROUP BY category HAVING count(*) > 1")
def collision_errors(spark, sf):
    return resolve.collision_errors(_claims(spark, sf))


@query("SELECT c_custkey, min(s_suppkey) AS s_suppkey FROM customer JOIN supplier ON c_nationkey = s_nationkey AND abs(c_acctbal - s_acctbal) <= 300 GROUP BY c_custkey HAVING count(*) = 1")
def unique_candidate_match(spark, sf):
    customers = t(spark, sf, "customer").select("c_custkey", F.col("c_nationkey").alias("nation"), "c_acctbal")
    suppliers = t(spark, sf, "supplier").select("s_suppkey", F.col("s_nationkey").alias("nation"), "s_acctbal")
    return resolve.unique_candidate(customers, suppliers, "nation", "c_custkey", ("c_acctbal", "s_acctbal", 300.0), "s_suppkey")


OVERRIDES = [
    ("3", "n_name", "Renamed", "spelling", "book", "ab", "2024-01-01"),
    ("4", "_drop", "", "not a nation", "book", "ab", "2024-01-01"),
    ("5", "rekey", "105", "wrong key", "book", "ab", "2024-01-01"),
    ("5", "n_regionkey", "4", "moved", "book", "ab", "2024-01-01"),
]
OVERRIDE_COLUMNS = "key string, field string, value string, reason string, source string, reviewer string, date string"


@query(
    """SELECT CAST(CASE n_nationkey WHEN 5 THEN 105 ELSE n_nationkey END AS BIGINT) AS n_nationkey, CASE n_nationkey WHEN 3 THEN 'Renamed' ELSE n_name END AS n_name, CAST(CASE n_nationkey WHEN 5 THEN 4 ELSE n_regionkey END AS BIGINT) AS n_regionkey FROM nation WHERE n_nationkey <> 4"""
)
def overrides_apply(spark, sf):
    out = overlay.apply_overrides(t(spark, sf, "nation"), inline(spark, OVERRIDES, OVERRIDE_COLUMNS), "n_nationkey", ["n_name", "n_regionkey"])
    return out.select(F.col("n_nationkey").cast("long").alias("n_nationkey"), "n_name", F.col("n_regionkey").cast("long").alias("n_regionkey"))


@query("SELECT CAST(n_nationkey AS VARCHAR) AS key, 'n_name' AS field, n_name AS old, 'Renamed' AS new FROM nation WHERE n_nationkey = 3 UNION ALL SELECT CAST(n_nationkey AS VARCHAR), 'n_regionkey', CAST(n_regionkey AS VARCHAR), '4' FROM nation WHERE n_nationkey = 5 AND n_regionkey <> 4")
def overridden_cells(spark, sf):
    return overlay.overridden_cells(t(spark, sf, "nation"), inline(spark, OVERRIDES, OVERRIDE_COLUMNS), "n_nationkey", ["n_name", "n_regionkey"])


@query(
    """SELECT CASE WHEN y <= 1995 THEN '≤ 1995' WHEN y <= 1971 THEN '-' WHEN y <= 1999 THEN '1972–1999' ELSE '2000+' END AS band, CASE WHEN k % 6 = 0 THEN 'eu_warning' WHEN k % 6 = 1 THEN 'us_only' WHEN k % 6 = 2 THEN 'licensed' WHEN k % 6 = 3 THEN 'wima' ELSE 'none' END AS basis, count(*) AS n
    FROM (SELECT year(o_orderdate) AS y, o_orderkey AS k FROM orders) GROUP BY 1, 2"""
)
def death_band_basis(spark, sf):
    flags = picked(["nonpd_eu|wima", "pd_us_only", "permission_granted", "wima", "nonpd_us", ""], "o_orderkey")
    return t(spark, sf, "orders").groupBy(status.death_band(F.year("o_orderdate").cast("string"), 2066).alias("band"), status.rights_basis(flags).alias("basis")).agg(F.count(F.lit(1)).alias("n"))


@query(
    """SELECT c_custkey, CASE c_custkey % 5 WHEN 0 THEN 'classical_core' WHEN 1 THEN 'film_media' WHEN 2 THEN 'popular' WHEN 3 THEN 'crossover' ELSE 'classical_core' END AS scope, CASE c_custkey % 5 WHEN 4 THEN 'default' ELSE 'occupations' END AS src,
    CASE WHEN c_custkey % 130 < 15 THEN 'implausible_lifespan' WHEN c_custkey % 130 > 110 THEN 'implausible_lifespan' ELSE '' END AS flags FROM customer"""
)
def scope_and_flags(spark, sf):
    occupations = F.filter(F.split(picked(["composer|film_composer", "film_composer", "songwriter", "pianist", ""], "c_custkey"), r"\|"), lambda x: x != "")
    scope = status.scope_class(occupations, F.array().cast("array<string>"))
    flags = status.lifespan_flags(F.lit(1800), 1800 + F.col("c_custkey") % 130)
    return t(spark, sf, "customer").select("c_custkey", scope["scope"].alias("scope"), scope["src"].alias("src"), F.array_join(flags, "|").alias("flags"))


@query(
    """SELECT c_custkey, CASE WHEN d < 1900 THEN 'death_year_' || d || '_before_1900' WHEN abs(lb - b) >= 40 AND b < 1850 THEN 'list_birth_' || lb || '_vs_wikidata_' || b END AS reason FROM
    (SELECT c_custkey, 1780 + c_custkey % 150 AS b, 1860 + c_custkey % 140 AS d, 1870 + c_custkey % 3 AS lb FROM customer) WHERE d < 1900 OR (abs(lb - b) >= 40 AND b < 1850)"""
)
def cohort_gate(spark, sf):
    k = F.col("c_custkey")
    reason = status.cohort_exclusion((1780 + k % 150).cast("string"), (1860 + k % 140).cast("string"), (1870 + k % 3).cast("string"), F.lit(""))
    return t(spark, sf, "customer").select("c_custkey", reason.alias("reason")).where("reason is not null")