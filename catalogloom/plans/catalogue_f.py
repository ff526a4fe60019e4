"""Queries of labellers' reports, entity fields, re-keyed rows and authority ids, over whole tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import agreement, entities, overlay, resolve
from ..sources.tables import spread
from .catalogue_d import pick, sql_list, sql_pick
from .registry import query, t

# Labels: each customer is labelled by three labellers under two conditions.

WHO = ["ada", "bob", "cyd"]
PERIODS = ["romantic", "modern", "baroque", "unknown"]
_L = """SELECT c_custkey AS k, l, c, CASE WHEN (c_custkey + l + c) % 5 = 0 THEN [] ELSE list_distinct(['t' || ((c_custkey + l * c) % 3), 't' || ((c_nationkey + l) % 4)]) END AS tags, ['romantic', 'modern', 'baroque', 'unknown'][CAST((c_custkey // 2 + l * (c_nationkey % 2)) % 4 + 1 AS INTEGER)] AS period,
    CASE WHEN c_custkey % 11 = 0 THEN l ELSE 0 END AS h FROM customer, (SELECT unnest([0, 1, 2]) AS l), (SELECT unnest([0, 1]) AS c) WHERE (c_custkey + l) % 13 <> 0"""
_REF = """SELECT c_custkey AS k, CASE WHEN c_custkey % 4 = 0 THEN [] ELSE ['t' || (c_nationkey % 4), 't1x'] END AS wanted, CASE c_custkey % 5 WHEN 0 THEN [] WHEN 1 THEN ['romantic', 'modern'] ELSE ['baroque'] END AS periods FROM customer"""
_NAMES = f"({sql_list(WHO)})[l + 1] AS labeller, (['closed@v1', 'grounded@v1'])[c + 1] AS asked"
_SHARED = f"SELECT k, c FROM ({_L}) GROUP BY 1, 2 HAVING count(*) = 3 AND count(DISTINCT h) = 1"


def _scores(tags: str) -> str:
    """Scores of ``tags`` against ``wanted`` over a group."""
    hit = f"len(list_intersect({tags}, wanted))"
    has = "FILTER (len(wanted) > 0)"
    p, r = f"(sum({hit}) {has} / nullif(sum(len({tags})) {has}, 0))", f"(sum({hit}) {has} / nullif(sum(len(wanted)) {has}, 0))"
    return f"count(*) {has} AS reference_n, round(avg({hit} / (len({tags}) + len(wanted) - {hit})) {has}, 6) AS mean_jaccard, round({p}, 6) AS precision, round({r}, 6) AS recall, round(CASE WHEN {p} + {r} = 0 THEN 0 ELSE 2 * {p} * {r} / ({p} + {r}) END, 6) AS f1"


def _labels(spark, sf):
    k, n, who, c = F.col("c_custkey"), F.col("c_nationkey"), F.col("l"), F.col("c")
    rows = spread(t(spark, sf, "customer"), "c_custkey").withColumn("l", F.explode(F.array(*map(F.lit, (0, 1, 2))))).withColumn("c", F.explode(F.array(F.lit(0), F.lit(1)))).where((k + who) % 13 != 0)
    tag = lambda x: F.concat(F.lit("t"), x.cast("string"))
    some = F.array_distinct(F.array(tag((k + who * c) % 3), tag((n + who) % 4)))
    return agreement.with_version(
        rows.select(
            k.alias("k"),
            pick(WHO, "l").alias("model"),
            F.lit("").alias("effort"),
            pick(["closed", "grounded"], "c").alias("condition"),
            F.lit("v1").alias("prompt_version"),
            F.when((k + who + c) % 5 == 0, F.array().cast("array<string>")).otherwise(some).alias("tags"),
            pick(PERIODS, "c_custkey div 2 + l * (c_nationkey % 2)").alias("period"),
            F.when(k % 11 == 0, who).otherwise(0).cast("string").alias("h"),
        )
    )


def _references(spark, sf):
    k, none = F.col("c_custkey"), F.array().cast("array<string>")
    wanted = F.when(k % 4 == 0, none).otherwise(F.array(F.concat(F.lit("t"), F.col("c_nationkey") % 4), F.lit("t1x")))
    periods = F.when(k % 5 == 0, none).when(k % 5 == 1, F.array(F.lit("romantic"), F.lit("modern"))).otherwise(F.array(F.lit("baroque")))
    return t(spark, sf, "customer").select(k.alias("k"), wanted.alias("wanted"), periods.alias("periods"))


def _rounded(df, *columns):
    return df.withColumns({c: F.round(c, 6) for c in columns})


SCORES = ("mean_jaccard", "precision", "recall", "f1")


@query(
    f"""SELECT {_NAMES}, n, abstained, share, reference_n, mean_jaccard, precision, recall, f1, period_n, period_ties, period_hits, round(period_hits / period_n, 6) AS accuracy FROM (SELECT l, c, count(*) AS n, count(*) FILTER (len(tags) = 0 AND period = 'unknown') AS abstained, round(count(*) FILTER (len(tags) = 0 AND period = 'unknown') / count(*), 6) AS share, {_scores('tags')},
    count(*) FILTER (len(periods) > 0 AND period <> 'unknown') AS period_n, count(*) FILTER (len(periods) > 1 AND period <> 'unknown') AS period_ties, count(*) FILTER (period <> 'unknown' AND list_contains(periods, period)) AS period_hits FROM ({_L}) JOIN ({_REF}) USING (k) GROUP BY l, c)"""
)
def label_report(spark, sf):
    out = agreement.label_scores(_labels(spark, sf), _references(spark, sf), "k", ["labeller", "asked"])
    return _rounded(out, "share", "accuracy", *SCORES)


@query(f"SELECT {_NAMES}, period AS said, periods[1] AS wanted, count(*) AS n FROM ({_L}) JOIN ({_REF}) USING (k) WHERE len(periods) = 1 AND period <> 'unknown' GROUP BY ALL")
def label_confusion(spark, sf):
    return agreement.period_confusion(_labels(spark, sf), _references(spark, sf), "k", ["labeller", "asked"])


def _equal(spark, sf):
    return agreement.equal_terms(_labels(spark, sf), "k", "labeller", "asked", "h", WHO)


@query(f"SELECT (['closed@v1', 'grounded@v1'])[c + 1] AS asked, count(*) AS by_any, count(*) FILTER (s) AS shared, count(*) FILTER (NOT s) AS left_out FROM (SELECT k, c, count(*) = 3 AND count(DISTINCT h) = 1 AS s FROM ({_L}) GROUP BY 1, 2) GROUP BY c")
def shared_inputs(spark, sf):
    return _equal(spark, sf)[1]


@query(
    f"""WITH r AS (SELECT k, c, tags, ({sql_list(WHO)})[l + 1] AS who FROM ({_L}) JOIN ({_SHARED}) USING (k, c)), p AS (SELECT x.c, x.who AS a, y.who AS b, x.tags AS s, y.tags AS t, len(list_intersect(x.tags, y.tags)) AS i FROM r x JOIN r y ON x.k = y.k AND x.c = y.c AND x.who < y.who)
    SELECT (['closed@v1', 'grounded@v1'])[c + 1] AS asked, a, b, count(*) AS n, count(*) FILTER (len(s) + len(t) = 0) AS both_empty, round(avg(CASE WHEN len(s) + len(t) > 0 THEN i / (len(s) + len(t) - i) END), 6) AS mean_jaccard FROM p GROUP BY ALL"""
)
def three_way_pairs(spark, sf):
    return _rounded(agreement.pairs_by_condition(_equal(spark, sf)[0], "k", "labeller", "asked"), "mean_jaccard")


@query(
    f"""WITH r AS (SELECT k, c, tags, l FROM ({_L}) JOIN ({_SHARED}) USING (k, c)), rules AS (SELECT 'ada+bob' AS rule, [0, 1] AS who, 2 AS need UNION ALL SELECT 'ada+cyd', [0, 2], 2 UNION ALL SELECT 'bob+cyd', [1, 2], 2 UNION ALL SELECT '1 of 3', [0, 1, 2], 1 UNION ALL SELECT '2 of 3', [0, 1, 2], 2 UNION ALL SELECT '3 of 3', [0, 1, 2], 3),
    v AS (SELECT k, c, rule, tag FROM (SELECT k, c, l, unnest(tags) AS tag FROM r) JOIN rules ON list_contains(who, l) GROUP BY k, c, rule, tag, need HAVING count(*) >= need),
    g AS (SELECT k, c, rule, coalesce(list(tag) FILTER (tag IS NOT NULL), []) AS carried FROM (SELECT DISTINCT k, c FROM r) CROSS JOIN rules LEFT JOIN v USING (k, c, rule) GROUP BY 1, 2, 3)
    SELECT (['closed@v1', 'grounded@v1'])[c + 1] AS asked, rule, count(*) AS n, count(*) FILTER (len(carried) > 0) AS covered, {_scores('carried')}, round(count(*) FILTER (len(carried) > 0) / count(*), 6) AS coverage FROM g JOIN ({_REF}) USING (k) GROUP BY c, rule"""
)
def three_way_votes(spark, sf):
    out = agreement.vote_scores(_equal(spark, sf)[0], _references(spark, sf), "k", "labeller", "asked", agreement.voting_rules(WHO))
    return _rounded(out, "coverage", *SCORES)


@query(
    f"""WITH r AS (SELECT k, c, period AS v FROM ({_L}) JOIN ({_SHARED}) USING (k, c) WHERE period <> 'unknown'), m AS (SELECT *, count(*) OVER (PARTITION BY k, c) AS m FROM r), q AS (SELECT k, c, v, count(*) AS n, any_value(m) AS m FROM m WHERE m > 1 GROUP BY k, c, v),
    o AS (SELECT x.c, sum(x.n * y.n / (x.m - 1)) FILTER (x.v <> y.v) AS o FROM q x JOIN q y ON x.k = y.k AND x.c = y.c GROUP BY 1), w AS (SELECT c, v, sum(n) AS n FROM q GROUP BY 1, 2), z AS (SELECT c, sum(n) AS n, sum(n) * sum(n) - sum(n * n) AS e FROM w GROUP BY 1)
    SELECT (['closed@v1', 'grounded@v1'])[c + 1] AS asked, CAST(n AS BIGINT) AS n, round(1 - (o / n) / (e / (n * (n - 1))), 6) AS alpha FROM z JOIN o USING (c)"""
)
def three_way_alpha(spark, sf):
    out = agreement.alphas(_equal(spark, sf)[0], "k", "asked", ["closed@v1", "grounded@v1"])
    return _rounded(out.where("measure = 'period'").drop("measure"), "alpha")


# Entities: styles, scope, notable works and the stated category; rows under a new key.

STYLE_IDS = ["Q837182", "Q106576145", "Q535611", "Q1"]
STYLE_PAIRS = ["impressionism|neoclassicism", "neoclassicism", "neoclassicism", "impressionism"]
WORK_IDS, WORKS = ["Q36834", "Q1259917", "Q1415090", "Q753110"], ["composer", "violinist", "film_composer", "songwriter"]
_SCOPE = f"{sql_pick(['classical_core', 'crossover', 'film_media', 'popular'], 'c_custkey')}"
_CATEGORY = "CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'Category:C' || c_custkey || ',_A' END"


def _entities(spark, sf):
    k = F.col("c_custkey")
    claim = lambda v: F.concat(F.lit('{"mainsnak":{"snaktype":"value","datavalue":{"value":'), v, F.lit("}}}"))
    item = lambda q: claim(F.concat(F.lit('{"id":"'), q, F.lit('"}')))
    told = F.when(k % 2 == 0, F.concat(F.lit('"C'), k, F.lit(', A"'))).otherwise(F.concat(F.lit('"Category:C'), k, F.lit(', A"')))
    stated = F.when(k % 5 == 0, "").otherwise(claim(told))
    born = claim(F.lit('{"time":"+1900-01-01T00:00:00Z","precision":11}'))
    died = F.when(k % 3 == 0, claim(F.lit('{"time":"+1970-00-00T00:00:00Z","precision":9}'))).otherwise("")
    list_of = lambda pid, c: F.concat(F.lit(f'"{pid}":['), c, F.lit("]"))
    parts = [list_of("P31", item(F.lit("Q5"))), list_of("P106", item(pick(WORK_IDS, "c_custkey"))), list_of("P135", item(pick(STYLE_IDS, "c_custkey"))), list_of("P136", item(pick(STYLE_IDS, "c_custkey + 1")))]
    parts += [list_of("P800", F.concat_ws(",", item(F.concat(F.lit("Q9"), k)), item(F.lit("Q7")))), list_of("P839", stated), list_of("P569", born), list_of("P570", died)]
    json = F.concat(F.lit('{"id":"Q'), k, F.lit('","claims":{'), F.concat_ws(",", *parts), F.lit("}}"))
    # The key stands beside the entity, so that a join's filter of null keys is not one of whole entities, before they are dealt.
    return spread(t(spark, sf, "customer"), "c_custkey").select(F.concat(F.lit("Q"), k).alias("id"), entities.flatten(json).alias("e"))


@query(
    f"""SELECT 'Q' || c_custkey AS id, CASE WHEN c_custkey % 3 = 0 THEN 'year' ELSE 'day' END AS date_precision, {sql_pick(STYLE_PAIRS, 'c_custkey')} AS styles, 'wikidata' AS styles_src, {sql_pick(STYLE_IDS, 'c_custkey')} || '|' || {sql_pick(STYLE_IDS, 'c_custkey + 1')} AS style_ids,
    {_SCOPE} AS scope, 'occupations' AS scope_src, 'Q9' || c_custkey || '|Q7' AS notable_works, {_CATEGORY} AS category, CASE WHEN c_custkey % 4 = 1 THEN 'no_composer_occupation' ELSE '' END AS flags FROM customer"""
)
def entity_fields(spark, sf):
    fields = ["date_precision", "styles", "styles_src", "style_ids", "scope", "scope_src", "notable_works", "category", "flags"]
    return _entities(spark, sf).select("e.id", *(f"e.{f}" for f in fields))


@query(
    f"""SELECT 'Q' || CASE WHEN moved THEN target ELSE k END AS id, CASE WHEN moved THEN {sql_pick(WORKS, 'target')} ELSE 'old' END AS occupations, 'Category:C' || held || ',_A' AS category, CASE WHEN NOT moved THEN '' WHEN target % 5 = 0 THEN 'p839_none' WHEN target = held THEN 'matched_p839' ELSE 'imslp_needs_recheck' END AS action,
    CASE WHEN NOT moved THEN 'f' ELSE array_to_string(list_filter([CASE WHEN target % 4 = 1 THEN 'no_composer_occupation' END, CASE WHEN target % 5 <> 0 AND target <> held THEN 'imslp_needs_recheck' END], lambda x: x IS NOT NULL), '|') END AS flags, CASE WHEN moved AND target % 5 <> 0 AND target = held THEN 'matched' ELSE 'unverified_heuristic' END AS imslp_match_status
    FROM (SELECT c_custkey AS k, c_custkey % 6 = 0 AND c_custkey > 0 AS moved, c_custkey - 1 AS target, CASE WHEN c_custkey % 4 = 0 THEN c_custkey - 1 ELSE c_custkey END AS held FROM customer)"""
)
def rederived_rows(spark, sf):
    k = F.col("c_custkey")
    held = F.when(k % 4 == 0, k - 1).otherwise(k)
    q = lambda c: F.concat(F.lit("Q"), c)
    people = t(spark, sf, "customer").select(q(k).alias("id"), F.lit("old").alias("occupations"), F.concat(F.lit("Category:C"), held, F.lit(",_A")).alias("category"), F.lit("f").alias("flags"), F.lit("unverified_heuristic").alias("imslp_match_status"))
    moves = t(spark, sf, "customer").where((k % 6 == 0) & (k > 0)).select(q(k).alias("key"), F.lit(overlay.REKEY).alias("field"), q(k - 1).alias("value"), F.lit("2024-01-01").alias("date"))
    return overlay.rederive(people, moves, _entities(spark, sf), "id", {"occupations": "occupations", "flags": "flags"})


@query(
    """SELECT c_custkey, CASE WHEN NOT there THEN prior WHEN own <> '' THEN own WHEN search AND found <> '' THEN found WHEN NOT search AND was_found THEN prior ELSE '' END AS authority_id,
    array_to_string(list_filter(CASE WHEN NOT there THEN ['keep', CASE WHEN was_found THEN 'gnd_from_lobid' END, CASE WHEN was_odd THEN 'gnd_death_conflict' END] ELSE ['keep', CASE WHEN own = '' AND ((search AND found <> '') OR (NOT search AND was_found)) THEN 'gnd_from_lobid' END,
      CASE WHEN own <> '' AND record AND c_nationkey % 2 = 1 THEN 'gnd_death_conflict' WHEN own <> '' AND NOT record AND own = prior AND was_odd THEN 'gnd_death_conflict' WHEN own = '' AND search AND found <> '' AND c_nationkey % 3 = 1 THEN 'gnd_death_conflict' WHEN own = '' AND NOT search AND was_found AND was_odd THEN 'gnd_death_conflict' END] END, lambda x: x IS NOT NULL), '|') AS authority_flags,
    CASE WHEN NOT there THEN 'unread' WHEN own <> '' THEN 'own' WHEN search AND found <> '' THEN 'search' WHEN NOT search AND was_found THEN 'prior' ELSE 'none' END AS authority_src
    FROM (SELECT c_custkey, c_nationkey, c_custkey % 7 <> 0 AS there, CASE WHEN c_custkey % 2 = 0 THEN 'A' || c_custkey ELSE '' END AS own, c_custkey % 3 <> 0 AS record, c_custkey % 5 < 3 AS search, CASE WHEN c_custkey % 5 < 2 THEN 'F' || c_custkey ELSE '' END AS found, 'A' || c_custkey AS prior, c_nationkey % 4 < 2 AS was_found, c_nationkey % 5 < 3 AS was_odd FROM customer)"""
)
def authority_keeps_prior(spark, sf):
    k, n = F.col("c_custkey"), F.col("c_nationkey")
    name = lambda p: F.concat(F.lit(p), k)
    rows = t(spark, sf, "customer").select(
        k,
        (k % 7 != 0).alias("has_entity"),
        F.when(k % 2 == 0, name("A")).otherwise("").alias("own"),
        (k % 3 != 0).alias("has_record"),
        (1950 + n % 2).alias("record_death"),
        (k % 5 < 3).alias("has_search"),
        F.when(k % 5 < 2, name("F")).otherwise("").alias("found"),
        F.when(n % 3 == 1, 1951).when(n % 3 == 0, 1950).alias("found_death"),
        F.lit(1950).alias("death"),
        name("A").alias("prior_id"),
        F.array_compact(F.array(F.lit("keep"), F.when(n % 4 < 2, "gnd_from_lobid"), F.when(n % 5 < 3, "gnd_death_conflict"))).alias("prior_flags"),
    )
    return resolve.authority_with_prior(rows).select("c_custkey", "authority_id", "authority_flags", "authority_src")
