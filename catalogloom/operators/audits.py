"""Audits of curated tables, pooled answers, agreement between labellers, and report heads."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cells import text
from ..functions.licences import is_open
from .statistics import hash_order, jaccard


def _errors(df: DataFrame, keep: list[str], tests: list[tuple[Column, str, str]]) -> DataFrame:
    """(keep, error, column): one row per test that a row fails, all tests in one pass."""
    found = F.array_compact(F.array(*(F.when(bad, F.struct(F.lit(error).alias("error"), F.lit(column).alias("column"))) for bad, error, column in tests)))
    return df.select(*keep, F.explode(found).alias("e")).select(*keep, "e.error", "e.column")


def registry_errors(rows: DataFrame, key: str, required: Sequence[str], licence: str, urls: Sequence[str], counts: Sequence[str]) -> DataFrame:
    """What is wrong in a registry: keys missing or repeated, empty fields, licences that are not open, bad URLs and counts."""
    cell = lambda c: F.trim(text(c))
    keyed = cell(key) != ""
    tests = [(~keyed, "missing key", key)]
    tests += [(keyed & (cell(c) == ""), "missing field", c) for c in required]
    tests += [(keyed & (cell(licence) != "") & ~is_open(cell(licence)), "licence is not open", licence)]
    tests += [(keyed & (cell(c) != "") & ~cell(c).rlike(r"^(?i)https?://[^/?#]+"), "not an http url", c) for c in urls]
    tests += [(keyed & (cell(c) != "") & ~cell(c).rlike(r"^\d+$"), "not a count", c) for c in counts]
    repeated = rows.where(keyed).groupBy(cell(key).alias(key)).agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    again = repeated.select(key, F.lit("duplicate key").alias("error"), F.lit(key).alias("column"))
    return _errors(rows.withColumn(key, cell(key)), [key], tests).unionByName(again)


def crosswalk_errors(rows: DataFrame, vocabulary: DataFrame, schemes: dict[str, str], relations: Sequence[str], id_pattern: str) -> DataFrame:
    """What is wrong in a crosswalk (facet, value, scheme, relation, label, uri) to outside ``schemes`` (name -> URI prefix).

    Values of the vocabulary (facet, value) that no row maps are errors too.
    """
    known = vocabulary.select("facet", "value", F.lit(True).alias("known")).distinct()
    facets = vocabulary.select("facet", F.lit(True).alias("facet_known")).distinct()
    told = rows.join(known, ["facet", "value"], "left").join(facets, "facet", "left")
    facet, scheme = F.col("facet_known").isNotNull(), text("scheme")
    outside = facet & scheme.isin(list(schemes))
    prefix = F.element_at(F.create_map(*(F.lit(x) for pair in schemes.items() for x in pair)), F.when(outside, scheme))
    fits = F.startswith(text("uri"), prefix) & F.substring(text("uri"), F.length(prefix) + 1, F.length(text("uri"))).rlike(f"^(?:{id_pattern})$")
    tests = [
        (~facet, "unknown facet", "facet"),
        (facet & F.col("known").isNull(), "unknown value", "value"),
        (facet & (scheme == "") & (F.concat(text("relation"), text("label"), text("uri")) != ""), "filled without a scheme", "scheme"),
        (facet & (scheme != "") & ~outside, "unknown scheme", "scheme"),
        (outside & ~text("relation").isin(list(relations)), "unknown relation", "relation"),
        (outside & ~F.coalesce(fits, F.lit(False)), "uri of another scheme", "uri"),
        (outside & (text("label") == ""), "empty label", "label"),
    ]
    unmapped = known.join(rows, ["facet", "value"], "left_anti").select("facet", "value", F.lit("unmapped value").alias("error"), F.lit("value").alias("column"))
    return _errors(told, ["facet", "value"], tests).unionByName(unmapped)


def pooled_answers(answers: DataFrame, item: str, order: list[str], complete: Column, columns: list[str]) -> DataFrame:
    """One answer per item: the first complete one in ``order``, else the first at all (combined map-side)."""
    best = F.min_by(F.struct(*columns), F.struct((~complete).alias("partial"), *order))
    return answers.groupBy(item).agg(best.alias("a")).select(item, "a.*")


def most_common(df: DataFrame, column: str) -> DataFrame:
    """(value, n): the most frequent non-empty value, ties by value."""
    counts = df.where(text(column) != "").groupBy(F.col(column).alias("value")).agg(F.count(F.lit(1)).alias("n"))
    return counts.orderBy(F.desc("n"), "value").limit(1)


def period_label(window: Column) -> Column:
    """'2025-01..2025-12' as '2025'; a window over several years as it is."""
    years = F.array_distinct(F.filter(F.transform(F.split(window, r"\.\."), lambda p: F.left(F.trim(p), F.lit(4))), lambda y: y.rlike(r"^\d{4}$")))
    return F.when(F.size(years) == 1, years[0]).otherwise(window)


def owners_of_changes(old: DataFrame, new: DataFrame, keys: list[str], owner: str, n: int = 20) -> DataFrame:
    """(change, owner, n): the owners of most rows added and of most rows removed (a report's head)."""

    def side(a: DataFrame, b: DataFrame, change: str) -> DataFrame:
        counts = a.join(b.select(*keys), keys, "left_anti").groupBy(owner).agg(F.count(F.lit(1)).alias("n"))
        return counts.orderBy(F.desc("n"), owner).limit(n).select(F.lit(change).alias("change"), owner, "n")

    return side(new, old, "added").unionByName(side(old, new, "removed"))


def pair_agreement(rows: DataFrame, unit: str, labeller: str, tags: str) -> DataFrame:
    """(a, b, n, both_empty, mean_jaccard) of each two labellers over the units that both labelled.

    One row per unit and labeller: a unit's rows are as many as its labellers.
    """
    side = lambda p: rows.select(unit, F.col(labeller).alias(p), F.col(tags).alias(f"{p}_tags"))
    met = side("a").join(side("b"), unit).where("a < b")
    empty = (F.size("a_tags") == 0) & (F.size("b_tags") == 0)
    share = jaccard(F.col("a_tags"), F.col("b_tags"))
    return met.groupBy("a", "b").agg(F.count(F.lit(1)).alias("n"), F.count_if(empty).alias("both_empty"), F.avg(F.when(~empty, share)).alias("mean_jaccard"))


def condition_agreement(rows: DataFrame, unit: str, labeller: str, condition: str, tags: str, pair: tuple[str, str] = ("closed", "grounded")) -> DataFrame:
    """(labeller, n, both_empty, mean_jaccard) of each labeller's answers under two conditions, over the units answered under both."""
    side = lambda c, p: rows.where(F.col(condition) == c).select(unit, labeller, F.col(tags).alias(p))
    met = side(pair[0], "a_tags").join(side(pair[1], "b_tags"), [unit, labeller])
    empty = (F.size("a_tags") == 0) & (F.size("b_tags") == 0)
    share = jaccard(F.col("a_tags"), F.col("b_tags"))
    return met.groupBy(labeller).agg(F.count(F.lit(1)).alias("n"), F.count_if(empty).alias("both_empty"), F.avg(F.when(~empty, share)).alias("mean_jaccard"))


def period_scores(answers: DataFrame, children: DataFrame, key: str, labeller: str, period: str, child_period: str) -> DataFrame:
    """(labeller, n, hits, share): answers that are among the most frequent periods of a parent's children (any of several tied)."""
    counts = children.groupBy(key, child_period).agg(F.count(F.lit(1)).alias("c"))
    most = counts.groupBy(key).agg(F.max("c").alias("most"))
    tied = counts.join(most, key).where("c = most").groupBy(key).agg(F.collect_set(child_period).alias("tied"))
    met = answers.where(text(period) != "").join(tied, key)
    return met.groupBy(labeller).agg(F.count(F.lit(1)).alias("n"), F.count_if(F.array_contains("tied", F.col(period))).alias("hits")).withColumn("share", F.col("hits") / F.col("n"))


def error_rates(df: DataFrame, stratum: str, metrics: dict[str, tuple[Column, Column]]) -> DataFrame:
    """(metric, stratum, eligible, errors, rate): each metric is a pair of conditions, eligible and wrong; all in one pass."""
    each = F.explode(F.array(*(F.struct(F.lit(k).alias("metric"), F.coalesce(e, F.lit(False)).alias("eligible"), F.coalesce(e & w, F.lit(False)).alias("wrong")) for k, (e, w) in metrics.items())))
    out = df.select(stratum, each.alias("m")).groupBy(F.col("m.metric").alias("metric"), stratum).agg(F.count_if("m.eligible").alias("eligible"), F.count_if("m.wrong").alias("errors"))
    return out.withColumn("rate", F.try_divide("errors", "eligible"))


def ordered_lookup(df: DataFrame, key: str, codes: str, table: DataFrame, code: str, value: str) -> DataFrame:
    """(key, values): each row's codes by ``table`` in their order, distinct, '|'-joined; unknown codes leave."""
    each = df.select(key, F.posexplode(codes).alias("place", "code"))
    named = each.join(table.select(F.col(code).alias("code"), F.col(value).alias("value")), "code")
    rolled = named.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("place", "value"))).alias("s"))
    joined = F.array_join(F.array_distinct(F.transform("s", lambda s: s["value"])), "|")
    return df.select(key).join(rolled, key, "left").select(key, F.coalesce(joined, F.lit("")).alias("values"))


def pilot_sample(df: DataFrame, groups: list[tuple[str, Column, int]], key: str, seed: str) -> DataFrame:
    """(key, group): so many rows of each group in hash order (a sampling operator); a row is of the first group that it fits."""
    name = F.coalesce(*(F.when(condition, group) for group, condition, _ in groups))
    grouped = df.select(key, name.alias("group"))
    heads = [grouped.where(F.col("group") == g).orderBy(hash_order(seed, key), key).limit(n) for g, _, n in groups]
    out = heads[0]
    for head in heads[1:]:
        out = out.unionByName(head)
    return out


#: Flags that keep a person out of a pilot sample, and how many of each group it has.
PILOT_EXCLUDED = ["not_human", "no_composer_occupation"]
PILOT_SIZES = {"wikidata": 40, "pd": 40, "other": 20}


def pilot_of_people(people: DataFrame, key: str, seed: str) -> DataFrame:
    """(key, group): a pilot sample of people without an excluding flag (a sampling operator), in hash order.

    ``wikidata``: styles by that source; ``pd``: out of protection, with works and without styles; ``other``: with an article, those of
    neither pool before others. A person is in one group only. Raises if a group cannot be filled.
    """
    flagged = F.arrays_overlap(F.split(text("qa_flags"), r"\|"), F.array(*map(F.lit, PILOT_EXCLUDED)))
    first = text("style_tags_src") == "wikidata"
    second = (text("eu_pd_status") == "pd") & (F.coalesce(F.expr("try_cast(imslp_works_count AS double)"), F.lit(0.0)) > 0) & (text("style_tags") == "")
    pool = people.where(~flagged).select(key, first.alias("wikidata"), second.alias("pd"), (text("wikipedia_url") != "").alias("other"), hash_order(seed, key).alias("_h"))
    out = None
    for group, n in PILOT_SIZES.items():
        rest = pool if out is None else pool.join(out, key, "left_anti")
        order = [F.asc("_h"), F.asc(key)] if group != "other" else [(F.col("wikidata") | F.col("pd")).asc(), F.asc("_h"), F.asc(key)]
        head = rest.where(F.col(group)).orderBy(*order).limit(n).select(key, F.lit(group).alias("group"))
        if (got := head.count()) < n:
            raise ValueError(f"{group}: {n} wanted, the pool has {got}")
        out = head if out is None else out.unionByName(head)
    return out
