"""Reports of several labellers: each against a reference, every two of them, all on equal terms, and by rules of voting.

Rows: one per unit, labeller and condition, with a set of tags and a period. Units are grouped by their labellers,
who are few; everything else is counted by aggregates.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cells import text
from .statistics import jaccard, krippendorff_alpha, masi_distance

ABSTAINED = "unknown"


def _abstains(tags: str, period: str) -> Column:
    return (F.size(tags) == 0) & F.coalesce(F.col(period) == ABSTAINED, F.lit(False))


def _against(tags: Column, reference: Column) -> dict[str, Column]:
    """Aggregates of tags against a reference set; rows whose reference is null or empty do not count."""
    counts = F.coalesce(F.size(reference) > 0, F.lit(False))
    total = lambda c: F.sum(F.when(counts, F.size(c)))
    hit, said, wanted = total(F.array_intersect(tags, reference)), total(F.array_distinct(tags)), total(F.array_distinct(reference))
    p, r = F.try_divide(hit, said), F.try_divide(hit, wanted)
    f1 = F.when(p + r == 0, 0.0).otherwise(F.try_divide(2 * p * r, p + r))
    return {"reference_n": F.count_if(counts), "mean_jaccard": F.avg(F.when(counts, jaccard(tags, reference))), "precision": p, "recall": r, "f1": f1}


def label_scores(rows: DataFrame, references: DataFrame, unit: str, by: list[str], tags: str = "tags", period: str = "period") -> DataFrame:
    """(by, n, abstained, share, scores of tags, period_n, period_ties, period_hits, accuracy) per labeller and condition.

    ``references``: unit, ``wanted`` (tags), ``periods`` (the most frequent ones, several if tied). An answer of the
    period 'unknown' is none; a tie counts as right if the answer is one of it.
    """
    met = rows.join(references.select(unit, "wanted", "periods"), unit, "left")
    told = F.coalesce(F.size("periods") > 0, F.lit(False)) & F.coalesce(F.col(period) != ABSTAINED, F.lit(False))
    out = met.groupBy(*by).agg(
        F.count(F.lit(1)).alias("n"),
        F.count_if(_abstains(tags, period)).alias("abstained"),
        *(c.alias(k) for k, c in _against(F.col(tags), F.col("wanted")).items()),
        F.count_if(told).alias("period_n"),
        F.count_if(told & (F.size("periods") > 1)).alias("period_ties"),
        F.count_if(told & F.array_contains("periods", F.col(period))).alias("period_hits"),
    )
    return out.withColumns({"share": F.col("abstained") / F.col("n"), "accuracy": F.try_divide("period_hits", "period_n")})


def period_confusion(rows: DataFrame, references: DataFrame, unit: str, by: list[str], period: str = "period") -> DataFrame:
    """(by, said, wanted, n) over the units that have one most frequent period and an answer."""
    one = references.where(F.size("periods") == 1).select(unit, F.col("periods")[0].alias("wanted"))
    return rows.where(F.col(period) != ABSTAINED).join(one, unit).groupBy(*by, F.col(period).alias("said"), "wanted").agg(F.count(F.lit(1)).alias("n"))


def shared_units(rows: DataFrame, unit: str, labeller: str, condition: str, input_hash: str, labellers: list[str]) -> DataFrame:
    """(condition, unit, shared) of the units that any of the labellers answered; ``shared`` where all did, from one input."""
    among = rows.where(F.col(labeller).isin(*labellers)).groupBy(condition, unit)
    # Labellers are bits: two sets of distinct values in one group would write every row three times.
    bit = reduce(lambda rest, i: F.when(F.col(labeller) == labellers[i], 1 << i).otherwise(rest), range(len(labellers)), F.lit(0))
    same = F.count_distinct(F.coalesce(input_hash, F.lit(""))) == 1
    return among.agg(((F.bit_or(bit.cast("long")) == (1 << len(labellers)) - 1) & same).alias("shared"))


def equal_terms(rows: DataFrame, unit: str, labeller: str, condition: str, input_hash: str, labellers: list[str]) -> tuple[DataFrame, DataFrame]:
    """The labellers' rows of shared units, and (condition, by_any, shared, left_out)."""
    units = shared_units(rows, unit, labeller, condition, input_hash, labellers)
    counts = units.groupBy(condition).agg(F.count(F.lit(1)).alias("by_any"), F.count_if("shared").alias("shared"), F.count_if(~F.col("shared")).alias("left_out"))
    kept = units.where("shared").select(condition, unit)
    return rows.where(F.col(labeller).isin(*labellers)).join(kept, [condition, unit]), counts


def pairs_by_condition(rows: DataFrame, unit: str, labeller: str, condition: str, tags: str = "tags") -> DataFrame:
    """(condition, a, b, n, both_empty, mean_jaccard) of every two labellers over the units both answered under the condition."""
    side = lambda p: rows.select(condition, unit, F.col(labeller).alias(p), F.col(tags).alias(f"{p}_tags"))
    met = side("a").join(side("b"), [condition, unit]).where("a < b")
    empty = (F.size("a_tags") == 0) & (F.size("b_tags") == 0)
    return met.groupBy(condition, "a", "b").agg(F.count(F.lit(1)).alias("n"), F.count_if(empty).alias("both_empty"), F.avg(F.when(~empty, jaccard(F.col("a_tags"), F.col("b_tags")))).alias("mean_jaccard"))


def alphas(rows: DataFrame, unit: str, condition: str, conditions: list[str], tags: str = "tags", period: str = "period") -> DataFrame:
    """(condition, measure, n, alpha) of periods (nominal) and of tag sets (MASI); an abstention is a missing value."""
    parts = []
    sets = F.when(F.size(tags) > 0, F.array_sort(F.array_distinct(tags)))
    for c in conditions:
        own = rows.where(F.col(condition) == c).select(unit, F.when(F.col(period) != ABSTAINED, F.col(period)).alias("period"), sets.alias("tags"))
        for measure, distance in (("period", None), ("tags", masi_distance)):
            parts.append(krippendorff_alpha(own, unit, measure, distance).select(F.lit(c).alias(condition), F.lit(measure).alias("measure"), "n", "alpha"))
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


def voting_rules(labellers: list[str]) -> list[tuple[str, list[str], int]]:
    """(name, members, votes needed): every pair in accord, then any, two and all of the labellers."""
    together = [("+".join(p), list(p), 2) for p in combinations(labellers, 2)]
    needs = dict.fromkeys((1, 2, len(labellers)))
    return together + [(f"{k} of {len(labellers)}", list(labellers), k) for k in needs]


def vote_scores(rows: DataFrame, references: DataFrame, unit: str, labeller: str, condition: str, rules: list[tuple[str, list[str], int]], tags: str = "tags") -> DataFrame:
    """(condition, rule, n, covered, coverage, scores of the carried tags) of each voting rule, all rules in one pass."""
    cast = rows.groupBy(condition, unit).agg(F.collect_list(F.struct(F.col(labeller).alias("who"), F.array_distinct(tags).alias("tags"))).alias("cast"))
    each = F.explode(F.array(*(F.struct(F.lit(name).alias("rule"), F.array(*map(F.lit, who)).alias("who"), F.lit(need).alias("need")) for name, who, need in rules)))
    asked = cast.select(condition, unit, "cast", each.alias("r"))
    votes = F.flatten(F.transform(F.filter("cast", lambda v: F.array_contains(F.col("r.who"), v["who"])), lambda v: v["tags"]))
    counted = asked.withColumn("votes", votes)
    carried = F.filter(F.array_distinct("votes"), lambda tag: F.size(F.filter(F.col("votes"), lambda v: v == tag)) >= F.col("r.need"))
    met = counted.select(condition, unit, "r.rule", carried.alias("carried")).join(references.select(unit, "wanted"), unit, "left")
    out = met.groupBy(condition, "rule").agg(F.count(F.lit(1)).alias("n"), F.count_if(F.size("carried") > 0).alias("covered"), *(c.alias(k) for k, c in _against(F.col("carried"), F.col("wanted")).items()))
    return out.withColumn("coverage", F.col("covered") / F.col("n"))


def with_version(rows: DataFrame, model: str = "model", effort: str = "effort", condition: str = "condition", version: str = "prompt_version") -> DataFrame:
    """``labeller`` (model, with its effort if told) and ``asked`` (condition and version of the prompt)."""
    named = F.when(text(effort) != "", F.concat_ws("@", text(model), text(effort))).otherwise(text(model))
    return rows.withColumns({"labeller": named, "asked": F.concat(text(condition), F.lit("@"), text(version))})
