"""The faceted query over parents and children."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cells import split_cell, text
from .statistics import hash_order, places


@dataclass(frozen=True)
class FacetQuery:
    """What is asked: any of several values within a facet, all facets at once; '' and () ask nothing."""

    contains: str = ""
    parent_in: dict[str, tuple] = field(default_factory=dict)
    #: Columns of '|'-lists: one of the values stands in one of the columns.
    tags_in: dict[tuple, tuple] = field(default_factory=dict)
    child_in: dict[str, tuple] = field(default_factory=dict)
    with_children: bool = False
    sort: str = ""
    descending: bool = False


def run(query: FacetQuery, parents: DataFrame, children: DataFrame, key: str, child_key: str, name: str) -> DataFrame:
    """Parents that fit, with the number of children that fit, sorted with missing values last in either direction."""
    found = parents
    if query.contains:
        found = found.where(F.lower(name).contains(query.contains.lower()))
    for column, values in query.parent_in.items():
        if values:
            found = found.where(F.col(column).isin(*values))
    for columns, values in query.tags_in.items():
        if values:
            found = found.where(F.arrays_overlap(F.concat(*map(split_cell, columns)), F.array(*map(F.lit, values))))
    fitting = children
    for column, values in query.child_in.items():
        if values:
            fitting = fitting.where(F.col(column).isin(*values))
    counts = fitting.groupBy(F.col(child_key).alias(key)).agg(F.count(F.lit(1)).alias("n_matches"))
    need = query.with_children or any(query.child_in.values())
    found = found.join(counts, key, "inner" if need else "left").withColumn("n_matches", F.coalesce("n_matches", F.lit(0)).cast("long"))
    return found.orderBy(*_order(query, key, name)) if query.sort else found


def _order(query: FacetQuery, key: str, name: str) -> list[Column]:
    way = F.col(query.sort).desc_nulls_last() if query.descending else F.col(query.sort).asc_nulls_last()
    return [way, F.asc(name), F.asc(key)]


def run_numbered(query: FacetQuery, parents: DataFrame, children: DataFrame, key: str, child_key: str, name: str) -> DataFrame:
    """``run`` with ``place`` from 0 in its order, so that a page of results is a range of places."""
    found = run(FacetQuery(**{**query.__dict__, "sort": ""}), parents, children, key, child_key, name)
    placed, _ = places(found, _order(query, key, name))
    return placed.withColumnRenamed("_place", "place")


def _each(facets: dict[str, Column]) -> Column:
    """(facet, value) of all facets of a row; array facets give each element."""
    named = lambda facet: lambda v: F.struct(F.lit(facet).alias("facet"), v.cast("string").alias("value"))
    pairs = [F.transform(values, named(facet)) for facet, values in facets.items()]
    return F.explode(F.filter(F.concat(*pairs), lambda p: F.coalesce(p["value"], F.lit("")) != ""))


def facet_counts(df: DataFrame, facets: dict[str, Column]) -> DataFrame:
    """(facet, value, n) of all facets, counted in one scan; each facet is an array (``F.array`` of a plain column)."""
    return df.select(_each(facets).alias("x")).groupBy("x.facet", "x.value").agg(F.count(F.lit(1)).alias("n"))


def manifest(parents: DataFrame, children: DataFrame, facets: dict[str, Column], filled: list[str], covered: dict[str, Column] | None = None, window: Column | None = None, child_facets: dict[str, Column] | None = None) -> DataFrame:
    """(section, name, value, n): row counts, facet values, cells filled, rows that fulfil each condition of ``covered``, and how often each ``window`` stands; one scan of each table.

    Every row gives an entry for each of its facts, which are counted together with a map-side combine. A condition
    that no row fulfils has no entry.
    """

    def entries(count: str, values: dict[str, Column], flags: dict[str, dict[str, Column]]) -> Column:
        fact = lambda section, name, value: F.struct(F.lit(section).alias("section"), F.lit(name).alias("name"), value.cast("string").alias("value"))
        one = [fact("count", count, F.lit("")), *(F.when(held, fact(section, name, F.lit(""))) for section, of in flags.items() for name, held in of.items())]
        named = lambda section, name: lambda x: fact(section, name, x)
        many = [F.filter(F.transform(v, named(*of)), lambda f: F.coalesce(f["value"], F.lit("")) != "") for of, v in values.items()]
        return F.explode(F.concat(F.array_compact(F.array(*one)), *many))

    values = {("facet", name): v for name, v in facets.items()}
    if window is not None:
        values[("window", "")] = F.array(window)
    own = parents.select(entries("parents", values, {"filled": {c: text(c) != "" for c in filled}, "covered": covered or {}}).alias("x"))
    theirs = children.select(entries("children", {("child_facet", name): v for name, v in (child_facets or {}).items()}, {}).alias("x"))
    return own.unionByName(theirs).groupBy("x.section", "x.name", "x.value").agg(F.count(F.lit(1)).alias("n"))


def window_label(entries: DataFrame) -> str:
    """A short label of the window that most parents have (the least of several): its year if both its ends share one; '' without any."""
    most = entries.where("section = 'window'").orderBy(F.desc("n"), "value").select("value").head()
    if not most:
        return ""
    years = {part.strip()[:4] for part in most[0].split("..") if part.strip()[:4].isdigit()}
    return years.pop() if len(years) == 1 else most[0]


def write_export(exported: DataFrame, parents: DataFrame, entries: DataFrame, path: str, key: str) -> None:
    """Three folders of JSON lines under ``path``, as they are read back by ``read_export``: parents, children by parent, manifest entries; refuses to overwrite."""
    parents.write.mode("errorifexists").json(f"{path}/parents")
    exported.select(key, "children").write.mode("errorifexists").json(f"{path}/children_by_parent")
    entries.write.mode("errorifexists").json(f"{path}/manifest")


def read_export(spark, path: str, key: str, schema: str) -> DataFrame:
    """(key, fields of ``schema``): the children of an export as flat rows; a parent without any has none."""
    rows = spark.read.schema(f"{key} string, children string").json(f"{path}/children_by_parent")
    return flat_children(rows, key, schema)


def flat_children(exported: DataFrame, key: str, schema: str) -> DataFrame:
    return exported.select(key, F.explode(F.from_json("children", f"array<struct<{schema}>>")).alias("c")).select(key, "c.*")


def vote_rules(labellers: list[str], pair: tuple[str, str]) -> dict[str, tuple[list[str], int]]:
    """Rule -> (labellers that count, votes needed): the pair, a majority and all (of three or more), any, each alone."""
    n = len(labellers)
    rules = {"pair": (list(pair), 2)}
    if n > 2:
        rules |= {f"{n // 2 + 1}of{n}": (labellers, n // 2 + 1), "all": (labellers, n)}
    return rules | {"any": (labellers, 1)} | {name: ([name], 1) for name in labellers}


def tags_by_rule(latest: DataFrame, entity: str, labeller: str, tags: str, labellers: list[str], pair: tuple[str, str]) -> DataFrame:
    """(entity, rule, tags): tags under every rule, sorted; a tag's votes are counted once for all rules."""
    votes = latest.select(entity, labeller, F.explode(F.array_distinct(tags)).alias("tag")).groupBy(entity, "tag").agg(F.collect_set(labeller).alias("by"))
    rules = vote_rules(labellers, pair)
    enough = lambda who, need: F.size(F.array_intersect("by", F.array(*map(F.lit, who)))) >= need
    kept = votes.select(entity, "tag", F.explode(F.array_compact(F.array(*(F.when(enough(*rule), F.lit(name)) for name, rule in rules.items())))).alias("rule"))
    return kept.groupBy(entity, "rule").agg(F.array_join(F.array_sort(F.collect_list("tag")), "|").alias("tags"))


def styles_by_source(parents: DataFrame, children: DataFrame, key: str, child_key: str, own: str, own_src: str, voted: str, child_styles: str) -> DataFrame:
    """(key, wikidata, llm, imslp): styles of a parent by source; the last is the union of its children's."""
    union = children.select(F.col(child_key).alias(key), F.explode(split_cell(child_styles)).alias("s")).groupBy(key).agg(F.array_join(F.array_sort(F.collect_set("s")), "|").alias("imslp"))
    told = F.when(F.col(own_src) == "wikidata", text(own)).otherwise("")
    return parents.select(key, told.alias("wikidata"), text(voted).alias("llm")).join(union, key, "left").withColumn("imslp", F.coalesce("imslp", F.lit("")))


def badges(tokens: Column, table: dict[str, str]) -> Column:
    """Labels of the tokens that have one, in the table's order."""
    return F.array_compact(F.array(*(F.when(F.array_contains(tokens, token), F.lit(label)) for token, label in table.items())))


def less_viewed_half(df: DataFrame, views: str, key: str) -> DataFrame:
    """The half with the fewer views (missing: none), the odd one included."""
    placed, total = places(df.withColumn("_v", F.coalesce(F.col(views).cast("double"), F.lit(0.0))), ["_v", key])
    return placed.where(F.col("_place") < (total + 1) // 2).drop("_v", "_place")


def random_picks(df: DataFrame, key: str, seed: str, n: int, seen: DataFrame | None = None) -> DataFrame:
    """``n`` rows in seeded hash order that were not seen before (a sampling operator)."""
    rest = df if seen is None else df.join(seen.select(key), key, "left_anti")
    return rest.orderBy(hash_order(seed, key), key).limit(n)


def export(parents: DataFrame, children: DataFrame, key: str, child_key: str, child_columns: list[str], order: str) -> DataFrame:
    """(key, n, works): children of each parent as ordered JSON text."""
    rows = children.groupBy(F.col(child_key).alias(key)).agg(F.array_sort(F.collect_list(F.struct(F.col(order).alias("_o"), F.struct(*child_columns).alias("w")))).alias("s"))
    joined = parents.select(key).join(rows, key, "left")
    return joined.select(key, F.coalesce(F.size("s"), F.lit(0)).cast("long").alias("n"), F.coalesce(F.to_json(F.transform("s", lambda x: x["w"])), F.lit("[]")).alias("children"))
