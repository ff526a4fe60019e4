"""Comparison of snapshots, and gates that a release must pass."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cells import split_cell, text


def cell_changes(old: DataFrame, new: DataFrame, keys: list[str], columns: list[str]) -> DataFrame:
    """(keys, change, column, old, new): rows added or removed, and each cell that differs, null equal to null."""
    side = lambda df, p: df.select(*(F.col(k).alias(f"{p}_{k}") for k in keys), F.struct(*(F.col(c).cast("string").alias(c) for c in columns)).alias(p))
    on = reduce(lambda a, b: a & b, (F.col(f"o_{k}").eqNullSafe(F.col(f"n_{k}")) for k in keys))
    joined = side(old, "o").join(side(new, "n"), on, "full_outer")
    cells = F.filter(F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"o.{c}").alias("old"), F.col(f"n.{c}").alias("new")) for c in columns)), lambda s: ~s["old"].eqNullSafe(s["new"]))
    none = F.array(F.struct(F.lit("").alias("column"), F.lit(None).cast("string").alias("old"), F.lit(None).cast("string").alias("new")))
    kind = F.when(F.col("o").isNull(), "added").when(F.col("n").isNull(), "removed").otherwise("changed")
    found = joined.select(*(F.coalesce(f"n_{k}", f"o_{k}").alias(k) for k in keys), kind.alias("change"), F.explode(F.when(kind == "changed", cells).otherwise(none)).alias("c"))
    return found.select(*keys, "change", F.col("c.column").alias("column"), F.col("c.old").alias("old"), F.col("c.new").alias("new"))


def change_counts(changes: DataFrame) -> DataFrame:
    return changes.groupBy("change", "column").agg(F.count(F.lit(1)).alias("n"))


def schema_changes(old: DataFrame, new: DataFrame) -> dict[str, list[str]]:
    return {"added": [c for c in new.columns if c not in old.columns], "removed": [c for c in old.columns if c not in new.columns]}


def violations(df: DataFrame, rules: list[tuple[str, Column]]) -> DataFrame:
    """(rule, n): rows that break each rule, all rules in one pass, zeros kept."""
    flat = df.agg(*(F.count_if(bad).alias(f"r{i}") for i, (_, bad) in enumerate(rules)))
    rows = F.explode(F.array(*(F.struct(F.lit(name).alias("rule"), F.col(f"r{i}").alias("n")) for i, (name, _) in enumerate(rules))))
    return flat.select(rows.alias("x")).select("x.rule", "x.n")


def duplicate_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where("n > 1")


def shared_owners(df: DataFrame, key: str, owner: str) -> DataFrame:
    """Keys with more than one owner."""
    return df.groupBy(key).agg(F.count_distinct(owner).alias("n_owners"), F.min(owner).alias("first_owner")).where("n_owners > 1")


def orphans(children: DataFrame, parents: DataFrame, child_key: str, key: str) -> DataFrame:
    return children.join(parents.select(F.col(key).alias(child_key)).distinct(), child_key, "left_anti")


def regression(old: DataFrame, new: DataFrame, measures: dict[str, Column], most_gain: float = 0.03, most_loss: float = 0.05) -> DataFrame:
    """(measure, old, new, ok): each measure of the new snapshot within bounds of the old."""
    a, b = (df.agg(*(m.cast("double").alias(f"{p}_{k}") for k, m in measures.items())) for df, p in ((old, "o"), (new, "n")))
    both = a.join(b)
    rows = F.explode(F.array(*(F.struct(F.lit(k).alias("measure"), F.col(f"o_{k}").alias("old"), F.col(f"n_{k}").alias("new")) for k in measures)))
    change = (F.col("x.new") - F.col("x.old")) / F.col("x.old")
    return both.select(rows.alias("x")).select("x.measure", "x.old", "x.new", F.coalesce(change.between(-most_loss, most_gain), F.col("x.old") == F.col("x.new")).alias("ok"))


def flag_changes(old: DataFrame, new: DataFrame, key: str, flags: str) -> DataFrame:
    """(flag, added, removed): how often each flag of a '|'-list came or went; a row that is in one snapshot counts too."""
    side = lambda df, p: df.select(key, split_cell(flags).alias(p))
    none = F.array().cast("array<string>")
    both = side(old, "o").join(side(new, "n"), key, "full_outer").select(F.coalesce("o", none).alias("o"), F.coalesce("n", none).alias("n"))
    each = F.concat(F.transform(F.array_except("n", "o"), lambda f: F.struct(f.alias("flag"), F.lit(1).alias("a"), F.lit(0).alias("r"))), F.transform(F.array_except("o", "n"), lambda f: F.struct(f.alias("flag"), F.lit(0).alias("a"), F.lit(1).alias("r"))))
    return both.select(F.explode(each).alias("x")).groupBy("x.flag").agg(F.sum("x.a").alias("added"), F.sum("x.r").alias("removed"))


def change_report(old: DataFrame, new: DataFrame, key: str, status: str, src: str, ignored: list[str]) -> DataFrame:
    """(measure, n): rows added, removed and changed, statuses that flipped, labels by models before and after; ``ignored`` columns do not count."""
    columns = [c for c in old.columns if c in new.columns and c != key and c not in ignored]
    side = lambda df, p: df.select(F.col(key).alias(f"{p}_key"), F.struct(*(F.col(c).cast("string").alias(c) for c in columns)).alias(p))
    both = side(old, "o").join(side(new, "n"), F.col("o_key").eqNullSafe(F.col("n_key")), "full_outer")
    there = F.col("o").isNotNull() & F.col("n").isNotNull()
    differs = reduce(lambda a, b: a | b, (~F.col(f"o.{c}").eqNullSafe(F.col(f"n.{c}")) for c in columns))
    measures = {
        "added": F.col("o").isNull(),
        "removed": F.col("n").isNull(),
        "changed": there & differs,
        "flips": there & ~F.col(f"o.{status}").eqNullSafe(F.col(f"n.{status}")),
        "by_model_old": F.coalesce(F.col(f"o.{src}").startswith("llm"), F.lit(False)),
        "by_model_new": F.coalesce(F.col(f"n.{src}").startswith("llm"), F.lit(False)),
    }
    return violations(both, list(measures.items())).withColumnRenamed("rule", "measure")


#: Columns whose changes are none of the data's, and heads of names of such columns.
IGNORED, IGNORED_HEADS = ["dump_date", "fetched_at"], ("pageviews_",)


def diff_report(old: DataFrame, new: DataFrame, keys: list[str], statuses: list[str] = (), years: list[str] = (), transitions: list[str] = (), by_model: dict[str, Column] | None = None, flags: str | None = None, owner: str | None = None, ignored: list[str] = IGNORED) -> DataFrame:
    """(section, name, value, n): everything that a snapshot's report tells of one table, from one join of both versions.

    ``rows``: rows of either and those added, removed or changed; ``column``: columns added or removed; ``cells``: cells that differ, by column;
    ``flip``: changes of ``statuses`` as 'from → to'; ``years``: rows in which any of ``years`` changed; ``transition``: changes of those columns;
    ``by_model``: rows of either version that fulfil each condition; ``flag added`` and ``flag removed``; ``added by`` and ``removed by``:
    rows by owner. Null equals ''. Columns in ``ignored``, or whose name begins as in ``IGNORED_HEADS``, do not count. Sections without anything have no row.
    """
    counts = lambda c: c not in ignored and not c.startswith(IGNORED_HEADS)
    shared = [c for c in old.columns if c in new.columns and c not in keys]
    there = [c for c in shared if counts(c)]
    conditions = by_model or {}
    side = lambda df, p: df.select(
        F.struct(*(text(k).alias(k) for k in keys)).alias(f"{p}_key"),
        F.struct(*(text(c).alias(c) for c in shared)).alias(p),
        F.array_compact(F.array(*(F.when(held, F.lit(name)) for name, held in conditions.items()), F.lit(None).cast("string"))).alias(f"{p}_model"),
        (text(owner) if owner else F.lit("")).alias(f"{p}_owner"),
    )
    both = side(old, "o").join(side(new, "n"), F.col("o_key") == F.col("n_key"), "full_outer")
    has_old, has_new = F.col("o_key").isNotNull(), F.col("n_key").isNotNull()
    kept = has_old & has_new
    fact = lambda section, name, value="": F.struct(F.lit(section).alias("section"), (F.lit(name) if isinstance(name, str) else name).alias("name"), (F.lit(value) if isinstance(value, str) else value).alias("value"))
    a, b = (lambda c: F.col("o")[c]), (lambda c: F.col("n")[c])
    differs = lambda c: kept & (a(c) != b(c))
    moved = lambda c: F.concat_ws(" → ", F.when(a(c) == "", "(empty)").otherwise(a(c)), F.when(b(c) == "", "(empty)").otherwise(b(c)))
    any_of = lambda columns: reduce(lambda x, y: x | y, (differs(c) for c in columns), F.lit(False))
    one = [
        F.when(has_old, fact("rows", "old")),
        F.when(has_new, fact("rows", "new")),
        F.when(~has_old, fact("rows", "added")),
        F.when(~has_new, fact("rows", "removed")),
        F.when(any_of(there), fact("rows", "changed")),
        *(F.when(differs(c), fact("cells", c)) for c in there),
        *(F.when(differs(c), fact("flip", c, moved(c))) for c in statuses),
        F.when(any_of(years), fact("years", "changed")),
        *(F.when(differs(c), fact("transition", c, moved(c))) for c in transitions),
    ]
    if owner:
        one += [F.when(~has_old, fact("added by", F.col("n_owner"))), F.when(~has_new, fact("removed by", F.col("o_owner")))]
    none = F.array().cast("array<string>")
    many = [F.transform(F.coalesce(f"{p}_model", none), _named(fact, "by_model", v)) for p, v in (("o", "old"), ("n", "new"))]
    if flags:
        before, after = (F.coalesce(split_cell(F.col(p)[flags]), none) for p in ("o", "n"))
        many += [F.transform(F.array_except(after, before), _named(fact, "flag added", "")), F.transform(F.array_except(before, after), _named(fact, "flag removed", ""))]
    told = both.select(F.explode(F.concat(F.array_compact(F.array(*one)), *many)).alias("x")).groupBy("x.section", "x.name", "x.value").agg(F.count(F.lit(1)).alias("n"))
    columns = [("column", c, kind, 1) for kind, names in schema_changes(old, new).items() for c in names if counts(c)]
    return told.unionByName(old.sparkSession.createDataFrame(columns, "section string, name string, value string, n long"))


def _named(fact, section: str, value: str):
    return lambda x: fact(section, x, value)


def has_changes(report: DataFrame) -> bool:
    """Whether a report tells of any change of data: rows or columns added or removed, or cells that differ."""
    return not report.where("section IN ('cells', 'column') OR (section = 'rows' AND name IN ('added', 'removed'))").isEmpty()


def coverage_gates(old: DataFrame, new: DataFrame, columns: dict[str, float]) -> DataFrame:
    """(column, old, new, ok): shares of filled cells; none may fall by more than its points."""
    share = {c: F.avg((F.coalesce(F.col(c).cast("string"), F.lit("")) != "").cast("double")) for c in columns}
    a, b = (df.agg(*(m.alias(f"{p}_{c}") for c, m in share.items())) for df, p in ((old, "o"), (new, "n")))
    rows = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(f"o_{c}").alias("old"), F.col(f"n_{c}").alias("new"), F.lit(most).alias("most")) for c, most in columns.items())))
    found = a.join(b).select(rows.alias("x")).select("x.*")
    return found.select("column", "old", "new", F.coalesce(F.round(F.col("old") - F.col("new"), 9) <= F.col("most"), F.lit(True)).alias("ok"))


def rollup_gate(parents: DataFrame, children: DataFrame, key: str, child_key: str, total: str) -> DataFrame:
    """(key, told, counted) of the parents whose stored number of children is wrong."""
    counted = children.groupBy(F.col(child_key).alias(key)).agg(F.count(F.lit(1)).alias("counted"))
    joined = parents.select(key, F.col(total).cast("long").alias("told")).join(counted, key, "left").withColumn("counted", F.coalesce("counted", F.lit(0)))
    return joined.where(~F.col("told").eqNullSafe(F.col("counted")))


def recomputed_gate(df: DataFrame, key: str, rules: dict[str, Column]) -> DataFrame:
    """(key, column, told, rule) of the cells that differ from what their rule gives now."""
    wrong = F.array_compact(F.array(*(F.when(~F.col(c).cast("string").eqNullSafe(rule.cast("string")), F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("told"), rule.cast("string").alias("rule"))) for c, rule in rules.items())))
    return df.select(key, F.explode(wrong).alias("x")).select(key, "x.*")


def release_errors(tables: dict[str, DataFrame], keys: dict[str, str], row_counts: dict[str, int], denied: dict[str, list[str]]) -> DataFrame:
    """(table, error, n): keys that repeat or are empty, row counts other than stated, ids that must not be there; zeros leave."""
    out = []
    for name, df in tables.items():
        key = F.col(keys[name]).cast("string")
        once = df.groupBy(key.alias("k")).agg(F.count(F.lit(1)).alias("n"))
        rules = {"repeated key": F.sum((F.col("n") > 1).cast("long")), "empty key": F.sum(F.when(F.coalesce("k", F.lit("")) == "", F.col("n"))), "denied key": F.sum(F.when(F.col("k").isin(denied.get(name, [])), F.col("n"))), "row count": F.abs(F.sum("n") - row_counts[name])}
        flat = once.agg(*(F.coalesce(m, F.lit(0)).alias(f"r{i}") for i, m in enumerate(rules.values())))
        rows = F.explode(F.array(*(F.struct(F.lit(name).alias("table"), F.lit(e).alias("error"), F.col(f"r{i}").alias("n")) for i, e in enumerate(rules))))
        out.append(flat.select(rows.alias("x")).select("x.*").where("n > 0"))
    return reduce(DataFrame.unionByName, out)


def spot_rules(categories: str = "imslp_genre_categories", family: str = "force_family") -> list[tuple[str, Column]]:
    """Rules that no work of a release may break: an opera is no concerto, an orchestra's symphony or overture no piano ensemble (fixed values)."""
    told, force = F.coalesce(F.col(categories), F.lit("")), F.coalesce(F.col(family), F.lit(""))
    orchestra = told.contains("For orchestra") & ~told.contains("For orchestra (arr)") & (told.contains("Symphonies") | told.contains("Overtures"))
    return [("opera as concerto", told.contains("Operas") & (force == "concerto")), ("orchestra as piano ensemble", orchestra & (force == "piano_ensemble"))]


def living_without_year(status: str = "eu_pd_status", died: str = "death_year") -> tuple[str, Column]:
    """A rule for persons: 'living' is a status of those with a year of death alone (fixed values)."""
    return "living without death year", (F.coalesce(F.col(status), F.lit("")) == "living") & (F.trim(F.coalesce(F.col(died).cast("string"), F.lit(""))) == "")


def manifest_errors(manifest: dict[str, int], told_id: str, dump_id: str, tables: dict[str, DataFrame]) -> DataFrame:
    """(error, n): a manifest of another snapshot, and counts that differ from the tables' rows (by how many); zeros leave."""
    spark = next(iter(tables.values())).sparkSession
    out = spark.createDataFrame([("manifest of another snapshot", int(told_id != dump_id))], "error string, n long")
    for name, df in tables.items():
        out = out.unionByName(df.agg(F.count(F.lit(1)).alias("n")).select(F.lit(f"count of {name}").alias("error"), F.abs(F.col("n") - F.lit(manifest.get(name, -1))).alias("n")))
    return out.where("n > 0")
