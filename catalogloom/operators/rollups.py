"""Grouped derivations: rollups over ordered vocabularies, merges, rankings, matrices."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def present_counts(parents: DataFrame, children: DataFrame, key: str, child_key: str, category: str, vocabulary: list[str]) -> DataFrame:
    """Per parent: categories present in vocabulary order, their counts as JSON text, the total; parents without children stay."""
    place = F.array_position(F.array(*map(F.lit, vocabulary)), F.col(category))
    counts = children.groupBy(F.col(child_key).alias(key), category).agg(F.count(F.lit(1)).alias("n"))
    counts = counts.withColumn("place", place).where("place > 0")
    rolled = counts.groupBy(key).agg(F.array_sort(F.collect_list(F.struct("place", F.col(category).alias("c"), "n"))).alias("s"), F.sum("n").alias("total"))
    entry = lambda s: F.concat(F.lit('"'), s["c"], F.lit('": '), s["n"].cast("string"))
    joined = parents.select(key).join(rolled, key, "left")
    return joined.select(
        key,
        F.coalesce(F.array_join(F.transform("s", lambda s: s["c"]), "|"), F.lit("")).alias("present"),
        F.coalesce(F.concat(F.lit("{"), F.array_join(F.transform("s", entry), ", "), F.lit("}")), F.lit("")).alias("counts"),
        F.coalesce("total", F.lit(0)).cast("long").alias("total"),
    )


def keep_first(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """One row per key, the first in ``order``; by a window, so the choice does not depend on partitions."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("_rn", F.row_number().over(w)).where("_rn = 1").drop("_rn")


def first_by(columns: list[str], order: list[Column]) -> Column:
    """Aggregate: the struct of ``columns`` of the first row in ``order`` (all ascending); combined map-side, so a hot key is no hot task."""
    return F.min_by(F.struct(*columns), F.struct(*order))


def capped_examples(df: DataFrame, key: str, value: str, cap: int) -> DataFrame:
    """At most ``cap`` distinct least values per key (a report)."""
    w = Window.partitionBy(key).orderBy(value)
    distinct = df.select(key, value).distinct()
    return distinct.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= cap).groupBy(key).agg(F.array_join(F.array_sort(F.collect_list(value)), "|").alias("examples"))


def token_counts(df: DataFrame, tokens: Column) -> DataFrame:
    return df.select(F.explode(tokens).alias("token")).groupBy("token").agg(F.count(F.lit(1)).alias("n"))


def top(df: DataFrame, n: int, count: str = "n", label: str = "token") -> DataFrame:
    return df.orderBy(F.desc(count), F.asc(label)).limit(n)


def matrix(df: DataFrame, row: str, column: str, values: list[str]) -> DataFrame:
    """Counts of row x column with zeros; the columns are ``values`` in order."""
    return df.groupBy(row).agg(*(F.count_if(F.col(column) == v).alias(f"n_{v}".replace(" ", "_").replace("-", "_").lower()) for v in values), F.count(F.lit(1)).alias("total"))


def dominant(df: DataFrame, key: str, value: str) -> DataFrame:
    """The most frequent values per key, ties all kept in order."""
    counts = df.groupBy(key, value).agg(F.count(F.lit(1)).alias("n"))
    most = counts.groupBy(key).agg(F.max("n").alias("most"))
    tied = counts.join(most, key).where("n = most")
    return tied.groupBy(key).agg(F.array_join(F.array_sort(F.collect_list(value)), "|").alias("dominant"), F.max("n").alias("n"), F.count(F.lit(1)).alias("n_tied"))


def carried_by(df: DataFrame, key: str, voter: str, tag: str, least: int) -> DataFrame:
    """Tags that at least ``least`` voters gave, sorted and '|'-joined."""
    counts = df.select(key, voter, tag).distinct().groupBy(key, tag).agg(F.count(F.lit(1)).alias("n"))
    kept = counts.where(F.col("n") >= least).groupBy(key).agg(F.array_join(F.array_sort(F.collect_list(tag)), "|").alias("tags"))
    return df.select(key).distinct().join(kept, key, "left").select(key, F.coalesce("tags", F.lit("")).alias("tags"))


def coverage(df: DataFrame, columns: list[str]) -> DataFrame:
    """Non-empty cells per column, and their share in percent (half-even, one decimal)."""
    flat = df.agg(F.count(F.lit(1)).alias("rows"), *(F.count_if(F.coalesce(F.col(c).cast("string"), F.lit("")) != "").alias(c) for c in columns))
    cells = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).alias("filled")) for c in columns)))
    return flat.select("rows", cells.alias("x")).select("x.column", "x.filled", F.bround(100 * F.col("x.filled") / F.col("rows"), 1).alias("percent"))


def transitions(old_new: DataFrame, old: str, new: str) -> DataFrame:
    changed = old_new.where(~F.col(old).eqNullSafe(F.col(new)))
    label = F.concat_ws(" → ", F.coalesce(F.col(old).cast("string"), F.lit("(empty)")), F.coalesce(F.col(new).cast("string"), F.lit("(empty)")))
    return changed.groupBy(label.alias("transition")).agg(F.count(F.lit(1)).alias("n"))
