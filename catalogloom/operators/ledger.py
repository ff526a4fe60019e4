"""Append-only decisions: the latest per key, consensus and votes of several labellers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .rollups import carried_by


def latest(ledger: DataFrame, keys: list[str], time: str, line: str) -> DataFrame:
    """The newest row per key, the later line where times tie. An aggregation, so a hot key is combined before the shuffle."""
    rest = [c for c in ledger.columns if c not in keys]
    return ledger.groupBy(*keys).agg(F.max_by(F.struct(*rest), F.struct(time, line)).alias("r")).select(*keys, "r.*")


def consensus(latest_rows: DataFrame, entity: str, labeller: str, tags: str, pair: tuple[str, str]) -> DataFrame:
    """Tags that both labellers gave, in the first one's order; both must have answered."""
    a, b = ((F.max(F.when(F.col(labeller) == p, F.col(tags)))) for p in pair)
    both = latest_rows.where(F.col(labeller).isin(*pair)).groupBy(entity).agg(a.alias("a"), b.alias("b")).where("a is not null and b is not null")
    return both.select(entity, F.array_join(F.array_intersect("a", "b"), "|").alias("tags"), F.arrays_overlap("a", "b").alias("overlap"))


def votes(latest_rows: DataFrame, entity: str, labeller: str, tags: str) -> DataFrame:
    """'labeller=tag|tag;…' per entity, in labeller order."""
    cell = F.concat_ws("=", labeller, F.array_join(tags, "|"))
    return latest_rows.groupBy(entity).agg(F.array_join(F.array_sort(F.collect_list(cell)), ";").alias("votes"))


def by_rule(latest_rows: DataFrame, entity: str, labeller: str, tags: str, least: int) -> DataFrame:
    """Tags that at least ``least`` labellers gave."""
    return carried_by(latest_rows.select(entity, labeller, F.explode_outer(tags).alias("tag")), entity, labeller, "tag", least)


def answered_by_all(latest_rows: DataFrame, entity: str, labeller: str, input_hash: str, n: int) -> DataFrame:
    """Entities that ``n`` labellers answered on the same input."""
    return latest_rows.groupBy(entity).agg(F.count_distinct(labeller).alias("n"), F.count_distinct(input_hash).alias("inputs")).where((F.col("n") == n) & (F.col("inputs") == 1)).select(entity)


def pending(wanted: DataFrame, ledger: DataFrame, keys: list[str]) -> DataFrame:
    """What the ledger has no decision on."""
    return wanted.join(ledger.select(*keys).distinct(), keys, "left_anti")
