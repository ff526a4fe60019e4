"""Connected components of links held in a table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, drop_written


def _state(edges: DataFrame) -> tuple[int, int]:
    row = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")).alias("s")).first()
    return row["n"], int(row["s"] or 0)


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of every node in ``edges`` (a, b: long); the component is its smallest node.

    Alternates large-star and small-star steps: each links a node's neighbours to the smallest one near
    it, until every node hangs from its component's smallest. Links stay in Spark; a round's result is
    written to the shared folder, so lineage stays short and lost executors cost one round at most.
    """
    now = cut(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    before = _state(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = now.join(least.withColumnRenamed("a", "b"), "b").select("a", "m").where("a <> m").withColumnRenamed("m", "b")
        large = large.unionByName(now.join(least, "a").where("b > m").select(F.col("b").alias("a"), F.col("m").alias("b"))).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a").where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        after = cut(small.unionByName(least.withColumnRenamed("m", "b")).where("a <> b").distinct())
        state = _state(after)
        drop_written(now)
        now = after
        if state == before:
            break
        before = state
    stars = now.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return stars.unionByName(now.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
