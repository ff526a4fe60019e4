"""Whether two tables hold the same rows, repeats counted, without sorting or joining them whole.

Each table is read once: rows are hashed, and the hashes are summed by range of the key. Sums do not depend on order or
partitions, and with the number of rows and a second hash's sum two different multisets of rows hardly agree. Ranges
that agree are done; rows of the others alone are compared one by one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cells import text


def _cells(columns: list[str]) -> list[Column]:
    return [text(c) for c in columns]


def key_range(key: str, ranges: int) -> Column:
    """The range of a key: by its hash, so that hot stretches of keys spread."""
    return F.pmod(F.xxhash64(text(key)), F.lit(ranges))


def fingerprints(df: DataFrame, key: str, columns: list[str], ranges: int = 1024) -> DataFrame:
    """(range, n, first, second): rows and sums of two hashes of the key and ``columns`` as text (null as '')."""
    row = _cells([key, *columns])
    one, two = F.xxhash64(*row), F.xxhash64(F.lit("second"), *reversed(row))
    exact = lambda h: F.sum(h.cast("decimal(20,0)"))
    return df.groupBy(key_range(key, ranges).alias("range")).agg(F.count(F.lit(1)).alias("n"), exact(one).alias("first"), exact(two).alias("second"))


def differing_ranges(left: DataFrame, right: DataFrame, key: str, columns: list[str], ranges: int = 1024) -> DataFrame:
    """(range, left_n, right_n) of the ranges in which the tables differ; one scan of each."""
    side = lambda df, p: fingerprints(df, key, columns, ranges).select("range", F.col("n").alias(f"{p}_n"), F.struct("n", "first", "second").alias(p))
    both = side(left, "left").join(side(right, "right"), "range", "full_outer")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    return both.where(~F.col("left").eqNullSafe(F.col("right"))).select("range", zero("left_n"), zero("right_n"))


def row_differences(left: DataFrame, right: DataFrame, key: str, columns: list[str], ranges: int = 1024) -> DataFrame:
    """(key, kind, n): rows that one side holds more often, in the ranges that differ.

    ``lost`` and ``extra`` are rows of a key that the other side has not so often, ``changed`` those of a key with as many
    rows on both sides but other cells. A row that stands more often than on the other side is lost or extra by the difference.
    """
    off = differing_ranges(left, right, key, columns, ranges).select("range")

    def rows(df: DataFrame, sign: int) -> DataFrame:
        cells = df.select(text(key).alias(key), F.struct(*(text(c).alias(c) for c in columns)).alias("cells"), key_range(key, ranges).alias("range"))
        return cells.join(off, "range", "left_semi").select(key, "cells", F.lit(sign).alias("sign"))

    apart = rows(left, 1).unionByName(rows(right, -1)).groupBy(key, "cells").agg(F.sum("sign").alias("d")).where("d <> 0")
    by_key = apart.groupBy(key).agg(F.sum(F.when(F.col("d") > 0, F.col("d")).otherwise(0)).alias("less"), F.sum(F.when(F.col("d") < 0, -F.col("d")).otherwise(0)).alias("more"))
    changed = F.least("less", "more")
    found = F.array(*(F.struct(F.lit(kind).alias("kind"), n.cast("long").alias("n")) for kind, n in (("changed", changed), ("lost", F.col("less") - changed), ("extra", F.col("more") - changed))))
    return by_key.select(key, F.explode(found).alias("x")).select(key, "x.*").where("n > 0")


def parity_errors(left: DataFrame, right: DataFrame, key: str, columns: list[str], ranges: int = 1024) -> DataFrame:
    """(error, n) of the gate: rows changed, lost and extra; no row if the tables are equal."""
    return row_differences(left, right, key, columns, ranges).groupBy(F.col("kind").alias("error")).agg(F.sum("n").alias("n"))
