"""Live facet counts from a bitmap index: one scan builds it, answers read bitmaps alone.

Parents get places 1..n in the order of their key; a row of the index is (facet, source, value, bucket, bits), the parents of
one value and source in one bucket of 32,768 places. Values chosen within a facet are or-ed, facets are and-ed, and what is left is
counted per value. A parent that holds a value by two chosen sources is one bit, so it counts once. Buckets are
independent: work is spread by (value, bucket), and no answer scans parents.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .statistics import places

#: Places of a bucket, fixed by Spark's bitmap functions.
BITS = 32_768
INDEX = ["facet", "source", "value", "bucket", "bits"]


def number(parents: DataFrame, key: str) -> DataFrame:
    """``parents`` with ``place`` from 1 in the order of ``key``."""
    placed, _ = places(parents, [key])
    return placed.withColumn("place", F.col("_place") + 1).drop("_place")


def build(numbered: DataFrame, facets: dict[str, dict[str, Column]]) -> DataFrame:
    """The index of ``facets`` (facet -> source -> array of values) over numbered parents; null and empty values have no bit."""
    none = F.array().cast("array<string>")
    entry = lambda facet, source: lambda v: F.struct(F.lit(facet).alias("facet"), F.lit(source).alias("source"), v.alias("value"))
    held = [F.transform(F.coalesce(values.cast("array<string>"), none), entry(facet, source)) for facet, by_source in facets.items() for source, values in by_source.items()]
    each = numbered.select("place", F.explode(F.filter(F.concat(*held), lambda x: F.coalesce(x["value"], F.lit("")) != "")).alias("x"))
    return each.groupBy("x.facet", "x.source", "x.value", F.expr("bitmap_bucket_number(place)").alias("bucket")).agg(F.expr("bitmap_construct_agg(bitmap_bit_position(place))").alias("bits"))


def _of(index: DataFrame, facet: str, sources: list[str] | None) -> DataFrame:
    found = index.where(F.col("facet") == facet)
    return found if sources is None else found.where(F.col("source").isin(*sources))


def chosen(index: DataFrame, choices: dict[str, tuple[list[str] | None, list[str]]]) -> DataFrame | None:
    """(bucket, bits) of the parents that hold, in every facet, one of its values by one of its sources (None: any); None if nothing is chosen.

    A facet without values asks nothing. A bucket in which a facet has no parent has no row.
    """
    asked = {f: (s, v) for f, (s, v) in choices.items() if v}
    parts = None
    for facet, (sources, values) in asked.items():
        one = _of(index, facet, sources).where(F.col("value").isin(*values)).groupBy("bucket").agg(F.expr("bitmap_or_agg(bits)").alias("bits"))
        parts = one if parts is None else parts.unionByName(one)
    if parts is None:
        return None
    both = parts.groupBy("bucket").agg(F.count(F.lit(1)).alias("n"), F.expr("bitmap_and_agg(bits)").alias("bits"))
    return both.where(F.col("n") == len(asked)).drop("n")


def live_counts(index: DataFrame, facet: str, sources: list[str] | None = None, choices: dict[str, tuple[list[str] | None, list[str]]] | None = None) -> DataFrame:
    """(value, n): parents that hold each value of ``facet`` by one of ``sources`` and fit ``choices``; every value of the facet, zeros kept."""
    values = index.where(F.col("facet") == facet).select("value").distinct()
    by_value = _of(index, facet, sources).groupBy("value", "bucket").agg(F.expr("bitmap_or_agg(bits)").alias("bits"))
    fit = chosen(index, choices or {})
    if fit is not None:
        both = by_value.join(fit.withColumnRenamed("bits", "fit"), "bucket").select("value", "bucket", F.explode(F.array("bits", "fit")).alias("bits"))
        by_value = both.groupBy("value", "bucket").agg(F.expr("bitmap_and_agg(bits)").alias("bits"))
    counted = by_value.groupBy("value").agg(F.sum(F.expr("bitmap_count(bits)")).alias("n"))
    return values.join(counted, "value", "left").select("value", F.coalesce("n", F.lit(0)).cast("long").alias("n"))


def coverage(index: DataFrame, facet: str) -> DataFrame:
    """(source, n): parents with any value of ``facet`` by each source, and by any ('')."""
    found = _of(index, facet, None)
    each = found.select("bucket", "bits", F.explode(F.array("source", F.lit(""))).alias("source"))
    any_ = each.groupBy("source", "bucket").agg(F.expr("bitmap_or_agg(bits)").alias("bits"))
    return any_.groupBy("source").agg(F.sum(F.expr("bitmap_count(bits)")).cast("long").alias("n"))


def fitting(numbered: DataFrame, index: DataFrame, choices: dict[str, tuple[list[str] | None, list[str]]]) -> DataFrame:
    """The numbered parents that fit ``choices``: their bit is looked up in their bucket's bitmap."""
    fit = chosen(index, choices)
    if fit is None:
        return numbered
    at = F.expr("bitmap_bit_position(place)")
    byte = F.conv(F.hex(F.substr(F.col("bits"), F.floor(at / 8).cast("int") + 1, F.lit(1))), 16, 10).cast("int")
    bit = F.expr("shiftright(_byte, cast(bitmap_bit_position(place) % 8 AS INT)) & 1")
    held = numbered.withColumn("bucket", F.expr("bitmap_bucket_number(place)")).join(fit, "bucket").withColumn("_byte", byte)
    return held.where(bit == 1).select(*numbered.columns)
