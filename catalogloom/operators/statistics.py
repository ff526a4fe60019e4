"""Sampling and agreement statistics over distributed counts."""

from __future__ import annotations

import heapq
import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..sources.tables import checkpointed

Z = 1.96


def allocate(sizes: dict[str, int], total: int, minimum: int) -> dict[str, int]:
    """Square-root allocation over strata: at least ``minimum``, at most the stratum, ``total`` in sum.

    Shares are rounded half to even. What is over or short is dealt a unit at a time to the strata sorted by how far
    the rounding took them from their share, ties by name; a stratum at its bound is passed over.
    """
    roots = {h: math.sqrt(n) for h, n in sizes.items()}
    aim = min(total, sum(sizes.values()))
    share = {h: aim * r / sum(roots.values()) for h, r in roots.items()}
    bounds = {h: (min(minimum, n), n) for h, n in sizes.items()}
    given = {h: max(min(minimum, n), min(n, max(minimum, round(share[h])))) for h, n in sizes.items()}
    missing = aim - sum(given.values())
    step = 1 if missing > 0 else -1
    # The stratum furthest off in the direction of the step comes first; a step moves it back by one.
    place = {h: i for i, h in enumerate(sorted(sizes, reverse=step > 0))}
    queue = [((given[h] - share[h]) * step, place[h], h) for h in sizes]
    heapq.heapify(queue)
    while missing and queue:
        off, tie, h = heapq.heappop(queue)
        if given[h] != bounds[h][step > 0]:
            given[h] += step
            missing -= step
            heapq.heappush(queue, (off + 1, tie, h))
    return given


def hash_order(seed: str, *keys: str) -> Column:
    """A place in a random order that any engine can recompute."""
    return F.md5(F.concat_ws(":", F.lit(seed), *keys))


def first_by_hash(df: DataFrame, stratum: str, key: str, wanted: DataFrame, seed: str, digits: int = 3) -> DataFrame:
    """Of each stratum the first rows in hash order, as many as ``wanted`` (stratum, _wanted) says; ties by key.

    Rows are counted by stratum and the hash's first hex digits, with a map-side combine. A stratum's counts tell the
    bucket in which its last row lies: buckets before it are taken whole, those after it not read again, and only rows
    of that one bucket are ordered, 1 / 16**digits of the stratum.
    """
    hashed = df.withColumn("_h", hash_order(seed, key)).withColumn("_b", F.substring("_h", 1, digits))
    counts = hashed.groupBy(F.col(stratum).alias("_s"), F.col("_b").alias("_c")).agg(F.count(F.lit(1)).alias("_n"))
    before = F.coalesce(F.sum("_n").over(Window.partitionBy("_s").orderBy("_c").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    buckets = counts.withColumn("_before", before).join(wanted.withColumnRenamed(stratum, "_s"), "_s").where("_before < _wanted").withColumn("_left", F.col("_wanted") - F.col("_before"))
    held = hashed.join(buckets, F.col(stratum).eqNullSafe(F.col("_s")) & (F.col("_b") == F.col("_c")))
    whole = held.where("_n <= _left")
    rank = F.row_number().over(Window.partitionBy("_s", "_c").orderBy("_h", key))
    edge = held.where("_n > _left").withColumn("_rank", rank).where("_rank <= _left").drop("_rank")
    return whole.unionByName(edge).drop("_h", "_b", "_s", "_c", "_n", "_before", "_wanted", "_left")


def _in_step(place: Column, step: Column, start: float, take: Column) -> Column:
    """Whether a place is floor(start * step + j * step) for a j from 0 to ``take`` - 1.

    The division that finds j may end a last digit above or below the whole number, so its neighbours are tried too.
    """
    near = F.ceil((place - start * step) / step)
    fits = lambda j: (place == F.floor(start * step + j * step)) & (j >= 0) & (j < take)
    return fits(near) | fits(near - 1) | fits(near + 1)


def systematic_within(df: DataFrame, stratum: str, spread: str, key: str, given: dict[str, tuple[int, int]], seed: str, start: float = 0.5) -> DataFrame:
    """Of each stratum every (N/n)-th row in the order of ``spread``, equal values in hash order; ``given`` maps strata to (N, n).

    All rows are placed at once in the order (stratum, spread, hash) over ranges; a stratum's places begin after those of the strata before it.
    """
    placed, _ = places(df.withColumn("_h", hash_order(seed, key)), [stratum, spread, "_h", key])
    rows, before = [], 0
    for name in sorted(given, key=lambda x: x.encode()):
        size, n = given[name]
        if n:
            rows.append((name, before, size / n, n))
        before += size
    table = df.sparkSession.createDataFrame(rows, "_s string, _first long, _step double, _take long")
    held = placed.join(F.broadcast(table), F.col(stratum) == F.col("_s"))
    fits = _in_step(F.col("_place") - F.col("_first"), F.col("_step"), start, F.col("_take"))
    return held.where(fits).drop("_place", "_h", "_s", "_first", "_step", "_take")


def stratified_sample(df: DataFrame, stratum: str, key: str, total: int, minimum: int, seed: str, spread: str | None = None) -> DataFrame:
    """Allocated numbers of rows per stratum, with stratum size, sample size and weight (a sampling operator).

    The rows are the first in hash order or, with ``spread``, systematic in its order. No task holds a stratum.
    """
    sizes = {r[stratum]: r["n"] for r in df.groupBy(stratum).agg(F.count(F.lit(1)).alias("n")).orderBy(stratum).collect()}  # strata, not rows
    given = allocate(sizes, total, minimum)
    rows = [(h, sizes[h], given[h]) for h in sizes]
    table = df.sparkSession.createDataFrame(rows, f"{stratum} string, stratum_size long, stratum_sample long")
    if spread:
        picked = systematic_within(df, stratum, spread, key, {h: (sizes[h], given[h]) for h in sizes}, seed)
    else:
        picked = first_by_hash(df, stratum, key, table.select(stratum, F.col("stratum_sample").alias("_wanted")), seed)
    return picked.join(F.broadcast(table), stratum).withColumn("weight", F.col("stratum_size") / F.col("stratum_sample"))


def places(df: DataFrame, order: list[str], parts: int | None = None) -> tuple[DataFrame, int]:
    """``df`` with ``_place``, its place from 0 in the order of ``order``, and the number of rows.

    The rows are range-partitioned and numbered within partitions; a count per partition shifts the numbers. Written
    once, so that both passes see the same partitions. No task holds more than a partition; ``order`` is best unique.
    """
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = checkpointed(df.repartitionByRange(parts, *order).sortWithinPartitions(*order).withColumn("_part", F.spark_partition_id()).withColumn("_n", F.monotonically_increasing_id()))
    counts = sorted(map(tuple, ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("n"), F.min("_n").alias("first")).collect()))  # partitions, not rows
    shifts, before = [], 0
    for part, n, start in counts:
        shifts.append((part, before - start))
        before += n
    table = df.sparkSession.createDataFrame(shifts, "_part int, _shift long")
    return ranged.join(F.broadcast(table), "_part").withColumn("_place", F.col("_n") + F.col("_shift")).drop("_part", "_n", "_shift"), before


def systematic(df: DataFrame, spread: str, key: str, n: int, start: float = 0.5) -> DataFrame:
    """Every (N/n)-th row in the order of ``spread``: its values appear in proportion."""
    placed, total = places(df, [spread, key])
    if not total:
        return df
    return placed.where(_in_step(F.col("_place"), F.lit(total / n), start, F.lit(n))).drop("_place")


def deal(df: DataFrame, stratum: str, key: str, packages: int, seed: str) -> DataFrame:
    """Package 1..packages per row of a sample, dealt in turn through the strata in hash order."""
    rows = df.withColumn("_h", hash_order(seed, key)).withColumn("_b", F.substring("_h", 1, 2))
    counts = rows.groupBy(F.col(stratum).alias("_s"), F.col("_b").alias("_c")).agg(F.count(F.lit(1)).alias("_n"))
    # One row per stratum and bucket of the hash: the window without partitions orders these alone.
    before = F.sum("_n").over(Window.orderBy("_s", "_c").rowsBetween(Window.unboundedPreceding, -1))
    starts = counts.select("_s", "_c", F.coalesce(before, F.lit(0)).alias("_before"))
    placed = rows.join(F.broadcast(starts), F.col(stratum).eqNullSafe(F.col("_s")) & (F.col("_b") == F.col("_c")))
    within = F.row_number().over(Window.partitionBy(stratum, "_b").orderBy("_h", key)) - 1
    return placed.withColumn("package", (F.col("_before") + within) % packages + 1).drop("_h", "_b", "_s", "_c", "_before")


def wilson(p: Column, n: Column, z: float = Z) -> Column:
    """struct<lo, hi>: the score interval of a share, (0, 1) without observations."""
    centre, spread, scale = p + z * z / (2 * n), z * F.sqrt(p * (1 - p) / n + z * z / (4 * n * n)), 1 + z * z / n
    return F.when(n > 0, F.struct(F.greatest(F.lit(0.0), (centre - spread) / scale).alias("lo"), F.least(F.lit(1.0), (centre + spread) / scale).alias("hi"))).otherwise(F.struct(F.lit(0.0).alias("lo"), F.lit(1.0).alias("hi")))


def stratified_rate(df: DataFrame, stratum: str = "stratum", size: str = "stratum_size", eligible: str = "eligible", error: str = "error") -> DataFrame:
    """Errors over eligible, weighted by stratum; linearised variance with finite-population correction, Wilson interval on the effective number.

    One pass gives each stratum's sums and cross products; the variance of error - rate * eligible follows from them.
    """
    e, x = F.col(eligible).cast("double"), F.col(error).cast("double")
    h = df.groupBy(stratum).agg(F.max(size).cast("double").alias("big"), F.count(F.lit(1)).cast("double").alias("n"), F.sum(e).alias("e"), F.sum(x).alias("x"), F.sum(e * e).alias("ee"), F.sum(x * x).alias("xx"), F.sum(e * x).alias("ex"))
    all_ = h.agg(F.sum("e").alias("eligible"), F.sum("x").alias("errors"), F.sum(F.col("x") * F.col("big") / F.col("n")).alias("xw"), F.sum(F.col("e") * F.col("big") / F.col("n")).alias("ew"))
    rate = F.col("xw") / F.col("ew")
    mean = (F.col("x") - rate * F.col("e")) / F.col("n")
    square = F.col("xx") - 2 * rate * F.col("ex") + rate * rate * F.col("ee")
    var_u = (square - F.col("n") * mean * mean) / (F.col("n") - 1)
    part = F.when(F.col("n") > 1, F.col("big") * F.col("big") * (1 - F.col("n") / F.col("big")) * var_u / F.col("n")).otherwise(0.0)
    totals = h.join(F.broadcast(all_.withColumnsRenamed({"eligible": "eligible_", "errors": "errors_"}))).agg(F.first("eligible_").alias("eligible"), F.first("errors_").alias("errors"), F.first(rate).alias("weighted_rate"), (F.sum(part) / F.first(F.col("ew") * F.col("ew"))).alias("variance"))
    n_eff = F.when(F.col("variance") > 1e-15, F.col("weighted_rate") * (1 - F.col("weighted_rate")) / F.col("variance")).otherwise(F.col("eligible"))
    ci = wilson(F.col("weighted_rate"), n_eff)
    return totals.select(F.col("eligible").cast("long").alias("eligible"), F.col("errors").cast("long").alias("errors"), (F.col("errors") / F.col("eligible")).alias("rate"), "weighted_rate", ci["lo"].alias("lo"), ci["hi"].alias("hi"))


def jaccard(a: Column, b: Column) -> Column:
    """Shared share of two sets; 1 for two empty ones."""
    union = F.size(F.array_union(a, b))
    return F.when(union == 0, 1.0).otherwise(F.size(F.array_intersect(a, b)) / union)


def masi_distance(a: Column, b: Column) -> Column:
    """1 - Jaccard x monotonicity: 1 for equal sets, 2/3 for a subset, 1/3 for an overlap."""
    only_a, only_b, shared = F.size(F.array_except(a, b)), F.size(F.array_except(b, a)), F.size(F.array_intersect(a, b))
    monotone = F.when((only_a == 0) | (only_b == 0), 2 / 3).otherwise(1 / 3)
    return F.when((only_a == 0) & (only_b == 0), 0.0).when(shared == 0, 1.0).otherwise(1 - jaccard(a, b) * monotone)


def kappa(df: DataFrame, a: str, b: str) -> DataFrame:
    """Cohen's kappa (n, agreement, kappa) of two columns, from the counts of their pairs of values."""
    pairs = df.where(F.col(a).isNotNull() & F.col(b).isNotNull()).groupBy(F.col(a).cast("string").alias("a"), F.col(b).cast("string").alias("b")).agg(F.count(F.lit(1)).alias("n"))
    left, right = pairs.groupBy(F.col("a").alias("v")).agg(F.sum("n").alias("na")), pairs.groupBy(F.col("b").alias("v")).agg(F.sum("n").alias("nb"))
    chance = left.join(right, "v").agg(F.coalesce(F.sum(F.col("na") * F.col("nb")), F.lit(0)).cast("double").alias("both"))
    total = pairs.agg(F.sum("n").cast("double").alias("n"), F.coalesce(F.sum(F.when(F.col("a") == F.col("b"), F.col("n"))), F.lit(0)).cast("double").alias("same"))
    po, pe = F.col("same") / F.col("n"), F.col("both") / (F.col("n") * F.col("n"))
    value = F.when(F.abs(1 - pe) < 1e-12, F.when(F.abs(1 - po) < 1e-12, 1.0).otherwise(0.0)).otherwise((po - pe) / (1 - pe))
    return total.join(chance).select(F.coalesce("n", F.lit(0.0)).cast("long").alias("n"), po.alias("agreement"), F.when(F.col("n") > 0, value).alias("kappa"))


def krippendorff_alpha(df: DataFrame, unit: str, value: str, distance=None) -> DataFrame:
    """Krippendorff's alpha (n, alpha) over units with two values or more; the distance defaults to nominal.

    Pairs are formed between distinct values with their counts, never between answers.
    """
    delta = distance or (lambda a, b: F.when(a == b, 0.0).otherwise(1.0))
    rows = df.where(F.col(value).isNotNull())
    counts = rows.groupBy(unit, value).agg(F.count(F.lit(1)).alias("n"))
    sizes = counts.groupBy(unit).agg(F.sum("n").alias("m")).where("m > 1")
    counts = counts.join(sizes, unit)
    a, b = counts.alias("a"), counts.alias("b")
    within = a.join(b, F.col(f"a.{unit}") == F.col(f"b.{unit}"))
    weight = F.col("a.n") * F.col("b.n") / (F.col("a.m") - 1)
    observed = within.agg(F.sum(weight * delta(F.col(f"a.{value}"), F.col(f"b.{value}"))).alias("observed"))
    totals = counts.groupBy(value).agg(F.sum("n").cast("double").alias("n"))
    # Values are a vocabulary: their table is small whatever the number of answers.
    v, w = totals.withColumn("k", F.lit(1)).alias("v"), totals.withColumn("k", F.lit(1)).alias("w")
    expected = v.join(w, "k").agg(F.sum(F.col("v.n") * F.col("w.n") * delta(F.col(f"v.{value}"), F.col(f"w.{value}"))).alias("expected"))
    n = totals.agg(F.sum("n").alias("n"))
    do, de = F.col("observed") / F.col("n"), F.col("expected") / (F.col("n") * (F.col("n") - 1))
    return observed.join(expected).join(n).select(F.col("n").cast("long").alias("n"), F.when(F.col("n") < 2, None).when(de == 0, F.when(do == 0, 1.0)).otherwise(1 - do / de).alias("alpha"))


def micro_prf(df: DataFrame, predicted: str, reference: str) -> DataFrame:
    """Micro precision, recall and F1 of set columns."""
    sums = df.agg(F.sum(F.size(F.array_intersect(predicted, reference))).alias("tp"), F.sum(F.size(F.array_except(predicted, reference))).alias("fp"), F.sum(F.size(F.array_except(reference, predicted))).alias("fn"))
    p, r = F.try_divide("tp", F.col("tp") + F.col("fp")), F.try_divide("tp", F.col("tp") + F.col("fn"))
    return sums.select("tp", "fp", "fn", p.alias("precision"), r.alias("recall"), F.when(p.isNotNull() & r.isNotNull(), F.when(p + r == 0, 0.0).otherwise(2 * p * r / (p + r))).alias("f1"))
