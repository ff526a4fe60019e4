"""SimHash near-duplicates through a hierarchical index in Gray order.

Fingerprints: 4-word shingles of the text (A-Z lower-cased, words between ASCII white space), each hashed by
XXH64 with seed 42; a bit is 1 if set in over half the hashes. Texts without words (null, empty) have
fingerprint zero and are linked like any other.

Links (at most ``MAX_BITS`` differing bits) are found among distinct fingerprints only. The upper level of
the index are shared masked bit patterns: of six blocks of bits, two fingerprints that differ in at most
four bits agree on two, so each pair shares one of 15 (mask, pattern) nodes. The whole table of (mask,
fingerprint) rows is sorted by the Gray ranks of the pattern and of the fingerprint, so that a node is a run
of rows; nodes with one fingerprint are left out before. A run is factored into nested groups of shared bits;
pairs of groups whose shared bits differ too often are pruned, those that cannot differ often enough are
linked whole, and the rest is worked off in bounded slices.

A node with over ``cap`` fingerprints is not gathered: what its fingerprints share up to four neighbouring
bits is linked first, a node that is one component by then is pruned whole, and any other is split by further
blocks of its free bits (again one of five must agree). So no group is unbounded, none is cut, and no pair is
lost. Copies are never expanded into pairs: a node gives links that span its components.

Rows that repeat an id or a whole row are rows like any other. Rows without an id get a fingerprint and the
component of the others that they reach (null if none of it has an id).
"""

from __future__ import annotations

import math
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut, map_batches, texts
from .graph import components

MAX_BITS, SHINGLE, SEED = 4, 4, 42
ALL = (1 << 64) - 1


def signed(x: int) -> int:
    return x - (1 << 64) if x >> 63 else x


def fingerprint(text: str) -> int:
    words = text.encode("utf-8", "surrogatepass").lower().split()  # bytes: ASCII letters and white space only
    if not words:
        return 0
    line = b" ".join(words)
    sizes = np.fromiter(map(len, words), np.int64, len(words))
    starts = np.concatenate([[0], np.cumsum(sizes + 1)[:-1]])
    ends = starts + sizes
    k = min(SHINGLE, len(words))
    hash_ = xxhash.xxh64_intdigest
    pairs = zip(starts[: len(words) - k + 1].tolist(), ends[k - 1 :].tolist(), strict=True)
    h = np.fromiter((hash_(line[a:b], SEED) for a, b in pairs), np.uint64, len(words) - k + 1)
    ones = np.zeros(64, np.int64)
    for at in range(0, len(h), 1 << 16):
        part = h[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1).sum(0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * ones > len(h)).tobytes(), "big")


def gray_rank(x: np.ndarray) -> np.ndarray:
    """Place of each code in Gray order."""
    x = x.copy()
    for s in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(s)
    return x


def _gray(c: Column) -> Column:
    """Place of a code in Gray order, as a signed number."""
    for s in (1, 2, 4, 8, 16, 32):
        c = c.bitwiseXOR(F.shiftrightunsigned(c, s))
    return c


def _merge(root: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the components of a[k] and b[k]; each place of ``root`` names its component's least place, before and after."""
    while len(a):
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        on = low != high
        a, b = a[on], b[on]
        np.minimum.at(root, high[on], low[on])
        while not (root[root] == root).all():
            root[:] = root[root]


def spanning_links(x: np.ndarray, limit: int = MAX_BITS, fan: int = 16, slice_: int = 256) -> np.ndarray:
    """For each of the distinct codes ``x`` in Gray order, the least place of its component under links of at most ``limit`` bits."""
    n = len(x)
    levels, both, any_ = [], x, x
    while True:
        levels.append((both, any_))
        if len(both) == 1:
            break
        cuts = np.arange(0, len(both), fan)
        both, any_ = np.bitwise_and.reduceat(both, cuts), np.bitwise_or.reduceat(any_, cuts)
    root, step = np.arange(n), np.arange(fan)
    todo = [(len(levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))]
    while todo:
        depth, i, j = todo.pop()
        if depth and len(i) > slice_:
            todo += [(depth, i[slice_:], j[slice_:])]
            i, j = i[:slice_], j[:slice_]
        both, any_ = levels[depth]
        shared = ~(both ^ any_)
        sure = np.bitwise_count((both[i] ^ both[j]) & shared[i] & shared[j])
        if not depth:
            ok = (sure <= limit) & (i < j)
            _merge(root, i[ok], j[ok])
            continue
        whole = sure + np.bitwise_count(~(shared[i] & shared[j])) <= limit  # every pair below is a link: all to the first
        width = fan**depth
        for a, b in zip(i[whole].tolist(), j[whole].tolist(), strict=True):
            inner = np.concatenate([np.arange(k * width, min(n, (k + 1) * width)) for k in {a, b}])
            _merge(root, np.full(len(inner), a * width), inner)
        keep, below = (sure <= limit) & ~whole, len(levels[depth - 1][0])
        up = np.broadcast_to((i[keep] * fan)[:, None, None] + step[:, None], (keep.sum(), fan, fan)).ravel()
        down = np.broadcast_to((j[keep] * fan)[:, None, None] + step, (keep.sum(), fan, fan)).ravel()
        ok = (up < below) & (down < below) & (up <= down)
        if ok.any():
            todo.append((depth - 1, up[ok], down[ok]))
    return root


def _blocks(free: list[int], n: int) -> list[int]:
    """Masks of ``n`` nearly equal runs of the bit places ``free``."""
    return [sum(1 << p for p in part.tolist()) for part in np.array_split(np.array(free), n) if len(part)]


def _nodes_of(batches):
    """From rows (mask, bits, fp) in Gray order: links (a, b) that span the components of each node."""

    def links(fp, edge):
        out = [(np.zeros(0, np.int64), np.zeros(0, np.int64))]
        for lo, hi in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            part = fp[lo:hi]
            root = spanning_links(part.view(np.uint64))
            on = np.flatnonzero(root != np.arange(len(part)))
            out.append((part[on], part[root[on]]))
        yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(x)) for x in zip(*out, strict=True)], names=["a", "b"])

    held = np.zeros((3, 0), np.int64)
    for b in batches:
        now = np.concatenate([held, np.stack([b.column(c).to_numpy(zero_copy_only=False) for c in ("mask", "bits", "fp")])], axis=1)
        new = np.flatnonzero((now[:2, 1:] != now[:2, :-1]).any(0)) + 1
        last = int(new[-1]) if len(new) else 0
        if last:
            yield from links(now[2, :last], np.concatenate([[0], new]))
        held = now[:, last:]
    if held.shape[1]:
        yield from links(held[2], np.array([0, held.shape[1]]))


def _star(rows: DataFrame, masks: list[int]) -> DataFrame:
    """Links (a, b) of the fingerprints that agree on one of ``masks`` to the least of them."""
    near = rows.select("fp", F.explode(F.array(*(F.lit(signed(m)) for m in masks))).alias("mask")).withColumn("bits", F.col("fp").bitwiseAND(F.col("mask")))
    first = near.groupBy("mask", "bits").agg(F.min("fp").alias("low"), F.max("fp").alias("high")).where("low <> high")
    return near.join(first, ["mask", "bits"]).where("fp <> low").select(F.col("fp").alias("a"), F.col("low").alias("b"))


def link_components(prints: DataFrame, cap: int = 2048, rows_per_task: int = 1 << 16) -> DataFrame:
    """(fp, component) for the distinct fingerprints ``prints`` (column fp) that have links; component is an fp."""
    spark = prints.sparkSession
    prints = cut(prints.select("fp").where("fp is not null").distinct())
    tasks = max(spark.sparkContext.defaultParallelism, math.ceil(prints.count() / rows_per_task))
    masks = [signed(a | b) for a, b in combinations(_blocks(list(range(64)), 6), 2)]
    keyed = prints.repartition(tasks).select("fp", F.explode(F.array(*map(F.lit, masks))).alias("mask"))
    edges = None
    while True:
        keyed = keyed.withColumn("bits", F.col("fp").bitwiseAND(F.col("mask")))
        nodes = cut(keyed.groupBy("mask", "bits").agg(F.count(F.lit(1)).alias("n")).where("n > 1"))
        small = keyed.join(nodes.where(F.col("n") <= cap), ["mask", "bits"]).select("mask", "bits", "fp")
        ordered = small.repartition("mask", "bits").sortWithinPartitions("mask", _gray(F.col("bits")), _gray(F.col("fp")))
        found = ordered.mapInArrow(_nodes_of, "a long, b long")
        edges = cut((found if edges is None else edges.unionByName(found)).distinct())
        large = nodes.where(F.col("n") > cap)
        if large.isEmpty():
            return components(edges).select(F.col("node").alias("fp"), "component")
        large = cut(keyed.join(large.select("mask", "bits"), ["mask", "bits"]))
        # Whatever agrees on all but four neighbouring bits is linked; nodes of one component then tell nothing new.
        edges = cut(edges.unionByName(_star(large.select("fp").distinct(), [ALL ^ m for m in _blocks(list(range(64)), 16)])).distinct())
        known = components(edges)
        rows = large.join(known, large["fp"] == known["node"], "left").select("fp", "mask", "bits", F.coalesce("component", "fp").alias("comp"))
        open_ = rows.groupBy("mask", "bits").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low <> high").select("mask", "bits")
        # Their free bits in five blocks, of which a linked pair agrees on one.
        finer = {m: [signed(m & ALL | x) for x in _blocks([p for p in range(64) if not m >> p & 1], MAX_BITS + 1)] for m in [r["mask"] for r in large.select("mask").distinct().collect()]}
        table = spark.createDataFrame([(m, x) for m, xs in finer.items() for x in xs], "mask long, finer long")  # masks, not rows
        split = rows.join(open_, ["mask", "bits"]).join(F.broadcast(table), "mask")
        keyed = cut(split.select("fp", F.col("finer").alias("mask")).distinct())


def _classes(df: DataFrame, id_col: str, text_col: str, cap: int) -> tuple[DataFrame, DataFrame]:
    """Rows (doc_id, key, fp), key being an md5 of the text, and fingerprints (fp, component, n rows, first row, least doc_id)."""
    rows = texts(df, id_col, text_col).withColumn("key", F.md5(F.col("text").cast("binary")))

    def fn(batch):
        yield {"doc_id": batch.column("doc_id"), "key": batch.column("key"), "fp": [signed(fingerprint(t)) for t in batch.column("text").to_pylist()]}

    prints = cut(map_batches(rows, fn, "doc_id long, key string, fp long"))
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")
    kinds = cut(prints.groupBy("fp").agg(F.min("doc_id").alias("owner"), F.min(row).alias("first"), F.count(F.lit(1)).alias("n")))
    found = link_components(kinds, cap)
    return prints, kinds.join(found, "fp", "left").withColumn("component", F.coalesce("component", "fp"))


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", cap: int = 2048) -> DataFrame:
    """(doc_id, fingerprint, component_id) of every row; component_id is the smallest doc_id reachable by links."""
    prints, kinds = _classes(df, id_col, text_col, cap)
    lowest = kinds.groupBy("component").agg(F.min("owner").alias("component_id"))
    out = prints.join(kinds.join(lowest, "component").select("fp", "component_id"), "fp")
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def one_of_each(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", cap: int = 2048) -> DataFrame:
    """The rows of ``df`` less those that a group of linked rows has before them: one row of each group stays.

    The first is the one with the smallest id (rows without an id last), then with the least hash of its text; of
    rows that repeat its id and text one stays. The rows that go are written, so Spark broadcasts them if they are few.
    """
    prints, kinds = _classes(df, id_col, text_col, cap)
    groups = kinds.groupBy("component").agg(F.min("first").alias("keep"), F.sum("n").alias("rows")).where("rows > 1")
    grouped = cut(prints.join(kinds.join(groups, "component").select("fp", "keep"), "fp").select("doc_id", "key", "keep"))
    row = F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "key")
    gone = cut(grouped.where(row != F.col("keep")).select(F.col("doc_id").alias("__id"), F.col("key").alias("__key")).distinct())
    again = cut(grouped.where(row == F.col("keep")).groupBy("doc_id", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select(F.col("doc_id").alias("__id"), F.col("key").alias("__key")))
    key = F.md5(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"))
    same = lambda t: F.col(id_col).cast("long").eqNullSafe(t["__id"]) & (key == t["__key"])
    left = df.join(gone, same(gone), "left_anti")
    repeated = left.join(again, same(again), "left_semi").withColumn("__key", key).dropDuplicates([id_col, "__key"]).drop("__key")
    return left.join(again, same(again), "left_anti").unionByName(repeated)
