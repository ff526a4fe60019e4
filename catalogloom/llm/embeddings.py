"""Embedding near-duplicates by an epsilon grid order join.

Vectors with cosine >= ``threshold`` are within eps = sqrt(2 - 2 * threshold) of each other on the unit sphere.
Unit vectors are rotated to principal directions (of a bounded sample, which only steers the pruning) and
sorted by their grid cells of side eps on the leading dimensions. The sorted sequence is cut into blocks of at
most about ``block`` vectors; two blocks meet if the boxes of their leading coordinates are within eps, found
by an equi-join of the first two dimensions' cells. A pair of blocks is joined recursively: intervals of the
sequence whose boxes are further apart than eps are skipped, others are halved, and small ones are compared by
dot products in double precision, so no link is lost and none below the threshold is made.

Equal vectors are reduced to one first. Each task has two blocks at most, whatever the cells hold, and returns a
count of links per vector and links that span its components, never the pairs. Null, empty, zero and non-finite
vectors link with nothing; vectors of different lengths do not link with each other. Lengths other than the most
common one are sorted by their own leading coordinates, in the same blocks. Rows without an id, with the same id
or repeated whole are vectors like others; a component without any id has none.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut
from .graph import components

LEAF = 256


def _matrix(column) -> np.ndarray:
    flat = column.flatten() if isinstance(column, pa.Array) else column.combine_chunks().flatten()
    return flat.to_numpy(zero_copy_only=False).reshape(len(column), -1).astype(np.float64)


class EgoJoin:
    """Links within a sequence of vectors in epsilon grid order, or between two."""

    def __init__(self, x: np.ndarray, lead: np.ndarray, weight: np.ndarray, threshold: float):
        self.x, self.lead, self.weight, self.threshold = x, lead, weight, threshold
        self.norm = np.sqrt((x * x).sum(1))
        self.eps2 = (2 - 2 * threshold) * (1 + 1e-9) + 1e-12
        self.links = np.zeros(len(x))
        self.root = np.arange(len(x))
        self.boxes: dict[tuple[int, int], tuple[np.ndarray, np.ndarray]] = {}

    def box(self, lo: int, hi: int):
        if (lo, hi) not in self.boxes:
            part = self.lead[lo:hi]
            self.boxes[lo, hi] = part.min(0), part.max(0)
        return self.boxes[lo, hi]

    def find(self, k: int) -> int:
        while self.root[k] != k:
            self.root[k] = self.root[self.root[k]]
            k = self.root[k]
        return k

    def leaf(self, a: int, b: int, c: int, d: int) -> None:
        near = (self.x[a:b] @ self.x[c:d].T) / self.norm[a:b, None] / self.norm[None, c:d] >= self.threshold
        if a == c:
            np.fill_diagonal(near, False)
        if not near.any():
            return
        self.links[a:b] += near @ self.weight[c:d]
        if a != c:
            self.links[c:d] += near.T @ self.weight[a:b]
        # The least place that each row and column reaches within this leaf.
        rows, cols = np.arange(a, b), np.arange(c, d)
        while True:
            new_cols = np.minimum(cols, np.where(near, rows[:, None], len(self.x)).min(0))
            new_rows = np.minimum(rows, np.where(near, new_cols[None, :], len(self.x)).min(1))
            if (new_cols == cols).all() and (new_rows == rows).all():
                break
            rows, cols = new_rows, new_cols
        for at, low in ((np.arange(a, b), rows), (np.arange(c, d), cols)):
            for k, m in zip(at[low < at].tolist(), low[low < at].tolist(), strict=True):
                p, q = self.find(k), self.find(m)
                self.root[max(p, q)] = min(p, q)

    def join(self, a: int, b: int, c: int, d: int) -> None:
        """All links between [a, b) and [c, d): the same interval, or one wholly before the other."""
        todo = [(a, b, c, d)]
        while todo:
            a, b, c, d = todo.pop()
            if a >= b or c >= d:
                continue
            if a != c:
                (low, high), (low2, high2) = self.box(a, b), self.box(c, d)
                gap = np.maximum(0, np.maximum(low - high2, low2 - high))
                if gap @ gap > self.eps2:
                    continue
            if b - a <= LEAF and d - c <= LEAF:
                self.leaf(a, b, c, d)
            elif a == c:
                m = (a + b) // 2
                todo += [(a, m, a, m), (a, m, m, b), (m, b, m, b)]
            elif b - a >= d - c:
                m = (a + b) // 2
                todo += [(a, m, c, d), (m, b, c, d)]
            else:
                m = (c + d) // 2
                todo += [(a, b, c, m), (a, b, m, d)]


def near_duplicates(df: DataFrame, threshold: float = 0.95, block: int = 4096, lead: int = 8, sample: int = 4096, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(vec_id, n_links, component_id, kept) of every row; see the module for vectors that link with nothing."""
    rows = df.select(F.col(id_col).cast("long").alias("vec_id"), F.col(vector_col).cast("array<double>").alias("v"))
    fine = F.col("v").isNotNull() & (F.size("v") > 0) & F.forall("v", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < math.inf)) & F.exists("v", lambda x: x != 0)
    good = rows.where(fine)
    width = good.groupBy(F.size("v").alias("n")).count().orderBy(F.desc("count"), "n").first()
    if width is None:
        return rows.select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"), F.lit(True).alias("kept"))
    found = good.groupBy("v").agg(F.min("vec_id").alias("least_id"), F.count(F.lit(1)).alias("copies"))
    kinds = cut(found.withColumn("id", F.monotonically_increasing_id()))
    total = kinds.count()

    picked = kinds.where(F.size("v") == width["n"]).where(F.pmod(F.xxhash64("id"), F.lit(1 << 30)) < int((1 << 30) * min(1.0, sample / total))).select("v").limit(2 * sample).toPandas()["v"]
    head = np.array(picked.tolist() or [[1.0] * width["n"]], float)
    head /= np.abs(head).max(1, keepdims=True)
    head /= np.sqrt((head * head).sum(1, keepdims=True))
    turn = np.linalg.eigh(head.T @ head)[1][:, ::-1][:, : min(lead, width["n"])].copy()
    eps = math.sqrt(2 - 2 * threshold) if threshold < 1 else 1e-6
    shared = df.sparkSession.sparkContext.broadcast(turn)

    def place(batches):
        turn = shared.value
        for batch in batches:
            sizes = pc.list_value_length(batch.column("v")).to_numpy(zero_copy_only=False)
            for size in np.unique(sizes).tolist():
                b = batch.filter(pa.array(sizes == size))
                x = _matrix(b.column("v"))
                x = x / np.abs(x).max(1, keepdims=True)
                unit = x / np.sqrt((x * x).sum(1, keepdims=True))
                p = np.zeros((len(x), turn.shape[1]))
                if size == len(turn):
                    p[:] = unit @ turn
                else:
                    p[:, : min(size, p.shape[1])] = unit[:, : p.shape[1]]
                cell = np.floor(p / eps).astype(np.int32)
                lists = [pa.array(m.tolist(), pa.list_(t)) for m, t in ((x, pa.float64()), (p, pa.float64()), (cell, pa.int32()))]
                yield pa.RecordBatch.from_arrays([b.column("id"), b.column("copies"), pa.array(np.full(len(x), size, np.int32)), *lists], names=["id", "copies", "width", "v", "p", "cell"])

    placed = kinds.select("id", "copies", "v").mapInArrow(place, "id long, copies long, width int, v array<double>, p array<double>, cell array<int>")
    n_blocks = max(1, math.ceil(total / block))
    ordered = placed.repartitionByRange(n_blocks, "width", "cell", "id").sortWithinPartitions("width", "cell", "id")
    ordered = cut(ordered.withColumn("block", F.spark_partition_id()).withColumn("place", F.monotonically_increasing_id()))

    # Blocks that may hold links: boxes within eps on every leading dimension.
    dims = range(turn.shape[1])
    boxes = ordered.groupBy("block").agg(F.array(*(F.min(F.col("p")[k]) for k in dims)).alias("low"), F.array(*(F.max(F.col("p")[k]) for k in dims)).alias("high"))
    cells = lambda k, reach: F.explode(F.sequence(F.floor((F.col("low")[k] - reach) / eps).cast("int"), F.floor((F.col("high")[k] + reach) / eps).cast("int")))
    spread = lambda reach: boxes.select("block", "low", "high", cells(0, reach).alias("c0")).select("*", cells(min(1, len(dims) - 1), reach).alias("c1"))
    a, b = spread(eps).alias("a"), spread(0.0).alias("b")
    met = a.join(b, (F.col("a.c0") == F.col("b.c0")) & (F.col("a.c1") == F.col("b.c1")) & (F.col("a.block") <= F.col("b.block")))
    gap = lambda k: F.greatest(F.lit(0.0), F.col("a.low")[k] - F.col("b.high")[k], F.col("b.low")[k] - F.col("a.high")[k])
    distance = sum((gap(k) * gap(k) for k in dims), F.lit(0.0))
    pairs = met.where((F.col("a.block") == F.col("b.block")) | (distance <= eps * eps * (1 + 1e-9) + 1e-12)).select(F.col("a.block").alias("x"), F.col("b.block").alias("y")).distinct()
    sides = pairs.select("x", "y", F.explode(F.array_distinct(F.array("x", "y"))).alias("block"))
    dealt = ordered.join(F.broadcast(sides) if n_blocks <= 256 else sides, "block").select("x", "y", "block", "place", "id", "copies", "width", "v", "p")

    def join_width(t: pa.Table) -> pa.Table:
        of, ids = t["block"].to_numpy(), t["id"].to_numpy()
        ego = EgoJoin(_matrix(t["v"]), _matrix(t["p"]), t["copies"].to_numpy().astype(float), threshold)
        if t["x"][0].as_py() == t["y"][0].as_py():
            ego.join(0, len(of), 0, len(of))
        else:
            n = int(np.searchsorted(of, t["y"][0].as_py()))
            ego.join(0, n, n, len(of))
        root = np.array([ego.find(k) for k in range(len(of))], np.int64)
        on = np.flatnonzero(ego.links)
        return pa.table({"id": ids[on], "links": ego.links[on].astype(np.int64), "root": ids[root[on]]})

    def join(t: pa.Table) -> pa.Table:
        t = t.sort_by([("block", "ascending"), ("place", "ascending")]).combine_chunks()
        return pa.concat_tables([join_width(t.filter(pc.equal(t["width"], size)).combine_chunks()) for size in pc.unique(t["width"])])

    linked = cut(dealt.groupBy("x", "y").applyInArrow(join, "id long, links long, root long"))
    found = components(linked.select(F.col("id").alias("a"), F.col("root").alias("b")))
    links = linked.groupBy("id").agg(F.sum("links").alias("links"))
    linked_kinds = kinds.join(found, kinds["id"] == found["node"]).select("id", "component", "least_id")
    low = linked_kinds.groupBy("component").agg(F.min("least_id").alias("least"))
    named = linked_kinds.join(low, "component").select("id", F.lit(True).alias("linked"), "least")
    by_kind = kinds.join(links, "id", "left").join(named, "id", "left")
    component = F.when(F.col("linked"), F.col("least")).otherwise(F.col("least_id"))
    by_kind = by_kind.select("v", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), component.alias("component_id"))
    done = good.join(by_kind, "v").select("vec_id", "n_links", "component_id")
    rest = rows.where(~F.coalesce(fine, F.lit(False))).select("vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id"))
    return done.unionByName(rest).withColumn("kept", F.col("vec_id").eqNullSafe(F.col("component_id")))
