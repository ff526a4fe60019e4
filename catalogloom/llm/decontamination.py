"""Benchmark decontamination by the q-gram lemma.

Texts are compared as lower-cased words with one space between them. Each benchmark item is cut into
overlapping windows of ``window`` characters (a shorter item is one window). A window of m characters
within k edits of a region of a text shares at least ``m + 1 - q * (k + 1)`` q-grams with it, on diagonals
no further than k apart. So shared q-grams are counted in overlapping bands of 2(k + 1) diagonals; regions
that reach the bound are kept and verified by banded alignment (edits within the band, free ends in the text).
k is ``edits`` times m, and no more than the lemma can bound (q * (k + 1) <= m). Items with fewer than ``short``
characters are searched as they are, between words, without edits.

A benchmark of up to ``block_bytes`` is broadcast and all documents pass it, nothing is shuffled. A larger one is
dealt into blocks of about that size; the documents pass one after the other, and each block's hits are written
before the next block is read, so that one block is in memory at a time. Long texts are read whole, in overlapping
stretches. Null and empty texts have no hits; items without words are left out; of items with one id each is
searched; documents that repeat get their hits each time.
"""

from __future__ import annotations

import math
import re
from dataclasses import dataclass
from functools import reduce

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, with_columns

Q, STRETCH = 10, 200_000
WORD = re.compile(r"\w+").findall
#: Odd factors that mix the hashes of neighbouring runs.
MIX = [np.uint64(0x9E3779B97F4A7C15 * k & (1 << 64) - 1) for k in (1, 3, 5, 7)]
HIT = "struct<item_id:long,start:long,end:long,edits:int>"


def points_of(line: str) -> np.ndarray:
    return np.frombuffer(line.encode("utf-32-le", "surrogatepass"), np.uint32)


def normal(text: str) -> np.ndarray:
    """Code points of the text's lower-cased words, one space between them."""
    return points_of(" ".join(WORD(text.lower())))


def grams(x: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of Q characters."""
    one = (x.astype(np.uint64) + np.uint64(1)) * np.uint64(0xD6E8FEB86659FD93)
    two = one[:-1] * MIX[0] + one[1:]
    four = two[:-2] * MIX[1] + two[2:]
    eight = four[:-4] * MIX[2] + four[4:]
    ten = eight[: len(x) - Q + 1] * MIX[3] + two[8 : 8 + len(x) - Q + 1]
    return ten ^ (ten >> np.uint64(29))


def align(window: np.ndarray, region: np.ndarray, k: int) -> tuple[int, int]:
    """Least edits, if at most ``k``, between the window and any part of the region, and where that part ends.

    Only the diagonals (region place less window place) that ``k`` edits can reach from a beginning in the region
    are filled; a larger number than ``k`` stands for any larger one.
    """
    m, n = len(window), len(region)
    d = np.arange(-k, max(0, n - m) + k + 1)
    far, place = m + n + 1, np.arange(len(d))
    padded = np.concatenate([np.full(m + k, -1), region.astype(np.int64), np.full(m + k, -1)])
    row = np.where((d >= 0) & (d <= n), 0, far)
    for r, c in enumerate(window.tolist(), 1):
        at = r + d
        new = np.minimum(row + (padded[at - 1 + m + k] != c), np.append(row[1:], far) + 1)
        new[(at < 0) | (at > n)] = far
        row = np.minimum.accumulate(new - place) + place
        row[(at < 0) | (at > n)] = far
    best = int(row.argmin())
    return int(row[best]), m + int(d[best])


@dataclass
class Index:
    """q-grams of the items: a small table of hash prefixes, then sorted hashes with their places."""

    items: list
    exact: dict[str, dict[int, dict[str, list]]]
    points: list[np.ndarray]
    windows: list[list[tuple[int, int, int]]]
    hashes: np.ndarray
    first: np.ndarray
    of: np.ndarray
    at: np.ndarray
    table: np.ndarray

    def __post_init__(self):
        """The widest band and the least bound of all windows."""
        self.widest = max((w[0][2] for w in self.windows), default=0) + 1
        self.least = min((m + 1 - Q * (k + 1) for w in self.windows for _, m, k in w), default=1)

    @classmethod
    def build(cls, rows: list[tuple[int, str]], window: int, stride: int, edits: float, short: int) -> Index:
        items, points, windows, found, exact = [], [], [], [], {}
        for item, text in rows:
            words = WORD(text.lower())
            line = " ".join(words)
            if len(line) < max(short, Q):
                if words:
                    exact.setdefault(words[0], {}).setdefault(len(words), {}).setdefault(line, []).append(item)
                continue
            x = points_of(line)
            m = min(window, len(x))
            starts = sorted({*range(0, len(x) - m + 1, stride), len(x) - m})
            k = min(int(edits * m), (m + 1) // Q - 1)
            items.append(item)
            points.append(x)
            windows.append([(s, m, k) for s in starts])
            found.append(grams(x))
        sizes = [len(g) for g in found]
        all_ = np.concatenate([*found, np.zeros(0, np.uint64)])
        of = np.repeat(np.arange(len(items)), sizes)
        at = np.concatenate([*(np.arange(n) for n in sizes), np.zeros(0, np.int64)])
        order = np.argsort(all_, kind="stable")
        hashes, first = np.unique(all_[order], return_index=True)
        table = np.zeros(1 << 22, bool)
        table[(hashes >> np.uint64(42)).astype(np.int64)] = True
        return cls(items, exact, points, windows, hashes, np.append(first, len(all_)), of[order], at[order].astype(np.int64), table)

    def hits(self, x: np.ndarray) -> list[tuple[int, int, int, int]]:
        """(item index, start, end, edits) for each item's best region in ``x``."""
        if len(x) < Q or not len(self.hashes):
            return []
        g = grams(x)
        doc = np.flatnonzero(self.table[(g >> np.uint64(42)).astype(np.int64)])
        k = np.searchsorted(self.hashes, g[doc])
        k[k == len(self.hashes)] = 0
        ok = self.hashes[k] == g[doc]
        doc, k = doc[ok], k[ok]
        if not len(doc):
            return []
        n = self.first[k + 1] - self.first[k]
        flat = np.repeat(self.first[k] - np.concatenate([[0], np.cumsum(n)[:-1]]), n) + np.arange(n.sum())
        item, at, doc = self.of[flat], self.at[flat], np.repeat(doc, n)
        diagonal = doc - at
        out: dict[int, tuple] = {}
        widest, least = self.widest, self.least
        band = np.floor_divide(diagonal, widest)
        # Each hit counts in the band that begins at its own strip and in the one before.
        key = np.concatenate([np.stack([item, band]), np.stack([item, band - 1])], axis=1)
        order = np.lexsort((key[1], key[0]))
        key = key[:, order]
        edge = np.concatenate([[0], np.flatnonzero((key[:, 1:] != key[:, :-1]).any(0)) + 1, [key.shape[1]]])
        big = np.flatnonzero(np.diff(edge) >= least)
        for e in big.tolist():
            rows = order[edge[e] : edge[e + 1]] % len(item)
            i, low = int(key[0, edge[e]]), int(key[1, edge[e]]) * widest
            places = np.unique(at[rows])
            for s, m, k in self.windows[i]:
                if i in out and out[i][2] == 0:
                    break
                shared = np.searchsorted(places, s + m - Q, "right") - np.searchsorted(places, s)
                if shared < max(1, m + 1 - Q * (k + 1)):
                    continue
                # The window begins on a diagonal of the band; edits may move its end by k.
                lo = max(0, s + low - k)
                region = x[lo : max(lo, s + m + low + 2 * widest + k)]
                edits, end = align(self.points[i][s : s + m], region, k)
                if edits <= k and (i not in out or edits < out[i][2]):
                    out[i] = (max(0, lo + end - m), lo + end, edits)
        return [(i, *v) for i, v in out.items()]


    def whole(self, text: str) -> list[tuple]:
        """(item, start, end, 0) of the first place of each short item."""
        found, at, words = {}, 0, WORD(text.lower())
        for i, w in enumerate(words):
            for n, lines in self.exact.get(w, {}).items():
                line = w if n == 1 else " ".join(words[i : i + n])
                for item in lines.get(line, ()):
                    found.setdefault(item, (item, at, at + len(line), 0))
            at += len(w) + 1
        return list(found.values())


def _searcher(rows, window: int, stride: int, edits: float, short: int):
    """A function from texts to their hits among the items of the broadcast ``rows``."""

    def fn(texts, kept={}):  # noqa: B006  one index for each task and block
        index = kept.get("index") or kept.setdefault("index", Index.build(rows.value, window, stride, edits, short))
        out = []
        for text in texts:
            x, best = normal(text), {}
            for lo in range(0, max(1, len(x)), STRETCH):
                for i, start, end, n in index.hits(x[lo : lo + STRETCH + 2 * window]):
                    if i not in best or n < best[i][2]:
                        best[i] = (lo + start, lo + end, n)
            hits = [(index.items[i], *v) for i, v in best.items()] + (index.whole(text) if index.exact else [])
            out.append([dict(zip(("item_id", "start", "end", "edits"), h, strict=True)) for h in hits])
        return {"hits": out}

    return fn


def find_hits(docs: DataFrame, benchmark: DataFrame, window: int = 100, stride: int = 25, edits: float = 0.08, short: int = 20, block_bytes: int = 8 << 20, text_col: str = "text", item_col: str = "item_id", item_text: str = "text") -> tuple[DataFrame, str]:
    """``docs`` with the hits of each row, and the name of that column.

    Hits: each benchmark item found, with the place of its best region among the normal form's characters.
    """
    sc = docs.sparkSession.sparkContext
    items = benchmark.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text).cast("string").alias("text")).where("text is not null and item_id is not null")
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n_blocks = max(1, math.ceil(total / block_bytes))
    if n_blocks == 1:
        fn = _searcher(sc.broadcast(sorted(map(tuple, items.collect()))), window, stride, edits, short)
        rows, (name,) = with_columns(docs, text_col, fn, {"hits": f"array<{HIT}>"})
        return rows, name
    row = next(n for n in (f"row{'_' * k}" for k in range(len(docs.columns) + 1)) if n not in docs.columns)
    numbered = cut(docs.withColumn(row, F.monotonically_increasing_id()))
    dealt = cut(items.withColumn("block", F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks))).repartition("block"))
    made = []
    for block in range(n_blocks):
        shared = sc.broadcast(sorted(map(tuple, dealt.where(F.col("block") == block).select("item_id", "text").collect())))
        found, (hits,) = with_columns(numbered.select(row, text_col), text_col, _searcher(shared, window, stride, edits, short), {"hits": f"array<{HIT}>"})
        made.append(cut(found.where(F.size(hits) > 0).select(row, F.col(hits).alias("hits"))))
        shared.unpersist()
    name = next(n for n in (f"hits{'_' * k}" for k in range(len(docs.columns) + 1)) if n not in docs.columns)
    all_ = reduce(DataFrame.unionByName, made).groupBy(row).agg(F.flatten(F.collect_list("hits")).alias(name))
    joined = numbered.join(all_, row, "left").drop(row)
    return joined.withColumn(name, F.coalesce(name, F.array().cast(f"array<{HIT}>"))), name
