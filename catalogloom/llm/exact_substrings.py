"""Dedup of repeated byte strings: winnowing and hash ranks, with distributed prefix doubling beside it.

A byte goes if it lies in a string of ``length`` bytes that also starts anywhere else, in the same text or in
another (overlaps count; matches never cross texts; all is judged on the input).

``doubled_starts`` is prefix doubling as it is named: Spark sorts the pairs of ranks at each position and at a
growing offset, ranks the pairs anew, and drops positions whose rank is unique, until the strings are ``length``
bytes long. It takes a row per byte and round, which no limit on shuffles allows on a whole corpus; so
``repeated_spans`` does the work by ranks that are hashes of the strings themselves:

1. Of the strings of ``2 / 5 * length`` bytes within each window of ``length`` bytes, the one with the least hash
   stands for the window (equal windows choose alike). Sampled positions are grouped by their string's rank;
   those that no other position shares leave, with all windows that they stand for.
2. The rest is reranked by the whole span of those windows. Spans that occur again are repeated as they are:
   copies are settled here, a row for each sampled position, whatever the size of their group.
3. What is left (the borders of repeated passages, and one span of each group that may meet them) is ranked in
   blocks of ``STEP`` neighbouring window starts: if the string that they span together is shared, all are
   repeated; if not even the string that they have in common is, none is.
4. Only the blocks that this leaves open are expanded to their window starts, ranked by the hashes of both
   halves of the string; the windows that share a rank are repeated.

Groups are only counted and joined, never gathered. What is counted is written before it is joined, so that each
side of a join is a plain exchange, of which Spark splits a partition that a common rank makes large. Null and
empty texts give no bytes. Each row is a text of its own, whatever its id: rows without one, with the same one or
repeated whole are compared like others. Texts are read in overlapping stretches, so a very long one is whole.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, drop_written, map_batches, pressed, texts, unpressed

STRETCH = 1 << 18
#: Texts that a task holds as Python values at once.
TEXTS = 256
STEP = 8
U = np.uint64


def _tables() -> tuple[np.ndarray, np.ndarray, U, U, U, U]:
    """Two random tables of bytes' values and odd bases with their inverses modulo 2**64 (from a fixed seed)."""
    rng = np.random.default_rng(20240229)
    t = rng.integers(0, 1 << 64, (2, 256), dtype=np.uint64)
    bases = [int(x) | 1 for x in rng.integers(0, 1 << 64, 2, dtype=np.uint64)]
    return t[0], t[1], U(bases[0]), U(pow(bases[0], -1, 1 << 64)), U(bases[1]), U(pow(bases[1], -1, 1 << 64))


def _powers(base: U, n: int) -> np.ndarray:
    return np.cumprod(np.concatenate([[U(1)], np.full(n, base, np.uint64)]))


def _mix(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> U(30))
    x *= U(0xBF58476D1CE4E5B9)
    x ^= x >> U(27)
    x *= U(0x94D049BB133111EB)
    x ^= x >> U(31)
    return x


class Rolling:
    """Fingerprints of any string b[i:j] of the stretch ``b``, from prefix sums of two polynomial hashes."""

    kept: dict = {}

    def __init__(self, b: np.ndarray):
        if not self.kept:
            t1, t2, b1, i1, b2, i2 = _tables()
            self.kept |= {"t": (t1, t2), "p": (_powers(b1, STRETCH * 2), _powers(b2, STRETCH * 2)), "i": (_powers(i1, STRETCH * 2), _powers(i2, STRETCH * 2))}
        self.bytes, self.sums = b, [None, None]

    def sum(self, which: int) -> np.ndarray:
        if self.sums[which] is None:
            part = self.kept["t"][which][self.bytes]
            part *= self.kept["p"][which][: len(part)]
            out = np.zeros(len(part) + 1, np.uint64)
            np.cumsum(part, out=out[1:])
            self.sums[which] = out
        return self.sums[which]

    def every(self, k: int, which: int) -> np.ndarray:
        """Fingerprints of all strings of ``k`` bytes."""
        sums = self.sum(which)
        out = sums[k:] - sums[:-k]
        out *= self.kept["i"][which][: len(out)]
        return out

    def of(self, i: np.ndarray, j: np.ndarray, which: int) -> np.ndarray:
        sums = self.sum(which)
        return (sums[j] - sums[i]) * self.kept["i"][which][i]


def _least(key: np.ndarray, w: int) -> np.ndarray:
    """The least of each ``w`` keys in a row, by doubling the width."""
    least, width = key, 1
    while 2 * width <= w:
        least = np.minimum(least[:-width], least[width:])
        width *= 2
    return np.minimum(least[: len(key) - w + 1], least[w - width :]) if width < w else least


def _stretches(docs: list[bytes], length: int):
    """Runs of whole texts, or of overlapping parts of a long one: (bytes, of each part: text, where it begins there, where in the run, its size)."""
    parts, size, bits = [], 0, []
    for d, text in enumerate(docs):
        at = 0
        while len(text) - at >= length:
            part = text[at : at + STRETCH]
            if size + len(part) > STRETCH and parts:
                yield np.frombuffer(b"".join(bits), np.uint8), parts
                parts, size, bits = [], 0, []
            parts.append((d, at, size, len(part)))
            bits.append(part)
            size += len(part)
            at += len(part) - length + 1
    if parts:
        yield np.frombuffer(b"".join(bits), np.uint8), parts


def _anchors(docs: list[bytes], length: int, k: int):
    """Per stretch: arrays of the text, the span's start and end, the rank of the sampled string, how far on it is, and a function for the span's rank."""
    w = length - k + 1
    for b, parts in _stretches(docs, length):
        roll = Rolling(b)
        h = _mix(roll.every(k, 0))
        key = h & ~U((1 << 20) - 1)
        key |= np.arange(len(h), dtype=np.uint64)
        chosen = (_least(key, w) & U((1 << 20) - 1)).astype(np.int64)  # of the window that starts at each place
        begin, size = np.array([p[2] for p in parts]), np.array([p[3] for p in parts])
        owner = np.repeat(np.arange(len(parts)), size)[: len(chosen)]
        inside = np.arange(len(chosen)) + length <= (begin + size)[owner]
        starts = np.flatnonzero(inside)
        new = np.concatenate([[True], (chosen[starts][1:] != chosen[starts][:-1]) | (owner[starts][1:] != owner[starts][:-1])])
        edge = np.flatnonzero(new)
        first, last = starts[edge], np.append(starts[edge[1:] - 1], starts[-1])
        own, anchor = owner[first], chosen[first]

        def spans(roll=roll, first=first, last=last, anchor=anchor):
            shape = ((anchor - first).astype(np.uint64) << U(32)) | (last - first).astype(np.uint64)
            return _mix(roll.of(first, last + length, 1) + _mix(shape + U(1)))

        text, shift = np.array([p[0] for p in parts])[own], np.array([p[1] - p[2] for p in parts])[own]
        yield text, first + shift, last + shift, h[anchor], anchor - first, spans


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(doc_id, row, z), written: a number for each row and its compressed text."""
    rows = texts(df, id_col, text_col)

    def pack(batch):
        yield {"doc_id": batch.column("doc_id"), "z": pressed(batch.column("text").to_pylist())}

    packed = map_batches(rows.withColumn("doc_id", F.col("doc_id").cast("long")), pack, "doc_id long, z binary", TEXTS)
    return cut(packed.withColumn("row", F.monotonically_increasing_id()))


def _unpacked(batch) -> list[bytes]:
    return unpressed(batch.column("z").to_pylist())


def _pieces(batch, length: int, k: int):
    """Flat window starts of the contexts in a batch, some thousand rows at a time.

    (rolling hashes, row, place of the start in the run, place in its text, distance to the sampled string)
    """
    per = max(1, STRETCH // (2 * length))
    for lo in range(0, batch.num_rows, per):
        part = batch.slice(lo, per)
        contexts = part.column("ctx").to_pylist()
        base = np.concatenate([[0], np.cumsum([len(c) for c in contexts])[:-1]]).astype(np.int64)
        first, ahead, n = (part.column(c).to_numpy().astype(np.int64) for c in ("first", "ahead", "n"))
        row = np.repeat(np.arange(len(n)), n)
        j = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        yield part, Rolling(np.frombuffer(b"".join(contexts), np.uint8)), row, base[row] + j, first[row] + j, ahead[row] - j


def _take(part, name: str, at: np.ndarray):
    return part.column(name).to_numpy(zero_copy_only=False)[at]


def doubled_starts(docs: DataFrame, length: int = 200) -> DataFrame:
    """(row, start): every place where a string of ``length`` bytes starts that also starts elsewhere, by prefix doubling.

    A rank is the place of a pair of earlier ranks among the sorted pairs; ranks of 8 bytes are the bytes themselves.
    """
    if length < 16:
        raise ValueError("length is at least 16")

    def eights(batch):
        for row, b in zip(batch.column("row").to_pylist(), _unpacked(batch), strict=True):
            if len(b) >= length:
                x = np.frombuffer(b, np.uint8).astype(np.uint64)
                n = len(b) - 7
                rank = sum((x[k : k + n] << U(56 - 8 * k) for k in range(8)), np.zeros(n, np.uint64))
                yield {"row": np.full(n, row), "start": np.arange(n), "rank": rank.view(np.int64)}

    now, width = map_batches(docs, eights, "row long, start long, rank long", 16), 8
    while width < length:
        offset = min(width, length - width)  # the last step overlaps
        after = now.select("row", (F.col("start") - offset).alias("start"), F.col("rank").alias("next"))
        pairs = cut(now.join(after, ["row", "start"]))
        ranked = pairs.groupBy("rank", "next").agg(F.count(F.lit(1)).alias("n")).repartitionByRange("rank", "next").sortWithinPartitions("rank", "next")
        shared = cut(ranked.withColumn("new", F.monotonically_increasing_id()).where("n > 1").drop("n"))
        now, width = cut(pairs.join(shared, ["rank", "next"]).select("row", "start", F.col("new").alias("rank"))), width + offset
        drop_written(pairs)
    return now.select("row", "start")


def repeated_spans(docs: DataFrame, length: int = 200) -> DataFrame:
    """(row, start, end): spans of bytes to remove; they may overlap. ``docs``: see ``_rows``."""
    if not 8 <= length < 1 << 16:
        raise ValueError("length is at least 8 and below 65536")
    k = max(2, 2 * length // 5)

    def sample(batch):
        rows = batch.column("row").to_numpy()
        for text, first, last, h, ahead, spans in _anchors(_unpacked(batch), length, k):
            span = first << 32 | ahead << 16 | last - first + 1
            yield {"row": rows[text], "h": h.view(np.int64), "c": spans().view(np.int64), "span": span}

    # Level 1: sampled positions by rank; unique ones leave.
    sampled = cut(map_batches(docs.select("row", "z"), sample, "row long, h long, c long, span long", TEXTS))
    shared = cut(sampled.groupBy("h").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h"))
    left = cut(sampled.join(shared, "h"))
    drop_written(sampled)
    drop_written(shared)

    # Level 2: whole spans. A span that occurs again is repeated.
    spans = cut(left.groupBy("h", "c").agg(F.count(F.lit(1)).alias("n"), F.min(F.struct("row", "span")).alias("one")))
    first = F.shiftright("span", 32)
    size = F.col("span").bitwiseAND(F.lit(0xFFFF))
    settled = left.join(spans.where("n > 1").select("h", "c"), ["h", "c"]).select("row", first.alias("start"), (first + size - 1 + length).alias("end"))

    # Borders, and one span of each repeated group that shares their sampled string, with their bytes.
    open_ = cut(spans.groupBy("h").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least")).where("kinds > 1 and least = 1").select("h"))
    wanted = spans.join(open_, "h").select("one.*", "h", (F.col("n") == 1).alias("border")).groupBy("row").agg(F.collect_list(F.struct("span", "h", "border")).alias("spans"))

    def contexts(batch):
        out = {c: [] for c in ("row", "h", "border", "first", "ahead", "n", "ctx")}
        for row, b, found in zip(batch.column("row").to_pylist(), _unpacked(batch), batch.column("spans").to_pylist(), strict=True):
            for x in found:
                at, ahead, n = x["span"] >> 32, x["span"] >> 16 & 0xFFFF, x["span"] & 0xFFFF
                for c, v in zip(out, (row, x["h"], x["border"], at, ahead, n, b[at : at + n - 1 + length]), strict=True):
                    out[c].append(v)
        yield out

    once = docs.join(wanted, "row").select("row", "z", "spans")
    context = cut(map_batches(once, contexts, "row long, h long, border boolean, first long, ahead int, n int, ctx binary", TEXTS))

    # Level 3: blocks of neighbouring starts.
    def blocks(batch):
        for part, roll, row, place, start, ahead in _pieces(batch, length, k):
            block = ahead // STEP
            lo = np.flatnonzero(np.concatenate([[True], (row[1:] != row[:-1]) | (block[1:] != block[:-1])]))
            hi = np.append(lo[1:], len(row)) - 1
            least, most = block[lo] * STEP, np.minimum(block[lo] * STEP + STEP - 1, length - k)
            anchor = place[lo] + ahead[lo]
            core = _mix(roll.of(anchor - least, anchor - most + length, 0) ^ _mix(block[lo].astype(np.uint64)))
            shape = (ahead[hi].astype(np.uint64) << U(20)) | (ahead[lo].astype(np.uint64) << U(1)) | U(1)
            whole = _mix(roll.of(place[lo], place[hi] + length, 1) + _mix(shape << U(8)))
            both = np.concatenate([lo, lo])
            n = len(lo)
            yield {
                "row": _take(part, "row", row[both]),
                "h": _take(part, "h", row[both]),
                "border": _take(part, "border", row[both]),
                "block": block[both].astype(np.int32),
                "whole": np.repeat([False, True], n),
                "key": np.concatenate([core, whole]).view(np.int64),
                "start": start[both],
                "stop": np.concatenate([start[hi], start[hi]]),
            }

    level3 = map_batches(context, blocks, "row long, h long, border boolean, block int, whole boolean, key long, start long, stop long")
    again = cut(level3.groupBy("h", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h", "key"))
    told = level3.where("border").join(again, ["h", "key"]).groupBy("row", "h", "block", "start", "stop").agg(F.max("whole").alias("whole"))
    told = cut(told)
    by_block = told.where("whole").select("row", "start", (F.col("stop") + length).alias("end"))

    # Level 4: single starts of the blocks left open.
    undecided = told.where("not whole").select("h", "block").distinct().groupBy("h").agg(F.collect_set("block").alias("blocks"))

    def starts(batch):
        for part, roll, row, place, start, ahead in _pieces(batch, length, k):
            todo = part.column("blocks").to_pylist()
            wanted = np.concatenate([[r * (1 << 20) + b for b in bs] for r, bs in enumerate(todo)]).astype(np.int64)
            keep = np.flatnonzero(np.isin(row * (1 << 20) + ahead // STEP, wanted))
            row, place = row[keep], place[keep]
            half = length // 2
            rank = _mix(_mix(roll.of(place, place + half, 0)) * U(3) + _mix(roll.of(place + half, place + length, 1)))
            yield {c: _take(part, c, row) for c in ("row", "h", "border")} | {"key": rank.view(np.int64), "start": start[keep]}

    level4 = map_batches(context.join(undecided, "h"), starts, "row long, h long, border boolean, key long, start long")
    level4 = cut(level4)
    again = cut(level4.groupBy("h", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("h", "key"))
    by_start = level4.where("border").join(again, ["h", "key"]).select("row", "start", (F.col("start") + length).alias("end"))
    return settled.unionByName(by_block).unionByName(by_start)


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for a, b in sorted(spans):
        if out and a <= out[-1][1]:
            out[-1][1] = max(out[-1][1], b)
        else:
            out.append([a, b])
    return [(a, b) for a, b in out]


def remove_repeats(df: DataFrame, length: int = 200, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_bytes, spans, kept) of every row: the maximal removed runs and the bytes that stay."""
    docs = _rows(df, id_col, text_col)
    spans = repeated_spans(docs, length).groupBy("row").agg(F.collect_set(F.struct("start", "end")).alias("spans"))

    def apply(batch):
        out = {c: [] for c in ("doc_id", "n_bytes", "spans", "kept")}
        for d, b, found in zip(batch.column("doc_id").to_pylist(), _unpacked(batch), batch.column("spans").to_pylist(), strict=True):
            runs = merge([(s["start"], s["end"]) for s in found or ()])
            edges = [0, *(x for r in runs for x in r), len(b)]
            kept = b"".join(b[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2))
            for c, v in zip(out, (d, len(b), [{"start": a, "end": z} for a, z in runs], kept), strict=True):
                out[c].append(v)
        yield out

    joined = docs.join(spans, "row", "left").select("doc_id", "z", "spans")
    return map_batches(joined, apply, "doc_id long, n_bytes long, spans array<struct<start:long,end:long>>, kept binary", TEXTS)
