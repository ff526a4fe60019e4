"""Ranked lexical search: an inverted index in shards, searched by MaxScore.

``build_index`` cuts the texts into shards of about ``SHARD`` bytes; a row of the index is a shard with its documents'
ids and lengths and its terms' postings (places and frequencies). Nothing is shuffled. ``search`` sums N, L and the
document frequencies over the shards, and scores each shard where it lies. A query's terms are split by their
upper bounds (the highest score that a posting of the shard gives): the terms whose bounds together stay below the
query's k-th best score so far are non-essential. Only documents in the other, essential lists are candidates, and the
non-essential lists are probed, the highest bound first, only for candidates that can still reach the k-th best. A task
hands on its k best for each query, Spark ranks those.

A query block's terms and weights go to all tasks; blocks hold about ``BLOCK`` bytes of terms, and each block
reads the index, not the texts. The index of a search holds the queries' terms alone while their hashes fit ``HASHES``
(others are counted in the lengths), else all terms; the rows are the same.

Scores are whole numbers: a term's weight w is floor(1000 * ln((2N + 2) / (2 df + 1))), m is
100 - 75 + (75 * n * N) div L for a document of n terms, and a term that occurs tf times adds
w * ((10**9 * tf) div (1000 * tf + 8 m)), as often as the query repeats it. Equal scores go by ascending id, rows without an
id last. A null or empty text has no terms and is found by nothing, nor does it count in N; a query without terms finds
nothing. Repeated rows are documents, and queries, of their own. Other columns are not read.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from .byte_terms import LETTERS_AND_DIGITS, Terms
from .common import cut, sliced

SHARD = 8 << 20
BLOCK = 4 << 20
HASHES = 4_000_000
INDEX = "ids array<bigint>, lengths array<bigint>, terms array<string>, held array<bigint>, places binary, often binary"
BAG = "item_id bigint, terms array<string>, often array<bigint>"
FOUND = "item long, item_id long, doc_id long, score long"


def _arrow(schema: str) -> pa.Schema:
    return to_arrow_schema(_parse_datatype_string(schema))


def _lists(values: pa.Array, ends: np.ndarray, type_: pa.DataType) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), values).cast(type_)


def build_index(docs: DataFrame, only: np.ndarray | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """A row for each shard; ``only``: sorted XXH3 hashes of the terms to hold."""
    schema = _arrow(INDEX)

    def run(batches):
        for b in sliced(batches, 100_000, SHARD):
            found = Terms(b.column("text"), LETTERS_AND_DIGITS, only)
            doc, term, n = found.counts()
            order = np.argsort(term, kind="stable")
            held = np.bincount(term, minlength=len(found.words)).astype(np.int64)
            one = lambda x, f: _lists(x, [len(x)], schema.field(f).type)
            yield pa.RecordBatch.from_arrays(
                [
                    one(b.column("doc_id").cast(pa.int64()), "ids"),
                    one(pa.array(found.n), "lengths"),
                    one(pa.array(found.words, pa.binary()).cast(pa.string()), "terms"),
                    one(pa.array(held), "held"),
                    pa.array([doc[order].astype("<u4").tobytes()], pa.binary()),
                    pa.array([n[order].astype("<u4").tobytes()], pa.binary()),
                ],
                schema=schema,
            )

    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, INDEX)


def bags(queries: DataFrame, id_col: str = "item_id", text_col: str = "text") -> DataFrame:
    """(item_id, terms, often): the terms of each query."""
    schema = _arrow(BAG)

    def run(batches):
        for b in sliced(batches):
            found = Terms(b.column("text"), LETTERS_AND_DIGITS)
            doc, term, n = found.counts()
            ends = np.searchsorted(doc, np.arange(b.num_rows), "right")
            words = pa.array([found.words[k] for k in term.tolist()], pa.binary()).cast(pa.string())
            yield pa.RecordBatch.from_arrays([b.column("item_id").cast(pa.int64()), _lists(words, ends, schema.field("terms").type), _lists(pa.array(n, pa.int64()), ends, schema.field("often").type)], schema=schema)

    return queries.select(F.col(id_col).cast("long").alias("item_id"), F.col(text_col).cast("string").alias("text")).mapInArrow(run, BAG)


def length_factors(lengths: np.ndarray, n_docs: int, total: int) -> np.ndarray:
    """100 - 75 + (75 * n * N) div L; in Python's whole numbers where 63 bits do not hold the product."""
    if len(lengths) and 75 * int(lengths.max()) * n_docs >= 1 << 63:
        return np.array([25 + 75 * int(n) * n_docs // total for n in lengths], np.int64)
    return 25 + 75 * lengths * n_docs // max(total, 1)


class Shard:
    """Postings of a shard with the score of each; a term's are worked out when it is first asked for."""

    def __init__(self, row: dict, n_docs: int, total: int):
        self.ids, self.m = row["ids"], length_factors(np.array(row["lengths"], np.int64), n_docs, total)
        self.place, self.often = np.frombuffer(row["places"], "<u4"), np.frombuffer(row["often"], "<u4")
        self.ends = np.cumsum(np.array(row["held"], np.int64))
        self.number = {t: k for k, t in enumerate(row["terms"])}
        self.made: dict[str, tuple] = {}

    def postings(self, term: str, weight: int) -> tuple[np.ndarray, np.ndarray, int] | None:
        """(places, scores, highest score) of a term."""
        if term not in self.made:
            k = self.number.get(term)
            if k is None:
                self.made[term] = None
            else:
                mine = slice(self.ends[k - 1] if k else 0, self.ends[k])
                place, tf = self.place[mine].astype(np.int64), self.often[mine].astype(np.int64)
                score = weight * (1_000_000_000 * tf // (1000 * tf + 8 * self.m[place]))
                self.made[term] = (place, score, int(score.max()))
        return self.made[term]


def max_score(shard: Shard, query: list[tuple[str, int, int]], least: int, probed: list | None = None) -> tuple[np.ndarray, np.ndarray]:
    """(places, scores) of all documents that score ``least`` or more; ``query`` lists (term, repeats, weight).

    ``probed`` (tests) takes the number of candidates with which each non-essential list is probed.
    """
    lists = []
    for term, repeats, weight in query:
        found = shard.postings(term, weight) if weight > 0 else None
        if found:
            lists.append((found[2] * repeats, found[0], found[1], repeats))
    lists.sort(key=lambda x: x[0])
    bound = np.cumsum([x[0] for x in lists])
    split = int(np.searchsorted(bound, least))  # the lists before it reach less than ``least`` together
    score = np.zeros(len(shard.ids), np.int64)
    for _, place, gain, repeats in lists[split:]:
        score[place] += gain * repeats
    at = np.flatnonzero(score)
    sums = score[at]
    for k in range(split - 1, -1, -1):
        able = sums + bound[k] >= least
        at, sums = at[able], sums[able]
        if not len(at):
            break
        if probed is not None:
            probed.append(len(at))
        _, place, gain, repeats = lists[k]
        near = np.minimum(np.searchsorted(place, at), len(place) - 1)
        sums = sums + np.where(place[near] == at, gain[near] * repeats, 0)
    reach = sums >= least
    return at[reach], sums[reach]


def _better(row: tuple) -> tuple:
    score, doc_id = row
    return -score, doc_id is None, doc_id or 0


def _search_block(index: DataFrame, block: list, weights: dict[str, int], n_docs: int, total: int, k: int) -> DataFrame:
    queries = [(r["item"], r["item_id"], [(t, n, weights.get(t, 0)) for t, n in zip(r["terms"], r["often"], strict=True)]) for r in block]
    schema = _arrow(FOUND)

    def run(batches):
        best: list[list] = [[] for _ in queries]
        for b in batches:
            for j in range(b.num_rows):
                shard = Shard(b.slice(j, 1).to_pylist()[0], n_docs, total)
                for i, (_, _, terms) in enumerate(queries):
                    least = max(1, best[i][-1][0]) if len(best[i]) == k else 1
                    at, score = max_score(shard, terms, least)
                    if len(at) > k:  # those under the k-th score cannot count; ties at it may
                        enough = score >= np.partition(score, len(score) - k)[len(score) - k]
                        at, score = at[enough], score[enough]
                    if len(at):
                        best[i] = sorted([*best[i], *zip(score.tolist(), (shard.ids[x] for x in at.tolist()), strict=True)], key=_better)[:k]
        rows = [(item, item_id, doc_id, score) for (item, item_id, _), kept in zip(queries, best, strict=True) for score, doc_id in kept]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, type=f.type) for x, f in zip(zip(*rows, strict=True), schema, strict=True)], schema=schema)

    return index.mapInArrow(run, FOUND)


def search(docs: DataFrame, queries: DataFrame, k: int = 10, id_col: str = "doc_id", text_col: str = "text", item_col: str = "item_id", item_text_col: str = "text") -> DataFrame:
    """(item_id, rank, doc_id, score): the ``k`` best documents of each query."""
    items = cut(bags(queries, item_col, item_text_col).withColumn("item", F.monotonically_increasing_id()))
    terms = items.select(F.explode("terms").alias("term")).distinct()
    count, size = terms.count(), items.agg(F.sum(F.aggregate("terms", F.lit(0), lambda n, t: n + F.octet_length(t) + 16))).first()[0] or 0
    only = None
    if count <= HASHES:

        def hashes(batches):
            import xxhash

            for b in batches:
                yield pa.RecordBatch.from_arrays([pa.array(np.array([xxhash.xxh3_64_intdigest(t) for t in b.column(0).to_pylist()], np.uint64).view(np.int64), pa.int64())], names=["hash"])

        only = np.sort(terms.mapInArrow(hashes, "hash long").toPandas()["hash"].to_numpy(np.int64).view(np.uint64))
    index = cut(build_index(docs, only, id_col, text_col))
    n_docs, total = index.agg(F.sum(F.size(F.filter("lengths", lambda n: n > 0))), F.sum(F.aggregate("lengths", F.lit(0).cast("long"), lambda a, n: a + n))).first()
    blocks = max(1, math.ceil(size / BLOCK))
    dealt = items.withColumn("block", F.pmod(F.xxhash64("item"), F.lit(blocks)))
    frequency = index.select(F.explode(F.arrays_zip("terms", "held")).alias("e")).groupBy(F.col("e.terms").alias("term")).agg(F.sum("e.held").alias("held")).join(terms, "term")
    frequency = cut(frequency)
    parts = []
    for b in range(blocks):
        mine = dealt.where(F.col("block") == b)
        held = frequency.join(mine.select(F.explode("terms").alias("term")).distinct(), "term", "left_semi")
        weights = {r["term"]: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * r["held"] + 1))) for r in held.collect()}
        part = _search_block(index, mine.collect(), weights, n_docs or 0, total or 0, k)
        parts.append(part if blocks == 1 else cut(part))
    found = parts[0]
    for part in parts[1:]:
        found = found.unionByName(part)
    order = Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k).select("item_id", "rank", "doc_id", "score")
