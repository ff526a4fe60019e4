"""Audit of how the sources of each language differ in their terms.

Terms are cut by the byte-level tokenizer and counted within each task, a row for each (language, term) with its counts
by source. Spark adds them up by (language, term); terms in fewer than ``min_docs`` documents of their language go. The
counts of the rest, dealt into blocks by language and hash of the term, are sparse matrices of sources by terms (CSR).
With N the counts of a source and V the kept terms, a term's share is p = 1 + floor(scale * (count + 1) / (N + V)), and
the divergence from q to p is floor((p - q)**2 / q), all in whole numbers.

Most counts are zero, so a pair of sources (a, b) costs no dense row: the sum over terms where a has none depends on
b's entries alone, and a's own entries are corrected by one ``reduceat`` over its row. Blocks emit sums for pairs and
the highest terms for each source, which Spark adds up and ranks.

A null text, language or source is ''. Each row is a document of its own, repeated or not. A group without terms has
zero counts and takes part; a language without kept terms gives pairs of value 0 and no terms. Ties go by the item's
UTF-8 bytes. Other columns are not read. An empty table gives no rows. Pairs are the result that is asked for: their number
grows with the square of the sources of a language, and a block holds one accumulator for each source.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from .byte_terms import LETTERS, Terms
from .common import cut, drop_written, sliced

COUNTED = "lang string, term string, entries array<struct<source:string,n:bigint,docs:bigint>>"
FOUND = "lang string, source string, part string, item string, value long"
#: Terms, and (term, source) counts, that a task holds before it hands them on.
ROOM = 1_000_000
#: (term, source) counts in a block.
BLOCK = 500_000


def shares(count: np.ndarray, total: np.ndarray | int, scale: int = 1_000_000_000) -> np.ndarray:
    """1 + floor(scale * (count + 1) / total), exact while total * 1000 fits 63 bits; ``scale`` is a power of 1000."""
    rest = np.asarray(count, np.int64) + 1
    found = np.zeros(np.broadcast(rest, total).shape, np.int64)
    while scale > 1:
        if scale % 1000:
            raise ValueError("scale is a power of 1000")
        rest, scale = rest * 1000, scale // 1000
        found = found * 1000 + rest // total
        rest = rest % total
    return 1 + found


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) ** 2 // q


def row_sums(values: np.ndarray, starts: np.ndarray) -> np.ndarray:
    """Sums of the rows of a CSR matrix; ``starts`` has one entry more than rows."""
    out = np.zeros(len(starts) - 1, np.int64)
    held = np.flatnonzero(np.diff(starts))
    if len(held):
        out[held] = np.add.reduceat(values, starts[:-1][held])
    return out


class Counts:
    """Counts by (language and source, term) of a task's batches so far."""

    def __init__(self):
        self.groups: dict[tuple[str, str], int] = {}
        self.terms: dict[bytes, int] = {}
        self.parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        self.size = 0

    def add(self, langs: list, sources: list, column: pa.Array) -> None:
        found = Terms(column, LETTERS)
        doc, term, n = found.counts()
        group = np.array([self.groups.setdefault(x, len(self.groups)) for x in zip(langs, sources, strict=True)], np.int64)
        number = np.array([self.terms.setdefault(w, len(self.terms)) for w in found.words], np.int64)
        if len(doc):
            self._reduce([(number[term] << 32 | group[doc], n, np.ones(len(n), np.int64))])

    def _reduce(self, parts: list) -> None:
        key, n, docs = (np.concatenate(x) for x in zip(*parts, strict=True))
        order = np.argsort(key, kind="stable")
        key = key[order]
        starts = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]]))
        self.parts.append((key[starts], np.add.reduceat(n[order], starts), np.add.reduceat(docs[order], starts)))
        self.size += len(starts)

    def flush(self, schema: pa.Schema):
        """Batches of rows (language, term, entries by source)."""
        parts, self.parts, self.size = self.parts, [], 0
        words, groups = list(self.terms), list(self.groups)
        self.terms, self.groups = {}, {}
        if not parts:
            return
        self._reduce(parts)
        key, n, docs = self.parts.pop()
        self.size = 0
        names = sorted({lang for lang, _ in groups})
        lang_of = np.array([names.index(lang) for lang, _ in groups], np.int64)
        term, group = key >> 32, key & 0xFFFFFFFF
        order = np.lexsort((lang_of[group], term))
        term, group, n, docs = term[order], group[order], n[order], docs[order]
        lang = lang_of[group]
        starts = np.flatnonzero(np.concatenate([[True], (term[1:] != term[:-1]) | (lang[1:] != lang[:-1])]))
        sources = pa.array([s for _, s in groups], pa.string())
        for lo in range(0, len(starts), 100_000):
            rows = starts[lo : lo + 100_000]
            upto = starts[lo + 100_000] if lo + 100_000 < len(starts) else len(term)
            entries = pa.StructArray.from_arrays(
                [sources.take(pa.array(group[rows[0] : upto])), pa.array(n[rows[0] : upto], pa.int64()), pa.array(docs[rows[0] : upto], pa.int64())],
                fields=list(schema.field("entries").type.value_type),
            )
            offsets = pa.array(np.append(rows, upto) - rows[0], pa.int32())
            column = pa.ListArray.from_arrays(offsets, entries).cast(schema.field("entries").type)
            yield pa.RecordBatch.from_arrays(
                [pa.array(names, pa.string()).take(pa.array(lang[rows])), pa.array([words[k] for k in term[rows].tolist()], pa.binary()).cast(pa.string()), column], schema=schema
            )


def term_counts(docs: DataFrame) -> DataFrame:
    """(lang, term, entries of (source, n, docs)): counts of each task's own documents, from columns lang, source, text."""
    schema = to_arrow_schema(_parse_datatype_string(COUNTED))

    def run(batches):
        held = Counts()
        for b in sliced(batches):
            held.add(b.column("lang").to_pylist(), b.column("source").to_pylist(), b.column("text"))
            if held.size > 4 * ROOM or len(held.terms) > ROOM:
                yield from held.flush(schema)
        yield from held.flush(schema)

    return docs.mapInArrow(run, COUNTED)


def _of_block(top: int, scale: int):
    schema = to_arrow_schema(_parse_datatype_string(FOUND))

    def run(key, counts: pa.Table, groups: pa.Table) -> pa.Table:
        lang = key[0].as_py()
        groups = groups.sort_by("source")
        sources, total = groups.column("source").combine_chunks(), groups.column("n").to_numpy()
        n_kept, of_lang, size = groups.column("kept")[0].as_py(), groups.column("lang_n")[0].as_py(), len(sources)
        entries = counts.column("entries").combine_chunks()
        flat, n_terms = entries.flatten(), counts.num_rows
        column = np.repeat(np.arange(n_terms), np.diff(entries.offsets.to_numpy()))
        row = pc.index_in(flat.field("source"), sources).to_numpy(zero_copy_only=False).astype(np.int64)
        order = np.argsort(row, kind="stable")
        row, column, n = row[order], column[order], flat.field("n").to_numpy(zero_copy_only=False)[order]
        starts = np.searchsorted(row, np.arange(size + 1))
        out = []
        if n_terms:
            p0, p = shares(np.zeros(size, np.int64), total + n_kept, scale), shares(n, (total + n_kept)[row], scale)
            for b in range(size):
                mine = slice(starts[b], starts[b + 1])
                q = np.full(n_terms, p0[b])
                q[column[mine]] = p[mine]
                value = (n_terms - (starts[b + 1] - starts[b])) * divergence(p0, p0[b])
                value += np.array([int(divergence(x, p[mine]).sum()) for x in p0], np.int64)
                value += row_sums(divergence(p, q[column]) - divergence(p0[row], q[column]), starts)
                out.append(value)
            whole = np.zeros(n_terms, np.int64)
            np.add.at(whole, column, n)
            q = shares(whole, of_lang + n_kept, scale)[column]
            more = np.flatnonzero(p > q)
            value, terms = divergence(p, q)[more], counts.column("term").combine_chunks()
            place = np.empty(n_terms, np.int64)
            place[pc.sort_indices(terms.cast(pa.binary())).to_numpy()] = np.arange(n_terms)
            order = np.lexsort((place[column[more]], -value, row[more]))
            at = row[more][order]
            order = order[np.arange(len(at)) - np.searchsorted(at, at) < top]
            best = [sources.take(pa.array(row[more][order])), terms.take(pa.array(column[more][order])), pa.array(value[order])]
        else:
            out = [np.zeros(size, np.int64)] * size
            best = [pa.array([], pa.string()), pa.array([], pa.string()), pa.array([], pa.int64())]
        a, b = np.divmod(np.arange(size * size), size)
        other = a != b
        values = np.array(out, np.int64).T.reshape(-1)[other]
        pairs = [sources.take(pa.array(a[other])), sources.take(pa.array(b[other])), pa.array(values)]
        made = [pa.table([pa.array([lang] * len(x[2]), pa.string()), x[0].cast(pa.string()), pa.array([part] * len(x[2]), pa.string()), x[1].cast(pa.string()), x[2].cast(pa.int64())], schema=schema) for part, x in (("pair", pairs), ("term", best))]
        return pa.concat_tables(made)

    return run


def divergences(df: DataFrame, lang_col: str = "lang", source_col: str = "source", text_col: str = "text", min_docs: int = 3, top: int = 200, scale: int = 1_000_000_000) -> DataFrame:
    """(lang, source, part, item, value, rank): for each source, its divergence from every other one of the language and its ``top`` terms."""
    docs = df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(name) for c, name in ((lang_col, "lang"), (source_col, "source"), (text_col, "text"))))
    spread = term_counts(docs).repartition("lang", "term").select("lang", "term", F.explode("entries").alias("e"))
    once = spread.groupBy("lang", "term", "e.source").agg(F.sum("e.n").alias("n"), F.sum("e.docs").alias("docs"))
    rows = once.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.collect_list(F.struct("source", "n")).alias("entries"))
    kept = cut(rows.where(F.col("docs") >= min_docs).select("lang", "term", "entries"))

    by_source = kept.select("lang", F.explode("entries").alias("e")).groupBy("lang", "e.source").agg(F.sum("e.n").alias("n"), F.count(F.lit(1)).alias("held"))
    groups = docs.select("lang", "source").distinct().join(by_source, ["lang", "source"], "left").fillna(0, ["n", "held"])
    langs = groups.groupBy("lang").agg(F.sum("n").alias("lang_n"), F.greatest(F.lit(1), F.ceil(F.sum("held") / BLOCK)).cast("long").alias("blocks"))
    langs = langs.join(kept.groupBy("lang").agg(F.count(F.lit(1)).alias("kept")), "lang", "left").fillna(0, ["kept"])
    langs = cut(langs)
    groups = groups.select("lang", "source", "n").join(langs, "lang").select("*", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)).alias("block"))
    dealt = kept.join(langs.select("lang", "blocks"), "lang").select("lang", "term", "entries", F.expr("pmod(xxhash64(term), blocks)").alias("block"))
    found = dealt.groupBy("lang", "block").cogroup(groups.drop("blocks").groupBy("lang", "block")).applyInArrow(_of_block(top, scale), FOUND)
    found = cut(found)
    for done in (kept, langs):
        drop_written(done)
    sums = found.where("part = 'pair'").groupBy("lang", "source", "part", "item").agg(F.sum("value").alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    ranked = [x.withColumn("rank", F.row_number().over(order)) for x in (sums, found.where("part = 'term'"))]
    return ranked[0].unionByName(ranked[1].where(F.col("rank") <= top)).select("lang", "source", "part", "item", "value", "rank")
