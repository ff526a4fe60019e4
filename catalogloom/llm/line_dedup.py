"""Line dedup by a deletion-neighbourhood join.

Lines (between line feeds) are compared lower-cased with white space collapsed. A line goes if an earlier
line, by (doc_id, place), equals it or, with at least ``min_chars`` characters on both sides, is one edit
away (insertion, deletion or substitution of a character). All is judged on the input: a line that goes may
be the reason why another goes. Lines of white space alone stay.

Equal lines are reduced to one row by 128-bit hashes first. A line can be one edit from another only if it
shares its first or last half with it, and then all but one of ``BLOCKS`` runs; lines that share neither
are left out at no loss. Each remaining line emits every variant with one character deleted in the runs
concerned, as hashed keys; equal keys meet in a group. In a group of lines that differ at one place the
earliest is the witness of the others. In a group of a line and longer ones that give it by a deletion, that
line is the witness of the longer ones and the earliest of these is its own; two longer ones can be two edits
apart and are not compared. Witnesses are verified by edit distance. Groups are aggregated, never expanded
into pairs, so a line that a third of all documents hold costs a row each.

Null texts are empty and give no lines. Rows that repeat a whole row count as the same document. Rows
without an id come first in the order. Very long lines are compared whole.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, StructField, StructType

from .common import cut, map_batches, pressed, release, sliced, unpressed

BLOCKS, NO_ID = 8, -(1 << 63)
#: What a key is of its line.
ITSELF, SHORTER, SAME = 0, 1, 2
#: Texts that a task holds as Python values at once.
TEXTS = 1000


def normal(line: str) -> str:
    return " ".join(line.lower().split())


def _hash(*parts) -> int:
    h = xxhash.xxh3_64_intdigest("\x00".join(map(str, parts)).encode("utf-8", "surrogatepass"))
    return h - (1 << 64) if h >> 63 else h


def _whole(line: str) -> tuple[int, int]:
    d = xxhash.xxh3_128_digest(line.encode("utf-8", "surrogatepass"))
    return int.from_bytes(d[:8], "big", signed=True), int.from_bytes(d[8:], "big", signed=True)


def half_keys(line: str) -> list[int]:
    """Hashes of the first and last halves; lines one edit apart share one."""
    n, out = len(line), []
    for h in {n // 2, (n - 1) // 2}:
        for seed, part in ((2 * h, line[:h]), (2 * h + 1, line[n - h :])):
            x = xxhash.xxh3_64_intdigest(part.encode("utf-8", "surrogatepass"), seed)
            out.append(x - (1 << 64) if x >> 63 else x)
    return out


def block_keys(line: str) -> list[tuple[int, int, int]]:
    """(key, from, to): the line without run [from, to), for runs of its own length and of one less."""
    n, out = len(line), []
    for m in (n, n - 1):
        at = [m * j // BLOCKS for j in range(BLOCKS + 1)]
        for lo, hi in zip(at[:-1], at[1:], strict=True):
            out.append((_hash(m, lo, hi, line[:lo], line[n - (m - hi) :] if m > hi else ""), lo, hi + n - m))
    return out


def variants(line: str, lo: int, hi: int) -> list[tuple[int, int]]:
    """(key, kind) of the line itself (``ITSELF``) and of it without character i, lo <= i < hi.

    The variant alone (``SHORTER``) meets a shorter line; the variant with its place (``SAME``) meets a line
    of the same length that differs there.
    """
    out = [(_hash("v", line), ITSELF)]
    for i in range(lo, min(hi, len(line))):
        rest = line[:i] + line[i + 1 :]
        out += [(_hash("v", rest), SHORTER), (_hash("s", i, rest), SAME)]
    return out


def _rows(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    rows = df.select(F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    return rows.withColumn("row", F.xxhash64("text"))


def _packed(df: DataFrame, text_col: str) -> DataFrame:
    """``df`` with its text column compressed, as texts are shuffled."""

    def run(batches):
        for b in sliced(batches, TEXTS):
            at = b.schema.get_field_index(text_col)
            yield b.set_column(at, pa.field(b.schema.names[at], pa.binary()), pa.array(pressed(b.column(at).to_pylist()), pa.binary()))

    return df.mapInArrow(run, StructType([StructField(f.name, BinaryType()) if f.name == text_col else f for f in df.schema]))


def duplicate_lines(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 16) -> DataFrame:
    """(doc_id, row, line): the lines that go, by document, hash of its text and place from 0."""
    docs = _rows(df, id_col, text_col)

    def lines(batch):
        out = {k: [] for k in ("doc_id", "row", "line", "h1", "h2", "keys")}
        for d, text, row in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "text", "row")), strict=True):
            for i, line in enumerate(map(normal, text.split("\n"))):
                if line:
                    for k, v in zip(out, (d, row, i, *_whole(line), half_keys(line) if len(line) >= min_chars - 1 else []), strict=True):
                        out[k].append(v)
        yield out

    all_ = cut(map_batches(docs, lines, "doc_id long, row long, line int, h1 long, h2 long, keys array<long>", TEXTS))
    place = F.struct("doc_id", "line", "row")
    kinds = cut(all_.groupBy("h1", "h2").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n"), F.first("keys").alias("keys")))

    again = kinds.where("n > 1").select("h1", "h2", "first")
    equal = all_.drop("keys").join(again, ["h1", "h2"]).where(place != F.col("first")).select("doc_id", "row", "line")

    # Lines that share a half with another one, with their text.
    keyed = kinds.select("first", F.explode("keys").alias("key"))
    shared = keyed.groupBy("key").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("key")
    near = keyed.join(shared, "key").select("first.*").distinct().groupBy("doc_id", "row").agg(F.collect_list("line").alias("lines"))

    def pick(batch):
        out = {k: [] for k in ("doc_id", "row", "line", "text", "keys")}
        for d, row, wanted, text in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "row", "lines")), unpressed(batch.column("text").to_pylist()), strict=True):
            have = text.decode("utf-8", "surrogatepass").split("\n")
            for i in wanted:
                line = normal(have[i])
                keys = [{"key": k, "lo": lo, "hi": hi} for k, lo, hi in block_keys(line)]
                for k, v in zip(out, (d, row, i, line, keys), strict=True):
                    out[k].append(v)
        yield out

    once = _packed(docs, "text").join(near, ["doc_id", "row"]).dropDuplicates(["doc_id", "row"])
    picked = cut(map_batches(once.select("doc_id", "row", "lines", "text"), pick, "doc_id long, row long, line int, text string, keys array<struct<key:long,lo:int,hi:int>>", TEXTS))

    blocks = picked.select("doc_id", "row", "line", F.explode("keys").alias("k")).select("doc_id", "row", "line", "k.*")
    meet = blocks.groupBy("key").agg(F.count_distinct("doc_id", "row", "line").alias("n")).where("n > 1").select("key")
    runs = blocks.join(meet, "key").select("doc_id", "row", "line", "lo", "hi").distinct().groupBy("doc_id", "row", "line").agg(F.collect_list(F.struct("lo", "hi")).alias("runs"))

    def emit(batch):
        for d, row, i, text, spans in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "row", "line", "text", "runs")), strict=True):
            keys = list({k for s in spans for k in variants(text, s["lo"], s["hi"])})
            n = len(keys)
            yield {"doc_id": np.full(n, d), "row": np.full(n, row), "line": np.full(n, i, np.int32), "key": [k for k, _ in keys], "kind": np.array([k for _, k in keys], np.int8)}

    long_enough = picked.drop("keys").where(F.char_length("text") >= min_chars)
    wide = long_enough.join(runs, ["doc_id", "row", "line"]).select("doc_id", "row", "line", "text", "runs")
    keys = map_batches(wide, emit, "doc_id long, row long, line int, key long, kind byte")
    firsts = (F.min(F.when(c, place)).alias(w) for c, w in ((F.col("kind") != SHORTER, "own"), (F.col("kind") == SHORTER, "longer")))
    best = keys.groupBy("key").agg(*firsts, F.count(F.lit(1)).alias("n")).where("n > 1 and own is not null").drop("n")
    other = F.when(F.col("kind") == ITSELF, F.col("longer")).otherwise(F.col("own"))
    later = keys.join(best, "key").withColumn("w", other).where(place > F.col("w")).select("doc_id", "row", "line", "w").distinct()
    witness = long_enough.select(place.alias("w"), F.col("text").alias("other"))
    pairs = later.join(long_enough, ["doc_id", "row", "line"]).join(witness, "w")
    verified = pairs.where(F.levenshtein("text", "other", 1) >= 0).select("doc_id", "row", "line").distinct()
    return equal.unionByName(verified)


def line_dedup(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_chars: int = 16) -> tuple[DataFrame, str]:
    """``df`` with its text column less the lines that go, and the name of a column with the places of those lines (null: none).

    A row whose lines all stay keeps its text as it is, null included.
    """
    gone = duplicate_lines(df, id_col, text_col, min_chars).groupBy("doc_id", "row").agg(F.collect_set("line").alias("gone"))
    taken = {c.lower() for c in df.columns}
    name = next(n for n in (f"gone{'_' * k}" for k in range(len(taken) + 1)) if n not in taken)
    gone = gone.select(F.col("doc_id").alias("__id"), F.col("row").alias("__row"), F.col("gone").alias(name))
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    keyed = df.withColumn("__id", F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID))).withColumn("__row", F.xxhash64(text))
    joined = _packed(keyed, text_col).join(gone, ["__id", "__row"], "left").drop("__id", "__row")
    out = StructType([*df.schema, joined.schema[name]])

    def keep(batches):
        for b in sliced(batches, TEXTS):
            texts = []
            for z, places in zip(unpressed(b.column(text_col).to_pylist()), b.column(name).to_pylist(), strict=True):
                text = None if z is None else z.decode("utf-8", "surrogatepass")
                if places is not None:
                    places = set(places)
                    text = "\n".join(x for i, x in enumerate(text.split("\n")) if i not in places)
                texts.append(text)
            at = b.schema.get_field_index(text_col)
            yield b.set_column(at, pa.field(b.schema.names[at], pa.string()), pa.array(texts, pa.string()))

    release(df.sparkSession)
    return joined.mapInArrow(keep, out), name
