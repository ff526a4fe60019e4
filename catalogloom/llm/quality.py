"""Quality classifier: logistic regression over hashed word n-grams, trained by follow-the-regularised-leader.

Tokens are lower-cased words and single symbols; a token equal to the one before is ``<same>``, a word in
capitals adds ``<caps>``. Unigrams and bigrams are hashed to ``2**bits`` weights; a document is the
L2-normalised vector of the logarithms of their counts, its score a sparse dot product and a sigmoid.

Training: at most about ``train_rows`` labelled rows, picked by a hash of the id (a bounded, documented
sample), are dealt to ``shards`` tasks; each runs FTRL-proximal over its rows, and Spark averages the
weights. Every text is scored whole. Null and empty texts have no feature but the bias. A row with several
labels counts as 1 if any of them is 1; null labels train nothing.
"""

from __future__ import annotations

import re
import zlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import with_columns

TOKEN = r"\w+|[^\w\s]"


class Features:
    """Hashed n-gram features of texts; token hashes are kept while there is room."""

    def __init__(self, bits: int, room: int = 300_000):
        self.mask, self.kept, self.room, self.find = np.uint32((1 << bits) - 1), {}, room, re.compile(TOKEN).findall

    def __call__(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        tokens = self.find(text)
        if len(self.kept) > self.room:
            self.kept.clear()
        for t in {t for t in tokens if t not in self.kept}:
            self.kept[t] = zlib.crc32(t.lower().encode("utf-8", "surrogatepass"))
        h = np.fromiter(map(self.kept.__getitem__, tokens), np.uint32, len(tokens))
        same = np.flatnonzero(h[1:] == h[:-1]) + 1
        h = h.copy()
        h[same] = zlib.crc32(b"<same>")
        caps = sum(len(t) > 1 and t.isupper() for t in tokens)
        pairs = h[:-1] * np.uint32(0x9E3779B1) + h[1:] * np.uint32(0x85EBCA77) + np.uint32(1)
        extra = np.full(caps, zlib.crc32(b"<caps>"), np.uint32)
        mixed = np.concatenate([h, pairs ^ (pairs >> np.uint32(15)), extra])
        at, n = np.unique((mixed ^ (mixed >> np.uint32(13))) & self.mask, return_counts=True)
        x = np.log1p(n)
        norm = np.sqrt(x @ x)
        return at.astype(np.int64), x / norm if norm else x


def ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], size: int, epochs: int, alpha: float, beta: float, l1: float, l2: float) -> np.ndarray:
    """Weights after FTRL-proximal updates; the last one is the bias."""
    z, n = np.zeros(size + 1), np.zeros(size + 1)

    def weights(at):
        return np.where(np.abs(z[at]) <= l1, 0.0, -(z[at] - np.sign(z[at]) * l1) / ((beta + np.sqrt(n[at])) / alpha + l2))

    for _ in range(epochs):
        for at, x, y in rows:
            at, x = np.append(at, size), np.append(x, 0.2)
            w = weights(at)
            g = (1 / (1 + np.exp(-np.clip(w @ x, -35, 35))) - y) * x
            step = (np.sqrt(n[at] + g * g) - np.sqrt(n[at])) / alpha
            z[at] += g - step * w
            n[at] += g * g
    return weights(np.arange(size + 1))


def fit(labelled: DataFrame, bits: int = 18, shards: int = 4, epochs: int = 10, alpha: float = 5.0, beta: float = 1.0, l1: float = 0.001, l2: float = 0.0001) -> np.ndarray:
    """Weights from rows (doc_id, text, label); the caller bounds their number (``sample_labels``)."""
    size = 1 << bits

    def run(batches):
        make = Features(bits)
        rows = [(i, *make(t or ""), int(y)) for b in batches for i, t, y in zip(*(b.column(c).to_pylist() for c in ("doc_id", "text", "label")), strict=True)]
        if rows:
            rows.sort(key=lambda r: zlib.crc32(str(r[0]).encode()))
            w = ftrl([r[1:] for r in rows], size, epochs, alpha, beta, l1, l2)
            at = np.flatnonzero(w)
            yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(w[at]), pa.array(np.full(len(at), len(rows), float))], names=["bucket", "w", "n"])

    dealt = labelled.select("doc_id", "text", "label").repartition(shards, "doc_id")
    found = dealt.mapInArrow(run, "bucket long, w double, n double").groupBy("bucket").agg(F.sum(F.col("w") * F.col("n")).alias("w"), F.sum("n").alias("n")).toPandas()
    out = np.zeros(size + 1)
    if len(found):
        out[found["bucket"].to_numpy()] = found["w"].to_numpy() / found["n"].max()
    return out


def sample_labels(labels: DataFrame, train_rows: int = 4_000, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """(doc_id, label) of at most about ``train_rows`` rows, by a hash of the id."""
    rows = labels.where(F.col(label_col).isNotNull() & F.col(id_col).isNotNull()).groupBy(F.col(id_col).alias("doc_id")).agg(F.max(F.col(label_col).cast("int")).alias("label"))
    total = rows.count()
    if total > train_rows:
        rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * train_rows / total))
    return rows


def score(df: DataFrame, weights: np.ndarray, text_col: str = "text", name: str = "score") -> tuple[DataFrame, str]:
    """``df`` with the score of each row, and the name of that column; repeated rows get it each time."""
    shared = df.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def fn(texts, kept={}):  # noqa: B006  one token table for each task
        w = shared.value
        make = kept.setdefault("make", Features((len(w) - 1).bit_length() - 1))
        out = []
        for text in texts:
            at, x = make(text)
            out.append(1 / (1 + np.exp(-np.clip(float(w[at] @ x) + 0.2 * float(w[-1]), -35, 35))))
        return {name: out}

    found, (column,) = with_columns(df, text_col, fn, {name: "double"})
    return found, column
