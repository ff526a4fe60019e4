"""Language identification as inference of a mixture.

Each language has a smoothed multinomial over hashed byte trigrams of lower-cased text, counted by Spark
over the training rows (at most about ``train_rows`` of them, picked by a hash of the id: a bounded,
documented sample). A document is a mixture of languages: expectation-maximisation estimates the
proportions from the trigrams' likelihoods. The set of languages grows from the best single one while
the penalised likelihood (log likelihood less ``penalty`` * log n for each further language) improves.
The prediction is the language with the largest proportion, the score that proportion.

Whole texts are read; a long text is reduced to at most ``BUCKETS`` trigram counts. Null texts and texts
without a letter give ``und`` with score 0. Rows without a language train nothing. Equal proportions are ordered
by the language's name; rows that repeat are predicted each time.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_batches, sliced

BUCKETS = 1 << 15


def trigrams(text: str) -> tuple[np.ndarray, np.ndarray | None]:
    """Buckets of the text's byte trigrams, and how often each occurs (None: once each, as listed)."""
    b = np.frombuffer(f" {' '.join(text.lower().split())} ".encode("utf-8", "surrogatepass"), np.uint8).astype(np.uint32)
    h = (b[:-2] * np.uint32(0x9E3779B1) + b[1:-1] * np.uint32(0x85EBCA77) + b[2:] * np.uint32(0xC2B2AE3D)) >> np.uint32(17)
    if len(h) < 20_000:
        return h, None
    n = np.bincount(h, minlength=BUCKETS)
    at = np.flatnonzero(n)
    return at, n[at].astype(float)


def has_letter(text: str) -> bool:
    return any(map(str.isalpha, text))


def expect_maximise(like: np.ndarray, n: np.ndarray | None, rounds: int = 100, tol: float = 1e-3) -> tuple[np.ndarray, float]:
    """Proportions and log likelihood; ``like``: languages x trigrams, each column scaled to at most 1.

    Rounds go on until no proportion moves by ``tol``; ``rounds`` only ends what does not settle.
    """
    share = np.full(len(like), 1 / len(like))
    total = like.shape[1] if n is None else n.sum()
    for _ in range(rounds):
        weight = 1 / (share @ like) if n is None else n / (share @ like)
        new = share * (like @ weight) / total
        done = np.abs(new - share).max() < tol
        share = new
        if done:
            break
    logs = np.log(share @ like)
    return share, float(logs.sum() if n is None else logs @ n)


def infer(probs: np.ndarray, text: str, penalty: float) -> tuple[list[int], np.ndarray]:
    """The selected languages, by proportion, and all proportions (0 outside the set)."""
    at, n = trigrams(text)
    like = probs[:, at].astype(float)
    like /= like.max(0)
    share, _ = expect_maximise(like, n)
    order = np.argsort(-share, kind="stable")
    chosen, held = [int(order[0])], np.ones(1)
    total = len(at) if n is None else n.sum()
    _, best = expect_maximise(like[chosen], n)
    for k in order[1:]:
        part, value = expect_maximise(like[[*chosen, int(k)]], n)
        if value - best <= penalty * np.log(total + 1):
            break
        chosen, held, best = [*chosen, int(k)], part, value
    out = np.zeros(len(probs))
    out[chosen] = held
    return sorted(chosen, key=lambda k: -out[k]), out


def fit(train: DataFrame, train_rows: int = 20_000, text_col: str = "text", lang_col: str = "lang", id_col: str = "doc_id") -> dict[str, np.ndarray]:
    """Language -> trigram likelihood table, from at most about ``train_rows`` rows; every label of these rows is learned.

    Counts are added up by (language, bucket) and packed into a row for each language by Spark. The model has ``BUCKETS``
    numbers of four bytes for each label of the sample: 128 KB, 39 MB for 300 labels.
    """
    rows = train.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = rows.where("text is not null and lang is not null")
    total = rows.select("doc_id").count()
    if total > train_rows:
        rows = rows.where(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < int((1 << 30) * train_rows / total))

    def count(batches):
        counts: dict[str, np.ndarray] = {}
        for b in sliced(batches):
            for text, lang in zip(b.column("text").to_pylist(), b.column("lang").to_pylist(), strict=True):
                at, n = trigrams(text)
                counts[lang] = counts.get(lang, 0) + np.bincount(at, n, minlength=BUCKETS)
        for lang, n in counts.items():
            at = np.flatnonzero(n)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(at)), pa.array(at, pa.int32()), pa.array(n[at], pa.float64())], names=["lang", "bucket", "n"])

    def pack(part: pa.Table) -> pa.Table:
        n = np.full(BUCKETS, 0.5)
        n[part.column("bucket").to_numpy()] += part.column("n").to_numpy()
        return pa.table({"lang": part.column("lang")[:1], "likelihoods": pa.array([(n / n.sum()).astype("<f4").tobytes()], pa.binary())})

    found = rows.select("text", "lang").mapInArrow(count, "lang string, bucket int, n double").groupBy("lang", "bucket").agg(F.sum("n").alias("n"))
    tables = found.groupBy("lang").applyInArrow(pack, "lang string, likelihoods binary").collect()  # a row for each label of the sample
    return {r["lang"]: np.frombuffer(r["likelihoods"], "<f4") for r in sorted(tables, key=lambda r: r["lang"])}


def identify(df: DataFrame, tables: dict[str, np.ndarray], penalty: float = 10.0, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: lang_pred, score, the selected languages and the proportions of all learned ones."""
    names = list(tables)
    probs = np.array([tables[k] for k in names], np.float32) if names else np.zeros((0, BUCKETS), np.float32)
    shared = df.sparkSession.sparkContext.broadcast(probs)

    def fn(batch):
        pred, score, langs, share = [], [], [], []
        for text in batch.column("text").to_pylist():
            if not names or text is None or not has_letter(text):
                chosen, part = [], np.zeros(len(names))
            else:
                chosen, part = infer(shared.value, text, penalty)
            pred.append(names[chosen[0]] if chosen else "und")
            score.append(min(1.0, float(part[chosen[0]])) if chosen else 0.0)
            langs.append([names[k] for k in chosen])
            share.append(part.tolist())
        yield {"doc_id": batch.column("doc_id"), "lang_pred": pred, "score": score, "langs": langs, "shares": share}

    rows = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return map_batches(rows, fn, "doc_id long, lang_pred string, score double, langs array<string>, shares array<double>")
