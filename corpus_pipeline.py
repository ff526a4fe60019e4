"""The corpus pipeline: quality, line dedup, SimHash near-dedup, decontamination, packing.

Each stage takes (spark, docs, sf_dir) and returns a DataFrame, which is written as Parquet and read again as
the next stage's documents. All but the last return the columns of documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogloom.llm import decontamination, line_dedup, packing, quality, queries, simhash
from catalogloom.llm.common import cut, drop_written, table


def good_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier does not reject."""
    found, score = quality.score(docs, queries.quality_weights(spark, docs, sf_dir))
    return found.where(F.col(score) >= queries.QUALITY_AT).select(*docs.columns)


def distinct_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without lines that an earlier line repeats; one that loses its last line with words goes."""
    found, gone = line_dedup.line_dedup(docs)
    emptied = F.col(gone).isNotNull() & (F.trim(F.regexp_replace("text", r"\s+", "")) == "")
    kept = found.where(~F.coalesce(emptied, F.lit(False)))
    return kept.withColumn("n_chars", F.when(F.col(gone).isNull(), F.col("n_chars")).otherwise(F.char_length("text").cast("long"))).select(*docs.columns)


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of SimHash near-duplicates: the one with the smallest id."""
    return simhash.one_of_each(docs).select(*docs.columns)


def uncontaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    found, hits = decontamination.find_hits(docs, table(spark, sf_dir, "benchmark"))
    return found.where(F.size(hits) == 0).select(*docs.columns)


def packed(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of token sequences."""
    return packing.pack(docs, queries.BPE_JSON, queries.BPE_RANKS, max_segments=queries.SEGMENTS)


STAGES = [
    ("quality", good_quality),
    ("line_dedup", distinct_lines),
    ("simhash_dedup", one_of_each),
    ("decontamination", uncontaminated),
    ("packing", packed),
]

#: A trained classifier and a tokenizer have no SQL form; tests/llm hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages; what a stage has written is deleted once the next one's result is."""
    docs, written = table(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES):
        if k:
            docs, before = cut(docs), written
            written = docs
            if before is not None:
                drop_written(before)
        docs = stage(spark, docs, sf_dir)
    return docs
