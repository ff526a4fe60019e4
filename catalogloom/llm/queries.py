"""Queries of the training-data operators, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import decontamination, divergence, embeddings, exact_substrings, language_id, lexical_search, license_scan, line_dedup, packing, quality, repetition, simhash, token_counts
from .common import table

BPE_JSON, BPE_RANKS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("byte_bpe_50k.tiktoken")


#: Documents with a lower score are rejected.
QUALITY_AT = 0.3
#: Most pieces of a sequence of 1024 tokens.
SEGMENTS = 128


def remainder():
    """crc32 of the id as text, mod 5; a row without an id has that of the empty text."""
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(5))


def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.token_counts(table(spark, sf_dir, "documents"), BPE_RANKS)


def op2_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return license_scan.license_scan(table(spark, sf_dir, "documents"))


def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = exact_substrings.remove_repeats(table(spark, sf_dir, "documents"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return found.select("doc_id", "n_bytes", removed.alias("n_removed"), F.size("spans").cast("long").alias("n_spans"), F.sha2("kept", 256).alias("kept_sha256"))


def op4_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.near_duplicates(table(spark, sf_dir, "documents"))


def op5_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.pack(table(spark, sf_dir, "documents"), BPE_JSON, BPE_RANKS, max_segments=SEGMENTS)
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embeddings.near_duplicates(table(spark, sf_dir, "embeddings"))


def op7_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    found, hits = decontamination.find_hits(table(spark, sf_dir, "documents").select("doc_id", "text"), table(spark, sf_dir, "benchmark"))
    items = F.array_sort(F.array_distinct(F.transform(hits, lambda h: h["item_id"])))
    least = F.array_min(F.transform(hits, lambda h: h["edits"]))
    return found.select("doc_id", (F.size(hits) > 0).alias("contaminated"), F.size(items).alias("n_items"), items.alias("item_ids"), least.alias("least_edits"))


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found, gone = line_dedup.line_dedup(docs)
    text = F.coalesce("text", F.lit(""))
    removed = F.coalesce(F.size(gone), F.lit(0)).cast("long")
    kept_lines = F.when(text == "", 0).otherwise(F.size(F.split(text, "\n", -1))).cast("long")
    return found.select("doc_id", kept_lines.alias("n_kept_lines"), removed.alias("n_removed"), F.sha2(text, 256).alias("kept_sha256"))


def op9_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.identify(docs, language_id.fit(docs.where(remainder() != 0)))
    return found.select("doc_id", (remainder() == 0).alias("held_out"), "lang_pred", "score", F.array_join("langs", ",").alias("langs"))


def quality_weights(spark: SparkSession, docs: DataFrame, sf_dir: str):
    """Weights from labelled rows of the training folds."""
    picked = F.broadcast(quality.sample_labels(table(spark, sf_dir, "labels").where(remainder() != 0)))
    once = docs.select("doc_id", "text").join(picked, "doc_id").groupBy("doc_id").agg(F.min("text").alias("text"), F.max("label").alias("label"))
    return quality.fit(once)  # a row for each id, however often documents repeat it


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found, score = quality.score(docs.select("doc_id", "text"), quality_weights(spark, docs, sf_dir))
    return found.select("doc_id", (remainder() == 0).alias("held_out"), score, (F.col(score) >= QUALITY_AT).cast("int").alias("predicted"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.divergences(table(spark, sf_dir, "documents"))


def op12_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lexical_search.search(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op13_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repetition.repetition_rules(table(spark, sf_dir, "documents")).drop("longest_repeat")


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {f.__name__: f for f in (op1_token_counts, op2_license_scan, op3_suffix_dedup, op4_simhash, op5_packing, op6_embedding_dedup, op7_decontamination, op8_line_dedup, op9_language_id, op10_quality, op11_source_divergence, op12_lexical_search, op13_quality_rules)}

#: The same rows on another engine, where SQL can say them: cosines of all pairs and their transitive closure, and
#: Levenshtein distances of distinct lines of like length.
ORACLES: dict[str, str] = {
    "op3_suffix_dedup": """WITH t AS (SELECT row_number() OVER (ORDER BY doc_id) AS r, doc_id, hex(encode(coalesce(text, ''))) AS h FROM documents), w AS (SELECT r, p, hash(substring(h, 2 * p + 1, 400)) AS k FROM (SELECT r, h, unnest(range(0, len(h) // 2 - 199)) AS p FROM t)),
    d AS (SELECT r, p FROM w WHERE k IN (SELECT k FROM w GROUP BY k HAVING count(*) > 1)), i AS (SELECT r, p, sum(new) OVER (PARTITION BY r ORDER BY p) AS island FROM (SELECT r, p, CASE WHEN p <= lag(p) OVER (PARTITION BY r ORDER BY p) + 200 THEN 0 ELSE 1 END AS new FROM d)),
    s AS (SELECT r, island, min(p) AS a, max(p) + 200 AS z FROM i GROUP BY r, island), g AS (SELECT r, a, z, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS before FROM s), m AS (SELECT t.r, string_agg(substring(h, 2 * before + 1, 2 * (a - before)), '' ORDER BY a) AS kept, sum(z - a) AS n_removed, count(*) AS n_spans, max(z) AS last FROM g JOIN t USING (r) GROUP BY t.r)
    SELECT doc_id, len(h) // 2 AS n_bytes, CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed, coalesce(n_spans, 0) AS n_spans, sha256(unhex(CASE WHEN m.r IS NULL THEN h ELSE kept || substring(h, 2 * last + 1) END)) AS kept_sha256 FROM t LEFT JOIN m USING (r)""",
    "op6_embedding_dedup": """WITH RECURSIVE v AS (SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings), g AS (SELECT * FROM v WHERE e IS NOT NULL AND len(e) > 0 AND len(list_filter(e, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(e, lambda x: x <> 0)) > 0),
    link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM g a JOIN g b ON a.vec_id <> b.vec_id AND len(a.e) = len(b.e) WHERE list_cosine_similarity(a.e, b.e) >= 0.95), reach(a, b) AS (SELECT vec_id, vec_id FROM v UNION SELECT reach.a, link.b FROM reach JOIN link ON reach.b = link.a)
    SELECT vec_id, (SELECT count(*) FROM link WHERE link.a = vec_id) AS n_links, c AS component_id, c = vec_id AS kept FROM v JOIN (SELECT a, min(b) AS c FROM reach GROUP BY a) ON a = vec_id""",
    "op8_line_dedup": """WITH l AS (SELECT doc_id, i, x, trim(regexp_replace(lower(x), '\\s+', ' ', 'g')) AS n, row_number() OVER (ORDER BY doc_id, i) AS s FROM (SELECT doc_id, unnest(string_split(text, chr(10))) AS x, generate_subscripts(string_split(text, chr(10)), 1) AS i FROM documents WHERE text IS NOT NULL)),
    k AS (SELECT n, min(s) AS f, length(n) AS w FROM l WHERE n <> '' GROUP BY n), near AS (SELECT DISTINCT b.n FROM (SELECT n, f, w + unnest([-1, 0, 1]) AS w FROM k WHERE w >= 16) a JOIN k b ON a.w = b.w WHERE b.w >= 16 AND a.f < b.f AND levenshtein(a.n, b.n) <= 1),
    d AS (SELECT l.*, l.n <> '' AND (s > f OR near.n IS NOT NULL) AS gone FROM l LEFT JOIN k ON k.n = l.n LEFT JOIN near ON near.n = l.n), t AS (SELECT doc_id, count(*) FILTER (gone) AS n_removed, coalesce(string_agg(x, chr(10) ORDER BY i) FILTER (NOT gone), '') AS text FROM d GROUP BY doc_id)
    SELECT doc_id, CASE WHEN coalesce(t.text, '') = '' THEN 0 ELSE len(string_split(t.text, chr(10))) END AS n_kept_lines, coalesce(n_removed, 0) AS n_removed, sha256(coalesce(t.text, '')) AS kept_sha256 FROM documents LEFT JOIN t USING (doc_id)""",
    "op11_source_divergence": """WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS x FROM documents),
    w AS (SELECT r, lang, source, unnest(regexp_extract_all(x, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d), k AS (SELECT lang, term, CAST(count(*) AS HUGEINT) AS n FROM w GROUP BY lang, term HAVING count(DISTINCT r) >= 3), v AS (SELECT lang, CAST(count(*) AS HUGEINT) AS v, sum(n) AS n FROM k GROUP BY lang),
    c AS (SELECT w.lang, source, term, CAST(count(*) AS HUGEINT) AS n FROM w JOIN k USING (lang, term) GROUP BY w.lang, source, term), s AS (SELECT g.lang, g.source, coalesce(sum(n), 0) AS n FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN c USING (lang, source) GROUP BY g.lang, g.source),
    p AS (SELECT s.lang, s.source, term, c.n, 1 + 1000000000 * (coalesce(c.n, 0) + 1) // (s.n + v.v) AS p, 1 + 1000000000 * (k.n + 1) // (v.n + v.v) AS q FROM s JOIN v USING (lang) JOIN k USING (lang) LEFT JOIN c USING (lang, source, term)),
    pairs AS (SELECT a.lang, a.source, b.source AS item, coalesce(f.value, 0) AS value FROM s a JOIN s b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL) f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
    found AS (SELECT lang, source, 'pair' AS part, item, value FROM pairs UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // q FROM p WHERE n > 0 AND p > q), ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank FROM found)
    SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 200""",
    "op12_lexical_search": """WITH w AS (SELECT r, doc_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (SELECT row_number() OVER () AS r, * FROM documents)),
    n AS (SELECT r, doc_id, count(*) AS n FROM w GROUP BY r, doc_id), s AS (SELECT count(*) AS docs, CAST(sum(n) AS BIGINT) AS total FROM n), tf AS (SELECT r, term, count(*) AS tf FROM w GROUP BY r, term), df AS (SELECT term, CAST(floor(1000 * ln((2 * max(docs) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM tf, s GROUP BY term),
    i AS (SELECT k, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM (SELECT row_number() OVER () AS k, * FROM benchmark)),
    f AS (SELECT k, item_id, r, n.doc_id, sum(df.w * (1000000000 * tf // (1000 * tf + 8 * (25 + 75 * n * docs // total)))) AS score FROM i JOIN tf USING (term) JOIN df USING (term) JOIN n USING (r), s GROUP BY k, item_id, r, n.doc_id),
    o AS (SELECT *, row_number() OVER (PARTITION BY k ORDER BY score DESC, doc_id) AS rank FROM f WHERE score > 0) SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, CAST(score AS BIGINT) AS score FROM o WHERE rank <= 10""",
    "op13_quality_rules": """WITH d AS (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS x FROM documents), w AS (SELECT r, doc_id, x, regexp_extract_all(x, '[^\x20\x09-\x0D]+') AS ws FROM d),
    k AS (SELECT r, m, i, count(*) OVER (PARTITION BY r, m, h) AS c FROM (SELECT r, m, i, hash(ws[i:i + m - 1]) AS h FROM (SELECT r, ws, m, unnest(range(1, len(ws) - m + 2)) AS i FROM w, (SELECT unnest([5, 16, 51]) AS m)))),
    s AS (SELECT r, m, i, coalesce(lag(i) OVER (PARTITION BY r, m ORDER BY i), i - m) AS before FROM k WHERE c > 1), g AS (SELECT r, coalesce(sum(least(m, i - before)) FILTER (m = 5), 0) AS n5, coalesce(sum(least(m, i - before)) FILTER (m = 16), 0) AS n16, count(*) FILTER (m = 51) AS n51 FROM s GROUP BY r),
    l AS (SELECT r, count(*) - count(DISTINCT y) AS n FROM (SELECT r, unnest(string_split(x, chr(10))) AS y FROM d) WHERE regexp_matches(y, '[^\x20\x09-\x0D]') GROUP BY r),
    f AS (SELECT doc_id, len(ws) AS n_words, coalesce(list_sum(list_transform(ws, lambda y: length(y))), 0) AS word_chars, length(regexp_replace(x, '[^#*$%&|<>]', '', 'g')) AS n_symbols, coalesce(l.n, 0) AS n_dup_lines, coalesce(n5, 0) AS n_repeat_words, coalesce(n16, 0) AS n_covered, coalesce(n51, 0) AS n51 FROM w LEFT JOIN g USING (r) LEFT JOIN l USING (r))
    SELECT doc_id, n_words, CAST(word_chars AS BIGINT) AS word_chars, n_symbols, n_dup_lines, CAST(n_repeat_words AS BIGINT) AS n_repeat_words, n_words < 10 OR 100 * n_repeat_words > 20 * n_words AS base_failed, CAST(n_covered AS BIGINT) AS n_covered, n_words >= 10 AND 100 * n_repeat_words <= 20 * n_words AND n_covered <= 0.1 * n_words AND n51 = 0 AS kept FROM f""",
}
