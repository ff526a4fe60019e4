"""Text tables, ledgers, id lists and document stores."""

from __future__ import annotations

import tempfile
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

LEDGER = "composer_id string, condition string, backend string, model string, effort string, prompt_version string, input_hash string, styles array<string>, primary_period string, confidence double, run_id string, batch_id string, created_at string"


def shared_folder(spark: SparkSession) -> str:
    """The folder of ``spark.checkpoint.dir``; a local session without one gets a temporary folder, on a cluster that is an error."""
    sc = spark.sparkContext
    if sc.getCheckpointDir() is None:
        named = sc.getConf().get("spark.checkpoint.dir", None)
        if named is None and not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        sc.setCheckpointDir(named or tempfile.mkdtemp(prefix="catalogloom-"))
    return sc.getCheckpointDir()


def checkpointed(df: DataFrame) -> DataFrame:
    """``df`` written to the shared folder, which cuts its lineage."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def read_tsv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """Every cell as text, '' for missing, quotes doubled, line feeds inside quotes kept; never inferred."""
    reader = spark.read.options(sep="\t", header=True, quote='"', escape='"', multiLine=True, ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    if columns:
        reader = reader.schema(StructType([StructField(c, StringType()) for c in columns]))
    return reader.csv(path).na.fill("")


def typed(cells: DataFrame, schema: str, keep: list[str] = ()) -> tuple[DataFrame, DataFrame]:
    """Text cells under an explicit schema ('' is null), and (keep, column, cell) of the cells that are not of their type; nothing is inferred.

    Whole numbers may be written with '.0'. Columns that the cells lack are null, others than the schema's are left out.
    """
    kinds = cells.sparkSession.createDataFrame([], schema).schema
    given = {c: F.trim(F.coalesce(F.col(c), F.lit(""))) for c in cells.columns}

    def read(field):
        cell, kind = given.get(field.name, F.lit("")), field.dataType.simpleString()
        bare = F.regexp_replace(cell, r"^([+-]?\d+)\.0+$", "$1") if kind in ("int", "bigint") else cell
        return F.when(cell != "", bare.try_cast(field.dataType))

    wrong = [F.when((given[f.name] != "") & read(f).isNull(), F.struct(F.lit(f.name).alias("column"), given[f.name].alias("cell"))) for f in kinds if f.name in given]
    faults = cells.select(*keep, F.explode(F.array_compact(F.array(*wrong))).alias("x")).select(*keep, "x.*")
    return cells.select(*(read(f).alias(f.name) for f in kinds)), faults


def write_tsv(df: DataFrame, path: str) -> None:
    """Text cells to ``path``, refusing to overwrite."""
    cells = df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in df.columns))
    cells.write.mode("errorifexists").options(sep="\t", header=True, quote='"', escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False).csv(path)


def _place() -> list[Column]:
    """File, place of the read block in it, and order within the block: together the order of the lines."""
    return [F.col("_metadata.file_name").alias("_file"), F.col("_metadata.file_block_start").alias("_block"), F.monotonically_increasing_id().alias("_line")]


def read_ledger(spark: SparkSession, path: str) -> DataFrame:
    """Decisions with their time (a zone is required) and ``line``, a place that sorts as the files' names and then their lines."""
    rows = spark.read.schema(LEDGER).json(path).select("*", *_place())
    return rows.withColumn("at", F.try_to_timestamp("created_at")).withColumn("line", F.struct("_file", "_block", "_line")).drop("_file", "_block", "_line")


def bad_times(ledger: DataFrame) -> DataFrame:
    """Decisions whose time has no zone or cannot be read."""
    return ledger.where(F.col("at").isNull() | ~F.col("created_at").rlike(r"(Z|[+-]\d{2}:?\d{2})$"))


def append_ledger(rows: DataFrame, path: str) -> None:
    rows.write.mode("append").json(path)


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """(id, place): lines of an id file without comments and blanks, in the file's order."""
    lines = spark.read.text(path).select("value", F.struct(*_place()).alias("place"))
    return lines.where(~F.col("value").rlike(r"^\s*(#|$)")).select(F.trim("value").alias("id"), "place")


def store_key(key: Column, most: int = 180) -> Column:
    """A document's key as a name of its own: each character that is no letter, digit, '.', '_' or '-' as '_', cut to ``most``; where that changed it, with 16 digits of its hash."""
    safe = F.substring(F.regexp_replace(key, r"[^\p{L}\p{N}._-]", "_"), 1, most)
    return F.when(safe == key, key).otherwise(F.concat(safe, F.lit("~"), F.substring(F.sha2(key, 256), 1, 16)))


def url_key(url: Column) -> Column:
    return F.sha2(url, 256)


def spread(df: DataFrame, *keys: str) -> DataFrame:
    """``df`` dealt by ``keys`` to as many tasks as a shuffle has: a small file's rows, or a few tasks' after a join, are not the work of one core where they are costly to read."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def write_by_url(pages: DataFrame, path: str, hashed: Callable[[Column], Column] = url_key, mode: str = "append") -> None:
    """(url, payload, stored_at) by hash, in folders by the hash's first two digits; the address stays beside the payload."""
    rows = pages.select("url", "payload", "stored_at", hashed(F.col("url")).alias("hash"))
    rows.withColumn("prefix", F.substring("hash", 1, 2)).repartition("prefix").write.mode(mode).partitionBy("prefix").parquet(path)


def read_by_url(wanted: DataFrame, path: str, hashed: Callable[[Column], Column] = url_key) -> DataFrame:
    """(url, payload, found) of each wanted address once: the payload stored last for it (of one time, the least).

    Entries of one hash are a chain; only those whose stored address is the wanted one count, so addresses that share a
    hash miss each other. Folders of other prefixes are not read where Spark prunes them by the wanted hashes.
    """
    stored = wanted.sparkSession.read.schema("url string, payload string, stored_at timestamp, hash string, prefix string").parquet(path)
    asked = wanted.select("url").distinct().withColumn("hash", hashed(F.col("url"))).withColumn("prefix", F.substring("hash", 1, 2))
    chain = stored.withColumnRenamed("url", "stored_url").join(asked, ["prefix", "hash"]).where(F.col("stored_url") == F.col("url"))
    last = chain.groupBy("url").agg(F.max("stored_at").alias("stored_at")).join(chain, ["url", "stored_at"]).groupBy("url").agg(F.min("payload").alias("payload"))
    return asked.select("url").join(last.withColumn("found", F.lit(True)), "url", "left").select("url", "payload", F.coalesce("found", F.lit(False)).alias("found"))


def read_documents(spark: SparkSession, path: str, namespace: str) -> DataFrame:
    """(key, payload) of a namespace; payloads that are no JSON count as absent."""
    rows = spark.read.parquet(path).where(F.col("namespace") == namespace)
    return rows.select("key", "payload").where(F.try_parse_json("payload").isNotNull())


def pending(wanted: DataFrame, stored: DataFrame, key: str = "key") -> DataFrame:
    """What a resumable fetch has still to get."""
    return wanted.join(stored.select(key).distinct(), key, "left_anti")


def resolve_titles(titles: DataFrame, redirects: DataFrame) -> DataFrame:
    """(title, target): each title at the end of its chain of normalisations and redirects, however long.

    Chains are shortened to half at each round (a redirect to a redirect becomes one to its target), so a chain of n
    takes about log2(n) rounds. What still moves after more rounds than the redirects allow has no end: a cycle raises.
    """
    step = checkpointed(redirects.groupBy(F.col("from").alias("from")).agg(F.min("to").alias("to")).where("`from` <> `to`"))
    rounds = max(step.count(), 1).bit_length() + 1
    while True:
        onward = step.select(F.col("from").alias("to"), F.col("to").alias("next"))
        joined = step.join(onward, "to", "left").select("from", F.coalesce("next", "to").alias("to"), F.col("next").isNotNull().alias("moved"))
        joined = checkpointed(joined)
        step = joined.select("from", "to")
        if joined.where("moved").isEmpty():
            break
        rounds -= 1
        if rounds < 0:
            raise ValueError("redirects form a cycle")
    return titles.select("title").join(step.withColumnRenamed("from", "title"), "title", "left").select("title", F.coalesce("to", "title").alias("target"))


def merge_page_lists(parts: DataFrame, key: str, values: str, prefix: str = "", wanted: DataFrame | None = None) -> DataFrame:
    """(key, title, values, missing, redirect): lists of pages that came in parts, as one list each.

    parts: key, part (order of arrival), title, values and, if there are any, missing and redirect. A value counts once, at
    its first arrival, without ``prefix``; flags hold if any part tells them; the title is the first part's. Only the least
    place of each (page, value) is kept, so repeated parts cost no memory: parts are dealt by page before their values
    stand in rows of their own, and nothing is shuffled after. A page of ``wanted`` without a part is missing.
    """
    flag = lambda c: F.coalesce(F.col(c), F.lit(False)) if c in parts.columns else F.lit(False)
    title = F.col("title") if "title" in parts.columns else F.lit("")
    each = parts.repartition(key).select(key, "part", F.coalesce(title, F.lit("")).alias("title"), flag("missing").alias("missing"), flag("redirect").alias("redirect"), F.posexplode_outer(values).alias("_at", "_v"))
    bare = F.when(F.col("_v").startswith(prefix), F.substring("_v", len(prefix) + 1, 1 << 30)).otherwise(F.col("_v"))
    first = each.groupBy(key, bare.alias("_v")).agg(F.min(F.struct("part", "_at")).alias("at"), F.min(F.struct("part", "title")).alias("t"), F.bool_or("missing").alias("missing"), F.bool_or("redirect").alias("redirect"))
    listed = F.transform(F.array_sort(F.collect_list(F.when(F.col("_v").isNotNull(), F.struct("at", F.col("_v").alias("v"))))), lambda x: x["v"])
    pages = first.groupBy(key).agg(F.min("t")["title"].alias("title"), listed.alias(values), F.bool_or("missing").alias("missing"), F.bool_or("redirect").alias("redirect"))
    if wanted is None:
        return pages
    return wanted.select(key).distinct().join(pages, key, "left").select(key, F.coalesce("title", F.lit("")).alias("title"), F.coalesce(values, F.array().cast("array<string>")).alias(values), F.coalesce("missing", F.lit(True)).alias("missing"), F.coalesce("redirect", F.lit(False)).alias("redirect"))


def monthly_sum(items: Column) -> Column:
    """Sum of a list of monthly views; null if the list is."""
    return F.aggregate(F.transform(items, lambda m: m["views"].cast("long")), F.lit(0).cast("long"), lambda a, v: a + F.coalesce(v, F.lit(0).cast("long")))


VIEWS = "struct<items:array<struct<views:bigint>>>"


def page_views(url, status, body) -> Column:
    """Views of an article by a stored answer: 0 if it is unknown (404), not a number without an article or after any other failure."""
    read = F.from_json(body, VIEWS)
    total = F.coalesce(monthly_sum(read["items"]), F.lit(0)).cast("double")
    good = status.between(200, 299) & F.try_parse_json(body).isNotNull()
    return F.when(~F.contains(F.coalesce(url, F.lit("")), F.lit("/wiki/")), float("nan")).when(status == 404, 0.0).when(F.coalesce(good, F.lit(False)), total).otherwise(float("nan"))


def entities_of(answers: DataFrame, body: str) -> DataFrame:
    """(id, entity, missing): each entity of stored answers once, as JSON text; one that an answer marks as missing is told apart, and one that any answer has is there."""
    each = answers.select(F.explode(F.from_json(F.get_json_object(body, "$.entities"), "map<string,string>")).alias("id", "entity"))
    gone = F.get_json_object("entity", "$.missing").isNotNull()
    return each.groupBy("id").agg(F.max(F.when(~gone, F.col("entity"))).alias("entity")).withColumn("missing", F.col("entity").isNull())
