"""Cells of works from their page documents: licence blocks, open-licence cells, category refresh."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cells import join_cell, split_cell, text
from ..functions.licences import file_formats, is_open, licence_id
from .markup import template_blocks

#: Templates of score and audio blocks.
KINDS = {"#fte:imslpfile": "score", "#fte:imslpaudio": "audio"}
#: Forms that a genre cell keeps beside 'For …'.
FORMS = "Sonatas Symphonies Quartets Quintets Trios Duets Concertos Overtures Suites Variations Preludes Fugues Etudes Songs Lieder Masses Operas Ballets Cantatas Oratorios Pieces Waltzes Marches Nocturnes Rondos".split()
#: Fields of a block that become columns of the same name.
PLAIN = ["Image Type", "Editor", "Arranger", "Uploader", "Date Submitted"]


def block_rows(pages: DataFrame, key: str, source: str, also: list[str] = ()) -> DataFrame:
    """A row per licence block of a page: its number, kind, section, files, licence and the people it names, with the page's columns ``also``."""
    given = F.struct(key, *also).alias("_page")
    found = template_blocks(pages.select(given, source), "_page", source).withColumn("kind", F.try_element_at(F.create_map(*(F.lit(x) for kv in KINDS.items() for x in kv)), F.col("name"))).where("kind is not null")
    field = lambda n: F.coalesce(F.try_element_at("fields", F.lit(n)), F.lit(""))
    names = F.filter(F.map_values(F.map_filter("fields", lambda k, _: k.rlike(r"^File Name( \d+)?$"))), lambda v: v != "")
    licence = licence_id(field("Copyright"))
    plain = [field(n).alias(n.lower().replace(" ", "_")) for n in PLAIN]
    rows = found.select("_page.*", (F.col("place") + 1).alias("block"), "kind", "section", F.size(names).alias("n_files"), join_cell(file_formats(names)).alias("formats"), *plain, field("Copyright").alias("copyright_raw"), licence.alias("licence"), join_cell(names).alias("file_names"))
    return rows.withColumn("open_licence", is_open("licence"))


#: The columns of a block's row, in order.
BLOCK_COLUMNS = ["work_id", "composer_id", "imslp_pageid", "block", "kind", "section", "n_files", "formats", "image_type", "copyright_raw", "licence", "open_licence", "editor", "arranger", "uploader", "date_submitted", "file_names", "revid"]


def full_block_rows(works: DataFrame, documents: DataFrame) -> DataFrame:
    """Rows of ``BLOCK_COLUMNS``: the blocks of works whose page is at hand, neither missing nor redirected.

    works: work_id, composer_id, imslp_pageid. documents: imslp_pageid, wikitext, revid and, if there are any, missing, redirect. Blocks are
    numbered from 1 among the file blocks of their page.
    """
    gone = [F.coalesce(F.col(c), F.lit(False)) for c in ("missing", "redirect") if c in documents.columns]
    there = documents.where(~reduce(lambda a, b: a | b, gone, F.lit(False))).select("imslp_pageid", "wikitext", "revid")
    rows = block_rows(there, "imslp_pageid", "wikitext", ["revid"]).withColumnRenamed("block", "_place")
    counted = rows.groupBy("imslp_pageid").agg(F.array_sort(F.collect_list("_place")).alias("_all"))  # numbers of one page's blocks
    numbered = rows.join(counted, "imslp_pageid").withColumn("block", F.array_position("_all", F.col("_place")).cast("int"))
    return works.select("work_id", "composer_id", "imslp_pageid").join(numbered, "imslp_pageid").select(*BLOCK_COLUMNS)


def work_summary(blocks: DataFrame, key: str = "work_id") -> DataFrame:
    """One row per work with a score block: blocks, licences, and the same of its open blocks with their formats and whether one was typeset."""
    scores = blocks.where("kind = 'score'")
    is_open_ = F.col("open_licence")
    listed = lambda c: F.array_join(F.array_sort(F.collect_set(c)), "|")
    typeset = F.lower("image_type").contains("typeset") | F.lower("image_type").contains("new")
    told = scores.groupBy(key).agg(
        F.count(F.lit(1)).alias("n_score_blocks"),
        listed(F.when(F.col("licence") != "", F.col("licence"))).alias("score_licences"),
        F.count_if(is_open_).alias("n_open_score_blocks"),
        listed(F.when(is_open_, F.col("licence"))).alias("open_score_licences"),
        F.collect_set(F.when(is_open_, F.col("formats"))).alias("_formats"),
        F.bool_or(F.when(is_open_, typeset)).alias("open_score_typeset"),
    )
    formats = F.array_sort(F.array_distinct(F.flatten(F.transform("_formats", split_cell))))
    return told.withColumn("open_score_formats", F.array_join(formats, "|")).drop("_formats")


def block_report(blocks: DataFrame, key: str = "work_id", owner: str = "composer_id", top: int = 40, top_unparsed: int = 15) -> DataFrame:
    """(section, name, value, n): the most frequent (kind, licence), raw values that no rule reads, and how many works and owners have an open score block; one scan, a report's heads."""
    facts = F.array_compact(
        F.array(
            F.struct(F.lit("licence").alias("section"), F.col("kind").alias("name"), F.col("licence").alias("value")),
            F.when(F.col("licence") == "unparsed", F.struct(F.lit("unparsed").alias("section"), F.lit("").alias("name"), F.col("copyright_raw").alias("value"))),
        )
    )
    counts = blocks.select(F.explode(facts).alias("x")).groupBy("x.section", "x.name", "x.value").agg(F.count(F.lit(1)).alias("n"))
    head = lambda section, n: counts.where(F.col("section") == section).orderBy(F.desc("n"), "name", "value").limit(n)
    open_ = blocks.where("kind = 'score' AND open_licence").agg(F.count_distinct(key).alias("works"), F.count_distinct(owner).alias("owners"))
    told = F.array(*(F.struct(F.lit("open").alias("section"), F.lit(c).alias("name"), F.lit("").alias("value"), F.col(c).alias("n")) for c in ("works", "owners")))
    return head("licence", top).unionByName(head("unparsed", top_unparsed)).unionByName(open_.select(F.explode(told).alias("x")).select("x.*"))


def open_cells(works: DataFrame, blocks: DataFrame, key: str, status: str) -> DataFrame:
    """(key, licences, scope, formats) of each work; '' without an open score block.

    The scope is 'composition' if an open block is a new composition of somebody who is not in the public domain and
    was arranged by nobody else; otherwise only the edition is open.
    """
    arranger = F.lower(F.trim("arranger"))
    own = F.trim("image_type").rlike("(?i)^new composition") & arranger.isin("", "composer")
    scores = blocks.where("kind = 'score' and open_licence")
    told = scores.groupBy(key).agg(F.collect_set("licence").alias("l"), F.max(own).alias("own"), F.collect_set("formats").alias("f"))
    formats = F.array_sort(F.array_distinct(F.flatten(F.transform("f", split_cell))))
    joined = works.select(key, status).join(told, key, "left")
    scope = F.when(F.col("own").isNull(), "").when(F.col("own") & (F.trim(text(status)) != "pd"), "composition").otherwise("edition")
    return joined.select(key, F.coalesce(F.array_join(F.array_sort("l"), "|"), F.lit("")).alias("licences"), scope.alias("scope"), F.coalesce(F.array_join(formats, "|"), F.lit("")).alias("formats"))


def licence_counts(blocks: DataFrame, top: int = 40) -> DataFrame:
    """(kind, licence, n): the most frequent pairs (a report's head)."""
    return blocks.groupBy("kind", "licence").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "kind", "licence").limit(top)


def genre_categories(categories: Column, own: Column) -> Column:
    """Categories that tell forces or forms, without the person's own."""
    plain = lambda c: F.replace(F.regexp_replace(c, "^Category:", ""), F.lit("_"), F.lit(" "))
    return F.filter(categories, lambda c: (c.startswith("For ") | c.isin(FORMS)) & (plain(c) != plain(text(own))) & ~c.rlike("/(Editor|Arranger)$"))


def refresh_categories(works: DataFrame, pages: DataFrame, key: str, cell: str, own: str) -> DataFrame:
    """``works`` with their cell made anew where the page is at hand, and ``state``: absent, missing, redirect or refreshed."""
    there = pages.select(key, F.lit(True).alias("_there"), "missing", "redirect", "categories")
    joined = works.join(there, key, "left")
    state = F.when(F.col("_there").isNull(), "absent").when(F.col("missing"), "missing").when(F.col("redirect"), "redirect").otherwise("refreshed")
    fresh = join_cell(genre_categories(F.coalesce("categories", F.array().cast("array<string>")), F.col(own)))
    new = F.when(state == "refreshed", fresh).otherwise(text(cell))
    return joined.select(*(c for c in works.columns if c != cell), new.alias(cell), state.alias("state"), (new != text(cell)).alias("changed"))


def refresh_statistics(refreshed: DataFrame, cell: str) -> DataFrame:
    """(state, n, changed, empty) of a refresh."""
    return refreshed.groupBy("state").agg(F.count(F.lit(1)).alias("n"), F.count_if("changed").alias("changed"), F.count_if(F.col(cell) == "").alias("empty"))


def category_members(listings: DataFrame, key: str, members: str) -> DataFrame:
    """(key, pageid, title): members of categories that are pages proper (name space 0), each once."""
    each = listings.select(key, F.explode(members).alias("m"))
    return each.where(F.coalesce("m.ns", F.lit(0)) == 0).select(key, "m.pageid", "m.title").distinct()


def without_content(pages: DataFrame) -> DataFrame:
    """Pages that are there but came without text: to be asked for again, one by one."""
    return pages.where((text("wikitext") == "") & ~F.coalesce("missing", F.lit(False)) & ~F.coalesce("redirect", F.lit(False)))


MEMBER = "struct<gndIdentifier:string,preferredName:string,type:array<string>,dateOfBirth:array<string>,dateOfDeath:array<string>,professionOrOccupation:array<struct<id:string,label:string>>>"


def authority_record(json: Column) -> Column:
    """The fields of an authority record that later stages read."""
    m = F.from_json(json, MEMBER)
    none = F.array().cast("array<string>")
    listed = lambda c: F.coalesce(c, none)
    jobs = lambda f: F.coalesce(F.filter(F.transform(m["professionOrOccupation"], lambda p: p[f]), lambda x: F.coalesce(x, F.lit("")) != ""), none)
    return F.struct(m["gndIdentifier"].alias("id"), m["preferredName"].alias("name"), listed(m["type"]).alias("types"), listed(m["dateOfBirth"]).alias("born"), listed(m["dateOfDeath"]).alias("died"), jobs("id").alias("professions"), jobs("label").alias("profession_labels"))
