"""The derivation of a snapshot: nine stages in their order, each from tables to tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cells import join_cell, split_cell, text, year
from ..sources.tables import checkpointed
from . import forces, ledger, overlay, resolve, rollups, status, works

Tables = dict[str, DataFrame]
Stage = tuple[str, Callable[[Tables], Tables]]
#: The stages' names, in order.
ORDER = ["remap_force", "carry_forward", "remap_people", "apply_overrides", "remap_authorities", "remap_matches", "remap_evidence", "remap_open_licences", "apply_styles"]
OVERRIDABLE = ["death_year"]


def _put(df: DataFrame, **columns) -> DataFrame:
    """``df`` with columns replaced in place or added."""
    return df.withColumns(columns)


def remap_force(t: Tables) -> Tables:
    """Labels of works by categories, instrumentation and titles, with where they come from."""
    found = forces.with_provenance(F.col("cell"), F.col("title"), F.col("instrumentation"), F.col("family"), F.col("src"))
    made = t["works"].withColumn("_f", found)
    return {"works": _put(made, family=F.col("_f.family"), src=F.col("_f.src")).drop("_f")}


def carry_forward(t: Tables) -> Tables:
    """Decisions of the base snapshot that weak labels do not replace."""
    return {"works": overlay.carry_forward(t["works"], t["base_works"], ["id", "work_id"], "family", "src", [], forces.WEAK).drop("carried")}


def remap_people(reference: int, vocabulary: list[str]) -> Callable[[Tables], Tables]:
    """Rollups of works and terms of protection."""

    def stage(t: Tables) -> Tables:
        rolled = rollups.present_counts(t["people"].select("id"), t["works"], "id", "id", "family", vocabulary).select("id", F.col("present").alias("_p"), F.col("total").alias("_n"))
        joined = t["people"].join(rolled, "id").withColumn("_t", status.term(F.col("death_year"), reference))
        return {"people": _put(joined, present=F.col("_p"), n_works=F.col("_n"), eu_pd_status=F.col("_t.status"), eu_pd_year=F.col("_t.year")).drop("_p", "_n", "_t")}

    return stage


def apply_overrides(reference: int, vocabulary: list[str]) -> Callable[[Tables], Tables]:
    """Corrections in the order of their file, with what follows from them."""

    def stage(t: Tables) -> Tables:
        people, following = overlay.apply_in_order(t["people"], t["works"], t["overrides"], t["entities"], "id", OVERRIDABLE, {}, reference, "family", vocabulary)
        return {"people": people, "works": following}

    return stage


def remap_authorities(t: Tables) -> Tables:
    """Authority ids and their flags. authorities: id, has_entity, own, has_record, record_death, has_search, found, found_death."""
    known = t["people"].join(t["authorities"], "id", "left")
    held = _put(known, death=year(F.col("death_year")), prior_id=text("authority_id"), prior_flags=split_cell("qa_flags"), **{c: F.coalesce(c, F.lit(False)) for c in ("has_entity", "has_record", "has_search")})
    told = resolve.authority_with_prior(held.drop("authority_id"))
    flags = join_cell(split_cell("authority_flags"))
    return {"people": _put(told, qa_flags=F.when(F.col("has_entity"), flags).otherwise(F.col("qa_flags"))).select(*(c for c in t["people"].columns if c != "authority_id"), "authority_id")}


def remap_matches(t: Tables) -> Tables:
    """Works leave whose person's link no longer holds; links: id, match_after."""
    linked = t["people"].join(t["links"], "id", "left").withColumn("match_after", F.coalesce("match_after", "imslp_match_status"))
    kept, report = resolve.remap_matches(linked, t["works"], "id", "imslp_match_status", "match_after")
    return {"works": kept, "people": _put(linked, imslp_match_status=F.col("match_after")).drop("match_after"), "match_report": report}


def remap_evidence(t: Tables) -> Tables:
    """Styles, first publication, rights and hosts of files of works whose page is at hand; pages: work_id, categories, files."""
    joined = t["works"].join(t["pages"].withColumn("_there", F.lit(True)), "work_id", "left")
    found, files = status.evidence(F.col("categories")), status.file_evidence(F.col("files"))
    made = _put(joined, _e=found, _f=files)
    keep = lambda column, value: F.when(F.col("_there"), value).otherwise(text(column) if column in t["works"].columns else F.lit(""))
    cells = {"imslp_style": F.col("_e.styles"), "imslp_first_published": F.col("_e.first_published"), "imslp_copyright_flags": F.col("_e.flags"), "has_files": F.col("_f.has_files"), "imslp_file_hosts": F.col("_f.hosts")}
    return {"works": _put(made, **{c: keep(c, v) for c, v in cells.items()}).drop("_e", "_f", "_there", "categories", "files")}


def remap_open_licences(t: Tables) -> Tables:
    """Open licences of works by their blocks (work_id, kind, licence, open_licence, image_type, arranger, formats)."""
    owned = t["works"].join(t["people"].select("id", "eu_pd_status"), "id", "left")
    told = works.open_cells(owned, t["blocks"], "work_id", "eu_pd_status")
    named = told.select("work_id", F.col("licences").alias("imslp_open_licences"), F.col("scope").alias("imslp_open_scope"), F.col("formats").alias("imslp_open_formats"))
    return {"works": t["works"].join(named, "work_id", "left")}


def apply_styles(pair: tuple[str, str]) -> Callable[[Tables], Tables]:
    """Styles on which two labellers agree; ledger: id, labeller, tags, at, line."""

    def stage(t: Tables) -> Tables:
        latest = ledger.latest(t["ledger"], ["id", "labeller"], "at", "line")
        agreed = ledger.consensus(latest, "id", "labeller", "tags", pair).select("id", F.col("tags").alias("llm_style_tags"))
        joined = t["people"].join(agreed, "id", "left")
        return {"people": _put(joined, llm_style_tags=text("llm_style_tags"))}

    return stage


def offline_stages(reference: int, vocabulary: list[str], pair: tuple[str, str]) -> list[Stage]:
    """All stages in ``ORDER``."""
    made = [remap_force, carry_forward, remap_people(reference, vocabulary), apply_overrides(reference, vocabulary), remap_authorities, remap_matches, remap_evidence, remap_open_licences, apply_styles(pair)]
    return list(zip(ORDER, made, strict=True))


def run(tables: Tables, stages: list[Stage]) -> tuple[Tables, list[dict]]:
    """The tables after all stages, and a record (stage, row counts) of each. What a stage makes is written before the next, so that a lost executor costs one stage."""
    records = []
    for name, stage in stages:
        made = {k: checkpointed(df) for k, df in stage(tables).items()}
        tables = {**tables, **made}
        records.append({"stage": name, "row_counts": {k: df.count() for k, df in made.items()}})
    return tables, records
