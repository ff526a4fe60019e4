"""Reviewed corrections over derived rows, and decisions carried forward between revisions."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.cells import join_flags, split_cell, text
from .rollups import present_counts
from .status import term

META = ["reason", "source", "reviewer", "date"]
REKEY, DROP = "rekey", "_drop"


def override_errors(overrides: DataFrame, base: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(error, key, field): every fault of the overrides, none hidden by another."""
    o = overrides.select(F.col("key").cast("string").alias("key"), "field", "value", *META)
    known = base.select(F.col(key).cast("string").alias("key")).distinct()
    say = lambda df, error: df.select(F.lit(error).alias("error"), "key", "field")
    faults = [say(o.where(text(c) == ""), f"missing {c}") for c in META]
    faults.append(say(o.where(~F.col("field").isin(*fields, REKEY, DROP)), "unknown field"))
    faults.append(say(o.groupBy("key", "field").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "duplicate override"))
    faults.append(say(o.join(known, "key", "left_anti"), "unknown key"))
    dropped = o.where(F.col("field") == DROP).select("key")
    faults.append(say(o.where(F.col("field") != DROP).join(dropped, "key", "left_semi"), "dropped key has other overrides"))
    moved = o.where(F.col("field") == REKEY)
    target = moved.join(known.withColumnRenamed("key", "value"), "value", "left_semi")
    staying = target.join(moved.select(F.col("key").alias("value")), "value", "left_anti")
    faults.append(say(staying, "new key is taken"))
    faults.append(say(moved.join(moved.groupBy("value").agg(F.count(F.lit(1)).alias("n")).where("n > 1"), "value", "left_semi"), "new key given twice"))
    out = faults[0]
    for f in faults[1:]:
        out = out.unionByName(f)
    return out


def apply_overrides(base: DataFrame, overrides: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """``base`` with its overrides: values addressed by the old key, then the new key, dropped rows gone.

    One aggregation turns the field-value rows to a map per key, one join lays them over the base.
    """
    once = overrides.groupBy("key", "field").agg(F.max_by("value", F.struct("date", "value")).alias("value"))  # of a field given twice the later stands
    laid = once.groupBy(F.col("key").cast("string").alias("_key")).agg(F.map_from_entries(F.collect_list(F.struct("field", "value"))).alias("_o"))
    joined = base.join(laid, F.col(key).cast("string") == F.col("_key"), "left")
    given = lambda f: F.try_element_at(F.col("_o"), F.lit(f))
    types = dict(base.dtypes)
    columns = [F.coalesce(given(c).cast(types[c]), F.col(c)).alias(c) if c in fields else F.coalesce(given(REKEY).cast(types[c]), F.col(c)).alias(c) if c == key else F.col(c) for c in base.columns]
    return joined.where(given(DROP).isNull()).select(*columns)


def rederive(people: DataFrame, overrides: DataFrame, documents: DataFrame, key: str, derived: dict[str, str], category: str = "category") -> DataFrame:
    """``people`` under their new keys, the cells that come from an entity taken afresh from the new one; ``action`` tells what became of the link.

    documents: id, e (a flat entity, see ``entities.flatten``), one per id; ``derived`` names the entity's field of each
    column (of which one is ``flags``). If the new entity states the category that the row has, the link is matched;
    if it states another, the row is flagged for a check; if none, the link stays. Rows without a re-key, and those whose
    old key is gone because it was applied before, stay as they are. A new key that names an entity without a document fails
    the plan; one that names none changes the key alone (action ``rekeyed``).
    """
    moved = overrides.where(F.col("field") == REKEY).groupBy(F.col("key").cast("string").alias("_old")).agg(F.max_by("value", F.struct("date", "value")).alias("_new"))
    joined = people.join(moved, F.col(key).cast("string") == F.col("_old"), "left").join(documents.select(F.col("id").alias("_id"), F.col("e").alias("_e")), F.col("_new") == F.col("_id"), "left")
    is_moved, is_named = F.col("_new").isNotNull(), F.coalesce(F.col("_new").rlike(r"^Q\d+$"), F.lit(False))
    entity = F.when(is_named & F.col("_id").isNull(), F.raise_error(F.concat(F.lit("no document of the new key "), F.col("_new")))).otherwise(F.col("_e"))
    held = joined.withColumn("_e", entity)
    stated = F.col("_e.category")
    action = F.when(~is_moved, "").when(~is_named, "rekeyed").when(stated.isNull(), "p839_none").when(stated == text(category), "matched_p839").otherwise("imslp_needs_recheck")
    matched, again = action == "matched_p839", action == "imslp_needs_recheck"
    types = dict(people.dtypes)

    def cell(c: str):
        if c == key:
            return F.when(is_moved, F.col("_new").cast(types[c])).otherwise(F.col(c))
        if c in derived:
            told = F.col(f"_e.{derived[c]}")
            told = F.array_join(F.array_compact(F.array(F.nullif(told, F.lit("")), F.when(again, "imslp_needs_recheck"))), "|") if derived[c] == "flags" else told
            return F.when(is_named, told.cast(types[c])).otherwise(F.col(c))
        settled = {"imslp_match_status": "matched", "imslp_match_method": "wikidata_p839"}
        return F.when(matched, settled[c]).otherwise(F.col(c)) if c in settled else F.col(c)

    return held.select(*(cell(c).alias(c) for c in people.columns), action.alias("action"))


def apply_in_order(people: DataFrame, works: DataFrame, overrides: DataFrame, documents: DataFrame, key: str, fields: list[str], derived: dict[str, str], reference: int, category: str, vocabulary: list[str]) -> tuple[DataFrame, DataFrame]:
    """All overrides of a file in their order: new keys, cells taken afresh from the new key's entity, stated values (still
    addressed by the old key), drops; then status, flag and rollups of the rows that were touched.

    people hold ``death_year``, ``qa_flags``, ``eu_pd_status``, ``eu_pd_year`` and the rollups ``n_works``, ``present``; works
    hold ``key`` and ``category``. Rows without overrides, and works of people without, stay as they are. A re-key
    whose old key is gone was applied before: its values and drops still go to the new key. Overrides of unknown keys do nothing.
    """
    types, old = dict(people.dtypes), F.col("key").cast("string")
    moves = overrides.where(F.col("field") == REKEY).groupBy(old.alias("key")).agg(F.max_by("value", F.struct("date", "value")).alias("_to"))
    placed = overrides.withColumn("key", old).join(moves, "key", "left").withColumn("key", F.coalesce("_to", "key")).drop("_to")
    dropped = placed.where(F.col("field") == DROP).select(F.col("key").cast(types[key]).alias(key)).distinct()
    values = placed.where(~F.col("field").isin(REKEY, DROP))
    touched = placed.select(F.col("key").cast(types[key]).alias(key)).distinct().withColumn("_touched", F.lit(True))

    moved = rederive(people, overrides, documents, key, derived).drop("action")
    laid = apply_overrides(moved, values, key, fields).join(dropped, key, "left_anti")
    to = moves.select(F.col("key").cast(types[key]).alias(key), F.col("_to").cast(types[key]))
    following = works.join(to, key, "left").withColumn(key, F.coalesce("_to", key)).drop("_to").select(*works.columns).join(dropped, key, "left_anti")

    # Rollups are counted for touched rows alone; few keys are touched, so the join that finds their works is small.
    marked = laid.join(touched, key, "left").withColumn("_touched", F.coalesce("_touched", F.lit(False)))
    some = following.join(touched.select(key), key, "left_semi")
    rolled = present_counts(marked.where("_touched").select(key), some, key, key, category, vocabulary).select(key, F.col("present").alias("_present"), F.col("total").alias("_total"))
    t = term(F.col("death_year"), reference)
    fresh = {
        "eu_pd_status": t["status"],
        "eu_pd_year": t["year"],
        "qa_flags": join_flags(F.concat(split_cell("qa_flags"), F.array(F.lit("manual_override")))),
        "n_works": F.col("_total"),
        "present": F.col("_present"),
    }
    whole = marked.join(rolled, key, "left")
    return whole.select(*(F.when(F.col("_touched"), fresh[c].cast(types[c])).otherwise(F.col(c)).alias(c) if c in fresh else F.col(c) for c in people.columns)), following


def overridden_cells(base: DataFrame, overrides: DataFrame, key: str, fields: list[str]) -> DataFrame:
    """(key, field, old, new) of the cells that overrides change."""
    cells = base.select(F.col(key).cast("string").alias("key"), F.explode(F.array(*(F.struct(F.lit(f).alias("field"), F.col(f).cast("string").alias("old")) for f in fields))).alias("c")).select("key", "c.*")
    return cells.join(overrides.select(F.col("key").cast("string").alias("key"), "field", F.col("value").alias("new")), ["key", "field"]).where(~F.col("old").eqNullSafe(F.col("new")))


def carry_forward(new: DataFrame, base: DataFrame, keys: list[str], label: str, src: str, fill: list[str], weak: list[str]) -> DataFrame:
    """``new`` with earlier decisions: a label made by other means than tags wins only over a weak one; empty ``fill`` columns take the base's."""
    # Keys of the base must be unique, or rows would multiply: the plan fails on one that repeats.
    held = [F.min(F.struct(*(F.col(c).alias(f"_{c}") for c in (label, src, *fill)))).alias("_held"), F.count(F.lit(1)).alias("_n")]
    told = F.when(F.col("_n") == 1, F.col("_held")).otherwise(F.raise_error(F.concat(F.lit("the base repeats the key "), F.to_json(F.struct(*keys)))))
    prior = base.groupBy(*keys).agg(*held).select(*keys, told.alias("_held")).select(*keys, "_held.*")
    joined = new.join(prior, keys, "left")
    decided = (F.col(f"_{src}").startswith("llm") | (F.col(f"_{src}") == "imslp_geninfo")) & ~F.col(f"_{label}").isin("", *weak)
    wins = F.coalesce(decided & (F.col(label).isin("", *weak)) & (F.col(src) != "imslp_tags"), F.lit(False))
    return joined.select(
        *(F.when(wins, F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in (label, src) else F.when((text(c) == "") & F.col(f"_{c}").isNotNull(), F.col(f"_{c}")).otherwise(F.col(c)).alias(c) if c in fill else F.col(c) for c in new.columns),
        wins.alias("carried"),
    )


def lost_rows(new: DataFrame, base: DataFrame, keys: list[str]) -> DataFrame:
    return base.join(new.select(*keys).distinct(), keys, "left_anti")


def keep_prior(rows: DataFrame, documents: DataFrame, on: str, value: str, prior: str, missing: str) -> DataFrame:
    """``value`` of the document; the prior cell where no document is at hand, '' where it is known to be missing."""
    joined = rows.join(documents.withColumn("_there", F.lit(True)), on, "left")
    state = F.when(F.col("_there").isNull(), "absent").when(F.coalesce(F.col(missing), F.lit(False)), "missing").otherwise("present")
    cell = F.when(state == "absent", text(prior)).when(state == "missing", "").otherwise(text(value))
    return joined.select(*rows.columns, state.alias("state"), cell.alias("cell"))
