"""Flattening of nested entity documents: claims with ranks, dates with precision.

A document's claims are ``map<pid, array<claim>>``; see CLAIMS for the claim.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ..functions.cells import let
from .status import lifespan_flags, scope_class

CLAIM = "struct<rank:string,mainsnak:struct<snaktype:string,datavalue:struct<value:string>>>"
ENTITY = f"struct<id:string,labels:map<string,struct<value:string>>,aliases:map<string,array<struct<value:string>>>,claims:map<string,array<{CLAIM}>>>"
#: Date precisions, from 0.
PRECISIONS = ["billion_years", "hundred_million_years", "ten_million_years", "million_years", "hundred_thousand_years", "ten_thousand_years", "millennium", "century", "decade", "year", "month", "day", "hour", "minute", "second"]
#: Style tags by item.
STYLES = {
    "Q837182": "impressionism",
    "Q613707": "expressionism",
    "Q535611": "neoclassicism",
    "Q106576145": "neoclassicism",
    "Q507246": "serialism",
    "Q221686": "serialism",
    "Q572901": "minimalism",
    "Q2394116": "postminimalism",
    "Q98528143": "postminimalism",
    "Q1245902": "spectralism",
    "Q1326777": "electroacoustic",
    "Q823560": "electroacoustic",
    "Q2332751": "avant_garde",
    "Q1640319": "avant_garde",
    "Q102932": "avant_garde",
    "Q108908": "avant_garde",
    "Q1196170": "national_folk",
    "Q235858": "national_folk",
    "Q1413570": "national_folk",
    "Q148163": "national_folk",
    "Q207591": "late_romantic",
    "Q136774417": "late_romantic",
    "Q1125039": "late_romantic",
    "Q37068": "late_romantic",
    "Q211745": "atonal_modernism",
    "Q3269212": "polystylism",
}
#: Occupations by item.
OCCUPATIONS = {
    "Q36834": "composer",
    "Q158852": "conductor",
    "Q486748": "pianist",
    "Q765778": "organist",
    "Q1259917": "violinist",
    "Q1415090": "film_composer",
    "Q753110": "songwriter",
    "Q14915627": "musicologist",
    "Q16145150": "music_teacher",
    "Q21680663": "classical_composer",
    "Q15981151": "jazz_musician",
}
#: Occupations of people who compose; the most aliases that a row lists.
COMPOSING = ["composer", "classical_composer", "film_composer", "songwriter"]
MAX_ALIASES = 20
#: IMSLP period names and their slugs.
PERIODS = {
    "Romantic": "romantic",
    "Early 20th century": "early_20th_century",
    "Modern": "modern",
    "Classical": "classical",
    "Baroque": "baroque",
    "Renaissance": "renaissance",
    "Medieval": "medieval",
    "Ancient": "ancient",
    "Jazz": "jazz",
    "Traditional (folk)": "traditional_folk",
    "Non-western classical": "non_western_classical",
    "Romántico": "romantic",
    "Traditional": "traditional_folk",
}


def claims_of(entity: Column, pid: str) -> Column:
    none = F.array().cast(f"array<{CLAIM}>")
    return F.coalesce(F.try_element_at(entity["claims"], F.lit(pid)), none)


def _values(claims: Column) -> Column:
    told = F.filter(claims, lambda c: (c["mainsnak"]["snaktype"] == "value") & c["mainsnak"]["datavalue"]["value"].isNotNull())
    return F.transform(told, lambda c: F.struct(F.coalesce(c["rank"], F.lit("normal")).alias("rank"), c["mainsnak"]["datavalue"]["value"].alias("value")))


def item_ids(entity: Column, pid: str) -> Column:
    """Ids or strings that a property's claims give, in order; deprecated claims included."""
    return F.transform(_values(claims_of(entity, pid)), lambda v: F.coalesce(F.get_json_object(v["value"], "$.id"), v["value"]))


def mapped(values: Column, table: dict[str, str]) -> Column:
    """Distinct mapped values in order; those outside the table leave."""
    m = F.create_map(*(F.lit(x) for kv in table.items() for x in kv))
    return F.array_distinct(F.array_compact(F.transform(values, lambda v: F.try_element_at(m, v))))


def time_value(value: Column) -> Column:
    """struct<iso, year, precision, imprecise>; coarse dates give the last year of their interval, null where nothing can be read."""
    p = F.coalesce(F.get_json_object(value, "$.precision").try_cast("int"), F.lit(9))
    return let(F.struct(F.get_json_object(value, "$.time").alias("time"), p.alias("p")), lambda x: _time_of(x["time"], x["p"]))


def _time_of(stamp: Column, p: Column) -> Column:
    date = r"^([+-])(\d+)-(\d{2})-(\d{2})"
    raw = F.regexp_extract(stamp, date, 2).try_cast("long") * F.when(F.regexp_extract(stamp, date, 1) == "-", -1).otherwise(1)
    return let(raw, lambda x: _dated(x, p, F.regexp_extract(stamp, date, 3), F.regexp_extract(stamp, date, 4)))


def _dated(raw: Column, p: Column, month: Column, day: Column) -> Column:
    span = F.pow(F.lit(10), F.lit(9) - p).cast("long")
    year = F.when(p == 8, F.floor(raw / 10) * 10 + 9).when(p < 8, F.floor((raw - 1) / span) * span + span).otherwise(raw).cast("long")
    base = F.lpad(year.cast("string"), 4, "0")
    iso = F.when(year >= 0, F.when(p >= 11, F.concat_ws("-", base, month, day)).when(p == 10, F.concat_ws("-", base, month)).otherwise(base))
    label = F.try_element_at(F.array(*map(F.lit, PRECISIONS)), p + 1)
    return F.when(raw.isNotNull() & p.between(0, 14), F.struct(iso.alias("iso"), F.when(year > 0, year).alias("year"), label.alias("precision"), (p < 9).alias("imprecise")))


def time_claim(claims: Column) -> Column:
    """The first value of the best rank that has one: struct<iso, year, precision, conflict, imprecise>.

    ``conflict``: the rank's values tell more than one year. Deprecated claims do not count.
    """
    read = F.filter(F.transform(_values(claims), lambda v: F.struct(v["rank"].alias("rank"), time_value(v["value"]).alias("t"))), lambda v: v["t"].isNotNull())
    return let(read, _best_time)


def _best_time(read: Column) -> Column:
    at = lambda rank: F.transform(F.filter(read, lambda v: v["rank"] == rank), lambda v: v["t"])
    best = F.when(F.size(at("preferred")) > 0, at("preferred")).otherwise(at("normal"))
    return let(best, _first_time)


def _first_time(best: Column) -> Column:
    first = F.try_element_at(best, F.lit(1))
    years = F.size(F.array_distinct(F.transform(best, lambda t: t["year"])))
    return F.struct(first["iso"].alias("iso"), first["year"].alias("year"), F.coalesce(first["precision"], F.lit("unknown")).alias("precision"), (years > 1).alias("conflict"), F.coalesce(first["imprecise"], F.lit(False)).alias("imprecise"))


def deprecated_years(claims: Column) -> Column:
    """Years that deprecated claims tell."""
    old = F.filter(_values(claims), lambda v: v["rank"] == "deprecated")
    return F.array_distinct(F.array_compact(F.transform(old, lambda v: time_value(v["value"])["year"])))


def fallback_year(claim: Column, deprecated: Column, fallback: Column, refine: bool) -> Column:
    """The year, filled from ``fallback`` if none is told or, with ``refine``, replaced inside a coarse interval; years marked wrong never serve."""
    usable = fallback.isNotNull() & ~F.array_contains(deprecated, fallback.cast("long"))
    span = F.when(claim["precision"] == "decade", 10).when(claim["precision"] == "century", 100).when(claim["precision"] == "millennium", 1000)
    inside = F.lit(refine) & claim["imprecise"] & fallback.between(claim["year"] - span + 1, claim["year"]) & (fallback != claim["year"])
    return F.when(usable & (claim["year"].isNull() | F.coalesce(inside, F.lit(False))), fallback.cast("long")).otherwise(claim["year"])


def best_ids(entity: Column, pid: str, pattern: str) -> Column:
    """The first valid id by rank, then order."""
    ranked = F.transform(F.filter(_values(claims_of(entity, pid)), lambda v: v["rank"] != "deprecated"), lambda v, i: F.struct(F.when(v["rank"] == "preferred", 0).otherwise(1).alias("r"), i.alias("i"), F.coalesce(F.get_json_object(v["value"], "$.id"), v["value"]).alias("x")))
    valid = F.filter(F.array_sort(ranked), lambda s: s["x"].rlike(pattern))
    return F.coalesce(F.try_element_at(valid, F.lit(1))["x"], F.lit(""))


def flatten(json: Column) -> Column:
    """An entity document as a flat struct."""
    return let(F.from_json(json, ENTITY), lambda e: let(F.struct(time_claim(claims_of(e, "P569")).alias("b"), time_claim(claims_of(e, "P570")).alias("d")), lambda x: _flat(e, x["b"], x["d"])))


def _flat(e: Column, birth: Column, death: Column) -> Column:
    flags = F.array_compact(
        F.array(
            F.when(birth["conflict"], "birth_rank_conflict"),
            F.when(death["conflict"], "death_rank_conflict"),
            F.when(birth["imprecise"], "birth_imprecise"),
            F.when(death["imprecise"], "death_imprecise"),
            F.when(~F.array_contains(item_ids(e, "P31"), "Q5"), "not_human"),
        )
    )
    alias = F.slice(F.filter(F.transform(F.try_element_at(e["aliases"], F.lit("en")), lambda a: a["value"]), lambda a: a != ""), 1, MAX_ALIASES)
    return let(mapped(item_ids(e, "P106"), OCCUPATIONS), lambda work: let(mapped(_style_ids(e), STYLES), lambda styles: _row(e, birth, death, flags, alias, work, styles)))


def _style_ids(e: Column) -> Column:
    return F.concat(item_ids(e, "P135"), item_ids(e, "P136"))


def stated_category(e: Column) -> Column:
    """The first category that an entity states, as a page title; null without one."""
    bare = F.regexp_replace(F.replace(F.try_element_at(item_ids(e, "P839"), F.lit(1)), F.lit(" "), F.lit("_")), "^Category:", "")
    return F.concat(F.lit("Category:"), bare)


def _row(e: Column, birth: Column, death: Column, flags: Column, alias: Column, occupations: Column, styles: Column) -> Column:
    scope = scope_class(occupations, styles)
    idle = F.when(~F.arrays_overlap(occupations, F.array(*map(F.lit, COMPOSING))), F.array(F.lit("no_composer_occupation"))).otherwise(F.array().cast("array<string>"))
    return F.struct(
        e["id"].alias("id"),
        F.try_element_at(e["labels"], F.lit("en"))["value"].alias("name"),
        F.coalesce(F.array_join(alias, "|"), F.lit("")).alias("aliases"),
        birth.alias("birth"),
        death.alias("death"),
        F.array_join(item_ids(e, "P27"), "|").alias("citizenship"),
        F.array_join(occupations, "|").alias("occupations"),
        F.array_contains(occupations, "film_composer").alias("is_film_composer"),
        F.array_join(styles, "|").alias("styles"),
        F.array_join(F.concat(flags, lifespan_flags(birth["year"], death["year"]), idle), "|").alias("flags"),
        # The precision of the date that decides about rights.
        F.when(death["year"].isNotNull(), death["precision"]).when(birth["year"].isNotNull(), birth["precision"]).otherwise("unknown").alias("date_precision"),
        F.when(F.size(styles) > 0, "wikidata").otherwise("").alias("styles_src"),
        F.array_join(_style_ids(e), "|").alias("style_ids"),
        scope["scope"].alias("scope"),
        scope["src"].alias("scope_src"),
        F.array_join(item_ids(e, "P800"), "|").alias("notable_works"),
        stated_category(e).alias("category"),
        best_ids(e, "P227", r"^[0-9X-]+$").alias("gnd"),
        best_ids(e, "P214", r"^[1-9][0-9]+$").alias("viaf"),
    )
