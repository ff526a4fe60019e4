"""Identity: comparison of dates and links, collisions of claimants, unique candidates, merges."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cells import page_key, page_title, split_cell, text
from .rules import ladder

ACTIVE = ["matched", "unverified_heuristic"]


def compare_dates(birth: Column, death: Column, born: Column, died: Column) -> Column:
    """'agree' within a year, 'conflict_strong' if no pair agrees and one is over ten years off, else 'conflict_weak'."""
    gaps = F.array_compact(F.array(F.abs(birth - born), F.abs(death - died)))
    return ladder([(F.size(gaps) == 0, "unknown"), (F.array_max(gaps) <= 1, "agree"), ((F.array_min(gaps) > 1) & (F.array_max(gaps) > 10), "conflict_strong")], "conflict_weak")


def compare_links(url: Column, title: Column) -> Column:
    a, b = page_key(page_title(url)), page_key(title)
    return ladder([((a == "") | (b == ""), "unknown"), (a == b, "agree")], "differs")


def status_by_dates(df: DataFrame) -> DataFrame:
    """New status and method from (status, method, dates, wikilink): promote, flag or reject."""
    heuristic = F.col("status") == "unverified_heuristic"
    active = F.col("status").isin(ACTIVE)
    by_dates, by_link = heuristic & (F.col("dates") == "agree"), heuristic & (F.col("dates") == "conflict_weak") & (F.col("wikilink") == "agree")
    strong = active & (F.col("dates") == "conflict_strong")
    trusted = (F.col("status") == "matched") & (F.col("method") == "wikidata_p839")
    return df.withColumns(
        {
            "new_status": F.coalesce(F.when(by_dates | by_link, "matched"), F.when(strong & trusted, "rejected_p839"), F.when(strong, "rejected_heuristic"), F.col("status")),
            "new_method": F.when(by_dates, "exact_name+life_dates").when(by_link, "exact_name+wikilink").otherwise(F.col("method")),
            "new_flag": F.when(active & (F.col("dates") == "conflict_weak"), "imslp_dates_conflict").when(strong & trusted, "imslp_p839_wrong").otherwise(""),
        }
    )


def resolve_collisions(df: DataFrame, category: str = "category", key: str = "id") -> DataFrame:
    """One owner per category among the active claimants of the input.

    A single trusted holder wins; else the single claimant whose dates agree; else the single one of several
    whose link agrees too. The others are rejected. Counts and the winner come from one aggregation per category,
    joined back. Two trusted holders of a category are an error (``collision_errors``).
    """
    claims = df.where(F.col("status").isin(ACTIVE) & (text(category) != ""))
    trusted = (F.col("status") == "matched") & (F.col("method") == "wikidata_p839") & (F.col("dates") != "conflict_strong")
    agreeing = F.col("dates") == "agree"
    linked = agreeing & (F.col("wikilink") == "agree")
    counts = claims.groupBy(category).agg(
        F.count(F.lit(1)).alias("n"),
        *(x for name, c in (("trusted", trusted), ("agreeing", agreeing), ("linked", linked)) for x in (F.count_if(c).alias(f"n_{name}"), F.min(F.when(c, F.col(key))).alias(name))),
    )
    winner = F.when(F.col("n_trusted") >= 1, F.when(F.col("n_trusted") == 1, F.col("trusted"))).when(F.col("n_agreeing") == 1, F.col("agreeing")).when(F.col("n_linked") == 1, F.col("linked"))
    why = F.when(F.col("n_trusted") >= 1, "wikidata_p839").when(F.col("n_agreeing") == 1, "dates_agree").when(F.col("n_linked") == 1, "dates_agree+wikilink_agree").otherwise("no_unique_agreeing_claimant")
    held = counts.where("n > 1").select(F.col(category).alias("_cat"), winner.alias("winner"), why.alias("why"), F.lit(True).alias("contested"))
    joined = status_by_dates(df).join(held, F.col(category) == F.col("_cat"), "left").drop("_cat")
    loses = F.coalesce(F.col("contested"), F.lit(False)) & F.col("status").isin(ACTIVE) & ~F.col("winner").eqNullSafe(F.col(key))
    wins = F.coalesce(F.col("contested"), F.lit(False)) & F.col("status").isin(ACTIVE) & ~loses
    return joined.withColumns(
        {
            "new_status": F.when(loses & (F.col("new_status") != "rejected_p839"), "rejected_heuristic").otherwise(F.col("new_status")),
            "new_method": F.when(loses, F.col("method")).otherwise(F.col("new_method")),
            "outcome": F.when(loses, "collision_lost").when(wins, "collision_won").otherwise(""),
        }
    ).drop("contested")


def collision_errors(df: DataFrame, category: str = "category", key: str = "id") -> DataFrame:
    """Categories with more than one trusted holder."""
    trusted = df.where((F.col("status") == "matched") & (F.col("method") == "wikidata_p839") & (F.col("dates") != "conflict_strong"))
    return trusted.groupBy(category).agg(F.count(F.lit(1)).alias("n"), F.min(key).alias("first")).where("n > 1")


def unique_candidate(rows: DataFrame, candidates: DataFrame, on: str, key: str, band: tuple[str, str, float], candidate: str) -> DataFrame:
    """The candidate of each row of which exactly one agrees on ``on`` and lies within the band; rows with none or several leave.

    ``band``: the row's number, the candidate's and how far apart they may be. The band's bucket is part of the join's
    key, and a candidate stands in its own bucket and both neighbours, so that a common ``on`` joins neighbours alone.
    """
    mine, theirs, width = band
    bucket = lambda c: F.floor(F.col(c) / width)
    near = candidates.withColumn("_bucket", F.explode(F.array(*(bucket(theirs) + d for d in (-1, 0, 1)))))
    found = rows.withColumn("_bucket", bucket(mine)).join(near, [on, "_bucket"]).where(F.abs(F.col(mine) - F.col(theirs)) <= width)
    return found.groupBy(key).agg(F.min(candidate).alias(candidate), F.count(F.lit(1)).alias("n")).where("n = 1").drop("n")


def merge_duplicates(df: DataFrame, keys: list[str], primary: list[Column], firsts: list[str], lows: list[str], highs: list[str], aliases: str) -> DataFrame:
    """One row per key: columns of the primary row, least and largest years, sorted alias set."""
    own = F.min_by(F.struct(*firsts), F.struct(*primary))
    out = df.groupBy(*keys).agg(own.alias("p"), *(F.min(c).alias(c) for c in lows), *(F.max(c).alias(c) for c in highs), F.array_join(F.array_sort(F.collect_set(aliases)), "|").alias("aliases"), F.count(F.lit(1)).alias("n_merged"))
    return out.select(*keys, "p.*", *lows, *highs, "aliases", "n_merged")


def merge_people(df: DataFrame, key: str, order: list[Column], name: str = "name_display", aliases: str = "name_aliases", url: str = "wikipedia_url", birth: str = "birth_year", death: str = "death_year") -> DataFrame:
    """One row per key: the first row by ``order`` (best unique), with the least birth, the largest death and all aliases.

    An address that joins two people ('and_' in it) stands for the pair: the last such row's address, and the last such
    row's name, replace those of the first row. Aliases are the other rows' names and all aliases, sorted, without the name
    that stays. The first row's own name is one of them only if a row behind the first pair has it. Everything is a
    mergeable aggregate, over rows and then over distinct names, so a repeated key gathers no rows.
    """
    place = F.struct(*(c.alias(f"o{i}") for i, c in enumerate(order)))
    pair = F.contains(F.lower(text(url)), F.lit("and_"))
    rest = [c for c in df.columns if c != key]
    rows = df.select("*", place.alias("_o"), pair.alias("_pair"), text(name).alias("_name"))
    one = rows.groupBy(key).agg(F.min_by(F.struct(*rest), "_o").alias("p"), F.min(birth).alias("_birth"), F.max(death).alias("_death"), F.max_by(F.when(F.col("_pair"), text(url)), F.when(F.col("_pair"), F.col("_o"))).alias("_url"), F.count(F.lit(1)).alias("n_merged"))
    named = rows.groupBy(key, "_name").agg(F.max("_o").alias("last"), F.min(F.when(F.col("_pair"), F.col("_o"))).alias("first_pair"), F.max(F.when(F.col("_pair"), F.col("_o"))).alias("last_pair")).where("_name <> ''")
    names = named.groupBy(key).agg(F.collect_list(F.struct(F.col("_name").alias("name"), "last", "first_pair", "last_pair")).alias("names"))
    listed = rows.select(key, F.explode(split_cell(aliases)).alias("a")).groupBy(key).agg(F.collect_set("a").alias("listed"))
    own = text(F.col("p")[name])
    pairs = F.filter(F.coalesce("names", F.array().cast(dict(names.dtypes)["names"])), lambda x: x["last_pair"].isNotNull())
    by_place = F.array_sort(F.transform(pairs, lambda x: F.struct(x["last_pair"].alias("o"), x["name"].alias("name"))))
    final = F.coalesce(F.try_element_at(by_place, F.lit(-1))["name"], own)
    begun = F.array_min(F.transform(F.filter(pairs, lambda x: x["name"] != own), lambda x: x["first_pair"]))
    seen = F.filter(F.coalesce("names", F.array().cast(dict(names.dtypes)["names"])), lambda x: (x["name"] != own) | F.coalesce(x["last"] > begun, F.lit(False)))
    joined = one.join(names, key, "left").join(listed, key, "left")
    all_ = F.array_sort(F.filter(F.array_distinct(F.concat(F.transform(seen, lambda x: x["name"]), F.coalesce("listed", F.array().cast("array<string>")))), lambda a: a != final))
    changed = {name: final, aliases: F.array_join(all_, "|"), url: F.coalesce("_url", F.col("p")[url]), birth: F.col("_birth"), death: F.col("_death")}
    one_only = F.col("n_merged") == 1
    return joined.select(key, *(F.when(one_only, F.col("p")[c]).otherwise(changed[c]).alias(c) if c in changed else F.col("p")[c].alias(c) for c in rest), "n_merged")


def authority(df: DataFrame) -> DataFrame:
    """(id, own, found, death, known_death): own id, else the found one; conflict of death years flagged."""
    return df.withColumns(
        {
            "authority_id": F.coalesce(F.nullif("own", F.lit("")), F.nullif("found", F.lit("")), F.lit("")),
            "flag": F.when(F.abs(F.col("death") - F.col("known_death")) > 1, "gnd_death_conflict").when((text("own") == "") & (text("found") != ""), "gnd_from_lobid").otherwise(""),
        }
    )


def authority_with_prior(df: DataFrame) -> DataFrame:
    """Authority id and flags where parts of the evidence may not be at hand; then what was known stays.

    Columns: has_entity; own (the entity's id); has_record, record_death (of the own id's record; death null if it is
    unknown to the authority); has_search, found, found_death (the search's one match); death; prior_id, prior_flags
    (arrays). Without the entity the row stays. With an own id whose record is not at hand, a conflict noted for that
    very id stays. Without a search, an id that a search gave before stays with its flags. A conflict is any difference of the death years.
    """
    ours = F.array(F.lit("gnd_from_lobid"), F.lit("gnd_death_conflict"))
    had = lambda flag: F.array_contains("prior_flags", flag)
    others = F.array_except("prior_flags", ours)
    by_own, there = text("own") != "", F.col("has_entity")
    differs = lambda c: F.coalesce(F.col(c) != F.col("death"), F.lit(False))
    kept = ~by_own & ~F.col("has_search") & had("gnd_from_lobid") & (text("prior_id") != "")
    by_search = ~by_own & F.col("has_search") & (text("found") != "")
    conflict = F.when(by_own & F.col("has_record"), differs("record_death")).when(by_own, (F.col("own") == text("prior_id")) & had("gnd_death_conflict")).when(kept, had("gnd_death_conflict")).otherwise(by_search & differs("found_death"))
    flags = F.concat(others, F.array_compact(F.array(F.when(kept | by_search, "gnd_from_lobid"), F.when(conflict, "gnd_death_conflict"))))
    told = ladder([(by_own, "own"), (by_search, "search"), (kept, "prior")], "none")
    return df.withColumns(
        {
            "authority_id": F.when(~there, text("prior_id")).when(by_own, F.col("own")).when(by_search, F.col("found")).when(kept, F.col("prior_id")).otherwise(""),
            "authority_flags": F.array_join(F.when(there, flags).otherwise(F.col("prior_flags")), "|"),
            "authority_src": F.when(there, told).otherwise("unread"),
        }
    )


def match_category(people: DataFrame, existing: DataFrame, name: str, stated: str) -> DataFrame:
    """``people`` with category, match status and method: the stated category if its page exists, else 'Last,_First' if that exists."""
    words = F.filter(F.split(text(name), r"\s+"), lambda w: w != "")
    rest = F.array_join(F.slice(words, 1, F.greatest(F.size(words) - 1, F.lit(0))), "_")
    guess = F.when(F.size(words) > 1, F.concat(F.element_at(words, -1), F.lit(",_"), rest)).otherwise(F.array_join(words, "_"))
    bare = F.replace(F.regexp_replace(text(stated), "^Category:", ""), F.lit(" "), F.lit("_"))
    wanted = F.concat(F.lit("Category:"), F.when(bare != "", bare).otherwise(guess))
    known = existing.select(F.col("category").alias("_category"), F.lit(True).alias("_exists")).distinct()
    joined = people.withColumn("_category", wanted).withColumn("_stated", bare != "").join(known, "_category", "left")
    there = F.col("_exists").isNotNull()
    status = F.when(there & F.col("_stated"), "matched").when(there, "unverified_heuristic").otherwise("not_found")
    method = F.when(F.col("_stated"), "wikidata_p839").when(there, "exact_name").otherwise("")
    return joined.select(*people.columns, F.when(there | F.col("_stated"), F.col("_category")).otherwise("").alias("category"), status.alias("match_status"), method.alias("match_method"))


def suspects(people: DataFrame, listed: DataFrame, key: str, url: str, least: int) -> DataFrame:
    """(key, gap, signals) of the people whose listed years are ``least`` years off or who carry a flag of identity.

    Lists are joined by the title in the address; of several rows of a title the nearest counts, so the order of the list
    does not matter. People: birth, death, flags, one row for each ``key``; listed: url, list_birth, list_death.
    """
    rows = listed.select(page_key(page_title(F.col("url"))).alias("_k"), "list_birth", "list_death").where("_k <> ''").distinct()
    off = F.array_max(F.array_compact(F.array(F.abs(F.col("birth") - F.col("list_birth")), F.abs(F.col("death") - F.col("list_death")))))
    years = people.select(key, page_key(page_title(F.col(url))).alias("_k"), "birth", "death").join(rows, "_k").groupBy(key).agg(F.min(off).alias("_gap"))
    joined = people.join(years, key, "left")
    gap = F.col("_gap")
    own = F.filter(F.array(F.lit("not_human"), F.lit("no_composer_occupation")), lambda f: F.array_contains(F.split(text("flags"), r"\|"), f))
    signals = F.concat(F.when(gap >= least, F.array(F.concat(F.lit("list_years_gap_"), gap.cast("string")))).otherwise(F.array().cast("array<string>")), own)
    return joined.select(key, gap.alias("gap"), F.array_join(signals, "|").alias("signals")).where("signals <> ''")


def proposals(found: DataFrame, candidates: DataFrame, key: str) -> DataFrame:
    """``found`` suspects with what to do: one fitting candidate re-keys; candidates: key, fits."""
    n = candidates.groupBy(key).agg(F.count_if("fits").alias("fitting"), F.count(F.lit(1)).alias("candidates"))
    joined = found.join(n, key, "left").withColumns({"fitting": F.coalesce("fitting", F.lit(0)), "candidates": F.coalesce("candidates", F.lit(0))})
    proposal = ladder([(F.col("fitting") == 1, "rekey"), (F.col("fitting") > 1, "ambiguous"), (F.col("signals").startswith("list_years_gap"), "no_candidate")], "check_occupation")
    return joined.withColumn("proposal", proposal)


def unique_authority(people: DataFrame, records: DataFrame, name: str, key: str) -> DataFrame:
    """(key, id) where one record of the name was born in the same year, did not die in another, and died in it or has the profession.

    Records alike in name, years and profession are told by their least and greatest id, which are one where a person has a
    single record: a common name costs a person as many rows as it has different years, not as it has records.
    """
    alike = records.groupBy(name, F.col("born").alias("birth"), "died", "composes").agg(F.min("id").alias("_least"), F.max("id").alias("_most"))
    found = people.join(alike, [name, "birth"]).where("died is null or death is null or died = death")
    close = found.where((F.coalesce(F.col("died") == F.col("death"), F.lit(False))) | F.col("composes"))
    return close.groupBy(key).agg(F.min("_least").alias("id"), F.max("_most").alias("_most")).where("id = _most").select(key, "id")


def remap_matches(people: DataFrame, works: DataFrame, key: str, before: str, after: str) -> tuple[DataFrame, DataFrame]:
    """Works of people whose link still holds, and the (transition, n) report of the statuses that changed."""
    rejected = people.where(~F.col(after).isin(ACTIVE)).select(key)
    changed = people.where(~F.col(before).eqNullSafe(F.col(after)))
    report = changed.groupBy(F.concat_ws(" → ", before, after).alias("transition")).agg(F.count(F.lit(1)).alias("n"))
    return works.join(rejected, key, "left_anti"), report
