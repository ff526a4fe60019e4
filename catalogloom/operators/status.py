"""Row-wise derivations: terms of protection, bands, gates, flags and scopes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.cells import split_cell, text, whole_number, year
from .rules import ladder

#: Years after death until the term ends, counted to the following new year.
TERM = 71
#: Rights basis by flags, the first that a row has.
BASIS = [
    ("eu_warning", ["nonpd_eu"]),
    ("us_only", ["pd_us_only"]),
    ("licensed", ["nonpd_licensed", "permission_granted", "pro_licensed"]),
    ("wima", ["wima"]),
    ("us_routes", ["pd_us_notrenewed", "pd_us_no_notice"]),
]
#: Flags of exact category titles.
CATEGORY_FLAGS = {
    "WorkNonPD-EU": ["nonpd_eu"],
    "WorkNonPD-USandEU": ["nonpd_eu", "nonpd_us"],
    "WorkNonPD-US": ["nonpd_us"],
    "Work-NonPD-US-renewed": ["nonpd_us"],
    "Items under copyright in USA due to GATT/TRIPS": ["nonpd_us"],
    "USA-C-URAA-RoST": ["nonpd_us"],
    "Files PD in the EU due to RoST": ["pd_eu_rost"],
    "Files PD in Canada due to RoST": ["pd_ca_rost"],
    "Items with text under copyright in Canada": ["nonpd_ca_text"],
    "FileNonPD-PermissionGranted": ["permission_granted"],
    "Works not in public domain": ["nonpd_licensed"],
    "WorkPD-USonly": ["pd_us_only"],
    "Work-PD-US-notrenewed": ["pd_us_notrenewed"],
    "PD-US-no notice": ["pd_us_no_notice"],
    "WIMA files": ["wima"],
    "WIMA duplicate files": ["wima"],
    "Works Licensed through BMI": ["pro_licensed"],
    "Works Licensed through ASCAP": ["pro_licensed"],
    "Works Licensed through GEMA": ["pro_licensed"],
}
#: Extensions of images, which are no scores.
IMAGES = ["bmp", "gif", "jpeg", "jpg", "png", "svg", "tif", "tiff", "webp"]
#: Servers by token of a file name.
HOSTS = {"PMLUS": "us", "PMLASIA": "asia"}
#: Occupations that put a person outside the core unless a composer.
FILM, POPULAR = ["film_composer"], ["songwriter", "jazz_musician"]


def reference_year(meta: dict, now: int) -> int:
    """The year that statuses refer to: as stated, else of the snapshot, else now."""
    stated = meta.get("pd_reference_year")
    return int(stated) if stated else int(str(meta.get("created_at_utc") or now)[:4])


def term(death, reference: int) -> Column:
    """struct<status, year, remaining>: 'pd' from the year the term ends on, 'unknown_death' without a death year."""
    ends = year(death) + TERM
    return F.when(
        ends.isNotNull(),
        F.struct(F.when(ends <= reference, "pd").otherwise("not_pd").alias("status"), ends.alias("year"), F.greatest(ends - reference, F.lit(0)).alias("remaining")),
    ).otherwise(F.struct(F.lit("unknown_death").alias("status"), F.lit(None).cast("int").alias("year"), F.lit(None).cast("int").alias("remaining")))


def live_bucket(ends: Column, today: int) -> Column:
    return ladder([(ends.isNull(), "unknown"), (ends < today, "now"), (ends == today, "now"), (ends == today + 1, "next"), (ends <= today + 5, "soon")], "later")


def years_conflict(birth, death, listed_birth, listed_death) -> Column:
    """Whether a known pair of years differs."""
    return F.coalesce(year(birth) != year(listed_birth), F.lit(False)) | F.coalesce(year(death) != year(listed_death), F.lit(False))


def cohort_exclusion(birth, death, listed_birth, listed_death, first_death: int = 1900, gap: int = 40, modern: int = 1850) -> Column:
    """Why a row is outside the cohort; null if it is inside."""
    b, d, lb, ld = year(birth), year(death), year(listed_birth), year(listed_death)
    say = lambda *parts: F.concat(*(F.lit(p) if isinstance(p, str) else p.cast("string") for p in parts))
    return F.coalesce(
        F.when(d < first_death, say("death_year_", d, f"_before_{first_death}")),
        F.when((F.abs(lb - b) >= gap) & (b < modern), say("list_birth_", lb, "_vs_wikidata_", b)),
        F.when((F.abs(ld - d) >= gap) & (d < first_death), say("list_death_", ld, "_vs_wikidata_", d)),
    )


def lifespan_flags(birth: Column, death: Column, least: int = 15, most: int = 110) -> Column:
    span = death - birth
    return F.array_compact(F.array(F.when((span < least) | (span > most), "implausible_lifespan"), F.when(span < 0, "death_before_birth")))


def scope_class(occupations: Column, styles: Column) -> Column:
    """struct<scope, src>; film or popular work does not count against a composer."""
    composer = F.arrays_overlap(occupations, F.array(F.lit("composer"), F.lit("classical_composer")))
    has = lambda names: F.arrays_overlap(occupations, F.array(*map(F.lit, names)))
    crossed = F.array_contains(styles, "crossover_popular")
    scope = ladder([(has(FILM) & ~composer, "film_media"), (has(POPULAR) & ~composer, "popular"), (crossed, "crossover"), (composer | (F.size(occupations) == 0), "classical_core")], "crossover")
    src = ladder([((has(FILM) | has(POPULAR)) & ~composer, "occupations"), (crossed, "style_tags"), (F.size(occupations) == 0, "default")], "occupations")
    return F.struct(scope.alias("scope"), src.alias("src"))


def death_band(death, reference: int, canada: int = 1971) -> Column:
    y, last = F.when(F.trim(text(death)).rlike(r"^\d+$"), year(death)), reference - TERM
    return ladder([(y.isNull(), "unknown"), (y <= last, f"≤ {last}"), (y <= canada, f"{last + 1}–{canada}"), (y <= 1999, f"{canada + 1}–1999")], "2000+")


def rights_basis(flags) -> Column:
    """The first basis of which a row has a flag."""
    return ladder([(F.arrays_overlap(split_cell(flags), F.array(*map(F.lit, names))), key) for key, names in BASIS], "none")


def host_group(has_files, hosts) -> Column:
    found = split_cell(hosts)
    none = F.size(found) == 0
    return ladder(
        [(none & (text(has_files) == "false"), "no files"), (none, "unknown"), (F.array_contains(found, "asia"), "asia (life+50 server)"), (F.array_contains(found, "us"), "us (US-only server)")],
        "ca (main server only)",
    )


def evidence(categories: Column) -> Column:
    """struct of styles, first publication year, flags and librettists from a list of categories."""
    table = F.create_map(*(x for k, v in CATEGORY_FLAGS.items() for x in (F.lit(k), F.array(*map(F.lit, v)))))
    ending = lambda s: F.array_distinct(F.filter(F.transform(F.filter(categories, lambda c: c.endswith(s)), lambda c: F.left(c, F.char_length(c) - len(s))), lambda c: c != ""))
    years = F.array_compact(F.transform(categories, lambda c: whole_number(F.regexp_extract(c, r"^Works first published in (\d{4})$", 1))))
    flags = F.flatten(F.array_compact(F.transform(categories, lambda c: F.try_element_at(table, c))))
    return F.struct(
        F.array_join(ending(" style"), "|").alias("styles"),
        F.coalesce(F.array_min(years).cast("string"), F.lit("")).alias("first_published"),
        F.array_join(F.array_sort(F.array_distinct(flags)), "|").alias("flags"),
        F.array_join(ending("/Librettist"), "|").alias("librettists"),
    )


def unmapped_rights(categories: Column) -> Column:
    """Categories that look like rights categories but have no flag."""
    known = F.array(*map(F.lit, CATEGORY_FLAGS))
    looks = r"(?i)NonPD|(?<![A-Za-z0-9])RoST(?![A-Za-z0-9])|copyright|public domain|licensed through|creative commons|permission|(?-i:PD-|WIMA)"
    return F.filter(categories, lambda c: ~F.array_contains(known, c) & c.rlike(looks))


def file_evidence(files: Column) -> Column:
    """struct<has_files, hosts> of linked files; images do not count."""
    scores = F.filter(files, lambda f: ~F.lower(F.substring_index(f, ".", -1)).isin(IMAGES))

    def host(name):
        token = F.regexp_extract(name, r"^PMLP\d+-(PML[A-Z]+)\d+-", 1)
        return F.coalesce(*(F.when(token == k, v) for k, v in HOSTS.items()), F.when(token.isin("", "PMLP"), "ca"), F.lower(F.substr(token, F.lit(4))))

    return F.struct(F.when(F.size(scores) > 0, "true").otherwise("false").alias("has_files"), F.array_join(F.array_sort(F.array_distinct(F.transform(scores, host))), "|").alias("hosts"))


def with_term(df: DataFrame, death_col: str, reference: int) -> DataFrame:
    t = term(F.col(death_col), reference)
    return df.select("*", t["status"].alias("term_status"), t["year"].alias("term_year"), t["remaining"].alias("term_remaining"))


def with_attributes(children: DataFrame, parents: DataFrame, child_key: str, key: str, columns: list[str]) -> DataFrame:
    """``children`` with their parent's columns (``parent_…``); children without one keep nulls. Parents' keys are unique."""
    side = parents.select(F.col(key).alias(child_key), *(F.col(c).alias(f"parent_{c}") for c in columns))
    return children.join(side, child_key, "left")


def registry_join(people: DataFrame, registry: DataFrame, key: str, columns: list[str]) -> tuple[DataFrame, DataFrame]:
    """People with the registry's cells ('' without a row), and registry rows that no person has."""
    cells = registry.select(key, *columns)
    return people.join(cells, key, "left").na.fill("", columns), registry.join(people.select(key), key, "left_anti")


def style_gaps(people: DataFrame, styles: str, scope: str, views: str, key: str, n: int) -> DataFrame:
    """People of the core without a style, the most read first (a report's head)."""
    return people.where((text(styles) == "") & (F.col(scope) == "classical_core")).orderBy(F.col(views).desc_nulls_last(), key).limit(n)


def not_free(people: DataFrame, key: str, status: str, forced: list, sample: int, seed: str) -> DataFrame:
    """People not in the public domain: those in ``forced``, and others in hash order up to ``sample`` (a sampling operator)."""
    from .statistics import hash_order

    rest = people.where(text(status) != "pd")
    named = rest.where(F.col(key).isin(forced))
    others = rest.where(~F.col(key).isin(forced)).orderBy(hash_order(seed, key), key).limit(max(0, sample - len(forced)))
    return named.unionByName(others)


def remap_styles(people: DataFrame, table: DataFrame, key: str, styles: str, src: str, overwrite: bool = False) -> DataFrame:
    """Empty style cells filled from ``table`` (key, tags); with ``overwrite`` others too, but never those that models or reviewers gave."""
    joined = people.join(table.select(key, F.col("tags").alias("_tags")), key, "left")
    held = text(styles) != ""
    safe = text(src).rlike("^(llm|override)")
    fill = (F.coalesce("_tags", F.lit("")) != "") & (~held | (F.lit(overwrite) & ~safe))
    return joined.select(*(F.when(fill, F.col("_tags")).otherwise(F.col(c)).alias(c) if c == styles else F.when(fill, "wikidata").otherwise(F.col(c)).alias(c) if c == src else F.col(c) for c in people.columns))


def band_order(reference: int, canada: int = 1971) -> list[str]:
    """All bands of years of death, the earliest first."""
    last = reference - TERM
    return [f"≤ {last}", f"{last + 1}–{canada}", f"{canada + 1}–1999", "2000+", "unknown"]


def basis_report(works: DataFrame, band: Column, basis: Column, hosts: Column, reference: int, canada: int = 1971) -> DataFrame:
    """(section, row, col, n) over works, all off one cube of their bands, bases and hosts, zeros filled in.

    ``basis``: band by basis; ``warned`` and ``works``: those with a warning and all of a band; ``unflagged``: without a basis, by
    band (those out of protection and unknown ones aside) and hosts; ``hosts``: hosts by band.
    """
    bands, keys = band_order(reference, canada), [*(k for k, _ in BASIS), "none"]
    cube = works.select(band.alias("b"), basis.alias("k"), hosts.alias("h")).groupBy("b", "k", "h").agg(F.count(F.lit(1)).alias("n"))
    fact = lambda section, row, col: F.struct(F.lit(section).alias("section"), row.alias("row"), col.alias("col"))
    b, k, h, none = F.col("b"), F.col("k"), F.col("h"), F.lit("")
    facts = F.array_compact(
        F.array(fact("basis", b, k), fact("works", b, none), F.when(k == "eu_warning", fact("warned", b, none)), F.when((k == "none") & ~b.isin(bands[0], "unknown"), fact("unflagged", b, h)), fact("hosts", h, b))
    )
    told = cube.select("n", F.explode(facts).alias("x")).groupBy("x.section", "x.row", "x.col").agg(F.sum("n").alias("n"))
    spark = works.sparkSession
    grid = [("basis", x, y) for x in bands for y in keys] + [(s, x, "") for s in ("works", "warned") for x in bands]
    wanted = spark.createDataFrame(grid, "section string, row string, col string")
    seen = told.where("section = 'hosts'").select("section", "row").distinct().select("section", "row", F.explode(F.array(*map(F.lit, bands))).alias("col"))
    zeros = wanted.unionByName(seen).join(told, ["section", "row", "col"], "left").withColumn("n", F.coalesce("n", F.lit(0)))
    return zeros.unionByName(told.where("section = 'unflagged'"))


def residual_queue(works: DataFrame, key: str, owner: str, label: str, context: str, title: str, weak: list[str], protected: DataFrame, head: int, shown: int = 5) -> tuple[DataFrame, DataFrame]:
    """The queue of works to judge again, and (owner, titles, n) of the owners in it.

    Works with a ``weak`` label whose key is not ``protected``; those with a context first, then by key, the first ``head`` (a
    queue's head, taken by partial sorts). An owner shows its first ``shown`` titles by key, kept as a bounded list.
    """
    open_ = works.where(text(label).isin(weak)).join(protected.select(key).distinct(), key, "left_anti")
    queue = open_.withColumn("has_context", text(context) != "").orderBy(F.desc("has_context"), key).limit(head)
    rank = F.row_number().over(Window.partitionBy(owner).orderBy(key))
    few = open_.select(owner, key, title).withColumn("_r", rank).where(F.col("_r") <= shown)
    titles = few.groupBy(owner).agg(F.transform(F.array_sort(F.collect_list(F.struct("_r", title))), lambda x: x[title]).alias("titles"))
    counts = open_.groupBy(owner).agg(F.count(F.lit(1)).alias("n"))
    return queue, titles.join(counts, owner).select(owner, F.array_join("titles", "|").alias("titles"), "n")
