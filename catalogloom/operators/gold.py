"""Gold sets: strata, sheets, their checks, error metrics and agreement of passes."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.cells import split_cell, text, year
from .audits import error_rates
from .statistics import deal, hash_order, jaccard, masi_distance, stratified_sample
from .status import TERM, rights_basis

UNSTABLE = ["unverified_heuristic", "rejected_p839", "rejected_heuristic"]


def person_stratum(flags: str = "qa_flags", match: str = "imslp_match_status", method: str = "imslp_match_method", status: str = "eu_pd_status") -> Column:
    """Flagged rows, then unstable links, then status by link."""
    link = F.when(F.col(match) != "matched", "not_found").when(F.col(method) == "wikidata_p839", "p839").otherwise("name")
    return F.when(text(flags) != "", "qa_flagged").when(F.col(match).isin(UNSTABLE), "imslp_rejected_or_unverified").otherwise(F.concat_ws("/", status, link))


def person_stratum_by_style(flags: str = "qa_flags", match: str = "imslp_match_status", src: str = "style_tags_src", voted: str = "llm_style_tags", status: str = "eu_pd_status") -> Column:
    """Flagged and unstable rows together, then the source of styles by status."""
    style = F.when(F.col(src) == "wikidata", "wikidata").when(text(voted) != "", "consensus").otherwise("no_consensus")
    return F.when((text(flags) != "") | F.col(match).isin(UNSTABLE), "qa_or_unstable").otherwise(F.concat_ws("/", style, status))


def work_stratum(src: str = "force_family_src", flags: str = "imslp_copyright_flags") -> Column:
    """The source of the label; labels from pages also by rights."""
    basis = rights_basis(F.col(flags))
    rights = F.when(basis.isin("eu_warning", "none"), basis).otherwise("other_rights")
    return F.when(F.col(src).isin("imslp_tags", "imslp_geninfo"), F.concat_ws("/", F.lit("imslp"), rights)).when(F.col(src) == "title", "title").when(F.col(src).startswith("llm"), "llm").otherwise("unlabelled")


def build_sheets(df: DataFrame, stratum: str, key: str, total: int, minimum: int, packages: int, recheck: int, seed: str, spread: str | None = None, core: bool = False) -> DataFrame:
    """The design of a sample: stratum sizes, weight, package and whether an item is annotated twice (a sampling operator).

    With ``core`` the items annotated twice are of package 1.
    """
    picked = stratified_sample(df, stratum, key, total, minimum, seed, spread)
    dealt = deal(picked, stratum, key, packages, seed)
    pool = dealt.where("package = 1") if core else dealt
    twice = pool.orderBy(hash_order(f"{seed}-again", key), key).limit(recheck).select(key, F.lit(True).alias("recheck"))
    return dealt.join(twice, key, "left").withColumn("recheck", F.coalesce("recheck", F.lit(False)))


def numbered_items(design: DataFrame, key: str, prefix: str, seed: str) -> DataFrame:
    """``design`` with ``item``: prefix and number in package order, hash order within; positions tell nothing of strata. The design is a sample, so one task numbers it."""
    from pyspark.sql import Window

    at = F.row_number().over(Window.orderBy("package", hash_order(f"{seed}-items", key), key))
    size = F.count(F.lit(1)).over(Window.partitionBy())
    width = F.greatest(F.lit(3), F.char_length(size.cast("string")))
    return design.withColumn("_at", at.cast("string")).withColumn("item", F.concat(F.lit(prefix), F.lpad("_at", 20, "0").substr(21 - width, width))).drop("_at")


def subset(design: DataFrame, stratum: str, key: str, per_stratum: int, seed: str) -> DataFrame:
    """A second annotator's part: so many items of each stratum in hash order; population sizes stay, weights are made anew."""
    from pyspark.sql import Window

    rank = F.row_number().over(Window.partitionBy(stratum).orderBy(hash_order(seed, key), key))
    kept = design.withColumn("_rn", rank).where(F.col("_rn") <= per_stratum).drop("_rn")
    sizes = kept.groupBy(stratum).agg(F.count(F.lit(1)).alias("stratum_sample"))
    return kept.drop("stratum_sample", "weight").join(F.broadcast(sizes), stratum).withColumn("weight", F.col("stratum_size") / F.col("stratum_sample"))


def sheet_faults(sheet: DataFrame, item: str, allowed: dict[str, list[str]], required: list[str]) -> DataFrame:
    """(item, field, fault): answers outside their vocabulary, and required ones that are empty; all in one pass."""
    wrong = [F.when((text(c) != "") & ~text(c).isin(values), F.struct(F.lit(c).alias("field"), F.lit("invalid").alias("fault"))) for c, values in allowed.items()]
    empty = [F.when(text(c) == "", F.struct(F.lit(c).alias("field"), F.lit("empty").alias("fault"))) for c in required]
    return sheet.select(item, F.explode(F.array_compact(F.array(*wrong, *empty))).alias("x")).select(item, "x.*")


def cleared(sheet: DataFrame, allowed: dict[str, list[str]]) -> DataFrame:
    """``sheet`` with answers outside their vocabulary emptied."""
    return sheet.withColumns({c: F.when(text(c).isin(values), text(c)).otherwise("") for c, values in allowed.items()})


def with_design(sheet: DataFrame, design: DataFrame, dump: DataFrame, item: str, key: str) -> DataFrame:
    """Answers with their design by item and the snapshot's cells (``dump_…``) by key."""
    cells = dump.select(key, *(F.col(c).alias(f"dump_{c}") for c in dump.columns if c != key))
    return sheet.join(design.drop(key), item, "left").join(cells, key, "left")


def person_metrics(reference: int) -> dict[str, tuple[Column, Column]]:
    """Metric -> (eligible, wrong) over answers and the snapshot's cells."""
    said, known, last = year(F.col("death_year")), year(F.col("dump_death_year")), reference - TERM
    dead, living = F.col("death_status") == "dead", F.col("death_status") == "living"
    truth = F.when(living, "not_pd").when(dead & said.isNotNull(), F.when(said <= last, "pd").otherwise("not_pd"))
    both, pd, linked = dead & said.isNotNull() & known.isNotNull(), F.col("dump_eu_pd_status") == "pd", text("imslp_url") != ""
    one_of = lambda c, *values: F.col(c).isin(*values)
    return {
        "identity_wrong": (one_of("wikidata_same_person", "yes", "no"), F.col("wikidata_same_person") == "no"),
        "imslp_link_wrong": (linked & one_of("imslp_check", "same", "different"), F.col("imslp_check") == "different"),
        "imslp_link_missed": (~linked & one_of("imslp_check", "found", "none"), F.col("imslp_check") == "found"),
        "death_year_wrong": (both, said != known),
        "death_year_off_by_2plus": (both, F.abs(said - known) > 1),
        "death_missing": (known.isNull() & (dead | living), dead),
        "false_pd": (pd & truth.isNotNull(), truth == "not_pd"),
        "missed_pd": (~pd & truth.isNotNull(), truth == "pd"),
    }


def work_metrics(families: list[str], forms: list[str], bases: list[str]) -> dict[str, tuple[Column, Column]]:
    """Metric -> (eligible, wrong) of works."""
    form, had = F.col("genre_form"), text("dump_genre_form")
    some, listed = form != "none", form.isin(forms)
    return {
        "force_family_wrong": (F.col("force_family").isin(families), F.col("force_family") != F.col("dump_force_family")),
        "genre_form_wrong": (listed, form != F.when(had == "", "none").otherwise(had)),
        "genre_form_missed": (listed & (had == ""), some),
        "genre_form_spurious": (listed & ~had.isin("", "arrangement"), ~some),
        "genre_form_arrangement": (listed & (had == "arrangement"), some),
        "has_files_wrong": (F.col("has_files").isin("yes", "no") & F.col("dump_has_files").isin("true", "false"), (F.col("has_files") == "yes") != (F.col("dump_has_files") == "true")),
        "rights_basis_wrong": (F.col("rights_basis").isin(bases), F.col("rights_basis") != rights_basis(F.col("dump_imslp_copyright_flags"))),
    }


def scores(df: DataFrame, stratum: str, metrics: dict[str, tuple[Column, Column]]) -> DataFrame:
    """Error rates by stratum and overall ('')."""
    parts = error_rates(df, stratum, metrics)
    whole = parts.groupBy("metric").agg(F.sum("eligible").alias("eligible"), F.sum("errors").alias("errors")).select("metric", F.lit("").alias(stratum), "eligible", "errors", F.try_divide("errors", "eligible").alias("rate"))
    return parts.unionByName(whole)


def answers(sheet: DataFrame, item: str, annotator: Column, fields: list[str], stratum: Column | None = None) -> DataFrame:
    """(stratum, item, annotator, field, value): each given answer once; '' is no answer."""
    each = F.explode(F.array(*(F.struct(F.lit(f).alias("field"), text(f).alias("value")) for f in fields)))
    rows = sheet.select((stratum if stratum is not None else F.lit("")).alias("stratum"), F.col(item).alias("item"), annotator.alias("annotator"), each.alias("x"))
    return rows.select("stratum", "item", "annotator", "x.*").where("value <> ''")


def coincidences(given: DataFrame, sets: list[str] = ()) -> DataFrame:
    """The cube (stratum, field, a, b, value_a, value_b, n, weight): pairs of answers to one item by two annotators, a before b, counted for all fields at once.

    ``weight`` sums 1 / (answers to the item - 1), as alpha needs it. Values of fields in ``sets`` are '|'-lists, put in
    order. Pairs of an item are as many as its few annotators give. A second answer of an annotator to an item counts by the least value.
    """
    ordered = F.when(F.col("field").isin(list(sets)), F.array_join(F.array_sort(F.array_distinct(split_cell("value"))), "|")).otherwise(F.col("value"))
    once = given.groupBy("stratum", "item", "field", "annotator").agg(F.min(ordered).alias("value"))
    items = once.groupBy("stratum", "item", "field").agg(F.array_sort(F.collect_list(F.struct("annotator", "value"))).alias("v")).where(F.size("v") > 1)
    pairs = F.flatten(F.transform("v", lambda a, i: F.transform(F.slice(F.col("v"), i + 2, F.size("v")), lambda b: F.struct(a.alias("a"), b.alias("b")))))
    each = items.select("stratum", "field", (1 / (F.size("v") - 1)).alias("w"), F.explode(pairs).alias("p"))
    return each.groupBy("stratum", "field", F.col("p.a.annotator").alias("a"), F.col("p.b.annotator").alias("b"), F.col("p.a.value").alias("value_a"), F.col("p.b.value").alias("value_b")).agg(F.count(F.lit(1)).alias("n"), F.sum("w").alias("weight"))


def _with_whole(cube: DataFrame) -> DataFrame:
    """The cube of each stratum and of all strata together ('')."""
    both = F.array_distinct(F.array("stratum", F.lit("")))
    return cube.withColumn("stratum", F.explode(both))


def pair_agreement(cube: DataFrame, sets: list[str] = ()) -> DataFrame:
    """(stratum, field, a, b, pairs, agree, kappa, jaccard) of every two annotators, by stratum and overall (''), off the cube.

    Fields in ``sets`` have a mean Jaccard and no kappa. Where both give one value alone, kappa is 1 if it is the same and 0 if not.
    """
    on = ["stratum", "field", "a", "b"]
    whole = _with_whole(cube).groupBy(*on, "value_a", "value_b").agg(F.sum("n").alias("n"))
    is_set = F.col("field").isin(list(sets))
    like = F.when(is_set, jaccard(split_cell("value_a"), split_cell("value_b")))
    told = whole.groupBy(*on).agg(F.sum("n").alias("pairs"), (F.sum(F.when(F.col("value_a") == F.col("value_b"), F.col("n")).otherwise(0)) / F.sum("n")).alias("agree"), (F.sum(like * F.col("n")) / F.sum("n")).alias("jaccard"))
    side = lambda v, n: whole.groupBy(*on, F.col(v).alias("value")).agg(F.sum("n").alias(n))
    chance = side("value_a", "n_a").join(side("value_b", "n_b"), [*on, "value"]).groupBy(*on).agg(F.sum(F.col("n_a").cast("double") * F.col("n_b")).alias("both"))
    expected = F.coalesce("both", F.lit(0.0)) / (F.col("pairs").cast("double") * F.col("pairs"))
    kappa = F.when(is_set, None).when(F.abs(1 - expected) < 1e-12, F.when(F.col("agree") == 1, 1.0).otherwise(0.0)).otherwise((F.col("agree") - expected) / (1 - expected))
    return told.join(chance, on, "left").select(*on, "pairs", "agree", kappa.alias("kappa"), "jaccard")


def field_alpha(cube: DataFrame, sets: list[str] = ()) -> DataFrame:
    """(stratum, field, pairs, agree, alpha) over all annotators, by stratum and overall (''), off the cube: Krippendorff's alpha, with MASI distance for fields in ``sets``.

    Expected disagreement meets the distinct values of a field with each other; those are a vocabulary, not rows.
    """
    on = ["stratum", "field"]
    whole = _with_whole(cube).groupBy(*on, "value_a", "value_b").agg(F.sum("n").alias("n"), F.sum("weight").alias("weight"))
    apart = lambda a, b: F.when(F.col("field").isin(list(sets)), masi_distance(split_cell(a), split_cell(b))).otherwise((F.col(a) != F.col(b)).cast("double"))
    told = whole.groupBy(*on).agg(F.sum("n").alias("pairs"), (F.sum(F.when(F.col("value_a") == F.col("value_b"), F.col("n")).otherwise(0)) / F.sum("n")).alias("agree"), (2 * F.sum(F.col("weight") * apart("value_a", "value_b"))).alias("observed"), (2 * F.sum("weight")).alias("total"))
    marginal = whole.select(*on, F.explode(F.array("value_a", "value_b")).alias("value"), "weight").groupBy(*on, "value").agg(F.sum("weight").alias("m"))
    other = marginal.select(*on, F.col("value").alias("other"), F.col("m").alias("k"))
    expected = marginal.join(other, on).where("value <> other").groupBy(*on).agg(F.sum(F.col("m") * F.col("k") * apart("value", "other")).alias("expected"))
    alpha = F.when(F.col("expected") > 0, 1 - (F.col("total") - 1) * F.col("observed") / F.col("expected")).otherwise(F.lit(1.0))
    return told.join(expected, on, "left").select(*on, "pairs", "agree", alpha.alias("alpha"))


def pass_agreement(first: DataFrame, second: DataFrame, on: str, fields: list[str], sets: list[str] = ()) -> DataFrame:
    """(field, pairs, agree, kappa, jaccard) of two passes over the same items; fields in ``sets`` are '|'-lists without kappa. All fields come off one cube."""
    both = answers(first, on, F.lit("1"), fields).unionByName(answers(second, on, F.lit("2"), fields))
    found = pair_agreement(coincidences(both, sets), sets).where("stratum = ''").select("field", "pairs", "agree", "kappa", "jaccard")
    named = first.sparkSession.createDataFrame([(f,) for f in fields], "field string")
    return named.join(found, "field", "left").withColumn("pairs", F.coalesce("pairs", F.lit(0)))


def source_scores(df: DataFrame, sources: dict[str, str], truth: str) -> DataFrame:
    """(source, n, precision, recall, none_shared, mean_jaccard) of '|'-lists against the annotator's; rows without either list leave."""
    want = split_cell(truth)
    each = F.explode(F.array(*(F.struct(F.lit(name).alias("source"), split_cell(c).alias("got")) for name, c in sources.items())))
    rows = df.select(want.alias("want"), each.alias("s")).select("want", "s.*").where((F.size("want") > 0) & (F.size("got") > 0))
    shared = F.size(F.array_intersect("want", "got"))
    return rows.groupBy("source").agg(
        F.count(F.lit(1)).alias("n"), (F.sum(shared) / F.sum(F.size("got"))).alias("precision"), (F.sum(shared) / F.sum(F.size("want"))).alias("recall"), F.count_if(shared == 0).alias("none_shared"), F.avg(jaccard(F.col("want"), F.col("got"))).alias("mean_jaccard")
    )


def period_kappas(df: DataFrame, item: str, sources: dict[str, str], truth: str) -> DataFrame:
    """(source, pairs, agree, kappa): each source's period against the annotator's, where both name one; all sources in one pass."""
    rows = answers(df.select(item, *(F.col(c).alias(f"s_{name}") for name, c in sources.items())), item, F.lit("source"), [f"s_{name}" for name in sources])
    told = answers(df.select(item, *(F.col(truth).alias(f"s_{name}") for name in sources)), item, F.lit("truth"), [f"s_{name}" for name in sources])
    found = pair_agreement(coincidences(rows.unionByName(told))).where("stratum = ''")
    return found.select(F.substring("field", 3, 100).alias("source"), "pairs", "agree", "kappa")
