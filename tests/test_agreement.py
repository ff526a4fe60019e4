"""Reports of labellers, re-keyed rows and authority ids on cases that the tables do not hold."""

import pytest
from pyspark.sql import functions as F

from catalogloom.operators import agreement, overlay, resolve

ROWS = "u int, who string, c string, h string, tags array<string>, period string"
REFS = "u int, wanted array<string>, periods array<string>"


@pytest.fixture(scope="module")
def rows(spark):
    told = [(1, "m", "x", "h", ["a"], "p"), (1, "n", "x", "h", ["a", "b"], "q"), (2, "m", "x", "h", [], "unknown"), (2, "n", "x", "g", ["b"], "p"), (3, "m", "x", None, ["a"], None), (3, "n", "x", None, ["a"], "p")]
    return spark.createDataFrame(told, ROWS)


def test_scores_count_only_units_with_a_reference(spark, rows):
    refs = spark.createDataFrame([(1, ["a"], ["p", "q"]), (2, [], ["p"]), (3, None, None)], REFS)
    got = {r["who"]: r.asDict() for r in agreement.label_scores(rows, refs, "u", ["who", "c"]).collect()}
    assert (got["m"]["n"], got["m"]["abstained"], got["m"]["reference_n"], got["m"]["f1"]) == (3, 1, 1, 1.0)
    assert (got["n"]["precision"], got["n"]["recall"], got["n"]["period_n"], got["n"]["period_ties"], got["n"]["period_hits"]) == (0.5, 1.0, 2, 1, 2)


def test_equal_terms_need_everyone_and_one_input(rows):
    kept, counts = agreement.equal_terms(rows, "u", "who", "c", "h", ["m", "n"])
    assert {r["u"] for r in kept.collect()} == {1, 3}  # inputs without a hash are the same
    assert [tuple(r) for r in counts.collect()] == [("x", 3, 2, 1)]


def test_votes(spark, rows):
    refs = spark.createDataFrame([(1, ["b"], [])], REFS)
    got = {r["rule"]: (r["n"], r["covered"], r["reference_n"], r["recall"]) for r in agreement.vote_scores(rows, refs, "u", "who", "c", agreement.voting_rules(["m", "n"])).collect()}
    assert got == {"m+n": (3, 2, 1, 0.0), "1 of 2": (3, 3, 1, 1.0), "2 of 2": (3, 2, 1, 0.0)}


def test_alpha_of_sets_is_one_for_equal_sets_in_any_order(spark):
    told = [(u, w, "x", "h", tags, "p") for u, sets in enumerate(([["a", "b"], ["b", "a"]], [["c"], ["c"]])) for w, tags in zip("mn", sets)]
    got = {r["measure"]: (r["n"], r["alpha"]) for r in agreement.alphas(spark.createDataFrame(told, ROWS), "u", "c", ["x"]).collect()}
    assert got == {"period": (4, 1.0), "tags": (4, 1.0)}


def test_reports_of_empty_tables(spark):
    none, refs = spark.createDataFrame([], ROWS), spark.createDataFrame([], REFS)
    assert agreement.label_scores(none, refs, "u", ["who"]).count() == 0
    assert agreement.vote_scores(none, refs, "u", "who", "c", agreement.voting_rules(["m", "n"])).count() == 0
    assert agreement.period_confusion(none, refs, "u", ["who"]).count() == 0


def test_effort_is_part_of_the_labeller(spark):
    df = spark.createDataFrame([("m", "high", "closed", "v1"), ("m", None, "closed", None)], "model string, effort string, condition string, prompt_version string")
    assert [(r["labeller"], r["asked"]) for r in agreement.with_version(df).collect()] == [("m@high", "closed@v1"), ("m", "closed@")]


def _derive(spark, people, moves):
    docs = spark.createDataFrame([("Q2", ("x", "f", None)), ("Q3", ("y", "", "Category:C"))], "id string, e struct<occupations:string,flags:string,category:string>")
    return overlay.rederive(people, moves, docs, "id", {"occupations": "occupations", "flags": "flags"})


PEOPLE, MOVES = "id string, occupations string, category string, flags string", "key string, field string, value string, date string"


def test_rederived_rows(spark):
    people = spark.createDataFrame([("Q1", "old", "Category:B", "z"), ("Q4", "old", "Category:C", "z"), ("Q5", "old", None, None), ("Q6", "old", "Category:D", "z")], PEOPLE)
    moves = spark.createDataFrame([("Q1", overlay.REKEY, "Q2", "1"), ("Q4", overlay.REKEY, "Q3", "1"), ("Q6", overlay.REKEY, "Q3", "1"), ("Q7", overlay.REKEY, "Q3", "1")], MOVES)
    got = {tuple(r) for r in _derive(spark, people, moves).collect()}
    assert got == {("Q2", "x", "Category:B", "f", "p839_none"), ("Q3", "y", "Category:C", "", "matched_p839"), ("Q3", "y", "Category:D", "imslp_needs_recheck", "imslp_needs_recheck"), ("Q5", "old", None, None, "")}


def test_a_new_key_needs_its_document(spark):
    people = spark.createDataFrame([("Q1", "old", "", "")], PEOPLE)
    with pytest.raises(Exception, match="no document of the new key Q9"):
        _derive(spark, people, spark.createDataFrame([("Q1", overlay.REKEY, "Q9", "1")], MOVES)).collect()


def test_no_conflict_of_authorities_without_both_years(spark):
    row = spark.range(1).select(F.lit(True).alias("has_entity"), F.lit("A").alias("own"), F.lit(True).alias("has_record"), F.lit(None).cast("int").alias("record_death"), F.lit(False).alias("has_search"), F.lit("").alias("found"), F.lit(None).cast("int").alias("found_death"), F.lit(1900).alias("death"), F.lit(None).cast("string").alias("prior_id"), F.array(F.lit("gnd_death_conflict")).alias("prior_flags"))
    got = resolve.authority_with_prior(row).first()
    assert (got["authority_id"], got["authority_flags"], got["authority_src"]) == ("A", "", "own")
