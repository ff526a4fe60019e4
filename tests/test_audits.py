"""Audits on rows that the catalogue's tables do not hold."""

import pytest
from pyspark.sql import functions as F

from catalogloom.operators import audits


def test_empty_tables(spark):
    none = spark.createDataFrame([], "id string, licence string, url string, n string")
    assert audits.registry_errors(none, "id", ["url"], "licence", ["url"], ["n"]).count() == 0
    assert audits.most_common(none, "id").count() == 0
    assert audits.pooled_answers(none, "id", ["url"], F.col("n") == "1", ["url"]).count() == 0


def test_null_cells_are_missing(spark):
    rows = spark.createDataFrame([(None, None, None, None), ("a", None, "http://x", None)], "id string, licence string, url string, n string")
    got = {(r["id"], r["error"], r["column"]) for r in audits.registry_errors(rows, "id", ["licence"], "licence", ["url"], ["n"]).collect()}
    assert got == {("", "missing key", "id"), ("a", "missing field", "licence")}


@pytest.mark.parametrize("window, label", [("2025-01..2025-12", "2025"), ("2024-07..2025-06", "2024-07..2025-06"), ("all", "all"), (None, None)])
def test_period_label(spark, window, label):
    assert spark.range(1).select(audits.period_label(F.lit(window).cast("string")).alias("x")).first()["x"] == label


def test_pool_prefers_complete_answers_then_order(spark):
    rows = spark.createDataFrame([(1, 1, None), (1, 2, "x"), (1, 3, "y"), (2, 2, None), (2, 1, None)], "item int, who int, answer string")
    got = {r["item"]: (r["who"], r["answer"]) for r in audits.pooled_answers(rows, "item", ["who"], F.col("answer").isNotNull(), ["who", "answer"]).collect()}
    assert got == {1: (2, "x"), 2: (1, None)}


def test_agreement_sets_empty_pairs_apart(spark):
    rows = spark.createDataFrame([(1, "m", ["a"]), (1, "n", ["a", "b"]), (2, "m", []), (2, "n", []), (3, "m", ["a"])], "u int, who string, tags array<string>")
    assert [tuple(r) for r in audits.pair_agreement(rows, "u", "who", "tags").collect()] == [("m", "n", 2, 1, 0.5)]


def test_pilot_sample_takes_nobody_twice(spark):
    rows = spark.range(100)
    got = audits.pilot_sample(rows, [("even", F.col("id") % 2 == 0, 10), ("all", F.lit(True), 60)], "id", "s").collect()
    assert len({r["id"] for r in got}) == len(got) == 60
