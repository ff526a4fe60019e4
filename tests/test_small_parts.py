"""Smaller parts on written-out cases: years, revisions, ledgers, answers, streams, styles and stages."""

import datetime

import pytest
from pyspark.sql import functions as F

from catalogloom.functions import styles
from catalogloom.operators import derive, gold, snapshots, statistics, status
from catalogloom.sources import revisions, tables
from catalogloom.streaming import ledger as intake


@pytest.mark.parametrize(("n", "take"), [(24, 18), (48, 21), (40, 15), (50, 7), (9, 9)])
def test_systematic_places_are_all_taken(spark, n, take):
    """Sizes at which the division that finds a place's number is off by a last digit."""
    want = {int(0.5 * (n / take) + j * (n / take)) for j in range(take)}
    rows = spark.range(n).select(F.lit("s").alias("s"), F.lit("x").alias("v"), "id")
    assert {r.id for r in statistics.systematic(rows, "v", "id", take).collect()} == want
    ordered = rows.withColumn("v", F.lpad(F.col("id").cast("string"), 3, "0"))
    assert {r.id for r in statistics.systematic_within(ordered, "s", "v", "id", {"s": (n, take)}, "seed").collect()} == want


def test_reference_years():
    assert status.reference_year({"pd_reference_year": "2025", "created_at_utc": "2024-01-01"}, 2026) == 2025
    assert status.reference_year({"created_at_utc": "2024-05-01T00:00:00Z"}, 2026) == 2024 and status.reference_year({}, 2026) == 2026


def test_conflicts_of_years(spark):
    rows = spark.createDataFrame([("1800", "1850", "1800.0", ""), ("1800", "", "1801", ""), ("", "1850", "", "1851"), (None, None, None, None)], "a string, b string, c string, d string")
    assert [r[0] for r in rows.select(status.years_conflict(F.col("a"), F.col("b"), F.col("c"), F.col("d"))).collect()] == [False, True, True, False]


def test_changes_are_counted(spark):
    old, new = spark.createDataFrame([(1, "a", "x"), (2, "b", "x"), (3, "c", "x")], "k int, v string, w string"), spark.createDataFrame([(1, "z", "y"), (2, "q", "x"), (4, "d", "x")], "k int, v string, w string")
    got = {(r.change, r.column): r.n for r in snapshots.change_counts(snapshots.cell_changes(old, new, ["k"], ["v", "w"])).collect()}
    assert got == {("changed", "v"): 2, ("changed", "w"): 1, ("added", ""): 1, ("removed", ""): 1}
    report = snapshots.diff_report(old, new.withColumn("fetched_at", F.lit("now")), ["k"])
    assert snapshots.has_changes(report) and not snapshots.has_changes(snapshots.diff_report(old, old.withColumn("pageviews_x", F.lit(1)), ["k"]))
    assert {(r.section, r.name): r.n for r in report.where("section <> 'cells'").collect()} == {("rows", "old"): 3, ("rows", "new"): 3, ("rows", "added"): 1, ("rows", "removed"): 1, ("rows", "changed"): 2}


def test_revisions_are_read_back(spark, tmp_path):
    df = spark.createDataFrame([(1, "a")], "k int, v string")
    revision = revisions.promote({"people": df}, str(tmp_path), {"crawl_date": "x"})
    assert revisions.read_revision(spark, str(tmp_path), revision, "people").collect() == df.collect()
    meta = revisions.merged_meta(revisions.read_meta(spark, str(tmp_path), revision), "r000", "r002", [{"stage": "a"}], {"people": df.columns}, 2026)
    assert meta["row_counts"] == {"people": 1} and meta["dump_id"] == "r002" and meta["derived_from_dump_id"] == "r000" and meta["people_columns"] == ["k", "v"] and meta["pd_reference_year"] == 2026
    window = spark.range(1).select(revisions.view_window(F.lit("2026-03-15").cast("date")).alias("w")).first().w
    assert (window.first, window.last) == (datetime.date(2025, 3, 1), datetime.date(2026, 2, 28))


def test_prepared_results(spark):
    df = spark.createDataFrame([(1, "x", "r1")], "a int, b string, dump_date string")
    wide = revisions.with_columns_after(df, "a", {"new": 5, "b": F.lit("moved")})
    assert wide.columns == ["a", "new", "b", "dump_date"] and revisions.with_columns_after(df, "none", {"z": 1}).columns[-1] == "z"
    out = revisions.prepared(wide, df.columns, "r2", ["new"])
    assert out.columns == ["a", "b", "dump_date", "new"] and tuple(out.first()) == (1, "moved", "r2", 5)
    for source, wanted in ((["a", "gone"], {}), (df.columns, {"may_add": []}), (df.columns, {"may_add": ["new"], "preserve": True})):
        with pytest.raises(ValueError, match="columns"):
            revisions.prepared(wide, source, "r2", **wanted)


def test_ledgers_grow(spark, tmp_path):
    row = spark.createDataFrame([("Q1", "m", ["a"], "2024-01-01T00:00:00Z")], "composer_id string, model string, styles array<string>, created_at string")
    for _ in range(2):
        tables.append_ledger(row, str(tmp_path / "l"))
    assert tables.read_ledger(spark, str(tmp_path / "l")).count() == 2


def test_answers_outside_the_vocabulary_are_emptied(spark):
    sheet = spark.createDataFrame([(1, "yes", "x"), (2, "maybe", None)], "i int, a string, b string")
    assert [tuple(r) for r in gold.cleared(sheet, {"a": ["yes", "no"], "b": ["x"]}).collect()] == [(1, "yes", "x"), (2, "", "")]


def test_typed_cells(spark):
    cells = spark.createDataFrame([("1.0", "x", "2024-01-01", "k1"), ("1.5", "", "soon", "k2"), (None, "2", "", "k3")], "n string, d string, day string, key string")
    rows, faults = tables.typed(cells, "n int, d double, day date, more string", ["key"])
    assert [tuple(r) for r in rows.collect()] == [(1, None, datetime.date(2024, 1, 1), None), (None, None, None, None), (None, 2.0, None, None)]
    assert sorted(map(tuple, faults.collect())) == [("k1", "d", "x"), ("k2", "day", "soon"), ("k2", "n", "1.5")]


def test_streams_drop_repeats_and_count(spark, tmp_path):
    spark.sql("SELECT * FROM VALUES ('e1', timestamp'2024-01-01 10:00:00', 'a'), ('e1', timestamp'2024-01-01 10:00:00', 'a'), ('e2', timestamp'2024-01-01 11:00:00', 'a'), ('e3', timestamp'2024-01-05 00:00:00', 'b') AS t(id, at, k)").coalesce(1).write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("id string, at timestamp, k string").parquet(f"{tmp_path}/in")
    got = []
    for name, df, mode in (("r", intake.without_repeats(stream, "id", "at"), "append"), ("w", intake.counts_by_window(stream, "at", "k"), "update")):
        q = df.writeStream.outputMode(mode).foreachBatch(lambda b, n: got.append([tuple(r) for r in b.collect()])).option("checkpointLocation", f"{tmp_path}/{name}").trigger(availableNow=True).start()
        q.awaitTermination(120)
        assert q.exception() is None
    rows = [r for batch in got for r in batch]
    assert sorted(r[0] for r in rows if len(r) == 3 and isinstance(r[0], str)) == ["e1", "e2", "e3"]
    assert sorted((r[1], r[2]) for r in rows if isinstance(r[0], datetime.datetime)) == [("a", 3), ("b", 1)]


def test_votes_of_styles(spark):
    df = spark.createDataFrame([("a=romantic|x;b=unknown;junk",), ("",), (None,), ("b=a=b",)], "v string")
    got = df.select(styles.votes_by_labeller("v", ["a", "b"]).alias("s"), styles.period_votes_by_labeller("v", ["a", "b"]).alias("p")).collect()
    assert [r.s for r in got] == [[["Romantic", "x"], ["unknown"]], [], [], [None, ["a=b"]]]
    assert [r.p for r in got] == [["Romantic|x", ""], [], [], [None, "a=b"]]


def test_stages_are_recorded(spark):
    df = spark.range(3)
    tables_, records = derive.run({"a": df}, [("one", lambda t: {"a": t["a"].where("id > 0")}), ("two", lambda t: {"b": t["a"].limit(1)})])
    assert tables_["a"].count() == 2 and records == [{"stage": "one", "row_counts": {"a": 2}}, {"stage": "two", "row_counts": {"b": 1}}]
    assert [name for name, _ in derive.offline_stages(2026, [], ("a", "b"))] == derive.ORDER and len(derive.ORDER) == 9
