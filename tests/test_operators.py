"""Operators that the catalogue's tables do not reach."""

import hashlib
import json

import pytest
from pyspark.sql import functions as F

from catalogloom.functions import cells
from catalogloom.operators import facets, forces, ledger, markup, overlay, resolve, rollups, snapshots, statistics, status
from catalogloom.sources import revisions, tables
from catalogloom.streaming import ledger as intake


def one(spark, column):
    return spark.range(1).select(column.alias("x")).first()["x"]


@pytest.mark.parametrize(
    "cell, family",
    [
        ("For 3 pianos", "piano_ensemble"),
        ("For piano right hand", "piano_solo"),
        ("For piano 6 hands", "piano_ensemble"),
        ("For unaccompanied voices", "choral"),
        ("For 4 voices", "choral"),
        ("For narrator", "solo_voice"),
        ("For string orchestra", "orchestral"),
        ("For oboe and strings", "concerto"),
        ("For winds", "wind_band"),
        ("For computer, viola", "electronic"),
        ("For 2 theorbos", "guitar"),
        ("For celesta, organ", "piano_ensemble"),
        ("For bassoon", "solo_instrument"),
        ("For horn, 2 pianos", "chamber"),
        ("Lieder|Concertos", "solo_voice"),
        ("Methods", "pedagogical"),
        ("Radio plays", "film_media"),
        ("Overtures|For 3 pianos", "orchestral"),
        ("For 7 players|Ballets", "stage_ballet"),
        ("For 7 players", "chamber"),
        ("For voice on stage", "stage_opera"),
    ],
)
def test_forces(spark, cell, family):
    assert one(spark, forces.from_categories(F.lit(cell)))["family"] == family


def test_recompute_ignores_held_labels(spark):
    args = (F.lit("For piano"), F.lit(""), F.lit(""), F.lit("organ"), F.lit("imslp_tags"))
    assert one(spark, forces.with_provenance(*args))["family"] == "organ"
    assert one(spark, forces.with_provenance(*args, recompute=True))["family"] == "piano_solo"


@pytest.mark.parametrize("text, year", [("1950", 1950), ("1950.0", 1950), ("", None), ("x", None), ("-5", -5), (None, None), ("99999999999", None)])
def test_year(spark, text, year):
    assert one(spark, cells.year(F.lit(text).cast("string"))) == year


def test_cells_round_trip(spark):
    assert one(spark, cells.join_cell(F.array(F.lit(" b "), F.lit("a"), F.lit(""), F.lit("b"), F.lit(None)))) == "b|a"
    assert one(spark, cells.split_cell(F.lit("a||b"))) == ["a", "b"]
    assert one(spark, cells.split_cell(F.lit(None))) == []
    got = one(spark, cells.votes(F.lit("m1=a|b;m2=c;;bad")))
    assert [(v["key"], v["tags"]) for v in got] == [("m1", ["a", "b"]), ("m2", ["c"])]


def test_truncate_at_sentence(spark):
    assert one(spark, cells.truncate_at_sentence(F.lit("One two. Three four five"), 20)) == "One two. Three four"
    assert one(spark, cells.truncate_at_sentence(F.lit("One two three. Four five"), 20)) == "One two three."
    assert one(spark, cells.truncate_at_sentence(F.lit("short"), 20)) == "short"


def test_tsv_keeps_text(spark, tmp_path):
    rows = [("001", " NA ", 'say "x"'), ("", "a\nb", "1.0")]
    tables.write_tsv(spark.createDataFrame(rows, "a string, b string, c string").coalesce(1), f"{tmp_path}/t")
    assert sorted(map(tuple, tables.read_tsv(spark, f"{tmp_path}/t").collect())) == sorted(rows)
    with pytest.raises(Exception, match="(?i)already exists"):
        tables.write_tsv(spark.createDataFrame(rows, "a string, b string, c string"), f"{tmp_path}/t")


def test_ledger_replay(spark, tmp_path):
    lines = [
        {"composer_id": "Q1", "model": "m", "styles": ["a"], "created_at": "2024-01-01T00:00:00Z"},
        {"composer_id": "Q1", "model": "m", "styles": ["b"], "created_at": "2024-01-01T00:00:00Z"},
        {"composer_id": "Q2", "model": "m", "styles": [], "created_at": "2024-01-01T00:00:00"},
    ]
    (tmp_path / "l.jsonl").write_text("\n".join(map(json.dumps, lines)))
    got = tables.read_ledger(spark, str(tmp_path / "l.jsonl"))
    newest = {r["composer_id"]: r["styles"] for r in ledger.latest(got, ["composer_id", "model"], "at", "line").collect()}
    assert newest == {"Q1": ["b"], "Q2": []}
    assert [r["composer_id"] for r in tables.bad_times(got).collect()] == ["Q2"]


def test_ids_and_stores(spark, tmp_path):
    (tmp_path / "ids.txt").write_text("# head\nb\n\na\n")
    assert [r["id"] for r in tables.read_ids(spark, str(tmp_path / "ids.txt")).orderBy("place").collect()] == ["b", "a"]
    spark.createDataFrame([("n", "k", '{"a": 1}'), ("n", "bad", "{"), ("m", "k", "1")], "namespace string, key string, payload string").write.parquet(f"{tmp_path}/d")
    docs = tables.read_documents(spark, f"{tmp_path}/d", "n")
    assert [r["key"] for r in docs.collect()] == ["k"]
    assert [r["key"] for r in tables.pending(spark.createDataFrame([("k",), ("z",)], "key string"), docs).collect()] == ["z"]
    assert [one(spark, tables.store_key(F.lit(k))) for k in ("Dvořák.x-1", "A b/c")] == ["Dvořák.x-1", "A_b_c~" + hashlib.sha256(b"A b/c").hexdigest()[:16]]


def test_promote_is_exclusive_and_clean(spark, tmp_path):
    root = f"{tmp_path}/revs"
    df = spark.range(3).toDF("id")
    assert revisions.promote({"composers": df}, root, {"note": "x"}) == "r001"
    assert revisions.next_revision(spark, root) == "r002"
    assert revisions.read_meta(spark, root, "r001")["row_counts"] == {"composers": 3}
    with pytest.raises(FileExistsError):
        revisions.promote({"composers": df}, root, {}, "r001")
    with pytest.raises(Exception):  # noqa: B017
        revisions.promote({"composers": df.select(F.raise_error(F.lit("no")).alias("id"))}, root, {})
    assert revisions.revisions(spark, root) == [1]
    with pytest.raises(ValueError, match="lost"):
        revisions.check_schema(["a", "b"], ["a"], [])


def test_allocation_sums_up():
    sizes = {"a": 1000, "b": 10, "c": 3}
    got = statistics.allocate(sizes, 40, 5)
    assert sum(got.values()) == 40 and got["c"] == 3 and got["b"] >= 5
    assert statistics.allocate(sizes, 5000, 5) == sizes


def test_kappa_of_constant_labels(spark):
    same = spark.createDataFrame([(1, 1), (1, 1)], "a int, b int")
    assert statistics.kappa(same, "a", "b").first()["kappa"] == 1.0
    assert statistics.kappa(same.where("a = 0"), "a", "b").first()["kappa"] is None


def test_alpha_undefined_without_pairs(spark):
    assert statistics.krippendorff_alpha(spark.createDataFrame([(1, "x"), (2, "y")], "u int, v string"), "u", "v").first()["alpha"] is None


def test_wilson_without_observations(spark):
    assert tuple(one(spark, statistics.wilson(F.lit(0.5), F.lit(0)))) == (0.0, 1.0)


def test_cell_changes_tell_null_from_text(spark):
    old, new = spark.createDataFrame([(1, None), (2, "001")], "k int, v string"), spark.createDataFrame([(1, None), (2, "1")], "k int, v string")
    assert [(r["k"], r["old"], r["new"]) for r in snapshots.cell_changes(old, new, ["k"], ["v"]).collect()] == [(2, "001", "1")]


@pytest.mark.parametrize("partitions", [1, 8])
def test_results_do_not_depend_on_partitions(spark, partitions):
    df = spark.createDataFrame([(i % 3, i) for i in range(30)], "k int, v int").repartition(partitions)
    assert sorted(r["v"] for r in rollups.keep_first(df, ["k"], [F.col("v")]).collect()) == [0, 1, 2]
    assert facets.less_viewed_half(df, "v", "k").count() == 15


def test_blocks_of_nested_and_open_templates():
    page = "= A =\n{{x|y=1}}\n== B ==\n{{box\n|One=a {{in|b\n|Two=c}} d\nmore\n|One=again\n}}\n}} stray\n{{never\n|K=v"
    got = markup.blocks(page)
    assert [(b["name"], b["section"], dict(b["fields"])) for b in got] == [("x", "A", {}), ("box", "B", {"One": "again", "Two": "c}} d more"}), ("never", "B", {"K": "v"})]
    assert markup.blocks("") == [] and markup.blocks("{ } text") == []
    page = "= A =\n{{wrap|x=\n= B =\n{{#fte:imslpfile\n|Copyright=CC {{x}}\n more\n{{#fte:inner\n|K=v}}\n}}\n}}\n{{#fte:imslpaudio\n|Copyright=PD"
    got = markup.blocks(page)
    assert [(b["name"], b["section"]) for b in got] == [("wrap", "A"), ("#fte:imslpfile", "B"), ("#fte:inner", "B"), ("#fte:imslpaudio", "B")]
    assert dict(got[1]["fields"])["Copyright"].startswith("CC {{x}} more") and dict(got[3]["fields"]) == {"Copyright": "PD"}


def test_places_of_every_partitioning(spark):
    df = spark.createDataFrame([(i % 7, i) for i in range(100)], "v int, k int").repartition(5)
    want = {k: n for n, (_, k) in enumerate(sorted((i % 7, i) for i in range(100)))}
    for parts in (1, 3, 16):
        placed, total = statistics.places(df, ["v", "k"], parts)
        assert total == 100 and {r["k"]: r["_place"] for r in placed.collect()} == want
    assert statistics.systematic(df.where("k < 0"), "v", "k", 5).count() == 0


def test_allocation_keeps_its_bounds():
    assert statistics.allocate({"a": 30, "b": 30, "c": 2, "d": 2}, 10, 4) == {"a": 4, "b": 4, "c": 2, "d": 2}
    assert statistics.allocate({"a": 9, "b": 9}, 5, 1) == {"a": 2, "b": 3}
    assert statistics.allocate({"a": 9, "b": 9}, 7, 1) == {"a": 3, "b": 4}


def test_carry_forward_refuses_a_base_that_repeats_a_key(spark):
    new = spark.createDataFrame([(1, "", "", "")], "k int, label string, src string, note string")
    base = spark.createDataFrame([(1, "organ", "llm", "x")], "k int, label string, src string, note string")
    assert overlay.carry_forward(new, base, ["k"], "label", "src", ["note"], ["other"]).first()["label"] == "organ"
    with pytest.raises(Exception, match="repeats the key"):
        overlay.carry_forward(new, base.unionByName(base), ["k"], "label", "src", ["note"], ["other"]).collect()


def test_of_a_field_given_twice_the_later_stands(spark):
    base = spark.createDataFrame([(1, "a")], "k int, v string")
    rows = [("1", "v", x, "r", "s", "w", d) for x, d in (("new", "2024-02-01"), ("old", "2024-01-01"))]
    given = spark.createDataFrame(rows, "key string, field string, value string, reason string, source string, reviewer string, date string")
    assert overlay.apply_overrides(base, given, "k", ["v"]).first()["v"] == "new"


def test_redirect_chains(spark):
    hops = spark.createDataFrame([(f"t{i}", f"t{i + 1}") for i in range(40)], "`from` string, `to` string")
    titles = spark.createDataFrame([("t0",), ("t39",), ("z",)], "title string")
    assert {r["title"]: r["target"] for r in tables.resolve_titles(titles, hops).collect()} == {"t0": "t40", "t39": "t40", "z": "z"}
    cycle = spark.createDataFrame([("a", "b"), ("b", "c"), ("c", "a")], "`from` string, `to` string")
    with pytest.raises(ValueError, match="cycle"):
        tables.resolve_titles(titles, cycle)


def test_ledger_lines_follow_the_files(spark, tmp_path):
    for name, styles in (("b", ["late"] * 3), ("a", ["early"] * 300)):
        (tmp_path / f"{name}.jsonl").write_text("\n".join(json.dumps({"composer_id": "Q", "model": "m", "styles": [x], "created_at": "2024-01-01T00:00:00Z"}) for x in styles))
    assert ledger.latest(tables.read_ledger(spark, str(tmp_path)), ["composer_id"], "at", "line").first()["styles"] == ["late"]


def test_unmapped_rights(spark):
    got = one(spark, status.unmapped_rights(F.array(*map(F.lit, ["WorkNonPD-EU", "New copyright rule", "Rostropovich", "RoST files", "hpd-x"]))))
    assert got == ["New copyright rule", "RoST files"]


def test_site_of_an_address(spark):
    assert one(spark, markup.site(F.lit("http://user@www.a.co.uk:80/x"))) == "a.co.uk"


def test_stream_merges_into_latest(spark, tmp_path):
    schema = "k string, at timestamp, v int"
    for i, rows in enumerate([[("a", "2024-01-01 00:00:00", 1)], [("a", "2024-01-02 00:00:00", 2), ("b", "2024-01-01 00:00:00", 3)]]):
        spark.createDataFrame(rows, "k string, at string, v int").selectExpr("k", "cast(at as timestamp) at", "v").coalesce(1).write.mode("append").parquet(f"{tmp_path}/in/{i}")
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    q = stream.writeStream.foreachBatch(intake.merge_latest(f"{tmp_path}/state", ["k"], "at", "v")).option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination(120)
    last = max(int(p.name.split("=")[1]) for p in (tmp_path / "state").glob("batch=*"))
    got = {r["k"]: r["v"] for r in spark.read.schema(schema).parquet(f"{tmp_path}/state/batch={last}").collect()}
    assert got == {"a": 2, "b": 3}


def test_deal_takes_turns_in_hash_order(spark):
    import hashlib

    rows = [(i, None if i % 11 == 0 else "abc"[min(i % 5, 2)]) for i in range(700)]
    got = {r["k"]: r["package"] for r in statistics.deal(spark.createDataFrame(rows, "k long, s string").repartition(5), "s", "k", 7, "seed").collect()}
    order = sorted(rows, key=lambda r: (r[1] is not None, r[1] or "", hashlib.md5(f"seed:{r[0]}".encode()).hexdigest(), r[0]))
    assert got == {k: i % 7 + 1 for i, (k, _) in enumerate(order)}


def test_common_names_meet_alike_records_once(spark):
    """A name of many records costs a person one row for each kind of them; repeated rows of one id are one record."""
    people = spark.createDataFrame([(1, "n", 1900, 1950), (2, "n", 1900, None), (3, "n", 1901, 1950), (4, None, 1900, 1950), (5, "m", 1900, 1950)], "k int, name string, birth int, death int")
    many = [(i, "n", 1901, 1950, True) for i in range(1000)]
    records = spark.createDataFrame([*many, (5000, "n", 1900, 1950, False), (5000, "n", 1900, 1950, True), (5001, "n", 1900, 1960, True), (5002, "m", 1900, None, None)], "id int, name string, born int, died int, composes boolean")
    found = resolve.unique_authority(people, records, "name", "k")
    assert sorted(map(tuple, found.collect())) == [(1, 5000)]
    assert found._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") > 1


def test_labels_are_told_once_and_no_empty_text_is_cast(spark):
    """The rules of a category stand once in the plan; numbers that a pattern did not find are not cast, for each failed cast costs an exception."""
    df = spark.createDataFrame([(["For piano", "For piano 4 hands", "For 99999999999 players", "For player", "Operas"], ["Works first published in 1901", "x"])], "t array<string>, c array<string>")
    told = df.select(F.transform("t", forces.family_of_forces).alias("f"), status.evidence(F.col("c"))["first_published"].alias("y"))
    plan = told._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("piano_ensemble") == 1 and "try_cast(regexp_extract" in plan
    assert plan.count("try_cast(regexp_extract") == plan.count("(char_length(regexp_extract")
    assert told.first().f == ["piano_solo", "piano_ensemble", "chamber", None, None] and told.first().y == "1901"
    numbers = spark.createDataFrame([("",), ("012",), ("99999999999",), (None,)], "d string")
    assert [r[0] for r in numbers.select(cells.whole_number(F.col("d"))).collect()] == [None, 12, None, None]
