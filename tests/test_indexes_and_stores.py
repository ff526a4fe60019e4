"""Bitmap index, parity of tables, samples, the coincidence cube, canonical JSON, search answers, stores and keyed state, against plain versions."""

import hashlib
import json
import random
from collections import Counter
from itertools import combinations

import pytest
from pyspark.sql import functions as F

from catalogloom.functions.canonical import canonical_json, input_hash
from catalogloom.operators import bitmaps, facets, gold, ledger, parity, resolve, snapshots, statistics
from catalogloom.sources import search_answers, tables
from catalogloom.streaming import ledger as intake

# Bitmaps.


def test_live_counts(spark):
    r = random.Random(2)
    rows = [(i, [r.choice("abcd") for _ in range(r.randint(0, 3))] or None, [r.choice("abz")], r.choice(["x", "y", "", None])) for i in range(3000)]
    df = spark.createDataFrame(rows, "k int, own array<string>, voted array<string>, seg string").repartition(7)
    numbered = bitmaps.number(df, "k")
    assert [x.place for x in numbered.orderBy("k").select("place").collect()] == list(range(1, 3001))
    index = tables.checkpointed(bitmaps.build(numbered, {"style": {"own": F.col("own"), "voted": F.col("voted")}, "seg": {"": F.array("seg")}}))

    def held(row, sources):
        return set((row[1] or []) if "own" in sources else []) | set(row[2] if "voted" in sources else [])

    for sources, choice in ((["own"], {}), (["own", "voted"], {}), ([], {}), (["own", "voted"], {"seg": (None, ["x"]), "style": (["own"], ["a", "c"])}), (["voted"], {"seg": (None, ["none"])}), (None, {"seg": (None, [])})):
        fit = [row for row in rows if (not choice.get("seg", (0, []))[1] or row[3] in choice["seg"][1]) and (not choice.get("style") or held(row, ["own"]) & {"a", "c"})]
        got = {x.value: x.n for x in bitmaps.live_counts(index, "style", sources, choice).collect()}
        want = Counter(v for row in fit for v in held(row, sources if sources is not None else ["own", "voted"]))
        assert got == {v: want[v] for v in "abcdz"}
    assert {x.source: x.n for x in bitmaps.coverage(index, "style").collect()} == {"own": sum(bool(x[1]) for x in rows), "voted": 3000, "": 3000}
    choice = {"seg": (None, ["x", "y"]), "style": (["voted"], ["z"])}
    assert sorted(x.k for x in bitmaps.fitting(numbered, index, choice).collect()) == [x[0] for x in rows if x[3] in ("x", "y") and x[2] == ["z"]]
    assert bitmaps.fitting(numbered, index, {}).count() == 3000
    plan = bitmaps.live_counts(index, "style", ["own"], choice)._jdf.queryExecution().optimizedPlan().toString()
    assert "voted" not in plan.split("Filter")[0] and "seg string" not in plan  # parents are not scanned


def test_buckets_past_the_first(spark):
    df = spark.range(0, 70_000).select("id", F.array((F.col("id") % 3).cast("string")).alias("v"))
    numbered = bitmaps.number(df, "id")
    index = tables.checkpointed(bitmaps.build(numbered, {"v": {"": F.col("v")}}))
    assert {x.value: x.n for x in bitmaps.live_counts(index, "v").collect()} == {"0": 23334, "1": 23333, "2": 23333}
    got = bitmaps.fitting(numbered, index, {"v": (None, ["1"])})
    assert got.count() == 23333 and got.where("id % 3 <> 1").count() == 0


def test_nothing_to_index(spark):
    none = spark.createDataFrame([], "k int, v array<string>")
    index = bitmaps.build(bitmaps.number(none, "k"), {"v": {"": F.col("v")}})
    assert index.count() == 0 and bitmaps.live_counts(index, "v").count() == 0


# Parity.


def test_parity(spark):
    r = random.Random(4)
    rows = [(f"k{i}", r.choice(["a", "", None]), str(i % 7)) for i in range(500)] + [("k1", "a", "1")] * 3
    left = spark.createDataFrame(rows, "k string, a string, b string")
    assert parity.differing_ranges(left, left.repartition(5), "k", ["a", "b"], 16).count() == 0
    assert parity.parity_errors(left, left.fillna(""), "k", ["a", "b"]).count() == 0
    changed = [x for x in rows if x[0] not in ("k7", "k9")] + [("k9", "new", "2"), ("k11", rows[11][1], rows[11][2]), ("other", None, None)]
    right = spark.createDataFrame(changed, "k string, a string, b string")
    assert 0 < parity.differing_ranges(left, right, "k", ["a", "b"], 4096).count() <= 4
    for ranges in (1, 4096):
        assert {tuple(x) for x in parity.row_differences(left, right, "k", ["a", "b"], ranges).collect()} == {("k7", "lost", 1), ("k9", "changed", 1), ("k11", "extra", 1), ("other", "extra", 1)}
    assert {x.error: x.n for x in parity.parity_errors(left, right, "k", ["a", "b"]).collect()} == {"lost": 1, "changed": 1, "extra": 2}


def test_export_is_read_back(spark, tmp_path):
    people = spark.createDataFrame([("Q1", "2025-01..2025-12"), ("Q2", "2025-01..2025-12"), ("Q3", "2024-06..2025-05")], "id string, window string")
    works = spark.createDataFrame([("Q1", 2, 'a "b"'), ("Q1", 1, "c"), ("Q3", 3, None)], "owner string, n int, title string")
    entries = tables.checkpointed(facets.manifest(people, works, {}, ["id"], {"first": F.col("id") == "Q1"}, F.col("window")))
    facets.write_export(facets.export(people, works, "id", "owner", ["n", "title"], "n"), people, entries, str(tmp_path), "id")
    flat = facets.read_export(spark, str(tmp_path), "id", "n int, title string")
    assert parity.parity_errors(works.withColumnRenamed("owner", "id"), flat, "id", ["n", "title"]).count() == 0 and flat.count() == 3
    assert facets.window_label(entries) == "2025" and facets.window_label(entries.where("section = 'count'")) == "" and facets.window_label(entries.where("value LIKE '2024%'")) == "2024-06..2025-05"
    assert {(x.section, x.name): x.n for x in entries.where("section <> 'window'").collect()} == {("count", "parents"): 3, ("count", "children"): 3, ("filled", "id"): 3, ("covered", "first"): 1}
    told = {x.name: x.n for x in entries.where("section = 'count'").collect()}
    assert snapshots.manifest_errors(told, "r1", "r1", {"parents": people, "children": works}).count() == 0
    assert [tuple(x) for x in snapshots.manifest_errors({}, "r1", "r1", {"works": works}).collect()] == [("count of works", 4)]


# Samples.


@pytest.mark.parametrize("digits", [1, 3])
def test_first_by_hash(spark, digits):
    rows = [(str(i), "abc"[min(i % 7, 2)]) for i in range(900)]
    want = {"a": 5, "b": 100, "c": 10_000}
    wanted = spark.createDataFrame(list(want.items()), "s string, _wanted long")
    got = statistics.first_by_hash(spark.createDataFrame(rows, "k string, s string").repartition(5), "s", "k", wanted, "seed", digits)
    order = lambda s: sorted((k for k, x in rows if x == s), key=lambda k: (hashlib.md5(f"seed:{k}".encode()).hexdigest(), k))
    assert {(x.k, x.s) for x in got.collect()} == {(k, s) for s, n in want.items() for k in order(s)[:n]}


def test_systematic_within(spark):
    rows = [(str(i), "xy"[i % 2], str(i * 7 % 5)) for i in range(300)]
    df = spark.createDataFrame(rows, "k string, s string, p string").repartition(4)
    picked = statistics.stratified_sample(df, "s", "k", 40, 5, "seed", spread="p").collect()
    for s in "xy":
        mine = sorted((x for x in rows if x[1] == s), key=lambda x: (x[2], hashlib.md5(f"seed:{x[0]}".encode()).hexdigest(), x[0]))
        n = next(x.stratum_sample for x in picked if x.s == s)
        step = len(mine) / n
        assert {x.k for x in picked if x.s == s} == {mine[int(0.5 * step + i * step)][0] for i in range(n)}
        per = Counter(x.p for x in picked if x.s == s)
        assert max(per.values()) - min(per.values()) <= 1  # values of the spread in proportion


# The cube.


def plain_alpha(units, apart):
    units = [u for u in units if len(u) > 1]
    values = [v for u in units for v in u]
    n = len(values)
    observed = sum(apart(a, b) * 2 / (len(u) - 1) for u in units for a, b in combinations(u, 2)) / n
    expected = sum(apart(a, b) * 2 for a, b in combinations(values, 2)) / (n * (n - 1))
    return 1 - observed / expected


def plain_masi(a, b):
    a, b = set(a.split("|")), set(b.split("|"))
    if a == b:
        return 0
    return 1 - len(a & b) / len(a | b) * (2 / 3 if a <= b or b <= a else 1 / 3) if a & b else 1


def test_cube_of_annotators(spark):
    r = random.Random(8)
    rows = [(i, who, r.choice(["p", "q", ""]), r.choice(["a", "a|b", "b|a", "c", ""]), r.choice("st")) for i in range(80) for who in "uvw" if r.random() < 0.8]
    stratum = {i: "s" if i % 3 else "t" for i in range(80)}
    df = spark.createDataFrame([(i, w, f, g, stratum[i]) for i, w, f, g, _ in rows], "i int, w string, form string, styles string, s string")
    cube = tables.checkpointed(gold.coincidences(gold.answers(df, "i", F.col("w"), ["form", "styles"], F.col("s")), ["styles"]))
    norm = lambda f, v: "|".join(sorted(set(v.split("|")))) if f == "styles" else v
    given = {f: {(i, w): norm(f, v) for i, w, a, b, _ in rows if (v := a if f == "form" else b)} for f in ("form", "styles")}
    found = {(x.stratum, x.field, x.a, x.b): x for x in gold.pair_agreement(cube, ["styles"]).collect()}
    for s in ("", "s", "t"):
        for f in given:
            mine = {k: v for k, v in given[f].items() if not s or stratum[k[0]] == s}
            for a, b in combinations("uvw", 2):
                pairs = [(mine[i, a], mine[i, b]) for i in range(80) if (i, a) in mine and (i, b) in mine]
                x = found[s, f, a, b]
                po = sum(p == q for p, q in pairs) / len(pairs)
                assert (x.pairs, x.agree) == (len(pairs), pytest.approx(po))
                if f == "form":
                    pe = sum(Counter(p for p, _ in pairs)[v] * Counter(q for _, q in pairs)[v] for v in "pq") / len(pairs) ** 2
                    assert x.kappa == pytest.approx((po - pe) / (1 - pe)) and x.jaccard is None
                else:
                    assert x.kappa is None
            units = [[v for (j, _), v in mine.items() if j == i] for i in range(80)]
            alpha = next(x for x in gold.field_alpha(cube, ["styles"]).collect() if (x.stratum, x.field) == (s, f)).alpha
            assert alpha == pytest.approx(plain_alpha(units, plain_masi if f == "styles" else lambda a, b: a != b))


def test_agreement_without_choice(spark):
    both = spark.createDataFrame([(1, "a"), (2, "a"), (3, "")], "i int, f string")
    got = gold.pass_agreement(both, both, "i", ["f"]).first()
    assert tuple(got) == ("f", 2, 1.0, 1.0, None)
    assert tuple(gold.pass_agreement(both, both.where("i > 3"), "i", ["f"]).first())[:2] == ("f", 0)


# Canonical JSON.


def test_canonical_json(spark):
    r = random.Random(6)
    letters = ['"', "\\", "\n", "\r", "\t", "\b", "\f", "\x00", "\x01", "\x1f", "\x7f", "é", "𝄞", " ", "/", "a", "\\u000b", ""]
    word = lambda: "".join(r.choice(letters) for _ in range(r.randint(0, 6)))
    numbers = [0.0, -0.0, 1.0, 0.1, -1.5, 1e6, 1e7, 12345678.5, 1e15, 1.5e15, 9999999999999998.0, 1e16, 1.25e16, 1e22, 1e-3, 1e-4, 1.5e-4, 1e-5, 2.5e-7, 1e100, -3.5e-10, 123456789012345.6]
    rows = [(i, word(), r.choice([None, True, False]), [word(), None], numbers[i % len(numbers)], {word(): r.randint(-9, 9) for _ in range(3)}, (word(), None)) for i in range(120)]
    df = spark.createDataFrame([(x,) for x in rows], "r struct<`z z`:int,b:string,a:boolean,list:array<string>,num:double,m:map<string,bigint>,in:struct<y:string,x:int>>")
    kind = df.schema["r"].dataType
    got = [x.r for x in df.select(canonical_json(F.col("r"), kind).alias("r")).collect()]
    names = ["z z", "b", "a", "list", "num", "m", "in"]
    plain = lambda row: dict(zip(names, [*row[:6], dict(zip(["y", "x"], row[6], strict=True))], strict=True))
    want = [json.dumps(plain(x), ensure_ascii=False, sort_keys=True, separators=(",", ":")) for x in rows]
    assert got == want
    hashes = [x.h for x in df.select(input_hash(F.col("r"), kind, 'p"1').alias("h")).collect()]
    assert hashes == [hashlib.sha256(json.dumps({"prompt_version": 'p"1', "record": plain(x)}, ensure_ascii=False, sort_keys=True, separators=(",", ":")).encode()).hexdigest() for x in rows]
    with pytest.raises(TypeError, match="date"):
        canonical_json(F.current_date(), spark.range(1).select(F.current_date().alias("d")).schema["d"].dataType)


# Answers of searches.


def test_batch_files(spark, tmp_path):
    (tmp_path / "batch_a.txt").write_text("# tokens_used=1,200\n# missing=Q2\nQ1\t1\thttps://a/1\tOne \nQ1\t2\thttp://a/2\nQ3\t1\thttps://x\tnot asked\nplain words\n\n# tokens_used=30\r\nQ2\t0\t\t\r\nQ1\t1\tftp://no\tbad\nQ1\t99999999999\thttps://a\tbig\n")
    (tmp_path / "batch_b.txt").write_text("Q1\t1\thttps://b/1\tbefore any head\nQ4\t1\thttps://b/4\told\n# tokens_used=\nQ4\t1\thttps://b/5\tnew")
    asked = spark.createDataFrame([("batch_a", "Q1"), ("batch_a", "Q2"), ("batch_b", "Q1"), ("batch_b", "Q4"), ("batch_b", "Q5"), ("batch_c", "Q1")], "batch string, key string")
    lines = search_answers.read_lines(spark, str(tmp_path))
    rows, faults = search_answers.answers(lines, asked)
    assert sorted(tuple(x)[:6] for x in rows.collect()) == [("batch_a", 1, "Q1", 1, "https://a/1", "One"), ("batch_a", 1, "Q1", 2, "http://a/2", ""), ("batch_a", 2, "Q2", 0, "", ""), ("batch_b", 0, "Q1", 1, "https://b/1", "before any head"), ("batch_b", 1, "Q4", 1, "https://b/5", "new")]
    assert sorted((x.batch, x.value.split("\t")[0], x.fault) for x in faults.collect()) == [("batch_a", "Q1", "bad address"), ("batch_a", "Q1", "bad rank"), ("batch_a", "Q3", "unknown key"), ("batch_a", "plain words", "no row")]
    assert sorted(map(tuple, search_answers.session_report(lines, asked).collect())) == [("batch_a", 2, 1230, 2, 0), ("batch_b", 1, 0, 2, 1), ("batch_c", 0, 0, 0, 1)]


def test_sessions_over_many_buckets(spark, monkeypatch):
    monkeypatch.setattr(search_answers, "BUCKET", 7)
    r = random.Random(3)
    rows = [(f"f{i % 3}", i // 60, i, r.random() < 0.2) for i in range(300)]
    lines = spark.createDataFrame(rows, "file string, block long, line long, head boolean").repartition(6)
    got = {(x.file, x.line): x.session for x in search_answers.sessions(lines, F.col("head")).collect()}
    for f in ("f0", "f1", "f2"):
        n = 0
        for row in (x for x in rows if x[0] == f):
            n += row[3]
            assert got[f, row[2]] == n


def test_search_events(spark):
    call = lambda term, chunks, kind="webSearchToolCall", ok="success": json.dumps({"type": "tool_call", "subtype": "completed", "tool_call": {kind: {"args": {"searchTerm": term}, "result": {ok: {"references": [{"chunk": c} for c in chunks]}}}}})
    links = "x\nLinks:\n1. [A  [b]](https://a/1)\n2. [](https://a/2)\nend\n3. [c](https://a/3)"
    values = ["no json", json.dumps({"type": "result", "usage": {"inputTokens": 5}}), call('"ann  BE" Score', [links, "Links:\n1. [d](http://d/4)"]), call("ann be score", ["Links:\n1. [late](https://late)"]), call("cy music", []), call("nobody", [links]), call("dee and cy", [links]), call("dee", [links], ok="error"), call("x", [links], kind="shellToolCall"), call("x", [], kind="getMcpToolsToolCall")]
    events = spark.createDataFrame([("b", i, v) for i, v in enumerate(values)], "batch string, place int, value string").repartition(3)
    queries = spark.createDataFrame([("b", "Q1", '"Ann Be" score', "Ann Be"), ("b", "Q2", '"Cy" score', "Cy"), ("b", "Q3", '"Dee" score', "Dee")], "batch string, key string, query string, name string")
    rows, faults = search_answers.search_events(events, queries, 3)
    assert sorted(map(tuple, rows.collect())) == [("b", "Q1", 1, "https://a/1", "A [b]"), ("b", "Q1", 2, "https://a/2", ""), ("b", "Q1", 3, "http://d/4", "d"), ("b", "Q2", 0, "", "")]
    assert sorted((x.place, x.fault, x.term) for x in faults.collect()) == [(5, "no key", "nobody"), (6, "no key", "dee and cy"), (8, "tool", "shellToolCall")]


def test_an_event_is_read_once(spark):
    events = spark.createDataFrame([("b", 1, "{}")], "batch string, place int, value string")
    assert search_answers.tool_calls(events)._jdf.queryExecution().optimizedPlan().toString().count("from_json") == 1


def test_terms_meet_no_name_that_they_do_not_hold(spark):
    """Names join parts of terms by equality, also where the batch is a constant; a key asked twice by a name counts twice, a name held twice once."""
    r = random.Random(5)
    word = lambda n: "".join(r.choice("abé ") for _ in range(n)).strip()
    asked = [(r.choice("xy"), f"Q{i}", word(r.randint(0, 5))) for i in range(40)] + [("x", "Q7", "abab"), ("x", "Q7", "abab")]
    terms = sorted({(r.choice("xyz"), word(r.randint(0, 12))) for _ in range(80)} | {("x", "c abab abab")})
    want = {}
    for batch, term in terms:
        keys = [key for b, key, name in asked if b == batch and name and name in term]
        if keys:
            want[batch, term] = (len(keys), min(keys))
    got = search_answers.names_held(spark.createDataFrame(terms, "batch string, term string"), spark.createDataFrame(asked, "batch string, key string, name string"))
    assert {(x.batch, x.term): (x.n, x.named) for x in got.collect()} == want

    events = spark.createDataFrame([(1, "{}")], "place int, value string").withColumn("batch", F.lit("b"))
    queries = spark.createDataFrame([("Q1", "a", "a")], "key string, query string, name string").withColumn("batch", F.lit("b"))
    plan = search_answers.search_events(events, queries)[0]._jdf.queryExecution().optimizedPlan().toString()
    assert "Contains(term" not in plan


# Lists in parts, and stores.


def test_lists_in_parts_are_dealt_once(spark):
    """Whole parts are dealt by page; their values are not dealt again, nor the lists."""
    parts = spark.createDataFrame([(1, 1, ["a", "b"]), (1, 2, ["b", "c"])], "k int, part int, v array<string>")
    plan = tables.merge_page_lists(parts, "k", "v")._jdf.queryExecution().executedPlan().toString()
    assert plan.count("Exchange hashpartitioning") == 1


def test_lists_in_parts(spark):
    rows = [(1, 2, "late", ["Category:c", "a"], None, True), (1, 1, "first", ["b", "Category:a", "b"], None, None), (1, 2, "late", ["c", "Category:c"], None, None), (2, 1, "gone", None, True, None), (3, 1, None, [], None, None)]
    parts = spark.createDataFrame(rows, "k int, part int, title string, v array<string>, missing boolean, redirect boolean").repartition(4)
    wanted = spark.createDataFrame([(1,), (2,), (3,), (4,), (4,)], "k int")
    got = {x.k: tuple(x)[1:] for x in tables.merge_page_lists(parts, "k", "v", "Category:", wanted).collect()}
    assert got == {1: ("first", ["b", "a", "c"], False, True), 2: ("gone", [], True, False), 3: ("", [], False, False), 4: ("", [], True, False)}
    assert tables.merge_page_lists(parts.select("k", "part", "v"), "k", "v").count() == 3


def test_collisions_of_addresses_are_misses(spark, tmp_path):
    same = lambda url: F.substring(F.sha2(F.lit("x"), 256), 1, F.char_length(url) * 0 + 8)
    stored = spark.sql("SELECT * FROM VALUES ('http://a', 'one', timestamp'2024-01-01'), ('http://a', 'two', timestamp'2024-01-02'), ('http://b', 'three', timestamp'2024-01-03') AS t(url, payload, stored_at)")
    for hashed in (same, tables.url_key):
        path = f"{tmp_path}/{hashed is same}"
        tables.write_by_url(stored, path, hashed)
        tables.write_by_url(spark.sql("SELECT 'http://b' AS url, 'four' AS payload, timestamp'2024-01-04' AS stored_at"), path, hashed)
        wanted = spark.createDataFrame([("http://a",), ("http://b",), ("http://c",), ("http://c",)], "url string")
        assert {tuple(x) for x in tables.read_by_url(wanted, path, hashed).collect()} == {("http://a", "two", True), ("http://b", "four", True), ("http://c", None, False)}


def test_names_of_documents_are_their_own(spark):
    keys = ["Dvořák", "Dvo áák", "Dvo_áák", "a/b", "a b", "x" * 181, "x" * 182, "x" * 180, "日本.1-2_3"]
    got = [x[0] for x in spark.createDataFrame([(k,) for k in keys], "k string").select(tables.store_key(F.col("k"))).collect()]
    assert len(set(got)) == len(keys) and got[0] == "Dvořák" and got[2] == "Dvo_áák" and got[8] == keys[8]
    assert all(all(c.isalnum() or c in "-_.~" for c in x) and len(x) <= 197 for x in got)


def test_long_chains_of_titles(spark):
    n = 5000
    hops = spark.createDataFrame([(f"t{i}", f"t{i + 1}") for i in range(n)], "from string, to string")
    titles = spark.createDataFrame([("t0",), ("t4000",), ("z",)], "title string")
    assert {x.title: x.target for x in tables.resolve_titles(titles, hops).collect()} == {"t0": f"t{n}", "t4000": f"t{n}", "z": "z"}


def test_nearest_row_of_a_list_counts(spark):
    people = spark.createDataFrame([(1, "https://en.wikipedia.org/wiki/A_b", 1800, 1850, "")], "k int, url string, birth int, death int, flags string")
    listed = [("https://en.wikipedia.org/wiki/A_b", 1700, 1750), ("https://en.wikipedia.org/wiki/A_b", 1801, None)]
    for rows in (listed, listed[::-1], listed[:1]):
        got = resolve.suspects(people, spark.createDataFrame(rows, "url string, list_birth int, list_death int"), "k", "url", 30).collect()
        assert [(x.gap, x.signals) for x in got] == ([] if len(rows) == 2 else [(100, "list_years_gap_100")])


# Keyed state.

DECISIONS = "k string, at timestamp, file string, line long, v int"


def _files(spark, folder, batches):
    for i, rows in enumerate(batches):
        spark.createDataFrame(rows, DECISIONS.replace("timestamp", "string")).selectExpr("k", "cast(at as timestamp) at", "file", "line", "v").coalesce(1).write.parquet(f"{folder}/{i}")


def _run(spark, tmp_path, name, make):
    stream = spark.readStream.schema(DECISIONS).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    emitted = []
    q = make(stream).writeStream.outputMode("update").foreachBatch(lambda df, n: emitted.append(sorted(map(tuple, df.collect())))).option("checkpointLocation", f"{tmp_path}/{name}").trigger(availableNow=True).start()
    q.awaitTermination(180)
    assert q.exception() is None
    return emitted


def test_keyed_state(spark, tmp_path):
    day = "2024-01-0{} 00:00:00".format
    first = [("a", day(2), "f1", 5, 1), ("a", day(2), "f1", 7, 2), ("a", day(2), "f1", 6, 3), ("b", day(1), "f1", 1, 4)]
    _files(spark, f"{tmp_path}/in", [first, [("a", day(1), "f9", 9, 5), ("b", day(1), "f2", 0, 6)], first])
    emitted = _run(spark, tmp_path, "state", lambda s: intake.latest_by_key(s, ["k"], ["at", "file", "line"]))
    last = {}
    for rows in emitted:
        last |= {x[0]: x for x in rows}
    whole = spark.read.schema(DECISIONS).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in").withColumn("place", F.struct("file", "line"))
    want = {x.k: (x.k, x["at"], x.file, x.line, x.v) for x in ledger.latest(whole, ["k"], "at", "place").collect()}
    assert last == want and last["a"][4] == 2 and last["b"][4] == 6
    assert sum(map(len, emitted)) == 3  # the batch that is played again changes nothing


def test_keyed_state_expires(spark, tmp_path):
    rows = [[("a", "2024-01-01 00:00:00", "f", 1, 1)], [("b", "2024-03-01 00:00:00", "f", 2, 2)], [("b", "2024-03-02 00:00:00", "f", 3, 3)], [("a", "2024-03-02 00:00:00", "f", 0, 4)]]
    _files(spark, f"{tmp_path}/in", rows)
    emitted = _run(spark, tmp_path, "state", lambda s: intake.latest_by_key(s, ["k"], ["at", "file", "line"], "1 day", 3_600_000))
    assert [x[4] for batch in emitted for x in batch] == [1, 2, 3, 4]


def test_merged_files_keep_the_later_line(spark, tmp_path):
    day = "2024-01-01 00:00:00"
    _files(spark, f"{tmp_path}/in", [[("a", day, "f", 2, 2), ("a", day, "f", 3, 3)], [("a", day, "f", 1, 1)], [("b", day, "f", 4, 4)]])
    stream = spark.readStream.schema(DECISIONS).option("maxFilesPerTrigger", 1).option("recursiveFileLookup", True).parquet(f"{tmp_path}/in")
    q = stream.writeStream.foreachBatch(intake.merge_latest(f"{tmp_path}/state", ["k"], "at", "line")).option("checkpointLocation", f"{tmp_path}/cp").trigger(availableNow=True).start()
    q.awaitTermination(180)
    left = sorted(p.name for p in (tmp_path / "state").glob("batch=*"))
    assert len(left) == 2 and {(x.k, x.v) for x in spark.read.schema(DECISIONS).parquet(f"{tmp_path}/state/{left[-1]}").collect()} == {("a", 3), ("b", 4)}
