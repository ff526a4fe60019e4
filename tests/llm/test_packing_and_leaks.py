"""Packing round trips, leaks against brute force, and the pipeline."""

import re
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from catalogloom.llm import decontamination, packing, queries, simhash

SF = "/root/testdata/sf0.001"
ODD = [(1, None), (2, ""), (3, "   \n\t "), (4, "a"), (5, "x  y   z \n "), (6, "<|endoftext|> and <|endoftext|>"), (7, "tab\there\n\n  two"), (8, "Ünï ©ode ñandú 12345 don't"), (9, " lead"), (10, "trail ")]


@pytest.mark.parametrize("limits", [(64, 64, None), (64, 3, 40)])
def test_round_trip(frame, prose, limits):
    rows = [*ODD, *((20 + i, prose(i, 7 * i)) for i in range(25)), (100, prose(100, 2000))]
    pieces = packing.pack(frame(rows), queries.BPE_JSON, queries.BPE_RANKS, max_tokens=limits[0], max_segments=limits[1], max_loss=limits[2], max_open=4).collect()
    t = Tokenizer.from_file(queries.BPE_JSON)
    by_doc, by_sequence = defaultdict(list), defaultdict(list)
    for p in pieces:
        by_doc[p["doc_id"]].append(p)
        by_sequence[p["sequence_id"]].append(p)
        assert len(p["ids"]) == 4 * p["length"] > 0
    for d, text in rows:
        want = [*t.encode(text or "", add_special_tokens=False).ids, 0]
        own = sorted(by_doc[d], key=lambda p: p["start"])
        assert np.frombuffer(b"".join(bytes(p["ids"]) for p in own), "<u4").tolist() == want
        assert [p["start"] for p in own] == np.cumsum([0] + [p["length"] for p in own[:-1]]).tolist()
        assert {p["doc_tokens"] for p in own} == {len(want)}
    padding = 0
    for own in by_sequence.values():
        own.sort(key=lambda p: p["offset"])
        n = sum(p["length"] for p in own)
        assert [p["offset"] for p in own] == np.cumsum([0] + [p["length"] for p in own[:-1]]).tolist()
        assert n <= limits[0] and len(own) <= limits[1] and sum(p["loss_tokens"] for p in own) <= (limits[2] or limits[0])
        padding += 0 if n & (n - 1) == 0 else limits[0] - n
    if limits[2] is None:
        assert padding == 0


def test_prompts_bear_no_loss(frame):
    pieces = packing.pack(frame([(1, "one two three four five")]).withColumn("p", F.lit(3)), queries.BPE_JSON, queries.BPE_RANKS, max_tokens=4, max_loss=2, prompt_col="p").collect()
    tokens = pieces[0]["doc_tokens"]
    assert sum(p["loss_tokens"] for p in pieces) == tokens - 3 and all(p["loss_tokens"] <= 2 for p in pieces)


def test_crc(frame):
    p = packing.pack(frame([(1, "hello")]), queries.BPE_JSON, queries.BPE_RANKS).withColumn("c", F.crc32("ids")).first()
    assert p["c"] == zlib.crc32(bytes(p["ids"]))


def edits_in(window, text):
    row = np.zeros(len(text) + 1, int)
    for c in window:
        new = [row[0] + 1]
        for j in range(len(text)):
            new.append(min(row[j] + (text[j] != c), row[j + 1] + 1, new[j] + 1))
        row = np.array(new)
    return int(row.min())


def test_leaks(frame, spark, prose):
    items = [(i, prose(900 + i, 40)) for i in range(4)] + [(9, None), (10, "Too short!"), (11, "four"), (12, "?"), (None, prose(950, 40))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    edited = items[1][1].replace("er", "ar", 2)
    rows = [(1, None), (2, ""), (3, prose(1, 300)), (4, f"{prose(2, 80)} {items[0][1]} {prose(3, 80)}"), (4, items[0][1]), (5, f"{prose(4, 30)}\n{items[1][1].upper()}!"), (6, f"{prose(5, 50)} {edited} {prose(6, 20)}"), (7, items[2][1][:130]), (8, items[2][1][:45]), (9, f"{items[3][1]} {items[0][1]}"), (12, "none is too, SHORT"), (13, "too shorter fourteen"), (14, "x four"), (10, prose(7, 60_000) + items[3][1])]
    found, hits = decontamination.find_hits(frame(rows), benchmark, block_bytes=300)
    got = defaultdict(set)
    for r in found.collect():
        got[r["doc_id"]] |= {h["item_id"] for h in r[hits]}
    assert hits == "hits_" and found.count() == len(rows)
    assert {d: sorted(x) for d, x in got.items()} == {1: [], 2: [], 3: [], 4: [0], 5: [1], 6: [1], 7: [2], 8: [], 9: [0, 3], 10: [3], 12: [10], 13: [], 14: [11]}
    one, _ = decontamination.find_hits(frame(rows), benchmark)
    assert {(r["doc_id"], h["item_id"], h["edits"]) for r in one.collect() for h in r["hits_"]} == {(r["doc_id"], h["item_id"], h["edits"]) for r in found.collect() for h in r[hits]}
    assert decontamination.find_hits(frame(rows), benchmark.where("item_id > 50"))[0].where(F.size("hits_") > 0).count() == 0


def test_short_items_with_edits(frame, spark, prose):
    items = {1: "the quick brown fox jumps over lazy dogs", 2: "a question of forty chars", 3: "only exact here"}
    benchmark = spark.createDataFrame(list(items.items()), "item_id long, text string")
    around = lambda x, i: f"{prose(i, 40)} {x} {prose(i + 1, 40)}"
    rows = [(1, around(items[1].replace("brown", "brawn"), 1)), (2, around(items[1].replace("quick brown", "quik brwn").replace("dogs", "dog"), 3)), (3, around(items[2].replace("forty", "fort"), 5)), (4, around("onli exact here", 7)), (5, around(items[3], 9)), (6, around("the slow brown fox sleeps under lazy cats", 11))]
    found, hits = decontamination.find_hits(frame(rows), benchmark)
    assert {r["doc_id"]: [(h["item_id"], h["edits"]) for h in r[hits]] for r in found.collect()} == {1: [(1, 1)], 2: [(1, 3)], 3: [(2, 1)], 4: [], 5: [(3, 0)], 6: []}


def test_edited_passages_are_found(frame, spark, prose):
    """200 items of 100 characters or more, each in a document with 0, 4 or 8 edits in a window's worth of text: all are found, by their documents alone."""
    import random

    r = random.Random(2)
    items = [(i, prose(3000 + i, 60)[:106].strip()) for i in range(200)]
    rows = []
    for i, text in items:
        x = list(text)
        for at in r.sample(range(2, len(x) - 2), (0, 4, 8)[i % 3]):
            x[at] = r.choice("bcfgjkmpqvwxyz")
        rows.append((i, f"{prose(i, 30)} {''.join(x)} {prose(i + 500, 30)}"))
    found, hits = decontamination.find_hits(frame(rows), spark.createDataFrame(items, "item_id long, text string"))
    assert all(r["doc_id"] in {h["item_id"] for h in r[hits]} for r in found.collect())


def test_banded_alignment():
    r = np.random.default_rng(1)
    for _ in range(40):
        w, text = r.integers(0, 4, 12), r.integers(0, 4, 25)
        want = edits_in(w, text)
        assert all(min(decontamination.align(w.astype(np.uint32), text.astype(np.uint32), k)[0], k + 1) == min(want, k + 1) for k in (0, 1, 3, 12))


def test_pack_of_null_ids_repeats_and_nothing(frame):
    rows = [(None, "a b c"), (None, None), (1, "same"), (1, "same"), *((i, "") for i in range(10, 60))]
    pieces = packing.pack(frame(rows), queries.BPE_JSON, queries.BPE_RANKS, max_tokens=16, max_segments=4).collect()
    assert sum(p["start"] == 0 for p in pieces) == len(rows) and sum(p["length"] for p in pieces) == sum(p["doc_tokens"] for p in pieces if p["start"] == 0)
    assert packing.pack(frame(rows).where("doc_id < 0"), queries.BPE_JSON, queries.BPE_RANKS).count() == 0


def padding(pieces, size):
    """Share of places without a token: sequences are as long as ``size``, or a power of two."""
    length = defaultdict(int)
    for p in pieces:
        length[p["sequence_id"]] += p["length"]
    places = [n if n == size or n & (n - 1) == 0 else size for n in length.values()]
    return 1 - sum(length.values()) / sum(places)


@pytest.mark.parametrize("segments", [queries.SEGMENTS, 4, 1])
@pytest.mark.parametrize("words", [[12], [0], [3000], [0, 1, 12, 400, 2500]])
def test_little_padding_whatever_the_lengths(frame, prose, words, segments):
    rows = [(i, prose(i % 50, words[i % len(words)])) for i in range(400)]
    pieces = packing.pack(frame(rows, 2), queries.BPE_JSON, queries.BPE_RANKS, max_segments=segments).collect()
    assert padding(pieces, 1024) < 0.01
    held = defaultdict(list)
    for p in pieces:
        held[p["sequence_id"]].append(p)
    assert max(map(len, held.values())) <= segments and all(sorted(p["offset"] for p in x)[0] == 0 for x in held.values())
    if words == [12] and segments < 100:
        assert max(map(len, held.values())) == segments  # the limit binds


def test_each_limit_binds(frame, prose):
    rows = frame([(i, prose(i, 30)) for i in range(300)], 2).withColumn("prompt", F.lit(5))
    most = {}
    for name, segments, loss in (("tokens", 256, None), ("segments", 2, None), ("loss", 256, 100)):
        pieces = packing.pack(rows, queries.BPE_JSON, queries.BPE_RANKS, max_tokens=256, max_segments=segments, max_loss=loss, prompt_col="prompt").collect()
        held = defaultdict(list)
        for p in pieces:
            held[p["sequence_id"]].append(p)
        most[name] = [max(f(x) for x in held.values()) for f in (lambda x: sum(p["length"] for p in x), len, lambda x: sum(p["loss_tokens"] for p in x))]
        assert padding(pieces, 256) == 0 and sum(p["length"] for p in pieces) == sum(p["doc_tokens"] for p in pieces if p["start"] == 0)
    assert most["tokens"][0] == 256 and most["tokens"][1] > 2 and most["tokens"][2] > 100
    assert most["segments"][1] == 2 and most["loss"][2] <= 100 and most["loss"][0] > 100 - 5 - 40


def test_ids_equal_the_tokenizer_on_a_whole_table(spark):
    t = Tokenizer.from_file(queries.BPE_JSON)
    coder = packing.ByteBpe(queries.BPE_JSON, queries.BPE_RANKS)
    for r in spark.read.parquet(f"{SF}/documents.parquet").select("text").collect():
        assert np.frombuffer(coder.ids(r["text"] or ""), "<u4").tolist() == t.encode(r["text"] or "", add_special_tokens=False).ids


def test_leaks_across_the_border_of_a_stretch_and_in_many_blocks(frame, spark, prose, monkeypatch):
    items = [(i, prose(700 + i, 40)) for i in range(20)]
    benchmark = spark.createDataFrame([*items, *items[:3]], "item_id long, text string")
    rows = [(i, f"{prose(i, 30)} {text} {prose(50 + i, 10)}") for i, text in items]
    text = prose(5, 40_000)
    places = [decontamination.STRETCH - 300 + 37 * i for i in range(16)]
    long = [(100 + i, f"{text[:at]} {items[i][1]} {text[at:]}") for i, at in enumerate(places)]
    found, hits = decontamination.find_hits(frame(rows), benchmark, block_bytes=600)
    assert {r["doc_id"]: {h["item_id"] for h in r[hits]} for r in found.collect()} == {i: {i} for i, _ in items}
    assert decontamination.find_hits(frame(rows).where("doc_id < 0"), benchmark, block_bytes=600)[0].count() == 0
    index = decontamination.Index.build(items, 100, 25, 0.08, 50)
    for (_, body), (i, _) in zip(long, items, strict=False):
        x = decontamination.normal(body)
        assert any(index.items[k] == i for lo in range(0, len(x), decontamination.STRETCH) for k, *_ in index.hits(x[lo : lo + decontamination.STRETCH + 200]))


def plain_lines(docs):
    lines = sorted((r["doc_id"], i, " ".join(x.lower().split())) for r in docs for i, x in enumerate((r["text"] or "").split("\n")))
    lines = [x for x in lines if x[2]]
    gone, seen, by_length = set(), set(), defaultdict(list)
    for d, i, x in lines:
        near = len(x) >= 16 and any(one_edit(x, y) for n in (-1, 0, 1) for y in by_length[len(x) + n] if len(y) >= 16)
        if x in seen or near:
            gone.add((d, i))
        if x not in seen:
            seen.add(x)
            by_length[len(x)].append(x)
    return gone


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    k = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def test_pipeline_stages_against_plain_ones(spark):
    """Lines, near-duplicates and leaks of a whole table, each stage on its own input; then whole runs."""
    pipeline = pytest.importorskip("corpus_pipeline")
    stages = dict(pipeline.STAGES)
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = docs.collect()

    gone = plain_lines(rows)
    want = {}
    for r in rows:
        kept = [x for i, x in enumerate((r["text"] or "").split("\n")) if (r["doc_id"], i) not in gone]
        lost = any((r["doc_id"], i) in gone for i in range(len((r["text"] or "").split("\n"))))
        if not lost:
            want[r["doc_id"]] = r["text"]
        elif "".join(kept).strip():
            want[r["doc_id"]] = "\n".join(kept)
    assert {r["doc_id"]: r["text"] for r in stages["line_dedup"](spark, docs, SF).collect()} == want

    prints = {r["doc_id"]: simhash.fingerprint(r["text"] or "") for r in rows}
    least = {d: d for d in prints}
    for _ in range(len(least)):
        new = {d: min(least[e] for e in prints if (prints[d] ^ prints[e]).bit_count() <= 4) for d in prints}
        if new == least:
            break
        least = new
    assert {r["doc_id"] for r in stages["simhash_dedup"](spark, docs, SF).collect()} == {d for d, c in least.items() if c == d}

    items = [" ".join(re.findall(r"\w+", r["text"].lower())) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    texts = {r["doc_id"]: " ".join(re.findall(r"\w+", (r["text"] or "").lower())) for r in rows}
    kept = {r["doc_id"] for r in stages["decontamination"](spark, docs, SF).collect()}
    assert not any(x in texts[d] for d in kept for x in items)
    for d in set(texts) - kept:  # what goes holds a window of an item within its edits
        assert any(edits_in(x[s : s + 100], texts[d]) <= 8 for x in items for s in {*range(0, max(1, len(x) - 99), 25), max(0, len(x) - 100)} if any(x[s + 11 * j : s + 11 * j + 11] in texts[d] for j in range(9)))


def test_pipeline_of_odd_tables(frame, spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    rows = [(1, None), (2, ""), (None, "no id here at all"), (None, "no id here at all"), (3, "same line of words\nsame line of words"), (3, "same line of words\nsame line of words"), (4, "x " * 50_000)]
    for docs in (frame(rows), frame(rows).where("doc_id < 0")):
        for name, stage in pipeline.STAGES[1:-1]:
            after = stage(spark, docs, SF)
            assert after.columns == docs.columns, name
            assert after.count() <= docs.count()
    kept = sorted((str(r["doc_id"]), r["text"]) for r in dict(pipeline.STAGES)["simhash_dedup"](spark, frame(rows), SF).collect())
    assert [d for d, _ in kept] == ["1", "3", "4", "None"]


def test_pipeline(spark):
    pipeline = pytest.importorskip("corpus_pipeline")
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    counts = [docs.count()]
    for name, stage in pipeline.STAGES[:-1]:
        after = stage(spark, docs, SF)
        assert after.columns == docs.columns, name
        after = spark.createDataFrame(after.collect(), docs.schema)
        assert after.join(docs, "doc_id", "left_anti").count() == 0
        assert after.where("n_chars <> char_length(text)").count() == 0
        docs = after
        counts.append(docs.count())
    assert counts == sorted(counts, reverse=True) and counts[-1] > 0.5 * counts[0]
    pieces = pipeline.STAGES[-1][1](spark, docs, SF)
    assert pieces.groupBy("doc_id").agg(F.sum("length").alias("n"), F.max("doc_tokens").alias("m")).where("n <> m").count() == 0
