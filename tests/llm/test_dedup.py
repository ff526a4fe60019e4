"""Dedup operators against brute force, with hot groups, ties, nulls and empties."""

import hashlib
import random
from collections import defaultdict

import numpy as np
import pytest

from catalogloom.llm import embeddings, exact_substrings, line_dedup, simhash

ODD = [(1, None), (2, ""), (3, "   \n\t "), (4, "a"), (4, "a"), (None, "no id"), (None, None)]


def variant(text, seed, edits):
    r, words = random.Random(seed), text.split()
    for _ in range(edits):
        words[r.randrange(len(words))] = f"w{r.randrange(1000)}"
    return " ".join(words)


# Substrings


def brute_removed(texts, length):
    places = defaultdict(list)
    for d, b in enumerate(texts):
        for i in range(len(b) - length + 1):
            places[b[i : i + length]].append((d, i))
    hit = [bytearray(len(b)) for b in texts]
    for found in places.values():
        if len(found) > 1:
            for d, i in found:
                hit[d][i : i + length] = b"\x01" * length
    return hit


@pytest.mark.parametrize("length", [16, 50])
def test_substrings(frame, prose, length):
    shared = prose(0, 30)
    rows = [*ODD, (10, shared), (11, f"{prose(1, 40)} {shared} {prose(2, 9)}"), (12, f"{shared}x"), (13, shared), (14, "ab" * 300), (15, "é" * 120 + prose(3, 60)), (16, prose(4, 200))]
    rows += [(20 + i, variant(f"{prose(5, 50)}", i, i % 4)) for i in range(12)]
    df = frame(rows)
    got = exact_substrings.remove_repeats(df, length).collect()
    assert len(got) == len(rows)
    texts = [(t or "").encode() for _, t in rows]
    want = sorted((str(d), hashlib.sha256(bytes(x for x, h in zip(b, hit, strict=True) if not h)).hexdigest(), sum(hit)) for (d, _), b, hit in zip(rows, texts, brute_removed(texts, length), strict=True))
    have = sorted((str(r["doc_id"]), hashlib.sha256(r["kept"]).hexdigest(), sum(s["end"] - s["start"] for s in r["spans"])) for r in got)
    assert have == want


def test_substrings_of_rows_without_ids_and_with_the_same(frame):
    a, b = "t9c87c7ceb2a2510fd0a4f25f86d16994", "tdda27bce673baaf7c1f2d227d6c04f42"
    got = exact_substrings.remove_repeats(frame([(1, a), (None, a), (None, b), (5, "x" * 15), (5, "0123456789abcdef")]), 16).collect()
    assert sorted((str(r["doc_id"]), r["n_bytes"], len(r["kept"])) for r in got) == [("1", 33, 0), ("5", 15, 15), ("5", 16, 16), ("None", 33, 0), ("None", 33, 33)]
    assert exact_substrings.remove_repeats(frame([(1, a)]).where("doc_id > 1"), 16).count() == 0


@pytest.mark.parametrize("length", [16, 50])
def test_prefix_doubling_gives_the_same_starts(frame, prose, length):
    shared = prose(0, 20)
    texts = [shared, f"{prose(1, 15)} {shared} {prose(2, 9)}", "ab" * 40, None, "", variant(shared, 1, 1)]
    docs = exact_substrings._rows(frame([(i, t) for i, t in enumerate(texts)]), "doc_id", "text")
    ids = {r["row"]: r["doc_id"] for r in docs.collect()}
    got = {(ids[r["row"]], r["start"]) for r in exact_substrings.doubled_starts(docs, length).collect()}
    places = defaultdict(list)
    for d, t in enumerate(texts):
        for i in range(len(t or "") - length + 1):
            places[t[i : i + length]].append((d, i))
    assert got == {p for found in places.values() if len(found) > 1 for p in found}


def test_substrings_of_200_bytes_of_a_whole_table(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = [(r["doc_id"], (r["text"] or "").encode()) for r in docs.select("doc_id", "text").collect()]
    want = sorted((d, sum(hit), hashlib.sha256(bytes(x for x, h in zip(b, hit, strict=True) if not h)).hexdigest()) for (d, b), hit in zip(texts, brute_removed([b for _, b in texts], 200), strict=True))
    got = exact_substrings.remove_repeats(docs).collect()
    assert sorted((r["doc_id"], r["n_bytes"] - len(r["kept"]), hashlib.sha256(r["kept"]).hexdigest()) for r in got) == want


def test_substrings_of_long_texts(frame, prose, monkeypatch):
    monkeypatch.setattr(exact_substrings, "STRETCH", 4096)
    texts = [prose(1, 3000).encode(), (prose(2, 1500) + prose(1, 500)).encode()]
    spans = defaultdict(list)
    for text, first, last, _, ahead, _ in exact_substrings._anchors(texts, 100, 40):
        spans_ok = (last - first < 61).all() and (ahead >= 0).all()
        assert spans_ok
        for d, a, z in zip(text, first, last, strict=True):
            spans[int(d)].append((int(a), int(z)))
    for d, found in spans.items():  # each window start once
        starts = [i for a, z in found for i in range(a, z + 1)]
        assert sorted(starts) == list(range(len(texts[d]) - 99))


# SimHash


def brute_components(ids, prints):
    comp = list(range(len(ids)))

    def find(k):
        while comp[k] != k:
            k = comp[k]
        return k

    for i in range(len(ids)):
        for j in range(i):
            if bin(prints[i] ^ prints[j]).count("1") <= 4:
                a, b = find(i), find(j)
                comp[max(a, b)] = min(a, b)
    low = defaultdict(list)
    for k, d in enumerate(ids):
        low[find(k)].append(d)
    return [min((d for d in low[find(k)] if d is not None), default=None) for k in range(len(ids))]


def test_simhash(frame, prose):
    rows = [*ODD, *((10 + i, variant(prose(7, 150), i, i % 5)) for i in range(25)), *((50 + i, prose(50 + i, 60)) for i in range(10)), *((70 + i, prose(7, 150)) for i in range(6))]
    got = simhash.near_duplicates(frame(rows)).collect()
    prints = [simhash.fingerprint(t or "") for _, t in rows]
    want = sorted((str(d), f"{p:016x}", str(c)) for (d, _), p, c in zip(rows, prints, brute_components([d for d, _ in rows], prints), strict=True))
    assert sorted((str(r["doc_id"]), r["fingerprint"], str(r["component_id"])) for r in got) == want


def test_spanning_links_of_dense_and_sparse_prints():
    r = np.random.default_rng(3)
    base = r.integers(0, 1 << 63, 6, dtype=np.uint64)
    close = [b ^ np.uint64(sum(1 << int(k) for k in r.choice(64, n, replace=False))) for b in base for n in (0, 1, 2, 2, 3, 4, 6) for _ in range(6)]
    x = np.unique(np.array(close, np.uint64))
    x = x[np.argsort(simhash.gray_rank(x))]
    root = simhash.spanning_links(x, slice_=3)
    want = brute_components(list(range(len(x))), [int(v) for v in x])
    assert root.tolist() == want


def test_large_nodes_are_split(spark):
    r = np.random.default_rng(4)
    base = 0x0123456789ABCDEF
    x = sorted({base ^ sum(1 << int(k) for k in r.choice(64, int(r.integers(0, 9)), replace=False)) for _ in range(200)})
    df = spark.createDataFrame([(simhash.signed(v),) for v in x], "fp long")
    got = {row["fp"]: row["component"] for row in simhash.link_components(df, cap=60).collect()}
    want = brute_components(list(range(len(x))), x)
    groups, mine = defaultdict(set), defaultdict(set)
    for k, v in enumerate(x):
        groups[want[k]].add(simhash.signed(v))
        mine[got.get(simhash.signed(v), simhash.signed(v))].add(simhash.signed(v))
    assert sorted(map(sorted, groups.values())) == sorted(map(sorted, mine.values()))


def test_one_row_of_each_group_stays(frame, prose):
    a, b, c = prose(7, 120), prose(8, 120), prose(9, 120)
    rows = [(1, a), (None, a), (None, b), (None, variant(b, 1, 1)), (7, c), (7, a), (7, c), (8, c), (9, prose(10, 50)), (None, "alone")]
    kept = simhash.one_of_each(frame(rows)).collect()
    mine = sorted((str(r["doc_id"]), r["text"]) for r in kept)
    assert len(kept) == 5 and {("1", a), ("7", c), ("9", prose(10, 50)), ("None", "alone")} < set(mine)
    assert sum(d == "None" and t in (b, variant(b, 1, 1)) for d, t in mine) == 1
    assert simhash.one_of_each(frame(rows).where("doc_id > 90")).count() == 0


# Lines


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1:
        return False
    k = next((i for i, (x, y) in enumerate(zip(a, b, strict=False)) if x != y), len(a))
    return a[k + 1 :] == b[k + 1 :] if len(a) == len(b) else a[k:] == b[k + 1 :]


def brute_lines(rows, least):
    lines = [((-1 if d is None else d, i), k, line_dedup.normal(x)) for k, (d, t) in enumerate(rows) for i, x in enumerate((t or "").split("\n")) if line_dedup.normal(x)]
    gone = defaultdict(set)
    for place, k, x in lines:
        if any(p < place and (x == y or (min(len(x), len(y)) >= least and one_edit(x, y))) for p, _, y in lines):
            gone[k].add(place[1])
    return ["\n".join(x for i, x in enumerate((t or "").split("\n")) if i not in gone[k]) for k, (_, t) in enumerate(rows)]


def test_lines(frame, prose):
    line = prose(1, 12)
    rows = [(1, None), (2, ""), (3, "   \n\t "), (4, "a\n\nb"), (5, "a\nc"), (6, f"{line}\n{prose(2, 8)}"), (7, f"x\n{line}"), (8, line.replace("e", "E")), (9, line[:20] + "q" + line[21:]), (10, line[:5] + line[6:]), (11, "z" + line), (12, line + "yy"), (13, "short line 1\nshort line 2"), (14, "w" * 5000 + "\n" + "w" * 4999)]
    rows += [(20 + i, f"{prose(99, 9)}\n{prose(30 + i, 9)}") for i in range(15)]
    found, gone = line_dedup.line_dedup(frame(rows))
    got = {r["doc_id"]: r["text"] for r in found.collect()}
    want = dict(zip([d for d, _ in rows], brute_lines(rows, 16), strict=True))
    assert {d: t or "" for d, t in got.items()} == want
    assert got[1] is None and found.columns == [*frame(rows).columns, gone]


@pytest.mark.parametrize("order", [(0, 1, 2), (1, 0, 2), (0, 2, 1), (2, 0, 1)])
def test_lines_that_meet_in_a_shorter_one(frame, order):
    short = "the quick brown fox jumps"
    texts = ["x" + short, short, short + "x"]
    rows = [(k + 1, texts[i]) for k, i in enumerate(order)]
    got = {r["doc_id"]: r["text"] for r in line_dedup.line_dedup(frame(rows))[0].collect()}
    assert got == dict(zip([d for d, _ in rows], brute_lines(rows, 16), strict=True))


def test_lines_of_families(frame, prose):
    r = random.Random(6)

    def edited(x, n):
        for _ in range(n):
            i = r.randrange(len(x))
            x = x[:i] + r.choice(["", "q", "q" + x[i]]) + x[i + 1 :]
        return x

    rows = [(i, "\n".join(edited(prose(40 + r.randrange(6), 5), r.randrange(4)) for _ in range(4))) for i in range(60)]
    got = {d["doc_id"]: d["text"] for d in line_dedup.line_dedup(frame(rows))[0].collect()}
    assert got == dict(zip([d for d, _ in rows], brute_lines(rows, 16), strict=True))


def test_lines_of_repeated_rows_and_no_ids(frame, spark):
    found, _ = line_dedup.line_dedup(frame([(1, "same line here today"), (1, "same line here today"), (None, "same line here today")]))
    assert sorted(r["text"] for r in found.collect()) == ["", "", "same line here today"]
    assert line_dedup.line_dedup(frame([(1, "x")]).where("doc_id > 1"))[0].count() == 0


# Embeddings


@pytest.mark.parametrize("block", [8, 4096])
def test_embeddings(spark, block):
    r = np.random.default_rng(5)
    base = r.normal(size=(12, 16))
    rows = [(i, (base[i % 12] + r.normal(size=16) * 0.08 * (i % 4)).tolist()) for i in range(60)]
    rows += [(100, base[0].tolist()), (101, base[0].tolist()), (102, (base[0] * 7).tolist())]
    odd = [(200, None), (201, [0.0] * 16), (202, [float("nan")] * 16), (203, [1.0]), (204, [None] * 16), (205, []), (206, [float("inf")] + [0.0] * 15)]
    df = spark.createDataFrame(rows + odd, "vec_id long, embedding array<double>").repartition(3)
    got = {x["vec_id"]: x for x in embeddings.near_duplicates(df, block=block).collect()}
    assert len(got) == len(rows + odd)
    x = np.array([v for _, v in rows])
    n = np.sqrt((x * x).sum(1))
    near = x @ x.T / n[:, None] / n[None, :] >= 0.95
    np.fill_diagonal(near, False)
    label = np.array([i for i, _ in rows])
    while True:
        new = np.minimum(label, np.where(near, label[None, :], 10**9).min(1))
        if (new == label).all():
            break
        label = new
    for (i, _), links, comp in zip(rows, near.sum(1), label, strict=True):
        assert (got[i]["n_links"], got[i]["component_id"], got[i]["kept"]) == (links, comp, i == comp)
    assert all(got[i]["n_links"] == 0 and got[i]["kept"] for i, _ in odd)
    assert embeddings.near_duplicates(df.where("vec_id < 0")).count() == 0


@pytest.mark.parametrize("block", [2, 4096])
def test_embeddings_of_every_length_and_without_ids(spark, block):
    rows = [(1, [1.0, 0.0], 5), (2, [1.0, 0.01], 5), (3, [0.0, 1.0, 0.0], 5), (4, [0.0, 1.0, 0.0], 5), (5, [0.0, 1.0, 0.01], 5), (6, [1.0, 0.0, 0.0], 5), (None, [1.0, 0.02], 5), (None, [0.0, 1.0], 5), (8, [-1.0], 5), (9, [-2.0], 5), (9, [-3.0], 5)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>, n_links int").repartition(2)
    got = sorted((str(x["vec_id"]), x["n_links"], str(x["component_id"]), x["kept"]) for x in embeddings.near_duplicates(df, block=block).collect())
    want = [("1", 2, "1", True), ("2", 2, "1", False), ("3", 2, "3", True), ("4", 2, "3", False), ("5", 2, "3", False), ("6", 0, "6", True), ("None", 2, "1", False), ("None", 0, "None", True), ("8", 2, "8", True), ("9", 2, "8", False), ("9", 2, "8", False)]
    assert got == sorted(want)
