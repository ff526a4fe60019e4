"""Source divergence, lexical search and repetition rules against brute force."""

import math
import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from catalogloom.llm import byte_terms, divergence, lexical_search, repetition
from catalogloom.llm.byte_terms import LETTERS, LETTERS_AND_DIGITS, Terms

ODD = [None, "", " \n\t ", "Ünï ©ode\x00 TEXT text", "a", "a1b2 Ärger", "word " * 30_000, "日本 語, x", "x#*$ <y> |z| & %"]


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def letters(text):
    return re.findall(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+", lower(text))


def letters_and_digits(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", lower(text))


@pytest.mark.parametrize(("members", "plain"), [(LETTERS, letters), (LETTERS_AND_DIGITS, letters_and_digits)])
@pytest.mark.parametrize("weak", [False, True])
def test_terms(members, plain, weak, prose):
    """``weak``: a hash under which many words collide, so that exact bytes must tell them apart."""
    texts = [*ODD, prose(1, 300), "endsword", "startsword"]
    options = {"hash_": lambda x: len(x) % 3} if weak else {}
    for column in (pa.array(texts), pa.array(["cut off", *texts, "too"]).slice(1, len(texts)), pa.array([], pa.string())):
        found = Terms(column, members, **options)
        got = [[] for _ in range(len(column))]
        for d, k in zip(found.doc.tolist(), found.term.tolist(), strict=True):
            got[d].append(found.words[k].decode())
        assert got == [plain(t) for t in column.to_pylist()]
        assert found.n.tolist() == [len(x) for x in got] and len(set(found.words)) == len(found.words)
        doc, term, n = found.counts()
        assert {(d, found.words[k].decode()): c for d, k, c in zip(doc.tolist(), term.tolist(), n.tolist(), strict=True)} == {(d, w): c for d, x in enumerate(got) for w, c in Counter(x).items()}


def test_only_some_terms():
    import xxhash

    found = Terms(pa.array(["a b c a", None, "b"]), LETTERS, only=np.sort(np.array([xxhash.xxh3_64_intdigest(b"a")], np.uint64)))
    assert found.words == [b"a"] and found.doc.tolist() == [0, 0] and found.n.tolist() == [4, 0, 1]
    none = Terms(pa.array(["a b"]), LETTERS, only=np.zeros(0, np.uint64))
    assert none.words == [] and none.n.tolist() == [2] and none.counts()[0].tolist() == []


# Divergence.


def brute_divergence(rows, min_docs, top, scale):
    docs = [(lang or "", source or "", letters(text)) for lang, source, text in rows]
    out = set()
    for lang in {d[0] for d in docs}:
        mine = [d for d in docs if d[0] == lang]
        df = Counter(w for d in mine for w in set(d[2]))
        kept = {w for w, n in df.items() if n >= min_docs}
        counts = {s: Counter(w for d in mine if d[1] == s for w in d[2] if w in kept) for s in {d[1] for d in mine}}
        whole = sum(counts.values(), Counter())
        p = lambda c, w: 1 + scale * (c[w] + 1) // (sum(c.values()) + len(kept))
        f = lambda a, b: (a - b) ** 2 // b
        for s, c in counts.items():
            parts = {"pair": [(o, sum(f(p(c, w), p(counts[o], w)) for w in kept)) for o in counts if o != s], "term": [(w, f(p(c, w), p(whole, w))) for w in c if c[w] > 0 and p(c, w) > p(whole, w)]}
            for part, items in parts.items():
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out |= {(lang, s, part, item, v, r) for r, (item, v) in enumerate(items[: top if part == "term" else None], 1)}
    return out


def sources(spark, rows, n=3):
    rows = [(lang, source, text, "x", 1, 2) for lang, source, text in rows]
    return spark.createDataFrame(rows, "lang string, source string, text string, term string, part int, value long").repartition(n)


def test_divergence(spark, prose, monkeypatch):
    monkeypatch.setattr(divergence, "BLOCK", 40)  # many blocks
    r = random.Random(3)
    rows = [(r.choice(["en", "de", None, ""]), r.choice(["a", "b", "ä", None]), prose(r.randint(0, 9), 30)) for _ in range(40)]
    rows += [("fr", "only", "one document"), ("es", "x", None), ("es", "y", ""), ("es", "z", "zz")]
    rows += [("en", "a", t) for t in ODD] + [("en", "none", "12 34")] + rows[:3]
    for top in (200, 3):
        got = {tuple(x) for x in divergence.divergences(sources(spark, rows), top=top).collect()}
        assert got == brute_divergence(rows, 3, top, 10**9)
    assert divergence.divergences(sources(spark, rows).where("lang = 'none'")).count() == 0


def test_counts_of_a_task(prose):
    counts = divergence.Counts()
    texts = [prose(i, 20) for i in range(6)]
    for t in texts:
        counts.add(["en", "de"], ["a", "b"], pa.array([t, t]))
    schema = divergence.to_arrow_schema(divergence._parse_datatype_string(divergence.COUNTED))
    rows = [x for b in counts.flush(schema) for x in b.to_pylist()]
    want = Counter(w for t in texts for w in letters(t))
    assert {(x["lang"], x["term"]): x["entries"][0]["n"] for x in rows} == {(lang, w): n for lang in ("en", "de") for w, n in want.items()}
    assert counts.size == 0 and list(counts.flush(schema)) == []


def test_shares_are_exact():
    r = random.Random(1)
    total = [r.randrange(1, 9_000_000_000_000_000) for _ in range(200)]
    count = [r.randrange(t) for t in total]
    assert divergence.shares(np.array(count), np.array(total)).tolist() == [1 + 10**9 * (c + 1) // t for c, t in zip(count, total, strict=True)]
    with pytest.raises(ValueError, match="power"):
        divergence.shares(np.array([1]), 5, 10**4)


# Search.


def brute_search(docs, items, k):
    bags = [(d, Counter(letters_and_digits(t))) for d, t in docs]
    bags = [(d, b) for d, b in bags if b]
    n_docs, total = len(bags), sum(sum(b.values()) for _, b in bags)
    df = Counter(w for _, b in bags for w in b)
    weight = {w: math.floor(1000 * math.log((2 * n_docs + 2) / (2 * n + 1))) for w, n in df.items()}
    out = []
    for item, text in items:
        scored = []
        for d, b in bags:
            m = 25 + 75 * sum(b.values()) * n_docs // total
            score = sum(weight[w] * (10**9 * b[w] // (1000 * b[w] + 8 * m)) for w in letters_and_digits(text) if w in b)
            if score > 0:
                scored.append((-score, d is None, d or 0, d))
        out += [(item, rank, x[3], -x[0]) for rank, x in enumerate(sorted(scored)[:k], 1)]
    return sorted(map(repr, out))


@pytest.mark.parametrize("blocks", [False, True])
def test_search(spark, frame, prose, monkeypatch, blocks):
    monkeypatch.setattr(lexical_search, "SHARD", 2000)  # many shards
    if blocks:
        monkeypatch.setattr(lexical_search, "BLOCK", 800)
        monkeypatch.setattr(lexical_search, "HASHES", 3)  # all terms are held
    docs = [(i, t) for i, t in enumerate(ODD)] + [(100 + i, prose(i % 25, 5 + i)) for i in range(60)] + [(None, prose(3, 40)), (100, prose(0, 5)), (100, prose(0, 5))]
    items = [(1, prose(2, 12) + " " + prose(4, 6)), (2, None), (3, "no such wordes"), (1, prose(7, 9)), (None, prose(9, 3)), (4, "an an an the er"), (5, "TEXT 1 Ärger, word")]
    queries = spark.createDataFrame([(i, t, 1, "y") for i, t in items], "item_id long, text string, rank int, doc_id string").repartition(2)
    for k in (1, 10):
        got = lexical_search.search(frame(docs), queries, k).collect()
        assert sorted(map(repr, (tuple(x) for x in got))) == brute_search(docs, items, k)
    assert lexical_search.search(frame(docs).where("doc_id > 10000"), queries).count() == 0
    assert lexical_search.search(frame(docs), queries.where("item_id > 99")).count() == 0


def test_max_score_probes_few(prose):
    """Non-essential lists meet candidates alone, and nothing that reaches the bound is lost."""
    r = random.Random(5)
    texts = [" ".join(r.choice(["the"] * 30 + ["of"] * 20 + [f"w{r.randint(0, 300)}"]) for _ in range(60)) for _ in range(800)]
    found = Terms(pa.array(texts), LETTERS_AND_DIGITS)
    doc, term, n = found.counts()
    order = np.argsort(term, kind="stable")
    row = {"ids": list(range(800)), "lengths": found.n.tolist(), "terms": [w.decode() for w in found.words], "held": np.bincount(term).tolist(), "places": doc[order].astype("<u4").tobytes(), "often": n[order].astype("<u4").tobytes()}
    shard = lexical_search.Shard(row, 800, int(found.n.sum()))
    query = [("the", 2, 3), ("of", 1, 300), ("w7", 1, 5000), ("w9", 3, 4000), ("none", 1, 900)]
    at, score = lexical_search.max_score(shard, query, 1)
    best = dict(zip(at.tolist(), score.tolist(), strict=True))
    least = sorted(best.values())[-10]
    probed = []
    at, score = lexical_search.max_score(shard, query, least, probed)
    assert dict(zip(at.tolist(), score.tolist(), strict=True)) == {d: s for d, s in best.items() if s >= least}
    assert probed and max(probed) < 100


def test_long_documents_in_many():
    assert lexical_search.length_factors(np.array([10, 20_000_000]), 10**12, 10**15).tolist() == [25 + 75 * 10 * 10**12 // 10**15, 25 + 75 * 20_000_000 * 10**12 // 10**15]


# Repetition.


def brute_repeats(words):
    out = []
    for i in range(len(words)):
        best = 0
        for j in range(len(words)):
            n = 0
            while i != j and max(i, j) + n < len(words) and words[i + n] == words[j + n]:
                n += 1
            best = max(best, n)
        out.append(best)
    return out


@pytest.mark.parametrize("seed", range(6))
def test_longest_repeats(seed):
    r = random.Random(seed)
    parts = [[r.choice("ab" if seed % 2 else "abcdefgh") for _ in range(r.randint(0, 40))] for _ in range(6)] + [list("ab" * 20)]
    column = pa.array([" ".join(p) for p in parts])
    doc, ids = repetition.word_ids(*byte_terms.buffer_of(column))
    got = repetition.longest_repeats(ids).tolist()
    assert got == [n for p in parts for n in brute_repeats(p)] and doc.tolist() == [d for d, p in enumerate(parts) for _ in p]


def test_repetition_rules(frame, prose):
    para = prose(5, 60)
    rows = [(i, t) for i, t in enumerate(ODD)] + [
        (20, prose(1, 200)), (20, prose(1, 200)), (21, f"{prose(2, 900)} {para} {prose(3, 50)} {para}"), (22, f"{prose(2, 60)} " + "one two three four five six " * 4), (23, "a line\n\nb line\na line\n a line\n\t\n" + prose(4, 100)),
        (24, prose(6, 400) + " " + f"{prose(7, 18)} ... " * 2 + prose(8, 20)), (None, "short"),
    ]
    got = repetition.repetition_rules(frame(rows)).collect()
    assert len(got) == len(rows)
    for d, text in rows:
        r = next(x for x in got if x["doc_id"] == d)
        words = re.findall(r"[^\x20\x09-\x0D]+", text or "")
        assert r["n_words"] == len(words) and r["word_chars"] == sum(map(len, words)) and r["n_symbols"] == sum(c in "#*$%&|<>" for c in text or "")
        seen, dup = set(), 0
        for line in (text or "").split("\n"):
            if re.search(r"[^\x20\x09-\x0D]", line):
                dup += line in seen
                seen.add(line)
        assert r["n_dup_lines"] == dup
        if len(words) < 2000:
            repeats = brute_repeats(words)
            cover = lambda least: len({p for i, n in enumerate(repeats) if n >= least for p in range(i, i + n)})
            failed = len(words) < 10 or 100 * cover(5) > 20 * len(words)
            assert (r["n_repeat_words"], r["n_covered"], r["longest_repeat"], r["base_failed"]) == (cover(5), cover(16), max(repeats, default=0), failed)
            assert r["kept"] == (not failed and cover(16) <= 0.1 * len(words) and max(repeats) <= 50)
    kept = {x["doc_id"]: (x["base_failed"], x["kept"]) for x in got}
    assert kept[20] == (False, True) and kept[21] == (False, False) and kept[22] == (True, False) and kept[6] == (True, False)
    assert repetition.repetition_rules(frame(rows).where("doc_id > 999")).count() == 0
