"""Quality rules by repetition inside a text.

The words of a batch's texts, numbered within their text so that no two texts share one, stand in one array; its
suffix array is made by prefix doubling (positions sorted by pairs of ranks at growing offsets; those whose rank is
unique are done), and the ranks of all rounds give the longest common prefix of neighbours. A run of words is repeated if
it stands twice in its text. The maximal repeated runs of ``min_words`` words or more are the intervals of the suffix
array's common prefixes; the union of their spans is the same as that of each position's longest repeated run, for
each such run is a maximal one or lies at the head of one. A text fails if those spans cover more than ``max_covered`` of
its words, or if its longest repeat has more than ``max_longest`` words.

Whole texts are read, in slices of a few MB, one text at least; nothing is shuffled. A null text is an empty one: no
words, it fails the base rule. Overlapping runs count. Repeated rows are judged each time, other columns stay out.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from .byte_terms import buffer_of
from .common import map_batches, texts

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: Characters that count as symbols.
SYMBOLS = np.zeros(256, bool)
SYMBOLS[[ord(c) for c in "#*$%&|<>"]] = True
SCHEMA = "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, base_failed boolean, n_covered long, longest_repeat long, kept boolean"


def suffix_ranks(ids: np.ndarray) -> list[np.ndarray]:
    """Ranks of the suffixes by their first 1, 2, 4, ... words, until all ranks are unique (suffixes end where ``ids`` ends)."""
    n = len(ids)
    _, rank = np.unique(ids, return_inverse=True)
    rank = rank.astype(np.int64)
    levels, width = [rank], 1
    while n:
        held = np.bincount(rank, minlength=n)
        todo = np.flatnonzero(held[rank] > 1)
        if not len(todo):
            break
        first = np.cumsum(held) - held  # ranks become places: a group's ranks start at its own
        rank = first[rank] if width == 1 else rank
        after = np.where(todo + width < n, rank[np.minimum(todo + width, n - 1)] + 1, 0)
        order = np.lexsort((after, rank[todo]))
        group, after, todo = rank[todo][order], after[order], todo[order]
        new = np.concatenate([[True], (group[1:] != group[:-1]) | (after[1:] != after[:-1])])
        head = np.concatenate([[True], group[1:] != group[:-1]])
        at = np.arange(len(todo))
        within = at - np.maximum.accumulate(np.where(head, at, 0))
        place = np.maximum.accumulate(np.where(new, at, 0))
        fresh = rank.copy()
        fresh[todo] = group + within[place]
        levels[-1] = rank
        rank = fresh
        levels.append(rank)
        width *= 2
    return levels


def longest_repeats(ids: np.ndarray) -> np.ndarray:
    """For each position, the length of the longest run starting there that starts elsewhere too."""
    n = len(ids)
    out = np.zeros(n, np.int64)
    if n < 2:
        return out
    levels = suffix_ranks(ids)
    suffixes = np.argsort(levels[-1], kind="stable")
    a, b, common = suffixes[:-1].copy(), suffixes[1:].copy(), np.zeros(n - 1, np.int64)
    for k in range(len(levels) - 1, -1, -1):
        inside = (a < n) & (b < n)
        same = inside.copy()
        same[inside] = levels[k][a[inside]] == levels[k][b[inside]]
        common[same] += 1 << k
        a[same] += 1 << k
        b[same] += 1 << k
    out[suffixes[:-1]] = common
    out[suffixes[1:]] = np.maximum(out[suffixes[1:]], common)
    return out


def covered(repeats: np.ndarray, least: int) -> np.ndarray:
    """Which positions lie in a repeated run of ``least`` words or more."""
    reach = np.where(repeats >= least, np.arange(len(repeats)) + repeats, 0)
    return np.maximum.accumulate(reach) > np.arange(len(repeats)) if len(repeats) else np.zeros(0, bool)


def word_ids(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(text of each word, id of each word): equal words of one text share an id, words of two texts never do."""
    raw = data.tobytes()
    docs, ids, upto = [], [], 0
    for d, (a, b) in enumerate(zip(offsets[:-1].tolist(), offsets[1:].tolist(), strict=True)):
        seen: dict[bytes, int] = {}
        mine = [seen.setdefault(w, len(seen)) for w in raw[a:b].split()]
        docs.append(len(mine))
        ids.append(np.array(mine, np.int64) + upto)
        upto += len(seen)
    return np.repeat(np.arange(len(docs)), docs), np.concatenate(ids) if ids else np.zeros(0, np.int64)


def repeated_lines(text: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    lines = [x for x in text.split(b"\n") if x.strip()]
    return len(lines) - len(set(lines))


def repetition_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", min_words: int = 16, max_covered: float = 0.1, max_longest: int = 50) -> DataFrame:
    """One row per input row with its counts and whether it stays."""

    def fn(batch):
        data, offsets = buffer_of(batch.column("text"))
        size, bounds = batch.num_rows, offsets[:-1]
        sums = lambda flags: np.diff(np.concatenate([[0], np.cumsum(flags)])[offsets])
        characters = sums((data & 0xC0) != 0x80)
        doc, ids = word_ids(data, offsets)
        n_words = np.bincount(doc, minlength=size)
        repeats = longest_repeats(ids)
        count = lambda flags: np.bincount(doc[flags], minlength=size)
        n_repeat, n_covered, longest = count(covered(repeats, 5)), count(covered(repeats, min_words)), np.zeros(size, np.int64)
        np.maximum.at(longest, doc, repeats)
        raw = data.tobytes()
        failed = (n_words < 10) | (100 * n_repeat > 20 * n_words)
        yield {
            "doc_id": batch.column("doc_id"),
            "n_words": n_words,
            "word_chars": characters - sums(SPACE[data]),
            "n_symbols": sums(SYMBOLS[data]),
            "n_dup_lines": [repeated_lines(raw[a:b]) for a, b in zip(bounds.tolist(), offsets[1:].tolist(), strict=True)],
            "n_repeat_words": n_repeat,
            "base_failed": pa.array(failed),
            "n_covered": n_covered,
            "longest_repeat": longest,
            "kept": pa.array(~failed & (n_covered <= max_covered * n_words) & (longest <= max_longest)),
        }

    return map_batches(texts(df, id_col, text_col), fn, SCHEMA)
