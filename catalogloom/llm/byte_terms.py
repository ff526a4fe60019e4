"""A byte-level tokenizer over whole Arrow buffers.

The texts of a batch lie one after another in a single UTF-8 buffer. A lookup table of 256 entries tells which bytes
belong to terms (and lower-cases A-Z), so that the terms' boundaries are the places where that table's answer changes or
a text begins. Slices are grouped by their XXH3 hash; every slice is then compared byte for byte with its group's first
one, and slices of another wording that share a hash get groups of their own.
"""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash

#: A-Z as a-z, other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32


def byte_class(*ranges: tuple[int, int]) -> np.ndarray:
    """A table of 256 booleans: the bytes of the ranges (ends included), and every byte of a non-ASCII character."""
    found = np.zeros(256, bool)
    found[0x80:] = True
    for low, high in ranges:
        found[low : high + 1] = True
    return found


LETTERS = byte_class((0x41, 0x5A), (0x61, 0x7A))
LETTERS_AND_DIGITS = byte_class((0x30, 0x39), (0x41, 0x5A), (0x61, 0x7A))


def buffer_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a column of texts, one after another, and where each begins (and the last ends); null is empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    data = column.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def same_bytes(data: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether data[a:a+length] equals data[b:b+length], slice by slice."""
    differ = np.zeros(len(a), bool)
    todo, at = np.flatnonzero(a != b), 0
    while len(todo):  # a column of bytes at a time: slices are short
        wrong = data[a[todo] + at] != data[b[todo] + at]
        differ[todo[wrong]] = True
        at += 1
        todo = todo[~wrong & (length[todo] > at)]
    return ~differ


class Terms:
    """The terms of a batch: of each occurrence its text (``doc``) and its group (``term``); the groups' ``words``."""

    def __init__(self, column: pa.Array, members: np.ndarray, only: np.ndarray | None = None, hash_: Callable[[bytes], int] = xxhash.xxh3_64_intdigest):
        """``only``: sorted hashes; terms of other hashes are counted in ``n`` alone."""
        data, offsets = buffer_of(column)
        data = LOWER[data]
        inside = members[data]
        first = np.zeros(len(data) + 1, bool)
        first[offsets] = True
        starts = np.flatnonzero(inside & (first[:-1] | ~np.concatenate([[False], inside[:-1]])))
        ends = np.flatnonzero(inside & (first[1:] | ~np.concatenate([inside[1:], [False]]))) + 1
        doc = np.searchsorted(offsets, starts, "right") - 1
        self.n = np.bincount(doc, minlength=len(column)).astype(np.int64)
        raw = data.tobytes()
        hashes = np.fromiter((hash_(raw[a:b]) for a, b in zip(starts.tolist(), ends.tolist(), strict=True)), np.uint64, len(starts))
        if only is not None:
            at = np.minimum(np.searchsorted(only, hashes), max(len(only) - 1, 0))
            held = np.flatnonzero(only[at] == hashes) if len(only) else np.zeros(0, np.int64)
            starts, ends, doc, hashes = starts[held], ends[held], doc[held], hashes[held]
        self.doc = doc
        _, leader, term = np.unique(hashes, return_index=True, return_inverse=True)
        length = ends - starts
        wrong = length != length[leader[term]]
        wrong[~wrong] = ~same_bytes(data, starts[~wrong], starts[leader[term[~wrong]]], length[~wrong])
        words = [raw[starts[k] : ends[k]] for k in leader.tolist()]
        if wrong.any():  # two wordings of one hash
            place = {}
            for k in np.flatnonzero(wrong).tolist():
                word = raw[starts[k] : ends[k]]
                if word not in place:
                    place[word] = len(words)
                    words.append(word)
                term[k] = place[word]
        self.term, self.words = term.astype(np.int64), words

    def counts(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Of each (text, term) that occurs, in this order: the text, the term and how often."""
        key, n = np.unique(self.doc * max(len(self.words), 1) + self.term, return_counts=True)
        return key // max(len(self.words), 1), key % max(len(self.words), 1), n
