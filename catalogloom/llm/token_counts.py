"""Token counts by dynamic programming over a trie of pre-tokens.

A vocabulary file lists byte strings by rank; a piece of rank r has the unigram score
``-log(r + 2)``. The best segmentation of a pre-token maximises the sum of its pieces' scores
(ties: fewer pieces). The score of the best segmentation of a prefix depends on the prefix alone,
so the distinct pre-tokens of a task share one trie: each node's forward score and piece count are
computed once, and the count at a word's last node is stored for that word.

The pieces that end at a place are found by walking back from it through a trie of reversed pieces, which ends where no
piece goes on; time is linear in the word's length. Bytes that no piece covers count as one piece each, with the score of
a rank past the vocabulary. Null and empty texts count 0. Whole texts are read.

Memory: a trie that has no room for a word's bytes within ``max_nodes`` nodes is dropped and begun anew, which changes no
count. Words longer than ``LONG`` bytes share no prefix worth keeping: their scores stand in arrays of their own length.
"""

from __future__ import annotations

import base64
import math
import re

from pyspark.sql import DataFrame

from .common import map_batches, texts

#: Bytes from which a word is scored by itself.
LONG = 1024
PRE_TOKEN = r" ?\w+| ?[^\w\s]+|\s+"
SCHEMA = "doc_id long, n_bytes long, n_pretokens long, n_tokens long"


def read_scores(vocab_path: str) -> dict[bytes, float]:
    """Piece -> unigram score, from a file of base64 pieces and ranks."""
    with open(vocab_path, "rb") as f:
        pairs = (line.split() for line in f if line.strip())
        return {base64.b64decode(piece): -math.log(int(rank) + 2) for piece, rank in pairs}


class PrefixTrie:
    """Forward scores and piece counts by prefix."""

    def __init__(self, scores: dict[bytes, float]):
        self.unknown = -math.log(len(scores) + 2) - 10
        self.back: dict = {}  # reversed pieces: byte -> node; a piece's score stands under None
        for piece, score in scores.items():
            node = self.back
            for byte in reversed(piece):
                node = node.setdefault(byte, {})
            node[None] = score
        self.clear()

    def __len__(self) -> int:
        return len(self.best)

    def clear(self) -> None:
        self.child: dict[int, int] = {}
        self.best, self.count = [0.0], [0]

    def _scored(self, word: bytes, end: int, best, count, path) -> tuple[float, int]:
        """Score and pieces of ``word[:end]`` from those of its prefixes, ``path`` telling where a prefix's stand."""
        last = path[end - 1]
        score, fewest, node, start = best[last] + self.unknown, count[last] + 1, self.back, end
        while start:
            node = node.get(word[start - 1])
            if node is None:
                break
            start -= 1
            if None in node:
                before = path[start]
                value, n = best[before] + node[None], count[before] + 1
                if value > score or (value == score and n < fewest):
                    score, fewest = value, n
        return score, fewest

    def insert(self, word: bytes) -> int:
        """The number of pieces of ``word``; only prefixes not seen before are computed."""
        if len(word) > LONG:
            return self.alone(word)
        path, node = [0], 0
        for end, byte in enumerate(word, 1):
            key = node << 8 | byte
            node = self.child.get(key, 0)
            if not node:
                node = self.child[key] = len(self.best)
                score, n = self._scored(word, end, self.best, self.count, path)
                self.best.append(score)
                self.count.append(n)
            path.append(node)
        return self.count[node]

    def alone(self, word: bytes) -> int:
        """The number of pieces of ``word``, nothing kept."""
        best, count = [0.0], [0]
        for end in range(1, len(word) + 1):
            score, n = self._scored(word, end, best, count, range(end))
            best.append(score)
            count.append(n)
        return count[-1]


def token_counts(df: DataFrame, vocab_path: str, id_col: str = "doc_id", text_col: str = "text", max_nodes: int = 600_000) -> DataFrame:
    """One row per input row: its bytes, pre-tokens and tokens. A repeated row gets a row each time."""

    def fn(batch, kept={}):  # noqa: B006  one trie for each task
        if not kept:
            kept |= {"words": {}, "trie": PrefixTrie(read_scores(vocab_path))}
        words, trie, find = kept["words"], kept["trie"], re.compile(PRE_TOKEN).findall
        n_bytes, n_pre, n_tokens = [], [], []
        for text in batch.column("text").to_pylist():
            found = find(text)
            new = {w for w in found if w not in words}
            for word in new:
                code = word.encode("utf-8", "surrogatepass")
                if len(trie) + len(code) > max_nodes:
                    trie.clear()
                words[word] = trie.insert(code)
            n_bytes.append(len(text.encode("utf-8", "surrogatepass")))
            n_pre.append(len(found))
            n_tokens.append(sum(map(words.__getitem__, found)))
            if len(words) > max_nodes:
                words.clear()
        yield {"doc_id": batch.column("doc_id"), "n_bytes": n_bytes, "n_pretokens": n_pre, "n_tokens": n_tokens}

    return map_batches(texts(df, id_col, text_col), fn, SCHEMA)
