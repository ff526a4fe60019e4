"""Packing of token sequences by vector bin packing.

A bin has three limits: tokens, segments and loss-bearing tokens. Of the open bins that hold an example
whole, it goes to the one whose free space has the largest dot product with the example's demand, both
as shares of the limits. Examples longer than a bin give full pieces first. Where no open bin fits and
``max_open`` bins are open, the example is cut to fill the fullest bin exactly. What is left open at a
task's end is dealt anew into full bins. A bin that is closed before its tokens are full, because another
limit is reached or nothing is left, gives a sequence whose length is a power of two, which needs no padding;
the pieces past it are packed again. So no limit costs padding, whatever the lengths.

Each partition is packed on its own, in its own order, so nothing is shuffled and a task that runs again
gives the same rows. Memory: ``max_open`` bins. A null or empty text is its end id alone. Repeated rows
are packed each time.
"""

from __future__ import annotations

import base64
import os

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import _parse_datatype_string

from .common import sliced

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, loss_tokens long, sequence_id long, offset long"
GPT_SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"


class ByteBpe:
    """Ids of a byte-level BPE, as little-endian unsigned 32-bit bytes.

    A pre-token never spans a space but as its leading one, so a text's ids are those of its space-led
    chunks; each distinct chunk is encoded once while the cache has room. Texts with runs of spaces,
    with trailing white space or with the text of a special token go to the tokenizer whole.
    """

    def __init__(self, json_path: str, ranks_path: str, room: int = 400_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        import tiktoken
        from tokenizers import Tokenizer

        self.whole = Tokenizer.from_file(json_path)
        with open(ranks_path, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.chunk = tiktoken.Encoding("ranks", pat_str=GPT_SPLIT, mergeable_ranks=ranks, special_tokens={})
        self.kept, self.room = {}, room

    def ids(self, text: str) -> bytes:
        if not text:
            return b""
        if "  " in text or "<|" in text or text[-1].isspace():
            return np.array(self.whole.encode(text, add_special_tokens=False).ids, "<u4").tobytes()
        first, *rest = text.split(" ")
        chunks = [first, *(f" {x}" for x in rest)]
        try:
            return b"".join(map(self.kept.__getitem__, chunks))
        except KeyError:
            encode = self.chunk.encode_ordinary
            new = {x: np.array(encode(x), "<u4").tobytes() for x in {c for c in chunks if c not in self.kept}}
            if len(self.kept) < self.room:
                self.kept.update(new)
                return b"".join(map(self.kept.__getitem__, chunks))
            return b"".join(new[x] if x in new else self.kept[x] for x in chunks)


class Bins:
    """Open bins under three limits; ``done`` collects finished sequences as lists of pieces."""

    def __init__(self, limits: tuple[int, int, int], max_open: int):
        self.limits = np.array(limits, float)
        self.free = np.zeros((max_open, 3))
        self.held: list[list | None] = [None] * max_open
        self.done: list[list] = []

    @staticmethod
    def demand(piece) -> tuple[int, int, int]:
        """piece: (row, start, length), row: [doc_id, ids, tokens, prompt]. The prompt's tokens bear no loss."""
        row, start, n = piece
        return n, 1, max(0, start + n - max(start, row[3]))

    def head(self, piece, free) -> int:
        """The longest head of ``piece`` that ``free`` takes."""
        row, start, n = piece
        return 0 if free[1] < 1 else int(min(n, free[0], max(0, row[3] - start) + free[2]))

    def settle(self, pieces: list) -> list:
        """Finish a bin: whole if its tokens are full, else its head up to a power of two. The pieces past the head."""
        used = sum(p[2] for p in pieces)
        left = used if used == self.limits[0] else 1 << (used.bit_length() - 1)
        head, rest = [], []
        for row, start, n in pieces:
            cut = min(n, left)
            left -= cut
            if cut:
                head.append((row, start, cut))
            if cut < n:
                rest.append((row, start + cut, n - cut))
        self.done.append(head)
        return rest

    def close(self, k: int) -> list:
        pieces, self.held[k], self.free[k] = self.held[k], None, 0
        return self.settle(pieces)

    def add(self, row) -> None:
        todo = [(row, 0, row[2])]
        while todo:
            row, start, n = piece = todo.pop()
            whole = self.head(piece, self.limits)
            if whole < n:  # as much as a bin takes: a sequence of its own
                todo += [(row, start + whole, n - whole), *self.settle([(row, start, whole)])]
                continue
            need = np.array(self.demand(piece))
            score = np.where((self.free >= need).all(1), (self.free / self.limits**2) @ need, -1)
            k = int(score.argmax())
            if score[k] < 0:
                if None not in self.held:
                    k = int(self.free[:, 0].argmin())
                    if cut := self.head(piece, self.free[k]):
                        self.held[k].append((row, start, cut))
                        piece = (row, start + cut, n - cut)
                    todo += [*([piece] if piece[2] else []), *self.close(k)]
                    continue
                k = self.held.index(None)
                self.held[k], self.free[k] = [], self.limits
            self.held[k].append(piece)
            self.free[k] -= need
            if self.free[k].min() < 1:
                todo += self.close(k)

    def finish(self) -> None:
        """Deal what is open into full bins; the rest into lengths that are powers of two."""
        todo = [p for b in self.held if b for p in b][::-1]
        self.held = [None] * len(self.held)
        self.free[:] = 0
        free, bin_ = self.limits.copy(), []
        while todo or bin_:
            cut = self.head(todo[-1], free) if todo else 0
            if cut:
                row, start, n = todo.pop()
                bin_.append((row, start, cut))
                free -= self.demand(bin_[-1])
                if cut < n:
                    todo.append((row, start + cut, n - cut))
            if not cut or free.min() < 1:
                todo += self.settle(bin_)[::-1]
                free, bin_ = self.limits.copy(), []


def pack(
    df: DataFrame,
    tokenizer_json: str,
    tokenizer_ranks: str,
    end_id: int = 0,
    max_tokens: int = 1024,
    max_segments: int = 1024,
    max_loss: int | None = None,
    max_open: int = 64,
    id_col: str = "doc_id",
    text_col: str = "text",
    prompt_col: str | None = None,
) -> DataFrame:
    """One row per piece, with its ids, sequence and place there.

    ``prompt_col`` (optional) counts the leading tokens of a row that bear no loss.
    """
    limits = (max_tokens, max_segments, max_loss or max_tokens)
    if min(limits) < 1:
        raise ValueError("limits are at least 1")
    arrow = to_arrow_schema(_parse_datatype_string(SCHEMA))
    end = int(end_id).to_bytes(4, "little")

    def run(batches):
        coder, bins, made = ByteBpe(tokenizer_json, tokenizer_ranks), Bins(limits, max_open), TaskContext.get().partitionId() << 32

        def flush():
            nonlocal made
            rows = []
            for pieces in bins.done:
                offset = 0
                for row, start, n in pieces:
                    rows.append((row[0], start, n, row[1][4 * start : 4 * (start + n)], row[2], Bins.demand((row, start, n))[2], made, offset))
                    offset += n
                made += 1
            bins.done.clear()
            if rows:
                yield pa.RecordBatch.from_arrays([pa.array(x, type=f.type) for x, f in zip(zip(*rows, strict=True), arrow, strict=True)], schema=arrow)

        for batch in sliced(batches):
            for i, (doc_id, text, prompt) in enumerate(zip(*(batch.column(k).to_pylist() for k in range(3)), strict=True)):
                ids = coder.ids(text) + end
                bins.add([doc_id, ids, len(ids) // 4, max(0, prompt)])
                if i % 500 == 499:
                    yield from flush()
        bins.finish()
        yield from flush()

    prompt = F.coalesce(F.col(prompt_col).cast("long"), F.lit(0)) if prompt_col else F.lit(0).cast("long")
    rows = df.select(F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), prompt.alias("prompt"))
    return rows.mapInArrow(run, SCHEMA)
