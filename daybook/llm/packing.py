"""Packing of token sequences under several limits at once, by the dot-product heuristic.

An example is a piece of a document with three sizes: tokens, one segment, and loss-bearing tokens
(all but a piece's first token, which nothing predicts). A sequence may hold at most ``limits`` of each. While a
sequence is open, the heuristic takes the waiting example whose sizes have the largest dot product with the room
left, both as shares of the limits, among those that fit. If none fits and only tokens are short,
the best one is cut to fill the sequence.

Each task packs the documents that it reads, so nothing shuffles and a lost task gives the same result
again. Documents longer than a sequence are cut into full sequences first. A sequence that another limit closes before
it is full of tokens, and a task's last one, are cut into sequences whose lengths are powers of two, which need no padding. Sequence ids
are the task's number and a running one.

Defined results: a NULL text is empty; an empty text is its end token alone. Rows are packed as they
come, repeated ids too, NULL ids included. Other columns are not used.
"""

from __future__ import annotations

import base64
import functools
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import regex
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SEQUENCE = 2048
#: Tokens, segments and loss-bearing tokens that a sequence holds at most.
LIMITS = (SEQUENCE, 64, SEQUENCE - 1)
END_ID = 1
#: Examples among which the heuristic chooses.
WAITING = 1024

_TWO_SPACES = regex.compile(r"\s\s")
#: Fixed value: the vocabulary's own way to find the parts of a text, but for runs of white space.
_PARTS = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+"


class Tokenizer:
    """Token ids of the byte-level vocabulary in a ``tokenizers`` file.

    Where the same vocabulary lies beside it as ranks, texts without runs of white space and without special tokens go
    through the faster reader of ranks, which gives the same ids.
    """

    def __init__(self, path: str, ranks_path: str | None):
        from tokenizers import Tokenizer as Full

        self.full = Full.from_file(path)
        self.special = [t.content for t in self.full.get_added_tokens_decoder().values()]
        self.fast = None
        if ranks_path:
            import tiktoken

            with open(ranks_path, "rb") as lines:
                ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
            self.fast = tiktoken.Encoding("ranks", pat_str=_PARTS, mergeable_ranks=ranks, special_tokens={})

    def ids(self, text: str) -> np.ndarray:
        if self.fast is None or _TWO_SPACES.search(text) or any(s in text for s in self.special):
            return np.array(self.full.encode(text, add_special_tokens=False).ids, dtype=np.uint32)
        return np.array(self.fast.encode_ordinary(text), dtype=np.uint32)


@functools.lru_cache(maxsize=2)
def tokenizer(path: str, ranks_path: str | None) -> Tokenizer:
    """Read once per Python worker."""
    return Tokenizer(path, ranks_path)


@dataclass(slots=True)
class Piece:
    doc_id: int | None
    start: int
    ids: np.ndarray
    doc_tokens: int

    def cut(self, at: int) -> tuple[Piece, Piece]:
        return (Piece(self.doc_id, self.start, self.ids[:at], self.doc_tokens),
                Piece(self.doc_id, self.start + at, self.ids[at:], self.doc_tokens))


def sizes(tokens: int) -> tuple[int, int, int]:
    return tokens, 1, tokens - 1


class Packer:
    """Sequences from examples that come one by one; gives lists of pieces."""

    def __init__(self, limits: tuple[int, int, int] = LIMITS, waiting: int = WAITING):
        self.limits = np.array(limits, dtype=float)
        self.tokens = min(limits[0], limits[2] + 1)  # what a sequence of one segment holds
        self.most = waiting
        self.pieces: list[Piece | None] = [None] * (waiting + 1)
        self.demand = np.zeros((waiting + 1, 3))  # shares of the limits; a free place has 0
        self.free = list(range(waiting, -1, -1))

    def __len__(self) -> int:
        return self.most + 1 - len(self.free)

    def _put(self, piece: Piece) -> None:
        at = self.free.pop()
        self.pieces[at] = piece
        self.demand[at] = np.array(sizes(len(piece.ids))) / self.limits

    def _take(self, at: int) -> Piece:
        piece = self.pieces[at]
        self.pieces[at] = None
        self.demand[at] = 0
        self.free.append(at)
        return piece

    def add(self, piece: Piece) -> Iterator[list[Piece]]:
        """Take in a piece of any length; yields the sequences that became full."""
        while len(piece.ids) > self.tokens:
            head, piece = piece.cut(self.tokens)
            yield [head]
        self._put(piece)
        while not self.free:
            sequence = self._fill()
            if sum(len(p.ids) for p in sequence) < self.limits[0]:  # closed by another limit
                yield from self._powers(sequence)
            else:
                yield sequence

    def _fill(self) -> list[Piece]:
        room, out = np.ones(3), []
        while len(self):
            score = self.demand @ room
            fits = (self.demand <= room + 1e-9).all(axis=1) & (score > 0)
            if fits.any():
                at = int(np.argmax(np.where(fits, score, -1)))
                room = room - self.demand[at]
                out.append(self._take(at))
                if room[0] * self.limits[0] < 1:
                    break
                continue
            left = int(min(round(room[0] * self.limits[0]), round(room[2] * self.limits[2]) + 1))
            if left >= 1 and room[1] * self.limits[1] >= 1 - 1e-9:
                at = int(np.argmax(score))
                head, tail = self._take(at).cut(left)
                out.append(head)
                self._put(tail)
            break
        return out

    @staticmethod
    def _powers(sequence: list[Piece]) -> Iterator[list[Piece]]:
        """A sequence cut into ones of 2^k tokens."""
        total = sum(len(p.ids) for p in sequence)
        while total:
            size = 1 << (total.bit_length() - 1)
            taken, got = [], 0
            while got < size:
                piece = sequence.pop(0)
                if got + len(piece.ids) > size:
                    piece, rest = piece.cut(size - got)
                    sequence.insert(0, rest)
                taken.append(piece)
                got += len(piece.ids)
            total -= size
            yield taken

    def finish(self) -> Iterator[list[Piece]]:
        """The rest: full sequences, then sequences of 2^k tokens."""
        while len(self):
            yield from self._powers(self._fill())


SCHEMA = T.StructType([
    T.StructField("doc_id", T.LongType()), T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
    T.StructField("ids", T.BinaryType()), T.StructField("doc_tokens", T.LongType()), T.StructField("sequence_id", T.LongType()),
    T.StructField("offset", T.LongType()), T.StructField("loss_tokens", T.LongType()),
])
_ROWS = 2_000


def pack(
    df: DataFrame, tokenizer_path: str, ranks_path: str | None = None, text: str = "text", doc_id: str = "doc_id",
    limits: tuple[int, int, int] = LIMITS,
) -> DataFrame:
    """One row per piece; ``ids`` are its token ids as little-endian unsigned 32-bit numbers."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode, packer = tokenizer(tokenizer_path, ranks_path).ids, Packer(limits)
        sequence, rows = TaskContext.get().partitionId() << 40, []
        end = np.array([END_ID], dtype=np.uint32)

        def sequences() -> Iterator[list[Piece]]:
            for b in batches:
                seen: dict[str, np.ndarray] = {}
                for doc, body in zip(b.column(0), b.column(1)):
                    body = body.as_py() or ""
                    ids = seen.get(body)
                    if ids is None:
                        ids = seen[body] = np.concatenate([encode(body), end])
                    yield from packer.add(Piece(doc.as_py(), 0, ids, len(ids)))
            yield from packer.finish()

        def table() -> pa.RecordBatch:
            columns = list(zip(*rows))
            return pa.RecordBatch.from_arrays([
                pa.array(c, pa.binary() if f.name == "ids" else pa.int64()) for c, f in zip(columns, SCHEMA.fields)], names=SCHEMA.names)

        for pieces in sequences():
            offset = 0
            for p in pieces:
                n = len(p.ids)
                rows.append((p.doc_id, p.start, n, p.ids.astype("<u4").tobytes(), p.doc_tokens, sequence, offset, n - 1))
                offset += n
            sequence += 1
            if len(rows) >= _ROWS:
                yield table()
                rows.clear()
        if rows:
            yield table()

    return df.select(F.col(doc_id).cast("long"), F.col(text)).mapInArrow(run, SCHEMA)
