"""Packing of examples into sequences: vector bin packing by the dot-product heuristic.

An example is a vector of tokens, segments (one) and loss-bearing tokens; a sequence takes examples
while all three sums stay within their limits.  Each task packs the rows of its partition as they
come, so nothing is shuffled and a sequence never depends on another task: it holds a bounded number
of examples, fills one sequence at a time from them, and takes in the next ones.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, functions as F

from stationflow.llm.common import fresh_name
from stationflow.llm.token_files import END_ID, WordEncoder, in_batches

# Examples a task holds at once to choose from; all of one sequence's length at most.
HELD = 256
# Bits of a sequence's number that count within a partition.
LOCAL_BITS = 40
# Rows of one batch of results.
ROWS_OUT = 1 << 12

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, loss_tokens long, sequence_id long, offset long"


@dataclass(frozen=True)
class Limits:
    """What one sequence holds at most; ``cut`` allows to part an example where a sequence has room left."""

    tokens: int = 2048
    segments: int = 256
    loss: int = 2048
    cut: bool = True

    def __post_init__(self) -> None:
        if min(self.tokens, self.segments, self.loss) < 1:
            raise ValueError("all limits are at least one")


@dataclass
class Example:
    """The part of an example that is not placed yet; ids from ``prompt`` on bear loss."""

    key: int
    start: int
    end: int
    prompt: int

    def loss(self, length: int) -> int:
        return max(0, self.start + length - max(self.start, self.prompt))

    def longest(self, tokens: int, loss: int) -> int:
        """Ids from the start that stay within both limits."""
        return min(self.end - self.start, tokens, max(0, self.prompt - self.start) + loss)


# A piece: key of the example, first id, ids, loss-bearing ids.
Piece = tuple[int, int, int, int]


class Packer:
    """Takes examples one by one and gives closed sequences, each a list of pieces.

    ``room`` is the number of examples held; their vectors lie in one array, a free slot is a vector
    that fits nowhere.
    """

    def __init__(self, limits: Limits, room: int = HELD) -> None:
        self.limits = limits
        self.most = np.array([limits.tokens, limits.segments, limits.loss], np.float64)
        self.free = self.most + 1
        self.vectors = np.tile(self.free, (room, 1))
        self.held: list[Example | None] = [None] * room
        self.slots = list(range(room))[::-1]

    def add(self, example: Example) -> Iterator[list[Piece]]:
        """Hold an example; what no single sequence could take is cut off its front first."""
        while example.longest(self.limits.tokens, self.limits.loss) < example.end - example.start:
            yield from self.closed([self.cut(example, self.limits.tokens, self.limits.loss)])
        if not self.slots:
            yield from self.closed(self.fill())
        slot = self.slots.pop()
        self.held[slot] = example
        self.vectors[slot] = example.end - example.start, 1, example.loss(example.end - example.start)

    def finish(self) -> Iterator[list[Piece]]:
        while len(self.slots) < len(self.held):
            yield from self.closed(self.fill())

    def cut(self, example: Example, tokens: int, loss: int) -> Piece:
        length = example.longest(tokens, loss)
        piece = (example.key, example.start, length, example.loss(length))
        example.start += length
        return piece

    def fill(self) -> list[Piece]:
        """Pieces of one sequence: of the examples that fit, always the one with the largest dot product
        of its vector and the room left, each dimension weighted by the mean demand of those held.

        Room that no example fits is filled by the front of the one with the largest product.
        """
        taken = np.array([e is not None for e in self.held])
        weights = self.vectors[taken].mean(0) / self.most**3
        left, pieces = self.most.copy(), []
        while True:
            products = self.vectors @ (weights * left)
            fits = (self.vectors <= left).all(1)
            if not fits.any():
                break
            slot = int(np.argmax(np.where(fits, products, -1.0)))
            example = self.held[slot]
            left -= self.vectors[slot]
            pieces.append(self.cut(example, self.limits.tokens, self.limits.loss))
            self.held[slot] = None
            self.vectors[slot] = self.free
            self.slots.append(slot)
        if self.limits.cut and left[0] > 0 and left[1] > 0 and len(self.slots) < len(self.held):
            taken = np.array([e is not None for e in self.held])
            slot = int(np.argmax(np.where(taken, products, -1.0)))
            example = self.held[slot]
            if example.longest(int(left[0]), int(left[2])):
                pieces.append(self.cut(example, int(left[0]), int(left[2])))
                self.vectors[slot] = example.end - example.start, 1, example.loss(example.end - example.start)
        return pieces

    def closed(self, pieces: list[Piece]) -> Iterator[list[Piece]]:
        """The pieces as one sequence, or as several whose lengths are powers of two if that saves padding."""
        length = sum(p[2] for p in pieces)
        if not self.limits.cut or length == self.limits.tokens or length & (length - 1) == 0:
            yield pieces
            return
        rest = pieces[::-1]
        for bit in range(length.bit_length() - 1, -1, -1):
            room, own = length & 1 << bit, []
            while room:
                key, start, size, loss = rest.pop()
                if size > room:
                    # Loss-bearing ids are the last ones of a piece.
                    front = max(0, loss - (size - room))
                    rest.append((key, start + room, size - room, loss - front))
                    size, loss = room, front
                own.append((key, start, size, loss))
                room -= size
            if own:
                yield own


def pack(docs: DataFrame, tokenizer_path: str, limits: Limits = Limits(), prompt: str | None = None) -> DataFrame:
    """One row per piece of each row of ``docs`` (``doc_id``, ``text`` and, if named, a prompt column).

    An example is the ids of the prompt, which bear no loss, those of the text and the end id.
    ``ids`` are the piece's ids as little-endian unsigned 32-bit integers, ``start`` the example's ids
    before it, ``offset`` its place in its sequence, from 0 without gaps.  With ``limits.cut`` every
    sequence is full or a power of two long, so padding it to either needs nothing; without, only
    examples that no sequence could take are cut.

    A null or empty text is the end id alone.  Null ids and repeated rows are packed like any other
    row, an empty table gives none, other columns are not looked at.  A text is held whole by its
    task, whatever its length.  Numbers of sequences name the partition of ``docs`` and are the same on
    every run over the same partitions.
    """

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = WordEncoder(tokenizer_path)
        packer, sequence, rows = Packer(limits), TaskContext.get().partitionId() << LOCAL_BITS, []
        # Of each example not placed whole: id, ids, and how many of them are placed.
        open_: dict[int, list] = {}

        def placed(sequences: Iterator[list[Piece]]) -> Iterator[pa.RecordBatch]:
            nonlocal sequence, rows
            for own in sequences:
                offset = 0
                for key, start, length, loss in own:
                    doc_id, ids, done = open_[key]
                    rows.append((doc_id, start, length, ids[start : start + length].tobytes(), len(ids), loss, sequence, offset))
                    open_[key][2] = done + length
                    if done + length == len(ids):
                        del open_[key]
                    offset += length
                sequence += 1
                if len(rows) >= ROWS_OUT:
                    yield _batch(rows)
                    rows = []

        key = 0
        for batch in in_batches(batches):
            texts = encoder.runs(batch.column("text"))
            ends, sizes = texts.ends.tolist(), texts.sizes.tolist()
            before = list(encoder.encode(batch.column("prompt"))) if prompt else None
            for n, doc_id in enumerate(batch.column("doc_id").to_pylist()):
                first = np.frombuffer(before[n], encoder.id_type) if before else np.empty(0, encoder.id_type)
                ids = np.concatenate([first, texts.flat[ends[n] - sizes[n] : ends[n]], [END_ID]]).astype("<u4")
                open_[key] = [doc_id, ids, 0]
                yield from placed(packer.add(Example(key, 0, len(ids), len(first))))
                key += 1
        yield from placed(packer.finish())
        if rows:
            yield _batch(rows)

    columns = [F.col("doc_id").cast("long").alias("doc_id"), F.col("text")]
    if prompt:
        columns.append(F.col(prompt).alias(fresh_name(docs.select("doc_id", "text"), "prompt")))
    return docs.select(*columns).mapInArrow(pieces, SCHEMA)


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    names, kinds = zip(*(f.split() for f in SCHEMA.split(", ")))
    types = [pa.binary() if kind == "binary" else pa.int64() for kind in kinds]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], list(names))
