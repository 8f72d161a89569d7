"""Packing by vector bins: the dot-product heuristic.

Every item has a demand on several limits at once: tokens, segments and loss-bearing
tokens. Of the open bins that can take an item whole, it goes to the one whose free room
is most alike to its demand, by the dot product of both as shares of the limits. Items
larger than a bin are cut into full bins first. An item that no open bin can take whole
fills up the fullest bin that has room and goes on with the rest; cuts are free.

A bin is closed when it is full or no more segments or loss tokens fit. Sequences are
padded to the token limit, unless their length is a power of two; so a closed bin that is
not full is dealt out over powers of two, which needs no padding at all.

Each task packs the rows it reads: no shuffle, one bounded set of open bins per task, and
a run that is repeated gives the same sequences. Ids are told apart by partition number.

Null texts count as empty; they still have their end token. Repeated rows are packed as
often as they come. A table without rows gives no pieces.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tripweave.llm.bpe import coder, half_encoded, ids_of, vocabulary_path
from tripweave.llm.common import row_numbers, slices

TOKENS = 4096
SEGMENTS = 64
OPEN = 32
END_ID = 2


@dataclass
class Limits:
    """What one sequence may hold."""

    tokens: int = TOKENS
    segments: int = SEGMENTS
    loss_tokens: int = TOKENS


@dataclass
class Piece:
    """A stretch of one item: tokens [start, start + length), ``loss`` of which bear loss."""

    item: int
    start: int
    length: int
    loss: int


@dataclass
class Bin:
    pieces: list[Piece] = field(default_factory=list)
    tokens: int = 0
    loss: int = 0

    def add(self, piece: Piece) -> None:
        self.pieces.append(piece)
        self.tokens += piece.length
        self.loss += piece.loss


def powers_of_two(n: int) -> Iterator[int]:
    for k in range(n.bit_length() - 1, -1, -1):
        if n >> k & 1:
            yield 1 << k


def dealt_out(pieces: list[Piece], prefix_loss, sizes: Iterable[int]) -> Iterator[list[Piece]]:
    """The pieces in order, cut into runs of the given sizes."""
    rest, sizes = pieces[::-1], list(sizes)
    for size in sizes:
        run, room = [], size
        while room:
            piece = rest.pop()
            if piece.length > room:
                loss = prefix_loss(piece.item, piece.start, room)
                rest.append(Piece(piece.item, piece.start + room, piece.length - room, piece.loss - loss))
                piece = Piece(piece.item, piece.start, room, loss)
            run.append(piece)
            room -= piece.length
        yield run


class VectorPacker:
    """Packs items one after another; ``prefix_loss(item, start, n)`` counts the
    loss-bearing ones of an item's ``n`` tokens from ``start`` on."""

    def __init__(self, limits: Limits, prefix_loss, open_bins: int = OPEN):
        self.limits, self.prefix_loss, self.open_bins = limits, prefix_loss, open_bins
        self.bins: list[Bin] = []

    def _free(self, b: Bin) -> tuple[int, int, int]:
        return self.limits.tokens - b.tokens, self.limits.segments - len(b.pieces), self.limits.loss_tokens - b.loss

    def _close(self, b: Bin) -> Iterator[list[Piece]]:
        if b.tokens == self.limits.tokens:
            yield b.pieces
        elif b.tokens:
            yield from dealt_out(b.pieces, self.prefix_loss, powers_of_two(b.tokens))

    def _fitting(self, item: int, start: int, most: int, loss_room: int) -> int:
        """The longest stretch of at most ``most`` tokens within the loss limit."""
        if self.prefix_loss(item, start, most) <= loss_room:
            return most
        low, high = 0, most
        while low < high:
            middle = (low + high + 1) // 2
            low, high = (middle, high) if self.prefix_loss(item, start, middle) <= loss_room else (low, middle - 1)
        return low

    def add(self, item: int, length: int) -> Iterator[list[Piece]]:
        start = 0
        while start < length:
            most = self._fitting(item, start, min(length - start, self.limits.tokens), self.limits.loss_tokens)
            piece = Piece(item, start, most, self.prefix_loss(item, start, most))
            if most == self.limits.tokens:
                yield [piece]
                start += most
                continue
            best, target = -1.0, None
            for b in self.bins:
                room = self._free(b)
                if piece.length <= room[0] and room[1] >= 1 and piece.loss <= room[2]:
                    alike = self._alike(piece, room)
                    if alike > best:
                        best, target = alike, b
            if target is None and len(self.bins) >= self.open_bins:
                # fill the fullest bin with a part of the item
                target = max(self.bins, key=lambda b: b.tokens)
                room = self._free(target)
                most = self._fitting(item, start, min(room[0], piece.length), room[2]) if room[1] else 0
                if not most:
                    self.bins.remove(target)
                    yield from self._close(target)
                    continue
                piece = Piece(item, start, most, self.prefix_loss(item, start, most))
            elif target is None:
                target = Bin()
                self.bins.append(target)
            target.add(piece)
            start += piece.length
            if min(self._free(target)) == 0:
                self.bins.remove(target)
                yield from self._close(target)

    def _alike(self, piece: Piece, room: tuple[int, int, int]) -> float:
        full = self.limits
        return (
            piece.length / full.tokens * (room[0] / full.tokens)
            + 1 / full.segments * (room[1] / full.segments)
            + piece.loss / full.loss_tokens * (room[2] / full.loss_tokens)
        )

    def flush(self) -> Iterator[list[Piece]]:
        """What is left: bins are poured together as far as the limits go."""
        current = Bin()
        for b in sorted(self.bins, key=lambda b: -b.tokens):
            for piece in b.pieces:
                while piece.length:
                    room = self._free(current)
                    most = self._fitting(piece.item, piece.start, min(room[0], piece.length), room[2]) if room[1] else 0
                    if not most:
                        yield from self._close(current)
                        current = Bin()
                        continue
                    loss = self.prefix_loss(piece.item, piece.start, most)
                    current.add(Piece(piece.item, piece.start, most, loss))
                    piece = Piece(piece.item, piece.start + most, piece.length - most, piece.loss - loss)
        self.bins = []
        yield from self._close(current)


PIECES = "doc_id {kind}, start long, length long, ids binary, doc_tokens long, loss_tokens long, sequence_id long, offset long"


def pack(encoded: DataFrame, key: str, end_id: int | None = END_ID, limits: Limits | None = None, loss: str | None = None, vocabulary: str | None = None) -> DataFrame:
    """key, ids (binary, 32-bit) -> one row per piece, its ids with it. Rows whose ids are
    null have a column text, which is encoded here by ``vocabulary``.

    ``loss``: a column with one byte per token, 1 where the token bears loss; without it
    all tokens do. ``end_id`` closes each item and always bears loss.
    """
    limits = limits or Limits()
    kind = dict(encoded.dtypes)[key]
    schema = PIECES.format(kind=kind)
    names = [x.split()[0] for x in schema.split(", ")]
    text = "text" if "text" in encoded.columns else F.lit(None).cast("string").alias("text")
    columns = [F.col(key).alias("key"), text, "ids", *([F.col(loss).alias("loss")] if loss else [])]
    path = vocabulary or vocabulary_path()
    tail = np.array([], "<u4") if end_id is None else np.array([end_id], "<u4")

    def run(batches):
        numbers = row_numbers()
        held: dict[int, tuple] = {}  # items that open bins may still hold a part of

        def prefix_loss(item: int, start: int, n: int) -> int:
            marks = held[item][2]
            return n if marks is None else int(marks[start + n] - marks[start])

        packer = VectorPacker(limits, prefix_loss)
        count = 0
        rows: list[tuple] = []

        def emit(run: list[Piece]) -> None:
            number, offset = next(numbers), 0
            for p in run:
                doc, ids, _, left = held[p.item]
                rows.append((doc, p.start, p.length, ids[p.start : p.start + p.length].tobytes(), len(ids), p.loss, number, offset))
                offset += p.length
                left -= p.length
                if left:
                    held[p.item] = (*held[p.item][:3], left)
                else:
                    del held[p.item]

        def batch_of_rows() -> pa.RecordBatch:
            kinds = [key_type, pa.int64(), pa.int64(), pa.binary(), pa.int64(), pa.int64(), pa.int64(), pa.int64()]
            done = pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)
            rows.clear()
            return done

        key_type = pa.int64()
        for batch in slices(batches, 1, 1 << 20):
            key_type = batch.column(0).type
            marks = batch.column(3).to_pylist() if loss else [None] * batch.num_rows
            known = ids_of(coder(path), batch.column(1), batch.column(2))
            for doc, raw, mark in zip(batch.column(0).to_pylist(), known, marks, strict=True):
                ids = np.concatenate([np.frombuffer(raw, "<u4"), tail])
                if not len(ids):
                    continue
                if loss:
                    bears = np.concatenate([np.frombuffer(mark or b"", "u1")[: len(ids)], np.ones(len(tail), "u1")])
                    mark = np.concatenate([[0], np.cumsum(bears.astype(np.int64))])
                held[count] = (doc, ids, mark, len(ids))
                for done in packer.add(count, len(ids)):
                    emit(done)
                count += 1
            if rows:
                yield batch_of_rows()
        for done in packer.flush():
            emit(done)
        if rows:
            yield batch_of_rows()

    return encoded.select(*columns).mapInArrow(run, schema).withColumnRenamed("doc_id", key)


def pack_texts(texts: DataFrame, key: str, text: str, vocabulary: str | None = None, limits: Limits | None = None) -> DataFrame:
    """Encode whole texts and pack them."""
    half = half_encoded(texts, key, text, vocabulary)
    return pack(half, "key", limits=limits, vocabulary=vocabulary).withColumnRenamed("key", key)


def with_crc32(pieces: DataFrame) -> DataFrame:
    """crc32 of each piece's ids, in place of the ids."""
    return pieces.withColumn("ids_crc32", F.crc32("ids")).drop("ids")


def crc32_of(ids) -> int:
    return zlib.crc32(np.asarray(ids, "<u4").tobytes())
