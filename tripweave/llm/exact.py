"""Exact deduplication by Grace hashing.

Texts are equal when they are identical after all ASCII white space is deleted. A task
first finds equal texts among the rows of a batch, so that a text which fills a third of
the table crosses the network once per batch and not once per row. Those distinct texts
are dealt out by hash; each task then puts them into an open-addressing table that
compares complete contents. When the table has reached its share of memory, rows whose
content it does not hold go to spill files by further bits of their hash, and each file
is worked through in the same way with a fresh table. A pass always empties into its table
at least one full share, so the recursion ends whatever the hashes are. A content in the table holds
the best of its rows and their number, so a text may come in any number of batches. A single
very long text is one entry, and as such may exceed the share alone.

Null texts count as empty, and all empty texts are equal. Of equal texts the one with the
most code points in the original stays, then the smallest id (null ids last), then the
first in file order; so of repeated rows exactly one stays. A table without rows gives
none.
"""

from __future__ import annotations

import hashlib
import pickle
import tempfile
from collections.abc import Iterable, Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_type

from tripweave.llm.common import row_numbers, slices, stored, utf8

WHITE = b" \t\n\r\x0b\x0c"
TABLE_BYTES = 48 << 20
FAN_OUT = 16
OUT_ROWS = 20_000
MEMBERS = 50_000


class ContentTable:
    """Open addressing with linear probing; equal means equal in every byte."""

    def __init__(self, slots: int = 1 << 10):
        self.slots = np.full(slots, -1, np.int64)
        self.hashes: list[int] = []
        self.contents: list[bytes] = []
        self.size = 0

    def find(self, code: int, content: bytes) -> tuple[int, int]:
        """(entry or -1, slot where the probe ended)."""
        mask = len(self.slots) - 1
        at = code & mask
        while (entry := int(self.slots[at])) >= 0:
            if self.hashes[entry] == code and self.contents[entry] == content:
                return entry, at
            at = (at + 1) & mask
        return -1, at

    def add(self, code: int, content: bytes, at: int) -> int:
        entry = len(self.contents)
        self.slots[at] = entry
        self.hashes.append(code)
        self.contents.append(content)
        self.size += len(content) + 120
        if 2 * len(self.contents) > len(self.slots):
            self._grow()
        return entry

    def _grow(self) -> None:
        self.slots = np.full(2 * len(self.slots), -1, np.int64)
        mask = len(self.slots) - 1
        for entry, code in enumerate(self.hashes):
            at = code & mask
            while self.slots[at] >= 0:
                at = (at + 1) & mask
            self.slots[at] = entry


def grace_classes(rows: Iterable[tuple[bytes, bytes, int, tuple, int]], budget: int = TABLE_BYTES, level: int = 0) -> Iterator[tuple[int, tuple, int]]:
    """(digest, content, member, rank, n) -> (member, least rank of its content, sum of n).

    A content holds one rank and one sum, however many members it has; members wait in
    memory up to ``MEMBERS`` of them, then in a spill file."""
    table, best, total, files = ContentTable(), [], [], {}
    members: list[tuple[int, int]] = []
    with tempfile.TemporaryFile(prefix="grace-") as waiting:
        for digest, content, member, rank, n in rows:
            code = int.from_bytes(digest[:8], "little") >> 1
            entry, at = table.find(code, content)
            if entry >= 0:
                best[entry] = min(best[entry], rank)
                total[entry] += n
            elif table.size < budget or not table.contents:
                entry = table.add(code, content, at)
                best.append(rank)
                total.append(n)
            else:
                bucket = digest[8 + level % 24] % FAN_OUT
                if bucket not in files:
                    files[bucket] = tempfile.TemporaryFile(prefix="grace-")
                pickle.dump((digest, content, member, rank, n), files[bucket], pickle.HIGHEST_PROTOCOL)
                continue
            members.append((entry, member))
            if len(members) >= MEMBERS:
                pickle.dump(members, waiting, pickle.HIGHEST_PROTOCOL)
                members = []
        del table
        for some in chain(_spilled(waiting), [members]):
            yield from ((member, best[entry], total[entry]) for entry, member in some)
    del best, total, members
    for file in files.values():
        with file:
            yield from grace_classes(_spilled(file), budget, level + 1)


def _spilled(file) -> Iterator[tuple]:
    file.seek(0)
    while True:
        try:
            yield pickle.load(file)
        except EOFError:
            return


def normal(text: bytes) -> bytes:
    return text.translate(None, WHITE)


DIGESTS = "row long, id {kind}, n_chars long, digest binary, first long, content binary, best_chars long, best_id {kind}, best_row long, n long"


def _rank(chars: int, key, row: int) -> tuple:
    return (-chars, key is None, key if key is not None else 0, row)


def digests(docs: DataFrame, key: str, text: str, row: str | None = None) -> DataFrame:
    """One row per document with its digest; the first row of each distinct text of a batch
    also carries the content, how many rows of the batch have it and the best of them.
    ``row``: a column of unique numbers for the rows; without it they are counted."""
    kind = dict(docs.dtypes)[key]
    schema = DIGESTS.format(kind=kind)

    def run(batches):
        numbers = row_numbers()
        for batch in slices(batches, 1):
            keys = batch.column(0).to_pylist()
            own = batch.column(2).to_pylist() if row else None
            chars = pc.fill_null(pc.utf8_length(batch.column(1)), 0).to_pylist()
            found: dict[bytes, list] = {}
            rows = []
            for i, (k, n, raw) in enumerate(zip(keys, chars, utf8(batch.column(1)), strict=True)):
                number, content = own[i] if own else next(numbers), normal(raw)
                group = found.get(content)
                if group is None:
                    digest = hashlib.sha256(content).digest()
                    found[content] = group = [len(rows), (n, k, number), 0, number, digest]
                    rows.append([number, k, n, digest, number, content, None, None, None, None])
                else:
                    rows.append([number, k, n, group[4], group[3], None, None, None, None, None])
                    if _rank(n, k, number) < _rank(*group[1]):
                        group[1] = (n, k, number)
                group[2] += 1
            for at, best, n, _, _ in found.values():
                rows[at][6:] = [*best, n]
            kt, i64 = batch.schema.field(0).type, pa.int64()
            kinds = [i64, kt, i64, pa.binary(), i64, pa.binary(), i64, kt, i64, i64]
            names = [x.split()[0] for x in schema.split(", ")]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    return docs.select(key, text, *([row] if row else [])).mapInArrow(run, schema)


def exact_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", budget: int = TABLE_BYTES, row: str | None = None) -> DataFrame:
    """key, keep_id, keep_row, row, group_size, n_chars, digest, kept: one row per document."""
    kind = dict(docs.dtypes)[key]
    every = stored(digests(docs, key, text, row), "exact-digests")
    firsts = every.where("n is not null").select("digest", "content", "first", "best_chars", "best_id", "best_row", "n")

    def grouped(batches):
        def rows():
            for batch in slices(batches, 1):
                for digest, content, first, chars, best, number, n in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                    yield digest, content, first, _rank(chars, best, number), n

        out: list[tuple] = []
        for first, (_, null, best, number), size in grace_classes(rows(), budget):
            out.append((first, None if null else best, number, size))
            if len(out) >= OUT_ROWS:
                yield _table(out)
                out = []
        if out:
            yield _table(out)

    key_type = to_arrow_type(docs.schema[key].dataType)

    def _table(out):
        kinds = [pa.int64(), key_type, pa.int64(), pa.int64()]
        arrays = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
        return pa.RecordBatch.from_arrays(arrays, names=["first", "keep_id", "keep_row", "group_size"])

    classes = firsts.repartition("digest").mapInArrow(grouped, f"first long, keep_id {kind}, keep_row long, group_size long")
    # a batch's first row stands for no more rows than a batch has: no hot key here
    joined = every.select("row", F.col("id").alias(key), "n_chars", "digest", "first").join(classes, "first")
    return joined.drop("first").withColumn("kept", F.col("row") == F.col("keep_row"))


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    row = next(name for i in range(len(docs.columns) + 1) if (name := f"row_{i}") not in docs.columns)
    numbered = stored(docs.withColumn(row, F.monotonically_increasing_id()), "exact-rows")
    kept = exact_dedup(numbered, key, text, row=row).where("kept").select(F.col("row").alias(row))
    return numbered.join(kept, row, "left_semi").drop(row)
