"""Vectors as whole numbers: the scaled entries, blocks of equal length, exact totals."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

SCALE = 256
ROWS = 4096  # of one block
LIMB = 24  # bits; 4096 products of two sums of limbs stay below 2**63
PART = 10**30  # totals travel as high * PART + low, both within decimal(38)


def usable(column: str) -> Column:
    """The vector is there and all its entries are finite numbers."""
    finite = lambda c: c.isNotNull() & ~F.isnan(c) & (F.abs(c) != float("inf"))
    return F.coalesce(F.forall(F.col(column).cast("array<double>"), finite), F.lit(False))


def scaled(column: str, scale: int = SCALE) -> Column:
    """floor(scale * entry) as longs; what a long cannot hold becomes its end of the range."""
    return F.transform(F.col(column).cast("array<double>"), lambda c: F.floor(c * F.lit(float(scale))).cast("long"))


def blocks(batches: Iterable[pa.RecordBatch], column: int, rows: int = ROWS) -> Iterator[tuple[pa.RecordBatch, np.ndarray]]:
    """Parts of the batches whose vectors have one length, each with its (rows, length) matrix."""
    for whole in batches:
        for start in range(0, whole.num_rows, rows):
            batch = whole.slice(start, rows)
            lengths = batch.column(column).value_lengths().to_numpy(zero_copy_only=False)
            for length in np.unique(lengths).tolist():
                same = lengths == length
                part = batch if same.all() else batch.filter(pa.array(same))
                values = part.column(column).flatten().to_numpy(zero_copy_only=False)
                yield part, values.reshape(part.num_rows, length)


def largest(values: np.ndarray) -> int:
    return max(abs(int(values.max())), abs(int(values.min()))) if values.size else 0


def exact_sum(values: np.ndarray) -> list[int]:
    """Column sums as Python integers."""
    if largest(values) * max(1, len(values)) >= 1 << 62:
        values = values.astype(object)
    return [int(v) for v in values.sum(axis=0)] if len(values) else [0] * values.shape[1]


def limbs(values: np.ndarray) -> list[np.ndarray]:
    """Signed whole numbers in base 2**LIMB, lowest first, as int64; the last one has the sign."""
    parts, mask = [], (1 << LIMB) - 1
    while largest(values) > mask:
        parts.append((values & mask).astype(np.int64))
        values = values >> LIMB
    return [*parts, values.astype(np.int64)]


def in_parts(total: int) -> tuple[Decimal, Decimal]:
    high, low = divmod(total, PART)
    return Decimal(high), Decimal(low)


def totals(rows: DataFrame, *keys: str) -> dict[tuple, int]:
    """Exact sums of columns (high, low) by key, on the driver: callers bound the keys."""
    summed = rows.groupBy(*keys).agg(F.sum("high").alias("high"), F.sum("low").alias("low"))
    return {tuple(r[k] for k in keys): int(r.high) * PART + int(r.low) for r in summed.collect()}


def total_rows(found: dict[tuple, int], names: list[str]) -> Iterator[pa.RecordBatch]:
    """One batch (keys..., high, low) of a task's totals."""
    if found:
        kinds = [*(pa.int32() for _ in names), pa.decimal128(38), pa.decimal128(38)]
        rows = [(*key, *in_parts(total)) for key, total in found.items()]
        columns = [pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)]
        yield pa.RecordBatch.from_arrays(columns, names=[*names, "high", "low"])
