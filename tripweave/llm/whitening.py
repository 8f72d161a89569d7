"""Whitening of embeddings by polarisation.

Entries become whole numbers x = floor(256 * c). The fit list holds each distinct vector
once: n of them, with sums S per dimension. With y = n * x - S, which is exact, the job adds
up y_i ** 2 for every dimension and (y_i + y_j) ** 2 for every sum of two dimensions. The
difference of these variances is the covariance:

    2 * n**3 * V_ij = sum (y_i + y_j)**2 - sum y_i**2 - sum y_j**2

All of it is integer arithmetic (limbs of 24 bits in tasks, decimals between them), so V is
rounded once. What reaches the driver are the d * (d + 1) / 2 totals; d is the length of
the vectors and bounds them, whatever the number of rows. ``eigh`` runs there.

Vectors that are null or hold null or non-finite entries are left out. Vectors of different
lengths are different spaces: each length has a fit list, a mean and components of its own
(at most as many as there are lengths). Repeated rows and rows without an id each get their
own result; equal vectors get equal results. A component along which the fit list does not
vary cannot be scaled to one: it is left out, so a table with one vector only, with empty
vectors, or without rows gives no rows. Deviations of more than 38 digits raise an error.
Other columns are neither read nor passed on.
"""

from __future__ import annotations

from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tripweave.llm.common import stored
from tripweave.llm.vectors import LIMB, blocks, exact_sum, largest, limbs, scaled, total_rows, totals, usable

COMPONENTS = 4
EPSILON = float(np.finfo(float).eps)


@dataclass(frozen=True)
class Space:
    """The fit of the vectors of one length; ``axes`` are the kept components as columns."""

    n: int
    sums: list[int]
    axes: np.ndarray
    values: np.ndarray  # eigenvalues of the kept components
    trace: float


def centred(x: np.ndarray, n: int, sums: list[int]) -> np.ndarray:
    """n * x - S, exactly: int64 where that holds it, else Python integers."""
    if n * largest(x) + max(map(abs, sums), default=0) < 1 << 62:
        return x * n - np.asarray(sums, np.int64)
    return x.astype(object) * n - np.asarray(sums, object)


def squares(y: np.ndarray) -> dict[tuple[int, int], int]:
    """Sums over the rows of y_i ** 2 as (i, i) and of (y_i + y_j) ** 2 as (i, j), i < j."""
    parts, found = limbs(y), {}

    def add(i: int, js: range, terms: list[np.ndarray]) -> None:
        whole = [0] * len(js)
        for a in range(len(terms)):
            for b in range(a, len(terms)):
                shift = (a + b) * LIMB + (a < b)
                for k, v in enumerate(np.einsum("ij,ij->j", terms[a], terms[b]).tolist()):
                    whole[k] += v << shift
        found.update({(j if i < 0 else i, j): v for j, v in zip(js, whole, strict=True)})

    d = y.shape[1]
    add(-1, range(d), parts)
    for i in range(d - 1):
        add(i, range(i + 1, d), [p[:, i : i + 1] + p[:, i + 1 :] for p in parts])
    return found


def merged(into: dict, more: dict) -> None:
    for key, total in more.items():
        into[key] = into.get(key, 0) + total


def _sums(batches):
    found: dict[tuple, int] = {}
    for _, x in blocks(batches, 0):
        d = x.shape[1]
        merged(found, {(d, -1): len(x), **{(d, i): s for i, s in enumerate(exact_sum(x))}})
    yield from total_rows(found, ["d", "i"])


def covariance(spread: dict[tuple[int, int], int], n: int, d: int) -> np.ndarray:
    v = np.empty((d, d))
    for i in range(d):
        v[i, i] = spread[i, i] / n**3
        for j in range(i + 1, d):
            v[i, j] = v[j, i] = (spread[i, j] - spread[i, i] - spread[j, j]) / (2 * n**3)
    return v


def fit(fit_list: DataFrame, components: int = COMPONENTS) -> dict[int, Space]:
    """The spaces of a table of distinct vectors ``x``, by their length."""
    summed = totals(fit_list.mapInArrow(_sums, "d int, i int, high decimal(38,0), low decimal(38,0)"), "d", "i")
    means = {d: (n, [summed[d, i] for i in range(d)]) for (d, i), n in summed.items() if i < 0 and d}

    def spreads(batches):
        found: dict[tuple, int] = {}
        for _, x in blocks(batches, 0):
            if d := x.shape[1]:
                merged(found, {(d, *pair): v for pair, v in squares(centred(x, *means[d])).items()})
        yield from total_rows(found, ["d", "i", "j"])

    kind = "d int, i int, j int, high decimal(38,0), low decimal(38,0)"
    spread = totals(fit_list.mapInArrow(spreads, kind), "d", "i", "j")
    spaces = {}
    for d, (n, sums) in means.items():
        values, axes = np.linalg.eigh(covariance({(i, j): v for (e, i, j), v in spread.items() if e == d}, n, d))
        order = np.argsort(-values, kind="stable")[:components]
        order = order[values[order] > d * EPSILON * max(values.max(), 0.0)]
        trace = sum(spread[d, i, i] for i in range(d)) / n**3
        spaces[d] = Space(n, sums, axes[:, order], values[order], trace)
    return spaces


def project(x: np.ndarray, space: Space) -> tuple[np.ndarray, np.ndarray]:
    """The centred integers of the rows and their whitened components."""
    y = centred(x, space.n, space.sums)
    return y, (y / space.n).astype(float) @ space.axes / np.sqrt(space.values)


def identity_error(fit_list: DataFrame, spaces: dict[int, Space]) -> float:
    """Largest absolute entry of (covariance of the whitened fit list - identity)."""

    def run(batches):
        for _, x in blocks(batches, 0):
            if (d := x.shape[1]) in spaces:
                w = project(x, spaces[d])[1]
                yield pa.RecordBatch.from_arrays([pa.array([d] * len(w), pa.int32()), pa.array(list(w), pa.list_(pa.float64()))], names=["d", "w"])

    most = max((len(s.values) for s in spaces.values()), default=0)
    pairs = [(a, b) for a in range(most) for b in range(a, most)]
    if not pairs:
        return 0.0
    rows = fit_list.mapInArrow(run, "d int, w array<double>").groupBy("d")
    found = rows.agg(*[F.covar_pop(F.get("w", F.lit(a)), F.get("w", F.lit(b))).alias(f"v{a}_{b}") for a, b in pairs])
    return max(
        abs(r[f"v{a}_{b}"] - (a == b)) for r in found.collect() for a, b in pairs if b < len(spaces[r.d].values)
    )


def _deviations(y: np.ndarray) -> pa.Array:
    """Sums of squares of the rows, exactly."""
    if largest(y) ** 2 * y.shape[1] < 1 << 62:
        return pa.array(np.einsum("ij,ij->i", y, y)).cast(pa.decimal128(38, 0))
    return pa.array([Decimal(int(v)) for v in (y.astype(object) ** 2).sum(axis=1)], pa.decimal128(38, 0))


def whiten(vectors: DataFrame, key: str = "vec_id", column: str = "embedding", components: int = COMPONENTS) -> DataFrame:
    """key, component, n, deviation (decimal(38)), whitened, explained, identity_error: a row
    for each usable vector and component."""
    rows = vectors.where(usable(column)).select(F.col(key).alias("key"), scaled(column).alias("x"))
    fit_list = stored(rows.select("x").distinct(), "whitening-fit")
    spaces = fit(fit_list, components)
    error = identity_error(fit_list, spaces)
    kind = dict(rows.dtypes)["key"]

    def run(batches):
        for part, x in blocks(batches, 1):
            space = spaces.get(x.shape[1])
            if space is None:
                continue
            y, w = project(x, space)
            deviation = _deviations(y)
            for c in range(w.shape[1]):
                m = len(w)
                columns = [
                    part.column(0),
                    pa.array(np.full(m, c + 1, np.int32)),
                    pa.array(np.full(m, space.n, np.int64)),
                    deviation,
                    pa.array(np.ascontiguousarray(w[:, c])),
                    pa.array(np.full(m, space.values[c] / space.trace)),
                    pa.array(np.full(m, error)),
                ]
                names = ["key", "component", "n", "deviation", "whitened", "explained", "identity_error"]
                yield pa.RecordBatch.from_arrays(columns, names=names)

    schema = f"key {kind}, component int, n long, deviation decimal(38,0), whitened double, explained double, identity_error double"
    return rows.mapInArrow(run, schema).withColumnRenamed("key", key)
