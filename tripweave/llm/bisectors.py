"""Clustering around centroids by a tournament of bisectors.

Vectors and centroids are whole numbers. For centroids a < b the bisector has the normal
2 * (c_b - c_a) and the threshold |c_b|^2 - |c_a|^2, worked out once a round for all pairs:
a vector x is nearer to b if x * normal > threshold, and a zero keeps a, the smaller number.
k - 1 such tests leave one centroid of k: neighbours in number meet first, so the smaller
number is always on the same side of a test, and all rows share the first half of the tests,
which is one product of matrices. The distance is worked out for the last one left only.
Everything is exact: doubles are used while all products are below 2**53, then 64-bit
integers, then Python's.

Each round is one pass over the stored vectors. Tasks add up their rows by centroid, so the
shuffle carries k * (d + 1) totals a task, and the driver gets k * (d + 1) of them, however
many vectors there are and however many fall to one centroid. The normals take k * k * d
numbers in each task: k is meant to be some hundreds at most.

Vectors that are null, hold null or non-finite entries, or have another number of
components are left out. Repeated rows each count. Seeds with equal hashes (repeated or null
ids; a null id is hashed as an empty text) come by their components. With fewer vectors than
k there are as many centroids as vectors; an empty table gives an empty result. Distances
beyond a 64-bit integer raise an error. Other columns are neither read nor passed on.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tripweave.llm.common import stored
from tripweave.llm.vectors import blocks, exact_sum, largest, scaled, total_rows, totals, usable

CENTROIDS = 40
DIMENSIONS = 64
ROUNDS = 5


class Tournament:
    """Normals and thresholds of all pairs of centroids."""

    def __init__(self, centroids: list[list[int]]):
        self.k, self.size = len(centroids), max((abs(c) for row in centroids for c in row), default=0)
        self.d = len(centroids[0]) if centroids else 0
        wide = self.size**2 * self.d >= 1 << 60
        self.centroids = c = np.array(centroids, object if wide else np.int64).reshape(self.k, self.d)
        self.normals = 2 * (c[None, :, :] - c[:, None, :])
        norms = (c * c).sum(axis=1)
        self.thresholds = norms[None, :] - norms[:, None]
        self.fast = None if wide else (self.normals.astype(float), self.thresholds.astype(float))

    def _tables(self, x: np.ndarray):
        """The rows and the tables in the smallest type that keeps all sums exact."""
        bound = self.d * (largest(x) * 4 * self.size + self.size**2)
        if bound < 1 << 53 and self.fast:
            return x.astype(float), *self.fast
        if bound < 1 << 62 and self.fast:
            return x, self.normals, self.thresholds
        return x.astype(object), self.normals.astype(object), self.thresholds.astype(object)

    def winners(self, x: np.ndarray) -> np.ndarray:
        """The number of the nearest centroid of each row; of equally near ones the smallest."""
        x, normals, thresholds = self._tables(x)
        every = np.arange(self.k)
        first, second = every[0 : self.k - 1 : 2], every[1::2]
        beaten = x @ normals[first, second].T > thresholds[first, second]
        left = [np.where(beaten[:, i], second[i], first[i]) for i in range(len(first))]
        if self.k % 2:
            left.append(np.full(len(x), self.k - 1))
        while len(left) > 1:
            onward = []
            for a, b in zip(left[0::2], left[1::2], strict=False):
                side = (x * normals[a, b]).sum(axis=1) if x.dtype == object else np.einsum("ij,ij->i", x, normals[a, b])
                onward.append(np.where(side > thresholds[a, b], b, a))
            left = [*onward, *left[len(left) - len(left) % 2 :]]
        return left[0]

    def distances(self, x: np.ndarray, winner: np.ndarray) -> np.ndarray:
        """Squared distances to the winners, exactly."""
        wide = self.d * (largest(x) + self.size) ** 2 >= 1 << 62
        gap = (x.astype(object) if wide else x) - self.centroids[winner]
        return (gap * gap).sum(axis=1)


def seeds(vectors: DataFrame, k: int, salt: str = "2:") -> list[list[int]]:
    """The k vectors with the smallest SHA-256 of ``salt`` and id, in the order of the hashes."""
    text = F.concat(F.lit(salt), F.coalesce(F.col("key").cast("string"), F.lit("")))
    return [r.x for r in vectors.select("x", F.sha2(text, 256).alias("hash")).orderBy("hash", "x").limit(k).collect()]


def moved(vectors: DataFrame, centroids: list[list[int]]) -> list[list[int]]:
    """One round: each centroid becomes the floor of the mean of the vectors nearest to it."""
    contest = Tournament(centroids)

    def run(batches):
        found: dict[tuple, int] = {}
        for _, x in blocks(batches, 0):
            winner = contest.winners(x)
            for c in np.unique(winner).tolist():
                mine = x[winner == c]
                for i, total in enumerate([*exact_sum(mine), len(mine)]):
                    found[c, i] = found.get((c, i), 0) + total
        yield from total_rows(found, ["cluster", "i"])

    kind = "cluster int, i int, high decimal(38,0), low decimal(38,0)"
    summed = totals(vectors.select("x").mapInArrow(run, kind), "cluster", "i")
    d = contest.d
    return [
        [summed[c, i] // summed[c, d] for i in range(d)] if (c, d) in summed else old for c, old in enumerate(centroids)
    ]


def cluster(
    vectors: DataFrame,
    key: str = "vec_id",
    column: str = "embedding",
    k: int = CENTROIDS,
    rounds: int = ROUNDS,
    dimensions: int = DIMENSIONS,
) -> DataFrame:
    """key, cluster, distance, cluster_inertia, inertia, centroid_sha256: a row for each kept vector."""
    kept = vectors.where(usable(column) & (F.size(column) == dimensions))
    rows = stored(kept.select(F.col(key).alias("key"), scaled(column).alias("x")), "bisector-vectors")
    centroids = seeds(rows, k)
    for _ in range(rounds if centroids else 0):
        centroids = moved(rows, centroids)
    contest = Tournament(centroids)

    def run(batches):
        for part, x in blocks(batches, 1):
            winner = contest.winners(x)
            columns = [part.column(0), pa.array(winner.astype(np.int32)), pa.array(contest.distances(x, winner), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "cluster", "distance"])

    kind = dict(rows.dtypes)["key"]
    placed = stored(rows.mapInArrow(run, f"key {kind}, cluster int, distance long"), "bisector-placed")
    inertia = {r.cluster: int(r.s) for r in placed.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(38,0)")).alias("s")).collect()}
    facts = [
        (c, total, sum(inertia.values()), hashlib.sha256(",".join(map(str, centroids[c])).encode()).hexdigest())
        for c, total in sorted(inertia.items())
    ]
    # at most k rows
    small = rows.sparkSession.createDataFrame(facts, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    joined = placed.join(F.broadcast(small), "cluster")
    return joined.select(F.col("key").alias(key), "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
