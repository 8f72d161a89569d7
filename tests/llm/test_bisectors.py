import hashlib
import math

import numpy as np
import pytest

from tripweave.llm import bisectors

NAN = float("nan")


def nearest(x, centroids):
    return min((sum((a - b) ** 2 for a, b in zip(x, c)), k) for k, c in enumerate(centroids))


@pytest.mark.parametrize("size", [3, 500, 1 << 24, 1 << 30])
@pytest.mark.parametrize("k", [1, 2, 3, 7, 40])
def test_tournament_finds_the_nearest(size, k):
    """Small entries make many ties; large ones leave doubles and 64-bit integers behind."""
    rng = np.random.default_rng(k)
    centroids = rng.integers(-size, size, (k, 5)).tolist()
    x = rng.integers(-size, size, (200, 5))
    contest = bisectors.Tournament(centroids)
    winner = contest.winners(x)
    want = [nearest(row, centroids) for row in x.tolist()]
    assert winner.tolist() == [w for _, w in want]
    assert [int(d) for d in contest.distances(x, winner)] == [d for d, _ in want]


def test_centroids_far_beyond_doubles():
    centroids = [[10**17, 5], [10**17 + 1, 5], [-(10**17), 0]]
    contest = bisectors.Tournament(centroids)
    x = np.array([[10**17, 4], [10**17 + 1, 5], [0, 0]])
    assert contest.winners(x).tolist() == [nearest(r, centroids)[1] for r in x.tolist()]


def brute(rows, k, rounds, d):
    kept = [(i, [math.floor(256 * float(np.float32(c))) for c in v]) for i, v in rows if v is not None and len(v) == d and all(c is not None and math.isfinite(c) for c in v)]
    text = lambda i: hashlib.sha256(f"2:{'' if i is None else i}".encode()).hexdigest()
    centroids = [x for _, x in sorted((text(i), x) for i, x in kept)][:k]
    for _ in range(rounds):
        groups = {}
        for _, x in kept:
            groups.setdefault(nearest(x, centroids)[1], []).append(x)
        centroids = [[sum(c) // len(g) for c in zip(*g)] if (g := groups.get(n)) else c for n, c in enumerate(centroids)]
    placed = [(i, *nearest(x, centroids)) for i, x in kept]
    own = {}
    for _, distance, c in placed:
        own[c] = own.get(c, 0) + distance
    digest = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return [(i, c, dist, own[c], sum(own.values()), digest[c]) for i, dist, c in placed]


def test_clusters_against_brute_force(spark):
    rng = np.random.default_rng(3)
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(rng.normal(size=(400, 4)))]
    rows += [(500 + i, rows[7][1]) for i in range(150)] + [(3, rows[3][1]), (None, rows[9][1])]
    odd = [(900, None), (901, [1.0, None, 1.0, 1.0]), (902, [NAN, 1.0, 1.0, 1.0]), (903, [1.0]), (904, [])]
    table = spark.createDataFrame([(*r, 5, "k") for r in rows + odd], "vec_id long, embedding array<float>, cluster int, k string")
    got = bisectors.cluster(table.repartition(6), k=9, rounds=3, dimensions=4).collect()
    assert sorted(map(tuple, got), key=str) == sorted(brute(rows, 9, 3, 4), key=str)


def test_few_vectors_and_none(spark):
    kind = "vec_id long, embedding array<double>"
    some = spark.createDataFrame([(1, [0.0, 1.0]), (2, [0.0, 1.0])], kind)
    got = bisectors.cluster(some, k=5, dimensions=2).collect()
    assert [(r.cluster, r.distance, r.inertia) for r in got] == [(0, 0, 0), (0, 0, 0)]  # two equal centroids: the smaller number
    assert bisectors.cluster(some.limit(0), k=5, dimensions=2).count() == 0
    assert bisectors.cluster(some, k=5, dimensions=3).count() == 0
