import math
from fractions import Fraction

import numpy as np

from tripweave.llm import vectors, whitening

NAN, INF = float("nan"), float("inf")


def frame(spark, rows, kind="vec_id long, embedding array<float>, n string, x int"):
    return spark.createDataFrame([(*r, "n", 1) for r in rows], kind)


def brute(rows, d):
    """Deviations, eigenvalues and whitened values by plain fractions and numpy."""
    kept = [(i, tuple(math.floor(256 * float(np.float32(c))) for c in v)) for i, v in rows if v is not None and len(v) == d and all(c is not None and math.isfinite(c) for c in v)]
    fit = sorted(set(x for _, x in kept))
    n, sums = len(fit), [sum(c) for c in zip(*fit)]
    mean = [Fraction(s, n) for s in sums]
    v = [[float(sum((x[a] - mean[a]) * (x[b] - mean[b]) for x in fit) / n) for b in range(d)] for a in range(d)]
    values, axes = np.linalg.eigh(np.array(v))
    order = np.argsort(-values)[:4]
    return kept, n, sums, mean, values, values[order], axes[:, order]


def test_against_fractions(spark):
    rng = np.random.default_rng(1)
    base = rng.normal(size=(300, 6)) * [3, 2, 1, 0.5, 0.2, 0.1]
    rows = [(i, [float(c) for c in v]) for i, v in enumerate(base)]
    rows += [(1000 + i, rows[5][1]) for i in range(200)]  # one vector that holds many rows
    odd = [(1, None), (2, [None] * 6), (3, [1.0, 2.0, 3.0, NAN, 1.0, 1.0]), (4, [INF] + [0.0] * 5), (5, [])]
    got = whitening.whiten(frame(spark, [*rows, *odd]).repartition(5)).collect()
    kept, n, sums, mean, values, top, axes = brute(rows, 6)
    assert len(got) == 4 * len(kept) and {r.n for r in got} == {300}
    assert {r.identity_error for r in got}.pop() < 1e-9
    by = {}
    for r in got:
        by.setdefault(r.vec_id, {})[r.component] = r
    for i, x in kept:
        assert int(by[i][1].deviation) == sum((n * c - s) ** 2 for c, s in zip(x, sums))
        for c in range(4):
            assert math.isclose(by[i][c + 1].explained, top[c] / values.sum(), rel_tol=1e-9)
    for c in range(4):
        want = np.array([[float(a - m) for a, m in zip(x, mean)] for _, x in kept]) @ axes[:, c] / np.sqrt(top[c])
        have = np.array([by[i][c + 1].whitened for i, _ in kept])
        assert np.allclose(have, want, atol=1e-8) or np.allclose(have, -want, atol=1e-8)


def test_totals_are_exact_for_any_size():
    rng = np.random.default_rng(2)
    for size in (5, 1 << 20, 1 << 40):
        x = rng.integers(-size, size, (50, 5))
        n, sums = 10**9, [int(s) for s in rng.integers(-size, size, 5)]
        y = [[n * int(c) - s for c, s in zip(row, sums)] for row in x.tolist()]
        found = whitening.squares(whitening.centred(x, n, sums))
        for i in range(5):
            assert found[i, i] == sum(r[i] ** 2 for r in y)
            for j in range(i + 1, 5):
                assert found[i, j] == sum((r[i] + r[j]) ** 2 for r in y)
        if size < 1 << 40:  # beyond 38 digits is an error
            assert whitening._deviations(whitening.centred(x, n, sums)).to_pylist() == [sum(c * c for c in r) for r in y]
    for total in (-1, 0, 10**31 + 7, -(10**40)):
        high, low = vectors.in_parts(total)
        assert int(high) * vectors.PART + int(low) == total


def test_odd_tables(spark):
    assert whitening.whiten(frame(spark, [])).count() == 0
    assert whitening.whiten(frame(spark, [(1, None), (2, [])])).count() == 0
    assert whitening.whiten(frame(spark, [(1, [1.0, 2.0]), (2, [1.0, 2.0])])).count() == 0  # nothing varies
    flat = whitening.whiten(frame(spark, [(None, [1.0, 2.0]), (2, [3.0, 2.0]), (2, [3.0, 2.0])])).collect()
    assert sorted((str(r.vec_id), r.component, round(abs(r.whitened), 9), r.explained) for r in flat) == [
        ("2", 1, 1.0, 1.0), ("2", 1, 1.0, 1.0), ("None", 1, 1.0, 1.0)]
    mixed = [(i, [float(i), float(i * i)]) for i in range(5)] + [(9 + i, [float(i), 1.0, float(-i * i)]) for i in range(4)]
    got = whitening.whiten(frame(spark, mixed).repartition(3)).collect()
    assert {(r.vec_id < 9, r.n) for r in got} == {(True, 5), (False, 4)} and len(got) == 5 * 2 + 4 * 2
