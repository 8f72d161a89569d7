import hashlib
import random

from tripweave.llm import lines


def brute(rows, m):
    docs = [(k, (t or "").split("\n")) for k, t in sorted(set(rows), key=lambda r: r[0])]
    seen, out = {}, {}
    for k, ls in docs:
        gone, copies = [False] * len(ls), {}
        for i in range(len(ls) - m + 1):
            window = tuple(ls[i : i + m])
            if window in seen:
                gone[i : i + m] = [True] * m
                copies[i] = seen[window]
            seen.setdefault(window, (k, i))
        longest = 0
        for i in copies:
            n = 0
            while copies.get(i + n) == (copies[i][0], copies[i][1] + n):
                n += 1
            longest = max(longest, n + m - 1)
        kept = "\n".join(x for x, g in zip(ls, gone, strict=True) if not g)
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        out[k] = (len(ls), sum(gone), runs, longest, hashlib.sha256(kept.encode()).hexdigest())
    return out


def got(spark, rows, m):
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    found = lines.line_dedup(table, min_lines=m).collect()
    return {r.doc_id: (r.n_lines, r.n_removed, r.n_runs, r.longest_copy, hashlib.sha256(bytes(r.kept)).hexdigest()) for r in found}


def corpus(seed):
    rng = random.Random(seed)
    pool = [f"line {i}" for i in range(15)] + ["", "é"]
    run = [rng.choice(pool) for _ in range(9)]
    rows = []
    for k in range(14):
        own = [rng.choice(pool) + (str(rng.random()) if rng.random() < 0.5 else "") for _ in range(rng.randint(0, 9))]
        if rng.random() < 0.5:
            a, b = sorted(rng.sample(range(10), 2))
            own[rng.randint(0, len(own)) :][:0] = run[a:b]
            own += run[a:b]
        rows.append((k, "\n".join(own)))
    return rows


def test_against_brute_force(spark):
    rows = corpus(1)
    assert got(spark, rows, 2) == brute(rows, 2)
    rows = [*corpus(2), (50, "x\n" * 11), (51, None), (52, "")]
    assert got(spark, rows, 3) == brute(rows, 3)


def test_odd_input(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, pos int, line string")
    assert lines.line_dedup(empty).count() == 0
    table = spark.createDataFrame([(1, "a\nb", 1), (1, "a\nb", 1), (None, "a\nb", 2), (3, "alone", 3)], "doc_id long, text string, rank int")
    found = sorted((r.doc_id is None, r.doc_id or 0, r.n_removed) for r in lines.line_dedup(table, min_lines=2).collect())
    assert found == [(False, 1, 0), (False, 1, 0), (False, 3, 0), (True, 0, 2)]
