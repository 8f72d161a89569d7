import hashlib
from collections import Counter

import pytest

from tripweave.llm import suffixes


def brute(texts, length):
    seen = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone = [False] * len(t)
        for i in range(len(t) - length + 1):
            if seen[t[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        runs = sum(g and (i == 0 or not gone[i - 1]) for i, g in enumerate(gone))
        kept = bytes(b for b, g in zip(t, gone, strict=True) if not g)
        out.append((len(t), sum(gone), runs, hashlib.sha256(kept).hexdigest()))
    return out


def digest(rows):
    return [(r.n_bytes, sum(s["end"] - s["start"] for s in r.spans), len(r.spans), hashlib.sha256(bytes(r.kept)).hexdigest()) for r in rows]


def check(spark, texts, length, k, **options):
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    rows = suffixes.remove_repeats(table.repartition(3), length=length, k=k, **options).orderBy("doc_id").collect()
    assert digest(rows) == brute([(t or "").encode() for t in texts], length)


def test_against_brute_force(spark):
    import random

    rng = random.Random(5)
    passage = "".join(rng.choice("abcdé ") for _ in range(90))
    texts = [None, "", "short", "ab" * 60, "ab" * 60, "x" * 200]
    for _ in range(60):
        t = "".join(rng.choice("abcdefgé ") for _ in range(rng.randint(0, 300)))
        if rng.random() < 0.6:
            a, b = sorted(rng.sample(range(len(passage)), 2))
            at = rng.randint(0, len(t))
            t = t[:at] + passage[a:b] + t[at:]
        texts.append(t)
    near = texts[20]
    texts += [near, near[:50] + "Z" + near[51:], near + near]
    check(spark, texts, 20, 6)
    check(spark, texts, 40, 11)


def test_two_letters(spark):
    import random

    rng = random.Random(6)
    check(spark, ["".join(rng.choice("ab") for _ in range(rng.randint(0, 60))) for _ in range(80)], 12, 3)


def test_long_texts_are_cut_into_stretches(spark, monkeypatch):
    texts = [bytes([97 + (i * i) % 23 for i in range(3000)]).decode(), "q" * 50 + bytes([97 + (i * i) % 23 for i in range(400)]).decode()]
    groups = list(suffixes.units([t.encode() for t in texts], 20, 256))
    windows = Counter((i, at + p) for g in groups for i, at, part in g for p in range(len(part) - 19))
    assert set(windows.values()) == {1}
    assert len(windows) == sum(len(t) - 19 for t in texts)


def test_odd_input(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, row string, stretches int, lo int")
    assert suffixes.remove_repeats(empty).count() == 0
    rows = [(None, "y" * 300, 1), (None, "y" * 300, 1), (4, None, None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, n int")
    got = suffixes.remove_repeats(table).toPandas()
    assert sorted(len(x) for x in got["kept"]) == [0, 0, 0]
    assert sorted(got["n_bytes"]) == [0, 300, 300]
    with pytest.raises(ValueError):
        suffixes.remove_repeats(table, length=10, k=10)


def test_whole_characters(spark):
    passage = "é" * 30
    table = spark.createDataFrame([(1, "Ã" + passage), (2, passage)], "doc_id long, text string")
    for row in suffixes.remove_repeats(table, length=21, k=5, whole_characters=True).collect():
        bytes(row.kept).decode()
