import random
from collections import Counter

import numpy as np

from tripweave.llm import near
from tripweave.llm.graphs import components
from tripweave.llm.simhash import WithinRadius


def shingles(text):
    words = (text or "").encode().lower().split()
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + 5]) for i in range(max(1, len(words) - 4)))


def brute(rows):
    sets = [(k, shingles(t)) for k, t in rows]
    names = [k for k, _ in sets]
    changed = True
    while changed:
        changed = False
        for i, (_, a) in enumerate(sets):
            for j in range(i):
                b = sets[j][1]
                if names[i] != names[j] and a and b and 100 * len(a & b) >= 75 * len(a | b):
                    names[i] = names[j] = min(names[i], names[j])
                    changed = True
    return {k: (len(s), name) for (k, s), name in zip(sets, names, strict=True)}


def corpus(seed=1):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice("abcdefg") for _ in range(4))
    rows = []
    for _ in range(12):
        base = [word() for _ in range(rng.randint(3, 120))]
        rows.append(" ".join(base))
        for _ in range(rng.randint(0, 12)):
            copy = list(base)
            for _ in range(rng.randint(0, 6)):
                copy[rng.randrange(len(copy))] = word()
            rows.append(rng.choice([" ", "\n", "  "]).join(copy).title())
    rows += ["", None, " \t", "one two", "ONE two", "one two three", "É a b c d", "é a b c d"]
    rng.shuffle(rows)
    return list(enumerate(rows))


def test_components_against_brute_force(spark):
    rows = corpus()
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = near.near_dedup(table).collect()
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in got} == brute(rows)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_blocks_of_a_large_bucket(spark):
    """Members that the hub does not reach are still linked, over several blocks."""
    rng = np.random.default_rng(1)
    prints = [rng.integers(0, 256, 64, np.uint8) for _ in range(4)]
    nodes = spark.createDataFrame([(i, prints[i % 4].tobytes(), None) for i in range(60)], "node long, sketch binary, value string")
    members = nodes.selectExpr("1L as band", "node")
    none = spark.createDataFrame([], "node long, component long")
    close = np.arange(513) < 5
    links = near.remaining_links(members, nodes, none, close, WithinRadius(), "t1", block=7, part=5)
    got = {r.node: r.component for r in components(links).collect()}
    assert got == {i: i % 4 for i in range(60)}
    labels = nodes.selectExpr("node", "node % 4 as component")
    assert near.remaining_links(members, nodes, labels, close, WithinRadius(), "t2", block=7, part=5).count() == 0


def test_odd_input(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, row int, node int, component int")
    assert near.near_dedup(empty).count() == 0
    rows = [(None, "a b c d e f", 1), (5, "a b c d e f", 2), (5, "a b c d e f", 2), (6, None, 3)]
    table = spark.createDataFrame(rows, "doc_id long, text string, band int")
    got = Counter((r.doc_id, r.component_id, r.kept) for r in near.near_dedup(table).collect())
    assert got == {(None, 5, False): 1, (5, 5, True): 2, (6, 6, True): 1}


def test_sketches_estimate_high_similarities():
    rng = np.random.default_rng(2)
    a = rng.integers(0, 1 << 63, 4000).astype(np.uint64)
    table = near.estimates()
    for share in (0.95, 0.8, 0.6):
        b = np.concatenate([a[: int(4000 * share)], rng.integers(0, 1 << 63, 4000 - int(4000 * share)).astype(np.uint64)])
        x, y = near.odd_sketches(near.samples_of([a, b]))
        true = share / (2 - share)
        assert abs(table[int(np.bitwise_count(x ^ y).sum())] - true) < 0.15


def test_components_of_a_long_chain(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(200)] + [(500, 501), (501, 501)], "a long, b long")
    got = {r.node: r.component for r in components(edges).collect()}
    assert got == {**{i: 0 for i in range(201)}, 500: 500, 501: 500}


def test_one_row_of_a_component_stays_when_rows_repeat(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text, "a"), (1, text, "a"), (1, text, "b"), (2, f"{text} more", "a"), (3, "", "a"), (3, None, "a"), (None, "alone", "a")]
    table = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(3)
    kept = near.keep_one(table).collect()
    assert sorted(str(r.doc_id) for r in kept) == ["1", "3", "None"]
    assert near.keep_one(table).columns == table.columns


def test_words_that_beat_polynomials_modulo_two_to_the_64(spark):
    """A Thue-Morse word and its complement have equal polynomial hashes for any base."""
    word = "a"
    while len(word) < 1024:
        word += word.translate(str.maketrans("ab", "ba"))
    other = word.translate(str.maketrans("ab", "ba"))
    table = spark.createDataFrame([(1, f"x {word} y z w"), (2, f"x {other} y z w")], "doc_id long, text string")
    assert {r.doc_id: r.component_id for r in near.near_dedup(table).collect()} == {1: 1, 2: 2}


def test_links_are_confirmed_on_words(spark, monkeypatch):
    """With hashes of three bits nearly all texts look alike; the words tell them apart."""
    whole = near.shingle_hashes
    monkeypatch.setattr(near, "shingle_hashes", lambda texts, n: (np.unique(h & np.uint64(7)) for h in whole(texts, n)))
    alike = near.SameShingles()
    one, two = "a b c d e f g h i j k", "q r s t u v w x y z l"
    assert not alike.linked(alike.prepare(one), alike.prepare(two))
    assert alike.linked(alike.prepare(one), alike.prepare(one + " k"))
