import hashlib
import random

import numpy as np
import pytest

from tripweave.llm import simhash


def hamming(a, b):
    return (int.from_bytes(a) ^ int.from_bytes(b)).bit_count()


def test_likeness_follows_common_terms():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(4000)]
    a = [rng.choice(words) for _ in range(600)]
    b = [rng.choice(words) for _ in range(600)]
    prints = simhash.fingerprints([" ".join(x) for x in (a, [*a[:300], *b[:300]], b, a)] + ["", " \n", "one"])
    assert prints[0] == prints[3] and simhash.likeness(prints[0], prints[3]) == 1
    assert 0.3 < simhash.likeness(prints[0], prints[1]) < 0.7
    assert simhash.likeness(prints[0], prints[2]) < 0.3
    assert prints[4] == prints[5] == bytes(16) and any(prints[6])
    assert simhash.likeness(prints[4], prints[5]) == 1 and simhash.likeness(prints[4], prints[6]) == 0


def test_a_shared_table_for_each_pair_within_the_radius():
    rng = np.random.default_rng(3)
    for _ in range(50):
        a = rng.integers(0, 256, 16, np.uint8)
        b = a.copy()
        for bit in rng.choice(128, 3, replace=False):
            b[bit // 8] ^= 1 << (bit % 8)
        x, y = simhash.table_keys([a.tobytes(), b.tobytes()])
        assert set(x) & set(y)
    with pytest.raises(ValueError):
        simhash.table_keys([bytes(16)], radius=3, blocks=3)


def test_edited_texts_meet_their_successor(spark):
    rng = random.Random(4)
    rows = [(i * 3 % 101, " ".join(rng.choice(["äpfel", "und", "birnen", "x"]) for _ in range(rng.randint(0, 30)))) for i in range(101)]
    rows[5] = (rows[5][0], None)
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(5)
    got = {r.doc_id: r for r in simhash.edited_likeness(table).collect()}
    ordered = sorted((k, t or "") for k, t in rows)
    for i, (key, text) in enumerate(ordered):
        after = ordered[(i + 1) % len(ordered)][1]
        half = len(text) // 2
        new = text[: len(text) - half] + after[:half]
        a, b, c = simhash.fingerprints([text, new, after])
        row = got[key]
        assert (row.n_chars, row.edited_sha256) == (len(text), hashlib.sha256(new.encode()).hexdigest())
        assert (bytes(row["print"]), bytes(row.edited_print)) == (a, b)
        assert (row.near_edited, row.near_next) == (simhash.likeness(a, b), simhash.likeness(a, c))


def test_odd_input(spark):
    assert simhash.edited_likeness(spark.createDataFrame([], "doc_id long, text string, place int")).count() == 0
    rows = [(None, "a b c d", 1), (None, "a b c d", 2), (1, "", 3)]
    table = spark.createDataFrame(rows, "doc_id long, text string, edge int")
    got = simhash.edited_likeness(table).collect()
    assert sorted(r.n_chars for r in got) == [0, 7, 7]
    assert simhash.edited_likeness(table.where("doc_id = 1")).first().near_next == 1


def test_classes_against_brute_force(spark):
    rng = np.random.default_rng(5)
    prints = [rng.integers(0, 256, 16, np.uint8).tobytes() for _ in range(30)]
    for _ in range(300):
        own = bytearray(prints[rng.integers(len(prints))])
        for bit in rng.choice(128, rng.integers(1, 6), replace=False):
            own[bit // 8] ^= 1 << (bit % 8)
        prints.append(bytes(own))
    names = list(range(len(prints)))
    for _ in prints:
        for i, a in enumerate(prints):
            for j in range(i):
                if hamming(a, prints[j]) <= 3:
                    names[i] = names[j] = min(names[i], names[j])
        break
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j in range(i):
                if names[i] != names[j] and hamming(a, prints[j]) <= 3:
                    names[i] = names[j] = min(names[i], names[j])
                    changed = True
    table = spark.createDataFrame([(p,) for p in [*prints, prints[0]]], "print binary")
    got = {bytes(r["print"]): r.near_class for r in simhash.near_classes(table).collect()}
    for i in range(len(prints)):
        members = [prints[j] for j in range(len(prints)) if names[j] == names[i]]
        assert got[prints[i]] == min(members).hex()
