import random

import numpy as np
import pytest

from tripweave.llm import toxicity


def corpus(n=500, seed=3):
    """Labelled texts of made-up words; toxic ones hold insults, some with letters put in."""
    rng = random.Random(seed)
    syllables = ["ta", "ren", "mol", "ki", "su", "van", "do", "pel", "ish", "or"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randint(1, 3)))
    insults = ["grumbolt", "snazwick", "fleebnot"]
    docs, labels = [], []
    for i in range(n):
        words = [word() for _ in range(rng.randint(20, 60))]
        toxic = int(rng.random() < 0.3)
        if toxic:
            for _ in range(rng.randint(2, 4)):
                words.insert(rng.randrange(len(words)), rng.choice(insults))
        docs.append((i, " ".join(words)))
        labels.append((i, toxic))
    return docs, labels


@pytest.fixture(scope="module")
def model(spark):
    docs, labels = corpus()
    return toxicity.train(spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(labels, "doc_id long, toxic int"))


def test_held_out_texts(spark, model):
    docs, labels = corpus(200, 9)
    table = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r.toxicity for r in toxicity.score(table, model).collect()}
    marks = dict(labels)
    wrong = [i for i, s in got.items() if (s >= toxicity.THRESHOLD) != bool(marks[i])]
    assert len(got) == 200 and len(wrong) <= 4


def test_letters_put_in(model):
    plain, *changed = model.margins([b"grumbolt", b"grumxbolt", b"g.r.u.m.b.o.l.t", b"grumb-olt", b"(grumbolt),"])
    other = model.margins([b"tarenmol", b"kisu", b"ish"])
    assert plain > 0.5 and min(changed) > other.max() and max(other) < 0
    spaced = model.top_two([b"you g r u m b o l t snazwick"])
    assert spaced[0, 1] > 0.5


def test_odd_input(spark, model):
    rows = [(1, None, 5), (2, "", 6), (2, "", 6), (None, " \n", 7), (4, "x" * 100_000, 8), (5, "grumbolt snazwick " * 3, 9)]
    table = spark.createDataFrame(rows, "doc_id long, text string, score int")
    got = toxicity.score(table, model)
    assert got.columns == ["doc_id", "text", "score", "toxicity"]
    low = [r.toxicity for r in got.collect() if r.doc_id != 5]
    assert max(low) < 0.5 and max(low) - min(low) < 0.1
    with pytest.raises(ValueError):
        toxicity.score(table, model, column="score")
    assert toxicity.score(table.limit(0), model).count() == 0
    nothing = toxicity.train(table, spark.createDataFrame([(1, None), (2, 0)], "doc_id long, toxic int"))
    assert {round(r.toxicity, 6) for r in toxicity.score(table, nothing).collect()} == {0.0}


def test_kernel_is_large_for_like_words():
    words = [b"\x02idiot\x03", b"\x02clown\x03", b"\x02idioot\x03"]
    values = toxicity.Landmarks(words).kernel(words)
    assert values[0, 1] < 0.1 < 0.7 < values[0, 2]
    assert np.allclose(values, values.T)
