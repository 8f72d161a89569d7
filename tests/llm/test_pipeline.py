import random
import re

import numpy as np
import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tripweave.llm import bpe, toxicity

LAYOUT = "doc_id long, text string, lang string, source string, n_chars long"


def corpus():
    rng = random.Random(8)
    word = lambda: "".join(rng.choice(["ta", "ren", "mol", "ki", "su", "van"]) for _ in range(rng.randint(1, 3)))
    text = lambda n: " ".join(word() for _ in range(n))
    docs, labels = {}, []
    for i in range(240):
        words = text(rng.randint(30, 60)).split()
        if toxic := int(i % 3 == 0):
            for _ in range(3):
                words.insert(rng.randrange(len(words)), rng.choice(["grumbolt", "snazwick"]))
        docs[i] = " ".join(words)
        labels.append((i, toxic))
    passage = text(60)
    docs |= {300: text(80), 301: "", 302: None, 303: text(20) + "\n" + passage + "\n" + text(20), 304: text(25) + " " + passage}
    docs[310] = docs[300].replace(" ", "\n")
    docs[311] = docs[300].replace(" ", "  ")
    near = docs[303].split()
    docs[312] = text(200)
    docs[313] = " ".join([*docs[312].split()[:-2], "changed", "end"])
    assert len(near) > 80
    rows = [(k, t, "en", "src", len(t or "")) for k, t in docs.items()]
    return rows, labels, passage


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rows, labels, _ = corpus()
    path = str(tmp_path_factory.mktemp("corpus"))
    spark.createDataFrame(rows, LAYOUT).repartition(3).write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, toxic int").write.parquet(f"{path}/labels.parquet")
    return path


def test_stages(spark, folder):
    rows, labels, passage = corpus()
    text = {k: t or "" for k, t, *_ in rows}
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    kept = []
    for _, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, folder)
        assert docs.dtypes == spark.createDataFrame([], LAYOUT).dtypes
        docs = spark.createDataFrame(docs.collect(), LAYOUT)
        kept.append({r.doc_id: r.text or "" for r in docs.collect()})
    clean, single, apart, cut = kept
    toxic = {i for i, t in labels if t}
    assert len(toxic & clean.keys()) <= 3
    assert len((text.keys() - toxic) - clean.keys()) <= 3
    # equal but for white space: the longest stays; the empty ones are one text
    assert {300, 310, 311} & single.keys() == {311} and len({301, 302} & single.keys()) == 1
    assert clean.keys() - single.keys() == {300, 310, 302}
    assert single.keys() - apart.keys() == {313}
    assert apart.keys() == cut.keys()
    # passages that stand in two texts, byte by byte
    seen: dict[bytes, int] = {}
    for t in apart.values():
        raw = t.encode()
        for i in range(len(raw) - 199):
            seen[raw[i : i + 200]] = seen.get(raw[i : i + 200], 0) + 1
    for k, t in apart.items():
        raw = t.encode()
        gone = np.zeros(len(raw), bool)
        for i in range(len(raw) - 199):
            if seen[raw[i : i + 200]] > 1:
                gone[i : i + 200] = True
        assert cut[k] == bytes(b for b, g in zip(raw, gone, strict=True) if not g).decode()
    assert passage in apart[303] and passage not in cut[303] and passage not in cut[304]


def test_run(spark, folder):
    assert 4 <= len(corpus_pipeline.STAGES) <= 5 and corpus_pipeline.ORACLE_SQL is None
    pieces = corpus_pipeline.run(spark, folder).collect()
    whole = Tokenizer.from_file(bpe.vocabulary_path())
    texts = {k: t or "" for k, t, *_ in corpus()[0]}
    one = sorted((p for p in pieces if p.doc_id == 311), key=lambda p: p.start)
    ids = np.concatenate([np.frombuffer(p.ids, "<u4") for p in one]).tolist()
    assert ids == [*whole.encode(texts[311], add_special_tokens=False).ids, 2]
    totals: dict[int, int] = {}
    for p in pieces:
        totals[p.sequence_id] = totals.get(p.sequence_id, 0) + p.length
    assert all(n & (n - 1) == 0 and n <= 4096 for n in totals.values())
    assert not re.search("grumbolt", " ".join(texts[p.doc_id] for p in pieces if p.doc_id < 240)) or len({p.doc_id for p in pieces if "grumbolt" in texts[p.doc_id]}) <= 3
    assert toxicity.THRESHOLD == 0.7


def test_empty_tables(spark, tmp_path):
    spark.createDataFrame([], LAYOUT).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([], "doc_id long, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    assert corpus_pipeline.run(spark, str(tmp_path)).count() == 0
