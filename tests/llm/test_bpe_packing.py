import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
from tokenizers import Tokenizer

from tripweave.llm import bpe, packing

LETTERS = [*"abcdeft's.,!?<|> \n\t0123éÉßİǅκλ你́̇'sre\x1c\x85\xa0😀", "<|endoftext|>", "<|startoftext|>", "'ll"]


def library():
    return Tokenizer.from_file(bpe.vocabulary_path())


def texts(seed=1):
    rng = random.Random(seed)
    some = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    some += ["".join(rng.choice(c) for _ in range(rng.randint(200, 5000))) for c in ("thaeinor", "ab!.é1", "a", "tthe ")]
    return [*some, "", "a" * 3000, "x<|endoftext|>" * 300]


def test_words_equal_the_library():
    words, whole = bpe.coder(bpe.vocabulary_path()), library()
    for text in texts():
        ids = words.encode(text.encode())
        expected = whole.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == expected, text
        assert words.decode(ids) == whole.decode(expected, skip_special_tokens=False)
        parts = bpe.segments(text.encode(), 100)
        assert b"".join(parts) == text.encode()
        assert bpe.rejoin(words, parts, [words.encode(p) for p in parts]) == ids


def test_marks_at_the_end_cost_no_word_twice(monkeypatch):
    # Words with marks behind them, or capitals beyond ASCII, are one word and its marks; the
    # word is merged once, however many marks follow it, and the whole library is not asked.
    words, whole = bpe.WordBPE(bpe.vocabulary_path()), library()
    text = "heenth heenth, heenth.*** heenth&&& Éeauon &&& heenth'"
    asked = []
    monkeypatch.setattr(words, "tokenize", lambda shown, f=words.tokenize: asked.append(shown) or f(shown))
    monkeypatch.setattr(words, "whole", None)
    some = words.encode("heenth heenth, heenth.*** heenth&&& Éeauon heenth'".encode())
    assert asked.count("heenth") == 1 and len(asked) == 6
    monkeypatch.undo()
    assert np.frombuffer(some, "<u4").tolist() == whole.encode(text.replace(" &&& ", " "), add_special_tokens=False).ids
    for text in [text, "ÀÉ. İa, ſa! ŉ' x's' x'll. a<| a<|. <|endoftext|>. a_ a\\\\ a''' 'a' .a. a" + "!" * 40]:
        assert np.frombuffer(words.encode(text.encode()), "<u4").tolist() == whole.encode(text, add_special_tokens=False).ids


def test_windows_grow_until_both_sides_agree():
    words = bpe.coder(bpe.vocabulary_path())
    rng = random.Random(4)
    for _ in range(60):
        text = "".join(rng.choice("aeth") for _ in range(rng.randint(1, 700)))
        ids = bpe.tree_encode(
            text,
            lambda part: words._lengths(words.inner.tokenize(part), False),
            lambda part: words._lengths(words.model.tokenize(part), True),
            leaf=5,
            window=1,
        )
        assert ids == library().encode(text, add_special_tokens=False).ids


def test_coding_digest(spark):
    rows = [(i, t) for i, t in enumerate([*texts(2)[-200:], None])]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(3)
    got = {r.doc_id: r for r in bpe.coding_digest(table, "doc_id", "text", segment=500).collect()}
    whole = library()
    for i, text in rows:
        ids = whole.encode(text or "", add_special_tokens=False).ids
        assert got[i].n_tokens == len(ids)
        assert got[i].ids_sha256 == hashlib.sha256(np.asarray(ids, "<u4").tobytes()).hexdigest()
        assert got[i].decoded_sha256 == hashlib.sha256(whole.decode(ids, skip_special_tokens=False).encode()).hexdigest()
    assert bpe.encode_texts(table.limit(0), "doc_id", "text").count() == 0


def test_packing_puts_each_id_into_one_piece(spark):
    rows = [(i, t) for i, t in enumerate(["the cat " * n for n in (1, 3, 900, 5000, 0, 77)] * 9)] + [(None, None), (7, "twice"), (7, "twice")]
    table = spark.createDataFrame(rows, "doc_id long, text string").repartition(2)
    limits = packing.Limits(tokens=512, segments=5)
    pieces = packing.pack_texts(table, "doc_id", "text", limits=limits).collect()
    assert {len(p.ids) // 4 for p in pieces} and all(len(p.ids) == 4 * p.length for p in pieces)
    sequences = defaultdict(list)
    for p in pieces:
        sequences[p.sequence_id].append(p)
    for run in sequences.values():
        run.sort(key=lambda p: p.offset)
        assert [p.offset for p in run] == [sum(q.length for q in run[:i]) for i in range(len(run))]
        total = sum(p.length for p in run)
        assert total & (total - 1) == 0 and total <= 512 and len(run) <= 5
    whole = library()
    expected = sum(len(whole.encode(t or "", add_special_tokens=False).ids) + 1 for _, t in rows)
    assert sum(p.length for p in pieces) == expected
    ids = np.concatenate([np.frombuffer(p.ids, "<u4") for p in sorted((p for p in pieces if p.doc_id == 3), key=lambda p: p.start)])
    assert ids.tolist() == [*whole.encode(rows[3][1], add_special_tokens=False).ids, 2]
    crc = packing.with_crc32(spark.createDataFrame([(bytes(ids[:9].astype("<u4").tobytes()),)], "ids binary")).first()
    assert crc.ids_crc32 == zlib.crc32(ids[:9].astype("<u4").tobytes())


def test_packing_keeps_the_loss_limit(spark):
    rows = [(i, bytes(np.arange(40, dtype="<u4").tobytes()), bytes([j % (i % 3 + 1) == 0 for j in range(40)])) for i in range(50)]
    table = spark.createDataFrame(rows, "doc_id long, ids binary, bears binary").repartition(1)
    limits = packing.Limits(tokens=128, segments=9, loss_tokens=64)
    pieces = packing.pack(table, "doc_id", limits=limits, loss="bears").collect()
    loss, tokens = defaultdict(int), defaultdict(int)
    for p in pieces:
        loss[p.sequence_id] += p.loss_tokens
        tokens[p.sequence_id] += p.length
    assert max(loss.values()) <= 64 and max(tokens.values()) <= 128
    assert sum(tokens.values()) == 50 * 41
    assert packing.pack(table.limit(0), "doc_id").count() == 0
