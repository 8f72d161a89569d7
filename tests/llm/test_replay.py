import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken

from tripweave.llm import replay
from tripweave.llm.bpe import vocabulary_path

LETTERS = [*"abcdeft's.,!?<|> \n\t\r\x0b0123éÉßİǅκλ你́̇'sre\x1c\x85\xa0 　😀\0", "'ll", "  ", "на", "工作", "٣"]


def library(path=None, pattern=public_tokenizers.PATTERN):
    with open(path or vocabulary_path(replay.DEFAULT_VOCABULARY), "rb") as file:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
    return tiktoken.Encoding("own", pat_str=pattern, mergeable_ranks=ranks, special_tokens={})


def texts(seed=1):
    rng = random.Random(seed)
    some = ["".join(rng.choice(LETTERS) for _ in range(rng.randint(0, 60))) for _ in range(1500)]
    some += ["".join(rng.choice(c) for _ in range(rng.randint(200, 5000))) for c in ("thaeinor", "ab!.é1", "a", "tthe ", " \n")]
    return [*some, "", "a" * 3000, "the cat  sat\n\n on" * 300]


def test_ids_equal_the_library():
    words, whole = replay.RankBPE(vocabulary_path(replay.DEFAULT_VOCABULARY), public_tokenizers.PATTERN), library()
    some = texts()
    for part in (some[:700], some[700:], some[:50]):  # the last one from the cache
        for text, ids in zip(part, words.encode([t.encode() for t in part]), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == whole.encode_ordinary(text), text
            assert words.decode(ids) == text.encode()


def test_merges_that_make_pairs_of_lower_rank(tmp_path):
    """Ranks in any order, where a merge may bring up a pair that goes before its own."""
    rng = random.Random(5)
    for _ in range(30):
        tokens = list(dict.fromkeys(bytes(rng.choice(b"abc") for _ in range(rng.randint(2, 5))) for _ in range(25)))
        listed = [bytes([b]) for b in range(256)] + tokens
        path = tmp_path / "odd.tiktoken"
        path.write_bytes(b"".join(base64.b64encode(t) + b" %d\n" % i for i, t in enumerate(listed)))
        words, whole = replay.RankBPE(str(path), public_tokenizers.PATTERN), library(path)
        some = ["".join(rng.choice("abc") for _ in range(rng.randint(1, 40))) for _ in range(60)]
        for text, ids in zip(some, words.encode([t.encode() for t in some]), strict=True):
            assert np.frombuffer(ids, "<u4").tolist() == whole.encode_ordinary(text), (text, tokens)


@pytest.mark.parametrize("size", [1, 7, 100])
def test_stretches_leave_the_ids_as_they_are(size):
    words, whole = replay.coder(vocabulary_path(replay.DEFAULT_VOCABULARY), public_tokenizers.PATTERN), library()
    for text in texts(3)[::9]:
        parts = list(replay.stretches(text.encode(), size))
        assert b"".join(parts) == text.encode()
        ids = b"".join(words.encode([p])[0] for p in parts)
        assert np.frombuffer(ids, "<u4").tolist() == whole.encode_ordinary(text), text


def test_a_bounded_cache(monkeypatch):
    monkeypatch.setattr(replay, "CACHED", 20)
    words, whole = replay.RankBPE(vocabulary_path(replay.DEFAULT_VOCABULARY), public_tokenizers.PATTERN), library()
    for text in texts(4)[-200:]:
        assert np.frombuffer(words.encode([text.encode()])[0], "<u4").tolist() == whole.encode_ordinary(text)
    assert len(words.young) < 2000


def test_coding_digest(spark):
    rows = [(i, t, "x") for i, t in enumerate([*texts(2)[-200:], None])] + [(None, "no id", "y"), (7, "twice", None), (7, "twice", None)]
    table = spark.createDataFrame(rows, "doc_id long, text string, ids string").repartition(3)
    got = replay.coding_digest(table, "doc_id", "text").collect()
    whole = library()

    def expected(i, text):
        ids = whole.encode_ordinary(text or "")
        listed = ",".join(map(str, ids)).encode()
        return (i, len(ids), hashlib.sha256(listed).hexdigest(), hashlib.sha256(whole.decode_bytes(ids)).hexdigest())

    assert sorted(map(tuple, got), key=str) == sorted((expected(i, t) for i, t, _ in rows), key=str)
    assert replay.coding_digest(table.limit(0), "doc_id", "text").count() == 0
