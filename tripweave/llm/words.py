"""Words and word shingles: lower-cased A-Z, split at ASCII white space."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import xxhash

from tripweave.llm.rolling import LIMIT, mixed

_STEP = np.uint64(0xD1342543DE82EF95)
LONGEST = 4096  # longer words are told apart by a digest, to bound the buffers


def words_of(text: bytes) -> list[bytes]:
    words = text.lower().split()
    if len(text) > LONGEST and any(len(w) > LONGEST for w in words):
        words = [w if len(w) <= LONGEST else b"\x00" + hashlib.sha256(w).digest().hex().encode() for w in words]
    return words


def shingle_hashes(texts: list[bytes], n: int) -> Iterator[np.ndarray]:
    """For each text the distinct hashes of its ``n``-word shingles, sorted."""
    return map(np.unique, all_shingle_hashes(texts, n))


def all_shingle_hashes(texts: list[bytes], n: int) -> Iterator[np.ndarray]:
    """For each text the hashes of its ``n``-word shingles. A text with fewer words is one
    shingle, one without words has none."""
    held: list[list[bytes]] = []
    size = 0
    for text in texts:
        words = words_of(text)
        length = sum(map(len, words)) + len(words)
        if size + length > LIMIT and held:
            yield from _hashes(held, n)
            held, size = [], 0
        if length > LIMIT:
            step = LIMIT // (LONGEST + 1) - n
            parts = [words[i : i + step + n - 1] for i in range(0, max(1, len(words) - n + 1), step)]
            yield np.concatenate([next(_hashes([p], n)) for p in parts])
            continue
        held.append(words)
        size += length
    yield from _hashes(held, n)


def _chained(codes: list[np.ndarray]) -> np.ndarray:
    """One hash of the words that stand at the same place of each array, in their order."""
    hashes = np.full(len(codes[0]), len(codes), np.uint64)
    for code in codes:
        hashes = mixed(hashes * _STEP + code)
    return hashes


def _hashes(docs: list[list[bytes]], n: int) -> Iterator[np.ndarray]:
    flat = [w for d in docs for w in d]
    codes = np.fromiter(map(xxhash.xxh3_64_intdigest, flat), np.uint64, len(flat))
    full = np.array([], np.uint64)
    if len(flat) >= n:
        full = _chained([codes[k : len(codes) - n + 1 + k] for k in range(n)])
    a = 0
    for doc in docs:
        count = len(doc)
        if count >= n:
            yield full[a : a + count - n + 1]
        elif count:
            yield _chained([codes[i : i + 1] for i in range(a, a + count)])
        else:
            yield np.array([], np.uint64)
        a += count


def same_shingles(one: bytes, two: bytes, n: int, percent: int) -> bool:
    """Whether the sets of ``n``-word shingles of two texts, the words themselves and no
    hashes, have ``percent`` of their union in common."""
    a, b = (
        {tuple(words[i : i + n]) for i in range(max(1, len(words) - n + 1))} if words else set()
        for words in (one.lower().split(), two.lower().split())
    )
    common = len(a & b)
    return 100 * common >= percent * (len(a) + len(b) - common)
