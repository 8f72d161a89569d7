"""Byte-level BPE by replaying the merges over a corpus of words.

A text falls apart by the vocabulary's pattern. The words that a task's block of texts
brings and its bounded cache does not know are laid end to end as bytes, with a stop between
them, and all merges are replayed over this corpus at once: an inverted index holds, for
each merge, the places where its pair stands; the lowest rank is taken, its places are
merged from left to right, and only the two neighbours of each place get new entries in the
index. Stale entries are found out when their turn comes, as the pair is then another one.
Pairs that spell the same token share its rank and thus its entry. Where a merge makes a pair
of a lower rank than its own, the places left over wait until that one is through, so every
word gets exactly the ids it would get alone.

The corpus is that of a block (about 4 MB of texts), not of the whole table: to bring the ids
of table-wide words back to their texts, every block's distinct words would be shuffled
twice, and every text once. Blocks need neither, so nothing is shuffled, no word or text
is hot, and a lost task is run again on its own.

Texts longer than a block go through it in stretches that end before white space, where no
match of the pattern goes on. One unbroken run is one word of the corpus, whole; it takes
some 30 bytes of memory for each of its own. Null texts count as empty; an empty text has no
ids. Repeated rows each get their own result, and an empty table gives none. Other columns
are neither read nor passed on.
"""

from __future__ import annotations

import base64
import hashlib
from array import array
from collections.abc import Iterator
from functools import lru_cache
from heapq import heapify, heappop, heappush

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame, functions as F

from tripweave.llm.common import BATCH_BYTES, slices, utf8

DEFAULT_VOCABULARY = "byte_bpe_multi_50k.tiktoken"
CACHED = 200_000  # words
KEPT = 64  # characters of the longest word that stays in the cache
STRETCH = 1 << 20  # characters


class RankBPE:
    """A file of ranks with the pattern that splits texts before the merges.

    ``encode`` equals the library's ``encode_ordinary`` as little-endian 32-bit integers,
    ``decode`` its ``decode_bytes``.
    """

    def __init__(self, path: str, pattern: str):
        with open(path, "rb") as file:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, file)}
        size = max(ranks.values()) + 1
        self.ranks = ranks
        self.tokens = [b""] * size
        for token, rank in ranks.items():
            self.tokens[rank] = token
        self.names = [str(i) for i in range(size)]
        self.split = regex.compile(pattern).findall
        # the ids of single bytes, and the rank of each pair of them (or size, where there is none)
        self.single = np.array([ranks[bytes([b])] for b in range(256)], np.int32)
        self.stop, self.gone, self.none = size, size + 1, size + 2
        self.twos = np.full((257, 257), self.none, np.int32)
        # every way to make a token of two others
        self.width = size + 3
        self.pairs: dict[int, int] = {}
        for token, rank in ranks.items():
            for cut in range(1, len(token)):
                left, right = ranks.get(token[:cut]), ranks.get(token[cut:])
                if left is not None and right is not None:
                    self.pairs[left * self.width + right] = rank
            if len(token) == 2:
                self.twos[token[0], token[1]] = rank
        self.young: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def replay(self, words: list[bytes]) -> list[bytes]:
        """Ids of each word, by merges in rank order over all the words."""
        if not words:
            return []
        flat = np.frombuffer(b"\0" + b"\0".join(words) + b"\0", np.uint8)
        lengths = np.fromiter(map(len, words), np.int64, len(words))
        stops = np.concatenate([[0], np.cumsum(lengths + 1)])
        codes = flat.astype(np.int16)
        codes[stops] = 256
        firsts = self.twos[codes[:-1], codes[1:]]
        start = np.append(self.single, np.int32(self.stop))[codes]
        places = np.flatnonzero(firsts != self.none).astype(np.int32)
        kinds = firsts[places]
        order = np.argsort(kinds, kind="stable")
        places, kinds = places[order], kinds[order]
        edges = np.flatnonzero(np.diff(kinds, prepend=-1))
        index = {int(kinds[e]): array("i", p.tobytes()) for e, p in zip(edges, np.split(places, edges[1:]), strict=True)} if len(edges) else {}
        tokens = array("i", start.astype(np.int32).tobytes())
        after = array("i", np.arange(1, len(flat) + 1, dtype=np.int32).tobytes())
        before = array("i", np.arange(-1, len(flat) - 1, dtype=np.int32).tobytes())
        self._merge(index, tokens, after, before)
        left = np.frombuffer(tokens, np.int32)
        left = left[left != self.gone]
        ends = np.flatnonzero(left == self.stop).tolist()
        raw = left.astype("<u4").tobytes()
        return [raw[4 * a + 4 : 4 * b] for a, b in zip(ends, ends[1:])]

    def _merge(self, index: dict[int, array], tokens: array, after: array, before: array) -> None:
        pairs, width, gone = self.pairs.get, self.width, self.gone
        heap = list(index)
        heapify(heap)
        while heap:
            rank = heappop(heap)
            places = sorted(index.pop(rank))
            for n, p in enumerate(places):
                q = after[p]
                if tokens[p] == gone or pairs(tokens[p] * width + tokens[q]) != rank:
                    continue
                tokens[p], tokens[q] = rank, gone
                right, left = after[q], before[p]
                after[p], before[right] = right, p
                for place, pair in ((p, rank * width + tokens[right]), (left, tokens[left] * width + rank)):
                    new = pairs(pair)
                    if new is not None:
                        known = index.get(new)
                        if known is None:
                            index[new] = array("i", (place,))
                            heappush(heap, new)
                        else:
                            known.append(place)
                if heap and heap[0] < rank:
                    if n + 1 < len(places):
                        rest = index.get(rank)
                        if rest is None:
                            index[rank] = array("i", places[n + 1 :])
                            heappush(heap, rank)
                        else:
                            rest.extend(places[n + 1 :])
                    break

    def learn(self, words: set[str]) -> dict[str, bytes]:
        """Ids of the words, from the cache or by one replay."""
        if len(self.young) > CACHED:
            self.old, self.young = self.young, {}
        young, old, known, new = self.young, self.old, {}, []
        for word in words:
            ids = young.get(word)
            if ids is None and (ids := old.get(word)) is not None:
                young[word] = ids
            if ids is None:
                new.append(word)
            else:
                known[word] = ids
        raw = [w.encode() for w in new]
        # the library takes a word that is a token as it is, whether merges lead there or not
        whole = [self.ranks.get(r) for r in raw]
        replayed = iter(self.replay([r for r, i in zip(raw, whole, strict=True) if i is None]))
        for word, i in zip(new, whole, strict=True):
            known[word] = ids = next(replayed) if i is None else i.to_bytes(4, "little")
            if len(word) <= KEPT:
                young[word] = ids
        return known

    def encode(self, texts: list[bytes]) -> list[bytes]:
        """Ids of some texts that are one corpus."""
        split = [self.split(t.decode()) for t in texts]
        known = self.learn(set().union(*split)) if split else {}
        return [b"".join(map(known.__getitem__, words)) for words in split]

    def decode(self, ids: bytes) -> bytes:
        return b"".join(map(self.tokens.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def coder(path: str, pattern: str) -> RankBPE:
    return RankBPE(path, pattern)


def stretches(text: bytes, size: int = STRETCH) -> Iterator[bytes]:
    """Cut a text before white space that follows something else, about every ``size``
    bytes: no match of the pattern holds both sides of such a place."""
    at, white = 0, regex.compile(rb"[^\x20\x09-\x0d]([\x20\x09-\x0d])")
    while len(text) - at > size:
        found = white.search(text, at + size)
        if found is None:
            break
        yield text[at : found.start(1)]
        at = found.start(1)
    yield text[at:]


def ids_of(words: RankBPE, texts: list[bytes], size: int = STRETCH) -> list[bytes]:
    if sum(map(len, texts)) <= max(BATCH_BYTES, size):
        return words.encode(texts)
    return [b"".join(words.encode([part])[0] for part in stretches(t, size)) for t in texts]


def default_pattern() -> str:
    import public_tokenizers

    return public_tokenizers.PATTERN


def _paths(vocabulary: str | None, pattern: str | None) -> tuple[str, str]:
    from tripweave.llm.bpe import vocabulary_path

    return vocabulary or vocabulary_path(DEFAULT_VOCABULARY), pattern or default_pattern()


def encode_texts(texts: DataFrame, key: str, text: str, vocabulary: str | None = None, pattern: str | None = None) -> DataFrame:
    """key, ids (binary, little-endian 32-bit): one row for each row of ``texts``."""
    files = _paths(vocabulary, pattern)
    source = texts.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))

    def run(batches):
        words = coder(*files)
        for batch in slices(batches, 1):
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids_of(words, utf8(batch.column(1))), pa.binary())], names=["key", "ids"])

    return source.mapInArrow(run, f"key {dict(source.dtypes)['key']}, ids binary").withColumnRenamed("key", key)


def coding_digest(texts: DataFrame, key: str, text: str, vocabulary: str | None = None, pattern: str | None = None) -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256: texts encoded, and decoded from the ids."""
    files = _paths(vocabulary, pattern)
    encoded = encode_texts(texts, key, text, *files).withColumnRenamed(key, "key")

    def run(batches):
        words = coder(*files)
        for batch in batches:
            ids = batch.column(1).to_pylist()
            listed = (",".join(map(words.names.__getitem__, np.frombuffer(x, "<u4").tolist())) for x in ids)
            columns = [
                batch.column(0),
                pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x.encode()).hexdigest() for x in listed], pa.string()),
                pa.array([hashlib.sha256(words.decode(x)).hexdigest() for x in ids], pa.string()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "n_tokens", "ids_sha256", "decoded_sha256"])

    kind = dict(encoded.dtypes)["key"]
    digests = encoded.mapInArrow(run, f"key {kind}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return digests.withColumnRenamed("key", key)
