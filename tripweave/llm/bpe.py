"""BPE encoding and decoding by tree concatenation.

A text falls apart at ASCII white space, across which no token reaches; each such chunk is
encoded once per worker and kept in a bounded cache. A long chunk without a break is cut
in halves down to short leaves; the leaves are encoded on their own, and every join is
mended by encoding a window around it anew, which grows until its first and its last
token are tokens that the left and the right side have at the very same places.

That agreement is exact: a token sequence is the encoding of its text if each pair of
neighbours is the encoding of the pair's text, and after the agreement every pair of
neighbours lies in the left side, in the window or in the right side.

Texts of more than ``SEGMENT`` characters are cut into segments that are spread over the
cluster, and the segments' tokens meet again by the same windows.

Null texts count as empty; an empty text has no ids. Repeated rows each get their own
result. Other columns of the input are neither read nor passed on.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Callable
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F
from tokenizers import Tokenizer
from tokenizers.models import BPE

from tripweave.llm.common import slices, utf8

DEFAULT_VOCABULARY = "word_bpe_49k.json"
LEAF = 256
WINDOW = 24
SEGMENT = 1 << 16
CACHED = 120_000
CACHED_TAILS = 1_000
LONGEST_TAIL = 16
MARKS = b"!\"#$%&'()*+,-./:;=>?@[\\]^_`{}~"  # what no special token starts with


def vocabulary_path(name: str = DEFAULT_VOCABULARY) -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_letters() -> list[str]:
    """The printable letter that stands for each byte in byte-level vocabularies."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    letters = {b: chr(b) for b in shown}
    for b in range(256):
        if b not in letters:
            letters[b] = chr(256 + len(letters) - len(shown))
    return [letters[b] for b in range(256)]


class Joined:
    """Tokens with the places where they start, for splicing."""

    __slots__ = ("ids", "starts", "end")

    def __init__(self, ids: list[int], starts: list[int], end: int):
        self.ids, self.starts, self.end = ids, starts, end


def tree_encode(text: str, inner: Callable, last: Callable, leaf: int = LEAF, window: int = WINDOW) -> list[int]:
    """Ids of one unbroken text. ``inner`` encodes a stretch that more text follows, and
    ``last`` one that ends the text; both return (ids, lengths)."""

    def encoded(start: int, end: int) -> tuple[list[int], list[int]]:
        return (last if end == len(text) else inner)(text[start:end])

    def piece(start: int, end: int) -> Joined:
        if end - start <= leaf:
            ids, lengths = encoded(start, end)
            return Joined(ids, [start, *(start + np.cumsum(lengths[:-1])).tolist()] if ids else [], end)
        middle = (start + end) // 2
        return join(piece(start, middle), piece(middle, end))

    def join(left: Joined, right: Joined) -> Joined:
        if not left.ids or not right.ids:
            return left if left.ids else right
        begin, stop, reach = left.starts[0], right.end, window
        while True:
            i = max(0, int(np.searchsorted(left.starts, left.end - reach, "right")) - 1)
            j = min(len(right.ids), int(np.searchsorted(right.starts, left.end + reach)) + 1)
            to = right.starts[j] if j < len(right.ids) else stop
            ids, lengths = encoded(left.starts[i], to)
            starts = [left.starts[i], *(left.starts[i] + np.cumsum(lengths[:-1])).tolist()]
            before = left.starts[i] == begin or ids[0] == left.ids[i] and starts[0] == left.starts[i]
            after = j == len(right.ids) or j and ids[-1] == right.ids[j - 1] and starts[-1] == right.starts[j - 1]
            if before and after:
                return Joined(left.ids[:i] + ids + right.ids[j:], left.starts[:i] + starts + right.starts[j:], stop)
            reach *= 2

    return piece(0, len(text)).ids


class Chunks(dict):
    """Chunks' ids, each worked out when it is first asked for."""

    __slots__ = ("words",)

    def __init__(self, words: WordBPE):
        super().__init__()
        self.words = words

    def __missing__(self, chunk: bytes) -> bytes:
        words = self.words
        ids = words.old.get(chunk)
        if ids is None:
            ids = words._learn(chunk)
        self[chunk] = ids
        return ids


class WordBPE:
    """A byte-level BPE file with word ends, applied without special tokens.

    ``encode`` equals the library's ``encode(text, add_special_tokens=False).ids`` as
    little-endian 32-bit integers, ``decode`` its ``decode(ids, skip_special_tokens=False)``.
    """

    def __init__(self, path: str):
        self.whole = Tokenizer.from_file(path)
        self.whole.no_truncation()
        self.whole.no_padding()
        model = self.whole.model
        self.model = model
        vocabulary = self.whole.get_vocab(with_added_tokens=False)
        special = {t.content: i for i, t in self.whole.get_added_tokens_decoder().items()}
        self.special = sorted(special, key=len)
        self.suffix = model.end_of_word_suffix or ""
        self.names = [""] * (max([*vocabulary.values(), *special.values()]) + 1)
        for name, i in [*vocabulary.items(), *special.items()]:
            self.names[i] = name
        self.letters = "".join(byte_letters())
        self.codes = [i.to_bytes(4, "little") for i in range(len(self.names))]
        self.tokenize = model.tokenize
        self.path = path
        self._inner = None
        self.young = Chunks(self)
        self.old: dict[bytes, bytes] = {}
        self.tails: dict[bytes, bytes] = {}

    @property
    def inner(self) -> BPE:
        """The same merges without word ends, for stretches that more text follows."""
        if self._inner is None:
            import json

            with open(self.path, encoding="utf-8") as file:
                kept = json.load(file)["model"]
            merges = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in kept["merges"]]
            self._inner = BPE(kept["vocab"], merges)
        return self._inner

    # one word

    def _lengths(self, tokens, ended: bool) -> tuple[list[int], list[int]]:
        ids = [t.id for t in tokens]
        lengths = [len(self.names[i]) for i in ids]
        if ended and ids and self.suffix:
            lengths[-1] -= len(self.suffix)
        return ids, lengths

    def _shown(self, shown: str) -> list[int]:
        """Ids of one word in byte letters."""
        if len(shown) <= LEAF:
            return [t.id for t in self.model.tokenize(shown)]
        return tree_encode(
            shown,
            lambda part: self._lengths(self.inner.tokenize(part), False),
            lambda part: self._lengths(self.model.tokenize(part), True),
        )

    def _word(self, word: bytes) -> bytes:
        """Ids of one lower-case run of Latin letters."""
        shown = word.decode() if word.isascii() else word.decode("latin-1").translate(self.letters)
        codes = self.codes
        if len(shown) <= LEAF:
            return b"".join([codes[t.id] for t in self.tokenize(shown)])
        return b"".join([codes[i] for i in self._shown(shown)])

    @staticmethod
    def _plain(chunk: bytes) -> bytes | None:
        """The normal form of letters of the Latin blocks alone, which are one word."""
        if chunk.isalpha():
            return chunk if chunk.islower() else None  # ASCII
        text = chunk.decode()
        if not text.isalpha() or max(text) >= "\u0180":
            return None
        lower = text.lower()
        return lower.encode() if lower.isalpha() and max(lower) < "\u0180" else None

    def _known(self, word: bytes) -> bytes:
        """Ids of one word in normal form, which may stand alone in the cache."""
        ids = self.young.get(word) or self.old.get(word)
        return self._word(word) if ids is None else ids

    def _learn(self, chunk: bytes) -> bytes:
        body = chunk.rstrip(MARKS)
        if body and (word := self._plain(body)) is not None:
            if len(body) == len(chunk):
                return self._word(word)
            tail = chunk[len(body) :]
            if len(tail) <= LONGEST_TAIL:
                if (marks := self.tails.get(tail)) is None:
                    marks = self._word(tail)
                    if len(self.tails) < CACHED_TAILS:
                        self.tails[tail] = marks
                return self._known(word) + marks
        if len(chunk) > LEAF or b"<|" in chunk:
            return self._odd(chunk)
        return np.asarray(self.whole.encode(chunk.decode(), add_special_tokens=False).ids, "<u4").tobytes()

    def _odd(self, chunk: bytes) -> bytes:
        """A long chunk or one with a special token: the file's own normal form and word
        split, then each word by itself."""
        ids: list[int] = []
        for part in re.split("(" + "|".join(map(re.escape, self.special)) + ")", chunk.decode()) if self.special else [chunk.decode()]:
            if part in self.special:
                ids.append(self.whole.token_to_id(part))
            elif part:
                normal = self.whole.normalizer.normalize_str(part)
                for shown, _ in self.whole.pre_tokenizer.pre_tokenize_str(normal):
                    ids += self._shown(shown)
        return np.asarray(ids, "<u4").tobytes()

    # texts

    def encode(self, text: bytes) -> bytes:
        if len(self.young) > CACHED:
            self.old, self.young = self.young, Chunks(self)
        chunks = (text if b"<|" in text else text.lower()).split()
        return b"".join(map(self.young.__getitem__, chunks))

    def decode(self, ids: bytes) -> str:
        """The library joins the names of the tokens by blanks: the file has no decoder."""
        return " ".join(map(self.names.__getitem__, np.frombuffer(ids, "<u4").tolist()))


@lru_cache(maxsize=2)
def coder(path: str) -> WordBPE:
    return WordBPE(path)


def segments(text: bytes, size: int = SEGMENT) -> list[bytes]:
    """Cut a text into stretches of about ``size`` bytes, at white space where there is
    any within the next ``size`` bytes, and else after a whole character."""
    cuts, at = [], 0
    while len(text) - at > size:
        found = re.search(rb"[\x20\x09-\x0d]", text[at + size : at + 2 * size])
        to = at + size + (found.start() if found else 0)
        while not found and to < len(text) and text[to] & 0xC0 == 0x80:
            to += 1
        cuts.append(text[at:to])
        at = to
    return [*cuts, text[at:]]


def rejoin(words: WordBPE, parts: list[bytes], encoded: list[bytes]) -> bytes:
    """Ids of the segments' whole text. Where a join lies at white space the ids just
    follow each other; where it cuts a word, the words on both sides are encoded as one."""
    white = b" \t\n\r\x0b\x0c"
    ids, held = [], b""
    for k, (part, known) in enumerate(zip(parts, encoded, strict=True)):
        cut = k + 1 < len(parts) and part and parts[k + 1] and part[-1] not in white and parts[k + 1][0] not in white
        if not cut and not held:
            ids.append(known)
            continue
        # the unbroken stretch around the join, from the last white space on
        whole = held + part
        if cut:
            at = max(whole.rfind(bytes([w])) for w in white) + 1
            ids.append(words.encode(whole[:at]))
            held = whole[at:]
        else:
            ids.append(words.encode(whole))
            held = b""
    return b"".join(ids)


def half_encoded(texts: DataFrame, key: str, text: str, vocabulary: str | None = None, segment: int = SEGMENT) -> DataFrame:
    """key, text, ids: one row for each row of ``texts``, with its text or, if that is
    longer than ``segment`` bytes, its ids; ``ids_of`` gives the ids of either.

    Texts up to ``segment`` bytes never leave their task: they are encoded where their ids
    are used. The segments of longer ones are spread by a shuffle and meet again per text,
    which is the size of the output row.
    """
    path = vocabulary or vocabulary_path()
    kind = dict(texts.dtypes)[key]
    source = texts.select(F.col(key).alias("key"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    long = F.octet_length("text") > segment

    def cut(batches):
        for batch in slices(batches, 2):
            rows = [
                (*kept, k, part)
                for *kept, text in zip(*(batch.column(i).to_pylist() for i in (0, 1)), utf8(batch.column(2)), strict=True)
                for k, part in enumerate(segments(text, segment))
            ]
            columns = zip(*rows, strict=True)
            kinds = [batch.schema.field(0).type, pa.int64(), pa.int32(), pa.binary()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(columns, kinds, strict=True)], names=["key", "row", "part", "text"])

    def encode(batches):
        words = coder(path)
        for batch in slices(batches, 3):
            ids = [words.encode(t) for t in batch.column(3).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(ids, pa.binary())], names=["key", "row", "part", "text", "ids"])

    def together(group):
        group = group.sort_values("part")
        ids = rejoin(coder(path), group["text"].tolist(), group["ids"].tolist())
        return group.iloc[:1][["key"]].assign(ids=[ids])

    near = source.where(~long).select("key", "text", F.lit(None).cast("binary").alias("ids"))
    parts = source.where(long).select("key", F.monotonically_increasing_id().alias("row"), "text").mapInArrow(cut, f"key {kind}, row long, part int, text binary")
    spread = parts.repartition("row", "part").mapInArrow(encode, f"key {kind}, row long, part int, text binary, ids binary")
    far = spread.groupBy("row").applyInPandas(together, f"key {kind}, ids binary")
    return near.unionByName(far.select("key", F.lit(None).cast("string").alias("text"), "ids"))


def ids_of(words: WordBPE, texts: pa.Array, ids: pa.Array) -> list[bytes]:
    known = ids.to_pylist()
    return [words.encode(t) if i is None else i for t, i in zip(utf8(texts), known, strict=True)]


def encode_texts(texts: DataFrame, key: str, text: str, vocabulary: str | None = None, segment: int = SEGMENT) -> DataFrame:
    """key, ids (binary, little-endian 32-bit): one row for each row of ``texts``."""
    path = vocabulary or vocabulary_path()
    half = half_encoded(texts, key, text, vocabulary, segment)

    def run(batches):
        for batch in slices(batches, 1):
            ids = ids_of(coder(path), batch.column(1), batch.column(2))
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(ids, pa.binary())], names=["key", "ids"])

    return half.mapInArrow(run, f"key {dict(half.dtypes)['key']}, ids binary").withColumnRenamed("key", key)


def coding_digest(texts: DataFrame, key: str, text: str, vocabulary: str | None = None, segment: int = SEGMENT) -> DataFrame:
    """key, n_tokens, ids_sha256, decoded_sha256: texts encoded, and decoded from the ids."""
    path = vocabulary or vocabulary_path()
    half = half_encoded(texts, key, text, vocabulary, segment)

    def run(batches):
        words = coder(path)
        for batch in slices(batches, 1):
            ids = ids_of(words, batch.column(1), batch.column(2))
            columns = [
                batch.column(0),
                pa.array([len(x) // 4 for x in ids], pa.int64()),
                pa.array([hashlib.sha256(x).hexdigest() for x in ids]),
                pa.array([hashlib.sha256(words.decode(x).encode()).hexdigest() for x in ids]),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "n_tokens", "ids_sha256", "decoded_sha256"])

    rows = half.mapInArrow(run, f"key {dict(half.dtypes)['key']}, n_tokens long, ids_sha256 string, decoded_sha256 string")
    return rows.withColumnRenamed("key", key)
