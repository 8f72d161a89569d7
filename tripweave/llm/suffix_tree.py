"""Language-model scores by a probabilistic suffix tree over words.

The tree's contexts are the words before a word, ``DEPTH`` at most, or fewer and the start
of the text. For each context it holds how often every word, or the end, follows. Every
word sequence that comes ``LEAST`` times in the training texts counts, however large the
corpus is. The tree is a set of tables keyed by a sequence, which grow with the corpus and
are never gathered: a sequence's key is made from those of its two parts (without its last
word, without its first), so any depth fits. Each length is counted per task and then by a
shuffle of blocks, a task's sequences of one bucket packed; there are as many buckets as the
corpus asks for. Blocks by suffix and by context then meet the tables of the length before;
the bucket of a very frequent word holds all that is frequent beside it. Sequences with a part that is not
frequent are left out before it as far as a bit table of fixed size tells, which changes the
cost and not the result.

A context is kept if what follows it diverges from what its longest kept suffix expects
by more than its number of parameters is worth. Its distribution is smoothed with that
suffix's, down to the root, whose distribution is the base score's. Texts are scored by
the state of the longest kept suffix; the probabilities of a state sum to 1 over the
training vocabulary and one unknown word.

In logarithms a score is a sum over the text's sequences: a kept context adds what it
leaves to its suffix, and a continuation that it lists adds what lies between its own
probability and that. So each sequence has one number, and texts meet these numbers by
bucket of sequences, as packed blocks too; only the ``AT_HAND`` most frequent ones travel to
the tasks. The base score's word counts are met in the same place.

Null texts count as empty: they have the end as their one token. Null ids belong to the
training texts; repeated rows count and are scored each. Without training texts every
token is the unknown word, with probability 1. A table without rows gives none; other
columns are not read.
"""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Callable
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, functions as F

from tripweave.llm.common import bucket_of, discard, row_numbers, slices, stored, text_or_empty, utf8
from tripweave.llm.rolling import mixed

DEPTH = 3
LEAST = 2
STRENGTH = 2.0
HELD = 400_000
HELD_WORDS = 150_000
HELD_PLACES = 3_000_000
HELD_ROWS = 1 << 15
AT_HAND = 1 << 20  # 40 bytes each in every task
COUNTED_TOKENS = 1 << 21  # training tokens for each bucket of sequences
WORD_BUCKETS = 8  # bits of a key that number the bucket of words that are counted
FILTER = 26  # bits of a key that number a bit of a filter
PROBES = 2  # bits of a filter for each key
REGION = 12  # leading bits that all of a key's bits have in common, so a bucket's lie together
FILTER_PARTS = 4
FOLDS = 5
START = 1
FIRST = 2
START_KEY = 0x5851F42D4C957F2D
END_KEY = 0x14057B7EF767814F
JOIN = np.uint64(0xD1342543DE82EF95)
BLOCKS = "bucket long, block binary"
VALUED = (np.int64, np.float64)  # what stands beside a code: its count and one number


def words_of(text: bytes) -> list[bytes]:
    return text.lower().split()


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """word, n: the count of every word of the texts; the empty word is the end."""

    def run(batches):
        counts: Counter = Counter()

        def done():
            table = pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], names=["word", "n"])
            counts.clear()
            return table

        for batch in slices(batches, 0, 2 << 20):
            for t in utf8(batch.column(0)):
                counts.update(words_of(t))
            counts[b""] += batch.num_rows
            if len(counts) > HELD_WORDS:
                yield done()
        if counts:
            yield done()

    return docs.select(text).mapInArrow(run, "word binary, n long").groupBy("word").agg(F.sum("n").alias("n"))


LETTERS = mixed(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD6E8FEB86659FD93))
LETTERS[0x41:0x5B] = LETTERS[0x61:0x7B]
LETTERS[[0x20, *range(0x09, 0x0E)]] = 0


@lru_cache(maxsize=4)
def _powers(size: int) -> np.ndarray:
    return np.cumprod(np.r_[np.uint64(1), np.full(size - 1, 0x9E3779B97F4A7C15, np.uint64)], dtype=np.uint64)


def keyed(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The texts' words as keys, each text between the start and the end; and for each key
    its text. A word's key is a 64-bit hash of its bytes, A-Z lower-cased."""
    texts = pc.cast(texts, pa.large_binary())
    _, ends, data = texts.buffers()
    ends = np.frombuffer(ends, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    data = np.frombuffer(data or b"", np.uint8)[ends[0] : ends[-1]]
    ends = ends - ends[0]
    inside = (data != 0x20) & (data - np.uint8(0x09) > 4)
    first = inside.copy()
    first[1:] &= ~inside[:-1]
    opening = ends[:-1][ends[:-1] < ends[1:]]
    first[opening] = inside[opening]
    at = np.flatnonzero(first)
    count = np.diff(np.searchsorted(at, ends))
    # white space after a word adds nothing to its sum
    size = np.diff(at, append=len(data))
    powers = _powers(1 << int(size.max(initial=1)).bit_length())
    number = np.repeat(np.arange(len(texts)), count + 2)
    ids = np.empty(len(number), np.uint64)
    last = np.cumsum(count + 2) - 1
    start = last - count - 1
    ids[start], ids[last] = START_KEY, END_KEY
    words = np.ones(len(ids), bool)
    words[start] = words[last] = False
    if len(at):
        place = np.arange(at[0], len(data)) - np.repeat(at, size)
        ids[words] = mixed(np.add.reduceat(LETTERS[data[at[0] :]] * powers[place], at - at[0]))
    return ids, number


def keys_of(words: list[bytes]) -> np.ndarray:
    """The keys of single words; the empty one is the end."""
    ids, _ = keyed(pa.array(words, pa.large_binary()))
    return ids[np.flatnonzero(ids == np.uint64(START_KEY)) + 1]


def key_counts(texts: DataFrame) -> DataFrame:
    """code, n: the count of every word of the texts, by key."""
    bits = WORD_BUCKETS

    def run(batches):
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def together():
            codes, n = (np.concatenate(x) for x in zip(*held, strict=True))
            held[:] = [tuple(added(codes, n))]

        def done():
            codes, n = held.pop()
            found = [(bucket, packed(codes[own], n[own])) for bucket, own in cuts(bits, codes)]
            numbers, blocks = zip(*found, strict=True)
            return pa.RecordBatch.from_arrays([pa.array(numbers), pa.array(blocks, pa.binary())], names=["bucket", "block"])

        for batch in slices(batches, 0, 1 << 20):
            ids, _ = keyed(batch.column(0))
            held.append(np.unique(ids[ids != np.uint64(START_KEY)], return_counts=True))
            if sum(len(x[0]) for x in held) > 3 * HELD:
                together()
                if len(held[0][0]) > HELD:
                    yield done()
        if held:
            together()
            yield done()

    def merged(table: pa.Table) -> pa.Table:
        codes, n = added(*map(np.concatenate, zip(*(unpacked(b, np.int64) for b in table["block"].to_pylist()), strict=True)))
        return pa.table([codes.view(np.int64), n], names=["code", "n"])

    return texts.mapInArrow(run, "bucket long, block binary").groupBy("bucket").applyInArrow(merged, "code long, n long")


def joined(context: np.ndarray, rest: np.ndarray) -> np.ndarray:
    """The keys of sequences from those of their parts without the last and the first word."""
    return mixed(context * JOIN + rest)


def sequences(ids: np.ndarray, length: int):
    """For each length up to ``length``: keys of the sequences up to each place, and which
    of them lie inside their text, whose start may come first."""
    starts = ids == np.uint64(START_KEY)
    codes, inside = ids, np.ones(len(ids), bool)
    yield codes, inside
    for _ in range(1, length):
        codes, inside = np.r_[np.uint64(0), joined(codes[:-1], codes[1:])], np.r_[False, inside[:-1]] & ~starts
        yield codes, inside


def _bit(codes: np.ndarray, probe: int) -> np.ndarray:
    """The numbers of one of the codes' bits in a filter."""
    free = FILTER - REGION
    within = codes << np.uint64(REGION + free * probe) >> np.uint64(64 - free)
    return codes >> np.uint64(64 - REGION) << np.uint64(free) | within


def filter_of(table: DataFrame) -> np.ndarray:
    """A bit table of fixed size of the keys of blocks; it says yes for all of them."""
    bits = FILTER - FILTER_PARTS  # numbered in a part

    def run(batches):
        held = np.zeros(1 << (FILTER - 3), np.uint8)
        for codes, *_ in (unpacked(b, *VALUED) for batch in batches for b in batch.column(0).to_pylist()):
            for probe in range(PROBES):
                at = np.unique(_bit(codes, probe)).astype(np.int64)
                byte = at >> 3
                firsts = np.flatnonzero(np.r_[True, byte[1:] != byte[:-1]][: len(byte)])
                if len(firsts):
                    held[byte[firsts]] |= np.bitwise_or.reduceat((1 << (at & 7)).astype(np.uint8), firsts)
        used = held.reshape(1 << FILTER_PARTS, -1)
        for part in np.flatnonzero(used.any(axis=1)).tolist():
            yield pa.RecordBatch.from_arrays([pa.array([part]), pa.array([used[part].tobytes()], pa.binary())], names=["part", "own"])

    def merged(group: pa.Table) -> pa.Table:
        own = np.zeros(1 << (bits - 3), np.uint8)
        for x in group["own"]:
            own |= np.frombuffer(x.as_py(), np.uint8)
        return pa.table([group["part"].slice(0, 1), pa.array([own.tobytes()], pa.binary())], names=["part", "own"])

    parts = table.select("block").mapInArrow(run, "part long, own binary")
    out = np.zeros((1 << FILTER_PARTS, 1 << (bits - 3)), np.uint8)
    for row in parts.groupBy("part").applyInArrow(merged, "part long, own binary").toArrow().to_pylist():
        out[row["part"]] = np.frombuffer(row["own"], np.uint8)
    return out.ravel()


def passing(bits: np.ndarray, codes: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which of the codes, told by a mask, the filter lets through."""
    left = np.flatnonzero(of)
    for probe in range(PROBES):
        at = _bit(codes[left], probe)
        left = left[(bits[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8) & np.uint8(1)).astype(bool)]
    out = np.zeros(len(codes), bool)
    out[left] = True
    return out


def met_sequences(ids: np.ndarray, length: int, filters: list[np.ndarray]):
    """For each length up to ``length``: keys of the sequences up to each place, and which
    of them may have a number: words, and by the filters kept contexts and what these list.
    Only a kept context lists anything, and the longest sequences are no contexts."""
    kept, listed = filters or (None, None)
    before = np.zeros(len(ids), bool)  # whether the sequence without its last word may be kept
    for size, (codes, inside) in enumerate(sequences(ids, length), 1):
        own = passing(kept, codes, inside) if size < length else np.zeros(len(ids), bool)
        if size == 1:
            yield codes, own | (ids != np.uint64(START_KEY))
        else:
            yield codes, own | passing(listed, codes, inside & np.r_[False, before[:-1]] & ~own)
        before = own


def buckets(tokens: int, each: int) -> int:
    """How many leading bits of a key number its bucket, one at least."""
    return max(1, math.ceil(math.log2(max(tokens, 1) / each)))


def planes(values: np.ndarray) -> bytes:
    """The first byte of every value, then the second, and so on: equal bytes side by side."""
    return np.ascontiguousarray(values).view(np.uint8).reshape(len(values), -1).T.tobytes()


def values_of(data: np.ndarray, kind: type) -> np.ndarray:
    return np.ascontiguousarray(data.reshape(np.dtype(kind).itemsize, -1).T).view(kind).ravel()


def packed(ordered: np.ndarray, *others: np.ndarray) -> bytes:
    """Rows as one block; their first column ascends and is told by its differences."""
    return b"".join(planes(x) for x in (np.diff(ordered, prepend=np.uint64(0)), *others))


def unpacked(block: bytes, *kinds: type) -> list[np.ndarray]:
    """The columns of a block: unsigned longs that ascend, then these kinds."""
    data = np.frombuffer(block, np.uint8)
    widths = [np.dtype(k).itemsize for k in (np.uint64, *kinds)]
    ends = np.cumsum([0, *widths]) * (len(data) // sum(widths))
    columns = [values_of(data[a:b], k) for a, b, k in zip(ends, ends[1:], (np.uint64, *kinds), strict=False)]
    return [np.cumsum(columns[0], dtype=np.uint64), *columns[1:]]


def cuts(bits: int, codes: np.ndarray):
    """bucket and slice of the codes, which ascend, for each bucket."""
    owner = codes >> np.uint64(64 - bits)
    at = np.flatnonzero(np.r_[True, owner[1:] != owner[:-1]][: len(codes)]).tolist()
    for a, b in zip(at, [*at[1:], len(codes)], strict=False):
        yield int(owner[a]), slice(a, b)


def blocks_of(bits: int, codes: np.ndarray, *others: np.ndarray) -> list[tuple[int, bytes]]:
    """Rows by the bucket of their code."""
    order = np.argsort(codes)
    columns = [x[order] for x in (codes, *others)]
    return [(bucket, packed(*(x[own] for x in columns))) for bucket, own in cuts(bits, columns[0])]


def gathered(blocks: pa.ChunkedArray, *kinds: type) -> list[np.ndarray]:
    """The columns of all blocks, one block after the other."""
    rows = [unpacked(b, *kinds) for b in blocks.to_pylist()]
    return [np.concatenate([np.zeros(0, k), *x]) for k, x in zip((np.uint64, *kinds), zip(*rows, strict=True) if rows else [()] * 9, strict=False)]


def as_table(rows: list[tuple[int, bytes]], **more: list) -> pa.Table:
    numbers, blocks = zip(*rows, strict=True) if rows else ((), ())
    return pa.table({"bucket": pa.array(numbers, pa.int64()), "block": pa.array(blocks, pa.binary()), **more})


def as_blocks(table: DataFrame, bits: int) -> DataFrame:
    """code, n and a number, as blocks by bucket."""

    def run(batches):
        held: list[list[np.ndarray]] = []

        def done():
            rows = as_table(blocks_of(bits, *map(np.concatenate, zip(*held, strict=True))))
            held.clear()
            return rows.to_batches()

        for batch in batches:
            if batch.num_rows:
                codes, n, value = (c.to_numpy(zero_copy_only=False) for c in batch.columns)
                held.append([codes.view(np.uint64), n, value])
            if sum(len(x[0]) for x in held) > HELD:
                yield from done()
        if held:
            yield from done()

    return table.mapInArrow(run, BLOCKS)


def as_rows(table: DataFrame) -> DataFrame:
    """code, n, value of the blocks' rows."""

    def run(batches):
        for batch in batches:
            for block in batch.column(0).to_pylist():
                codes, n, value = unpacked(block, *VALUED)
                yield pa.RecordBatch.from_arrays([*map(pa.array, (codes.view(np.int64), n, value))], names=["code", "n", "value"])

    return table.select("block").mapInArrow(run, "code long, n long, value double")


def found_at(sorted_codes: np.ndarray, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where each code stands among the sorted ones, and whether it does."""
    spot = np.searchsorted(sorted_codes, codes)
    there = spot < len(sorted_codes)
    there[there] = sorted_codes[spot[there]] == codes[there]
    return spot, there


def added(codes: np.ndarray, *others: np.ndarray) -> list[np.ndarray]:
    """Equal sequences together by code: the last column is added up, of others the first
    value stays."""
    order = np.argsort(codes)
    codes = codes[order]
    at = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]][: len(codes)])
    firsts = order[at]
    return [codes[at], *(x[firsts] for x in others[:-1]), np.add.reduceat(others[-1][order], at) if len(at) else others[-1]]


def _counted(texts: DataFrame, length: int, parts: np.ndarray, least: int, tokens: int) -> DataFrame:
    """rest, context, n of the sequences of ``length`` words that are frequent, as blocks by
    rest."""
    bits = buckets(tokens, COUNTED_TOKENS)

    def run(batches):
        held: list[list[np.ndarray]] = []

        def done():
            codes, *columns = held.pop()
            for bucket, own in cuts(bits, codes):
                context, rest, n = (c[own] for c in columns)
                order = np.argsort(context)
                block = packed(context[order], rest[order], n[order])
                yield pa.RecordBatch.from_arrays([pa.array([bucket]), pa.array([block], pa.binary())], names=["bucket", "block"])

        for batch in slices(batches, 0, 1 << 20):
            ids, _ = keyed(batch.column(0))
            for size, (codes, inside) in enumerate(sequences(ids, length), 1):
                if size == length - 1:
                    short = codes
            known = passing(parts, short, np.ones(len(short), bool))
            at = np.flatnonzero(inside & np.r_[False, known[:-1]] & known)
            if len(at):
                held.append([codes[at], short[at - 1], short[at], np.ones(len(at), np.int64)])
            if sum(len(x[0]) for x in held) > 3 * HELD:
                held[:] = [added(*map(np.concatenate, zip(*held, strict=True)))]
                if len(held[0][0]) > HELD:
                    yield from done()
        if held:
            held[:] = [added(*map(np.concatenate, zip(*held, strict=True)))]
            yield from done()

    def merged(table: pa.Table) -> pa.Table:
        rows = [unpacked(block, np.uint64, np.int64) for block in table["block"].to_pylist()]
        context, rest, n = map(np.concatenate, zip(*rows, strict=True))
        _, context, rest, n = added(joined(context, rest), context, rest, n)
        frequent = n >= least
        return as_table(blocks_of(bits, *(c[frequent] for c in (rest, context, n))))

    found = texts.mapInArrow(run, BLOCKS)
    return found.groupBy("bucket").applyInArrow(merged, BLOCKS)


def signed(key: int) -> int:
    return key - (1 << 64) if key >> 63 else key


def keyed_counts(counts: DataFrame) -> DataFrame:
    """code, n, word of the words."""

    def run(batches):
        for batch in batches:
            codes = keys_of(batch.column(0).to_pylist())
            yield pa.RecordBatch.from_arrays([pa.array(codes.view(np.int64)), batch.column(1), batch.column(0)], names=["code", "n", "word"])

    return counts.select("word", "n").mapInArrow(run, "code long, n long, word binary")


def _expected(places: pa.Table, known: pa.Table, bits: int) -> pa.Table:
    """context, rest, n, e, as blocks by context: with each sequence the probability of its
    last word after the others but the first."""
    rest, context, n = gathered(places["block"], np.uint64, np.int64)
    codes, _, p = gathered(known["block"], *VALUED)
    order = np.argsort(codes)
    spot, there = found_at(codes[order], rest)
    e = p[order[spot[there]]]
    return as_table(blocks_of(bits, context[there], rest[there], n[there], e))


KNOWN, LISTED, KEPT = range(3)


def _judged(places: pa.Table, known: pa.Table, bits: int, price: float, last: bool) -> pa.Table:
    """Blocks of three kinds: probabilities of the sequences for the next length, what kept
    contexts list, and these contexts."""
    columns = gathered(places["block"], np.uint64, np.int64, np.float64)
    codes, counts, _ = gathered(known["block"], *VALUED)
    order = np.argsort(codes)
    codes, counts = codes[order], counts[order]
    order = np.argsort(columns[0])
    context, rest, n, e = (c[order] for c in columns)
    spot, there = found_at(codes, context)
    context, rest, n, e, total = (*(c[there] for c in (context, rest, n, e)), counts[spot[there]])
    out: list[tuple[int, bytes]] = []
    kinds: list[int] = []
    if len(context):
        code = joined(context, rest)
        at = np.flatnonzero(np.r_[True, context[1:] != context[:-1]])
        number = np.diff(at, append=len(context))
        total = total[at]
        seen, sum_e, own = (np.add.reduceat(x, at) for x in (n, e, n * np.log(n / e)))
        gain = own - seen * np.log(total)
        others = np.maximum(total - seen, 0)
        left = np.maximum(1 - sum_e, 1e-9)
        gain += np.where(others > 0, others * np.log(np.maximum(others, 1) / total / left), 0.0)
        kept = gain > number * price + 0.5 * np.log(np.maximum(total, 2))
        part = (STRENGTH + total - seen) / (STRENGTH + total)
        listed = np.repeat(kept, number)
        parts = np.repeat(part, number)
        own = n / (np.repeat(total, number) + STRENGTH) + parts * e
        ratio = np.log10(own / e / parts)
        made = [] if last else [(KNOWN, (code, n, np.where(listed, own, e)))]
        made += [(LISTED, (code[listed], n[listed], ratio[listed])), (KEPT, (context[at][kept], total[kept], np.log10(part[kept])))]
        for kind, columns in made:
            blocks = blocks_of(bits, *columns)
            out += blocks
            kinds += [kind] * len(blocks)
    return as_table(out, kind=pa.array(kinds, pa.int32()))


def _judge(bits: int, price: float, last: bool) -> Callable[[pa.Table, pa.Table], pa.Table]:
    return lambda places, known: _judged(places, known, bits, price, last)


def levels(texts: DataFrame, words: DataFrame, tokens: int, distinct: int, least: int = LEAST, depth: int = DEPTH) -> list[tuple[DataFrame, DataFrame]]:
    """For each length of contexts the kept ones (code, n, gain: what each leaves to its
    suffix) and what they list (code, n, gain: what each continuation has beyond that), as
    blocks. ``words``: the training texts' words with code and n."""
    norm, bits = tokens + 0.5 * (distinct + 1), buckets(tokens, COUNTED_TOKENS)
    frequent = words.where(F.col("n") >= least)
    start = words.where(F.col("code") == signed(END_KEY)).select(F.lit(signed(START_KEY)).alias("code"), "n", F.lit(0.0).alias("p"))
    # of each frequent sequence the probability of its last word after the others
    known = frequent.select("code", "n", ((F.col("n") + 0.5) / norm).alias("p")).unionAll(start.where(F.col("n") >= least))
    price = math.log(known.count() + 2)
    known = stored(as_blocks(known, bits), "tree-level-1")
    out = []
    for length in range(2, depth + 2):
        # the last length has no longer one to tell probabilities to
        last = length == depth + 1
        rows = stored(_counted(texts, length, filter_of(known), least, tokens), f"tree-rows-{length}")
        expected = rows.groupBy("bucket").cogroup(known.groupBy("bucket")).applyInArrow(lambda a, b: _expected(a, b, bits), BLOCKS)
        judged = expected.groupBy("bucket").cogroup(known.groupBy("bucket"))
        level = stored(judged.applyInArrow(_judge(bits, price, last), f"{BLOCKS}, kind int"), f"tree-level-{length}")
        discard(rows, known)
        own = level
        if not last:
            own = stored(level.where(F.col("kind") != KNOWN), f"tree-listed-{length}")
            known = level.where(F.col("kind") == KNOWN).select("bucket", "block")
        out.append(tuple(own.where(F.col("kind") == kind).select("bucket", "block") for kind in (KEPT, LISTED)))
    return out


class SuffixTree:
    """The tree of a small corpus, gathered to look at."""

    def __init__(self, words: dict[bytes, int], counts: np.ndarray, tokens: int, distinct: int):
        self.words, self.counts = words, counts
        self.norm = tokens + 0.5 * (distinct + 1)
        self.keys = np.r_[np.array([0, START_KEY], np.uint64), keys_of(list(words))]
        self.levels: list[Level] = []

    def root(self, words: np.ndarray) -> np.ndarray:
        return (self.counts[words] + 0.5) / self.norm

    def ratios(self, ids: np.ndarray) -> np.ndarray:
        """For each place how many times as likely as by the root its word is."""
        gain = np.zeros(len(ids))
        found = list(sequences(self.keys[ids], len(self.levels) + 1))
        for level, (before, left), (codes, inside) in zip(self.levels, found, found[1:], strict=False):
            known = inside & np.r_[False, np.isin(before[:-1], level.contexts) & left[:-1]]
            gain += np.where(known, np.r_[0.0, [level.gains.get(c, 0.0) for c in before[:-1].tolist()]], 0.0)
            gain += np.where(known, [level.listed.get(c, 0.0) for c in codes.tolist()], 0.0)
        return 10**gain


class Level:
    """The kept contexts of one length, and what they list, with their gains."""

    def __init__(self, kept: DataFrame, listed: DataFrame):
        self.gains, self.listed = ({r.code & ((1 << 64) - 1): r.value for r in as_rows(t).collect()} for t in (kept, listed))
        self.contexts = np.array(sorted(self.gains), np.uint64)


def grow(texts: DataFrame, counts: DataFrame, tokens: int, distinct: int, least: int = LEAST, depth: int = DEPTH) -> SuffixTree:
    """The tree of a few training texts, whose word counts are given, down to its longest
    kept context."""
    found = sorted(counts.where(F.col("n") >= least).collect(), key=lambda r: bytes(r.word))
    words = {bytes(r.word): FIRST + i for i, r in enumerate(found)}
    tree = SuffixTree(words, np.array([0, 0, *(r.n for r in found)], float), tokens, distinct)
    tree.levels = [Level(*x) for x in levels(texts, stored(keyed_counts(counts), "tree-words"), tokens, distinct, least, depth)]
    while tree.levels and not len(tree.levels[-1].contexts):
        tree.levels.pop()
    return tree


class AtHand:
    """gain and base of the most frequent sequences, each at the slot that its code's leading
    bits number. Of two at one slot one is not found here, and is met like the others."""

    def __init__(self, values: DataFrame):
        def steps(batches):
            """Rows by n; counts of 4096 and more are told apart by their highest bits alone."""
            for batch in batches:
                for _, n, _ in (unpacked(b, *VALUED) for b in batch.column(1).to_pylist()):
                    step, rows = np.unique(np.where(n < 4096, n, 1 << np.log2(n).astype(np.int64)), return_counts=True)
                    yield pa.RecordBatch.from_arrays([pa.array(step), pa.array(rows)], names=["step", "rows"])

        found = values.mapInArrow(steps, "step long, rows long").groupBy("step").agg(F.sum("rows").alias("rows"))
        total, least = 0, None
        for step, rows in found.orderBy(F.desc("step")).collect():  # some 4150 rows at most
            total += rows
            if total > AT_HAND:
                break
            least = step

        def frequent(batches):
            for batch in batches:
                for word, block in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                    codes, n, value = unpacked(block, *VALUED)
                    own = n >= least
                    if own.any():
                        value, none = value[own], np.zeros(own.sum())
                        columns = codes[own].view(np.int64), *((none, value) if word else (value, none))
                        yield pa.RecordBatch.from_arrays([*map(pa.array, columns)], names=["code", "gain", "base"])

        top = values.where(F.lit(least is not None)).mapInArrow(frequent, "code long, gain double, base double").toArrow()
        self.codes, self.gain, self.base = summed(top["code"].to_numpy().view(np.uint64), *(top[c].to_numpy() for c in ("gain", "base")))
        self.slots = np.zeros(4 * AT_HAND, np.int32)
        self.slots[self._slot(self.codes)] = np.arange(len(self.codes))

    def _slot(self, codes: np.ndarray) -> np.ndarray:
        return (codes >> np.uint64(32)) * np.uint64(len(self.slots)) >> np.uint64(32)

    def spots(self, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Where each code stands, if it does."""
        if not len(self.codes):
            return np.zeros(len(codes), np.int32), np.zeros(len(codes), bool)
        spot = self.slots[self._slot(codes)]
        return spot, self.codes[spot] == codes


def summed(codes: np.ndarray, gain: np.ndarray, base: np.ndarray) -> tuple[np.ndarray, ...]:
    """Gain and base of each code, by code; a code has a row for each of its parts."""
    order = np.argsort(codes)
    codes = codes[order]
    at = np.flatnonzero(np.r_[True, codes[1:] != codes[:-1]][: len(codes)])
    return codes[at], *(np.add.reduceat(x[order], at) if len(at) else x for x in (gain, base))


def met_sums(spot: np.ndarray, owner: np.ndarray, gain: np.ndarray, base: np.ndarray, sums: np.ndarray, words: bool = True) -> None:
    """Add the gain, the base and the number of known words that stand at each spot to its
    owner's sums; only ``words`` have a base."""
    sums[0] += np.bincount(owner, gain[spot], len(sums[0]))
    if words:
        base = base[spot]
        sums[1] += np.bincount(owner, base, len(sums[1]))
        sums[2] += np.bincount(owner[base > 0], minlength=len(sums[2]))


SCORED = "row long, id {kind}, held_out boolean, n_tokens long, gain double, base double, known double"


def score_texts(docs: DataFrame, key: str = "doc_id", text: str = "text", folds: int = FOLDS, held_out: int = 1, least: int = LEAST, depth: int = DEPTH) -> DataFrame:
    """key, held_out, n_tokens, n_known, train_tokens, base_score, score: one row per row.

    Learns from the texts whose id hash, modulo ``folds``, is not ``held_out``.
    """
    plain = docs.select(F.col(key).alias("id"), text_or_empty(text).alias("text"), (bucket_of(key, folds) == held_out).alias("held_out"))
    train = plain.where("not held_out").select("text")
    counts = stored(key_counts(train), "tree-words")
    tokens, distinct = counts.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count("*")).first()
    bits = buckets(tokens, COUNTED_TOKENS)
    # beyond what a word that is not known has, so more than 0 for the words and them alone
    base = (F.log10(F.col("n") + 0.5) - math.log10(0.5)).alias("base")
    values = stored(as_blocks(counts.select("code", "n", base), bits), "tree-bases").select(F.lit(True).alias("word"), "block", "bucket")
    grown = levels(train, counts, tokens, distinct, least, depth)
    discard(counts)
    filters = []
    for tables in zip(*grown, strict=True):  # the kept contexts, and what they list
        tables = reduce(DataFrame.unionAll, tables)
        filters.append(filter_of(tables))
        values = values.unionAll(tables.select(F.lit(False).alias("word"), "block", "bucket"))
    # a word or a sequence that is a kept context too has two rows, of the same n
    top = AtHand(values.select("word", "block"))
    kind = dict(plain.dtypes)["id"]
    schema = SCORED.format(kind=kind)
    names = [x.split()[0] for x in schema.split(", ")]

    def run(batches):
        numbers = row_numbers()
        held: list[tuple[np.ndarray, np.ndarray]] = []
        first = None

        def places():
            codes, rows = (np.concatenate(x) for x in zip(*held, strict=True))
            held.clear()
            order = np.argsort(codes)
            codes, rows = codes[order], rows[order]
            for bucket, own in cuts(bits, codes):
                block = [pa.array([first]), pa.array([packed(codes[own], rows[own])], pa.binary()), pa.array([bucket])]
                yield pa.RecordBatch.from_arrays([*(pa.nulls(1, t) for t in kinds), *block], names=[*names, "shift", "block", "bucket"])

        for batch in slices(batches, 1, 1 << 20):
            ids, number = keyed(batch.column(1))
            row = np.array([next(numbers) for _ in range(batch.num_rows)], np.int64)
            first = int(row[0]) if not held else first
            sums = np.zeros((3, len(row)))
            for length, (codes, asked) in enumerate(met_sequences(ids, depth + 1, filters), 1):
                at = np.flatnonzero(asked)
                codes, owner = codes[at], number[at]
                spot, near = top.spots(codes)
                met_sums(spot[near], owner[near], top.gain, top.base, sums, length == 1)
                if not near.all():
                    held.append((codes[~near], (row[owner[~near]] - first).astype(np.int32)))
            n_tokens = np.bincount(number, minlength=len(row)) - 1
            columns = [pa.array(row), batch.column(0), batch.column(2), pa.array(n_tokens), *map(pa.array, sums)]
            kinds = [c.type for c in columns]
            more = [pa.array(np.full(len(row), first)), pa.nulls(len(row), pa.binary()), pa.array(row & ((1 << bits) - 1))]
            yield pa.RecordBatch.from_arrays([*columns, *more], names=[*names, "shift", "block", "bucket"])
            if sum(len(c) for c, _ in held) > HELD_PLACES or held and row[-1] - first >= HELD_ROWS:
                yield from places()
        if held:
            yield from places()

    def met(own: pa.Table, found: pa.Table) -> pa.Table:
        """The texts' own rows, and a block of what a block's texts have besides."""
        words, others = (gathered(found.filter(pc.equal(found["word"], word))["block"], *VALUED) for word in (True, False))
        none = np.zeros(len(words[0])), np.zeros(len(others[0]))
        codes, gain, base = summed(*map(np.concatenate, ((words[0], others[0]), (none[0], others[2]), (words[2], none[1]))))
        own = own.select([*names, "shift", "block"])
        places = own.filter(pc.is_valid(own["block"]))
        shifts, blocks = [], []
        for shift, block in zip(places["shift"].to_pylist(), places["block"], strict=True):
            wanted, rows = unpacked(block.as_py(), np.int32)
            spot, there = found_at(codes, wanted)
            sums = np.zeros((3, int(rows.max()) + 1))
            met_sums(spot[there], rows[there], gain, base, sums)
            which = np.flatnonzero(sums.any(axis=0))
            if len(which):
                shifts.append(shift)
                blocks.append(packed(which.astype(np.uint64), *sums[:, which]))
        columns = [*(pa.nulls(len(blocks), own.schema.field(c).type) for c in names), pa.array(shifts, pa.int64()), pa.array(blocks, own.schema.field("block").type)]
        return pa.concat_tables([own.filter(pc.is_null(own["block"])), pa.table(columns, schema=own.schema)])

    def total(group: pa.Table) -> pa.Table:
        """The rows of one shift, with what its blocks add to them."""
        own = group.filter(pc.is_null(group["block"])).sort_by("row")
        rows = own["row"].to_numpy()
        sums = np.array([own[c].to_numpy() for c in names[4:]])
        for shift, block in zip(group["shift"].to_pylist(), group["block"], strict=True):
            if block.is_valid:
                which, *more = unpacked(block.as_py(), *[np.float64] * 3)
                sums[:, np.searchsorted(rows, which.astype(np.int64) + shift)] += more
        return pa.table([*(own[c] for c in names[:4]), *map(pa.array, sums)], names=names)

    placed = plain.mapInArrow(run, f"{schema}, shift long, block binary, bucket long")
    scored = placed.groupBy("bucket").cogroup(values.groupBy("bucket")).applyInArrow(met, f"{schema}, shift long, block binary")
    sums = scored.groupBy("shift").applyInArrow(total, schema)
    norm = math.log10(tokens + 0.5 * (distinct + 1))
    base = F.col("base") + F.col("n_tokens") * (math.log10(0.5) - norm)
    return sums.select(
        F.col("id").alias(key),
        "held_out",
        "n_tokens",
        F.round("known").cast("long").alias("n_known"),
        F.lit(tokens).cast("long").alias("train_tokens"),
        base.alias("base_score"),
        (base + F.col("gain")).alias("score"),
    )
