"""Repeated passages by a depth-limited radix sort of suffixes.

Suffixes are told apart only up to ``length`` bytes, most significant digit first: a pass
splits every group by the next digit and drops the suffixes that are alone, so that what
is left after the last digit, in groups of two and more, are exactly the windows of
``length`` bytes that occur again.

The first digit is not taken at the start of each window but at its anchor: the place
inside the window whose ``K`` bytes have the smallest hash, the leftmost of equal ones.
Equal windows have equal anchors at equal distances, and neighbouring windows share
theirs, so the first pass sorts one row per anchor (about one per 80 bytes) and not one
per byte. The digits are

1. the ``K`` bytes at the anchor: anchors that are alone in this are dropped;
2. the stretch that all windows of the anchor cover together: where that occurs again, all
   of these windows do;
3. for what the second digit leaves alone within a group of the first, and for one of each
   group of equal stretches beside it: the bytes that ``STEP`` neighbouring windows, at a
   fixed distance from the anchor, have in common;
4. the stretch that these few windows cover together;
5. for what is alone in that, and one of each group beside it: every whole window.

Digits are compared by 64-bit hashes. A task first compares the rows it has at hand: of
equal digits only one row leaves it, so that a passage that stands in a third of all texts
crosses the network once per task. Rows of one group with different next digits are never
gathered in one place.

Windows never cross texts. Null texts count as empty; texts shorter than ``length`` have
no windows. Rows that are equal in key and text are copies of each other like any two
texts. A table without rows gives none. Other columns are not read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from tripweave.llm.common import slices, stored, text_or_empty, utf8
from tripweave.llm.rolling import LIMIT, Rolling, mixed, sliding_min

LENGTH = 200
K = 32
STEP = 16
HELD_ROWS = 250_000


def units(texts: list[bytes], length: int, limit: int = LIMIT) -> Iterator[list[tuple[int, int, bytes]]]:
    """Groups of (text number, offset, bytes) of ``limit`` bytes at most; longer texts come
    in stretches that overlap such that each window lies in just one."""
    held, size = [], 0
    for i, text in enumerate(texts):
        at = 0
        while at == 0 or at + length <= len(text):
            part = text[at : at + limit]
            if size + len(part) > limit:
                yield held
                held, size = [], 0
            held.append((i, at, part))
            size += len(part)
            at += limit - length + 1
    if held:
        yield held


def laid_out(group: list[tuple[int, int, bytes]]) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """bytes end to end; start and end of each part; what to add to a place to get the
    place in its text."""
    data = np.frombuffer(b"".join(part for _, _, part in group), np.uint8)
    ends = np.cumsum([len(part) for _, _, part in group])
    starts = ends - [len(part) for _, _, part in group]
    return data, starts, ends, np.array([at for _, at, _ in group]) - starts


def merged(rows: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Overlapping or touching stretches of each row made one."""
    if not len(rows):
        return rows, starts, ends
    order = np.lexsort((starts, rows))
    rows, starts, ends = rows[order], starts[order], ends[order]
    fresh = np.r_[True, rows[1:] != rows[:-1]]
    number = np.cumsum(fresh)
    reach = np.maximum.accumulate(ends + number * (np.int64(1) << 40)) - number * (np.int64(1) << 40)
    first = fresh | np.r_[True, starts[1:] > reach[:-1]]
    at = np.flatnonzero(first)
    return rows[at], starts[at], reach[np.r_[at[1:] - 1, len(rows) - 1]]


def groups_of(keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(order by key, first of each group in that order, group sizes)."""
    order = np.argsort(keys, kind="stable")
    ordered = keys[order]
    at = np.flatnonzero(np.r_[True, ordered[1:] != ordered[:-1]]) if len(keys) else np.array([], np.int64)
    return order, at, np.diff(np.r_[at, len(keys)])


class Anchors:
    """The anchors of the windows of a group of texts."""

    def __init__(self, group: list[tuple[int, int, bytes]], length: int, k: int):
        data, starts, ends, shift = laid_out(group)
        hashes = Rolling(data)
        bytes_at = hashes.every(k)
        self.text = self.lo = self.hi = self.anchor = np.array([], np.int64)
        self.first = self.second = np.array([], np.uint64)
        n = len(data) - length + 1
        if n <= 0:
            return
        places = np.arange(len(bytes_at), dtype=np.uint64)
        ranked = (bytes_at & ~np.uint64(LIMIT - 1)) | places
        lowest = sliding_min(ranked, length - k + 1)[:n] & np.uint64(LIMIT - 1)
        inside = np.ones(n, bool)
        for start, end in zip(starts.tolist(), ends.tolist(), strict=True):
            inside[max(start, end - length + 1) : end] = False
        at = np.flatnonzero(inside)
        if not len(at):
            return
        anchor = lowest[at].astype(np.int64)
        new = np.flatnonzero(np.r_[True, (anchor[1:] != anchor[:-1]) | (at[1:] != at[:-1] + 1)])
        lo, hi = at[new], at[np.r_[new[1:] - 1, len(at) - 1]]
        anchor = anchor[new]
        part = np.searchsorted(ends, lo, "right")
        self.text = np.array([i for i, _, _ in group])[part]
        self.lo, self.hi, self.anchor = lo + shift[part], hi + shift[part], anchor + shift[part]
        self.first = bytes_at[anchor]
        stretch = hashes.at(lo, hi + length)
        self.second = mixed(stretch * np.uint64(3) + self.first + (anchor - lo).astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + (hi - lo).astype(np.uint64))


def packed(lo, hi, anchor):
    """First and last window and the anchor in one number."""
    return lo << 24 | (hi - lo) << 12 | (anchor - lo)


def unpacked(place):
    lo = place >> 24
    return lo, lo + (place >> 12 & 4095), lo + (place & 4095)


def _settled(rows: np.ndarray, lo: np.ndarray, hi: np.ndarray, inner: np.ndarray) -> tuple[np.ndarray, tuple]:
    """One row of each inner digit; the merged stretches of those that occur again here."""
    order, at, sizes = groups_of(inner)
    known = order[np.repeat(sizes > 1, sizes)]
    return order[at], merged(rows[known], lo[known], hi[known])


def _longs(own: np.ndarray, more: np.ndarray | None, n: int) -> pa.Array:
    return pa.concat_arrays([pa.array(own.astype(np.int64, copy=False)), pa.nulls(n, pa.int64()) if more is None else pa.array(more)])


FIRST_PASS = "row long, outer long, inner long, place long, lo long, hi long"


def _first_pass(batches, length: int, k: int):
    """Anchors, one row for equal ones, and the stretches these settle (lo, hi)."""
    held: list[tuple[np.ndarray, ...]] = []

    def done() -> pa.RecordBatch:
        rows, lo, hi, anchor, first, second = (np.concatenate(x) for x in zip(*held, strict=True))
        held.clear()
        own, (row, start, end) = _settled(rows, lo, hi + length, second)
        nothing, n = np.zeros(0, np.int64), len(row)
        columns = [
            pa.array(np.r_[rows[own], row]),
            _longs(first[own].view(np.int64), None, n),
            _longs(second[own].view(np.int64), None, n),
            _longs(packed(lo, hi, anchor)[own], None, n),
            pa.concat_arrays([pa.nulls(len(own), pa.int64()), pa.array(start if n else nothing)]),
            pa.concat_arrays([pa.nulls(len(own), pa.int64()), pa.array(end if n else nothing)]),
        ]
        return pa.RecordBatch.from_arrays(columns, names=["row", "outer", "inner", "place", "lo", "hi"])

    for batch in slices(batches, 1):
        keys = batch.column(0).to_numpy(zero_copy_only=False)
        for group in units(utf8(batch.column(1)), length):
            found = Anchors(group, length, k)
            if len(found.lo):
                held.append((keys[found.text], found.lo, found.hi, found.anchor, found.first, found.second))
        if sum(len(x[0]) for x in held) >= HELD_ROWS:
            yield done()
    if held:
        yield done()


STEP_PASS = "row long, outer long, inner long, first_window long, left binary, right binary, lo long, hi long"


def _step_pass(batches, length: int, step: int):
    """row, text, places -> a row for each ``step`` windows at a fixed distance from an
    anchor: the hash of what they have in common (outer), of what they cover (inner), and
    the few bytes on both sides that tell them apart."""
    held: list[tuple] = []

    def done() -> pa.RecordBatch:
        numbers = [np.concatenate([x[i] for x in held]) for i in range(5)]
        left, right = ([b for x in held for b in x[i]] for i in (5, 6))
        held.clear()
        rows, outer, inner, lo, hi = numbers
        own, (row, start, end) = _settled(rows, lo, hi + length, inner)
        n, chosen = len(row), own.tolist()
        gone, none = pa.nulls(n, pa.binary()), pa.nulls(len(own), pa.int64())
        columns = [
            pa.array(np.r_[rows[own], row]),
            _longs(outer[own].view(np.int64), None, n),
            _longs(inner[own].view(np.int64), None, n),
            _longs(lo[own], None, n),
            pa.concat_arrays([pa.array([left[i] for i in chosen], pa.binary()), gone]),
            pa.concat_arrays([pa.array([right[i] for i in chosen], pa.binary()), gone]),
            pa.concat_arrays([none, pa.array(start)]),
            pa.concat_arrays([none, pa.array(end)]),
        ]
        names = ["row", "outer", "inner", "first_window", "left", "right", "lo", "hi"]
        return pa.RecordBatch.from_arrays(columns, names=names)

    for batch in slices(batches, 1):
        keys, places = batch.column(0).to_pylist(), batch.column(2).to_pylist()
        for key, text, own in zip(keys, utf8(batch.column(1)), places, strict=True):
            lo, hi, anchor = unpacked(np.array(own, np.int64))
            # long texts by stretches that the hashes can hold
            for chunk in np.unique(anchor // (LIMIT // 2)):
                some = anchor // (LIMIT // 2) == chunk
                held.append(_steps(key, text, lo[some], hi[some], anchor[some], length, step))
        if sum(len(x[0]) for x in held) >= HELD_ROWS:
            yield done()
    if held:
        yield done()


def _steps(key: int, text: bytes, lo, hi, anchor, length: int, step: int) -> tuple:
    near, far = (anchor - hi) // step, (anchor - lo) // step
    times = far - near + 1
    which = np.repeat(np.arange(len(lo)), times)
    number = np.arange(len(which)) - np.repeat(np.cumsum(times) - times, times) + near[which]
    core = anchor[which] - number * step
    first = np.maximum(lo[which], core - step + 1)
    last = np.minimum(hi[which], core)
    core_end = core - step + 1 + length
    base = int(first.min())
    hashes = Rolling(np.frombuffer(text, np.uint8)[base : int(last.max()) + length])
    outer = mixed(hashes.at(core - base, core_end - base) + number.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    shape = (core - first).astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93) + (core - last).astype(np.uint64)
    inner = mixed(hashes.at(first - base, last + length - base) + outer * np.uint64(3) + shape)
    left = [text[a:b] for a, b in zip(first.tolist(), core.tolist(), strict=True)]
    right = [text[a:b] for a, b in zip(core_end.tolist(), (last + length).tolist(), strict=True)]
    return np.full(len(which), key, np.int64), outer, inner, first, last, left, right


WINDOWS = "window long, row long, lo long, hi long"


def _window_pass(batches, length: int, step: int):
    """Each window of the steps still open, told apart by what is left and right of what
    the step has in common."""
    held: list[tuple[int, int, int]] = []

    def done() -> pa.RecordBatch:
        window, rows, lo = (np.array(x) for x in zip(*held, strict=True))
        held.clear()
        own, (row, start, end) = _settled(rows, lo, lo + length, window)
        columns = [_longs(window[own], None, len(row)), *(pa.array(np.r_[a[own], b]) for a, b in ((rows, row), (lo, start), (lo + length, end)))]
        return pa.RecordBatch.from_arrays(columns, names=["window", "row", "lo", "hi"])

    for batch in batches:
        for row, outer, first, left, right in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            windows = len(left) + len(right) - step + 2
            for i in range(windows):
                before, beyond = left[i:], right[: len(right) - windows + 1 + i]
                seed = outer + 0x9E3779B97F4A7C15 * len(before) & (1 << 64) - 1
                code = xxhash.xxh64_intdigest(before + beyond, seed)
                held.append((code - (code >> 63 << 64), row, first + i))
        if len(held) >= HELD_ROWS:
            yield done()
    if held:
        yield done()


def keyed(docs: DataFrame, key: str, text: str, *more: Column) -> DataFrame:
    """key, text, row: a number that says key and text, whatever order rows are read in."""
    plain = docs.select(F.col(key), text_or_empty(text).alias("text"), *more)
    return plain.withColumn("row", F.xxhash64(F.col(key), F.col("text")))


def refined(table: DataFrame, name: str) -> tuple[list[DataFrame], DataFrame]:
    """One pass over the outer and the inner digit: (the rows that this settles, the rows
    still open). Rows that are alone in their outer digit are in neither."""
    groups = table.groupBy("outer").agg(F.count("*").alias("rows"), F.min("inner").alias("a"), F.max("inner").alias("b"))
    groups = groups.where("rows > 1").select("outer", (F.col("a") != F.col("b")).alias("split"))
    left = stored(table.join(groups, "outer"), f"suffix-{name}-outer")
    alike = Window.partitionBy("inner")
    split = left.where("split").withColumns(
        {"rows": F.count("*").over(alike), "turn": F.row_number().over(alike.orderBy("row"))}
    )
    split = stored(split, f"suffix-{name}-inner")
    return [left.where("not split"), split.where("rows > 1")], split.where("turn = 1")


def repeated_stretches(docs: DataFrame, length: int = LENGTH, k: int = K, step: int = STEP) -> DataFrame:
    """row, text -> row, lo, hi: stretches of bytes that cover all repeated windows."""
    if not k < length < 4096:
        raise ValueError("the first digit must be shorter than the window, and that less than 4096")
    step = min(step, length - 1)
    texts = docs.select("row", "text")
    passed = stored(texts.mapInArrow(lambda b: _first_pass(b, length, k), FIRST_PASS), "suffix-anchors")
    anchors = passed.where("outer is not null").select("row", "outer", "inner", "place")
    known, open_ = refined(anchors, "anchors")
    lo, count = F.shiftright("place", 24), F.shiftright("place", 12).bitwiseAND(4095)
    found = [passed, *(x.select("row", lo.alias("lo"), (lo + count + length).alias("hi")) for x in known)]

    listed = open_.groupBy("row").agg(F.collect_list("place").alias("places"))
    steps = stored(texts.join(listed, "row").mapInArrow(lambda b: _step_pass(b, length, step), STEP_PASS), "suffix-steps")
    some = steps.where("outer is not null").select("row", "outer", "inner", "first_window", "left", "right")
    known, open_ = refined(some, "steps")
    last = F.col("first_window") + F.octet_length("left") + F.octet_length("right") - step + 1
    found += [steps, *(x.select("row", F.col("first_window").alias("lo"), (last + length).alias("hi")) for x in known)]

    sides = open_.select("row", "outer", "first_window", "left", "right")
    windows = stored(sides.mapInArrow(lambda b: _window_pass(b, length, step), WINDOWS), "suffix-windows")
    again = windows.where("window is not null").withColumn("rows", F.count("*").over(Window.partitionBy("window")))
    found += [windows.where("window is null"), again.where("rows > 1")]

    first, *rest = (x.select("row", "lo", "hi").where("lo is not null") for x in found)
    for x in rest:
        first = first.unionAll(x)
    return first


def _whole_characters(text: bytes, start: int, end: int) -> tuple[int, int]:
    """The stretch without parts of characters at its ends."""
    while start < end and text[start] & 0xC0 == 0x80:
        start += 1
    while end > start and end < len(text) and text[end] & 0xC0 == 0x80:
        end -= 1
    return start, end


def remove_repeats(docs: DataFrame, key: str = "doc_id", text: str = "text", length: int = LENGTH, k: int = K, whole_characters: bool = False) -> DataFrame:
    """key, n_bytes, spans (array of start, end in bytes), kept (binary), others (the
    further columns of ``docs``, as a struct): one row per row.

    ``whole_characters`` leaves a character at the edge of a span in place when only a part
    of its bytes is repeated, so that ``kept`` is UTF-8.
    """
    rest = [F.col(c) for c in docs.columns if c not in (key, text)]
    texts = keyed(docs, key, text, F.struct(*(rest or [F.lit(0).alias("none")])).alias("others"))
    spans = repeated_stretches(texts, length, k).groupBy("row").agg(F.collect_list(F.struct("lo", "hi")).alias("stretches"))
    span_type = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))

    def cut(batches):
        for batch in slices(batches, 1):
            sizes, spans, kept = [], [], []
            for raw, stretches in zip(utf8(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                found = np.array([(s["lo"], s["hi"]) for s in stretches or ()], np.int64).reshape(-1, 2)
                _, starts, ends = merged(np.zeros(len(found), np.int64), found[:, 0], found[:, 1])
                runs = list(zip(starts.tolist(), ends.tolist(), strict=True))
                if whole_characters:
                    runs = [run for run in (_whole_characters(raw, *r) for r in runs) if run[0] < run[1]]
                edges = [0, *(x for run in runs for x in run), len(raw)]
                sizes.append(len(raw))
                spans.append([{"start": a, "end": b} for a, b in runs])
                kept.append(b"".join(raw[edges[i] : edges[i + 1]] for i in range(0, len(edges), 2)))
            columns = [batch.column(0), pa.array(sizes, pa.int64()), pa.array(spans, span_type), pa.array(kept, pa.binary()), batch.column(3)]
            yield pa.RecordBatch.from_arrays(columns, names=["key", "n_bytes", "spans", "kept", "others"])

    joined = texts.join(spans, "row", "left").select(F.col(key).alias("key"), "text", "stretches", "others")
    span = T.ArrayType(T.StructType([T.StructField("start", T.LongType()), T.StructField("end", T.LongType())]))
    kinds = [("key", joined.schema["key"].dataType), ("n_bytes", T.LongType()), ("spans", span), ("kept", T.BinaryType()), ("others", joined.schema["others"].dataType)]
    done = joined.mapInArrow(cut, T.StructType([T.StructField(*k) for k in kinds]))
    return done.withColumnRenamed("key", key)
