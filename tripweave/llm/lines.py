"""Repeated runs of lines, by a suffix array over line numbers.

Each line gets a number, its hash; a text is the sequence of its lines' numbers, and a
suffix begins at each line. Prefix doubling ranks the suffixes by their first 1, 2, 4, ...
lines: the rank by 2h lines is that of the pair (rank by h lines here, rank by h lines h
lines further on). Ranks come from one distributed sort a round; a suffix that is alone in
its rank, or ends, has no copy and drops out, so the rounds shrink. They end with the
largest power of two up to ``MIN_LINES``; two such ranks that overlap rank by exactly
``MIN_LINES`` lines. Suffixes of equal rank are then the intervals of the suffix array
whose longest common prefix has ``MIN_LINES`` lines or more.

Of each interval all suffixes but the earliest are later copies, and the ``MIN_LINES``
lines that they begin with are deleted; where the next suffix is a copy too, one run goes
on, and a maximal run of copies is one whose lines follow each other in the earliest copy
as well. Earlier is by id (null ids last), then by a hash of the text, then by line.
Lines are what newlines separate, compared whole; null
counts as the empty text, which has one empty line. Repeated rows (equal id and text) are
one text and share the result. A table without rows gives none; other columns are not read.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, functions as F

from tripweave.llm.common import slices, stored, utf8
from tripweave.llm.suffixes import keyed

MIN_LINES = 3


def _group_starts(batches, keys: int):
    """Rows sorted by their first columns: each with its number in the partition and that
    of the first row with the same key."""
    place, number, start, before = TaskContext.get().partitionId(), 0, 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)])
        fresh = np.r_[before is None or bool((values[:, 0] != before).any()), (values[:, 1:] != values[:, :-1]).any(axis=0)]
        numbers = number + np.arange(batch.num_rows)
        starts = np.maximum.accumulate(np.where(fresh, numbers, start))
        number, start, before = number + batch.num_rows, int(starts[-1]), values[:, -1]
        more = [pa.array(np.full(batch.num_rows, place, np.int32)), pa.array(numbers), pa.array(starts)]
        yield pa.RecordBatch.from_arrays([*batch.columns, *more], names=[*batch.schema.names, "place", "number", "start"])


def ranked(rows: DataFrame, keys: list[str], name: str) -> DataFrame:
    """row, pos, rank of the rows whose keys occur more than once; the rank is the number
    of rows with smaller keys. Equal keys may lie in several partitions: of each partition
    only its size and its first and last key come to the driver."""
    order = [*keys, "row", "pos"]
    parts = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ordered = rows.select(*order).repartitionByRange(parts, *order).sortWithinPartitions(*order)
    schema = ", ".join(f"{c} {t}" for c, t in ordered.dtypes)
    numbered = stored(ordered.mapInArrow(lambda b: _group_starts(b, len(keys)), f"{schema}, place int, number long, start long"), f"{name}-sorted")
    key = F.struct(*keys)
    edges = numbered.groupBy("place").agg(
        F.count("*").alias("n"), F.min_by(key, "number").alias("first"), F.max_by(key, "number").alias("last"), F.max("start").alias("start")
    )
    offset, carried, last, shifts = 0, 0, None, []
    for e in sorted(edges.collect(), key=lambda e: e.place):
        own = carried if last is not None and e.first == last else offset
        shifts.append((e.place, offset, own))
        carried = own if e.start == 0 else offset + e.start
        offset, last = offset + e.n, e.last
    moved = rows.sparkSession.createDataFrame(shifts, "place int, offset long, own long")
    rank = F.when(F.col("start") == 0, F.col("own")).otherwise(F.col("offset") + F.col("start"))
    # one row per partition, so it may be broadcast
    all_ranks = numbered.join(F.broadcast(moved), "place").select("row", "pos", rank.alias("rank"))
    again = all_ranks.groupBy("rank").agg(F.count("*").alias("n")).where("n > 1").select("rank")
    return stored(all_ranks.join(again, "rank").select("row", "pos", "rank"), f"{name}-ranks")


def doubled(lines: DataFrame, length: int) -> list[DataFrame]:
    """Ranks (row, pos, rank) by 1, 2, 4, ... lines, up to ``length``, of the suffixes that
    share them."""
    levels = [ranked(lines, ["line"], "lines-1")]
    while (width := 1 << len(levels)) <= length:
        here = levels[-1]
        there = here.select("row", (F.col("pos") - width // 2).alias("pos"), F.col("rank").alias("then"))
        levels.append(ranked(here.join(there, ["row", "pos"]), ["rank", "then"], f"lines-{width}"))
    return levels


def windows(lines: DataFrame, length: int) -> DataFrame:
    """row, pos, name: equal names for equal runs of ``length`` lines that come twice."""
    levels = doubled(lines, length)
    here, gap = levels[-1], length - (1 << (len(levels) - 1))
    if not gap:
        return here.withColumnRenamed("rank", "name")
    there = here.select("row", (F.col("pos") - gap).alias("pos"), F.col("rank").alias("then"))
    return here.join(there, ["row", "pos"]).select("row", "pos", F.xxhash64("rank", "then").alias("name"))


def _order(key: str) -> Column:
    return F.struct(F.col(key).isNull().alias("none"), F.col(key).alias("key"), F.col("row").alias("row"), F.col("pos").alias("pos"))


def longest_copy(copies: list[dict], min_lines: int) -> int:
    """The lines of the longest maximal run of copies."""
    best = run = 0
    before = None
    for c in sorted(copies, key=lambda c: c["pos"]):
        now = (c["row"], c["pos"] - c["first"])
        run = run + 1 if before == (*now, c["pos"] - 1) else 1
        best, before = max(best, run), (*now, c["pos"])
    return best + min_lines - 1 if best else 0


def line_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", min_lines: int = MIN_LINES) -> DataFrame:
    """key, n_lines, n_removed, n_runs (removed ones), longest_copy (lines of the longest
    maximal run of copies), kept: one row per row."""
    if min_lines < 1:
        raise ValueError("a run has at least one line")
    plain = keyed(docs, key, text)
    exploded = plain.select("row", key, F.posexplode(F.split("text", "\n", -1)).alias("pos", "content"))
    lines = stored(exploded.select("row", F.col("pos").cast("long").alias("pos"), F.xxhash64("content").alias("line"), key).distinct(), "lines")
    kind = dict(plain.dtypes)[key]
    ids = stored(windows(lines, min_lines).join(lines, ["row", "pos"]).select("row", "pos", "name", _order(key).alias("at")), "lines-windows")
    firsts = ids.groupBy("name").agg(F.min("at").alias("first"))
    copy = F.struct("pos", F.col("first.row").alias("row"), F.col("first.pos").alias("first"))
    later = ids.join(firsts, "name").where("at <> first").groupBy("row").agg(F.collect_list(copy).alias("copies"))

    def cut(batches):
        for batch in slices(batches, 1):
            out = []
            for raw, copies in zip(utf8(batch.column(1)), batch.column(2).to_pylist(), strict=True):
                parts = raw.split(b"\n")
                gone = np.zeros(len(parts) + 1, bool)
                starts = np.array([c["pos"] for c in copies or ()], np.int64)
                for back in range(min_lines):
                    gone[starts + back] = True
                kept = b"\n".join(p for p, g in zip(parts, gone.tolist(), strict=False) if not g)
                runs = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
                out.append((len(parts), int(gone.sum()), runs, longest_copy(copies or [], min_lines), kept))
            kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.binary()]
            columns = [pa.array(c, t) for c, t in zip(zip(*out, strict=True), kinds, strict=True)]
            yield pa.RecordBatch.from_arrays([batch.column(0), *columns], names=["key", "n_lines", "n_removed", "n_runs", "longest_copy", "kept"])

    joined = plain.join(later, "row", "left").select(F.col(key).alias("key"), "text", "copies")
    done = joined.mapInArrow(cut, f"key {kind}, n_lines long, n_removed long, n_runs long, longest_copy long, kept binary")
    return done.withColumnRenamed("key", key)
