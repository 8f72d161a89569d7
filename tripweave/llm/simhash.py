"""SimHash fingerprints, and all fingerprints within a Hamming radius.

Terms are word shingles; each votes with its weight, 1 + ln(number of times it occurs),
for or against every bit, by its own hash bits. Two texts' share of differing bits tells
the angle between their weighted term vectors, and the likeness is that angle's cosine,
0 at least: 1 for equal terms, about 0 for texts without common terms.

``near_classes`` finds what lies within a radius by permuted block tables: the bits are
cut into blocks, and two fingerprints that differ in at most ``RADIUS`` bits agree in whole
blocks wherever these differences lie; there is a table for each choice of the blocks that
must agree. Only distinct fingerprints are looked up, so copies cost nothing, and no
table's bucket is paired out: members are compared with the bucket's most central one
first, and then only across components, in blocks of bounded size.

The edited text of a document takes the place of its second half from the next document.
Documents are range-sorted by id once; a task sees each one and its successor as they pass
by. Only the last document of a partition waits for the first one of the next.

Null texts count as empty. Empty texts have the fingerprint of no votes, all bits 0; they
are like each other and unlike any text with a term. Null ids come last; rows with equal
ids follow each other by a hash of their text. A table without rows gives none.
"""

from __future__ import annotations

import hashlib
from itertools import combinations, pairwise

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window, functions as F

from tripweave.llm.common import slices, stored
from tripweave.llm.graphs import components
from tripweave.llm.near import bucket_members, remaining_links
from tripweave.llm.rolling import mixed
from tripweave.llm.suffixes import keyed
from tripweave.llm.words import all_shingle_hashes

SHINGLE = 3
BITS = 128
RADIUS = 3
BLOCKS = 5
CHUNK = 1 << 14


def fingerprint(terms: np.ndarray) -> bytes:
    """``BITS`` bits from the hashes of a text's terms."""
    if not len(terms):
        return bytes(BITS // 8)
    distinct, times = np.unique(terms, return_counts=True)
    weights = (1 + np.log(times)).astype(np.float32)
    votes = np.zeros(BITS, np.float64)
    for at in range(0, len(distinct), CHUNK):
        some = distinct[at : at + CHUNK]
        words = np.stack([mixed(some + np.uint64(1 + i)) for i in range(BITS // 64)], axis=1)
        bits = np.unpackbits(words.view(np.uint8), axis=1)
        part = weights[at : at + CHUNK]
        votes += 2 * (part @ bits.astype(np.float32)) - part.sum(dtype=np.float64)
    bits = votes > 0
    if not bits.any():
        bits[-1] = True  # no text with terms looks empty
    return np.packbits(bits).tobytes()


def fingerprints(texts: list[str]) -> list[bytes]:
    return [fingerprint(terms) for terms in all_shingle_hashes([t.encode() for t in texts], SHINGLE)]


def likeness(a: bytes, b: bytes) -> float:
    """0 to 1, from the share of bits that differ."""
    if a == b:
        return 1.0
    if not any(a) or not any(b):
        return 0.0
    differing = (int.from_bytes(a) ^ int.from_bytes(b)).bit_count()
    return max(0.0, float(np.cos(np.pi * differing / BITS)))


def edited(text: str, following: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + following[:half]


def table_keys(prints: list[bytes], radius: int = RADIUS, blocks: int = BLOCKS) -> list[list[int]]:
    """For each fingerprint its key in each block table."""
    if not prints:
        return []
    if blocks <= radius:
        raise ValueError("more blocks than differing bits are needed")
    bits = np.unpackbits(np.frombuffer(b"".join(prints), np.uint8).reshape(len(prints), -1), axis=1)
    parts = np.array_split(np.arange(BITS), blocks)
    keys = []
    for number, chosen in enumerate(combinations(range(blocks), blocks - radius)):
        packed = np.packbits(bits[:, np.concatenate([parts[i] for i in chosen])], axis=1)
        wide = np.zeros((len(prints), -(-packed.shape[1] // 8) * 8), np.uint8)
        wide[:, : packed.shape[1]] = packed
        key = np.full(len(prints), number, np.uint64)
        for word in wide.view(np.uint64).T:
            key = mixed(key * np.uint64(31) + word)
        keys.append(key)
    return np.stack(keys, axis=1).view(np.int64).tolist()


PRINTS = "place int, edge string, key {kind}, text string, n_chars long, edited_sha256 string, print binary, edited_print binary, near_edited double, near_next double"


def _names(schema: str) -> list[str]:
    return [x.split()[0] for x in schema.split(", ")]


def _result(text: str, following: str, own: bytes, after: bytes, changed: bytes, new: str) -> tuple:
    return len(text), hashlib.sha256(new.encode()).hexdigest(), own, changed, likeness(own, changed), likeness(own, after)


def _in_order(batches, schema: str, key_type):
    """Sorted documents: each with its successor, and the partition's edges for later."""
    place = TaskContext.get().partitionId()
    names = _names(schema)
    kinds = [pa.int32(), pa.string(), key_type, pa.string(), pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]

    def batch_of(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    before = None
    for batch in slices(batches, 1, 4 << 20):
        texts = [t or "" for t in batch.column(1).to_pylist()]
        docs = list(zip(batch.column(0).to_pylist(), texts, fingerprints(texts), strict=True))
        rows = [] if before else [(place, "first", None, docs[0][1], *[None] * 6)]
        chain = [before, *docs] if before else docs
        new = [edited(a[1], b[1]) for a, b in pairwise(chain)]
        for (a, b), text, changed in zip(pairwise(chain), new, fingerprints(new), strict=True):
            rows.append((place, None, a[0], None, *_result(a[1], b[1], a[2], b[2], changed, text)))
        before = docs[-1]
        if rows:
            yield batch_of(rows)
    if before:
        yield batch_of([(place, "last", before[0], before[1], *[None] * 6)])


def edited_likeness(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """key, n_chars, edited_sha256, print, edited_print (binary), near_edited, near_next."""
    plain = keyed(docs, key, text)
    kind = dict(plain.dtypes)[key]
    schema = PRINTS.format(kind=kind)
    parts = int(plain.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    order = [F.col(key).asc_nulls_last(), F.col("row")]
    ranged = plain.repartitionByRange(parts, *order).sortWithinPartitions(*order).select(key, "text")

    def run(batches):
        first = next(iter_batches := iter(batches), None)
        if first is None:
            return
        yield from _in_order((b for part in ([first], iter_batches) for b in part), schema, first.schema.field(0).type)

    passed = stored(ranged.mapInArrow(run, schema), "simhash-prints")
    # of each partition one number, its place in the order
    places = passed.where("edge = 'first'").select("place")
    around = Window.orderBy("place")
    turns = places.select("place", F.coalesce(F.lead("place").over(around), F.min("place").over(around)).alias("next_place"))
    firsts = passed.where("edge = 'first'").select(F.col("place").alias("next_place"), F.col("text").alias("following"))
    lasts = passed.where("edge = 'last'").select("place", "key", "text").join(turns, "place").join(firsts, "next_place")

    def close(batches):
        for batch in slices(batches, 1):
            keys, texts, after = (batch.column(i).to_pylist() for i in range(3))
            new = [edited(a, b) for a, b in zip(texts, after, strict=True)]
            prints = [fingerprints(x) for x in (texts, after, new)]
            rows = [(k, *_result(a, b, x, y, z, t)) for k, a, b, x, y, z, t in zip(keys, texts, after, *prints, new, strict=True)]
            kinds = [batch.schema.field(0).type, pa.int64(), pa.string(), pa.binary(), pa.binary(), pa.float64(), pa.float64()]
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), kinds, strict=True)], names=names)

    wanted = [x for x in schema.split(", ") if not x.startswith(("place ", "edge ", "text "))]
    names = _names(", ".join(wanted))
    closed = lasts.select("key", "text", "following").mapInArrow(close, ", ".join(wanted))
    return passed.where("edge is null").select(*names).unionByName(closed).withColumnRenamed("key", key)


class WithinRadius:
    """Fingerprints whose differing bits are few: nothing more to ask."""

    def prepare(self, value) -> None:
        return None

    def linked(self, x, y) -> bool:
        return True


def near_classes(prints: DataFrame, column: str = "print", radius: int = RADIUS, blocks: int = BLOCKS) -> DataFrame:
    """Distinct fingerprints with the class each belongs to: print, near_class (the least
    fingerprint, in hexadecimal, reachable in steps of at most ``radius`` bits)."""
    distinct = prints.select(F.col(column).alias("print")).distinct().withColumn("node", F.xxhash64("print"))

    def keys(batches):
        for batch in batches:
            made = table_keys(batch.column(0).to_pylist(), radius, blocks)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(made, pa.list_(pa.int64()))], names=["print", "node", "keys"])

    table = stored(distinct.mapInArrow(keys, "print binary, node long, keys array<long>"), "simhash-tables")
    members, stars = bucket_members(table.select("node", F.explode("keys").alias("band")), "simhash")
    own = table.select("node", "print")

    def words(c: str) -> list:
        return [F.conv(F.substring(F.hex(c), 1 + 8 * i, 8), 16, 10).cast("long") for i in range(BITS // 32)]

    a, b = (own.select(F.col("node").alias(x), F.col("print").alias(f"print_{x}")) for x in "ab")
    both = stars.join(a, "a").join(b, "b")
    differing = sum(F.bit_count(x.bitwiseXOR(y)) for x, y in zip(words("print_a"), words("print_b"), strict=True))
    first = stored(both.where(differing <= radius).select("a", "b"), "simhash-links")
    close = np.arange(BITS + 1) <= radius
    nodes = own.select("node", F.col("print").alias("sketch"), F.lit(None).cast("string").alias("value"))
    more = remaining_links(members, nodes, components(first), close, WithinRadius(), "simhash")
    labels = components(first.unionAll(more))
    placed = own.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    names = placed.groupBy("component").agg(F.lower(F.hex(F.min("print"))).alias("near_class"))
    return placed.join(names, "component").select("print", "near_class")
