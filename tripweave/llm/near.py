"""Near duplicates by odd sketches.

Each text's set of word shingles gets ``SAMPLES`` MinHash samples. Bands of them name
buckets of candidates; the samples are also folded into an odd sketch, a bitmap in which
every sample flips one bit. The population count of two sketches' XOR estimates how many
samples differ, precisely where the similarity is high, and so tells which candidates are
worth comparing. Links are confirmed on the full sets: 100 * intersection >= 75 * union.

No group is paired out. Texts with equal sets are one class with one representative. In a
first round every representative is compared with one hub: of its buckets' members the one
that shares the most buckets with others, which in a group of edited copies is the text
they were made from. What that links is joined into components. A bucket whose members
are all in one component has nothing more to tell. The others form families, in which the
members outside the family's largest component are compared with the members of other
components, in blocks of bounded size: by sketch first, and where the sketches are close
enough by the full sets, unless other links have joined their components meanwhile. Only
links that join something leave the task. So a link can be lost only where all bands miss
(about 5e-6 at a similarity of 0.75, less above) or a sketch is off by more than ``SLACK``
(about 1e-6), and never by a group's size.

Null texts and texts without words have an empty set, are linked with nothing and are
their own component. A text with fewer words than a shingle is one shingle. Repeated rows
(equal id and text) share their component; null ids are nobody's smallest id. A table
without rows gives none. Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tripweave.llm.common import slices, stored, utf8
from tripweave.llm.graphs import components
from tripweave.llm.rolling import mixed
from tripweave.llm.suffixes import keyed
from tripweave.llm.words import same_shingles, shingle_hashes

SHINGLE = 5
PERCENT = 75
SAMPLES = 128
BAND = 4
BITS = 512
SLACK = 0.2
BLOCK = 256
PART = 512


@lru_cache(maxsize=1)
def _samplers() -> tuple[np.ndarray, np.ndarray]:
    seeds = mixed(np.arange(1, 2 * SAMPLES + 1, dtype=np.uint64) * np.uint64(0xA24BAED4963EE407))
    return seeds[:SAMPLES] | np.uint64(1), seeds[SAMPLES:]


def samples_of(sets: list[np.ndarray]) -> np.ndarray:
    """One row of MinHash samples for each of the sets, none of which is empty."""
    factors, shifts = _samplers()
    flat = np.concatenate(sets)
    starts = np.r_[0, np.cumsum([len(s) for s in sets])[:-1]]
    out = np.empty((len(sets), SAMPLES), np.uint64)
    for k in range(SAMPLES):
        out[:, k] = np.minimum.reduceat(flat * factors[k] + shifts[k], starts)
    return mixed(out)


def band_keys(samples: np.ndarray) -> np.ndarray:
    bands = samples.reshape(len(samples), -1, BAND)
    keys = np.zeros(bands.shape[:2], np.uint64)
    for k in range(BAND):
        keys = mixed(keys * np.uint64(31) + bands[:, :, k])
    return mixed(keys + np.arange(bands.shape[1], dtype=np.uint64)).view(np.int64)


def odd_sketches(samples: np.ndarray) -> np.ndarray:
    """One bitmap of ``BITS`` parities per row, as bytes."""
    place = mixed(samples + np.arange(SAMPLES, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(BITS)
    cells = np.arange(len(samples))[:, None] * BITS + place.astype(np.int64)
    parity = np.bincount(cells.ravel(), minlength=len(samples) * BITS) & 1
    return np.packbits(parity.reshape(-1, BITS).astype(np.uint8), axis=1)


def estimates() -> np.ndarray:
    """The similarity that each number of differing bits stands for."""
    odd = np.minimum(np.arange(BITS + 1) / BITS, 0.4999)
    differing = np.log1p(-2 * odd) / np.log1p(-2 / BITS) / 2
    return 1 - differing / SAMPLES


SIGNATURE = "node long, id {kind}, n_shingles long, set binary, bands array<long>, sketch binary"


def signatures(docs: DataFrame, key: str) -> DataFrame:
    """From key, text, row: the set's size and digest, band keys and sketch."""
    schema = SIGNATURE.format(kind=dict(docs.dtypes)[key])

    def run(batches):
        for batch in slices(batches, 1):
            sets = list(shingle_hashes(utf8(batch.column(1)), SHINGLE))
            full = [i for i, s in enumerate(sets) if len(s)]
            bands, sketches = [None] * len(sets), [None] * len(sets)
            for at in range(0, len(full), 256):
                some = full[at : at + 256]
                samples = samples_of([sets[i] for i in some])
                for i, keys, sketch in zip(some, band_keys(samples).tolist(), odd_sketches(samples), strict=True):
                    bands[i], sketches[i] = keys, sketch.tobytes()
            columns = [
                batch.column(2),
                batch.column(0),
                pa.array([len(s) for s in sets], pa.int64()),
                pa.array([hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None for s in sets], pa.binary()),
                pa.array(bands, pa.list_(pa.int64())),
                pa.array(sketches, pa.binary()),
            ]
            yield pa.RecordBatch.from_arrays(columns, names=["node", "id", "n_shingles", "set", "bands", "sketch"])

    return docs.select(key, "text", "row").mapInArrow(run, schema)


def confirmed(pairs: DataFrame, texts: DataFrame, percent: int = PERCENT) -> DataFrame:
    """The pairs (a, b) whose full sets are similar enough; texts: node, text."""
    one = texts.select(F.col("node").alias("b"), F.col("text").alias("text_b"))
    two = texts.select(F.col("node").alias("a"), F.col("text").alias("text_a"))

    def run(batches):
        alike = SameShingles(percent)
        for batch in slices(batches, 3, 2 << 20):
            one, two = (utf8(batch.column(i)) for i in (2, 3))
            sets = [list(shingle_hashes(texts, SHINGLE)) for texts in (one, two)]
            keep = [alike.linked((x, s), (y, t)) for x, s, y, t in zip(sets[0], one, sets[1], two, strict=True)]
            yield batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    joined = pairs.join(one, "b").join(two, "a").select("a", "b", "text_a", "text_b")
    return joined.mapInArrow(run, "a long, b long")


def _groups(batches, keys: int) -> Iterator[pa.Table]:
    """The rows of each key, from batches sorted by their first columns."""
    held, current = [], None
    for batch in batches:
        if not batch.num_rows:
            continue
        values = np.stack([batch.column(i).to_numpy(zero_copy_only=False) for i in range(keys)])
        edges = np.flatnonzero((values[:, 1:] != values[:, :-1]).any(axis=0)) + 1
        cuts = [0, *edges.tolist(), batch.num_rows]
        for start, end in zip(cuts, cuts[1:], strict=False):
            key = tuple(values[:, start].tolist())
            if key != current and held:
                yield pa.Table.from_batches(held)
                held = []
            current = key
            held.append(batch.slice(start, end - start))
    if held:
        yield pa.Table.from_batches(held)


def _joining_links(batches, close: np.ndarray, alike) -> Iterator[pa.RecordBatch]:
    """Rows sorted by family, block, part: links between probes and members of other
    components, each of which joins components that no link before it has joined."""
    for table in _groups(batches, 3):
        node, component = (table.column(i).to_numpy() for i in (3, 4))
        probe = table.column(6).to_numpy()
        sketch = np.frombuffer(b"".join(table.column(5).to_pylist()), np.uint64).reshape(len(node), -1)
        probes, members = np.flatnonzero(probe), np.flatnonzero(~probe)
        values = table.column(7)
        sets: dict[int, object] = {}
        parent: dict[int, int] = {}

        def root(x: int) -> int:
            while (up := parent.get(x, x)) != x:
                parent[x] = x = parent.get(up, up)
            return x

        def value(i: int):
            if (key := int(node[i])) not in sets:
                sets[key] = alike.prepare(values[i].as_py())
            return sets[key]

        a, b = [], []
        for at in range(0, len(probes), 64):
            some = probes[at : at + 64]
            bits = np.bitwise_count(sketch[some][:, None, :] ^ sketch[members][None, :, :]).sum(axis=2)
            wanted = close[bits] & (component[some][:, None] != component[members][None, :])
            x, y = np.nonzero(wanted)
            order = np.argsort(bits[x, y], kind="stable")
            for i, j in zip(some[x[order]].tolist(), members[y[order]].tolist(), strict=True):
                one, two = root(int(component[i])), root(int(component[j]))
                if one != two and alike.linked(value(i), value(j)):
                    parent[one] = two
                    a.append(int(node[i]))
                    b.append(int(node[j]))
        if a:
            yield pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), pa.array(b, pa.int64())], names=["a", "b"])


class SameShingles:
    """Full shingle sets, similar by at least ``percent``: by the hashes of the shingles, and
    where these say so by the shingles themselves."""

    def __init__(self, percent: int = PERCENT):
        self.percent = percent

    def prepare(self, text: str | None) -> tuple[np.ndarray, bytes]:
        raw = (text or "").encode()
        return next(iter(shingle_hashes([raw], SHINGLE))), raw

    def linked(self, one: tuple[np.ndarray, bytes], two: tuple[np.ndarray, bytes]) -> bool:
        (x, a), (y, b) = one, two
        common = len(np.intersect1d(x, y, assume_unique=True))
        return 100 * common >= self.percent * (len(x) + len(y) - common) and same_shingles(a, b, SHINGLE, self.percent)


def bucket_members(banded: DataFrame, name: str) -> tuple[DataFrame, DataFrame]:
    """banded (node, band) -> (band, node of the buckets with more than one; the pair of
    each node with the most central node it shares a bucket with: a, b)."""
    sizes = banded.groupBy("band").agg(F.count("*").alias("n")).where("n > 1")
    members = stored(banded.join(sizes, "band"), f"{name}-members")
    weights = members.groupBy("node").agg(F.sum("n").alias("weight"))
    weighed = members.join(weights, "node").select("band", "node", F.struct("weight", "node").alias("rank"))
    weighed = stored(weighed, f"{name}-weighed")
    hubs = weighed.groupBy("band").agg(F.max("rank").alias("hub"))
    best = weighed.join(hubs, "band").where(F.col("node") != F.col("hub")["node"]).groupBy("node").agg(F.max("hub").alias("hub"))
    return members.select("band", "node"), best.select(F.col("hub")["node"].alias("a"), F.col("node").alias("b"))


def remaining_links(members: DataFrame, nodes: DataFrame, labels: DataFrame, close: np.ndarray, alike, name: str, block: int = BLOCK, part: int = PART) -> DataFrame:
    """Links (a, b) that join components, in buckets that hold more than one.

    members: band, node; nodes: node, sketch (binary, whole 8-byte words), value; labels:
    node, component. ``close`` says for each number of differing bits whether it is worth
    asking ``alike`` about the values.
    """
    labelled = members.join(labels, "node", "left").withColumn("component", F.coalesce("component", "node"))
    labelled = stored(labelled, f"{name}-labelled")
    kinds = labelled.groupBy("band").agg(F.min("component").alias("least"), F.max("component").alias("most"), F.min("node").alias("first"))
    open_ = labelled.join(kinds.where("least <> most").select("band", "first"), "band").select("node", "component", "first")
    open_ = stored(open_.distinct(), f"{name}-open")
    families = components(open_.select(F.col("first").alias("a"), F.col("node").alias("b")))
    placed = open_.select("node", "component").distinct().join(families.withColumnRenamed("component", "family"), "node")
    placed = stored(placed, f"{name}-families")
    sizes = placed.groupBy("family", "component").agg(F.count("*").alias("n"))
    sizes = sizes.groupBy("family").agg(F.sum("n").alias("rows"), F.max(F.struct("n", "component")).alias("main"))
    rows = placed.join(sizes, "family").join(nodes, "node")
    blocks = F.ceil(F.col("rows") / block).cast("int")
    parts = F.ceil((F.col("rows") - F.col("main")["n"]) / part).cast("int")
    turn = F.xxhash64("node", F.lit(1))
    own_block, own_part = F.pmod(turn, blocks).cast("int"), F.pmod(turn, parts).cast("int")
    rest = ["node", "component", "sketch"]
    probes = rows.where(F.col("component") != F.col("main")["component"])
    probes = probes.select("family", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), own_part.alias("part"), *rest, F.lit(True).alias("probe"), "value")
    held = rows.select("family", own_block.alias("block"), F.explode(F.sequence(F.lit(0), parts - 1)).alias("part"), *rest, F.lit(False).alias("probe"), "value")
    key = ["family", "block", "part"]
    together = probes.unionAll(held).repartition(*key).sortWithinPartitions(*key)
    return together.mapInArrow(lambda b: _joining_links(b, close, alike), "a long, b long")


def near_dedup(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """key, n_shingles, component_id, kept, row, stays: one row per row.

    ``kept``: its id is the component's name. ``row`` is a hash of id and text, ``stays``
    marks one such row of each component."""
    plain = keyed(docs, key, text)
    signed = stored(signatures(plain, key), "near-signatures")
    # stored before they meet the rows again, so that one set of very many rows can be split
    classes = stored(signed.where("set is not null").groupBy("set").agg(F.min("node").alias("leader")), "near-classes")
    leaders = signed.select("node", "sketch", "bands", "set").join(classes.select(F.col("leader").alias("node")), "node", "left_semi")
    leaders = stored(leaders.dropDuplicates(["node"]), "near-leaders")
    members, stars = bucket_members(leaders.select("node", F.explode("bands").alias("band")), "near")
    texts = plain.select(F.col("row").alias("node"), "text").join(members.select("node").distinct(), "node", "left_semi")
    texts = stored(texts.dropDuplicates(["node"]), "near-texts")
    first = stored(confirmed(stars, texts, percent), "near-links")
    close = estimates() >= percent / 100 - SLACK
    nodes = leaders.select("node", "sketch").join(texts.withColumnRenamed("text", "value"), "node")
    more = remaining_links(members, nodes, components(first), close, SameShingles(percent), "near")
    labels = components(first.unionAll(more)).select(F.col("node").alias("leader"), "component")
    placed = signed.select("node", "id", "n_shingles", "set").join(classes, "set", "left").join(labels, "leader", "left")
    placed = placed.withColumn("component", F.coalesce("component", "leader", "node"))
    placed = stored(placed.select("node", "id", "n_shingles", "component"), "near-placed")
    # a component's name is its smallest id; its rows meet the name, not each other
    at = F.struct(F.col("id").isNull().alias("none"), "id", "node")
    names = stored(placed.groupBy("component").agg(F.min(at).alias("first")), "near-names")
    named = placed.join(names, "component")
    return named.select(
        F.col("id").alias(key),
        "n_shingles",
        F.col("first.id").alias("component_id"),
        F.col("id").eqNullSafe(F.col("first.id")).alias("kept"),
        F.col("node").alias("row"),
        (F.col("node") == F.col("first.node")).alias("stays"),
    )


def keep_one(docs: DataFrame, key: str = "doc_id", text: str = "text", percent: int = PERCENT) -> DataFrame:
    """The rows of ``docs`` that stay, one of each component, with all their columns; of
    rows that are equal in id and text any one."""
    found = near_dedup(docs, key, text, percent).where("stays").select("row").distinct()
    row = F.xxhash64(F.col(key), F.coalesce(F.col(text), F.lit("")))
    everything = docs.select(row.alias("row"), F.struct(*[F.col(c) for c in docs.columns]).alias("doc"))
    return everything.join(found, "row", "left_semi").dropDuplicates(["row"]).select("doc.*")
