"""Polygon layers in the shapefile format.

The files are read by Spark's binary reader, so from any store it reaches. A file, which its
32-bit offsets bound, is cut into records in one task; the records, still as bytes, are then
dealt out and decoded in parallel. Attributes come from the ``.dbf`` beside it, in the order
of the records, and the projection's description from the ``.prj``.
"""

from __future__ import annotations

import struct
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from tripweave import schemas

POLYGONS = (5, 15, 25)  # plain, with heights, with measures: x and y come first in all
ROWS = 2048

_RING = pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))
_SHAPE = pa.list_(pa.list_(_RING))
_SHAPE_DDL = "array<array<array<struct<x: double, y: double>>>>"


def shape_records(content: bytes) -> Iterator[bytes]:
    """The content of each record of a ``.shp`` file."""
    if len(content) < 100 or struct.unpack(">i", content[:4])[0] != 9994:
        raise ValueError("not a shapefile")
    at = 100
    while at + 8 <= len(content):
        (words,) = struct.unpack(">i", content[at + 4 : at + 8])
        yield content[at + 8 : at + 8 + 2 * words]
        at += 8 + 2 * words


def attribute_records(content: bytes, names: Sequence[str], encoding: str) -> Iterator[list[str | None]]:
    """The wanted fields of each record of a ``.dbf`` file, as text; blank is null."""
    count, header, width = struct.unpack("<IHH", content[4:12])
    fields, at, place = {}, 32, 1
    while content[at] != 0x0D:
        name = content[at : at + 11].split(b"\0")[0].decode(encoding).upper()
        fields[name] = place, place + content[at + 16]
        place += content[at + 16]
        at += 32
    if missing := [n for n in names if n.upper() not in fields]:
        raise ValueError(f"fields not found: {', '.join(missing)}; the file has {', '.join(fields)}")
    spans = [fields[n.upper()] for n in names]
    for k in range(count):
        row = content[header + k * width : header + (k + 1) * width]
        yield [row[a:b].decode(encoding).strip(" \0") or None for a, b in spans]


def _area(ring: np.ndarray) -> float:
    x, y = (ring - ring[0]).T
    return float((x[:-1] * y[1:] - x[1:] * y[:-1]).sum() / 2)


def _inside(ring: np.ndarray, x: float, y: float) -> bool:
    ax, ay, bx, by = *ring[:-1].T, *ring[1:].T
    spans = (ay > y) != (by > y)
    with np.errstate(divide="ignore", invalid="ignore"):
        return bool((spans & (x < ax + (y - ay) * (bx - ax) / (by - ay))).sum() % 2)


def polygons_of(record: bytes) -> list[list[np.ndarray]] | None:
    """Polygons, shell first, from one record; shells counter-clockwise and holes clockwise,
    the other way round than in the file. Null shapes give None."""
    (kind,) = struct.unpack("<i", record[:4])
    if kind == 0:
        return None
    if kind not in POLYGONS:
        raise ValueError(f"shape type {kind} is no polygon")
    parts, points = struct.unpack("<2i", record[36:44])
    starts = np.frombuffer(record, "<i4", parts, 44)
    corners = np.frombuffer(record, "<f8", 2 * points, 44 + 4 * parts).reshape(-1, 2)
    rings = [r[::-1] for r in np.split(corners, starts[1:])]
    rings = [(r, _area(r)) for r in rings if len(r) > 2]
    shells = sorted(([r] for r, a in rings if a > 0), key=lambda p: _area(p[0]))
    if not shells:  # rings of one direction only, the wrong one
        return [[r[::-1]] for r, a in rings if a < 0]
    for hole in (r for r, a in rings if a < 0):
        x, y = (hole[0] + hole[1]) / 2
        next((p for p in shells if _inside(p[0], x, y)), shells[-1]).append(hole)
    return shells


def scan_records(spark: SparkSession, path, names: Sequence[str], encoding: str = "utf-8") -> DataFrame:
    """record and the attributes ``names``: one row for each record of the layer's files."""

    def files(ending: str) -> DataFrame:
        found = spark.read.format("binaryFile").option("pathGlobFilter", f"*.{ending}").option("recursiveFileLookup", True).load(path)
        return found.select(F.regexp_replace("path", r"\.[^./]+$", "").alias("stem"), F.col("content").alias(ending))

    def cut(batches):
        for batch in batches:
            for stem, shapes, table in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if table is None:
                    raise ValueError(f"{stem}.dbf is missing")
                rows, held = zip_records(shapes, table), []
                for row in rows:
                    held.append(row)
                    if len(held) == ROWS:
                        yield packed(held)
                        held = []
                if held:
                    yield packed(held)

    def zip_records(shapes: bytes, table: bytes):
        for record, fields in zip(shape_records(shapes), attribute_records(table, names, encoding), strict=True):
            yield record, *fields

    def packed(rows) -> pa.RecordBatch:
        columns = [pa.array(c, pa.binary() if i == 0 else pa.string()) for i, c in enumerate(zip(*rows, strict=True))]
        return pa.RecordBatch.from_arrays(columns, names=["record", *names])

    both = files("shp").join(files("dbf"), "stem", "left")
    return both.mapInArrow(cut, "record binary, " + ", ".join(f"`{n}` string" for n in names))


def scan_shapefile(spark: SparkSession, path, names: Sequence[str] = tuple(schemas.BOUNDARY_CODES), encoding: str = "utf-8") -> DataFrame:
    """geom and the attributes ``names``, in the layer's own coordinates.

    ``path``: a folder with the layer's files, or several. Records without a shape have a
    null geometry; blank attributes are null. Further attributes are not read.
    """
    records = scan_records(spark, path, names, encoding)
    spread = records.repartition(spark.sparkContext.defaultParallelism)

    def decode(batches):
        for batch in batches:
            shapes = [polygons_of(r) for r in batch.column(0).to_pylist()]
            nested = [s and [[[{"x": x, "y": y} for x, y in ring.tolist()] for ring in polygon] for polygon in s] for s in shapes]
            yield pa.RecordBatch.from_arrays([pa.array(nested, _SHAPE), *batch.columns[1:]], names=["geom", *names])

    return spread.mapInArrow(decode, f"geom {_SHAPE_DDL}, " + ", ".join(f"`{n}` string" for n in names))


def description(spark: SparkSession, path) -> str | None:
    """The projection's description beside a layer, if there is one."""
    found = spark.read.format("text").option("wholetext", True).option("pathGlobFilter", "*.prj").option("recursiveFileLookup", True)
    texts = found.load(path).distinct().limit(2).collect()
    if len(texts) > 1:
        raise ValueError(f"the files of {path} have different projections")
    return texts[0].value if texts else None
