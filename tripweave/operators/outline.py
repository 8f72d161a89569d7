"""Outlines of merged zones."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, functions as F

from tripweave.operators import overlay, rings


def outline_edges(zones: DataFrame, by: Sequence[str]) -> DataFrame:
    """Directed edges (ax, ay, bx, by) of the union of the zones of each group, which may
    overlap and whose common borders may be cut unevenly (see ``overlay``)."""
    return overlay.union_edges(zones, by)


def outline_rings(zones: DataFrame, by: Sequence[str]) -> DataFrame:
    """ring, corners, area and ``by``: the rings of each group's union. Shells run
    counter-clockwise, holes clockwise with a negative area."""
    return rings.closed_rings(rings.ring_corners(outline_edges(zones, by), by), by)


def merged_shapes(zones: DataFrame, by: str = "municipality_id") -> DataFrame:
    """One geometry per group: the union of its zones, borders inside it dissolved.

    All merging is done on single edges, and rings are found by list ranking; what comes
    together at the end is the value of the output row.
    """
    found = outline_rings(zones.where(F.col(by).isNotNull()), [by])
    polygons = rings.with_holes(found, [by])
    return polygons.groupBy(by).agg(
        F.transform(F.array_sort(F.collect_list(F.struct("area", "polygon"))), lambda p: p["polygon"]).alias("geometry")
    )
