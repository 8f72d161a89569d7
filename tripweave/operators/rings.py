"""Closed rings from directed edges, by list ranking.

Every edge knows the edge that follows it: around a corner, edges that arrive and edges that
leave alternate, and the follower is the first one clockwise, so that a ring keeps its inside
whole. The edges of a block, some thousands that lie close together, are joined to paths in
one task; paths find the ring they belong to and their place in it by pointer doubling, in as
many rounds as the number of paths of the longest ring has binary digits. No task holds an
outline: a ring comes together only as the value of its own row.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tripweave.functions import geometry as geo, predicates
from tripweave.functions.lambdas import let
from tripweave.session import written

BLOCK = 1 << 13  # edges joined to paths in one task


def _turning(at: Column, to: Column) -> Column:
    """The direction from one corner to another as an angle."""
    return F.atan2(to["y"] - at["y"], to["x"] - at["x"])


def followers(edges: DataFrame, by: Sequence[str], clockwise: bool = True) -> DataFrame:
    """``edges`` (id, a, b and ``by``) with ``next``, the id of the edge after each."""
    leaving = edges.select(*by, F.col("a").alias("at"), _turning(F.col("a"), F.col("b")).alias("angle"), F.col("id").alias("out"), F.lit(None).cast("long").alias("id"))
    coming = edges.select(*by, F.col("b").alias("at"), _turning(F.col("b"), F.col("a")).alias("angle"), F.lit(None).cast("long").alias("out"), "id")
    corner = Window.partitionBy(*by, "at")
    sense = F.col("angle") if clockwise else -F.col("angle")
    before = corner.orderBy(sense).rowsBetween(Window.unboundedPreceding, -1)
    found = leaving.unionByName(coming).select(
        "id",
        F.coalesce(
            F.last("out", ignorenulls=True).over(before),
            F.max_by("out", F.when(F.col("out").isNotNull(), sense)).over(corner),
        ).alias("next"),
    )
    return found.where("id is not null")


def _paths(frame: pd.DataFrame) -> pd.DataFrame:
    """The edges of one block as paths: head, place, and at a path's end the edge after it."""
    ids, after = frame["id"].to_numpy(np.int64), frame["next"].to_numpy(np.int64)
    onward = dict(zip(ids.tolist(), after.tolist(), strict=True))
    targets = set(after.tolist())
    seen: set[int] = set()
    rows = []
    for start in [*(i for i in onward if i not in targets), *sorted(onward)]:
        place, at = 0, start
        while at in onward and at not in seen:
            seen.add(at)
            rows.append((at, start, place, None))
            place, at = place + 1, onward[at]
        if place:
            rows[-1] = (*rows[-1][:3], at)
    table = pd.DataFrame(rows, columns=["id", "head", "place", "exit"])
    return table.astype({"exit": "Int64"})


def ranked(links: DataFrame) -> DataFrame:
    """id, ring, place: for each (id, next), the ring's name and the edge's place in it.

    Ids of one ring should lie close together; any will do.
    """
    block = F.floor(F.col("id") / BLOCK).alias("block")
    kind = "id long, head long, place long, exit long"
    steps = written(links.select("id", "next", block).groupBy("block").applyInPandas(_paths, kind), "ring-paths")
    paths = steps.where("exit is not null").select("head", F.col("exit").alias("next"), (F.col("place") + 1).alias("length"))
    closed = paths.where("next = head").select("head", F.col("head").alias("ring"), F.lit(0).cast("long").alias("offset"))
    open_ = written(paths.where("next <> head"), "ring-open")
    placed = closed
    if not open_.isEmpty():
        placed = closed.unionByName(_placed(open_))
    return steps.join(placed, "head").select("id", "ring", (F.col("offset") + F.col("place")).alias("place"))


def _placed(paths: DataFrame) -> DataFrame:
    """head, ring, offset of paths (head, next, length) that close to rings of several."""

    def jumped(table: DataFrame, *extra: Column) -> DataFrame:
        ahead = table.select(*[F.col(c).alias(f"{c}_") for c in table.columns])
        return table.join(ahead, F.col("next") == F.col("head_")).select(*extra)

    # the least head of each ring
    least = paths.select("head", "next", F.col("head").alias("ring"))
    while True:
        further = jumped(least, F.col("head"), F.col("next_").alias("next"), F.least("ring", "ring_").alias("ring"),
                         (F.col("ring_") < F.col("ring")).alias("moved"))
        further = written(further, "ring-least")
        least = further.drop("moved")
        if further.where("moved").isEmpty():
            break
    # the way from each path to the ring's start, which is where it ends
    way = paths.join(least.select("head", "ring"), "head")
    while True:
        there = F.col("next") == F.col("ring")
        further = jumped(way, F.col("head"), F.when(there, F.col("next")).otherwise(F.col("next_")).alias("next"),
                         (F.col("length") + F.when(there, 0).otherwise(F.col("length_"))).alias("length"), F.col("ring"))
        way = written(further, "ring-way")
        if way.where("next <> ring").isEmpty():
            break
    totals = way.where("head = ring").select("ring", F.col("length").alias("total"))
    return way.join(totals, "ring").select("head", "ring", (F.col("total") - F.col("length")).alias("offset"))


def ring_corners(edges: DataFrame, by: Sequence[str]) -> DataFrame:
    """ring, place, x, y and ``by``: the corners of simple rings in their order, each ring
    from its least corner on. ``edges`` are directed (ax, ay, bx, by) and close to rings.

    Where a ring comes back to a corner, as where a hole touches its shell, it is taken
    apart there: those edges are followed the other way round that corner.
    """
    ends = [F.struct(F.col(f"{c}x").alias("x"), F.col(f"{c}y").alias("y")).alias(c) for c in "ab"]
    named = [F.col(c).alias(f"k{i}") for i, c in enumerate(by)]
    keys = [f"k{i}" for i in range(len(by))]
    numbered = written(edges.select(*named, *ends, F.monotonically_increasing_id().alias("id")), "ring-edges")
    found = written(ranked(followers(numbered, keys)), "rings")
    placed = numbered.join(found, "id")
    again = placed.groupBy("ring", "a").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    twisted = written(again.select("ring", "a"), "ring-twisted")
    if not twisted.isEmpty():
        rings = placed.join(twisted.select("ring").distinct(), "ring", "left_semi").select("id", "a", "b", "ring")
        other = followers(rings.join(twisted, ["ring", "a"], "left_semi").unionByName(
            rings.join(twisted.withColumnRenamed("a", "b"), ["ring", "b"], "left_semi")).distinct(), ["ring"], clockwise=False)
        # only edges that arrive at such a corner change
        arriving = rings.join(twisted.withColumnRenamed("a", "b"), ["ring", "b"], "left_semi").select("id")
        changed = other.join(arriving, "id", "left_semi").withColumnRenamed("next", "other")
        links = followers(numbered, keys).join(rings.select("id"), "id", "left_semi").join(changed, "id", "left")
        redone = ranked(links.select("id", F.coalesce("other", "next").alias("next")))
        found = written(found.join(rings.select("id"), "id", "left_anti").unionByName(redone), "rings")
        placed = numbered.join(found, "id")
    first = placed.groupBy("ring").agg(F.min_by("place", "a").alias("first"), F.count(F.lit(1)).alias("size"))
    moved = placed.join(first, "ring").withColumn("place", F.pmod(F.col("place") - F.col("first"), F.col("size")))
    return moved.select(*[F.col(k).alias(c) for k, c in zip(keys, by, strict=True)], "ring", "place", "a.x", "a.y")


def closed_rings(corners: DataFrame, by: Sequence[str]) -> DataFrame:
    """ring, corners, area and ``by``: one row per ring, closed; holes have negative areas."""
    rows = corners.groupBy(*by, "ring").agg(F.array_sort(F.collect_list(F.struct("place", "x", "y"))).alias("c"))
    points = rows.select(*by, "ring", F.expr("transform(c, p -> named_struct('x', p.x, 'y', p.y))").alias("c"))
    closed = points.select(*by, "ring", F.concat("c", F.slice("c", 1, 1)).alias("corners"))
    return closed.withColumn("area", F.expr(geo.ring_area("corners")))


def _level(rings: DataFrame) -> DataFrame:
    box = {c: F.expr(e) for c, e in geo.envelope("array(array(corners))").items()}
    boxed = rings.withColumns(box)
    extent = F.greatest(F.col("xmax") - F.col("xmin"), F.col("ymax") - F.col("ymin"))
    return boxed.withColumn("level", F.ceil(F.log2(extent)).cast("int"))


def with_holes(rings: DataFrame, by: Sequence[str]) -> DataFrame:
    """``by``, shell area and polygon: each shell with the holes that lie in it.

    A shell reaches over four cells at most of the power of two above its size; a hole looks
    into the one cell of each size in use that holds a point of it.
    """
    sized = written(_level(rings), "ring-sizes")
    shells, holes = sized.where("area > 0"), sized.where("area < 0")

    def cell(value: Column, level: Column) -> Column:
        return F.floor(value / F.pow(F.lit(2.0), level))

    cells = {f"c{c}": F.explode(F.sequence(cell(F.col(f"{c}min"), F.col("level")), cell(F.col(f"{c}max"), F.col("level")))) for c in "xy"}
    laid = shells
    for name, column in cells.items():
        laid = laid.withColumn(name, column)
    keys = [*by, "level", "cx", "cy"]
    levels = shells.agg(F.collect_set("level")).first()[0]  # as many as sizes differ in powers of two
    # a point of the hole that lies on no corner: the middle of its first edge
    spot = holes.select(
        *by, F.col("ring").alias("hole"), F.col("corners").alias("hole_corners"),
        F.expr("(corners[0].x + corners[1].x) / 2").alias("px"), F.expr("(corners[0].y + corners[1].y) / 2").alias("py"),
        F.explode(F.array(*map(F.lit, levels)) if levels else F.array().cast("array<int>")).alias("level"),
    ).withColumns({f"c{c}": cell(F.col(f"p{c}"), F.col("level")) for c in "xy"})
    boxes = "px between xmin and xmax and py between ymin and ymax"
    inside = F.expr(let(geo.edges("array(array(corners))"), lambda e: predicates.point_inside("px", "py", e)))
    home = (
        spot.join(laid.select(*keys, "ring", "corners", "area", "xmin", "xmax", "ymin", "ymax"), keys)
        .where(boxes).where(inside)
        .groupBy("hole").agg(F.min_by("ring", "area").alias("ring"), F.first("hole_corners").alias("corners"))
    )
    held = home.groupBy("ring").agg(F.sort_array(F.collect_list("corners")).alias("holes"))
    whole = shells.join(held, "ring", "left")
    return whole.select(*by, "area", F.concat(F.array("corners"), F.coalesce("holes", F.expr("array()").cast("array<array<struct<x:double,y:double>>>"))).alias("polygon"))
