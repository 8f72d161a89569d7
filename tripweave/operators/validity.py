"""Valid polygons, found with edges in slabs.

The edges of a polygon are laid on slabs as high (or wide) as a mean edge is long, across
the longer side of its box; an edge reaches over as many slabs as it is long, so all of them
together over about twice as many as there are edges. Only edges of one slab are compared:
a ring of n corners takes some multiple of n comparisons, and large rings spread over many
tasks. A polygon so crooked that its border is k times as long as its box has k edges a slab.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from tripweave.functions import geometry as geo, predicates
from tripweave.functions.lambdas import every, let
from tripweave.session import written


def _whole_rings(shape: str) -> str:
    """Rings are closed, have four points and an area; a hole starts inside its shell."""

    def good(ring: str) -> str:
        closed = f"get({ring}, 0) = get({ring}, size({ring}) - 1)"
        return f"size({ring}) >= 4 and {closed} and {geo.ring_area(ring)} <> 0"

    def held(polygon: str) -> str:
        def inside(shell: str) -> str:
            middle = lambda h, c: f"({h}[0].{c} + {h}[1].{c}) / 2"
            return every(
                f"slice({polygon}, 2, greatest(size({polygon}) - 1, 0))",
                lambda hole: f"size({hole}) < 2 or {predicates.point_inside(middle(hole, 'x'), middle(hole, 'y'), shell)}",
            )

        return let(geo.edges(f"array(slice({polygon}, 1, 1))"), inside)

    rings = f"flatten({shape})"
    return f"coalesce(size({rings}) > 0 and {every(rings, good)} and {every(shape, held)}, false)"


def edge_table(rows: DataFrame) -> DataFrame:
    """id, polygon, ring, n (edges of the ring), i (place in it) and e, from id and geometry."""
    polygons = rows.select("id", F.posexplode("geometry").alias("polygon", "rings"))
    rings = polygons.select("id", "polygon", F.posexplode("rings").alias("ring", "r"))
    lines = rings.select("id", "polygon", "ring", F.expr(geo.edges("array(array(r))")).alias("lines"))
    return lines.select("id", "polygon", "ring", F.size("lines").alias("n"), F.posexplode("lines").alias("i", "e"))


def with_validity(zones: DataFrame, column: str = "valid") -> DataFrame:
    """The rows with a flag: each ring is closed, has four points and an area, and meets
    itself nowhere but where neighbours share a corner; rings of a polygon do not cross, and
    holes lie in their shell. False for null and empty geometries.
    """
    rows = written(zones.withColumn("id", F.monotonically_increasing_id()), "validity-rows")
    edges = written(edge_table(rows.select("id", "geometry")), "validity-edges")
    key = ["id", "polygon"]
    length = F.expr("abs(e.ax - e.bx) + abs(e.ay - e.by)")
    boxes = edges.groupBy(*key).agg(
        F.avg(length).alias("step"),
        *[f(F.expr(f"{g}(e.a{c}, e.b{c})")).alias(f"{n}{c}") for c in "xy" for f, g, n in ((F.min, "least", "low"), (F.max, "greatest", "high"))],
    )
    upright = F.expr("highy - lowy >= highx - lowx")
    measured = edges.join(boxes, key).withColumns(
        {"a": F.when(upright, F.col("e.ay") - F.col("lowy")).otherwise(F.col("e.ax") - F.col("lowx")) / F.col("step"),
         "b": F.when(upright, F.col("e.by") - F.col("lowy")).otherwise(F.col("e.bx") - F.col("lowx")) / F.col("step")}
    )
    # a little wider than the edge, as edges that nearly touch count as touching
    slabs = F.sequence(F.floor(F.least("a", "b") - F.lit(1e-6)), F.floor(F.greatest("a", "b") + F.lit(1e-6)))
    laid = written(measured.select(*key, "ring", "n", "i", "e", F.explode(slabs).alias("slab")), "validity-slabs")
    other = laid.select(*key, "slab", F.col("ring").alias("ring2"), F.col("i").alias("j"), F.col("e").alias("f"))
    later = F.expr("ring < ring2 or (ring = ring2 and i < j)")
    pairs = laid.join(other, [*key, "slab"]).where(later).where(F.expr(geo.boxes_meet("e", "f")))
    next_ = "(j = i + 1 or (i = 0 and j = n - 1))"
    wrong = F.expr(
        f"if(ring <> ring2, {geo.segments_cross('e', 'f')}, if({next_}, {geo.folds_back('e', 'f')}, {geo.segments_meet('e', 'f')}))"
    )
    crossed = pairs.where(wrong).select("id").distinct().withColumn("crossed", F.lit(True))
    flag = F.col("crossed").isNull() & F.expr(_whole_rings("geometry"))
    return rows.join(crossed, "id", "left").withColumn(column, flag).drop("id", "crossed")
