"""How single polygons lie to the union of a layer, from the border of the union alone.

The plane is cut into tiles at quantiles of the border's corners and of the polygons, so
that each tile has about as many of both. Tiles that the border passes know its edges there;
tiles that it does not pass lie whole inside or outside, which the running sums over the
crossings of tile lines tell (see ``overlay``). A polygon meets the border's edges near it,
and asks at one point inside it whether the layer covers that point. So a polygon in an
inside tile needs no exact test, and one polygon of the layer that spans the country is no
more to a tile than the few edges it has there.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, functions as F

from tripweave.functions import geometry as geo, planar, predicates
from tripweave.functions.lambdas import let, neighbours, row, some
from tripweave.operators import overlay
from tripweave.session import written

# The border's corners lie on a grid, up to a step from where they were (degrees).
SLIVER = 2e-9
# The share of its height at which a polygon is asked: no corner is likely to lie there.
_HEIGHT = 0.3819660112501051
EDGE, CORNER, POLYGON = range(3)
_BOX = ["xmin", "xmax", "ymin", "ymax"]
_FOUND = "id long, covered boolean, ax double, ay double, bx double, by double"


def inner_point(shape: str) -> str:
    """struct<x, y>: the middle of the widest stretch of the shape at some height."""

    def at(v: str) -> str:
        cut = f"{v}.low + ({v}.high - {v}.low) * {_HEIGHT!r}D"
        crossed = f"filter({v}.e, e -> (e.ay > {cut}) <> (e.by > {cut}))"
        xs = f"array_sort(transform({crossed}, e -> e.ax + ({cut} - e.ay) * (e.bx - e.ax) / (e.by - e.ay)))"

        def widest(w: str) -> str:
            gaps = neighbours(w, lambda a, b: row(wide=f"{b} - {a}", x=f"({a} + {b}) / 2"))
            # every second stretch lies inside
            return f"array_max(filter({gaps}, (g, i) -> i % 2 = 0)).x"

        return row(x=let(xs, widest), y=cut)

    box = geo.envelope(shape)
    return let(row(e=geo.edges(shape), low=box["ymin"], high=box["ymax"]), at)


def tiles_over(border: DataFrame, points: DataFrame, tile: int) -> overlay.Tiles | None:
    spots = points.select(*[F.col(c).alias(f"{p}{k}") for k in (1, 2) for p, c in (("x", "gx"), ("y", "gy"))])
    both = border.select("x1", "y1", "x2", "y2").unionByName(spots)
    return overlay.tiles_for(both, tile)


def _laid_boxes(polygons: DataFrame, tiles: overlay.Tiles) -> DataFrame:
    """Each polygon's box for every tile it reaches into, and whether its point is there."""

    def run(frames):
        for frame in frames:
            left, right, low, high = (frame[c].to_numpy(np.int64) for c in _BOX)
            column, line = (lambda v: np.maximum(tiles.column(2 * v), 0)), (lambda v: np.maximum(tiles.row(2 * v), 0))
            own = tiles.column(2 * frame["gx"].to_numpy(np.int64)), tiles.row(2 * frame["gy"].to_numpy(np.int64))
            for i, r in planar.ranges(line(low), line(high) + 1):
                for k, c in planar.ranges(column(left)[i], column(right)[i] + 1):
                    b = i[k]
                    yield frame.iloc[b].assign(tx=c, ty=r[k], asked=(own[0][b] == c) & (own[1][b] == r[k]))

    kind = "id long, gx long, gy long, xmin long, xmax long, ymin long, ymax long"
    return polygons.select("id", "gx", "gy", *_BOX).mapInPandas(run, f"{kind}, tx long, ty long, asked boolean")


def met_border(polygons: DataFrame, border: DataFrame, tile: int = overlay.TILE) -> DataFrame:
    """id with ``covered``, whether the layer covers the polygon's point; and id with each
    edge (ax, ay, bx, by, in degrees) of the border that passes the polygon's box.

    ``polygons``: id, shape. ``border``: see ``overlay.union_border``, of one group.
    """
    scale = float(10**overlay.SNAP)
    grid = lambda c, f: f(F.col(c) * scale).cast("long").alias(c)
    spots = polygons.select("id", F.expr(inner_point("shape")).alias("p"), *[F.expr(e).alias(c) for c, e in geo.envelope("shape").items()])
    # boxes a step wider on each side
    spots = spots.select(
        "id", F.round(F.col("p.x") * scale).cast("long").alias("gx"), F.round(F.col("p.y") * scale).cast("long").alias("gy"),
        *[grid(c, lambda v: F.floor(v) - 1) for c in ("xmin", "ymin")], *[grid(c, lambda v: F.ceil(v) + 1) for c in ("xmax", "ymax")],
    ).where("gx is not null")
    spots = written(spots, "cover-spots")
    tiles = tiles_over(border, spots, tile)
    if tiles is None:
        return polygons.sparkSession.createDataFrame([], _FOUND)
    boxes = _laid_boxes(spots, tiles)
    laid = overlay.laid_out(border, tiles)
    asked = boxes.where("asked").select(F.lit("").alias("g"), "tx", "ty").distinct()
    corners = overlay.corner_coverage(laid.withColumn("g", F.lit("")), asked)

    def find(key, frame):
        lines, held = frame[frame["kind"] == EDGE], frame[frame["kind"] == POLYGON]
        base = int(frame.loc[frame["kind"] == CORNER, "way"].sum())
        x1, y1, x2, y2, way = (lines[c].to_numpy(np.int64) for c in ("x1", "y1", "x2", "y2", "way"))
        ids = held["id"].to_numpy(np.int64)
        at = np.flatnonzero(held["asked"].to_numpy(bool))
        none = np.zeros(len(x1), np.int64)
        points = np.zeros(len(at), np.int64), *(2 * held[c].to_numpy(np.int64)[at] for c in ("gx", "gy"))
        corner = tiles.xs[key[0]], tiles.ys[key[1]]
        count = planar.coverage_at(none, x1, y1, x2, y2, way, points, corner, np.array([base]))
        parts = [pd.DataFrame({"id": ids[at], "covered": count > 0}).assign(ax=np.nan, ay=np.nan, bx=np.nan, by=np.nan)]
        near = [held[c].to_numpy(np.int64) for c in _BOX]
        for b, s in planar.near_boxes(near, x1, y1, x2, y2):
            ends = {n: v[s] / scale for n, v in (("ax", x1), ("ay", y1), ("bx", x2), ("by", y2))}
            parts.append(pd.DataFrame({"id": ids[b], "covered": None, **ends}))
        return pd.concat(parts).astype({"covered": "boolean"})

    # no nulls among the whole numbers: pandas would make doubles of them
    kinds = ((laid.where("edge"), EDGE), (corners, CORNER), (boxes, POLYGON))
    parts = [table.drop("g", "edge").withColumn("kind", F.lit(kind)) for table, kind in kinds]
    rows = parts[0].unionByName(parts[1]).unionByName(parts[2], allowMissingColumns=True).na.fill(0).na.fill(False)
    return rows.groupBy("tx", "ty").applyInPandas(find, _FOUND)


def polygon_facts(polygons: DataFrame, border: DataFrame, tile: int = overlay.TILE) -> DataFrame:
    """id, touch, meets, inside: whether a polygon shares a point with the layer's union,
    whether their interiors meet, and whether the polygon lies within it.

    A polygon whose inside the border does not enter lies whole on one side, and its point
    tells which. What lies within ``SLIVER`` of the border counts as touching it.
    """
    found = written(met_border(polygons, border, tile), "cover-found")
    edge = F.struct("ax", "ay", "bx", "by").alias("edge")
    pairs = found.where("ax is not null").select("id", edge).join(polygons.hint("merge"), "id")
    entered = let(row(edge="edge", e=geo.edges("shape")), lambda v: predicates.edge_runs_inside(f"{v}.edge", f"{v}.e", SLIVER))
    reached = let(row(edge="edge", e=geo.edges("shape")), lambda v: some(f"{v}.e", lambda f: geo.segments_meet(f"{v}.edge", f, SLIVER)))
    judged = pairs.select("id", F.expr(entered).alias("cut"), F.expr(reached).alias("reached"), F.lit(False).alias("covered"))
    asked = found.where("covered").select("id", F.lit(False).alias("cut"), F.lit(False).alias("reached"), "covered")
    blank = polygons.select("id", *[F.lit(False).alias(c) for c in ("cut", "reached", "covered")])
    facts = judged.unionByName(asked).unionByName(blank).groupBy("id").agg(*[F.bool_or(c).alias(c) for c in ("cut", "reached", "covered")])
    meets = F.col("cut") | F.col("covered")
    return facts.select("id", (meets | F.col("reached")).alias("touch"), meets.alias("meets"), (F.col("covered") & ~F.col("cut")).alias("inside"))
