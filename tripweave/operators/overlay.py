"""Planar overlay: borders of the union of polygons that may overlap or be cut unevenly.

The plane is cut into tiles of about ``TILE`` edges, by lines at quantiles of the edges'
corners, so that a dense place gets more tiles and no tile grows with the data: with n edges
there are about sqrt(n / TILE) lines each way, and a tile never holds more than the edges
between two lines. An edge goes to every tile it passes.

1. Edges of neighbours that match run in opposite directions and cancel out, combined
   before the shuffle. Level and upright edges that run over each other are made one. All
   that follows sees the rest only.
2. Tiles find where edges cross or touch and lead each edge through these grid points
   (see ``functions.planar``). Its pieces come together per edge.
3. Tiles find how many polygons cover each side of their pieces. The coverage at a tile's
   corner is a running sum over the crossings of one tile line, of as many terms as there
   are tiles in a row.

A piece is a border of the union if just one of its sides is covered.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window, functions as F

from tripweave.functions import geometry as geo, planar
from tripweave.session import written

# Decimal places (degrees) of the grid that corners are moved to.
SNAP = 9
TILE = 4000
LINES = 4096  # most lines each way; their number goes to the driver

_EDGE = ["x1", "y1", "x2", "y2"]
_PIECE = ["g", *_EDGE, "way"]
_DDL = "g string, x1 long, y1 long, x2 long, y2 long, way long"


def _grid(value: str) -> Column:
    return F.round(F.col(value) * F.lit(float(10**SNAP))).cast("long")


def degrees(value: Column) -> Column:
    return F.round(value / F.lit(float(10**SNAP)), SNAP)


def netted_edges(shapes: DataFrame, by: Sequence[str], geometry: str = "geometry") -> DataFrame:
    """g, x1, y1, x2, y2, way: edges from their lower to their higher end, with how many
    more polygons lie on the left than on the right. ``g`` stands for the columns ``by``."""
    group = F.to_json(F.struct(*by)) if by else F.lit("")
    e = shapes.select(group.alias("g"), F.explode(F.expr(geo.edges(geometry))).alias("e"))
    e = e.select("g", *[_grid(f"e.{c}").alias(c) for c in ("ax", "ay", "bx", "by")])
    rising = (F.col("ax") < F.col("bx")) | ((F.col("ax") == F.col("bx")) & (F.col("ay") < F.col("by")))
    ends = [F.when(rising, F.col(p)).otherwise(F.col(q)).alias(n) for p, q, n in
            (("ax", "bx", "x1"), ("ay", "by", "y1"), ("bx", "ax", "x2"), ("by", "ay", "y2"))]
    one = e.where("ax <> bx or ay <> by").select("g", *ends, F.when(rising, 1).otherwise(-1).alias("way"))
    return one.groupBy("g", *_EDGE).agg(F.sum("way").alias("way")).where("way <> 0")


def levelled(edges: DataFrame) -> DataFrame:
    """The same edges, those along one level or upright line cut at each other's ends and
    made one where they run over each other: at most twice as many, however many polygons
    lie over each other. Stretches whose edges cancel out stay, with ``way`` 0, as they
    mark where others are cut. The ends on a line are summed up in their order, by a window
    that streams."""
    level = F.col("y1") == F.col("y2")
    straight = edges.where("x1 = x2 or y1 = y2").select(
        "g", level.alias("level"), F.when(level, F.col("y1")).otherwise(F.col("x1")).alias("line"), "way",
        *[F.when(level, F.col(f"x{k}")).otherwise(F.col(f"y{k}")).alias(n) for k, n in ((1, "a"), (2, "b"))],
    )
    line = ["g", "level", "line"]
    begins = straight.select(*line, F.col("a").alias("at"), "way", F.lit(1).alias("n"))
    ends = straight.select(*line, F.col("b").alias("at"), (-F.col("way")).alias("way"), F.lit(-1).alias("n"))
    changes = begins.unionByName(ends).groupBy(*line, "at").agg(F.sum("way").alias("way"), F.sum("n").alias("n"))
    order = Window.partitionBy(*line).orderBy("at")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = changes.select(*line, "at", F.lead("at").over(order).alias("to"), *[F.sum(c).over(upto).alias(c) for c in ("way", "n")])
    across = lambda on, off: F.when(F.col("level"), F.col(on)).otherwise(F.col(off))
    cut = summed.where("n > 0").select(
        "g", across("at", "line").alias("x1"), across("line", "at").alias("y1"),
        across("to", "line").alias("x2"), across("line", "to").alias("y2"), "way",
    )
    return edges.where("x1 <> x2 and y1 <> y2").unionByName(cut)


@dataclass(frozen=True)
class Tiles:
    """Lines between grid points, doubled; the first ones lie outside of everything."""

    xs: np.ndarray
    ys: np.ndarray

    def column(self, x: np.ndarray) -> np.ndarray:
        """The tile column of doubled coordinates."""
        return np.searchsorted(self.xs, x, "right") - 1

    def row(self, y: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.ys, y, "right") - 1


def tiles_for(edges: DataFrame, tile: int = TILE) -> Tiles | None:
    """Tiles of about ``tile`` edges each, from approximate quantiles; None without edges."""
    facts = edges.agg(F.count(F.lit(1)).alias("n"), *[F.min(c).alias(f"low_{c}") for c in _EDGE]).first()
    if not facts.n:
        return None
    cuts = min(LINES, int((facts.n / tile) ** 0.5))
    lows = [2 * min(facts.low_x1, facts.low_x2) - 1, 2 * min(facts.low_y1, facts.low_y2) - 1]
    found = [[], []]
    if cuts:
        shares = [k / (cuts + 1) for k in range(1, cuts + 1)]
        row = edges.agg(*[F.percentile_approx(c, shares, 100 * (cuts + 1)).alias(c) for c in ("x1", "y1")]).first()
        found = [row.x1, row.y1]
    return Tiles(*[np.array(sorted({low, *(2 * v + 1 for v in f if 2 * v + 1 > low)}), np.int64) for low, f in zip(lows, found, strict=True)])


def laid_out(edges: DataFrame, tiles: Tiles) -> DataFrame:
    """Each edge once for every tile it passes (tx, ty); with ``edge`` false, its crossings
    of the lines between two rows of tiles: the row above, the first column whose corner
    lies right of it, and by how much coverage changes there."""

    def run(frames):
        for frame in frames:
            x1, y1, x2, y2, way = (frame[c].to_numpy(np.int64) for c in [*_EDGE, "way"])
            rise = (y2 - y1).astype(float)
            low, high = np.minimum(y1, y2), np.maximum(y1, y2)
            first, last = tiles.row(2 * low), tiles.row(2 * high)
            roofs = np.append(tiles.ys[1:], np.iinfo(np.int64).max) / 2
            for i, r in planar.ranges(first, last + 1):
                # the stretch of the edge within the row, taken a unit wider than it is
                with np.errstate(divide="ignore", invalid="ignore"):
                    u, v = (
                        x1[i] + (x2[i] - x1[i]) * ((h - y1[i]) / rise[i])
                        for h in (np.maximum(tiles.ys[r] / 2, low[i]), np.minimum(roofs[r], high[i]))
                    )
                level = rise[i] == 0
                u, v = np.where(level, x1[i], u), np.where(level, x2[i], v)
                c1 = tiles.column(2 * np.maximum(np.floor(np.minimum(u, v)).astype(np.int64) - 1, x1[i]))
                c2 = tiles.column(2 * np.minimum(np.ceil(np.maximum(u, v)).astype(np.int64) + 1, x2[i]))
                for k, c in planar.ranges(c1, c2 + 1):
                    yield frame.iloc[i[k]].assign(tx=c, ty=r[k], edge=True)
                over = r > first[i]
                i, r, c1, c2 = i[over], r[over], c1[over], c2[over]
                up = np.where(rise[i] > 0, 1, -1)
                column = c2 + 1
                for k, c in planar.ranges(c1 + 1, c2 + 1):
                    e = i[k]
                    corner = planar.side(2 * x1[e], 2 * y1[e], 2 * x2[e], 2 * y2[e], tiles.xs[c], tiles.ys[r[k]])
                    right = corner * up[k] < 0
                    np.minimum.at(column, k[right], c[right])
                if len(i):
                    yield frame.iloc[i].assign(tx=column, ty=r, edge=False, way=-up * way[i])

    return edges.select(*_PIECE).mapInPandas(run, f"{_DDL}, tx long, ty long, edge boolean")


def pieces_of(edges: DataFrame, tiles: Tiles) -> DataFrame:
    """g, x1, y1, x2, y2, way: the edges cut so that they meet at ends only; equal pieces
    are one, and pieces with as many polygons left as right of them are gone."""

    def find(key, frame):
        codes, _ = pd.factorize(frame["g"])
        own = lambda x, y: (tiles.column(2 * x) == key[0]) & (tiles.row(2 * y) == key[1])
        i, x, y = planar.nodes(codes, *(frame[c].to_numpy(np.int64) for c in _EDGE), own)
        return frame[_PIECE].iloc[i].assign(nx=x, ny=y)

    found = laid_out(edges, tiles).where("edge").groupBy("tx", "ty").applyInPandas(find, f"{_DDL}, nx long, ny long")
    along = "cast(nx - x1 as double) * (x2 - x1) + cast(ny - y1 as double) * (y2 - y1)"
    order = Window.partitionBy("g", *_EDGE).orderBy(F.expr(along), "nx", "ny")
    steps = found.select("g", "way", "nx", "ny", F.lead("nx").over(order).alias("mx"), F.lead("ny").over(order).alias("my"))
    rising = F.expr("nx < mx or (nx = mx and ny < my)")
    ends = [F.when(rising, F.col(p)).otherwise(F.col(q)).alias(n) for p, q, n in
            (("nx", "mx", "x1"), ("ny", "my", "y1"), ("mx", "nx", "x2"), ("my", "ny", "y2"))]
    turned = steps.where("mx is not null").select("g", *ends, F.when(rising, F.col("way")).otherwise(-F.col("way")).alias("way"))
    return turned.groupBy("g", *_EDGE).agg(F.sum("way").alias("way")).where("way <> 0")


def corner_coverage(laid: DataFrame, asked: DataFrame | None = None) -> DataFrame:
    """What covers the lower left corner of each tile that a group has edges in, or of those
    of ``asked`` (g, tx, ty) too: ``way``, with ``edge`` false.

    A running sum along each line of tiles; a tile without crossings to its left has 0."""
    changes = laid.where("not edge").groupBy("g", "ty", "tx").agg(F.sum("way").alias("way")).withColumn("here", F.lit(0))
    tiles = laid.where("edge").select("g", "ty", "tx")
    tiles = tiles if asked is None else tiles.unionByName(asked)
    present = tiles.distinct().select("g", "ty", "tx", F.lit(0).cast("long").alias("way"), F.lit(1).alias("here"))
    line = Window.partitionBy("g", "ty").orderBy("tx", "here").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    summed = changes.unionByName(present).withColumn("way", F.sum("way").over(line)).where("here = 1")
    return summed.select("g", *[F.lit(0).cast("long").alias(c) for c in _EDGE], "way", "tx", "ty", F.lit(False).alias("edge"))


def covered_pieces(pieces: DataFrame, tiles: Tiles) -> DataFrame:
    """The pieces with the number of polygons that cover their left and right side."""
    laid = laid_out(pieces, tiles)

    def cover(key, frame):
        codes, names = pd.factorize(frame["g"])
        piece = frame["edge"].to_numpy(bool)
        base = np.zeros(len(names), np.int64)
        base[codes[~piece]] = frame["way"].to_numpy(np.int64)[~piece]
        some, codes = frame[piece], codes[piece]
        x1, y1, x2, y2, way = (some[c].to_numpy(np.int64) for c in [*_EDGE, "way"])
        own = np.flatnonzero((tiles.column(x1 + x2) == key[0]) & (tiles.row(y1 + y2) == key[1]))
        corner = tiles.xs[key[0]], tiles.ys[key[1]]
        left, right = planar.covers(codes, x1, y1, x2, y2, way, own, corner, base)
        return some[_PIECE].iloc[own].assign(left=left, right=right)

    everything = laid.where("edge").unionByName(corner_coverage(laid))
    return everything.groupBy("tx", "ty").applyInPandas(cover, f"{_DDL}, left long, right long")


def union_border(shapes: DataFrame, by: Sequence[str], geometry: str = "geometry", tile: int = TILE) -> DataFrame:
    """g, x1, y1, x2, y2, way: the border of each group's union in grid units, stored.
    ``way`` is 1 where the inside is on the left of the rising edge, else -1."""
    edges = written(levelled(netted_edges(shapes, by, geometry)), "overlay-edges")
    tiles = tiles_for(edges, tile)
    if tiles is None:
        return edges
    covered = covered_pieces(written(pieces_of(edges, tiles), "overlay-pieces"), tiles)
    border = covered.where("(left > 0) <> (right > 0)")
    return written(border.select("g", *_EDGE, F.when(F.col("left") > 0, 1).otherwise(-1).cast("long").alias("way")), "overlay-border")


def union_edges(shapes: DataFrame, by: Sequence[str], geometry: str = "geometry", tile: int = TILE) -> DataFrame:
    """Directed edges (ax, ay, bx, by) of the border of each group's union, its inside to
    their left, in degrees; no two of them meet except at their ends.

    ``shapes`` has the columns ``by``, which may be null, and polygons with shells
    counter-clockwise and holes clockwise. Edges that others touch are cut there. Null and
    empty geometries have no edges. Repeated polygons count as one.
    """
    onward = F.col("way") > 0
    ends = [F.when(onward, F.col(p)).otherwise(F.col(q)).alias(n) for p, q, n in
            (("x1", "x2", "ax"), ("y1", "y2", "ay"), ("x2", "x1", "bx"), ("y2", "y1", "by"))]
    kinds = dict(shapes.select(*by).dtypes)
    group = F.from_json("g", ", ".join(f"`{c}` {kinds[c]}" for c in by)) if by else F.lit(None)
    placed = union_border(shapes, by, geometry, tile).select(group.alias("g"), *ends)
    return placed.select(*[F.col(f"g.`{c}`").alias(c) for c in by], *[degrees(F.col(c)).alias(c) for c in ("ax", "ay", "bx", "by")])
