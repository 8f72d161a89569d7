import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tripweave.functions import formats, geometry as geo, planar, predicates
from tripweave.operators import cover, outline, overlay, rings, zones as zone_ops
from tests.test_geometry import picked, zone_table


def box(x, y, u, v):
    return f"POLYGON(({x} {y},{u} {y},{u} {v},{x} {v},{x} {y}))"


def shapes(spark, rows):
    table = spark.createDataFrame(rows, "g string, t string")
    return table.select("g", F.expr(geo.oriented(formats.from_wkt("t"))).alias("geometry"))


def area(edges):
    turn = F.sum(F.expr("(ax * by - bx * ay) / 2"))
    return {r.g: round(r.a, 6) for r in edges.groupBy("g").agg(turn.alias("a")).collect()}


@pytest.mark.parametrize("tile", [4000, 5])
def test_union_of_boxes_against_cells(spark, tile):
    """Boxes on whole numbers: the union is a set of unit cells."""
    rng, rows, want = random.Random(tile), [], {}
    for g in "abcd":
        cells = set()
        for _ in range(25):
            x, y = rng.randint(-9, 12), rng.randint(-9, 12)
            w, h = rng.randint(1, 6), rng.randint(1, 6)
            rows.append((g, box(x, y, x + w, y + h)))
            cells |= {(a, b) for a in range(x, x + w) for b in range(y, y + h)}
        want[g] = cells
    edges = overlay.union_edges(shapes(spark, rows), ["g"], tile=tile)
    assert area(edges) == {g: len(c) for g, c in want.items()}
    length = {r.g: r.s for r in edges.groupBy("g").agg(F.sum(F.expr("abs(ax - bx) + abs(ay - by)")).alias("s")).collect()}
    around = {g: sum((x + dx, y + dy) not in c for x, y in c for dx, dy in ((1, 0), (-1, 0), (0, 1), (0, -1))) for g, c in want.items()}
    assert length == pytest.approx(around)


@pytest.mark.parametrize("tile", [4000, 8])
def test_union_of_triangles_against_sampling(spark, tile):
    """Slanted edges that cross anywhere: a point is inside the union if inside any triangle."""
    rng = random.Random(7)
    corners = [[(rng.uniform(0, 1), rng.uniform(0, 1)) for _ in range(3)] for _ in range(30)]
    text = lambda c: "POLYGON((" + ",".join(f"{x:.9f} {y:.9f}" for x, y in [*c, c[0]]) + "))"
    edges = [(r.ax, r.ay, r.bx, r.by) for r in overlay.union_edges(shapes(spark, [("t", text(c)) for c in corners]), [], tile=tile).collect()]
    ax, ay, bx, by = np.array(edges).T
    # borders close: as many edges leave each corner as come to it
    ends = lambda x, y: sorted(zip(x.tolist(), y.tolist(), strict=True))
    assert ends(ax, ay) == ends(bx, by)
    for _ in range(400):
        px, py = rng.uniform(0, 1), rng.uniform(0, 1)
        inside = any(
            len({(q[0] - p[0]) * (py - p[1]) - (q[1] - p[1]) * (px - p[0]) > 0 for p, q in zip(c, [*c[1:], c[0]])}) == 1
            for c in corners
        )
        spans = (ay > py) != (by > py)
        hits = spans & (ax + (py - ay) * (bx - ax) / np.where(spans, by - ay, 1) > px)
        turns = np.where(by > ay, 1, -1)[hits].sum()
        assert turns == int(inside)


def test_uneven_cuts_repeats_and_nothing(spark):
    rows = [("t", box(0, 0, 2, 2)), ("t", box(2, 0, 4, 1)), ("t", box(2, 1, 4, 2)), ("t", box(2, 1, 4, 2))]
    rows += [("h", box(0, 0, 4, 4)), ("h", box(1, 1, 2, 2)), (None, box(0, 0, 1, 1)), ("n", None)]
    assert area(overlay.union_edges(shapes(spark, rows), ["g"])) == {"t": 8, "h": 16, None: 1}
    assert overlay.union_edges(shapes(spark, rows[:0]), ["g"]).count() == 0


def test_a_border_a_step_off_the_grid(spark):
    """A corner that lies on a neighbour's border but for rounding."""
    rows = [("s", "POLYGON((0 0,1 0,0.333333333 0.777777777,0 0))"), ("s", "POLYGON((1 0,1 1,0.333333333 0.777777777,0.666666667 0.388888888,1 0))")]
    got = overlay.union_edges(shapes(spark, rows), ["g"]).collect()
    starts, ends = sorted((r.ax, r.ay) for r in got), sorted((r.bx, r.by) for r in got)
    assert starts == ends


def test_sides_are_exact():
    big = 10**17
    ax, ay, bx, by = (np.array([v]) for v in (0, 0, big, big + 1))
    px = np.array([big - 1])
    assert planar.side(ax, ay, bx, by, px, np.array([big])).tolist() == [1]  # (b - 1, b): a turn of one unit
    assert planar.side(ax, ay, bx, by, bx, by).tolist() == [1]  # on the line: up
    assert planar.side(ax, ay, bx, by, np.array([big]), np.array([big])).tolist() == [-1]


def test_boxes_that_meet():
    rng = np.random.default_rng(1)

    def some(n):
        x, y = rng.integers(0, 60, n), rng.integers(0, 60, n)
        w = rng.choice([0, 1, 5, 50], n)
        return rng.integers(0, 3, n), x, x + w, y, y + rng.integers(0, 20, n)

    one, two = some(80), some(70)
    found = [(i, j) for p, q in planar.meeting(*one, *two) for i, j in zip(p.tolist(), q.tolist(), strict=True)]
    want = [
        (i, j) for i in range(80) for j in range(70)
        if one[0][i] == two[0][j] and one[1][i] <= two[2][j] and two[1][j] <= one[2][i] and one[3][i] <= two[4][j] and two[3][j] <= one[4][i]
    ]
    assert sorted(found) == want


PINCHED = "POLYGON((0 0,4 0,4 4,0 4,0 0),(0 2,1 1,1 3,0 2))"
TWICE = "POLYGON((0 0,4 0,4 4,0 4,0 0),(0 2,1 1,1 3,0 2),(4 2,3 3,3 1,4 2))"


@pytest.mark.parametrize("block", [1 << 13, 2])
def test_rings(spark, monkeypatch, block):
    """In one block, and in blocks of two edges, where all but the smallest rings take rounds."""
    monkeypatch.setattr(rings, "BLOCK", block)
    rows = [("a", box(x, y, x + 1, y + 1)) for x in range(5) for y in range(5) if (x, y) not in ((1, 1), (2, 2), (3, 1))]
    rows += [("b", box(0, 0, 1, 1)), ("b", box(1, 1, 2, 2)), ("b", box(10, 10, 11, 11)), ("p", PINCHED), ("q", TWICE)]
    rows += [("i", "POLYGON((0 0,9 0,9 9,0 9,0 0),(1 1,8 1,8 8,1 8,1 1))"), ("i", box(3, 3, 5, 5))]
    sizes = F.expr("transform(geometry, p -> transform(p, r -> size(r)))").alias("s")
    got = outline.merged_shapes(shapes(spark, rows), "g").select("g", sizes, F.expr(geo.area("geometry")).alias("area"))
    assert {r.g: (r.s, round(r.area, 9)) for r in got.collect()} == {
        "a": ([[21, 5, 5, 5]], 22), "b": ([[5], [5], [5]], 3), "p": ([[6, 4]], 15), "q": ([[7, 4, 4]], 14), "i": ([[5], [5, 5]], 36),
    }
    first = outline.outline_rings(shapes(spark, rows[-1:]), ["g"]).first()
    assert [(p.x, p.y) for p in first.corners] == [(3, 3), (5, 3), (5, 5), (3, 5), (3, 3)]
    assert outline.merged_shapes(shapes(spark, rows[:0]), "g").count() == 0


def test_layers_that_overlap_or_are_cut_unevenly(spark):
    """The layer's union is the box from 0 to 4."""
    inside, across, out = box(1, 1, 3, 3), box(3, 3, 5, 5), box(6, 6, 7, 7)
    whole, around = box(0, 0, 4, 4), box(-1, -1, 5, 5)
    zones = zone_table(spark, [inside, across, out, whole, around])
    cut = [box(0, 0, 2, 4), box(2, 0, 4, 2), box(2, 2, 4, 4)]  # a T border inside ``inside``
    overlapping = [box(0, 0, 3, 4), box(1, 0, 4, 4)]
    for texts in (cut, overlapping, [*cut, *overlapping]):
        layer = zone_ops.layer_from_wkt(zones, texts)
        got = {name: picked(zone_ops.zones_by_layer(zones, layer, name)) for name in predicates.PREDICATES}
        assert got["within"] == {inside, whole}
        assert got["overlaps"] == {across}
        assert got["contains"] == {whole, around}
        assert got["intersects"] == {inside, across, whole, around}


def test_one_large_polygon_makes_no_hot_tile(spark):
    """900 zones under one polygon, and 100 small polygons at one side."""
    rows = [(y * 30 + x, box(x, y, x + 1, y + 1)) for x in range(30) for y in range(30)]
    zones = spark.createDataFrame(rows, "id long, t string").select("id", F.expr(geo.oriented(formats.from_wkt("t"))).alias("shape"))
    small = [("s", box(40 + x, y, 40.5 + x, y + 0.5)) for x in range(10) for y in range(10)]
    layer = shapes(spark, [("b", box(-1, -1, 22.5, 31)), *small])
    border = overlay.union_border(layer.select("geometry"), [])
    spots = zones.select("id", *[F.expr(f"cast(({cover.inner_point('shape')}).{c} * 1e9 as long) as g{c}") for c in "xy"])
    tiles = cover.tiles_over(border, spots, 50)
    where = [(int(tiles.column(np.array([2 * r.gx]))[0]), int(tiles.row(np.array([2 * r.gy]))[0])) for r in spots.collect()]
    counts = sorted(where.count(t) for t in set(where))
    assert len(counts) >= 10 and counts[-1] <= 3 * counts[len(counts) // 2]
    facts = {r.id: (r.touch, r.meets, r.inside) for r in cover.polygon_facts(zones, border, tile=50).collect()}
    for n, _ in rows:
        x = n % 30
        assert facts[n] == (x < 23, x < 23, x < 22), n


@pytest.mark.parametrize("name", ["within", "overlaps"])
def test_layers_are_not_broadcast(spark, capsys, name):
    """Shapes are sorted and merged, also where files are small enough for a broadcast."""
    texts = [box(k, 0, k + 1, 1) for k in range(6)]
    zones = zone_table(spark, texts)
    layer = shapes(spark, [("", box(0, 0, 3.5, 1)), ("", box(2, 0, 2.5, 1))])
    kept = zone_ops.zones_by_layer(zones, layer, name)
    assert picked(kept) == set(texts[:3] if name == "within" else texts[3:4])
    kept.explain()
    plan = capsys.readouterr().out
    assert "SortMergeJoin" in plan and "BroadcastHashJoin" not in plan


def test_edges_over_each_other_are_made_one(spark):
    """Boxes that each lie over the next thirty: no more stretches than twice their edges."""
    table = shapes(spark, [("a", box(k, 0, k + 30, 1)) for k in range(100)])
    edges = overlay.netted_edges(table, ["g"]).cache()
    found = [tuple(r) for r in overlay.levelled(edges).select("x1", "y1", "x2", "y2", "way").collect()]
    assert len(found) <= 2 * edges.count()
    unit = 10**overlay.SNAP
    want = {(k * unit, 0, (k + 1) * unit, 0): min(k + 1, 30, 129 - k) for k in range(129)}
    assert {f[:4]: f[4] for f in found if f[1] == f[3] == 0} == want
    border = overlay.union_edges(table, ["g"], tile=20)
    assert area(border) == {"a": 129}
