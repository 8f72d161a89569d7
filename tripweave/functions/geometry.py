"""Geometry as ordinary columns; each function takes and gives Spark SQL text.

A geometry is ``array<polygon>``, a polygon ``array<ring>`` (shell first, then
holes), a ring an array of ``struct<x,y>`` whose last point repeats the first.
x is the longitude (or easting) and y the latitude (or northing), always.
Shells run counter-clockwise and holes clockwise (see ``oriented``), so the
inside of a geometry lies to the left of each of its edges.
"""

from __future__ import annotations

from tripweave.functions.lambdas import each, fold, having, let, neighbours, num, row


def point(x: str, y: str) -> str:
    return row(x=x, y=y)


def rectangle(xmin: str, ymin: str, xmax: str, ymax: str) -> str:
    corners = [(xmin, ymin), (xmax, ymin), (xmax, ymax), (xmin, ymax), (xmin, ymin)]
    return f"array(array(array({', '.join(point(x, y) for x, y in corners)})))"


def edges(geometry: str) -> str:
    """All edges as array<struct<ax,ay,bx,by>>; edges without length are left out."""
    rings = each(
        f"flatten({geometry})",
        lambda r: neighbours(r, lambda p, q: row(ax=f"{p}.x", ay=f"{p}.y", bx=f"{q}.x", by=f"{q}.y")),
    )
    return having(f"flatten({rings})", lambda e: f"{e}.ax <> {e}.bx or {e}.ay <> {e}.by")


def points(geometry: str) -> str:
    return f"flatten(flatten({geometry}))"


def ring_area(ring: str) -> str:
    """Signed area, positive if counter-clockwise. Measured from the ring's first
    point, which keeps the digits that large coordinates would cancel away."""

    def doubled(v: str) -> str:
        ox, oy = f"{v}.o.x", f"{v}.o.y"
        turns = neighbours(
            f"{v}.ring",
            lambda p, q: f"({p}.x - {ox}) * ({q}.y - {oy}) - ({q}.x - {ox}) * ({p}.y - {oy})",
        )
        return fold(turns, "0D", lambda total, t: f"{total} + {t}") + " / 2"

    return let(row(ring=ring, o=f"get({ring}, 0)"), doubled)


def oriented(geometry: str) -> str:
    """The same geometry with shells counter-clockwise and holes clockwise."""

    def turned(ring: str, i: str) -> str:
        return f"if(({ring_area(ring)} > 0) = ({i} = 0), {ring}, reverse({ring}))"

    return each(geometry, lambda polygon: each(polygon, turned))


def moments(geometry: str) -> str:
    """struct<area, mx, my, ox, oy>: area and first moments about the first point (ox, oy)."""

    def of(v: str) -> str:
        def step(acc: str, e: str) -> str:
            ax, ay = f"({e}.ax - {v}.o.x)", f"({e}.ay - {v}.o.y)"
            bx, by = f"({e}.bx - {v}.o.x)", f"({e}.by - {v}.o.y)"
            turn = f"({ax} * {by} - {bx} * {ay})"
            return row(
                area=f"{acc}.area + {turn} / 2",
                mx=f"{acc}.mx + ({ax} + {bx}) * {turn} / 6",
                my=f"{acc}.my + ({ay} + {by}) * {turn} / 6",
            )

        done = fold(edges(f"{v}.g"), row(area="0D", mx="0D", my="0D"), step)
        return let(
            done,
            lambda d: row(area=f"{d}.area", mx=f"{d}.mx", my=f"{d}.my", ox=f"{v}.o.x", oy=f"{v}.o.y"),
        )

    return let(row(g=geometry, o=f"get({points(geometry)}, 0)"), of)


def area(geometry: str) -> str:
    return f"{moments(geometry)}.area"


def centroid(geometry: str) -> str:
    """Centre of area; holes count against it. NULL if there is no area."""
    return let(
        moments(geometry),
        lambda m: f"if({m}.area <> 0, "
        + point(
            f"{m}.ox + try_divide({m}.mx, {m}.area)", f"{m}.oy + try_divide({m}.my, {m}.area)"
        )
        + ", null)",
    )


def envelope(geometry: str) -> dict[str, str]:
    """Bounding box columns, kept beside each geometry so that files can be pruned by them."""
    xs = each(points(geometry), lambda p: f"{p}.x")
    ys = each(points(geometry), lambda p: f"{p}.y")
    return {
        "xmin": f"array_min({xs})",
        "ymin": f"array_min({ys})",
        "xmax": f"array_max({xs})",
        "ymax": f"array_max({ys})",
    }


def cross(ax: str, ay: str, bx: str, by: str) -> str:
    return f"(({ax}) * ({by}) - ({ay}) * ({bx}))"


def direction(e: str) -> tuple[str, str]:
    return f"({e}.bx - {e}.ax)", f"({e}.by - {e}.ay)"


def folds_back(e: str, f: str) -> str:
    """Neighbour edges that lie on one line and run over each other."""
    (ex, ey), (fx, fy) = direction(e), direction(f)
    return f"({cross(ex, ey, fx, fy)} = 0 and {ex} * {fx} + {ey} * {fy} < 0)"


# Points closer than this to an edge count as lying on it (degrees; about a micrometre).
TOLERANCE = 1e-11


def on_edge(x: str, y: str, e: str, tolerance: float = TOLERANCE) -> str:
    dx, dy = direction(e)
    slack = f"{num(tolerance)} * sqrt({dx} * {dx} + {dy} * {dy})"
    along = f"(({x} - {e}.ax) * {dx} + ({y} - {e}.ay) * {dy})"
    off = cross(dx, dy, f"{x} - {e}.ax", f"{y} - {e}.ay")
    return (
        f"(abs({off}) <= {slack} and {along} >= -({slack})"
        f" and {along} <= {dx} * {dx} + {dy} * {dy} + {slack})"
    )


def segments_cross(e: str, f: str) -> str:
    """Each segment has the ends of the other strictly on both its sides."""

    def sides(g: str, h: str) -> str:
        dx, dy = direction(g)
        first = cross(dx, dy, f"{h}.ax - {g}.ax", f"{h}.ay - {g}.ay")
        second = cross(dx, dy, f"{h}.bx - {g}.ax", f"{h}.by - {g}.ay")
        return f"signum({first}) * signum({second}) < 0"

    return f"({sides(e, f)} and {sides(f, e)})"


def boxes_meet(e: str, f: str, tolerance: float = TOLERANCE) -> str:
    """The bounding boxes of two edges touch (a cheap first test)."""
    t = num(tolerance)

    def spans(c: str, d: str) -> str:
        return f"least({c}.a{d}, {c}.b{d})", f"greatest({c}.a{d}, {c}.b{d})"

    (ex1, ex2), (ey1, ey2) = spans(e, "x"), spans(e, "y")
    (fx1, fx2), (fy1, fy2) = spans(f, "x"), spans(f, "y")
    return (
        f"({ex1} <= {fx2} + {t} and {fx1} <= {ex2} + {t}"
        f" and {ey1} <= {fy2} + {t} and {fy1} <= {ey2} + {t})"
    )


def segments_meet(e: str, f: str, tolerance: float = TOLERANCE) -> str:
    """The segments share at least one point, ends included."""
    touches = [
        segments_cross(e, f),
        on_edge(f"{f}.ax", f"{f}.ay", e, tolerance),
        on_edge(f"{f}.bx", f"{f}.by", e, tolerance),
        on_edge(f"{e}.ax", f"{e}.ay", f, tolerance),
        on_edge(f"{e}.bx", f"{e}.by", f, tolerance),
    ]
    return f"({boxes_meet(e, f, tolerance)} and ({' or '.join(touches)}))"
