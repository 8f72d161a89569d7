"""Exact polygon predicates; each function takes and gives Spark SQL text.

Every question is answered from pieces: an edge of one shape is cut wherever it
may meet the boundary of the other, and the middle of each piece is then inside,
outside or on that boundary, which also settles shapes that share boundaries.

With A, B the two shapes (inside to the left of their edges):
* the interiors meet  <=>  a piece of one boundary runs inside the other shape, or
  both boundaries share a piece with the inside on the same side;
* A lies within B  <=>  for each polygon of A, the interiors meet and no piece of
  B's boundary runs inside that polygon.
"""

from __future__ import annotations

from collections.abc import Callable

from tripweave.functions.geometry import (
    TOLERANCE,
    boxes_meet,
    cross,
    direction,
    edges,
    on_edge,
    segments_meet,
)
from tripweave.functions.lambdas import each, every, having, let, neighbours, num, row, some


def point_inside(x: str, y: str, boundary: str) -> str:
    """Even-odd rule: true if a ray to the right meets the boundary an odd number of times."""

    def hit(e: str) -> str:
        dx, dy = direction(e)
        left = f"{cross(dx, dy, f'{x} - {e}.ax', f'{y} - {e}.ay')} > 0"
        return f"({e}.ay > {y}) <> ({e}.by > {y}) and ({left}) = ({e}.by > {e}.ay)"

    return f"(size({having(boundary, hit)}) % 2 = 1)"


def _middles(e: str, boundary: str) -> str:
    """Middles (x, y) of the pieces of ``e``, with half the length of each as ``r``."""
    dx, dy = direction(e)
    length2 = f"({dx} * {dx} + {dy} * {dy})"

    def cuts(f: str) -> str:
        fx, fy = direction(f)
        meet = cross(f"{f}.ax - {e}.ax", f"{f}.ay - {e}.ay", fx, fy)
        return (
            f"array(try_divide({meet}, {cross(dx, dy, fx, fy)}),"
            f" (({f}.ax - {e}.ax) * {dx} + ({f}.ay - {e}.ay) * {dy}) / {length2},"
            f" (({f}.bx - {e}.ax) * {dx} + ({f}.by - {e}.ay) * {dy}) / {length2})"
        )

    near = having(boundary, lambda f: boxes_meet(e, f))
    inner = having(f"flatten({each(near, cuts)})", lambda t: f"{t} is not null and {t} > 0 and {t} < 1")
    return let(
        f"array_sort(array_distinct(concat(array(0D, 1D), {inner})))",
        lambda ts: neighbours(
            ts,
            lambda s, t: row(
                x=f"{e}.ax + {dx} * ({s} + {t}) / 2",
                y=f"{e}.ay + {dy} * ({s} + {t}) / 2",
                r=f"sqrt({length2}) * ({t} - {s}) / 2",
            ),
        ),
    )


def edge_runs_inside(e: str, boundary: str, tolerance: float = TOLERANCE) -> str:
    """Some piece of the edge lies strictly inside the shape, ``tolerance`` off its boundary."""
    return some(
        _middles(e, boundary),
        lambda m: f"not {some(boundary, lambda f: on_edge(m + '.x', m + '.y', f, tolerance))}"
        f" and {point_inside(m + '.x', m + '.y', boundary)}",
    )


def _edge_shared(e: str, boundary: str) -> str:
    """Some piece of the edge runs along the boundary, inside on the same side."""

    def same_way(m: str, f: str) -> str:
        (ex, ey), (fx, fy) = direction(e), direction(f)
        scale = f"sqrt(({ex} * {ex} + {ey} * {ey}) * ({fx} * {fx} + {fy} * {fy}))"
        return (
            f"{on_edge(m + '.x', m + '.y', f)} and abs({cross(ex, ey, fx, fy)}) <= {num(1e-7)} * {scale}"
            f" and {ex} * {fx} + {ey} * {fy} > 0"
        )

    return some(
        _middles(e, boundary),
        lambda m: f"{m}.r > {num(4 * TOLERANCE)} and {some(boundary, lambda f: same_way(m, f))}",
    )


def _with_edges(a: str, b: str, body: Callable[[str, str], str]) -> str:
    return let(row(a=edges(a), b=edges(b)), lambda v: f"({body(v + '.a', v + '.b')})")


def intersects(a: str, b: str) -> str:
    """The shapes share at least one point; touching counts."""

    def body(ea: str, eb: str) -> str:
        return " or ".join(
            [
                some(ea, lambda e: some(eb, lambda f: segments_meet(e, f))),
                some(ea, lambda e: point_inside(f"{e}.ax", f"{e}.ay", eb)),
                some(eb, lambda f: point_inside(f"{f}.ax", f"{f}.ay", ea)),
            ]
        )

    return _with_edges(a, b, body)


def interiors_meet(a: str, b: str) -> str:
    def body(ea: str, eb: str) -> str:
        return " or ".join(
            [
                some(ea, lambda e: edge_runs_inside(e, eb)),
                some(eb, lambda f: edge_runs_inside(f, ea)),
                some(ea, lambda e: _edge_shared(e, eb)),
            ]
        )

    return _with_edges(a, b, body)


def boundary_runs_inside(a: str, b: str) -> str:
    """Some piece of A's boundary lies strictly inside B."""
    return _with_edges(a, b, lambda ea, eb: some(ea, lambda e: edge_runs_inside(e, eb)))


def within(a: str, b: str) -> str:
    """No point of A lies outside B (boundaries may be shared)."""

    def held(polygon: str) -> str:
        single = f"array({polygon})"
        return f"{interiors_meet(single, b)} and not {boundary_runs_inside(b, single)}"

    return f"(size({a}) > 0 and {every(a, held)})"


def contains(a: str, b: str) -> str:
    return within(b, a)


def overlaps(a: str, b: str) -> str:
    """The interiors meet and each shape has a part outside the other."""
    return f"({interiors_meet(a, b)} and not {within(a, b)} and not {within(b, a)})"


PREDICATES = {
    "intersects": intersects,
    "within": within,
    "contains": contains,
    "overlaps": overlaps,
}


def predicate(name: str) -> Callable[[str, str], str]:
    if name not in PREDICATES:
        raise ValueError(f"unknown predicate {name!r}; known: {', '.join(PREDICATES)}")
    return PREDICATES[name]
