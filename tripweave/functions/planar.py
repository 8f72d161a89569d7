"""Segments of one tile of the plane: where they meet, and what covers their two sides.

All coordinates are whole numbers (grid units), so that every decision is exact. What lies
halfway, middles of segments and tile borders, is kept as doubled coordinates. Functions
take and give numpy arrays; they know nothing of Spark.

Segments are cut by snap rounding: each end and each crossing of two segments marks its
grid point, and every segment is led through the middles of all marked points whose unit
square it passes. Segments made so meet at their ends only.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np

PAIRS = 1 << 20  # candidates looked at in one go


def side(ax, ay, bx, by, px, py) -> np.ndarray:
    """The side of the line from a to b that p lies on: 1 left, -1 right. A point on the
    line counts as moved up a little, or to the left of an upright line going up."""
    dx, dy, ex, ey = bx - ax, by - ay, px - ax, py - ay
    one, two = dx.astype(float) * ey, dy.astype(float) * ex
    turn = one - two
    found = np.sign(turn).astype(np.int64)
    unsure = np.flatnonzero(np.abs(turn) <= (np.abs(one) + np.abs(two)) * 4e-16)
    if len(unsure):  # too close for doubles: the same with exact integers
        wide = [np.broadcast_to(v, turn.shape)[unsure].astype(object) for v in (dx, dy, ex, ey)]
        exact = wide[0] * wide[3] - wide[1] * wide[2]
        flat = np.where(wide[0] != 0, wide[0], wide[1])
        found[unsure] = [(t > 0) - (t < 0) or ((f > 0) - (f < 0)) for t, f in zip(exact, flat, strict=True)]
    return found


def ranges(start: np.ndarray, stop: np.ndarray, limit: int = PAIRS) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(i, j) for every i and every j from start[i] up to stop[i], in bounded chunks."""
    count = np.maximum(stop - start, 0)
    done = np.concatenate([[0], np.cumsum(count)])
    first = 0
    while first < len(count):
        last = max(first + 1, int(np.searchsorted(done, done[first] + limit, "right")) - 1)
        n = count[first:last]
        i = np.repeat(np.arange(first, last), n)
        j = np.arange(done[last] - done[first]) - np.repeat(done[first:last] - done[first], n) + start[i]
        if len(i):
            yield i, j
        first = last


class Slabs:
    """Horizontal slabs of equal height, about as many as the root of the number of boxes."""

    def __init__(self, low: int, high: int, boxes: int):
        self.low, self.count = low, max(1, int(boxes**0.5))
        self.height = -(-(high - low + 1) // self.count)

    def of(self, y: np.ndarray) -> np.ndarray:
        return (y - self.low) // self.height

    def spread(self, ymin: np.ndarray, ymax: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(number, slab) of every box and every slab it reaches into."""
        parts = list(ranges(self.of(ymin), self.of(ymax) + 1))
        return np.concatenate([p[0] for p in parts]), np.concatenate([p[1] for p in parts])


def meeting(g1, x1, x2, y1, y2, g2, u1, u2, v1, v2) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (i, j) of boxes [x1, x2] x [y1, y2] and [u1, u2] x [v1, v2] of the same group
    that meet, each pair once: slabs by y, and by order of x in each slab. Second boxes are
    taken by classes of width, so that a wide one does not make all look wide."""
    if not len(g1) or not len(g2):
        return
    slabs = Slabs(int(min(y1.min(), v1.min())), int(max(y2.max(), v2.max())), len(g2))
    i, si = slabs.spread(y1, y2)
    width = np.ceil(np.log2((u2 - u1).astype(float) + 1) / 2)
    for kind in np.unique(width).tolist():
        some = np.flatnonzero(width == kind)
        j, sj = slabs.spread(v1[some], v2[some])
        j = some[j]
        # second boxes in the order of (group, slab, left end)
        starts = np.unique(u1[j])
        many = len(starts) + 1
        keys = (g2[j] * slabs.count + sj) * many + np.searchsorted(starts, u1[j])
        order = np.argsort(keys, kind="stable")
        keys, j = keys[order], j[order]
        mine = (g1[i] * slabs.count + si) * many
        begin = np.searchsorted(keys, mine + np.searchsorted(starts, x1[i] - int((u2 - u1)[some].max()), "left"))
        end = np.searchsorted(keys, mine + np.searchsorted(starts, x2[i], "right"))
        for a, b in ranges(begin, end):
            p, q = i[a], j[b]
            meet = (u2[q] >= x1[p]) & (u1[q] <= x2[p]) & (v1[q] <= y2[p]) & (y1[p] <= v2[q])
            meet &= slabs.of(np.maximum(y1[p], v1[q])) == si[a]  # the slab of the common low edge
            if meet.any():
                yield p[meet], q[meet]


def crossings(group, ax, ay, bx, by) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(group, x, y) of the grid points where two segments cross inside both."""
    left, right, low, high = np.minimum(ax, bx), np.maximum(ax, bx), np.minimum(ay, by), np.maximum(ay, by)
    found = []
    for i, j in meeting(group, left, right, low, high, group, left, right, low, high):
        keep = i < j
        i, j = i[keep], j[keep]
        rx, ry, sx, sy = (v.astype(float) for v in (bx[i] - ax[i], by[i] - ay[i], bx[j] - ax[j], by[j] - ay[j]))
        wx, wy = (ax[j] - ax[i]).astype(float), (ay[j] - ay[i]).astype(float)
        both = rx * sy - ry * sx
        with np.errstate(divide="ignore", invalid="ignore"):
            t, u = (wx * sy - wy * sx) / both, (wx * ry - wy * rx) / both
        # ends that touch are marked anyway: nothing is lost at t or u of 0 or 1
        hit = (both != 0) & (t > 0) & (t < 1) & (u > 0) & (u < 1)
        i, t, rx, ry = i[hit], t[hit], rx[hit], ry[hit]
        found.append((group[i], ax[i] + np.rint(t * rx).astype(np.int64), ay[i] + np.rint(t * ry).astype(np.int64)))
    if not found:
        return (np.empty(0, np.int64),) * 3
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def through(group, ax, ay, bx, by, marked) -> tuple[np.ndarray, np.ndarray]:
    """(segment, marked point) for each marked point (group, x, y) whose unit square the
    segment passes."""
    mg, mx, my = marked
    left, right, low, high = np.minimum(ax, bx), np.maximum(ax, bx), np.minimum(ay, by), np.maximum(ay, by)
    found = [(np.empty(0, np.int64), np.empty(0, np.int64))]
    for i, j in meeting(group, left, right, low, high, mg, mx, mx, my, my):
        dx, dy = (bx[i] - ax[i]).astype(float), (by[i] - ay[i]).astype(float)
        off = np.abs(dx * (my[j] - ay[i]) - dy * (mx[j] - ax[i]))
        near = off <= (np.abs(dx) + np.abs(dy)) * 0.500001
        found.append((i[near], j[near]))
    return tuple(np.concatenate(c) for c in zip(*found, strict=True))


def nodes(group, ax, ay, bx, by, inside) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(segment, x, y): the marked points of a tile that each segment is led through.
    ``inside(x, y)`` tells which grid points are the tile's own."""
    g = np.concatenate([group, group])
    x, y = np.concatenate([ax, bx]), np.concatenate([ay, by])
    cg, cx, cy = crossings(group, ax, ay, bx, by)
    marks = np.stack([np.concatenate([g, cg]), np.concatenate([x, cx]), np.concatenate([y, cy])], axis=1)
    marks = np.unique(marks[inside(marks[:, 1], marks[:, 2])], axis=0)
    i, j = through(group, ax, ay, bx, by, (marks[:, 0], marks[:, 1], marks[:, 2]))
    return i, marks[j, 1], marks[j, 2]


def coverage_at(group, x1, y1, x2, y2, way, points, corner, base, skip=None) -> np.ndarray:
    """What covers some points (group, doubled x, doubled y) of a tile.

    Segments go from (x1, y1) to (x2, y2) in rising order and meet at ends only; ``way``
    is by how much coverage is larger on the left. ``base`` is the coverage, by group,
    at the tile's doubled ``corner``. From there a path leads up to the height of each
    point and then right to it; what it crosses changes the coverage. ``skip`` names a
    segment for each point that the last stretch of its path does not count.
    """
    cx, cy = corner
    ax, ay, bx, by = 2 * x1, 2 * y1, 2 * x2, 2 * y2
    mg, mx, my = points
    found = base[mg].astype(np.int64)

    def crossed(m, s, px, py, qx, qy, spans) -> None:
        m, s = m[spans], s[spans]
        px, py, qx, qy = (np.broadcast_to(v, spans.shape)[spans] for v in (px, py, qx, qy))
        line = ax[s], ay[s], bx[s], by[s]
        change = way[s] * (side(*line, qx, qy) - side(*line, px, py)) // 2
        np.add.at(found, m, change)

    # up the left border, past segments that cross it, the one to skip among them
    over = np.flatnonzero((ax < cx) & (bx > cx))
    if len(over):
        order = np.argsort(group[over], kind="stable")
        over = over[order]
        begin, end = (np.searchsorted(group[over], mg, s) for s in ("left", "right"))
        for m, k in ranges(begin, end):
            crossed(m, over[k], cx, cy, cx, my[m], np.ones(len(m), bool))
    # and right to the point
    low, high = np.minimum(ay, by), np.maximum(ay, by)
    far = np.full(len(mx), cx)
    for m, s in meeting(mg, np.minimum(far, mx), mx, my, my, group, ax, bx, low, high):
        spans = (ay[s] > my[m]) != (by[s] > my[m])
        if skip is not None:
            spans &= s != skip[m]
        crossed(m, s, cx, my[m], mx[m], my[m], spans)
    return found


def covers(group, x1, y1, x2, y2, way, own, corner, base) -> tuple[np.ndarray, np.ndarray]:
    """What covers the left and the right side of the segments numbered ``own``, by the
    coverage beside their middles (see ``coverage_at``)."""
    middles = group[own], x1[own] + x2[own], y1[own] + y2[own]
    found = coverage_at(group, x1, y1, x2, y2, way, middles, corner, base, own)
    # the path comes from the west, or from above where the segment is level
    rising = y2[own] >= y1[own]
    step = way[own]
    return np.where(rising, found, found + step), np.where(rising, found - step, found)


def near_boxes(boxes, x1, y1, x2, y2) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Pairs (box, segment) of the boxes (left, right, low, high) that the segments pass or
    touch; a box whose corners all lie on one side of a segment's line is left out."""
    left, right, low, high = boxes
    one, two = np.zeros(len(left), np.int64), np.zeros(len(x1), np.int64)
    for b, s in meeting(one, left, right, low, high, two, x1, x2, np.minimum(y1, y2), np.maximum(y1, y2)):
        line = x1[s], y1[s], x2[s], y2[s]
        turns = [(line[2] - line[0]).astype(float) * (v[b] - line[1]) - (line[3] - line[1]).astype(float) * (h[b] - line[0])
                 for h in (left, right) for v in (low, high)]
        slack = 1e-6 * (np.abs(line[2] - line[0]) + np.abs(line[3] - line[1]))
        keep = (np.min(turns, axis=0) <= slack) & (np.max(turns, axis=0) >= -slack)
        if keep.any():
            yield b[keep], s[keep]
