"""Whether outlines meet, in NumPy on the rings of one pair at a time."""

from __future__ import annotations

import numpy as np

Ring = list[tuple[float, float]]


def legs_of(rings: list[Ring]) -> np.ndarray:
    """Legs (x, y, x, y) of lines or closed rings; a single point is a leg without a length."""
    found = [np.hstack([v[:-1], v[1:]]) if len(v) > 1 else np.hstack([v, v]) for v in (np.array(r, dtype=float) for r in rings if len(r))]
    return np.vstack(found) if found else np.zeros((0, 4))


def holds(legs: np.ndarray, p: tuple[float, float]) -> bool:
    """Whether a polygon, given by the legs of all its rings, holds a point; its boundary counts as inside."""
    x0, y0, x1, y1 = legs.T
    cross = (x1 - x0) * (p[1] - y0) - (y1 - y0) * (p[0] - x0)
    on = (cross == 0) & (np.minimum(x0, x1) <= p[0]) & (p[0] <= np.maximum(x0, x1)) & (np.minimum(y0, y1) <= p[1]) & (p[1] <= np.maximum(y0, y1))
    if on.any():
        return True
    rises = (y0 > p[1]) != (y1 > p[1])
    at = (x1[rises] - x0[rises]) * ((p[1] - y0[rises]) / (y1[rises] - y0[rises])) + x0[rises]
    return bool((p[0] < at).sum() % 2)


def touch(a: np.ndarray, b: np.ndarray) -> bool:
    """Whether any leg of one meets any leg of the other, ends included; compared in blocks where boxes meet."""
    low, high = np.minimum(b[:, :2], b[:, 2:]), np.maximum(b[:, :2], b[:, 2:])
    for start in range(0, len(a), 256):
        s = a[start : start + 256]
        near = (np.minimum(s[:, :2], s[:, 2:])[:, None] <= high[None]).all(axis=2) & (low[None] <= np.maximum(s[:, :2], s[:, 2:])[:, None]).all(axis=2)
        i, j = np.nonzero(near)
        if len(i):
            u, v = s[i], b[j]
            turn = lambda o, p: np.sign((o[:, 2] - o[:, 0]) * (p[:, 1] - o[:, 1]) - (o[:, 3] - o[:, 1]) * (p[:, 0] - o[:, 0]))
            if ((turn(u, v[:, :2]) * turn(u, v[:, 2:]) <= 0) & (turn(v, u[:, :2]) * turn(v, u[:, 2:]) <= 0)).any():
                return True
    return False


def line_meets(line: list[Ring], legs: np.ndarray) -> bool:
    """Whether a line shares a point with a polygon, given by its legs."""
    return holds(legs, line[0][0]) or touch(legs_of(line), legs)


def polygon_meets(polygon: list[Ring], area: list[Ring], legs: np.ndarray) -> bool:
    """Whether two polygons share a point; one in a hole of the other doesn't."""
    return holds(legs, polygon[0][0]) or holds(legs_of(polygon), area[0][0]) or touch(legs_of(polygon[:1]), legs)


def centroid(ring: Ring) -> tuple[float, float]:
    """Area-weighted centroid of a closed ring; the mean of its points if it has no area."""
    v = np.array(ring, dtype=float)
    a, b = v[:-1], v[1:]
    cross = a[:, 0] * b[:, 1] - b[:, 0] * a[:, 1]
    twice = cross.sum()
    place = ((a + b) * cross[:, None]).sum(axis=0) / (3 * twice) if abs(twice) > 0 else v.mean(axis=0)
    return float(place[0]), float(place[1])


def cover_of(rings: list[Ring], size: float, most: int) -> list[tuple[int, int, int, bool]]:
    """Square cells (level, x, y, whole) that cover a polygon, boundary included: cells of `size` times 2**level.

    Cells that no leg touches are whole (all inside) or left out; others are quartered, the largest first, down to `size` or
    until there are about `most`. Boxes count as a little wider than they are, so that rounding loses no point.
    """
    legs = legs_of(rings)
    if not len(legs):
        return []
    low, high = np.minimum(legs[:, :2], legs[:, 2:]), np.maximum(legs[:, :2], legs[:, 2:])
    normal = np.stack([legs[:, 1] - legs[:, 3], legs[:, 2] - legs[:, 0]], axis=1)
    bottom, top = low.min(axis=0), high.max(axis=0)
    level = 0
    while (np.floor(top / (size * 2**level)) - np.floor(bottom / (size * 2**level))).max() > 1:
        level += 1
    first, last = (np.floor(v / (size * 2**level)).astype(int) for v in (bottom, top))
    todo = [(level, x, y, np.arange(len(legs))) for x in range(first[0], last[0] + 1) for y in range(first[1], last[1] + 1)]
    out: list[tuple[int, int, int, bool]] = []
    while todo:
        level, x, y, near = todo.pop(0)
        side = size * 2**level
        centre, half = np.array([(x + 0.5) * side, (y + 0.5) * side]), side * (0.5 + 1e-9)
        near = near[((low[near] <= centre + half) & (high[near] >= centre - half)).all(axis=1)]
        off = np.abs((normal[near] * (centre - legs[near, :2])).sum(axis=1))
        near = near[off <= np.abs(normal[near]).sum(axis=1) * half * (1 + 1e-9)]
        if not len(near):
            if holds(legs, (float(centre[0]), float(centre[1]))):
                out.append((level, int(x), int(y), True))
        elif level == 0 or len(out) + len(todo) + 4 > most:
            out.append((level, int(x), int(y), False))
        else:
            todo += [(level - 1, 2 * x + i, 2 * y + j, near) for i in (0, 1) for j in (0, 1)]
    return out
