"""Intersection, union, difference and symmetric difference of any polygons with holes, over Arrow batches.

Both outlines are cut at all their crossings and touching points, on a grid far finer than the shapes. A part belongs to
the result's outline if exactly one of its sides is inside the result; parts join to rings around the inside. Shared
edges, touching corners and holes need no case of their own. Rings count by parity, so all rings of several polygons that
share no area are a shape too.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

from geoloom.functions.geometry import area, ring_area

Ring = list[tuple[float, float]]
MULTI = "array<array<array<struct<x:double,y:double>>>>"
OPERATIONS: dict[str, Callable] = {"intersection": lambda a, b: a & b, "union": lambda a, b: a | b, "difference": lambda a, b: a & ~b, "symmetric_difference": lambda a, b: a ^ b}
#: Steps of the grid along the longer side of both shapes, at least half as many, and rows of a comparison held at once.
STEPS, ROWS = 2.0**38, 256


def _edges(rings: list[Ring]) -> np.ndarray:
    found = [(*p, *q) for ring in rings for p, q in zip(ring, ring[1:] + ring[:1], strict=True)]
    return np.array(found, dtype=float).reshape(-1, 4)


def _parts(edges: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Edges cut wherever another one crosses or touches them: (x, y, x, y) of each part on the grid, and its edge."""
    n = len(edges)
    p, r = edges[:, :2], edges[:, 2:] - edges[:, :2]
    size = np.hypot(r[:, 0], r[:, 1])
    low, high = np.minimum(p, edges[:, 2:]), np.maximum(p, edges[:, 2:])
    cuts: list[list[tuple[float, float]]] = [[] for _ in range(n)]
    for start in range(0, n, ROWS):
        i = np.arange(start, min(n, start + ROWS))[:, None]
        near = ((low[i] <= high[None] + 1) & (low[None] <= high[i] + 1)).all(axis=2) & (np.arange(n)[None] != i)
        a, b = np.nonzero(near)
        a = a + start
        gap = p[b] - p[a]
        cross = r[a, 0] * r[b, 1] - r[a, 1] * r[b, 0]
        with np.errstate(divide="ignore", invalid="ignore"):
            t = (gap[:, 0] * r[b, 1] - gap[:, 1] * r[b, 0]) / cross
            u = (gap[:, 0] * r[a, 1] - gap[:, 1] * r[a, 0]) / cross
        # Both edges of a pair get the same point: it is worked out on the one with the smaller number.
        meet = (a < b) & (cross != 0) & (t >= 0) & (t <= 1) & (u >= 0) & (u <= 1)
        for k in np.flatnonzero(meet):
            at = tuple(np.rint(p[a[k]] + r[a[k]] * t[k]))
            cuts[a[k]].append(at)
            cuts[b[k]].append(at)
        for end in (p[b], edges[b, 2:]):
            off = end - p[a]
            along = (off * r[a]).sum(axis=1) / size[a] ** 2
            aside = np.abs(off[:, 0] * r[a, 1] - off[:, 1] * r[a, 0]) / size[a]
            for k in np.flatnonzero((aside <= 1) & (along > 0) & (along < 1)):
                cuts[a[k]].append(tuple(end[k]))
    found, owner = [], []
    for e in range(n):
        ends = (tuple(edges[e, :2]), tuple(edges[e, 2:]))
        order = sorted({*cuts[e], *ends}, key=lambda c: (c[0] - p[e, 0]) * r[e, 0] + (c[1] - p[e, 1]) * r[e, 1])
        found += [(*x, *y) for x, y in zip(order, order[1:], strict=False)]
        owner += [e] * (len(order) - 1)
    return np.array(found, dtype=float).reshape(-1, 4), np.array(owner, dtype=int)


def _sides(parts: np.ndarray, odd: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For each part and shape, whether the side ahead is inside: towards larger x, or larger y where the part is level; and
    whether the other side is."""
    n = len(parts)
    middle = (parts[:, :2] + parts[:, 2:]) / 2
    level = parts[:, 1] == parts[:, 3]
    ahead = np.zeros((n, odd.shape[1]), dtype=int)
    for flat in (False, True):
        along, across = (0, 1) if flat else (1, 0)
        low, high = np.minimum(parts[:, along], parts[:, along + 2]), np.maximum(parts[:, along], parts[:, along + 2])
        rows = np.flatnonzero(level == flat)
        for start in range(0, len(rows), ROWS):
            i = rows[start : start + ROWS]
            m = middle[i]
            with np.errstate(divide="ignore", invalid="ignore"):
                share = (m[:, along, None] - parts[None, :, along]) / (parts[:, along + 2] - parts[:, along])[None]
            at = parts[None, :, across] + share * (parts[:, across + 2] - parts[:, across])[None]
            hit = (low[None] <= m[:, along, None]) & (m[:, along, None] < high[None]) & (at > m[:, across, None])
            hit[np.arange(len(i)), i] = False
            ahead[i] = hit.astype(int) @ odd
    ahead %= 2
    return ahead.astype(bool), ((ahead + odd) % 2).astype(bool)


def _rings(starts: np.ndarray, stops: np.ndarray) -> list[Ring]:
    """Rings of directed parts with the inside on their left; where several leave a corner, the first one clockwise."""
    out: dict[tuple, list[tuple]] = defaultdict(list)
    for a, b in zip(map(tuple, starts), map(tuple, stops), strict=True):
        out[a].append(b)
    rings = []
    while out:
        first = next(iter(out))
        ring, here = [first], out[first].pop()
        while here != first:
            ring.append(here)
            ways = out.get(here)
            if not ways:
                ring = []
                break
            back = np.arctan2(ring[-2][1] - here[1], ring[-2][0] - here[0])
            turn = [(back - np.arctan2(w[1] - here[1], w[0] - here[0])) % (2 * np.pi) or 2 * np.pi for w in ways]
            there = ways.pop(int(np.argmin(turn)))
            if not ways:
                del out[here]
            here = there
        if not out.get(first, True):
            del out[first]
        rings += _loops(ring)
    return rings


def _loops(ring: Ring) -> list[Ring]:
    """A ring in parts that meet no corner twice: a hole that touches its outline is a ring of its own."""
    loops, stack, place = [], [], {}
    for p in ring:
        if p in place:
            at = place[p]
            loop, stack = stack[at:], stack[:at]
            loops.append(loop)
            for q in loop:
                del place[q]
        place[p] = len(stack)
        stack.append(p)
    return [x for x in (*loops, stack) if len(x) > 2]


def signed_area(ring: Ring) -> float:
    """Area of an open ring, negative if it runs clockwise."""
    v = np.array(ring) - np.array(ring[0])
    w = np.roll(v, -1, axis=0)
    return float((v[:, 0] * w[:, 1] - w[:, 0] * v[:, 1]).sum() / 2)


def _holds(ring: Ring, p: tuple[float, float]) -> bool:
    inside = False
    for a, b in zip(ring, ring[1:] + ring[:1], strict=True):
        if (a[1] > p[1]) != (b[1] > p[1]) and p[0] < (b[0] - a[0]) * (p[1] - a[1]) / (b[1] - a[1]) + a[0]:
            inside = not inside
    return inside


def _straight(ring: Ring) -> Ring:
    """A ring without corners that lie on the line between their neighbours."""
    n = len(ring)
    keep = [(b[0] - a[0]) * (c[1] - b[1]) != (b[1] - a[1]) * (c[0] - b[0]) for a, b, c in ((ring[i - 1], ring[i], ring[(i + 1) % n]) for i in range(n))]
    return [p for p, k in zip(ring, keep, strict=True) if k]


def clipped(subject: Ring, window: Ring) -> Ring:
    """A ring cut to a convex ring (Sutherland and Hodgman, 1974); both open, any direction."""
    turn = sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(window, window[1:] + window[:1], strict=True))
    edges = window if turn > 0 else window[::-1]
    out = subject
    for a, b in zip(edges, edges[1:] + edges[:1], strict=True):
        side = lambda p, a=a, b=b: (b[0] - a[0]) * (p[1] - a[1]) - (b[1] - a[1]) * (p[0] - a[0])
        before, out = out, []
        for p, q in zip(before, before[1:] + before[:1], strict=True):
            sp, sq = side(p), side(q)
            if sp >= 0:
                out.append(p)
            if sp * sq < 0:
                t = sp / (sp - sq)
                out.append((p[0] + t * (q[0] - p[0]), p[1] + t * (q[1] - p[1])))
        if not out:
            break
    return out


def ring_size(ring: Ring) -> float:
    """Area of an open ring."""
    return abs(sum(a[0] * b[1] - b[0] * a[1] for a, b in zip(ring, ring[1:] + ring[:1], strict=True))) / 2 if ring else 0.0


def is_convex(ring: Ring) -> bool:
    """Whether an open ring never turns both ways."""
    n = len(ring)
    turns = [(ring[(i + 1) % n][0] - ring[i][0]) * (ring[(i + 2) % n][1] - ring[(i + 1) % n][1]) - (ring[(i + 1) % n][1] - ring[i][1]) * (ring[(i + 2) % n][0] - ring[(i + 1) % n][0]) for i in range(n)]
    return all(t >= 0 for t in turns) or all(t <= 0 for t in turns)


def overlay(a: list[Ring], b: list[Ring], operation: str = "intersection") -> list[list[Ring]]:
    """Polygons (outer ring counterclockwise, then its holes, all open) of an operation on two shapes, given as open rings."""
    if operation == "intersection" and len(a) == len(b) == 1 and is_convex(a[0]) and is_convex(b[0]):
        ring = list(dict.fromkeys(clipped(a[0], b[0])))
        return [[ring if signed_area(ring) > 0 else ring[::-1]]] if ring_size(ring) > 0 else []
    edges = [_edges([r for r in shape if len(r) > 2]) for shape in (a, b)]
    whole = np.vstack(edges)
    if not len(whole):
        return []
    corner = whole.reshape(-1, 2).min(axis=0)
    extent = float((whole.reshape(-1, 2).max(axis=0) - corner).max())
    if not 0 < extent < np.inf:
        return []
    # Steps are powers of two, counted from zero: a result's corners stay where they are in the next operation.
    step = 2.0 ** np.ceil(np.log2(extent)) / STEPS
    corner = np.floor(corner / step) * step
    gridded = np.rint((whole - np.tile(corner, 2)) / step)
    real = (gridded[:, :2] != gridded[:, 2:]).any(axis=1)
    shape_of = np.repeat([0, 1], [len(edges[0]), len(edges[1])])[real]
    parts, owner = _parts(gridded[real])
    # One part in one direction for each place, with the parity of each shape's edges there.
    swap = (parts[:, 1] > parts[:, 3]) | ((parts[:, 1] == parts[:, 3]) & (parts[:, 0] > parts[:, 2]))
    parts[swap] = parts[swap][:, [2, 3, 0, 1]]
    parts, place = np.unique(parts, axis=0, return_inverse=True)
    odd = np.zeros((len(parts), 2), dtype=int)
    np.add.at(odd, (place.reshape(-1), shape_of[owner]), 1)
    odd %= 2
    parts, odd = parts[odd.any(axis=1)], odd[odd.any(axis=1)]
    ahead, behind = _sides(parts, odd)
    inside = OPERATIONS[operation]
    front, back = inside(ahead[:, 0], ahead[:, 1]), inside(behind[:, 0], behind[:, 1])
    level = parts[:, 1] == parts[:, 3]
    # Along the part's direction (up, or to larger x) the left side is the one behind, or the one ahead of a level part.
    left, edge = np.where(level, front, back), front != back
    starts, stops = np.where(left[:, None], parts[:, :2], parts[:, 2:])[edge], np.where(left[:, None], parts[:, 2:], parts[:, :2])[edge]
    rings = [(signed_area(r), r) for r in _rings(starts, stops)]
    outers = sorted(((s, r, [r]) for s, r in rings if s > 0), key=lambda x: x[0])
    for _, hole in (x for x in rings if x[0] < 0):
        # A point just left of the hole's first part is inside the polygon that has the hole.
        (ax, ay), (bx, by) = hole[0], hole[1]
        far = np.hypot(bx - ax, by - ay)
        p = ((ax + bx) / 2 - (by - ay) / far * 0.25, (ay + by) / 2 + (bx - ax) / far * 0.25)
        home = next((polygon for _, outer, polygon in outers if _holds(outer, p)), None)
        if home is not None:
            home.append(hole)
    real_place = lambda ring: [(float(x * step + corner[0]), float(y * step + corner[1])) for x, y in _straight(ring)]
    return [[r for r in map(real_place, polygon) if len(r) > 2] for _, _, polygon in outers]


def shape_area(polygons: list[list[Ring]]) -> float:
    """Area of polygons without their holes."""
    return sum(abs(signed_area(p[0])) - sum(abs(signed_area(h)) for h in p[1:]) for p in polygons if p)


def united(shapes: list[list[Ring]]) -> list[list[Ring]]:
    """The union of shapes, pair by pair, so that no shape is compared with all others one after another."""
    now = [overlay(s, [], "union") for s in shapes]
    while len(now) > 1:
        flat = [[r for polygon in x for r in polygon] for x in now]
        now = [overlay(flat[i], flat[i + 1], "union") if i + 1 < len(flat) else now[i] for i in range(0, len(flat), 2)]
    return now[0] if now else []


POINT_TYPE = pa.struct([("x", pa.float64()), ("y", pa.float64())])
POLYGON_TYPE = pa.list_(pa.list_(POINT_TYPE))
MULTI_TYPE = pa.list_(POLYGON_TYPE)


def split_at(values: list, lengths: pa.Array) -> list[list]:
    """Values in runs of given lengths, null counting as none."""
    ends = np.cumsum(lengths.fill_null(0).to_numpy(zero_copy_only=False)).tolist()
    return [values[a:b] for a, b in zip([0, *ends], ends, strict=False)]


def shapes_of(column: pa.Array, closed: bool = False) -> list[list[Ring] | None]:
    """Each polygon of a column as its rings, without their repeated last point unless `closed`; None for null."""
    rings = column.flatten()
    points = rings.flatten()
    places = list(zip(*(points.field(c).to_pylist() for c in ("x", "y")), strict=True)) if len(points) else []
    runs = [r[:-1] if not closed and len(r) > 1 and r[0] == r[-1] else r for r in split_at(places, rings.value_lengths())]
    return [x if known else None for x, known in zip(split_at(runs, column.value_lengths()), column.is_valid().to_pylist(), strict=True)]


def as_value(polygons: list[list[Ring]]) -> list:
    """Polygons as values, rings closed."""
    return [[[{"x": x, "y": y} for x, y in [*ring, ring[0]]] for ring in polygon] for polygon in polygons]


def as_column(found: list[list[list[Ring]] | None]) -> pa.Array:
    """Polygons of each row as a column of MULTI."""
    return pa.array([None if x is None else as_value(x) for x in found], MULTI_TYPE)


def each_once(work: Callable, *columns: list) -> Iterator:
    """What `work` gives for each row of a batch, worked out once for equal rows; null where a value is."""
    known: dict = {}
    for row in zip(*columns, strict=True):
        key = repr(row)
        if key not in known:
            known[key] = None if any(x is None for x in row) else work(*row)
        yield known[key]


def overlaid(a: Column, b: Column, operation: str = "intersection") -> Column:
    """The polygons of an operation on two polygons; null if either is. Empty where nothing is left.

    Coordinates are kept to about 4e-12 of the shapes' extent. Edges are compared with edges near them only, in memory of
    some hundred rows, but all in one row's time: subdivide outlines of many thousand corners first.
    """

    @F.arrow_udf(MULTI)
    def run(first: pa.Array, second: pa.Array) -> pa.Array:
        return as_column(list(each_once(lambda x, y: overlay(x, y, operation), shapes_of(first), shapes_of(second))))

    return run(a, b)


def rings_of(polygons: Column) -> Column:
    """All rings of several polygons as one shape."""
    return F.flatten(polygons)


def rounded_leg(a: tuple[float, float], b: tuple[float, float], far: float, arcs: int) -> Ring:
    """All places within `far` of a leg, its round ends as `arcs` chords a quarter."""
    turn = np.arctan2(b[1] - a[1], b[0] - a[0])
    # Corners stand at whole steps from the axes, so that legs in any direction share them with their neighbours.
    step = np.pi / 2 / arcs
    ends = []
    for (x, y), start in ((b, turn - np.pi / 2), (a, turn + np.pi / 2)):
        inner = np.arange(np.floor(start / step + 1e-9) + 1, np.ceil((start + np.pi) / step - 1e-9)) * step
        ends += [(float(x + far * np.cos(t)), float(y + far * np.sin(t))) for t in (start, *inner, start + np.pi)]
    return ends


def buffer(rings: list[Ring], far: float, arcs: int = 8) -> list[list[Ring]]:
    """All places within `far` of a shape, as the union of the shape and the surroundings of its legs."""
    legs = [[rounded_leg(p, q, far, arcs)] for ring in rings for p, q in zip(ring, ring[1:] + ring[:1], strict=True) if p != q]
    return united([rings, *legs])


def buffered(polygon: Column, far: Column | float, arcs: int = 8) -> Column:
    """The polygons of all places within a planar distance of a polygon; null for a null one or distance."""

    @F.arrow_udf(MULTI)
    def run(shapes: pa.Array, by: pa.Array) -> pa.Array:
        return as_column(list(each_once(lambda x, d: buffer(x, d, arcs), shapes_of(shapes), by.to_pylist())))

    return run(polygon, (far if isinstance(far, Column) else F.lit(float(far))).cast("double"))


def nearest_parts(seeds: list[tuple[float, float]], box: Ring) -> list[Ring]:
    """For each seed the part of a convex ring that is nearer to it than to any other; of equal seeds the first has it.

    Other seeds come in order of distance; one that is more than twice as far as the part's farthest corner cuts nothing.
    """
    place = np.array(seeds, dtype=float).reshape(-1, 2)
    parts = []
    for i, (x, y) in enumerate(place):
        ring = box
        far = np.hypot(place[:, 0] - x, place[:, 1] - y)
        for j in np.argsort(far, kind="stable"):
            if j == i or not ring:
                continue
            if far[j] == 0:
                ring = ring if i < j else []
                continue
            if far[j] > 2 * max(np.hypot(p[0] - x, p[1] - y) for p in ring):
                break
            nx, ny = (place[j] - place[i]) / far[j]
            side = [(p[0] - x) * nx + (p[1] - y) * ny - far[j] / 2 for p in ring]
            cut: Ring = []
            for p, q, s, t in zip(ring, ring[1:] + ring[:1], side, side[1:] + side[:1], strict=True):
                if s <= 0:
                    cut.append(p)
                if s * t < 0:
                    cut.append((float(p[0] + (q[0] - p[0]) * s / (s - t)), float(p[1] + (q[1] - p[1]) * s / (s - t))))
            ring = cut if len(cut) > 2 else []
        parts.append(ring)
    return parts


def voronoi(seeds: Column, outline: Column) -> Column:
    """For each of an array of points the polygons of an outline's part that is nearest to it; null for a null outline.

    Parts cover the outline and share no area. One row holds one outline with its seeds; their number is meant to be small.
    """

    @F.arrow_udf(f"array<{MULTI}>")
    def run(places: pa.Array, shapes: pa.Array) -> pa.Array:
        out = []
        for points, rings in zip(places.to_pylist(), shapes_of(shapes), strict=True):
            corners = [p for r in rings or [] for p in r]
            found = [[] for _ in points or []]
            if corners and points:
                (x0, y0), (x1, y1) = np.min(corners, axis=0), np.max(corners, axis=0)
                box = [(float(x0), float(y0)), (float(x1), float(y0)), (float(x1), float(y1)), (float(x0), float(y1))]
                found = [overlay(rings, [part]) if part else [] for part in nearest_parts([(p["x"], p["y"]) for p in points], box)]
            out.append(None if rings is None or points is None else [as_value(x) for x in found])
        return pa.array(out, pa.list_(MULTI_TYPE))

    return run(seeds, outline)


def strips(rings: list[Ring]) -> np.ndarray:
    """Trapezoids (y, left, right, y, left, right) that make up a shape, between the heights of its corners."""
    edges = _edges(rings)
    edges = edges[edges[:, 1] != edges[:, 3]]
    heights = np.unique(edges[:, [1, 3]])
    out = []
    for low, high in zip(heights, heights[1:], strict=False):
        own = edges[(np.minimum(edges[:, 1], edges[:, 3]) <= low) & (np.maximum(edges[:, 1], edges[:, 3]) >= high)]
        at = lambda y, e=own: e[:, 0] + (e[:, 2] - e[:, 0]) * ((y - e[:, 1]) / (e[:, 3] - e[:, 1]))
        order = np.argsort(at((low + high) / 2), kind="stable")
        bottom, top = at(low)[order], at(high)[order]
        out += [(low, bottom[i], bottom[i + 1], high, top[i], top[i + 1]) for i in range(0, len(order) - 1, 2)]
    return np.array(out, dtype=float).reshape(-1, 6)


def scattered(rings: list[Ring], n: int, seed: int) -> list[tuple[float, float]]:
    """n points spread evenly at random over a shape, the same for a seed; none for a shape without an area."""
    t = strips(rings)
    width0, width1 = t[:, 2] - t[:, 1], t[:, 5] - t[:, 4]
    size = (width0 + width1) / 2 * (t[:, 3] - t[:, 0])
    if n <= 0 or not size.sum() > 0:
        return []
    rng = np.random.default_rng(seed)
    k = rng.choice(len(t), n, p=size / size.sum())
    u, v = rng.random(n), rng.random(n)
    # The share of height below which a share u of a trapezoid's area lies.
    a, b = width0[k], width1[k] - width0[k]
    level = np.where(np.abs(b) < 1e-12 * np.maximum(a, 1e-300), u, (np.sqrt(np.maximum(a * a + u * b * (2 * a + b), 0)) - a) / np.where(b == 0, 1, b))
    y = t[k, 0] + level * (t[k, 3] - t[k, 0])
    left = t[k, 1] + level * (t[k, 4] - t[k, 1])
    x = left + v * (a + level * b)
    return list(zip(x.tolist(), y.tolist(), strict=True))


def generated_points(polygon: Column, n: Column, seed: Column) -> Column:
    """n points spread evenly at random over a polygon, the same for a seed; null for a null polygon or number."""

    @F.arrow_udf("array<struct<x:double,y:double>>")
    def run(shapes: pa.Array, numbers: pa.Array, seeds: pa.Array) -> pa.Array:
        found = [None if x is None or k is None else [{"x": a, "y": b} for a, b in scattered(x, k, abs(s or 0))] for x, k, s in zip(shapes_of(shapes), numbers.to_pylist(), seeds.to_pylist(), strict=True)]
        return pa.array(found, pa.list_(POINT_TYPE))

    return run(polygon, n.cast("int"), seed.cast("long"))


def union_of(shapes: Column) -> Column:
    """The polygons of the union of an array of shapes; null members are left out."""

    @F.arrow_udf(MULTI)
    def run(lists: pa.Array) -> pa.Array:
        found = split_at(shapes_of(lists.flatten()), lists.value_lengths())
        return as_column([united([x for x in shapes if x is not None]) for shapes in found])

    return run(shapes)


def merged(shapes: Column, clean: bool) -> Column:
    """The rings of the union of an array of shapes; with `clean` a single shape stays as it is."""

    @F.arrow_udf("array<array<struct<x:double,y:double>>>")
    def run(lists: pa.Array) -> pa.Array:
        out = []
        for found in split_at(shapes_of(lists.flatten()), lists.value_lengths()):
            known = [x for x in found if x is not None]
            polygons = [known[0]] if clean and len(known) == 1 else united(known)
            out.append([ring for polygon in as_value(polygons) for ring in polygon])
        return pa.array(out, POLYGON_TYPE)

    return run(shapes)


def without_small(polygons: Column, least: float, least_hole: float = 0.0) -> Column:
    """Polygons of at least an area, without their holes under one."""
    whole = F.transform(polygons, lambda p: F.filter(p, lambda ring, i: (i == 0) | (ring_area(ring) >= least_hole)))
    return F.filter(whole, lambda p: area(p) >= least)


def total_area(polygons: Column) -> Column:
    """Planar area of several polygons."""
    return F.aggregate(polygons, F.lit(0.0), lambda t, p: t + area(p))


def snapped(polygon: Column, border: Column, far: float, least: float = 0.0) -> Column:
    """A polygon grown by a distance up to the shape of its neighbours, without what overlaps them or is under an area.

    Gaps up to `far` between the polygon and its neighbours close, and it loses what lay inside them.
    """
    own = rings_of(overlaid(polygon, border, "difference"))
    return without_small(overlaid(rings_of(buffered(own, far)), border, "difference"), least)
