"""Line work that has no expression in Spark, over Arrow batches."""

from __future__ import annotations

from collections.abc import Iterator
from math import ceil, floor

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def _kept(points: np.ndarray, tolerance: float) -> np.ndarray:
    """Which points (x, y) of a line are farther than `tolerance` from the chord of their part, or its ends."""
    keep = np.zeros(len(points), dtype=bool)
    keep[:1] = keep[-1:] = True
    todo = [(0, len(points) - 1)]
    while todo:
        a, b = todo.pop()
        if b - a < 2:
            continue
        (ax, ay), (bx, by) = points[a].tolist(), points[b].tolist()
        x, y = points[a + 1 : b].T
        length = ((bx - ax) ** 2 + (by - ay) ** 2) ** 0.5
        off = np.abs((bx - ax) * (ay - y) - (ax - x) * (by - ay)) / length if length else np.sqrt((x - ax) ** 2 + (y - ay) ** 2)
        at = int(np.argmax(np.where(off > tolerance, off, 0.0)))
        if off[at] > tolerance:
            keep[a + 1 + at] = True
            todo += [(a, a + 1 + at), (a + 1 + at, b)]
    return keep


def simplified_points(points: list[tuple[float, float]], tolerance: float) -> list[tuple[float, float]]:
    """Douglas and Peucker's line: points farther than `tolerance` from the chord of their part stay."""
    return [p for p, k in zip(points, _kept(np.array(points, dtype=float).reshape(-1, 2), tolerance).tolist(), strict=True) if k]


def simplified(line: Column, tolerance: float) -> Column:
    """A line with fewer points, nowhere farther than `tolerance` from the line given; null for a null line.

    Of points that follow each other at one place the first goes to Python, besides the last of the line: the others never
    stay. There they are numbers in arrays, not an object each, however many lines a batch has.
    """
    n = F.size(line)
    moved = F.filter(line, lambda p, i: (i == 0) | (i == n - 1) | ~p.eqNullSafe(F.get(line, i - 1)))

    @F.arrow_udf("array<struct<x:double,y:double>>")
    def run(lines: pa.Array) -> pa.Array:
        points = lines.flatten()
        xy = np.column_stack([points.field(c).to_numpy(zero_copy_only=False).astype(float) for c in ("x", "y")])
        ends = np.cumsum(lines.value_lengths().fill_null(0).to_numpy(zero_copy_only=False)).tolist()
        keep = [_kept(xy[a:b], tolerance) for a, b in zip([0, *ends], ends, strict=False)]
        xy = xy[np.concatenate(keep)] if keep else xy
        offsets = pa.array([None if gone else at for gone, at in zip([*lines.is_null().to_pylist(), False], np.cumsum([0, *map(np.sum, keep)]).tolist(), strict=True)], pa.int32())
        return pa.ListArray.from_arrays(offsets, pa.StructArray.from_arrays([pa.array(xy[:, 0]), pa.array(xy[:, 1])], names=["x", "y"]))

    return run(moved)


def points_at(line: Column, shares: Column) -> Column:
    """The points at ascending shares of a line's planar length, with one running sum of its legs; null for a null line."""

    @F.pandas_udf("array<struct<x:double,y:double>>")
    def run(lines: pd.Series, at: pd.Series) -> pd.Series:
        def one(points, wanted):
            if points is None or wanted is None or not len(points):
                return None
            xs, ys = (np.array([p[c] for p in points]) for c in ("x", "y"))
            reach = np.concatenate([[0.0], np.cumsum(np.hypot(np.diff(xs), np.diff(ys)))])
            goal = np.asarray(wanted, dtype=float) * reach[-1]
            return [{"x": float(x), "y": float(y)} for x, y in zip(np.interp(goal, reach, xs), np.interp(goal, reach, ys), strict=True)]

        return pd.Series([one(p, w) for p, w in zip(lines, at, strict=True)])

    return run(line, shares)


def located(line: Column, at: Column) -> Column:
    """Share of a line's length at which it comes nearest to a point, the first of equals; null without a line or a point."""

    @F.pandas_udf("double")
    def run(lines: pd.Series, points: pd.DataFrame) -> pd.Series:
        def one(points, x, y):
            if points is None or not len(points) or x is None or y is None or x != x or y != y:
                return None
            v = np.array([(p["x"], p["y"]) for p in points], dtype=float)
            step = np.diff(v, axis=0)
            long = np.hypot(step[:, 0], step[:, 1])
            if not long.sum() > 0:
                return 0.0
            own = np.where(long > 0, ((np.array([x, y]) - v[:-1]) * step).sum(axis=1) / np.where(long > 0, long * long, 1), 0).clip(0, 1)
            near = np.hypot(*(v[:-1] + step * own[:, None] - (x, y)).T)
            k = int(np.argmin(near))
            return float((long[:k].sum() + own[k] * long[k]) / long.sum())

        return pd.Series([one(line, x, y) for line, x, y in zip(lines, points["x"], points["y"], strict=True)], dtype=float)

    return run(line, at)


#: Cuts closer than this share of a leg are one.
SAME_CUT = 1e-12


def cut_line(xs: list[float], ys: list[float], cell: float) -> list[tuple[int, int, list[float], list[float]]]:
    """(cell_x, cell_y, xs, ys) of the parts of a line between places where it goes from one square cell to another.

    Legs are cut where they cross x = k * cell or y = k * cell, and neighbouring parts in one cell are joined again, so that
    vertices inside a cell cut nothing; a part belongs to the cell of its legs' middles. Legs without a length go; a line
    without a length is one part.
    """
    moves = [i for i in range(len(xs) - 1) if xs[i] != xs[i + 1] or ys[i] != ys[i + 1]]
    if not moves:
        return [(floor(xs[0] / cell), floor(ys[0] / cell), xs, ys)]
    px, py = [xs[moves[0]]], [ys[moves[0]]]
    for i in moves:
        ax, ay, bx, by = xs[i], ys[i], xs[i + 1], ys[i + 1]
        cuts = [0.0]
        for a, b in ((ax, bx), (ay, by)):
            if a != b:
                cuts += [(k * cell - a) / (b - a) for k in range(floor(min(a, b) / cell) + 1, ceil(max(a, b) / cell))]
        cuts.sort()
        inner = [t for before, t in zip(cuts, cuts[1:], strict=False) if SAME_CUT < t < 1 - SAME_CUT and t - before > SAME_CUT]
        px += [ax + (bx - ax) * t for t in inner] + [bx]
        py += [ay + (by - ay) * t for t in inner] + [by]
    at = [(floor((px[i] + px[i + 1]) / 2 / cell), floor((py[i] + py[i + 1]) / 2 / cell)) for i in range(len(px) - 1)]
    starts = [i for i in range(len(at)) if not i or at[i] != at[i - 1]]
    return [(*at[a], px[a : b + 1], py[a : b + 1]) for a, b in zip(starts, [*starts[1:], len(at)], strict=True)]


def grid_pieces(rows: DataFrame, line: str, cell: float) -> DataFrame:
    """(row, n, i, cell_x, cell_y, piece): every row with each part of its line by square cell, in order; rows whose line has no
    point are left out."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, n, number, cx, cy, pieces = [], [], [], [], [], []
            for k, points in enumerate(batch.column(1).to_pylist()):
                found = cut_line([float(p["x"]) for p in points], [float(p["y"]) for p in points], cell) if points else []
                for i, (x, y, xs, ys) in enumerate(found):
                    at.append(k)
                    n.append(len(found))
                    number.append(i)
                    cx.append(x)
                    cy.append(y)
                    pieces.append([{"x": a, "y": b} for a, b in zip(xs, ys, strict=True)])
            place = pa.list_(pa.struct([("x", pa.float64()), ("y", pa.float64())]))
            whole = [batch.column(0).take(pa.array(at, pa.int64())), pa.array(n, pa.int32()), pa.array(number, pa.int32()), pa.array(cx, pa.int64()), pa.array(cy, pa.int64()), pa.array(pieces, place)]
            yield pa.record_batch(whole, names=["row", "n", "i", "cell_x", "cell_y", "piece"])

    held = rows.select(F.struct("*").alias("row"), F.col(line).alias("line"))
    return held.mapInArrow(run, f"row {held.schema['row'].dataType.simpleString()}, n int, i int, cell_x long, cell_y long, piece array<struct<x:double,y:double>>")
