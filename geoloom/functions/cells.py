"""Cell identifiers: bit fields of hexagon indexes, and a square grid for joins."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Masks and shifts of the short forms at resolutions 3 and 6, and the bits that make a resolution-3 index full again.
SHORT_3_MASK, SHORT_3_SHIFT = 0x000FFFF000000000, 36
SHORT_6_MASK, SHORT_6_SHIFT = 0x000FFFFFFF000000, 24
FULL_3 = 0x0830000FFFFFFFFF


def short_3(index: Column) -> Column:
    """The 16 bits of an index that tell resolution-3 cells apart."""
    return F.shiftright(index.bitwiseAND(F.lit(SHORT_3_MASK)), SHORT_3_SHIFT).cast("int")


def short_6(index: Column) -> Column:
    """The 28 bits of an index that tell resolution-6 cells apart."""
    return F.shiftright(index.bitwiseAND(F.lit(SHORT_6_MASK)), SHORT_6_SHIFT).cast("int")


def full_3(short: Column) -> Column:
    """A resolution-3 index from its short form."""
    return F.shiftleft(short.cast("long").bitwiseAND(F.lit(0xFFFF)), SHORT_3_SHIFT).bitwiseOR(F.lit(FULL_3))


def grid_cell(x: Column, y: Column, size: float) -> Column:
    """struct<cx,cy> of the square cell that holds a point."""
    return F.struct(F.floor(x / size).alias("cx"), F.floor(y / size).alias("cy"))


def grid_around(x: Column, y: Column, size: float) -> Column:
    """The cell of a point and the eight around it."""
    near = F.sequence(F.lit(-1), F.lit(1))
    return F.flatten(F.transform(near, lambda i: F.transform(near, lambda j: F.struct((F.floor(x / size) + i).alias("cx"), (F.floor(y / size) + j).alias("cy")))))


def grid_cover(box: Column, size: float) -> Column:
    """All cells that an envelope touches."""
    xs = F.sequence(F.floor(box["xmin"] / size), F.floor(box["xmax"] / size))
    ys = F.sequence(F.floor(box["ymin"] / size), F.floor(box["ymax"] / size))
    return F.flatten(F.transform(xs, lambda cx: F.transform(ys, lambda cy: F.struct(cx.alias("cx"), cy.alias("cy")))))


def hilbert_key(x: Column, y: Column, box: Mapping[str, float], bits: int = 16) -> Column:
    """Place of a point along a Hilbert curve through a box (xmin, ymin, xmax, ymax) of 2**bits squares a side: points with
    near keys are near each other. Points outside the box count as the nearest ones inside; null for a null coordinate."""
    n = 1 << bits
    grid = lambda v, low, high: F.greatest(F.lit(0), F.least(F.lit(n - 1), F.floor((v - low) / ((high - low) or 1.0) * n))).cast("long")
    start = F.struct(grid(x, box["xmin"], box["xmax"]).alias("x"), grid(y, box["ymin"], box["ymax"]).alias("y"), F.lit(0).cast("long").alias("d"))

    def step(at: Column, s: Column) -> Column:
        rx, ry = F.when(at["x"].bitwiseAND(s) > 0, 1).otherwise(0), F.when(at["y"].bitwiseAND(s) > 0, 1).otherwise(0)
        flip = lambda v: F.when((ry == 0) & (rx == 1), n - 1 - v).otherwise(v)
        turned = lambda v, w: F.when(ry == 0, flip(w)).otherwise(v)
        return F.struct(turned(at["x"], at["y"]).alias("x"), turned(at["y"], at["x"]).alias("y"), (at["d"] + s * s * (rx * 3).bitwiseXOR(ry)).cast("long").alias("d"))

    sides = F.array(*[F.lit(1 << b).cast("long") for b in reversed(range(bits))])
    return F.when(x.isNotNull() & y.isNotNull(), F.aggregate(sides, start, step)["d"])
