"""Joins by distance and containment: equality on grid cells first, the exact condition on what meets there."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoloom.functions.cells import grid_around, grid_cell
from geoloom.functions.geometry import in_polygon
from geoloom.functions.overlay import shapes_of
from geoloom.functions.predicates import cover_of
from geoloom.operators.lineage import checkpointed, spread_if_small


def within_distance(left: DataFrame, right: DataFrame, radius: float, left_xy: tuple[str, str] = ("x", "y"), right_xy: tuple[str, str] = ("x", "y"), how: str = "inner", also: Column | None = None, spread: bool = False) -> DataFrame:
    """Pairs of rows at most `radius` apart, in the coordinates' own unit; columns `l` and `r` hold the two rows.

    Cells are `radius` wide, so a partner lies in a point's cell or in one of the eight around it: the right side is
    copied nine times and the left side isn't. A pair meets in one cell only, so nothing repeats. Spark broadcasts a
    small side, and splits a crowded cell in a sort-merge join. `also` is a further condition on l and r. With `spread`
    both sides are dealt by cell however small they are: where pairs cost more than rows, a broadcast would leave them
    all to the few tasks that read the left side.
    """
    lx, ly = (F.col(f"l.{c}") for c in left_xy)
    rx, ry = (F.col(f"r.{c}") for c in right_xy)
    a = left.select(F.struct("*").alias("l")).withColumn("cell", grid_cell(lx, ly, radius))
    b = right.select(F.struct("*").alias("r")).withColumn("cell_r", F.explode(grid_around(rx, ry, radius)))
    near = (F.col("cell") == F.col("cell_r")) & (F.pow(lx - rx, 2) + F.pow(ly - ry, 2) <= radius * radius)
    joined = a.join(b.hint("merge") if spread else b, near if also is None else near & also, how)
    return joined.drop("cell", "cell_r")


def ranked_partners(pairs: DataFrame, key: Column, order: list[Column], most: int) -> DataFrame:
    """The first `most` pairs of each key in a total order, with their `rank`."""
    return pairs.withColumn("rank", F.row_number().over(Window.partitionBy(key).orderBy(*order))).where(F.col("rank") <= most)


def _places(rows: DataFrame, xy: tuple[str, str]) -> DataFrame:
    """The different points (x, y) of rows."""
    return rows.select(*[F.col(c).alias(n) for c, n in zip(xy, "xy", strict=True)]).where("x is not null and y is not null").distinct()


def _at_places(left: DataFrame, found: DataFrame, xy: tuple[str, str], how: str = "inner") -> DataFrame:
    """Left rows as `l` with what was found for their point (place_x, place_y)."""
    here = (F.col(f"l.{xy[0]}") == F.col("place_x")) & (F.col(f"l.{xy[1]}") == F.col("place_y"))
    return left.select(F.struct("*").alias("l")).join(found, here, how).drop("place_x", "place_y")


def _nearest_of_places(left: DataFrame, right: DataFrame, radius: float, right_id: str, most: int, left_xy: tuple[str, str], right_xy: tuple[str, str]) -> DataFrame:
    """(place_x, place_y, r, distance, rank): the `most` nearest right rows of each different point of the left side.

    Rows at one point have the same partners, and of right rows at one point only the first `most` ids can be among
    them: points are compared once, however many rows share them.
    """
    first = ranked_partners(right.select(F.struct("*").alias("r")), F.struct(*[F.col(f"r.{c}") for c in right_xy]), [F.col(f"r.{right_id}")], most)
    first = first.select("r", F.col(f"r.{right_xy[0]}").alias("x"), F.col(f"r.{right_xy[1]}").alias("y"))
    pairs = within_distance(_places(left, left_xy), first, radius)
    d = F.sqrt(F.pow(F.col("l.x") - F.col("r.x"), 2) + F.pow(F.col("l.y") - F.col("r.y"), 2))
    pairs = pairs.select(F.col("l.x").alias("place_x"), F.col("l.y").alias("place_y"), F.col("r.r").alias("r"), d.alias("distance"))
    return ranked_partners(pairs, F.struct("place_x", "place_y"), [F.col("distance"), F.col(f"r.{right_id}")], most)


def nearest(left: DataFrame, right: DataFrame, radius: float, left_id: str, right_id: str, most: int = 1, left_xy: tuple[str, str] = ("x", "y"), right_xy: tuple[str, str] = ("x", "y")) -> DataFrame:
    """(l, r, distance, rank): the `most` nearest right rows within `radius` of each left row; equal distances go by id."""
    return _at_places(left, _nearest_of_places(left, right, radius, right_id, most, left_xy, right_xy), left_xy)


def without_near(left: DataFrame, right: DataFrame, radius: float, left_xy: tuple[str, str] = ("x", "y"), right_xy: tuple[str, str] = ("x", "y"), also: Column | None = None, spread: bool = False) -> DataFrame:
    """Left rows that have no right row within `radius`."""
    return within_distance(left, right, radius, left_xy, right_xy, "left_anti", also, spread).select("l.*")


def count_within(left: DataFrame, right: DataFrame, radius: float, left_id: str, name: str = "n", left_xy: tuple[str, str] = ("x", "y"), right_xy: tuple[str, str] = ("x", "y")) -> DataFrame:
    """Left rows with the number of right rows within `radius`, zero included. Points are compared once, with how many right
    rows stand there."""
    counted = right.select(*[F.col(c).alias(n) for c, n in zip(right_xy, "xy", strict=True)]).groupBy("x", "y").agg(F.count(F.lit(1)).alias("n"))
    pairs = within_distance(_places(left, left_xy), counted, radius)
    counts = pairs.groupBy(F.col("l.x").alias("place_x"), F.col("l.y").alias("place_y")).agg(F.sum("r.n").alias("counted"))
    return _at_places(left, counts, left_xy, "left").select("l.*", F.coalesce("counted", F.lit(0)).cast("long").alias(name))


def covered_cells(polygon: Column, cell: float, most: int = 128) -> Column:
    """Cells struct<level,cx,cy,whole> that cover a polygon: few large ones inside, small ones along its outline."""

    @F.arrow_udf("array<struct<level:int,cx:bigint,cy:bigint,whole:boolean>>")
    def run(shapes: pa.Array) -> pa.Array:
        names = ("level", "cx", "cy", "whole")
        kind = pa.list_(pa.struct([("level", pa.int32()), ("cx", pa.int64()), ("cy", pa.int64()), ("whole", pa.bool_())]))
        return pa.array([[dict(zip(names, c, strict=True)) for c in cover_of(x, cell, most)] if x else [] for x in shapes_of(shapes, closed=True)], kind)

    return run(polygon)


def outline(polygon: Column) -> Column:
    """Two hashes of a polygon, by which equal ones are told."""
    return F.struct(F.xxhash64(F.lit(1), polygon).alias("a"), F.xxhash64(F.lit(2), polygon).alias("b"))


def points_in_polygons(points: DataFrame, polygons: DataFrame, cell: float, polygon: str = "geom", xy: tuple[str, str] = ("x", "y"), how: str = "inner", most: int = 128) -> DataFrame:
    """Pairs (l: point row, r: polygon row) where the polygon holds the point, its boundary included; with `left_semi` each
    point row (l) that a polygon holds, once, with `left_anti` each that none holds.

    Outlines become about `most` cells of several sizes, the smallest `cell` wide, whatever their extent; cells carry no
    outlines. A point meets cells of each size that there is; in a cell that lies wholly inside it isn't compared with the
    outline. Outlines join back by two hashes of them, so that equal ones are covered once.
    """
    x, y = (F.col(f"l.{c}").cast("double") for c in xy)
    held = polygons.where(F.size(polygon) > 0).select(F.struct("*").alias("r")).withColumn("outline", outline(F.col(f"r.{polygon}")))
    shapes = held.select("outline", F.col(f"r.{polygon}").alias("shape")).dropDuplicates(["outline"])
    tasks = max(1, int(points.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    cover = checkpointed(shapes.repartition(tasks, "outline").select("outline", F.explode(covered_cells(F.col("shape"), cell, most)).alias("c")).select("outline", "c.*"))
    levels = sorted(r.level for r in cover.select("level").distinct().collect())
    own = F.array(*[F.struct(F.lit(k).alias("level"), F.floor(x / (cell * 2.0**k)).alias("cx"), F.floor(y / (cell * 2.0**k)).alias("cy")) for k in levels]) if levels else F.array().cast("array<struct<level:int,cx:bigint,cy:bigint>>")
    rows = spread_if_small(points.select(F.struct("*").alias("l"))).withColumn("number", F.monotonically_increasing_id())
    inside = F.col("whole") | in_polygon(F.struct(x.alias("x"), y.alias("y")), F.col(f"r.{polygon}"))
    if how == "inner":
        near = rows.withColumn("at", F.explode(own)).select("l", "at.*").join(cover, ["level", "cx", "cy"]).select("l", "outline", "whole")
        return near.join(held, "outline").where(inside).select("l", "r")
    if how not in ("left_semi", "left_anti"):
        raise ValueError(f"no {how} join of points with polygons")
    # Rows keep their number through one plan, from the scan to the aggregate.
    near = rows.withColumn("at", F.explode_outer(own)).select("l", "number", "at.*").join(cover, ["level", "cx", "cy"], "left").select("l", "number", "outline", "whole")
    met = near.join(held, "outline", "left").select("l", "number", F.coalesce(inside, F.lit(False)).alias("held"))
    met = met.groupBy("number").agg(F.any_value("l").alias("l"), F.bool_or("held").alias("held"))
    return met.where("held" if how == "left_semi" else "not held").select("l")


def idw(points: DataFrame, pixels: DataFrame, radius: float, point_id: str, pixel_id: str, value: str, most: int = 3, name: str = "value", greatest: bool = False) -> DataFrame:
    """(point_id, name): inverse-distance weighted mean of the `most` nearest pixels; a pixel at the point itself decides alone.

    Of several such pixels among the nearest the first id decides, or with `greatest` the greatest value. Points of one
    place have one mean, which is worked out once.
    """
    near = _nearest_of_places(points, pixels, radius, pixel_id, most, ("x", "y"), ("x", "y"))
    v, d = F.col(f"r.{value}"), F.col("distance")
    mean = F.sum(F.when(d > 0, v / d)) / F.sum(F.when(d > 0, 1 / d))
    here = F.max(F.when(d == 0, v)) if greatest else F.min_by(F.when(d == 0, v), F.when(d == 0, F.col("rank")))
    means = near.groupBy("place_x", "place_y").agg(F.coalesce(here, mean).alias("mean"))
    return _at_places(points, means, ("x", "y")).select(F.col(f"l.{point_id}").alias(point_id), F.col("mean").alias(name))
