"""Rasters as rows: upper left corner (x0, y0), pixel sizes dx and dy (dy downward), width, height, and bands of values by row."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions.geometry import point
from geoloom.operators.spatial_joins import points_in_polygons


def band_count(bands: Column) -> Column:
    """Number of bands."""
    return F.size(bands)


def hull(rows: DataFrame) -> Column:
    """The outline of a raster as a polygon, from its columns."""
    c = rows.__getitem__
    right, low = c("x0") + c("dx") * c("width"), c("y0") - c("dy") * c("height")
    return F.array(F.array(point(c("x0"), low), point(right, low), point(right, c("y0")), point(c("x0"), c("y0")), point(c("x0"), low)))


def pixels(rasters: DataFrame, key: str = "rid", band: int = 1) -> DataFrame:
    """(key, pixel, x, y, val): centres of the pixels of a band that have a value; `pixel` counts by row from 0."""
    rows = rasters.select(key, "x0", "y0", "dx", "dy", "width", F.posexplode(F.element_at("bands", band)).alias("pixel", "val"))
    x = F.col("x0") + (F.col("pixel") % F.col("width") + 0.5) * F.col("dx")
    y = F.col("y0") - (F.floor(F.col("pixel") / F.col("width")) + 0.5) * F.col("dy")
    return rows.where("val is not null").select(key, "pixel", x.alias("x"), y.alias("y"), "val")


def clipped_pixels(rasters: DataFrame, areas: DataFrame, cell: float, key: str = "rid", band: int = 1) -> DataFrame:
    """Pixels whose centre lies in an area."""
    return points_in_polygons(pixels(rasters, key, band), areas, cell, how="left_semi").select("l.*")
