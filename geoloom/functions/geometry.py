"""Geometry as expressions: points are struct<x,y>, lines arrays of points, polygons arrays of closed rings, outer first."""

from __future__ import annotations

import math

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Radius of the web-Mercator sphere, and the mean radius of the Earth, in metres.
MERCATOR_RADIUS, EARTH_RADIUS = 6378137.0, 6371008.8


def point(x: Column, y: Column) -> Column:
    """A point."""
    return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))


def mercator_x(lon: Column) -> Column:
    """Web-Mercator x of a longitude in degrees."""
    return MERCATOR_RADIUS * F.radians(lon)


def mercator_y(lat: Column) -> Column:
    """Web-Mercator y of a latitude in degrees."""
    return MERCATOR_RADIUS * F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2))


def to_mercator(p: Column) -> Column:
    """Degrees to web-Mercator metres."""
    return point(mercator_x(p["x"]), mercator_y(p["y"]))


def from_mercator(p: Column) -> Column:
    """Web-Mercator metres to degrees."""
    lat = 2 * F.atan(F.exp(p["y"] / MERCATOR_RADIUS)) - F.lit(math.pi / 2)
    return point(F.degrees(p["x"] / MERCATOR_RADIUS), F.degrees(lat))


def distance(a: Column, b: Column) -> Column:
    """Planar distance of two points."""
    return F.hypot(a["x"] - b["x"], a["y"] - b["y"])


def metres(a: Column, b: Column) -> Column:
    """Great-circle distance of two points in degrees (sphere: up to 0.5 % off the spheroid)."""
    dx, dy = F.radians(b["x"] - a["x"]) / 2, F.radians(b["y"] - a["y"]) / 2
    h = F.pow(F.sin(dy), 2) + F.cos(F.radians(a["y"])) * F.cos(F.radians(b["y"])) * F.pow(F.sin(dx), 2)
    return 2 * EARTH_RADIUS * F.asin(F.least(F.lit(1.0), F.sqrt(h)))


def legs(line: Column) -> Column:
    """Consecutive point pairs of a line as struct<a,b>; none for fewer than two points."""
    ahead = F.slice(line, 2, F.greatest(F.size(line) - 1, F.lit(0)))
    return F.filter(F.zip_with(line, ahead, lambda a, b: F.struct(a.alias("a"), b.alias("b"))), lambda s: s["b"].isNotNull())


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda t, x: t + x)


def length(line: Column) -> Column:
    """Planar length of a line."""
    return _total(F.transform(legs(line), lambda s: distance(s["a"], s["b"])))


def length_metres(line: Column) -> Column:
    """Length of a line in degrees, in metres on the sphere."""
    return _total(F.transform(legs(line), lambda s: metres(s["a"], s["b"])))


def ring_area(ring: Column) -> Column:
    """Planar area of a closed ring, whatever its direction."""
    return F.abs(_total(F.transform(legs(ring), lambda s: s["a"]["x"] * s["b"]["y"] - s["b"]["x"] * s["a"]["y"]))) / 2


def area(polygon: Column) -> Column:
    """Planar area of a polygon without its holes."""
    holes = F.slice(polygon, 2, F.greatest(F.size(polygon) - 1, F.lit(0)))
    return ring_area(F.get(polygon, F.lit(0))) - _total(F.transform(holes, ring_area))


def ring_area_metres(ring: Column) -> Column:
    """Area of a closed ring in degrees, in square metres on the sphere."""
    each = F.transform(legs(ring), lambda s: F.radians(s["b"]["x"] - s["a"]["x"]) * (2 + F.sin(F.radians(s["a"]["y"])) + F.sin(F.radians(s["b"]["y"]))))
    return F.abs(_total(each)) * (EARTH_RADIUS**2 / 2)


def centroid(ring: Column) -> Column:
    """Area-weighted centroid of a closed ring; the mean of its points if it has no area."""
    cross = lambda s: s["a"]["x"] * s["b"]["y"] - s["b"]["x"] * s["a"]["y"]
    twice = _total(F.transform(legs(ring), cross))
    cx = _total(F.transform(legs(ring), lambda s: (s["a"]["x"] + s["b"]["x"]) * cross(s)))
    cy = _total(F.transform(legs(ring), lambda s: (s["a"]["y"] + s["b"]["y"]) * cross(s)))
    n = F.size(ring)
    flat = point(_total(F.transform(ring, lambda p: p["x"])) / n, _total(F.transform(ring, lambda p: p["y"])) / n)
    return F.when(F.abs(twice) > 0, point(cx / (3 * twice), cy / (3 * twice))).otherwise(flat)


def envelope(line: Column) -> Column:
    """struct<xmin,ymin,xmax,ymax> of an array of points."""
    xs, ys = F.transform(line, lambda p: p["x"]), F.transform(line, lambda p: p["y"])
    return F.struct(F.array_min(xs).alias("xmin"), F.array_min(ys).alias("ymin"), F.array_max(xs).alias("xmax"), F.array_max(ys).alias("ymax"))


def envelopes_meet(a: Column, b: Column) -> Column:
    """Whether two envelopes share a point."""
    return (a["xmin"] <= b["xmax"]) & (b["xmin"] <= a["xmax"]) & (a["ymin"] <= b["ymax"]) & (b["ymin"] <= a["ymax"])


def _on_leg(p: Column, s: Column) -> Column:
    a, b = s["a"], s["b"]
    cross = (b["x"] - a["x"]) * (p["y"] - a["y"]) - (b["y"] - a["y"]) * (p["x"] - a["x"])
    return (cross == 0) & p["x"].between(F.least(a["x"], b["x"]), F.greatest(a["x"], b["x"])) & p["y"].between(F.least(a["y"], b["y"]), F.greatest(a["y"], b["y"]))


def _crossings(p: Column, ring: Column) -> Column:
    def crossed(s: Column) -> Column:
        a, b = s["a"], s["b"]
        straddles = (a["y"] > p["y"]) != (b["y"] > p["y"])
        at = (b["x"] - a["x"]) * F.try_divide(p["y"] - a["y"], b["y"] - a["y"]) + a["x"]
        return straddles & (p["x"] < at)

    return F.size(F.filter(legs(ring), crossed))


def in_polygon(p: Column, polygon: Column) -> Column:
    """Whether a point lies in a polygon by ray casting over all rings; its boundary counts as inside."""
    edge = F.exists(polygon, lambda ring: F.exists(legs(ring), lambda s: _on_leg(p, s)))
    return edge | (F.aggregate(polygon, F.lit(0), lambda t, ring: t + _crossings(p, ring)) % 2 == 1)


def moved(p: Column, far: Column, azimuth: Column) -> Column:
    """A point moved by a planar distance in the direction of an azimuth in radians, clockwise from north."""
    return point(p["x"] + far * F.sin(azimuth), p["y"] + far * F.cos(azimuth))


def interpolated(line: Column, share: Column) -> Column:
    """The point at a share in [0, 1] of a line's planar length."""
    parts = legs(line)
    start = F.struct(F.lit(0.0).alias("done"), F.lit(None).cast("struct<x:double,y:double>").alias("p"))
    goal = share * length(line)

    def step(t: Column, s: Column) -> Column:
        own = distance(s["a"], s["b"])
        ratio = F.coalesce(F.try_divide(goal - t["done"], own), F.lit(0.0))
        here = point(s["a"]["x"] + (s["b"]["x"] - s["a"]["x"]) * ratio, s["a"]["y"] + (s["b"]["y"] - s["a"]["y"]) * ratio)
        return F.struct((t["done"] + own).alias("done"), F.when(t["p"].isNull() & (t["done"] + own >= goal), here).otherwise(t["p"]).alias("p"))

    return F.coalesce(F.aggregate(parts, start, step)["p"], F.element_at(line, -1))


def wkt_point(p: Column) -> Column:
    """Well-known text of a point."""
    return F.concat(F.lit("POINT("), p["x"].cast("string"), F.lit(" "), p["y"].cast("string"), F.lit(")"))


def wkt_line(line: Column) -> Column:
    """Well-known text of a line."""
    return F.concat(F.lit("LINESTRING("), F.array_join(F.transform(line, lambda p: F.concat(p["x"].cast("string"), F.lit(" "), p["y"].cast("string"))), ","), F.lit(")"))


def geojson_point(p: Column) -> Column:
    """GeoJSON of a point."""
    return F.to_json(F.struct(F.lit("Point").alias("type"), F.array(p["x"], p["y"]).alias("coordinates")))


def parsed_wkt_line(text: Column) -> Column:
    """Points of a LINESTRING or POINT in well-known text; null if it is neither."""
    body = F.regexp_extract(F.upper(text), r"^\s*(?:LINESTRING|POINT)\s*\(([^()]*)\)\s*$", 1)
    points = F.transform(F.split(body, ","), lambda s: point(F.get(F.split(F.trim(s), r"\s+"), F.lit(0)).try_cast("double"), F.get(F.split(F.trim(s), r"\s+"), F.lit(1)).try_cast("double")))
    return F.when(body != "", points)
