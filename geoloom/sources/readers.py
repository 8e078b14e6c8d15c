"""Sources: GTFS text files, tagged map objects, place tables, relational tables, boundaries."""

from __future__ import annotations

import json
import re
from collections.abc import Mapping, Sequence
from xml.etree import ElementTree

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.functions import cells

#: Tables of a feed with their columns and types, as the public format defines them.
GTFS = {
    "agency": "agency_id string, agency_name string, agency_url string, agency_timezone string, agency_lang string",
    "stops": "stop_id string, stop_code string, stop_name string, stop_lat double, stop_lon double, location_type string, parent_station string, wheelchair_boarding string, platform_code string",
    "routes": "route_id string, agency_id string, route_short_name string, route_long_name string, route_type int",
    "trips": "trip_id string, route_id string, service_id string, trip_headsign string, direction_id int, shape_id string",
    "stop_times": "trip_id string, arrival_time string, departure_time string, stop_id string, stop_sequence int, pickup_type string, drop_off_type string, shape_dist_traveled double",
    "calendar": "service_id string, monday string, tuesday string, wednesday string, thursday string, friday string, saturday string, sunday string, start_date string, end_date string",
    "calendar_dates": "service_id string, date string, exception_type int",
    "shapes": "shape_id string, shape_pt_lat double, shape_pt_lon double, shape_pt_sequence int, shape_dist_traveled double",
}
#: Overture themes with their types.
THEMES = {
    "addresses": ("address",),
    "base": ("infrastructure", "land", "land_cover", "land_use", "water", "bathymetry"),
    "buildings": ("building", "building_part"),
    "divisions": ("division", "division_area", "division_boundary"),
    "places": ("place",),
    "transportation": ("connector", "segment"),
}


def typed(rows: DataFrame, schema: T.StructType | str) -> DataFrame:
    """Rows cast to a schema: columns that are missing become null, others are left out, what can't be cast is null."""
    wanted = T.StructType.fromDDL(schema) if isinstance(schema, str) else schema
    return rows.select(*[(F.nullif(F.trim(F.col(f.name).cast("string")), F.lit("")).try_cast(f.dataType.simpleString()) if f.name in rows.columns else F.lit(None).cast(f.dataType)).alias(f.name) for f in wanted])


def read_csv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """A CSV file with a header, reconciled with a schema; broken UTF-8 and byte-order marks are dropped."""
    rows = spark.read.option("header", True).option("quote", '"').option("escape", '"').option("mode", "PERMISSIVE").csv(path)
    rows = rows.toDF(*[c.strip().lstrip("﻿").lower() for c in rows.columns])
    return typed(rows.select(*[F.replace(F.col(c), F.lit("�"), F.lit("")).alias(c) for c in rows.columns]), schema)


def seconds(time: Column) -> Column:
    """A feed's time, which may pass 24 hours, as seconds after midnight."""
    parts = F.transform(F.split(F.trim(time), ":"), lambda x: x.try_cast("int"))
    return F.when(F.size(parts) == 3, parts[0] * 3600 + parts[1] * 60 + parts[2])


def read_gtfs(spark: SparkSession, folder: str, cell: float = 0.1, tables: Sequence[str] = tuple(GTFS)) -> dict[str, DataFrame]:
    """A feed's tables by name, typed; stops and shapes have a grid cell, stop times that of their stop. A missing file raises."""
    feed = {t: read_csv(spark, f"{folder.rstrip('/')}/{t}.txt", GTFS[t]) for t in tables}
    at = lambda x, y: cells.grid_cell(F.col(x), F.col(y), cell)
    if "stops" in feed:
        feed["stops"] = feed["stops"].withColumn("cell", at("stop_lon", "stop_lat"))
    if "shapes" in feed:
        feed["shapes"] = feed["shapes"].withColumn("cell", at("shape_pt_lon", "shape_pt_lat"))
    if "stop_times" in feed:
        times = feed["stop_times"].withColumns({"arrival_time": seconds(F.col("arrival_time")), "departure_time": seconds(F.col("departure_time"))})
        feed["stop_times"] = times.join(feed["stops"].select("stop_id", "cell"), "stop_id", "left") if "stops" in feed else times
    for name, dates in (("calendar", ("start_date", "end_date")), ("calendar_dates", ("date",))):
        if name in feed:
            feed[name] = feed[name].withColumns({d: F.to_date(d, "yyyyMMdd") for d in dates})
    return feed


def feed_problems(feed: Mapping[str, DataFrame]) -> dict[str, DataFrame]:
    """Repeated keys and references to nothing, by the name of the rule."""
    from geoloom.operators.relational import duplicate_keys, orphans

    keys = {"stops": ["stop_id"], "routes": ["route_id"], "trips": ["trip_id"], "stop_times": ["trip_id", "stop_sequence"], "calendar": ["service_id"]}
    found = {f"{t}: repeated key": duplicate_keys(feed[t], k) for t, k in keys.items() if t in feed}
    links = (("trips", "route_id", "routes", "route_id"), ("stop_times", "trip_id", "trips", "trip_id"), ("stop_times", "stop_id", "stops", "stop_id"), ("stops", "parent_station", "stops", "stop_id"))
    return found | {f"{t}.{k}: no such {p}": orphans(feed[t], feed[p], k, pk) for t, k, p, pk in links if t in feed and p in feed}


def tagged(objects: DataFrame, filters: Mapping[str, Sequence[str] | bool]) -> DataFrame:
    """Objects that have one of the tags (map<string,string>) with a listed value, True being any value."""
    hit = F.lit(False)
    for key, values in filters.items():
        own = F.col("tags")[key]
        hit = hit | F.coalesce(own.isNotNull() if values is True else own.isin(list(values)), F.lit(False))
    return objects.where(hit)


def promoted(objects: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Tags as columns of their own."""
    return objects.select("*", *[F.col("tags")[k].alias(k) for k in keys])


def read_theme(spark: SparkSession, root: str, theme: str, kind: str, box: Mapping[str, float] | None = None) -> DataFrame:
    """One type of a theme in a theme=/type= layout; a box keeps rows strictly inside, pruning row groups by their bounds."""
    if kind not in THEMES.get(theme, ()):
        raise ValueError(f"theme {theme!r} has no type {kind!r}; known: {THEMES}")
    rows = spark.read.parquet(f"{root.rstrip('/')}/theme={theme}/type={kind}")
    if box:
        rows = rows.where((F.col("bbox.xmin") > box["xmin"]) & (F.col("bbox.ymin") > box["ymin"]) & (F.col("bbox.xmax") < box["xmax"]) & (F.col("bbox.ymax") < box["ymax"])).drop("bbox")
    return rows


def flattened(rows: DataFrame) -> DataFrame:
    """Structs, arrays and maps as JSON texts."""
    return rows.select(*[F.to_json(F.col(f.name)).alias(f.name) if isinstance(f.dataType, (T.StructType, T.ArrayType, T.MapType)) else F.col(f.name) for f in rows.schema])


def wkb_point(geometry: Column) -> Column:
    """The point of a little-endian WKB point as struct<x,y>; null for other geometries."""
    code = F.hex(geometry)

    def coordinate(at: int) -> Column:
        turned = F.concat(*[F.substring(code, at + 2 * i, 2) for i in range(7, -1, -1)])
        # Sign, exponent and fraction of an IEEE double, from its 16 hexadecimal digits.
        high = F.conv(F.substring(turned, 1, 3), 16, 10).cast("int")
        fraction = F.conv(F.substring(turned, 4, 13), 16, 10).cast("double") / float(2**52)
        sign = F.when(high >= 2048, -1.0).otherwise(1.0)
        exponent = high % 2048
        return sign * F.when(exponent == 0, fraction * F.lit(2.0**-1022)).otherwise((1 + fraction) * F.pow(F.lit(2.0), exponent - 1023))

    return F.when(F.substring(code, 1, 10) == "0101000000", F.struct(coordinate(11).alias("x"), coordinate(27).alias("y")))


def read_jdbc(spark: SparkSession, url: str, *queries: str, **options: str) -> DataFrame:
    """Rows of one or more queries of a relational store, one after the other."""
    parts = [spark.read.format("jdbc").options(url=url, query=q, **options).load() for q in queries]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out


def parse_poly(text: str) -> list[list[list[tuple[float, float]]]]:
    """Polygons of a boundary file: sections up to END, those whose name starts with ! are holes of the polygon before."""
    polygons: list[list[list[tuple[float, float]]]] = []
    ring: list[tuple[float, float]] | None = None
    hole = False
    for line in text.splitlines()[1:]:
        line = line.strip()
        if line == "END":
            if ring is not None:
                ring = ring if ring and ring[0] == ring[-1] else [*ring, *ring[:1]]
                if hole and polygons:
                    polygons[-1].append(ring)
                else:
                    polygons.append([ring])
            ring = None
        elif ring is None:
            if line:
                ring, hole = [], line.startswith("!")
        elif line:
            x, y = line.split()[:2]
            ring.append((float(x), float(y)))
    return polygons


def write_poly(name: str, polygons: Sequence[Sequence[Sequence[tuple[float, float]]]]) -> str:
    """Text of a boundary file."""
    lines = [name]
    for i, polygon in enumerate(polygons, 1):
        for j, ring in enumerate(polygon):
            lines.append(f"{'!' if j else ''}{i if not j else f'{i}_{j}'}")
            lines += [f"   {x:.7E}   {y:.7E}" for x, y in ring]
            lines.append("END")
    return "\n".join([*lines, "END", ""])


def geojson_polygons(text: str) -> list[list[list[tuple[float, float]]]]:
    """Polygons of a GeoJSON geometry, feature or collection."""
    def walk(x: dict) -> list:
        kind = x["type"]
        if kind == "FeatureCollection":
            return [p for f in x["features"] for p in walk(f)]
        if kind == "Feature":
            return walk(x["geometry"])
        rings = {"Polygon": [x.get("coordinates")], "MultiPolygon": x.get("coordinates")}.get(kind, [])
        return [[[(float(a), float(b)) for a, b, *_ in ring] for ring in p] for p in rings]

    return walk(json.loads(text))


def envelope_of(rows: DataFrame, x: str = "x", y: str = "y") -> dict[str, float]:
    """Bounds of all points."""
    r = rows.agg(F.min(x).alias("xmin"), F.min(y).alias("ymin"), F.max(x).alias("xmax"), F.max(y).alias("ymax")).first()
    return r.asDict()


def file_timestamp(info: str) -> str | None:
    """The timestamp=... of a description of a map extract; None without one."""
    found = re.search(r"timestamp=(\d{4}-\d{2}-\d{2}T\d{2}:\d{2}:\d{2}Z)", info)
    return found.group(1) if found else None


def code_list(text: str) -> dict[str, str]:
    """Code to meaning from an XML dictionary whose entries hold definitions with two names each."""
    gml = "{http://www.opengis.net/gml}"
    names = ([n.text for n in definition.findall(f"{gml}name")] for definition in ElementTree.fromstring(text).findall(f"{gml}dictionaryEntry/*"))
    return {found[0]: found[1] for found in names if len(found) > 1}


def links_left(links: Sequence[str], others: Sequence[Sequence[str]]) -> list[str]:
    """Links of a region in order, without those that the settings of other regions cover."""
    covered = {x for other in others for x in other}
    return [x for x in links if x not in covered]
