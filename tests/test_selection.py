"""Selections of tables, meeting geometries, pieces of polygons, and small readers, by values worked out by hand."""

import pytest
from pyspark.sql import functions as F

from geoloom.functions import geometry as geo
from geoloom.operators import buildings, networks, selection
from geoloom.sources import readers

SHAPES = "id long, geom array<array<struct<x:double,y:double>>>"
LINES = "id long, source long, target long, geom array<struct<x:double,y:double>>"


def square(x, y, side):
    return [[(x, y), (x + side, y), (x + side, y + side), (x, y + side), (x, y)]]


def test_lines_meet_areas(spark):
    hole = [*square(0.0, 0.0, 10.0), *square(2.0, 2.0, 6.0)]
    areas = spark.createDataFrame([(1, hole), (2, square(100.0, 0.0, 5.0))], SHAPES)
    lines = [
        (1, 1, 2, [(-1.0, 5.0), (11.0, 5.0)]),  # through both rings
        (2, 3, 4, [(3.0, 3.0), (7.0, 7.0)]),  # inside the hole
        (3, 5, 6, [(10.0, 10.0), (12.0, 12.0)]),  # touches a corner
        (4, 7, 8, [(-1.0, 11.0), (11.0, 11.1)]),  # outside
        (5, 9, 10, [(1.0, 1.0), (1.0, 1.5)]),  # inside
        (6, 11, 12, [(9.0, 1.0), (101.0, 1.0)]),  # meets both areas
        (7, 13, 14, [(10.0, 2.0), (10.0, 3.0)]),  # along an edge
    ]
    edges = spark.createDataFrame(lines, LINES)
    taken = selection.selected("edge", edges, areas, 4.0)
    assert sorted(r.id for r in taken.collect()) == [1, 3, 5, 6, 7]
    nodes = spark.createDataFrame([(i,) for i in range(16)], "id long")
    assert sorted(r.id for r in selection.selected("node", nodes, areas, 4.0, edges=edges).collect()) == [1, 2, 5, 6, 9, 10, 11, 12, 13, 14]
    assert selection.selected("edge", edges, areas.limit(0), 4.0).count() == 0


def test_buildings_go_by_their_centroid_too(spark):
    areas = spark.createDataFrame([(1, square(0.0, 0.0, 10.0))], SHAPES)
    rows = spark.createDataFrame([(1, square(8.0, 8.0, 3.0)), (2, square(9.0, 9.0, 3.0)), (3, square(-5.0, -5.0, 30.0)), (4, square(20.0, 20.0, 1.0)), (5, None), (6, square(-5.0, -5.0, 34.0))], SHAPES)
    assert sorted(r.id for r in selection.selected("aoi", rows, areas, 5.0).collect()) == [1, 2, 3, 6]
    # The third has its centroid on a corner of the area, which counts; the last one beyond it.
    assert sorted(r.id for r in selection.selected("building", rows, areas, 5.0).collect()) == [1, 3]


def test_areas_points_and_unknown_tables(spark):
    areas = spark.createDataFrame([(1, square(0.0, 0.0, 10.0)), (2, square(5.0, 5.0, 10.0))], SHAPES)
    points = spark.createDataFrame([(1, 6.0, 6.0), (2, 6.0, 6.0), (3, 16.0, 6.0)], "id long, x double, y double")
    assert sorted(r.id for r in selection.selected("poi", points, areas, 10.0).collect()) == [1, 2]
    subs = spark.createDataFrame([(7, 1), (8, 3), (9, None)], "id long, study_area_id long")
    assert [r.id for r in selection.selected("sub_study_area", subs, areas, 10.0).collect()] == [7]
    for name in ("node", "road"):
        with pytest.raises(ValueError, match="no selection"):
            selection.selected(name, points, areas, 10.0)


def test_curated_kinds(spark):
    row = spark.range(1).select(*[F.lit(c).alias(c) for c in {*selection.COMMON, *(c for own in selection.OWN.values() for c in own)}], F.lit('{"a":"b"}').alias("tags"), F.lit("p").alias("geom"))
    assert selection.curated(row, "childcare").columns == [*selection.OWN["childcare"], *selection.COMMON, "geom"]
    assert selection.curated(row, "school").first().tags == {"a": "b"}
    assert selection.curated(row, "anything").first().other_categories == ["other_categories"]


def test_pieces_cover_a_concave_ring(spark):
    comb = [(0.0, 0.0), (24.0, 0.0), *[(24.0 - i, 5.0 if i % 2 == 0 else 1.0) for i in range(25)], (0.0, 0.0)]
    rows = spark.createDataFrame([("comb", [comb]), ("flat", [[(0.0, 0.0), (1.0, 0.0), (0.0, 0.0)]]), ("none", None)], "id string, geom array<array<struct<x:double,y:double>>>")
    pieces = buildings.subdivided(rows, "id", most=8).withColumn("size", F.abs(geo.ring_area(F.col("geom")[0]))).collect()
    assert {p.id for p in pieces} == {"comb"} and all(len(p.geom[0]) <= 9 for p in pieces)
    assert sum(p.size for p in pieces) == pytest.approx(24 * 3.0)


def test_profile_without_pixels_is_null(spark):
    segments = spark.createDataFrame([(1, [(0.0, 0.0), (1.0, 0.0)], 25.0), (2, [(50.0, 0.0), (51.0, 0.0)], 25.0)], "id long, geom array<struct<x:double,y:double>>, length_m double")
    pixels = spark.createDataFrame([(1, 0.0, 0.0, 5.0), (2, 1.0, 0.0, 5.0)], "pixel long, x double, y double, val double")
    rows = {r.id: r for r in networks.slope_profile(segments, pixels, 2.0).collect()}
    assert rows[1].impedance_slope == pytest.approx(0.0) and rows[1].slope_average == 0
    assert rows[2].impedance_slope is None and rows[2].slope_average is None


def test_profile_by_hand(spark):
    segments = spark.createDataFrame([(1, [(0.0, 0.0), (25.0, 0.0)], 25.0)], "id long, geom array<struct<x:double,y:double>>, length_m double")
    pixels = spark.createDataFrame([(1, 0.0, 0.0, 0.0), (2, 10.0, 0.0, 1.0), (3, 20.0, 0.0, 2.0), (4, 25.0, 0.0, 2.0)], "pixel long, x double, y double, val double")
    r = networks.slope_profile(segments, pixels, 1.0).first()
    # Two sections of ten with 10 percent, which is beyond the limit, and a level one of five.
    assert r.impedance_slope == pytest.approx(0.4 * 3 + 0.4 * 3 + 0.2 - 1)
    assert r.impedance_slope_reverse == pytest.approx(0.4 * 0.65 + 0.4 * 0.65 + 0.2 - 1)
    assert r.slope_average == 7


def test_small_readers():
    assert readers.file_timestamp("a\ntimestamp=2024-01-02T03:04:05Z\nb") == "2024-01-02T03:04:05Z"
    assert readers.file_timestamp("no date") is None
    entry = "<g:dictionaryEntry><g:Definition><g:name>{}</g:name><g:name>{}</g:name></g:Definition></g:dictionaryEntry>"
    xml = '<g:Dictionary xmlns:g="http://www.opengis.net/gml">' + entry.format("31001_1000", "house") + entry.format("31001_2000", "barn") + "</g:Dictionary>"
    assert readers.code_list(xml) == {"31001_1000": "house", "31001_2000": "barn"}
    assert readers.links_left(["a", "b", "c"], [["b"], ["x"]]) == ["a", "c"]


def test_meeting_equals_the_geometry_library(spark):
    """Concave rows and areas with holes; pairs are dealt in a given number of partitions, which isn't made less."""
    import math
    import random

    rng = random.Random(8)
    ring = lambda x, y, low, high, n: [(x + r * math.cos(2 * math.pi * i / n), y + r * math.sin(2 * math.pi * i / n)) for i in range(n) for r in (rng.uniform(low, high),)]
    close = lambda r: [*r, r[0]]
    areas = [(k, [close(ring(x, y, 2, 4, 14)), close(ring(x, y, 0.8, 1.5, 9))]) for k in range(12) for x, y in ((rng.uniform(0, 20), rng.uniform(0, 20)),)]
    shapes = [(k, [close(ring(rng.uniform(0, 20), rng.uniform(0, 20), 0.2, 0.6, 8))]) for k in range(300)]
    kind = "id int, geom array<array<struct<x:double,y:double>>>"
    rows, study = spark.createDataFrame([*shapes, (900, None), (901, [])], kind), spark.createDataFrame([*areas, (99, None)], kind)
    out = selection.meeting(rows, study, "id", 3.0)
    plan = out._jdf.queryExecution().toString()
    assert "REPARTITION_BY_NUM" in plan
    read = spark._jvm.org.locationtech.jts.io.WKTReader().read
    text = lambda g: read("POLYGON(" + ",".join("(" + ",".join(f"{x!r} {y!r}" for x, y in r) + ")" for r in g) + ")")
    known = [text(g) for _, g in areas]
    wanted = {}
    for k, g in shapes:
        own = text(g)
        met = [a for a in known if a.intersects(own)]
        if met:
            wanted[k] = any(a.contains(own.getCentroid()) for a in met)
    assert {r.row_id: r.held for r in out.collect()} == wanted
    lines = spark.createDataFrame([(k, g[0][:5]) for k, g in shapes], "id int, geom array<struct<x:double,y:double>>")
    met = {k for k, g in shapes for own in (read("LINESTRING(" + ",".join(f"{x!r} {y!r}" for x, y in g[0][:5]) + ")"),) if any(a.intersects(own) for a in known)}
    assert {r.id for r in selection.selected("edge", lines, study, 3.0).collect()} == met
