"""Functions and operators on values worked out by hand."""

import math
import struct

import pytest
from pyspark.sql import functions as F

from geoloom.functions import cells, collections as fc, geometry as geo, lines, text as ft
from geoloom.operators import buildings, networks, poi, relational as rel, spatial_joins as sj, transit
from geoloom.sources import readers, writers


def value(spark, column):
    return spark.range(1).select(column.alias("v")).first().v


def test_trigrams(spark):
    assert value(spark, ft.similarity(F.lit("word"), F.lit("two words"))) == pytest.approx(4 / 11)
    assert value(spark, ft.similarity(F.lit(""), F.lit("x"))) == 0
    assert value(spark, ft.similarity(F.lit(None).cast("string"), F.lit("x"))) == 0


def test_sequences_alike():
    assert ft.sequence_similar("edekka", "edeka", 0.9) and ft.sequence_similar("lidll", "lidl", 0.88)
    assert not ft.sequence_similar("aldo", "aldi", 0.8) and ft.sequence_similar("rewe city", "rewe", 0.99)
    assert not ft.sequence_similar(None, "x", 0.1)


def test_house_numbers(spark):
    assert value(spark, F.struct(ft.street(F.lit("Main St 12a")), ft.house_number(F.lit("Main St 12a")))) == ("Main St ", "12a")
    assert value(spark, F.struct(ft.street(F.lit("Main St")), ft.house_number(F.lit("Main St")))) == ("Main St", "")
    assert value(spark, ft.street(F.lit("12 Main"))) is None


def test_casts(spark):
    assert value(spark, F.struct(ft.to_int(F.lit("12.5")), ft.to_int(F.lit("abc")), ft.to_int(F.lit("13.5")))) == (12, None, 14)
    assert value(spark, F.struct(ft.guarded_number(F.lit("2.5")), ft.guarded_number(F.lit("")), ft.guarded_number(F.lit("2m")))) == (2.5, None, None)
    assert value(spark, F.struct(ft.storeys(F.lit(10.0)), ft.storeys(F.lit(2.0)))) == (2, 1)
    assert value(spark, F.struct(ft.valid_email(F.lit("a@b.com")), ft.valid_email(F.lit("a@b")))) == ("a@b.com", None)
    assert value(spark, F.struct(ft.valid_url(F.lit("https://x.org/a")), ft.valid_url(F.lit("x.org")))) == ("https://x.org/a", None)


def test_arrays_and_tags(spark):
    ids = F.array(F.lit(33), F.lit(12), F.lit(88))
    assert value(spark, fc.id_of_largest(F.array(F.lit(300), F.lit(10), F.lit(30000)), ids)) == 88
    assert value(spark, fc.without_adjacent_repeats(F.array(F.lit(1), F.lit(1), F.lit(2), F.lit(1)))) == [1, 2, 1]
    tags = fc.merged_tags(F.create_map(F.lit("a"), F.lit("1"), F.lit("b"), F.lit("2")), F.lit(None).cast("map<string,string>"), F.create_map(F.lit("a"), F.lit("3")))
    assert value(spark, tags) == {"a": "3", "b": "2"}
    assert value(spark, fc.first_of_json_array(F.lit('["x","y"]'))) == "x" and value(spark, fc.first_of_json_array(F.lit("[]"))) is None
    assert value(spark, fc.json_ints(F.lit("[1,2]"))) == [1, 2]


def test_cells(spark):
    assert value(spark, cells.short_3(F.lit(590112357393367039))) == 2048
    assert value(spark, cells.full_3(F.lit(2048))) == 590112357393367039
    assert len(value(spark, cells.grid_around(F.lit(1.5), F.lit(2.5), 1.0))) == 9


def square(x, y, size):
    return [[(x, y), (x + size, y), (x + size, y + size), (x, y + size), (x, y)]]


def test_geometry(spark):
    p = value(spark, geo.to_mercator(geo.point(F.lit(11.333), F.lit(48.123))))
    assert p.x == pytest.approx(1261583.78916, abs=1e-4) and p.y == pytest.approx(6127342.10068, abs=1e-4)
    back = value(spark, geo.from_mercator(geo.to_mercator(geo.point(F.lit(11.333), F.lit(48.123)))))
    assert (back.x, back.y) == (pytest.approx(11.333), pytest.approx(48.123))
    kind = "array<array<struct<x:double,y:double>>>"
    df = spark.createDataFrame([(square(0.0, 0.0, 2.0),)], f"g {kind}")
    row = df.select(geo.area(F.col("g")), geo.centroid(F.col("g")[0]), geo.length(F.col("g")[0]), geo.in_polygon(geo.point(F.lit(1), F.lit(1)), F.col("g")), geo.in_polygon(geo.point(F.lit(2), F.lit(1)), F.col("g")), geo.in_polygon(geo.point(F.lit(3), F.lit(1)), F.col("g")), geo.interpolated(F.col("g")[0], F.lit(0.375))).first()
    assert row[0] == 4 and tuple(row[1]) == (1, 1) and row[2] == 8 and row[3] and row[4] and not row[5] and tuple(row[6]) == (2, 1)
    a = value(spark, geo.metres(geo.point(F.lit(0), F.lit(0)), geo.point(F.lit(0), F.lit(90))))
    assert a == pytest.approx(math.pi / 2 * geo.EARTH_RADIUS)
    assert [tuple(x) for x in value(spark, geo.parsed_wkt_line(F.lit("LINESTRING(1 2, 3 4)")))] == [(1, 2), (3, 4)]
    assert value(spark, geo.wkt_point(geo.point(F.lit(1.5), F.lit(2)))) == "POINT(1.5 2.0)"


@pytest.mark.parametrize(
    ("heights", "metres", "interval", "wanted"),
    [([100, 102], 15, 10, (0.5, -0.675, 27)), ([0, 0.5], 8, 10, (0.269259375, -0.22703, 6)), ([0, 2, 0], 30, 10, (13 / 30, 73 / 60, 15)), ([592.7148121482129, 592.9108133538796, 592.8564161772507, 592.9966675210214], 25, 10, (0.050041190587917, -0.039483178571469, 2))],
)
def test_impedance(spark, heights, metres, interval, wanted):
    found = value(spark, networks.impedance(F.array(*[F.lit(float(h)) for h in heights]), F.lit(float(metres)), interval))
    assert tuple(found) == (pytest.approx(wanted[0]), pytest.approx(wanted[1]), wanted[2])


def test_impedance_needs_two_heights(spark):
    assert value(spark, networks.impedance(F.array(F.lit(1.0)), F.lit(5.0), 10)) is None


def test_grid_join_equals_brute_force(spark):
    points = [(i, (i * 7919 % 1000) / 100, (i * 104729 % 1000) / 100) for i in range(300)]
    df = spark.createDataFrame(points, "id long, x double, y double")
    found = {(r.a, r.b) for r in sj.within_distance(df, df, 0.7).select(F.col("l.id").alias("a"), F.col("r.id").alias("b")).collect()}
    assert found == {(a, b) for a, ax, ay in points for b, bx, by in points if (ax - bx) ** 2 + (ay - by) ** 2 <= 0.49}


def test_overlaps(spark):
    kind = "id long, geom array<array<struct<x:double,y:double>>>"
    a = spark.createDataFrame([(1, square(0.0, 0.0, 2.0)), (2, square(10.0, 10.0, 1.0))], kind)
    b = spark.createDataFrame([(7, square(1.0, 1.0, 5.0))], kind)
    assert [tuple(r) for r in buildings.overlaps(a, b, "id", "id", 1.5).collect()] == [(1, 7, pytest.approx(1.0))]
    dents = [[(0.0, 0.0), (4.0, 0.0), (4.0, 4.0), (2.0, 1.0), (0.0, 4.0), (0.0, 0.0)]]
    assert buildings.overlaps(spark.createDataFrame([(1, dents)], kind), spark.createDataFrame([(2, dents)], kind), "id", "id", 9.0).first().overlap == pytest.approx(10.0)


def test_difference_round_trip(spark):
    old = spark.createDataFrame([(1, "a", 1.0), (2, "b", None), (3, "c", 3.0)], "id long, s string, v double")
    new = spark.createDataFrame([(1, "a", 2.0), (2, "b", 5.0), (4, "d", None)], "id long, s string, v double")
    diff = rel.difference(old, new, ["id"])
    assert {(r.id, r.action) for r in diff.collect()} == {(1, "update"), (2, "update"), (3, "delete"), (4, "insert")}
    assert sorted(map(tuple, rel.applied(old, diff, ["id"]).collect())) == sorted(map(tuple, new.collect()))
    assert {r.id for r in rel.difference(old, new, ["id"], null_aware=False, with_delete=False).collect()} == {1, 4}
    assert rel.same_schema(old, new.drop("v"))["only_left"] == {("v", "double")}


def test_table_operators(spark):
    rows = spark.createDataFrame([(i,) for i in (30, 10, 20)], "id long")
    assert sorted((r.old_id, r.id) for r in rel.rebased(rows, "id", 100).collect()) == [(10, 101), (20, 102), (30, 103)]
    parts = spark.createDataFrame([(1, 2.0, 10.0), (1, 3.0, 10.0), (2, 0.0, 5.0), (3, None, 5.0)], "area long, w double, total double")
    assert sorted(r.allocated for r in rel.allocated(parts, "area", "w", "total").collect()) == [4.0, 6.0]
    assert [r.n for r in rel.duplicate_keys(parts, ["area"]).collect()] == [2]
    assert rel.orphans(parts, rows, "area", "id").count() == 4


def test_fused_decisions(spark):
    kind = "id long, name string, phone string, x double, y double"
    left = spark.createDataFrame([(1, "Cafe Nord", None, 0.0, 0.0), (2, "Bakery", "2", 5.0, 5.0)], kind)
    right = spark.createDataFrame([(10, "Cafe Nord", "10", 0.001, 0.0), (11, "Museum", "11", 0.0, 0.0)], kind)
    out = {r.id: (r.decision, r.phone) for r in poi.fused(left, right, 0.002, 0.2, matched="combine").collect()}
    assert out == {1: ("combined", "10"), 2: ("unmatched", "2"), 11: ("added", "11")}
    out = {r.id: r.decision for r in poi.fused(left, right, 0.002, 0.2, unmatched="drop", matched="replace", extra="drop").collect()}
    assert out == {1: "replaced"}


def test_fixed_rules(spark):
    kind = "id long, leisure string, sport string, amenity string, shop string, name string, osm_type string, tags map<string,string>"
    rows = [(1, "fitness_centre", None, None, None, None, "n", {}), (2, None, None, "charging_station", None, None, "n", {"bicycle": "yes"}), (3, None, None, "place_of_worship", None, None, "w", {"wikidata": "Q1"}), (4, None, None, "bicycle_rental", "x", None, "n", {})]
    out = {r.id: r.category for r in poi.fixed_rules(spark.createDataFrame(rows, kind), key="id").collect()}
    assert out == {1: "gym", 2: "ebike_charging_station", 3: "religious_site", 4: None}


def test_segments(spark):
    kind = "id string, source string, target string, geom array<struct<x:double,y:double>>, shares array<struct<share:double,id:string>>"
    rows = [("s", "a", "b", [(0.0, 0.0), (4.0, 0.0)], [(0.0, "a"), (0.5, "m"), (1.0, "b")])]
    df = spark.createDataFrame(rows, kind)
    parts = {r.id: (r.source, r.target, [tuple(p) for p in r.geom]) for r in networks.split_at_connectors(df).collect()}
    assert parts == {"s_0": ("a", "m", [(0, 0), (2, 0)]), "s_1": ("m", "b", [(2, 0), (4, 0)])}
    pieces = networks.clipped_to_grid(df, 1.5).collect()
    assert sorted((r.source, r.target, round(r.length, 6)) for r in pieces) == [("a", "connector.s_clip_1", 1.5), ("connector.s_clip_1", "connector.s_clip_2", 1.5), ("connector.s_clip_2", "b", 1.0)]


def test_islands(spark):
    edges = spark.createDataFrame([(1, 1, 2, 100), (2, 2, 3, 100), (3, 8, 9, 100)], "id long, source long, target long, class_id int")
    out = {r.id: r.class_id for r in networks.islands(edges, F.lit(True)).collect()}
    assert out == {1: 100, 2: 100, 3: 701}


def test_circle(spark):
    rows = spark.createDataFrame([(["test3", "test", "test4", "test1"], 0.0, 0.0)], "categories array<string>, x double, y double").withColumn("geom", geo.point(F.col("x"), F.col("y")))
    out = {r.category: (round(r.geom.x, 6), round(r.geom.y, 6)) for r in networks.spread_categories(rows, 1.0).collect()}
    assert out == {"test": (0, 1), "test1": (1, 0), "test3": (0, -1), "test4": (-1, 0)}


def test_gtfs_reader(spark, tmp_path):
    files = {"stops": "stop_id,stop_name,stop_lat,stop_lon,extra\na,\"A, B\",48.1,11.5,x\n", "stop_times": "trip_id,arrival_time,departure_time,stop_id,stop_sequence\nt,25:10:00,25:11:00,a,1\nt,1:00:00,1:00:00,zz,2\n"}
    for name, body in files.items():
        (tmp_path / f"{name}.txt").write_text(body, encoding="utf-8")
    feed = readers.read_gtfs(spark, str(tmp_path), tables=("stops", "stop_times"))
    assert [(r.stop_name, r.cell.cx) for r in feed["stops"].collect()] == [("A, B", 115)] or feed["stops"].first().cell.cx == 114
    assert sorted(r.arrival_time for r in feed["stop_times"].collect()) == [3600, 90600]
    assert readers.feed_problems(feed)["stop_times.stop_id: no such stops"].count() == 1


def test_boundaries_and_wkb(spark):
    text = "region\n1\n 0 0\n 4 0\n 4 4\nEND\n!1\n 1 1\n 2 1\n 2 2\nEND\nEND\n"
    polygons = readers.parse_poly(text)
    assert len(polygons) == 1 and len(polygons[0]) == 2 and polygons[0][0][0] == polygons[0][0][-1]
    assert readers.parse_poly(writers_text := readers.write_poly("region", polygons)) == polygons, writers_text
    data = bytearray(b"\x01\x01\x00\x00\x00" + struct.pack("<dd", 11.25, -48.5))
    p = spark.createDataFrame([(data,)], "g binary").select(readers.wkb_point(F.col("g")).alias("p")).first().p
    assert (p.x, p.y) == (11.25, -48.5)
    with pytest.raises(ValueError, match="no type"):
        readers.read_theme(spark, "/x", "places", "segment")


def test_writers(spark, tmp_path):
    rows = spark.createDataFrame([(1, "a"), (2, "b")], "id long, kind string")
    writers.write_table(rows, str(tmp_path / "t"), partition_by=["kind"])
    with pytest.raises(Exception, match="(?i)exists"):
        writers.write_table(rows, str(tmp_path / "t"))
    writers.dump(rows, str(tmp_path / "s"), writers.Dump.SCHEMA)
    assert spark.read.parquet(str(tmp_path / "s")).schema.names == ["id", "kind"]
    assert spark.read.parquet(str(tmp_path / "t")).count() == 2
    ways = spark.createDataFrame([(5, [(1.0, 2.0), (3.0, 4.0)], {"name": 'A "B"'})], "id long, geom array<struct<x:double,y:double>>, tags map<string,string>")
    writers.write_osm(networks.ways_as_osm(ways), str(tmp_path / "osm"))
    lines = "".join(r.value for r in spark.read.text(str(tmp_path / "osm")).collect())
    assert lines.count("<node") == 2 and '<way id="5"' in lines and 'v="A B"' in lines


def test_modes(spark):
    types = {0: "tram", 1: "metro", 2: "rail", 3: "bus", 4: "other", 109: "rail", 401: "metro", 704: "bus", 900: "tram", None: None}
    df = spark.createDataFrame([(k,) for k in types], "t int")
    assert {r.t: r.m for r in df.select("t", transit.mode_of_route_type(F.col("t")).alias("m")).collect()} == types


@pytest.mark.parametrize("metres", [5.0, 10.0, 15.0, 20.0, 30.0, 40.0])
def test_level_lines_take_no_effort(spark, metres):
    kind = "id int, geom array<struct<x:double,y:double>>, length_m double"
    segments = spark.createDataFrame([(1, [(0.0, 0.0), (3.0, 4.0), (3.0, 9.0)], metres)], kind)
    pixels = spark.createDataFrame([(i, float(i % 4), float(i // 4), 100.0) for i in range(44)], "pixel int, x double, y double, val double")
    r = networks.slope_profile(segments, pixels, 3.0).first()
    assert (r.impedance_slope, r.impedance_slope_reverse, r.slope_average) == (pytest.approx(0), pytest.approx(0), 0)


def test_points_along_a_line(spark):
    kind = "id int, geom array<struct<x:double,y:double>>, shares array<double>"
    rows = spark.createDataFrame([(1, [(0.0, 0.0), (3.0, 4.0), (3.0, 9.0)], [0.0, 0.25, 0.5, 0.75, 1.0]), (2, None, [0.0]), (3, [(1.0, 1.0)], [0.0, 1.0])], kind)
    out = {r.id: r.p and [(p.x, p.y) for p in r.p] for r in rows.select("id", lines.points_at(F.col("geom"), F.col("shares")).alias("p")).collect()}
    assert out[2] is None and out[3] == [(1, 1), (1, 1)]
    assert out[1] == [pytest.approx(p) for p in [(0, 0), (1.5, 2), (3, 4), (3, 6.5), (3, 9)]]


def test_lines_inside_a_cell_stay_whole(spark):
    kind = "id string, source string, target string, geom array<struct<x:double,y:double>>"
    inside = [(0.1 + 0.08 * i, 0.2 + 0.05 * (i % 3)) for i in range(10)]
    at_vertex = [(0.5, 0.5), (1.0, 0.5), (1.5, 0.5)]
    corner = [(0.5, 0.5), (1.5, 1.5)]
    rows = [("in", "a", "b", inside), ("v", "a", "b", at_vertex), ("c", "a", "b", corner), ("same", "a", "b", [(0.5, 0.5)] * 3), ("none", "a", "b", []), ("back", "a", "b", [(0.5, 0.5), (1.5, 0.5), (0.5, 0.5)])]
    out = {r.id: (r.source, r.target, r.cell_x, r.cell_y, len(r.geom), round(r.length, 6)) for r in networks.clipped_to_grid(spark.createDataFrame(rows, kind), 1.0).collect()}
    assert out.pop("in")[:5] == ("a", "b", 0, 0, 10)
    assert out.pop("same") == ("a", "b", 0, 0, 3, 0)
    assert out == {
        "v_clip_1": ("a", "connector.v_clip_1", 0, 0, 2, 0.5), "v_clip_2": ("connector.v_clip_1", "b", 1, 0, 2, 0.5),
        "c_clip_1": ("a", "connector.c_clip_1", 0, 0, 2, 0.707107), "c_clip_2": ("connector.c_clip_1", "b", 1, 1, 2, 0.707107),
        "back_clip_1": ("a", "connector.back_clip_1", 0, 0, 2, 0.5), "back_clip_2": ("connector.back_clip_1", "connector.back_clip_2", 1, 0, 3, 1.0), "back_clip_3": ("connector.back_clip_2", "b", 0, 0, 2, 0.5),
    }
