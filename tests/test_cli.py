"""The command line's datasets, from settings to tables."""

import pytest

from geoloom.plans import cli


def test_migration_of_a_table(spark, tmp_path):
    spark.createDataFrame([(1, "a"), (2, "b")], "id long, s string").write.parquet(str(tmp_path / "in/old"))
    spark.createDataFrame([(1, "a"), (2, "c")], "id long, s string").write.parquet(str(tmp_path / "in/new"))
    (tmp_path / "table_x.yaml").write_text(f"source: {tmp_path}/in\ntarget: {tmp_path}/out\nkeys: [id]\n", encoding="utf-8")
    cli.run(spark, "migration", "table", cli.Settings.read(str(tmp_path / "table_x.yaml")))
    assert [(r.id, r.s, r.action) for r in spark.read.parquet(str(tmp_path / "out")).collect()] == [(2, "c", "update")]


def test_timetable(spark, tmp_path):
    files = {
        "agency": "agency_id,agency_name\nx,X\n",
        "stops": "stop_id,stop_name,stop_lat,stop_lon\na,A,48.1,11.5\n",
        "routes": "route_id,agency_id,route_type\nr,x,3\n",
        "trips": "trip_id,route_id,service_id\nt,r,s\nu,r,s\n",
        "stop_times": "trip_id,arrival_time,departure_time,stop_id,stop_sequence\nt,8:00:00,8:00:00,a,1\nu,8:00:00,8:00:00,a,1\n",
        "calendar": "service_id,monday,tuesday,wednesday,thursday,friday,saturday,sunday,start_date,end_date\ns,1,1,1,1,1,0,0,20240101,20241231\n",
        "calendar_dates": "service_id,date,exception_type\ns,20240109,2\n",
        "shapes": "shape_id,shape_pt_lat,shape_pt_lon,shape_pt_sequence\n",
    }
    (tmp_path / "in").mkdir()
    for name, body in files.items():
        (tmp_path / f"in/{name}.txt").write_text(body, encoding="utf-8")
    cli.run(spark, "preparation", "gtfs", cli.Settings(str(tmp_path / "in"), str(tmp_path / "out"), {"start_date": "2024-01-02", "weeks": 4}))
    rows = spark.read.parquet(str(tmp_path / "out")).collect()
    assert [(r.stop_id, r.arrival_time, r.trip_id, r.weekdays, r.route_type) for r in rows] == [("a", 28800, "t", [True, False, False], 3)]


def made(spark, tmp_path, action, dataset, values=None, source="in"):
    cli.run(spark, action, dataset, cli.Settings(str(tmp_path / source), str(tmp_path / "out"), values or {}))
    return spark.read.parquet(str(tmp_path / "out"))


def test_stops_and_stations(spark, tmp_path):
    (tmp_path / "in").mkdir()
    files = {
        "stops": "stop_id,stop_name,stop_lat,stop_lon,location_type,parent_station,wheelchair_boarding\nh,H,48.5,11.5,1,,1\na,A,48.1,11.5,0,h,0\nb,B,48.2,11.6,,,2\nc,B,48.4,11.8,,,\nd,D,48.4,11.8,,,\n",
        "routes": "route_id,agency_id,route_type\nr,x,3\nt,x,0\n",
        "trips": "trip_id,route_id,service_id\nt1,r,s\nt2,t,s\n",
        "stop_times": "trip_id,arrival_time,departure_time,stop_id,stop_sequence\nt1,8:00:00,8:00:00,a,1\nt2,8:00:00,8:00:00,a,1\nt1,8:05:00,8:05:00,b,2\nt1,8:06:00,8:06:00,c,3\n",
    }
    for name, body in files.items():
        (tmp_path / f"in/{name}.txt").write_text(body, encoding="utf-8")
    stops = {r.stop_id: r for r in made(spark, tmp_path, "preparation", "gtfs_stops").collect()}
    assert {k: (v.modes, v.wheelchair) for k, v in stops.items()} == {"a": (["bus", "tram"], "yes"), "b": (["bus"], "no"), "c": (["bus"], "unknown")}
    stations = {r.stop_name: r for r in made(spark, tmp_path, "preparation", "gtfs_stations").collect()}
    assert sorted(stations) == ["B", "H"]
    assert stations["H"].modes == ["bus", "tram"] and stations["B"].children == ["b", "c"]
    assert (round(stations["B"].x, 6), round(stations["B"].y, 6)) == (11.7, 48.3)


def test_division_areas(spark, tmp_path):
    names, sources = '{"primary": "A\\u0000b"}', '[{"dataset": "y"}, {"dataset": "x"}, {"dataset": "y"}]'
    spark.createDataFrame([("1", names, "county", sources), ("2", names, "region", sources)], "id string, names string, subtype string, sources string").write.parquet(str(tmp_path / "in"))
    rows = made(spark, tmp_path, "preparation", "overture_division_area", {"subtypes": ["county"]}).collect()
    assert [(r.id, r.name, r.sources) for r in rows] == [("1", "Ab", "x, y")]


def test_buildings(spark, tmp_path):
    spark.createDataFrame([(1, "garage", 1, 0, 10.0), (2, "house", 3, 1, 10.0), (3, None, 1, 1, 10.0)], "id int, building_type string, building_levels int, shops int, area double").write.parquet(str(tmp_path / "in"))
    rows = made(spark, tmp_path, "preparation", "building", {"no_residents": {"building_type": ["garage"]}, "subtract": "shops"}).collect()
    assert {r.id: (r.residential_status, r.gross_floor_area_residential) for r in rows} == {1: ("no_residents", 0.0), 2: ("with_residents", 20.0), 3: ("no_residents", 0.0)}


def test_network(spark, tmp_path):
    kind = "gid int, osm_id long, source long, target long, tag_id int, maxspeed_forward int, maxspeed_backward int, geom array<struct<x:double,y:double>>"
    line = [(0.0, 0.0), (0.0001, 0.0)]
    spark.createDataFrame([(1, 10, 5, 6, 112, 50, 50, line), (2, 11, 6, 7, 112, 50, 30, line), (3, 10, 8, 9, 112, 50, 30, line), (4, 10, 6, 7, 104, 50, 30, line)], kind).write.parquet(str(tmp_path / "in/ways"))
    spark.createDataFrame([(10, "stairs", "no", None, "Gravel", {})], "osm_id long, highway string, foot string, bicycle string, surface string, tags map<string,string>").write.parquet(str(tmp_path / "in/lines"))
    spark.createDataFrame([(1, 0.0, 0.00001, 100.0), (2, 0.0001, 0.00001, 101.0)], "pixel int, x double, y double, val double").write.parquet(str(tmp_path / "in/pixels"))
    rows = {r.gid: r for r in made(spark, tmp_path, "preparation", "network", {"surfaces": {"gravel": 0.3}}).collect()}
    assert (rows[1].preparation_status, rows[1].foot, rows[1].wheelchair, rows[1].impedance_surface, rows[1].maxspeed_forward) == ("p", "no", "no", 0.3, 50)
    assert (rows[2].preparation_status, rows[2].foot, rows[2].maxspeed_backward) == ("e", None, None)
    assert rows[1].s_imp is None and rows[1].length_m == pytest.approx(11.12, abs=0.01)
    whole = {"surfaces": {"gravel": 0.3}, "radius": 0.00003, "island_from": [112], "last_node": 100, "last_edge": 1000}
    rows = {r.old_gid: r for r in made(spark, tmp_path, "preparation", "network", whole).collect()}
    assert {k: (r.gid, r.source, r.target, r.tag_id) for k, r in rows.items()} == {1: (1001, 101, 102, 112), 2: (1002, 102, 103, 112), 3: (1003, 104, 105, 701), 4: (1004, 102, 103, 104)}
    assert rows[1].incline_percent is None and rows[2].preparation_status == "e"


def test_network_migration_keeps_no_scenarios(spark, tmp_path):
    kind = "id long, scenario_id long"
    spark.createDataFrame([(1, None), (2, 7)], kind).write.parquet(str(tmp_path / "in/old"))
    spark.createDataFrame([(1, None), (2, None), (3, None)], kind).write.parquet(str(tmp_path / "in/new"))
    assert sorted(r.id for r in made(spark, tmp_path, "migration", "network").collect()) == [1, 3]
    spark.createDataFrame([(1,)], "id long").write.parquet(str(tmp_path / "other/old"))
    spark.createDataFrame([(1, None)], kind).write.parquet(str(tmp_path / "other/new"))
    with pytest.raises(ValueError, match="schemas differ"):
        made(spark, tmp_path, "migration", "network", source="other")


def test_unknown_dataset(spark):
    with pytest.raises(ValueError, match="no fusion of"):
        cli.run(spark, "fusion", "gtfs", cli.Settings("", ""))


def test_overture_network(spark, tmp_path):
    segment = "id string, connectors array<string>, geom array<struct<x:double,y:double>>, road string"
    line = [(0.0, 0.0), (0.0, 0.01), (0.0, 0.02)]
    rows = [("s", ["a", "b", "c"], line, '{"class":"path","surface":"gravel","flags":["is_bridge"],"restrictions":{"speedLimits":{"maxSpeed":[30,"km/h"]}}}'), ("t", ["a", "missing"], line, '{"class":"road","surface":[{"value":"gravel"}]}'), ("u", [], line, None)]
    spark.createDataFrame(rows, segment).write.parquet(str(tmp_path / "in/segments"))
    spark.createDataFrame([("a", (0.0, 0.0)), ("b", (0.0, 0.012)), ("c", (0.0, 0.02))], "id string, geom struct<x:double,y:double>").write.parquet(str(tmp_path / "in/connectors"))
    spark.createDataFrame([(1, 0.0, 0.0, 10.0), (2, 0.0, 0.02, 12.0)], "pixel int, x double, y double, val double").write.parquet(str(tmp_path / "in/pixels"))
    values = {"surfaces": {"gravel": 0.3}, "fine": 0.01, "coarse": 1.0, "radius": 0.03}
    out = {r.name: r for r in made(spark, tmp_path, "preparation", "overture_network", values).collect()}
    # The line runs along x = 0 from cell (0, 0) on; the fine grid cuts it at y = 0.01.
    assert sorted(out) == ["s_sub_1_clip_1", "s_sub_1_clip_2", "s_sub_2", "t_clip_1", "t_clip_2", "u_clip_1", "u_clip_2"]
    assert (out["s_sub_2"].class_, out["s_sub_2"].maxspeed_forward, out["s_sub_2"].impedance_surface, out["s_sub_2"].tags) == ("path", 30, 0.3, '["is_bridge"]')
    assert (out["t_clip_1"].impedance_surface, out["u_clip_1"].class_, out["u_clip_1"].source) == (None, None, None)
    assert out["s_sub_1_clip_1"].target == out["s_sub_1_clip_2"].source and out["s_sub_1_clip_2"].target == out["s_sub_2"].source
    assert out["s_sub_2"].impedance_slope > 0 and out["s_sub_2"].length_m == pytest.approx(889.6, abs=0.5)
    nodes = {r.id: r.geom for r in made(spark, tmp_path, "preparation", "overture_connectors", values).collect()}
    assert nodes[out["s_sub_2"].source] == (0.0, 0.012) and nodes[out["t_clip_1"].target].y == pytest.approx(0.01)


def test_network_migration_of_nodes_and_edges(spark, tmp_path):
    node, edge = "id long, scenario_id long", "id long, source long, target long, geom array<struct<x:double,y:double>>, scenario_id long"
    line = lambda x: [(x, 0.0), (x + 0.5, 0.0)]
    tables = {
        "old_node": ([(1, None), (2, None), (50, 7)], node), "new_node": ([(1, None), (2, None), (3, None), (4, None), (5, None)], node),
        "old_edge": ([(10, 1, 2, line(0.0), None), (90, 1, 50, line(0.0), 7)], edge), "new_edge": ([(10, 1, 2, line(0.0), None), (11, 2, 3, line(0.5), None), (12, 4, 5, line(70.0), None)], edge),
        "areas": ([(1, [[(-1.0, -1.0), (3.0, -1.0), (3.0, 1.0), (-1.0, 1.0), (-1.0, -1.0)]])], "id long, geom array<array<struct<x:double,y:double>>>"),
        "way_modified": ([(7,), (7,), (9,), (None,)], "scenario_id long"),
    }
    for name, (rows, kind) in tables.items():
        spark.createDataFrame(rows, kind).write.parquet(str(tmp_path / f"in/{name}"))
    cli.run(spark, "migration", "networks", cli.Settings(str(tmp_path / "in"), str(tmp_path / "out"), {"cell": 2.0, "modified": "way_modified"}))
    ids = lambda name, column="id": sorted(r[0] for r in spark.read.parquet(str(tmp_path / f"out/{name}")).select(column).collect())
    assert (ids("node"), ids("edge"), ids("scenario", "scenario_id")) == ([1, 2, 3], [10, 11], [7, 9])
    spark.createDataFrame([(1,)], "id long").write.parquet(str(tmp_path / "bad/new_node"))
    for name in ("old_node", "old_edge", "new_edge"):
        spark.createDataFrame(*tables[name]).write.parquet(str(tmp_path / f"bad/{name}"))
    with pytest.raises(ValueError, match="schemas differ"):
        cli.run(spark, "migration", "networks", cli.Settings(str(tmp_path / "bad"), str(tmp_path / "other"), {}))
    assert not (tmp_path / "other").exists()


def test_collected_feed_and_theme(spark, tmp_path):
    files = {"stops": "stop_id,stop_name,stop_lat,stop_lon,parent_station\na,A,48.1,11.5,zz\na,A,48.1,11.5,\n", "routes": "route_id,route_type\nr,3\n", "trips": "trip_id,route_id,service_id\nt,x,s\n"}
    (tmp_path / "in").mkdir()
    for name, body in files.items():
        (tmp_path / f"in/{name}.txt").write_text(body, encoding="utf-8")
    cli.run(spark, "collection", "gtfs", cli.Settings(str(tmp_path / "in"), str(tmp_path / "out"), {"tables": ["stops", "routes", "trips"]}))
    read = lambda name: spark.read.parquet(str(tmp_path / f"out/{name}")).collect()
    assert [(r.stop_id, r.stop_lat, r.cell.cx) for r in read("stops")] == [("a", 48.1, 115)] * 2 and read("trips")[0].service_id == "s"
    assert sorted(r.rule for r in read("problems")) == ["stops.parent_station: no such stops", "stops: repeated key", "trips.route_id: no such routes"]
    kind = "id string, names struct<primary:string>, bbox struct<xmin:double,xmax:double,ymin:double,ymax:double>"
    spark.createDataFrame([("p", ("P",), (1.0, 1.0, 1.0, 1.0)), ("q", ("Q",), (5.0, 5.0, 1.0, 1.0))], kind).write.parquet(str(tmp_path / "lake/theme=places/type=place"))
    values = {"theme": "places", "type": "place", "box": {"xmin": 0, "ymin": 0, "xmax": 2, "ymax": 2}}
    cli.run(spark, "collection", "overture", cli.Settings(str(tmp_path / "lake"), str(tmp_path / "places"), values))
    assert [(r.id, r.names) for r in spark.read.parquet(str(tmp_path / "places")).collect()] == [("p", '{"primary":"P"}')]
