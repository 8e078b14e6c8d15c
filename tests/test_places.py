"""Order by place, partitions rewritten by cell, nearest parts, scattered points, regions; queries without SQL by brute force."""

import difflib
import math
import os
import random

from pathlib import Path

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from geoloom.functions import cells, overlay as ov
from geoloom.operators import buildings, networks
from geoloom.plans import queries, queries_more
from geoloom.sources import writers

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
POLYGON = "array<array<struct<x:double,y:double>>>"


def closed(rings):
    return [[{"x": float(x), "y": float(y)} for x, y in [*r, r[0]]] for r in rings]


def square(x, y, far):
    return [(x, y), (x + far, y), (x + far, y + far), (x, y + far)]


def test_curve_visits_each_square_once_and_goes_to_a_neighbour(spark):
    rows = spark.range(64).select((F.col("id") % 8 + 0.5).alias("x"), (F.floor(F.col("id") / 8) + 0.5).alias("y"))
    box = {"xmin": 0.0, "ymin": 0.0, "xmax": 8.0, "ymax": 8.0}
    place = {r.k: (r.x, r.y) for r in rows.select("x", "y", cells.hilbert_key(F.col("x"), F.col("y"), box, 3).alias("k")).collect()}
    assert sorted(place) == list(range(64))
    assert all(math.dist(place[k], place[k + 1]) == 1 for k in range(63))
    odd = spark.createDataFrame([(-5.0, 99.0), (8.0, 8.0), (None, 1.0)], "x double, y double").select(cells.hilbert_key(F.col("x"), F.col("y"), box, 3).alias("k")).collect()
    assert [place.get(r.k) for r in odd] == [(0.5, 7.5), (7.5, 7.5), None]


def test_box_scans_of_a_table_by_place(spark, tmp_path):
    rows = spark.range(20_000).select("id", (F.rand(3) * 100).alias("x"), (F.rand(4) * 100).alias("y"))
    writers.write_by_place(rows, str(tmp_path / "t"), 64)
    files = [pq.ParquetFile(f).metadata.row_group(0) for f in (tmp_path / "t").glob("part-*.parquet")]
    assert 48 <= len(files) <= 72 and sum(f.num_rows for f in files) == 20_000
    span = [{c.path_in_schema: (c.statistics.min, c.statistics.max) for c in (f.column(i) for i in range(3))} for f in files]
    met = sum(s["x"][0] <= 40 and s["x"][1] >= 30 and s["y"][0] <= 70 and s["y"][1] >= 60 for s in span)
    assert met <= 0.15 * len(files)
    assert spark.read.parquet(str(tmp_path / "t")).where("x between 30 and 40 and y between 60 and 70").count() == rows.where("x between 30 and 40 and y between 60 and 70").count()


def test_one_cell_is_rewritten_alone(spark, tmp_path):
    kind = "id int, geom array<struct<x:double,y:double>>, length_m double, impedance_slope double, impedance_slope_reverse double, slope_average int, cell int"
    rows = [(i, [(float(i), 0.0), (float(i), 1.0)], 25.0, None, None, None, i % 3) for i in range(9)]
    path = str(tmp_path / "segments")
    spark.createDataFrame(rows, kind).write.partitionBy("cell").parquet(path)
    files = lambda: {str(f.relative_to(path)): f.stat().st_mtime_ns for f in Path(path).rglob("*.parquet")}
    content = lambda: sorted(map(tuple, spark.read.parquet(path).select("id", "cell", "length_m", "impedance_slope", "slope_average").collect()))
    pixels = spark.createDataFrame([(i * 2 + j, float(i), float(j), 100.0 + 3 * j) for i in range(9) for j in range(2)], "pixel int, x double, y double, val double")
    first = files()
    networks.recomputed_slopes(spark, path, pixels, 0.8, [1])
    second, once = files(), content()
    assert {f for f in first if "cell=1" not in f} == {f for f in second if "cell=1" not in f}
    assert all(second[f] == first[f] for f in first if "cell=1" not in f) and not {f for f in second if "cell=1" in f} & set(first)
    assert [r[0] for r in once if r[3] is not None] == [1, 4, 7] and len(once) == 9
    networks.recomputed_slopes(spark, path, pixels, 0.8, [1])
    assert content() == once
    networks.recomputed_slopes(spark, path, pixels, 0.8, [77])
    assert content() == once
    networks.recomputed_slopes(spark, path, pixels, 0.8, [0, 2])
    assert all(r[3] is not None for r in content())


def test_nearest_parts_cover_an_outline(spark):
    rng = random.Random(6)
    outline = [[(0, 0), (10, 0), (10, 6), (6, 6), (6, 3), (4, 3), (4, 10), (0, 10)], square(1, 1, 2)]
    seeds = [(rng.uniform(0, 10), rng.uniform(0, 10)) for _ in range(40)]
    seeds += [seeds[0], (5.0, 50.0)]
    rows = spark.createDataFrame([(1, [{"x": x, "y": y} for x, y in seeds], closed(outline)), (2, [{"x": 1.0, "y": 1.0}], closed(outline)), (3, [], closed(outline)), (4, [{"x": 1.0, "y": 1.0}], None)], f"id int, seeds array<struct<x:double,y:double>>, geom {POLYGON}")
    found = {r.id: r.parts for r in rows.select("id", ov.voronoi(F.col("seeds"), F.col("geom")).alias("parts")).collect()}
    assert found[3] == [] and found[4] is None and len(found[2]) == 1
    shapes = [[[(p.x, p.y) for p in ring[:-1]] for g in part for ring in g] for part in found[1]]
    size = lambda rings: ov.shape_area(ov.overlay(rings, [], "union"))
    assert sum(map(size, shapes)) == pytest.approx(size(outline)) and shapes[40] == []
    legs = [ov._edges(s) for s in shapes]
    for _ in range(400):
        p = (rng.uniform(0, 10), rng.uniform(0, 10))
        holds = lambda rings, p=p: sum(ov._holds(r, p) for r in rings) % 2 == 1
        best = min(range(len(seeds)), key=lambda k: (math.dist(seeds[k], p), k))
        assert [k for k, s in enumerate(shapes) if len(legs[k]) and holds(s)] == ([best] if holds(outline) else [])


def test_scattered_points_are_even_and_repeatable(spark):
    comb = [[(0, 0), (5, 0), (5, 4), (4, 4), (4, 1), (3, 1), (3, 4), (2, 4), (2, 1), (1, 1), (1, 4), (0, 4)]]
    rows = spark.createDataFrame([(1, closed(comb), 6000), (2, closed([square(0, 0, 4), square(1, 1, 2)]), 6000), (3, closed([square(0, 0, 1)]), 0), (4, None, 5), (5, closed([[(0, 0), (1, 1)]]), 5)], f"id int, geom {POLYGON}, n int")
    points = rows.select("id", ov.generated_points(F.col("geom"), F.col("n"), F.col("id")).alias("p"))
    found = {r.id: r.p for r in points.collect()}
    assert found[3] == [] and found[4] is None and found[5] == [] and len(found[1]) == len(found[2]) == 6000
    assert found == {r.id: r.p for r in points.collect()}
    teeth = [sum(k <= p.x <= k + 1 and p.y > 1 for p in found[1]) for k in (0, 2, 4)]
    base = sum(p.y <= 1 for p in found[1])
    assert sum(teeth) + base == 6000
    for n, share in (*((t, 3 / 14) for t in teeth), (base, 5 / 14)):
        assert abs(n - 6000 * share) < 4 * math.sqrt(6000 * share * (1 - share))
    assert not any(1 < p.x < 3 and 1 < p.y < 3 for p in found[2])
    corner = sum(p.x < 1 and p.y < 1 for p in found[2])
    assert abs(corner - 500) < 4 * math.sqrt(500)
    triangle = ov.scattered([[(0, 0), (1, 0), (0, 1)]], 8000, 5)
    assert abs(sum(y < 1 - math.sqrt(0.5) for _, y in triangle) - 4000) < 4 * math.sqrt(2000)


def test_equal_units(spark):
    rows = spark.createDataFrame([(i, float(i % 17), float(i % 13)) for i in range(1000)] + [(5000, None, 1.0), (5001, 3.0, 3.0), (5001, 3.0, 3.0)], "id int, x double, y double")
    sizes = [r["count"] for r in buildings.equal_areas(rows, 9, "id").groupBy("unit").count().collect()]
    assert len(sizes) == 9 and sum(sizes) == 1002 and max(sizes) - min(sizes) <= 1
    assert buildings.equal_areas(rows.limit(0), 3, "id").collect() == []


def test_designed_regions(spark):
    rng = random.Random(2)
    centres = [(2, 2), (8, 2), (5, 8)]
    points = spark.createDataFrame([(cx + rng.gauss(0, 0.3), cy + rng.gauss(0, 0.3)) for cx, cy in centres for _ in range(60)], "x double, y double")
    outline = spark.createDataFrame([(closed([square(0, 0, 10)]),)], f"geom {POLYGON}")
    found = buildings.designed_regions(points, outline, 3, 0.5).select("region", ov.total_area(F.col("geom")).alias("size"), ov.total_area(F.col("buffer_geom")).alias("grown")).collect()
    assert sorted(r.region for r in found) == [0, 1, 2] and sum(r.size for r in found) == pytest.approx(100)
    assert all(r.size < r.grown < r.size + 0.5 * 40 + 1 for r in found)


def test_names_alike_by_brute_force(spark):
    if not os.path.isdir(SF):
        pytest.skip("no test tables here")
    wanted = {}
    for r in queries.table(spark, SF, "part").select("p_partkey", "p_name").collect():
        name = r.p_name.lower()
        wanted[r.p_partkey] = any(difflib.SequenceMatcher(None, name, a).ratio() >= 0.85 or a in name or name in a for a in ("small widgets", "larg bolt"))
    found = {r.p_partkey: r.alike for r in queries.name_similarity_udf(spark, SF).collect()}
    assert found == wanted and any(found.values()) and not all(found.values())


def test_simplified_lines_by_brute_force(spark):
    if not os.path.isdir(SF):
        pytest.skip("no test tables here")

    def kept(points, tolerance):
        """Recursive, farthest point first, distances by Hero's formula."""
        if len(points) < 3:
            return points
        a, b = points[0], points[-1]

        def off(p):
            side = math.dist(a, b)
            if not side:
                return math.dist(a, p)
            half = (side + math.dist(a, p) + math.dist(b, p)) / 2
            return 2 * math.sqrt(max(0.0, half * (half - side) * (half - math.dist(a, p)) * (half - math.dist(b, p)))) / side

        at = max(range(1, len(points) - 1), key=lambda i: (off(points[i]), -i))
        if off(points[at]) <= tolerance:
            return [a, b]
        return kept(points[: at + 1], tolerance)[:-1] + kept(points[at:], tolerance)

    rows = queries.coordinates(queries.table(spark, SF, "lineitem"), "l_partkey").select("l_suppkey", "x", "y").collect()
    lines = {}
    for r in rows:
        lines.setdefault(r.l_suppkey, []).append((r.x, r.y))
    wanted = {k: (len(v), len(kept(sorted(v), 0.5))) for k, v in lines.items()}
    assert {r.l_suppkey: (r.before, r.after) for r in queries_more.simplified_lines(spark, SF).collect()} == wanted


