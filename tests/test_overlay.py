"""Operations on polygons against the JVM's own geometry library, formulas, and unions in one go."""

import math
import random

import pytest
from pyspark.sql import functions as F

from geoloom.functions import geometry as geo, overlay as ov
from geoloom.operators import buildings

KIND = "id int, kind string, geom array<array<struct<x:double,y:double>>>"


def star(rng, cx, cy, n, low, high, grid=None):
    places = [(cx + r * math.cos(2 * math.pi * i / n), cy + r * math.sin(2 * math.pi * i / n)) for i in range(n) for r in (rng.uniform(low, high),)]
    return [(round(x / grid) * grid, round(y / grid) * grid) for x, y in places] if grid else places


def shape(rng, grid):
    cx, cy = rng.uniform(-2, 2), rng.uniform(-2, 2)
    cx, cy = (round(cx), round(cy)) if grid else (cx, cy)
    rings = [star(rng, cx, cy, rng.randint(4, 40), 2, 5, grid)]
    return rings + ([star(rng, cx, cy, rng.randint(3, 12), 0.5, 1.2, grid)] if rng.random() < 0.6 else [])


def well_known(rings):
    return "POLYGON(" + ",".join("(" + ",".join(f"{x!r} {y!r}" for x, y in [*r, r[0]]) + ")" for r in rings) + ")"


@pytest.mark.parametrize("grid", [None, 0.25])
def test_operations_on_polygons(spark, grid):
    read = spark._jvm.org.locationtech.jts.io.WKTReader().read
    rng = random.Random(3)
    checked = 0
    for _ in range(60):
        a, b = shape(rng, grid), shape(rng, grid)
        ja, jb = read(well_known(a)), read(well_known(b))
        if not (ja.isValid() and jb.isValid()):
            continue
        for operation, name in (("intersection", "intersection"), ("union", "union"), ("difference", "difference"), ("symmetric_difference", "symDifference")):
            found, wanted = ov.overlay(a, b, operation), getattr(ja, name)(jb)
            assert ov.shape_area(found) == pytest.approx(wanted.getArea(), abs=1e-7)
            parts = [wanted.getGeometryN(i) for i in range(wanted.getNumGeometries())]
            parts = [p for p in parts if p.getArea() > 1e-9]
            assert (len(found), sum(len(p) - 1 for p in found)) == (len(parts), sum(p.getNumInteriorRing() for p in parts))
            checked += 1
    assert checked > 100


def square(x, y, far=1.0):
    return [(x, y), (x + far, y), (x + far, y + far), (x, y + far)]


def closed(rings):
    return [[{"x": float(x), "y": float(y)} for x, y in [*r, r[0]]] for r in rings]


def test_operations_on_simple_cases():
    a, b = [square(0, 0)], [square(1, 0)]
    assert ov.overlay(a, b) == [] and ov.overlay(a, []) == [] and ov.overlay([], []) == []
    both = ov.overlay(a, b, "union")
    assert [[sorted(r) for r in p] for p in both] == [[[(0, 0), (0, 1), (2, 0), (2, 1)]]] and ov.signed_area(both[0][0]) == 2
    assert len(ov.overlay(a, [square(1, 1)], "union")) == 2
    assert ov.overlay(a, a, "difference") == [] and ov.shape_area(ov.overlay(a, a, "union")) == 1
    assert ov.overlay([[(0, 0), (1, 1)]], a) == [] and ov.overlay([[(0, 0), (1, 1), (2, 2)]], [], "union") == []
    inner = ov.overlay([square(0, 0, 3)], [square(1, 1)], "difference")
    assert [len(p) for p in inner] == [2] and ov.shape_area(inner) == 8
    island = ov.overlay([r for p in inner for r in p], [square(1.25, 1.25, 0.5)], "union")
    assert sorted(len(p) for p in island) == [1, 2] and ov.shape_area(island) == 8.25


def test_columns_of_polygons(spark):
    rows = [(1, "a", closed([square(0, 0, 4), square(1, 1, 2)])), (2, "a", None), (3, "a", []), (4, "a", closed([square(9, 9)]))]
    df = spark.createDataFrame(rows, KIND)
    other = F.lit(None).cast("array<array<struct<x:double,y:double>>>")
    box = F.array(F.array(*[geo.point(F.lit(float(x)), F.lit(float(y))) for x, y in [*square(2.0, 2.0, 3.0), (2.0, 2.0)]]))
    found = {r.id: (r.n, r.size) for r in df.select("id", ov.overlaid(F.col("geom"), box).alias("g")).select("id", F.size("g").alias("n"), ov.total_area(F.col("g")).alias("size")).collect()}
    assert found == {1: (1, 3.0), 2: (None, None), 3: (0, 0.0), 4: (0, 0.0)}
    assert df.select(ov.overlaid(F.col("geom"), other).alias("g")).where("g is not null").count() == 0
    assert {r.id: r.g and len(r.g) for r in df.select("id", ov.buffered(F.col("geom"), 0.25).alias("g")).collect()} == {1: 1, 2: None, 3: [], 4: 1}


def test_buffers_within_a_percent():
    ell = [[(0.0, 0.0), (4.0, 0.0), (4.0, 1.0), (1.0, 1.0), (1.0, 3.0), (0.0, 3.0)]]
    for far in (0.1, 0.5, 1.0):
        assert ov.shape_area(ov.buffer([square(0, 0, 3)], far)) == pytest.approx(9 + 12 * far + math.pi * far**2, rel=0.01)
        assert ov.shape_area(ov.buffer(ell, far)) == pytest.approx(6 + 14 * far + 1.25 * math.pi * far**2 - far**2, rel=0.01)
    ring = ov.buffer([square(0, 0, 4), square(1, 1, 2)], 0.5)
    assert [len(p) for p in ring] == [2] and ov.shape_area(ring) == pytest.approx(16 + 8 + math.pi / 4 - 1, rel=0.01)
    assert [len(p) for p in ov.buffer([square(0, 0, 4), square(1, 1, 2)], 1.25)] == [1]


def test_concave_overlaps_by_cell(spark):
    comb = [(0, 0), (5, 0), (5, 4), (4, 4), (4, 1), (3, 1), (3, 4), (2, 4), (2, 1), (1, 1), (1, 4), (0, 4)]
    a = spark.createDataFrame([(1, "x", closed([square(-1, 2, 7), square(3.25, 2.5, 0.5)])), (2, "x", None)], KIND)
    b = spark.createDataFrame([(7, "y", closed([comb])), (8, "y", closed([square(50, 50)]))], KIND)
    for cell in (0.7, 3.0, 100.0):
        assert [tuple(r) for r in buildings.overlaps(a, b, "id", "id", cell).collect()] == [(1, 7, pytest.approx(6.0))]


def test_dissolve_equals_one_union(spark):
    rng = random.Random(9)
    rows = [(i, rng.choice(["a", "b", None]), closed([square(rng.randint(-9, 9), rng.randint(-9, 9), rng.randint(1, 3))])) for i in range(120)]
    rows += [(500 + i, "hot", closed([square(0, 0)])) for i in range(100)] + [(900, "a", None), (901, "one", closed([square(-30, 40), square(-29.75, 40.25, 0.5)]))]
    rows += [(600 + i, "dense", closed([square(0.01 * i, 0.02 * (i % 7), 0.5)])) for i in range(90)]
    found = {r.kind: r for r in buildings.dissolved(spark.createDataFrame(rows, KIND).repartition(4), "kind", 4.0, fan=4).select("kind", ov.total_area(F.col("geom")).alias("size"), F.size("geom").alias("parts"), F.size(F.flatten("geom")).alias("rings")).collect()}
    assert set(found) == {"a", "b", None, "hot", "one", "dense"}
    for kind in found:
        shapes = [[[(p["x"], p["y"]) for p in ring[:-1]] for ring in g] for _, k, g in rows if k == kind and g is not None]
        whole = ov.united(shapes)
        r = found[kind]
        assert (r.size, r.parts, r.rings) == (pytest.approx(ov.shape_area(whole)), len(whole), sum(map(len, whole)))
    assert found["one"].size == 0.75
    filled = buildings.dissolved(spark.createDataFrame(rows, KIND).where("kind = 'one'"), "kind", 4.0, least_hole=0.3).select(ov.total_area(F.col("geom"))).first()[0]
    assert filled == 1.0
    assert buildings.dissolved(spark.createDataFrame([], KIND), "kind", 4.0).collect() == []


def test_holes_stay_when_subdivided(spark):
    rows = spark.createDataFrame([(1, "x", closed([square(0, 0, 10), square(1, 1, 6)])), (2, "x", closed([star(random.Random(1), 0, 0, 60, 3, 5), star(random.Random(2), 0, 0, 30, 1, 2)]))], KIND)
    whole = {r.id: r.size for r in rows.select("id", geo.area(F.col("geom")).alias("size")).collect()}
    out = buildings.subdivided(rows, "id", most=7).withColumn("corners", F.aggregate("geom", F.lit(0), lambda t, r: t + F.size(r) - 1))
    got = {r.id: r for r in out.groupBy("id").agg(F.sum(geo.area(F.col("geom"))).alias("size"), F.max("corners").alias("most"), F.count("*").alias("n")).collect()}
    assert whole[1] == 64 and all(got[k].size == pytest.approx(whole[k]) and got[k].most <= 7 for k in whole)


def test_snapping_closes_gaps(spark):
    """A square beside a wall: the gap closes where it is narrow, what lay inside the wall goes."""
    wall = F.array(F.array(*[geo.point(F.lit(x), F.lit(y)) for x, y in [(3.0, -5.0), (5.0, -5.0), (5.0, 9.0), (3.0, 9.0), (3.0, -5.0)]]))
    rows = spark.createDataFrame([(1, "", closed([square(0, 0, 2.5)])), (2, "", closed([square(1, 0, 2.5)])), (3, "", closed([square(3.5, 0)]))], KIND)
    out = {r.id: r.g for r in rows.select("id", ov.snapped(F.col("geom"), wall, 0.75, 0.01).alias("g")).collect()}
    assert max(p.x for p in out[1][0][0]) == 3.0 and max(p.x for p in out[2][0][0]) == 3.0 and out[3] == []


def test_buildings_by_rules_in_order(spark):
    """Attribute, points, share of concave zones with holes; the first that holds wins, unknown shapes match attributes only."""
    kind = "id int, kind string, building_levels int, geom array<array<struct<x:double,y:double>>>"
    rows = [(1, "church", 2, closed([square(0, 0)])), (2, "house", 3, closed([square(2, 0)])), (3, "house", 2, closed([square(4, 0)])), (4, "house", 2, closed([square(6, 0)])), (5, "church", 1, None), (6, None, 1, None), (7, "house", 1, closed([square(50, 50), square(50.25, 50.25, 0.5)]))]
    points = spark.createDataFrame([(2.5, 0.5), (2.5, 0.25), (3.0, 1.0), (4.5, 0.5)], "x double, y double")
    zones = [[square(3.5, -1, 3), square(4, 0.5, 0.5)], [square(6, 0, 0.5)], [square(6, 0, 0.5)]]
    shop = spark.createDataFrame([(3.0, 1.0), (2.5, 0.25), (4.5, 0.5)], "x double, y double")
    tables = {"poi": points, "zone": spark.createDataFrame([(closed(z),) for z in zones], "geom array<array<struct<x:double,y:double>>>"), "shop": shop}
    rules = [{"attribute": "kind", "values": ["church"]}, {"points": "poi", "count": 3, "status": "shops"}, {"polygons": "zone", "share": 0.7, "status": "mixed"}]
    out = {r.id: r for r in buildings.classified(spark.createDataFrame(rows, kind), rules, tables, 2.0, "shop").collect()}
    assert {k: (r.residential_status, r.matched_rule, r.building_levels_residential) for k, r in out.items()} == {
        1: ("no_residents", "attribute:kind", 2), 2: ("shops", "points:poi", 1), 3: ("mixed", "share:zone", 1), 4: ("mixed", "share:zone", 2),
        5: ("no_residents", "attribute:kind", 1), 6: ("with_residents", "default", 1), 7: ("with_residents", "default", 1),
    }
    assert out[6].area is None and 0 < out[7].area < out[1].area and out[7].gross_floor_area_residential == pytest.approx(out[7].area)
    none = [{"points": "poi", "count": 0, "status": "empty"}]
    assert {r.id for r in buildings.classified(spark.createDataFrame(rows, kind), none, tables, 2.0).where("residential_status = 'empty'").collect()} == {1, 4, 5, 6, 7}


def test_components_in_rounds_and_in_one_task(spark):
    from geoloom.operators import networks

    rng = random.Random(4)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(180)] + [(400, 400), (None, 500), (501, None)]
    df = spark.createDataFrame(edges, "source long, target long")
    few, many = (sorted(map(tuple, networks.component_of(df, one_task=n).collect())) for n in (1 << 17, 0))
    assert few == many and len({c for _, c in few}) > 20


def test_covers_are_few_and_exact(spark):
    from geoloom.functions.predicates import cover_of, holds, legs_of
    from geoloom.operators import spatial_joins as sj

    rng = random.Random(12)
    wide = [[*star(rng, 0, 0, 40, 300, 500), None], [*star(rng, 0, 0, 12, 50, 100), None]]
    wide = [[*r[:-1], r[0]] for r in wide]
    cells = cover_of(wide, 1.0, 200)
    assert len(cells) <= 200 and any(whole for *_, whole in cells)
    size = sum(4.0**level for level, *_ in cells)
    assert size < 1.5 * (ov.signed_area(wide[0][:-1]) - ov.signed_area(wide[1][:-1]))
    legs = legs_of(wide)
    for _ in range(2000):
        p = (rng.uniform(-500, 500), rng.uniform(-500, 500))
        met = [whole for level, x, y, whole in cells if (math.floor(p[0] / 2**level), math.floor(p[1] / 2**level)) == (x, y)]
        assert (len(met) == 1) if holds(legs, p) else (met in ([], [False]))
    shapes = [(1, "a", [[{"x": x, "y": y} for x, y in r] for r in wide]), (2, "b", closed([square(0, 0, 10)])), (3, "c", closed([square(0, 0, 10)])), (4, "d", None), (5, "e", [])]
    df = spark.createDataFrame(shapes, KIND)
    points = [(i, rng.uniform(-500, 500), rng.uniform(-500, 500)) for i in range(300)] + [(900, 5.0, 5.0), (900, 5.0, 5.0), (901, 10.0, 10.0), (902, 0.0, 3.0), (903, None, 1.0)]
    table = spark.createDataFrame(points, "id int, x double, y double")
    wanted = sorted((i, k) for i, x, y in points if x is not None for k, _, g in shapes if g and holds(legs_of([[(p["x"], p["y"]) for p in r] for r in g]), (x, y)))
    assert sorted((r.l.id, r.r.id) for r in sj.points_in_polygons(table, df, 1.0).collect()) == wanted and len(wanted) > 60
    once = sj.points_in_polygons(table, df, 1.0, how="left_semi").collect()
    assert sorted(r.l.id for r in once) == sorted(i for i, x, y in points if i in {a for a, _ in wanted})
    none = sj.points_in_polygons(table, df, 1.0, how="left_anti").collect()
    assert sorted(r.l.id for r in none) == sorted(i for i, x, y in points if i not in {a for a, _ in wanted})
    assert sj.points_in_polygons(table, df.limit(0), 1.0).collect() == []
    assert sj.points_in_polygons(table, df.limit(0), 1.0, how="left_anti").count() == len(points)
