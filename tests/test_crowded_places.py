"""Many rows at one place: results by brute force, and as many comparisons as there are different places."""

import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from geoloom.functions import lines, overlay
from geoloom.operators import buildings, networks, poi
from geoloom.operators import spatial_joins as sj


@pytest.fixture
def compared(monkeypatch):
    """Numbers of pairs that joins by distance gave."""
    found, join = [], sj.within_distance

    def counted(*args, **kwargs):
        out = join(*args, **kwargs)
        found.append(out.count())
        return out

    monkeypatch.setattr(sj, "within_distance", counted)
    return found


LEFT = [(i, float(i % 3), 0.0) for i in range(300)] + [(900, None, 1.0), (901, 50.0, 50.0)]
RIGHT = [(i, float(i % 2) + 0.25, 0.0, float(i)) for i in range(200)] + [(300, None, 0.0, 1.0), (301, 2.0, 0.0, 5.0), (302, 2.0, 0.0, 9.0)]


def sides(spark):
    return spark.createDataFrame(LEFT, "id long, x double, y double"), spark.createDataFrame(RIGHT, "rid long, x double, y double, v double")


def brute(most):
    out = {}
    for i, x, y in LEFT:
        near = [(math.hypot(x - a, y - b), rid, v) for rid, a, b, v in RIGHT if x is not None and a is not None and math.hypot(x - a, y - b) <= 1.0]
        out[i] = (len(near), sorted(near)[:most])
    return out


def test_nearest_compares_places_once(spark, compared):
    rows = sj.nearest(*sides(spark), 1.0, "id", "rid", 3).select("l.id", "rank", "distance", "r.rid").collect()
    found = {}
    for r in sorted(rows, key=lambda r: (r.id, r.rank)):
        found.setdefault(r.id, []).append((r.distance, r.rid))
    assert found == {i: [(d, rid) for d, rid, _ in near] for i, (_, near) in brute(3).items() if near}
    assert max(compared) <= 4 * 8


def test_idw_at_crowded_places(spark, compared):
    left, right = sides(spark)
    mean = lambda near: sum(v / d for d, _, v in near) / sum(1 / d for d, _, _ in near)
    for greatest in (False, True):
        found = {r.id: r.value for r in sj.idw(left, right, 1.0, "id", "rid", "v", greatest=greatest).collect()}
        wanted = {i: (max if greatest else min)(v for d, _, v in near if d == 0) if near[0][0] == 0 else mean(near) for i, (_, near) in brute(3).items() if near}
        assert found == pytest.approx(wanted)
    assert max(compared) <= 4 * 8


def test_count_within_counts_places_once(spark, compared):
    found = {r.id: r.n for r in sj.count_within(*sides(spark), 1.0, "id").collect()}
    assert found == {i: n for i, (n, _) in brute(0).items()}
    assert max(compared) <= 4 * 3


def test_greatest_of_pixels_at_a_sample(spark):
    segments = spark.sql("select 1L as id, array(named_struct('x', 0D, 'y', 0D), named_struct('x', 5D, 'y', 0D)) as geom, 5D as length_m")
    pixels = spark.createDataFrame([(1, 0.0, 0.0, 1.0), (2, 0.0, 0.0, 1.5), (3, 5.0, 0.0, 1.6), (4, 5.0, 0.0, 1.0)], "pixel long, x double, y double, val double")
    up = 2.0 * networks.UP_EFFORT
    assert networks.slope_profile(segments, pixels, 1.0).first().impedance_slope == pytest.approx(up)


NAMES = ["red bolt", "red bolts", "cold gear", None]


def named(spark, n, more):
    return spark.createDataFrame([(more + i, NAMES[i % 4], float(i % 3), 0.0) for i in range(n)] + [(more + n, "red bolt", None, 0.0)], "id long, name string, x double, y double")


@pytest.fixture
def matched(monkeypatch):
    """Numbers of pairs that comparisons of names gave."""
    found, join = [], poi.within_distance

    def counted(*args, **kwargs):
        out = join(*args, **kwargs)
        found.append(out.count())
        return out

    monkeypatch.setattr(poi, "within_distance", counted)
    return found


def test_names_at_crowded_places_are_compared_once(spark, matched):
    left, right = named(spark, 240, 0), named(spark, 120, 1000)
    best = {r.l.id: r.r.id for r in poi.best_matches(left, right, 0.5, 0.5).collect()}
    wanted = {}
    for i in range(240):
        if NAMES[i % 4]:
            wanted[i] = next(1000 + j for j in range(120) if j % 3 == i % 3 and NAMES[j % 4] == NAMES[i % 4])
    assert best == wanted
    assert max(matched) <= 3 * 9


@pytest.mark.parametrize("whole", [False, True])
def test_fusion_at_crowded_places(spark, matched, whole):
    left, right = named(spark, 240, 0).where("coalesce(name, '') <> 'cold gear'"), named(spark, 120, 1000)
    out = poi.fused(left, right, 0.5, 0.5, left_all=left if whole else None)
    found = {r.id: r.decision for r in out.collect()}
    own = {i: "kept" if NAMES[i % 4] else "unmatched" for i in range(240) if NAMES[i % 4] != "cold gear"} | {240: "unmatched"}
    new = {1000 + j: "added" for j in range(120) if NAMES[j % 4] in (None, "cold gear")} | {1120: "added"}
    assert found == own | new and out.count() == len(found)
    assert max(matched) <= 3 * 9


def test_simplified_lines_with_points_that_repeat(spark):
    line = [(0.0, 0.0)] * 3 + [(1.0, 0.05)] * 2 + [(2.0, 0.0)] + [(3.0, 2.0)] * 4 + [(4.0, 0.0)] * 3
    cases = [line, None, [], [(1.0, 1.0)] * 3, [(1.0, 1.0)], line[::-1], [(0.0, 0.0), (1.0, 1.0), (0.0, 0.0), (0.0, 0.0)]]
    rows = spark.createDataFrame(list(enumerate(cases)), "i int, g array<struct<x:double,y:double>>").coalesce(1)
    found = {r.i: r.s and [tuple(p) for p in r.s] for r in rows.select("i", lines.simplified(F.col("g"), 0.1).alias("s")).collect()}
    assert found == {i: g and lines.simplified_points(g, 0.1) for i, g in enumerate(cases)}
    assert found[0] == [(0.0, 0.0), (2.0, 0.0), (3.0, 2.0), (4.0, 0.0)] and found[3] == [(1.0, 1.0)] * 2


def test_simplified_lines_are_arrays_in_python():
    import tracemalloc

    xy = np.column_stack([np.arange(200_000.0), np.zeros(200_000)])
    tracemalloc.start()
    assert lines._kept(xy, 0.1).sum() == 2
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 100 * len(xy)


def test_equal_rows_of_a_batch_are_worked_out_once():
    done = []
    work = lambda x, y: done.append((x, y)) or [x, y]
    assert list(overlay.each_once(work, [1, None, 1, 2], [[3], [3], [3], None])) == [[1, [3]], None, [1, [3]], None]
    assert done == [(1, [3])]


def test_cut_lines_are_plain_numbers():
    found = lines.cut_line([0.5, 0.5, 2.5, 2.75], [0.5, 0.5, 0.5, 0.5], 1.0)
    assert found == [(0, 0, [0.5, 1.0], [0.5, 0.5]), (1, 0, [1.0, 2.0], [0.5, 0.5]), (2, 0, [2.0, 2.5, 2.75], [0.5] * 3)]
    assert lines.cut_line([-0.5], [1.5], 1.0) == [(-1, 1, [-0.5], [1.5])]


def test_equal_outlines_meet_points_and_squares_once(spark, monkeypatch):
    met = {"points_in_polygons": [], "_near": []}
    for name, found in met.items():
        join = getattr(buildings, name)
        monkeypatch.setattr(buildings, name, lambda *args, join=join, found=found: (out := join(*args), found.append(out.count()))[0])
    ring = lambda x: [[(x, 0.0), (x + 1, 0.0), (x + 1, 1.0), (x, 1.0), (x, 0.0)]]
    shape = "geom array<array<struct<x:double,y:double>>>"
    rows = spark.createDataFrame([(i, ring(float(i % 2))) for i in range(40)] + [(40, None)], f"id long, {shape}")
    points = spark.createDataFrame([(0.5, 0.5)] * 30 + [(1.5, 0.5)] * 20, "x double, y double")
    assert {r.id: r.n for r in buildings.with_point_count(rows, points, "n", 1.0).collect()} == {i: 20 if i % 2 else 30 for i in range(40)} | {40: 0}
    squares = spark.createDataFrame([(7, ring(0.5))] * 3, f"kind long, {shape}")
    assert {(r.id, r.kind): r.overlap for r in buildings.covered(rows, squares, "id", "kind", 1.0).collect()} == pytest.approx({(i, 7): 0.5 for i in range(40)})
    assert met["points_in_polygons"] == [2] and met["_near"] == [2]
