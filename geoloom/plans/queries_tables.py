"""Further operators as queries: routing and selection of tables, slope profiles, rasters, subdivision, JSON text."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoloom.functions import collections as fc, geometry as geo, overlay
from geoloom.operators import buildings, networks, rasters, selection
from geoloom.plans.queries import XY, coordinates, query, table
from geoloom.plans.queries_more import WHOLE, _whole


@query("""
SELECT 'c' || c_custkey AS id, (c_nationkey % 6)::VARCHAR AS category FROM customer WHERE c_nationkey % 6 IN (0, 2)
UNION ALL SELECT 's' || s_suppkey, (s_nationkey % 6)::VARCHAR FROM supplier WHERE s_nationkey % 6 IN (1, 3)
""")
def routed_sources(spark, sf_dir):
    """Each category from the table of its subscribed source; an excluded, an unknown and a missing one (SUB-05)."""
    rules = [("0", "C", "subscribe"), ("2", "C", "subscribe"), ("2", "S", "subscribe"), ("1", "S", "subscribe"), ("3", "S", "subscribe"), ("4", "C", "exclude"), ("5", "other", "subscribe")]
    c = table(spark, sf_dir, "customer").select(F.concat(F.lit("c"), "c_custkey").alias("id"), (F.col("c_nationkey") % 6).cast("string").alias("category"))
    s = table(spark, sf_dir, "supplier").select(F.concat(F.lit("s"), "s_suppkey").alias("id"), (F.col("s_nationkey") % 6).cast("string").alias("category"))
    return selection.routed(spark.createDataFrame(rules, "category string, source string, rule string"), {"C": c, "S": s}).select("id", "category")


@query("""
SELECT p_partkey::VARCHAR AS name, p_brand AS category, CASE WHEN p_size % 3 = 0 THEN NULL ELSE p_size || '|' || p_size + 1 END AS others, CASE WHEN p_size % 2 = 0 THEN p_type END AS tag FROM part
""")
def curated_tables(spark, sf_dir):
    """Curated points with the columns of their kind (SUB-07, STR-07)."""
    size = F.col("p_size")
    rows = table(spark, sf_dir, "part").select(
        F.col("p_partkey").cast("string").alias("name"), F.col("p_brand").alias("category"), F.lit("x").alias("geom"), F.lit("left out").alias("extra"),
        F.when(size % 3 != 0, F.concat_ws(",", size.cast("string"), (size + 1).cast("string"))).alias("other_categories"),
        F.when(size % 2 == 0, F.to_json(F.struct(F.col("p_type").alias("kind")))).alias("tags"),
        *[F.lit(None).cast("string").alias(c) for c in ("operator", *selection.COMMON) if c != "name"],
    )
    return selection.curated(rows, "standard").select("name", "category", F.array_join("other_categories", "|").alias("others"), F.col("tags")["kind"].alias("tag"))


def _areas(spark, sf_dir):
    """Squares of 200 by 200 around the coordinates of nations."""
    n = _whole(table(spark, sf_dir, "nation").select("n_nationkey"), "n_nationkey")
    x, y = F.col("x"), F.col("y")
    ring = F.array(geo.point(x, y), geo.point(x + 200, y), geo.point(x + 200, y + 200), geo.point(x, y + 200), geo.point(x, y))
    return n.select(F.col("n_nationkey").cast("long").alias("id"), F.array(ring).alias("geom"))


def _streets(spark, sf_dir):
    """Lines of 100 by 50 from the coordinates of customers."""
    c = _whole(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey")
    line = F.array(geo.point(F.col("x"), F.col("y")), geo.point(F.col("x") + 100, F.col("y") + 50))
    return c.select(F.col("c_custkey").alias("id"), (F.col("c_custkey") * 2).alias("source"), (F.col("c_custkey") * 2 + 3).alias("target"), line.alias("geom"))


AREAS = f"""n AS (SELECT n_nationkey, {XY.format(k="n_nationkey")} FROM nation), a AS (SELECT n_nationkey, {WHOLE.format(t="n")} FROM n),
c0 AS (SELECT c_custkey, {XY.format(k="c_custkey")} FROM customer), c AS (SELECT c_custkey, {WHOLE.format(t="c0")} FROM c0),
e AS (SELECT DISTINCT c_custkey FROM c JOIN a ON greatest(0, a.x - c.x, 2 * (a.y - c.y)) <= least(100, a.x + 200 - c.x, 2 * (a.y + 200 - c.y)))"""


@query(f"WITH {AREAS} SELECT c_custkey AS id FROM e")
def selected_edges(spark, sf_dir):
    """Lines that meet study areas, each once (MIG-05, GEO-01)."""
    return selection.selected("edge", _streets(spark, sf_dir), _areas(spark, sf_dir), 250.0).select("id")


@query(f"WITH {AREAS} SELECT o_orderkey AS id FROM orders WHERE o_orderkey IN (SELECT 2 * c_custkey FROM e UNION ALL SELECT 2 * c_custkey + 3 FROM e)")
def selected_nodes(spark, sf_dir):
    """Nodes at the ends of the lines that meet study areas (MIG-05, AR-01)."""
    nodes = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("id"))
    return selection.selected("node", nodes, _areas(spark, sf_dir), 250.0, edges=_streets(spark, sf_dir)).select("id")


@query(f"""WITH {AREAS}, b AS (SELECT c_custkey, x, y FROM c)
SELECT DISTINCT c_custkey AS id, b.x + 30 BETWEEN a.x AND a.x + 200 AND b.y + 30 BETWEEN a.y AND a.y + 200 AS central
FROM b JOIN a ON b.x <= a.x + 200 AND b.x + 60 >= a.x AND b.y <= a.y + 200 AND b.y + 60 >= a.y
QUALIFY bool_or(b.x + 30 BETWEEN a.x AND a.x + 200 AND b.y + 30 BETWEEN a.y AND a.y + 200) OVER (PARTITION BY c_custkey) = central
""")
def selected_buildings(spark, sf_dir):
    """Polygons that meet study areas, and whether one holds their centroid (MIG-05, GEO-02, GEO-08)."""
    c = _whole(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey")
    x, y = F.col("x"), F.col("y")
    ring = F.array(geo.point(x, y), geo.point(x + 60, y), geo.point(x + 60, y + 60), geo.point(x, y + 60), geo.point(x, y))
    rows, areas = c.select(F.col("c_custkey").alias("id"), F.array(ring).alias("geom")), _areas(spark, sf_dir)
    return selection.meeting(rows, areas, "id", 250.0).select(F.col("row_id").alias("id"), F.col("held").alias("central"))


@query("""
SELECT s_suppkey AS id, s_name AS name FROM supplier WHERE s_nationkey > 3
UNION ALL SELECT p_partkey, p_name FROM part WHERE p_partkey NOT IN (SELECT s_suppkey FROM supplier)
""")
def network_inserted(spark, sf_dir):
    """A network table without its scenarios, with the rows that are new (MIG-08)."""
    old = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"), F.when(F.col("s_nationkey") <= 3, F.col("s_nationkey")).alias("scenario_id"))
    new = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name"))
    return selection.network_inserted(old, new).select("id", "name")


@query("""
SELECT p_partkey, CASE WHEN p_size > 5 THEN p_size END AS maxspeed, CASE WHEN p_size > 5 THEN 'p' ELSE 'e' END AS preparation_status FROM part
""")
def way_status(spark, sf_dir):
    """Rows that fail keep no results and don't stop the others (NET-03)."""
    rows = table(spark, sf_dir, "part").withColumn("maxspeed", F.col("p_size"))
    return networks.with_status(rows, F.col("maxspeed") > 5, ["maxspeed"]).select("p_partkey", "maxspeed", "preparation_status")


@query(f"""
WITH c AS (SELECT c_custkey, CASE c_custkey % 6 WHEN 0 THEN 10 WHEN 1 THEN 15 WHEN 2 THEN 20 WHEN 3 THEN 25 WHEN 4 THEN 30 ELSE 6 END::DOUBLE AS len, {XY.format(k="c_custkey")} FROM customer),
s AS (SELECT s_suppkey, CASE WHEN s_suppkey % 3 = 0 THEN 5 ELSE s_acctbal / 1000 END AS val, {XY.format(k="s_suppkey")} FROM supplier),
a AS (SELECT *, CASE WHEN len > 20 THEN list_transform(range(0, ceil(len / 10)::BIGINT), lambda i: i * 10 / len) || [1.0] WHEN len > 10 AND len < 20 THEN [0.0, 0.5, 1.0] ELSE [0.0, 1.0] END AS shares FROM c),
p AS (SELECT c_custkey, len, i, len(shares) AS parts, shares[i] AS share, x + shares[i] AS x, y FROM a, range(1, 6) r(i) WHERE i <= len(shares)),
n AS (SELECT c_custkey, i, sqrt(pow(p.x - s.x, 2) + pow(p.y - s.y, 2)) AS d, s_suppkey, val FROM p JOIN s ON pow(p.x - s.x, 2) + pow(p.y - s.y, 2) <= 4),
t AS (SELECT * FROM n QUALIFY row_number() OVER (PARTITION BY c_custkey, i ORDER BY d, s_suppkey) <= 3),
h AS (SELECT c_custkey, i, coalesce(max(CASE WHEN d = 0 THEN val END), sum(CASE WHEN d > 0 THEN val / d END) / sum(CASE WHEN d > 0 THEN 1 / d END)) AS h FROM t GROUP BY ALL),
q AS (SELECT c_custkey, i, share, len, parts, h FROM p JOIN h USING (c_custkey, i)),
g AS (SELECT a.c_custkey, a.parts, b.share - a.share AS part, (b.h - a.h) / ((b.share - a.share) * a.len) * 100 AS slope, count(*) OVER (PARTITION BY a.c_custkey) AS n FROM q a JOIN q b ON a.c_custkey = b.c_custkey AND b.i = a.i + 1),
f AS (SELECT c_custkey, sum(part * CASE WHEN slope > 9 THEN 3 WHEN slope >= 0 THEN 1 + slope * 0.0430815 WHEN slope >= -9 THEN 1 + slope * 0.0363248 ELSE 0.65 END) - 1 AS up,
  sum(part * CASE WHEN -slope > 9 THEN 3 WHEN -slope >= 0 THEN 1 - slope * 0.0430815 WHEN -slope >= -9 THEN 1 - slope * 0.0363248 ELSE 0.65 END) - 1 AS down FROM g WHERE n = parts - 1 GROUP BY ALL)
SELECT c_custkey AS id, round(up, 5) + 0.0 AS up, round(down, 5) + 0.0 AS down FROM customer LEFT JOIN f USING (c_custkey)
""")
def slope_profiles(spark, sf_dir):
    """Heights sampled along lines of six lengths, below, at and above the interval and twice of it, and their effort in both
    directions (NET-04, NET-12, JN-14)."""
    kind = F.col("c_custkey") % 6
    metres = F.when(kind == 0, 10.0).when(kind == 1, 15.0).when(kind == 2, 20.0).when(kind == 3, 25.0).when(kind == 4, 30.0).otherwise(6.0)
    c = coordinates(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey")
    line = F.array(geo.point(F.col("x"), F.col("y")), geo.point(F.col("x") + 1, F.col("y")))
    segments = c.select(F.col("c_custkey").alias("id"), line.alias("geom"), metres.alias("length_m"))
    value = F.when(F.col("s_suppkey") % 3 == 0, 5.0).otherwise(F.col("s_acctbal") / 1000)
    heights = coordinates(table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("pixel"), value.alias("val")), "pixel")
    out = networks.slope_profile(segments, heights, 2.0)
    return out.select("id", (F.round("impedance_slope", 5) + F.lit(0.0)).alias("up"), (F.round("impedance_slope_reverse", 5) + F.lit(0.0)).alias("down"))


@query(f"""
WITH s AS (SELECT s_suppkey AS k, {XY.format(k="s_suppkey")} FROM supplier),
parts AS (SELECT k, y, 'r' || k || '_sub_1' AS sub, x AS a, x + 0.75 AS b, 'c' || k || '_0' AS source, 'c' || k || '_1' AS target FROM s WHERE k % 4 <> 0
  UNION ALL SELECT k, y, 'r' || k || '_sub_2', x + 0.75, x + 2.25, 'c' || k || '_1', 'c' || k || '_2' FROM s WHERE k % 4 <> 0
  UNION ALL SELECT k, y, 'r' || k, x, x + 2.25, 'c' || k || '_0', 'c' || k || '_2' FROM s WHERE k % 4 = 0),
cuts AS (SELECT k, y, sub, source, target, unnest(list_distinct([a, b] || list_transform(range(floor(a)::BIGINT + 1, ceil(b)::BIGINT), lambda g: g::DOUBLE))) AS t FROM parts),
legs AS (SELECT *, lead(t) OVER w AS u, row_number() OVER w AS i, count(*) OVER (PARTITION BY sub) - 1 AS n FROM cuts WINDOW w AS (PARTITION BY sub ORDER BY t)),
named AS (SELECT *, sub || CASE WHEN n > 1 THEN '_clip_' || i ELSE '' END AS name, CASE WHEN i = 1 THEN source ELSE 'connector.' || sub || '_clip_' || (i - 1) END AS s, CASE WHEN i = n THEN target ELSE 'connector.' || sub || '_clip_' || i END AS e FROM legs WHERE u IS NOT NULL),
nodes AS (SELECT name, row_number() OVER (ORDER BY name) AS id FROM (SELECT s AS name FROM named UNION SELECT e FROM named))
SELECT row_number() OVER (ORDER BY n.name) AS id, n.name, p.id AS source, q.id AS target, CASE k % 3 WHEN 0 THEN 'primary' WHEN 1 THEN 'path' END AS class_, CASE WHEN k % 3 = 2 THEN NULL WHEN k % 2 = 0 THEN 0.3 END::DOUBLE AS impedance_surface,
       CASE WHEN k % 3 <> 2 THEN k % 5 * 10 END::INTEGER AS maxspeed_forward, round(6378137 * radians(u - t), 3) AS length_3857, floor((t + u) / 2)::BIGINT AS fine_x, floor((t + u) / 8)::BIGINT AS coarse_x
FROM named n JOIN nodes p ON p.name = n.s JOIN nodes q ON q.name = n.e
""")
def overture_segments(spark, sf_dir):
    """Segments split at connectors, clipped at two grids, attributed and numbered with their connectors (NET-09 to NET-12, API-15)."""
    s = coordinates(table(spark, sf_dir, "supplier").select("s_suppkey"), "s_suppkey")
    k, x, y = F.col("s_suppkey"), F.col("x"), F.col("y")
    name = lambda i: F.concat(F.lit("c"), k.cast("string"), F.lit(f"_{i}"))
    road = F.when(k % 3 != 2, F.to_json(F.struct(F.when(k % 3 == 0, "primary").otherwise("path").alias("class"), F.when(k % 2 == 0, "gravel").otherwise("paved").alias("surface"), F.struct(F.struct(F.array(k % 5 * 10).alias("maxSpeed")).alias("speedLimits")).alias("restrictions"))))
    line = F.array(geo.point(x, y), geo.point(x + 1, y), geo.point(x + 2.25, y))
    segments = s.select(F.concat(F.lit("r"), k.cast("string")).alias("id"), F.when(k % 4 == 0, F.array(name(0), name(2))).otherwise(F.array(name(0), name(1), name(2))).alias("connectors"), line.alias("geom"), road.alias("road"))
    places = F.array(*[F.struct(name(i).alias("id"), geo.point(x + far, y).alias("geom")) for i, far in enumerate((0.0, 0.75, 2.25))])
    connectors = s.select(F.explode(places).alias("c")).select("c.*")
    out, _ = networks.prepared_segments(segments, connectors, {"gravel": 0.3}, 1.0, 4.0)
    return out.select("id", "name", "source", "target", "class_", "impedance_surface", "maxspeed_forward", F.round("length_3857", 3).alias("length_3857"), "fine_x", "coarse_x")


@query("""
SELECT s_suppkey, CASE WHEN s_suppkey % 2 = 0 THEN 16.0 ELSE 16.0 - 2.25 END::DOUBLE AS area, CASE WHEN s_suppkey % 2 = 0 THEN 0 ELSE 1 END AS holes, (s_suppkey % 5 * 3 + 2)::DOUBLE AS height, CASE WHEN s_suppkey % 5 * 3 + 2 > 3.5 THEN floor((s_suppkey % 5 * 3 + 2) / 3.5) ELSE 1 END::INTEGER AS levels FROM supplier
""")
def building_footprints(spark, sf_dir):
    """Outlines of four surfaces around a gap, which is closed where it is small, with height and levels (BLD-10, AG-14)."""
    s = coordinates(table(spark, sf_dir, "supplier").select("s_suppkey"), "s_suppkey")
    k, x, y = F.col("s_suppkey"), F.round(F.col("x")), F.round(F.col("y"))
    gap = F.when(k % 2 == 0, 0.5).otherwise(1.5)
    low, high = 2 - gap / 2, 2 + gap / 2
    sides = [(x, y, F.lit(4.0), low), (x, y + high, F.lit(4.0), 4 - high), (x, y, low, F.lit(4.0)), (x + high, y, 4 - high, F.lit(4.0))]
    parts = F.explode(F.array(*[F.struct(F.array(_box(*side)).alias("geom"), (k % 5 * 3 + 2 - i).cast("double").alias("height")) for i, side in enumerate(sides)]))
    out = buildings.footprints(s.select("s_suppkey", parts.alias("p")).select("s_suppkey", "p.*"), "s_suppkey", 8.0)
    return out.select("s_suppkey", F.round(overlay.total_area(F.col("geom")), 6).alias("area"), (F.size(F.flatten("geom")) - F.size("geom")).alias("holes"), "height", F.col("building_levels").cast("int").alias("levels"))


@query("""
SELECT c_custkey AS id, c_name AS name FROM customer WHERE c_nationkey % 5 <> 0 AND c_custkey NOT IN (SELECT s_suppkey FROM supplier) UNION ALL SELECT s_suppkey, s_name FROM supplier WHERE s_suppkey NOT IN (SELECT c_custkey FROM customer WHERE c_nationkey % 5 <> 0)
UNION ALL SELECT c_custkey, c_name FROM customer JOIN supplier ON s_suppkey = c_custkey WHERE c_nationkey % 5 <> 0
""")
def replaced_buildings(spark, sf_dir):
    """Rows outside the replaced states, and the new ones whose id isn't taken (BLD-11)."""
    old = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("id"), F.col("c_name").alias("name"), (F.col("c_nationkey") % 5 == 0).alias("inside"))
    new = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"), F.col("s_name").alias("name"))
    return buildings.replaced_inside(old, new, "id", F.col("inside")).select("id", "name")


@query(f"""WITH {AREAS}, e0 AS (SELECT c_custkey AS k, x, y FROM c), hit AS (SELECT DISTINCT k FROM e0 JOIN a ON e0.x BETWEEN a.x AND a.x + 200 AND e0.y BETWEEN a.y AND a.y + 200),
ways AS (SELECT o_orderkey AS k, [o_custkey, o_custkey % 7 + 1] AS refs FROM orders), w AS (SELECT k, refs FROM ways WHERE refs[1] IN (FROM hit) OR refs[2] IN (FROM hit)),
taken AS (FROM hit UNION SELECT unnest(refs) FROM w)
SELECT 'node' AS kind, count(*) AS n, sum(k)::BIGINT AS ids FROM taken UNION ALL SELECT 'way', count(*), sum(k)::BIGINT FROM w
UNION ALL SELECT 'relation', count(*), sum(n_nationkey)::BIGINT FROM nation WHERE n_nationkey + 1 IN (FROM taken)
""")
def cropped_extract(spark, sf_dir):
    """Nodes inside areas, ways with one of them and all their nodes, relations with such a member (NET-18, SRC-09)."""
    from geoloom.sources import map_extracts

    c = _whole(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey")
    none = lambda name, kind: F.lit(None).cast(kind).alias(name)
    tags, refs, members = none("tags", "map<string,string>"), none("refs", "array<bigint>"), none("members", "array<struct<kind:string,id:bigint,role:string>>")
    nodes = c.select(F.lit("node").alias("kind"), F.col("c_custkey").alias("id"), tags, "x", "y", refs, members)
    ways = table(spark, sf_dir, "orders").select(F.lit("way").alias("kind"), F.col("o_orderkey").alias("id"), tags, none("x", "double"), none("y", "double"), F.array("o_custkey", F.col("o_custkey") % 7 + 1).alias("refs"), members)
    member = F.array(F.struct(F.lit("node").alias("kind"), (F.col("n_nationkey").cast("long") + 1).alias("id"), F.lit("").alias("role")))
    relations = table(spark, sf_dir, "nation").select(F.lit("relation").alias("kind"), F.col("n_nationkey").cast("long").alias("id"), tags, none("x", "double"), none("y", "double"), refs, member.alias("members"))
    out = map_extracts.cropped(nodes.unionByName(ways).unionByName(relations), _areas(spark, sf_dir), 50.0)
    return out.groupBy("kind").agg(F.count(F.lit(1)).alias("n"), F.sum("id").alias("ids"))


@query(f"""WITH {AREAS}, b0 AS (SELECT s_suppkey, s_nationkey, {XY.format(k="s_suppkey")} FROM supplier), b AS (SELECT s_suppkey, s_nationkey, {WHOLE.format(t="b0")} FROM b0),
m AS (SELECT s_suppkey, s_nationkey, (SELECT count(*) FROM c WHERE c.x BETWEEN b.x AND b.x + 60 AND c.y BETWEEN b.y AND b.y + 60) AS n,
  (SELECT least(1, sum(greatest(0, least(b.x + 60, a.x + 200) - greatest(b.x, a.x)) * greatest(0, least(b.y + 60, a.y + 200) - greatest(b.y, a.y))) / 3600.0) FROM a) AS share FROM b),
s AS (SELECT s_suppkey, n, CASE WHEN s_nationkey IN (1, 2) THEN 'no_residents' WHEN n >= 8 THEN 'shops' WHEN share >= 0.5 THEN 'mixed' ELSE 'with_residents' END AS status, CASE WHEN s_nationkey IN (1, 2) THEN 'attribute:kind' WHEN n >= 8 THEN 'points:shop' WHEN share >= 0.5 THEN 'share:zone' ELSE 'default' END AS rule FROM m)
SELECT s_suppkey, rule, greatest(s_suppkey % 9 - n, 0)::INTEGER AS levels, CASE WHEN greatest(s_suppkey % 9 - n, 0) = 0 THEN 'no_residents' ELSE status END AS status FROM s""")
def classified_buildings(spark, sf_dir):
    """Buildings by attribute, points inside and share under zones, less the levels that shops take (BLD-02 to BLD-06, API-10)."""
    s = _whole(table(spark, sf_dir, "supplier").select("s_suppkey", "s_nationkey"), "s_suppkey")
    rows = s.select(F.col("s_suppkey").alias("id"), F.col("s_nationkey").alias("kind"), (F.col("s_suppkey") % 9).cast("int").alias("building_levels"), F.array(_box(F.col("x"), F.col("y"), 60, 60)).alias("geom"))
    shops = _whole(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey").select("x", "y")
    rules = [{"attribute": "kind", "values": [1, 2]}, {"points": "shop", "count": 8, "status": "shops"}, {"polygons": "zone", "share": 0.5, "status": "mixed"}]
    out = buildings.classified(rows, rules, {"shop": shops, "zone": _areas(spark, sf_dir)}, 250.0, "shop")
    return out.select(F.col("id").alias("s_suppkey"), F.col("matched_rule").alias("rule"), F.col("building_levels_residential").cast("int").alias("levels"), F.col("residential_status").alias("status"))


@query("SELECT s_suppkey, true AS small, round(20 * 2 * sin(pi() / 20) - 0.25, 6) AS area, 1 AS holes FROM supplier")
def subdivided_polygons(spark, sf_dir):
    """Stars of forty corners around a square hole, in pieces of twenty corners at most, which cover them (GEO-17)."""
    s = _spread(coordinates(table(spark, sf_dir, "supplier").select("s_suppkey"), "s_suppkey"))
    far = lambda i: 1 + i % 2
    angle = lambda i: i * F.lit(3.141592653589793) / 20
    ring = F.transform(F.sequence(F.lit(0), F.lit(40)), lambda i: geo.point(F.col("x") + far(i) * F.cos(angle(i)), F.col("y") + far(i) * F.sin(angle(i))))
    hole = _box(F.col("x") - 0.25, F.col("y") - 0.25, 0.5, 0.5)
    polygon = s.select("s_suppkey", F.array(ring, hole).alias("geom"))
    pieces = buildings.subdivided(polygon, "s_suppkey")
    corners = F.aggregate("geom", F.lit(0), lambda t, r: t + F.size(r) - 1)
    return pieces.join(polygon.select("s_suppkey", (F.size("geom") - 1).alias("holes")), "s_suppkey").groupBy("s_suppkey").agg(F.bool_and(corners <= 20).alias("small"), F.round(F.sum(geo.area(F.col("geom"))), 6).alias("area"), F.max("holes").alias("holes"))


def _box(x, y, width, height):
    """A closed rectangle as a ring."""
    return F.array(geo.point(x, y), geo.point(x + width, y), geo.point(x + width, y + height), geo.point(x, y + height), geo.point(x, y))


def _spread(rows, *alike):
    """Rows of a small table over as many partitions as a shuffle has: each takes long. Rows alike in columns go to one."""
    return rows.repartition(max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))), *alike)


def _frames_and_combs(spark, sf_dir):
    """Square frames, 4 wide with a hole of 2, each with a comb of three teeth that lies over it somewhere, in halves; no other
    comb comes near it."""
    s = _spread(coordinates(table(spark, sf_dir, "supplier").select("s_suppkey"), "s_suppkey"))
    k, x, y = F.col("s_suppkey"), F.round(F.col("x")) + F.col("s_suppkey") * 32.0, F.round(F.col("y"))
    a, b = x + (k % 9 - 4) / 2.0, y + (k % 7 - 3) / 2.0
    corners = [(0, 0), (5, 0), (5, 4), (4, 4), (4, 1), (3, 1), (3, 4), (2, 4), (2, 1), (1, 1), (1, 4), (0, 4), (0, 0)]
    comb = F.array(*[geo.point(a + u, b + v) for u, v in corners])
    return s.select("s_suppkey", F.array(_box(x, y, 4, 4), _box(x + 1, y + 1, 2, 2)).alias("frame"), F.array(comb).alias("comb"))


#: Half squares of frames (f) and combs (c) around the lower left corner of the frame.
FRAMES_AND_COMBS = """halves AS (SELECT s_suppkey, i, j, i BETWEEN 0 AND 7 AND j BETWEEN 0 AND 7 AND NOT (i BETWEEN 2 AND 5 AND j BETWEEN 2 AND 5) AS f, i - (s_suppkey % 9 - 4) AS u, j - (s_suppkey % 7 - 3) AS v,
  u BETWEEN 0 AND 9 AND v BETWEEN 0 AND 7 AND (v < 2 OR u % 4 < 2) AS c FROM supplier, range(-8, 24) a(i), range(-8, 24) b(j))"""


@query(f"WITH {FRAMES_AND_COMBS} SELECT s_suppkey, count_if(f AND c) / 4.0 AS shared, count_if(f OR c) / 4.0 AS both, count_if(f AND NOT c) / 4.0 AS frame_only, count_if(f <> c) / 4.0 AS either FROM halves GROUP BY s_suppkey")
def polygon_overlay(spark, sf_dir):
    """Intersection, union and differences of concave polygons with holes that share edges and corners (GEO-09)."""
    rows = _frames_and_combs(spark, sf_dir)
    size = lambda operation: F.round(overlay.total_area(overlay.overlaid(F.col("frame"), F.col("comb"), operation)), 6)
    return rows.select("s_suppkey", size("intersection").alias("shared"), size("union").alias("both"), size("difference").alias("frame_only"), size("symmetric_difference").alias("either"))


@query(f"WITH {FRAMES_AND_COMBS} SELECT s_suppkey, s_suppkey AS b_id, count_if(f AND c) / 4.0 AS overlap FROM halves GROUP BY s_suppkey HAVING overlap > 0")
def concave_overlaps(spark, sf_dir):
    """Shares of concave polygons with holes that meet by cell (JN-16, BLD-04)."""
    rows = _frames_and_combs(spark, sf_dir)
    out = buildings.overlaps(rows.select("s_suppkey", F.col("frame").alias("geom")), rows.select("s_suppkey", F.col("comb").alias("geom")), "s_suppkey", "s_suppkey", 4.0)
    return out.select(F.col("a_id").alias("s_suppkey"), "b_id", F.round("overlap", 6).alias("overlap"))


SQUARES = f"""c0 AS (SELECT c_custkey, c_nationkey, c_custkey % 3 AS kind, {XY.format(k="c_custkey")} FROM customer),
c AS (SELECT c_custkey, c_nationkey, kind, round(x * 2)::BIGINT AS i, round(y * 2)::BIGINT AS j FROM c0)"""


def _squares(spark, sf_dir):
    """Squares of three halves around the coordinates of customers, in halves."""
    c = coordinates(table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey"), "c_custkey")
    return c.select(F.col("c_custkey").alias("id"), "c_nationkey", (F.col("c_custkey") % 3).alias("kind"), F.array(_box(F.round(F.col("x") * 2) / 2, F.round(F.col("y") * 2) / 2, 1.5, 1.5)).alias("geom"))


@query(f"""WITH {SQUARES}, q AS (SELECT DISTINCT c_nationkey, i + u AS i, j + v AS j FROM c, range(3) a(u), range(3) b(v)),
g AS (SELECT c_nationkey, i, j, EXISTS (FROM q p WHERE p.c_nationkey = q.c_nationkey AND p.i = q.i + 1 AND p.j = q.j) AS e, EXISTS (FROM q p WHERE p.c_nationkey = q.c_nationkey AND p.i = q.i AND p.j = q.j + 1) AS n FROM q)
SELECT c_nationkey, count(*) / 4.0 AS area, (4 * count(*) - 2 * count_if(e) - 2 * count_if(n)) / 2.0 AS outline FROM g GROUP BY c_nationkey""")
def dissolved_areas(spark, sf_dir):
    """Squares of a nation as one shape: its area and the length of its outlines (AG-14, GEO-09)."""
    out = buildings.dissolved(_squares(spark, sf_dir), "c_nationkey", 2.0)
    outline = F.aggregate(F.flatten("geom"), F.lit(0.0), lambda t, r: t + geo.length(r))
    return out.select("c_nationkey", F.round(overlay.total_area(F.col("geom")), 6).alias("area"), F.round(outline, 6).alias("outline"))


@query(f"""WITH {SQUARES}, s AS (SELECT s_suppkey, round(({{x}}) * 2)::BIGINT AS a, round(({{y}}) * 2)::BIGINT AS b FROM supplier),
m AS (SELECT DISTINCT s_suppkey, kind, c.i + u AS i, c.j + v AS j FROM s, c, range(3) p(u), range(3) q(v) WHERE c.i + u - a BETWEEN 0 AND 1 AND c.j + v - b BETWEEN 0 AND 1)
SELECT s_suppkey, kind, count(*) / 4.0 AS overlap FROM m GROUP BY s_suppkey, kind""".replace("{x}", XY.format(k="s_suppkey").split(" AS x")[0]).replace("{y}", XY.format(k="s_suppkey").split("AS x, ")[1].split(" AS y")[0]))
def covered_by_category(spark, sf_dir):
    """Area of each square that the squares of a category cover together, counted once (BLD-09, JN-16)."""
    s = coordinates(table(spark, sf_dir, "supplier").select("s_suppkey"), "s_suppkey")
    own = s.select("s_suppkey", F.array(_box(F.round(F.col("x") * 2) / 2, F.round(F.col("y") * 2) / 2, 1.0, 1.0)).alias("geom"))
    out = buildings.covered(own, _squares(spark, sf_dir), "s_suppkey", "kind", 2.0)
    return out.select("s_suppkey", "kind", F.round("overlap", 6).alias("overlap"))


@query("""
WITH s AS (SELECT s_suppkey, 0.25 + s_suppkey // 2 % 4 / 4.0 AS d FROM supplier)
SELECT s_suppkey, round(CASE WHEN s_suppkey % 2 = 0 THEN 14 * d + 16 * sin(pi() / 16) * d * d ELSE 14 * d + 1.25 * 16 * sin(pi() / 16) * d * d - d * d END, 6) AS grown FROM s
""")
def buffered_polygons(spark, sf_dir):
    """What rectangles and concave corners grow by with round corners of eight chords a quarter (GEO-09, GTF-14)."""
    s = _spread(coordinates(table(spark, sf_dir, "supplier").select("s_suppkey"), "s_suppkey"), "x", "y").withColumn("d", 0.25 + F.floor(F.col("s_suppkey") / 2) % 4 / 4.0)
    x, y = F.col("x"), F.col("y")
    corner = F.array(*[geo.point(x + u, y + v) for u, v in ((0, 0), (4, 0), (4, 1), (1, 1), (1, 3), (0, 3), (0, 0))])
    shape = F.array(F.when(F.col("s_suppkey") % 2 == 0, _box(x, y, 4, 3)).otherwise(corner))
    return s.select("s_suppkey", F.round(overlay.total_area(overlay.buffered(shape, F.col("d"))) - geo.area(shape), 6).alias("grown"))


@query("""
WITH s AS (SELECT s_suppkey, 0.25 + s_suppkey % 4 / 4.0 AS gap FROM supplier)
SELECT s_suppkey, round(CASE WHEN gap <= 0.5 THEN 2 * gap ELSE 2 * 0.5 END, 6) AS gained FROM s
""")
def snapped_polygons(spark, sf_dir):
    """How far squares grow across a gap towards a wall that surrounds them on the other sides (UTL-03)."""
    s = _spread(coordinates(table(spark, sf_dir, "supplier").select("s_suppkey"), "s_suppkey"), "x", "y").withColumn("gap", 0.25 + F.col("s_suppkey") % 4 / 4.0)
    x, y, gap = F.col("x"), F.col("y"), F.col("gap")
    wall = F.array(_box(x - 3, y - 3, gap + 8, F.lit(8.0)), _box(x, y, gap + 2, F.lit(2.0)))
    own = F.array(_box(x, y, F.lit(2.0), F.lit(2.0)))
    grown = overlay.snapped(own, wall, 0.5, 0.01)
    return s.select("s_suppkey", F.round(overlay.total_area(grown) - 4, 6).alias("gained"))


@query(f"""
WITH s AS (SELECT s_suppkey, round({{x}} * 100) AS x, round({{y}} * 100) AS y FROM supplier),
p AS (SELECT s_suppkey AS rid, i AS pixel, x + (i % 4 + 0.5) * 10 AS x, y - (i // 4 + 0.5) * 20 AS y, s_suppkey + i AS val FROM s, range(12) r(i) WHERE i <> 5)
SELECT rid, pixel, x::DOUBLE AS x, y::DOUBLE AS y, val::DOUBLE AS val, 1 AS bands, 2400.0::DOUBLE AS area FROM p WHERE x BETWEEN 200 AND 700 AND y BETWEEN 100 AND 800
""".replace("{x}", XY.format(k="s_suppkey").split(" AS x")[0]).replace("{y}", XY.format(k="s_suppkey").split("AS x, ")[1].split(" AS y")[0]))
def raster_pixels(spark, sf_dir):
    """Pixel centres of rasters inside an area, bands and outlines (GEO-21)."""
    s = _whole(table(spark, sf_dir, "supplier").select("s_suppkey"), "s_suppkey")
    values = F.transform(F.sequence(F.lit(0), F.lit(11)), lambda i: F.when(i != 5, (F.col("s_suppkey") + i).cast("double")))
    grid = s.select(F.col("s_suppkey").alias("rid"), F.col("x").alias("x0"), F.col("y").alias("y0"), F.lit(10.0).alias("dx"), F.lit(20.0).alias("dy"), F.lit(4).alias("width"), F.lit(3).alias("height"), F.array(values).alias("bands"))
    ring = F.array(*[geo.point(F.lit(x), F.lit(y)) for x, y in ((200.0, 100.0), (700.0, 100.0), (700.0, 800.0), (200.0, 800.0), (200.0, 100.0))])
    inside = rasters.clipped_pixels(grid, spark.range(1).select(F.array(ring).alias("geom")), 400.0)
    about = grid.select(F.col("rid").alias("r"), rasters.band_count(F.col("bands")).alias("bands"), geo.area(rasters.hull(grid)).alias("area"))
    return inside.join(about, F.col("rid") == F.col("r")).select("rid", F.col("pixel").cast("long").alias("pixel"), "x", "y", "val", "bands", "area")


@query("""
WITH e AS (SELECT event_id, event_id % 7 AS k FROM events)
SELECT event_id, CASE k WHEN 0 THEN 'object' WHEN 1 THEN 'array' WHEN 2 THEN 'string' WHEN 3 THEN 'number' WHEN 4 THEN 'boolean' WHEN 5 THEN 'null' END AS kind, CASE WHEN k = 0 THEN event_id % 100 END::INTEGER AS speed, 'a' || event_id AS clean, CASE WHEN k = 0 THEN 'h07_30,h08_00' END AS keys FROM e
""")
def json_texts(spark, sf_dir):
    """Kinds of JSON texts, speeds at a time of day, text without NUL escapes (JS-06, DT-05, JS-10)."""
    k, number = F.col("event_id") % 7, (F.col("event_id") % 100).cast("string")
    text = F.when(k == 0, F.concat(F.lit('{"h07_30":"x","h08_00":'), number, F.lit("}"))).when(k == 1, F.concat(F.lit(" ["), number, F.lit("]"))).when(k == 2, F.lit('"h"')).when(k == 3, F.lit("-1.5")).when(k == 4, F.lit("true")).when(k == 5, F.lit("null")).otherwise(F.lit("{no json"))
    dirty = F.concat(F.lit("a\\u0000"), F.col("event_id").cast("string"))
    return table(spark, sf_dir, "events").select("event_id", fc.json_kind(text).alias("kind"), fc.at_time(F.when(k == 0, text), "08:00").alias("speed"), fc.without_nul(dirty).alias("clean"), F.array_join(fc.json_keys(F.when(k == 6, F.lit("[1]")).otherwise(text)), ",").alias("keys"))
