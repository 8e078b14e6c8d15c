"""Further operators as queries: publishing, stations, networks, geometry, table work."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.functions import cells, collections as fc, geometry as geo, lines, overlay, text as ft
from geoloom.operators import buildings, networks, poi, relational as rel, spatial_joins as sj, transit
from geoloom.plans.queries import XY, coordinates, query, table
from geoloom.sources import readers
from geoloom.streaming import windows

WHOLE = "round(100 * {t}.x) AS x, round(100 * {t}.y) AS y"


def _whole(rows, key):
    return coordinates(rows, key).withColumns({c: F.round(F.col(c) * 100) for c in "xy"})


@query(f"""
WITH s AS (SELECT s_suppkey, {XY.format(k="s_suppkey")} FROM supplier)
SELECT s_suppkey FROM s WHERE s_suppkey % 2 = 0
UNION ALL SELECT s_suppkey FROM s p WHERE s_suppkey % 2 = 1 AND NOT EXISTS (SELECT 1 FROM s o WHERE o.s_suppkey % 2 = 0 AND pow(o.x - p.x, 2) + pow(o.y - p.y, 2) <= 0.25)
""")
def tram_stop_union(spark, sf_dir):
    """Stops, and platforms without a stop near them (POI-11, JN-13)."""
    s = coordinates(table(spark, sf_dir, "supplier").select("s_suppkey"), "s_suppkey")
    return poi.tram_stops(s.where("s_suppkey % 2 = 0"), s.where("s_suppkey % 2 = 1"), 0.5).select("s_suppkey")


@query(f"""
WITH c AS (SELECT c_custkey, CASE WHEN c_custkey % 3 = 0 THEN c_name END AS name, {XY.format(k="c_custkey")} FROM customer), s AS (SELECT s_suppkey, s_name, {XY.format(k="s_suppkey")} FROM supplier),
n AS (SELECT c_custkey, s_name FROM c JOIN s ON pow(c.x - s.x, 2) + pow(c.y - s.y, 2) <= 1 WHERE name IS NULL QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY sqrt(pow(c.x - s.x, 2) + pow(c.y - s.y, 2)), s_suppkey) = 1)
SELECT c_custkey, coalesce(name, s_name) AS name FROM c LEFT JOIN n USING (c_custkey) WHERE coalesce(name, s_name) IS NOT NULL
""")
def named_entrances(spark, sf_dir):
    """Names from the nearest station in reach (POI-13)."""
    c = table(spark, sf_dir, "customer").select("c_custkey", F.when(F.col("c_custkey") % 3 == 0, F.col("c_name")).alias("name"))
    s = table(spark, sf_dir, "supplier").select("s_suppkey", F.col("s_name").alias("name"))
    return poi.named_entrances(coordinates(c, "c_custkey"), coordinates(s, "s_suppkey"), "c_custkey", "s_suppkey", 1.0).select("c_custkey", "name")


@query("""
SELECT event_id, CASE WHEN event_id % 3 = 0 THEN NULL ELSE 'p' || user_id END AS phone, round(value / 100, 6) AS confidence FROM events WHERE event_type <> 'click' AND value / 100 > 0.6
""")
def place_extraction(spark, sf_dir):
    """First entries of JSON arrays, and rows with enough confidence (OVP-01, OVP-02, JS-02)."""
    e = table(spark, sf_dir, "events")
    phones = F.when(F.col("event_id") % 3 == 0, F.lit("[]")).otherwise(F.to_json(F.array(F.concat(F.lit("p"), F.col("user_id")), F.lit("z"))))
    rows = e.select("event_id", F.when(F.col("event_type") != "click", F.col("event_type")).alias("categories"), (F.col("value") / 100).alias("confidence"), phones.alias("phones"), F.lit("[]").alias("websites"), F.lit(None).cast("string").alias("socials"), F.lit('"B"').alias("brand"), F.lit('"n"').alias("names"))
    return poi.places(rows).select("event_id", "phone", F.round("confidence", 6).alias("confidence"))


def _sql_values(rows) -> str:
    """Rows of strings and nulls as a list of SQL values, each numbered."""
    word = lambda x: "NULL" if x is None else "'" + x + "'"
    return ", ".join("(" + ", ".join([str(i), *map(word, r)]) + ")" for i, r in enumerate(rows))


def _dealt(spark, sf_dir, name: str, key: str, rows, columns: str) -> DataFrame:
    """A table's keys, each with one of the rows in turn; `tags` is JSON there and a map here."""
    cases = spark.createDataFrame([(i, *r) for i, r in enumerate(rows)], "case_id long, " + columns)
    found = table(spark, sf_dir, name).select(key).join(cases, F.col(key) % len(rows) == F.col("case_id")).drop("case_id")
    return found.withColumn("tags", F.from_json("tags", "map<string,string>"))


OBJECTS = "leisure string, sport string, amenity string, shop string, name string, osm_type string, tags string"
#: One object for every branch of the rules.
OBJECT_CASES = [
    ("playground", None, None, None, None, "n", "{}"),
    (None, None, "playground", None, None, "w", "{}"),
    (None, None, "bicycle_rental", None, None, "n", "{}"),
    (None, None, "bicycle_rental", "bicycle", None, "n", "{}"),
    (None, None, "bicycle_rental", None, None, "w", "{}"),
    ("fitness_centre", None, None, None, "Yoga and more", "n", "{}"),
    ("fitness_centre", "yoga", None, "sports", None, "n", "{}"),
    ("sports_centre", "fitness", None, None, "Iron", "n", "{}"),
    ("sports_centre", "fitness", None, None, None, "n", "{}"),
    ("sports_centre", "fitness", None, "sports", "City YOGA", "n", "{}"),
    ("sports_centre", "multi", None, None, "Iron", "n", "{}"),
    (None, None, None, None, "Yogahaus", "n", "{}"),
    (None, "yoga", None, None, None, "n", "{}"),
    ("water_park", "swimming", None, None, None, "w", "{}"),
    ("water_park", None, None, None, None, "w", "{}"),
    ("swimming_pool", "swimming", None, None, None, "w", "{}"),
    ("swimming_pool", "yoga", None, None, None, "w", "{}"),
    ("sports_centre", "swimming", None, None, None, "w", "{}"),
    (None, None, None, "farm", None, "n", "{}"),
    (None, None, None, "honey", None, "n", "{}"),
    (None, None, "charging_station", None, None, "n", '{"bicycle":"yes"}'),
    (None, None, "charging_station", None, None, "n", '{"bicycle":"no"}'),
    (None, None, "vending_machine", None, None, "n", '{"vending":"milk"}'),
    (None, None, "vending_machine", None, None, "n", '{"vending":"parking","organic":"potatoes"}'),
    (None, None, "vending_machine", None, None, "n", '{"vending":"fruit"}'),
    (None, None, "monastery", None, None, "w", '{"brand:wikidata":"Q1"}'),
    (None, None, "place_of_worship", None, None, "w", '{"wikidata":"Q1"}'),
    (None, None, "place_of_worship", None, None, "w", "{}"),
]


@query(f"""
WITH cases(k, leisure, sport, amenity, shop, name, osm_type, tags) AS (VALUES {_sql_values(OBJECT_CASES)}),
early AS (
  SELECT *, CASE WHEN leisure = 'water_park' THEN 'water_park'
                 WHEN (sport = 'yoga' OR lower(name) LIKE '%yoga%') AND shop IS NULL THEN 'yoga'
                 WHEN leisure = 'fitness_centre' OR (leisure = 'sports_centre' AND sport = 'fitness' AND lower(name) NOT LIKE '%yoga%') THEN 'gym'
                 WHEN amenity = 'bicycle_rental' AND shop IS NULL AND osm_type = 'n' THEN 'bike_sharing'
                 WHEN leisure = 'playground' OR amenity = 'playground' THEN 'playground' END AS first FROM cases)
SELECT p_partkey, CASE WHEN amenity IN ('monastery', 'place_of_worship') AND contains(tags, 'wikidata') THEN 'religious_site'
                       WHEN amenity = 'vending_machine' AND regexp_matches(tags, 'food|bread|milk|eggs|meat|potato|honey|cheese') THEN 'food_vending_machine'
                       WHEN amenity = 'charging_station' AND contains(tags, 'bicycle":"yes"') THEN 'ebike_charging_station'
                       WHEN amenity = 'charging_station' THEN 'charging_station'
                       WHEN shop IN ('farm', 'honey') THEN 'farm_shop'
                       WHEN sport = 'swimming' THEN 'swimming' ELSE first END AS category
FROM part JOIN early ON k = p_partkey % {len(OBJECT_CASES)} WHERE NOT (coalesce(leisure, '') = 'swimming_pool' AND first IS NULL)
""")
def fixed_rule_cascade(spark, sf_dir):
    """Rules over several tags, the later one counts; unclassified pools go (POI-08, POI-09, FLT-08, FLT-15)."""
    rows = _dealt(spark, sf_dir, "part", "p_partkey", OBJECT_CASES, OBJECTS)
    return poi.fixed_rules(rows, key="p_partkey").select("p_partkey", "category")


STOPS = "highway string, public_transport string, railway string, name string, category string, tags string"
STOP_CASES = [
    ("bus_stop", None, None, "A", None, "{}"),
    ("bus_stop", None, None, None, None, "{}"),
    ("bus_stop", None, None, "A", "gym", "{}"),
    (None, "platform", None, "A", None, '{"bus":"yes"}'),
    (None, "platform", None, "A", None, '{"bus":"no"}'),
    (None, None, "station", "A", "gym", "{}"),
    (None, None, "station", None, None, "{}"),
    (None, None, "station", "A", None, '{"disused":"yes"}'),
    (None, None, "station", "A", None, '{"railway:disused":"station"}'),
    (None, None, "station", "A", None, '{"railway:disused":"station","train":"yes"}'),
    (None, None, "station", "A", None, '{"usage":"tourism","train":"yes"}'),
    (None, None, "station", "A", None, '{"usage":"main"}'),
    (None, None, "stop", "A", None, '{"train":"yes"}'),
    (None, None, "stop", "A", None, "{}"),
    (None, "stop_position", "halt", "A", None, '{"rail":"yes"}'),
    (None, "station", "disused_station", "A", None, '{"train":"yes"}'),
    (None, None, "halt", "A", None, '{"train":"yes"}'),
    (None, None, "subway_entrance", "A", None, "{}"),
    (None, None, "subway_entrance", None, None, "{}"),
]


@query(f"""
WITH cases(k, highway, public_transport, railway, name, category, tags) AS (VALUES {_sql_values(STOP_CASES)}),
t AS (SELECT *, tags::JSON ->> '$.bus' AS bus, tags::JSON ->> '$.train' AS train, tags::JSON ->> '$.rail' AS rail, tags::JSON ->> '$.disused' AS disused,
             tags::JSON ->> '$."railway:disused"' AS was, tags::JSON ->> '$.usage' AS usage FROM cases)
SELECT s_suppkey, CASE WHEN name IS NULL THEN category
    WHEN railway = 'subway_entrance' THEN 'subway_entrance'
    WHEN (railway IN ('stop', 'station', 'stop_position') OR public_transport IN ('stop', 'station', 'stop_position')) AND coalesce(railway NOT IN ('disused_station', 'proposed'), TRUE)
         AND (train = 'yes' OR rail = 'yes') AND disused IS NULL AND (usage <> 'tourism' OR usage IS NULL) THEN 'rail_station'
    WHEN railway = 'station' AND disused IS NULL AND was IS NULL AND (usage <> 'tourism' OR usage IS NULL) THEN 'rail_station'
    WHEN category IS NULL AND (highway = 'bus_stop' OR (public_transport = 'platform' AND bus = 'yes')) THEN 'bus_stop' ELSE category END AS category
FROM supplier JOIN t ON k = s_suppkey % {len(STOP_CASES)}
""")
def stop_rules(spark, sf_dir):
    """Bus stops, rail stations and entrances (POI-10, POI-12)."""
    return poi.stop_rules(_dealt(spark, sf_dir, "supplier", "s_suppkey", STOP_CASES, STOPS)).select("s_suppkey", "category")


@query("""
SELECT c_custkey, trim(c_name) AS name, CASE WHEN c_custkey % 2 = 0 THEN 'c' || c_custkey || '@x.org' END AS email, CASE WHEN c_custkey % 3 = 0 THEN 'https://x.org/' || c_custkey END AS website, CASE WHEN c_custkey % 5 = 0 THEN c_custkey::INTEGER END AS capacity, 'n' || c_nationkey AS brand FROM customer
""")
def standardised_poi(spark, sf_dir):
    """Validated columns and joined tags (POI-15, STR-04, STR-05, STR-10, FLT-06, FLT-07)."""
    k, none = F.col("c_custkey"), F.lit(None).cast("string")
    rows = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("osm_id"), F.lit("n").alias("osm_type"), F.concat(F.lit("  "), F.col("c_name")).alias("name"),
        F.when(k % 2 == 0, F.concat(F.lit("c"), k, F.lit("@x.org"))).otherwise("no mail").alias("email"),
        F.when(k % 3 == 0, F.concat(F.lit("https://x.org/"), k)).otherwise("x.org").alias("website"),
        F.when(k % 5 == 0, k.cast("string")).otherwise("many").alias("capacity"),
        F.concat(F.lit("n"), F.col("c_nationkey")).alias("brand"), F.lit("").alias("origin"), none.alias("organic"), F.create_map(F.lit("a"), F.lit("b")).alias("tags"),
        *[none.alias(c) for c in ("street", "housenumber", "zipcode", "phone", "opening_hours", "operator", "wheelchair")],
    )
    out = poi.standardised(rows)
    key = F.get_json_object(F.col("tags")["extended_source"], "$.osm_id").cast("long")
    return out.select(key.alias("c_custkey"), "name", "email", "website", "capacity", F.col("tags")["brand"].alias("brand"))


@query(f"""
WITH c0 AS (SELECT c_custkey, {XY.format(k="c_custkey")} FROM customer), c AS (SELECT c_custkey, {WHOLE.format(t="c0")} FROM c0),
z0 AS (SELECT n_nationkey, {XY.format(k="(n_nationkey + 1)")} FROM nation), z AS (SELECT n_nationkey, {WHOLE.format(t="z0")} FROM z0),
i AS (SELECT c_custkey, n_nationkey FROM c JOIN z ON abs(c.x - z.x) + abs(c.y - z.y) <= 200)
SELECT c_custkey FROM c WHERE c_custkey IN (SELECT c_custkey FROM i WHERE n_nationkey % 2 = 0) AND c_custkey NOT IN (SELECT c_custkey FROM i WHERE n_nationkey % 5 = 1 AND n_nationkey % 2 = 1)
""")
def subscription_area(spark, sf_dir):
    """Points in subscribed and outside excluded areas (SUB-02, SUB-03, SUB-04, FLT-04)."""
    z = _whole(table(spark, sf_dir, "nation").withColumn("k", F.col("n_nationkey").cast("long") + 1), "k")
    corner = lambda dx, dy: geo.point(F.col("x") + dx, F.col("y") + dy)
    ring = F.array(corner(200, 0), corner(0, 200), corner(-200, 0), corner(0, -200), corner(200, 0))
    rule = F.when(F.col("n_nationkey") % 2 == 0, "subscribe").when(F.col("n_nationkey") % 5 == 1, "exclude")
    areas = z.select(F.array(ring).alias("geom"), rule.alias("rule"))
    return poi.in_area(_whole(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey"), areas, 400.0).select("c_custkey")


@query(f"""
WITH s AS (SELECT s_suppkey, s_nationkey, {XY.format(k="s_suppkey")} FROM supplier)
SELECT floor(x / 5)::BIGINT AS tile, (s_nationkey % 4)::VARCHAR AS stop_name, round(avg(x), 6) AS x, round(avg(y), 6) AS y, count(*)::BIGINT AS n FROM s GROUP BY ALL
""")
def stations_from_orphans(spark, sf_dir):
    """Stops without parents as stations by tile and name (GTF-11, GTF-13, AG-14)."""
    s = coordinates(table(spark, sf_dir, "supplier"), "s_suppkey")
    stops = s.select(F.col("s_suppkey").alias("stop_id"), F.floor(F.col("x") / 5).alias("tile"), (F.col("s_nationkey") % 4).cast("string").alias("stop_name"), "x", "y", F.lit(None).cast("long").alias("parent_station"), F.array(F.lit("bus")).alias("modes"))
    out = transit.stations_from_orphans(stops)
    return out.select("tile", "stop_name", F.round("x", 6).alias("x"), F.round("y", 6).alias("y"), F.size("children").cast("long").alias("n"))


@query("""
WITH m AS (SELECT DISTINCT s_nationkey AS stop_id, CASE s_suppkey % 3 WHEN 0 THEN 'bus' WHEN 1 THEN 'rail' ELSE 'tram' END AS mode FROM supplier)
SELECT stop_id::BIGINT AS stop_id, array_to_string(list_sort(list(mode)), ',') AS modes, CASE WHEN list_contains(list(mode), 'rail') THEN 'rail_station' WHEN list_contains(list(mode), 'tram') THEN 'tram_stop' ELSE 'bus_stop' END AS category FROM m GROUP BY stop_id
""")
def station_classification(spark, sf_dir):
    """Stations with the modes of their stops (GTF-10, JN-21)."""
    s = table(spark, sf_dir, "supplier")
    mode = F.when(F.col("s_suppkey") % 3 == 0, "bus").when(F.col("s_suppkey") % 3 == 1, "rail").otherwise("tram")
    stops = s.select(F.col("s_nationkey").cast("long").alias("parent_station"), F.array(mode).alias("modes"))
    stations = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("stop_id"))
    return transit.classified_stations(stations, stops).select("stop_id", F.array_join("modes", ",").alias("modes"), "category")


@query("""
WITH trips AS (SELECT o_orderkey AS trip_id, o_custkey AS route_id, o_orderkey % 60 AS shape_id, o_custkey % 4 AS route_type, [o_orderstatus = 'O', o_orderstatus = 'F', o_custkey % 2 = 0] AS weekdays FROM orders),
shapes AS (SELECT DISTINCT p_partkey % 50 AS shape_id, p_size % 3 AS cell FROM part),
by_cell AS (SELECT trips.*, cell FROM trips JOIN shapes USING (shape_id)),
stops AS (SELECT l_orderkey AS trip_id, l_partkey % 30 AS stop_id, l_shipdate::DATE AS arrival_time, l_suppkey % 3 AS cell FROM lineitem)
SELECT stop_id, arrival_time, weekdays[1] AS on_weekday, weekdays[2] AS on_saturday, weekdays[3] AS on_sunday, cell, min(trip_id) AS trip_id, arg_min(route_id, trip_id) AS route_id, arg_min(route_type, trip_id) AS route_type
FROM stops JOIN by_cell USING (trip_id, cell) GROUP BY stop_id, arrival_time, weekdays, cell
""")
def optimised_stop_times(spark, sf_dir):
    """Trips dealt to the cells of their shapes, and their stop times without repeats (GTF-07, GTF-08, AG-13)."""
    status, route = F.col("o_orderstatus"), F.col("o_custkey")
    trips = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("trip_id"), route.alias("route_id"), (F.col("o_orderkey") % 60).alias("shape_id"), (route % 4).alias("route_type"), F.array(status == "O", status == "F", route % 2 == 0).alias("weekdays"))
    shapes = table(spark, sf_dir, "part").select((F.col("p_partkey") % 50).alias("shape_id"), (F.col("p_size") % 3).cast("long").alias("cell"))
    stops = table(spark, sf_dir, "lineitem").select(F.col("l_orderkey").alias("trip_id"), (F.col("l_partkey") % 30).alias("stop_id"), F.to_date("l_shipdate").alias("arrival_time"), (F.col("l_suppkey") % 3).alias("cell"))
    w = F.col("weekdays")
    out = transit.optimised_stop_times(stops, transit.trips_by_cell(trips, shapes))
    return out.select("stop_id", "arrival_time", w[0].alias("on_weekday"), w[1].alias("on_saturday"), w[2].alias("on_sunday"), "cell", "trip_id", "route_id", "route_type")


@query("SELECT l_suppkey AS region_id, l_orderkey AS shape_id, l_linenumber AS cell, max(l_extendedprice) - min(l_extendedprice) AS shape_dist_traveled FROM lineitem GROUP BY ALL")
def shape_extent(spark, sf_dir):
    """How far shapes run inside regions and cells (GTF-03, AG-02)."""
    rows = table(spark, sf_dir, "lineitem").select(F.col("l_suppkey").alias("region_id"), F.col("l_orderkey").alias("shape_id"), F.col("l_linenumber").alias("cell"), F.col("l_extendedprice").alias("shape_dist_traveled"))
    return transit.shape_extent(rows)


@query(f"""
WITH s AS (SELECT s_suppkey, {XY.format(k="s_suppkey")} FROM supplier)
SELECT 's' || s_suppkey || '_' || i AS id, CASE i WHEN 0 THEN 'a' ELSE 'm' END AS source, CASE i WHEN 0 THEN 'm' ELSE 'b' END AS target, round(CASE i WHEN 0 THEN 0.25 ELSE 0.75 END * (3 + y), 6) AS length
FROM s, (VALUES (0), (1)) v(i)
""")
def segment_split(spark, sf_dir):
    """Segments cut at connectors (NET-09, GEO-12, AR-02)."""
    s = coordinates(table(spark, sf_dir, "supplier"), "s_suppkey")
    line = F.array(geo.point(F.col("x"), F.col("y")), geo.point(F.col("x") + 3, F.col("y")), geo.point(F.col("x") + 3, F.col("y") + 2 * F.col("y") - F.col("y")))
    share = lambda v, i: F.struct(F.lit(v).alias("share"), F.lit(i).alias("id"))
    rows = s.select(F.concat(F.lit("s"), F.col("s_suppkey")).alias("id"), line.alias("geom"), F.array(share(1.0, "b"), share(0.0, "a"), share(0.25, "m")).alias("shares"))
    return networks.split_at_connectors(rows).select("id", "source", "target", F.round(geo.length(F.col("geom")), 6).alias("length"))


@query(f"""
WITH c AS (SELECT c_custkey, {XY.format(k="c_custkey")} FROM customer),
v AS (SELECT c_custkey, 0 AS j, x + 0.003 AS x, y + 0.007 AS y FROM c
  UNION ALL SELECT c_custkey, 1, x + 0.003 + (c_custkey % 7 - 3), y + 0.007 + (c_custkey % 5 - 2) FROM c
  UNION ALL SELECT c_custkey, 2, x + 0.003 + (c_custkey % 7 - 3) + 0.25, y + 0.007 + (c_custkey % 5 - 2) + 0.125 FROM c
  UNION ALL SELECT c_custkey, 3, x + 0.003 + (c_custkey % 7 - 3) + 0.25 + (c_custkey % 3 - 1) * 1.5, y + 0.007 + (c_custkey % 5 - 2) + 0.125 + 0.75 FROM c),
e AS (SELECT * FROM (SELECT c_custkey, j, x, y, lead(x) OVER w AS x2, lead(y) OVER w AS y2 FROM v WINDOW w AS (PARTITION BY c_custkey ORDER BY j)) WHERE x <> x2 OR y <> y2),
cuts AS (SELECT c_custkey, j, 0.0::DOUBLE AS t FROM e
  UNION SELECT c_custkey, j, (g - x) / (x2 - x) FROM (SELECT *, unnest(range(floor(least(x, x2))::BIGINT + 1, ceil(greatest(x, x2))::BIGINT)) AS g FROM e)
  UNION SELECT c_custkey, j, (g - y) / (y2 - y) FROM (SELECT *, unnest(range(floor(least(y, y2))::BIGINT + 1, ceil(greatest(y, y2))::BIGINT)) AS g FROM e)),
apart AS (SELECT c_custkey, j, t FROM cuts WHERE t < 1 - 1e-12 QUALIFY t = 0 OR t - lag(t) OVER (PARTITION BY c_custkey, j ORDER BY t) > 1e-12),
legs AS (SELECT c_custkey, j, t, lead(t, 1, 1.0::DOUBLE) OVER (PARTITION BY c_custkey, j ORDER BY t) AS u FROM apart),
placed AS (SELECT c_custkey, j, t, floor(x + (x2 - x) * (t + u) / 2)::BIGINT AS cell_x, floor(y + (y2 - y) * (t + u) / 2)::BIGINT AS cell_y, sqrt(pow(x2 - x, 2) + pow(y2 - y, 2)) * (u - t) AS len FROM legs JOIN e USING (c_custkey, j)),
marked AS (SELECT *, (cell_x, cell_y) IS DISTINCT FROM lag((cell_x, cell_y)) OVER (PARTITION BY c_custkey ORDER BY j, t) AS opens FROM placed),
runs AS (SELECT *, count_if(opens) OVER (PARTITION BY c_custkey ORDER BY j, t) AS i FROM marked),
pieces AS (SELECT c_custkey, i, cell_x, cell_y, sum(len) AS len, count(*) OVER (PARTITION BY c_custkey) AS n FROM runs GROUP BY c_custkey, i, cell_x, cell_y)
SELECT 'e' || c_custkey || CASE WHEN n > 1 THEN '_clip_' || i ELSE '' END AS id, CASE WHEN i = 1 THEN 's' ELSE 'connector.e' || c_custkey || '_clip_' || (i - 1) END AS source,
       CASE WHEN i = n THEN 't' ELSE 'connector.e' || c_custkey || '_clip_' || i END AS target, cell_x, cell_y, round(len, 6) AS length
FROM pieces
""")
def grid_clip(spark, sf_dir):
    """Lines of four points, some repeated, cut where they change cells: names, ends, cells and lengths of all pieces (NET-10, GEO-13, WN-01, WN-04)."""
    k = F.col("c_custkey")
    c = coordinates(table(spark, sf_dir, "customer"), "c_custkey")
    x, y = F.col("x") + 0.003, F.col("y") + 0.007
    x2, y2 = x + (k % 7 - 3), y + (k % 5 - 2)
    x3, y3 = x2 + 0.25, y2 + 0.125
    line = F.array(geo.point(x, y), geo.point(x2, y2), geo.point(x3, y3), geo.point(x3 + (k % 3 - 1) * 1.5, y3 + 0.75))
    rows = c.select(F.concat(F.lit("e"), k).alias("id"), F.lit("s").alias("source"), F.lit("t").alias("target"), line.alias("geom"))
    return networks.clipped_to_grid(rows, 1.0).select("id", "source", "target", "cell_x", "cell_y", F.round("length", 6).alias("length"))


#: highway, foot, bicycle, surface and tags of map lines.
WAY_CASES = [
    ("residential", "Yes", "Designated", "Gravel", '{"lit":"Yes","lanes":"2","sidewalk:both:width":"1.5","sidewalk:left:width":"2","sidewalk:right:width":"x","smoothness":"good"}'),
    ("residential", "no", None, "asphalt", '{"sidewalk:left:width":"2.5","lanes":"two","parking":"yes","parking:lane:both":"parallel"}'),
    ("cycleway", "yes", "yes", "sand", '{"segregated":"yes","cycleway":"track","bicycle_road":"yes"}'),
    ("footway", "designated", "no", None, '{"wheelchair":"Limited","sidewalk":"left"}'),
    ("bridleway", "yes", None, "grass", "{}"),
    ("service", "yes", "yes", "asphalt", '{"psv":"designated"}'),
    ("service", "yes", "yes", "asphalt", '{"bus":"yes"}'),
    ("service", "yes", "yes", "asphalt", '{"bus":"no"}'),
    ("Service", "yes", "yes", "asphalt", '{"psv":"yes"}'),
    ("stairs", "yes", "no", "paving", '{"wheelchair":"yes","parking:lane:left":"diagonal","parking:lane:right":"no_stopping"}'),
    ("living_street", "yes", "yes", "sett", '{"sidewalk:both:width":"1,5","sidewalk:left:width":"3"}'),
    ("Living_Street", None, "yes", "SETT", '{"lanes":"1.5"}'),
    (None, "yes", "yes", "sett", '{"psv":"yes"}'),
]
_TAGS = ["bicycle_road", "cycleway", "parking", "segregated", "sidewalk", "smoothness"]


@query(f"""
WITH cases(k, highway, foot, bicycle, surface, tags) AS (VALUES {_sql_values(WAY_CASES)}),
w AS (SELECT p_partkey, p_size % 14 AS k, p_size AS forward, p_size + 5 AS backward, {XY.format(k="p_partkey")} FROM part),
t AS (SELECT w.*, highway, foot, bicycle, surface, tags::JSON ->> '$.psv' AS psv, tags::JSON ->> '$.bus' AS bus, tags::JSON ->> '$.lit' AS lit, tags::JSON ->> '$.lanes' AS lanes, tags::JSON ->> '$.wheelchair' AS chair,
             tags::JSON ->> '$."sidewalk:both:width"' AS w_both, tags::JSON ->> '$."sidewalk:left:width"' AS w_left, tags::JSON ->> '$."sidewalk:right:width"' AS w_right,
             tags::JSON ->> '$."parking:lane:both"' AS p_both, tags::JSON ->> '$."parking:lane:left"' AS p_left, tags::JSON ->> '$."parking:lane:right"' AS p_right,
             {", ".join(f"tags::JSON ->> '$.{x}' AS {x}" for x in _TAGS)}
      FROM w LEFT JOIN cases c ON c.k = w.k)
SELECT p_partkey, CASE WHEN highway = 'service' AND (psv IS NOT NULL OR bus = 'yes') THEN 'no' WHEN highway NOT IN ('bridleway', 'cycleway', 'footway') THEN lower(foot) END AS foot,
       lower(bicycle) AS bicycle, lower(highway) AS highway, lower(surface) AS surface, CASE lower(surface) WHEN 'gravel' THEN 0.3 WHEN 'sand' THEN 0.4 WHEN 'sett' THEN 0.3 END::DOUBLE AS impedance_surface,
       CASE WHEN regexp_matches(w_both, '^[0-9.]*$') THEN try_cast(w_both AS DOUBLE) END AS sidewalk_both_width, CASE WHEN regexp_matches(w_both, '^[0-9.]*$') THEN try_cast(w_left AS DOUBLE) END AS sidewalk_left_width,
       CASE WHEN regexp_matches(w_both, '^[0-9.]*$') THEN try_cast(w_right AS DOUBLE) END AS sidewalk_right_width, lower(lit) AS lit, try_cast(lanes AS DOUBLE) AS lanes,
       CASE WHEN lower(highway) = 'stairs' THEN 'no' ELSE lower(chair) END AS wheelchair, {", ".join(_TAGS)}, p_both AS parking_lane_both, p_left AS parking_lane_left, p_right AS parking_lane_right,
       CASE WHEN lower(highway) = 'living_street' AND forward > 7 THEN 7 ELSE forward END AS maxspeed_forward, CASE WHEN lower(highway) = 'living_street' AND forward > 7 THEN 7 ELSE backward END AS maxspeed_backward,
       round(6378137 * sqrt(pow(radians(0.001), 2) + pow(ln(tan(pi() / 4 + radians(y + 0.001) / 2)) - ln(tan(pi() / 4 + radians(y) / 2)), 2)), 4) AS length_3857
FROM t
""")
def way_attributes(spark, sf_dir):
    """All attributes of ways from their map lines, some without a line (NET-02, CA-02, AR-08)."""
    part = table(spark, sf_dir, "part")
    at = coordinates(part, "p_partkey")
    line = F.array(geo.point(F.col("x"), F.col("y")), geo.point(F.col("x") + 0.001, F.col("y") + 0.001))
    ways = at.select(F.col("p_partkey").alias("gid"), F.col("p_partkey").alias("osm_id"), F.col("p_size").alias("maxspeed_forward"), (F.col("p_size") + 5).alias("maxspeed_backward"), line.alias("geom"))
    cases = [F.struct(*[F.lit(v).cast("string").alias(n) for n, v in zip(("highway", "foot", "bicycle", "surface", "tags"), case, strict=True)]) for case in WAY_CASES]
    rows = part.withColumn("c", F.get(F.array(*cases), F.col("p_size") % 14)).where("c is not null")
    lines = rows.select(F.col("p_partkey").alias("osm_id"), "c.highway", "c.foot", "c.bicycle", "c.surface", F.from_json("c.tags", "map<string,string>").alias("tags"))
    out = networks.classified_ways(ways, lines, {"gravel": 0.3, "sand": 0.4, "sett": 0.3})
    kept = ["foot", "bicycle", "highway", "surface", "impedance_surface", "sidewalk_both_width", "sidewalk_left_width", "sidewalk_right_width", "lit", "lanes", "wheelchair", *_TAGS, "parking_lane_both", "parking_lane_left", "parking_lane_right", "maxspeed_forward", "maxspeed_backward"]
    return out.select(F.col("gid").alias("p_partkey"), *kept, F.round("length_3857", 4).alias("length_3857"))


CROSSING_CASES = [
    ("crossing", '{"crossing_ref":"zebra","crossing":"marked"}'),
    ("crossing", '{"crossing":"pelican"}'),
    ("crossing", "{}"),
    ("traffic_signals", "{}"),
    ("traffic_signals", '{"traffic_signals":"crossing"}'),
    (None, '{"traffic_signals":"pedestrian_crossing","crossing_ref":"toucan"}'),
    (None, '{"traffic_signals":"crossing"}'),
    (None, '{"crossing":"unmarked","kerb":"lowered"}'),
    ("bus_stop", "{}"),
    ("bus_stop", '{"crossing_ref":"zebra"}'),
]


@query(f"""
WITH cases(k, highway, tags) AS (VALUES {_sql_values(CROSSING_CASES)}),
t AS (SELECT *, tags::JSON ->> '$.crossing' AS c, tags::JSON ->> '$.crossing_ref' AS ref, tags::JSON ->> '$.traffic_signals' AS signals, tags::JSON ->> '$.kerb' AS kerb FROM cases)
SELECT s_suppkey, CASE WHEN signals IN ('crossing', 'pedestrian_crossing') THEN 'traffic_signals' WHEN coalesce(ref, c) IS NULL THEN highway ELSE coalesce(ref, c) END AS crossing, kerb
FROM supplier JOIN t ON k = s_suppkey % {len(CROSSING_CASES)} WHERE c IS NOT NULL OR highway IN ('crossing', 'traffic_signals') OR signals = 'pedestrian_crossing'
""")
def crossing_kinds(spark, sf_dir):
    """One kind for each street crossing (NET-06)."""
    rows = _dealt(spark, sf_dir, "supplier", "s_suppkey", CROSSING_CASES, "highway string, tags string")
    return networks.crossings(rows).select("s_suppkey", "crossing", "kerb")


@query(f"""
WITH c AS (SELECT {XY.format(k="c_custkey")} FROM customer UNION SELECT {XY.format(k="s_suppkey")} FROM supplier)
SELECT row_number() OVER (ORDER BY x, y) AS node_id, x, y FROM c
""")
def coordinate_nodes(spark, sf_dir):
    """Distinct coordinates with consecutive ids (NET-15, JN-20, WN-05, ST-02)."""
    c = coordinates(table(spark, sf_dir, "customer"), "c_custkey").select("x", "y")
    s = coordinates(table(spark, sf_dir, "supplier"), "s_suppkey").select("x", "y")
    streets = c.unionByName(s).select(F.array(geo.point(F.col("x"), F.col("y"))).alias("geom"))
    return networks.coordinate_nodes(streets).select("node_id", "x", "y")


@query("""
SELECT c_custkey, greatest(l - s, 0) AS levels, CASE WHEN greatest(l - s, 0) = 0 THEN 'no_residents' ELSE 'with_residents' END AS status, CASE WHEN greatest(l - s, 0) = 0 THEN 0 ELSE 20.0 * greatest(l - s, 0) END::DOUBLE AS area
FROM (SELECT c_custkey, (CASE WHEN h > 3.5 THEN floor(h / 3.5) ELSE 1 END)::INTEGER AS l, (c_custkey % 3)::INTEGER AS s FROM (SELECT c_custkey, (c_custkey % 20)::DOUBLE AS h FROM customer))
""")
def residential_floor_area(spark, sf_dir):
    """Levels from heights, less those in other use, and floor area (BLD-06, BLD-07, MA-04, FLT-09)."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", (F.col("c_custkey") % 20).cast("double").alias("height"), F.lit(None).cast("int").alias("building_levels"), (F.col("c_custkey") % 3).cast("int").alias("shops"), F.lit(20.0).alias("area"), F.lit("with_residents").alias("residential_status"))
    out = buildings.floor_area(buildings.residential_levels(buildings.with_storeys(rows), "shops"))
    return out.select("c_custkey", F.col("building_levels_residential").alias("levels"), F.col("residential_status").alias("status"), F.col("gross_floor_area_residential").alias("area"))


@query(f"""
WITH s AS (SELECT s_suppkey, {XY.format(k="s_suppkey")} FROM supplier)
SELECT s_suppkey, unnest(range(floor(x / 2)::BIGINT, floor((x + 3) / 2)::BIGINT + 1)) AS cx, floor(y / 2)::BIGINT AS cy FROM s
""")
def cover_cells(spark, sf_dir):
    """Cells that an envelope touches (GEO-15, GEO-16, UDF-03; square cells only)."""
    s = coordinates(table(spark, sf_dir, "supplier"), "s_suppkey")
    box = geo.envelope(F.array(geo.point(F.col("x"), F.col("y")), geo.point(F.col("x") + 3, F.col("y"))))
    return s.select("s_suppkey", F.explode(cells.grid_cover(box, 2.0)).alias("c")).select("s_suppkey", "c.cx", "c.cy")


@query(f"""
WITH s AS (SELECT s_suppkey, {XY.format(k="s_suppkey")} FROM supplier)
SELECT s_suppkey, 6.0::DOUBLE AS area, round(x + 4.0::DOUBLE / 3, 4) AS cx, 12.0::DOUBLE AS legs FROM s
""")
def polygon_measures(spark, sf_dir):
    """Area, centroid and outline of triangles (GEO-06, GEO-07, GEO-08, GEO-14)."""
    s = coordinates(table(spark, sf_dir, "supplier"), "s_suppkey")
    x, y = F.col("x"), F.col("y")
    ring = F.array(geo.point(x, y), geo.point(x + 4, y), geo.point(x, y + 3), geo.point(x, y))
    rows = s.select("s_suppkey", F.array(ring).alias("g"))
    return rows.select("s_suppkey", F.round(geo.area(F.col("g")), 4).alias("area"), F.round(geo.centroid(F.col("g")[0])["x"], 4).alias("cx"), F.round(geo.length(F.col("g")[0]), 4).alias("legs"))


@query("""
SELECT c_custkey, CASE WHEN c_mktsegment = 'BUILDING' THEN 'BUILDING' ELSE 'BUILDING' END AS category, CASE WHEN c_mktsegment = 'BUILDING' THEN '' ELSE c_mktsegment END AS others, CASE WHEN c_custkey % 2 = 0 THEN '{"source":"OSM","extended_source":"' || c_custkey || '"}' END AS matching_key FROM customer
""")
def recategorised(spark, sf_dir):
    """Sub-categories under a top-level one, and matching keys (FUS-01, FUS-06, FUS-07, JS-04)."""
    rows = table(spark, sf_dir, "customer").select("c_custkey", F.col("c_mktsegment").alias("category"), F.lit(None).cast("array<string>").alias("other_categories"))
    out = poi.recategorised(rows, "BUILDING")
    key = poi.matching_key(F.lit("OSM"), F.when(F.col("c_custkey") % 2 == 0, F.col("c_custkey").cast("string")))
    return out.select("c_custkey", "category", F.array_join("other_categories", ",").alias("others"), key.alias("matching_key"))


@query("""
SELECT n_nationkey, CASE n_regionkey % 3 WHEN 0 THEN TIMESTAMP '2024-05-01' WHEN 1 THEN TIMESTAMP '2024-04-01' ELSE TIMESTAMP '2024-04-01' END AS source_date FROM nation
""")
def source_dates(spark, sf_dir):
    """Dates of sources, the older of a fused one (SUB-06, DT-06)."""
    source = F.when(F.col("n_regionkey") % 3 == 0, "OSM").when(F.col("n_regionkey") % 3 == 1, "Overture").otherwise("OSM_Overture")
    rows = table(spark, sf_dir, "nation").select("n_nationkey", source.alias("source"), F.lit(None).cast("timestamp").alias("source_date"))
    return poi.source_dates(rows, {"OSM": "2024-05-01", "Overture": "2024-04-01"}).select("n_nationkey", "source_date")


@query("SELECT c_custkey, c_acctbal FROM customer ORDER BY c_acctbal DESC, c_custkey LIMIT 20 OFFSET 10")
def page_of_rows(spark, sf_dir):
    """One page of an order (SO-01)."""
    return table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal").orderBy(F.desc("c_acctbal"), "c_custkey").offset(10).limit(20)


@query("""
SELECT 'duplicate' AS problem, count(*)::BIGINT AS n FROM (SELECT l_orderkey, l_linenumber FROM lineitem GROUP BY ALL HAVING count(*) > 1)
UNION ALL SELECT 'orphan', count(*)::BIGINT FROM orders WHERE NOT EXISTS (SELECT 1 FROM customer WHERE c_custkey = o_custkey AND c_custkey % 2 = 0)
""")
def integrity_checks(spark, sf_dir):
    """Repeated keys and references to nothing (GTF-02, AG-09)."""
    dup = rel.duplicate_keys(table(spark, sf_dir, "lineitem"), ["l_orderkey", "l_linenumber"])
    lost = rel.orphans(table(spark, sf_dir, "orders"), table(spark, sf_dir, "customer").where("c_custkey % 2 = 0"), "o_custkey", "c_custkey")
    return dup.agg(F.count(F.lit(1)).alias("n")).select(F.lit("duplicate").alias("problem"), "n").unionByName(lost.agg(F.count(F.lit(1)).alias("n")).select(F.lit("orphan").alias("problem"), "n"))


@query("""SELECT n_nationkey AS id, '{"name":"' || n_name || '","region":' || n_regionkey || '}' AS place, '["' || n_name || '"]' AS names FROM nation""")
def nested_as_json(spark, sf_dir):
    """Nested columns as JSON (OVC-01, JS-08, FLT-11)."""
    rows = table(spark, sf_dir, "nation").select(F.col("n_nationkey").alias("id"), F.struct(F.col("n_name").alias("name"), F.col("n_regionkey").alias("region")).alias("place"), F.array("n_name").alias("names"))
    return readers.flattened(rows)


@query("SELECT c_custkey AS key, c_name AS name, NULL::DOUBLE AS price FROM customer UNION ALL SELECT p_partkey, NULL, p_retailprice FROM part")
def diagonal_concat(spark, sf_dir):
    """Tables one after the other, missing columns null (ST-04, POI-02, POI-16)."""
    c = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("key"), F.col("c_name").alias("name"))
    p = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("key"), F.col("p_retailprice").alias("price"))
    return c.unionByName(p, allowMissingColumns=True)


@query("SELECT date_trunc('day', ts) AS window_start, event_type, count(*)::BIGINT AS n FROM events GROUP BY ALL")
def daily_windows(spark, sf_dir):
    """Counts by window; the same function serves streams."""
    return windows.windowed_counts(table(spark, sf_dir, "events"), "ts", ["event_type"])


@query("SELECT event_id, CASE WHEN regexp_matches(event_type, '^(click|view)') THEN 'seen' ELSE coalesce(nullif(event_type, 'x'), 'y') END AS kind FROM events WHERE event_type LIKE '%i%' AND (user_id NOT IN (1, 2, 3) OR user_id IS NULL) AND value IS NOT NULL")
def null_tolerant_filters(spark, sf_dir):
    """Patterns, exclusions that keep nulls, and defaults (FLT-02, FLT-06, FLT-07, FLT-09)."""
    u = F.col("user_id")
    rows = table(spark, sf_dir, "events").where(F.col("event_type").like("%i%") & (~u.isin(1, 2, 3) | u.isNull()) & F.col("value").isNotNull())
    return rows.select("event_id", F.when(F.col("event_type").rlike("^(click|view)"), "seen").otherwise(F.coalesce(F.nullif(F.col("event_type"), F.lit("x")), F.lit("y"))).alias("kind"))


CURVE = """list_reduce(list_prepend({'x': least(65535, floor((x - x0) / (x1 - x0) * 65536))::BIGINT, 'y': least(65535, floor((y - y0) / (y1 - y0) * 65536))::BIGINT, 'd': 0::BIGINT, 's': 0::BIGINT},
  list_transform(range(15, -1, -1), lambda b: {'x': 0::BIGINT, 'y': 0::BIGINT, 'd': 0::BIGINT, 's': (1::BIGINT << b)})),
  lambda t, e: {'x': CASE WHEN t.y & e.s > 0 THEN t.x WHEN t.x & e.s > 0 THEN 65535 - t.y ELSE t.y END, 'y': CASE WHEN t.y & e.s > 0 THEN t.y WHEN t.x & e.s > 0 THEN 65535 - t.x ELSE t.x END,
                'd': t.d + e.s * e.s * CASE WHEN t.x & e.s > 0 THEN CASE WHEN t.y & e.s > 0 THEN 2 ELSE 3 END WHEN t.y & e.s > 0 THEN 1 ELSE 0 END, 's': e.s}).d"""


@query(f"""
WITH c AS (SELECT c_custkey, {XY.format(k="c_custkey")} FROM customer), b AS (SELECT min(x) AS x0, max(x) AS x1, min(y) AS y0, max(y) AS y1, count(*) AS n FROM c),
o AS (SELECT c_custkey, n, row_number() OVER (ORDER BY {CURVE}, x, y, c_custkey) - 1 AS i FROM c, b)
SELECT c_custkey, (i * 7 // n)::INTEGER AS unit, count(*) OVER (PARTITION BY i * 7 // n) AS size FROM o
""")
def equal_area_units(spark, sf_dir):
    """Nearby points in groups that differ by one point at most (NET-01, GEO-18, WN-03, SO-07, SO-08)."""
    out = buildings.equal_areas(coordinates(table(spark, sf_dir, "customer"), "c_custkey").select("c_custkey", "x", "y"), 7, "c_custkey")
    sizes = out.groupBy("unit").agg(F.count(F.lit(1)).alias("size"))
    return out.join(sizes, "unit").select("c_custkey", "unit", "size")


@query(f"""
WITH s AS (SELECT n_nationkey, {XY.format(k="(n_nationkey + 1)")} FROM nation), c AS (SELECT c_custkey, x + 0.00317 AS x, y + 0.00519 AS y FROM (SELECT c_custkey, {XY.format(k="c_custkey")} FROM customer))
SELECT c_custkey, arg_min(n_nationkey, pow(c.x - s.x, 2) + pow(c.y - s.y, 2)) AS n_nationkey FROM c, s WHERE c.x < 10 AND c.y < 10 GROUP BY c_custkey
""")
def voronoi_cells(spark, sf_dir):
    """Points in the parts of a square that are nearest to each seed (GEO-18, GTF-14)."""
    seeds = coordinates(table(spark, sf_dir, "nation").select("n_nationkey", (F.col("n_nationkey").cast("long") + 1).alias("k")), "k")
    square = F.array(F.array(*[geo.point(F.lit(x), F.lit(y)) for x, y in ((0.0, 0.0), (10.0, 0.0), (10.0, 10.0), (0.0, 10.0), (0.0, 0.0))]))
    held = seeds.agg(F.array_sort(F.collect_list(F.struct("n_nationkey", geo.point(F.col("x"), F.col("y")).alias("p")))).alias("seeds"))
    cells = held.select("seeds", F.posexplode(overlay.voronoi(F.col("seeds.p"), square)).alias("i", "geom"))
    parts = cells.select(F.get("seeds.n_nationkey", F.col("i")).alias("n_nationkey"), F.explode("geom").alias("geom"))
    moved = coordinates(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey").withColumns({"x": F.col("x") + 0.00317, "y": F.col("y") + 0.00519})
    return sj.points_in_polygons(moved, parts, 2.0).select(F.col("l.c_custkey").alias("c_custkey"), F.col("r.n_nationkey").alias("n_nationkey"))


@query()
def simplified_lines(spark, sf_dir):
    """Lines with fewer points (GEO-19, UDF-07)."""
    p = coordinates(table(spark, sf_dir, "lineitem"), "l_partkey")
    rows = p.groupBy("l_suppkey").agg(F.transform(F.array_sort(F.collect_list(geo.point(F.col("x"), F.col("y")))), lambda s: s).alias("line"))
    return rows.select("l_suppkey", F.size("line").alias("before"), F.size(lines.simplified(F.col("line"), 0.5)).alias("after"))


@query("SELECT event_id, list_extract([user_id, event_id, 7], 3) AS third, CASE WHEN user_id >= event_id AND user_id >= 7 THEN 'a' WHEN event_id >= 7 THEN 'b' ELSE 'c' END AS id FROM events")
def array_operators(spark, sf_dir):
    """Array access and the id of the largest value (AR-02 to AR-04, SO-06)."""
    values = F.array(F.col("user_id"), F.col("event_id"), F.lit(7).cast("long"))
    return table(spark, sf_dir, "events").select("event_id", F.get(values, F.lit(2)).cast("int").alias("third"), fc.id_of_largest(values, F.array(F.lit("a"), F.lit("b"), F.lit("c"))).alias("id"))


@query("SELECT s_suppkey, s_name, ('12.5' || '')::DOUBLE AS number, upper(left(s_name, 5)) AS head FROM supplier")
def string_operators(spark, sf_dir):
    """Text functions and guarded numbers (STR-01, STR-07, CA-01, CA-02)."""
    return table(spark, sf_dir, "supplier").select("s_suppkey", ft.unquoted(F.concat(F.lit('"'), F.col("s_name"), F.lit('"'))).alias("s_name"), ft.guarded_number(F.lit("12.5")).alias("number"), F.upper(F.left("s_name", F.lit(5))).alias("head"))
