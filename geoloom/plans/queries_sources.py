"""Readers and writers as queries: tables go out in each format and come back, and SQL over the tables says what has to come."""

from __future__ import annotations

from pyspark.sql import functions as F

from geoloom.functions import geometry as geo
from geoloom.operators import networks, poi, relational as rel
from geoloom.operators.lineage import through_files
from geoloom.plans.queries import XY, coordinates, query, table
from geoloom.sources import readers, writers


@query("""
SELECT 't' || l_orderkey || '_' || l_linenumber AS trip_id, (l_orderkey % 30 * 3600 + l_linenumber * 60 + 5)::INTEGER AS arrival_time, 's' || l_suppkey AS stop_id, l_linenumber AS stop_sequence,
       CASE WHEN l_linenumber % 2 = 0 THEN l_quantity END AS shape_dist_traveled, floor(s_acctbal / 1000 / 0.5)::BIGINT AS cx, floor(s_suppkey % 7 / 0.5)::BIGINT AS cy
FROM lineitem JOIN supplier ON s_suppkey = l_suppkey
""")
def feed_stop_times(spark, sf_dir):
    """Stop times and stops as feed text files, read back with types, times past midnight and the cells of their stops (SRC-03, SRC-04, DT-03)."""
    supplier, line = table(spark, sf_dir, "supplier"), table(spark, sf_dir, "lineitem")
    stops = supplier.select(F.concat(F.lit("s"), "s_suppkey").alias("stop_id"), F.concat(F.lit('Stop "'), "s_name", F.lit('", x')).alias("stop_name"), (F.col("s_suppkey") % 7).alias("stop_lat"), (F.col("s_acctbal") / 1000).alias("stop_lon"), F.lit("extra").alias("unknown"))
    n = F.col("l_linenumber")
    clock = F.format_string("%d:%02d:05", F.col("l_orderkey") % 30, n)
    times = line.select(F.concat(F.lit("t"), "l_orderkey", F.lit("_"), n).alias("trip_id"), clock.alias("arrival_time"), F.lit("").alias("departure_time"), F.concat(F.lit("s"), "l_suppkey").alias("stop_id"), n.alias("stop_sequence"), F.when(n % 2 == 0, F.col("l_quantity")).alias("shape_dist_traveled"))

    def passed(folder):
        for name, rows in (("stops", stops), ("stop_times", times)):
            rows.write.option("header", True).option("escape", '"').csv(f"{folder}/{name}.txt")
        feed = readers.read_gtfs(spark, folder, 0.5, ("stops", "stop_times"))
        return feed["stop_times"].select("trip_id", "arrival_time", "stop_id", "stop_sequence", "shape_dist_traveled", "cell.cx", "cell.cy")

    return through_files(spark, passed)


@query(f"""
WITH s AS (SELECT s_suppkey, s_name, {XY.format(k="s_suppkey")} FROM supplier)
SELECT s_suppkey AS id, '{{"primary":"' || s_name || '"}}' AS names FROM s WHERE x > 2 AND y > 1 AND x + 0.5 < 7 AND y + 0.5 < 9
""")
def theme_scan(spark, sf_dir):
    """A theme's type in its folder layout, strictly inside a box, nested columns as JSON (SRC-01, SRC-02, FLT-10, JS-08)."""
    s = coordinates(table(spark, sf_dir, "supplier"), "s_suppkey")
    box = F.struct(F.col("x").alias("xmin"), (F.col("x") + 0.5).alias("xmax"), F.col("y").alias("ymin"), (F.col("y") + 0.5).alias("ymax"))
    rows = s.select(F.col("s_suppkey").alias("id"), F.struct(F.col("s_name").alias("primary")).alias("names"), box.alias("bbox"), F.lit("places").alias("theme"), F.lit("place").alias("type"))

    def passed(folder):
        writers.write_table(rows, folder, partition_by=["theme", "type"])
        return readers.flattened(readers.read_theme(spark, folder, "places", "place", {"xmin": 2.0, "ymin": 1.0, "xmax": 7.0, "ymax": 9.0}))

    return through_files(spark, passed)


@query("""
SELECT o_orderpriority AS priority, count(*) * 2 AS n, round(sum(o_totalprice) * 2, 4) AS total, 0 AS kept_rows, true AS same_columns FROM orders WHERE o_orderstatus = 'F' GROUP BY o_orderpriority
""")
def tables_written(spark, sf_dir):
    """A table by status, appended to, replaced, and dumped as schema and as data; one partition read (SNK-02, SNK-03, SNK-04, SNK-08, SNK-09, FLT-12, MIG-01)."""
    orders = table(spark, sf_dir, "orders")

    def passed(folder):
        writers.write_table(orders.limit(5), f"{folder}/t", partition_by=["o_orderstatus"])
        writers.write_table(orders, f"{folder}/t", writers.IfExists.REPLACE, ["o_orderstatus"], ["o_orderkey"])
        writers.write_table(orders, f"{folder}/t", writers.IfExists.APPEND, ["o_orderstatus"])
        writers.dump(orders, f"{folder}/empty", writers.Dump.SCHEMA)
        writers.dump(orders, f"{folder}/all")
        empty = spark.read.parquet(f"{folder}/empty")
        differ = rel.same_schema(empty, spark.read.parquet(f"{folder}/all"))
        back = spark.read.parquet(f"{folder}/t").where("o_orderstatus = 'F'")
        sums = back.groupBy(F.col("o_orderpriority").alias("priority")).agg(F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").alias("total"))
        return sums.withColumns({"kept_rows": F.lit(empty.count()), "same_columns": F.lit(not any(differ.values()))}).withColumn("total", F.round("total", 4))

    return through_files(spark, passed)


@query(f"WITH c AS (SELECT c_custkey, {XY.format(k='c_custkey')} FROM customer) SELECT c_custkey, x, y FROM c WHERE x BETWEEN 2 AND 4 AND y BETWEEN 5 AND 6.5")
def place_scan(spark, sf_dir):
    """A table in order of place, read back by a box (SO-07, SO-08)."""
    c = coordinates(table(spark, sf_dir, "customer").select("c_custkey"), "c_custkey")

    def passed(folder):
        writers.write_by_place(c, folder, 16)
        return spark.read.parquet(folder).where("x between 2 and 4 and y between 5 and 6.5")

    return through_files(spark, passed)


@query("""
WITH s AS (SELECT s_suppkey AS id, s_suppkey % 4 AS cell FROM supplier)
SELECT id, cell, CASE WHEN cell IN (1, 3) THEN 0.0 END::DOUBLE AS slope, CASE WHEN cell IN (1, 3) THEN 0 END AS average FROM s
""")
def cells_recomputed(spark, sf_dir):
    """Slopes worked out anew in two cells of a table by cell; the others stay as they were (NET-12)."""
    s = coordinates(table(spark, sf_dir, "supplier").select("s_suppkey"), "s_suppkey")
    line = F.array(geo.point(F.col("x"), F.col("y")), geo.point(F.col("x") + 0.5, F.col("y")))
    none = {"impedance_slope": "double", "impedance_slope_reverse": "double", "slope_average": "int"}
    rows = s.select(F.col("s_suppkey").alias("id"), line.alias("geom"), F.lit(25.0).alias("length_m"), *[F.lit(None).cast(t).alias(c) for c, t in none.items()], (F.col("s_suppkey") % 4).alias("cell"))
    pixels = s.select(F.col("s_suppkey").alias("pixel"), "x", "y", F.lit(100.0).alias("val"))

    def passed(folder):
        writers.write_table(rows, folder, partition_by=["cell"])
        networks.recomputed_slopes(spark, folder, pixels, 1.0, [1, 3])
        back = spark.read.parquet(folder)
        return back.select("id", F.col("cell").cast("long").alias("cell"), (F.round("impedance_slope", 6) + F.lit(0.0)).alias("slope"), F.col("slope_average").alias("average"))

    return through_files(spark, passed)


@query("""
SELECT p_partkey AS id, CASE WHEN p_size % 3 = 0 THEN 'cafe' WHEN p_size % 3 = 1 THEN 'bar' END AS amenity, CASE WHEN p_size % 5 = 0 THEN p_brand END AS shop FROM part WHERE p_size % 3 = 0 OR p_size % 5 = 0
""")
def tagged_objects(spark, sf_dir):
    """Objects with a listed tag, and their tags as columns (SRC-10, SRC-11)."""
    size = F.col("p_size")
    entries = F.filter(F.array(F.struct(F.lit("amenity").alias("key"), F.when(size % 3 == 0, "cafe").when(size % 3 == 1, "bar").alias("value")), F.struct(F.lit("shop").alias("key"), F.when(size % 5 == 0, F.col("p_brand")).alias("value"))), lambda e: e["value"].isNotNull())
    rows = table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.map_from_entries(entries).alias("tags"))
    return readers.promoted(readers.tagged(rows, {"amenity": ["cafe"], "shop": True}), ["amenity", "shop"]).drop("tags")


@query("""
WITH b AS (SELECT min(x) AS x0, min(y) AS y0, max(x) AS x1, max(y) AS y1 FROM (SELECT {xy} FROM supplier))
SELECT s_suppkey, x0 AS xmin, y0 AS ymin, x1 AS xmax, y1 AS ymax FROM supplier, b
""".replace("{xy}", XY.format(k="s_suppkey")))
def region_bounds(spark, sf_dir):
    """Bounds of all points, through a boundary file and back (SRC-14, SRC-22, SNK-14)."""
    s = coordinates(table(spark, sf_dir, "supplier").select("s_suppkey"), "s_suppkey")
    b = readers.envelope_of(s)
    ring = [(b["xmin"], b["ymin"]), (b["xmax"], b["ymin"]), (b["xmax"], b["ymax"]), (b["xmin"], b["ymax"]), (b["xmin"], b["ymin"])]
    back = readers.parse_poly(readers.write_poly("region", [[ring]]))[0][0]
    xs, ys = [p[0] for p in back], [p[1] for p in back]
    return s.select("s_suppkey", F.lit(min(xs)).alias("xmin"), F.lit(min(ys)).alias("ymin"), F.lit(max(xs)).alias("xmax"), F.lit(max(ys)).alias("ymax"))


@query(f"WITH s AS (SELECT s_suppkey, s_name, {XY.format(k='s_suppkey')} FROM supplier) SELECT s_suppkey, s_name, x, y FROM s")
def geojson_features(spark, sf_dir):
    """Points as features in text files, read back as JSON (SNK-12, JS-01)."""
    s = coordinates(table(spark, sf_dir, "supplier").select("s_suppkey", "s_name"), "s_suppkey")

    def passed(folder):
        writers.write_geojson(s.withColumn("g", geo.geojson_point(geo.point(F.col("x"), F.col("y")))), folder, "g", ["s_suppkey", "s_name"])
        get = lambda path: F.get_json_object("value", path)
        return spark.read.text(folder).select(get("$.properties.s_suppkey").cast("long").alias("s_suppkey"), get("$.properties.s_name").alias("s_name"), get("$.geometry.coordinates[0]").cast("double").alias("x"), get("$.geometry.coordinates[1]").cast("double").alias("y"))

    return through_files(spark, passed)


@query("""
SELECT e.event_id, e.user_id % 5 = ANY([1, 3]) AS listed, NOT (e.event_type = ANY(['click', 'view'])) AS other, [e.event_id % 3, 7]::INTEGER[] AS numbers, n_name AS pair, to_short AS short
FROM events e JOIN (SELECT n_nationkey, n_name, (n_nationkey * 68719476736 & 72057525318451200) >> 36 AS to_short FROM nation) n ON e.event_id % 25 = n_nationkey
""")
def scalar_functions(spark, sf_dir):
    """Functions of the library called by name in SQL, with array membership and a small table joined whole (UDF-01 to UDF-05, FLT-05, JS-03, JN-17)."""
    from geoloom.functions import sql

    sql.register_all(spark)
    table(spark, sf_dir, "events").createOrReplaceTempView("scalar_events")
    table(spark, sf_dir, "nation").createOrReplaceTempView("scalar_nations")
    return spark.sql("""
      SELECT event_id, array_contains(array(1, 3), user_id % 5) AS listed, NOT array_contains(array('click', 'view'), event_type) AS other,
             jsonb_array_int_array(concat('[', event_id % 3, ', 7]')) AS numbers, n_name AS pair, CAST(to_short_h3_3(n_nationkey * 68719476736) AS BIGINT) AS short
      FROM scalar_events JOIN scalar_nations ON event_id % 25 = n_nationkey
    """)


@query("""
SELECT p_partkey, CASE WHEN p_size % 4 = 0 THEN 'cafe' WHEN p_size % 4 = 1 THEN 'kiosk' WHEN p_size % 4 = 2 THEN 'bench' END AS category FROM part
""")
def extended_categories(spark, sf_dir):
    """Rules for every collected tag value, those of settings first (POI-01)."""
    rules = poi.extended_rules({"cafe": {"amenity": ["cafe", "coffee"]}}, {"amenity": ["cafe", "bench"], "shop": ["kiosk"]})
    size = F.col("p_size") % 4
    rows = table(spark, sf_dir, "part").select("p_partkey", F.when(size == 0, "Coffee").when(size == 2, "bench").when(size == 3, "fountain").alias("amenity"), F.when(size == 1, "Kiosk").alias("shop"))
    category = F.coalesce(*[F.when(poi.by_tag(found), F.lit(name)) for name, found in rules.items()])
    return rows.select("p_partkey", category.alias("category"))
