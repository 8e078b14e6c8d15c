"""Every operator as a query over the driver's tables, with the SQL that gives the same rows."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.functions import cells, collections as fc, geometry as geo, text as ft
from geoloom.operators import buildings, networks, poi, relational as rel, spatial_joins as sj, transit

QUERIES: dict = {}
ORACLES: dict = {}


def query(sql: str | None = None):
    """Register a query under its function's name."""

    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def coordinates(rows: DataFrame, key: str) -> DataFrame:
    """Reproducible coordinates in [0, 10) from a key."""
    return rows.withColumns({"x": F.pmod(F.col(key) * 7919, F.lit(1000)) / 100.0, "y": F.pmod(F.col(key) * 104729, F.lit(1000)) / 100.0})


XY = "({k} * 7919 % 1000) / 100.0 AS x, ({k} * 104729 % 1000) / 100.0 AS y"
GRAMS = "list_distinct(flatten(list_transform(list_filter(string_split_regex(lower({c}), '[^a-z0-9]+'), lambda w: w <> ''), lambda w: list_transform(range(1, length(w) + 2), lambda i: substr('  ' || w || ' ', i, 3)))))"


@query("SELECT l_orderkey, l_linenumber, round(l_extendedprice / sum(l_extendedprice) OVER (PARTITION BY l_orderkey) * o_totalprice, 4) AS allocated FROM lineitem JOIN orders ON l_orderkey = o_orderkey")
def disaggregate_order_value(spark, sf_dir):
    """Totals of areas shared among their parts by weight (POPU-01)."""
    rows = table(spark, sf_dir, "lineitem").join(table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_totalprice"), "l_orderkey")
    weight = rel.allocated(rows.withColumn("one", F.lit(1.0)), "l_orderkey", "l_extendedprice", "one", "share")
    return weight.select("l_orderkey", "l_linenumber", F.round(F.col("share") * F.col("o_totalprice"), 4).alias("allocated"))


@query("""
WITH n AS (SELECT event_type, ts::DATE AS date, count(*) AS n FROM events GROUP BY ALL),
f AS (SELECT event_type, n, count(*) AS freq, min(date) AS date FROM n GROUP BY ALL)
SELECT event_type, n, date FROM f QUALIFY row_number() OVER (PARTITION BY event_type ORDER BY freq DESC, n) = 1
""")
def modal_daily_count(spark, sf_dir):
    """Modal number per day and the earliest day that has it (GTF-05, AG-04, SO-05)."""
    counts = table(spark, sf_dir, "events").groupBy("event_type", F.to_date("ts").alias("date")).agg(F.count(F.lit(1)).alias("n"))
    return rel.modal_value(counts, ["event_type"], "n", "date")


def _calendar(spark, sf_dir):
    orders = table(spark, sf_dir, "orders")
    day = F.to_date("o_orderdate")
    calendar = orders.select(
        F.col("o_orderkey").alias("service_id"), day.alias("start_date"), F.date_add(day, 90).alias("end_date"),
        (F.col("o_orderkey") % 2 == 0).cast("int").alias("weekday"), (F.col("o_orderkey") % 3 == 0).cast("int").alias("saturday"), (F.col("o_orderkey") % 5 == 0).cast("int").alias("sunday"),
    )
    exceptions = orders.where("o_orderkey % 4 = 0").select(F.col("o_orderkey").alias("service_id"), F.expr("date_add(DATE'1995-01-03', cast(o_orderkey % 10 as int) * 7)").alias("date"), (1 + F.col("o_orderkey") % 8 / 4).cast("int").alias("exception_type"))
    trips = orders.select(F.col("o_orderkey").alias("trip_id"), (F.col("o_custkey") % 20).alias("route_id"), F.col("o_orderkey").alias("service_id"))
    return calendar, exceptions, trips, transit.sampled_dates(spark, transit.Sampling("1995-01-03", 10))


CALENDAR = """
WITH dates AS (SELECT (DATE '1995-01-03' + (7 * w + o)::INTEGER)::DATE AS date, t AS day_type FROM range(11) r(w), (VALUES (0, 'weekday'), (4, 'saturday'), (5, 'sunday')) v(o, t)),
cal AS (SELECT o_orderkey AS service_id, o_orderdate::DATE AS s, o_orderdate::DATE + 90 AS e, o_orderkey % 2 = 0 AS wd, o_orderkey % 3 = 0 AS sa, o_orderkey % 5 = 0 AS su FROM orders),
exc AS (SELECT o_orderkey AS service_id, (DATE '1995-01-03' + (o_orderkey % 10 * 7)::INTEGER)::DATE AS date, CASE WHEN o_orderkey % 8 = 0 THEN 1 ELSE 2 END AS kind FROM orders WHERE o_orderkey % 4 = 0),
runs AS (
  SELECT c.service_id, d.date, d.day_type FROM cal c JOIN dates d ON d.date BETWEEN c.s AND c.e
  WHERE CASE d.day_type WHEN 'weekday' THEN wd WHEN 'saturday' THEN sa ELSE su END
    AND NOT EXISTS (SELECT 1 FROM exc x WHERE x.kind = 2 AND x.service_id = c.service_id AND x.date = d.date)
  UNION ALL SELECT x.service_id, x.date, d.day_type FROM exc x JOIN dates d ON d.date = x.date WHERE x.kind = 1),
trips AS (SELECT o_orderkey AS trip_id, o_custkey % 20 AS route_id, o_orderkey AS service_id FROM orders),
counts AS (SELECT route_id, date, day_type, count(*)::BIGINT AS trip_cnt FROM trips JOIN runs USING (service_id) GROUP BY ALL)
"""


@query(CALENDAR + "SELECT * FROM counts")
def sampled_service_counts(spark, sf_dir):
    """Trips per route on sampled dates, with exceptions (GTF-04, DT-01, DT-02, JN-03, JN-07)."""
    calendar, exceptions, trips, dates = _calendar(spark, sf_dir)
    return transit.trip_counts(trips, transit.service_days(calendar, exceptions, dates))


@query(CALENDAR + """,
f AS (SELECT route_id, day_type, trip_cnt, count(*) AS freq, min(date) AS date FROM counts GROUP BY ALL),
modal AS (SELECT route_id, day_type, date FROM f QUALIFY row_number() OVER (PARTITION BY route_id, day_type ORDER BY freq DESC, trip_cnt) = 1),
a AS (SELECT trip_id, route_id, day_type, date FROM trips JOIN (SELECT DISTINCT * FROM runs) USING (service_id) JOIN modal USING (route_id, day_type, date))
SELECT trip_id, route_id, coalesce(bool_or(day_type = 'weekday'), false) AS on_weekday, coalesce(bool_or(day_type = 'saturday'), false) AS on_saturday, coalesce(bool_or(day_type = 'sunday'), false) AS on_sunday,
       min(date) FILTER (day_type = 'weekday') AS at_weekday
FROM a GROUP BY trip_id, route_id
""")
def weekday_activity_flags(spark, sf_dir):
    """Day types on whose modal date a trip runs (GTF-06, AG-08, ST-02)."""
    calendar, exceptions, trips, dates = _calendar(spark, sf_dir)
    active = transit.service_days(calendar, exceptions, dates)
    out = transit.trip_weekdays(trips, active, transit.modal_days(transit.trip_counts(trips, active)))
    w = F.col("weekdays")
    return out.select("trip_id", "route_id", w[0].alias("on_weekday"), w[1].alias("on_saturday"), w[2].alias("on_sunday"), F.col("weekday_dates")[0].alias("at_weekday"))


@query("SELECT user_id, event_type, ts::DATE AS date, min(event_id) AS event_id, arg_min(value, event_id) AS value FROM events GROUP BY ALL")
def dedupe_stop_times(spark, sf_dir):
    """One row of each group, that with the least id (GTF-08, AG-06, AG-11, AG-13)."""
    rows = table(spark, sf_dir, "events").select("user_id", "event_type", F.to_date("ts").alias("date"), "event_id", "value")
    return rel.representative(rows, ["user_id", "event_type", "date"], "event_id")


FUSION = f"""
WITH p AS (SELECT p_partkey AS id, p_name AS name, {XY.format(k="p_partkey")}, {GRAMS.format(c="p_name")} AS g FROM part),
a AS (SELECT * FROM p WHERE id % 2 = 0), b AS (SELECT * FROM p WHERE id % 2 = 1),
pairs AS (SELECT a.id, b.id AS other, len(list_intersect(a.g, b.g)) / len(list_distinct(list_concat(a.g, b.g)))::DOUBLE AS sim
          FROM a JOIN b ON pow(a.x - b.x, 2) + pow(a.y - b.y, 2) <= 1.0)
"""


def _fusion(spark, sf_dir):
    parts = coordinates(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("id"), F.col("p_name").alias("name")), "id")
    return parts.where("id % 2 = 0"), parts.where("id % 2 = 1")


@query(FUSION + "SELECT id, other, round(sim, 6) AS sim FROM pairs WHERE sim >= 0.2 QUALIFY row_number() OVER (PARTITION BY id ORDER BY sim DESC, other) = 1")
def fuzzy_spatial_fusion(spark, sf_dir):
    """Most similar partner in reach (FUS-02, STR-02, JN-09, JN-12, SO-02)."""
    best = poi.best_matches(*_fusion(spark, sf_dir), 1.0, 0.2)
    return best.select(F.col("l.id").alias("id"), F.col("r.id").alias("other"), F.round("sim", 6).alias("sim"))


@query(FUSION + """
SELECT id, CASE WHEN id IN (SELECT id FROM pairs WHERE sim >= 0.2) THEN 'kept' ELSE 'unmatched' END AS decision FROM a
UNION ALL SELECT id, 'added' FROM b WHERE id NOT IN (SELECT other FROM pairs WHERE sim >= 0.2)
""")
def fusion_decisions(spark, sf_dir):
    """Both sources as one, with decisions (FUS-03, FUS-04, FUS-05, FLT-03)."""
    return poi.fused(*_fusion(spark, sf_dir), 1.0, 0.2).select("id", "decision")


NEAR = f"""
WITH c AS (SELECT c_custkey, {XY.format(k="c_custkey")} FROM customer), s AS (SELECT s_suppkey, s_acctbal, {XY.format(k="s_suppkey")} FROM supplier),
d AS (SELECT c_custkey, s_suppkey, s_acctbal, sqrt(pow(c.x - s.x, 2) + pow(c.y - s.y, 2)) AS distance FROM c JOIN s ON pow(c.x - s.x, 2) + pow(c.y - s.y, 2) <= 2.25)
"""


def _near(spark, sf_dir):
    return coordinates(table(spark, sf_dir, "customer"), "c_custkey"), coordinates(table(spark, sf_dir, "supplier"), "s_suppkey")


@query(NEAR + "SELECT c_custkey, s_suppkey, round(distance, 6) AS distance FROM d QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY distance, s_suppkey) = 1")
def nearest_supplier(spark, sf_dir):
    """Nearest row in reach (JN-13, GEO-04, GEO-05)."""
    near = sj.nearest(*_near(spark, sf_dir), 1.5, "c_custkey", "s_suppkey")
    return near.select(F.col("l.c_custkey").alias("c_custkey"), F.col("r.s_suppkey").alias("s_suppkey"), F.round("distance", 6).alias("distance"))


@query(NEAR + "SELECT s_suppkey, (SELECT count(*) FROM d WHERE d.s_suppkey = s.s_suppkey)::BIGINT AS n FROM s")
def within_distance_count(spark, sf_dir):
    """Points in reach of each row, zero included (JN-12, JN-15, BLD-03, GEO-03, AG-01)."""
    c, s = _near(spark, sf_dir)
    return sj.count_within(s, c, 1.5, "s_suppkey").select("s_suppkey", "n")


@query(NEAR + ", k AS (SELECT * FROM d QUALIFY row_number() OVER (PARTITION BY c_custkey ORDER BY distance, s_suppkey) <= 3) SELECT c_custkey, round(coalesce(arg_min(s_acctbal, s_suppkey) FILTER (distance = 0), sum(s_acctbal / nullif(distance, 0)) / sum(1 / nullif(distance, 0))), 4) AS elevation FROM k GROUP BY c_custkey")
def idw_elevation(spark, sf_dir):
    """Inverse-distance weighted mean of the three nearest (NET-04, AG-12, JN-14, SO-04)."""
    c, s = _near(spark, sf_dir)
    out = sj.idw(c, s, 1.5, "c_custkey", "s_suppkey", "s_acctbal", 3, "elevation")
    return out.select("c_custkey", F.round("elevation", 4).alias("elevation"))


@query("""
WITH n AS (SELECT c_custkey, c_mktsegment, c_acctbal, count(o_orderkey) AS n FROM customer LEFT JOIN orders ON o_custkey = c_custkey GROUP BY ALL)
SELECT c_custkey, CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'no_residents' WHEN n >= 15 THEN 'no_residents' WHEN least(c_acctbal / 10000, 1) >= 0.5 THEN 'mixed' ELSE 'with_residents' END AS residential_status,
       CASE WHEN c_mktsegment IN ('BUILDING', 'MACHINERY') THEN 'attribute:c_mktsegment' WHEN n >= 15 THEN 'points:n' WHEN least(c_acctbal / 10000, 1) >= 0.5 THEN 'share:share' ELSE 'default' END AS matched_rule
FROM n
""")
def first_rule_wins(spark, sf_dir):
    """Rules in order, first that holds (BLD-02 to BLD-05, BLD-07)."""
    n = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.count(F.lit(1)).alias("n"))
    rows = table(spark, sf_dir, "customer").join(n, "c_custkey", "left").withColumns({"n": F.coalesce("n", F.lit(0)), "share": F.col("c_acctbal") / 10000})
    rules = [buildings.attribute_rule("c_mktsegment", ["BUILDING", "MACHINERY"]), buildings.point_rule("n", 15), buildings.share_rule("share", 0.5, "mixed")]
    return buildings.first_rule(rows, rules).select("c_custkey", "residential_status", "matched_rule")


@query("""
WITH q AS (SELECT l_orderkey, CASE l_returnflag WHEN 'A' THEN 0 WHEN 'N' THEN 1 ELSE 3 END AS cat, sum(l_quantity) AS q FROM lineitem GROUP BY ALL),
t AS (SELECT *, sum(q) OVER (PARTITION BY l_orderkey) AS total FROM q)
SELECT l_orderkey, CASE WHEN q / total > 0.5 THEN cat ELSE 2 END AS cat FROM t QUALIFY row_number() OVER (PARTITION BY l_orderkey ORDER BY q DESC, cat) = 1
""")
def dominant_class(spark, sf_dir):
    """Category with the largest share, if it is over one half (BLD-09, SO-03)."""
    cat = F.when(F.col("l_returnflag") == "A", 0).when(F.col("l_returnflag") == "N", 1).otherwise(3)
    q = table(spark, sf_dir, "lineitem").groupBy("l_orderkey", cat.alias("cat")).agg(F.sum("l_quantity").alias("q"))
    total = q.groupBy("l_orderkey").agg(F.sum("q").alias("total"))
    return buildings.dominant_class(q.join(total, "l_orderkey"), "l_orderkey", "cat", "q", "total")


@query("SELECT c_custkey, CASE WHEN b IS NULL THEN a WHEN a = b THEN a WHEN a IN (0, 2) AND b = 1 THEN 1 WHEN b IN (0, 2) AND a = 1 THEN 1 ELSE 0 END::INTEGER AS class FROM (SELECT c_custkey, c_custkey % 3 AS a, CASE WHEN c_custkey // 3 % 4 < 3 THEN c_custkey // 3 % 4 END AS b FROM customer)")
def reconcile_landuse(spark, sf_dir):
    """One verdict of several, or of one alone (BLD-08)."""
    k = F.col("c_custkey")
    second = F.floor(k / 3) % 4
    return table(spark, sf_dir, "customer").select("c_custkey", buildings.reconciled(k % 3, F.when(second < 3, second)).cast("int").alias("class"))


DIFF = """
WITH o AS (SELECT o_orderkey, o_totalprice, o_orderstatus FROM orders WHERE o_orderkey % 10 <> 0),
n AS (SELECT o_orderkey, CASE WHEN o_orderkey % 7 = 0 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice, CASE WHEN o_orderkey % 11 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus FROM orders WHERE o_orderkey % 9 <> 0)
"""


def _versions(spark, sf_dir):
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_totalprice", "o_orderstatus")
    new = orders.where("o_orderkey % 9 <> 0").withColumns({"o_totalprice": F.when(F.col("o_orderkey") % 7 == 0, F.col("o_totalprice") + 1).otherwise(F.col("o_totalprice")), "o_orderstatus": F.when(F.col("o_orderkey") % 11 != 0, F.col("o_orderstatus"))})
    return orders.where("o_orderkey % 10 <> 0"), new


@query(DIFF + """
SELECT o_orderkey, coalesce(n.o_totalprice, o.o_totalprice) AS o_totalprice,
       CASE WHEN o.p IS NOT NULL AND n.p IS NOT NULL THEN CASE WHEN o.o_totalprice IS DISTINCT FROM n.o_totalprice THEN 'changed' ELSE 'unchanged' END END AS o_totalprice_check,
       CASE WHEN n.p IS NULL THEN o.o_orderstatus ELSE n.o_orderstatus END AS o_orderstatus,
       CASE WHEN o.p IS NOT NULL AND n.p IS NOT NULL THEN CASE WHEN o.o_orderstatus IS DISTINCT FROM n.o_orderstatus THEN 'changed' ELSE 'unchanged' END END AS o_orderstatus_check,
       CASE WHEN o.p IS NULL THEN 'insert' WHEN n.p IS NULL THEN 'delete' ELSE 'update' END AS action
FROM (SELECT *, 1 AS p FROM o) o FULL JOIN (SELECT *, 1 AS p FROM n) n USING (o_orderkey)
WHERE o.p IS NULL OR n.p IS NULL OR o.o_totalprice IS DISTINCT FROM n.o_totalprice OR o.o_orderstatus IS DISTINCT FROM n.o_orderstatus
""")
def migration_diff(spark, sf_dir):
    """Inserts, updates and deletes between versions (MIG-02 to MIG-04)."""
    return rel.difference(*_versions(spark, sf_dir), ["o_orderkey"])


@query(DIFF + "SELECT * FROM n")
def migration_apply(spark, sf_dir):
    """The old version after the difference is the new one (MIG-06, SNK-06, SNK-07)."""
    old, new = _versions(spark, sf_dir)
    return rel.applied(old, rel.difference(old, new, ["o_orderkey"]), ["o_orderkey"])


@query("""
SELECT p_partkey, CASE p_brand
  WHEN 'Brand#11' THEN CASE WHEN lower(p_type) = 'promo' THEN 'promoted' WHEN regexp_matches(lower(p_name), 'blue|green') THEN 'coloured' ELSE 'other' END
  WHEN 'Brand#12' THEN CASE WHEN regexp_matches(lower(p_name), 'red') THEN 'red' END END AS category
FROM part
""")
def poi_cascade(spark, sf_dir):
    """Rule cascade by key, in one pass (POI-03, POI-04, POI-06, POI-07, STR-11)."""
    rules = {
        "Brand#11": poi.CategoryRules(tags={"promoted": {"p_type": ["promo"]}}, names={"coloured": ["blue", "green"]}, unmatched="other"),
        "Brand#12": poi.CategoryRules(names={"red": ["red"]}),
    }
    return poi.cascade(table(spark, sf_dir, "part"), rules, F.col("p_brand"), name_columns=("p_name",)).select("p_partkey", "category")


@query()
def name_similarity_udf(spark, sf_dir):
    """Names alike any alias by matching blocks (POI-05, STR-03, UDF-07)."""
    return table(spark, sf_dir, "part").select("p_partkey", ft.similar_to_any(F.col("p_name"), ["small widgets", "larg bolt"], 0.85).alias("alike"))


@query("""
SELECT c_mktsegment AS category, 'c_name' AS column_name, round(100.0 * sum(CASE WHEN trim(c_name) <> '' THEN 1 ELSE 0 END)::DOUBLE / count(*), 2) AS percentage FROM customer GROUP BY ALL
UNION ALL SELECT c_mktsegment, 'phone', round(100.0 * sum(CASE WHEN c_custkey % 3 = 0 THEN 0 ELSE 1 END)::DOUBLE / count(*), 2) FROM customer GROUP BY ALL
""")
def category_completeness(spark, sf_dir):
    """Percentages of filled columns (STA-01, AG-03, AG-16)."""
    rows = table(spark, sf_dir, "customer").withColumn("phone", F.when(F.col("c_custkey") % 3 != 0, F.lit("1")).otherwise(F.lit(" ")))
    out = rel.completeness(rows, ["c_name", "phone"], "c_mktsegment")
    return out.withColumn("percentage", F.col("percentage").cast("double"))


@query("""
WITH t AS (SELECT n_nationkey, n_name, count(c_custkey)::BIGINT AS n FROM nation LEFT JOIN customer ON c_nationkey = n_nationkey GROUP BY n_nationkey, n_name)
SELECT n_nationkey, n_name, n, round(n / 2.5::DOUBLE, 6) AS density, round(n * 10000.0::DOUBLE / (n_nationkey + 1000), 6) AS per_10k FROM t
""")
def stat_per_capita(spark, sf_dir):
    """Counts per area and per inhabitants (STA-02, STA-03, AG-01)."""
    areas = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", F.lit(2.5).alias("area"), (F.col("n_nationkey") + 1000).alias("population"))
    points = table(spark, sf_dir, "customer").withColumnRenamed("c_nationkey", "n_nationkey")
    out = buildings.per_inhabitants(areas, points, "n_nationkey")
    return out.select("n_nationkey", "n_name", "n", F.round("density", 6).alias("density"), F.round("per_10k", 6).alias("per_10k"))


@query("""
SELECT c_custkey, 'balance not negative' AS rule FROM customer WHERE c_acctbal < 0
UNION ALL SELECT c_custkey, 'segment known' FROM customer WHERE c_mktsegment NOT IN ('BUILDING', 'AUTOMOBILE', 'MACHINERY', 'HOUSEHOLD')
UNION ALL SELECT c_custkey, 'name trimmed' FROM customer WHERE c_name <> trim(c_name)
""")
def constraint_violations(spark, sf_dir):
    """Rows that break rules (SUB-01, GTF-02)."""
    rules = {"balance not negative": F.col("c_acctbal") >= 0, "segment known": F.col("c_mktsegment").isin("BUILDING", "AUTOMOBILE", "MACHINERY", "HOUSEHOLD"), "name trimmed": F.col("c_name") == F.trim("c_name")}
    return rel.violations(table(spark, sf_dir, "customer"), "c_custkey", rules)


@query("""
WITH p AS (SELECT l_orderkey, l_quantity AS h, lag(l_quantity) OVER w AS before, row_number() OVER w AS i, count(*) OVER (PARTITION BY l_orderkey) AS n FROM lineitem WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, l_quantity)),
s AS (SELECT *, 10.0 * (n - 1) + 5 AS len, CASE WHEN i = n THEN CASE WHEN n = 2 THEN (10.0 * (n - 1) + 5) / 2 ELSE 10.0 * (n - 1) + 5 - (n - 2) * 10.0 END WHEN n = 2 THEN (10.0 * (n - 1) + 5) / 2 ELSE 10.0 END AS run FROM p),
j AS (SELECT *, (h - before) / run * 100 AS slope FROM s WHERE i > 1)
SELECT l_orderkey, round(sum(run / len * CASE WHEN slope > 9 THEN 3 WHEN slope >= 0 THEN 1 + slope * 0.0430815 WHEN slope >= -9 THEN 1 + slope * 0.0363248 ELSE 0.65 END) - 1, 6) AS up,
       round(sum(run / len * CASE WHEN -slope > 9 THEN 3 WHEN -slope >= 0 THEN 1 - slope * 0.0430815 WHEN -slope >= -9 THEN 1 - slope * 0.0363248 ELSE 0.65 END) - 1, 6) AS down
FROM j GROUP BY l_orderkey
""")
def slope_impedance(spark, sf_dir):
    """Effort along a profile of heights (NET-05, AR-07, MA-02)."""
    heights = table(spark, sf_dir, "lineitem").groupBy("l_orderkey").agg(F.transform(F.array_sort(F.collect_list(F.struct("l_linenumber", "l_quantity"))), lambda p: p["l_quantity"]).alias("h")).where(F.size("h") > 1)
    i = networks.impedance(F.col("h"), 10.0 * (F.size("h") - 1) + 5, 10.0)
    return heights.select("l_orderkey", i.alias("i")).select("l_orderkey", F.round("i.up", 6).alias("up"), F.round("i.down", 6).alias("down"))


EDGES = "WITH RECURSIVE e AS (SELECT DISTINCT s_suppkey % 97 AS a, s_suppkey * 31 % 89 + 200 AS b FROM supplier), u AS (SELECT a, b FROM e UNION SELECT b, a FROM e)"


@query(EDGES + ", r(n, m) AS (SELECT a, a FROM u UNION SELECT u.b, r.m FROM r JOIN u ON u.a = r.n) SELECT n AS node, min(m) AS component FROM r GROUP BY n")
def network_islands(spark, sf_dir):
    """Connected components of a network (NET-07, JN-18)."""
    k = F.col("s_suppkey")
    edges = table(spark, sf_dir, "supplier").select((k % 97).alias("source"), (k * 31 % 89 + 200).alias("target"))
    return networks.component_of(edges)


@query("SELECT s_suppkey AS old_s_suppkey, 100 + row_number() OVER (ORDER BY s_suppkey) AS s_suppkey FROM supplier")
def rebase_ids(spark, sf_dir):
    """Ids that go on from the last one in use (NET-08, SNK-16, WN-05)."""
    return rel.rebased(table(spark, sf_dir, "supplier").select("s_suppkey"), "s_suppkey", 100)


@query("""
SELECT o_orderstatus AS mode, o_orderpriority AS ref, array_to_string(list_sort(list(DISTINCT (o_custkey % 5)::VARCHAR || ' -> ' || (o_custkey % 3)::VARCHAR)), '; ') AS routes, count(DISTINCT o_orderkey)::BIGINT AS parts
FROM orders GROUP BY ALL
""")
def pt_lines_grouping(spark, sf_dir):
    """Routes grouped to lines with their distinct ends (NET-17, JN-19, AG-05)."""
    lines = table(spark, sf_dir, "orders").select(F.col("o_orderkey").alias("osm_id"), F.col("o_orderstatus").alias("mode"), F.col("o_orderpriority").alias("ref"), F.lit("op").alias("operator"), (F.col("o_custkey") % 5).cast("string").alias("from"), (F.col("o_custkey") % 3).cast("string").alias("to"))
    masters = spark.createDataFrame([], "master_id long, parts array<long>")
    out = transit.grouped_lines(lines, masters)
    return out.select("mode", "ref", F.array_join("routes", "; ").alias("routes"), F.size("parts").cast("long").alias("parts"))


@query(f"""
WITH s AS (SELECT s_suppkey, s_name, {XY.format(k="s_suppkey")} FROM supplier)
SELECT s_suppkey, '<node id="' || s_suppkey || '" lat="' || y::DECIMAL(6, 2) || '" lon="' || x::DECIMAL(6, 2) || '" version="1"/>' AS node,
       '<way id="' || s_suppkey || '" version="1"><nd ref="' || s_suppkey || '"/><nd ref="' || (s_suppkey + 1) || '"/><tag k="name" v="' || s_name || '"/></way>' AS way
FROM s
""")
def way_to_xml(spark, sf_dir):
    """Nodes and ways as XML (NET-13, NET-16, SNK-10, STR-08, AG-15)."""
    rows = coordinates(table(spark, sf_dir, "supplier"), "s_suppkey")
    place = F.struct(F.col("x").cast("decimal(6,2)").alias("x"), F.col("y").cast("decimal(6,2)").alias("y"))
    k = F.col("s_suppkey")
    return rows.select("s_suppkey", networks.node_xml(k, place).alias("node"), networks.way_xml(k, F.array(k, k + 1), F.create_map(F.lit("name"), F.col("s_name"))).alias("way"))


@query(f"""
WITH p AS (SELECT l_orderkey, l_linenumber, {XY.format(k="(l_partkey)")} FROM lineitem),
m AS (SELECT *, 6378137.0 * radians(x) AS mx, 6378137.0 * ln(tan(pi() / 4 + radians(y) / 2)) AS my FROM p),
d AS (SELECT l_orderkey, sqrt(pow(mx - lag(mx) OVER w, 2) + pow(my - lag(my) OVER w, 2)) AS d FROM m WINDOW w AS (PARTITION BY l_orderkey ORDER BY l_linenumber, x, y))
SELECT l_orderkey, round(coalesce(sum(d), 0), 2) AS length FROM d GROUP BY l_orderkey
""")
def mercator_length(spark, sf_dir):
    """Lengths of projected lines (GEO-07, GEO-10, WN-02)."""
    p = coordinates(table(spark, sf_dir, "lineitem"), "l_partkey")
    lines = p.groupBy("l_orderkey").agg(F.array_sort(F.collect_list(F.struct("l_linenumber", geo.point(F.col("x"), F.col("y")).alias("p")))).alias("line"))
    return lines.select("l_orderkey", F.round(geo.length(F.transform("line", lambda s: geo.to_mercator(s["p"]))), 2).alias("length"))


@query("""
SELECT c_custkey, ((i & 4503530907893760) >> 36)::INTEGER AS short_3, ((i & 4503599610593280) >> 24)::INTEGER AS short_6, (((c_custkey & 65535) << 36) | 589971619905011711) AS full_3
FROM (SELECT c_custkey, 589971619905011711 + c_custkey * 68719476736 AS i FROM customer)
""")
def h3_bits(spark, sf_dir):
    """Bit fields of cell indexes (H3-04 to H3-06, MA-05)."""
    i = F.lit(cells.FULL_3) + F.col("c_custkey") * F.lit(68719476736)
    return table(spark, sf_dir, "customer").select("c_custkey", cells.short_3(i).alias("short_3"), cells.short_6(i).alias("short_6"), cells.full_3(F.col("c_custkey")).alias("full_3"))


@query("""
SELECT event_id, k, (k % 3)::VARCHAR AS third, CASE WHEN event_id % 2 = 0 THEN 'b' ELSE 'a' END AS tag
FROM (SELECT event_id, try_cast(props ->> '$.k' AS INTEGER) AS k FROM events) WHERE k > 6
""")
def json_tags(spark, sf_dir):
    """Values of JSON and merged tags (JS-01, JS-04, CA-01, OVP-01, OVP-02, AR-08)."""
    rows = table(spark, sf_dir, "events").select("event_id", ft.to_int(F.get_json_object("props", "$.k")).alias("k")).where("k > 6")
    tags = fc.merged_tags(F.create_map(F.lit("t"), F.lit("a")), F.when(F.col("event_id") % 2 == 0, F.create_map(F.lit("t"), F.lit("b"))), F.create_map(F.lit("third"), (F.col("k") % 3).cast("string"), F.lit("none"), F.lit(None).cast("string")))
    return rows.withColumn("tags", tags).select("event_id", "k", F.col("tags")["third"].alias("third"), F.col("tags")["t"].alias("tag"))


@query("SELECT lang, string_agg(DISTINCT source, ', ' ORDER BY source) AS sources, count(*)::BIGINT AS n FROM documents GROUP BY lang")
def division_sources(spark, sf_dir):
    """Distinct sources joined in order (OVD-01, AG-07, AG-10)."""
    return table(spark, sf_dir, "documents").groupBy("lang").agg(fc.sorted_join(F.col("source")).alias("sources"), F.count(F.lit(1)).alias("n"))


@query("""
SELECT c_custkey, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE 'Main St ' END AS street, CASE WHEN c_custkey % 5 = 0 THEN NULL ELSE c_custkey || 'a' END AS housenumber FROM customer
""")
def split_house_number(spark, sf_dir):
    """Street and house number of an address (STR-06)."""
    rows = table(spark, sf_dir, "customer").withColumn("address", F.when(F.col("c_custkey") % 5 == 0, F.concat(F.col("c_custkey").cast("string"), F.lit(" Main"))).otherwise(F.concat(F.lit(" Main St "), F.col("c_custkey").cast("string"), F.lit("a "))))
    return rows.select("c_custkey", ft.street(F.col("address")).alias("street"), ft.house_number(F.col("address")).alias("housenumber"))


@query(f"""
WITH g AS (SELECT p_brand, list_sort(list(DISTINCT p_type)) AS c, min(p_partkey) AS k FROM part GROUP BY p_brand),
e AS (SELECT p_brand, {XY.format(k="k")}, len(c) AS n, unnest(c) AS category, unnest(range(len(c))) AS i FROM g)
SELECT p_brand, category, round(x + 0.5 * sin(radians(360 // n * i)), 6) AS px, round(y + 0.5 * cos(radians(360 // n * i)), 6) AS py FROM e
""")
def circle_offsets(spark, sf_dir):
    """Categories of one point spread on a circle (UTL-01, UTL-02, GEO-11, SO-06, AR-01)."""
    rows = table(spark, sf_dir, "part").groupBy("p_brand").agg(F.collect_set("p_type").alias("categories"), F.min("p_partkey").alias("k"))
    rows = coordinates(rows, "k").withColumn("geom", geo.point(F.col("x"), F.col("y")))
    out = networks.spread_categories(rows, 0.5)
    return out.select("p_brand", "category", F.round("geom.x", 6).alias("px"), F.round("geom.y", 6).alias("py"))


@query("""
SELECT 'anti' AS kind, c_custkey AS key FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)
UNION ALL SELECT 'semi', c_custkey FROM customer WHERE EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)
UNION ALL (SELECT 'except', c_custkey FROM customer EXCEPT SELECT 'except', o_custkey FROM orders)
UNION ALL (SELECT 'union', c_nationkey FROM customer UNION SELECT 'union', s_nationkey FROM supplier)
""")
def anti_semi_set_ops(spark, sf_dir):
    """Anti and semi joins, difference and union (JN-04 to JN-06, ST-01 to ST-04, FLT-03, FLT-04)."""
    c, o, s = (table(spark, sf_dir, t) for t in ("customer", "orders", "supplier"))
    on = F.col("c_custkey") == F.col("o_custkey")
    kind = lambda name, df: df.select(F.lit(name).alias("kind"), F.col(df.columns[0]).cast("long").alias("key"))
    parts = [
        kind("anti", c.join(o, on, "left_anti").select("c_custkey")),
        kind("semi", c.join(o, on, "left_semi").select("c_custkey")),
        kind("except", c.select("c_custkey").subtract(o.select("o_custkey"))),
        kind("union", c.select("c_nationkey").union(s.select("s_nationkey")).distinct()),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


@query("""
SELECT p_partkey, CASE v WHEN 'small' THEN 'compact' WHEN 'economy' THEN 'compact' ELSE v END AS landuse_simplified
FROM (SELECT p_partkey, coalesce(CASE WHEN lower(split_part(p_type, ' ', 1)) IN ('economy', 'small') THEN lower(split_part(p_type, ' ', 1)) END, CASE WHEN p_size > 25 THEN 'large' END) AS v FROM part) WHERE v IS NOT NULL
""")
def landuse_simplify(spark, sf_dir):
    """First listed value of tags in order, grouped (LND-01, AR-06)."""
    rows = table(spark, sf_dir, "part").select("p_partkey", F.lower(F.split("p_type", " ")[0]).alias("kind"), F.when(F.col("p_size") > 25, "large").alias("size"), F.lit("Polygon").alias("geometry_type"))
    out = buildings.simplified_landuse(rows, {"kind": ["economy", "small"], "size": True}, {"compact": ["small", "economy"]})
    return out.select("p_partkey", "landuse_simplified")


@query("""
SELECT s_suppkey AS id, CASE WHEN s_suppkey % 3 = 0 THEN NULL ELSE n1.n_regionkey * 10 END AS forward, CASE WHEN s_suppkey % 3 = 0 THEN 50 ELSE (n1.n_regionkey * 10 + n2.n_regionkey * 10) // 2 END AS speed
FROM supplier JOIN nation n1 ON n1.n_nationkey = s_suppkey % 25 JOIN nation n2 ON n2.n_nationkey = s_suppkey * 7 % 25
""")
def car_speed_merge(spark, sf_dir):
    """Speeds of both directions through patterns (NET-14, JS-05, MA-03)."""
    streets = table(spark, sf_dir, "supplier").select(F.col("s_suppkey").alias("id"))
    traffic = table(spark, sf_dir, "supplier").where("s_suppkey % 3 <> 0").select(F.col("s_suppkey").alias("id"), (F.col("s_suppkey") % 25).alias("t_hin"), (F.col("s_suppkey") * 7 % 25).alias("t_rueck"))
    patterns = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("pattern_id"), (F.col("n_regionkey") * 10).alias("h08"))
    out = networks.speeds(streets, traffic, patterns)
    return out.select("id", F.col("speed_forward.h08").alias("forward"), networks.mean_speed(F.col("speed_forward.h08"), F.col("speed_backward.h08"), F.lit(50)).alias("speed"))


@query(f"""
WITH p AS (SELECT c_custkey, {XY.format(k="c_custkey")} FROM customer), z AS (SELECT n_nationkey, {XY.format(k="(n_nationkey + 1)")} FROM nation)
SELECT c_custkey, n_nationkey FROM p JOIN z ON abs(round(100 * p.x) - round(100 * z.x)) + abs(round(100 * p.y) - round(100 * z.y)) <= 150
""")
def points_in_polygons(spark, sf_dir):
    """Points in diamonds, boundary included (JN-11, GEO-01, GEO-15, POPU-02)."""
    whole = lambda rows, k: coordinates(rows, k).withColumns({c: F.round(F.col(c) * 100) for c in "xy"})
    zones = whole(table(spark, sf_dir, "nation").withColumn("k", F.col("n_nationkey").cast("long") + 1), "k")
    corner = lambda dx, dy: geo.point(F.col("x") + dx, F.col("y") + dy)
    ring = F.array(corner(150, 0), corner(0, 150), corner(-150, 0), corner(0, -150), corner(150, 0))
    pairs = sj.points_in_polygons(whole(table(spark, sf_dir, "customer"), "c_custkey"), zones.withColumn("geom", F.array(ring)), 300.0)
    return pairs.select(F.col("l.c_custkey").alias("c_custkey"), F.col("r.n_nationkey").alias("n_nationkey"))


@query(f"""
WITH a AS (SELECT s_suppkey, {XY.format(k="s_suppkey")} FROM supplier), b AS (SELECT n_nationkey, {XY.format(k="(n_nationkey + 1)")} FROM nation)
SELECT s_suppkey, n_nationkey, round(greatest(least(a.x, b.x) + 1 - greatest(a.x, b.x), 0) * greatest(least(a.y, b.y) + 1 - greatest(a.y, b.y), 0), 4) AS overlap
FROM a JOIN b ON abs(a.x - b.x) < 1 AND abs(a.y - b.y) < 1
""")
def polygon_overlaps(spark, sf_dir):
    """Areas that polygons share (JN-16, BLD-04, GEO-06, GEO-09)."""
    def squares(rows: DataFrame) -> DataFrame:
        c = lambda dx, dy: geo.point(F.col("x") + dx, F.col("y") + dy)
        return rows.withColumn("geom", F.array(F.array(c(0, 0), c(1, 0), c(1, 1), c(0, 1), c(0, 0))))

    a = squares(coordinates(table(spark, sf_dir, "supplier"), "s_suppkey"))
    b = squares(coordinates(table(spark, sf_dir, "nation").withColumn("k", F.col("n_nationkey").cast("long") + 1), "k"))
    out = buildings.overlaps(a, b, "s_suppkey", "n_nationkey", 1.0)
    return out.select(F.col("a_id").alias("s_suppkey"), F.col("b_id").alias("n_nationkey"), F.round("overlap", 4).alias("overlap")).where("overlap > 0")


@query("""
WITH t AS (SELECT o_orderkey % 50 AS stop, o_orderkey % 12 AS kind FROM orders),
m AS (SELECT DISTINCT stop, CASE WHEN kind IN (0, 5) THEN 'tram' WHEN kind = 1 THEN 'metro' WHEN kind = 2 THEN 'rail' WHEN kind IN (3, 11) THEN 'bus' ELSE 'other' END AS mode FROM t)
SELECT stop AS stop_id, array_to_string(list_sort(list(mode)), ',') AS modes,
       CASE WHEN list_contains(list(mode), 'metro') THEN 'subway_station' WHEN list_contains(list(mode), 'rail') THEN 'rail_station' WHEN list_contains(list(mode), 'tram') THEN 'tram_stop' WHEN list_contains(list(mode), 'bus') THEN 'bus_stop' ELSE 'other' END AS category,
       CASE WHEN stop % 3 = 1 THEN 'yes' WHEN stop % 3 = 2 THEN 'no' ELSE 'unknown' END AS wheelchair
FROM m WHERE stop % 10 <> 9 GROUP BY stop
""")
def stop_classification(spark, sf_dir):
    """Modes, category and access of stops (GTF-09, GTF-12, JN-21, JS-07)."""
    o = table(spark, sf_dir, "orders").select((F.col("o_orderkey") % 50).alias("stop_id"), (F.col("o_orderkey") % 12).alias("route_type")).distinct()
    stops = o.select("stop_id").distinct().withColumns({"parent_station": F.lit(None).cast("long"), "location_type": F.when(F.col("stop_id") % 10 == 9, "1").otherwise("0"), "wheelchair_boarding": (F.col("stop_id") % 3).cast("string")})
    return transit.classified_stops(stops, o).select("stop_id", F.array_join("modes", ",").alias("modes"), "category", "wheelchair")


@query("SELECT n_nationkey AS id, CASE WHEN n_nationkey % 4 = 0 THEN 'new' ELSE n_name END AS name FROM nation UNION ALL SELECT s_suppkey + 24, 'extra' FROM supplier WHERE s_suppkey < 6 AND s_suppkey + 24 > 24")
def table_maintenance(spark, sf_dir):
    """Insert where absent, update from another table (SNK-04 to SNK-06)."""
    old = table(spark, sf_dir, "nation").select(F.col("n_nationkey").cast("long").alias("id"), F.col("n_name").alias("name"))
    extra = table(spark, sf_dir, "supplier").where("s_suppkey < 6").select((F.col("s_suppkey") + 24).alias("id"), F.lit("extra").alias("name"))
    changes = old.where("id % 4 = 0").select("id", F.lit("new").alias("name"))
    return rel.insert_absent(rel.update_from(old, changes, ["id"], ["name"]), extra, ["id"])


@query("""
SELECT l_returnflag, l_linestatus, count(*)::BIGINT AS n, round(sum(l_quantity), 2) AS quantity, round(max(l_extendedprice) - min(l_extendedprice), 2) AS spread, (count(*) FILTER (l_discount > 0.05))::BIGINT AS discounted
FROM lineitem WHERE l_shipdate BETWEEN TIMESTAMP '1994-01-01' AND TIMESTAMP '1997-12-31' AND l_linenumber IN (1, 2, 3) GROUP BY ALL
""")
def filtered_aggregates(spark, sf_dir):
    """Filters and grouped aggregates (FLT-01, FLT-08, AG-01 to AG-03)."""
    rows = table(spark, sf_dir, "lineitem").where("l_shipdate between timestamp'1994-01-01' and timestamp'1997-12-31' and l_linenumber in (1, 2, 3)")
    return rows.groupBy("l_returnflag", "l_linestatus").agg(F.count(F.lit(1)).alias("n"), F.round(F.sum("l_quantity"), 2).alias("quantity"), F.round(F.max("l_extendedprice") - F.min("l_extendedprice"), 2).alias("spread"), F.count_if(F.col("l_discount") > 0.05).alias("discounted"))


@query("SELECT c_custkey, o_orderkey, o_totalprice FROM customer LEFT JOIN LATERAL (SELECT o_orderkey, o_totalprice FROM orders WHERE o_custkey = c_custkey ORDER BY o_totalprice DESC, o_orderkey LIMIT 1) ON TRUE")
def top_order_per_customer(spark, sf_dir):
    """Top row per row, kept where there is none (JN-08, JN-09, SO-02)."""
    o = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey")).agg(F.max(F.struct("o_totalprice", (-F.col("o_orderkey")).alias("order"), "o_orderkey")).alias("best"))
    return table(spark, sf_dir, "customer").select("c_custkey").join(o, "c_custkey", "left").select("c_custkey", "best.o_orderkey", "best.o_totalprice")


@query(f"""
WITH s AS (SELECT s_suppkey, {XY.format(k="s_suppkey")} FROM supplier)
SELECT s_suppkey, 'POINT(' || x::DECIMAL(6, 2) || ' ' || y::DECIMAL(6, 2) || ')' AS wkt, floor(x / 2.5)::BIGINT AS gx, floor(y / 2.5)::BIGINT AS gy, round(6378137.0 * radians(x), 4) AS mx FROM s
""")
def point_formats(spark, sf_dir):
    """Text, cells and projection of points (GEO-10, GEO-16, GEO-20, BLD-01)."""
    rows = coordinates(table(spark, sf_dir, "supplier"), "s_suppkey")
    p = F.struct(F.col("x").cast("decimal(6,2)").alias("x"), F.col("y").cast("decimal(6,2)").alias("y"))
    grid = buildings.grid_units(rows, 2.5)
    return grid.select("s_suppkey", geo.wkt_point(p).alias("wkt"), F.col("grid_x").alias("gx"), F.col("grid_y").alias("gy"), F.round(geo.mercator_x(F.col("x")), 4).alias("mx"))
