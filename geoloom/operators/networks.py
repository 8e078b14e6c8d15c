"""Routing networks: slopes and impedances, ways and segments, islands, street data, and XML for routing tools."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.functions import text as ft
from geoloom.functions.geometry import distance, interpolated, legs, length, length_metres, point, to_mercator
from geoloom.functions.lines import grid_pieces, located, points_at
from geoloom.operators.lineage import checkpointed, forget
from geoloom.operators.relational import numbered, rebased, running_total
from geoloom.operators.spatial_joins import idw
from geoloom.sources.writers import rewrite_partitions

#: Effort added per percent of slope up and down; slopes beyond the limit count as these fixed efforts.
UP_EFFORT, DOWN_EFFORT, SLOPE_LIMIT, STEEP_UP, STEEP_DOWN = 0.0430815, 0.0363248, 9, 3.0, 0.65


def sample_distances(metres: Column, interval: float = 10.0) -> Column:
    """Shares of a line's length at which its height is sampled: both ends, every `interval` of lines over two of them, the
    middle of lines between one and two. A line of exactly two intervals has its ends only."""
    steps = F.floor(metres / interval).cast("int")
    inner = F.transform(F.sequence(F.lit(0), steps), lambda i: i * interval / metres)
    middle = (metres > interval) & (metres < 2 * interval)
    return F.when(metres > 2 * interval, F.concat(F.filter(inner, lambda s: s < 1), F.array(F.lit(1.0)))).when(middle, F.array(F.lit(0.0), F.lit(0.5), F.lit(1.0))).otherwise(F.array(F.lit(0.0), F.lit(1.0)))


def slope_points(line: Column, metres: Column, interval: float = 10.0) -> Column:
    """Points along a line whose heights make its profile."""
    return points_at(line, sample_distances(metres, interval))


def slope_profile(segments: DataFrame, pixels: DataFrame, radius: float, key: str = "id", line: str = "geom", metres: str = "length_m", interval: float = 10.0, pixel_id: str = "pixel", value: str = "val") -> DataFrame:
    """Segments with impedance_slope, impedance_slope_reverse and slope_average from the heights along them.

    Heights are weighted means of up to three pixels within `radius` of each sample; of pixels at the sample itself the
    greatest decides. Segments with a sample that has no pixel in reach have nulls.
    """
    at = F.posexplode(slope_points(F.col(line), F.col(metres), interval)).alias("i", "p")
    samples = segments.select(F.col(key).alias("k"), at).select(F.struct("k", "i").alias("sample"), F.col("p.x").alias("x"), F.col("p.y").alias("y"))
    heights = idw(samples, pixels, radius, "sample", pixel_id, value, name="height", greatest=True)
    found = heights.groupBy(F.col("sample.k").alias("profile_key")).agg(F.array_sort(F.collect_set(F.struct("sample.i", "height"))).alias("profile"))
    joined = segments.join(found, segments[key] == F.col("profile_key"), "left")
    whole = F.size("profile") == F.size(sample_distances(F.col(metres), interval))
    effort = F.when(whole, impedance(F.col("profile.height"), F.col(metres), interval))
    done = joined.withColumn("profile", effort)
    return done.withColumns({"impedance_slope": F.col("profile.up"), "impedance_slope_reverse": F.col("profile.down"), "slope_average": F.col("profile.average")}).drop("profile", "profile_key")


def recomputed_slopes(spark: SparkSession, path: str, pixels: DataFrame, radius: float, cells: Sequence[int], cell: str = "cell", key: str = "id") -> None:
    """Slopes of the segments of some cells worked out again, in a table partitioned by cell.

    Only the partitions of those cells are read and replaced; doing it again changes nothing. A cell without segments is
    left alone. Each partition is replaced as a whole when the job ends, so a job that fails leaves the table as it was.
    """
    own = spark.read.parquet(path)
    order = own.columns
    wanted = own.where(F.col(cell).isin(list(cells))).drop("impedance_slope", "impedance_slope_reverse", "slope_average")
    rewrite_partitions(slope_profile(wanted, pixels, radius, key=key).select(*order), path, [cell])


def with_status(rows: DataFrame, valid: Column, results: Sequence[str], status: str = "preparation_status") -> DataFrame:
    """Rows with status p, or e and no results where they aren't valid: one bad row takes no other along."""
    fine = F.coalesce(valid, F.lit(False))
    return rows.withColumns({c: F.when(fine, F.col(c)) for c in results} | {status: F.when(fine, "p").otherwise("e")})


def section_effort(slope: Column) -> Column:
    """Relative effort of a section by its slope in percent, downhill negative; 1 on the level."""
    return F.when(slope > SLOPE_LIMIT, F.lit(STEEP_UP)).when(slope >= 0, 1 + slope * UP_EFFORT).when(slope >= -SLOPE_LIMIT, 1 + slope * DOWN_EFFORT).otherwise(F.lit(STEEP_DOWN))


def impedance(heights: Column, metres: Column, interval: float) -> Column:
    """struct<up,down,average>: effort beyond the level in both directions, weighted by length, and the mean slope in whole percent.

    Sections are `interval` long, the last takes the rest, and a link between one and two intervals has two halves.
    Null for fewer than two heights.
    """
    n = F.size(heights)
    halves = (metres > interval) & (metres < 2 * interval)
    last = F.when(metres > 2 * interval, metres - (n - 2) * interval).when(halves, metres / 2).otherwise(metres)
    usual = F.when(halves, metres / 2).otherwise(F.lit(float(interval)))
    run = lambda i: F.when(i == n - 1, last).otherwise(usual)
    rows = F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.struct(run(i).alias("run"), (F.try_divide(F.get(heights, i) - F.get(heights, i - 1), run(i)) * 100).alias("slope")))
    zero = F.struct(F.lit(0.0).alias("up"), F.lit(0.0).alias("down"), F.lit(0.0).alias("slopes"))
    add = lambda t, s: F.struct((t["up"] + s["run"] / metres * section_effort(s["slope"])).alias("up"), (t["down"] + s["run"] / metres * section_effort(-s["slope"])).alias("down"), (t["slopes"] + F.abs(s["slope"])).alias("slopes"))
    done = lambda t: F.struct((t["up"] - 1).alias("up"), (t["down"] - 1).alias("down"), F.rint(t["slopes"] / (n - 1)).cast("int").alias("average"))
    return F.when(n >= 2, F.aggregate(rows, zero, add, done))


#: Attributes that a way takes from its map line as they are, by tag; in lower case; and numbers.
TAGS = {"bicycle_road": "bicycle_road", "cycleway": "cycleway", "parking": "parking", "parking_lane_both": "parking:lane:both", "parking_lane_right": "parking:lane:right", "parking_lane_left": "parking:lane:left", "segregated": "segregated", "sidewalk": "sidewalk", "smoothness": "smoothness"}
WAY_RESULTS = ("foot", "bicycle", "sidewalk_both_width", "sidewalk_left_width", "sidewalk_right_width", "highway", "surface", *TAGS, "lit", "wheelchair", "lanes", "incline_percent", "length_m", "length_3857", "coordinates_3857", "s_imp", "rs_imp", "impedance_surface", "maxspeed_forward", "maxspeed_backward")


def classified_ways(ways: DataFrame, lines: DataFrame, surface_effort: Mapping[str, float], pixels: DataFrame | None = None, radius: float = 0.0, living_street_cap: int = 7, steepest: int = 6) -> DataFrame:
    """Ways (key `gid`, line `geom` in degrees) with the attributes of their map line, lengths, and slopes if there are heights.

    The pedestrian attribute is empty for bridleways, cycleways, footways and ways without a kind, and `no` on service ways
    for buses. Sidewalk widths, of all sides, count where that of both sides is a number. Living streets are capped in both
    directions where the forward speed is over the cap. Stairs, and slopes over `steepest` percent, are closed to
    wheelchairs. A way without a line keeps its own columns and has nulls; lines that repeat an id count once.
    """
    col, tag = F.col, lambda k: F.col("line_tags")[k]
    known = F.create_map(*[F.lit(x) for pair in surface_effort.items() for x in pair]) if surface_effort else F.create_map().cast("map<string,double>")
    found = lines.select("osm_id", *[F.lower(c).alias(f"line_{c}") for c in ("highway", "foot", "bicycle", "surface")], col("highway").alias("line_kind"), col("tags").alias("line_tags")).dropDuplicates(["osm_id"])
    rows = ways.withColumns({"length_m": length_metres(col("geom")), "length_3857": length(F.transform("geom", to_mercator)), "coordinates_3857": F.to_json(F.transform("geom", lambda p: F.array(to_mercator(p)["x"], to_mercator(p)["y"])))})
    if pixels is None:
        rows = rows.withColumns({"s_imp": F.lit(None).cast("double"), "rs_imp": F.lit(None).cast("double"), "incline_percent": F.lit(None).cast("int")})
    else:
        rows = slope_profile(rows, pixels, radius, key="gid").withColumnsRenamed({"impedance_slope": "s_imp", "impedance_slope_reverse": "rs_imp", "slope_average": "incline_percent"})
    joined = rows.join(found, "osm_id", "left")
    for_buses = (col("line_kind") == "service") & (tag("psv").isNotNull() | F.coalesce(tag("bus") == "yes", F.lit(False)))
    foot = F.when(for_buses, "no").when(~col("line_kind").isin("bridleway", "cycleway", "footway"), col("line_foot"))
    width = lambda side: F.when(tag("sidewalk:both:width").rlike("^[0-9.]*$"), ft.guarded_number(tag(f"sidewalk:{side}:width")))
    closed = (col("line_highway") == "stairs") | (F.abs(col("incline_percent")) > steepest)
    capped = (col("line_highway") == "living_street") & (col("maxspeed_forward") > living_street_cap)
    cap = lambda c: F.when(capped, F.lit(living_street_cap)).otherwise(col(c))
    out = {"foot": foot, "bicycle": col("line_bicycle"), "highway": col("line_highway"), "surface": col("line_surface"), "impedance_surface": known[col("line_surface")], "lit": F.lower(tag("lit")), "lanes": tag("lanes").try_cast("double")}
    out |= {f"sidewalk_{side}_width": width(side) for side in ("both", "left", "right")} | {name: tag(key) for name, key in TAGS.items()}
    out |= {"wheelchair": F.when(closed, "no").otherwise(F.lower(tag("wheelchair"))), "maxspeed_forward": cap("maxspeed_forward"), "maxspeed_backward": cap("maxspeed_backward")}
    return joined.withColumns(out).drop(*[c for c in joined.columns if c.startswith("line_")])


def end_nodes(ways: DataFrame, line: str = "geom") -> DataFrame:
    """Distinct end points of ways with the ids that ways give them."""
    first = ways.select(F.col("source").alias("id"), F.get(F.col(line), F.lit(0)).alias("geom"))
    last = ways.select(F.col("target").alias("id"), F.element_at(F.col(line), -1).alias("geom"))
    return first.unionByName(last).groupBy("id").agg(F.min("geom").alias("geom"))


def with_new_ids(ways: DataFrame, last_node: int, last_edge: int, key: str = "gid") -> DataFrame:
    """Ways with ids, and ids of their end nodes, that go on from the last ones in use; the way's old id stays as `old_<key>`."""
    ends = ways.select(F.explode(F.array("source", "target")).alias("end_id")).where("end_id is not null").distinct()
    nodes = numbered(ends, ["end_id"], "new_end", last_node + 1)
    out = rebased(ways, key, last_edge)
    for end in ("source", "target"):
        own = nodes.select(F.col("end_id").alias(f"{end}_old"), F.col("new_end").alias(f"{end}_new"))
        out = out.join(own, F.col(end) == F.col(f"{end}_old"), "left").withColumn(end, F.col(f"{end}_new")).drop(f"{end}_old", f"{end}_new")
    return out


def crossings(points: DataFrame) -> DataFrame:
    """Street crossings with one kind each: objects tagged as a crossing or as signals, or whose signals are for pedestrians.

    The kind is traffic_signals where the tag traffic_signals says crossing or pedestrian_crossing, else the crossing
    reference, the crossing, or the highway tag, whichever is there first.
    """
    tag = lambda name: F.col("tags")[name]
    found = tag("crossing").isNotNull() | F.coalesce(F.col("highway").isin("crossing", "traffic_signals"), F.lit(False)) | F.coalesce(tag("traffic_signals") == "pedestrian_crossing", F.lit(False))
    signals = F.coalesce(tag("traffic_signals").isin("crossing", "pedestrian_crossing"), F.lit(False))
    kind = F.when(signals, "traffic_signals").otherwise(F.coalesce(tag("crossing_ref"), tag("crossing"), F.col("highway")))
    named = {x: tag(x) for x in ("traffic_signals", "kerb", "segregated", "supervised", "tactile_paving", "wheelchair")}
    return points.where(found).withColumns({"crossing": kind, **named, "source": F.lit("osm")})


def split_at_connectors(segments: DataFrame, shares: str = "shares") -> DataFrame:
    """Segments cut at their connectors: struct<share,id> in `shares`, two at least; pieces keep their order as `part`."""
    ordered = F.array_sort(F.col(shares))
    pairs = F.transform(F.sequence(F.lit(1), F.size(ordered) - 1), lambda i: F.struct(F.get(ordered, i - 1).alias("a"), F.get(ordered, i).alias("b")))
    rows = segments.where(F.size(shares) >= 2).select("*", F.posexplode(pairs).alias("part", "ends"))
    piece = between(F.col("geom"), F.col("ends.a.share"), F.col("ends.b.share"))
    return rows.withColumns({"geom": piece, "source": F.col("ends.a.id"), "target": F.col("ends.b.id"), "id": F.concat_ws("_", F.col("id"), F.col("part").cast("string"))}).drop("ends")


def between(line: Column, start: Column, stop: Column) -> Column:
    """The part of a line between two shares of its length: one running sum of its legs gives every vertex its share."""
    steps = F.transform(legs(line), lambda s: distance(s["a"], s["b"]))
    first = F.array(F.lit(0.0))
    reach = F.aggregate(steps, first, lambda done, step: F.array_append(done, F.element_at(done, -1) + step))
    shares = F.transform(F.array(reach), lambda r: F.transform(r, lambda x: F.try_divide(x, F.element_at(r, -1))))
    inner = F.flatten(F.transform(shares, lambda r: F.filter(line, lambda p, i: (F.get(r, i) > start) & (F.get(r, i) < stop))))
    return F.concat(F.array(interpolated(line, start)), inner, F.array(interpolated(line, stop)))


def clipped_to_grid(segments: DataFrame, cell: float) -> DataFrame:
    """Segments cut where they go from one square cell to another, with their cell and length.

    A segment inside one cell stays as it is, with its id and ends, however many vertices it has. The pieces of others are
    <id>_clip_<i>, counted from 1; where two meet, the connector is connector.<id>_clip_<i> of the first. Lines without a
    length stay whole; those without a point are left out.
    """
    rows = grid_pieces(segments, "geom", cell)
    own = lambda i: F.concat(F.col("row.id"), F.lit("_clip_"), i.cast("string"))
    name = lambda i: F.concat(F.lit("connector."), own(i))
    kept = [c for c in segments.columns if c not in ("id", "source", "target", "geom", "cell_x", "cell_y", "length")]
    return rows.select(
        F.when(F.col("n") == 1, F.col("row.id")).otherwise(own(F.col("i") + 1)).alias("id"),
        F.when(F.col("i") == 0, F.col("row.source")).otherwise(name(F.col("i"))).alias("source"),
        F.when(F.col("i") == F.col("n") - 1, F.col("row.target")).otherwise(name(F.col("i") + 1)).alias("target"),
        F.col("piece").alias("geom"),
        "cell_x",
        "cell_y",
        length(F.col("piece")).alias("length"),
        *[F.col(f"row.`{c}`").alias(c) for c in kept],
    )


def sub_segments(segments: DataFrame, connectors: DataFrame) -> DataFrame:
    """Segments (id, connectors, geom) between their connectors (id, geom) in order: <id>_sub_<i>, counted from 1, with source
    and target; those with two connectors at most stay whole. Connectors that aren't known are left out; other columns stay.
    """
    places = connectors.select(F.col("id").alias("place_id"), F.col("geom").alias("place"))
    steps = segments.select("id", "geom", F.posexplode("connectors").alias("i", "c")).join(places, F.col("c") == F.col("place_id"))
    steps = steps.select(F.col("id").alias("of"), F.struct("i", F.col("c").alias("id"), located(F.col("geom"), F.col("place")).alias("share")).alias("step"))
    ordered = steps.groupBy("of").agg(F.array_sort(F.collect_list("step")).alias("steps"))
    rows = segments.join(ordered, F.col("id") == F.col("of"), "left").drop("of")
    n = F.coalesce(F.size("steps"), F.lit(0))
    pairs = F.transform(F.sequence(F.lit(1), n - 1), lambda i: F.struct(F.get("steps", i - 1).alias("a"), F.get("steps", i).alias("b")))
    whole = F.array(F.struct(F.get("steps", F.lit(0)).alias("a"), F.when(n > 1, F.get("steps", n - 1)).alias("b")))
    cut = rows.withColumn("many", n > 2).select("*", F.posexplode(F.when(n > 2, pairs).otherwise(whole)).alias("part", "ends"))
    low, high = F.least("ends.a.share", "ends.b.share"), F.greatest("ends.a.share", "ends.b.share")
    out = {
        "geom": F.when(F.col("many"), between(F.col("geom"), low, high)).otherwise(F.col("geom")),
        "source": F.col("ends.a.id"),
        "target": F.col("ends.b.id"),
        "id": F.when(F.col("many"), F.concat(F.col("id"), F.lit("_sub_"), (F.col("part") + 1).cast("string"))).otherwise(F.col("id")),
    }
    return cut.withColumns(out).drop("steps", "many", "part", "ends", "connectors")


def prepared_segments(segments: DataFrame, connectors: DataFrame, surface_effort: Mapping[str, float], fine: float, coarse: float, pixels: DataFrame | None = None, radius: float = 0.0) -> tuple[DataFrame, DataFrame]:
    """Routable segments and connectors, both with consecutive ids, of segments (id, connectors, geom in degrees, road as JSON).

    Segments are split at their connectors, and where they leave a cell of the fine grid, then of the coarse one. Each has
    its class, flags, first speed limit, effort of its surface (unless that varies along it), lengths, coordinates in
    metres, cells of its middle, and slopes if there are heights. Pieces' ends inside a segment are connectors of their own.
    """
    surface = F.get_json_object("road", "$.surface")
    known = F.create_map(*[F.lit(x) for pair in surface_effort.items() for x in pair]) if surface_effort else F.create_map().cast("map<string,double>")
    own = segments.select("id", "connectors", "geom", F.get_json_object("road", "$.class").alias("class_"), F.get_json_object("road", "$.flags").alias("tags"), F.get_json_object("road", "$.restrictions.speedLimits.maxSpeed[0]").try_cast("int").alias("maxspeed_forward"), known[surface].alias("impedance_surface"))
    cut = clipped_to_grid(sub_segments(own, connectors), fine)
    cut = clipped_to_grid(cut, coarse).withColumnsRenamed({"cell_x": "coarse_x", "cell_y": "coarse_y"})
    metric = F.transform("geom", to_mercator)
    middle = F.get(points_at(F.col("geom"), F.array(F.lit(0.5))), F.lit(0))
    cut = cut.withColumns({"length_m": length_metres(F.col("geom")), "length_3857": length(metric), "coordinates_3857": F.to_json(F.transform(metric, lambda p: F.array(p["x"], p["y"]))), "middle": middle})
    cut = cut.withColumns({"fine_x": F.floor(F.col("middle.x") / fine), "fine_y": F.floor(F.col("middle.y") / fine)}).drop("middle", "length")
    if pixels is not None:
        cut = slope_profile(cut, pixels, radius)
    cut = checkpointed(cut)
    ends = F.array(F.struct(F.col("source").alias("id"), F.get("geom", F.lit(0)).alias("geom")), F.struct(F.col("target").alias("id"), F.element_at("geom", -1).alias("geom")))
    used = cut.select(F.explode(ends).alias("e")).select("e.*").where("id is not null").groupBy("id").agg(F.min("geom").alias("end_geom"))
    known_places = connectors.select(F.col("id").alias("known_id"), F.col("geom").alias("known_geom"))
    nodes = used.join(known_places, F.col("id") == F.col("known_id"), "left").select(F.col("id").alias("name"), F.coalesce("known_geom", "end_geom").alias("geom"))
    nodes = checkpointed(numbered(nodes, ["name"], "id"))
    out = numbered(cut.withColumnRenamed("id", "name"), ["name"], "id")
    for end in ("source", "target"):
        place = nodes.select(F.col("name").alias(f"{end}_name"), F.col("id").alias(f"{end}_id"))
        out = out.join(place, F.col(end) == F.col(f"{end}_name"), "left").withColumn(end, F.col(f"{end}_id")).drop(f"{end}_name", f"{end}_id")
    return out, nodes


def with_lengths(segments: DataFrame) -> DataFrame:
    """Lengths in metres of lines in degrees."""
    return segments.withColumn("length_m", length_metres(F.col("geom")))


#: Edges that one task joins by itself, some ten MB; more are settled in rounds.
ONE_TASK = 1 << 17


def _joined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, component) of all nodes of edges (a, b), by union with the smaller root."""
    root: dict = {}

    def find(x):
        while root.setdefault(x, x) != x:
            root[x] = root[root[x]]
            x = root[x]
        return x

    kind = None
    for batch in batches:
        kind = batch.schema.field(0).type
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            low, high = sorted((find(a), find(b)))
            root[high] = low
    if kind is not None:
        yield pa.record_batch([pa.array(list(root), kind), pa.array([find(x) for x in root], kind)], names=["node", "component"])


def component_of(edges: DataFrame, most_rounds: int = 60, one_task: int = ONE_TASK) -> DataFrame:
    """(node, component): the least node reachable from each, over undirected edges (source, target).

    Up to `one_task` different edges, counted first, are one task's work. More go through alternating large-star and
    small-star rounds; each is checkpointed in the folder that spark.checkpoint.dir names, in place of the one before.
    Components that aren't settled after `most_rounds` are an error, never a result.
    """
    now = checkpointed(edges.select(F.greatest("source", "target").alias("a"), F.least("source", "target").alias("b")).where("a <> b").distinct())
    alone = edges.select(F.col("source").alias("node")).unionAll(edges.select(F.col("target").alias("node"))).where("node is not null").distinct()
    if now.count() <= one_task:
        kind = now.schema["a"].dataType.simpleString()
        found = now.repartition(1).mapInArrow(_joined, f"node {kind}, component {kind}").select(F.col("node").alias("a"), "component")
        return alone.join(found, F.col("node") == F.col("a"), "left").select("node", F.coalesce("component", "node").alias("component"))
    before = None
    for _ in range(most_rounds):
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        large = both.join(least, F.col("a") == F.col("n")).where("b > a and b <> m").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        root = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), "m")
        ends = F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))
        after = checkpointed(large.join(root, F.col("a") == F.col("n")).select(F.explode(ends).alias("e")).select("e.*").where("a <> b").distinct())
        state = after.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        forget(now)
        now = after
        if state == before:
            roots = now.groupBy("a").agg(F.min("b").alias("root"))
            return alone.join(roots, F.col("node") == F.col("a"), "left").select("node", F.coalesce("root", "node").alias("component"))
        before = state
    raise RuntimeError(f"component_of: not settled after {most_rounds} rounds")


def islands(edges: DataFrame, eligible: Column, island_class: int = 701) -> DataFrame:
    """Edges with `class_id` set to `island_class` where they are eligible but not connected to the largest component."""
    usable = edges.where(eligible)
    parts = component_of(usable.select("source", "target"))
    tagged = usable.join(parts, F.col("source") == F.col("node")).select("id", "component")
    biggest = parts.groupBy("component").agg(F.count(F.lit(1)).alias("n")).agg(F.max(F.struct("n", (-F.col("component")).alias("order"), "component")).alias("m")).select(F.col("m.component").alias("main"))
    cut = tagged.crossJoin(F.broadcast(biggest)).where("component <> main").select(F.col("id").alias("cut_id"))
    return edges.join(cut, F.col("id") == F.col("cut_id"), "left").withColumn("class_id", F.when(F.col("cut_id").isNotNull(), F.lit(island_class)).otherwise(F.col("class_id"))).drop("cut_id")


def speeds(streets: DataFrame, traffic: DataFrame, patterns: DataFrame) -> DataFrame:
    """Streets with the speed patterns of both directions through their traffic pattern; streets without stay, without speeds."""
    there = patterns.select(F.col("pattern_id").alias("t_hin"), F.struct([c for c in patterns.columns if c != "pattern_id"]).alias("speed_forward"))
    back = patterns.select(F.col("pattern_id").alias("t_rueck"), F.struct([c for c in patterns.columns if c != "pattern_id"]).alias("speed_backward"))
    with_both = streets.join(traffic, "id").join(there, "t_hin").join(back, "t_rueck").drop("t_hin", "t_rueck")
    rest = streets.join(with_both.select("id"), "id", "left_anti")
    return with_both.unionByName(rest, allowMissingColumns=True)


def mean_speed(forward: Column, backward: Column, default: Column) -> Column:
    """Whole mean of both directions' speeds, or the default of the street's class."""
    return F.coalesce(F.floor((forward + backward) / 2).cast("int"), default)


def coordinate_nodes(streets: DataFrame, line: str = "geom") -> DataFrame:
    """Distinct coordinates of all lines with consecutive ids."""
    points = streets.select(F.explode(line).alias("p")).select("p.x", "p.y").distinct()
    return numbered(points, ["x", "y"], "node_id")


def node_xml(node_id: Column, p: Column) -> Column:
    """OSM XML of a node."""
    return F.format_string('<node id="%s" lat="%s" lon="%s" version="1"/>', node_id.cast("string"), p["y"].cast("string"), p["x"].cast("string"))


def way_xml(way_id: Column, refs: Column, tags: Column) -> Column:
    """OSM XML of a way: node references in line order, tags in key order, without double quotes in values."""
    nodes = F.array_join(F.transform(refs, lambda r: F.concat(F.lit('<nd ref="'), r.cast("string"), F.lit('"/>'))), "")
    pairs = F.array_sort(F.map_entries(tags))
    marks = F.array_join(F.transform(pairs, lambda e: F.concat(F.lit('<tag k="'), e["key"], F.lit('" v="'), ft.xml_escape(e["value"]), F.lit('"/>'))), "")
    return F.concat(F.lit('<way id="'), way_id.cast("string"), F.lit('" version="1">'), nodes, marks, F.lit("</way>"))


def ways_as_osm(ways: DataFrame, start: int = 1, line: str = "geom") -> DataFrame:
    """(kind, id, xml) of every way and its own nodes; node ids count on from `start` in the order of ways and points."""
    sized = running_total(ways.withColumn("points", F.size(line)), ["id"], F.col("points"), "points_so_far")
    rows = sized.withColumn("first_node", F.col("points_so_far") - F.col("points") + start)
    refs = F.transform(F.sequence(F.lit(0), F.col("points") - 1), lambda i: F.col("first_node") + i)
    nodes = rows.select(F.posexplode(line).alias("i", "p"), "first_node").select(F.lit("node").alias("kind"), (F.col("first_node") + F.col("i")).alias("id"), node_xml(F.col("first_node") + F.col("i"), F.col("p")).alias("xml"))
    return nodes.unionByName(rows.select(F.lit("way").alias("kind"), F.col("id").cast("long").alias("id"), way_xml(F.col("id"), refs, F.col("tags")).alias("xml")))


def on_circle(p: Column, i: Column, n: Column, far: float) -> Column:
    """The i-th of n places on a circle of radius `far` around a point, by whole degrees from north."""
    azimuth = F.radians((F.floor(F.lit(360) / n) * i).cast("double"))
    return point(p["x"] + far * F.sin(azimuth), p["y"] + far * F.cos(azimuth))


def spread_categories(rows: DataFrame, far: float, categories: str = "categories", geom: str = "geom") -> DataFrame:
    """One row per category, in order, on a circle around the row's point."""
    out = rows.select("*", F.size(categories).alias("n"), F.posexplode(F.array_sort(F.col(categories))).alias("i", "category"))
    return out.withColumn(geom, on_circle(F.col(geom), F.col("i"), F.col("n"), far)).drop("n", "i", categories)


def spread_duplicates(rows: DataFrame, key: str, far: float) -> DataFrame:
    """Rows that share their exact point, moved to a circle around it in order of their key."""
    same = rows.groupBy("x", "y").agg(F.array_sort(F.collect_list(key)).alias("keys")).where(F.size("keys") > 1)
    out = same.select("x", "y", F.size("keys").alias("n"), F.posexplode("keys").alias("i", key))
    return out.select(key, on_circle(point(F.col("x"), F.col("y")), F.col("i"), F.col("n"), far).alias("geom"))
