"""Command line: actions over datasets of a region, each with its own settings."""

from __future__ import annotations

import argparse
from collections.abc import Callable, Mapping
from dataclasses import dataclass, field
from pathlib import Path

import yaml
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.functions import collections as fc
from geoloom.operators import buildings, networks, poi, relational, selection, transit
from geoloom.sources import map_extracts, readers, writers

ACTIONS = ("collection", "preparation", "fusion", "export", "migration")


@dataclass(frozen=True)
class Settings:
    """Settings of a dataset in a region: input folder, output folder, and what the YAML file says."""

    source: str
    target: str
    values: Mapping = field(default_factory=dict)

    @classmethod
    def read(cls, path: str) -> Settings:
        """Settings from a YAML file with `source`, `target` and further values."""
        raw = yaml.safe_load(Path(path).read_text(encoding="utf-8"))
        return cls(raw.pop("source"), raw.pop("target"), raw)


def collect_gtfs(spark: SparkSession, s: Settings) -> dict[str, DataFrame]:
    """A feed's text files as typed tables with cells, and their problems: rows (rule, keys) of repeated keys and dead links."""
    feed = readers.read_gtfs(spark, s.source, float(s.values.get("cell", 0.1)), tuple(s.values.get("tables", readers.GTFS)))
    problems = None
    for rule, rows in readers.feed_problems(feed).items():
        found = rows.select(F.lit(rule).alias("rule"), F.to_json(F.struct("*")).alias("keys"))
        problems = found if problems is None else problems.unionAll(found)
    return feed if problems is None else feed | {"problems": problems}


def collect_theme(spark: SparkSession, s: Settings) -> DataFrame:
    """One type of a theme inside a box (`box` with xmin, ymin, xmax, ymax), nested columns as JSON."""
    return readers.flattened(readers.read_theme(spark, s.source, s.values["theme"], s.values["type"], s.values.get("box")))


def collect_extract(spark: SparkSession, s: Settings) -> dict[str, DataFrame]:
    """Points, lines, closed outlines and relations of a map extract that have one of the tags (`filters`), with tags as columns
    (`columns`); with `outline`, a table with one polygon, only objects with a node inside."""
    extract = map_extracts.read_extract(spark, s.source)
    if "outline" in s.values:
        extract = map_extracts.cropped(extract, spark.read.parquet(s.values["outline"]), float(s.values.get("cell", 0.01)))
    wanted = lambda rows: readers.promoted(readers.tagged(rows, s.values["filters"]), s.values.get("columns", []))
    ways = map_extracts.with_lines(extract)
    return {
        "point": wanted(extract.where("kind = 'node'").select("id", "tags", "x", "y")),
        "line": wanted(ways.where("not closed").drop("closed")),
        "polygon": wanted(ways.where("closed").select("id", "tags", F.array("line").alias("geom"))),
        "relation": wanted(extract.where("kind = 'relation'").select("id", "tags", "members")),
    }


def prepare_gtfs(spark: SparkSession, s: Settings) -> DataFrame:
    """Feed to stop times of the trips that run on modal days."""
    feed = readers.read_gtfs(spark, s.source)
    weekday = feed["calendar"].withColumn("weekday", feed["calendar"]["tuesday"])
    dates = transit.sampled_dates(spark, transit.Sampling(str(s.values["start_date"]), int(s.values.get("weeks", 26))))
    active = transit.service_days(weekday, feed["calendar_dates"], dates)
    counts = transit.trip_counts(feed["trips"], active)
    trips = transit.trip_weekdays(feed["trips"], active, transit.modal_days(counts)).join(feed["routes"].select("route_id", "route_type"), "route_id")
    return transit.optimised_stop_times(feed["stop_times"], trips)


def _read(spark: SparkSession, s: Settings, name: str) -> DataFrame:
    return spark.read.parquet(f"{s.source}/{name}")


def prepare_stops(spark: SparkSession, s: Settings) -> DataFrame:
    """Feed to stops with modes, category and wheelchair access; x and y are their degrees."""
    feed = readers.read_gtfs(spark, s.source, tables=("stops", "routes", "trips", "stop_times"))
    by_route = feed["stop_times"].select("stop_id", "trip_id").join(feed["trips"].select("trip_id", "route_id"), "trip_id").select("stop_id", "route_id").distinct()
    types = by_route.join(feed["routes"].select("route_id", "route_type"), "route_id").select("stop_id", "route_type").distinct()
    stops = feed["stops"].withColumns({"location_type": F.coalesce("location_type", F.lit("0")), "x": F.col("stop_lon"), "y": F.col("stop_lat")})
    return transit.classified_stops(stops, types)


def prepare_stations(spark: SparkSession, s: Settings) -> DataFrame:
    """Feed to stations: its own with the modes of their stops, and stops without one by name in tiles of one degree."""
    stops = prepare_stops(spark, s).withColumn("tile", F.concat_ws("_", F.floor("x"), F.floor("y")))
    own = readers.read_gtfs(spark, s.source, tables=("stops",))["stops"].where("location_type = '1'")
    named = own.select("stop_id", "stop_name", F.col("stop_lon").alias("x"), F.col("stop_lat").alias("y"))
    return transit.classified_stations(named, stops).unionByName(transit.stations_from_orphans(stops), allowMissingColumns=True)


def prepare_lines(spark: SparkSession, s: Settings) -> DataFrame:
    """Route relations and their masters to lines."""
    return transit.grouped_lines(_read(spark, s, "lines"), _read(spark, s, "masters"), s.values.get("include", ()), s.values.get("exclude", ()))


def prepare_places(spark: SparkSession, s: Settings) -> DataFrame:
    """Places to points with first phone and website, and tags."""
    return poi.places(spark.read.parquet(s.source), float(s.values.get("confidence", 0.6)))


def prepare_divisions(spark: SparkSession, s: Settings) -> DataFrame:
    """Division areas with their primary name and distinct sources; `subtypes` limits them if given."""
    rows = spark.read.parquet(s.source)
    rows = rows.where(F.col("subtype").isin(list(s.values["subtypes"]))) if "subtypes" in s.values else rows
    found = F.from_json(fc.without_nul(F.col("sources")), "array<struct<dataset:string>>")["dataset"]
    return rows.withColumns({"name": F.get_json_object(fc.without_nul(F.col("names")), "$.primary"), "sources": F.array_join(F.array_sort(F.array_distinct(found)), ", ")}).drop("names")


def prepare_landuse(spark: SparkSession, s: Settings) -> DataFrame:
    """Tagged areas to land-use groups."""
    return buildings.simplified_landuse(spark.read.parquet(s.source), s.values["tags"], s.values["groups"])


def prepare_building(spark: SparkSession, s: Settings) -> DataFrame:
    """Buildings with residential status by the first rule that holds, levels and floor area.

    With `rules` (attribute, points, polygons; tables of the source's folder) buildings are its table `building`, and
    `subtract` names a table of points, each of which takes a level. Without, the source is the table of buildings,
    `no_residents` lists columns with values, and `subtract` names the column of the levels in other use.
    """
    if "rules" in s.values:
        names = {r[k] for r in s.values["rules"] for k in ("points", "polygons") if k in r} | ({s.values["subtract"]} if "subtract" in s.values else set())
        tables = {n: _read(spark, s, n) for n in names}
        return buildings.classified(_read(spark, s, "building"), s.values["rules"], tables, float(s.values.get("cell", 0.05)), s.values.get("subtract"))
    rules = [buildings.attribute_rule(column, values) for column, values in s.values["no_residents"].items()]
    rows = buildings.first_rule(spark.read.parquet(s.source), rules)
    return buildings.floor_area(buildings.residential_levels(rows, s.values["subtract"]))


def prepare_network(spark: SparkSession, s: Settings) -> DataFrame:
    """Ways with the attributes of their map lines; ways without a line keep no results and have status e.

    With a table `pixels` (pixel, x, y, val) and `radius` slopes are computed. With `last_node` and `last_edge` nodes and
    edges get ids that go on from them, the old id of a way stays as `old_gid`. With `island_from`, a list of classes, ways
    of other classes that aren't connected to the largest part by them get class `island_class`.
    """
    lines = _read(spark, s, "lines")
    pixels = _read(spark, s, "pixels") if "radius" in s.values else None
    ways = networks.classified_ways(_read(spark, s, "ways"), lines, s.values["surfaces"], pixels, float(s.values.get("radius", 0.0)))
    known = lines.select(F.col("osm_id").alias("known_id")).distinct()
    ways = ways.join(known, F.col("osm_id") == F.col("known_id"), "left")
    ways = networks.with_status(ways, F.col("known_id").isNotNull(), [c for c in networks.WAY_RESULTS if c in ways.columns]).drop("known_id")
    if "island_from" in s.values:
        ways = ways.withColumnsRenamed({"gid": "id", "tag_id": "class_id"})
        ways = networks.islands(ways, F.col("class_id").isin(list(s.values["island_from"])), int(s.values.get("island_class", 701)))
        ways = ways.withColumnsRenamed({"id": "gid", "class_id": "tag_id"})
    if "last_node" in s.values:
        ways = networks.with_new_ids(ways, int(s.values["last_node"]), int(s.values["last_edge"]))
    return ways


def _overture(spark: SparkSession, s: Settings) -> tuple[DataFrame, DataFrame]:
    pixels = _read(spark, s, "pixels") if "radius" in s.values else None
    return networks.prepared_segments(_read(spark, s, "segments"), _read(spark, s, "connectors"), s.values["surfaces"], float(s.values.get("fine", 0.05)), float(s.values.get("coarse", 1.0)), pixels, float(s.values.get("radius", 0.0)))


def prepare_overture_network(spark: SparkSession, s: Settings) -> DataFrame:
    """Segments of a road network, split, clipped and attributed; with a table `pixels` and `radius` slopes too."""
    return _overture(spark, s)[0]


def prepare_overture_connectors(spark: SparkSession, s: Settings) -> DataFrame:
    """Connectors of those segments, with the ids that segments name."""
    return _overture(spark, s)[1].drop("name")


def prepare_crossings(spark: SparkSession, s: Settings) -> DataFrame:
    """Street crossings of tagged points, one kind each."""
    return networks.crossings(spark.read.parquet(s.source))


def export_network(spark: SparkSession, s: Settings) -> DataFrame:
    """Ways and the nodes of their lines as XML rows."""
    return networks.ways_as_osm(spark.read.parquet(s.source))


def subscribe_poi(spark: SparkSession, s: Settings) -> DataFrame:
    """Points of one category from listed sources inside the subscribed areas."""
    return poi.published(_read(spark, s, "points"), _read(spark, s, "areas"), s.values["category"], s.values["sources"], float(s.values.get("cell", 1.0)))


def migrate_network(spark: SparkSession, s: Settings) -> DataFrame:
    """A network table with what is new, without scenarios; another schema is an error."""
    old, new = _read(spark, s, "old"), _read(spark, s, "new")
    differ = {k: v for k, v in relational.same_schema(old, new).items() if v}
    if differ:
        raise ValueError(f"schemas differ: {differ}")
    return selection.network_inserted(old, new)


def migrate_networks(spark: SparkSession, s: Settings) -> dict[str, DataFrame]:
    """Tables node and edge after a migration, nodes first, and the scenarios to work out again.

    Tables of the source: old_node, old_edge, new_node, new_edge; with `cell` also areas, whose nodes and edges alone are taken
    along; with `modified` a table with the scenario_id of each change. Another schema of either is an error before
    anything is written. Rows of scenarios go, rows whose id is new are added.
    """
    old, new = ({n: _read(spark, s, f"{age}_{n}") for n in ("node", "edge")} for age in ("old", "new"))
    differ = {n: d for n in old if any((d := relational.same_schema(old[n], new[n])).values())}
    if differ:
        raise ValueError(f"schemas differ: {differ}")
    if "cell" in s.values:
        areas, cell = _read(spark, s, "areas"), float(s.values["cell"])
        new = {"node": selection.selected("node", new["node"], areas, cell, edges=new["edge"]), "edge": selection.selected("edge", new["edge"], areas, cell)}
    out = {n: selection.network_inserted(old[n], new[n]) for n in ("node", "edge")}
    if s.values.get("modified"):
        out["scenario"] = _read(spark, s, s.values["modified"]).select("scenario_id").where("scenario_id is not null").distinct()
    return out


def migrate_gtfs(spark: SparkSession, s: Settings) -> dict[str, DataFrame]:
    """Prepared feed tables, in the order that `tables` lists them, in place of those at the target."""
    return {n: _read(spark, s, n) for n in s.values.get("tables", ["stops"])}


def prepare_poi(spark: SparkSession, s: Settings) -> DataFrame:
    """Tagged objects to classified, standardised points."""
    objects = readers.promoted(readers.tagged(spark.read.parquet(s.source), s.values["filters"]), s.values["columns"])
    rules = {k: poi.CategoryRules(**v) for k, v in s.values["rules"].items()}
    return poi.standardised(poi.cascade(objects, rules, objects[s.values["key"]]).where("category is not null"))


def prepare_population(spark: SparkSession, s: Settings) -> DataFrame:
    """Population of areas shared among buildings."""
    read = lambda name: spark.read.parquet(f"{s.source}/{name}")
    return buildings.disaggregated(read("building"), read("sub_study_area"))


def fuse_poi(spark: SparkSession, s: Settings) -> DataFrame:
    """Two sources of points as one."""
    read = lambda name: spark.read.parquet(f"{s.source}/{name}")
    return poi.fused(read("left"), read("right"), float(s.values.get("radius", 0.002)), float(s.values.get("threshold", 0.2)))


def migrate(spark: SparkSession, s: Settings) -> DataFrame:
    """Reviewable difference of two versions of a table."""
    read = lambda name: spark.read.parquet(f"{s.source}/{name}")
    return relational.difference(read("old"), read("new"), s.values["keys"], s.values.get("exclude", ()), with_delete=bool(s.values.get("with_delete", True)))


DATASETS: dict[tuple[str, str], Callable[[SparkSession, Settings], DataFrame]] = {
    ("collection", "gtfs"): collect_gtfs,
    ("collection", "overture"): collect_theme,
    ("collection", "extract"): collect_extract,
    ("preparation", "gtfs"): prepare_gtfs,
    ("preparation", "poi"): prepare_poi,
    ("preparation", "population"): prepare_population,
    ("preparation", "gtfs_stops"): prepare_stops,
    ("preparation", "gtfs_stations"): prepare_stations,
    ("preparation", "osm_pt_lines"): prepare_lines,
    ("preparation", "poi_overture"): prepare_places,
    ("preparation", "overture_division_area"): prepare_divisions,
    ("preparation", "landuse"): prepare_landuse,
    ("preparation", "building"): prepare_building,
    ("preparation", "street_crossings"): prepare_crossings,
    ("preparation", "overture_network"): prepare_overture_network,
    ("preparation", "overture_connectors"): prepare_overture_connectors,
    ("preparation", "network"): prepare_network,
    ("preparation", "subscription"): subscribe_poi,
    ("export", "network"): export_network,
    ("fusion", "poi"): fuse_poi,
    ("migration", "table"): migrate,
    ("migration", "network"): migrate_network,
    ("migration", "networks"): migrate_networks,
    ("migration", "gtfs"): migrate_gtfs,
}


def run(spark: SparkSession, action: str, dataset: str, settings: Settings) -> None:
    """One action on one dataset; the result replaces what is at the target, several tables each their own folder of it."""
    if (action, dataset) not in DATASETS:
        raise ValueError(f"no {action} of {dataset!r}; known: {sorted(DATASETS)}")
    result = DATASETS[action, dataset](spark, settings)
    for name, rows in result.items() if isinstance(result, dict) else [("", result)]:
        writers.write_table(rows, f"{settings.target}/{name}".rstrip("/"), writers.IfExists.REPLACE)


def main(argv: list[str] | None = None) -> None:
    """python -m geoloom.plans.cli -a preparation -d gtfs -r de --settings folder"""
    parser = argparse.ArgumentParser(description=__doc__)
    parser.add_argument("-a", "--actions", required=True, help=", ".join(ACTIONS))
    parser.add_argument("-d", "--datasets", required=True)
    parser.add_argument("-r", "--region", required=True)
    parser.add_argument("--settings", required=True, help="folder with <dataset>/<dataset>_<region>.yaml")
    args = parser.parse_args(argv)
    spark = SparkSession.builder.getOrCreate()
    for action in args.actions.split(","):
        if action not in ACTIONS:
            parser.error(f"unknown action {action!r}")
        for dataset in args.datasets.split(","):
            run(spark, action, dataset, Settings.read(f"{args.settings}/{dataset}/{dataset}_{args.region}.yaml"))


if __name__ == "__main__":
    main()
