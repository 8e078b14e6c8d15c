"""Timetables: sampled service counts, modal days, active trips, stop times, stops and stations, lines."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from geoloom.functions import collections as fc
from geoloom.operators.relational import modal_value

#: Dominance of modes at a stop that several serve.
MODE_ORDER = ("metro", "rail", "tram", "bus", "other")
CATEGORY_OF_MODE = {"bus": "bus_stop", "tram": "tram_stop", "metro": "subway_station", "rail": "rail_station", "other": "other"}


def mode_of_route_type(route_type: Column) -> Column:
    """Mode of a basic or extended route type code, by the ranges that the public feed format defines."""
    t = route_type.cast("int")
    return (
        F.when((t == 0) | (t == 5) | t.between(900, 999), "tram")
        .when((t == 1) | t.between(400, 404), "metro")
        .when((t == 2) | t.between(100, 199), "rail")
        .when((t == 3) | (t == 11) | t.between(200, 299) | t.between(700, 799) | (t == 800), "bus")
        .when(t.isNotNull(), "other")
    )


@dataclass(frozen=True)
class Sampling:
    """Dates to count services on: a Tuesday, the Saturday and the Sunday after it, for a number of weeks."""

    start: str
    weeks: int = 26
    offsets: Sequence[tuple[str, int]] = (("weekday", 0), ("saturday", 4), ("sunday", 5))


def sampled_dates(spark, sampling: Sampling) -> DataFrame:
    """(date, day_type) of a sampling, both ends included."""
    weeks = spark.sql(f"SELECT explode(sequence(DATE'{sampling.start}', DATE'{sampling.start}' + INTERVAL {7 * sampling.weeks} DAYS, INTERVAL 7 DAYS)) AS tuesday")
    days = F.array(*[F.struct(F.date_add("tuesday", n).alias("date"), F.lit(d).alias("day_type")) for d, n in sampling.offsets])
    return weeks.select(F.explode(days).alias("d")).select("d.*")


def service_days(calendar: DataFrame, exceptions: DataFrame, dates: DataFrame, dedupe_added: bool = False) -> DataFrame:
    """(service_id, date, day_type, active): how often a service runs on each sampled date.

    calendar: service_id, start_date, end_date and flags weekday, saturday, sunday. exceptions: service_id, date,
    exception_type (1 added, 2 removed). A regular day counts once unless it is removed; an added day counts once more,
    also where it was regular, unless dedupe_added. Services meet dates by week, so that many services and dates make no
    pairs but those of a week that both have.
    """
    week = lambda day: F.floor(F.datediff(day, F.lit("1970-01-05")) / 7)
    weeks = F.when(F.col("end_date") >= F.col("start_date"), F.sequence(week(F.col("start_date")), week(F.col("end_date"))))
    by_week = dates.withColumn("service_week", week(F.col("date")))
    flag = F.when(F.col("day_type") == "saturday", F.col("saturday")).when(F.col("day_type") == "sunday", F.col("sunday")).otherwise(F.col("weekday"))
    windows = calendar.withColumn("service_week", F.explode(weeks))
    regular = windows.join(by_week, "service_week").where(F.col("date").between(F.col("start_date"), F.col("end_date"))).where(flag.cast("int") == 1).select("service_id", "date", "day_type")
    removed = exceptions.where("exception_type = 2").select("service_id", "date")
    regular = regular.join(removed, ["service_id", "date"], "left_anti")
    added = exceptions.where("exception_type = 1").join(dates, "date").select("service_id", "date", "day_type")
    rows = regular.unionByName(added)
    rows = rows.distinct() if dedupe_added else rows
    return rows.groupBy("service_id", "date", "day_type").agg(F.count(F.lit(1)).alias("active"))


def trip_counts(trips: DataFrame, active: DataFrame) -> DataFrame:
    """(route_id, date, day_type, trip_cnt): trips of each route on each sampled date on which one runs."""
    per_service = trips.groupBy("route_id", "service_id").agg(F.count(F.lit(1)).alias("trips"))
    return per_service.join(active, "service_id").groupBy("route_id", "date", "day_type").agg(F.sum(F.col("trips") * F.col("active")).alias("trip_cnt"))


def modal_days(counts: DataFrame) -> DataFrame:
    """Per route and day type the modal number of trips and the earliest date that has it."""
    return modal_value(counts, ["route_id", "day_type"], "trip_cnt", "date")


def trip_weekdays(trips: DataFrame, active: DataFrame, modal: DataFrame) -> DataFrame:
    """(trip_id, route_id, weekdays array<boolean>, weekday_dates array<date>): day types on whose modal date a trip runs."""
    days = ("weekday", "saturday", "sunday")
    at = modal.select("route_id", "day_type", "date")
    runs = trips.select("trip_id", "route_id", "service_id").join(active.drop("active"), "service_id").join(at, ["route_id", "day_type", "date"])
    flags = [F.bool_or(F.col("day_type") == d).alias(f"on_{d}") for d in days] + [F.min(F.when(F.col("day_type") == d, F.col("date"))).alias(f"at_{d}") for d in days]
    out = runs.groupBy("trip_id", "route_id").agg(*flags)
    return out.select("trip_id", "route_id", F.array(*[f"on_{d}" for d in days]).alias("weekdays"), F.array(*[f"at_{d}" for d in days]).alias("weekday_dates"))


def trips_by_cell(trips: DataFrame, shapes: DataFrame, cell: str = "cell") -> DataFrame:
    """Trips once for each cell that their shape runs through; trips without a known shape are left out."""
    through = shapes.select(F.col("shape_id").alias("known_shape"), cell).distinct()
    return trips.join(through, F.col("shape_id") == F.col("known_shape")).drop("known_shape")


def optimised_stop_times(stop_times: DataFrame, trips: DataFrame, cell: str = "cell") -> DataFrame:
    """Stop times of active trips; of equal (stop, arrival, weekdays, cell) the row of the least trip stays.

    Trips that are given by cell (trips_by_cell) meet the stop times of their cell alone. Rows of a group are combined
    before the shuffle.
    """
    joined = stop_times.join(trips, ["trip_id", cell] if cell in trips.columns else ["trip_id"])
    keys = ["stop_id", "arrival_time", "weekdays", cell]
    return joined.groupBy(*keys).agg(F.min("trip_id").alias("trip_id"), F.min_by("route_id", "trip_id").alias("route_id"), F.min_by("route_type", "trip_id").alias("route_type"))


def shape_extent(shapes_in_regions: DataFrame, cell: str = "cell") -> DataFrame:
    """(region_id, shape_id, cell, shape_dist_traveled): how far each shape runs inside each region and cell."""
    return shapes_in_regions.groupBy("region_id", "shape_id", cell).agg((F.max("shape_dist_traveled") - F.min("shape_dist_traveled")).alias("shape_dist_traveled"))


def with_cells(stop_times: DataFrame, stops: DataFrame, cell: str = "cell") -> DataFrame:
    """Stop times with the cell of their stop."""
    return stop_times.join(stops.select("stop_id", cell), "stop_id", "left")


def classified_stops(stops: DataFrame, route_types: DataFrame, wheelchair: Mapping[str, str] | None = None) -> DataFrame:
    """Stops with modes, dominant category and wheelchair access, their own or else their parent's.

    stops: stop_id, parent_station, location_type, wheelchair_boarding; route_types: stop_id, route_type. Stations
    (location_type 1) are left out, as are rows whose location type is null.
    """
    names = wheelchair or {"0": "unknown", "1": "yes", "2": "no"}
    modes = route_types.select("stop_id", mode_of_route_type(F.col("route_type")).alias("mode")).groupBy("stop_id").agg(F.array_sort(F.collect_set("mode")).alias("modes"))
    parents = stops.select(F.col("stop_id").alias("parent_id"), F.col("wheelchair_boarding").alias("parent_wheelchair"))
    joined = stops.where("location_type <> '1'").join(modes, "stop_id").join(parents, F.col("parent_station") == F.col("parent_id"), "left")
    own = lambda c: F.when(c.isin("1", "2"), c)
    access = F.coalesce(own(F.col("wheelchair_boarding")), own(F.col("parent_wheelchair")), F.lit("0"))
    dominant = F.coalesce(*[F.when(F.array_contains("modes", m), F.lit(m)) for m in MODE_ORDER])
    return joined.withColumns({"category": fc.lookup(CATEGORY_OF_MODE, dominant), "wheelchair": fc.lookup(names, access)}).drop("parent_id", "parent_wheelchair")


def classified_stations(stations: DataFrame, stops: DataFrame) -> DataFrame:
    """Stations with the modes of all their classified child stops, and the dominant one's category."""
    children = stops.where("parent_station is not null").select(F.col("parent_station").alias("station_id"), F.explode("modes").alias("mode"))
    modes = children.groupBy("station_id").agg(F.array_sort(F.collect_set("mode")).alias("modes"))
    dominant = F.coalesce(*[F.when(F.array_contains("modes", m), F.lit(m)) for m in MODE_ORDER])
    return stations.join(modes, stations["stop_id"] == F.col("station_id")).drop("station_id").withColumn("category", fc.lookup(CATEGORY_OF_MODE, dominant))


def stations_from_orphans(stops: DataFrame, tile: str = "tile") -> DataFrame:
    """Stops without a parent as stations: those of one name in one tile together, at their mean point."""
    alone = stops.where("parent_station is null")
    return alone.groupBy(tile, "stop_name").agg(F.avg("x").alias("x"), F.avg("y").alias("y"), F.array_sort(F.collect_set(F.col("stop_id"))).alias("children"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("modes")))).alias("modes")).withColumn("stop_id", F.lit("new_station"))


def grouped_lines(lines: DataFrame, masters: DataFrame, include: Sequence[str] = (), exclude: Sequence[str] = ()) -> DataFrame:
    """Route relations as lines: (mode, ref, operator, master) with their distinct "from -> to" routes and parts.

    masters: master_id, parts array<long>; a route belongs to the master that lists its absolute id. Operators are
    included or excluded whatever their case; lines with a null end have no route text.
    """
    links = masters.select("master_id", F.explode("parts").alias("part_id")).groupBy("part_id").agg(F.min("master_id").alias("master_id"))
    joined = lines.join(links, F.abs(F.col("osm_id")) == F.col("part_id"), "left")
    operator = F.lower(F.col("operator"))
    if include:
        joined = joined.where(operator.isin([x.lower() for x in include]))
    if exclude:
        joined = joined.where(~F.coalesce(operator.isin([x.lower() for x in exclude]), F.lit(False)))
    route = F.concat(F.col("from"), F.lit(" -> "), F.col("to"))
    return joined.groupBy("mode", "ref", "operator", F.coalesce("master_id", F.lit(-1)).alias("master_id")).agg(F.array_sort(F.collect_set(route)).alias("routes"), F.array_sort(F.collect_set("osm_id")).alias("parts"))
