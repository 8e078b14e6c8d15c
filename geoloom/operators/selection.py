"""Rows of tables by area, source and column set: what is published, and what a migration takes along."""

from __future__ import annotations

from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.functions.cells import grid_cover
from geoloom.functions.geometry import envelope, envelopes_meet
from geoloom.functions.overlay import shapes_of
from geoloom.functions.predicates import centroid, holds, legs_of, line_meets, polygon_meets
from geoloom.operators.spatial_joins import points_in_polygons

#: Columns that every curated table of points has, and those of each kind; childcare has no tags.
COMMON = ("name", "street", "housenumber", "zipcode", "phone", "email", "website", "capacity", "opening_hours", "wheelchair", "source")
OWN = {
    "childcare": ("nursery", "kindergarten", "after_school", "min_age", "max_age", "carrier", "carrier_type"),
    "school": ("school_isced_level_1", "school_isced_level_2", "school_isced_level_3", "operator"),
    "standard": ("category", "other_categories", "operator"),
}


def routed(subscriptions: DataFrame, tables: Mapping[str, DataFrame], category: str = "category") -> DataFrame:
    """Rows of each category from the table of the source that it subscribes to, with their `source_table`.

    Of several subscribed sources the least counts; categories without one, or whose source has no table, give no rows.
    """
    chosen = subscriptions.where("rule = 'subscribe'").groupBy(F.col(category).alias("chosen_category")).agg(F.min("source").alias("chosen_source"))
    parts = None
    for source, rows in tables.items():
        part = rows.withColumn("source_table", F.lit(source))
        parts = part if parts is None else parts.unionByName(part, allowMissingColumns=True)
    if parts is None:
        raise ValueError("no tables to route to")
    return parts.join(chosen, (F.col(category) == F.col("chosen_category")) & (F.col("source_table") == F.col("chosen_source")), "left_semi")


def curated(rows: DataFrame, kind: str, geom: str = "geom") -> DataFrame:
    """A curated table with the columns of its kind (any other kind: standard), tags from JSON, other categories from a list with commas."""
    own = OWN.get(kind, OWN["standard"])
    out = rows.withColumn("other_categories", F.split("other_categories", ",")) if "other_categories" in own else rows
    if kind == "childcare":
        return out.select(*own, *COMMON, geom)
    return out.withColumn("tags", F.from_json("tags", "map<string,string>")).select(*own, *COMMON, "tags", geom)


def _decided(batches: Iterator[pa.RecordBatch], lines: bool) -> Iterator[pa.RecordBatch]:
    """(row_id, held) of the pairs (row_id, geometry, area) that meet: `held` says that the area holds a polygon's centroid."""
    for batch in batches:
        meets, held, known = [], [], {}
        for row, area in zip(shapes_of(batch.column(1), closed=True), shapes_of(batch.column(2), closed=True), strict=True):
            found, central = False, False
            if row and row[0] and area and area[0]:
                place = tuple(map(tuple, area))
                legs = known[place] if place in known else known.setdefault(place, legs_of(area))
                found = line_meets(row, legs) if lines else polygon_meets(row, area, legs)
                central = found and not lines and holds(legs, centroid(row[0]))
            meets.append(found)
            held.append(central)
        keep = pa.array(meets, pa.bool_())
        yield pa.record_batch([batch.column(0).filter(keep), pa.array(held, pa.bool_()).filter(keep)], names=["row_id", "held"])


def meeting(rows: DataFrame, areas: DataFrame, key: str, cell: float, lines: bool = False) -> DataFrame:
    """(row_id, held) of the rows whose line or polygon meets an area, each once; `held`: an area that it meets holds its centroid.

    Both sides are copied to the cells that their envelopes touch, and a pair counts in one cell only. Pairs are dealt by
    row in a given number of partitions before outlines are compared, since that costs more than moving them: a crowded
    cell, and few rows, are spread over all tasks.
    """
    outline = F.col("geom") if lines else F.get("geom", F.lit(0))
    left = rows.select(F.col(key).alias("row_id"), (F.array("geom") if lines else F.col("geom")).alias("row_geom"), envelope(outline).alias("row_box"))
    right = areas.select(F.col("geom").alias("area"), envelope(F.get("geom", F.lit(0))).alias("area_box"))
    left, right = (side.withColumn("cell", F.explode(grid_cover(F.col(box), cell))) for side, box in ((left, "row_box"), (right, "area_box")))
    a, b = F.col("row_box"), F.col("area_box")
    owner = F.struct(F.floor(F.greatest(a["xmin"], b["xmin"]) / cell).alias("cx"), F.floor(F.greatest(a["ymin"], b["ymin"]) / cell).alias("cy"))
    pairs = left.join(right, "cell").where(envelopes_meet(a, b) & (F.col("cell") == owner)).select("row_id", "row_geom", "area")
    tasks = max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    found = pairs.repartition(tasks, "row_id").mapInArrow(lambda x: _decided(x, lines), f"row_id {rows.schema[key].dataType.simpleString()}, held boolean")
    return found.groupBy("row_id").agg(F.bool_or("held").alias("held"))


def selected(name: str, rows: DataFrame, areas: DataFrame, cell: float, edges: DataFrame | None = None, key: str = "id") -> DataFrame:
    """The rows of a table that a migration of study areas takes along, each once however many areas it meets.

    areas: id, geom polygon. Areas go by id, sub-areas by study_area_id, points (x, y) by containment, lines and polygons
    by intersection, buildings by the area that holds their centroid too, nodes by the ends of the edges taken along.
    """
    if name == "study_area":
        return rows.join(areas.select(F.col("id").alias("area_id")), F.col("id") == F.col("area_id"), "left_semi")
    if name == "sub_study_area":
        return rows.join(areas.select(F.col("id").alias("area_id")), F.col("study_area_id") == F.col("area_id"), "left_semi")
    if name in ("poi", "population"):
        return points_in_polygons(rows, areas, cell, how="left_semi").select("l.*")
    if name in ("edge", "aoi", "building"):
        found = meeting(rows, areas, key, cell, lines=name == "edge")
        found = found.where("held") if name == "building" else found
        return rows.join(found.select("row_id"), F.col(key) == F.col("row_id"), "left_semi")
    if name == "node" and edges is not None:
        ends = selected("edge", edges, areas, cell, key=key).select(F.explode(F.array("source", "target")).alias("end")).distinct()
        return rows.join(ends, F.col(key) == F.col("end"), "left_semi")
    raise ValueError(f"no selection of {name!r}" + (" without edges" if name == "node" else ""))


def network_inserted(old: DataFrame, new: DataFrame, key: str = "id", scenario: str = "scenario_id") -> DataFrame:
    """A network table after a migration: rows of scenarios go, rows whose id wasn't there are added."""
    added = new.join(old.select(F.col(key).alias("old_id")), new[key] == F.col("old_id"), "left_anti")
    return old.where(F.col(scenario).isNull()).unionByName(added, allowMissingColumns=True)
