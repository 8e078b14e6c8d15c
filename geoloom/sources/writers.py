"""Sinks: tables with a policy for what is there, partitions by value, relational stores, text for map tools."""

from __future__ import annotations

from collections.abc import Sequence
from enum import Enum

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.functions.cells import hilbert_key
from geoloom.functions.text import free_name


class IfExists(Enum):
    """What to do where the table exists."""

    FAIL = "error"
    APPEND = "append"
    REPLACE = "overwrite"


class Dump(Enum):
    """What of a table to write."""

    ALL = "all"
    DATA = "data"
    SCHEMA = "schema"


def write_table(rows: DataFrame, path: str, if_exists: IfExists = IfExists.FAIL, partition_by: Sequence[str] = (), sort_by: Sequence[str] = ()) -> None:
    """Parquet, by partition values and in order within files if asked."""
    rows = rows.sortWithinPartitions(*sort_by) if sort_by else rows
    rows.write.mode(if_exists.value).partitionBy(*partition_by).parquet(path)


def write_by_place(rows: DataFrame, path: str, files: int, x: str = "x", y: str = "y", if_exists: IfExists = IfExists.FAIL) -> None:
    """Parquet in about `files` files, each with rows that lie near each other (in order along a Hilbert curve), so that the
    ranges of x and y kept with each file tell a reader of a box which files to leave out."""
    box = rows.agg(*[f(c).alias(n) for n, f, c in (("xmin", F.min, x), ("ymin", F.min, y), ("xmax", F.max, x), ("ymax", F.max, y))]).first().asDict()
    place = free_name(rows.columns, "curve_place")
    keyed = rows.withColumn(place, hilbert_key(F.col(x), F.col(y), {k: v or 0.0 for k, v in box.items()}))
    keyed.repartitionByRange(files, place).sortWithinPartitions(place).drop(place).write.mode(if_exists.value).parquet(path)


def rewrite_partitions(rows: DataFrame, path: str, partition_by: Sequence[str]) -> None:
    """Replace those partitions of a table that the rows have; all others keep their files. The rows may come from the table."""
    rows.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*partition_by).parquet(path)


def dump(rows: DataFrame, path: str, what: Dump = Dump.ALL) -> None:
    """A table's data, or its schema alone as a table without rows."""
    write_table(rows.limit(0) if what is Dump.SCHEMA else rows, path, IfExists.REPLACE)


def write_jdbc(rows: DataFrame, url: str, table: str, if_exists: IfExists = IfExists.REPLACE, batch: int = 10_000, **options: str) -> None:
    """Rows to a relational store in batches."""
    rows.write.format("jdbc").options(url=url, dbtable=table, batchsize=str(batch), **options).mode(if_exists.value).save()


def write_osm(nodes_and_ways: DataFrame, path: str) -> None:
    """(kind, id, xml) as OSM text files: nodes before ways, each in order of id, with a header and an end in files of their own."""
    spark = nodes_and_ways.sparkSession
    order = F.when(F.col("kind") == "node", 1).otherwise(2)
    body = nodes_and_ways.select(order.alias("part"), "id", "xml")
    frame = spark.createDataFrame([(0, 0, '<?xml version="1.0" encoding="UTF-8"?><osm version="0.6">'), (3, 0, "</osm>")], "part int, id long, xml string")
    body.unionByName(frame).repartitionByRange("part", "id").sortWithinPartitions("part", "id").select("xml").write.mode("overwrite").text(path)


def write_geojson(rows: DataFrame, path: str, geometry: str, properties: Sequence[str]) -> None:
    """One GeoJSON feature per line; `geometry` holds GeoJSON text."""
    feature = F.concat(F.lit('{"type":"Feature","properties":'), F.to_json(F.struct(*properties)), F.lit(',"geometry":'), F.col(geometry), F.lit("}"))
    rows.select(feature.alias("value")).write.mode("overwrite").text(path)
