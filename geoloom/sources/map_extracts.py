"""Map extracts in the public PBF format as a Spark data source: blocks of a file are dealt to tasks and decoded there."""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceReader, InputPartition

from geoloom.operators.lineage import checkpointed
from geoloom.operators.spatial_joins import points_in_polygons

SCHEMA = "kind string, id long, tags map<string,string>, x double, y double, refs array<long>, members array<struct<kind:string,id:long,role:string>>"
MEMBERS = pa.list_(pa.struct([("kind", pa.string()), ("id", pa.int64()), ("role", pa.string())]))
ARROW = pa.schema([("kind", pa.string()), ("id", pa.int64()), ("tags", pa.map_(pa.string(), pa.string())), ("x", pa.float64()), ("y", pa.float64()), ("refs", pa.list_(pa.int64())), ("members", MEMBERS)])
KINDS = ("node", "way", "relation")
#: Bytes of a file that a task reads, about; a block is never divided.
RANGE = 32 << 20


def fields(data: bytes) -> Iterator[tuple[int, int | bytes]]:
    """(number, value) of a message's fields: an integer, or bytes of a nested or packed one."""
    at = 0

    def varint() -> int:
        nonlocal at
        value = shift = 0
        while True:
            byte = data[at]
            at += 1
            value |= (byte & 127) << shift
            if byte < 128:
                return value
            shift += 7

    while at < len(data):
        key = varint()
        if key & 7 == 0:
            yield key >> 3, varint()
        elif key & 7 == 2:
            size = varint()
            yield key >> 3, data[at : at + size]
            at += size
        elif key & 7 in (1, 5):
            at += 8 if key & 7 == 1 else 4
        else:
            raise ValueError(f"no map extract: wire type {key & 7}")


def message(data: bytes) -> dict[int, list]:
    """All values of each field of a message."""
    out: dict[int, list] = {}
    for number, value in fields(data):
        out.setdefault(number, []).append(value)
    return out


def packed(data: bytes, signed: bool = False, deltas: bool = False) -> np.ndarray:
    """Integers of a packed field, all at once; signed ones in zigzag form, deltas summed up."""
    raw = np.frombuffer(data, dtype=np.uint8)
    stops = np.flatnonzero(raw < 128)
    starts = np.concatenate([[0], stops[:-1] + 1]) if len(stops) else stops
    out = np.zeros(len(stops), dtype=np.uint64)
    for k in range(10):
        at = starts + k
        there = at <= stops
        if not there.any():
            break
        out[there] |= (raw[at[there]] & np.uint8(127)).astype(np.uint64) << np.uint64(7 * k)
    values = out.astype(np.int64)
    if signed:
        values = (out >> np.uint64(1)).astype(np.int64) ^ -(out & np.uint64(1)).astype(np.int64)
    return np.cumsum(values) if deltas else values


def zigzag(value: int) -> int:
    return (value >> 1) ^ -(value & 1)


def plain(value: int) -> int:
    """A plain integer field's value: 64 bits, negative ones as their complement."""
    return value - (1 << 64) if value >= 1 << 63 else value


def objects(block: bytes) -> Iterator[tuple]:
    """Rows of SCHEMA of one block of primitives."""
    top = message(block)
    texts = [s.decode("utf-8", "replace") for s in message(top[1][0]).get(1, [])] if 1 in top else []
    step = top.get(17, [100])[0]
    y0, x0 = (plain(top.get(n, [0])[0]) for n in (19, 20))
    degrees = lambda offset, v: (offset + step * v) / 1e9
    ids = lambda m, n: packed(b"".join(m.get(n, []))).tolist()
    tags = lambda m: [(texts[k], texts[v]) for k, v in zip(ids(m, 2), ids(m, 3), strict=True)]
    for group in map(message, top.get(2, [])):
        for node in map(message, group.get(1, [])):
            yield "node", zigzag(node[1][0]), tags(node), degrees(x0, zigzag(node[9][0])), degrees(y0, zigzag(node[8][0])), None, None
        for dense in map(message, group.get(2, [])):
            numbers, ys, xs = (packed(b"".join(dense.get(n, [])), True, True).tolist() for n in (1, 8, 9))
            pairs, at = ids(dense, 10), 0
            for i, y, x in zip(numbers, ys, xs, strict=True):
                own = []
                while at < len(pairs) and pairs[at]:
                    own.append((texts[pairs[at]], texts[pairs[at + 1]]))
                    at += 2
                at += 1
                yield "node", i, own, degrees(x0, x), degrees(y0, y), None, None
        for way in map(message, group.get(3, [])):
            yield "way", plain(way[1][0]), tags(way), None, None, packed(b"".join(way.get(8, [])), True, True).tolist(), None
        for relation in map(message, group.get(4, [])):
            roles, kinds = ids(relation, 8), ids(relation, 10)
            members = packed(b"".join(relation.get(9, [])), True, True).tolist()
            held = [{"kind": KINDS[k], "id": i, "role": texts[r]} for k, i, r in zip(kinds, members, roles, strict=True)]
            yield "relation", plain(relation[1][0]), tags(relation), None, None, None, held


def opened(path: str):
    """A file of any store that Arrow knows, for reading at places."""
    from pyarrow import fs

    store, place = fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)
    return store.open_input_file(place)


def blocks(file, start: int, stop: int) -> Iterator[tuple[int, str, bytes | None]]:
    """(end, type, data) of the blocks from one place to another; data is read only if `file` isn't a pair with False."""
    file, read = file if isinstance(file, tuple) else (file, True)
    at = start
    while at < stop:
        file.seek(at)
        head = file.read(4)
        if len(head) < 4:
            return
        size = struct.unpack(">I", head)[0]
        header = message(file.read(size))
        length = header[3][0]
        data = None
        if read:
            blob = message(file.read(length))
            if 1 in blob:
                data = blob[1][0]
            elif 3 in blob:
                data = zlib.decompress(blob[3][0])
            elif 7 in blob:
                import zstandard

                data = zstandard.ZstdDecompressor().decompress(blob[7][0], max_output_size=blob[2][0])
            else:
                raise ValueError(f"no map extract: a block at {at} is packed in a way that isn't read here")
        at += 4 + size + length
        yield at, header[1][0].decode(), data


@dataclass
class Range(InputPartition):
    """Some consecutive blocks of a file."""

    start: int
    stop: int


class ExtractReader(DataSourceReader):
    """Reads ranges of blocks; only the blocks' headers are read to find the ranges."""

    def __init__(self, options: dict):
        self.path, self.range = options["path"], int(options.get("range", RANGE))

    def partitions(self) -> list[Range]:
        with opened(self.path) as file:
            size, start, found = file.size(), 0, []
            for end, _, _ in blocks((file, False), 0, size):
                if end - start >= self.range or end >= size:
                    found.append(Range(start, end))
                    start = end
        return found

    def read(self, partition: Range | None) -> Iterator[pa.RecordBatch]:
        with opened(self.path) as file:
            for _, kind, data in blocks(file, partition.start, partition.stop) if partition else ():
                if kind == "OSMData":
                    columns = list(zip(*objects(data), strict=True)) or [[]] * len(ARROW)
                    yield pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, ARROW, strict=True)], schema=ARROW)


class MapExtract(DataSource):
    """Format map_extract: option path; option range, bytes of a task."""

    @classmethod
    def name(cls) -> str:
        return "map_extract"

    def schema(self) -> str:
        return SCHEMA

    def reader(self, schema) -> ExtractReader:
        return ExtractReader(self.options)


def read_extract(spark: SparkSession, path: str, bytes_a_task: int = RANGE) -> DataFrame:
    """Nodes, ways and relations of a map extract, by `kind`: id, tags, place of nodes, node ids of ways, members of relations."""
    spark.dataSource.register(MapExtract)
    return spark.read.format("map_extract").option("range", bytes_a_task).load(path)


def with_lines(extract: DataFrame) -> DataFrame:
    """(id, tags, line, closed) of the ways: their nodes' places in order, nodes that the extract lacks left out.

    Places join by node id, so that no task holds more than the points of its ways.
    """
    nodes = extract.where("kind = 'node'").select(F.col("id").alias("node_id"), F.struct("x", "y").alias("p"))
    ways = extract.where("kind = 'way'").select("id", "tags", "refs")
    steps = ways.select("id", F.posexplode("refs").alias("i", "ref")).join(nodes, F.col("ref") == F.col("node_id"))
    lines = steps.groupBy(F.col("id").alias("way_id")).agg(F.array_sort(F.collect_list(F.struct("i", "p"))).alias("steps"))
    closed = (F.size("refs") > 3) & (F.get("refs", F.lit(0)) == F.element_at("refs", -1))
    return ways.join(lines, F.col("id") == F.col("way_id"), "left").select("id", "tags", F.coalesce(F.col("steps.p"), F.array().cast("array<struct<x:double,y:double>>")).alias("line"), closed.alias("closed"))


def cropped(extract: DataFrame, outline: DataFrame, cell: float) -> DataFrame:
    """The part of an extract that an area (polygons `geom`) takes: nodes inside, ways with one of them, whole, with all their
    nodes, and relations with one of these nodes or ways among their members."""
    nodes, ways, relations = (extract.where(F.col("kind") == k) for k in KINDS)
    inside = checkpointed(points_in_polygons(nodes.select("id", "x", "y"), outline, cell, how="left_semi").select(F.col("l.id").alias("near_id")).distinct())
    links = ways.select("id", F.explode("refs").alias("ref"))
    taken = links.join(inside, F.col("ref") == F.col("near_id"), "left_semi").select(F.col("id").alias("way_id")).distinct()
    kept = checkpointed(ways.join(taken, F.col("id") == F.col("way_id"), "left_semi"))
    of_ways = kept.select(F.explode("refs").alias("near_id"))
    held = nodes.join(inside.unionAll(of_ways).distinct(), F.col("id") == F.col("near_id"), "left_semi")
    ids = held.select("kind", "id").unionAll(kept.select("kind", "id")).select(F.col("kind").alias("own_kind"), F.col("id").alias("own_id"))
    members = relations.select("id", F.explode("members").alias("m")).select("id", "m.kind", F.col("m.id").alias("member"))
    met = members.join(ids, (F.col("kind") == F.col("own_kind")) & (F.col("member") == F.col("own_id")), "left_semi").select(F.col("id").alias("relation_id")).distinct()
    return held.unionByName(kept).unionByName(relations.join(met, F.col("id") == F.col("relation_id"), "left_semi"))
