"""A map extract written here byte by byte, and read back by blocks."""

import struct
import zlib

import pytest

from geoloom.sources import map_extracts as m


def varint(v):
    v &= (1 << 64) - 1
    out = b""
    while True:
        out += bytes([v & 127 | (128 if v > 127 else 0)])
        v >>= 7
        if not v:
            return out


zig = lambda v: (v << 1) ^ (v >> 63)
whole = lambda n, v: varint(n << 3) + varint(v)
part = lambda n, data: varint(n << 3 | 2) + varint(len(data)) + data
row = lambda n, values: part(n, b"".join(map(varint, values)))


def deltas(values):
    return [zig(b - a) for a, b in zip([0, *values], values, strict=False)]


def blob(kind, data, how="zlib"):
    body = {"raw": lambda: part(1, data), "zlib": lambda: whole(2, len(data)) + part(3, zlib.compress(data)), "lzma": lambda: part(4, b"x")}[how]()
    header = part(1, kind.encode()) + whole(3, len(body))
    return struct.pack(">I", len(header)) + header + body


TEXTS = [b"", b"amenity", "Café".encode(), b"name", b"highway", b"path", b"outer"]


def block(*groups, extra=b""):
    return part(1, b"".join(part(1, t) for t in TEXTS)) + b"".join(part(2, g) for g in groups) + extra


DENSE = part(2, row(1, deltas([5, 3, 10_000_000_000])) + row(8, deltas([480_000_000, -10, 0])) + row(9, deltas([110_000_000, -1_800_000_000, 7])) + row(10, [1, 2, 3, 2, 0, 0, 4, 5, 0]))
PLAIN = part(1, whole(1, zig(-7)) + row(2, [1]) + row(3, [2]) + whole(8, zig(-5)) + whole(9, zig(25)))
WAY = part(3, whole(1, 77) + row(2, [4]) + row(3, [5]) + row(8, deltas([5, 3, 10_000_000_000, 99, 5])))
RELATION = part(4, whole(1, 88) + row(2, [3]) + row(3, [2]) + row(8, [6, 0]) + row(9, deltas([77, 3])) + row(10, [1, 0]))


@pytest.fixture
def extract(tmp_path):
    file = tmp_path / "x.osm.pbf"
    shifted = whole(17, 1000) + whole(19, 5) + whole(20, -5)
    file.write_bytes(blob("OSMHeader", b"") + blob("OSMData", block(DENSE)) + blob("OSMData", block(PLAIN, extra=shifted), "raw") + blob("OSMData", block(WAY + RELATION)) + blob("OSMData", block()))
    return str(file)


def test_objects_of_an_extract(spark, extract):
    rows = {(r.kind, r.id): r for r in m.read_extract(spark, extract).collect()}
    assert set(rows) == {("node", 5), ("node", 3), ("node", 10_000_000_000), ("node", -7), ("way", 77), ("relation", 88)}
    first = rows["node", 5]
    assert (first.tags, first.x, first.y) == ({"amenity": "Café", "name": "Café"}, 11.0, 48.0)
    assert (rows["node", 3].tags, rows["node", 3].x, rows["node", 3].y) == ({}, -180.0, -1e-6)
    assert rows["node", 10_000_000_000].tags == {"highway": "path"}
    assert (rows["node", -7].x, rows["node", -7].y) == (pytest.approx((25 * 1000 - 5) / 1e9), pytest.approx((-5 * 1000 + 5) / 1e9))
    assert (rows["way", 77].tags, rows["way", 77].refs) == ({"highway": "path"}, [5, 3, 10_000_000_000, 99, 5])
    assert [tuple(x) for x in rows["relation", 88].members] == [("way", 77, "outer"), ("node", 3, "")]


def test_blocks_are_dealt_to_tasks(spark, extract):
    assert m.read_extract(spark, extract).rdd.getNumPartitions() == 1
    small = m.read_extract(spark, extract, 1)
    assert small.rdd.getNumPartitions() == 5 and small.count() == 6
    assert m.read_extract(spark, f"file://{extract}").where("kind = 'way'").count() == 1


def test_lines_of_ways(spark, extract):
    r = m.with_lines(m.read_extract(spark, extract)).first()
    assert (r.id, r.closed, [(p.x, p.y) for p in r.line]) == (77, True, [(11.0, 48.0), (-180.0, -1e-6), (7e-7, 0.0), (11.0, 48.0)])


def test_packing_that_is_not_read(spark, tmp_path):
    (tmp_path / "y.pbf").write_bytes(blob("OSMData", b"", "lzma"))
    with pytest.raises(Exception, match="no map extract"):
        m.read_extract(spark, str(tmp_path / "y.pbf")).collect()
    (tmp_path / "z.pbf").write_bytes(b"")
    assert m.read_extract(spark, str(tmp_path / "z.pbf")).collect() == []


def test_collected_extract(spark, extract, tmp_path):
    from geoloom.plans import cli

    values = {"filters": {"highway": True, "amenity": ["Café"], "name": True}, "columns": ["highway", "name"]}
    cli.run(spark, "collection", "extract", cli.Settings(extract, str(tmp_path / "out"), values))
    back = {n: spark.read.parquet(str(tmp_path / f"out/{n}")).collect() for n in ("point", "line", "polygon", "relation")}
    assert sorted((r.id, r.highway, r.name) for r in back["point"]) == [(-7, None, None), (5, None, "Café"), (10_000_000_000, "path", None)]
    assert back["line"] == [] and [(r.id, r.highway, len(r.geom[0])) for r in back["polygon"]] == [(77, "path", 4)]
    assert [(r.id, r.name) for r in back["relation"]] == [(88, "Café")]
    corner = [[(10.0, 47.0), (12.0, 47.0), (12.0, 49.0), (10.0, 49.0), (10.0, 47.0)]]
    spark.createDataFrame([(corner,)], "geom array<array<struct<x:double,y:double>>>").write.parquet(str(tmp_path / "area"))
    part = m.cropped(m.read_extract(spark, extract), spark.read.parquet(str(tmp_path / "area")), 0.5)
    assert sorted((r.kind, r.id) for r in part.collect()) == [("node", 3), ("node", 5), ("node", 10_000_000_000), ("relation", 88), ("way", 77)]
