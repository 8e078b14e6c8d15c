"""Removal of every byte that lies in a string of WIDTH bytes which also starts elsewhere in the corpus.

Suffix sorting the whole corpus at once isn't needed: of the GRAM-byte strings inside a window of WIDTH bytes, the one
with the least hash is the same wherever that window stands. Windows in a row that share it are a record, with that hash
as its key; equal windows lie in records with equal keys. Keys that occur once drop out by counting. What is left meets
by key: equal records repeat as a whole, and records that are equal in part are sorted by suffixes (linear grouping),
where repeated windows are neighbours. Where one key has very many different records, as at the edge of a passage that
a third of all documents quote, its windows are dealt out by their own 128-bit hash, so that no key gathers in one task.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from functools import cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.shared import drop_written, id_or_none, known_id, written
from geoloom.llm.suffix_array import repeated_starts

WIDTH, GRAM = 200, 100
#: Windows in a record at most; different records of a key that go to one suffix array (about 1.2 MB, some seconds: a
#: row for each window costs some seventy times as much as one for the record); bytes sorted at once beyond one key.
MOST_RUN, CROWD, SORT_BYTES = 256, 4096, 262_144
BASE = 0x9E3779B97F4A7C15


@cache
def byte_values() -> np.ndarray:
    """A random odd-spread number for each byte value."""
    return np.random.default_rng(5).integers(1, 2**63, 256, dtype=np.uint64)


class Powers:
    """Powers of BASE and of its inverse modulo 2**64, as far as the longest text so far needs them."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            for name, base in (("up", BASE), ("down", pow(BASE, -1, 1 << 64))):
                steps = np.full(size, base, np.uint64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))
        return self.up[:n], self.down[:n]


def gram_hashes(raw: np.ndarray, gram: int, powers: Powers) -> np.ndarray:
    """A 64-bit hash of each `gram`-byte string: differences of a running polynomial, mixed."""
    n = len(raw)
    up, down = powers.upto(n)
    total = np.cumsum(byte_values()[raw] * up)
    h = total[gram - 1 :].copy()
    h[1:] -= total[: n - gram]
    h *= down[: n - gram + 1]
    h ^= h >> np.uint64(32)
    h *= np.uint64(0xD6E8FEB86659FD93)
    h ^= h >> np.uint64(32)
    return h


def sliding_least(h: np.ndarray, width: int) -> np.ndarray:
    """The least of each `width` neighbours, by least-so-far within blocks from both sides."""
    n = len(h)
    size = -(-n // width) * width
    padded = np.full(size, 2**64 - 1, np.uint64)
    padded[:n] = h
    blocks = padded.reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def records(data: bytes, width: int, gram: int, powers: Powers) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(key, first window, last window + 1, whether the key stands twice in it) of each record of a text."""
    if len(data) < width:
        empty = np.empty(0, np.int64)
        return empty.astype(np.uint64), empty, empty, empty.astype(bool)
    h = gram_hashes(np.frombuffer(data, np.uint8), gram, powers)
    span = width - gram + 1
    least = sliding_least(h, span)
    first = np.flatnonzero(np.concatenate(([True], least[1:] != least[:-1])))
    last = np.append(first[1:], len(least))
    if (last - first).max() > MOST_RUN:
        cuts = [np.arange(a, b, MOST_RUN) for a, b in zip(first.tolist(), last.tolist(), strict=True)]
        first = np.concatenate(cuts)
        last = np.append(first[1:], len(least))
    key = least[first]
    twice = np.zeros(len(first), bool)
    small = np.sort(h[h <= key.max()])
    again = np.unique(small[1:][small[1:] == small[:-1]])
    if len(again):
        for k in np.flatnonzero(np.isin(key, again)).tolist():
            twice[k] = np.count_nonzero(h[first[k] : last[k] + span - 1] == key[k]) > 1
    return key, first, last, twice


def keyed(batches: Iterator[pd.DataFrame], width: int, gram: int) -> Iterator[pd.DataFrame]:
    """(v, doc, th, lo, hi, twice) of each record of (doc, th, text); 50 000 rows at a time."""
    powers = Powers()
    names = ["v", "doc", "th", "lo", "hi", "twice"]

    def table(parts: list) -> pd.DataFrame:
        columns = [np.concatenate(x) for x in zip(*parts, strict=True)] if parts else [[]] * 6
        out = pd.DataFrame(dict(zip(names, columns, strict=True)))
        return out.astype({"v": "int64", "doc": "int64", "th": "int64", "lo": "int32", "hi": "int32", "twice": "bool"})

    parts, held = [], 0
    for docs in batches:
        for doc, th, text in zip(docs["doc"].tolist(), docs["th"].tolist(), docs["text"], strict=True):
            key, lo, hi, twice = records(text.encode("utf-8"), width, gram, powers)
            n = len(key)
            if n:
                parts.append((key.view(np.int64), np.full(n, doc), np.full(n, th), lo, hi, twice))
                held += n
            if held > 50_000:
                yield table(parts)
                parts, held = [], 0
    yield table(parts)


def pieces(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """(v, h1, h2, doc, th, lo, hi, twice, content) of each listed record; its bytes only where a task meets them first."""
    seen: set[bytes] = set()
    schema = pa.schema([(x, pa.int64()) for x in ("v", "h1", "h2", "doc", "th")] + [("lo", pa.int32()), ("hi", pa.int32()), ("twice", pa.bool_()), ("content", pa.binary())])
    for rows in batches:
        names = rows.schema.names
        columns = [rows.column(names.index(x)).to_pylist() for x in ("doc", "th", "text", "found")]
        out, held = [], 0
        for doc, th, text, found in zip(*columns, strict=True):
            data = text.encode("utf-8")
            for x in found:
                content = data[x["lo"] : x["hi"] + width - 1]
                digest = xxhash.xxh3_128_digest(content)
                key = digest + x["v"].to_bytes(8, "big", signed=True)
                h1, h2 = int.from_bytes(digest[:8], "big", signed=True), int.from_bytes(digest[8:], "big", signed=True)
                new = key not in seen
                if new:
                    seen.add(key)
                    held += len(content)
                out.append((x["v"], h1, h2, doc, th, x["lo"], x["hi"], x["twice"], content if new else None))
            if held > 8_000_000 or len(out) > 50_000:
                yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)
                out, held = [], 0
        if out:
            yield pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True), schema, strict=True)], schema=schema)


SPANS = pa.schema([("doc", pa.int64()), ("th", pa.int64()), ("start", pa.int32()), ("stop", pa.int32())])


def runs(starts: list[int], width: int) -> list[tuple[int, int]]:
    """[start, stop) byte ranges that windows at the given sorted starts cover."""
    found: list[tuple[int, int]] = []
    for s in starts:
        if found and s <= found[-1][1]:
            found[-1] = (found[-1][0], s + width)
        else:
            found.append((s, s + width))
    return found


def sorted_groups(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """Spans of repeated windows from records in order of their key: whole keys, SORT_BYTES at a time, are suffix sorted.

    Equal records from several tasks count once here; that they repeat as a whole is found by counting.
    """
    group: dict[tuple, tuple] = {}
    held, last = 0, None

    def emptied() -> pa.RecordBatch:
        out = []
        contents = [x[0] for x in group.values()]
        for (_, doc, th, lo), starts in zip(group.values(), repeated_starts(contents, width), strict=True):
            out += [(doc, th, lo + a, lo + b) for a, b in runs(starts, width)]
        group.clear()
        return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*out, strict=True) if out else [[]] * 4, SPANS, strict=True)], schema=SPANS)

    for rows in batches:
        names = rows.schema.names
        for v, h1, h2, content, doc, th, lo in zip(*[rows.column(names.index(x)).to_pylist() for x in ("v", "h1", "h2", "content", "doc", "th", "lo")], strict=True):
            if v != last and held > SORT_BYTES:
                yield emptied()
                held = 0
            last = v
            if (v, h1, h2) not in group:
                group[v, h1, h2] = (content, doc, th, lo)
                held += len(content)
    yield emptied()


def windows(batches: Iterator[pa.RecordBatch], width: int) -> Iterator[pa.RecordBatch]:
    """(w1, w2, doc, th, at) of each window of a record: its hash and its place."""
    schema = pa.schema([("w1", pa.int64()), ("w2", pa.int64()), ("doc", pa.int64()), ("th", pa.int64()), ("at", pa.int32())])
    for rows in batches:
        names = rows.schema.names
        out: list[list] = [[], [], [], [], []]
        for content, doc, th, lo in zip(*[rows.column(names.index(x)).to_pylist() for x in ("content", "doc", "th", "lo")], strict=True):
            n = len(content) - width + 1
            digests = b"".join([xxhash.xxh3_128_digest(content[i : i + width]) for i in range(n)])
            pair = np.frombuffer(digests, ">i8").reshape(-1, 2)
            for column, values in zip(out, (pair[:, 0], pair[:, 1], np.full(n, doc), np.full(n, th), np.arange(lo, lo + n)), strict=True):
                column.append(values.astype(np.int64))
        if out[0]:
            yield pa.record_batch([pa.array(np.concatenate(c).astype(f.type.to_pandas_dtype()), f.type) for c, f in zip(out, schema, strict=True)], schema=schema)


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    """Maximal runs of the bytes that the spans cover, in order."""
    found: list[tuple[int, int]] = []
    for a, b in sorted(spans):
        if found and a <= found[-1][1]:
            if b > found[-1][1]:
                found[-1] = (found[-1][0], b)
        else:
            found.append((a, b))
    return found


def cut(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans) of (doc_id, text, spans)."""
    for docs in batches:
        rows = []
        for doc_id, text, spans in zip(docs["doc_id"], docs["text"], docs["spans"], strict=True):
            data = text.encode("utf-8")
            gone = merged([(x["start"], x["stop"]) for x in spans]) if spans is not None else []
            kept, at = hashlib.sha256(), 0
            for a, b in gone:
                kept.update(data[at:a])
                at = b
            kept.update(data[at:])
            rows.append((doc_id, len(data), sum(b - a for a, b in gone), len(gone), kept.hexdigest(), [{"start": a, "stop": b} for a, b in gone]))
        yield pd.DataFrame(rows, columns=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])


def repeated_spans(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """(doc, th, spans) of byte ranges covered by repeated windows, for (doc, th, text); ranges may overlap.

    All joined sides grow with the corpus, so none is ever broadcast, however small it happens to be.
    """
    kinds = ["v", "h1", "h2"]
    found = written(docs.mapInPandas(lambda b: keyed(b, width, gram), "v long, doc long, th long, lo int, hi int, twice boolean"), "records")
    often = found.groupBy("v").agg(F.count(F.lit(1)).alias("n"), F.max("twice").alias("any")).where("n > 1 or any").select(F.col("v").alias("often_v"))
    often = written(often, "often")
    listed = found.join(often.hint("merge"), found.v == often.often_v).groupBy("doc", "th").agg(F.collect_set(F.struct("v", "lo", "hi", "twice")).alias("found"))
    lists = written(listed, "lists")
    drop_written(found)
    drop_written(often)
    schema = "v long, h1 long, h2 long, doc long, th long, lo int, hi int, twice boolean, content binary"
    parts = written(docs.join(lists.hint("merge"), ["doc", "th"]).mapInArrow(lambda b: pieces(b, width), schema), "pieces")
    drop_written(lists)

    counted = written(parts.groupBy(*kinds).agg(F.count(F.lit(1)).alias("n"), F.max("twice").alias("twice")), "kinds")
    per_key = counted.groupBy("v").agg(F.count(F.lit(1)).alias("kinds"), F.min("n").alias("least"), F.max("twice").alias("any"))
    # Records that occur once may share windows with other records of their key, or within themselves.
    per_key = written(per_key.where("(least = 1 and kinds > 1) or any").select(F.col("v").alias("open_v"), "kinds"), "open")
    opened = parts.where("content is not null").join(per_key.hint("merge"), F.col("v") == F.col("open_v"))

    n = max(1, int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    few = opened.where(F.col("kinds") <= crowd).select(*kinds, "content", "doc", "th", "lo")
    sorted_spans = few.repartition(n, "v").sortWithinPartitions("v").mapInArrow(lambda b: sorted_groups(b, width), "doc long, th long, start int, stop int")

    # The same record from several tasks is one: its place is that of the least document.
    place = F.min(F.struct("doc", "th", "lo", "content")).alias("x")
    many = opened.where(F.col("kinds") > crowd).groupBy(*kinds).agg(place).select("x.*")
    dealt = written(many.mapInArrow(lambda b: windows(b, width), "w1 long, w2 long, doc long, th long, at int"), "windows")
    twice = written(dealt.groupBy("w1", "w2").count().where("count > 1").select(F.col("w1").alias("t1"), F.col("w2").alias("t2")), "twice")
    window_spans = dealt.join(twice.hint("merge"), (F.col("w1") == F.col("t1")) & (F.col("w2") == F.col("t2"))).select("doc", "th", F.col("at").alias("start"), (F.col("at") + width).alias("stop"))

    whole = counted.where("n > 1").select(*[F.col(k).alias(f"c_{k}") for k in kinds])
    whole_spans = parts.join(whole.hint("merge"), [F.col(k) == F.col(f"c_{k}") for k in kinds]).select("doc", "th", F.col("lo").alias("start"), (F.col("hi") + (width - 1)).alias("stop"))
    lists = sorted_spans.unionAll(window_spans).unionAll(whole_spans).groupBy("doc", "th").agg(F.collect_set(F.struct("start", "stop")).alias("spans"))
    out = written(lists, "spans")
    for table in (parts, counted, per_key, dealt, twice):
        drop_written(table)
    return out


def removed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", width: int = WIDTH, gram: int = GRAM, crowd: int = CROWD) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans) of each document.

    Texts are whole, as UTF-8; null is empty. A window counts as repeated if the same bytes start at any other place of
    any document, the same one included; overlaps count. Documents shorter than `width` lose nothing. Rows that repeat
    an id are documents of their own, told apart by a hash of their text; fully equal rows repeat each other. Null ids
    are allowed; an empty table gives an empty one.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    own = docs.select(id_or_none(doc_id).alias("doc"), F.xxhash64(body).alias("th"), body.alias("text"))
    spans = repeated_spans(own, width, gram, crowd)
    joined = own.join(spans.hint("merge"), ["doc", "th"], "left").select(F.col("doc").alias("doc_id"), "text", "spans")
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:int,stop:int>>"
    return joined.mapInPandas(cut, schema).withColumn("doc_id", known_id("doc_id"))
