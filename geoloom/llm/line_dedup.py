"""Line dedup by content-defined chunks: a rolling hash over line hashes cuts documents into chunks of lines.

Boundaries depend on the lines around them alone, so a passage has the same chunks wherever it stands. Multi-line
chunks that occur more than once in the corpus stay at their first place, in order of (doc_id, line), and go elsewhere.
Equal hashes count only after their chunks' bytes were compared.

Chunks lose a passage's first and last lines to the unique ones beside it. So passages of over PASSAGE_WORDS words go by
windows: from each line the fewest lines on that have so many, and from each line back. A run of lines that stands in
two places has the same windows in both, whatever surrounds it, and they cover it to its ends.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from geoloom.llm.shared import drop_written, written

#: Lines in a chunk at least and at most, and how many pairs of lines share a boundary.
LEAST, MOST, EVERY = 2, 64, 3
#: A passage has more words than this.
PASSAGE_WORDS = 50
MIX = np.uint64(0x9E3779B97F4A7C15)


def chunk_bounds(lines: list[bytes]) -> list[tuple[int, int]]:
    """[start, end) of each chunk. A boundary follows a line where the rolling hash of it and the line before it says so."""
    n = len(lines)
    h = np.fromiter((xxhash.xxh3_64_intdigest(x) for x in lines), np.uint64, n)
    before = np.concatenate((np.zeros(1, np.uint64), h[:-1]))
    with np.errstate(over="ignore"):
        rolled = (before * MIX + h) * MIX
    ends = ((rolled >> np.uint64(32)) % np.uint64(EVERY) == 0).tolist()
    found, start = [], 0
    for i in range(n):
        size = i + 1 - start
        if i + 1 == n or size >= MOST or (ends[i] and size >= LEAST):
            found.append((start, i + 1))
            start = i + 1
    return found


def text_lines(text: str) -> list[bytes]:
    """Lines as UTF-8, parted at \\n."""
    return text.encode("utf-8").split(b"\n")


def digest(chunk: bytes) -> tuple[int, int]:
    """128 bits of a chunk as two signed longs."""
    value = xxhash.xxh3_128_digest(chunk)
    return int.from_bytes(value[:8], "big", signed=True), int.from_bytes(value[8:], "big", signed=True)


def window_bounds(lines: list[bytes], words: int) -> list[tuple[int, int]]:
    """[start, end) of each window: the fewest lines from a line on, or back from a line, with over `words` words.

    Windows start and end at lines with words, so a window has at most `words` + 1 of these.
    """
    sizes = [len(x.split()) for x in lines]
    at = [i for i, n in enumerate(sizes) if n]
    found, end, total = set(), 0, 0
    for i in range(len(at)):
        while end < len(at) and total <= words:
            total += sizes[at[end]]
            end += 1
        if total <= words:
            break
        found.add((at[i], at[end - 1] + 1))
        total -= sizes[at[i]]
    start, total = 0, 0
    for i in range(len(at)):
        total += sizes[at[i]]
        while total - sizes[at[start]] > words:
            total -= sizes[at[start]]
            start += 1
        if total > words:
            found.add((at[start], at[i] + 1))
    return sorted(found)


def pieces(lines: list[bytes], words: int | None) -> Iterator[tuple[int, int, bytes]]:
    """(start, end, bytes) of what may repeat: multi-line chunks, and windows of over `words` words, without blank lines, if given."""
    for a, b in chunk_bounds(lines):
        if b - a >= LEAST:
            yield a, b, b"\n".join(lines[a:b])
    for a, b in window_bounds(lines, words) if words is not None else ():
        yield a, b, b"\n".join([x for x in lines[a:b] if x.strip()])


def spans(batches: Iterator[pd.DataFrame], words: int | None) -> Iterator[pd.DataFrame]:
    """(doc_id, start, size, h1, h2) of each piece of (doc_id, text); size is in lines."""
    for docs in batches:
        rows = []
        for doc_id, text in zip(docs["doc_id"], docs["text"], strict=True):
            if isinstance(text, str):
                rows += {(doc_id, a, b - a, *digest(piece)) for a, b, piece in pieces(text_lines(text), words)}
        yield pd.DataFrame(rows, columns=["doc_id", "start", "size", "h1", "h2"]).astype("int64")


def chunk_texts(batches: Iterator[pa.RecordBatch], text: str, marks: str, words: int | None) -> Iterator[pa.RecordBatch]:
    """(h1, h2, chunk) of each marked piece, equal ones of a batch once."""
    for rows in batches:
        names = rows.schema.names
        found = set()
        for body, starts in zip(rows.column(names.index(text)).to_pylist(), rows.column(names.index(marks)).to_pylist(), strict=True):
            if starts:
                wanted = {(x["start"], x["h1"], x["h2"]) for x in starts}
                for a, _, chunk in pieces(text_lines(body), words):
                    if (a, *(h := digest(chunk))) in wanted:
                        found.add((*h, chunk))
        h1, h2, chunks = zip(*found, strict=True) if found else ((), (), ())
        yield pa.record_batch([pa.array(h1, pa.int64()), pa.array(h2, pa.int64()), pa.array(chunks, pa.binary())], names=["h1", "h2", "chunk"])


def without_chunks(batches: Iterator[pa.RecordBatch], text: str, marks: str, count: str | None, words: int | None) -> Iterator[pa.RecordBatch]:
    """The rows with the marked pieces that aren't first places cut from their text; `count` names an added column of lines cut."""
    for rows in batches:
        at, cut_at = rows.schema.names.index(text), rows.schema.names.index(marks)
        texts, cuts = [], []
        for body, starts in zip(rows.column(at).to_pylist(), rows.column(cut_at).to_pylist(), strict=True):
            gone = {(x["start"], x["h1"], x["h2"]) for x in starts or () if not x["first"]}
            cut = 0
            if gone:
                lines, cuts_of = text_lines(body), set()
                for a, b, piece in pieces(lines, words):
                    if (a, *digest(piece)) in gone:
                        cuts_of.update(range(a, b))
                cut = len(cuts_of)
                body = b"\n".join([x for i, x in enumerate(lines) if i not in cuts_of]).decode("utf-8")
            texts.append(body)
            cuts.append(cut)
        columns = [pa.array(texts, rows.schema.field(i).type) if i == at else rows.column(i) for i in range(rows.num_columns) if i != cut_at]
        names = [x for i, x in enumerate(rows.schema.names) if i != cut_at]
        if count:
            columns.append(pa.array(cuts, pa.int64()))
            names.append(count)
        yield pa.record_batch(columns, names=names)


def free_name(frame: DataFrame, name: str) -> str:
    """A column name that the frame doesn't have."""
    taken = {c.lower() for c in frame.columns}
    while name.lower() in taken:
        name += "_"
    return name


def deduplicated(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", count: str | None = None, words: int | None = None) -> DataFrame:
    """Documents without repeated multi-line chunks; columns as given, plus `count` (lines removed) if named.

    With `words`, repeated runs of lines with more words than that go as well, whichever lines surround them, one line
    or many. A run that overlaps its own first place stays. Every line that goes stands at an earlier place too.

    Places of chunks go by hash without their text and are counted before the shuffle, so a chunk that a third of the
    documents have is one row per task. Each document then meets its own list (one shuffle of texts by id; joined sides
    grow with the corpus and are never broadcast); the marked chunks' bytes, equal ones once a batch, are compared by
    hash, and hashes with unequal bytes, if any, mark nothing.
    Null texts and null ids stay as they are; an emptied document stays with an empty text; equal rows of one
    doc_id are one place; an empty table gives an empty one.
    """
    place = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text")).where("doc_id is not null")
    found = written(place.mapInPandas(lambda b: spans(b, words), "doc_id long, start long, size long, h1 long, h2 long"), "chunks")
    per_hash = found.groupBy("h1", "h2").agg(F.min(F.struct("doc_id", "start", "size")).alias("low"), F.max(F.struct("doc_id", "start")).alias("high"))
    repeated = per_hash.where("low.doc_id <> high.doc_id or low.start <> high.start").select(F.col("h1").alias("r1"), F.col("h2").alias("r2"), "low")
    repeated = written(repeated, "repeated")
    marked = found.join(repeated.hint("merge"), (found.h1 == repeated.r1) & (found.h2 == repeated.r2)).select("doc_id", "start", "h1", "h2", ((F.col("doc_id") == F.col("low.doc_id")) & (F.col("start") < F.col("low.start") + F.col("low.size"))).alias("first"))
    marked = written(marked, "marked")
    mark, key = free_name(docs, "chunk_marks"), free_name(docs, "chunk_doc")

    def joined(places: DataFrame) -> DataFrame:
        lists = places.groupBy("doc_id").agg(F.collect_set(F.struct("start", "first", "h1", "h2")).alias(mark)).withColumnRenamed("doc_id", key)
        return docs.join(lists.hint("merge"), docs[doc_id].cast("long") == F.col(key), "left").drop(key)

    together = written(joined(marked), "together")
    chunks = together.where(F.col(mark).isNotNull()).mapInArrow(lambda b: chunk_texts(b, text, mark, words), "h1 long, h2 long, chunk binary")
    unequal = chunks.distinct().groupBy("h1", "h2").count().where("count > 1").select("h1", "h2")
    if unequal.limit(1).count():
        drop_written(together)
        together = written(joined(marked.join(unequal, ["h1", "h2"], "left_anti")), "together")
    schema = T.StructType([T.StructField(f.name, f.dataType) for f in docs.schema] + ([T.StructField(count, T.LongType())] if count else []))
    return together.mapInArrow(lambda b: without_chunks(b, text, mark, count, words), schema)


def report(docs: DataFrame) -> DataFrame:
    """(doc_id, n_lines, n_removed, kept_sha256) of each document of (doc_id, text)."""
    lines = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.when(F.col("text").isNull(), 0).otherwise(F.size(F.split("text", "\n", -1))).cast("long").alias("n_lines"))
    out = deduplicated(lines, count="n_removed", words=PASSAGE_WORDS)
    return out.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")).cast("binary"), 256).alias("kept_sha256"))


def kept_text(text: str, gone: set[int]) -> str:
    """A text without the chunks that start at the given lines."""
    lines = text_lines(text)
    return b"\n".join(x for a, b in chunk_bounds(lines) if a not in gone for x in lines[a:b]).decode("utf-8")


def sha256(text: str | None) -> str:
    """Lowercase hex of a text's UTF-8."""
    return hashlib.sha256((text or "").encode("utf-8")).hexdigest()
