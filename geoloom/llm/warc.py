"""WARC archives of captures: request, response (or revisit) and metadata records, written, read back and joined again.

Records are WARC/1.1 text in UTF-8, gzip files written by Spark's text writer with the record terminator as its line
separator, so that any Hadoop store serves. The reader follows Content-Length, never a separator, so payloads may hold
anything.
"""

from __future__ import annotations

import hashlib
import zlib
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from geoloom.llm.shared import drop_written, id_or_none, known_id, new_folder, remove, written

LEAST_REVISIT = 1000
#: Bytes of payloads in a file on average: pages are dealt by a hash to as many files, so that what the reader holds at
#: once is this and, at most, some pages that are larger themselves.
FILE_BYTES = 32_000_000
#: Records in a file at most, a multiple of three.
FILE_RECORDS = 30_000
END = "\r\n\r\n"
RECORD = "record_id string, record_type string, target_uri string, concurrent_to string, refers_to string, payload_digest string, payload_bytes long, computed_digest string, computed_bytes long, payload string"


def revisits(pages: DataFrame, least: int = LEAST_REVISIT) -> DataFrame:
    """(page_id, id, digest, bytes) -> (again_id, refers_to), ids of the pages that repeat a payload of at least `least` bytes.

    The page with the largest page_id keeps the payload, of equal ones that with the largest id. Digests are counted before they are shuffled; only pages of repeated
    digests travel, as ids, and Spark can split a digest that many pages share, since nothing above the join groups.
    """
    large = pages.where(F.col("bytes") >= least)
    kept = large.groupBy("digest").agg(F.max(F.struct("page_id", "id")).alias("kept"), F.count(F.lit(1)).alias("n")).where("n > 1").select("digest", F.col("kept.id").alias("kept_id"), F.col("kept.page_id").alias("kept_page"))
    named = F.concat_ws(":", F.col("kept_page").cast("string"), F.col("kept_id").cast("string"))
    return large.select("id", "digest").join(kept, "digest").where("id <> kept_id").select(F.col("id").alias("again_id"), named.alias("refers_to"))


def record(kind: str, own_id: str, uri, date, headers: list, body):
    """One record without its terminator."""
    lines = [F.lit("WARC/1.1\r\nWARC-Type: " + kind + "\r\nWARC-Record-ID: <urn:capture:" + own_id), F.col("id"), F.lit(">\r\nWARC-Target-URI: "), uri, F.lit("\r\nWARC-Date: " + date)]
    for name, value in headers:
        lines += [F.lit("\r\n" + name + ": "), value]
    return F.concat(*lines, F.lit("\r\nContent-Length: "), F.octet_length(body).cast("string"), F.lit("\r\n\r\n"), body)


def write_archive(pages: DataFrame, folder: str, page_id: str = "page_id", url: str = "url", html: str = "html", least: int = LEAST_REVISIT, date: str = "2024-01-01T00:00:00Z") -> None:
    """Three records a page: request, response or revisit (without payload, referring to the page that has it), metadata.

    Null html is an empty payload and null urls an empty target; line ends in urls become %0D and %0A so that a header
    stays one line. An identifier has the page's id and a number of its row, so that repeated rows, and pages that share
    an id, are captures of their own; an empty table writes no records. Rows are numbered in a table of their own: the
    numbers have to be the same wherever a page is read again.
    """
    spark = pages.sparkSession
    p = pages.select(id_or_none(page_id).alias("page_id"), F.coalesce(F.col(url), F.lit("")).alias("url"), F.coalesce(F.col(html), F.lit("")).alias("html"))
    p = p.select("page_id", F.regexp_replace(F.regexp_replace("url", "\r", "%0D"), "\n", "%0A").alias("url"), "html", F.sha1(F.col("html").cast("binary")).alias("digest"), F.octet_length("html").cast("long").alias("bytes"), F.monotonically_increasing_id().alias("number"))
    staged = written(p, "pages")
    again = revisits(staged.select("page_id", F.col("number").alias("id"), "digest", "bytes"), least)
    files = 1 + (staged.agg(F.sum("bytes")).first()[0] or 0) // FILE_BYTES
    parts = max(files, int(spark.conf.get("spark.sql.shuffle.partitions")))
    p = staged.repartition(parts, "number").join(again.hint("merge"), F.col("number") == F.col("again_id"), "left")
    p = p.withColumn("id", F.concat_ws(":", F.col("page_id").cast("string"), F.col("number").cast("string")))
    digest, size = F.concat(F.lit("sha1:"), F.col("digest")), F.col("bytes").cast("string")
    own = [("WARC-Payload-Digest", digest)]
    ok = F.lit("HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n\r\n")
    response = record("response", "response:", F.col("url"), date, [("Content-Type", F.lit("application/http;msgtype=response")), *own], F.concat(ok, F.col("html")))
    refers = F.concat(F.lit("<urn:capture:response:"), F.col("refers_to"), F.lit(">"))
    profile = F.lit("http://netpreserve.org/warc/1.1/revisit/identical-payload-digest")
    revisit = record("revisit", "response:", F.col("url"), date, [("WARC-Profile", profile), ("WARC-Refers-To", refers), ("Content-Type", F.lit("application/http;msgtype=response")), *own], ok)
    same = ("WARC-Concurrent-To", F.concat(F.lit("<urn:capture:response:"), F.col("id"), F.lit(">")))
    request = record("request", "request:", F.col("url"), date, [same, ("Content-Type", F.lit("application/http;msgtype=request"))], F.lit("GET / HTTP/1.1\r\n\r\n"))
    meta = record("metadata", "metadata:", F.col("url"), date, [same, ("Content-Type", F.lit("application/warc-fields"))], F.concat(F.lit("payload-bytes: "), size, F.lit("\r\n")))
    three = F.array(request, F.when(F.col("refers_to").isNull(), response).otherwise(revisit), meta)
    text = p.select(F.explode(three).alias("value"))
    text.write.option("lineSep", END).option("compression", "gzip").option("maxRecordsPerFile", FILE_RECORDS).text(folder)
    drop_written(staged)


def records_of(data: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """(headers by lower-case name, block) of each record of a gzip or plain WARC file; gzip may have many members."""
    view = data
    if data[:2] == b"\x1f\x8b":
        parts, rest = [], data
        while rest:
            opened = zlib.decompressobj(31)
            parts.append(opened.decompress(rest))
            if not opened.eof:
                raise ValueError("truncated gzip member")
            rest = opened.unused_data
        view = parts[0] if len(parts) == 1 else b"".join(parts)
    at = 0
    while at < len(view):
        stop = view.find(b"\r\n\r\n", at)
        if stop < 0 or not view.startswith(b"WARC/", at):
            raise ValueError(f"no WARC record at byte {at}")
        head = dict((k.strip().lower(), v.strip()) for k, _, v in (x.partition(":") for x in view[at:stop].decode("utf-8").split("\r\n")[1:]))
        size = int(head["content-length"])
        yield head, view[stop + 4 : stop + 4 + size]
        at = stop + 4 + size + 4


def parsed(batches: Iterator[pd.DataFrame], payloads: bool) -> Iterator[pd.DataFrame]:
    """Rows of RECORD from files' bytes, a bounded number at a time; payload texts only if asked for."""
    names = [x.split()[0] for x in RECORD.split(", ")]
    for files in batches:
        for data in files["content"]:
            rows, held = [], 0
            for head, block in records_of(bytes(data)):
                body, fields = None, {}
                if head["warc-type"] in ("response", "revisit"):
                    body = block.partition(b"\r\n\r\n")[2]
                elif head["warc-type"] == "metadata":
                    fields = dict((k, v.strip()) for k, _, v in (x.partition(":") for x in block.decode("utf-8").split("\r\n") if x))
                whole = body is not None and head["warc-type"] == "response"
                rows.append((head["warc-record-id"], head["warc-type"], head.get("warc-target-uri"), head.get("warc-concurrent-to"), head.get("warc-refers-to"), head.get("warc-payload-digest"), int(fields["payload-bytes"]) if "payload-bytes" in fields else None, hashlib.sha1(body).hexdigest() if whole else None, len(body) if whole else None, body.decode("utf-8") if whole and payloads else None))
                held += len(block) if payloads else 0
                if len(rows) >= 3000 or held > 8_000_000:
                    yield pd.DataFrame(rows, columns=names).astype({"payload_bytes": "Int64", "computed_bytes": "Int64"})
                    rows, held = [], 0
            if rows:
                yield pd.DataFrame(rows, columns=names).astype({"payload_bytes": "Int64", "computed_bytes": "Int64"})


def read_archive(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """The records of all archives in a folder, one row each (RECORD)."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.gz").load(folder).select("content")
    return files.mapInPandas(lambda b: parsed(b, payloads), RECORD)


def assembled(records: DataFrame) -> DataFrame:
    """One nested row per capture: (capture_id, request, response, metadata), joined through concurrent-to identifiers.

    Responses and revisits are the captures; a request or metadata record belongs to the one that its
    WARC-Concurrent-To names. A capture without one of them has null there; records naming no capture are left out, and
    records that repeat an identifier are one, so that no key is hot.
    """
    one = lambda rows, name: rows.groupBy("capture_id").agg(F.first(name).alias(name))
    main = records.where(F.col("record_type").isin("response", "revisit")).select(F.col("record_id").alias("capture_id"), F.struct("*").alias("response"))
    asked = records.where(F.col("record_type") == "request").select(F.col("concurrent_to").alias("capture_id"), F.struct("record_id", "target_uri").alias("request"))
    noted = records.where(F.col("record_type") == "metadata").select(F.col("concurrent_to").alias("capture_id"), F.struct("record_id", "payload_bytes").alias("metadata"))
    return one(main, "response").join(one(asked, "request"), "capture_id", "left").join(one(noted, "metadata"), "capture_id", "left").select("capture_id", "request", "response", "metadata")


def captures(pages: DataFrame) -> DataFrame:
    """Write pages as archives in the shared folder, read these back, and return one row per row of pages.

    The archives are removed once they are read. (page_id, payload_bytes, payload_digest, record_type, refers_to): digests and sizes of responses are computed from
    the payload read; revisits have those that their headers and metadata carry.
    """
    spark = pages.sparkSession
    folder = new_folder(spark, "warc")
    write_archive(pages, folder)
    number = lambda c: F.regexp_extract(c, r"response:(-?\d+):", 1).cast("long")
    c = assembled(read_archive(spark, folder, payloads=False))
    r = F.col("response")
    out = c.select(
        known_id(number("capture_id")).alias("page_id"),
        F.coalesce(r["computed_bytes"], F.col("metadata")["payload_bytes"]).alias("payload_bytes"),
        F.coalesce(r["computed_digest"], F.regexp_replace(r["payload_digest"], "^sha1:", "")).alias("payload_digest"),
        r["record_type"].alias("record_type"),
        known_id(number(r["refers_to"])).alias("refers_to"),
    )
    read = written(out, "captures")
    remove(spark, folder)
    return read
