"""Merkle manifest of documents: digests, roots, and a proof of every document.

Leaves stand in order within their source. Tasks accumulate the indexed digests of partial parents; as soon as a parent
has as many children as the size of its level says, its own digest goes on as a child of the next. What a task can't
complete is dealt again by an ancestor, so that siblings meet, until nothing is open. Proofs follow the links back,
from the root to the leaves, a block of one ancestor at a time.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoloom.llm.shared import drop_written, written

#: Children of a node, and levels of a block: proofs are made for the 3**6 = 729 digests below one ancestor at a time.
ARITY, BLOCK = 3, 6
#: Stands for a digest's own place among its siblings.
OWN = "*"
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
ITEM = "grp string, digest string, doc_id long, extra string"
NODE = "grp string, size long, level int, idx long, digest string, state string"
PATH = "grp string, idx long, extra string, path array<string>, subroot string"
PROOF = "doc_id long, leaf string, subroot string, proof_sha256 string, folded_root string"


def digest_of(text: str) -> str:
    """Lowercase hex SHA-256 of an ASCII string."""
    return hashlib.sha256(text.encode("ascii")).hexdigest()


def level_size(size: int, level: int) -> int:
    """Nodes of a level above `size` leaves."""
    for _ in range(level):
        size = -(-size // ARITY)
    return size


def height(size: int) -> int:
    """The level that has a single node."""
    level = 0
    while size > 1:
        size, level = -(-size // ARITY), level + 1
    return level


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    """Rows as a batch."""
    columns = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)


NODE_SCHEMA = pa.schema([("grp", pa.string()), ("size", pa.int64()), ("level", pa.int32()), ("idx", pa.int64()), ("digest", pa.string()), ("state", pa.string())])
PATH_SCHEMA = pa.schema([("grp", pa.string()), ("idx", pa.int64()), ("extra", pa.string()), ("path", pa.list_(pa.string())), ("subroot", pa.string())])
PROOF_SCHEMA = pa.schema([("doc_id", pa.int64()), ("leaf", pa.string()), ("subroot", pa.string()), ("proof_sha256", pa.string()), ("folded_root", pa.string())])


class Partial:
    """Partial parents of one task, by (group, size, level, index): indexed child digests until the arity is met."""

    def __init__(self) -> None:
        self.open: dict[tuple, dict[int, str]] = {}

    def add(self, grp: str, size: int, level: int, idx: int, digest: str) -> Iterator[tuple]:
        """A digest arrives; yields each ancestor that is complete by it, (group, size, level, index, digest, width)."""
        width = level_size(size, level)
        while width > 1:
            level, parent, at = level + 1, idx // ARITY, idx % ARITY
            key = (grp, size, level, parent)
            children = self.open.setdefault(key, {})
            children[at] = digest
            if len(children) < min(ARITY, width - ARITY * parent):
                return
            del self.open[key]
            idx, digest, width = parent, digest_of("".join(children[i] for i in sorted(children))), -(-width // ARITY)
            yield grp, size, level, idx, digest, width

    def rest(self) -> Iterator[tuple]:
        """The children of parents that are still open."""
        for (grp, size, level, parent), children in self.open.items():
            for at, digest in children.items():
                yield grp, size, level - 1, parent * ARITY + at, digest


def combined(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Digests in; out come heads of blocks and roots that they complete, and what stays open.

    Leaves come in the order of their index, so a task holds some partial parents a level, however many leaves it reads.
    """
    partial = Partial()
    for batch in batches:
        out = []
        for grp, size, level, idx, digest in zip(*(batch.column(i).to_pylist() for i in range(5)), strict=True):
            if size == 1:
                out.append((grp, size, level, idx, digest, "root"))
            for node in partial.add(grp, size, level, idx, digest):
                if node[5] == 1 or node[2] % BLOCK == 0:
                    out.append((*node[:5], "root" if node[5] == 1 else "head"))
        yield batch_of(out, NODE_SCHEMA)
    yield batch_of([(*x, "open") for x in partial.rest()], NODE_SCHEMA)


def partitions(rows: DataFrame) -> int:
    return max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))


def resolved(leaves: DataFrame) -> list[DataFrame]:
    """Tables of nodes; their 'head' and 'root' rows are every head of a block and every root, each once.

    The first pass combines leaves where they lie. Each further one deals what is open by its ancestor at the end of the
    next block of levels (by its parent beyond that), so that all that is open below the ancestor meets.
    """
    tables = [written(leaves.select("grp", "size", F.lit(0).alias("level"), "idx", "digest").mapInArrow(combined, NODE), "nodes")]
    top = 0
    while True:
        still = tables[-1].where("state = 'open'").drop("state")
        if still.isEmpty():
            return tables
        top += BLOCK
        up = F.greatest(F.lit(top) - F.col("level"), F.lit(1))
        ancestor = F.expr(" ".join(["CASE", *[f"WHEN up = {n} THEN idx div {ARITY**n}" for n in range(1, BLOCK + 1)], "END"]))
        dealt = still.withColumn("up", up).withColumn("of_idx", ancestor).withColumn("of_level", F.col("level") + F.col("up"))
        tables.append(written(dealt.repartition(partitions(leaves), "grp", "of_level", "of_idx").drop("up", "of_idx", "of_level").mapInArrow(combined, NODE), "nodes"))


def counted(batches: Iterator[pa.RecordBatch], names: list[str]) -> Iterator[pa.RecordBatch]:
    """Each row with its number among the rows of its group in this task; the group is the first column."""
    seen: dict[str, int] = {}
    for batch in batches:
        inside = []
        for grp in batch.column(0).to_pylist():
            inside.append(seen.get(grp, 0))
            seen[grp] = inside[-1] + 1
        yield pa.record_batch([*batch.columns, pa.array(inside, pa.int64())], names=names)


def numbered(rows: DataFrame, *order: str) -> tuple[DataFrame, DataFrame]:
    """Rows of ITEM with `idx`, the place in their group, and `size`, the group's rows; and the table that they are read from.

    Rows are range-partitioned by group and order (equal ones by where they were read, so copies spread), numbered within
    their partition, and moved on by the group's rows in the partitions before it.
    """
    places = rows.withColumn("seen", F.monotonically_increasing_id()).repartitionByRange(partitions(rows), "grp", *order, "seen").sortWithinPartitions("grp", *order, "seen")
    placed = places.select("grp", "digest", "doc_id", "extra", F.spark_partition_id().alias("part"))
    names = [*placed.columns, "inside"]
    kept = written(placed.mapInArrow(lambda b: counted(b, names), ITEM + ", part int, inside long"), "leaves")
    counts = kept.groupBy("grp", "part").agg(F.count(F.lit(1)).alias("n"))
    group = Window.partitionBy("grp")
    before = F.coalesce(F.sum("n").over(group.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = counts.select("grp", "part", before.alias("before"), F.sum("n").over(group).alias("size"))
    return kept.join(offsets, ["grp", "part"]).select("grp", "size", (F.col("before") + F.col("inside")).alias("idx"), "digest", "doc_id", "extra"), kept


def linked(nodes: list[tuple[int, str]], size: int, level: int) -> Iterator[list[str]]:
    """For each (index, digest) of one whole block: its run of siblings with OWN in its place, then those of its ancestors
    below the block's head."""
    links: list[dict[int, str]] = []
    now = dict(nodes)
    width = level_size(size, level)
    while width > 1 and len(links) < BLOCK:
        link, above = {}, {}
        for parent in dict.fromkeys(i // ARITY for i in now):
            run = [now[i] for i in range(parent * ARITY, min(width, parent * ARITY + ARITY))]
            for at in range(len(run)):
                link[parent * ARITY + at] = "".join([*run[:at], OWN, *run[at + 1 :]])
            above[parent] = digest_of("".join(run))
        links.append(link)
        now, width = above, -(-width // ARITY)
    for idx, _ in nodes:
        yield [link[idx // ARITY**up] for up, link in enumerate(links)]


def folded(digest: str, path: list[str]) -> str:
    """The root that a digest and its runs of siblings lead to."""
    for run in path:
        digest = digest_of(run.replace(OWN, digest))
    return digest


def members(block: pa.Table, head: pa.Table) -> Iterator[tuple[dict, list[str]]]:
    """Rows of one block, each with its path up to the root: the block's own links, then the path of its head."""
    rows = block.to_pylist()
    above = head["path"][0].as_py() if rows else []
    own = linked([(r["idx"], r["digest"]) for r in rows], rows[0]["size"], rows[0]["level"]) if rows else []
    for row, path in zip(rows, own, strict=True):
        yield row, [*path, *above]


def block_paths(block: pa.Table, head: pa.Table) -> pa.Table:
    """Paths of one block; an item without a source's root above it is one itself."""
    subroot = head["subroot"][0].as_py() if head.num_rows else None
    out = [(r["grp"], r["idx"], r["extra"], path, subroot or r["digest"]) for r, path in members(block, head)]
    return pa.Table.from_batches([batch_of(out, PATH_SCHEMA)])


def block_proofs(block: pa.Table, head: pa.Table) -> pa.Table:
    """Digests of the paths of one block of leaves, and the roots that they fold to from the tampered leaf, if there is one."""
    subroot = head["subroot"][0].as_py() if head.num_rows else None
    out = [(r["doc_id"], r["digest"], subroot, digest_of("".join(path).replace(OWN, "")), folded(r["extra"] or r["digest"], path)) for r, path in members(block, head)]
    return pa.Table.from_batches([batch_of(out, PROOF_SCHEMA)])


def paths(items: DataFrame, tables: list[DataFrame], roots: DataFrame, largest: int, proofs: bool) -> DataFrame:
    """The path of every item from (grp, size, path, subroot) of the roots down, block by block of levels.

    A task holds one block (3**BLOCK digests) at a time, so a source with most rows is as many blocks as it needs.
    """
    nodes = tables[0].where("state <> 'open'")
    for more in tables[1:]:
        nodes = nodes.unionAll(more.where("state <> 'open'"))
    above = None
    for k in range(height(largest) // BLOCK, -1, -1):
        if k:
            rows = nodes.where(F.col("level") == k * BLOCK).select("grp", "size", "level", "idx", "digest", F.lit(None).cast("long").alias("doc_id"), F.lit(None).cast("string").alias("extra"))
        else:
            rows = items.select("grp", "size", F.lit(0).alias("level"), "idx", "digest", "doc_id", "extra")
        low, high = (ARITY ** (k * BLOCK - 1) if k else 0), ARITY ** ((k + 1) * BLOCK - 1)
        heads = roots.where((F.col("size") > low) & (F.col("size") <= high)).select("grp", F.lit(0).cast("long").alias("block"), "path", "subroot")
        if above is not None:
            heads = heads.unionAll(above.select("grp", F.col("idx").alias("block"), "path", "subroot"))
        heads = heads.select(F.col("grp").alias("of_grp"), F.col("block").alias("of_block"), F.col("path").alias("path"), F.col("subroot").alias("subroot"))
        dealt = rows.withColumn("block", F.expr(f"idx div {ARITY**BLOCK}")).groupBy("grp", "block").cogroup(heads.groupBy("of_grp", "of_block"))
        above = dealt.applyInArrow(block_proofs, PROOF) if proofs and k == 0 else dealt.applyInArrow(block_paths, PATH)
    return above


def of_state(tables: list[DataFrame], state: str) -> DataFrame:
    """Rows of one state of all tables."""
    out = tables[0].where(F.col("state") == state)
    for more in tables[1:]:
        out = out.unionAll(more.where(F.col("state") == state))
    return out


def field(value: Column) -> Column:
    """A value's UTF-8 byte count, a colon and the value; a hyphen for null."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))


def leaf_digest(text: Column) -> Column:
    """Digest of a document's fields, with `text` in place of its text."""
    return F.sha2(F.concat(*[field(text if c == "text" else F.col(c)) for c in FIELDS]).cast("binary"), 256)


def manifest(docs: DataFrame) -> DataFrame:
    """(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified) of every row.

    A null source is a source of its own and stands first; rows without an id stand first in their source; rows that
    share an id stand in the order of their leaves, and equal rows are a leaf each. A document whose text has no line
    feed, or is null, isn't changed by the tampering and verifies. A lone document of a lone source is its own root, with
    an empty proof. An empty table gives no rows. Other columns are neither read nor returned.
    """
    spark = docs.sparkSession
    doc_id, text = F.col("doc_id").cast("long"), F.col("text")
    tampered = (F.crc32(doc_id.cast("string").cast("binary")) % 2 == 0) & F.contains(text, F.lit("\n"))
    grp = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("-"))
    leaves = docs.select(grp.alias("grp"), leaf_digest(text).alias("digest"), doc_id.alias("doc_id"), F.when(tampered, leaf_digest(F.replace(text, F.lit("\n"), F.lit("")))).alias("extra"))
    items, _ = numbered(leaves, "doc_id", "digest")
    tables = resolved(items)
    subroots = of_state(tables, "root")
    largest = subroots.agg(F.max("size")).first()[0]
    if largest is None:
        return spark.createDataFrame([], "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    above, kept = numbered(subroots.select(F.lit("").alias("grp"), "digest", F.lit(None).cast("long").alias("doc_id"), F.col("grp").alias("extra")), "extra")
    tops = resolved(above)
    root = of_state(tops, "root").first()
    start = spark.createDataFrame([("", root["size"], [], None)], "grp string, size long, path array<string>, subroot string")
    down = written(paths(above, tops, start, root["size"], False).select(F.col("extra").alias("grp"), "path", "subroot"), "subroot_paths")
    for table in (*tops, kept):
        drop_written(table)
    out = paths(items, tables, subroots.select("grp", "size").join(down, "grp"), largest, True)
    return out.select("doc_id", "leaf", "subroot", F.lit(root["digest"]).alias("root"), "proof_sha256", "folded_root", (F.col("folded_root") == root["digest"]).alias("verified"))
