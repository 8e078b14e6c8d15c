"""SimHash near-duplicates: fingerprints of shingles, linked within a Hamming radius through a vantage-point tree.

A tree over a bounded sample of fingerprints deals all fingerprints to shards: at each node those within the node's
radius of its vantage point go left, the others right, and those of the right that lie within the link radius of the
boundary go left as well. By the triangle inequality no pair within the link radius is parted: its members meet in the
shard of the one that is further left. Each shard is searched by a tree of its own.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.shared import NO_ID, components, drop_written, hash_sample, id_or_none, known_id, written

SHINGLE, BITS, SEED = 3, 2, 42
#: Fingerprints in a shard before its boundary copies, shards at most (beyond 130 million fingerprints shards grow
#: instead, at 10 thousand million to 150 000), sampled fingerprints per shard: 2 million, 17 MB, at most.
SHARD_ROWS, MOST_SHARDS, SAMPLE_ROWS = 2_000, 65_536, 32
LEAF_ROWS = 256


def words_of(text: str | None) -> tuple[list[bytes], bytes]:
    """Words, and the text of them: bytes.lower() changes A-Z only and bytes.split() parts at exactly the six ASCII spaces."""
    tokens = (text or "").encode("utf-8").lower().split()
    return tokens, b" ".join(tokens)


def shingle_hashes(tokens: list[bytes], body: bytes, shingle: int, seed: int) -> np.ndarray:
    """XXH64 of each shingle in order, repeats included; of fewer words than that the whole text is one."""
    if not tokens:
        return np.zeros(0, np.uint64)
    width = min(shingle, len(tokens))
    sizes = np.fromiter(map(len, tokens), np.int64, len(tokens))
    starts = np.concatenate(([0], np.cumsum(sizes + 1)[:-1]))
    ends = (starts + sizes)[width - 1 :]
    digest = xxhash.xxh64_intdigest
    return np.fromiter((digest(body[a:b], seed) for a, b in zip(starts.tolist(), ends.tolist(), strict=False)), np.uint64, len(ends))


def folded(hashes: np.ndarray) -> int:
    """64-bit SimHash: a bit is one if it is set in over half of the hashes; none give zero."""
    counts = np.zeros(64, np.int64)
    for at in range(0, len(hashes), 65536):
        part = hashes[at : at + 65536].astype("<u8")
        counts += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(counts * 2 > len(hashes), bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, shingle: int = SHINGLE, seed: int = SEED) -> int:
    """The SimHash of a text's shingles; no words give zero."""
    return folded(shingle_hashes(*words_of(text), shingle, seed))


def fingerprinted(batches: Iterator[pd.DataFrame], shingle: int, seed: int) -> Iterator[pd.DataFrame]:
    """(doc_id, fp) of each (doc_id, text); fp is the fingerprint as a signed long."""
    for docs in batches:
        fps = np.fromiter((fingerprint(t if isinstance(t, str) else None, shingle, seed) for t in docs["text"]), np.uint64, len(docs))
        yield pd.DataFrame({"doc_id": docs["doc_id"], "fp": fps.view(np.int64)})


def distances(points: np.ndarray, to: np.uint64) -> np.ndarray:
    """Hamming distances of fingerprints to one."""
    return np.bitwise_count(points ^ to).astype(np.int64)


def grown(sample: np.ndarray, depth: int, rng: np.random.Generator) -> list[tuple[int, int] | None]:
    """Nodes (vantage point, radius) of a tree of at most `depth` levels as a heap; None where a branch ends."""
    nodes: list[tuple[int, int] | None] = [None] * (2 ** (depth + 1))
    parts = {1: sample}
    for at in range(1, 2**depth):
        part = parts.pop(at, None)
        if part is None or len(part) < 4:
            continue
        point = part[rng.integers(len(part))]
        far = distances(part, point)
        radius = int(np.median(far))
        left = far <= radius
        if left.all():
            radius = int(far.max()) - 1
            left = far <= radius
        if radius < 0 or not left.any():
            continue
        nodes[at] = (int(point), radius)
        parts[2 * at], parts[2 * at + 1] = part[left], part[~left]
    return nodes


def dealt(points: np.ndarray, nodes: list, bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(leaf, indexes of points in it, whether each is there only because of a boundary)."""
    todo = [(1, np.arange(len(points)), np.zeros(len(points), bool))]
    while todo:
        at, own, copy = todo.pop()
        if not len(own):
            continue
        node = nodes[at] if at < len(nodes) else None
        if node is None:
            yield at, own, copy
            continue
        far = distances(points[own], np.uint64(node[0]))
        left, near = far <= node[1], far <= node[1] + bits
        todo.append((2 * at, own[near], copy[near] | ~left[near]))
        todo.append((2 * at + 1, own[~left], copy[~left]))


def close_pairs(points: np.ndarray, bits: int, rng: np.random.Generator) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs within `bits`, every one at least once: a tree down to small leaves, each compared whole."""
    todo = [np.arange(len(points))]
    while todo:
        own = todo.pop()
        part = points[own]
        if len(own) > LEAF_ROWS:
            far = distances(part, part[rng.integers(len(part))])
            radius = int(np.median(far))
            left = far <= radius + bits
            right = far > radius
            if max(left.sum(), right.sum()) < 0.9 * len(own) and right.any():
                todo += [own[left], own[right]]
                continue
        for a in range(0, len(own), 1024):
            for b in range(a, len(own), 1024):
                i, j = np.nonzero(np.bitwise_count(part[a : a + 1024, None] ^ part[None, b : b + 1024]) <= bits)
                keep = (a + i) < (b + j)
                if keep.any():
                    yield own[a + i[keep]], own[b + j[keep]]


class Forest:
    """Union-find over positions; the least position of a set is its root."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def root(self, x: int) -> int:
        up = self.up
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    def link(self, a: int, b: int) -> None:
        a, b = self.root(a), self.root(b)
        if a != b:
            self.up[max(a, b)] = min(a, b)


def shard_links(shard: pd.DataFrame, bits: int) -> pd.DataFrame:
    """A spanning forest of a shard's links, as (a, b) fingerprints."""
    points = np.unique(shard["fp"].to_numpy()).view(np.uint64)
    forest = Forest(len(points))
    for i, j in close_pairs(points, bits, np.random.default_rng(len(points))):
        for a, b in zip(i.tolist(), j.tolist(), strict=True):
            forest.link(a, b)
    roots = np.fromiter((forest.root(x) for x in range(len(points))), np.int64, len(points))
    own = np.flatnonzero(roots != np.arange(len(points)))
    return pd.DataFrame({"a": points[own].view(np.int64), "b": points[roots[own]].view(np.int64)})


def spread(batches: Iterator[pd.DataFrame], nodes: list, bits: int) -> Iterator[pd.DataFrame]:
    """(shard, fp) of each fingerprint, once more for each boundary that it lies near."""
    for rows in batches:
        fps = rows["fp"].to_numpy()
        points = fps.view(np.uint64)
        for at in range(0, len(fps), 50_000):
            part = points[at : at + 50_000]
            found = [pd.DataFrame({"shard": np.full(len(own), leaf, np.int64), "fp": part[own].view(np.int64)}) for leaf, own, _ in dealt(part, nodes, bits)]
            yield pd.concat(found, ignore_index=True)


def fingerprint_links(fps: DataFrame, bits: int = BITS) -> DataFrame:
    """Distinct fingerprints (fp long) -> links (a, b) whose components are those of all pairs within `bits`.

    Each shard gives a spanning forest of its links, fewer than it has fingerprints, however dense it is. The tree
    comes from a hash sample of about SAMPLE_ROWS fingerprints for each of at most MOST_SHARDS shards; all fingerprints go through it.
    """
    n = fps.count()
    shards = min(MOST_SHARDS, max(1, -(-n // SHARD_ROWS)))
    depth = (shards - 1).bit_length()
    sample = hash_sample(fps, "fp", SAMPLE_ROWS * 2**depth, n).toPandas()["fp"].to_numpy(np.int64) if depth else np.zeros(0, np.int64)
    points = np.sort(sample).view(np.uint64)
    nodes = grown(points, depth, np.random.default_rng(7)) if depth else [None, None]
    dealt_rows = fps.mapInPandas(lambda b: spread(b, nodes, bits), "shard long, fp long")
    return dealt_rows.groupBy("shard").applyInPandas(lambda x: shard_links(x, bits), "a long, b long")


def fingerprint_roots(fps: DataFrame, bits: int = BITS) -> DataFrame:
    """Distinct fingerprints (fp long) -> (fp, root): fingerprints reachable from each other by links have one root."""
    ends = components(fingerprint_links(fps, bits))
    return fps.join(ends.select(F.col("id").alias("fp"), "root"), "fp", "left").select("fp", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, bits: int = BITS, seed: int = SEED) -> DataFrame:
    """(doc_id, fingerprint, component_id): one row per document, of whole texts.

    Documents with equal fingerprints are one class; classes within `bits` are linked, and component_id is the smallest
    doc_id of what is reachable, null where all ids are. Null, empty and blank texts have fingerprint zero and link like any other. Repeated
    rows stay; an empty table gives an empty one; other columns are left out.
    """
    rows = docs.select(id_or_none(doc_id).alias("doc_id"), F.col(text).alias("text"))
    fps = written(rows.mapInPandas(lambda b: fingerprinted(b, shingle, seed), "doc_id long, fp long"), "fingerprints")
    classes = written(fps.groupBy("fp").agg(F.min(F.when(F.col("doc_id") != NO_ID, F.col("doc_id"))).alias("least")), "classes")
    rooted = written(classes.join(fingerprint_roots(classes.select("fp"), bits), "fp"), "rooted")
    drop_written(classes)
    first = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    of_class = rooted.join(first, "root").select(F.col("fp").alias("class_fp"), "component_id")
    joined = fps.join(of_class, fps.fp == of_class.class_fp)
    return joined.select(known_id("doc_id").alias("doc_id"), F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One document of each near-duplicate group, that with the smallest id; columns as given.

    Groups are settled over ids and fingerprints alone; documents then meet the ids that stay in one join. Rows that
    share an id are one document, of which one row stays; rows without an id belong to no group and all stay.
    """
    grouped = near_duplicates(docs.where(F.col(doc_id).isNotNull()), doc_id, text, **options)
    stay = grouped.where("doc_id = component_id").select(F.col("doc_id").alias("stay_id")).distinct()
    kept = docs.join(stay.hint("merge"), docs[doc_id] == stay["stay_id"], "left_semi").dropDuplicates([doc_id])
    return kept.unionAll(docs.where(F.col(doc_id).isNull()))
