"""Lloyd's clustering of integer vectors with Hamerly's bounds, exact in every decision.

Each vector keeps an upper bound of the distance to its own centroid and a lower bound of that to the second nearest
(Hamerly, "Making k-means even faster", 2010), as floating point with a margin for rounding. Centroids that move loosen
them by how far they moved; a vector whose bounds still differ can't change cluster and isn't compared with anything.
The others get exact integer distances to all centroids. Sums change only by vectors that moved.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.shared import drop_written, written

DIMENSIONS, CLUSTERS, ROUNDS, SCALE, SEED = 64, 8, 10, 1024, 3
#: Bounds count as different beyond this share of them: far more than ten rounds of rounding add up to.
MARGIN = 1e-9
#: Integers up to this have squared distances of 64 components that fit 64 bits; beyond it Python's own integers are used.
SMALL = 2**27
MOST = 2**63 - 1
STATE = "vec_id long, x array<long>, cluster int, was int, upper double, lower double"
FINAL = "vec_id long, cluster int, distance long"
OUT = "vec_id long, cluster int, distance long, cluster_inertia long, inertia long, centroid_sha256 string"


def fitting(x: np.ndarray, *others: np.ndarray) -> np.ndarray:
    """The integers, as Python's own where squared distances to any of the others might not fit 64 bits."""
    small = all(a.dtype != object and (a.size == 0 or (a.max() <= SMALL and a.min() >= -SMALL)) for a in (x, *others))
    return x if small else x.astype(object)


def squared(x: np.ndarray, c: np.ndarray) -> np.ndarray:
    """Exact squared distances of the rows of x to c (one centroid, or one a row)."""
    x = fitting(x, c)
    gap = x - c
    return (gap * gap).sum(axis=1) if gap.dtype == object else np.einsum("ij,ij->i", gap, gap)


def centroid_array(centroids: list[list[int]]) -> np.ndarray:
    """Centroids as 64-bit integers, or as Python's own if one doesn't fit."""
    return np.array(centroids, dtype=np.int64)


def scanned(x: np.ndarray, c: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Nearest centroid of each row (ties: the smaller number), its distance, and the second smallest distance."""
    best = squared(x, c[0])
    second = np.full(len(x), np.inf)
    at = np.zeros(len(x), dtype=np.int32)
    for k in range(1, len(c)):
        d = squared(x, c[k])
        nearer = (d < best).astype(bool)
        second = np.minimum(second, np.where(nearer, best, d).astype(float))
        at[nearer] = k
        best = np.where(nearer, d, best)
    return at, np.sqrt(best.astype(float)), np.sqrt(second)


class Moves:
    """A round's centroids, how far each moved at most, and half the distance to the nearest other one at least."""

    def __init__(self, centroids: list[list[int]], before: list[list[int]] | None):
        self.c = centroid_array(centroids)
        self.first = before is None
        k = len(self.c)
        self.drift = np.zeros(k) if before is None else np.sqrt(np.array([float(squared(self.c[i : i + 1], centroid_array(before)[i])[0]) for i in range(k)])) * (1 + MARGIN)
        others = [[float(d) for j, d in enumerate(squared(self.c, self.c[i])) if j != i] for i in range(k)]
        self.half = np.array([np.sqrt(min(d)) / 2 if d else np.inf for d in others])
        order = np.sort(self.drift)[::-1]
        self.largest, self.next = order[0], order[1] if k > 1 else 0.0

    def assign(self, x: np.ndarray, cluster: np.ndarray, upper: np.ndarray, lower: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
        """Clusters and bounds after the round, and how many rows were compared with all centroids."""
        if self.first:
            return *scanned(x, self.c), len(x)
        upper = upper + self.drift[cluster]
        lower = lower - np.where(self.drift[cluster] == self.largest, self.next, self.largest)
        bound = np.maximum(lower, self.half[cluster])
        open_ = np.flatnonzero(~(upper * (1 + MARGIN) < bound * (1 - MARGIN)))
        if len(open_):
            upper[open_] = np.sqrt(squared(x[open_], self.c[cluster[open_]]).astype(float))
            open_ = open_[~(upper[open_] * (1 + MARGIN) < bound[open_] * (1 - MARGIN))]
        if len(open_):
            cluster = cluster.copy()
            cluster[open_], upper[open_], lower[open_] = scanned(x[open_], self.c)
        return cluster, upper, lower, len(open_)


def vectors(column: pa.Array) -> np.ndarray:
    """A batch's vectors as a matrix of 64-bit integers."""
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)


def stepped(batches: Iterator[pa.RecordBatch], moves: Moves) -> Iterator[pa.RecordBatch]:
    """State rows after a round."""
    for batch in batches:
        if batch.num_rows:
            was = batch.column(2).to_numpy(zero_copy_only=False)
            cluster, upper, lower, _ = moves.assign(vectors(batch.column(1)), was, *(batch.column(i).to_numpy(zero_copy_only=False) for i in (4, 5)))
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(cluster, pa.int32()), pa.array(was, pa.int32()), pa.array(upper), pa.array(lower)], names=batch.schema.names)


def changes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(cluster, total) of a task's vectors that moved: their number, then the sum of each component; leaving counts below zero."""
    total: dict[int, np.ndarray] = {}
    for batch in batches:
        x = vectors(batch.column(0)) if batch.num_rows else np.zeros((0, DIMENSIONS), dtype=np.int64)
        for column, sign in ((1, 1), (2, -1)):
            of = batch.column(column).to_numpy(zero_copy_only=False)
            for k in np.unique(of[of >= 0]):
                rows = fitting(x[of == k])
                own = np.array([len(rows), *rows.sum(axis=0).tolist()], dtype=object) * sign
                total[int(k)] = total[int(k)] + own if int(k) in total else own
    exact = pa.list_(pa.decimal128(38, 0))
    yield pa.record_batch([pa.array(list(total), pa.int32()), pa.array([[Decimal(int(v)) for v in t] for t in total.values()], exact)], names=["cluster", "total"])


def measured(batches: Iterator[pa.RecordBatch], moves: Moves) -> Iterator[pa.RecordBatch]:
    """(vec_id, cluster, distance) under the last centroids; null where a distance is beyond a long."""
    for batch in batches:
        if batch.num_rows:
            x = vectors(batch.column(1))
            cluster, _, _, _ = moves.assign(x, *(batch.column(i).to_numpy(zero_copy_only=False) for i in (2, 4, 5)))
            exact = squared(x, moves.c[cluster])
            distance = pa.array([int(d) if d <= MOST else None for d in exact], pa.int64()) if exact.dtype == object else pa.array(exact, pa.int64())
            yield pa.record_batch([batch.column(0), pa.array(cluster, pa.int32()), distance], names=["vec_id", "cluster", "distance"])


def kept_vectors(rows: DataFrame) -> DataFrame:
    """(vec_id, x) of vectors with exactly DIMENSIONS components, none null or non-finite, as integers floor(SCALE * x)."""
    whole = F.forall("embedding", lambda x: x.isNotNull() & (F.abs(x) < float("inf")))
    scaled = F.transform("embedding", lambda x: F.floor(x.cast("double") * SCALE).cast("long"))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), "embedding").where((F.size("embedding") == DIMENSIONS) & whole).select("vec_id", scaled.alias("x"))


def first_centroids(kept: DataFrame) -> list[list[int]]:
    """The vectors with the least hashes of their ids, in that order: CLUSTERS rows reach the driver."""
    place = F.sha2(F.concat(F.lit(f"{SEED}:"), F.coalesce(F.col("vec_id").cast("string"), F.lit(""))).cast("binary"), 256)
    return [list(r.x) for r in kept.select("x", place.alias("place")).orderBy("place", "x").limit(CLUSTERS).collect()]


def clustered(rows: DataFrame) -> DataFrame:
    """(vec_id, cluster, distance, cluster_inertia, inertia, centroid_sha256) of every kept vector.

    Each round writes the vectors with their bounds and removes the table before it; the driver holds CLUSTERS centroids
    and sums. Vectors that are null, of another length, or hold null or non-finite components are left out. A null id is
    hashed as an empty one; of rows with one id and hash the smaller vector goes first; repeated rows are vectors each.
    Fewer than CLUSTERS vectors are a centroid each; none give no rows. Components beyond a long count as the nearest
    one; a distance, or sum, beyond a long is null. Other columns are neither read nor returned.
    """
    spark = rows.sparkSession
    state = written(kept_vectors(rows).select("vec_id", "x", F.lit(-1).alias("cluster"), F.lit(-1).alias("was"), F.lit(0.0).alias("upper"), F.lit(0.0).alias("lower")), "vectors")
    centroids, before = first_centroids(state), None
    if not centroids:
        drop_written(state)
        return spark.createDataFrame([], OUT)
    sums = [[0] * (DIMENSIONS + 1) for _ in centroids]
    for _ in range(ROUNDS):
        moves = Moves(centroids, before)
        after = written(state.mapInArrow(lambda b, m=moves: stepped(b, m), STATE), "vectors")
        drop_written(state)
        state = after
        moved = state.where("cluster <> was").select("x", "cluster", "was").mapInArrow(changes, "cluster int, total array<decimal(38,0)>")
        for r in moved.select("cluster", F.posexplode("total").alias("at", "v")).groupBy("cluster", "at").agg(F.sum("v").alias("v")).collect():
            sums[r.cluster][r.at] += int(r.v)
        before, centroids = centroids, [[s // n for s in total] if n else c for (n, *total), c in zip(sums, centroids, strict=True)]
    moves = Moves(centroids, before)
    final = written(state.mapInArrow(lambda b: measured(b, moves), FINAL), "clusters")
    drop_written(state)
    whole = F.when(F.count("distance") == F.count(F.lit(1)), F.sum(F.col("distance").cast("decimal(20,0)")))
    inertia = {r.cluster: r.v for r in final.groupBy("cluster").agg(whole.alias("v")).collect()}
    as_long = lambda v: F.lit(int(v) if v is not None and v <= MOST else None).cast("long")
    every = None if None in inertia.values() else sum(inertia.values())
    of = lambda values: F.get(F.array(*values), F.col("cluster"))
    digests = [hashlib.sha256(",".join(map(str, c)).encode()).hexdigest() for c in centroids]
    return final.select("vec_id", "cluster", "distance", of([as_long(inertia.get(k)) for k in range(len(centroids))]).alias("cluster_inertia"), as_long(every).alias("inertia"), of([F.lit(d) for d in digests]).alias("centroid_sha256"))
