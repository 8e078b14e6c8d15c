"""Embedding near-duplicates by sorted projection passes.

In each pass every vector has a string of hash bits, the signs of random projections, and all vectors are put in
lexicographic order of these strings. Each is compared, in double precision, with the WINDOW vectors after it; blocks of
the order hold the first WINDOW vectors of the next block as guests, so that no neighbour is lost at an edge. Passes
repeat until a pair right at the threshold meets with probability REACH, and the verified pairs of all passes are united.

A window is a cap only where more than WINDOW vectors agree in all the bits that are meant to tell them apart. Such a
run of the order, a dense group, is compared whole: in one task up to TILE vectors, beyond that in pairs of tiles.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoloom.llm.shared import components, drop_written, id_or_none, known_id, written
from geoloom.llm.simhash import Forest

COSINE = 0.9
WINDOW, REACH, SEED = 1024, 0.95, 11
#: Vectors of a block of the order before its guests, and of a tile of a run: what a task holds at most is twice a tile.
BLOCK, TILE = 4096, 4096
#: Hash bits of a pass; more than any table needs to tell its vectors apart.
KEY_BITS = 48
#: Passes whose vectors are shuffled at once.
AT_ONCE = 4


def plan(n: int, cosine: float = COSINE, window: int = WINDOW, reach: float = REACH) -> tuple[int, int]:
    """(bits, passes) for n vectors: runs that agree in `bits` bits have half a window of vectors on average, and a pair
    at the threshold agrees in one bit with probability 1 - angle / pi."""
    bits = min(KEY_BITS, max(1, math.ceil(math.log2(max(2, 2 * n / window)))))
    same = (1 - math.acos(cosine) / math.pi) ** bits
    return bits, math.ceil(math.log(1 - reach) / math.log(1 - same))


def usable(vector: Column) -> Column:
    """Whether a vector may link: not null, not zero, every component finite."""
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return F.coalesce(finite & F.exists(vector, lambda x: x != 0), F.lit(False))


def unit_rows(m: np.ndarray) -> np.ndarray:
    """Rows brought to length one in double precision; scaled first, so that no square overflows."""
    m = m.astype(np.float64)
    m /= np.abs(m).max(axis=1, keepdims=True)
    return m / np.linalg.norm(m, axis=1, keepdims=True)


def hashed(batches: Iterator[pd.DataFrame], passes: int, seed: int) -> Iterator[pd.DataFrame]:
    """(id, copies, vector, size, keys) of (id, copies, vector): the vector's bytes, and the hash string of each pass as a number."""
    planes: dict[int, np.ndarray] = {}
    weights = 1 << np.arange(KEY_BITS, dtype=np.int64)[::-1]
    for rows in batches:
        keys = np.zeros((len(rows), passes), np.int64)
        lengths = rows["vector"].map(len).to_numpy()
        for size in set(lengths.tolist()):
            own = np.flatnonzero(lengths == size)
            if size not in planes:
                planes[size] = np.random.default_rng([seed, size]).standard_normal((size, passes * KEY_BITS))
            for at in range(0, len(own), 1024):
                part = own[at : at + 1024]
                signs = (unit_rows(np.stack(rows["vector"].iloc[part].tolist())) @ planes[size] > 0).reshape(len(part), passes, KEY_BITS)
                keys[part] = (signs * weights).sum(axis=2)
        yield rows.assign(vector=[v.tobytes() for v in rows["vector"]], size=lengths.astype(np.int32), keys=list(keys))


def ordered(rows: DataFrame, bits: int) -> DataFrame:
    """(pass, run, at, id): every vector's place in each pass's order, and the bits that name its run; places count on
    through the passes. Only ids and keys are sorted; places come from sorted partitions and a table of their sizes."""
    keys = rows.select("id", "size", F.posexplode("keys").alias("pass", "key"))
    laid = keys.repartitionByRange("pass", "size", "key", "id").sortWithinPartitions("pass", "size", "key", "id")
    laid = written(laid.select("pass", "size", F.shiftright("key", KEY_BITS - bits).alias("run"), "id", F.monotonically_increasing_id().alias("raw")), "order")
    part, inside = F.shiftright("raw", 33), F.col("raw").bitwiseAND(2**33 - 1)
    sizes = laid.groupBy(part.alias("part")).agg(F.count(F.lit(1)).alias("n"))
    before = F.coalesce(F.sum("n").over(Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    offsets = sizes.select("part", before.alias("offset"))
    placed = written(laid.withColumn("part", part).join(offsets, "part").select("pass", F.struct("size", "run").alias("run"), (F.col("offset") + inside).alias("at"), "id"), "places")
    drop_written(laid)
    return placed


def dealt(placed: DataFrame, window: int, block: int, tile: int) -> DataFrame:
    """(id, places): the groups each vector goes to, and its places. Group (pass, kind, a, b): kind 0 is block a of the
    order with its guests, kind 1 tiles a and b of a run that is longer than a window."""
    runs = placed.groupBy("pass", "run").agg(F.count(F.lit(1)).alias("n"), F.min("at").alias("start")).where(F.col("n") > window)
    runs = runs.select(F.col("pass").alias("p"), F.col("run").alias("r"), "n", "start")
    both = placed.join(runs, (F.col("pass") == F.col("p")) & (F.col("run") == F.col("r")), "left")
    own = F.floor(F.col("at") / block).cast("long")
    group = lambda kind, home, a, b: F.struct(F.lit(kind).alias("kind"), home.alias("home"), a.alias("a"), b.alias("b"))
    zero = F.lit(0).cast("long")
    blocks = F.when(F.col("at") % block < window, F.array(group(0, own, own, zero), group(0, own, own - 1, zero))).otherwise(F.array(group(0, own, own, zero)))
    # A run's start makes its tiles' numbers different from those of other runs of the pass.
    mine = F.floor((F.col("at") - F.col("start")) / tile).cast("long")
    last = F.floor((F.col("n") - 1) / tile).cast("long")
    tiles = F.transform(F.sequence(zero, last), lambda x: group(1, F.col("start") + mine, F.col("start") + F.least(x, mine), F.col("start") + F.greatest(x, mine)))
    groups = F.when(F.col("n").isNull(), blocks).otherwise(F.concat(blocks, tiles))
    place = F.struct("pass", "at", F.col("run.run").alias("run"), groups.alias("groups"))
    return both.groupBy("id").agg(F.sort_array(F.collect_list(place)).alias("places"))


def near_each_other(group: pd.DataFrame, window: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Index pairs that a group has to compare, as (rows, rows) rectangles to be masked by place."""
    n = len(group)
    if group["kind"].iloc[0] == 0:
        step = max(1, window // 4)
        for first in range(0, n, step):
            yield np.arange(first, min(first + step, n)), np.arange(first, min(first + step + window, n))
        return
    low, high = (np.flatnonzero(group["home"] == group[side]) for side in "ab")
    for first in range(0, len(low), 1024):
        yield low[first : first + 1024], high


def verified(group: pd.DataFrame, dtype: str, cosine: float, window: int) -> pd.DataFrame:
    """Links of one group that no earlier pass has found, summed per vector, with a spanning forest of all: (id, other, links)."""
    names = ["id", "other", "links"]
    out = []
    for size, rows in group.groupby("size"):
        rows = rows.sort_values("at", kind="stable").reset_index(drop=True)
        vectors = unit_rows(np.frombuffer(b"".join(rows["vector"]), dtype).reshape(-1, int(size)))
        ids, copies, at = rows["id"].to_numpy(), rows["copies"].to_numpy(), rows["at"].to_numpy()
        number, kind = int(rows["pass"].iloc[0]), int(rows["kind"].iloc[0])
        ats, runs = (np.stack(rows[c].to_numpy())[:, :number] for c in ("ats", "runs"))
        home = (rows["home"] == rows["a"]).to_numpy()
        links, forest = np.zeros(len(ids), np.int64), Forest(len(ids))
        for left, right in near_each_other(rows, window):
            i, j = np.nonzero(vectors[left] @ vectors[right].T >= cosine)
            x, y = left[i], right[j]
            step = at[y] - at[x]
            keep = (step > 0) & ((home[x] & (step <= window)) if kind == 0 else (step > window))
            x, y = x[keep], y[keep]
            for k in range(0, len(x), 65536):
                u, v = x[k : k + 65536], y[k : k + 65536]
                if number:
                    new = ~((np.abs(ats[u] - ats[v]) <= window) | (runs[u] == runs[v])).any(axis=1)
                    u, v = u[new], v[new]
                links += np.bincount(u, copies[v], len(ids)).astype(np.int64) + np.bincount(v, copies[u], len(ids)).astype(np.int64)
                for p, q in zip(u.tolist(), v.tolist(), strict=True):
                    forest.link(p, q)
        own = np.flatnonzero(links)
        out.append(pd.DataFrame({"id": ids[own], "other": ids[[forest.root(k) for k in own.tolist()]], "links": links[own]}, columns=names))
    return pd.concat(out, ignore_index=True)


def class_links(classes: DataFrame, cosine: float, window: int, reach: float, seed: int, block: int, tile: int) -> DataFrame:
    """Distinct vectors (id, copies, vector) -> (id, other, links): links of a vector by part, and one link of the forest."""
    bits, passes = plan(classes.count(), cosine, window, reach)
    single = classes.schema["vector"].dataType.simpleString() == "array<float>"
    dtype = "f4" if single else "f8"
    numbers = F.col("vector") if single else F.col("vector").cast("array<double>")
    rows = written(classes.select("id", "copies", numbers.alias("vector")).mapInPandas(lambda b: hashed(b, passes, seed), "id long, copies long, vector binary, size int, keys array<long>"), "hashed")
    placed = ordered(rows, bits)
    laid = written(rows.drop("keys").join(dealt(placed, window, block, tile), "id"), "dealt")
    drop_written(placed)
    drop_written(rows)
    found: DataFrame | None = None
    for first in range(0, passes, AT_ONCE):
        some = F.slice("places", first + 1, AT_ONCE)
        sent = laid.select("id", "copies", "vector", "size", F.col("places.at").alias("ats"), F.col("places.run").alias("runs"), F.explode(some).alias("p"))
        sent = sent.select("id", "copies", "vector", "size", "ats", "runs", "p.pass", "p.at", F.explode("p.groups").alias("g")).select("*", "g.*").drop("g")
        part = written(sent.groupBy("pass", "kind", "a", "b").applyInPandas(lambda x: verified(x, dtype, cosine, window), "id long, other long, links long"), "found")
        found = part if found is None else found.unionAll(part)
    assert found is not None
    drop_written(laid)
    return found


def near_duplicates(vectors: DataFrame, vec_id: str = "vec_id", embedding: str = "embedding", cosine: float = COSINE, window: int = WINDOW, reach: float = REACH, seed: int = SEED, block: int = BLOCK, tile: int = TILE) -> DataFrame:
    """(vec_id, n_links, component_id, kept): one row per vector.

    Exact copies are one class and are never paired with each other: each links with the rest of its class and with
    every member of linked classes. Vectors of different lengths never link. Null vectors, zero vectors and those with
    null or non-finite components link with nothing. Repeated rows count as copies; rows that share an id keep links of
    their own; an empty table gives an empty one; other columns, labels included, are ignored.
    """
    rows = vectors.select(id_or_none(vec_id).alias("vec_id"), F.col(embedding).alias("vector"))
    rows = rows.withColumn("vector", F.when(usable(F.col("vector")), F.col("vector"))).withColumn("hash", F.xxhash64("vector"))
    equal = rows.where("vector is not null").groupBy("hash", "vector").agg(F.min("vec_id").alias("least"), F.count(F.lit(1)).alias("copies"))
    classes = written(equal.select(F.monotonically_increasing_id().alias("id"), "*"), "classes")
    found = class_links(classes, cosine, window, reach, seed, block, tile)
    links = found.groupBy("id").agg(F.sum("links").alias("links"))
    roots = components(found.select(F.col("id").alias("a"), F.col("other").alias("b")))
    rooted = written(classes.join(links, "id", "left").join(roots, "id", "left").select("hash", "vector", "least", (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("root", "id").alias("root")), "rooted")
    drop_written(classes)
    named = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    known = rooted.join(named, "root").select(F.col("hash").alias("class_hash"), F.col("vector").alias("class_vector"), "n_links", "component_id")
    out = rows.join(known, (rows.hash == known.class_hash) & (rows.vector == known.class_vector), "left")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"), F.coalesce("component_id", "vec_id").alias("component_id"))
    # A null id counts as the smallest inside; as a name of a component it is null again.
    out = out.withColumn("kept", F.col("vec_id") == F.col("component_id"))
    return out.select(known_id("vec_id").alias("vec_id"), "n_links", known_id("component_id").alias("component_id"), "kept")
