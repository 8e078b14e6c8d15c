"""SimHash near-duplicates by similarity: documents whose word shingles have a Jaccard of 0.8 or more.

A pair at 0.8 differs in some ten of the 64 bits of its fingerprints; at such a radius no branch of a vantage-point tree
can be pruned, since unrelated fingerprints differ in 32 bits, give or take 4. So the tree links what lies within
TREE_BITS, most of what copies are in practice, and bands of minima over the same shingle hashes bring together
what lies further apart. Both only propose: every link is a pair whose exact Jaccard was checked.

Documents with equal words are one class, and one row each goes on. Classes that the tree links, or that share a band,
meet in a bucket. First each member is checked against the least of all its buckets, then, where they are still apart,
against the least of each. So a large group costs one pair a member. Buckets whose members aren't all linked then are
compared whole, so that no pair of a bucket goes unchecked: as sets in one task, beyond TILE members in pairs of tiles,
of which those that hold one linked group alone are left out. Tasks give links, never pairs.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from geoloom.llm.shared import components, drop_written, written
from geoloom.llm.simhash import Forest, fingerprint_roots, folded, shingle_hashes, words_of

#: Words of a shingle, and the least similarity of a linked pair as a fraction.
SHINGLE, SHARE = 5, (4, 5)
#: Radius of the tree.
TREE_BITS = 3
#: A pair at 0.8 shares one of 24 bands of 4 minima but for 3 in a million: (1 - 0.8 ** 4) ** 24.
BANDS, ROWS, SEED = 24, 4, 42
#: Members of a tile at most, shingles of its members on average, and at least members whatever their size.
TILE, TILE_SHINGLES, LEAST_TILE = 1000, 1_000_000, 16
FACTORS, TERMS = np.random.default_rng(SEED).integers(0, 2**64, (2, BANDS * ROWS), dtype=np.uint64) | np.array([[1], [0]], np.uint64)


def digest(body: bytes) -> tuple[int, int]:
    """128 bits of a body as two signed longs."""
    value = xxhash.xxh3_128_digest(body)
    return int.from_bytes(value[:8], "big", signed=True), int.from_bytes(value[8:], "big", signed=True)


def band_keys(hashes: np.ndarray) -> list[int]:
    """A signed long per band: equal for sets whose minima under the band's functions are equal."""
    if not len(hashes):
        return []
    least = np.full(BANDS * ROWS, np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 2048):
        least = np.minimum(least, (hashes[None, at : at + 2048] * FACTORS[:, None] + TERMS[:, None]).min(axis=1))
    data = least.astype("<u8").tobytes()
    step = 8 * ROWS
    return np.array([xxhash.xxh3_64_intdigest(data[i * step : (i + 1) * step], i) for i in range(BANDS)], np.uint64).view(np.int64).tolist()


def signed(batches: Iterator[pd.DataFrame], shingle: int) -> Iterator[pd.DataFrame]:
    """(doc_id, c1, c2, n, fp, keys) of each (doc_id, text): digest of the words, number of shingles, fingerprint, bands."""
    for docs in batches:
        rows = []
        for i, text in zip(docs["doc_id"].tolist(), docs["text"], strict=True):
            tokens, body = words_of(text if isinstance(text, str) else None)
            hashes = shingle_hashes(tokens, body, shingle, SEED)
            distinct = np.unique(hashes)
            fp = int(np.uint64(folded(hashes)).astype(np.int64))
            rows.append((i, *digest(body), len(distinct), fp, band_keys(distinct)))
        yield pd.DataFrame(rows, columns=["doc_id", "c1", "c2", "n", "fp", "keys"])


def packed(batches: Iterator[pd.DataFrame], shingle: int) -> Iterator[pd.DataFrame]:
    """(id, hashes) of each (doc_id, text, d1, d2) whose words have that digest."""
    for docs in batches:
        rows = []
        for r in docs.itertuples(index=False):
            tokens, body = words_of(r.text if isinstance(r.text, str) else None)
            if digest(body) == (r.d1, r.d2):
                rows.append((r.doc_id, np.unique(shingle_hashes(tokens, body, shingle, SEED)).astype("<u8").tobytes()))
        yield pd.DataFrame(rows, columns=["id", "hashes"])


def alike(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """The pairs (a, b) of (a, b, x, y) whose sets have the similarity."""
    for pairs in batches:
        keep = []
        for x, y in zip(pairs["x"], pairs["y"], strict=True):
            one, two = np.frombuffer(bytes(x), "<u8"), np.frombuffer(bytes(y), "<u8")
            both = len(np.intersect1d(one, two, assume_unique=True))
            keep.append(both * SHARE[1] >= (len(one) + len(two) - both) * SHARE[0])
        yield pairs.loc[np.array(keep, bool), ["a", "b"]]


def checked(pairs: DataFrame, sets: DataFrame) -> DataFrame:
    """The pairs (a, b) that have the similarity, from (id, hashes)."""
    left = sets.select(F.col("id").alias("a"), F.col("hashes").alias("x"))
    right = sets.select(F.col("id").alias("b"), F.col("hashes").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInPandas(alike, "a long, b long")


def overlaps(sets: list[np.ndarray]) -> np.ndarray:
    """Numbers of elements that each two sets share; what only one set has takes no part."""
    values, inverse, often = np.unique(np.concatenate(sets), return_inverse=True, return_counts=True)
    owners = np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    column = np.cumsum(often > 1) - 1
    keep = often[inverse] > 1
    owners, columns = owners[keep], column[inverse[keep]]
    order = np.argsort(columns, kind="stable")
    owners, columns = owners[order], columns[order]
    both = np.zeros((len(sets), len(sets)), np.float64)
    for at in range(0, int((often > 1).sum()), 4096):
        low, high = np.searchsorted(columns, (at, at + 4096))
        part = np.zeros((len(sets), 4096), np.float32)
        part[owners[low:high], columns[low:high] - at] = 1
        both += part @ part.T
    return both


def tile_links(group: pd.DataFrame) -> pd.DataFrame:
    """Links (a, b) that join what is still apart in one tile, or between two tiles, of a bucket."""
    ids, roots, home = group["id"].to_numpy(), group["root"].to_numpy(), group["home"].to_numpy()
    sets = [np.frombuffer(bytes(x), "<u8") for x in group["hashes"]]
    sizes = np.array([len(x) for x in sets])
    both = overlaps(sets)
    x, y = np.nonzero(both * SHARE[1] >= (sizes[:, None] + sizes[None, :] - both) * SHARE[0])
    across = home[x] != home[y] if group["a"].iloc[0] != group["b"].iloc[0] else np.ones(len(x), bool)
    keep = (x < y) & (roots[x] != roots[y]) & across
    forest, names = Forest(len(ids)), np.unique(roots, return_index=True)
    first = dict(zip(names[0].tolist(), names[1].tolist(), strict=True))
    for i, r in enumerate(roots.tolist()):
        forest.link(i, first[r])
    found = []
    for i, j in zip(x[keep].tolist(), y[keep].tolist(), strict=True):
        if forest.root(i) != forest.root(j):
            forest.link(i, j)
            found.append((min(ids[i], ids[j]), max(ids[i], ids[j])))
    return pd.DataFrame(found, columns=["a", "b"]).astype("int64")


def whole_buckets(members: DataFrame, sets: DataFrame, tile: int = TILE) -> DataFrame:
    """(key, id, n, root) of buckets whose members are still apart -> links (a, b) over all their pairs.

    Members of roots larger than a tile have tiles of their root, the others share tiles; two tiles of one root never
    meet. Buckets of the same members are compared once.
    """
    of_root = members.groupBy("key", "root").agg(F.count(F.lit(1)).alias("s"), F.sum("n").alias("w"), F.bit_xor(F.xxhash64("id")).alias("x"))
    total = of_root.groupBy("key").agg(F.sum("s").alias("m"), F.sum("w").alias("w"), F.bit_xor("x").alias("x"), F.count(F.lit(1)).alias("k")).where("k > 1")
    total = total.groupBy("m", "w", "x").agg(F.min("key").alias("key"))
    fit = F.greatest(F.lit(LEAST_TILE), F.least(F.lit(tile), (TILE_SHINGLES * F.col("m") / F.greatest(F.col("w"), F.lit(1))).cast("int")))
    sized = written(of_root.drop("w", "x").join(total.select(F.col("key").alias("k"), fit.alias("fit")).hint("merge"), F.col("key") == F.col("k")).drop("k"), "roots")
    pool = F.when(F.col("s") > F.col("fit"), F.col("root"))
    tiles = sized.groupBy("key", pool.alias("r")).agg(F.ceil(F.sum("s") / F.first("fit")).cast("int").alias("c"))
    # Written, so that the join below has nothing that needs a key's rows together, and a crowded bucket may be split.
    tiles = written(tiles.groupBy("key").agg(F.collect_list(F.struct("r", "c")).alias("tiles")), "tiles")
    own = members.join(sized.select(F.col("key").alias("k"), F.col("root").alias("own"), pool.alias("r"), "s", "fit").hint("merge"), (F.col("key") == F.col("k")) & (F.col("root") == F.col("own"))).drop("k", "own", "s", "fit")
    own = own.join(tiles.withColumnRenamed("key", "k").hint("merge"), F.col("key") == F.col("k")).drop("k")
    count = F.element_at(F.filter("tiles", lambda t: t["r"].eqNullSafe(F.col("r"))), 1)["c"]
    name = lambda r, i: F.concat_ws(":", F.coalesce(r.cast("string"), F.lit("")), i.cast("string"))
    other = F.flatten(F.transform(F.filter("tiles", lambda t: F.col("r").isNull() | ~t["r"].eqNullSafe(F.col("r"))), lambda t: F.transform(F.sequence(F.lit(0), t["c"] - 1), lambda i: name(t["r"], i))))
    dealt = own.withColumn("home", name(F.col("r"), F.pmod(F.xxhash64("id"), count))).withColumn("other", F.explode(other))
    dealt = dealt.select("key", "id", "root", "home", F.least("home", "other").alias("a"), F.greatest("home", "other").alias("b"))
    dealt = dealt.join(sets.select(F.col("id").alias("set_id"), "hashes").hint("merge"), F.col("id") == F.col("set_id")).drop("set_id")
    links = written(dealt.groupBy("key", "a", "b").applyInPandas(tile_links, "a long, b long").distinct(), "links")
    drop_written(sized)
    drop_written(tiles)
    return links


def bucketed(docs: DataFrame, shingle: int) -> tuple[DataFrame, DataFrame]:
    """Classes (id, n, c1, c2) of documents with equal words, and their rows (key, low, id, n) in buckets of two or more."""
    signs = written(docs.mapInPandas(lambda b: signed(b, shingle), "doc_id long, c1 long, c2 long, n long, fp long, keys array<long>"), "signs")
    classes = written(signs.groupBy("c1", "c2").agg(F.min("doc_id").alias("id"), F.first("n").alias("n"), F.first("fp").alias("fp"), F.first("keys").alias("keys")), "classes")
    drop_written(signs)
    worded = classes.where("n > 0")
    fps = written(worded.select("fp").distinct(), "fps")
    trees = fingerprint_roots(fps, TREE_BITS).withColumnRenamed("fp", "tree_fp")
    tree = worded.join(trees.hint("merge"), F.col("fp") == F.col("tree_fp")).select("id", "n", F.xxhash64(F.lit("tree"), "root").alias("key"))
    placed = written(worded.select("id", "n", F.explode("keys").alias("key")).unionAll(tree), "placed")
    drop_written(fps)
    buckets = placed.groupBy("key").agg(F.min(F.struct("id", "n")).alias("low"), F.max("id").alias("high")).where("low.id <> high")
    members = written(placed.join(buckets.select(F.col("key").alias("k"), "low").hint("merge"), F.col("key") == F.col("k")).drop("k"), "members")
    drop_written(placed)
    return classes, members


def near(n, m):
    """Whether sets of these sizes can have the similarity."""
    return SHARE[1] * F.least(n, m) >= SHARE[0] * F.greatest(n, m)


def roots(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, tile: int = TILE) -> DataFrame:
    """(least, root) of each class of documents with equal words: its smallest id and that of what is reachable from it.

    Ids may not be null. Texts without words are one class. Pairs of unlike numbers of shingles can't have the
    similarity and aren't looked at; sets are 64-bit hashes of shingles. An empty table gives an empty one.
    """
    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).alias("text"))
    classes, members = bucketed(rows, shingle)
    ids = classes.select(F.col("id").alias("w"), F.col("c1").alias("d1"), F.col("c2").alias("d2"))
    wanted = ids.join(members.select(F.col("id").alias("m")).distinct().hint("merge"), F.col("w") == F.col("m"), "left_semi")
    found = rows.join(wanted.hint("merge"), rows.doc_id == F.col("w")).select("doc_id", "text", "d1", "d2")
    sets = written(found.mapInPandas(lambda b: packed(b, shingle), "id long, hashes binary").dropDuplicates(["id", "hashes"]), "sets")

    def rooted(links: DataFrame) -> DataFrame:
        ends = components(links).withColumnRenamed("id", "e")
        joined = members.join(ends.hint("merge"), F.col("id") == F.col("e"), "left")
        return written(joined.select("key", "id", "n", "low", F.coalesce("root", "id").alias("root")), "rooted")

    stars = members.where((F.col("id") != F.col("low.id")) & near(F.col("n"), F.col("low.n")))
    links = written(checked(stars.groupBy("id").agg(F.min("low.id").alias("a")).select("a", F.col("id").alias("b")), sets), "links")
    now = rooted(links)
    lows = now.groupBy("key").agg(F.min(F.struct("id", "root")).alias("first")).select(F.col("key").alias("k"), F.col("first.root").alias("low_root"))
    apart = now.join(lows.hint("merge"), F.col("key") == F.col("k")).where((F.col("root") != F.col("low_root")) & near(F.col("n"), F.col("low.n")))
    more = written(checked(apart.select(F.col("low.id").alias("a"), F.col("id").alias("b")).distinct(), sets), "links")
    drop_written(now)
    links = links.unionAll(more)
    now = rooted(links)
    open_keys = now.groupBy("key").agg(F.min("root").alias("r0"), F.max("root").alias("r1")).where("r0 <> r1").select(F.col("key").alias("k"))
    # The least was checked against everyone; what it met is left out.
    left = written(now.where("id <> low.id").join(open_keys.hint("merge"), F.col("key") == F.col("k"), "left_semi").select("key", "id", "n", "root"), "open")
    last = whole_buckets(left, sets, tile)
    drop_written(left)
    for done in (now, sets, members):
        drop_written(done)
    ends = components(links.unionAll(last)).withColumnRenamed("id", "e")
    out = classes.select(F.col("id").alias("least")).distinct().join(ends.hint("merge"), F.col("least") == F.col("e"), "left")
    out = written(out.select("least", F.coalesce("root", "least").alias("root")), "roots")
    drop_written(classes)
    return out


def representatives(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE, tile: int = TILE) -> DataFrame:
    """One document of each near-duplicate group, that with the smallest id; columns as given.

    Rows that share an id are one document, of which one row stays; rows without an id belong to no group and all stay.
    """
    stay = roots(docs.where(F.col(doc_id).isNotNull()), doc_id, text, shingle, tile).where("least = root").select(F.col("least").alias("stay_id"))
    kept = docs.join(stay.hint("merge"), docs[doc_id] == stay["stay_id"], "left_semi").dropDuplicates([doc_id])
    return kept.unionAll(docs.where(F.col(doc_id).isNull()))
