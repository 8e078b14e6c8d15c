"""Mixing sources to target weights: per-source repetition rates, whole copies plus one seeded draw per document."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from geoloom.llm.shared import WORD, written

WEIGHTS = (5, 2, 1)
MOST_REPEATS = 3
#: A document with over one part in HEAVY of its source's size is a heavy one.
HEAVY = 2000
SEED = "mix-1"


def word_count(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` in a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def source_targets(per_source: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS) -> DataFrame:
    """(source, source_size) -> (source, source_size, target).

    Sources in code-point order, null last, weigh `weights` in turn and share the sum of all sizes. A target stops at
    `most` times its source's size; what that leaves over is shared again by weight among the rest. Sorting sources by
    size over weight gives the one level at which nothing is above its stop, without iterating: sources are stopped
    in that order for as long as the level of the rest lies above their own. One row per source: the unpartitioned
    windows see sources, never documents.
    """
    n = len(weights)
    place = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    weight = F.element_at(F.array(*[F.lit(w).cast("long") for w in weights]), (place % n + 1).cast("int"))
    ranked = per_source.withColumn("weight", weight)
    order = Window.orderBy((F.col("source_size") / F.col("weight")).asc(), F.col("source").asc_nulls_last())
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    after = order.rowsBetween(0, Window.unboundedFollowing)
    everything = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    levels = ranked.select(
        "*",
        F.sum("source_size").over(everything).alias("total"),
        F.coalesce(F.sum(F.col("source_size") * most).over(before), F.lit(0)).alias("stopped"),
        F.sum("weight").over(after).alias("open_weight"),
    ).withColumn("level", (F.col("total") - F.col("stopped")) / F.col("open_weight"))
    fits = F.col("level") * F.col("weight") <= F.col("source_size") * most
    settled = levels.withColumn("final", F.min_by(F.when(fits, F.col("level")), F.when(fits, F.col("stopped"))).over(everything))
    cap = (F.col("source_size") * most).cast("double")
    return settled.select("source", "source_size", F.least(cap, F.coalesce(F.col("final") * F.col("weight"), cap)).alias("target"))


def draw(doc_id: Column, seed: str = SEED) -> Column:
    """A number in [0, 1) from 52 bits of the MD5 of seed and id: reruns agree on any cluster."""
    digest = F.substring(F.md5(F.concat(F.lit(seed + ":"), F.coalesce(doc_id.cast("string"), F.lit("")))), 1, 13)
    return F.conv(digest, 16, 10).cast("double") / F.lit(float(2**52))


def with_copies(docs: DataFrame, doc_id: str = "doc_id", source: str = "source", size: str = "size", weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, seed: str = SEED) -> DataFrame:
    """Add `mix` struct<source_size, target, copies> to each row.

    copies = floor(rate) plus one with probability equal to the fraction, rate = target / source size, never above
    `most`. Documents draw by the hash of their id. Those that hold over 1 / HEAVY of their source's size, of which no
    source can have more than HEAVY, draw by one hashed number per source instead, moved on by the fraction from each to
    the next smaller: the probability is the same, and large documents can't all be drawn, or none. Only they are
    shuffled; sizes are pre-aggregated per source, and the table of sources is written, so that Spark knows its size
    before it plans the join: it broadcasts it below the session's threshold, without shuffling documents first, and
    splits a hot source in a sort-merge join beyond it. Null sources are one source; empty texts take part and contribute nothing; an empty table gives an empty table. Other columns
    pass through, but for one named `mix`, which is replaced. Rows that share an id, null included, draw alike.
    """
    names = [c for c in docs.columns if c.lower() != "mix"]
    sizes = docs.groupBy(F.col(source).alias("source")).agg(F.sum(size).alias("source_size"))
    targets = written(source_targets(sizes, weights, most).select(F.struct("source", "source_size", "target").alias("target_of_source")), "targets")
    own = targets["target_of_source"]
    joined = docs.join(targets, docs[source].eqNullSafe(own["source"]))
    rate = F.when(own["source_size"] > 0, own["target"] / own["source_size"]).otherwise(F.lit(0.0))
    rated = joined.select(*[docs[c] for c in names], F.struct(own["source_size"].alias("source_size"), own["target"].alias("target"), rate.alias("rate")).alias("mix"))
    heavy = F.col(size) * HEAVY > F.col("mix.source_size")
    fraction = F.col("mix.rate") - F.floor("mix.rate")
    order = Window.partitionBy(source).orderBy(F.col(size).desc(), draw(F.col(doc_id), seed), F.col(doc_id))
    moved = draw(F.concat(F.lit("source:"), F.coalesce(F.col(source), F.lit(""))), seed) + F.row_number().over(order) * fraction

    def copied(rows: DataFrame, number: Column) -> DataFrame:
        copies = F.floor("mix.rate") + F.when(number < fraction, 1).otherwise(0)
        mix = F.struct("mix.source_size", "mix.target", F.least(copies, F.lit(most)).cast("long").alias("copies"))
        return rows.select(*names, mix.alias("mix"))

    return copied(rated.where(~F.coalesce(heavy, F.lit(False))), draw(F.col(doc_id), seed)).unionAll(copied(rated.where(heavy), moved - F.floor(moved)))


def mixed(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", source: str = "source", weights: tuple[int, ...] = WEIGHTS, most: int = MOST_REPEATS, seed: str = SEED) -> DataFrame:
    """The mix itself: each document as many times as it was drawn, columns as given."""
    sized = docs.select(F.struct("*").alias("row"), F.col(doc_id).alias("doc_id"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"))
    copied = with_copies(sized, "doc_id", "source", "size", weights, most, seed).where("mix.copies > 0")
    return copied.select("row", F.explode(F.sequence(F.lit(1).cast("long"), F.col("mix.copies"))).alias("copy")).select("row.*")
