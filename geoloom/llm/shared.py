"""What several operators use: words, tables in the shared folder, connected components."""

from __future__ import annotations

import atexit
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

SPACE = " \t\n\x0b\f\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
WORD = r"[^\x20\x09-\x0D]+"
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


#: Stands for a null id inside operators, where Arrow batches would turn ids with nulls into floating point.
NO_ID = -(2**63)


def id_or_none(column: str) -> Column:
    """An id as a long, null as NO_ID."""
    return F.coalesce(F.col(column).cast("long"), F.lit(NO_ID))


def known_id(column: str | Column) -> Column:
    """An id, NO_ID as null again."""
    c = F.col(column) if isinstance(column, str) else column
    return F.when(c != NO_ID, c)


def text_of(column: str | Column) -> Column:
    """The text, null as empty."""
    return F.coalesce(F.col(column) if isinstance(column, str) else column, F.lit(""))


def words(text: Column) -> Column:
    """Words `[^\\x20\\x09-\\x0D]+` of a text as an array; null and blank texts have none."""
    body = F.btrim(F.coalesce(text, F.lit("")), F.lit(SPACE))
    return F.when(body == "", F.array().cast("array<string>")).otherwise(F.split(body, SPACE_RUN))


#: Tables and archives written in this process and not removed yet, by path.
REMAINING: dict[str, SparkSession] = {}


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir. Unset, a local session gets a new local one;
    on a cluster executors wouldn't see that, so there it is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir isn't set: it has to name a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="geoloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def new_folder(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing uses yet; what is still there goes when the driver ends."""
    path = f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"
    REMAINING[path] = spark
    return path


def remove(spark: SparkSession, path: str) -> None:
    """Remove a folder that nothing reads any more."""
    REMAINING.pop(path, None)
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


@atexit.register
def remove_remaining() -> None:
    """Results are lazy, so the last tables of a query have to outlive it; they go with the driver, if its session is up."""
    for path, spark in list(REMAINING.items()):
        if spark.sparkContext._jsc is None:
            return
        remove(spark, path)


def written(frame: DataFrame, name: str) -> DataFrame:
    """The frame as a table in the shared folder: lineage ends here, and a lost executor loses nothing.

    The write's own shuffle files are of no use once it is done and are removed then, not when the driver next happens
    to collect its garbage.
    """
    spark = frame.sparkSession
    path = new_folder(spark, name)
    before = spark.conf.get(CLEANUP, "false")
    spark.conf.set(CLEANUP, "true")
    try:
        frame.write.option("compression", "zstd").parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    table = spark.read.schema(frame.schema).parquet(path)
    table._written_at = path
    return table


def drop_written(frame: DataFrame) -> None:
    """Remove a table made by written() that nothing reads any more."""
    path = getattr(frame, "_written_at", None)
    if path:
        remove(frame.sparkSession, path)


def hash_sample(frame: DataFrame, column: str, rows: int, total: int) -> DataFrame:
    """About `rows` of `total` rows, those with the least hashes of a column: for fitting bounds only.

    A condition on each row, so that what reaches the driver is the sample itself, however many partitions there are.
    """
    steps = 1 << 30
    return frame.where(F.pmod(F.xxhash64(column), F.lit(steps)) < min(steps, max(1, steps * rows // max(1, total))))


def components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """Smallest id reachable from each end of undirected edges (a long, b long) -> (id long, root long).

    Alternating large-star and small-star rounds (Kiveris et al., "Connected Components in MapReduce and Beyond",
    2014): each round links every node to the least node around it, until a round changes nothing. Each round's edges
    are a table in the shared folder. Self loops and nulls are dropped; ids without another end aren't returned.
    """
    now = edges.where("a is not null and b is not null and a <> b")
    now = written(now.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    before = None
    for _ in range(most_rounds):
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), F.least("a", "m").alias("m"))
        large = both.join(least, both.a == least.n).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.where("a <> b").distinct()
        root = large.groupBy("a").agg(F.min("b").alias("m")).select(F.col("a").alias("n"), "m")
        small = large.join(root, large.a == root.n).select(F.explode(F.array(F.struct(F.col("a").alias("a"), F.col("m").alias("b")), F.struct(F.col("b").alias("a"), F.col("m").alias("b")))).alias("e")).select("e.*")
        after = written(small.where("a <> b").distinct(), "edges")
        state = after.agg(F.count(F.lit(1)), F.bit_xor(F.xxhash64("a", "b"))).first()
        drop_written(now)
        now = after
        if state == before:
            return now.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("id"), "root").unionAll(now.select(F.col("b").alias("id"), F.col("b").alias("root")).distinct())
        before = state
    raise RuntimeError(f"components: not settled after {most_rounds} rounds")
