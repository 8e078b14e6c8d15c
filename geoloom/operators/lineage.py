"""Cutting lineage where a plan must not be evaluated anew."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession


def shared_folder(spark: SparkSession) -> str:
    """The folder that spark.checkpoint.dir names. Unset, a local session gets a new local one; on a cluster that is an error."""
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("spark.checkpoint.dir isn't set: it has to name a folder that driver and executors share")
        folder = "file://" + tempfile.mkdtemp(prefix="geoloom-")
        spark.conf.set("spark.checkpoint.dir", folder)
    return folder.rstrip("/")


def through_files(spark: SparkSession, passed: Callable[[str], DataFrame]) -> DataFrame:
    """What a function that writes and reads below a new shared folder returns, kept as a checkpoint; its files are removed."""
    folder = f"{shared_folder(spark)}/files-{uuid.uuid4().hex}"
    try:
        return checkpointed(passed(folder))
    finally:
        where = spark._jvm.org.apache.hadoop.fs.Path(folder)
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def checkpointed(rows: DataFrame) -> DataFrame:
    """The rows, computed now and kept in the folder that spark.checkpoint.dir names.

    Where that is unset a local session gets a new local folder; on a cluster executors wouldn't see one, so there it is
    an error.
    """
    context = rows.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_folder(rows.sparkSession))
    return rows.checkpoint()


def forget(rows: DataFrame) -> None:
    """Remove the files of a checkpoint that nothing reads any more."""
    spark = rows.sparkSession
    plan = rows._jdf.queryExecution().logical()
    file = plan.rdd().getCheckpointFile() if plan.nodeName() == "LogicalRDD" else None
    if file is not None and file.isDefined():
        where = spark._jvm.org.apache.hadoop.fs.Path(file.get())
        where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def spread_if_small(rows: DataFrame, most_bytes: int = 64 << 20) -> DataFrame:
    """Rows dealt to as many partitions as a shuffle has, where Spark's estimate of them is small: a small table is often one
    file, whose work would be one task's. Larger ones stay where they are."""
    if int(str(rows._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())) > most_bytes:
        return rows
    return rows.repartition(max(1, int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
