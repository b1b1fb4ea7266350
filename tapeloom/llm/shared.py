"""Shared folder, cut lineage and distributed prefix sums for the text operators."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: What separates words: everything but space and the controls U+0009 to U+000D is part of a word.
WORD = r"[^\x20\x09-\x0D]+"


#: Used where spark.checkpoint.dir is unset and driver and executors are one process.
LOCAL_DIR = "/tmp/checkpoints"
#: Tables that ``cut`` has written in this process.
_written: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: spark.checkpoint.dir.

    Where it is unset, a local run takes LOCAL_DIR. A cluster has no such folder, so there it is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if found:
        return found.rstrip("/")
    master = spark.sparkContext.master
    if master == "local" or master.startswith("local["):
        return LOCAL_DIR
    raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")


def cut(df: DataFrame) -> DataFrame:
    """Write ``df`` as a Parquet table in the shared folder and read it back.

    The table outlives executors, so what is built on it restarts from files, not from the first scan. It stays
    until ``clear`` is called, as results are lazy and read it.
    """
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/tapeloom-{uuid.uuid4().hex}"
    df.write.parquet(path)
    _written.append(path)
    return spark.read.schema(df.schema).parquet(path)


def clear(spark: SparkSession) -> int:
    """Delete the tables that ``cut`` has written; how many. For when all results built on them are written."""
    jvm, n = spark.sparkContext._jvm, 0
    while _written:
        path = jvm.org.apache.hadoop.fs.Path(_written.pop())
        n += path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
    return n


def own_name(wanted: str, *frames: DataFrame) -> str:
    """``wanted``, with as many underscores after it as keep it from any column of the frames, case ignored."""
    taken = {c.lower() for f in frames for c in f.columns}
    while wanted.lower() in taken:
        wanted += "_"
    return wanted


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def prefix_sums(df: DataFrame, group: list[str], order: list[Column], value: str) -> DataFrame:
    """Running totals over all rows of each group, without one task per group.

    Adds ``rank`` (0-based place in the group), ``before`` (sum of ``value`` ahead of the row), and the
    group's ``group_rows`` and ``group_sum``. Rows are range-partitioned by group and order, each partition
    sums its own part, and the per-partition totals (one row for each partition and group that meet) give
    the offsets. A group of any size spreads over as many partitions as its share of the rows asks for.

    ``order`` must make rows that differ in the output comparable; rows equal in it are interchangeable.
    The frame is narrow by contract: it is written once to the shared folder.
    """
    n = shuffle_partitions(df.sparkSession)
    keys = [F.col(c) for c in group]
    ranged = df.withColumn("_tie", F.monotonically_increasing_id())
    parted = cut(ranged.repartitionByRange(n, *keys, *order, F.col("_tie")).withColumn("_pid", F.spark_partition_id()))
    totals = parted.groupBy("_pid", *group).agg(F.sum(value).alias("_sum"), F.count(F.lit(1)).alias("_rows"))
    over = Window.partitionBy(*group) if group else Window.partitionBy()
    ahead = over.orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        F.col("_pid").alias("_opid"),
        *(F.col(c).alias(f"_o_{c}") for c in group),
        F.coalesce(F.sum("_sum").over(ahead), F.lit(0)).alias("_off_sum"),
        F.coalesce(F.sum("_rows").over(ahead), F.lit(0)).alias("_off_rows"),
        F.sum("_sum").over(over).alias("group_sum"),
        F.sum("_rows").over(over).alias("group_rows"),
    )
    own = Window.partitionBy("_pid", *group).orderBy(*order, "_tie")
    same = [F.col("_pid") == F.col("_opid"), *(F.col(c).eqNullSafe(F.col(f"_o_{c}")) for c in group)]
    running = parted.withColumn("_n", F.row_number().over(own)).withColumn(
        "_run", F.sum(value).over(own.rowsBetween(Window.unboundedPreceding, 0))
    )
    # one row for each pair of partition and group: its size follows the number of partitions, not of rows
    joined = running.join(F.broadcast(offsets), on=_all(same), how="inner")
    drop = ["_tie", "_pid", "_opid", "_n", "_run", "_off_sum", "_off_rows", *(f"_o_{c}" for c in group)]
    return (
        joined.withColumn("rank", F.col("_off_rows") + F.col("_n") - 1)
        .withColumn("before", F.col("_off_sum") + F.col("_run") - F.col(value))
        .drop(*drop)
    )


def _all(conditions: list[Column]) -> Column:
    out = conditions[0]
    for c in conditions[1:]:
        out = out & c
    return out
