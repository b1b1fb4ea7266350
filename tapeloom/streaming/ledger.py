"""Sinks whose written data carry the micro-batch's id, so that a replayed batch is known.

A table is a log: a folder a batch (``batch=3``), each written as a whole. A batch that a killed query had written but
not committed comes again under its id; what is already complete is left, what isn't is written anew. A keyed table is
the latest row a key over the log; ``compact`` folds batches into a base, whose name says up to which batch it goes.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.operators.dedupe import keep_latest


def _fs(spark: SparkSession, path: str):
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    return hadoop(path).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), hadoop


def _complete(spark: SparkSession, path: str, kind: str) -> list[int]:
    """Ids of the folders of a kind that a job has finished, in order: one listing, no data."""
    fs, hadoop = _fs(spark, path)
    found = fs.globStatus(hadoop(f"{path}/{kind}=*/_SUCCESS")) or []
    return sorted(int(s.getPath().getParent().getName().split("=")[1]) for s in found)


def append_once(path: str) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: each batch is a folder; one that is complete, or that the base holds, is skipped."""

    def write(batch: DataFrame, n: int) -> None:
        spark = batch.sparkSession
        base = _complete(spark, path, "base")
        if n in _complete(spark, path, "batch") or (base and n <= base[-1]):
            return
        batch.write.mode("overwrite").parquet(f"{path}/batch={n}")

    return write


def _parts(spark: SparkSession, path: str) -> tuple[list[int], list[int]]:
    base = _complete(spark, path, "base")[-1:]
    return base, [n for n in _complete(spark, path, "batch") if not base or n > base[0]]


def read_log(spark: SparkSession, path: str) -> DataFrame:
    """All rows of complete batches after the base, and of the base, with ``batch`` (the base's is its last)."""
    base, batches = _parts(spark, path)
    folders = [*(f"{path}/base={n}" for n in base), *(f"{path}/batch={n}" for n in batches)]
    if not folders:
        raise ValueError(f"nothing has been written to {path}")
    number = F.coalesce(*(F.nullif(F.regexp_extract(F.input_file_name(), f"{k}=([0-9]+)/", 1), F.lit("")) for k in ("batch", "base")))
    return spark.read.option("mergeSchema", "true").parquet(*folders).withColumn("batch", number.cast("long"))


def current(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """The last row of each key by ``order``, then by batch; a sink that upserts is this view of the log."""
    return keep_latest(read_log(spark, path), list(keys), [*(F.col(c) for c in order), F.col("batch")]).drop("batch")


def compact(spark: SparkSession, path: str, keys: Sequence[str], order: Sequence[str]) -> None:
    """Writes the current rows as a new base and then deletes what it replaces.

    Readers take the newest complete base and the batches after it, so they see either all of the old or the new
    form. A compaction that dies leaves the old form whole. One compaction at a time; batches may come meanwhile.
    """
    base, batches = _parts(spark, path)
    if not batches:
        return
    current(spark, path, keys, order).write.mode("overwrite").parquet(f"{path}/base={batches[-1]}")
    fs, hadoop = _fs(spark, path)
    for old in [*(f"base={n}" for n in base), *(f"batch={n}" for n in batches)]:
        fs.delete(hadoop(f"{path}/{old}"), True)
