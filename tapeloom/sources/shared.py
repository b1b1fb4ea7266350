"""The folder that driver and executors share."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession

#: Used where spark.checkpoint.dir is unset and driver and executors are one process.
LOCAL_DIR = "/tmp/checkpoints"


def shared_folder(spark: SparkSession, name: str) -> str:
    """A new folder's path under spark.checkpoint.dir. A local run without it takes LOCAL_DIR; on a cluster that is an error."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if not found:
        master = spark.sparkContext.master
        if not (master == "local" or master.startswith("local[")):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        found = LOCAL_DIR
    return f"{found.rstrip('/')}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder: what is built on it restarts from files, and its partitions stay as they are."""
    path = shared_folder(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
