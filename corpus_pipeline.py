"""A training corpus from raw documents: language, near-duplicates, benchmark passages, source mix, shards.

Every stage takes documents with any further columns, whatever their names, and an empty table gives an empty one.
Null and empty texts go in the first stage, as they are in no language. Of equal rows one stays after the second.
Null ids are ids of their own that come last among equals. What a stage does with ties is said at its operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.llm import decontaminate, langid, mixing, neardup, sharding
from tapeloom.llm.shared import cut


def language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents mainly in one of the languages learned from the labelled rows that aren't held out."""
    model = langid.fit(docs.where(~langid.is_held_out(F.col("doc_id"))))
    return langid.select_languages(docs, model)


def near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class."""
    return neardup.deduplicate(docs)


def benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate.decontaminate(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the target weights of their sources take them."""
    return mixing.mixed(docs)


def shards(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The shard and slot of every document."""
    return sharding.shard_by_bytes(docs)


STAGES = [("language", language), ("near_duplicates", near_duplicates), ("benchmark", benchmark), ("mix", mix), ("shards", shards)]

#: SQL can't express the language, near-duplicate and edit-distance stages.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages on the documents, each written to the shared folder before the next. ``shared.clear`` deletes these tables."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
