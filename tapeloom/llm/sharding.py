"""Contiguous shards of near-equal bytes from global prefix sums."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tapeloom.llm.shared import prefix_sums


def shard_by_bytes(docs: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Cut the corpus, in id order, into ``shards`` contiguous runs of near-equal UTF-8 bytes.

    Every partition of the id order sums its own bytes, the totals give each partition its global offset, and
    a row belongs to the shard in which its middle byte falls, so no shard misses its target by more than one row.

    Returns doc_id, size (UTF-8 bytes + 1), text_crc32, law (``bytes``), shard, slot (place in its shard, from 0)
    and grown_shard (null under this law). Null text: size 1, checksum 0. Null ids come first. Repeated ids keep
    one row each, ordered by checksum and size. An empty table gives an empty result. Other columns are ignored.
    """
    if shards < 1:
        raise ValueError("shards must be positive")
    text = F.coalesce(F.col(text_col), F.lit(""))
    narrow = docs.select(
        F.col(id_col).alias("doc_id"),
        (F.octet_length(text).cast("long") + 1).alias("size"),
        F.crc32(text.cast("binary")).alias("text_crc32"),
    )
    order = [F.col("doc_id"), F.col("text_crc32"), F.col("size")]
    ranked = prefix_sums(narrow, [], order, "size")
    # decimals: (2 * before + size) * shards leaves 64 bits on large corpora
    middle = (F.col("before").cast("decimal(20,0)") * 2 + F.col("size")).cast("decimal(24,0)")
    placed = ranked.withColumn(
        "shard",
        F.floor((middle * F.lit(shards).cast("decimal(9,0)")) / (F.col("group_sum").cast("decimal(20,0)") * 2)).cast("int"),
    ).withColumn("shard", F.least(F.col("shard"), F.lit(shards - 1)))
    starts = placed.groupBy(F.col("shard").alias("_shard")).agg(F.min("rank").alias("_first"))  # a row for each shard
    return placed.join(F.broadcast(starts), F.col("shard") == F.col("_shard")).select(
        "doc_id",
        "size",
        "text_crc32",
        F.lit("bytes").alias("law"),
        "shard",
        (F.col("rank") - F.col("_first")).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
