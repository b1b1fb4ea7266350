"""The registered queries of this subpackage and their SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

import corpus_pipeline
from tapeloom.llm import alignment, decontaminate, langid, merkle, mixing, neardup, phrases, quality, repair, secrets, sharding, tokens, urls


def _docs(spark: SparkSession, sf_dir: str, table: str = "documents") -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def op1_url_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urls.judge(_docs(spark, sf_dir, "pages"), _docs(spark, sf_dir, "labels"))


def op2_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tokens.count_tokens(_docs(spark, sf_dir))


def op3_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shard_by_bytes(_docs(spark, sf_dir))


def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.digest(secrets.scan(_docs(spark, sf_dir)))


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return neardup.classes(_docs(spark, sf_dir))


def op6_merkle(spark: SparkSession, sf_dir: str) -> DataFrame:
    return merkle.fingerprint_edits(_docs(spark, sf_dir))


def op7_phrases(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrases.digest(phrases.remove(_docs(spark, sf_dir)))


def op8_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return langid.predict(_docs(spark, sf_dir)).select("doc_id", "held_out", "lang_pred", "score")


def op9_benchmark(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.search(_docs(spark, sf_dir), _docs(spark, sf_dir, "benchmark"))


def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_docs(spark, sf_dir)).drop("copies")


def op11_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.predict(_docs(spark, sf_dir), _docs(spark, sf_dir, "labels"))


def op12_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.link_counts(_docs(spark, sf_dir))


def op13_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return repair.repair(repair.damage(_docs(spark, sf_dir, "conversations")))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_url_rules": op1_url_rules,
    "op2_tokens": op2_tokens,
    "op3_shards": op3_shards,
    "op4_secrets": op4_secrets,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_merkle": op6_merkle,
    "op7_phrases": op7_phrases,
    "op8_languages": op8_languages,
    "op9_benchmark": op9_benchmark,
    "op10_mixing": op10_mixing,
    "op11_quality": op11_quality,
    "op12_alignment": op12_alignment,
    "op13_repair": op13_repair,
    "pipeline": corpus_pipeline.run,
}
