"""Readers and writers: globbed and headerless scans, schema enforcement, partitioned writes, upserts, backfills."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterable, Sequence
from datetime import date, timedelta

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def scan(spark: SparkSession, path: str, pattern: str = "*.parquet") -> DataFrame:
    """All Parquet files under a folder whose names match, at any depth; columns of later files are merged in."""
    return spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", pattern).option("mergeSchema", "true").parquet(path)


def read_trade_dump(spark: SparkSession, path: str) -> DataFrame:
    """Headerless CSV trades: a stray header row is dropped, epoch microseconds become milliseconds."""
    schema = "trade_id string, price string, quantity string, quote_quantity string, trade_time string, is_buyer_maker string, is_best_match string"
    raw = spark.read.schema(schema).csv(path).where(F.col("trade_id").try_cast("long").isNotNull())
    t = F.col("trade_time").try_cast("double")
    ms = F.when(t > 1e14, t / 1000).otherwise(t).cast("long")
    return raw.select(
        F.col("trade_id").try_cast("long").alias("trade_id"), *[F.col(c).try_cast("double").alias(c) for c in ("price", "quantity", "quote_quantity")], ms.alias("trade_time"), F.timestamp_millis(ms).alias("trade_ts"),
        F.lower("is_buyer_maker").isin("true", "1").alias("is_buyer_maker"), F.lower("is_best_match").isin("true", "1").alias("is_best_match"),
    )


def enforce(df: DataFrame, schema: T.StructType, ints_default: int | None = 0) -> DataFrame:
    """The declared columns in their order: missing ones null, values cast, whole numbers that don't fit ``ints_default``."""
    out = []
    for f in schema:
        x = F.col(f.name).try_cast(f.dataType) if f.name in df.columns else F.lit(None).cast(f.dataType)
        if ints_default is not None and isinstance(f.dataType, (T.IntegerType, T.LongType)):
            x = F.coalesce(x, F.lit(ints_default).cast(f.dataType))
        out.append(x.alias(f.name))
    return df.select(*out)


_WIDER = {"tinyint": "bigint", "smallint": "bigint", "int": "bigint", "float": "double"}


def widen(df: DataFrame) -> DataFrame:
    """Lake types: whole numbers long, floats double, decimals (38, 18), nested and unknown types text."""

    def kind(t: str) -> str | None:
        if t.startswith("decimal"):
            return "decimal(38,18)"
        return "string" if t.startswith(("map", "void")) else _WIDER.get(t)

    return df.withColumns({c: F.col(c).cast(k) for c, t in df.dtypes if (k := kind(t))})


def align(df: DataFrame, target: T.StructType) -> tuple[DataFrame, DataFrame]:
    """(rows in the target's schema, count by column of values that didn't fit and became null)."""
    shaped = enforce(df, target, None)
    lost = [F.count_if(F.col(f.name).isNotNull() & F.col(f.name).try_cast(f.dataType).isNull()).alias(f.name) for f in target if f.name in df.columns]
    return shaped, df.agg(*lost)


def append_new_columns(table: DataFrame, batch: DataFrame) -> DataFrame:
    """Rows of both; columns that either lacks are null."""
    return table.unionByName(batch, allowMissingColumns=True)


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], mode: str = "append") -> None:
    """Hive-partitioned Parquet; a missing partition column is an error before anything is written."""
    missing = [c for c in by if c not in df.columns]
    if missing:
        raise ValueError(f"partition columns not in the data: {missing}")
    df.write.mode(mode).option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)


def write_single(df: DataFrame, path: str) -> None:
    """One snappy file: for small exports."""
    df.coalesce(1).write.mode("overwrite").option("compression", "snappy").parquet(path)


def exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).schema  # noqa: B018
    except AnalysisException:
        return False
    return True


def merge_upsert(path: str, batch: DataFrame, keys: Sequence[str], partition: str | None = None) -> None:
    """Rows of ``batch`` replace stored rows of equal keys; others are added.

    Parquet has no row updates, so what the batch touches is written anew, first beside the table under a name of its
    own: a job that fails until then leaves the table as it was. Without a partition column the new folder then takes
    the old one's place (two renames: on a file system that isn't atomic in them, readers may miss the table between).
    With one, Spark's dynamic overwrite replaces the touched partitions when it commits; keys must not move between
    partitions. One writer at a time: of two at once one may lose its rows.
    """
    spark = batch.sparkSession
    if not exists(spark, path):
        writer = batch.write
        (writer.partitionBy(partition) if partition else writer).parquet(path)
        return
    stored = spark.read.parquet(path)
    if partition:
        touched = [r[0] for r in batch.select(partition).distinct().collect()]  # partitions of one batch
        stored = stored.where(F.col(partition).isin(touched))
    merged = stored.join(batch.select(*keys).distinct(), list(keys), "left_anti").unionByName(batch, allowMissingColumns=True)
    base, own = path.rstrip("/"), uuid.uuid4().hex
    fresh = f"{base}__new_{own}"
    merged.write.parquet(fresh)
    hadoop = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = hadoop(base).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    if partition:
        spark.read.parquet(fresh).write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition).parquet(path)
        fs.delete(hadoop(fresh), True)
        return
    old = hadoop(f"{base}__old_{own}")
    if not fs.rename(hadoop(base), old):
        raise OSError(f"{path} can't be moved aside; the new rows are in {fresh}")
    if not fs.rename(hadoop(fresh), hadoop(base)):
        fs.rename(old, hadoop(base))
        raise OSError(f"{fresh} can't be moved to {path}, which is as it was")
    fs.delete(old, True)


def lookback_bound(spark: SparkSession, path: str, ts: str, days: int):
    """The stored maximum less ``days`` as a literal, so that scans prune by it; null for a new table."""
    if not exists(spark, path):
        return None
    last = spark.read.parquet(path).agg(F.max(ts).alias("m")).first()["m"]
    return last - timedelta(days=days) if last is not None else None


def since(df: DataFrame, ts: str, bound) -> DataFrame:
    return df if bound is None else df.where(F.col(ts) >= F.lit(bound))


def append_results(df: DataFrame, path: str, required: Sequence[str], not_null: Sequence[str] = ()) -> None:
    """Append after checks: required columns there, none of ``not_null`` null; *_ts and *_at are times."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"columns missing: {missing}")
    df = df.withColumns({c: F.col(c).try_cast("timestamp") for c, t in df.dtypes if c.endswith(("_ts", "_at")) and t == "string"})
    if not_null:
        counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in not_null]).first().asDict()
        if bad := {c: n for c, n in counts.items() if n}:
            raise ValueError(f"nulls in required columns: {bad}")
    df.write.mode("append").parquet(path)


def backfill(days: Iterable[date], read: Callable[[date, date], DataFrame], build: Callable[[DataFrame], DataFrame], path: str, day_col: str, context_days: int = 3) -> None:
    """A day at a time: build from the day and those before it, overwrite the day's partition alone. Reruns agree."""
    for day in days:
        out = build(read(day - timedelta(days=context_days), day)).where(F.col(day_col) == F.lit(day))
        write_partitioned(out, path, [day_col], "overwrite")


def normalise_bars(df: DataFrame) -> DataFrame:
    """Daily bars: adjusted close defaults to close, volume to 0; times floored to the second; one row a symbol and day."""
    ts = F.date_trunc("second", "bar_ts")
    out = df.where("close is not null").withColumns({"adj_close": F.coalesce("adj_close", "close"), "volume": F.coalesce(F.col("volume").cast("double"), F.lit(0.0)), "bar_ts": ts})
    out = out.withColumns({"epoch": F.unix_timestamp(F.col("bar_ts").cast("timestamp")), "price_date": F.to_date("bar_ts"), "year": F.year("bar_ts"), "month": F.month("bar_ts")})
    from tapeloom.operators.dedupe import keep_latest

    return keep_latest(out, ["symbol", "price_date"], [F.col("bar_ts"), F.col("close")])
