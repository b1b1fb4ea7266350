"""As-of, interval and coverage joins as plans that scale."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str, tie: Sequence[str], values: Sequence[str], tolerance: str | None = None) -> DataFrame:
    """Each left row with the latest right row of its keys at or before its time; unmatched rows stay with nulls.

    Both sides are stacked and one window carries the last right row forward: one shuffle on the keys and a sort,
    where a range join would make every pair. Right rows older than the tolerance (an interval) are dropped.
    ``tie`` orders right rows of one time. Without keys (few rows only) the window is one partition.
    """
    payload = F.struct(F.col(right_ts).alias("_at"), *values)
    row = F.struct(*left.columns)
    blank = F.lit(None)
    l_side = left.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(left_ts).alias("_t"), F.lit(1).alias("_side"), *[blank.cast("string").alias(f"_tie{i}") for i in range(len(tie))], row.alias("_left"), blank.cast(right.select(payload.alias("p")).schema["p"].dataType).alias("_right"))
    r_side = right.where(F.col(right_ts).isNotNull()).select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)], F.col(right_ts).alias("_t"), F.lit(0).alias("_side"), *[F.col(c).cast("string").alias(f"_tie{i}") for i, c in enumerate(tie)], blank.cast(left.select(row.alias("p")).schema["p"].dataType).alias("_left"), payload.alias("_right"))
    w = Window.partitionBy(*[f"_k{i}" for i in range(len(keys))]).orderBy("_t", "_side", *[f"_tie{i}" for i in range(len(tie))]).rowsBetween(Window.unboundedPreceding, 0)
    both = l_side.unionByName(r_side).withColumn("_right", F.last("_right", ignorenulls=True).over(w)).where("_side = 1")
    fresh = F.col("_right._at") >= F.col("_t") - F.expr(f"interval {tolerance}") if tolerance else F.lit(True)
    return both.select("_left.*", F.when(fresh, F.col("_right._at")).alias(right_ts), *[F.when(fresh, F.col(f"_right.{v}")).alias(v) for v in values])


def _epoch(ts: str | Column) -> Column:
    return F.unix_micros((F.col(ts) if isinstance(ts, str) else ts).cast("timestamp"))


def interval_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str, low: int, high: int, how: str = "inner") -> DataFrame:
    """Pairs with right_ts in [left_ts + low, left_ts + high] seconds and equal keys (right's are dropped).

    Time is cut into buckets as long as the interval. A left row is in the bucket where its interval begins; a right
    row is looked for from its own bucket and from the one before: an equi-join, no range join. Each pair meets once,
    so ``how`` may be inner or left. Rows of null keys or times match nothing. Column names other than the keys must differ.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    size = max(1, high - low) * 1_000_000
    bucket = F.floor(_epoch(right_ts) / size)
    side = right.select(*[F.col(k).alias(f"_r_{k}") for k in keys], *[c for c in right.columns if c not in keys]).withColumn("_r_bucket", F.explode(F.array(bucket, bucket - 1)))
    spread = left.withColumn("_bucket", F.floor((_epoch(left_ts) + low * 1_000_000) / size))
    on = (F.col("_bucket") == F.col("_r_bucket")) & (_epoch(right_ts) >= _epoch(left_ts) + low * 1_000_000) & (_epoch(right_ts) <= _epoch(left_ts) + high * 1_000_000)
    for k in keys:
        on = on & (F.col(k) == F.col(f"_r_{k}"))
    return spread.join(side, on, how).drop("_bucket", "_r_bucket", *[f"_r_{k}" for k in keys])


def point_in_interval(points: DataFrame, spans: DataFrame, keys: Sequence[str], at: str, start: str, end: str, bucket: str = "minute") -> DataFrame:
    """Points with the spans [start, end] that hold them: an equi-join on the buckets (a unit of ``date_trunc``) that a span touches.

    Spans may be of any length; a row is made for each bucket of a span, so buckets should be about as long as spans are.
    """
    side = spans.where(F.col(start) <= F.col(end)).select(*[F.col(k).alias(f"_s_{k}") for k in keys], *[c for c in spans.columns if c not in keys])
    side = side.withColumn("_b", F.explode(F.sequence(F.date_trunc(bucket, start), F.date_trunc(bucket, end), F.expr(f"interval 1 {bucket}"))))
    on = (F.date_trunc(bucket, at) == F.col("_b")) & F.col(at).between(F.col(start), F.col(end))
    for k in keys:
        on = on & (F.col(k) == F.col(f"_s_{k}"))
    return points.join(side, on).drop("_b", *[f"_s_{k}" for k in keys])


def join_with_fallback(left: DataFrame, first: DataFrame, second: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Left rows with the attributes of a dimension, each taken from ``second`` where ``first`` has no row or no value.

    Both are dimensions with one row a key and the same columns; Spark broadcasts them if their size allows.
    """
    values = [c for c in first.columns if c not in keys]
    of = lambda df, tag: df.select(*keys, *[F.col(c).alias(f"{tag}_{c}") for c in values])
    both = left.join(of(first, "_a"), list(keys), "left").join(of(second, "_b"), list(keys), "left")
    return both.select(*left.columns, *[F.coalesce(f"_a_{c}", f"_b_{c}").alias(c) for c in values])


def full_outer(left: DataFrame, right: DataFrame, keys: Sequence[str], left_flag: str, right_flag: str) -> DataFrame:
    """Full outer join with single key columns and flags of presence."""
    both = left.withColumn(left_flag, F.lit(True)).join(right.withColumn(right_flag, F.lit(True)), list(keys), "full_outer")
    return both.withColumns({c: F.coalesce(F.col(c), F.lit(False)) for c in (left_flag, right_flag)})


def missing_columns(df: DataFrame, expected: Sequence[str]) -> DataFrame:
    """The expected columns that a table lacks, a row each."""
    have = set(df.columns)
    return df.sparkSession.createDataFrame([(c,) for c in sorted(set(expected) - have)], "column_name string")


def relationship_violations(child: DataFrame, parent: DataFrame, key: str, parent_key: str) -> DataFrame:
    """Child keys that no parent has."""
    return child.select(F.col(key).alias("missing_key")).where("missing_key is not null").distinct().join(parent.select(F.col(parent_key).alias("missing_key")), "missing_key", "left_anti")
