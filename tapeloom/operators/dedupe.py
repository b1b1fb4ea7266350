"""Latest rows: of a key, of an hour, of a run."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def keep_latest(df: DataFrame, keys: Sequence[Column | str], latest: Sequence[Column]) -> DataFrame:
    """The row of each key that comes first by ``latest`` (descending columns as a rule).

    A max over a struct, not a window: partial aggregates drop old versions before the shuffle, and a hot key
    costs a row for each task. Give a unique last column to make ties definite.
    """
    named = [F.col(k) if isinstance(k, str) else k for k in keys]
    row = F.struct(*df.columns)
    order = F.struct(*[c.alias(f"k{i}") for i, c in enumerate(latest)])
    keyed = df.select(row.alias("_row"), order.alias("_order"), *[k.alias(f"_key{i}") for i, k in enumerate(named)])
    best = keyed.groupBy(*[f"_key{i}" for i in range(len(named))]).agg(F.max_by("_row", "_order").alias("_row"))
    return best.select("_row.*")


def latest_per_hour(df: DataFrame, ts: str, keys: Sequence[str], latest: Sequence[Column]) -> DataFrame:
    """The last observation of each entity within each hour; adds hour_ts."""
    hourly = df.withColumn("hour_ts", F.date_trunc("hour", ts).cast("timestamp_ntz"))
    return keep_latest(hourly, ["hour_ts", *keys], latest)


def last_of_day(df: DataFrame, ts: str, keys: Sequence[str], latest: Sequence[Column]) -> DataFrame:
    """The last snapshot of each entity and day; adds snapshot_date."""
    return keep_latest(df.withColumn("snapshot_date", F.to_date(ts)), ["snapshot_date", *keys], latest)


def flag_latest(df: DataFrame, ranks: dict[str, tuple[Sequence[str], Sequence[Column]]]) -> DataFrame:
    """Boolean columns: whether a row is the first of its keys by the order, for several rankings at once."""
    for name, (keys, order) in ranks.items():
        df = df.withColumn(name, F.row_number().over(Window.partitionBy(*keys).orderBy(*order)) == 1)
    return df


def latest_run(df: DataFrame, run: str, at: str) -> DataFrame:
    """The rows of the run that has the latest time (run id breaks ties): a semi-join on one row."""
    last = df.agg(F.max_by(run, F.struct(at, run)).alias(run))
    return df.join(F.broadcast(last), run, "left_semi")


def union_by_priority(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """All frames under each other; of rows with equal keys the one of the earliest frame stays."""
    every = None
    for i, df in enumerate(frames):
        own = df.withColumn("_priority", F.lit(i))
        every = own if every is None else every.unionByName(own, allowMissingColumns=True)
    return keep_latest(every, keys, [-F.col("_priority")]).drop("_priority")
