"""Chunked series equal plain windows, and one key's rows are dealt to many tasks."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tapeloom.operators import chunked, joins

START = dt.datetime(2024, 1, 1)


@pytest.fixture(scope="module")
def rows(spark):
    rng = random.Random(3)
    data = [(rng.choice(["A"] * 9 + ["B", None]), i, None if rng.random() < 0.05 else START + dt.timedelta(seconds=rng.randrange(0, 40_000), microseconds=rng.choice([0, 0, 1])), None if rng.random() < 0.3 else rng.uniform(-5, 5), rng.randrange(5)) for i in range(1500)]
    return spark.createDataFrame(data, "symbol string, id long, ts timestamp, v double, q long").repartition(5).cache()


def same(got, want):
    assert sorted(map(str, got.collect())) == sorted(map(str, want.select(got.columns).collect()))


@pytest.mark.parametrize("size", [None, 900, 5000])
def test_over_time(rows, size):
    frames = lambda w: {"m": F.avg("v").over(w), "n": F.count(F.lit(1)).over(w), "s": F.sum("q").over(w)}
    plain = rows.withColumns(frames(Window.partitionBy("symbol").orderBy(F.unix_micros("ts")).rangeBetween(-900_000_000, 0)))
    got = chunked.over_time(rows, ["symbol"], "ts", 900, frames, size)
    # means are sums in frame order, so equal to rounding of the last digit only where rows of one time tie
    digits = lambda df: df.withColumn("m", F.round("m", 9) + F.lit(0.0))
    same(digits(got), digits(plain))


def test_ranked_and_over_rows(rows):
    plain = rows.withColumn("rank", (F.row_number().over(Window.partitionBy("symbol").orderBy("ts", "id")) - 1).cast("long"))
    same(chunked.ranked(rows, ["symbol"], ["ts", "id"]).withColumn("rank", F.col("rank").cast("long")), plain)
    whole = rows.withColumn("rank", (F.row_number().over(Window.orderBy("id")) - 1).cast("long"))
    same(chunked.ranked(rows, [], ["id"]).withColumn("rank", F.col("rank").cast("long")), whole)
    frames = lambda w: {"l": F.lag("q", 4).over(w), "f": F.lead("q", 3).over(w), "s": F.sum("q").over(w.rowsBetween(-4, -1)), "m": F.avg("v").over(w.rowsBetween(-4, 3))}
    want = rows.withColumns(frames(Window.partitionBy("symbol").orderBy("ts", "id")))
    for size in (4, 50, 100_000):
        same(chunked.over_rows(rows, ["symbol"], ["ts", "id"], 4, 3, frames, size), want)


def test_carries(rows):
    dated = rows.where("ts is not null")
    w = Window.partitionBy("symbol").orderBy("ts", "id").rowsBetween(Window.unboundedPreceding, 0)
    same(chunked.fill_forward(dated, ["symbol"], ["ts", "id"], ["v"], 600), dated.withColumn("v", F.last("v", ignorenulls=True).over(w)))
    same(chunked.running_sum(dated, ["symbol"], ["ts", "id"], "q", "run", 600), dated.withColumn("run", F.sum("q").over(w)))
    same(chunked.running_sum(dated.withColumn("q", F.lit(None).cast("long")), ["symbol"], ["ts", "id"], "q", "run", 600), dated.withColumn("q", F.lit(None).cast("long")).withColumn("run", F.lit(None).cast("long")))


@pytest.mark.parametrize("tolerance", [None, "300 seconds"])
def test_asof(rows, tolerance):
    left = rows.select("symbol", "id", "ts")
    right = rows.where("q > 1").select("symbol", F.col("ts").alias("at"), "v", F.col("id").alias("rid"))
    args = (["symbol"], "ts", "at", ["rid"], ["v", "rid"], tolerance)
    same(chunked.asof_join(left, right, *args, seconds=700), joins.asof_join(left, right, *args))
    same(chunked.asof_join(left, right.limit(0), *args), joins.asof_join(left, right.limit(0), *args))


def test_one_key_is_many_tasks(spark):
    """All rows are of one symbol: chunks reach many partitions, and none holds most of the rows."""
    df = spark.range(40_000).select(F.lit("A").alias("symbol"), (F.timestamp_seconds(F.lit(1_700_000_000)) + F.make_dt_interval(secs=F.col("id"))).alias("ts"), F.col("id").cast("double").alias("v"))
    old = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for out in (chunked.over_time(df, ["symbol"], "ts", 60, lambda w: {"m": F.avg("v").over(w)}), chunked.over_rows(df, ["symbol"], ["ts"], 5, 0, lambda w: {"m": F.lag("v", 5).over(w)}, 500)):
            held = [r["n"] for r in out.groupBy(F.spark_partition_id().alias("p")).agg(F.count(F.lit(1)).alias("n"), F.sum("m")).collect()]
            assert len(held) == 8 and max(held) < 12_000
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", old)
