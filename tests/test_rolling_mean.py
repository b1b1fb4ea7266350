"""Rolling means over time whose cost doesn't grow with the rows of a frame."""

import datetime as dt
import random

from pyspark.sql import Window
from pyspark.sql import functions as F

from tapeloom.operators import chunked
from tapeloom.streaming import alerts


def test_mean_over_time_equals_range_frame(spark):
    rng = random.Random(4)
    start = dt.datetime(2023, 12, 31, 22)
    rows = [(rng.choice(["A", "B", None]), i, None if i % 11 == 0 else rng.uniform(-9, 9), None if i % 97 == 0 else start + dt.timedelta(seconds=rng.choice([rng.randrange(20_000), 900 * rng.randrange(22)]))) for i in range(3000)]
    rows.append(("C", 3000, None, start))
    df = spark.createDataFrame(rows, "symbol string, id long, v double, ts timestamp").repartition(5)
    over = Window.partitionBy("symbol").orderBy(F.unix_micros("ts")).rangeBetween(-900_000_000, 0)
    want = {r["id"]: r["m"] for r in df.withColumn("m", F.avg("v").over(over)).collect()}
    out = chunked.mean_over_time(df, ["symbol"], "ts", 900, "v", "m")
    assert out.columns == [*df.columns, "m"]
    got = {r["id"]: r["m"] for r in out.collect()}
    assert got.keys() == want.keys() and out.count() == len(rows)
    assert all((got[k] is None) == (want[k] is None) and (want[k] is None or abs(got[k] - want[k]) < 1e-9) for k in want)


def test_baseline_has_no_frame_of_a_reach(spark):
    """A frame between a bound and the row is added up anew for each row; running sums aren't."""
    df = spark.createDataFrame([("A", 1.0, 2.0, dt.datetime(2024, 1, 1))], "symbol string, price double, quantity double, ts timestamp")
    plan = alerts.with_baseline(df, "ts", 600)._jdf.queryExecution().optimizedPlan().toString()
    frames = [x.split(")")[0] for x in plan.split("specifiedwindowframe(")[1:]]
    assert frames and all("unboundedpreceding" in x for x in frames)
