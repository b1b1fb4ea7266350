"""A model renewed in ten daily steps with late rows equals the full build; scans and writes keep to the days that matter."""

import datetime as dt
import random

from pyspark.sql import functions as F

from tapeloom.operators import series
from tapeloom.plans.market import trades_hourly
from tapeloom.sources import incremental as inc
from tapeloom.sources.tables import write_partitioned

START = dt.datetime(2024, 1, 1)


def build(rows):
    hours = trades_hourly(rows).withColumn("day", F.to_date("hour_ts"))
    return series.forward_labels(hours, "close_price", series.by(["symbol"], ["hour_ts"]), {4: 0.003})


MODEL = inc.Model(build, back=2, ahead=1)


def rows_of(days=10):
    rng = random.Random(8)
    out = []
    for h in range(days * 24):
        for symbol in "AB":
            for k in range(2):
                late = rng.choice([0, 0, 0, 1, 3]) if k else 0
                out.append((len(out), START + dt.timedelta(hours=h, minutes=rng.randrange(60)), symbol, rng.uniform(90, 110), rng.uniform(1, 5), bool(k), min(h // 24 + late, days - 1)))
    return out


def frame(spark, rows):
    df = spark.createDataFrame(rows, "trade_id long, trade_ts timestamp_ntz, symbol string, price double, quantity double, is_buyer_maker boolean, arrived int")
    return df.withColumns({"quote_quantity": F.col("price") * F.col("quantity"), "day": F.to_date("trade_ts")})


def test_ten_daily_steps_with_late_rows(spark, tmp_path):
    rows, source, out = rows_of(), str(tmp_path / "source"), str(tmp_path / "out")
    replaced = []
    for step in range(10):
        write_partitioned(frame(spark, [r for r in rows if r[-1] == step]), source, ["day"])
        replaced.append(inc.run(spark, spark.read.parquet(source), "arrived", out, MODEL))
        assert inc.run(spark, spark.read.parquet(source), "arrived", out, MODEL) == []  # nothing new
    text = lambda df: sorted(str([round(x, 8) if isinstance(x, float) else x for x in r]) for r in df.select(sorted(df.columns)).collect())
    assert text(spark.read.parquet(out)) == text(build(frame(spark, rows)))
    assert all(len(days) < 9 for days in replaced) and replaced[-1][-1] == dt.date(2024, 1, 10) and replaced[-1][0] > dt.date(2024, 1, 4)


def test_a_run_that_dies_is_done_again(spark, tmp_path):
    rows, source, out = rows_of(4), str(tmp_path / "source"), str(tmp_path / "out")
    write_partitioned(frame(spark, rows), source, ["day"])

    def dying(df):
        raise RuntimeError("killed")

    try:
        inc.run(spark, spark.read.parquet(source), "arrived", out, inc.Model(dying, 2, 1))
    except RuntimeError:
        pass
    assert inc.last_mark(spark, f"{out}_marks") is None
    assert len(inc.run(spark, spark.read.parquet(source), "arrived", out, MODEL)) == 4
    assert spark.read.parquet(out).count() == build(frame(spark, rows)).count()


def test_scan_prunes_to_the_wanted_days(spark, tmp_path):
    source = str(tmp_path / "source")
    write_partitioned(frame(spark, rows_of()), source, ["day"])
    days = inc.wanted([dt.date(2024, 1, 8)], MODEL)
    assert days == [dt.date(2024, 1, d) for d in (6, 7, 8, 9)] and inc.touched([dt.date(2024, 1, 8)], MODEL) == [dt.date(2024, 1, d) for d in (7, 8, 9, 10)]
    plan = inc.on_days(spark.read.parquet(source), days, "day")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [day" in plan and "2024-01-05" not in plan
    assert {r[0] for r in inc.on_days(spark.read.parquet(source), days, "day").select("day").distinct().collect()} == set(days)
    assert inc.on_days(spark.read.parquet(source), [], "day").count() == 0
