"""Joins of live alerts: kept by bucket, and a window's matches are joined before the next join."""

import datetime as dt

from tapeloom.plans import live as plans
from tapeloom.streaming import live
from tests.test_live import NARROW, SCHEMAS


def test_windows_meet_by_bucket_and_are_one_row_before_context(spark, tmp_path):
    own = plans.stream_session(spark)

    def feed(name):
        schema, ts = SCHEMAS[name]
        (tmp_path / name).mkdir(exist_ok=True)
        return own.readStream.schema(schema).parquet(str(tmp_path / name)).withWatermark(ts, "20 seconds")

    (tmp_path / "base").mkdir()
    base = own.readStream.schema("symbol string, ts timestamp, tie long, value double, price double, quantity double, mean double, dev double").parquet(str(tmp_path / "base")).withWatermark("ts", "1 second")
    for df in (live.bull_trap(base, feed("book"), feed("sent"), feed("chain"), NARROW), live.liquidation_cascade(base, feed("book"), feed("sent"), feed("chain"), NARROW)):
        lines = df._jdf.queryExecution().analyzed().toString().split("\n")
        joins = [k for k, line in enumerate(lines) if "Join " in line]
        assert len(joins) == 3 and all("_bucket" in lines[k] for k in joins)
        sent, book = joins[1], joins[2]  # outermost first
        assert any("Aggregate " in line for line in lines[sent:book])


def test_buckets_lose_no_row_at_the_ends_of_a_look_back(spark):
    """As a batch: rows at both ends of the look-back and within it, and just outside."""
    end = dt.datetime(2024, 1, 1, 0, 1)
    w = spark.createDataFrame([("A", end - dt.timedelta(microseconds=1))], "symbol string, event_time timestamp")
    for seconds, met in ((-60, True), (-30, True), (0, True), (-60.000001, False), (0.000001, False)):
        other = spark.createDataFrame([("A", end + dt.timedelta(seconds=seconds))], "symbol string, ts timestamp")
        from pyspark.sql import functions as F

        assert live.meets(w, other, "ts", -60, 0, F.lit(True)).count() == int(met), seconds
        assert [r["f"] for r in live.meets(w, other, "ts", -60, 0, F.lit(True), "f").collect()] == [met]


def test_state_is_a_block_of_events_an_entry(spark, tmp_path):
    """A thousand events a batch are few writes to the store; before, each was written at least twice."""
    from pyspark.sql import functions as F

    from tapeloom.streaming import state
    from tests.test_live import TRADES, at, batches_of

    own = plans.stream_session(spark)
    rows = [("A", i, float(i % 7), 1.0, at(i)) for i in range(3000)]
    stream = batches_of(own, tmp_path / "in", rows, TRADES, 3).withWatermark("trade_ts", "5 seconds")
    df = state.rolling(stream, "trade_ts", "trade_id", F.col("price"), seconds=300)
    q = df.writeStream.format("memory").queryName("blocks").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(180)
    assert own.sql("select * from blocks").count() >= 2990
    assert max(p["stateOperators"][0]["customMetrics"]["rocksdbPutCount"] for p in q.recentProgress) < 100
