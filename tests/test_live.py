"""Live alerts and keyed state: restarts, late rows, silent feeds, state that grows by event; ledgers of sinks."""

import datetime as dt
import random

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from tapeloom.plans import live as plans
from tapeloom.streaming import alerts, ledger, live, state
from tapeloom.streaming import pipelines as P

START = dt.datetime(2024, 1, 1)
TRADES = "symbol string, trade_id long, price double, quantity double, trade_ts timestamp"
BOOK = "symbol string, book_id long, best_bid_price double, bid_vol_1pct_usd double, ask_vol_1pct_usd double, ob_ts timestamp"
SENT = "symbol string, sent_id long, funding_rate_pct double, oi_delta_pct double, sent_ts timestamp"
CHAIN = "symbol string, chain_id long, tx_type string, chain_ts timestamp"
LIQS = "symbol string, liq_id long, side string, price double, quantity double, liq_ts timestamp"
at = lambda s: START + dt.timedelta(seconds=s)
NARROW = alerts.DEFAULTS | {"pump_window_seconds": 10, "pump_price_pct": 0.2, "max_pump_vol_multiplier": 30.0, "ask_bid_imbalance": 1.2, "bid_wall_multiplier": 1.2, "whale_multiplier": 1.0, "liq_multiplier": 1.1, "spoof_multiplier": 1.5, "execution_threshold": 5.0, "sentiment_seconds": 60, "chain_seconds": 60, "baseline_seconds": 120}


@pytest.fixture
def own(spark):
    s = plans.stream_session(spark)
    s.conf.set("spark.sql.shuffle.partitions", "2")
    return s


def feeds(seconds=600, seed=5):
    """Rows of every feed, in time order."""
    rng = random.Random(seed)
    sym = lambda: rng.choice(["A", "B"])
    out = {"trades": [], "book": [], "sent": [], "chain": [], "liqs": []}
    for s in range(seconds):
        out["trades"].append((sym(), s, 100.0 + rng.uniform(-1, 1), rng.uniform(1, 9), at(s)))
        out["book"].append((sym(), s, 100.0, rng.uniform(1, 3000), rng.uniform(1, 3000), at(s)))
        if s % 3 == 0:
            out["liqs"].append((sym(), s, rng.choice(["SELL", "SELL", "BUY"]), 100.0, rng.uniform(1, 9), at(s)))
        if s % 7 == 0:
            out["sent"].append((sym(), s, rng.uniform(-0.2, 0.2), rng.uniform(0, 3), at(s)))
            out["chain"].append((sym(), s, rng.choice(["INFLOW", "OUTFLOW"]), at(s)))
    return out


SCHEMAS = {"trades": (TRADES, "trade_ts"), "book": (BOOK, "ob_ts"), "sent": (SENT, "sent_ts"), "chain": (CHAIN, "chain_ts"), "liqs": (LIQS, "liq_ts")}


def add(own, folder, rows, names=SCHEMAS):
    for name in names:
        own.createDataFrame(rows[name], SCHEMAS[name][0]).coalesce(1).write.mode("append").parquet(str(folder / name))


def feed(own, folder, delay="20 seconds"):
    def of(name):
        schema, ts = SCHEMAS[name]
        return own.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(str(folder / name)).withWatermark(ts, delay)

    return of


def held(folder):
    def of(df, name):
        P_ = plans.start_all([plans.Sink(name, df, str(folder / f"base_{name}"))], str(folder / "cp"), once=True)
        for q in P_:
            q.awaitTermination(120)
        return df.sparkSession.readStream.schema(df.schema).parquet(str(folder / f"base_{name}")).withWatermark("ts", "1 second")

    return of


CASES = {
    "bull_trap": (lambda f, h: live.bull_trap(h(live.trade_baseline(f("trades"), NARROW), "trades"), f("book"), f("sent"), f("chain"), NARROW), lambda b: alerts.bull_trap(b["trades"], b["book"], b["sent"], b["chain"], p=NARROW)),
    "spoofing": (lambda f, h: live.spoofing(f("trades"), f("book"), f("sent"), f("chain"), NARROW), lambda b: alerts.spoofing(b["trades"], b["book"], b["sent"], b["chain"], p=NARROW)),
}


@pytest.mark.parametrize("name", CASES)
def test_closed_windows_equal_batch_after_restart_and_late_rows(own, tmp_path, name):
    rows = feeds()
    parts = [{k: [r for r in v if lo <= (r[-1] - START).total_seconds() < hi] for k, v in rows.items()} for lo, hi in ((0, 250), (250, 450), (450, 600))]
    for part in parts:  # rows of one part come in any order: the delay covers a file's last 20 seconds only, so parts stay apart
        for v in part.values():
            random.Random(1).shuffle(v)
    stream, batch = CASES[name]
    out = str(tmp_path / "alerts")

    def go():
        df = stream(feed(own, tmp_path), held(tmp_path))
        for q in plans.start_all([plans.Sink("alerts", df, out)], str(tmp_path / "cp"), once=True):
            q.awaitTermination(120)
        return sorted((tuple(r) for r in own.read.schema(df.schema).parquet(out).collect()), key=str)

    add(own, tmp_path, parts[0])
    add(own, tmp_path, parts[1])
    first = go()
    late = {"trades": [("A", 9001, 500.0, 900.0, at(5))], "book": [("A", 9001, 1.0, 1.0, 1e9, at(5))], "sent": [("A", 9001, 9.0, 9.0, at(5))], "chain": [("A", 9001, "INFLOW", at(5))], "liqs": [("A", 9001, "SELL", 100.0, 1e6, at(5))]}
    add(own, tmp_path, {k: parts[2][k] + late[k] for k in late})
    got = go()
    want = sorted((tuple(r) for r in batch({k: own.createDataFrame(v, SCHEMAS[k][0]) for k, v in rows.items()}).collect()), key=str)
    assert set(map(str, first)) <= set(map(str, got)) and len(first) < len(got) == len(set(got))
    assert set(got) <= set(want) and any(r[3] for r in got) and any(not r[3] for r in got)
    last = max(r[2] for r in got)
    assert last > at(390) > max(r[2] for r in first) and {r for r in want if r[2] < last} <= set(got)


def test_silent_context_lets_windows_out_and_state_shrinks(own, tmp_path):
    """No sentiment at all: windows wait while nothing says so, and come once the trades drive its watermark."""
    rows = feeds(400)
    rows["sent"] = []
    add(own, tmp_path, rows)
    raw = lambda name: own.readStream.schema(SCHEMAS[name][0]).option("maxFilesPerTrigger", 1).parquet(str(tmp_path / name))

    def run(name, sent):
        w = live.windows(raw("trades").withWatermark("trade_ts", "20 seconds"), "trade_ts", 10, {"n": F.count(F.lit(1))})
        w = live.meets(w, sent, "sent_ts", -20, 0, F.lit(True), "_sent")
        q = w.writeStream.format("memory").queryName(name).option("checkpointLocation", str(tmp_path / f"c_{name}")).trigger(availableNow=True).start()
        q.awaitTermination(120)
        return own.sql(f"select * from {name}").collect(), sum(s["numRowsTotal"] for s in q.lastProgress["stateOperators"])

    held, kept = run("held", raw("sent").withWatermark("sent_ts", "20 seconds"))
    assert held == [] and kept >= 80
    paced = live.paced(raw("sent"), "sent_ts", raw("trades"), "trade_ts", "30 seconds", "20 seconds")
    got, kept = run("paced", paced)
    assert len(got) >= 60 and not any(r["_sent"] for r in got) and len({(r["event_time"], r["symbol"]) for r in got}) == len(got)
    assert kept < 30  # what the look-back has passed has left both the windows' and the join's state
    own.createDataFrame([("A", 1, 0.1, 1.0, at(395))], SENT).coalesce(1).write.mode("append").parquet(str(tmp_path / "sent"))
    own.createDataFrame([("A", 10_000 + s, 1.0, 1.0, at(400 + s)) for s in range(200)], TRADES).coalesce(1).write.mode("append").parquet(str(tmp_path / "trades"))
    seen = {(r["symbol"], (r["event_time"] + dt.timedelta(microseconds=1) - START).total_seconds()) for r in run("paced_on", live.paced(raw("sent"), "sent_ts", raw("trades"), "trade_ts", "30 seconds", "20 seconds"))[0] if r["_sent"]}
    assert seen == {("A", 400.0), ("A", 410.0)}


def batches_of(own, folder, rows, schema, files):
    for k in range(files):
        own.createDataFrame(rows[k * len(rows) // files : (k + 1) * len(rows) // files], schema).coalesce(1).write.parquet(str(folder / f"f{k:02d}"))
    return own.readStream.schema(schema).option("recursiveFileLookup", "true").option("maxFilesPerTrigger", 1).parquet(str(folder))


def test_rolling_state_equals_range_frame_and_writes_by_event(own, tmp_path):
    rng = random.Random(2)
    rows = [("AB"[i % 2], i, rng.uniform(0, 9), 1.0, at(i + rng.randrange(-4, 5))) for i in range(1200)]
    stream = batches_of(own, tmp_path / "in", rows, TRADES, 6).withWatermark("trade_ts", "20 seconds")
    df = state.rolling(stream, "trade_ts", "trade_id", F.col("price"), seconds=300, carry=["quantity"])
    q = df.writeStream.format("memory").queryName("rolled").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(180)
    got = {r["tie"]: (r["mean"], r["dev"]) for r in own.sql("select * from rolled").collect()}
    over = Window.partitionBy("symbol").orderBy(F.unix_micros("trade_ts")).rangeBetween(-300_000_000, 0)
    table = own.createDataFrame(rows, TRADES).select("trade_id", "trade_ts", F.avg("price").over(over).alias("m"), F.stddev_pop("price").over(over).alias("d")).collect()
    for r in table:
        if r["trade_ts"] < max(x[4] for x in rows) - dt.timedelta(seconds=20):
            assert got[r["trade_id"]] == (pytest.approx(r["m"]), pytest.approx(r["d"], abs=1e-6))
    # each batch brings 200 events, while the frame's rows grow to 300 a symbol: puts follow the events
    puts = [p["stateOperators"][0]["customMetrics"]["rocksdbPutCount"] for p in q.recentProgress if p["numInputRows"] == 200]
    assert len(puts) == 6 and max(puts[2:]) < 1.3 * min(puts[2:]) + 50
    rows_held = [p["stateOperators"][0]["numRowsTotal"] for p in q.recentProgress]
    assert rows_held[-1] < 400 + 200


def test_previous_value_and_silence(own, tmp_path):
    rows = [("A", i, float(v), 1.0, at(s)) for i, (s, v) in enumerate([(0, 5), (10, 10), (20, 0), (30, 4), (4000, 8), (9000, 2), (20000, 1)])]
    stream = batches_of(own, tmp_path / "in", rows, TRADES, 7).withWatermark("trade_ts", "1 second")
    df = state.change(stream, "trade_ts", "trade_id", F.col("price"), ttl_minutes=30)
    q = df.writeStream.format("memory").queryName("changed").option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
    q.awaitTermination(120)
    got = {r["tie"]: (r["before"], r["change_pct"]) for r in own.sql("select * from changed").collect()}
    assert got[0] == (None, None) and got[1] == (5.0, 100.0) and got[2] == (10.0, -100.0) and got[3] == (0.0, None)
    assert got[4] == got[5] == (None, None)  # forgotten after more than half an hour


def test_ledgered_sinks_know_a_replayed_batch(own, tmp_path):
    """A batch that was written but not committed is replayed under its id and changes nothing."""
    rows = [("AB"[i % 2], i % 6, float(i), 1.0, at(i)) for i in range(40)]
    stream = batches_of(own, tmp_path / "in", rows, TRADES, 4)
    log, failing = str(tmp_path / "log"), {1, 3}

    def write(batch, n):
        ledger.append_once(log)(batch, n)
        if n in failing:
            failing.discard(n)
            raise RuntimeError("killed between write and commit")

    for _ in range(3):
        q = stream.writeStream.foreachBatch(write).option("checkpointLocation", str(tmp_path / "cp")).trigger(availableNow=True).start()
        try:
            q.awaitTermination(120)
            break
        except Exception as e:  # noqa: BLE001
            assert "killed" in str(e)
    assert not failing
    assert sorted(r["price"] for r in ledger.read_log(own, log).collect()) == [r[2] for r in rows]
    key = lambda df: {(r["symbol"], r["trade_id"]): r["price"] for r in df.collect()}
    want = {(r[0], r[1]): r[2] for r in rows}
    assert key(ledger.current(own, log, ["symbol", "trade_id"], ["trade_ts"])) == want
    ledger.compact(own, log, ["symbol", "trade_id"], ["trade_ts"])
    assert key(ledger.current(own, log, ["symbol", "trade_id"], ["trade_ts"])) == want
    ledger.append_once(log)(own.createDataFrame([("A", 0, -1.0, 1.0, at(0))], TRADES), 2)  # a batch that the base holds
    assert key(ledger.current(own, log, ["symbol", "trade_id"], ["trade_ts"])) == want
    ledger.append_once(log)(own.createDataFrame([("A", 0, 77.0, 1.0, at(99))], TRADES), 4)
    assert key(ledger.current(own, log, ["symbol", "trade_id"], ["trade_ts"])) == want | {("A", 0): 77.0}
    ledger.compact(own, log, ["symbol", "trade_id"], ["trade_ts"])
    assert key(ledger.current(own, log, ["symbol", "trade_id"], ["trade_ts"])) == want | {("A", 0): 77.0}
