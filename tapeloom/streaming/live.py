"""The eight alerts as streams: windows, then joins to order book, sentiment and chain flow, all in event time.

A detector that compares a window with a rolling baseline takes ``baseline`` rows, the output of a first query that
keeps each symbol's last values in its state; others take the raw streams. Every stream has a watermark, which goes
through windows, inner joins and outer joins. A window fires once, when the watermark has passed all that it looks at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.functions.columns import ieee_div
from tapeloom.streaming.alerts import DEFAULTS, KEY
from tapeloom.streaming.state import rolling


#: The symbol of rows that only drive a watermark.
_BEAT = "\0beat"


def _usd() -> Column:
    return F.col("price") * F.col("quantity")


def trade_baseline(trades: DataFrame, p: dict = DEFAULTS, seconds: str = "baseline_seconds") -> DataFrame:
    """Trades with their mean value in quote currency over the last seconds; a query of its own, whose output is streamed on."""
    return rolling(trades, "trade_ts", "trade_id", _usd(), p[seconds], carry=["price", "quantity"])


def liquidation_baseline(liqs: DataFrame, p: dict = DEFAULTS) -> DataFrame:
    return rolling(liqs.where("side = 'SELL'"), "liq_ts", "liq_id", _usd(), p["baseline_seconds"], carry=["price", "quantity"])


def paced(context: DataFrame, ts: str, pace: DataFrame, pace_ts: str, idle: str, delay: str) -> DataFrame:
    """A slow stream with a watermark that a busy one drives on when it is silent.

    A query's watermark is that of its slowest stream, so a feed without rows would hold every window back. Here each
    row of ``pace`` also says that ``context`` (neither has a watermark yet) is known up to ``idle`` before it; rows
    of the context that come later than that and ``delay`` are late. What drives the watermark goes before any shuffle.
    """
    beat = pace.select((F.col(pace_ts) - F.expr(f"interval {idle}")).alias(ts), F.lit(_BEAT).alias("symbol"), *[F.lit(None).cast(t).alias(c) for c, t in context.dtypes if c not in (ts, "symbol")])
    both = context.unionByName(beat).withWatermark(ts, delay)
    # a condition that isn't deterministic isn't pushed below the watermark, where it would remove what drives it
    return both.where((F.col("symbol") != _BEAT) | (F.uuid() == ""))


def windows(df: DataFrame, ts: str, seconds: int, aggregates: dict[str, Column], slide: int | None = None) -> DataFrame:
    """event_time (the last microsecond of the window, with the stream's watermark), symbol and the aggregates."""
    w = F.window(ts, f"{seconds} seconds", f"{slide} seconds" if slide else None)
    return df.groupBy(w.alias("w"), "symbol").agg(*[c.alias(n) for n, c in aggregates.items()]).select(F.window_time("w").alias("event_time"), "symbol", *aggregates)


def meets(w: DataFrame, other: DataFrame, ts: str, low: int, high: int, met: Column, flag: str | None = None, ahead: int = 1) -> DataFrame:
    """Windows with a row of ``other`` from low to high seconds of their end that meets the condition.

    Without ``flag`` only such windows stay. With it all stay, and those that meet none come once the watermark has
    passed the look-back. A window with several rows comes several times: ``once`` joins these, best before the next join.
    ``ahead``: microseconds from event_time to the window's end.

    Both sides are kept by symbol and bucket as long as the look-back: a row goes to its bucket and to the one before,
    a window to that where its look-back begins, so it meets the rows of two look-backs and not all that are held.
    """
    names = {c: f"_o_{c}" for c in other.columns if c in w.columns}
    start, end = (F.col("event_time") + F.expr(f"interval {x * 1_000_000 + ahead} microseconds") for x in (low, high))
    bucket = lambda at: F.floor(F.unix_micros(at) / ((high - low) * 1_000_000))
    side = other.withColumnsRenamed(names).withColumnRenamed(ts, "_at")
    side = side.withColumn("_o_bucket", F.explode(F.array(bucket(F.col("_at")), bucket(F.col("_at")) - 1)))
    on = (F.col("symbol") == F.col("_o_symbol")) & (F.col("_bucket") == F.col("_o_bucket")) & (F.col("_at") >= start) & (F.col("_at") <= end) & met
    j = w.withColumn("_bucket", bucket(start)).join(side, on, "inner" if flag is None else "left_outer")
    return j.select(*w.columns) if flag is None else j.select(*w.columns, F.col("_at").isNotNull().alias(flag))


def once(w: DataFrame, *flags: str) -> DataFrame:
    """One row a window; a flag holds if any row has it."""
    keys = [c for c in w.columns if c not in flags]
    return w.groupBy(*keys).agg(*[F.max(f).alias(f) for f in flags]) if flags else w.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).drop("_n")


def alerts(w: DataFrame, kind: str, sent: DataFrame | None, chain: DataFrame | None, sentiment: Column | None, flow: Column | None, p: dict) -> DataFrame:
    """alert_type, symbol, event_time (the window's end), strong and side: sentiment and chain flow make an alert strong."""
    kept = w.select("event_time", "symbol", F.col("side") if "side" in w.columns else F.lit("").alias("side"))
    if sent is not None:
        kept = once(meets(kept, sent, "sent_ts", -p["sentiment_seconds"], 0, sentiment, "_sent"), "_sent")
        kept = once(meets(kept, chain, "chain_ts", -p["chain_seconds"], 0, flow, "_chain"), "_chain")
        strong = F.col("_sent") & F.col("_chain")
    else:
        kept, strong = once(kept), F.lit(False)
    return kept.select(F.lit(kind).alias("alert_type"), "symbol", (F.col("event_time") + F.expr("interval 1 microsecond")).alias("event_time"), strong.alias("strong"), F.nullif("side", F.lit("")).alias("side"))


def _pumps(base: DataFrame, p: dict) -> DataFrame:
    order = F.struct("ts", "tie")
    w = windows(base, "ts", p["pump_window_seconds"], {"open_price": F.min_by("price", order), "close_price": F.max_by("price", order), "vol_usd": F.sum("value"), "avg_trade": F.max("mean")})
    return w.where(ieee_div(F.col("close_price") - F.col("open_price"), F.col("open_price")) * 100 > p["pump_price_pct"])


def _sums(base: DataFrame, seconds: int, total: str, mean: str) -> DataFrame:
    return windows(base, "ts", seconds, {total: F.sum("value"), mean: F.max("mean")})


def bull_trap(base, book, sent, chain, p=DEFAULTS) -> DataFrame:
    w = _pumps(base, p).where(F.col("vol_usd") < F.col("avg_trade") * p["max_pump_vol_multiplier"])
    w = once(meets(w.select(*KEY), book, "ob_ts", -p["book_seconds"], 0, F.col("ask_vol_1pct_usd") > F.col("bid_vol_1pct_usd") * p["ask_bid_imbalance"]))
    return alerts(w, "BULL_TRAP", sent, chain, (F.col("funding_rate_pct") > 0.05) & (F.col("oi_delta_pct") > 1.0), F.col("tx_type") == "INFLOW", p)


def true_breakout(base, book, sent, chain, p=DEFAULTS) -> DataFrame:
    w = _pumps(base, p).where(F.col("vol_usd") > F.col("avg_trade") * p["min_vol_multiplier"])
    w = once(meets(w.select(*KEY), book, "ob_ts", -p["book_seconds"], 0, F.col("bid_vol_1pct_usd") > F.col("ask_vol_1pct_usd") * p["bid_ask_imbalance"]))
    return alerts(w, "TRUE_BREAKOUT", sent, chain, (F.col("funding_rate_pct") < 0) & (F.col("oi_delta_pct") > 1.0), F.col("tx_type") == "OUTFLOW", p)


def bottom_catcher(base, liq_base, book, sent, chain, p=DEFAULTS, floor_usd: float = 10000.0) -> DataFrame:
    w = _sums(liq_base, p["window_seconds"], "liq_usd", "avg_liq").where(F.col("liq_usd") > F.greatest(F.col("avg_liq"), F.lit(floor_usd)) * p["liq_multiplier"])
    buys = _sums(base, p["window_seconds"], "buy_usd", "avg_trade").where(F.col("buy_usd") > F.col("avg_trade") * p["whale_multiplier"])
    # both sides carry the last microsecond of their windows, so their ends differ as these do
    w = once(meets(w.select(*KEY), buys.select("symbol", F.col("event_time").alias("_buy_time")), "_buy_time", 0, 2 * p["window_seconds"], F.lit(True), ahead=0))
    w = meets(w, book, "ob_ts", -p["book_seconds"], p["book_seconds"], F.col("bid_vol_1pct_usd") > F.col("ask_vol_1pct_usd") * p["bid_wall_multiplier"])
    w = once(w)
    return alerts(w, "BOTTOM_CATCHER", sent, chain, F.col("funding_rate_pct") < 0, F.col("tx_type") == "OUTFLOW", p)


def liquidation_cascade(liq_base, book, sent, chain, p=DEFAULTS) -> DataFrame:
    w = _sums(liq_base, p["cascade_window_seconds"], "liq_usd", "avg_liq").where(F.col("liq_usd") > F.greatest(F.col("avg_liq"), F.lit(p["min_base_liq_usd"])) * p["cascade_liq_multiplier"])
    w = once(meets(w, book, "ob_ts", -p["book_seconds"], 0, F.col("liq_usd") > F.col("bid_vol_1pct_usd") * p["liquidity_ratio"]).select(*KEY))
    return alerts(w, "LIQUIDATION_CASCADE", sent, chain, F.col("funding_rate_pct") > 0.05, F.col("tx_type") == "INFLOW", p)


def _leaning(down: Column, sent_down: Column, sent_up: Column) -> tuple[Column, Column]:
    """Conditions on sentiment and flow for alerts of both sides: inflow goes with the falling one."""
    return (down & sent_down) | (~down & sent_up), (down & (F.col("tx_type") == "INFLOW")) | (~down & (F.col("tx_type") == "OUTFLOW"))


def spoofing(trades, book, sent, chain, p=DEFAULTS) -> DataFrame:
    order = F.struct("ob_ts", "book_id")
    sides = {f"{n}_{s}": f(f"{s}_vol_1pct_usd") for s in ("bid", "ask") for n, f in (("min", F.min), ("peak", F.max))} | {f"final_{s}": F.max_by(f"{s}_vol_1pct_usd", order) for s in ("bid", "ask")}
    o = windows(book, "ob_ts", p["spoof_window_seconds"], sides, p["spoof_slide_seconds"])
    t = windows(trades, "trade_ts", p["spoof_window_seconds"], {"traded": F.sum(_usd())}, p["spoof_slide_seconds"]).select(F.col("event_time").alias("_t"), F.col("symbol").alias("_s"), "traded")
    j = o.join(t, (F.col("symbol") == F.col("_s")) & (F.col("event_time") == F.col("_t")), "left_outer")

    def fake(s: str) -> Column:
        low, peak, final = (F.col(f"{n}_{s}") for n in ("min", "peak", "final"))
        return (peak > low * p["spoof_multiplier"]) & (final < low * 1.5) & (F.coalesce("traded", F.lit(0.0)) < (peak - low) * p["execution_threshold"])

    w = j.select("event_time", "symbol", F.when(fake("bid"), "BID").when(fake("ask"), "ASK").alias("side")).where("side is not null")
    sentiment, flow = _leaning(F.col("side") == "BID", F.col("funding_rate_pct") > 0.05, F.col("funding_rate_pct") < 0)
    return alerts(w, "SPOOFING_DETECTED", sent, chain, sentiment, flow, p)


def mean_reversion(base, book, p=DEFAULTS) -> DataFrame:
    """base: ``trade_baseline`` over ``scalp_baseline_seconds``."""
    w = windows(base, "ts", p["scalp_window_seconds"], {"px": F.max_by("price", F.struct("ts", "tie")), "vol": F.sum("value"), "avg": F.max("mean"), "vwap": ieee_div(F.sum("value"), F.sum("quantity"))})
    dev = ieee_div(F.col("px") - F.col("vwap"), F.col("vwap")) * 100
    w = w.where((F.abs(dev) >= p["vwap_deviation_pct"]) & (F.col("vol") < F.col("avg") * p["max_chop_vol"])).select("event_time", "symbol", F.when(dev > 0, "SHORT").otherwise("LONG").alias("side"))
    m, short = p["reversion_wall_multiplier"], F.col("side") == "SHORT"
    asks, bids = F.col("ask_vol_1pct_usd"), F.col("bid_vol_1pct_usd")
    return alerts(meets(w, book, "ob_ts", -p["book_seconds"], 0, (short & (asks > bids * m)) | (~short & (bids > asks * m))), "MICRO_MEAN_REVERSION", None, None, None, None, p)


def order_flow(book, sent, chain, p=DEFAULTS) -> DataFrame:
    order = F.struct("ob_ts", "book_id")
    ends = {f"{n}_{c}": f(v, order) for c, v in (("px", "best_bid_price"), ("bid", "bid_vol_1pct_usd"), ("ask", "ask_vol_1pct_usd")) for n, f in (("open", F.min_by), ("close", F.max_by))}
    w = windows(book, "ob_ts", p["ofi_window_seconds"], ends)
    moved = lambda c: F.col(f"close_{c}") - F.col(f"open_{c}")
    most = p["ofi_delta_usd_threshold"]
    side = F.when((moved("bid") <= -most) & (moved("ask") >= most), "SELL").when((moved("bid") >= most) & (moved("ask") <= -most), "BUY")
    w = w.where(F.abs(ieee_div(moved("px"), F.col("open_px")) * 100) < p.get("ofi_flat_pct", 0.1)).select("event_time", "symbol", side.alias("side")).where("side is not null")
    _, flow = _leaning(F.col("side") == "SELL", F.lit(True), F.lit(True))
    return alerts(w, "ORDER_FLOW_IMBALANCE", sent, chain, F.col("oi_delta_pct") > 1.0, flow, p)


def lead_lag(trades, sent, chain, leader: str, lagger: str, p=DEFAULTS) -> DataFrame:
    """Both symbols' windows meet by their ends, as a stream joined with itself."""
    order = F.struct("trade_ts", "trade_id")

    def moves(symbol: str) -> DataFrame:
        w = windows(trades.where(F.col("symbol") == symbol), "trade_ts", p["lead_lag_window_seconds"], {"o": F.min_by("price", order), "c": F.max_by("price", order)})
        return w.select("event_time", "symbol", (ieee_div(F.col("c") - F.col("o"), F.col("o")) * 100).alias("chg"))

    led = moves(leader).select(F.col("event_time").alias("_t"), F.col("chg").alias("lead_chg"))
    j = moves(lagger).join(led, F.col("event_time") == F.col("_t"))
    move, late = p["leader_move_pct"], p["lagger_delay_pct"]
    side = F.when((F.col("lead_chg") <= -move) & (F.col("chg") > -late), "SHORT").when((F.col("lead_chg") >= move) & (F.col("chg") < late), "LONG")
    w = j.select("event_time", "symbol", side.alias("side")).where("side is not null")
    sentiment, flow = _leaning(F.col("side") == "SHORT", F.col("funding_rate_pct") > 0.05, F.col("funding_rate_pct") < 0)
    return alerts(w, "LEAD_LAG_ARBITRAGE", sent, chain, sentiment, flow, p)
