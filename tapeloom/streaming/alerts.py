"""Alert detection over trades, order book, liquidations, sentiment and chain flows.

Each detector works on all symbols at once; thresholds come from a parameter table with a ``default`` row. A
window fires at most once: it looks whether any order-book, sentiment or chain row near its end meets the
condition. Rows that do are reduced to a first and last time a bucket before the join.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.functions.columns import ieee_div
from tapeloom.operators.chunked import mean_over_time
from tapeloom.operators.joins import interval_join

KEY = ["symbol", "event_time"]

#: Default thresholds of the detectors; windows and look-backs in seconds.
DEFAULTS = {
    "window_seconds": 5, "liq_multiplier": 5.0, "bid_wall_multiplier": 3.0, "whale_multiplier": 4.0, "pump_window_seconds": 60, "pump_price_pct": 1.5, "max_pump_vol_multiplier": 1.5, "ask_bid_imbalance": 4.0,
    "min_vol_multiplier": 3.0, "bid_ask_imbalance": 2.0, "spoof_window_seconds": 10, "spoof_slide_seconds": 2, "spoof_multiplier": 4.0, "execution_threshold": 0.1, "cascade_window_seconds": 5, "cascade_liq_multiplier": 5.0,
    "min_base_liq_usd": 5000.0, "liquidity_ratio": 1.5, "lead_lag_window_seconds": 3, "leader_move_pct": 0.5, "lagger_delay_pct": 0.1, "ofi_window_seconds": 10, "ofi_delta_usd_threshold": 500000.0,
    "scalp_window_seconds": 15, "max_chop_vol": 0.5, "vwap_deviation_pct": 0.15, "reversion_wall_multiplier": 2.0, "baseline_seconds": 600, "scalp_baseline_seconds": 1800, "book_seconds": 5, "sentiment_seconds": 600, "chain_seconds": 3600,
}


def with_params(df: DataFrame, params: DataFrame, names: list[str]) -> DataFrame:
    """Adds each symbol's thresholds, those of ``default`` where it has none. params: symbol and a column a threshold.

    The table has a row a symbol and is broadcast by its size, as any small dimension is.
    """
    default = params.where("symbol = 'default'").select(*[F.col(n).alias(f"_d_{n}") for n in names])
    own = params.where("symbol <> 'default'").select("symbol", *[F.col(n).alias(f"_p_{n}") for n in names])
    joined = df.join(own, "symbol", "left").crossJoin(F.broadcast(default))  # one row
    return joined.withColumns({n: F.coalesce(f"_p_{n}", f"_d_{n}") for n in names}).drop(*[f"_{x}_{n}" for n in names for x in "pd"])


def tumble(df: DataFrame, ts: str, seconds: int, slide: int | None = None) -> DataFrame:
    """Adds event_time, the end of the row's window (of each of them for a hopping one)."""
    w = F.window(ts, f"{seconds} seconds", f"{slide} seconds") if slide else F.window(ts, f"{seconds} seconds")
    return df.withColumn("_w", w).withColumn("event_time", F.col("_w.end")).drop("_w")


@dataclass(frozen=True)
class Either:
    """A condition on the rows looked for that depends on the window: ``yes`` where ``case`` holds for it, else ``no``."""

    case: Column
    yes: Column
    no: Column


def near(windows: DataFrame, other: DataFrame, ts: str, low: int, high: int, flag: str, met: Column | Either) -> DataFrame:
    """Adds to each window whether any row of other, low to high seconds from its end, meets the condition.

    Rows that meet it are first reduced to the first and last time of each symbol and bucket as long as the look-back
    (low < high): a row reaches from the bucket where a window's look-back begins if the last one isn't too early,
    and from the next bucket if the first one isn't too late. So a window meets a row, however many there are.
    """
    if isinstance(met, Either):
        out = near(near(windows, other, ts, low, high, f"{flag}_yes", met.yes), other, ts, low, high, f"{flag}_no", met.no)
        return out.withColumn(flag, F.when(met.case, F.col(f"{flag}_yes")).otherwise(F.col(f"{flag}_no"))).drop(f"{flag}_yes", f"{flag}_no")
    if high <= low:
        raise ValueError("the look-back must have a length")
    size = (high - low) * 1_000_000
    at, start = F.unix_micros(F.col(ts).cast("timestamp")), F.unix_micros(F.col("event_time").cast("timestamp")) + low * 1_000_000
    hits = other.where(met).select(F.col("symbol").alias("_s"), at.alias("_at")).groupBy("_s", F.floor(F.col("_at") / size).alias("_b")).agg(F.min("_at").alias("_lo"), F.max("_at").alias("_hi"))
    none = F.lit(None).cast("bigint")
    seen = hits.select("_s", F.inline(F.array(F.struct(F.col("_b"), none.alias("_lo"), F.col("_hi")), F.struct((F.col("_b") - 1).alias("_b"), F.col("_lo"), none.alias("_hi")))))
    seen = seen.groupBy("_s", "_b").agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
    placed = windows.withColumns({"_start": start, "_wb": F.floor(start / size)})
    joined = placed.join(seen, (F.col("symbol") == F.col("_s")) & (F.col("_wb") == F.col("_b")), "left")
    found = F.coalesce(F.col("_hi") >= F.col("_start"), F.lit(False)) | F.coalesce(F.col("_lo") <= F.col("_start") + size, F.lit(False))
    return joined.withColumn(flag, found).drop("_s", "_b", "_lo", "_hi", "_start", "_wb")


def beside(windows: DataFrame, other: DataFrame, ts: str, low: int, high: int, flag: str, met: Column) -> DataFrame:
    """As ``near``, for a condition that compares a row with its window: every row of the (short) look-back is looked at."""
    any_ = interval_join(windows, other, ["symbol"], "event_time", ts, low, high).where(met).select(*KEY).distinct().withColumn(flag, F.lit(True))
    return windows.join(any_, KEY, "left").withColumn(flag, F.coalesce(F.col(flag), F.lit(False)))


def with_context(windows: DataFrame, sent: DataFrame, chain: DataFrame, sentiment: Column | Either, flow: str | Either, p: dict) -> DataFrame:
    """Adds strong: sentiment and chain flow both point the alert's way."""
    flow = F.col("tx_type") == flow if isinstance(flow, str) else flow
    out = near(windows, sent, "sent_ts", -p["sentiment_seconds"], 0, "_sent", sentiment)
    out = near(out, chain, "chain_ts", -p["chain_seconds"], 0, "_chain", flow)
    return out.withColumn("strong", F.col("_sent") & F.col("_chain")).drop("_sent", "_chain")


def _alert(df: DataFrame, kind: str, side: Column | None = None) -> DataFrame:
    return df.select(F.lit(kind).alias("alert_type"), "symbol", "event_time", "strong", (side if side is not None else F.lit(None).cast("string")).alias("side"))


def _first_last(x: str, ts: str, tie: str) -> tuple[Column, Column]:
    order = F.struct(ts, tie)
    return F.min_by(x, order), F.max_by(x, order)


def with_baseline(df: DataFrame, ts: str, seconds: int) -> DataFrame:
    """Adds the value in quote currency and its mean over the symbol's last seconds, in time chunks: a busy symbol is many tasks."""
    valued = df.withColumn("_usd", F.col("price") * F.col("quantity"))
    return mean_over_time(valued, ["symbol"], ts, seconds, "_usd", "_avg")


def pump_windows(trades: DataFrame, p: dict) -> DataFrame:
    base = with_baseline(trades, "trade_ts", p["baseline_seconds"])
    first, last = _first_last("price", "trade_ts", "trade_id")
    out = tumble(base, "trade_ts", p["pump_window_seconds"]).groupBy(*KEY).agg(first.alias("open_price"), last.alias("close_price"), F.sum("_usd").alias("vol_usd"), F.max("_avg").alias("avg_trade"))
    return out.withColumn("move_pct", ieee_div(F.col("close_price") - F.col("open_price"), F.col("open_price")) * 100)


def bull_trap(trades, book, sent, chain, p=DEFAULTS) -> DataFrame:
    """A price spike on weak volume under a wall of asks."""
    w = pump_windows(trades, p).where((F.col("move_pct") > p["pump_price_pct"]) & (F.col("vol_usd") < F.col("avg_trade") * p["max_pump_vol_multiplier"]))
    w = near(w, book, "ob_ts", -p["book_seconds"], 0, "_wall", F.col("ask_vol_1pct_usd") > F.col("bid_vol_1pct_usd") * p["ask_bid_imbalance"]).where("_wall")
    return _alert(with_context(w, sent, chain, (F.col("funding_rate_pct") > 0.05) & (F.col("oi_delta_pct") > 1.0), "INFLOW", p), "BULL_TRAP")


def true_breakout(trades, book, sent, chain, p=DEFAULTS) -> DataFrame:
    """A price spike on strong volume over a wall of bids."""
    w = pump_windows(trades, p).where((F.col("move_pct") > p["pump_price_pct"]) & (F.col("vol_usd") > F.col("avg_trade") * p["min_vol_multiplier"]))
    w = near(w, book, "ob_ts", -p["book_seconds"], 0, "_wall", F.col("bid_vol_1pct_usd") > F.col("ask_vol_1pct_usd") * p["bid_ask_imbalance"]).where("_wall")
    return _alert(with_context(w, sent, chain, (F.col("funding_rate_pct") < 0) & (F.col("oi_delta_pct") > 1.0), "OUTFLOW", p), "TRUE_BREAKOUT")


def liquidation_windows(liqs: DataFrame, seconds: int, p: dict) -> DataFrame:
    sells = liqs.where("side = 'SELL'")
    base = with_baseline(sells, "liq_ts", p["baseline_seconds"])
    return tumble(base, "liq_ts", seconds).groupBy(*KEY).agg(F.sum("_usd").alias("liq_usd"), F.max("_avg").alias("avg_liq"))


def bottom_catcher(trades, book, liqs, sent, chain, p=DEFAULTS, floor_usd: float = 10000.0) -> DataFrame:
    """Forced selling that strong buying absorbs over a wall of bids."""
    w = liquidation_windows(liqs, p["window_seconds"], p).where(F.col("liq_usd") > F.greatest(F.col("avg_liq"), F.lit(floor_usd)) * p["liq_multiplier"])
    base = with_baseline(trades, "trade_ts", p["baseline_seconds"])
    buys = tumble(base, "trade_ts", p["window_seconds"]).groupBy(*KEY).agg(F.sum("_usd").alias("buy_usd"), F.max("_avg").alias("avg_trade")).withColumnRenamed("event_time", "buy_time")
    w = near(w, buys, "buy_time", 0, 2 * p["window_seconds"], "_buy", F.col("buy_usd") > F.col("avg_trade") * p["whale_multiplier"]).where("_buy")
    w = near(w, book, "ob_ts", -p["book_seconds"], p["book_seconds"], "_wall", F.col("bid_vol_1pct_usd") > F.col("ask_vol_1pct_usd") * p["bid_wall_multiplier"]).where("_wall")
    return _alert(with_context(w, sent, chain, F.col("funding_rate_pct") < 0, "OUTFLOW", p), "BOTTOM_CATCHER")


def liquidation_cascade(book, liqs, sent, chain, p=DEFAULTS) -> DataFrame:
    """Forced selling larger than its average and than the bids below the price."""
    w = liquidation_windows(liqs, p["cascade_window_seconds"], p).where(F.col("liq_usd") > F.greatest(F.col("avg_liq"), F.lit(p["min_base_liq_usd"])) * p["cascade_liq_multiplier"])
    w = beside(w, book, "ob_ts", -p["book_seconds"], 0, "_thin", F.col("liq_usd") > F.col("bid_vol_1pct_usd") * p["liquidity_ratio"]).where("_thin")
    return _alert(with_context(w, sent, chain, F.col("funding_rate_pct") > 0.05, "INFLOW", p), "LIQUIDATION_CASCADE")


def spoofing(trades, book, sent, chain, p=DEFAULTS) -> DataFrame:
    """A wall that appears and goes within a hopping window while little trades."""
    o = tumble(book, "ob_ts", p["spoof_window_seconds"], p["spoof_slide_seconds"])
    order = F.struct("ob_ts", "book_id")
    o = o.groupBy(*KEY).agg(*[f(f"{s}_vol_1pct_usd").alias(f"{n}_{s}") for s in ("bid", "ask") for n, f in (("min", F.min), ("peak", F.max))], *[F.max_by(f"{s}_vol_1pct_usd", order).alias(f"final_{s}") for s in ("bid", "ask")])
    t = tumble(trades, "trade_ts", p["spoof_window_seconds"], p["spoof_slide_seconds"]).groupBy(*KEY).agg(F.sum(F.col("price") * F.col("quantity")).alias("traded"))
    j = o.join(t, KEY, "left").withColumn("traded", F.coalesce("traded", F.lit(0.0)))

    def fake(s: str) -> Column:
        low, peak, final = (F.col(f"{n}_{s}") for n in ("min", "peak", "final"))
        return (peak > low * p["spoof_multiplier"]) & (final < low * 1.5) & (F.col("traded") < (peak - low) * p["execution_threshold"])

    j = j.withColumn("_side", F.when(fake("bid"), "BID").when(fake("ask"), "ASK")).where("_side is not null")
    bid = F.col("_side") == "BID"
    w = with_context(j, sent, chain, Either(bid, F.col("funding_rate_pct") > 0.05, F.col("funding_rate_pct") < 0), Either(bid, F.col("tx_type") == "INFLOW", F.col("tx_type") == "OUTFLOW"), p)
    return _alert(w, "SPOOFING_DETECTED", F.col("_side"))


def mean_reversion(trades, book, p=DEFAULTS) -> DataFrame:
    """In a quiet market the price leaves its VWAP and meets a wall."""
    base = with_baseline(trades, "trade_ts", p["scalp_baseline_seconds"])
    w = tumble(base, "trade_ts", p["scalp_window_seconds"]).groupBy(*KEY).agg(F.max_by("price", F.struct("trade_ts", "trade_id")).alias("px"), F.sum("_usd").alias("vol"), F.max("_avg").alias("avg"), ieee_div(F.sum("_usd"), F.sum("quantity")).alias("vwap"))
    dev = ieee_div(F.col("px") - F.col("vwap"), F.col("vwap")) * 100
    w = w.withColumn("dev", dev).where((F.abs("dev") >= p["vwap_deviation_pct"]) & (F.col("vol") < F.col("avg") * p["max_chop_vol"]))
    m = p["reversion_wall_multiplier"]
    wall = Either(F.col("dev") > 0, F.col("ask_vol_1pct_usd") > F.col("bid_vol_1pct_usd") * m, F.col("bid_vol_1pct_usd") > F.col("ask_vol_1pct_usd") * m)
    w = near(w, book, "ob_ts", -p["book_seconds"], 0, "_wall", wall).where("_wall").withColumn("strong", F.lit(False))
    return _alert(w, "MICRO_MEAN_REVERSION", F.when(F.col("dev") > 0, "SHORT").otherwise("LONG"))


def order_flow_windows(book: DataFrame, p: dict) -> DataFrame:
    """First and last depth of each window; also runs as a stream."""
    order = F.struct("ob_ts", "book_id")
    ends = {f"{n}_{c}": f(v, order) for c, v in (("px", "best_bid_price"), ("bid", "bid_vol_1pct_usd"), ("ask", "ask_vol_1pct_usd")) for n, f in (("open", F.min_by), ("close", F.max_by))}
    w = book.groupBy(F.window("ob_ts", f"{p['ofi_window_seconds']} seconds").alias("_w"), "symbol").agg(*[c.alias(n) for n, c in ends.items()])
    w = w.select("symbol", F.col("_w.end").alias("event_time"), (F.col("close_bid") - F.col("open_bid")).alias("bid_delta"), (F.col("close_ask") - F.col("open_ask")).alias("ask_delta"), (ieee_div(F.col("close_px") - F.col("open_px"), F.col("open_px")) * 100).alias("move_pct"))
    most, flat = p["ofi_delta_usd_threshold"], p.get("ofi_flat_pct", 0.1)
    down = (F.col("bid_delta") <= -most) & (F.col("ask_delta") >= most)
    up = (F.col("bid_delta") >= most) & (F.col("ask_delta") <= -most)
    return w.where(F.abs("move_pct") < flat).withColumn("_side", F.when(down, "SELL").when(up, "BUY")).where("_side is not null")


def order_flow(book, sent, chain, p=DEFAULTS) -> DataFrame:
    """Depth moves from one side to the other while the price stands."""
    flow = Either(F.col("_side") == "SELL", F.col("tx_type") == "INFLOW", F.col("tx_type") == "OUTFLOW")
    w = with_context(order_flow_windows(book, p), sent, chain, F.col("oi_delta_pct") > 1.0, flow, p)
    return _alert(w, "ORDER_FLOW_IMBALANCE", F.col("_side"))


def lead_lag(trades, sent, chain, leader: str, lagger: str, p=DEFAULTS) -> DataFrame:
    """The leader moves in a window, the lagger hasn't yet."""
    first, last = _first_last("price", "trade_ts", "trade_id")
    w = tumble(trades.where(F.col("symbol").isin(leader, lagger)), "trade_ts", p["lead_lag_window_seconds"]).groupBy(*KEY).agg(first.alias("o"), last.alias("c")).withColumn("chg", ieee_div(F.col("c") - F.col("o"), F.col("o")) * 100)
    led = w.where(F.col("symbol") == leader).select("event_time", F.col("chg").alias("lead_chg"))
    j = w.where(F.col("symbol") == lagger).join(led, "event_time")
    move, late = p["leader_move_pct"], p["lagger_delay_pct"]
    side = F.when((F.col("lead_chg") <= -move) & (F.col("chg") > -late), "SHORT").when((F.col("lead_chg") >= move) & (F.col("chg") < late), "LONG")
    j = j.withColumn("_side", side).where("_side is not null")
    short = F.col("_side") == "SHORT"
    j = with_context(j, sent, chain, Either(short, F.col("funding_rate_pct") > 0.05, F.col("funding_rate_pct") < 0), Either(short, F.col("tx_type") == "INFLOW", F.col("tx_type") == "OUTFLOW"), p)
    return _alert(j, "LEAD_LAG_ARBITRAGE", F.col("_side"))
