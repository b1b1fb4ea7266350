"""Batch forms of the streaming work: candles, dead letters and the eight alerts, at the stand-ins' pace."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.plans.registry import query
from tapeloom.plans.standins import table, view
from tapeloom.streaming import alerts, pipelines

#: The stand-in streams have an event every few minutes, so windows are hours and thresholds are wide.
P = alerts.DEFAULTS | {
    "window_seconds": 7200, "liq_multiplier": 0.2, "bid_wall_multiplier": 1.5, "whale_multiplier": 0.5, "pump_window_seconds": 7200, "pump_price_pct": 1.5, "max_pump_vol_multiplier": 3.0, "ask_bid_imbalance": 1.5, "min_vol_multiplier": 1.0, "bid_ask_imbalance": 1.5,
    "spoof_window_seconds": 7200, "spoof_slide_seconds": 3600, "spoof_multiplier": 1.5, "execution_threshold": 0.9, "cascade_window_seconds": 7200, "cascade_liq_multiplier": 0.5, "min_base_liq_usd": 10.0, "liquidity_ratio": 0.5, "lead_lag_window_seconds": 10800,
    "leader_move_pct": 0.5, "lagger_delay_pct": 5.0, "ofi_window_seconds": 14400, "ofi_delta_usd_threshold": 5.0, "ofi_flat_pct": 60.0, "scalp_window_seconds": 7200, "max_chop_vol": 20.0, "vwap_deviation_pct": 0.15, "reversion_wall_multiplier": 1.1,
    "baseline_seconds": 86400, "scalp_baseline_seconds": 172800, "book_seconds": 14400, "sentiment_seconds": 172800, "chain_seconds": 172800,
}


def _s(seconds: int) -> str:
    return f"(interval 1 second * {int(seconds)})"


def _end(ts: str, seconds: int) -> str:
    return f"time_bucket({_s(seconds)}, {ts}, timestamp '1970-01-01') + {_s(seconds)}"


def _any(view_: str, ts: str, low: int, high: int, cond: str) -> str:
    return f"exists (select 1 from {view_} x where x.symbol = w.symbol and x.{ts} >= w.event_time + {_s(low)} and x.{ts} <= w.event_time + {_s(high)} and ({cond}))"


def _context(sentiment: str, flow: str) -> str:
    return f"{_any('v_s_sent', 'sent_ts', -P['sentiment_seconds'], 0, sentiment)} and {_any('v_s_chain', 'chain_ts', -P['chain_seconds'], 0, flow)}"


def _book(cond: str, high: int = 0) -> str:
    return _any("v_s_book", "ob_ts", -P["book_seconds"], high, cond)


def _baseline(view_: str, ts: str, seconds: int, where: str = "true") -> str:
    return f"select *, price * quantity as usd, avg(price * quantity) over (partition by symbol order by {ts} range between {_s(seconds)} preceding and current row) as base from {view_} where {where}"


PUMPS = f"""with b as ({_baseline("v_s_trades", "trade_ts", P["baseline_seconds"])}),
  g as (select symbol, {_end("trade_ts", P["pump_window_seconds"])} as event_time, arg_min(price, (trade_ts, trade_id)) as o, arg_max(price, (trade_ts, trade_id)) as c, sum(usd) as vol, max(base) as base from b group by 1, 2),
  w as (select *, (c - o) / o * 100 as move from g)"""
LIQS = f"""with b as ({_baseline("v_s_liq", "liq_ts", P["baseline_seconds"], "side = 'SELL'")}), w as (select symbol, {_end("liq_ts", P["window_seconds"])} as event_time, sum(usd) as liq, max(base) as base from b group by 1, 2)"""
BUYS = f"""t as ({_baseline("v_s_trades", "trade_ts", P["baseline_seconds"])}), y as (select symbol, {_end("trade_ts", P["window_seconds"])} as buy_time, sum(usd) as buy, max(base) as base from t group by 1, 2)"""
HEAD = "symbol, event_time, {strong} as strong, {side} as side from w where {where}"


def _sql(views: str, kind: str, strong: str, where: str, side: str = "cast(null as varchar)") -> str:
    return f"{views} select '{kind}' as alert_type, " + HEAD.format(strong=strong, side=side, where=where)


def register(name: str, sql: str, run: Callable[..., DataFrame], *inputs: str) -> None:
    query(name, sql)(lambda spark, sf_dir: run(*[view(spark, sf_dir, i) for i in inputs], p=P))


register(
    "t08_bull_trap",
    _sql(PUMPS, "BULL_TRAP", _context("funding_rate_pct > 0.05 and oi_delta_pct > 1.0", "tx_type = 'INFLOW'"), f"move > {P['pump_price_pct']} and vol < base * {P['max_pump_vol_multiplier']} and {_book(f'ask_vol_1pct_usd > bid_vol_1pct_usd * {P["ask_bid_imbalance"]}')}"),
    alerts.bull_trap, "v_s_trades", "v_s_book", "v_s_sent", "v_s_chain",
)
register(
    "t09_true_breakout",
    _sql(PUMPS, "TRUE_BREAKOUT", _context("funding_rate_pct < 0 and oi_delta_pct > 1.0", "tx_type = 'OUTFLOW'"), f"move > {P['pump_price_pct']} and vol > base * {P['min_vol_multiplier']} and {_book(f'bid_vol_1pct_usd > ask_vol_1pct_usd * {P["bid_ask_imbalance"]}')}"),
    alerts.true_breakout, "v_s_trades", "v_s_book", "v_s_sent", "v_s_chain",
)
query(
    "t10_bottom_catcher",
    _sql(
        f"{LIQS}, {BUYS}", "BOTTOM_CATCHER", _context("funding_rate_pct < 0", "tx_type = 'OUTFLOW'"),
        f"liq > greatest(base, 100) * {P['liq_multiplier']} and exists (select 1 from y where y.symbol = w.symbol and y.buy_time >= w.event_time and y.buy_time <= w.event_time + {_s(2 * P['window_seconds'])} and y.buy > y.base * {P['whale_multiplier']}) and {_book(f'bid_vol_1pct_usd > ask_vol_1pct_usd * {P["bid_wall_multiplier"]}', P['book_seconds'])}",
    ),
)(lambda spark, sf_dir: alerts.bottom_catcher(*[view(spark, sf_dir, v) for v in ("v_s_trades", "v_s_book", "v_s_liq", "v_s_sent", "v_s_chain")], p=P, floor_usd=100.0))

SPOOF = f"""with hops as (select 0 as k union all select 1), o as (select symbol, {_end("ob_ts", P["spoof_slide_seconds"])} + k * {_s(P["spoof_slide_seconds"])} as event_time, min(bid_vol_1pct_usd) as nb, max(bid_vol_1pct_usd) as pb, arg_max(bid_vol_1pct_usd, (ob_ts, book_id)) as fb,
    min(ask_vol_1pct_usd) as na, max(ask_vol_1pct_usd) as pa, arg_max(ask_vol_1pct_usd, (ob_ts, book_id)) as fa from v_s_book, hops group by 1, 2),
  t as (select symbol, {_end("trade_ts", P["spoof_slide_seconds"])} + k * {_s(P["spoof_slide_seconds"])} as event_time, sum(price * quantity) as traded from v_s_trades, hops group by 1, 2),
  j as (select o.*, coalesce(traded, 0) as tr from o left join t on t.symbol = o.symbol and t.event_time = o.event_time),
  w as (select *, case when pb > nb * {P["spoof_multiplier"]} and fb < nb * 1.5 and tr < (pb - nb) * {P["execution_threshold"]} then 'BID' when pa > na * {P["spoof_multiplier"]} and fa < na * 1.5 and tr < (pa - na) * {P["execution_threshold"]} then 'ASK' end as s from j)"""
register(
    "t11_spoofing",
    _sql(SPOOF, "SPOOFING_DETECTED", _context("case when w.s = 'BID' then funding_rate_pct > 0.05 else funding_rate_pct < 0 end", "case when w.s = 'BID' then tx_type = 'INFLOW' else tx_type = 'OUTFLOW' end"), "s is not null", "s"),
    alerts.spoofing, "v_s_trades", "v_s_book", "v_s_sent", "v_s_chain",
)
SCALP = f"""with b as ({_baseline("v_s_trades", "trade_ts", P["scalp_baseline_seconds"])}), g as (select symbol, {_end("trade_ts", P["scalp_window_seconds"])} as event_time, arg_max(price, (trade_ts, trade_id)) as px, sum(usd) as vol, max(base) as base, sum(usd) / sum(quantity) as vwap from b group by 1, 2), w as (select *, (px - vwap) / vwap * 100 as dev from g)"""
register(
    "t12_mean_reversion",
    _sql(SCALP, "MICRO_MEAN_REVERSION", "false", f"abs(dev) >= {P['vwap_deviation_pct']} and vol < base * {P['max_chop_vol']} and {_book(f'case when w.dev > 0 then ask_vol_1pct_usd > bid_vol_1pct_usd * {P["reversion_wall_multiplier"]} else bid_vol_1pct_usd > ask_vol_1pct_usd * {P["reversion_wall_multiplier"]} end')}", "case when dev > 0 then 'SHORT' else 'LONG' end"),
    alerts.mean_reversion, "v_s_trades", "v_s_book",
)
OFI = f"""with g as (select symbol, {_end("ob_ts", P["ofi_window_seconds"])} as event_time, arg_min(best_bid_price, (ob_ts, book_id)) as o, arg_max(best_bid_price, (ob_ts, book_id)) as c, arg_max(bid_vol_1pct_usd, (ob_ts, book_id)) - arg_min(bid_vol_1pct_usd, (ob_ts, book_id)) as bd,
    arg_max(ask_vol_1pct_usd, (ob_ts, book_id)) - arg_min(ask_vol_1pct_usd, (ob_ts, book_id)) as ad from v_s_book group by 1, 2), w as (select *, case when bd <= -{P["ofi_delta_usd_threshold"]} and ad >= {P["ofi_delta_usd_threshold"]} then 'SELL' when bd >= {P["ofi_delta_usd_threshold"]} and ad <= -{P["ofi_delta_usd_threshold"]} then 'BUY' end as s from g)"""
register(
    "t13_order_flow",
    _sql(OFI, "ORDER_FLOW_IMBALANCE", _context("oi_delta_pct > 1.0", "case when w.s = 'SELL' then tx_type = 'INFLOW' else tx_type = 'OUTFLOW' end"), f"abs((c - o) / o * 100) < {P['ofi_flat_pct']} and s is not null", "s"),
    alerts.order_flow, "v_s_book", "v_s_sent", "v_s_chain",
)
register(
    "t14_liquidation_cascade",
    _sql(LIQS.replace(_s(P["window_seconds"]), _s(P["cascade_window_seconds"])), "LIQUIDATION_CASCADE", _context("funding_rate_pct > 0.05", "tx_type = 'INFLOW'"), f"liq > greatest(base, {P['min_base_liq_usd']}) * {P['cascade_liq_multiplier']} and {_book(f'w.liq > bid_vol_1pct_usd * {P["liquidity_ratio"]}')}"),
    alerts.liquidation_cascade, "v_s_book", "v_s_liq", "v_s_sent", "v_s_chain",
)
LAG = f"""with g as (select symbol, {_end("trade_ts", P["lead_lag_window_seconds"])} as event_time, arg_min(price, (trade_ts, trade_id)) as o, arg_max(price, (trade_ts, trade_id)) as c from v_s_trades group by 1, 2),
  w as (select f.symbol, f.event_time, case when (l.c - l.o) / l.o * 100 <= -{P["leader_move_pct"]} and (f.c - f.o) / f.o * 100 > -{P["lagger_delay_pct"]} then 'SHORT' when (l.c - l.o) / l.o * 100 >= {P["leader_move_pct"]} and (f.c - f.o) / f.o * 100 < {P["lagger_delay_pct"]} then 'LONG' end as s
    from g f join g l on l.event_time = f.event_time and l.symbol = 'S0' where f.symbol = 'S1')"""
query("t15_lead_lag", _sql(LAG, "LEAD_LAG_ARBITRAGE", _context("case when w.s = 'SHORT' then funding_rate_pct > 0.05 else funding_rate_pct < 0 end", "case when w.s = 'SHORT' then tx_type = 'INFLOW' else tx_type = 'OUTFLOW' end"), "s is not null", "s"))(
    lambda spark, sf_dir: alerts.lead_lag(*[view(spark, sf_dir, v) for v in ("v_s_trades", "v_s_sent", "v_s_chain")], leader="S0", lagger="S1", p=P)
)


@query(
    "t01_candles",
    """select symbol, time_bucket(interval 1 minute, trade_ts) as window_start, time_bucket(interval 1 minute, trade_ts) + interval 1 minute as window_end, arg_max(trade_id, (trade_ts, trade_id)) as trade_id, arg_min(price, (trade_ts, trade_id)) as open_price, max(price) as high_price, min(price) as low_price,
      arg_max(price, (trade_ts, trade_id)) as close_price, sum(quantity) as volume, sum(price * quantity) / sum(quantity) as vwap from v_trades group by symbol, time_bucket(interval 1 minute, trade_ts)""",
    "open_price high_price low_price close_price volume vwap",
    9,
)
def candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pipelines.candles(view(spark, sf_dir, "v_trades"))


@query(
    "t03_dead_letters",
    """select 'orders' as source_name, count(*) as dead_rows, count(distinct o_custkey) as customers from orders where o_totalprice <= 50000 or o_orderpriority is null""",
)
def dead_letters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule split with reason and JSON payload; here the dead letters are parsed again and counted."""
    _, letters = pipelines.route_dead_letters(table(spark, sf_dir, "orders").select("o_custkey", "o_totalprice", "o_orderpriority"), "orders", "o_totalprice <= 50000 or o_orderpriority is null", "price too low or no priority")
    return letters.groupBy("source_name").agg(F.count(F.lit(1)).alias("dead_rows"), F.count_distinct(F.get_json_object("raw_payload", "$.o_custkey")).alias("customers"))


@query(
    "t16_symbol_params",
    "select trade_id, symbol, case when symbol = 'view' then 0.8 else 1.5 end as pump_price_pct, price > 100 * case when symbol = 'view' then 0.8 else 1.5 end as over_limit from v_trades",
    "pump_price_pct",
)
def symbol_params(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Thresholds by symbol with a default row."""
    params = spark.createDataFrame([("default", 1.5), ("view", 0.8)], "symbol string, pump_price_pct double")
    df = alerts.with_params(view(spark, sf_dir, "v_trades"), params, ["pump_price_pct"])
    return df.select("trade_id", "symbol", "pump_price_pct", (F.col("price") > F.lit(100) * F.col("pump_price_pct")).alias("over_limit"))


@query(
    "t18_first_in_watermark",
    """select symbol, bucket, min(trade_id) as trade_id from (select symbol, time_bucket(interval 10 minute, trade_ts) as bucket, trade_id from v_s_trades) x group by 1, 2""",
)
def first_in_bucket(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One alert a key whatever the repeats; here the first trade of each symbol and ten minutes."""
    df = view(spark, sf_dir, "v_s_trades").withColumn("bucket", F.window("trade_ts", "10 minutes")["start"])
    return df.groupBy("symbol", "bucket").agg(F.min("trade_id").alias("trade_id"))


@query(
    "m59_oi_delta",
    "select sent_id, symbol, (oi - lag(oi) over w) / nullif(lag(oi) over w, 0) * 100 as oi_delta_pct from (select *, oi_delta_pct + 10 as oi from v_s_sent) x window w as (partition by symbol order by sent_ts)",
    "oi_delta_pct",
)
def oi_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = view(spark, sf_dir, "v_s_sent").withColumn("open_interest", F.col("oi_delta_pct") + 10).drop("oi_delta_pct")
    return pipelines.oi_delta(df).select("sent_id", "symbol", "oi_delta_pct")


@query(
    "m58_transfer_classes",
    "select o_orderkey, case when c_custkey % 7 = 0 then 'INFLOW' when c_custkey % 11 = 0 then 'OUTFLOW' else 'WALLET_TO_WALLET' end as tx_type from orders left join customer on o_custkey = c_custkey where o_totalprice >= 100000",
)
def transfer_classes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transfers of a least size by whether an exchange's wallet receives or sends."""
    o = table(spark, sf_dir, "orders").where("o_totalprice >= 100000")
    known = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("wallet"))
    kinds = known.select("wallet", F.when(F.col("wallet") % 7 == 0, "INFLOW").when(F.col("wallet") % 11 == 0, "OUTFLOW").alias("kind")).where("kind is not null")
    j = o.join(kinds, F.col("o_custkey") == F.col("wallet"), "left")
    return j.select("o_orderkey", F.coalesce("kind", F.lit("WALLET_TO_WALLET")).alias("tx_type"))


@query(
    "m57_book_depth",
    """with l as (select o_custkey, list((o_totalprice, o_orderkey % 9 + 1)) as levels, max(o_totalprice) as best from orders group by 1)
      select o_custkey, list_sum(list_transform(list_filter(levels, lambda x: x[1] >= best * 0.9), lambda x: x[1] * x[2])) as depth_usd, len(levels) as level_count from l""",
    "depth_usd",
    2,
)
def book_depth(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value within a share of the best price, from arrays of price levels."""
    levels = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.collect_list(F.struct(F.col("o_totalprice").alias("px"), (F.col("o_orderkey") % 9 + 1).cast("double").alias("qty"))).alias("levels"), F.max("o_totalprice").alias("best"))
    inside = F.filter("levels", lambda x: x["px"] >= F.col("best") * 0.9)
    return levels.select("o_custkey", F.aggregate(inside, F.lit(0.0), lambda a, x: a + x["px"] * x["qty"]).alias("depth_usd"), F.size("levels").cast("long").alias("level_count"))


@query(
    "m45_recent_alert_candles",
    """with a as (select liq_id, symbol, liq_ts from v_s_liq), c as (select symbol, time_bucket(interval 1 hour, trade_ts) as s, time_bucket(interval 1 hour, trade_ts) + interval 1 hour as e, avg(price) as mean_price from v_s_trades group by 1, 2, 3)
      select liq_id, s as candle_start, mean_price from a join c on a.symbol = c.symbol and a.liq_ts >= c.s and a.liq_ts <= c.e""",
    "mean_price",
)
def alert_candles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The candles within which an alert falls (ends included)."""
    from tapeloom.operators.joins import point_in_interval

    w = F.window("trade_ts", "1 hour")
    c = view(spark, sf_dir, "v_s_trades").groupBy("symbol", w.alias("w")).agg(F.avg("price").alias("mean_price")).select("symbol", F.col("w.start").alias("candle_start"), F.col("w.end").alias("candle_end"), "mean_price")
    met = point_in_interval(view(spark, sf_dir, "v_s_liq"), c, ["symbol"], "liq_ts", "candle_start", "candle_end", "hour")
    return met.select("liq_id", "candle_start", "mean_price")

