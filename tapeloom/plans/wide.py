"""Wide hourly features, the core fact and what is read from it.

Formulas are SQL text that both engines read. Weights, thresholds and labels are fixed values.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.functions import columns as C
from tapeloom.operators import alerts, dedupe, joins
from tapeloom.plans import legs
from tapeloom.plans.market import TRADES_HOURLY_SQL, trades_hourly
from tapeloom.plans.registry import added, added_sql, doubles_of, duck, grouped, grouped_sql, query
from tapeloom.plans.standins import view

FUNDING = {
    "funding_exchange_count": "count(*)", "avg_basis_pct": "avg(basis_pct)", "max_abs_basis_pct": "max(abs(basis_pct))", "avg_funding_rate_coin": "avg(funding_rate_coin)", "avg_funding_rate_usdt": "avg(funding_rate_coin * 0.9e0)", "avg_annualized_funding_coin": "avg(funding_rate_coin) * 1095",
    "avg_annualized_funding_usdt": "avg(funding_rate_coin * 0.9e0) * 1095", "funding_dispersion_coin": "stddev_samp(funding_rate_coin)", "avg_arbitrage_spread": "avg(arbitrage_spread)", "max_abs_arbitrage_spread": "max(abs(arbitrage_spread))", "max_leverage_stress": "max(leverage_stress)", "avg_leverage_stress": "avg(leverage_stress)",
}
FUNDING_SQL = grouped_sql("(select * from (select *, cast(date_trunc('hour', observed_at) as timestamp) as hour_ts, row_number() over (partition by date_trunc('hour', observed_at), exchange, symbol order by observed_at desc, obs_id desc) as rn from v_funding) x where rn = 1) o", ["hour_ts", "symbol"], FUNDING)

MARKET = ("open_price", "high_price", "low_price", "close_price", "vwap_price", "base_volume", "quote_volume", "taker_buy_quote_volume", "taker_sell_quote_volume", "taker_buy_quote_ratio", "return_1h", "log_return_1h", "quote_volume_24h", "avg_return_24h", "realized_volatility_24h", "quote_volume_zscore_24h")
_MACRO = [f"{t}_return_{n}d" for n in (1, 5, 10) for t in ("sp500", "nasdaq", "gold", "vix", "oil")] + list(legs.MACRO)
_ETF = ["btc_etf_volume", "eth_etf_volume", "total_etf_volume", "btc_etf_volume_share", "eth_etf_volume_share", *(f"{g}_etf_volume_weighted_return_{n}d" for n in (1, 5) for g in ("btc", "eth", "total")), "btc_etf_flow_proxy", "eth_etf_flow_proxy", "total_etf_flow_proxy", "ibit_return_1d", "etha_return_1d", "feth_return_1d", "most_active_etf", "most_active_etf_group", "most_active_etf_return_1d", *legs.ETF]
#: A daily row is known from half past five on the day after, and used for three weeks.
_KNOWN, _STALE = "interval '1' day + interval '330' minute", 21

_Z = lambda x: f"coalesce({x}, 0)"
COMPOSITE = {
    "sentiment_volume_pressure": f"{_Z('social_weighted_avg_sentiment')} * {_Z('quote_volume_zscore_24h')}", "funding_sentiment_alignment": f"{_Z('avg_annualized_funding_coin')} * {_Z('social_weighted_avg_sentiment')}",
    "systemic_crypto_stress_score": f"{_Z('max_leverage_stress')} + {_Z('max_depeg_risk_score')} + {_Z('high_bank_run_risk_exchange_count')}", "raw_derivatives_risk_score": f"{_Z('realized_volatility_24h')} + abs({_Z('avg_funding_rate_coin')}) + abs({_Z('net_long_short_liq_ratio')})",
    "composite_market_regime": f"""case when {_Z('social_weighted_avg_sentiment')} > 0.1 and {_Z('avg_annualized_funding_coin')} > 2 and {_Z('taker_buy_quote_ratio')} > 0.55 then 'BULLISH_MOMENTUM' when {_Z('social_weighted_avg_sentiment')} < -0.1 and {_Z('avg_annualized_funding_coin')} < -2 and {_Z('taker_buy_quote_ratio')} < 0.45 then 'BEARISH_PRESSURE'
        when {_Z('max_leverage_stress')} > 20 or {_Z('max_panic_norm')} > 0.8 or {_Z('high_bank_run_risk_exchange_count')} > 0 then 'STRESS_RISK' when macro_risk_regime = 'RISK_OFF' and {_Z('social_weighted_avg_sentiment')} < 0 then 'MACRO_RISK_OFF' else 'NEUTRAL' end""",
    "feature_available_at": "greatest(available_at, coalesce(macro_at, available_at), coalesce(etf_at, available_at))",
}


def daily_known(hours: DataFrame, daily: DataFrame, values: list[str], tag: str) -> DataFrame:
    """Daily rows as they were known at each of the distinct hours; both sides have a row a period, so the one window is small."""
    known = daily.select((F.col("price_date").cast("timestamp_ntz") + F.expr(_KNOWN)).alias(f"{tag}_at"), F.col("price_date").alias(f"{tag}_date"), *values)
    met = joins.asof_join(hours, known, [], "hour_ts", f"{tag}_at", [f"{tag}_date"], [f"{tag}_date", *values])
    fresh = F.col(f"{tag}_date") >= F.date_sub(F.to_date("hour_ts"), _STALE)
    return met.select(*hours.columns, *[F.when(fresh, F.col(c)).alias(c) for c in (f"{tag}_at", f"{tag}_date", *values)])


def wide_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The market's hours with every leg, by hour and symbol, by hour, or as the day was known."""
    funding = grouped(dedupe.latest_per_hour(view(spark, sf_dir, "v_funding"), "observed_at", ["exchange", "symbol"], [F.col("observed_at"), F.col("obs_id")]), ["hour_ts", "symbol"], FUNDING)
    market = trades_hourly(view(spark, sf_dir, "v_trades"))
    out = market
    for leg in (funding, legs.liquidation_hourly(spark, sf_dir), legs.options_hourly(spark, sf_dir), legs.social_hourly(spark, sf_dir)):
        out = out.join(leg, ["hour_ts", "symbol"], "left")
    for leg in (legs.stablecoin_hourly(spark, sf_dir), legs.reserve_hourly(spark, sf_dir)):
        out = out.join(leg, ["hour_ts"], "left")
    # the rows of all symbols meet the days through their distinct hours, which are joined once
    context = daily_known(market.select("hour_ts").distinct(), legs.macro_features(spark, sf_dir), _MACRO, "macro")
    context = daily_known(context, legs.etf_features(spark, sf_dir), _ETF, "etf")
    return added(out.join(context, "hour_ts", "left"), COMPOSITE)


def _asof_sql(daily: str, values: list[str], tag: str) -> str:
    return f"""select h.hour_ts, q.* from (select distinct hour_ts from m) h left join lateral (select cast(price_date as timestamp) + {_KNOWN} as {tag}_at, price_date as {tag}_date, {', '.join(values)} from ({daily}) d
      where cast(price_date as timestamp) + {_KNOWN} <= h.hour_ts and price_date >= cast(h.hour_ts as date) - {_STALE} order by price_date desc limit 1) q on true"""


WIDE_SQL = f"""with m as ({TRADES_HOURLY_SQL}), f as ({FUNDING_SQL}), l as ({legs.LIQUIDATION_SQL}), o as ({legs.OPTIONS_SQL}), s as ({legs.SOCIAL_SQL}), st as ({legs.STABLE_SQL}), rs as ({legs.RESERVE_SQL}), ma as ({_asof_sql(legs.MACRO_SQL, _MACRO, 'macro')}), ea as ({_asof_sql(legs.ETF_SQL, _ETF, 'etf')}),
  j as (select * from m left join f using (hour_ts, symbol) left join l using (hour_ts, symbol) left join o using (hour_ts, symbol) left join s using (hour_ts, symbol) left join st using (hour_ts) left join rs using (hour_ts) left join ma using (hour_ts) left join ea using (hour_ts))
  {added_sql('j', COMPOSITE)}"""
#: Columns of the wide table that are shown; all its legs have queries of their own.
_SHOWN = ["hour_ts", "symbol", "close_price", "trade_count", *FUNDING, "total_liq_usd", "top_squeeze_signal", "put_call_oi_ratio", "gamma_exposure_proxy", "social_item_count", "social_weighted_avg_sentiment", "total_stablecoin_market_cap_usd", "reserve_hhi", "macro_date", *_MACRO, "etf_date", *_ETF, *COMPOSITE]
_SHOWN_DOUBLES = doubles_of(dict.fromkeys(c for c in _SHOWN if c not in ("hour_ts", "symbol")))
query("m16_wide_features", f"select {', '.join(_SHOWN)} from ({WIDE_SQL}) w", _SHOWN_DOUBLES, 7)(lambda spark, sf_dir: wide_features(spark, sf_dir).select(*_SHOWN))

_CLAMP = lambda low, x: f"greatest({low}, least(100, {x}))"
SCORES = {
    "market_momentum_score": _CLAMP(-100, f"{_Z('return_1h')} * 500 + {_Z('avg_return_24h')} * 300 + {_Z('quote_volume_zscore_24h')} * 5"), "social_sentiment_score": _CLAMP(-100, f"{_Z('social_weighted_avg_sentiment')} * 100"),
    "derivatives_risk_score": _CLAMP(0, f"{_Z('abs(avg_annualized_funding_coin)')} * 1.2e0 + {_Z('abs(avg_basis_pct)')} * 2 + {_Z('max_leverage_stress')} * 0.5e0 + {_Z('avg_panic_norm')} * 25 + {_Z('abs(max_magnet_norm)')} * 10 + {_Z('put_call_oi_ratio')} * 5"),
    "liquidity_risk_score": _CLAMP(0, f"{_Z('max_abs_peg_deviation_pct')} * 15 + {_Z('max_depeg_risk_score')} * 20 + {_Z('normalized_system_reserve_utilization')} * 25 + {_Z('high_bank_run_risk_exchange_count')} * 10"),
    "macro_risk_score": _CLAMP(0, f"case coalesce(macro_risk_regime, 'NEUTRAL') when 'RISK_OFF' then 75 when 'DEFENSIVE' then 55 when 'RISK_ON' then 20 else 40 end + {_Z('vix_return_1d')} * 100e0 - {_Z('sp500_return_1d')} * 50e0"),
}
OVERALL = {"overall_risk_score": _CLAMP(0, "derivatives_risk_score * 0.40e0 + liquidity_risk_score * 0.25e0 + macro_risk_score * 0.25e0 + greatest(0, -social_sentiment_score) * 0.10e0")}
CLASSES = {
    "market_regime": f"""case when close_price is null then 'NO_PRICE' when derivatives_risk_score >= 75 or liquidity_risk_score >= 75 then 'SYSTEM_RISK' when coalesce(macro_risk_regime, 'NEUTRAL') = 'RISK_OFF' and {_Z('return_1h')} < 0 then 'RISK_OFF_SELL_PRESSURE'
        when market_momentum_score >= 20 and social_sentiment_score >= 10 and macro_risk_score < 60 then 'BULLISH_RISK_ON' when market_momentum_score <= -20 and social_sentiment_score <= -10 then 'BEARISH_MOMENTUM' when {_Z('abs(avg_annualized_funding_coin)')} >= 10 or {_Z('max_leverage_stress')} >= 10 then 'LEVERAGE_CROWDED' else 'NEUTRAL' end""",
    "core_signal": """case when close_price is null then 'NO_SIGNAL' when derivatives_risk_score >= 80 or liquidity_risk_score >= 80 then 'REDUCE_RISK' when market_momentum_score >= 25 and social_sentiment_score >= 15 and overall_risk_score < 60 then 'BULLISH'
        when market_momentum_score <= -25 or social_sentiment_score <= -25 then 'BEARISH' else 'NEUTRAL' end""",
    "is_ml_feature_eligible": "close_price is not null and return_1h is not null and feature_available_at is not null", "is_dashboard_ready": "close_price is not null and feature_available_at is not null",
}


def core_fact(features: DataFrame) -> DataFrame:
    """Clamped scores, overall risk, regime, signal and flags, beside all features."""
    out = added(added(added(features, SCORES), OVERALL), CLASSES)
    return out.withColumns({"crypto_feature_sk": C.surrogate_key(F.date_format("hour_ts", "yyyy-MM-dd HH:mm:ss"), F.col("symbol")), "feature_date": F.to_date("hour_ts"), "feature_latency_minutes": F.timestamp_diff("MINUTE", F.col("hour_ts"), F.col("feature_available_at"))})


def fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    return core_fact(wide_features(spark, sf_dir))


CORE_SQL = f"""select *, md5(strftime(hour_ts, '%Y-%m-%d %H:%M:%S') || '|' || symbol) as crypto_feature_sk, cast(hour_ts as date) as feature_date, date_diff('second', hour_ts, feature_available_at) // 60 as feature_latency_minutes
  from ({added_sql(f'({added_sql(f"({added_sql(f"({WIDE_SQL}) w0", SCORES)}) w1", OVERALL)}) w2', CLASSES)}) w3"""
_CORE = ["crypto_feature_sk", "hour_ts", "feature_date", "symbol", "feature_available_at", "feature_latency_minutes", "close_price", *SCORES, *OVERALL, *CLASSES, "max_abs_peg_deviation_pct", "worst_peg_symbol", "macro_risk_regime", "top_squeeze_signal", "high_bank_run_risk_exchange_count"]
_SCORE_DOUBLES = doubles_of(SCORES, OVERALL)


def _from_core(name: str, keep: list[str], *steps: dict[str, str], doubles: str = "", digits: int = 7) -> None:
    """Register what is the core fact with columns added step by step, of which ``keep`` and the added ones are shown."""
    sql = f"({CORE_SQL}) c"
    for step in steps:
        sql = f"({added_sql(sql, step)}) c"
    shown = [*keep, *(n for s in steps for n in s if not n.startswith("_"))]

    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        out = fact(spark, sf_dir)
        for step in steps:
            out = added(out, step)
        return out.select(*shown)

    query(name, f"select {', '.join(shown)} from {sql}", doubles or doubles_of(*(dict.fromkeys(c for c in x if not c.startswith("_")) for x in steps)), digits)(run)


query("m17_core_fact", f"select {', '.join(_CORE)} from ({CORE_SQL}) c", f"close_price max_abs_peg_deviation_pct {_SCORE_DOUBLES}", 7)(lambda spark, sf_dir: fact(spark, sf_dir).select(*_CORE))

_KEYS = ["hour_ts", "symbol"]
_BAND = lambda x, *cases, otherwise: f"case {' '.join(f'when {_Z(x)} {c} then {v!r}' for c, v in cases)} else {otherwise!r} end"
OVERVIEW = {
    "intrahour_return": "(close_price - open_price) / nullif(open_price, 0)", "intrahour_range_pct": "(high_price - low_price) / nullif(open_price, 0)", "close_vwap_deviation_pct": "(close_price - vwap_price) / nullif(vwap_price, 0)",
    "taker_imbalance": "(taker_buy_quote_volume - taker_sell_quote_volume) / nullif(taker_buy_quote_volume + taker_sell_quote_volume, 0)", "candle_direction": "case when close_price > open_price then 'GREEN' when close_price < open_price then 'RED' else 'FLAT' end",
    "volume_regime": _BAND("quote_volume_zscore_24h", (">= 3", "EXTREME_VOLUME"), (">= 2", "HIGH_VOLUME"), ("<= -2", "LOW_VOLUME"), otherwise="NORMAL_VOLUME"),
    "volatility_regime": _BAND("realized_volatility_24h", (">= 0.08", "EXTREME_VOLATILITY"), (">= 0.04", "HIGH_VOLATILITY"), ("<= 0.01", "LOW_VOLATILITY"), otherwise="NORMAL_VOLATILITY"),
    "momentum_regime": _BAND("market_momentum_score", (">= 30", "STRONG_UP"), (">= 10", "UP"), ("<= -30", "STRONG_DOWN"), ("<= -10", "DOWN"), otherwise="SIDEWAYS"),
    "risk_regime": _BAND("overall_risk_score", (">= 80", "CRITICAL_RISK"), (">= 65", "HIGH_RISK"), (">= 45", "MEDIUM_RISK"), otherwise="LOW_RISK"),
}
_from_core("m22_overview_regimes", _KEYS, OVERVIEW)
_PUTS = lambda puts, calls, otherwise: f"case when {_Z('put_call_oi_ratio')} >= 1.5 then '{puts}' when {_Z('put_call_oi_ratio')} > 0 and {_Z('put_call_oi_ratio')} <= 0.6 then '{calls}' else '{otherwise}' end"
_PART = lambda a, b: f"{_Z(a)} / nullif({_Z(a)} + {_Z(b)}, 0)"
DERIVATIVES = {
    "funding_bias_label": _BAND("avg_annualized_funding_coin", (">= 10", "EXTREME_LONG_CROWDING"), (">= 2", "LONG_BIAS"), ("<= -10", "EXTREME_SHORT_CROWDING"), ("<= -2", "SHORT_BIAS"), otherwise="NEUTRAL_FUNDING"),
    "options_positioning_label": _PUTS("PUT_HEAVY_DEFENSIVE", "CALL_HEAVY_RISK_ON", "BALANCED_OPTIONS"), "liquidation_pressure_label": _BAND("net_long_short_liq_ratio", (">= 0.35", "LONG_LIQUIDATION_DOMINANT"), ("<= -0.35", "SHORT_LIQUIDATION_DOMINANT"), otherwise="BALANCED_LIQUIDATION"),
    "long_liq_share": _PART("long_liq_sum", "short_liq_sum"), "short_liq_share": _PART("short_liq_sum", "long_liq_sum"), "call_oi_share": _PART("call_open_interest", "put_open_interest"), "put_oi_share": _PART("put_open_interest", "call_open_interest"),
    "derivatives_alert_level": _BAND("derivatives_risk_score", (">= 80", "CRITICAL_DERIVATIVES_RISK"), (">= 65", "HIGH_DERIVATIVES_RISK"), (">= 40", "MEDIUM_DERIVATIVES_RISK"), otherwise="LOW_DERIVATIVES_RISK"),
}
_from_core("m23_derivatives_labels", _KEYS, DERIVATIVES)
_IV = "coalesce(atm_avg_mark_iv, avg_mark_iv)"
OPTION_RISK = {
    "call_instrument_share": "call_instrument_count / nullif(cast(option_instrument_count as double), 0)", "put_instrument_share": "put_instrument_count / nullif(cast(option_instrument_count as double), 0)", "atm_instrument_share": "atm_instrument_count / nullif(cast(option_instrument_count as double), 0)",
    "call_open_interest_share": _PART("call_open_interest", "put_open_interest"), "put_open_interest_share": _PART("put_open_interest", "call_open_interest"),
    "implied_volatility_regime": f"case when {_Z(_IV)} >= 90 then 'EXTREME_IV' when {_Z(_IV)} >= 65 then 'HIGH_IV' when {_Z(_IV)} > 0 and {_Z(_IV)} <= 35 then 'LOW_IV' else 'NORMAL_IV' end",
    "iv_skew_label": _BAND("put_call_iv_skew", (">= 10", "PUT_SKEW_PANIC_HEDGE"), ("<= -10", "CALL_SKEW_UPSIDE_DEMAND"), otherwise="BALANCED_SKEW"), "oi_positioning_label": _PUTS("DEFENSIVE_OI", "UPSIDE_OI", "BALANCED_OI"),
    "gamma_exposure_label": _BAND("gamma_exposure_proxy", (">= 0", "POSITIVE_GAMMA_PROXY"), otherwise="NEGATIVE_GAMMA_PROXY"), "vega_exposure_label": _BAND("vega_exposure_proxy", (">= 100000", "HIGH_VEGA_EXPOSURE"), (">= 25000", "MEDIUM_VEGA_EXPOSURE"), otherwise="LOW_VEGA_EXPOSURE"),
    "options_alert_level": _BAND("derivatives_risk_score", (">= 80", "CRITICAL_OPTIONS_RISK"), (">= 65", "HIGH_OPTIONS_RISK"), (">= 40", "MEDIUM_OPTIONS_RISK"), otherwise="LOW_OPTIONS_RISK"),
}
_from_core("m24_options_labels", _KEYS, OPTION_RISK)
SOCIAL_BOARD = {
    "social_net_bullish_bearish_ratio": f"({_Z('social_bullish_count')} - {_Z('social_bearish_count')}) / nullif(cast({_Z('social_bullish_count')} + {_Z('social_bearish_count')} as double), 0)", "reddit_item_share": f"{_Z('reddit_post_count')} / nullif(cast({_Z('social_item_count')} as double), 0)",
    "telegram_item_share": f"{_Z('telegram_message_count')} / nullif(cast({_Z('social_item_count')} as double), 0)", "social_sentiment_regime": _BAND("social_sentiment_score", (">= 35", "EUPHORIC"), (">= 15", "BULLISH"), ("<= -35", "PANIC"), ("<= -15", "BEARISH"), otherwise="NEUTRAL"),
    "social_attention_level": f"case when {_Z('social_item_count')} >= 100 or {_Z('social_engagement_proxy')} >= 100000 then 'VIRAL_ATTENTION' when {_Z('social_item_count')} >= 40 or {_Z('social_engagement_proxy')} >= 25000 then 'HIGH_ATTENTION' when {_Z('social_item_count')} >= 10 then 'NORMAL_ATTENTION' else 'LOW_ATTENTION' end",
    "security_mentions": f"{_Z('reddit_hack_mentions')} > 0 or {_Z('telegram_hack_scam_topic_count')} > 0", "policy_mentions": f"{_Z('reddit_etf_mentions')} > 0 or {_Z('telegram_regulation_topic_count')} > 0", "whale_mentions": f"{_Z('reddit_whale_mentions')} > 0",
    "liquidation_mentions": f"{_Z('reddit_liquidation_mentions')} > 0", "macro_mentions": f"{_Z('reddit_fed_mentions')} > 0 or {_Z('telegram_macro_topic_count')} > 0",
}
_from_core("m26_social_dashboard", [*_KEYS, "social_item_count", "reddit_post_count", "telegram_message_count"], SOCIAL_BOARD)
SIGNAL = {
    "dashboard_signal": "case when core_signal = 'REDUCE_RISK' then 'RISK_REDUCTION' when market_regime = 'SYSTEM_RISK' then 'SYSTEM_RISK_ALERT' when core_signal = 'BULLISH' and overall_risk_score < 60 then 'BULLISH_SETUP' when core_signal = 'BEARISH' then 'BEARISH_SETUP' else 'NEUTRAL_WAIT' end",
    "signal_confidence_score": _CLAMP(0, "case when core_signal = 'BULLISH' then 50 + market_momentum_score * 0.40e0 + social_sentiment_score * 0.20e0 - overall_risk_score * 0.20e0 when core_signal = 'BEARISH' then 50 + abs(market_momentum_score) * 0.40e0 + greatest(0, -social_sentiment_score) * 0.20e0 + overall_risk_score * 0.20e0 when core_signal = 'REDUCE_RISK' or market_regime = 'SYSTEM_RISK' then 60 + overall_risk_score * 0.40e0 else 50 - abs(market_momentum_score) * 0.10e0 end"),
}
SIGNAL_MORE = {
    "signal_confidence_label": _BAND("signal_confidence_score", (">= 80", "HIGH_CONFIDENCE"), (">= 60", "MEDIUM_CONFIDENCE"), otherwise="LOW_CONFIDENCE"), "dashboard_signal_direction": "case when dashboard_signal in ('RISK_REDUCTION', 'SYSTEM_RISK_ALERT') then 'DEFENSIVE' when dashboard_signal = 'BEARISH_SETUP' then 'BEARISH' when dashboard_signal = 'BULLISH_SETUP' then 'BULLISH' else 'NEUTRAL' end",
    "dashboard_signal_sort_order": "case when dashboard_signal in ('RISK_REDUCTION', 'SYSTEM_RISK_ALERT') then 1 when dashboard_signal = 'BEARISH_SETUP' then 2 when dashboard_signal = 'BULLISH_SETUP' then 3 else 4 end",
}
_from_core("m27_signal_board", _KEYS, SIGNAL, SIGNAL_MORE)

# --- M28: all seven rules ---------------------------------------------------------------------------------------------

_NAME = lambda x: f"coalesce({x}, 'UNKNOWN')"
#: A number to so many digits, without trailing zeros. DuckDB's cast rounds the double times a power of ten, Spark's the
#: number as it is written; where it lies half-way between two figures these differ, so Spark gets DuckDB's way.
_TRIMMED = lambda x: f"regexp_replace(cast({x} as varchar(40)), '[.]?0+$', '')"
_FIGURE = lambda x, digits: _TRIMMED(f"cast({_Z(x)} as decimal(30, {digits}))")
_SPARK_FIGURE = lambda x, digits: _TRIMMED(f"cast(cast(round({_Z(x)} * 1e{digits}) as decimal(26, 0)) * 1e-{digits}BD as decimal(30, {digits}))")


def _alert_rules(figure: Callable[[str, int], str]) -> tuple[tuple[str, ...], ...]:
    """Type, category, severity, message, score, action"""
    return (
        ("SYSTEM_RISK", "risk", _BAND("overall_risk_score", (">= 80", "CRITICAL"), (">= 65", "HIGH"), otherwise=""), f"concat('Overall risk score is ', {figure('overall_risk_score', 2)})", "overall_risk_score", "Reduce exposure and review all risk panels."),
        ("DERIVATIVES_CROWDING", "derivatives", _BAND("derivatives_risk_score", (">= 80", "CRITICAL"), (">= 65", "HIGH"), otherwise=""), f"concat('Derivatives risk score is ', {figure('derivatives_risk_score', 2)})", "derivatives_risk_score", "Check funding, leverage stress, options positioning and liquidation clusters."),
        ("LIQUIDATION_SQUEEZE", "liquidation", "case when top_squeeze_signal in ('SHORT_SQUEEZE_SETUP', 'LONG_SQUEEZE_SETUP') then 'HIGH' else '' end", f"concat('Top squeeze signal: ', {_NAME('top_squeeze_signal')}, ', top bucket rank score: ', {figure('max_rank_score', 4)})", f"{_Z('max_rank_score')} * 100", "Inspect liquidation heatmap around spot price."),
        ("STABLECOIN_DEPEG", "liquidity", _BAND("max_abs_peg_deviation_pct", (">= 2", "CRITICAL"), (">= 0.5", "HIGH"), otherwise=""), f"concat('Worst peg symbol: ', {_NAME('worst_peg_symbol')}, ', deviation: ', {figure('max_abs_peg_deviation_pct', 4)}, '%')", f"{_Z('max_abs_peg_deviation_pct')} * 10", "Review stablecoin peg and liquidity risk panels."),
        ("EXCHANGE_BANK_RUN", "exchange", _BAND("high_bank_run_risk_exchange_count", (">= 2", "CRITICAL"), (">= 1", "HIGH"), otherwise=""), f"concat('High bank-run risk exchange count: ', cast({_Z('high_bank_run_risk_exchange_count')} as varchar(20)))", f"{_Z('high_bank_run_risk_exchange_count')} * 50", "Check exchange reserve utilization and top risky exchange."),
        ("SOCIAL_PANIC", "social", _BAND("social_sentiment_score", ("<= -35", "HIGH"), otherwise=""), f"concat('Social sentiment score is ', {figure('social_sentiment_score', 2)})", f"abs({_Z('social_sentiment_score')})", "Review social sentiment, security mentions and panic narratives."),
        ("MACRO_RISK_OFF", "macro", _BAND("macro_risk_score", (">= 75", "HIGH"), otherwise=""), f"concat('Macro risk regime: ', {_NAME('macro_risk_regime')}, ', macro risk score: ', {figure('macro_risk_score', 2)})", "macro_risk_score", "Check macro and ETF dashboard before taking directional risk."),
    )


ALERTS = _alert_rules(_FIGURE)
_ALERT_KEYS = ["hour_ts", "symbol", "feature_date", "crypto_feature_sk", "feature_available_at", "feature_latency_minutes"]
_ALERT_SQL = " union all ".join(f"select {', '.join(_ALERT_KEYS)}, '{t}' as alert_type, '{c}' as alert_category, nullif({s}, '') as alert_severity, {m} as alert_message, cast({x} as double) as alert_score, '{a}' as recommended_action from c where is_dashboard_ready" for t, c, s, m, x, a in ALERTS)


@query(
    "m28_alert_fan_out",
    f"with c as ({CORE_SQL}) select md5(strftime(hour_ts, '%Y-%m-%d %H:%M:%S') || '|' || symbol || '|' || alert_type) as dashboard_alert_sk, *, true as is_active_alert, case alert_severity when 'CRITICAL' then 1 when 'HIGH' then 2 when 'MEDIUM' then 3 else 4 end as alert_severity_sort_order from ({_ALERT_SQL}) a where alert_severity is not null",
    "alert_score",
)
def alert_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row for each of the seven rules that fires: one pass, no union."""
    rules = [alerts.Rule(t, c, [(F.expr(s) == v, v) for v in ("CRITICAL", "HIGH")], F.expr(m), F.expr(x), a) for t, c, s, m, x, a in _alert_rules(_SPARK_FIGURE)]
    fired = alerts.rule_alerts(fact(spark, sf_dir).where("is_dashboard_ready"), _ALERT_KEYS, rules)
    return fired.withColumns(
        {"dashboard_alert_sk": C.surrogate_key(F.date_format("hour_ts", "yyyy-MM-dd HH:mm:ss"), F.col("symbol"), F.col("alert_type")), "is_active_alert": F.lit(True), "alert_severity_sort_order": F.expr("case alert_severity when 'CRITICAL' then 1 when 'HIGH' then 2 when 'MEDIUM' then 3 else 4 end")}
    )


# --- M29, M30: daily risk ----------------------------------------------------------------------------------------------

_LAST_SQL = f"(select * from (select *, row_number() over (partition by feature_date, symbol order by hour_ts desc, feature_available_at desc) as nth from ({CORE_SQL}) c where is_dashboard_ready) x where nth = 1) d"
_BEFORE = lambda x: f"lag({x}) over (order by feature_date)"
_TREND = lambda x, up, down, flat: f"case when {x} > {_BEFORE(x)} then '{up}' when {x} < {_BEFORE(x)} then '{down}' else '{flat}' end"
_MOVE = lambda x: f"({x} - {_BEFORE(x)}) / nullif({_BEFORE(x)}, 0)"
#: What stood with the largest value of the day, where it is known; a day has a row a symbol, so the symbol tells ties apart.
_LED = lambda x, value: f"max_by({x}, struct({value}, hour_ts, symbol)) filter (where {x} is not null and {value} is not null)"
_MAXED = lambda names: {n: f"max({n})" for n in names.split()}
LIQUIDITY_DAY = (
    {"latest_hour_ts": "max(hour_ts)", "latest_feature_available_at": "max(feature_available_at)", "symbol_count": "count(distinct symbol)"}
    | _MAXED("total_stablecoin_market_cap_usd total_stablecoin_volume_24h_usd stablecoin_volume_to_mcap mcap_weighted_peg_deviation_pct max_abs_peg_deviation_pct max_depeg_risk_score depeg_risk_coin_count usdt_dominance_pct usdc_dominance_pct total_exchange_reserve_usd total_exchange_volume_24h_usd system_reserve_utilization normalized_system_reserve_utilization avg_exchange_trust_score reserve_hhi high_bank_run_risk_exchange_count top_reserve_exchange highest_utilization_risk_label highest_utilization_exchange")
    | {n: _LED(n, "max_abs_peg_deviation_pct") for n in ("worst_peg_symbol", "worst_peg_regime")}
    | {"liquidity_risk_score": "avg(liquidity_risk_score)", "overall_risk_score": "avg(overall_risk_score)"}
)
EXCHANGE_DAY = {k: v for k, v in LIQUIDITY_DAY.items() if "peg" not in k and "stablecoin" not in k and "dominance" not in k} | {
    "exchange_count": "max(exchange_count)", "top_reserve_exchange": _LED("top_reserve_exchange", "total_exchange_reserve_usd"), "highest_utilization_exchange": _LED("highest_utilization_exchange", "normalized_system_reserve_utilization"),
    "highest_utilization_risk_label": _LED("highest_utilization_risk_label", "normalized_system_reserve_utilization"),
}
#: A row a day: one window over all days is small
LIQUIDITY_RISK = {
    "stablecoin_market_cap_change_1d": _MOVE("total_stablecoin_market_cap_usd"), "exchange_reserve_change_1d": _MOVE("total_exchange_reserve_usd"), "liquidity_risk_level": _BAND("liquidity_risk_score", (">= 80", "CRITICAL_LIQUIDITY_RISK"), (">= 65", "HIGH_LIQUIDITY_RISK"), (">= 40", "MEDIUM_LIQUIDITY_RISK"), otherwise="LOW_LIQUIDITY_RISK"),
    "stablecoin_peg_status": _BAND("max_abs_peg_deviation_pct", (">= 2", "DEPEG_ALERT"), (">= 0.5", "PEG_WATCH"), otherwise="PEG_STABLE"), "stablecoin_liquidity_trend": _TREND("total_stablecoin_market_cap_usd", "LIQUIDITY_EXPANDING", "LIQUIDITY_CONTRACTING", "LIQUIDITY_FLAT"),
    "exchange_reserve_trend": _TREND("total_exchange_reserve_usd", "RESERVES_EXPANDING", "RESERVES_CONTRACTING", "RESERVES_FLAT"),
}
EXCHANGE_RISK = {
    "exchange_reserve_change_1d": _MOVE("total_exchange_reserve_usd"), "exchange_volume_change_1d": _MOVE("total_exchange_volume_24h_usd"),
    "exchange_risk_level": f"case when {_Z('high_bank_run_risk_exchange_count')} >= 2 or {_Z('normalized_system_reserve_utilization')} >= 0.85 then 'CRITICAL_EXCHANGE_RISK' when {_Z('high_bank_run_risk_exchange_count')} >= 1 or {_Z('normalized_system_reserve_utilization')} >= 0.65 then 'HIGH_EXCHANGE_RISK' when {_Z('normalized_system_reserve_utilization')} >= 0.40 then 'MEDIUM_EXCHANGE_RISK' else 'LOW_EXCHANGE_RISK' end",
    "reserve_concentration_label": _BAND("reserve_hhi", (">= 0.35", "HIGH_RESERVE_CONCENTRATION"), (">= 0.20", "MEDIUM_RESERVE_CONCENTRATION"), otherwise="DIVERSIFIED_RESERVES"), "reserve_trend": _TREND("total_exchange_reserve_usd", "RESERVES_INCREASING", "RESERVES_DECREASING", "RESERVES_FLAT"),
    "reserve_utilization_trend": _TREND("normalized_system_reserve_utilization", "UTILIZATION_INCREASING", "UTILIZATION_DECREASING", "UTILIZATION_FLAT"),
}


def _daily(name: str, day: dict[str, str], more: dict[str, str]) -> None:
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        last = dedupe.keep_latest(fact(spark, sf_dir).where("is_dashboard_ready"), ["feature_date", "symbol"], [F.col("hour_ts"), F.col("feature_available_at")])
        return added(grouped(last, ["feature_date"], day), more)

    query(name, f"select * from ({added_sql(f'({grouped_sql(_LAST_SQL, ["feature_date"], day)}) g', more)}) f", doubles_of(day, more))(run)


_daily("m30_liquidity_risk_daily", LIQUIDITY_DAY, LIQUIDITY_RISK)
_daily("m29_exchange_risk_daily", EXCHANGE_DAY, EXCHANGE_RISK)

# --- M18, M19: dimensions ----------------------------------------------------------------------------------------------

#: Fixed values
_KNOWN_SYMBOLS = [("BTC", "BTCUSDT", "Bitcoin", "bitcoin", True, True, 1), ("ETH", "ETHUSDT", "Ethereum", "ethereum", True, True, 2)]
_SYMBOL_COLUMNS = "symbol string, pair_symbol string, asset_name string, coingecko_id string, is_major_asset boolean, ml_enabled boolean, sort_order int"


@query(
    "m18_dim_symbols",
    """with o as (select distinct upper(symbol) as symbol from v_trades), u as (select 'BTC' as symbol, 'BTCUSDT' as pair_symbol, 'Bitcoin' as asset_name, 'bitcoin' as coingecko_id, true as is_major_asset, true as ml_enabled, 1 as sort_order, 1 as p union all select 'ETH', 'ETHUSDT', 'Ethereum', 'ethereum', true, true, 2, 1
      union all select symbol, symbol || 'USDT', symbol, null, false, false, 999, 2 from o)
      select symbol as symbol_key, symbol, pair_symbol, asset_name, symbol as base_asset, 'USDT' as quote_asset, 'crypto' as class_name, coingecko_id, is_major_asset, true as dashboard_enabled, ml_enabled, sort_order from (select *, row_number() over (partition by symbol order by p, ml_enabled desc, sort_order) as rn from u) x where rn = 1""",
)
def dim_symbols(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Known symbols before observed ones."""
    seen = view(spark, sf_dir, "v_trades").select(F.upper("symbol").alias("symbol")).distinct()
    seen = seen.select("symbol", F.concat("symbol", F.lit("USDT")).alias("pair_symbol"), F.col("symbol").alias("asset_name"), F.lit(None).cast("string").alias("coingecko_id"), F.lit(False).alias("is_major_asset"), F.lit(False).alias("ml_enabled"), F.lit(999).alias("sort_order"))
    out = dedupe.union_by_priority([spark.createDataFrame(_KNOWN_SYMBOLS, _SYMBOL_COLUMNS), seen], ["symbol"])
    return out.select(F.col("symbol").alias("symbol_key"), "symbol", "pair_symbol", "asset_name", F.col("symbol").alias("base_asset"), F.lit("USDT").alias("quote_asset"), F.lit("crypto").alias("class_name"), "coingecko_id", "is_major_asset", F.lit(True).alias("dashboard_enabled"), "ml_enabled", "sort_order")


@query(
    "m19_dim_exchanges",
    """with r as (select lower(exchange) as exchange_key, any_value('id_' || lower(exchange)) as coingecko_id from v_exch_obs where exchange is not null group by 1), f as (select distinct lower(exchange) || case when user_id % 2 = 0 then '_coin_m' else '_usdt' end as exchange_key from v_funding join events on obs_id = event_id),
      u as (select exchange_key, 'cex' as exchange_type, 'spot' as market_type, exchange_key as exchange_family, coingecko_id, 1 as p from r union all select exchange_key, 'derivatives', case when exchange_key like '%coin_m%' then 'coin_m_perp' when exchange_key like '%usdt%' then 'usdt_m_perp' else 'perpetual' end, split_part(exchange_key, '_', 1), null, 2 from f)
      select exchange_key, array_to_string(list_transform(string_split(replace(exchange_key, '_', ' '), ' '), lambda x: upper(x[1]) || x[2:]), ' ') as exchange_name, exchange_type, market_type, exchange_family, coingecko_id, true as is_cex, true as dashboard_enabled from (select *, row_number() over (partition by exchange_key order by p) as rn from u) x where rn = 1""",
)
def dim_exchanges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A4: any value of an attribute that all rows of a key share; reserves' exchanges before those of funding."""
    reserve = view(spark, sf_dir, "v_exch_obs").where("exchange is not null").groupBy(F.lower("exchange").alias("exchange_key")).agg(F.any_value(F.concat(F.lit("id_"), F.lower("exchange"))).alias("coingecko_id"))
    reserve = reserve.select("exchange_key", F.lit("cex").alias("exchange_type"), F.lit("spot").alias("market_type"), F.col("exchange_key").alias("exchange_family"), "coingecko_id")
    events = spark.read.parquet(f"{sf_dir}/events.parquet").select(F.col("event_id").alias("obs_id"), "user_id")
    key = F.concat(F.lower("exchange"), F.when(F.col("user_id") % 2 == 0, "_coin_m").otherwise("_usdt"))
    funding = view(spark, sf_dir, "v_funding").join(events, "obs_id").select(key.alias("exchange_key")).distinct()
    market = C.label_by([(F.col("exchange_key").contains("coin_m"), "coin_m_perp"), (F.col("exchange_key").contains("usdt"), "usdt_m_perp")], "perpetual")
    funding = funding.select("exchange_key", F.lit("derivatives").alias("exchange_type"), market.alias("market_type"), F.split("exchange_key", "_")[0].alias("exchange_family"), F.lit(None).cast("string").alias("coingecko_id"))
    out = dedupe.union_by_priority([reserve, funding], ["exchange_key"])
    return out.select("exchange_key", F.initcap(F.replace("exchange_key", F.lit("_"), F.lit(" "))).alias("exchange_name"), "exchange_type", "market_type", "exchange_family", "coingecko_id", F.lit(True).alias("is_cex"), F.lit(True).alias("dashboard_enabled"))


# --- M34, M38, M39: features for models --------------------------------------------------------------------------------

_W = "partition by symbol order by hour_ts"
_LAG = lambda x, n: f"lag({x}, {n}) over ({_W})"
_OVER = lambda f, x, n: f"{f}({x}) over ({_W} rows between {n - 1} preceding and current row)"
_RETURN = lambda n: f"(close_price - {_LAG('close_price', n)}) / nullif({_LAG('close_price', n)}, 0)"
_SCORES6 = ("market_momentum", "overall_risk", "social_sentiment", "derivatives_risk", "liquidity_risk", "macro_risk")
ML_WINDOWS = {
    "return_4h": _RETURN(4), "return_24h": _RETURN(24), **{f"price_change_{n}h": f"close_price - {_LAG('close_price', n)}" for n in (1, 4, 24)}, "rolling_avg_return_7h": _OVER("avg", "return_1h", 7), "rolling_avg_return_24h": _OVER("avg", "return_1h", 24), "rolling_volatility_24h": _OVER("stddev_samp", "return_1h", 24),
    "rolling_volatility_7d": _OVER("stddev_samp", "return_1h", 168), "rolling_avg_quote_volume_24h": _OVER("avg", "quote_volume", 24), **{f"{s}_delta_24h": f"{s}_score - {_LAG(s + '_score', 24)}" for s in _SCORES6}, **{f"rolling_avg_{s}_24h": _OVER("avg", f"{s}_score", 24) for s in ("overall_risk", "social_sentiment", "derivatives_risk")},
    "volume_zscore_24h": "quote_volume_zscore_24h",
}
#: Only what was known an hour before
_L = {"_quote_lag": _LAG("quote_volume", 1), "quote_volume_24h_lag_1h": _LAG("quote_volume_24h", 1), "volume_zscore_24h_lag_1h": _LAG("volume_zscore_24h", 1), "liquidity_risk_score_lag_1h": _LAG("liquidity_risk_score", 1), "_return_lag": _LAG("return_1h", 1), "return_4h_lag_1h": _LAG("return_4h", 1), "return_24h_lag_1h": _LAG("return_24h", 1), "_log_sum": f"sum(coalesce(log_return_1h, 0e0)) over ({_W} rows between unbounded preceding and current row)"}
_L2 = {"_log_lag": _LAG("_log_sum", 1)}
_N = lambda x, n, least, then: f"case when {_OVER('count', x, n)} >= {least} then {then} end"
_ALL = f"({_W} rows between unbounded preceding and current row)"
MICRO = {
    "quote_volume_lag_1h": "_quote_lag", "return_1h_rolling_mean_4h": _N("_return_lag", 4, 2, _OVER("avg", "_return_lag", 4)), "return_1h_rolling_sum_4h": _N("_return_lag", 4, 2, _OVER("sum", "_return_lag", 4)), "return_1h_rolling_mean_24h": _N("_return_lag", 24, 12, _OVER("avg", "_return_lag", 24)),
    "return_1h_rolling_sum_24h": _N("_return_lag", 24, 12, _OVER("sum", "_return_lag", 24)), "quote_volume_zscore_safe_24h": _N("_quote_lag", 24, 6, f"(_quote_lag - {_OVER('avg', '_quote_lag', 24)}) / nullif({_OVER('stddev_samp', '_quote_lag', 24)}, 0)"),
    "return_24h_symbol_zscore": f"case when count(return_24h_lag_1h) over {_ALL} >= 24 then (return_24h_lag_1h - avg(return_24h_lag_1h) over {_ALL}) / nullif(stddev_samp(return_24h_lag_1h) over {_ALL}, 0) end", "rolling_drawdown_24h": _N("_log_lag", 24, 6, f"_log_lag - {_OVER('max', '_log_lag', 24)}"),
}
_COMPLETE = ("close_price", "return_1h", "return_4h", "return_24h", "volume_zscore_24h", "coalesce(realized_volatility_24h, rolling_volatility_24h)", "avg_basis_pct", "avg_annualized_funding_coin", "avg_panic_norm", "social_weighted_avg_sentiment", "total_stablecoin_market_cap_usd", "overall_risk_score")
ML_LAST = {
    "high_liquidity_flag": "case when quote_volume_zscore_safe_24h >= 1.0 then 1e0 else 0e0 end", "low_liquidity_flag": "case when quote_volume_zscore_safe_24h <= -1.0 then 1e0 else 0e0 end", "feature_completeness_score": f"({' + '.join(f'case when {c} is not null then 1 else 0 end' for c in _COMPLETE)}) / 12e0",
    "is_training_feature_ready": "close_price is not null and return_1h is not null and return_4h is not null and coalesce(realized_volatility_24h, rolling_volatility_24h) is not null and feature_available_at is not null",
}
#: The numeric features of the production contract
CONTRACT = """return_1h return_4h return_24h log_return_1h realized_volatility_24h rolling_avg_return_7h rolling_avg_return_24h rolling_volatility_24h rolling_volatility_7d quote_volume quote_volume_24h volume_zscore_24h taker_buy_quote_ratio
    avg_basis_pct max_abs_basis_pct avg_funding_rate_coin avg_funding_rate_usdt avg_annualized_funding_coin avg_annualized_funding_usdt avg_arbitrage_spread max_leverage_stress avg_leverage_stress
    sp500_return_1d nasdaq_return_1d gold_return_1d vix_return_1d oil_return_1d nasdaq_sp500_ratio safe_haven_bid_1d
    market_momentum_score social_sentiment_score derivatives_risk_score liquidity_risk_score macro_risk_score overall_risk_score market_momentum_delta_24h overall_risk_delta_24h rolling_avg_overall_risk_24h""".split()
_ML_STEPS = (ML_WINDOWS, _L, _L2, MICRO, ML_LAST)


def ml_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The core fact with rolling, lagged and past-only features: one shuffle and sort by symbol serve all windows."""
    out = fact(spark, sf_dir)
    for step in _ML_STEPS:
        out = added(out, step)
    return out


ML_SQL = f"({CORE_SQL}) c"
for _step in _ML_STEPS:
    ML_SQL = f"({added_sql(ML_SQL, _step)}) c"
_MICRO = [*MICRO, "quote_volume_24h_lag_1h", "volume_zscore_24h_lag_1h", "liquidity_risk_score_lag_1h", "return_4h_lag_1h", "return_24h_lag_1h"]
_ML_SHOWN = ["hour_ts", "symbol", *CONTRACT, *(c for c in ML_WINDOWS if c not in CONTRACT), *_MICRO, *ML_LAST]
query("m34_ml_features", f"select {', '.join(_ML_SHOWN)} from {ML_SQL}", " ".join(c for c in _ML_SHOWN if c not in ("hour_ts", "symbol", "is_training_feature_ready")), 7)(lambda spark, sf_dir: ml_features(spark, sf_dir).select(*_ML_SHOWN))

_MISSING = {
    "close_price": "close_price", "return_1h": "return_1h", "return_4h": "return_4h", "return_24h": "return_24h", "volatility": "coalesce(realized_volatility_24h, rolling_volatility_24h)", "funding": "avg_funding_rate_coin", "annualized_funding": "avg_annualized_funding_coin", "liquidation": "avg_panic_norm",
    "liquidation_rank": "max_rank_score", "options": "avg_mark_iv", "options_positioning": "put_call_oi_ratio", "social": "social_weighted_avg_sentiment", "social_engagement": "social_engagement_proxy", "stablecoin": "total_stablecoin_market_cap_usd", "exchange_reserve": "total_exchange_reserve_usd", "macro": "sp500_return_1d", "etf": "btc_etf_flow_proxy",
}
QUALITY = {
    "feature_row_count": "count(*)", "avg_feature_completeness_score": "avg(feature_completeness_score)", "min_feature_completeness_score": "min(feature_completeness_score)", "max_feature_completeness_score": "max(feature_completeness_score)", "training_ready_count": "count(*) filter (where is_training_feature_ready)",
    "training_ready_ratio": "count(*) filter (where is_training_feature_ready) / cast(count(*) as double)", **{f"missing_{n}_count": f"count(*) filter (where {x} is null)" for n, x in _MISSING.items()}, **{f"missing_{n}_ratio": f"count(*) filter (where {x} is null) / cast(count(*) as double)" for n, x in _MISSING.items()},
    "avg_feature_latency": "avg(feature_latency_minutes)", "max_feature_latency_minutes": "max(feature_latency_minutes)",
}
QUALITY_STATUS = {
    "feature_quality_status": "case when training_ready_ratio >= 0.90 and avg_feature_completeness_score >= 0.80 then 'GOOD' when training_ready_ratio >= 0.70 and avg_feature_completeness_score >= 0.60 then 'ACCEPTABLE' when training_ready_ratio >= 0.50 then 'WEAK' else 'BAD' end",
    "feature_latency_status": "case when max_feature_latency_minutes >= 1440 then 'HIGH_LATENCY' when max_feature_latency_minutes >= 360 then 'MEDIUM_LATENCY' else 'LOW_LATENCY' end",
}
query("m39_feature_quality_daily", f"select * from ({added_sql(f'({grouped_sql(ML_SQL, ["feature_date", "symbol"], QUALITY)}) g', QUALITY_STATUS)}) q", doubles_of(QUALITY))(
    lambda spark, sf_dir: added(grouped(ml_features(spark, sf_dir), ["feature_date", "symbol"], QUALITY), QUALITY_STATUS)
)

# --- M36: labels, splits, weight, flags -------------------------------------------------------------------------------

_AHEAD = lambda n: f"(lead(close_price, {n}) over ({_W}) - close_price) / nullif(close_price, 0)"
LABELS = {"future_return_4h": _AHEAD(4), "symbol_time_rank": f"percent_rank() over ({_W})"}
LABELLED = {
    "future_direction_4h": "case when future_return_4h >= 0.003 then 'UP' when future_return_4h <= -0.003 then 'DOWN' when future_return_4h is not null then 'FLAT' end", "dataset_split_name": "case when symbol_time_rank < 0.70 then 'train' when symbol_time_rank < 0.85 then 'validation' else 'test' end",
    "sample_weight_4h": "greatest(0.1e0, least(10e0, abs(future_return_4h) / 0.003e0))", "is_training_row_ready": "feature_completeness_score >= 0.60 and close_price > 0 and return_1h is not null and return_4h is not null and future_return_4h is not null",
    "no_leakage_ready": f"feature_available_at <= lead(hour_ts, 4) over ({_W})",
}
_SET = ["hour_ts", "symbol", *CONTRACT, "future_return_4h", "symbol_time_rank", *LABELLED]
_SET_SQL = f"(select * from ({added_sql(f'({added_sql(ML_SQL, LABELS)}) l', LABELLED)}) s where close_price is not null and future_return_4h is not null) t"
query("m36_training_dataset_wide", f"select {', '.join(_SET)} from {_SET_SQL}", " ".join([*CONTRACT, "future_return_4h", "symbol_time_rank", "sample_weight_4h"]), 7)(lambda spark, sf_dir: training_dataset(spark, sf_dir).select(*_SET))


def training_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All contract features with the label four hours ahead, a split by time, a weight, and whether the features were known before the label's hour."""
    return added(added(ml_features(spark, sf_dir), LABELS), LABELLED).where("close_price is not null and future_return_4h is not null")


# --- M37, M32 ----------------------------------------------------------------------------------------------------------


@query(
    "m37_prediction_input",
    f"""with f as ({CORE_SQL}), h as (select hour_ts + interval '17' minute as at_ts, symbol, close_price as seen_price from v_hourly)
      select h.at_ts, h.symbol, h.seen_price, q.hour_ts as context_ts, q.overall_risk_score, q.core_signal, q.macro_risk_score, q.liquidity_risk_score, row_number() over (partition by h.symbol order by h.at_ts desc) = 1 as latest_ready
      from h left join lateral (select * from f where f.symbol = h.symbol and extract('hour' from f.hour_ts) % 9 = 0 and f.hour_ts <= h.at_ts and f.hour_ts >= h.at_ts - interval '6' hour order by f.hour_ts desc limit 1) q on true""",
    "seen_price overall_risk_score macro_risk_score liquidity_risk_score",
)
def prediction_input(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candles with the core fact as it was known then, six hours old at most. The fact comes every nine hours, so some candles have none."""
    known = fact(spark, sf_dir).where("hour(hour_ts) % 9 = 0").select(F.col("hour_ts").alias("context_ts"), "symbol", "overall_risk_score", "core_signal", "macro_risk_score", "liquidity_risk_score")
    candles = view(spark, sf_dir, "v_hourly").select((F.col("hour_ts") + F.expr("interval 17 minutes")).alias("at_ts"), "symbol", F.col("close_price").alias("seen_price"))
    out = joins.asof_join(candles, known, ["symbol"], "at_ts", "context_ts", ["core_signal"], ["overall_risk_score", "core_signal", "macro_risk_score", "liquidity_risk_score"], "6 hours")
    return added(out, {"latest_ready": "row_number() over (partition by symbol order by at_ts desc) = 1"})


_AGE = "date_diff('second', hour_ts, timestamp '2024-01-31') // 60"


@query(
    "m32_kpi_latest",
    f"""with l as (select *, row_number() over (partition by symbol order by hour_ts desc) as rn from ({CORE_SQL}) f)
      select symbol, hour_ts, close_price, overall_risk_score, macro_risk_score, core_signal, {_AGE} as age_minutes, case when {_AGE} <= 90 then 'FRESH' when {_AGE} <= 240 then 'STALE' else 'OLD' end as freshness, case when overall_risk_score >= 75 then 'RED' when overall_risk_score >= 50 then 'AMBER' else 'GREEN' end as risk_badge from l where rn = 1""",
    "close_price overall_risk_score macro_risk_score",
)
def kpi_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    last = dedupe.keep_latest(fact(spark, sf_dir), ["symbol"], [F.col("hour_ts")])
    age, risk = F.timestamp_diff("MINUTE", F.col("hour_ts"), F.lit("2024-01-31").cast("timestamp_ntz")), F.col("overall_risk_score")
    return last.select("symbol", "hour_ts", "close_price", "overall_risk_score", "macro_risk_score", "core_signal", age.alias("age_minutes"), C.label_by([(age <= 90, "FRESH"), (age <= 240, "STALE")], "OLD").alias("freshness"), C.label_by([(risk >= 75, "RED"), (risk >= 50, "AMBER")], "GREEN").alias("risk_badge"))


_SIGNAL = {"signal_confidence": _CLAMP(0, "case when overall_risk_score >= 70 then overall_risk_score when core_signal in ('BULLISH', 'BEARISH') then abs(market_momentum_score) + 20 else 50 - overall_risk_score / 4 end"), "short_signal": "case when overall_risk_score >= 70 then 'RISK_ALERT' when core_signal = 'BULLISH' and market_momentum_score >= 40 then 'STRONG_BUY' when core_signal = 'BULLISH' then 'BUY' when core_signal = 'BEARISH' then 'SELL' else 'HOLD' end"}
_from_core("m27_ai_signal", _KEYS, _SIGNAL)

assert len(CONTRACT) == 38
__all__ = ["CORE_SQL", "core_fact", "duck", "fact", "ml_features", "training_dataset", "wide_features"]
