"""Typed projection, domain filters and keep-latest: raw text columns to staged tables."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.operators.dedupe import keep_latest


@dataclass(frozen=True)
class Stage:
    """What a staged table holds.

    columns: name to type; a type ending in ``upper``, ``lower`` or ``blank`` also folds text or makes '' null.
    domain: SQL conditions, all of which a row must meet. key and latest: of rows with one key the latest stays.
    strip: column to a suffix pattern that goes. source: column to its name in the raw table, where that differs.
    helpers: columns that only serve the key. A column of type ``seconds`` is a time from seconds since 1970.
    """

    columns: dict[str, str]
    key: Sequence[str]
    domain: Sequence[str] = ()
    latest: Sequence[str] = ("ingestion_time", "run_id")
    strip: dict[str, str] = field(default_factory=dict)
    source: dict[str, str] = field(default_factory=dict)
    helpers: Sequence[str] = ()


def typed(df: DataFrame, columns: dict[str, str], strip: dict[str, str] | None = None, source: dict[str, str] | None = None) -> DataFrame:
    """Casts that give null where a value doesn't fit; columns that the input lacks are null."""

    def one(name: str, kind: str) -> Column:
        base, *folds = kind.split()
        raw = (source or {}).get(name, name)
        if raw not in df.columns:
            return F.lit(None).cast("timestamp" if base == "seconds" else base)
        x = F.col(raw)
        if base == "seconds":
            x = F.timestamp_seconds(x.try_cast("bigint"))
        elif base == "boolean":
            x = F.when(x.isNotNull(), F.lower(x.cast("string")).isin("true", "1"))
        elif base == "bigint" and dict(df.dtypes)[raw] == "string":
            x = x.try_cast("decimal(38,0)").try_cast("bigint")
        else:
            x = x.try_cast(base)
        for fold in folds:
            x = {"upper": F.upper, "lower": F.lower, "blank": lambda c: F.nullif(c, F.lit(""))}[fold](x)
        if strip and name in strip:
            x = F.regexp_replace(x, strip[name], "")
        return x

    return df.select(*[one(n, k).alias(n) for n, k in columns.items()])


def stage(df: DataFrame, spec: Stage) -> DataFrame:
    """Project, filter, keep the latest row of each key."""
    out = typed(df, spec.columns, spec.strip, spec.source)
    for rule in [*(f"{k} is not null" for k in spec.key), *spec.domain]:
        out = out.where(rule)
    return (keep_latest(out, spec.key, [F.col(c) for c in spec.latest]) if spec.latest else out).drop(*spec.helpers)


def _columns(doubles: str = "", strings: str = "", blanks: str = "", bigints: str = "", **others: str) -> dict[str, str]:
    out = dict.fromkeys(doubles.split(), "double") | dict.fromkeys(strings.split(), "string") | dict.fromkeys(blanks.split(), "string blank") | dict.fromkeys(bigints.split(), "bigint")
    return out | others | {"source": "string", "run_id": "string", "ingestion_time": "timestamp", "year": "string", "month": "string", "day": "string"}


#: Types, keys and domains of the staged tables.
_BARS = _columns(
    "open_price high_price low_price close_price adj_close_price volume vwap trade_count", "data_provider",
    price_date="date", price_at="seconds", symbol="string upper", ticker="string upper", asset_class="string lower", exchange="string upper", currency="string upper", timeframe="string lower",
)
_BAR_SOURCE = {"price_date": "date", "price_at": "timestamp", "open_price": "open", "high_price": "high", "low_price": "low", "close_price": "close", "adj_close_price": "adj_close"}
_BAR_DOMAIN = ["close_price > 0", "open_price > 0", "high_price > 0", "low_price > 0", "volume >= 0", "high_price >= low_price"]
STAGES = {
    "trades": Stage(
        {"symbol": "string upper", "trade_id": "bigint", "trade_ts": "timestamp", "price": "double", "quantity": "double", "quote_quantity": "double", "is_buyer_maker": "boolean", "run_id": "string", "ingestion_time": "timestamp"},
        ["symbol", "trade_id"], ["price > 0", "quantity > 0", "quote_quantity > 0"], strip={"symbol": "USDT$"},
    ),
    "options": Stage(
        _columns(
            "strike underlying_price index_price mark_price mark_iv best_bid_price best_ask_price bid_iv ask_iv last_price open_interest volume volume_usd delta gamma vega theta rho moneyness iv_spread mid_iv", "instrument_name expiry",
            observed_at="timestamp", observed_date="date", observed_hour="bigint", underlying="string upper", option_type="string upper", is_atm="boolean", is_call="boolean",
        ),
        ["instrument_name", "observed_at"],
        ["underlying in ('BTC', 'ETH')", "option_type in ('C', 'P')", "strike > 0", "index_price > 0", "underlying_price > 0", "mark_price >= 0", "mark_iv >= 0", "mid_iv >= 0", "open_interest >= 0", "delta between -1.05 and 1.05"],
        source={"observed_at": "timestamp", "observed_date": "date", "observed_hour": "hour"},
    ),
    "etf": Stage(_BARS, ["symbol", "price_date"], ["asset_class = 'etf'", *_BAR_DOMAIN], source=_BAR_SOURCE),
    "macro": Stage(_BARS, ["symbol", "price_date"], ["asset_class = 'macro'", *_BAR_DOMAIN], source=_BAR_SOURCE),
    "exchange_reserve": Stage(
        _columns(
            "trust_score trade_volume_24h_btc trade_volume_24h_btc_normalized llama_reserve_usd arkham_reserve_usd actual_reserve_usd live_btc_price_usd trade_volume_24h_usd trade_volume_24h_usd_normalized reserve_utilization wash_trading_volume_usd reserve_dominance_pct concentration_risk_score liquidity_score whale_withdrawal_risk",
            "data_source", "country year_established",
            exchange="string lower", coingecko_id="string lower", observed_at="timestamp", observed_date="date", bank_run_risk="string upper", exchange_tier="string lower",
        ),
        ["exchange", "observed_at"],
        ["coingecko_id is not null", "actual_reserve_usd >= 0", "trade_volume_24h_usd >= 0", "reserve_dominance_pct between 0 and 100", "trust_score between 0 and 10", "bank_run_risk in ('SAFE', 'MODERATE', 'HIGH_RISK')", "exchange_tier in ('tier_1', 'tier_2', 'tier_3', 'tier_4')"],
        source={"observed_at": "timestamp", "observed_date": "date"},
    ),
    "funding": Stage(
        _columns(
            "mark_price spot_price basis_spread basis_pct funding_rate_coin funding_rate_usdt annualized_funding_coin annualized_funding_usdt annualized_basis_coin annualized_basis_usdt arbitrage_spread next_funding_time leverage_stress",
            exchange="string lower", symbol="string upper", observed_at="timestamp", observed_date="date", funding_regime="string lower", arbitrage_opportunity="string upper",
        ),
        ["exchange", "symbol", "observed_at"],
        ["symbol in ('BTC', 'ETH')", "mark_price > 0", "spot_price > 0", "basis_pct between -20 and 20", "funding_rate_coin between -10 and 10", "funding_rate_usdt between -10 and 10"],
        source={"observed_at": "timestamp", "observed_date": "date"},
    ),
    "liquidations": Stage(
        _columns(
            "price_bucket total_liq_usd_bucket long_sum short_sum oi_avg vol_sum avg_weighted_liq_ratio avg_panic avg_money_flow distance_pct weighted_liq_ratio distance_decay magnet_score magnet_zscore magnet_norm panic_norm hit_norm rank_score", bigints="hit_count",
            symbol="string upper", price_bucket_key="decimal(18,2)", snapshot_at="timestamp", squeeze_signal="string upper", dominant_side="string upper", stress_level="string upper",
        ),
        ["symbol", "snapshot_at", "price_bucket_key"],
        ["symbol in ('BTC', 'ETH')", "price_bucket > 0", "total_liq_usd_bucket >= 0", "hit_count >= 0", "weighted_liq_ratio between -1 and 1", "panic_norm between 0 and 1", "magnet_norm between -1 and 1", "squeeze_signal in ('SHORT_SQUEEZE_SETUP', 'LONG_SQUEEZE_SETUP', 'NEUTRAL')"],
        strip={"symbol": "(USDT_PERP[.]A|USDT_PERP|USDT)$"}, source={"snapshot_at": "snapshot_timestamp", "price_bucket_key": "price_bucket"}, helpers=["price_bucket_key"],
    ),
    "stablecoins": Stage(
        _columns(
            "price_usd market_cap_usd fully_diluted_valuation_usd volume_24h_usd circulating_supply total_supply max_supply peg_deviation_pct utilization_ratio volume_to_marketcap depeg_risk_score market_cap_usd_log volume_24h_usd_log circulating_supply_log stablecoin_dominance_pct liquidity_score hour_sin hour_cos",
            bigints="market_cap_rank timestamp_unix hour day_of_week is_peg_outlier is_volume_outlier",
            symbol="string upper", coin_id="string lower", observed_at="timestamp", observed_date="date", peg_regime="string lower", liquidity_tier="string lower",
        ),
        ["symbol", "observed_at"],
        [
            "coin_id is not null", "price_usd between 0.95 and 1.05", "market_cap_usd > 0", "volume_24h_usd >= 0", "circulating_supply >= 0", "stablecoin_dominance_pct between 0 and 100", "peg_regime in ('premium', 'depeg_risk', 'stable')",
            "liquidity_tier in ('mega', 'large', 'medium', 'small')", "hour between 0 and 23", "day_of_week between 0 and 6", "is_peg_outlier in (0, 1)", "is_volume_outlier in (0, 1)",
        ],
        source={"observed_at": "timestamp", "observed_date": "date"},
    ),
    "reddit": Stage(
        _columns(
            "engagement_velocity interaction_weight final_weight sentiment_compound weighted_sentiment", "post_id", "title body full_text author event_tags url", "score comments",
            subreddit="string lower", created_at="timestamp", asset="string upper", is_viral="boolean",
        ),
        ["post_id"], ["full_text is not null", "asset in ('BTC', 'ETH', 'GENERAL')", "sentiment_compound between -1 and 1", "comments >= 0", "engagement_velocity >= 0"],
        source={"created_at": "created_utc"},
    ),
    "telegram": Stage(
        _columns(
            "nlp_compound weighted_sentiment engagement_score", "day_of_week", "text cashtags hashtags urls message_url", "message_id views forwards replies reactions word_count financial_mentions_count hour_of_day",
            channel="string lower", message_date="date", message_at="timestamp", signal_type="string upper", coin_focus="string upper", topic="string upper", importance="string upper", media_type="string upper",
            is_weekend="boolean", has_media="boolean", is_forward="boolean",
        ),
        ["channel", "message_id"], ["text is not null", "nlp_compound between -1 and 1", "signal_type in ('BULLISH', 'BEARISH', 'NEUTRAL')", "views >= 0", "engagement_score >= 0.99"],
        source={"message_date": "date", "message_at": "datetime"},
    ),
    "candles": Stage(
        {"window_start": "timestamp", "window_end": "timestamp", "symbol": "string upper", "trade_id": "bigint"} | dict.fromkeys(["open_price", "high_price", "low_price", "close_price", "volume", "vwap_price", "sma20", "upper_band", "lower_band"], "double"),
        ["window_start", "symbol"], ["close_price > 0"], latest=(), source={"vwap_price": "VWAP"},
    ),
}
