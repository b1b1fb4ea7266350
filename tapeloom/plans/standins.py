"""Views that give the test tables the shapes of market inputs. The same text runs in Spark and in DuckDB."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "labels", "conversations")

VIEWS = {
    "v_trades": """select event_id as trade_id, ts as trade_ts, event_type as symbol, value as price,
        cast(user_id % 10 + 1 as double) as quantity, value * (user_id % 10 + 1) as quote_quantity, (event_id % 2 = 0) as is_buyer_maker from {events}""",
    "v_raw_trades": """select concat(event_type, 'USDT') as symbol, cast(event_id as varchar(20)) as trade_id, ts as trade_ts,
        case when event_id % 37 = 0 then 'bad' else cast(value as varchar(30)) end as price, cast(user_id % 10 as varchar(20)) as quantity,
        case when event_id % 2 = 0 then 'True' else '0' end as is_buyer_maker, 'r1' as run_id, event_id as ingested from {events}
        union all select concat(event_type, 'USDT'), cast(event_id as varchar(20)), ts, cast(value + 1 as varchar(30)), cast(user_id % 10 as varchar(20)),
        case when event_id % 2 = 0 then '1' else 'false' end, 'r2', event_id + 1000000 from {events} where event_id % 5 = 0""",
    "v_s_trades": """select concat('S', cast(user_id % 2 as varchar(4))) as symbol, event_id as trade_id, ts as trade_ts, value as price,
        cast(user_id % 10 + 1 as double) as quantity from {events} where event_type = 'view'""",
    "v_s_book": """select concat('S', cast(user_id % 2 as varchar(4))) as symbol, event_id as book_id, ts as ob_ts, value as best_bid_price,
        value * (user_id % 7 + 1) as bid_vol_1pct_usd, value * (event_id % 7 + 1) as ask_vol_1pct_usd from {events} where event_type = 'click'""",
    "v_s_liq": """select concat('S', cast(user_id % 2 as varchar(4))) as symbol, event_id as liq_id, ts as liq_ts,
        case when event_id % 2 = 0 then 'SELL' else 'BUY' end as side, value as price, cast(user_id % 10 + 1 as double) as quantity from {events} where event_type = 'error'""",
    "v_s_sent": """select concat('S', cast(user_id % 2 as varchar(4))) as symbol, event_id as sent_id, ts as sent_ts, (value - 100) / 1000 as funding_rate_pct,
        cast((user_id % 5) - 1.5 as double) as oi_delta_pct from {events} where event_type = 'signup'""",
    "v_s_chain": """select concat('S', cast(user_id % 2 as varchar(4))) as symbol, event_id as chain_id, ts as chain_ts,
        case event_id % 3 when 0 then 'INFLOW' when 1 then 'OUTFLOW' else 'WALLET_TO_WALLET' end as tx_type, value as amount from {events} where event_type = 'purchase'""",
    "v_daily": """select cast(o_orderdate as date) as price_date, o_orderpriority as symbol, avg(o_totalprice) as adj_close_price,
        cast(count(*) as double) as volume from {orders} group by cast(o_orderdate as date), o_orderpriority""",
    "v_options": """select month_date, symbol, concat(cast(l_partkey as varchar(20)), '-', option_type) as instrument_name, option_type,
        max(l_extendedprice) as strike, avg(l_discount) * 100 as mark_iv, sum(l_quantity) as open_interest, avg(l_tax) as delta, max(expiry) as expiry from (
          select cast(date_trunc('month', l_shipdate) as date) as month_date, l_linestatus as symbol, l_partkey, l_extendedprice, l_discount, l_quantity, l_tax,
            cast(l_shipdate as date) as expiry, case when l_returnflag = 'R' then 'C' else 'P' end as option_type from {lineitem}) x
        group by month_date, symbol, l_partkey, option_type""",
    "v_reserve": """select cast(date_trunc('month', o_orderdate) as date) as month_date, n_name as exchange, n_regionkey as region, sum(o_totalprice) as trade_volume_24h_usd,
        sum(abs(c_acctbal)) as actual_reserve_usd, cast(count(*) as double) as trust_score
        from {orders} join {customer} on o_custkey = c_custkey join {nation} on c_nationkey = n_nationkey group by cast(date_trunc('month', o_orderdate) as date), n_name, n_regionkey""",
    "v_funding": """select event_id as obs_id, ts as observed_at, concat('ex', cast(user_id % 7 as varchar(4))) as exchange, event_type as symbol, value as mark_price,
        value * (1 + (event_id % 11 - 5) / 900.0e0) as spot_price, (event_id % 21 - 10) / 10.0e0 as basis_pct, case when event_id % 13 = 0 then null else (user_id % 9 - 4) / 100.0e0 end as funding_rate_coin,
        (event_id % 17 - 8) / 2.0e0 as arbitrage_spread, cast(event_id % 29 as double) as leverage_stress from {events}""",
    "v_posts": """select doc_id as post_id, source as channel, lang, text, n_chars as engagement, (doc_id % 21 - 10) / 10.0e0 as sentiment from {documents}""",
    "v_pred": """select l.doc_id, d.source as slice, cast(l.quality as integer) as actual, case when d.n_chars > 1500 then 1 else 0 end as predicted,
        (d.n_chars % 100) / 100.0e0 as score from {labels} l join {documents} d on l.doc_id = d.doc_id""",
    "v_classes": """select doc_id, actual, a / (a + b + c) as prob_down, b / (a + b + c) as prob_flat, c / (a + b + c) as prob_up from (
        select doc_id, case doc_id % 3 when 0 then 'DOWN' when 1 then 'FLAT' else 'UP' end as actual, (n_chars % 97 + 1 + case when doc_id % 3 = 0 then 30 else 0 end) * 1e0 as a,
          (n_chars % 61 + 1 + case when doc_id % 3 = 1 then 30 else 0 end) * 1e0 as b, (n_chars % 83 + 1 + case when doc_id % 3 = 2 then 30 else 0 end) * 1e0 as c from {documents}) x""",
    "v_hourly": """select hour_ts, symbol, close_price, quote_volume, taker_buy_ratio from (
        select ts_hour as hour_ts, event_type as symbol, sum(value * (user_id % 10 + 1)) as quote_volume, avg(value) as close_price,
          sum(case when event_id % 2 = 1 then value else 0 end) / sum(value) as taker_buy_ratio
        from (select event_id, user_id, value, event_type, cast(date_trunc('hour', ts) as timestamp) as ts_hour from {events}) e group by ts_hour, event_type) h""",
    "v_liq_map": """select cast(date_trunc('hour', ts) as timestamp) as hour_ts, event_type as symbol, event_id as obs_id, floor(value / 50) * 50e0 as price_bucket, value * (user_id % 10 + 1) as total_liq_usd_bucket,
        case when event_id % 2 = 0 then value else 0e0 end as long_sum, case when event_id % 2 = 1 then value else 0e0 end as short_sum, value as oi_avg, value * 2 as vol_sum, event_id % 12 as hit_count, (event_id % 21 - 10) / 10.0e0 as weighted_liq_ratio,
        (event_id % 9 - 4) / 4.0e0 as avg_money_flow, (event_id % 101) / 100.0e0 as panic_norm, (user_id % 41 - 20) / 20.0e0 as magnet_norm, (event_id % 97) / 97.0e0 as rank_score, (event_id % 61 - 30) / 3.0e0 as distance_pct,
        case user_id % 6 when 0 then 'SHORT_SQUEEZE_SETUP' when 1 then 'LONG_SQUEEZE_SETUP' else 'NEUTRAL' end as squeeze_signal, case when event_id % 2 = 0 then 'LONG' else 'SHORT' end as dominant_side, case event_id % 3 when 0 then 'HIGH' when 1 then 'MEDIUM' else 'LOW' end as stress_level from {events}""",
    "v_opt_obs": """select cast(date_trunc('hour', ts) as timestamp) as hour_ts, ts as observed_at, event_type as symbol, concat('I', cast(event_id % 40 as varchar(10))) as instrument_name, event_id as obs_id, case when user_id % 2 = 0 then 'C' else 'P' end as option_type, (user_id % 9 + 1) * 10e0 as strike,
        value as open_interest, value * 3 as volume_usd, event_id % 60 + 20e0 as mark_iv, event_id % 58 + 21e0 as mid_iv, (event_id % 7) / 10.0e0 as iv_spread, (event_id % 101 - 50) / 50.0e0 as delta, (event_id % 10) / 1000.0e0 as gamma, (event_id % 30) / 10.0e0 as vega, -(event_id % 20) / 10.0e0 as theta,
        case when user_id % 3 = 0 then null else 100 + value end as underlying_price, 101 + value as index_price, event_id % 5 = 0 as is_atm, event_id % 50 as days_left from {events}""",
    "v_coin_obs": """select ts as observed_at, event_id as obs_id, case user_id % 5 when 0 then 'USDT' when 1 then 'USDC' when 2 then 'DAI' when 3 then 'FDUSD' else 'TUSD' end as symbol, 1 + (event_id % 41 - 20) / 1000.0e0 as price_usd, value * (user_id % 5 + 1) as market_cap_usd, value * 1.1e0 as fully_diluted_valuation_usd,
        value * (event_id % 3 + 1) / 10 as volume_24h_usd, value * 0.9e0 as circulating_supply, (event_id % 41 - 20) / 10.0e0 as peg_deviation_pct, (event_id % 100) / 100.0e0 as depeg_risk_score, case when event_id % 41 > 25 then 'premium' when event_id % 41 < 15 then 'depeg_risk' else 'stable' end as peg_regime,
        case when event_id % 13 = 0 then 1 else 0 end as is_peg_outlier, case when event_id % 17 = 0 then 1 else 0 end as is_volume_outlier from {events}""",
    "v_exch_obs": """select ts as observed_at, event_id as obs_id, concat('ex', cast(user_id % 7 as varchar(4))) as exchange, event_id % 11 * 1e0 as trust_score, value * 100 as actual_reserve_usd, value * (user_id % 9 + 1) as trade_volume_24h_usd, value * (user_id % 5 + 1) as trade_volume_24h_usd_normalized,
        value * (event_id % 2) as wash_trading_volume_usd, (event_id % 23) / 23.0e0 as reserve_utilization, (user_id % 40) * 1e0 as reserve_dominance_pct, (event_id % 31) / 31.0e0 as concentration_risk_score, value * (event_id % 4) as whale_withdrawal_risk,
        case event_id % 9 when 0 then 'HIGH_RISK' when 1 then 'MODERATE' when 2 then 'MODERATE' else 'SAFE' end as bank_run_risk, concat('tier_', cast(user_id % 4 + 1 as varchar(4))) as exchange_tier from {events}""",
    "v_coin_raw": """select event_id as obs_id, cast(date_trunc('hour', ts) as timestamp) as run_ts, case user_id % 5 when 0 then 'USDT' when 1 then 'USDC' when 2 then 'DAI' when 3 then 'FDUSD' else 'TUSD' end as symbol,
        case when event_id % 31 = 0 then null when event_id % 37 = 0 then 0e0 else 1 + (event_id % 51 - 25) / 1000.0e0 end as price_usd, case when event_id % 29 = 0 then 0e0 else value * power(10e0, event_id % 4 + 6) end as market_cap_usd,
        value * power(10e0, event_id % 4 + 6) * (user_id % 9) / 4 as volume_24h_usd, value * 8e5 as circulating_supply, case when event_id % 23 = 0 then 0e0 else value * 1e6 end as total_supply from {events}""",
    "v_exch_raw": """select event_id as obs_id, cast(date_trunc('hour', ts) as timestamp) as run_ts, concat('ex', cast(user_id % 7 as varchar(4))) as exchange, (event_id % 11) * 1e0 as trust_score, value * (user_id % 40 + 1) * 20 as trade_volume_24h_btc,
        value * (user_id % 40 + 1) * (event_id % 5 + 15) as trade_volume_24h_btc_normalized, 40000e0 as btc_price_usd, case event_id % 5 when 0 then null when 1 then 0e0 else value * (user_id % 90 + 1) * 1e6 end as first_reserve_usd,
        case event_id % 3 when 0 then null else value * (user_id % 80 + 1) * 1e6 end as second_reserve_usd from {events}""",
    "v_liq_priced": """select l.obs_id, l.hour_ts, l.symbol, l.price_bucket, case when l.obs_id % 19 = 0 then null else 100 + l.obs_id % 3 * 50e0 end as close_price, case when l.obs_id % 17 = 0 then null else l.distance_pct end as distance_pct, l.total_liq_usd_bucket, l.long_sum, l.short_sum, l.rank_score, l.panic_norm, l.magnet_norm from (
        select event_id as obs_id, cast(date_trunc('hour', ts) as timestamp) as hour_ts, event_type as symbol, floor(value / 50) * 50e0 as price_bucket, value * (user_id % 10 + 1) as total_liq_usd_bucket, case when event_id % 2 = 0 then value when event_id % 7 = 0 then null else 0e0 end as long_sum,
          case when event_id % 2 = 1 then value else 0e0 end as short_sum, (event_id % 101) / 100.0e0 as panic_norm, (user_id % 41 - 20) / 20.0e0 as magnet_norm, (event_id % 97) / 96.0e0 as rank_score, (event_id % 61 - 30) / 3.0e0 as distance_pct from {events}) l""",
    "v_checks": """select event_id as check_id, ts as check_ts, case when event_id % 211 = 0 then null else concat('run_', cast(date_trunc('day', ts) as varchar(10))) end as run_id, case when user_id % 3 = 0 then 'critical' else 'warning' end as severity,
        case when user_id % 3 = 0 then event_id % 97 <> 0 else event_id % 41 <> 0 end as success from {events}""",
    "v_model_runs": """select concat('m', cast(user_id % 3 as varchar(4))) as model_name, case when event_id % 101 = 0 then null else concat('v', cast(user_id % 2 as varchar(4))) end as model_version, case event_id % 3 when 0 then 'direction_4h' when 1 then 'direction_1h' else null end as target_name,
        case event_id % 4 when 0 then 'TRAIN' when 1 then 'validation' when 2 then 'test' else 'holdout' end as split_name, cast(ts - interval '2' hour as timestamp) as trained_at, ts as evaluated_at, concat('r', cast(event_id as varchar(20))) as run_id, event_id % 7 as row_count, (event_id % 100) / 100.0e0 as accuracy,
        (event_id % 71) / 100.0e0 as f1_macro, case when event_id % 5 = 0 then null else (event_id % 80) / 100.0e0 end as auc_ovr from {events}""",
    "v_models": """select distinct concat('m', cast(user_id % 3 as varchar(4))) as model_name, 'v1' as model_version, 'trees' as model_family, 'boosted' as algorithm, 'classification' as problem_type, 'direction_4h' as primary_target, user_id % 3 = 1 as is_active from {events} where user_id % 3 < 2""",
    "v_candidates": """select event_id as obs_id, c.candidate, case when event_id % 10 < 7 then 'validation' else 'test' end as split_name, date_format_month as month, event_type as symbol, actual, case when (event_id * c.k) % 10 < c.right_of_ten then actual else other end as predicted from (
        select event_id, event_type, cast(user_id % 3 as varchar(4)) as date_format_month, case event_id % 3 when 0 then 'DOWN' when 1 then 'FLAT' else 'UP' end as actual, case event_id % 2 when 0 then 'FLAT' else 'DOWN' end as other from {events}) e
        cross join (select 'base' as candidate, 7 as k, 6 as right_of_ten union all select 'better', 7, 8 union all select 'worse', 3, 5 union all select 'same', 7, 6) c""",
    "v_ticks": """select cast(cast(o_orderdate as date) + interval '9290' day as date) as price_date, case o_orderpriority when '1-URGENT' then 'SP500' when '2-HIGH' then 'VIX' when '3-MEDIUM' then 'NASDAQ' when '5-LOW' then 'GOLD' else 'OIL' end as symbol,
        avg(o_totalprice) as close_price, cast(count(*) as double) as volume from {orders} group by cast(cast(o_orderdate as date) + interval '9290' day as date), o_orderpriority""",
    "v_messages": """select doc_id as post_id, source as channel, lang, doc_id % 97 as score, doc_id % 13 as comments, doc_id % 500 + 1 as hours_old, doc_id % 20000 as views, doc_id % 31 as forwards, doc_id % 11 as replies, doc_id % 41 as reactions, (doc_id % 21 - 10) / 10.0e0 as compound,
        case doc_id % 17 when 0 then 'BTC to the moon, buy $BTC #btc' when 1 then 'Ethereum ETF lawsuit at the SEC http://x.io/a' when 2 then 'hack and exploit, funds stolen 12.5% #rekt' when 3 then 'whale sells, crash and panic $5k' when 4 then 'Powell: rate cut <b>soon</b> &amp; later' when 5 then 'airdrop giveaway, claim now $ETH $BTC'
          when 6 then 'support and resistance, RSI chart 3%' when 7 then 'blackrock new high, bitcoin and ethereum' when 8 then 'bear market, short it' when 9 then 'short text' when 10 then '' else 'plain words about nothing at all' end as title,
        case when doc_id % 23 = 0 then '[removed]' when doc_id % 29 = 0 then '[deleted]' when doc_id % 17 = 9 then '' when doc_id % 17 = 10 then '' else text end as body from {documents}""",
    "v_audit": """select ts as audit_ts, event_type as table_name, concat('rule_', cast(user_id % 5 as varchar(4))) as expectation_type, event_id % 7 <> 0 as success, case when user_id % 3 = 0 then 'critical' else 'warning' end as severity, event_id as audit_id from {events}""",
    "v_social": """select cast(timestamp '2024-01-01 00:00:00' + (doc_id % 720) * interval '1' hour as timestamp) as hour_ts, case doc_id % 5 when 0 then 'view' when 1 then 'click' when 2 then 'error' when 3 then 'signup' else 'purchase' end as symbol, doc_id as post_id,
        case when doc_id % 3 = 0 then 'telegram' else 'reddit' end as channel, n_chars * 1e0 as engagement, n_chars % 17 * 1e0 as weight, (doc_id % 21 - 10) / 10.0e0 as sentiment,
        concat(case when doc_id % 7 = 0 then 'ETF,' else '' end, case when doc_id % 11 = 0 then 'HACK,' else '' end, case when doc_id % 13 = 0 then 'WHALE,' else '' end, case when doc_id % 17 = 0 then 'LIQUIDATION,' else '' end, case when doc_id % 19 = 0 then 'FED' else '' end) as event_tags,
        case doc_id % 4 when 0 then 'TECHNICAL' when 1 then 'REGULATION' when 2 then 'HACK_SCAM' else 'MACRO' end as topic, case when doc_id % 6 = 0 then 'HIGH' else 'LOW' end as importance from {documents}""",
}


def duck_view(name: str) -> str:
    return VIEWS[name].format(**{t: t for t in TABLES})


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def view(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    text = VIEWS[name]
    used = {t: table(spark, sf_dir, t) for t in TABLES if f"{{{t}}}" in text}
    return spark.sql(text.replace("as timestamp)", "as timestamp_ntz)"), **used)
