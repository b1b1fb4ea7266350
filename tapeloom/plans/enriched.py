"""What collection runs add to coins, exchanges and liquidation buckets; runs of checks; a rule suite over six tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.functions import enrichment
from tapeloom.plans.registry import query
from tapeloom.plans.standins import table, view
from tapeloom.quality import rules as Q
from tapeloom.quality import suite

_COIN = "peg_deviation_pct utilization_ratio volume_to_marketcap stablecoin_dominance_pct depeg_risk_score liquidity_score market_cap_usd_log volume_24h_usd_log circulating_supply_log hour_sin hour_cos".split()
_COIN_OTHERS = ["peg_regime", "liquidity_tier", "is_peg_outlier", "is_volume_outlier"]


@query(
    "m49_coin_features",
    f"""with d as (select *, case when price_usd is null or price_usd = 0 then 0 else (price_usd - 1) * 100 end as peg_deviation_pct, case when total_supply > 0 then circulating_supply / total_supply end as utilization_ratio, case when market_cap_usd > 0 then volume_24h_usd / market_cap_usd end as volume_to_marketcap,
        sum(market_cap_usd) over (partition by run_ts) as all_caps from v_coin_raw),
      f as (select *, case when peg_deviation_pct >= 0.5 then 'premium' when peg_deviation_pct <= -0.5 then 'depeg_risk' else 'stable' end as peg_regime, case when all_caps > 0 then market_cap_usd / all_caps * 100 else 0 end as stablecoin_dominance_pct, abs(peg_deviation_pct) * coalesce(volume_to_marketcap, 0) as depeg_risk_score,
        case when market_cap_usd >= 50000000000 then 'mega' when market_cap_usd >= 5000000000 then 'large' when market_cap_usd >= 500000000 then 'medium' else 'small' end as liquidity_tier, ln(1 + market_cap_usd) * 0.5 + volume_to_marketcap * 0.3 - abs(peg_deviation_pct) * 0.2 as liquidity_score,
        ln(1 + market_cap_usd) as market_cap_usd_log, ln(1 + volume_24h_usd) as volume_24h_usd_log, ln(1 + circulating_supply) as circulating_supply_log, (abs(peg_deviation_pct) > 2)::int as is_peg_outlier, coalesce((volume_to_marketcap > 1.5)::int, 0) as is_volume_outlier,
        sin(2 * pi() * hour(run_ts) / 24) as hour_sin, cos(2 * pi() * hour(run_ts) / 24) as hour_cos from d)
      select obs_id, symbol, {', '.join(_COIN_OTHERS + _COIN)} from f""",
    " ".join(_COIN),
    8,
)
def coin_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrichment.coin_features(view(spark, sf_dir, "v_coin_raw"), ["run_ts"], "run_ts").select("obs_id", "symbol", *_COIN_OTHERS, *_COIN)


_RESERVE = "actual_reserve_usd trade_volume_24h_usd reserve_utilization reserve_dominance_pct wash_trading_volume_usd concentration_risk_score liquidity_score whale_withdrawal_risk".split()
_RESERVE_OTHERS = ["data_source", "bank_run_risk", "exchange_tier"]


@query(
    "m50_reserve_features",
    f"""with a as (select *, coalesce(case when first_reserve_usd > 0 then first_reserve_usd else second_reserve_usd end, 0) as actual_reserve_usd, case when first_reserve_usd is not null then 'DefiLlama' when second_reserve_usd is not null then 'Arkham' else 'Missing' end as data_source, trade_volume_24h_btc * btc_price_usd as trade_volume_24h_usd,
        trade_volume_24h_btc_normalized * btc_price_usd as norm from v_exch_raw),
      b as (select *, trade_volume_24h_usd / case when actual_reserve_usd = 0 then 1 else actual_reserve_usd end as reserve_utilization, trade_volume_24h_usd - norm as wash_trading_volume_usd, sum(actual_reserve_usd) over (partition by run_ts) as whole from a),
      c as (select *, case when whole > 0 then actual_reserve_usd / whole * 100 else 0 end as reserve_dominance_pct, case when reserve_utilization > 1 and trust_score < 8 then 'HIGH_RISK' when reserve_utilization < 0.5 and trust_score >= 9 then 'SAFE' else 'MODERATE' end as bank_run_risk,
        case when trade_volume_24h_usd >= 10000000000 then 'tier_1' when trade_volume_24h_usd >= 1000000000 then 'tier_2' when trade_volume_24h_usd >= 100000000 then 'tier_3' else 'tier_4' end as exchange_tier, trust_score * norm as liquidity_score, abs(wash_trading_volume_usd) * reserve_utilization as whale_withdrawal_risk from b)
      select obs_id, exchange, {', '.join(_RESERVE_OTHERS)}, {', '.join(x if x != 'concentration_risk_score' else 'reserve_dominance_pct * reserve_utilization as concentration_risk_score' for x in _RESERVE)} from c""",
    " ".join(_RESERVE),
    2,
)
def reserve_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrichment.reserve_features(view(spark, sf_dir, "v_exch_raw"), ["run_ts"]).select("obs_id", "exchange", *_RESERVE_OTHERS, *_RESERVE)


_BUCKET = "bucket_distance_ratio long_short_bucket_imbalance long_liq_share short_liq_share heatmap_intensity_score".split()


@query(
    "m25_bucket_labels",
    """with b as (select *, coalesce(long_sum, 0) as l, coalesce(short_sum, 0) as s, abs(coalesce(distance_pct, 999)) as far, coalesce(rank_score, 0) as r from v_liq_priced)
      select obs_id, (price_bucket - close_price) / nullif(close_price, 0) as bucket_distance_ratio, (l - s) / nullif(l + s, 0) as long_short_bucket_imbalance, l / nullif(l + s, 0) as long_liq_share, s / nullif(l + s, 0) as short_liq_share,
        case when close_price is null then 'UNKNOWN' when price_bucket > close_price then 'ABOVE_PRICE' when price_bucket < close_price then 'BELOW_PRICE' else 'AT_PRICE' end as bucket_location, case when far <= 1 then 'NEAR_SPOT' when far <= 3 then 'MID_RANGE' when far <= 7 then 'FAR_RANGE' else 'TAIL_RANGE' end as distance_band,
        case when r >= 0.75 then 'EXTREME_CLUSTER' when r >= 0.5 then 'HIGH_CLUSTER' when r >= 0.25 then 'MEDIUM_CLUSTER' else 'LOW_CLUSTER' end as heatmap_intensity_label, greatest(0, least(100, r * 60 + coalesce(panic_norm, 0) * 20 + abs(coalesce(magnet_norm, 0)) * 20)) as heatmap_intensity_score from b""",
    " ".join(_BUCKET),
    8,
)
def bucket_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enrichment.bucket_labels(view(spark, sf_dir, "v_liq_priced")).select("obs_id", *_BUCKET, "bucket_location", "distance_band", "heatmap_intensity_label")


@query(
    "m44_recent_runs",
    """select run_id, max(check_ts) as latest_check_ts, count(*) as total_checks, count(*) filter (success) as passed_checks, count(*) filter (not success) as failed_checks, count(*) filter (not success and severity = 'critical') as failed_critical_checks, count(*) filter (not success and severity = 'warning') as failed_warning_checks,
        case when count(*) filter (not success and severity = 'critical') > 0 then 'FAILED' when count(*) filter (not success and severity = 'warning') > 0 then 'WARNING' else 'HEALTHY' end as pipeline_health_status
      from v_checks where check_ts >= timestamp '2024-01-24 12:00:00' - interval 7 day and run_id is not null group by 1""",
)
def recent_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return Q.recent_runs(view(spark, sf_dir, "v_checks"), F.lit("2024-01-24 12:00:00").cast("timestamp_ntz"))


def _count(name: str, rule: str, sql: str, severity: str = "error", shown: str = "''") -> str:
    return f"select '{name}' as table_name, '{rule}' as rule_name, '{severity}' as severity, ({sql}) as violations, ({shown}) as offenders"


def _shown(values: str) -> str:
    """The first three values of a query with one column v, as text."""
    return f"select coalesce(string_agg(v, ',' order by v), '') from (select distinct v::varchar as v from ({values}) q order by 1 limit 3) z"


def _lost(child: str, key: str, parent: str, parent_key: str, where: str = "true") -> tuple[str, str]:
    rows = f"from {child} where {key} is not null and {key} not in (select {parent_key} from {parent} where {where})"
    return f"select count(*) {rows}", _shown(f"select {key} as v {rows}")


def _related(child: str, key: str, parent: str, parent_key: str, where: str | None = None) -> str:
    count, shown = _lost(child, key, parent, parent_key, where or "true")
    kept = f"[{where}]" if where else ""
    return _count(child, f"relationship:{key}->{parent}({parent_key}){kept}", count, shown=shown)


_RULES = {
    "customer": [_count("customer", "between:c_acctbal", "select count(*) from customer where c_acctbal < -900 or c_acctbal > 9000", "warning", _shown("select c_acctbal as v from customer where c_acctbal < -900 or c_acctbal > 9000")), _related("customer", "c_nationkey", "nation", "n_nationkey", "n_regionkey < 4")],
    "nation": [_count("nation", "unique:n_nationkey", "select count(*) - count(distinct n_nationkey) from nation"), _related("nation", "n_regionkey", "region", "r_regionkey")],
    "orders": [_count("orders", "accepted:o_orderpriority", "select count(*) from orders where o_orderpriority not in ('1-URGENT', '2-HIGH')", "warning", _shown("select o_orderpriority as v from orders where o_orderpriority not in ('1-URGENT', '2-HIGH')")), _related("orders", "o_custkey", "customer", "c_custkey")],
    "lineitem": [
        _count("lineitem", "unique:l_orderkey,l_linenumber", "select coalesce(sum(n - 1), 0)::bigint from (select count(*) as n from lineitem group by l_orderkey, l_linenumber) g", shown=_shown("select l_orderkey || '|' || l_linenumber as v from lineitem group by l_orderkey, l_linenumber having count(*) > 1")),
        _count("lineitem", "not_null:l_shipdate", "select count(*) from lineitem where l_shipdate is null"), _related("lineitem", "l_orderkey", "orders", "o_orderkey", "o_totalprice > 20000"), _related("lineitem", "l_partkey", "part", "p_partkey"),
    ],
}


@query("q15_suite", f"select *, violations = 0 as passed from ({' union all '.join(r for rows in _RULES.values() for r in rows)}) x")
def rule_suite(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q15, Q4: value rules, unique combinations and relationships over six tables, with the first offenders."""
    of = {t: table(spark, sf_dir, t) for t in ("customer", "nation", "orders", "lineitem", "region", "part")}
    relation = suite.Relationship
    tables = {
        "customer": suite.Table(of["customer"], [Q.Rule("between", ["c_acctbal"], -900, 9000, severity="warning")], [relation(["c_nationkey"], "nation", ["n_nationkey"], "n_regionkey < 4")]),
        "nation": suite.Table(of["nation"], [Q.Rule("unique", ["n_nationkey"])], [relation(["n_regionkey"], "region", ["r_regionkey"])]),
        "orders": suite.Table(of["orders"], [Q.Rule("accepted", ["o_orderpriority"], values=["1-URGENT", "2-HIGH"], severity="warning")], [relation(["o_custkey"], "customer", ["c_custkey"])]),
        "lineitem": suite.Table(of["lineitem"], [Q.Rule("unique", ["l_orderkey", "l_linenumber"]), Q.Rule("not_null", ["l_shipdate"])], [relation(["l_orderkey"], "orders", ["o_orderkey"], "o_totalprice > 20000"), relation(["l_partkey"], "part", ["p_partkey"])]),
        "region": suite.Table(of["region"]),
        "part": suite.Table(of["part"]),
    }
    return suite.run(tables)
