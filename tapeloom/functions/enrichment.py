"""What a collection run adds to its observations: pegs and liquidity of stablecoins, reserves and risks of exchanges.

Shares are of a run's total, so ``run`` names the columns that tell runs apart. Bounds and labels are fixed values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tapeloom.functions.columns import label_by, safe_div


def _share(x: str, run: Sequence[str]) -> Column:
    total = F.sum(x).over(Window.partitionBy(*run))  # a row a coin or exchange and run
    return F.when(total > 0, F.col(x) / total * 100).otherwise(F.lit(0.0))


def _positive_ratio(a: str, b: str) -> Column:
    return F.when(F.col(b) > 0, F.col(a) / F.col(b))


def coin_features(df: DataFrame, run: Sequence[str], at: str) -> DataFrame:
    """M49. df: price_usd, market_cap_usd, volume_24h_usd, circulating_supply, total_supply and ``at``, the time of the run.

    A missing or zero price has no deviation. Without market value the turnover is null, which counts as 0 in the risk
    and leaves the liquidity score null.
    """
    deviation = F.when(F.coalesce(F.col("price_usd"), F.lit(0.0)) != 0, (F.col("price_usd") - 1) * 100).otherwise(F.lit(0.0))
    out = df.withColumns({"peg_deviation_pct": deviation, "utilization_ratio": _positive_ratio("circulating_supply", "total_supply"), "volume_to_marketcap": _positive_ratio("volume_24h_usd", "market_cap_usd")})
    dev, turnover, cap = F.col("peg_deviation_pct"), F.col("volume_to_marketcap"), F.col("market_cap_usd")
    angle = F.lit(2.0) * F.pi() * F.hour(at) / 24
    return out.withColumns(
        {
            "peg_regime": label_by([(dev >= 0.5, "premium"), (dev <= -0.5, "depeg_risk")], "stable"),
            "stablecoin_dominance_pct": _share("market_cap_usd", run),
            "depeg_risk_score": F.abs(dev) * F.coalesce(turnover, F.lit(0.0)),
            "liquidity_tier": label_by([(cap >= 5e10, "mega"), (cap >= 5e9, "large"), (cap >= 5e8, "medium")], "small"),
            "liquidity_score": F.log1p("market_cap_usd") * 0.5 + turnover * 0.3 - F.abs(dev) * 0.2,
            **{f"{c}_log": F.log1p(c) for c in ("market_cap_usd", "volume_24h_usd", "circulating_supply")},
            "is_peg_outlier": (F.abs(dev) > 2).cast("int"),
            "is_volume_outlier": F.coalesce((turnover > 1.5).cast("int"), F.lit(0)),
            "hour_sin": F.sin(angle),
            "hour_cos": F.cos(angle),
        }
    )


def reserve_features(df: DataFrame, run: Sequence[str]) -> DataFrame:
    """M50. df: first_reserve_usd and second_reserve_usd (two sources), trade_volume_24h_btc, trade_volume_24h_btc_normalized,
    btc_price_usd and trust_score.

    The first source's reserve counts where it is above zero, else the second's, else 0; a reserve of 0 counts as 1 in
    ratios. The source is named by what is known, a zero included. Washed volume is what normalising takes away.
    """
    first, second = F.col("first_reserve_usd"), F.col("second_reserve_usd")
    out = df.withColumns(
        {
            "actual_reserve_usd": F.coalesce(F.when(first > 0, first).otherwise(second), F.lit(0.0)),
            "data_source": label_by([(first.isNotNull(), "DefiLlama"), (second.isNotNull(), "Arkham")], "Missing"),
            "trade_volume_24h_usd": F.col("trade_volume_24h_btc") * F.col("btc_price_usd"),
            "trade_volume_24h_usd_normalized": F.col("trade_volume_24h_btc_normalized") * F.col("btc_price_usd"),
        }
    )
    use = F.col("trade_volume_24h_usd") / F.when(F.col("actual_reserve_usd") == 0, F.lit(1.0)).otherwise(F.col("actual_reserve_usd"))
    out = out.withColumns({"reserve_utilization": use, "reserve_dominance_pct": _share("actual_reserve_usd", run), "wash_trading_volume_usd": F.col("trade_volume_24h_usd") - F.col("trade_volume_24h_usd_normalized")})
    used, trust, volume = F.col("reserve_utilization"), F.col("trust_score"), F.col("trade_volume_24h_usd")
    return out.withColumns(
        {
            "bank_run_risk": label_by([((used > 1.0) & (trust < 8), "HIGH_RISK"), ((used < 0.5) & (trust >= 9), "SAFE")], "MODERATE"),
            "concentration_risk_score": F.col("reserve_dominance_pct") * used,
            "liquidity_score": trust * F.col("trade_volume_24h_usd_normalized"),
            "exchange_tier": label_by([(volume >= 1e10, "tier_1"), (volume >= 1e9, "tier_2"), (volume >= 1e8, "tier_3")], "tier_4"),
            "whale_withdrawal_risk": F.abs("wash_trading_volume_usd") * used,
        }
    )


def bucket_labels(df: DataFrame) -> DataFrame:
    """M25. Adds to liquidation buckets (price_bucket, close_price, distance_pct, long_sum, short_sum, rank_score, panic_norm,
    magnet_norm) where they lie, how far from the price, their sides' shares and how intense they are."""
    long_, short = (F.coalesce(F.col(c), F.lit(0.0)) for c in ("long_sum", "short_sum"))
    price, bucket, far = F.col("close_price"), F.col("price_bucket"), F.abs(F.coalesce(F.col("distance_pct"), F.lit(999.0)))
    rank = F.coalesce(F.col("rank_score"), F.lit(0.0))
    intensity = rank * 60 + F.coalesce(F.col("panic_norm"), F.lit(0.0)) * 20 + F.abs(F.coalesce(F.col("magnet_norm"), F.lit(0.0))) * 20
    return df.withColumns(
        {
            "bucket_distance_ratio": safe_div(bucket - price, price),
            "long_short_bucket_imbalance": safe_div(long_ - short, long_ + short),
            "long_liq_share": safe_div(long_, long_ + short),
            "short_liq_share": safe_div(short, long_ + short),
            "bucket_location": label_by([(price.isNull(), "UNKNOWN"), (bucket > price, "ABOVE_PRICE"), (bucket < price, "BELOW_PRICE")], "AT_PRICE"),
            "distance_band": label_by([(far <= 1, "NEAR_SPOT"), (far <= 3, "MID_RANGE"), (far <= 7, "FAR_RANGE")], "TAIL_RANGE"),
            "heatmap_intensity_label": label_by([(rank >= 0.75, "EXTREME_CLUSTER"), (rank >= 0.5, "HIGH_CLUSTER"), (rank >= 0.25, "MEDIUM_CLUSTER")], "LOW_CLUSTER"),
            "heatmap_intensity_score": F.greatest(F.lit(0.0), F.least(F.lit(100.0), intensity)),
        }
    )
