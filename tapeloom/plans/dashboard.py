"""Dashboard plans: regimes, shares, levels, signals, alerts, daily risk and the latest KPIs."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeloom.functions import columns as C
from tapeloom.mlops import training
from tapeloom.operators import dedupe, series
from tapeloom.plans.features import by_symbol
from tapeloom.plans.market import TRADES_HOURLY_SQL, reserve_enriched, trades_hourly
from tapeloom.plans.registry import query
from tapeloom.plans.standins import table, view


@query(
    "m22_market_overview",
    f"""with m as ({TRADES_HOURLY_SQL}) select hour_ts, symbol, close_price - open_price as candle_body, high_price - low_price as candle_range, (close_price - open_price) / nullif(high_price - low_price, 0) as body_ratio,
        (taker_buy_quote_volume - taker_sell_quote_volume) / nullif(quote_volume, 0) as taker_imbalance, case when close_price > open_price then 'GREEN' when close_price < open_price then 'RED' else 'DOJI' end as candle_color,
        case when quote_volume_zscore_24h >= 2 then 'SPIKE' when quote_volume_zscore_24h <= -1 then 'DRY' when quote_volume_zscore_24h is null then 'UNKNOWN' else 'NORMAL' end as volume_regime,
        case when realized_volatility_24h >= 1.5 then 'HIGH' when realized_volatility_24h >= 0.8 then 'MEDIUM' when realized_volatility_24h is null then 'UNKNOWN' else 'LOW' end as volatility_regime from m""",
    "candle_body candle_range body_ratio taker_imbalance",
)
def market_overview(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = trades_hourly(view(spark, sf_dir, "v_trades"))
    body, span, z, vol = F.col("close_price") - F.col("open_price"), F.col("high_price") - F.col("low_price"), F.col("quote_volume_zscore_24h"), F.col("realized_volatility_24h")
    return m.select(
        "hour_ts", "symbol", body.alias("candle_body"), span.alias("candle_range"), C.safe_div(body, span).alias("body_ratio"), C.safe_div(F.col("taker_buy_quote_volume") - F.col("taker_sell_quote_volume"), F.col("quote_volume")).alias("taker_imbalance"),
        C.label_by([(body > 0, "GREEN"), (body < 0, "RED")], "DOJI").alias("candle_color"), C.label_by([(z >= 2, "SPIKE"), (z <= -1, "DRY"), (z.isNull(), "UNKNOWN")], "NORMAL").alias("volume_regime"),
        C.label_by([(vol >= 1.5, "HIGH"), (vol >= 0.8, "MEDIUM"), (vol.isNull(), "UNKNOWN")], "LOW").alias("volatility_regime"),
    )


@query(
    "m23_derivatives_risk",
    """with l as (select date_trunc('day', liq_ts)::date as day, symbol, sum(case when side = 'SELL' then price * quantity else 0 end) as long_usd, sum(price * quantity) as usd from v_s_liq group by 1, 2)
      select day, symbol, 100.0 * long_usd / nullif(usd, 0) as long_share_pct, 100.0 * usd / nullif(sum(usd) over (partition by day), 0) as day_share_pct, case when long_usd > 0.6 * usd then 'LONG_FLUSH' when long_usd < 0.4 * usd then 'SHORT_SQUEEZE' else 'BALANCED' end as liquidation_bias,
        case when usd >= 20000 then 'CRITICAL' when usd >= 8000 then 'HIGH' when usd >= 3000 then 'MEDIUM' else 'LOW' end as alert_level from l""",
    "long_share_pct day_share_pct",
)
def derivatives_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    usd = F.col("price") * F.col("quantity")
    d = view(spark, sf_dir, "v_s_liq").groupBy(F.to_date("liq_ts").alias("day"), "symbol").agg(C.sum_if(F.col("side") == "SELL", usd).alias("long_usd"), F.sum(usd).alias("usd"))
    long_, all_ = F.col("long_usd"), F.col("usd")
    return d.select(
        "day", "symbol", C.safe_div(F.lit(100.0) * long_, all_).alias("long_share_pct"), C.safe_div(F.lit(100.0) * all_, F.sum("usd").over(Window.partitionBy("day"))).alias("day_share_pct"),
        C.label_by([(long_ > all_ * 0.6, "LONG_FLUSH"), (long_ < all_ * 0.4, "SHORT_SQUEEZE")], "BALANCED").alias("liquidation_bias"), C.label_by([(all_ >= 20000, "CRITICAL"), (all_ >= 8000, "HIGH"), (all_ >= 3000, "MEDIUM")], "LOW").alias("alert_level"),
    )


@query(
    "m24_options_risk",
    """with o as (select month_date, symbol, avg(mark_iv) as iv, avg(case when option_type = 'P' then mark_iv end) - avg(case when option_type = 'C' then mark_iv end) as skew, sum(delta * open_interest) as dx from v_options group by 1, 2)
      select month_date, symbol, iv, skew, case when iv >= percentile_cont(0.8) within group (order by iv) over () then 'HIGH_IV' else 'NORMAL_IV' end as iv_regime, case when skew > 0.2 then 'PUT_SKEW' when skew < -0.2 then 'CALL_SKEW' else 'FLAT' end as skew_label from o""".replace(
        "percentile_cont(0.8) within group (order by iv) over ()", "(select quantile_cont(iv, 0.8) from o)"
    ),
    "iv skew",
)
def options_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    iv = F.col("mark_iv")
    o = view(spark, sf_dir, "v_options").groupBy("month_date", "symbol").agg(F.avg(iv).alias("iv"), (C.avg_if(F.col("option_type") == "P", iv) - C.avg_if(F.col("option_type") == "C", iv)).alias("skew"))
    high = o.agg(F.percentile("iv", 0.8).alias("high"))
    j = o.crossJoin(F.broadcast(high))  # one row
    return j.select("month_date", "symbol", "iv", "skew", F.when(F.col("iv") >= F.col("high"), "HIGH_IV").otherwise("NORMAL_IV").alias("iv_regime"), C.label_by([(F.col("skew") > 0.2, "PUT_SKEW"), (F.col("skew") < -0.2, "CALL_SKEW")], "FLAT").alias("skew_label"))


@query(
    "m46_liquidation_heatmap",
    """with s as (select trade_ts, symbol, trade_id, price, quantity, price * quantity as usd, price - lag(price) over w as d, (price - lag(price) over w) / nullif(lag(price) over w, 0) as r, avg(quantity) over (partition by symbol order by trade_ts, trade_id rows between 11 preceding and current row) as qm, quantity - lag(quantity) over w as qd from v_trades window w as (partition by symbol order by trade_ts, trade_id)),
      l as (select symbol, arg_max(price, (trade_ts, trade_id)) as spot from v_trades group by 1),
      b as (select symbol, round(price / 25) * 25 as price_bucket, sum(usd) as total_usd, avg(quantity) as oi_avg, count(*) as hit_count, avg(tanh(coalesce(qd, 0) / (qm + 1e-9) * coalesce(r, 0))) as avg_money_flow, sum(quantity) as vol_sum from s group by 1, 2),
      m as (select b.*, (price_bucket - spot) / spot * 100 as distance_pct, total_usd * oi_avg / (vol_sum + 1e-9) * exp(-abs((price_bucket - spot) / spot * 100) / 5) as magnet from b join l using (symbol))
      select symbol, price_bucket, total_usd, hit_count, avg_money_flow, distance_pct, tanh((magnet - avg(magnet) over (partition by symbol)) / (stddev_samp(magnet) over (partition by symbol) + 1e-9)) as magnet_norm,
        case when distance_pct > 1 then 'ABOVE' when distance_pct < -1 then 'BELOW' else 'AT_SPOT' end as bucket_location from m""",
    "price_bucket total_usd avg_money_flow distance_pct magnet_norm",
)
def heatmap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Value by price bucket, money flow squeezed by tanh, distance decay, magnet score against its symbol's."""
    over = series.by(["symbol"], ["trade_ts", "trade_id"])
    px, q = F.col("price"), F.col("quantity")
    trades = view(spark, sf_dir, "v_trades")
    s = trades.withColumns({"r": C.zero(C.pct_change(px, over)), "qd": C.zero(C.delta(q, over)), "qm": F.avg(q).over(series.last_rows(over, 12))}).withColumn("flow", F.tanh(F.col("qd") / (F.col("qm") + 1e-9) * F.col("r")))
    spot = trades.groupBy("symbol").agg(F.max_by("price", F.struct("trade_ts", "trade_id")).alias("spot"))
    b = s.groupBy("symbol", (F.round(px / 25) * 25).alias("price_bucket")).agg(F.sum(px * q).alias("total_usd"), F.avg(q).alias("oi_avg"), F.count(F.lit(1)).alias("hit_count"), F.avg("flow").alias("avg_money_flow"), F.sum(q).alias("vol_sum"))
    dist = (F.col("price_bucket") - F.col("spot")) / F.col("spot") * 100
    m = b.join(spot, "symbol").withColumn("distance_pct", dist).withColumn("magnet", F.col("total_usd") * F.col("oi_avg") / (F.col("vol_sum") + 1e-9) * F.exp(-F.abs("distance_pct") / 5))
    of = Window.partitionBy("symbol")  # buckets of a symbol
    norm = F.tanh((F.col("magnet") - F.avg("magnet").over(of)) / (F.stddev_samp("magnet").over(of) + 1e-9))
    return m.select("symbol", "price_bucket", "total_usd", "hit_count", "avg_money_flow", "distance_pct", norm.alias("magnet_norm"), C.label_by([(F.col("distance_pct") > 1, "ABOVE"), (F.col("distance_pct") < -1, "BELOW")], "AT_SPOT").alias("bucket_location"))


@query(
    "m29_exchange_risk_latest",
    """with e as (select month_date, exchange, trade_volume_24h_usd / nullif(actual_reserve_usd, 0) as u, actual_reserve_usd as r from v_reserve), l as (select *, row_number() over (partition by exchange order by month_date desc) as rn, lag(u) over (partition by exchange order by month_date) as pu from e)
      select exchange, month_date, u as utilization, case when pu is null then 'NEW' when u > pu then 'WORSENING' when u < pu then 'IMPROVING' else 'STABLE' end as trend, case when u > 45 then 'HIGH' when u > 30 then 'MEDIUM' else 'LOW' end as risk_badge from l where rn = 1""",
    "utilization",
)
def exchange_risk(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest row of each entity with its trend and badge."""
    e = reserve_enriched(spark, sf_dir)
    over = series.by(["exchange"], ["month_date"])
    e = e.withColumn("_d", C.delta(F.col("utilization"), over))
    last = dedupe.keep_latest(e, ["exchange"], [F.col("month_date")])
    d, u = F.col("_d"), F.col("utilization")
    return last.select("exchange", "month_date", "utilization", C.label_by([(d.isNull(), "NEW"), (d > 0, "WORSENING"), (d < 0, "IMPROVING")], "STABLE").alias("trend"), C.label_by([(u > 45, "HIGH"), (u > 30, "MEDIUM")], "LOW").alias("risk_badge"))


@query("m21_metric_catalog", "select md5(n_name || '|' || cast(n_regionkey as varchar)) as metric_sk, n_name as metric_name, r_name as metric_group, row_number() over (partition by r_name order by n_name) as sort_order from nation join region on n_regionkey = r_regionkey")
def metric_catalog(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A catalog dimension with surrogate keys and an order within its groups."""
    j = table(spark, sf_dir, "nation").join(table(spark, sf_dir, "region"), F.col("n_regionkey") == F.col("r_regionkey"))
    return j.select(C.surrogate_key(F.col("n_name"), F.col("n_regionkey")).alias("metric_sk"), F.col("n_name").alias("metric_name"), F.col("r_name").alias("metric_group"), F.row_number().over(Window.partitionBy("r_name").orderBy("n_name")).alias("sort_order"))


@query(
    "m51_reserve_proxy",
    """with e as (select *, avg(trade_volume_24h_usd) over (partition by exchange order by month_date rows between 2 preceding and current row) as vol_3 from v_reserve) select month_date, exchange, vol_3 * least(1.0, trust_score / 40) as proxy_reserve,
      vol_3 * least(1.0, trust_score / 40) - lag(vol_3 * least(1.0, trust_score / 40)) over (partition by exchange order by month_date) as proxy_change from e""",
    "proxy_reserve proxy_change",
    7,
)
def reserve_proxy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Smoothed volume discounted by trust stands for reserves; change to the period before."""
    over = series.by(["exchange"], ["month_date"])
    proxy = F.avg("trade_volume_24h_usd").over(series.last_rows(over, 3)) * F.least(F.lit(1.0), F.col("trust_score") / 40)
    return view(spark, sf_dir, "v_reserve").select("month_date", "exchange", proxy.alias("proxy_reserve")).withColumn("proxy_change", C.delta(F.col("proxy_reserve"), over))


# --- M34-M36, M38, L1-L6, L11: the data set, the model and its scores ------------------------------------------------

FEATURES = ["return_1", "return_4", "past_mean_24", "past_volume_z", "taker_z"]


def training_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Past-only features, labels four hours ahead, splits by time, sample weight; rows without a label go."""
    px = F.col("close_price")
    df = view(spark, sf_dir, "v_hourly").withColumns({"return_1": C.pct_change(px, by_symbol()), "return_4": C.pct_change(px, by_symbol(), 4)})
    df = df.withColumns({"past_mean_24": series.past_rolling(F.col("return_1"), by_symbol(), 24, "mean", 12), "past_volume_z": series.past_zscore(F.col("quote_volume"), by_symbol(), 24, 6), "taker_z": series.past_zscore(F.col("taker_buy_ratio"), by_symbol(), None, 24)})
    df = series.forward_labels(df, "close_price", by_symbol(), {4: 0.003})
    df = series.time_split(df, ["symbol"], "hour_ts", [(0.7, "train"), (0.85, "validation"), (1.1, "test")])
    return df.withColumns({"sample_weight": C.clamp(F.abs("future_return_4") / 0.003, 0.1, 10.0), "feature_completeness": C.completeness(FEATURES)}).where("future_direction_4 is not null")


@query(
    "m36_training_dataset",
    """with r as (select *, (close_price - lag(close_price) over w) / nullif(lag(close_price) over w, 0) as return_1, (close_price - lag(close_price, 4) over w) / nullif(lag(close_price, 4) over w, 0) as return_4, (lead(close_price, 4) over w - close_price) / nullif(close_price, 0) as fr, percent_rank() over w as p from v_hourly window w as (partition by symbol order by hour_ts)),
      f as (select hour_ts, symbol, return_1, return_4, case when count(return_1) over q >= 12 then avg(return_1) over q end as past_mean_24, case when count(quote_volume) over q >= 6 then (quote_volume - avg(quote_volume) over q) / nullif(stddev_samp(quote_volume) over q, 0) end as past_volume_z,
        case when count(taker_buy_ratio) over a >= 24 then (taker_buy_ratio - avg(taker_buy_ratio) over a) / nullif(stddev_samp(taker_buy_ratio) over a, 0) end as taker_z, fr, p from r window q as (partition by symbol order by hour_ts rows between 24 preceding and 1 preceding), a as (partition by symbol order by hour_ts rows between unbounded preceding and 1 preceding))
      select hour_ts, symbol, return_1, return_4, past_mean_24, past_volume_z, taker_z, case when fr >= 0.003 then 'UP' when fr <= -0.003 then 'DOWN' else 'FLAT' end as future_direction_4, case when p < 0.7 then 'train' when p < 0.85 then 'validation' else 'test' end as split_name,
        greatest(0.1, least(10.0, abs(fr) / 0.003)) as sample_weight from f where fr is not null""",
    "return_1 return_4 past_mean_24 past_volume_z taker_z sample_weight",
)
def training_dataset(spark: SparkSession, sf_dir: str) -> DataFrame:
    return training_rows(spark, sf_dir).select("hour_ts", "symbol", *FEATURES, "future_direction_4", "split_name", "sample_weight")


@query("l11_model_scores")
def model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fit on the train split, score the others. Fitting is iterative, so there is no SQL for it."""
    rows = training_rows(spark, sf_dir)
    frame = training.training_frame(rows, FEATURES, ["symbol"], "future_direction_4", ["UP", "DOWN", "FLAT"], ["hour_ts", "split_name", "sample_weight", "feature_completeness"])
    train = training.balanced_weights(frame.where("split_name = 'train'"), "sample_weight")
    labels = [r[0] for r in train.select("label_text").distinct().orderBy("label_text").collect()]  # the classes
    model = training.pipeline(FEATURES, ["symbol"]).fit(train)
    scored = training.score(model, frame.where("split_name <> 'train'"), labels, completeness="feature_completeness", min_completeness=0.5)
    return scored.select("hour_ts", "symbol", "split_name", "label_text", "predicted", "confidence", "signal")
