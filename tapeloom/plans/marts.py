"""Further marts: joined context, backfills, predictions, walk-forward scores, research features."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tapeloom.functions import columns as C
from tapeloom.mlops import metrics as M
from tapeloom.operators import dedupe, joins, series
from tapeloom.plans.features import by_symbol
from tapeloom.plans.market import etf_daily, liquidation_buckets, macro_daily
from tapeloom.plans.registry import SQL, query
from tapeloom.plans.standins import table, view


@query(
    "j12_three_series",
    """with t as (select date_trunc('hour', trade_ts)::timestamp as hour_ts, avg(price) as px from v_s_trades group by 1), l as (select date_trunc('hour', liq_ts)::timestamp as hour_ts, sum(price * quantity) as liq from v_s_liq group by 1), o as (select date_trunc('hour', sent_ts)::timestamp as hour_ts, max(oi_delta_pct) as oi from v_s_sent group by 1)
      select hour_ts, px, liq, oi from t join l using (hour_ts) join o using (hour_ts)""",
    "px liq oi",
)
def three_series(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Inner joins of hourly series, each aggregated first."""
    hour = lambda c: F.date_trunc("hour", c).cast("timestamp_ntz").alias("hour_ts")
    t = view(spark, sf_dir, "v_s_trades").groupBy(hour("trade_ts")).agg(F.avg("price").alias("px"))
    liq = view(spark, sf_dir, "v_s_liq").groupBy(hour("liq_ts")).agg(F.sum(F.col("price") * F.col("quantity")).alias("liq"))
    o = view(spark, sf_dir, "v_s_sent").groupBy(hour("sent_ts")).agg(F.max("oi_delta_pct").alias("oi"))
    return t.join(liq, "hour_ts").join(o, "hour_ts")


@query(
    "j14_bucket_context",
    """with b as (select cast(date_trunc('day', liq_ts) as date) as day, symbol, floor(price / 50) * 50 as price_bucket, sum(price * quantity) as liq_usd from v_s_liq group by 1, 2, 3), c as (select cast(trade_ts as date) as day, symbol, avg(price) as spot from v_s_trades group by 1, 2)
      select b.day, b.symbol, price_bucket, liq_usd, (price_bucket - spot) / spot * 100 as distance_pct, case when spot is null then 'NO_PRICE' when price_bucket > spot then 'ABOVE' else 'BELOW' end as bucket_location, least(100.0, liq_usd / 100) as intensity from b left join c on b.day = c.day and b.symbol = c.symbol""",
    "price_bucket liq_usd distance_pct intensity",
)
def bucket_context(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Buckets with the day's price where there is one."""
    c = view(spark, sf_dir, "v_s_trades").groupBy(F.to_date("trade_ts").alias("day"), "symbol").agg(F.avg("price").alias("spot"))
    b = liquidation_buckets(spark, sf_dir).select("day", "symbol", "price_bucket", "liq_usd").join(c, ["day", "symbol"], "left")
    px, spot = F.col("price_bucket"), F.col("spot")
    return b.select("day", "symbol", "price_bucket", "liq_usd", ((px - spot) / spot * 100).alias("distance_pct"), C.label_by([(spot.isNull(), "NO_PRICE"), (px > spot, "ABOVE")], "BELOW").alias("bucket_location"), C.clamp(F.col("liq_usd") / 100, 0, 100).alias("intensity"))


@query(
    "m31_macro_etf_daily",
    "with m as (" + SQL["m10_macro_daily"] + "), e as (" + SQL["m11_etf_daily"] + ") select price_date, macro_risk_regime, sp500_return_1d, weighted_return, flow_proxy, case when macro_risk_regime = 'RISK_ON' and flow_proxy > 0 then 'SUPPORTIVE' when macro_risk_regime in ('RISK_OFF', 'DEFENSIVE') and flow_proxy < 0 then 'HOSTILE' else 'MIXED' end as backdrop from m join e using (price_date)",
    "sp500_return_1d weighted_return flow_proxy",
)
def macro_etf(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two daily plans side by side with one label."""
    from tapeloom.plans.registry import rounded

    j = rounded(macro_daily(spark, sf_dir)).join(rounded(etf_daily(spark, sf_dir)), "price_date")
    r, f = F.col("macro_risk_regime"), F.col("flow_proxy")
    return j.select("price_date", "macro_risk_regime", "sp500_return_1d", "weighted_return", "flow_proxy", C.label_by([((r == "RISK_ON") & (f > 0), "SUPPORTIVE"), (r.isin("RISK_OFF", "DEFENSIVE") & (f < 0), "HOSTILE")], "MIXED").alias("backdrop"))


@query(
    "m38_microstructure",
    """with r as (select hour_ts, symbol, taker_buy_ratio as t, taker_buy_ratio - lag(taker_buy_ratio) over w as d1, taker_buy_ratio - lag(taker_buy_ratio, 4) over w as d4 from v_hourly window w as (partition by symbol order by hour_ts))
      select hour_ts, symbol, d1 as taker_delta_1, d4 as taker_delta_4, case when count(t) over p >= 2 then avg(t) over p end as past_pressure_4, case when t > 0.65 then 1 else 0 end as is_buy_burst from r window p as (partition by symbol order by hour_ts rows between 4 preceding and 1 preceding)""",
    "taker_delta_1 taker_delta_4 past_pressure_4",
)
def microstructure(spark: SparkSession, sf_dir: str) -> DataFrame:
    t = F.col("taker_buy_ratio")
    return view(spark, sf_dir, "v_hourly").select("hour_ts", "symbol", C.delta(t, by_symbol()).alias("taker_delta_1"), C.delta(t, by_symbol(), 4).alias("taker_delta_4"), series.past_rolling(t, by_symbol(), 4, "mean", 2).alias("past_pressure_4"), (t > 0.65).cast("int").alias("is_buy_burst"))


@query(
    "m43_predictions_latest",
    """with active as (select distinct source as slice from documents where source in ('src1', 'src2', 'src3', 'src5')), p as (select v.*, row_number() over (partition by slice order by doc_id desc) as rn from v_pred v join active using (slice))
      select slice, doc_id, predicted, score, case when score >= 0.6 then 'CONFIDENT' else 'UNSURE' end as confidence_label from p where rn = 1""",
    "score",
)
def predictions_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of active models, the latest of each."""
    active = table(spark, sf_dir, "documents").where("source in ('src1', 'src2', 'src3', 'src5')").select(F.col("source").alias("slice")).distinct()
    last = dedupe.keep_latest(view(spark, sf_dir, "v_pred").join(active, "slice"), ["slice"], [F.col("doc_id")])
    return last.select("slice", "doc_id", "predicted", "score", F.when(F.col("score") >= 0.6, "CONFIDENT").otherwise("UNSURE").alias("confidence_label"))


@query(
    "m52_funding_backfill",
    """with s as (select symbol, cast(unnest(generate_series(date_trunc('hour', min(sent_ts)), date_trunc('hour', max(sent_ts)), interval 1 hour)) as timestamp) as hour_ts from v_s_sent group by 1)
      select s.symbol, s.hour_ts, coalesce(f.funding_rate_pct, 0.0) as funding_rate_pct, f.sent_id is null as is_default, s.hour_ts + interval 10 minute as available_at from s left join lateral (select * from v_s_sent x where x.symbol = s.symbol and x.sent_ts <= s.hour_ts order by x.sent_ts desc limit 1) f on true""",
    "funding_rate_pct",
    7,
)
def funding_backfill(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hour spine, last settlement known, default before the first; available ten minutes on."""
    sent = view(spark, sf_dir, "v_s_sent")
    grid = series.spine(sent.withColumn("hour_ts", F.date_trunc("hour", "sent_ts").cast("timestamp_ntz")), ["symbol"], "hour_ts")
    j = joins.asof_join(grid, sent, ["symbol"], "hour_ts", "sent_ts", ["sent_id"], ["funding_rate_pct", "sent_id"])
    return j.select("symbol", "hour_ts", C.zero("funding_rate_pct").alias("funding_rate_pct"), F.col("sent_id").isNull().alias("is_default"), (F.col("hour_ts") + F.expr("interval 10 minutes")).alias("available_at"))


@query(
    "l13_walk_forward_scores",
    """with p as (select doc_id, actual, predicted from v_pred), t as (select doc_id, row_number() over (order by doc_id) - 1 as n, count(*) over () as total from (select distinct doc_id from p) d), f as (select unnest(range(0, 3)) as fold), b as (select fold, total, cast(floor(total * 0.5) as bigint) as s from f, (select max(total) as total from t) m),
      c as (select fold, s + cast(floor((total - s) / 3.0 * fold) as bigint) as a, case when fold = 2 then total else s + cast(floor((total - s) / 3.0 * (fold + 1)) as bigint) end as z from b),
      x as (select fold, case when n < a then 'train' else 'test' end as role, avg((actual = predicted)::int) as acc from p join t using (doc_id) join c on n < z group by 1, 2)
      select fold, max(acc) filter (role = 'train') as train_accuracy, max(acc) filter (role = 'test') as test_accuracy, max(acc) filter (role = 'train') - max(acc) filter (role = 'test') > 0.08 as is_overfit from x group by 1""",
    "train_accuracy test_accuracy",
)
def walk_forward_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fold scores and the overfit flag."""
    placed = series.walk_forward(view(spark, sf_dir, "v_pred"), "doc_id", 3)
    m = M.classification(placed, ["fold", "role"], [0, 1])
    g = m.groupBy(F.col("fold").cast("long").alias("fold")).agg(F.max(F.when(F.col("role") == "train", F.col("accuracy"))).alias("train_accuracy"), F.max(F.when(F.col("role") == "test", F.col("accuracy"))).alias("test_accuracy"))
    return g.withColumn("is_overfit", F.col("train_accuracy") - F.col("test_accuracy") > 0.08)


@query(
    "l14_research_features",
    """with r as (select *, (close_price - lag(close_price) over w) / nullif(lag(close_price) over w, 0) as ret, avg(close_price) over (partition by hour_ts) as market from v_hourly window w as (partition by symbol order by hour_ts)), f as (select hour_ts, symbol, lag(ret, 4) over w as lag_4, lag(ret, 12) over w as lag_12, case when count(ret) over p >= 6 then avg(ret) over p end as roll_12, close_price / nullif(market, 0) as relative_price from r window w as (partition by symbol order by hour_ts), p as (partition by symbol order by hour_ts rows between 12 preceding and 1 preceding))
      select *, roll_12 * relative_price as symbol_interaction from f""",
    "lag_4 lag_12 roll_12 relative_price symbol_interaction",
)
def research_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lags, rolls and interactions of the symbol with the market."""
    px = F.col("close_price")
    r = view(spark, sf_dir, "v_hourly").withColumns({"ret": C.pct_change(px, by_symbol()), "market": F.avg(px).over(Window.partitionBy("hour_ts"))})
    f = r.select("hour_ts", "symbol", F.lag("ret", 4).over(by_symbol()).alias("lag_4"), F.lag("ret", 12).over(by_symbol()).alias("lag_12"), series.past_rolling(F.col("ret"), by_symbol(), 12, "mean", 6).alias("roll_12"), C.safe_div(px, F.col("market")).alias("relative_price"))
    return f.withColumn("symbol_interaction", F.col("roll_12") * F.col("relative_price"))


@query(
    "l19_feature_groups",
    """with f as (select 'l_discount' as feature, corr(l_discount, l_extendedprice) as c from lineitem union all select 'l_tax', corr(l_tax, l_extendedprice) from lineitem union all select 'l_quantity', corr(l_quantity, l_extendedprice) from lineitem)
      select case when feature like '%tax%' or feature like '%discount%' then 'rate' else 'size' end as feature_group, count(*) as features, max(abs(c)) as best_correlation, arg_max(feature, (abs(c), feature)) as best_feature from f group by 1""",
    "best_correlation",
)
def feature_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Families by name, summarised."""
    c = M.target_correlation(table(spark, sf_dir, "lineitem"), "l_extendedprice", ["l_discount", "l_tax", "l_quantity"])
    group = F.when(F.col("feature").contains("tax") | F.col("feature").contains("discount"), "rate").otherwise("size")
    r = F.abs("correlation")
    return c.groupBy(group.alias("feature_group")).agg(F.count(F.lit(1)).alias("features"), F.max(r).alias("best_correlation"), C.arg_first(F.col("feature"), r, F.col("feature")).alias("best_feature"))


@query(
    "f03_text_and_time",
    """select o_orderkey, upper(substr(o_orderpriority, 3, 1)) || lower(substr(o_orderpriority, 4)) as label, string_split(o_orderpriority, '-')[1] as code, strpos(o_orderpriority, 'URGENT') > 0 as is_urgent, replace(o_orderpriority, '-', '_') as slug, date_diff('day', o_orderdate::date, date '2000-01-01') as age_days,
      strftime(o_orderdate, '%Y-%m') as month_text, date_trunc('quarter', o_orderdate)::date as quarter_start, (o_orderdate::date + interval 1 day)::timestamp + interval 270 minute as available_at, sign(o_totalprice - 100000) as side from orders""",
    "side",
)
def text_and_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """string and date functions."""
    p, d = F.col("o_orderpriority"), F.col("o_orderdate")
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", F.concat(F.upper(F.substring(p, 3, 1)), F.lower(F.substring(p, 4, 100))).alias("label"), F.try_element_at(F.split(p, "-"), F.lit(1)).alias("code"), (F.instr(p, "URGENT") > 0).alias("is_urgent"), F.replace(p, F.lit("-"), F.lit("_")).alias("slug"),
        F.datediff(F.lit("2000-01-01").cast("date"), F.to_date(d)).cast("long").alias("age_days"), F.date_format(d, "yyyy-MM").alias("month_text"), F.date_trunc("quarter", d).cast("date").alias("quarter_start"),
        (F.date_add(F.to_date(d), 1).cast("timestamp_ntz") + F.expr("interval 270 minutes")).alias("available_at"), F.signum(F.col("o_totalprice") - 100000).alias("side"),
    )
