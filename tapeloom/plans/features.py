"""Series features, labels, splits and joins."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tapeloom.functions import columns as C
from tapeloom.operators import chunked, dedupe, joins, series
from tapeloom.plans.registry import query
from tapeloom.plans.standins import table, view


def by_symbol() -> WindowSpec:
    """Rows of a symbol in time order."""
    return series.by(["symbol"], ["hour_ts"])


@query(
    "w03_rolling_features",
    """select hour_ts, symbol, (close_price - lag(close_price, 4) over w) / nullif(lag(close_price, 4) over w, 0) as return_4h, avg(close_price) over w7 as mean_7, stddev_samp(close_price) over w24 as std_24, sum(quote_volume) over w168 as volume_168,
        (quote_volume - avg(quote_volume) over w24) / nullif(stddev_samp(quote_volume) over w24, 0) as volume_z, close_price - lag(close_price, 24) over w as delta_24 from v_hourly
      window w as (partition by symbol order by hour_ts), w7 as (partition by symbol order by hour_ts rows between 6 preceding and current row), w24 as (partition by symbol order by hour_ts rows between 23 preceding and current row),
        w168 as (partition by symbol order by hour_ts rows between 167 preceding and current row)""",
    "return_4h mean_7 std_24 volume_168 volume_z delta_24",
)
def rolling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One shuffle and sort serve every window of a symbol."""
    px, vol = F.col("close_price"), F.col("quote_volume")
    return view(spark, sf_dir, "v_hourly").select(
        "hour_ts", "symbol", C.pct_change(px, by_symbol(), 4).alias("return_4h"), F.avg(px).over(series.last_rows(by_symbol(), 7)).alias("mean_7"), F.stddev_samp(px).over(series.last_rows(by_symbol(), 24)).alias("std_24"),
        F.sum(vol).over(series.last_rows(by_symbol(), 168)).alias("volume_168"), C.zscore(vol, series.last_rows(by_symbol(), 24)).alias("volume_z"), C.delta(px, by_symbol(), 24).alias("delta_24"),
    )


@query(
    "w07_past_only_features",
    """with r as (select *, (close_price - lag(close_price) over w) / nullif(lag(close_price) over w, 0) as ret, case when lag(close_price) over w > 0 and close_price > 0 then ln(close_price / lag(close_price) over w) end as lr from v_hourly window w as (partition by symbol order by hour_ts))
      select hour_ts, symbol, case when count(ret) over p4 >= 2 then avg(ret) over p4 end as past_mean_4, case when count(ret) over p24 >= 12 then sum(ret) over p24 end as past_sum_24,
        case when count(quote_volume) over p24 >= 6 then (quote_volume - avg(quote_volume) over p24) / nullif(stddev_samp(quote_volume) over p24, 0) end as past_volume_z,
        case when count(taker_buy_ratio) over pall >= 24 then (taker_buy_ratio - avg(taker_buy_ratio) over pall) / nullif(stddev_samp(taker_buy_ratio) over pall, 0) end as expanding_z
      from r window p4 as (partition by symbol order by hour_ts rows between 4 preceding and 1 preceding), p24 as (partition by symbol order by hour_ts rows between 24 preceding and 1 preceding), pall as (partition by symbol order by hour_ts rows between unbounded preceding and 1 preceding)""",
    "past_mean_4 past_sum_24 past_volume_z expanding_z",
)
def past_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Nothing of the row's own hour or later enters its mean and deviation."""
    df = view(spark, sf_dir, "v_hourly").withColumn("ret", C.pct_change(F.col("close_price"), by_symbol()))
    return df.select(
        "hour_ts", "symbol", series.past_rolling(F.col("ret"), by_symbol(), 4, "mean", 2).alias("past_mean_4"), series.past_rolling(F.col("ret"), by_symbol(), 24, "sum", 12).alias("past_sum_24"),
        series.past_zscore(F.col("quote_volume"), by_symbol(), 24, 6).alias("past_volume_z"), series.past_zscore(F.col("taker_buy_ratio"), by_symbol(), None, 24).alias("expanding_z"),
    )


@query(
    "w09_drawdown",
    """with r as (select hour_ts, symbol, case when lag(close_price) over w > 0 and close_price > 0 then ln(close_price / lag(close_price) over w) end as lr from v_hourly window w as (partition by symbol order by hour_ts)),
      c as (select hour_ts, symbol, sum(coalesce(lr, 0)) over (partition by symbol order by hour_ts rows between unbounded preceding and current row) as cum_log_return from r)
      select *, cum_log_return - max(cum_log_return) over (partition by symbol order by hour_ts rows between 23 preceding and current row) as drawdown from c""",
    "cum_log_return drawdown",
)
def drawdown(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = view(spark, sf_dir, "v_hourly").withColumn("lr", C.log_return(F.col("close_price"), by_symbol()))
    return series.drawdown(df, "lr", by_symbol(), 24).select("hour_ts", "symbol", "cum_log_return", "drawdown")


@query(
    "m35_forward_labels",
    """with f as (select hour_ts, symbol, close_price, (lead(close_price) over w - close_price) / nullif(close_price, 0) as r1, (lead(close_price, 4) over w - close_price) / nullif(close_price, 0) as r4, (lead(close_price, 24) over w - close_price) / nullif(close_price, 0) as r24,
        lead(close_price) over w as n, case when lag(close_price) over w > 0 and close_price > 0 then ln(close_price / lag(close_price) over w) end as lr from v_hourly window w as (partition by symbol order by hour_ts))
      select hour_ts, symbol, r1 as future_return_1, r4 as future_return_4, r24 as future_return_24, case when r1 >= 0.001 then 'UP' when r1 <= -0.001 then 'DOWN' when r1 is not null then 'FLAT' end as future_direction_1,
        case when r4 >= 0.003 then 'UP' when r4 <= -0.003 then 'DOWN' when r4 is not null then 'FLAT' end as future_direction_4, case when r24 >= 0.01 then 'UP' when r24 <= -0.01 then 'DOWN' when r24 is not null then 'FLAT' end as future_direction_24,
        case when count(lr) over v >= 12 then stddev_samp(lr) over v end as future_volatility_24, r4 > 0 as is_up_4, case when r4 is null then 0.1 else greatest(0.1, least(10.0, abs(r4) / 0.003)) end as sample_weight_4
      from f window v as (partition by symbol order by hour_ts rows between 1 following and 24 following)""",
    "future_return_1 future_return_4 future_return_24 future_volatility_24 sample_weight_4",
)
def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Returns ahead, direction beyond .1, .3 and 1 %, volatility of the next day, sample weight."""
    df = view(spark, sf_dir, "v_hourly").withColumn("lr", C.log_return(F.col("close_price"), by_symbol()))
    df = series.forward_labels(df, "close_price", by_symbol(), {1: 0.001, 4: 0.003, 24: 0.01})
    weight = C.clamp(F.abs("future_return_4") / 0.003, 0.1, 10.0)
    return df.withColumns({"future_volatility_24": series.forward_volatility(F.col("lr"), by_symbol(), 24, 12), "is_up_4": F.col("future_return_4") > 0, "sample_weight_4": F.coalesce(weight, F.lit(0.1))}).drop("close_price", "quote_volume", "taker_buy_ratio", "lr")


@query(
    "w12_time_split",
    """select hour_ts, symbol, case when p < 0.7 then 'train' when p < 0.85 then 'validation' else 'test' end as split_name from (select *, percent_rank() over (partition by symbol order by hour_ts) as p from v_hourly) x""",
)
def split(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.time_split(view(spark, sf_dir, "v_hourly"), ["symbol"], "hour_ts", [(0.7, "train"), (0.85, "validation"), (1.1, "test")]).select("hour_ts", "symbol", "split_name")


@query(
    "w14_latest_flags",
    """select obs_id, row_number() over (partition by symbol order by observed_at desc, obs_id desc) = 1 as is_latest_symbol, row_number() over (partition by exchange, symbol order by observed_at desc, obs_id desc) = 1 as is_latest_pair from v_funding""",
)
def latest_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = [F.col("observed_at").desc(), F.col("obs_id").desc()]
    return dedupe.flag_latest(view(spark, sf_dir, "v_funding"), {"is_latest_symbol": (["symbol"], order), "is_latest_pair": (["exchange", "symbol"], order)}).select("obs_id", "is_latest_symbol", "is_latest_pair")


@query(
    "w15_latest_per_key",
    "select symbol, hour_ts, close_price from (select *, row_number() over (partition by symbol order by hour_ts desc) as rn from v_hourly) x where rn = 1",
    "close_price",
)
def latest_per_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe.keep_latest(view(spark, sf_dir, "v_hourly"), ["symbol"], [F.col("hour_ts")]).select("symbol", "hour_ts", "close_price")


@query(
    "w17_quantile_regime",
    """with q as (select price_date, symbol, adj_close_price as x, quantile_cont(adj_close_price, 1.0/3) over w as a, quantile_cont(adj_close_price, 2.0/3) over w as b from v_daily window w as (partition by symbol order by price_date rows between 90 preceding and 1 preceding))
      select price_date, symbol, case when x <= a then 'LOW' when x >= b then 'HIGH' when a is not null then 'MID' end as regime from q""",
)
def quantile_regime(spark: SparkSession, sf_dir: str) -> DataFrame:
    return view(spark, sf_dir, "v_daily").select("price_date", "symbol", series.regime("adj_close_price", series.by(["symbol"], ["price_date"]), 90).alias("regime"))


@query(
    "w18_range_baseline",
    "select trade_id, symbol, avg(price * quantity) over (partition by symbol order by trade_ts range between interval 6 hour preceding and current row) as baseline from v_trades",
    "baseline",
    8,
)
def range_baseline(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = view(spark, sf_dir, "v_trades").select("trade_id", "symbol", "trade_ts", (F.col("price") * F.col("quantity")).alias("usd"))
    return chunked.mean_over_time(rows, ["symbol"], "trade_ts", 6 * 3600, "usd", "baseline").select("trade_id", "symbol", "baseline")


@query(
    "w19_bollinger",
    "select hour_ts, symbol, close_price, avg(close_price) over w as sma, avg(close_price) over w + 2 * stddev_pop(close_price) over w as upper_band, avg(close_price) over w - 2 * stddev_pop(close_price) over w as lower_band from v_hourly window w as (partition by symbol order by hour_ts rows between 19 preceding and current row)",
    "close_price sma upper_band lower_band",
    8,
)
def bollinger(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.bollinger(view(spark, sf_dir, "v_hourly").select("hour_ts", "symbol", "close_price"), "close_price", by_symbol())


@query(
    "w20_fill_and_smooth",
    """with s as (select symbol, unnest(generate_series(min(hour_ts), max(hour_ts), interval 1 hour)) as hour_ts from v_hourly group by symbol), j as (select s.symbol, cast(s.hour_ts as timestamp) as hour_ts, close_price, quote_volume from s left join v_hourly h on h.symbol = s.symbol and h.hour_ts = s.hour_ts),
      f as (select symbol, hour_ts, close_price is null as was_missing, last_value(close_price ignore nulls) over (partition by symbol order by hour_ts rows between unbounded preceding and current row) as px, coalesce(quote_volume, 0) as vol from j)
      select *, px - lag(px) over (partition by symbol order by hour_ts) as px_diff, avg(vol) over (partition by symbol order by hour_ts rows between 11 preceding and current row) as vol_mean_12 from f""",
    "px vol px_diff vol_mean_12",
    8,
)
def filled(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hour spine, forward fill, zero fill, difference and smoothing."""
    hourly = view(spark, sf_dir, "v_hourly")
    j = series.spine(hourly, ["symbol"], "hour_ts").join(hourly, ["symbol", "hour_ts"], "left")
    f = j.select("symbol", "hour_ts", F.col("close_price").isNull().alias("was_missing"), F.col("close_price").alias("px"), C.zero("quote_volume").alias("vol"))
    f = chunked.fill_forward(f, ["symbol"], ["hour_ts"], ["px"], 30 * 86_400)
    return chunked.over_rows(f, ["symbol"], ["hour_ts"], 11, 0, lambda w: {"px_diff": C.delta(F.col("px"), w), "vol_mean_12": F.avg("vol").over(series.last_rows(w, 12))})


@query(
    "w22_order_limit",
    "select o_orderpriority, o_orderkey, o_totalprice from orders order by o_orderpriority, o_totalprice desc, o_orderkey limit 25",
    "o_totalprice",
)
def ordered_limit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A top-k report (the limit is the feature), planned as take-ordered."""
    return table(spark, sf_dir, "orders").select("o_orderpriority", "o_orderkey", "o_totalprice").orderBy("o_orderpriority", F.col("o_totalprice").desc(), "o_orderkey").limit(25)


@query(
    "w24_union_by_priority",
    """with u as (select n_name as name, 'nation' as kind, 0 as p from nation union all select r_name, 'region', 1 from region union all select distinct c_mktsegment, 'segment', 2 from customer)
      select name, kind from (select *, row_number() over (partition by name order by p) as rn from u) x where rn = 1""",
)
def dims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Dimensions from several sources, the first source wins."""
    frames = [
        table(spark, sf_dir, "nation").select(F.col("n_name").alias("name"), F.lit("nation").alias("kind")),
        table(spark, sf_dir, "region").select(F.col("r_name").alias("name"), F.lit("region").alias("kind")),
        table(spark, sf_dir, "customer").select(F.col("c_mktsegment").alias("name"), F.lit("segment").alias("kind")).distinct(),
    ]
    return dedupe.union_by_priority(frames, ["name"])


@query(
    "w25_category_fan_out",
    """select coin, count(*) as posts, avg(sentiment) as avg_sentiment from (select 'BTC' as coin, sentiment from v_posts where lang in ('en', 'fr') union all select 'ETH', sentiment from v_posts where lang in ('en', 'de') union all select 'OTHER', sentiment from v_posts where lang not in ('en', 'fr', 'de')) x group by 1""",
    "avg_sentiment",
)
def category_fan_out(spark: SparkSession, sf_dir: str) -> DataFrame:
    lang = F.col("lang")
    coins = F.when(lang == "en", F.array(F.lit("BTC"), F.lit("ETH"))).when(lang == "fr", F.array(F.lit("BTC"))).when(lang == "de", F.array(F.lit("ETH"))).otherwise(F.array(F.lit("OTHER")))
    return view(spark, sf_dir, "v_posts").select(F.explode(coins).alias("coin"), "sentiment").groupBy("coin").agg(F.count(F.lit(1)).alias("posts"), F.avg("sentiment").alias("avg_sentiment"))


@query(
    "m20_dim_time",
    """with b as (select date_trunc('hour', min(ts)) as lo, date_trunc('hour', max(ts)) as hi from events), s as (select cast(unnest(generate_series(lo, hi, interval 1 hour)) as timestamp) as hour_ts from b)
      select hour_ts, cast(hour_ts as date) as date_day, cast(hour(hour_ts) as integer) as hour_of_day, cast(dayofweek(hour_ts) + 1 as integer) as day_of_week, cast(week(hour_ts) as integer) as iso_week, cast(month(hour_ts) as integer) as month_of_year, cast(quarter(hour_ts) as integer) as quarter_of_year,
        dayofweek(hour_ts) in (0, 6) as is_weekend, case when hour(hour_ts) < 8 then 'ASIA' when hour(hour_ts) < 14 then 'EUROPE' when hour(hour_ts) < 22 then 'US' else 'LATE' end as session_label from s""",
)
def dim_time(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hour spine with calendar columns and session labels."""
    ends = table(spark, sf_dir, "events").agg(F.date_trunc("hour", F.min("ts")).alias("lo"), F.date_trunc("hour", F.max("ts")).alias("hi"))
    s = ends.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 hour"))).alias("hour_ts"))
    h, d = F.hour("hour_ts"), F.dayofweek("hour_ts")
    return s.select(
        "hour_ts", F.to_date("hour_ts").alias("date_day"), h.alias("hour_of_day"), d.alias("day_of_week"), F.weekofyear("hour_ts").alias("iso_week"), F.month("hour_ts").alias("month_of_year"), F.quarter("hour_ts").alias("quarter_of_year"),
        d.isin(1, 7).alias("is_weekend"), C.label_by([(h < 8, "ASIA"), (h < 14, "EUROPE"), (h < 22, "US")], "LATE").alias("session_label"),
    )


@query(
    "w27_walk_forward",
    """with t as (select hour_ts, row_number() over (order by hour_ts) - 1 as n, count(*) over () as total from (select distinct hour_ts from v_hourly) d), f as (select unnest(range(0, 4)) as fold),
      b as (select fold, total, cast(floor(total * 0.5) as bigint) as s from f, (select max(total) as total from t) m),
      c as (select fold, s + cast(floor((total - s) / 4.0 * fold) as bigint) as a, case when fold = 3 then total else s + cast(floor((total - s) / 4.0 * (fold + 1)) as bigint) end as z from b)
      select fold, role, count(*) as row_count, min(hour_ts) as first_ts, max(hour_ts) as last_ts from (select h.hour_ts, fold, case when n < a then 'train' else 'test' end as role from v_hourly h join t using (hour_ts) join c on n < z) x group by 1, 2""",
)
def folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    placed = series.walk_forward(view(spark, sf_dir, "v_hourly"), "hour_ts", 4)
    return placed.groupBy(F.col("fold").cast("long").alias("fold"), "role").agg(F.count(F.lit(1)).alias("row_count"), F.min("hour_ts").alias("first_ts"), F.max("hour_ts").alias("last_ts"))


# --- joins -------------------------------------------------------------------------------------------------------


@query(
    "j02_full_outer_presence",
    """with a as (select date_trunc('day', trade_ts)::date as day, symbol, count(*) as trades from v_s_trades group by 1, 2), b as (select date_trunc('day', liq_ts)::date as day, symbol, count(*) as liqs from v_s_liq group by 1, 2)
      select coalesce(a.day, b.day) as day, coalesce(a.symbol, b.symbol) as symbol, trades, liqs, a.day is not null as has_trades, b.day is not null as has_liqs from a full outer join b on a.day = b.day and a.symbol = b.symbol""",
)
def presence(spark: SparkSession, sf_dir: str) -> DataFrame:
    a = view(spark, sf_dir, "v_s_trades").groupBy(F.to_date("trade_ts").alias("day"), "symbol").agg(F.count(F.lit(1)).alias("trades"))
    b = view(spark, sf_dir, "v_s_liq").groupBy(F.to_date("liq_ts").alias("day"), "symbol").agg(F.count(F.lit(1)).alias("liqs"))
    return joins.full_outer(a, b, ["day", "symbol"], "has_trades", "has_liqs")


@query(
    "j05_asof_join",
    """select t.trade_id, t.symbol, f.sent_ts, f.funding_rate_pct, f.sent_id from v_s_trades t left join lateral (
        select * from v_s_sent s where s.symbol = t.symbol and s.sent_ts <= t.trade_ts and s.sent_ts >= t.trade_ts - interval 2 hour order by s.sent_ts desc, s.sent_id desc limit 1) f on true""",
    "funding_rate_pct",
    9,
)
def asof(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The latest known context within two hours."""
    return chunked.asof_join(view(spark, sf_dir, "v_s_trades"), view(spark, sf_dir, "v_s_sent"), ["symbol"], "trade_ts", "sent_ts", ["sent_id"], ["funding_rate_pct", "sent_id"], "2 hours").select("trade_id", "symbol", "sent_ts", "funding_rate_pct", "sent_id")


@query(
    "j09_interval_join",
    """select t.trade_id, b.book_id from v_s_trades t left join v_s_book b on b.symbol = t.symbol and b.ob_ts >= t.trade_ts - interval 20 minute and b.ob_ts <= t.trade_ts + interval 10 minute""",
)
def interval(spark: SparkSession, sf_dir: str) -> DataFrame:
    """J9 and the batch form of T6, T7."""
    return joins.interval_join(view(spark, sf_dir, "v_s_trades"), view(spark, sf_dir, "v_s_book"), ["symbol"], "trade_ts", "ob_ts", -1200, 600, "left").select("trade_id", "book_id")


@query(
    "j10_relationship_gaps",
    "select distinct o_custkey as missing_key from orders where o_custkey % 50 <> 0 and o_custkey not in (select c_custkey from customer where c_mktsegment <> 'BUILDING')",
)
def relationship_gaps(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q15: child keys without a parent."""
    parent = table(spark, sf_dir, "customer").where("c_mktsegment <> 'BUILDING'")
    return joins.relationship_violations(table(spark, sf_dir, "orders").where("o_custkey % 50 <> 0"), parent, "o_custkey", "c_custkey")


@query(
    "j15_latest_run",
    "select event_id, event_type from events where cast(user_id as varchar) = (select arg_max(cast(user_id as varchar), (ts, cast(user_id as varchar))) from events)",
)
def latest_run(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = table(spark, sf_dir, "events").withColumn("run_id", F.col("user_id").cast("string"))
    return dedupe.latest_run(e, "run_id", "ts").select("event_id", "event_type")


@query(
    "j16_filled_rates",
    """with d as (select price_date, symbol, case when day(price_date) % 3 = 0 then adj_close_price end as rate from v_daily)
      select price_date, symbol, coalesce(last_value(rate ignore nulls) over (partition by symbol order by price_date rows between unbounded preceding and current row), first_value(rate ignore nulls) over (partition by symbol order by price_date rows between current row and unbounded following)) as filled from d""",
    "filled",
)
def filled_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = view(spark, sf_dir, "v_daily").withColumn("rate", F.when(F.day("price_date") % 3 == 0, F.col("adj_close_price")))
    return d.select("price_date", "symbol", series.fill("rate", series.by(["symbol"], ["price_date"]), backward=True).alias("filled"))


@query(
    "f12_completeness",
    """with r as (select hour_ts, symbol, lag(close_price, 1) over w as a, lag(close_price, 24) over w as b, close_price as c, lag(quote_volume, 168) over w as d from v_hourly window w as (partition by symbol order by hour_ts))
      select hour_ts, symbol, ((a is not null)::int + (b is not null)::int + (c is not null)::int + (d is not null)::int) / 4.0 as feature_completeness from r""",
    "feature_completeness",
)
def feature_completeness(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = view(spark, sf_dir, "v_hourly").select("hour_ts", "symbol", F.lag("close_price", 1).over(by_symbol()).alias("a"), F.lag("close_price", 24).over(by_symbol()).alias("b"), F.col("close_price").alias("c"), F.lag("quote_volume", 168).over(by_symbol()).alias("d"))
    return df.select("hour_ts", "symbol", C.completeness(["a", "b", "c", "d"]).alias("feature_completeness"))


@query(
    "f08_nested_snapshot",
    """select exchange, '[' || string_agg('{"month_date":"' || month_date || '","orders":' || cast(trust_score as bigint) || '}', ',' order by trust_score desc, month_date) || ']' as snapshot_json from (select *, row_number() over (partition by exchange order by trust_score desc, month_date) as rn from v_reserve) x where rn <= 5 group by 1""",
)
def nested_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ordered rows of a group as a JSON array."""
    r = view(spark, sf_dir, "v_reserve").select("exchange", "month_date", F.col("trust_score").cast("long").alias("orders"))
    return C.top_n_json(r, ["exchange"], ["month_date", "orders"], [F.col("orders").desc(), F.col("month_date")], 5, "snapshot_json")
