"""Data quality, monitoring and model-evaluation queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.mlops import metrics as M
from tapeloom.operators import series
from tapeloom.plans.features import by_symbol
from tapeloom.plans.registry import query
from tapeloom.plans.standins import table, view
from tapeloom.quality import rules as Q

ORDER_RULES = [
    Q.Rule("columns", ["o_orderkey", "o_custkey", "o_totalprice"]),
    Q.Rule("min_rows", low=10),
    Q.Rule("not_null", ["o_orderkey"]),
    Q.Rule("accepted", ["o_orderstatus"], values=["F", "O"], severity="warning"),
    Q.Rule("unique", ["o_custkey"], severity="warning"),
    Q.Rule("between", ["o_totalprice"], 1000, 300000, severity="warning"),
    Q.Rule("condition", condition="o_orderkey > 0"),
    Q.Rule("not_null", ["no_such_column"]),
]

RULES_SQL = """select 'orders' as table_name, * from (
    select 'columns:o_orderkey,o_custkey,o_totalprice' as rule_name, 'error' as severity, 0::bigint as violations
    union all select 'min_rows', 'error', greatest(0, 10 - count(*)) from orders union all select 'not_null:o_orderkey', 'error', count(*) filter (o_orderkey is null) from orders
    union all select 'accepted:o_orderstatus', 'warning', count(*) filter (o_orderstatus not in ('F', 'O')) from orders union all select 'unique:o_custkey', 'warning', count(*) - count(distinct o_custkey) from orders
    union all select 'between:o_totalprice', 'warning', count(*) filter (o_totalprice < 1000 or o_totalprice > 300000) from orders union all select 'condition:o_orderkey > 0', 'error', count(*) filter (not o_orderkey > 0) from orders
    union all select 'not_null:no_such_column', 'error', 1) r"""


@query("q07_ruleset", f"select *, violations = 0 as passed from ({RULES_SQL}) x")
def ruleset(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q1-Q8, Q17: one aggregate pass for all rules."""
    return Q.run_rules(table(spark, sf_dir, "orders"), ORDER_RULES, "orders")


@query(
    "q14_run_summary",
    f"""with r as (select *, violations = 0 as passed from ({RULES_SQL}) x) select table_name, count(*) as total_checks, count(*) filter (passed) as passed_checks, count(*) filter (not passed and severity = 'error') as failed_errors,
      count(*) filter (not passed and severity = 'warning') as failed_warnings, string_agg(rule_name || ': ' || violations, ',' order by rule_name || ': ' || violations) filter (not passed) as failed_rules from r group by 1""",
)
def run_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A28, Q14, M44."""
    out = Q.summarise(ruleset(spark, sf_dir), ["table_name"])
    return out.withColumn("failed_rules", F.array_join("failed_rules", ","))


@query(
    "m33_data_freshness",
    """with t as (select 'events' as table_name, count(*) as row_count, max(ts) as latest_ts, 120 as limit_minutes from events union all select 'orders', count(*), max(o_orderdate)::timestamp, 100000000 from orders union all select 'lineitem', count(*), max(l_shipdate)::timestamp, 20000000 from lineitem
      union all select 'empty', count(*), max(ts), 60 from events where event_id < 0)
      select *, date_diff('second', latest_ts, timestamp '2024-02-01') // 60 as age_minutes, case when latest_ts is null then 'MISSING' when date_diff('second', latest_ts, timestamp '2024-02-01') // 60 <= limit_minutes then 'FRESH' when date_diff('second', latest_ts, timestamp '2024-02-01') // 60 <= 2 * limit_minutes then 'STALE' else 'OLD' end as freshness_status from t""",
)
def data_freshness(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events")
    tables = {"events": (events, "ts", 120), "orders": (table(spark, sf_dir, "orders"), "o_orderdate", 100_000_000), "lineitem": (table(spark, sf_dir, "lineitem"), "l_shipdate", 20_000_000), "empty": (events.where("event_id < 0"), "ts", 60)}
    return Q.freshness(tables, F.lit("2024-02-01").cast("timestamp_ntz"))


@query(
    "q13_health",
    """select 'orders_non_empty' as check_name, 'critical' as severity, count(*)::double as value, case when count(*) >= 1 then 'PASS' else 'FAIL' end as status from orders
      union all select 'prediction_age_hours', 'warning', date_diff('hour', max(date_trunc('hour', ts)), timestamp '2024-02-01')::double, case when date_diff('hour', max(date_trunc('hour', ts)), timestamp '2024-02-01') <= 6 then 'PASS' else 'FAIL' end from events
      union all select 'bad_status_count', 'critical', (count(*) filter (o_orderstatus = 'P'))::double, case when count(*) filter (o_orderstatus = 'P') <= 1000000 then 'PASS' else 'FAIL' end from orders
      union all select 'absent_table', 'warning', null, 'PASS' union all select 'absent_critical', 'critical', null, 'MISSING'""",
    "value",
)
def health(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q9-Q13: checks over tables, rows with status."""
    orders, events = table(spark, sf_dir, "orders"), table(spark, sf_dir, "events")
    age = F.timestamp_diff("HOUR", F.date_trunc("hour", F.max("ts")).cast("timestamp_ntz"), F.lit("2024-02-01").cast("timestamp_ntz"))
    return Q.health(
        [
            Q.Check("orders_non_empty", orders, F.count(F.lit(1)), low=1),
            Q.Check("prediction_age_hours", events, age, high=6, severity="warning"),
            Q.Check("bad_status_count", orders, F.count_if(F.col("o_orderstatus") == "P"), high=1_000_000),
            Q.Check("absent_table", None, F.lit(0), severity="warning", missing_ok=True),
            Q.Check("absent_critical", None, F.lit(0)),
        ],
        spark,
    )


@query(
    "q16_assertion",
    "select l_orderkey, l_linenumber, l_discount from lineitem where not (l_discount between 0 and 0.09) or l_tax is null",
    "l_discount",
)
def assertion(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Q16: the rows that violate an assertion."""
    return table(spark, sf_dir, "lineitem").where("not (l_discount between 0 and 0.09) or l_tax is null").select("l_orderkey", "l_linenumber", "l_discount")


@query(
    "m39_feature_quality",
    """with r as (select cast(hour_ts as date) as feature_date, symbol, case when lag(close_price, 4) over w is null then 1 else 0 end as a, case when lag(quote_volume, 24) over w is null then 1 else 0 end as b from v_hourly window w as (partition by symbol order by hour_ts))
      select feature_date, symbol, count(*) as row_count, sum(a)::bigint as missing_return_4h, sum(b)::bigint as missing_volume_24h, sum(a + b) / (count(*) * 2.0) as missing_share from r group by 1, 2""",
    "missing_share",
)
def feature_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A25."""
    df = view(spark, sf_dir, "v_hourly").select(F.to_date("hour_ts").alias("feature_date"), "symbol", F.lag("close_price", 4).over(by_symbol()).alias("return_4h"), F.lag("quote_volume", 24).over(by_symbol()).alias("volume_24h"))
    return Q.missing_profile(df, ["feature_date", "symbol"], ["return_4h", "volume_24h"])


@query(
    "m40_label_distribution",
    """with f as (select cast(hour_ts as date) as label_date, symbol, (lead(close_price, 4) over (partition by symbol order by hour_ts) - close_price) / nullif(close_price, 0) as r from v_hourly)
      select label_date, symbol, count(*) as row_count, count(r) as available, count(*) filter (r >= 0.003) as up_count, count(*) filter (r <= -0.003) as down_count, count(*) filter (r > -0.003 and r < 0.003) as flat_count, avg(r) as mean_return, stddev_samp(r) as std_return, min(r) as min_return, max(r) as max_return from f group by 1, 2""",
    "mean_return std_return min_return max_return",
)
def label_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A26."""
    df = series.forward_labels(view(spark, sf_dir, "v_hourly"), "close_price", by_symbol(), {4: 0.003})
    r, d = F.col("future_return_4"), F.col("future_direction_4")
    return df.groupBy(F.to_date("hour_ts").alias("label_date"), "symbol").agg(
        F.count(F.lit(1)).alias("row_count"), F.count(r).alias("available"), F.count_if(d == "UP").alias("up_count"), F.count_if(d == "DOWN").alias("down_count"), F.count_if(d == "FLAT").alias("flat_count"),
        F.avg(r).alias("mean_return"), F.stddev_samp(r).alias("std_return"), F.min(r).alias("min_return"), F.max(r).alias("max_return"),
    )


_CLASS_SQL = """with c as (select slice, count(*) as row_count, count(*) filter (actual = predicted) as ok, count(*) filter (actual = 0 and predicted = 0) as t0, count(*) filter (actual = 0) as a0, count(*) filter (predicted = 0) as p0,
    count(*) filter (actual = 1 and predicted = 1) as t1, count(*) filter (actual = 1) as a1, count(*) filter (predicted = 1) as p1 from v_pred group by 1)
  select slice, row_count, ok / row_count as accuracy, (coalesce(t0 / nullif(p0, 0), 0) + coalesce(t1 / nullif(p1, 0), 0)) / 2 as macro_precision, (coalesce(t0 / nullif(a0, 0), 0) + coalesce(t1 / nullif(a1, 0), 0)) / 2 as macro_recall,
    (coalesce(2 * t0 / nullif(a0 + p0, 0), 0) + coalesce(2 * t1 / nullif(a1 + p1, 0), 0)) / 2 as macro_f1, least(coalesce(t0 / nullif(a0, 0), 0), coalesce(t1 / nullif(a1, 0), 0)) as min_recall,
    (coalesce(t0 / nullif(a0, 0), 0) + coalesce(t1 / nullif(a1, 0), 0)) / nullif((a0 > 0)::int + (a1 > 0)::int, 0) as balanced_accuracy from c"""


@query("l07_classification_by_slice", _CLASS_SQL, "accuracy macro_precision macro_recall macro_f1 min_recall balanced_accuracy")
def classification(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Metrics by slice."""
    return M.classification(view(spark, sf_dir, "v_pred"), ["slice"], [0, 1])


@query("l20_confusion", "select slice, cast(actual as varchar) as actual, cast(predicted as varchar) as predicted, count(*) as n from v_pred group by all")
def confusion(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.confusion(view(spark, sf_dir, "v_pred"), ["slice"])


@query(
    "l07_auc_logloss",
    """with p as (select slice, actual, score, (rank() over (partition by slice order by score) + rank() over (partition by slice order by score) + count(*) over (partition by slice, score) - 1) / 2.0 as r from v_pred)
      select slice, (sum(case when actual = 1 then r else 0 end) - count(*) filter (actual = 1) * (count(*) filter (actual = 1) + 1) / 2.0) / nullif(count(*) filter (actual = 1) * count(*) filter (actual = 0), 0) as auc,
        avg(-case when actual = 1 then ln(greatest(1e-15, least(1 - 1e-15, score))) else ln(1 - greatest(1e-15, least(1 - 1e-15, score))) end) as log_loss, avg(power(score - actual, 2)) as brier from p group by 1""",
    "auc log_loss brier",
    9,
)
def auc_logloss(spark: SparkSession, sf_dir: str) -> DataFrame:
    df = view(spark, sf_dir, "v_pred")
    loss = df.groupBy("slice").agg(M.log_loss(F.col("actual"), F.col("score")).alias("log_loss"), M.brier(F.col("actual"), F.col("score")).alias("brier"))
    return M.auc(df, ["slice"], "actual", "score").join(loss, "slice")


@query(
    "l15_threshold_search",
    """with g as (select round(0.20 + i * 0.01, 6) as threshold from range(36) t(i)), c as (select threshold, count(*) filter (actual = 1 and score >= threshold - 1e-9) as tp, count(*) filter (actual = 0 and score >= threshold - 1e-9) as fp, count(*) filter (actual = 1) as pos from g, v_pred group by 1)
      select threshold, coalesce(tp / nullif(tp + fp, 0), 0) as precision, coalesce(tp / nullif(pos, 0), 0) as recall, coalesce(2 * tp / nullif(tp + fp + pos, 0), 0) as f1 from c""",
    "threshold precision recall f1",
)
def thresholds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.threshold_search(view(spark, sf_dir, "v_pred"), "actual", "score", 0.20, 0.55, 36)


@query(
    "l20_calibration",
    "select cast(least(floor(score * 10), 9) as integer) as score_bin, count(*) as row_count, avg(score) as mean_score, avg(actual::double) as hit_rate from v_pred group by 1",
    "mean_score hit_rate",
)
def calibration(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.calibration(view(spark, sf_dir, "v_pred"), "actual", "score")


@query(
    "l16_target_correlation",
    "select 'l_discount' as feature, corr(l_discount, l_extendedprice) as correlation, avg((l_discount is null)::int) as missing_rate from lineitem union all select 'l_tax', corr(l_tax, l_extendedprice), avg((l_tax is null)::int) from lineitem union all select 'l_quantity', corr(l_quantity, l_extendedprice), avg((l_quantity is null)::int) from lineitem",
    "correlation missing_rate",
)
def correlation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return M.target_correlation(table(spark, sf_dir, "lineitem"), "l_extendedprice", ["l_discount", "l_tax", "l_quantity"])


@query(
    "l22_parity",
    """with w as (select close_price as px, round(close_price, 2) as px2, avg(close_price) over v as a, sum(close_price) over v / count(close_price) over v as b from v_hourly window v as (partition by symbol order by hour_ts rows between 6 preceding and current row)),
        d as (select 'mean_7' as feature, abs(a - b) as diff, (a is null) <> (b is null) as odd from w union all select 'px', abs(px - px2), (px is null) <> (px2 is null) from w),
        g as (select feature, count(*) as matched, max(diff) as max_abs_diff, count(*) filter (odd) as null_mismatches from d group by 1)
      select *, case when max_abs_diff <= 1e-9 and null_mismatches = 0 then 'EXACT' when max_abs_diff <= 1e-6 and null_mismatches = 0 then 'CLOSE' else 'MISMATCH' end as verdict from g""",
    "max_abs_diff",
)
def parity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two ways to the same features: a window mean against a sum over a count, a price against its rounding."""
    h = view(spark, sf_dir, "v_hourly")
    w = series.last_rows(by_symbol(), 7)
    a = h.select("hour_ts", "symbol", F.avg("close_price").over(w).alias("mean_7"), F.col("close_price").alias("px"))
    b = h.select("hour_ts", "symbol", (F.sum("close_price").over(w) / F.count("close_price").over(w)).alias("mean_7"), F.round("close_price", 2).alias("px"))
    return M.parity(a, b, ["hour_ts", "symbol"], ["mean_7", "px"])


@query(
    "l12_promotion_gate",
    """with m as (select slice, count(*) as row_count, avg((actual = predicted)::int) as validation_f1, avg((actual = (score > 0.5)::int)::int) as test_f1, least(coalesce(count(*) filter (actual = 0 and predicted = 0) / nullif(count(*) filter (actual = 0), 0), 0), coalesce(count(*) filter (actual = 1 and predicted = 1) / nullif(count(*) filter (actual = 1), 0), 0)) as min_recall from v_pred group by 1),
      c as (select 'src' || cast((try_cast(replace(slice, 'src', '') as integer) + 1) % 20 as varchar) as slice, validation_f1 as v, test_f1 as t from m),
      j as (select m.*, concat_ws('; ', case when validation_f1 is null then 'validation f1 missing' end, case when row_count < 20 then 'too few rows' end, case when min_recall < 0.2 then 'a class has too low a recall' end, case when validation_f1 < v then 'not better than the champion' end, case when test_f1 < t - 0.05 then 'worse on the test split' end) as reasons from m left join c using (slice))
      select slice, reasons = '' as promoted, reasons from j""",
)
def promotion_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Slices play candidates, the next slice plays the champion."""
    pred = view(spark, sf_dir, "v_pred")
    test = pred.groupBy("slice").agg(F.avg((F.col("actual") == (F.col("score") > 0.5).cast("int")).cast("int")).alias("test_f1"))  # a second model's scores play the test split
    m = M.classification(pred, ["slice"], [0, 1]).select("slice", "row_count", F.col("accuracy").alias("validation_f1"), "min_recall").join(test, "slice")
    nxt = F.concat(F.lit("src"), ((F.regexp_replace("slice", "src", "").cast("int") + 1) % 20).cast("string"))
    return M.promotion(m, m.withColumn("slice", nxt), ["slice"], min_recall=0.2)


@query(
    "l27_leaderboard",
    """select slice as candidate, accuracy, macro_f1, row_number() over (order by macro_f1 desc nulls last, accuracy desc nulls last, slice) as rank from (""" + _CLASS_SQL + """) x""",
    "accuracy macro_f1",
)
def leaderboard(spark: SparkSession, sf_dir: str) -> DataFrame:
    m = classification(spark, sf_dir).select(F.col("slice").alias("candidate"), "accuracy", "macro_f1")
    m = m.withColumns({"accuracy": F.round("accuracy", 12), "macro_f1": F.round("macro_f1", 12)})
    return M.leaderboard(m, ["macro_f1", "accuracy"])


@query(
    "l09_split_ranges",
    """with s as (select hour_ts, case when p < 0.7 then 'train' when p < 0.85 then 'validation' else 'test' end as split_name from (select hour_ts, percent_rank() over (partition by symbol order by hour_ts) as p from v_hourly) x),
      r as (select split_name, min(hour_ts) as first_ts, max(hour_ts) as last_ts, count(*) as row_count from s group by 1)
      select *, coalesce(first_ts > max(last_ts) over (order by first_ts, split_name rows between unbounded preceding and 1 preceding), true) as starts_after_previous from r""",
)
def split_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Splits in time with a leak flag."""
    from tapeloom.plans.features import split

    return M.split_ranges(split(spark, sf_dir), "split_name", "hour_ts")


@query(
    "l17_class_distribution",
    """with f as (select date_trunc('day', hour_ts)::date as day, case when r >= 0.003 then 'UP' when r <= -0.003 then 'DOWN' else 'FLAT' end as direction from (select hour_ts, (lead(close_price, 4) over (partition by symbol order by hour_ts) - close_price) / nullif(close_price, 0) as r from v_hourly) x where r is not null)
      select day, direction, count(*) as n, count(*) / sum(count(*)) over (partition by day) as share from f group by 1, 2""",
    "share",
)
def class_distribution(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Class shares by period."""
    from pyspark.sql import Window

    df = series.forward_labels(view(spark, sf_dir, "v_hourly"), "close_price", by_symbol(), {4: 0.003}).where("future_direction_4 is not null")
    g = df.groupBy(F.to_date("hour_ts").alias("day"), F.col("future_direction_4").alias("direction")).agg(F.count(F.lit(1)).alias("n"))
    return g.withColumn("share", F.col("n") / F.sum("n").over(Window.partitionBy("day")))


@query(
    "l18_completeness_by_symbol",
    """with r as (select symbol, ((lag(close_price) over w is not null)::int + (lag(close_price, 24) over w is not null)::int + (lag(quote_volume, 168) over w is not null)::int) / 3.0 as c from v_hourly window w as (partition by symbol order by hour_ts))
      select symbol, avg(c) as mean_completeness, quantile_cont(c, 0.1) as p10_completeness, min(c) as min_completeness from r group by 1""",
    "mean_completeness p10_completeness min_completeness",
)
def completeness_by_symbol(spark: SparkSession, sf_dir: str) -> DataFrame:
    from tapeloom.functions.columns import completeness

    df = view(spark, sf_dir, "v_hourly").select("symbol", F.lag("close_price").over(by_symbol()).alias("a"), F.lag("close_price", 24).over(by_symbol()).alias("b"), F.lag("quote_volume", 168).over(by_symbol()).alias("d"))
    df = df.select("symbol", completeness(["a", "b", "d"]).alias("c"))
    return df.groupBy("symbol").agg(F.avg("c").alias("mean_completeness"), F.percentile("c", 0.1).alias("p10_completeness"), F.min("c").alias("min_completeness"))


@query(
    "m41_naive_baselines",
    """with f as (select symbol, hour_ts, (close_price - lag(close_price, 4) over w) / nullif(lag(close_price, 4) over w, 0) as past, (lead(close_price, 4) over w - close_price) / nullif(close_price, 0) as nxt, taker_buy_ratio as t from v_hourly window w as (partition by symbol order by hour_ts)),
      d as (select symbol, case when nxt >= 0.003 then 'UP' when nxt <= -0.003 then 'DOWN' else 'FLAT' end as actual, case when past >= 0.003 then 'UP' when past <= -0.003 then 'DOWN' else 'FLAT' end as mom, case when t > 0.6 then 'UP' when t < 0.4 then 'DOWN' else 'FLAT' end as sig from f where nxt is not null),
      b as (select symbol, 'momentum' as baseline_name, actual, mom as predicted from d union all select symbol, 'signal', actual, sig from d)
      select symbol, baseline_name, count(*) as row_count, avg((actual = predicted)::int) as accuracy, count(*) filter (predicted = 'UP' and actual = 'UP') / nullif(count(*) filter (predicted = 'UP'), 0) as precision_up, count(*) filter (predicted <> 'FLAT') / count(*) as coverage from b group by 1, 2""",
    "accuracy precision_up coverage",
)
def naive_baselines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rule predictions fanned out by a generator, scored in one pass."""
    from tapeloom.functions.columns import label_by, pct_change, safe_div

    df = series.forward_labels(view(spark, sf_dir, "v_hourly"), "close_price", by_symbol(), {4: 0.003}).withColumn("past", pct_change(F.col("close_price"), by_symbol(), 4)).where("future_direction_4 is not null")
    mom = label_by([(F.col("past") >= 0.003, "UP"), (F.col("past") <= -0.003, "DOWN")], "FLAT")
    sig = label_by([(F.col("taker_buy_ratio") > 0.6, "UP"), (F.col("taker_buy_ratio") < 0.4, "DOWN")], "FLAT")
    pairs = F.array(F.struct(F.lit("momentum").alias("baseline_name"), mom.alias("predicted")), F.struct(F.lit("signal").alias("baseline_name"), sig.alias("predicted")))
    b = df.select("symbol", F.col("future_direction_4").alias("actual"), F.inline(pairs))
    up = F.col("predicted") == "UP"
    return b.groupBy("symbol", "baseline_name").agg(
        F.count(F.lit(1)).alias("row_count"), F.avg((F.col("actual") == F.col("predicted")).cast("double")).alias("accuracy"), safe_div(F.count_if(up & (F.col("actual") == "UP")), F.count_if(up)).alias("precision_up"), (F.count_if(F.col("predicted") != "FLAT") / F.count(F.lit(1))).alias("coverage")
    )
