"""Metrics of model runs by the registry, candidates that are kept, coverage by scope."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.mlops import registry
from tapeloom.plans.registry import query
from tapeloom.plans.standins import table, view

_SHOWN = "ml_model_metric_sk model_name model_version model_family algorithm problem_type target_name primary_target split_name run_id row_count metric_age_hours error_rate f1_macro model_quality_label auc_quality_label is_active_model is_test_split is_primary_target_metric is_latest_for_model_split is_latest_for_target_split".split()


@query(
    "m42_model_metrics",
    f"""with k as (select *, lower(split_name) as split from v_model_runs where model_name is not null and model_version is not null and target_name is not null and lower(split_name) in ('train', 'validation', 'test')),
      e as (select k.* exclude (split_name), split as split_name, model_family, algorithm, problem_type, primary_target, coalesce(is_active, false) as is_active_model from k left join v_models using (model_name, model_version))
      select {', '.join(c for c in _SHOWN if c in ('model_name', 'model_version', 'model_family', 'algorithm', 'problem_type', 'target_name', 'primary_target', 'split_name', 'run_id', 'row_count', 'f1_macro', 'is_active_model'))},
        md5(model_name || '|' || model_version || '|' || target_name || '|' || split_name || '|' || strftime(evaluated_at, '%Y-%m-%d %H:%M:%S') || '|' || run_id) as ml_model_metric_sk, date_diff('second', evaluated_at, timestamp '2024-02-01') // 3600 as metric_age_hours, 1 - accuracy as error_rate,
        case when row_count = 0 then 'NO_ROWS' when f1_macro >= 0.6 then 'GOOD' when f1_macro >= 0.5 then 'ACCEPTABLE' when f1_macro >= 0.4 then 'WEAK' else 'BAD' end as model_quality_label, case when auc_ovr is null then 'AUC_NOT_AVAILABLE' when auc_ovr >= 0.65 then 'GOOD_AUC' when auc_ovr >= 0.55 then 'WEAK_AUC' else 'POOR_AUC' end as auc_quality_label,
        split_name = 'test' as is_test_split, coalesce(target_name = primary_target, false) as is_primary_target_metric, row_number() over (partition by model_name, model_version, target_name, split_name order by evaluated_at desc, run_id desc) = 1 as is_latest_for_model_split,
        row_number() over (partition by target_name, split_name order by evaluated_at desc, run_id desc) = 1 as is_latest_for_target_split from e""",
    "error_rate f1_macro",
)
def model_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.metric_rows(view(spark, sf_dir, "v_model_runs"), view(spark, sf_dir, "v_models"), F.lit("2024-02-01").cast("timestamp_ntz")).select(*_SHOWN)


_CLASSES = ("DOWN", "FLAT", "UP")
_R = lambda c: f"coalesce(count(*) filter (actual = '{c}' and predicted = '{c}') / nullif(count(*) filter (actual = '{c}'), 0)::double, 0)"
_F = lambda c: f"coalesce(2.0 * count(*) filter (actual = '{c}' and predicted = '{c}') / nullif(count(*) filter (actual = '{c}') + count(*) filter (predicted = '{c}'), 0), 0)"
_MEASURES = f"count(*) as n, count(distinct actual) as classes, ({' + '.join(map(_F, _CLASSES))}) / 3 as f1, {_R('DOWN')} as recall, least({', '.join(map(_R, _CLASSES))}) as least_recall"
STABILITY_SQL = f"""w as (select candidate, split_name, {_MEASURES} from v_candidates group by 1, 2), m as (select candidate, month, {_MEASURES} from v_candidates where split_name = 'validation' group by 1, 2 having n >= 60 and classes >= 2),
  y as (select candidate, symbol, {_MEASURES} from v_candidates where split_name = 'validation' group by 1, 2 having n >= 60 and classes >= 2),
  s as (select v.candidate, v.f1 as validation_f1, v.recall as validation_target_recall, v.least_recall as min_recall, abs(v.f1 - t.f1) as validation_test_gap, mm.monthly_f1_min, mm.monthly_recall_min, mm.monthly_f1_std, yy.symbol_f1_gap, yy.symbol_recall_gap
    from w v join w t on t.candidate = v.candidate and t.split_name = 'test' and v.split_name = 'validation' left join (select candidate, min(f1) as monthly_f1_min, min(recall) as monthly_recall_min, stddev_pop(f1) as monthly_f1_std from m group by 1) mm on mm.candidate = v.candidate
    left join (select candidate, max(f1) - min(f1) as symbol_f1_gap, max(recall) - min(recall) as symbol_recall_gap from y group by 1) yy on yy.candidate = v.candidate)"""


@query(
    "l21_stability",
    f"""with {STABILITY_SQL}, b as (select * from s where candidate = 'base'),
      r as (select s.*, concat_ws(',', case when s.validation_f1 < b.validation_f1 - 0.005 then 'validation_f1_below_budget' end, case when s.validation_target_recall < b.validation_target_recall + 0.005 then 'down_recall_not_stably_higher' end, case when s.min_recall < b.min_recall - 0.03 then 'per_class_recall_min_drops_too_much' end,
        case when s.monthly_f1_min < b.monthly_f1_min - 0.03 then 'monthly_f1_min_worse' end, case when s.monthly_recall_min < b.monthly_recall_min - 0.03 then 'monthly_down_recall_min_worse' end, case when s.symbol_f1_gap > b.symbol_f1_gap + 0.05 then 'symbol_f1_gap_worse' end,
        case when s.symbol_recall_gap > b.symbol_recall_gap + 0.05 then 'symbol_down_recall_gap_worse' end, case when s.validation_test_gap > 0.06 then 'validation_test_gap_too_large' end) as why,
        s.monthly_f1_min is null or b.monthly_f1_min is null or s.symbol_f1_gap is null or b.symbol_f1_gap is null or s.validation_test_gap is null as missing from s, b where s.candidate <> 'base')
      select * exclude (why, missing), not missing and why = '' as is_kept, case when missing then 'insufficient_stability_metrics' when why = '' then 'stable_keeper_candidate' else why end as reasons from r""",
    "validation_f1 validation_target_recall min_recall validation_test_gap monthly_f1_min monthly_recall_min monthly_f1_std symbol_f1_gap symbol_recall_gap",
    8,
)
def keepers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Candidates against the baseline over months and symbols, kept or rejected with reasons."""
    return registry.keep_or_reject(registry.stability(view(spark, sf_dir, "v_candidates"), _CLASSES, "DOWN"), "base")


@query(
    "l22_coverage",
    """with l as (select distinct l_returnflag as scope, l_orderkey as k from lineitem where l_returnflag is not null), r as (select distinct case o_orderpriority when '1-URGENT' then 'A' when '2-HIGH' then 'N' else 'X' end as scope, o_orderkey as k from orders)
      select coalesce(l.scope, r.scope) as scope, count(l.k) as left_keys, count(r.k) as right_keys, count(*) filter (l.k is not null and r.k is not null) as common_keys, count(*) filter (l.k is not null and r.k is not null) / nullif(count(l.k), 0)::double as left_coverage, count(*) filter (l.k is not null and r.k is not null) / nullif(count(r.k), 0)::double as right_coverage
      from l full join r on l.scope = r.scope and l.k = r.k group by 1""",
    "left_coverage right_coverage",
)
def coverage(spark: SparkSession, sf_dir: str) -> DataFrame:
    left = table(spark, sf_dir, "lineitem").select(F.col("l_returnflag").alias("scope"), F.col("l_orderkey").alias("k"))
    part = F.when(F.col("o_orderpriority") == "1-URGENT", "A").when(F.col("o_orderpriority") == "2-HIGH", "N").otherwise("X")
    return registry.coverage(left, table(spark, sf_dir, "orders").select(part.alias("scope"), F.col("o_orderkey").alias("k")), ["k"], "scope")
