"""Strategies in folds, threshold policy and class-wise curves."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tapeloom.mlops import metrics, training
from tapeloom.plans.dashboard import FEATURES, training_rows
from tapeloom.plans.registry import query
from tapeloom.plans.standins import view

CLASSES = ("DOWN", "FLAT", "UP")


@query("l13_strategy_folds")
def strategy_folds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A row a fold and strategy over the training rows, the rolling windows cut to the stand-in's month. Fitting is iterative, so there is no SQL for it."""
    frame = training.training_frame(training_rows(spark, sf_dir), FEATURES, ["symbol"], "future_direction_4", list(CLASSES), ["hour_ts", "sample_weight"])
    strategies = [training.Strategy("logistic_all_history", "logistic", None), training.Strategy("boosted_all_history", "boosted", None), training.Strategy("boosted_rolling_10d", "boosted", 10)]
    return training.strategy_folds(frame, "hour_ts", FEATURES, ["symbol"], list(CLASSES), 2, strategies, "sample_weight")


@query(
    "l07_class_auc",
    "with e as (" + " union all ".join(f"select '{c}' as class_name, prob_{c.lower()} as s, (actual = '{c}')::int as y from v_classes" for c in CLASSES) + """),
      r as (select class_name, y, rank() over (partition by class_name order by s) + (count(*) over (partition by class_name, s) - 1) / 2.0 as r from e)
      select class_name, count(*) as row_count, avg(y) as class_share, (sum(case when y = 1 then r end) - sum(y) * (sum(y) + 1) / 2.0) / (sum(y) * (count(*) - sum(y)))::double as auc from r group by class_name""",
    "class_share auc",
    8,
)
def class_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.class_auc(view(spark, sf_dir, "v_classes"), CLASSES, "actual")


_RECALL = lambda c: f"coalesce(sum((actual = '{c}' and said = '{c}')::int) / nullif(sum((actual = '{c}')::int), 0)::double, 0)"
_F1 = lambda c: f"coalesce(2 * sum((actual = '{c}' and said = '{c}')::int) / nullif(sum((actual = '{c}')::int) + sum((said = '{c}')::int), 0)::double, 0)"
GRID_SQL = f"""with l as (select *, case when prob_down >= prob_flat and prob_down >= prob_up then 'DOWN' when prob_flat >= prob_up then 'FLAT' else 'UP' end as likeliest from v_classes),
  t as (select unnest([{', '.join(f'{t!r}::double' for t in metrics.POLICY_THRESHOLDS)}, null]) as threshold), s as (select threshold, actual, case when prob_down >= threshold then 'DOWN' else likeliest end as said from l, t),
  g as (select threshold, ({' + '.join(map(_F1, CLASSES))}) / 3 as macro_f1, {_RECALL('DOWN')} as target_recall, least({', '.join(map(_RECALL, CLASSES))}) as min_recall from s group by threshold)"""


@query("l15_threshold_grid", f"{GRID_SQL} select * from g where threshold is not null", "macro_f1 target_recall min_recall", 8)
def threshold_grid(spark: SparkSession, sf_dir: str) -> DataFrame:
    return metrics.threshold_grid(view(spark, sf_dir, "v_classes"), CLASSES, "DOWN", metrics.POLICY_THRESHOLDS, "actual").where("threshold is not null")


@query(
    "l15_threshold_policy",
    f"""{GRID_SQL}, b as (select macro_f1 as baseline_macro_f1, target_recall as baseline_target_recall from g where threshold is null), e as (select g.*, b.*, macro_f1 >= baseline_macro_f1 - 0.03e0 as eligible from g, b where threshold is not null)
      select threshold, eligible, macro_f1, target_recall, min_recall, baseline_macro_f1, baseline_target_recall, case when eligible then '{metrics.WITHIN}' else '{metrics.DIAGNOSTIC}' end as reason
      from e order by eligible desc, target_recall desc, macro_f1 desc, min_recall desc, threshold limit 1""",
    "macro_f1 target_recall min_recall baseline_macro_f1 baseline_target_recall",
    8,
)
def threshold_policy(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The threshold for DOWN within a budget of macro F1."""
    return metrics.threshold_policy(metrics.threshold_grid(view(spark, sf_dir, "v_classes"), CLASSES, "DOWN", metrics.POLICY_THRESHOLDS, "actual"))
