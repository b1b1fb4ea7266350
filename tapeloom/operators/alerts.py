"""Rule-driven rows: each rule looks at a row and may add one."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.functions.columns import label_by


@dataclass(frozen=True)
class Rule:
    name: str
    category: str
    severities: Sequence[tuple[Column, str]]
    message: Column
    score: Column
    action: str


def rule_alerts(df: DataFrame, keys: Sequence[str], rules: Sequence[Rule]) -> DataFrame:
    """A row for each rule that fires on a row: one pass, no join and no union."""
    fired = F.array(
        *[
            F.struct(
                F.lit(r.name).alias("alert_type"),
                F.lit(r.category).alias("alert_category"),
                label_by(r.severities).alias("alert_severity"),
                r.message.alias("alert_message"),
                r.score.cast("double").alias("alert_score"),
                F.lit(r.action).alias("recommended_action"),
            )
            for r in rules
        ]
    )
    return df.select(*keys, F.inline(F.filter(fired, lambda x: x["alert_severity"].isNotNull())))


def fan_out(df: DataFrame, category: Column, into: str) -> DataFrame:
    """A copy of the row for each entry of the category array (one column expression, one pass)."""
    return df.withColumn(into, F.explode(category))
