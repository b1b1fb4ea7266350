"""Declarative data quality: all rules of a table in one aggregate pass, health checks, freshness, run summaries."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.functions.columns import label_by


@dataclass(frozen=True)
class Rule:
    """kind: columns, min_rows, max_rows, not_null, accepted, unique, between or condition (SQL that every row must meet)."""

    kind: str
    columns: Sequence[str] = ()
    low: float | None = None
    high: float | None = None
    values: Sequence[Any] = ()
    condition: str | None = None
    severity: str = "error"

    @property
    def name(self) -> str:
        return ":".join([self.kind, ",".join(self.columns) or (self.condition or "")]).rstrip(":")


def parse(spec: dict[str, Any]) -> list[Rule]:
    """Rules from a mapping, as rule files hold them."""
    out = [Rule("columns", spec["required_columns"])] if spec.get("required_columns") else []
    if "min_rows" in spec:
        out.append(Rule("min_rows", low=spec["min_rows"]))
    out += [Rule("not_null", [c]) for c in spec.get("not_null", [])]
    out += [Rule("accepted", [c], values=v) for c, v in spec.get("accepted_values", {}).items()]
    if spec.get("unique_key"):
        out.append(Rule("unique", spec["unique_key"]))
    out += [Rule("between", [c], r.get("min"), r.get("max")) for c, r in spec.get("ranges", {}).items()]
    return out


def _violations(rule: Rule) -> Column | None:
    """The number of rows against a rule that one aggregate can count."""
    if rule.kind == "not_null":
        return F.count_if(F.col(rule.columns[0]).isNull())
    if rule.kind == "accepted":
        return F.count_if(F.col(rule.columns[0]).isNotNull() & ~F.col(rule.columns[0]).isin(*rule.values))
    if rule.kind == "between":
        x = F.col(rule.columns[0])
        out = F.lit(False)
        if rule.low is not None:
            out = out | (x < rule.low)
        if rule.high is not None:
            out = out | (x > rule.high)
        return F.count_if(out)
    if rule.kind == "condition":
        return F.count_if(~F.expr(rule.condition) | F.expr(rule.condition).isNull())
    if rule.kind in ("min_rows", "max_rows"):
        n = F.count(F.lit(1))
        return F.when(n < rule.low, rule.low - n).otherwise(0) if rule.kind == "min_rows" else F.when(n > rule.high, n - rule.high).otherwise(0)
    return None


def run_rules(df: DataFrame, rules: Sequence[Rule], table: str) -> DataFrame:
    """A row a rule: table_name, rule_name, severity, violations, passed.

    All counts come from one scan; keys are counted by a group-by each, so no key set is held in one task. A rule
    on columns that the table lacks fails with one violation. Keys with a null are no one's repeats: that they are
    null is for ``not_null`` to say.
    """
    spark = df.sparkSession
    have = set(df.columns)
    fixed, counted, keys = [], [], []
    for i, r in enumerate(rules):
        missing = [c for c in r.columns if c not in have]
        if r.kind == "columns" or missing:
            fixed.append((i, len(missing)))
        elif r.kind == "unique":
            keys.append(i)
        else:
            counted.append(i)
    known = spark.createDataFrame(fixed, "i int, violations long")
    if counted:
        row = df.agg(*[_violations(rules[i]).cast("long").alias(f"v{i}") for i in counted])
        known = known.unionByName(row.select(F.inline(F.array(*[F.struct(F.lit(i).alias("i"), F.col(f"v{i}").alias("violations")) for i in counted]))))
    for i in keys:
        known = known.unionByName(df.dropna(subset=list(rules[i].columns)).groupBy(*rules[i].columns).count().agg(F.coalesce(F.sum(F.col("count") - 1), F.lit(0)).alias("violations")).select(F.lit(i).alias("i"), "violations"))
    names = spark.createDataFrame([(i, r.name, r.severity) for i, r in enumerate(rules)], "i int, rule_name string, severity string")
    return known.join(F.broadcast(names), "i").select(F.lit(table).alias("table_name"), "rule_name", "severity", "violations", (F.col("violations") == 0).alias("passed"))


def offenders(df: DataFrame, column: str, values: Sequence[Any], n: int = 20) -> DataFrame:
    """The first n values outside the accepted ones, for a message."""
    return df.select(column).where(F.col(column).isNotNull() & ~F.col(column).isin(*values)).distinct().orderBy(column).limit(n)


class RulesFailed(ValueError):
    """Raised with all failed rules after the whole pass."""


def enforce(df: DataFrame, rules: Sequence[Rule], table: str) -> DataFrame:
    """The table if it meets all error rules, else RulesFailed with every failure."""
    failed = [f"{r['rule_name']} ({r['violations']})" for r in run_rules(df, rules, table).where("not passed and severity = 'error'").collect()]  # a row a rule
    if failed:
        raise RulesFailed(f"{table}: " + "; ".join(sorted(failed)))
    return df


def summarise(results: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Totals of a run by outcome and severity, with the failed rules in order."""
    bad = ~F.col("passed")
    return results.groupBy(*keys).agg(
        F.count(F.lit(1)).alias("total_checks"),
        F.count_if(F.col("passed")).alias("passed_checks"),
        F.count_if(bad & (F.col("severity") == "error")).alias("failed_errors"),
        F.count_if(bad & (F.col("severity") == "warning")).alias("failed_warnings"),
        F.array_sort(F.collect_list(F.when(bad, F.concat_ws(": ", "rule_name", F.col("violations").cast("string"))))).alias("failed_rules"),
    )


def freshness(tables: dict[str, tuple[DataFrame, str, int]], as_of: Column) -> DataFrame:
    """A row a table: rows, latest time, age in minutes and FRESH, STALE (twice the limit), OLD or MISSING.

    tables: name to (frame, time column, limit in minutes). as_of is an argument, so that reruns agree.
    """
    out = None
    for name, (df, ts, limit) in tables.items():
        one = df.agg(F.count(F.lit(1)).alias("row_count"), F.max(F.col(ts)).cast("timestamp_ntz").alias("latest_ts")).select(F.lit(name).alias("table_name"), "row_count", "latest_ts", F.lit(limit).alias("limit_minutes"))
        out = one if out is None else out.unionByName(one)
    age = F.timestamp_diff("MINUTE", F.col("latest_ts"), as_of)
    status = label_by([(F.col("latest_ts").isNull(), "MISSING"), (age <= F.col("limit_minutes"), "FRESH"), (age <= F.col("limit_minutes") * 2, "STALE")], "OLD")
    return out.withColumns({"age_minutes": age, "freshness_status": status})


@dataclass(frozen=True)
class Check:
    """A health check: ``metric`` over the table must stay within the bounds; a missing table fails or passes by policy."""

    name: str
    table: DataFrame | None
    metric: Column
    low: float | None = None
    high: float | None = None
    severity: str = "critical"
    missing_ok: bool = False


def health(checks: Sequence[Check], spark) -> DataFrame:
    """A row a check: check_name, severity, value, status (PASS, FAIL or MISSING). Each metric is one aggregate."""
    out = spark.createDataFrame([], "check_name string, severity string, value double, status string")
    for c in checks:
        if c.table is None:
            one = spark.createDataFrame([(c.name, c.severity, None, "PASS" if c.missing_ok else "MISSING")], out.schema)
        else:
            v = F.col("value")
            ok = v.isNotNull() & (v >= c.low if c.low is not None else F.lit(True)) & (v <= c.high if c.high is not None else F.lit(True))
            one = c.table.agg(c.metric.cast("double").alias("value")).select(F.lit(c.name).alias("check_name"), F.lit(c.severity).alias("severity"), "value", F.when(ok, "PASS").otherwise("FAIL").alias("status"))
        out = out.unionByName(one)
    return out


#: Columns that may say how a table is, in order; what counts as well; columns that may hold its last time.
STATUS_COLUMNS = ("freshness_status", "status", "quality_status")
GOOD_STATUS = ("fresh", "ok", "healthy", "pass", "passed", "success", "good")
LATEST_COLUMNS = ("latest_data_update", "latest_data_ts", "latest_source_ts", "latest_update_ts", "latest_loaded_at", "max_event_ts", "hour_ts", "updated_at")


def found_status(df: DataFrame) -> DataFrame:
    """Q10: bad rows by the first column that says so, and its name: a count of them, a flag, or a status text (null is bad)."""
    have = set(df.columns)
    if "bad_freshness_count" in have:
        count = F.max(F.try_to_number(F.col("bad_freshness_count").cast("string"), F.lit("999999999"))).cast("long")
        return df.agg(F.coalesce(count, F.lit(0)).alias("bad_rows"), F.when(count.isNull(), "bad_freshness_count_null").otherwise("bad_freshness_count").alias("status_source"))
    if "is_fresh" in have:
        return df.agg(F.count_if(~F.coalesce(F.col("is_fresh").cast("boolean"), F.lit(False))).alias("bad_rows"), F.lit("is_fresh").alias("status_source"))
    name = next((c for c in STATUS_COLUMNS if c in have), None)
    if name is None:
        return df.sparkSession.createDataFrame([(0, "no_explicit_status_column")], "bad_rows long, status_source string")
    good = F.coalesce(F.lower(F.trim(F.col(name).cast("string"))), F.lit("")).isin(*GOOD_STATUS)
    return df.agg(F.count_if(~good).alias("bad_rows"), F.lit(name).alias("status_source"))


def found_latest(df: DataFrame) -> DataFrame:
    """Q10: the last time in the first column of LATEST_COLUMNS that has one, and its name; nulls where none has."""
    names = [c for c in LATEST_COLUMNS if c in df.columns]
    if not names:
        return df.sparkSession.createDataFrame([(None, None)], "latest_ts timestamp, latest_source string")
    row = df.agg(*[F.max(F.col(c).try_cast("timestamp")).alias(c) for c in names])
    return row.select(F.coalesce(*names).alias("latest_ts"), F.coalesce(*[F.when(F.col(c).isNotNull(), c) for c in names]).alias("latest_source"))


def recent_runs(results: DataFrame, as_of: Column, days: int = 7) -> DataFrame:
    """A row a run of health checks of the last days: counts by outcome and FAILED, WARNING or HEALTHY. Checks without a run are left out."""
    bad = ~F.coalesce(F.col("success"), F.lit(True))
    of = lambda severity: F.count_if(bad & (F.col("severity") == severity))
    runs = results.where((F.col("check_ts") >= as_of - F.make_dt_interval(F.lit(days))) & F.col("run_id").isNotNull()).groupBy("run_id").agg(
        F.max("check_ts").alias("latest_check_ts"), F.count(F.lit(1)).alias("total_checks"), F.count_if(F.col("success")).alias("passed_checks"), F.count_if(bad).alias("failed_checks"), of("critical").alias("failed_critical_checks"), of("warning").alias("failed_warning_checks")
    )
    return runs.withColumn("pipeline_health_status", label_by([(F.col("failed_critical_checks") > 0, "FAILED"), (F.col("failed_warning_checks") > 0, "WARNING")], "HEALTHY"))


def missing_profile(df: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """Rows and nulls of each column by key, and their share of all cells."""
    counts = [F.count_if(F.col(c).isNull()).alias(f"missing_{c}") for c in columns]
    out = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count"), *counts)
    total = sum((F.col(f"missing_{c}") for c in columns), F.lit(0))
    return out.withColumn("missing_share", total / (F.col("row_count") * len(columns)))
