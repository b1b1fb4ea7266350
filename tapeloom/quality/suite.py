"""A suite of rules over many tables in one result: value rules, unique combinations and relationships, with their first offenders."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tapeloom.quality import rules as Q


@dataclass(frozen=True)
class Relationship:
    """Every value of ``columns`` that isn't null is one of the parent's; ``where`` keeps some of the parent's rows."""

    columns: Sequence[str]
    parent: str
    parent_columns: Sequence[str]
    where: str | None = None
    severity: str = "error"

    @property
    def name(self) -> str:
        kept = f"[{self.where}]" if self.where else ""
        return f"relationship:{','.join(self.columns)}->{self.parent}({','.join(self.parent_columns)}){kept}"


@dataclass(frozen=True)
class Table:
    frame: DataFrame
    rules: Sequence[Q.Rule] = ()
    relationships: Sequence[Relationship] = field(default=())


def _text(columns: Sequence[str]) -> Column:
    return F.concat_ws("|", *[F.coalesce(F.col(c).cast("string"), F.lit("null")) for c in columns])


def _first(rows: DataFrame, columns: Sequence[str], n: int) -> DataFrame:
    """The n least distinct values, as text joined by commas: each task hands on n of them."""
    least = rows.select(_text(columns).alias("_v")).distinct().orderBy("_v").limit(n)
    return least.agg(F.array_join(F.array_sort(F.collect_list("_v")), ",").alias("offenders"))


def _offending(table: Table, rule: Q.Rule) -> tuple[DataFrame, Sequence[str]] | None:
    """Rows against a rule and the columns that show them; None for rules on the table as a whole."""
    df = table.frame
    if any(c not in df.columns for c in rule.columns):
        return None
    if rule.kind == "accepted":
        return df.where(F.col(rule.columns[0]).isNotNull() & ~F.col(rule.columns[0]).isin(*rule.values)), rule.columns
    if rule.kind == "between":
        x = F.col(rule.columns[0])
        return df.where((x < rule.low if rule.low is not None else F.lit(False)) | (x > rule.high if rule.high is not None else F.lit(False))), rule.columns
    if rule.kind == "unique":
        return df.dropna(subset=list(rule.columns)).groupBy(*rule.columns).count().where("count > 1"), rule.columns
    return None


def orphans(child: DataFrame, parent: DataFrame, relation: Relationship) -> DataFrame:
    """Child keys that no parent has, with how many rows hold each: keys are counted before they meet the parent's."""
    kept = parent.where(relation.where) if relation.where else parent
    named = [f"_k{i}" for i in range(len(relation.columns))]
    keys = child.dropna(subset=list(relation.columns)).groupBy(*[F.col(c).alias(n) for c, n in zip(relation.columns, named, strict=True)]).agg(F.count(F.lit(1)).alias("_rows"))
    known = kept.select(*[F.col(c).alias(n) for c, n in zip(relation.parent_columns, named, strict=True)])
    return keys.join(known, named, "left_anti")


def run(tables: dict[str, Table], offenders: int = 3) -> DataFrame:
    """A row a rule of every table: table_name, rule_name, severity, violations, passed and the first offending values.

    Value rules of a table are one aggregate over one scan; a unique combination or relationship is a group-by of its
    keys. Offenders are looked for in accepted, between, unique and relationship rules. Null keys break no relationship.
    """
    parts, shown = [], []
    for name, table in tables.items():
        if table.rules:
            parts.append(Q.run_rules(table.frame, table.rules, name))
        for rule in table.rules:
            found = _offending(table, rule)
            if found is not None:
                shown.append(_first(*found, offenders).select(F.lit(name).alias("table_name"), F.lit(rule.name).alias("rule_name"), "offenders"))
        for relation in table.relationships:
            lost = orphans(table.frame, tables[relation.parent].frame, relation)
            broken = F.coalesce(F.sum("_rows"), F.lit(0))
            parts.append(lost.agg(broken.alias("violations")).select(F.lit(name).alias("table_name"), F.lit(relation.name).alias("rule_name"), F.lit(relation.severity).alias("severity"), "violations", (F.col("violations") == 0).alias("passed")))
            shown.append(_first(lost, [f"_k{i}" for i in range(len(relation.columns))], offenders).select(F.lit(name).alias("table_name"), F.lit(relation.name).alias("rule_name"), "offenders"))
    results = reduce(DataFrame.unionByName, parts)
    if not shown:
        return results.withColumn("offenders", F.lit(""))
    return results.join(reduce(DataFrame.unionByName, shown), ["table_name", "rule_name"], "left").withColumn("offenders", F.coalesce("offenders", F.lit("")))
