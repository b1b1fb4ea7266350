"""Column expressions that market plans share. All are built-in functions, so plans stay in generated code."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec


def safe_div(a: Column, b: Column) -> Column:
    """a / b, null where b is 0 or either is null."""
    return F.try_divide(a, b)


def ieee_div(a: Column, b: Column) -> Column:
    """a / b of doubles as DuckDB divides: infinite where b is 0, NaN where both are."""
    return F.when(b == 0, a * F.lit(float("inf"))).otherwise(F.try_divide(a, b))


def clamp(x: Column, low: float, high: float) -> Column:
    """x within [low, high]; null stays null (greatest and least skip nulls)."""
    return F.when(x.isNotNull(), F.greatest(F.lit(low), F.least(F.lit(high), x)))


def zero(x: Column | str) -> Column:
    return F.coalesce(F.col(x) if isinstance(x, str) else x, F.lit(0.0))


def weighted_avg(x: Column, w: Column, where: Column | None = None) -> Column:
    """sum(x * w) / sum(w) over the rows that pass, null where the weights sum to 0."""
    keep = (lambda c: F.when(where, c)) if where is not None else (lambda c: c)
    return safe_div(F.sum(keep(x * w)), F.sum(keep(w)))


def sum_if(where: Column, x: Column) -> Column:
    return F.sum(F.when(where, x).otherwise(F.lit(0)))


def avg_if(where: Column, x: Column) -> Column:
    return F.avg(F.when(where, x))


def arg_first(value: Column, *order: Column, descending: bool = True, ignore_nulls: bool = True) -> Column:
    """The value of the row that is first in the order (last for ascending keys of all columns alike).

    Null values don't win unless ignore_nulls is off. Give a unique last key to make ties definite.
    """
    key = F.struct(*[o.alias(f"k{i}") for i, o in enumerate(order)])
    key = F.when(value.isNotNull(), key) if ignore_nulls else key
    return F.max_by(value, key) if descending else F.min_by(value, key)


def top_n_json(df: DataFrame, keys: Sequence[str], fields: Sequence[str], order: Sequence[Column], n: int | None, name: str) -> DataFrame:
    """A row a group with its first n rows by the order (all of them for None) as a JSON array of objects.

    Rows are ranked first; with n, Spark cuts each partition's groups to n rows before the shuffle, so n rows are collected.
    """
    first = df.withColumn("_nth", F.row_number().over(Window.partitionBy(*keys).orderBy(*order)))
    first = first if n is None else first.where(F.col("_nth") <= n)
    rows = F.array_sort(F.collect_list(F.struct("_nth", F.struct(*fields).alias("_row"))))
    return first.groupBy(*keys).agg(F.to_json(F.transform(rows, lambda x: x["_row"]), {"ignoreNullFields": "false"}).alias(name))


def hhi(share_pct: Column) -> Column:
    """Herfindahl concentration of shares in per cent."""
    return F.sum(F.pow(share_pct / 100, F.lit(2)))


def surrogate_key(*parts: Column) -> Column:
    """MD5 in hex over the parts as text, joined by a bar."""
    return F.md5(F.concat_ws("|", *[p.cast("string") for p in parts]))


def completeness(names: Sequence[str]) -> Column:
    """Share of the columns that aren't null."""
    return sum((F.col(c).isNotNull().cast("int") for c in names), F.lit(0)) / F.lit(float(len(names)))


def available_at(*times: Column) -> Column:
    """The latest of the sources' availabilities that are known."""
    return F.greatest(*times) if len(times) > 1 else times[0]


def pct_change(x: Column, over: WindowSpec, n: int = 1) -> Column:
    before = F.lag(x, n).over(over)
    return safe_div(x - before, before)


def log_return(x: Column, over: WindowSpec, n: int = 1) -> Column:
    """ln(x / x n rows ago) where both are positive, else null."""
    before = F.lag(x, n).over(over)
    return F.when((before > 0) & (x > 0), F.ln(safe_div(x, before)))


def delta(x: Column, over: WindowSpec, n: int = 1) -> Column:
    return x - F.lag(x, n).over(over)


def zscore(x: Column, over: WindowSpec) -> Column:
    return safe_div(x - F.avg(x).over(over), F.stddev_samp(x).over(over))


def label_by(cases: Sequence[tuple[Column, str]], otherwise: str | None = None) -> Column:
    """The label of the first case that holds."""
    out = F.lit(otherwise)
    for when, label in reversed(cases):
        out = F.when(when, F.lit(label)).otherwise(out)
    return out


def is_true_text(x: Column) -> Column:
    return F.coalesce(F.lower(x.cast("string")).isin("true", "1"), F.lit(False))
