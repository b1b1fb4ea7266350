"""Incremental models: a run finds which days new rows touch, reads these with what they look back and ahead at, and replaces only them."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.sources.tables import exists, write_partitioned


@dataclass(frozen=True)
class Model:
    """``build`` turns source rows into output rows with column ``day``; a day's output depends on the source from
    ``back`` days before to ``ahead`` days after it. Both tables are partitioned by ``day``."""

    build: Callable[[DataFrame], DataFrame]
    back: int
    ahead: int = 0
    day: str = "day"


def touched(days: list[date], model: Model) -> list[date]:
    """Days whose output a change of the given source days may alter."""
    return sorted({d + timedelta(k) for d in days for k in range(-model.ahead, model.back + 1)})


def wanted(days: list[date], model: Model) -> list[date]:
    """Source days that the output of the given days depends on."""
    return sorted({d + timedelta(k) for d in days for k in range(-model.back, model.ahead + 1)})


def on_days(df: DataFrame, days: list[date], day: str) -> DataFrame:
    """Rows of the days, as literals, so that a scan of a table partitioned by day reads these partitions alone."""
    return df.where(F.col(day).isin(days)) if days else df.limit(0)


def last_mark(spark: SparkSession, marks: str):
    """The highest arrival that a finished run has taken in; None before the first."""
    return spark.read.parquet(marks).agg(F.max("mark")).first()[0] if exists(spark, marks) else None


def run(spark: SparkSession, source: DataFrame, arrived: str, path: str, model: Model) -> list[date]:
    """Take in what has arrived since the last run; returns the days that were replaced.

    ``arrived`` grows with arrival (a load time or number). Late rows are found by it, whatever their day. Output days
    whose source is untouched are neither read nor written. The mark is written last: a run that dies before that
    is done again by the next one, which overwrites the same days. One run at a time.
    """
    marks = f"{path.rstrip('/')}_marks"
    mark = last_mark(spark, marks)
    new = source if mark is None else source.where(F.col(arrived) > F.lit(mark))
    found = new.groupBy(model.day).agg(F.max(arrived).alias("mark")).collect()  # a row a day that has changed
    if not found:
        return []
    upto = max(r["mark"] for r in found)
    # what arrives while this runs is left for the next run
    ends = source.agg(F.min(model.day), F.max(model.day)).first()
    days = [d for d in touched([r[model.day] for r in found], model) if ends[0] <= d <= ends[1]]
    rows = on_days(source, wanted(days, model), model.day).where(F.col(arrived) <= F.lit(upto))
    write_partitioned(on_days(model.build(rows), days, model.day), path, [model.day], "overwrite")
    spark.createDataFrame([(upto,)], f"mark {dict(source.dtypes)[arrived]}").coalesce(1).write.mode("append").parquet(marks)
    return days
