"""Candles, rolling features, labels, fills and spines over keyed time series."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tapeloom.functions.columns import safe_div
from tapeloom.operators import chunked


def ohlcv(df: DataFrame, keys: Sequence[str | Column], ts: str, price: str, qty: str, tie: str) -> DataFrame:
    """Open, high, low, close, VWAP and volume of each key; open and close by time, then tie. Batch or stream."""
    order = F.struct(F.col(ts), F.col(tie))
    return df.groupBy(*keys).agg(
        F.min_by(price, order).alias("open_price"),
        F.max(price).alias("high_price"),
        F.min(price).alias("low_price"),
        F.max_by(price, order).alias("close_price"),
        safe_div(F.sum(F.col(price) * F.col(qty)), F.sum(qty)).alias("vwap_price"),
        F.sum(qty).alias("base_volume"),
        F.count(F.lit(1)).alias("trade_count"),
    )


def reroll(candles: DataFrame, keys: Sequence[str | Column], start: str) -> DataFrame:
    """Candles of a longer span from shorter ones; VWAP is weighted by their volume."""
    return candles.groupBy(*keys).agg(
        F.min_by("open_price", start).alias("open_price"),
        F.max("high_price").alias("high_price"),
        F.min("low_price").alias("low_price"),
        F.max_by("close_price", start).alias("close_price"),
        safe_div(F.sum(F.col("vwap_price") * F.col("base_volume")), F.sum("base_volume")).alias("vwap_price"),
        F.sum("base_volume").alias("base_volume"),
        F.count(F.lit(1)).alias("candle_count"),
    )


def by(keys: Sequence[str], order: Sequence[str | Column]) -> WindowSpec:
    return Window.partitionBy(*keys).orderBy(*order)


def last_rows(over: WindowSpec, n: int) -> WindowSpec:
    """The row and the n - 1 before it."""
    return over.rowsBetween(-(n - 1), 0)


def before_rows(over: WindowSpec, n: int | None) -> WindowSpec:
    """The n rows before the row (all of them for None): nothing of the row itself."""
    return over.rowsBetween(Window.unboundedPreceding if n is None else -n, -1)


def past_rolling(x: Column, over: WindowSpec, n: int | None, agg: str, min_periods: int) -> Column:
    """mean, sum or std of the n values before the row, null with fewer than min_periods of them."""
    w = before_rows(over, n)
    value = {"mean": F.avg, "sum": F.sum, "std": F.stddev_samp}[agg](x).over(w)
    return F.when(F.count(x).over(w) >= min_periods, value)


def past_zscore(x: Column, over: WindowSpec, n: int | None, min_periods: int) -> Column:
    """How far the value lies from the mean of those before it, in their standard deviations."""
    return safe_div(x - past_rolling(x, over, n, "mean", min_periods), past_rolling(x, over, n, "std", min_periods))


def bollinger(df: DataFrame, price: str, over: WindowSpec, n: int = 20, width: float = 2.0) -> DataFrame:
    """sma, upper_band and lower_band over the last n rows (population deviation)."""
    w = last_rows(over, n)
    mean, dev = F.avg(price).over(w), F.stddev_pop(price).over(w)
    return df.withColumns({"sma": mean, "upper_band": mean + dev * width, "lower_band": mean - dev * width})


def range_mean(x: Column, keys: Sequence[str], ts: Column, seconds: int) -> Column:
    """Mean of the values of the last ``seconds``, the row included: a rolling baseline for each event."""
    micros = F.unix_micros(ts.cast("timestamp"))
    return F.avg(x).over(Window.partitionBy(*keys).orderBy(micros).rangeBetween(-seconds * 1_000_000, 0))


def drawdown(df: DataFrame, log_ret: str, over: WindowSpec, n: int) -> DataFrame:
    """cum_log_return and its distance from the highest of the last n rows."""
    run = over.rowsBetween(Window.unboundedPreceding, 0)
    df = df.withColumn("cum_log_return", F.sum(F.coalesce(F.col(log_ret), F.lit(0.0))).over(run))
    return df.withColumn("drawdown", F.col("cum_log_return") - F.max("cum_log_return").over(last_rows(over, n)))


def forward_labels(df: DataFrame, price: str, over: WindowSpec, bands: dict[int, float]) -> DataFrame:
    """For each horizon (rows ahead) the future return and its direction: UP or DOWN beyond the band, else FLAT."""
    for n, band in bands.items():
        ahead = F.lead(price, n).over(over)
        ret = safe_div(ahead - F.col(price), F.col(price))
        df = df.withColumn(f"future_return_{n}", ret)
        r = F.col(f"future_return_{n}")
        df = df.withColumn(f"future_direction_{n}", F.when(r >= band, "UP").when(r <= -band, "DOWN").when(r.isNotNull(), "FLAT"))
    return df


def forward_volatility(x: Column, over: WindowSpec, n: int, min_rows: int) -> Column:
    """Standard deviation of the next n values, the row's own excluded, null with fewer than min_rows."""
    w = over.rowsBetween(1, n)
    return F.when(F.count(x).over(w) >= min_rows, F.stddev_samp(x).over(w))


def time_split(df: DataFrame, keys: Sequence[str], ts: str, cuts: Sequence[tuple[float, str]]) -> DataFrame:
    """split_name by the share of the key's rows that lie before: (upper bound, name) in order."""
    rank = F.percent_rank().over(by(keys, [ts]))
    out = F.lit(cuts[-1][1])
    for bound, name in reversed(cuts[:-1]):
        out = F.when(F.col("_rank") < bound, name).otherwise(out)
    return df.withColumn("_rank", rank).withColumn("split_name", out).drop("_rank")


def fill(x: str, over: WindowSpec, backward: bool = False) -> Column:
    """The last known value up to the row; with backward, else the first known one after it."""
    known = F.last(x, ignorenulls=True).over(over.rowsBetween(Window.unboundedPreceding, 0))
    if not backward:
        return known
    return F.coalesce(known, F.first(x, ignorenulls=True).over(over.rowsBetween(0, Window.unboundedFollowing)))


def spine(df: DataFrame, keys: Sequence[str], ts: str, step: str = "1 hour") -> DataFrame:
    """Every step from the first to the last time of each key."""
    ends = df.groupBy(*keys).agg(F.min(ts).alias("_lo"), F.max(ts).alias("_hi"))
    return ends.select(*keys, F.explode(F.sequence("_lo", "_hi", F.expr(f"interval {step}"))).alias(ts))


def regime(x: str, over: WindowSpec, n: int | None, low: float = 1 / 3, high: float = 2 / 3) -> Column:
    """LOW, MID or HIGH against quantiles of the n values before the row."""
    w = before_rows(over, n)
    a, b = F.percentile(x, low).over(w), F.percentile(x, high).over(w)
    return F.when(F.col(x) <= a, "LOW").when(F.col(x) >= b, "HIGH").when(a.isNotNull() & F.col(x).isNotNull(), "MID")


def walk_forward(df: DataFrame, ts: str, folds: int, warm_up: float = 0.5, window: int | None = None) -> DataFrame:
    """Rows of each fold with their role. Folds cut the distinct times after the warm-up into equal runs; a fold
    trains on all times before its run, or on the last ``window`` of them, and tests on the run.

    Distinct times are ranked by range partitions, so they may be as many as rows; the bounds are broadcast: a row a fold.
    """
    ranked = chunked.ranked(df.select(ts).where(F.col(ts).isNotNull()).distinct(), [], [ts], "_n")
    total = ranked.agg(F.count(F.lit(1)).alias("_total"))
    start = F.floor(F.col("_total") * warm_up)
    size = (F.col("_total") - start) / folds
    bounds = total.select(F.explode(F.sequence(F.lit(0), F.lit(folds - 1))).alias("fold"), "_total").select(
        "fold", (start + F.floor(size * F.col("fold"))).alias("_a"), F.when(F.col("fold") == folds - 1, F.col("_total")).otherwise(start + F.floor(size * (F.col("fold") + 1))).alias("_b")
    )
    low = F.greatest(F.lit(0), F.col("_a") - window) if window else F.lit(0)
    placed = ranked.join(F.broadcast(bounds), (F.col("_n") >= low) & (F.col("_n") < F.col("_b")))
    roles = placed.select(ts, "fold", F.when(F.col("_n") < F.col("_a"), "train").otherwise("test").alias("role"))
    return df.join(roles, ts)
