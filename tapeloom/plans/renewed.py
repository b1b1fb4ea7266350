"""Models built in steps as rows arrive, late ones included; the end equals the full build."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.operators import series
from tapeloom.plans.market import TRADES_HOURLY_SQL, trades_hourly
from tapeloom.plans.registry import query
from tapeloom.plans.standins import view
from tapeloom.sources import incremental
from tapeloom.sources.shared import shared_folder
from tapeloom.sources.tables import write_partitioned

#: Arrival of a stand-in trade in days since 2024: every seventh comes two days late.
ARRIVED = "datediff(cast(trade_ts as date), date '2024-01-01') + case when trade_id % 7 = 0 then 2 else 0 end"
STEPS = 4


def market_hours(rows: DataFrame) -> DataFrame:
    return trades_hourly(rows).withColumn("day", F.to_date("hour_ts"))


def label_rows(rows: DataFrame) -> DataFrame:
    hours = trades_hourly(rows).select("hour_ts", "symbol", "close_price").withColumn("day", F.to_date("hour_ts"))
    return series.forward_labels(hours, "close_price", series.by(["symbol"], ["hour_ts"]), {4: 0.003})


#: The stand-in's hours are sparse, so a window of 24 of them may reach over several days.
MARKET = incremental.Model(market_hours, back=12)
LABELS = incremental.Model(label_rows, back=0, ahead=12)


def stepwise(spark: SparkSession, sf_dir: str, model: incremental.Model, name: str, steps: int = STEPS) -> DataFrame:
    """The source lands in a table by day, a step at a time, and the model is renewed after each."""
    folder = shared_folder(spark, name)
    trades = view(spark, sf_dir, "v_trades").withColumns({"day": F.to_date("trade_ts"), "arrived": F.expr(ARRIVED)})
    ends = trades.agg(F.min("arrived"), F.max("arrived")).first()
    low = ends[0] - 1
    for k in range(1, steps + 1):
        high = ends[0] + (ends[1] - ends[0]) * k // steps
        write_partitioned(trades.where((F.col("arrived") > low) & (F.col("arrived") <= high)), f"{folder}/source", ["day"])
        incremental.run(spark, spark.read.parquet(f"{folder}/source"), "arrived", f"{folder}/out", model)
        low = high
    return spark.read.parquet(f"{folder}/out").drop("day")


_DOUBLES = "open_price high_price low_price close_price vwap_price base_volume quote_volume taker_sell_quote_volume taker_buy_quote_volume taker_buy_quote_ratio return_1h log_return_1h quote_volume_24h avg_return_24h realized_volatility_24h quote_volume_zscore_24h"
query("s13_market_hours_in_steps", TRADES_HOURLY_SQL, _DOUBLES, 8)(lambda spark, sf_dir: stepwise(spark, sf_dir, MARKET, "market"))
query(
    "s13_labels_in_steps",
    """with h as (select cast(date_trunc('hour', trade_ts) as timestamp) as hour_ts, symbol, arg_max(price, (trade_ts, trade_id)) as close_price from v_trades group by 1, 2), f as (select *, (lead(close_price, 4) over (partition by symbol order by hour_ts) - close_price) / nullif(close_price, 0) as future_return_4 from h)
      select *, case when future_return_4 >= 0.003 then 'UP' when future_return_4 <= -0.003 then 'DOWN' when future_return_4 is not null then 'FLAT' end as future_direction_4 from f""",
    "close_price future_return_4",
    8,
)(lambda spark, sf_dir: stepwise(spark, sf_dir, LABELS, "labels"))
