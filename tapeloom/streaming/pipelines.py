"""Structured Streaming: sources, candles, dead letters, stateful baselines, joins and sinks."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.functions.columns import safe_div
from tapeloom.operators.dedupe import keep_latest
from tapeloom.sources.tables import merge_upsert
from tapeloom.streaming.state import rolling


def json_stream(spark: SparkSession, schema: str, path: str | None = None, kafka: dict[str, str] | None = None, starting: str = "latest") -> DataFrame:
    """Events from a topic or, for tests and back-fills, a folder of JSON lines; unparsable records are left out."""
    if kafka is not None:
        raw = spark.readStream.format("kafka").options(**kafka).option("startingOffsets", starting).load().select(F.col("value").cast("string").alias("value"))
    else:
        raw = spark.readStream.format("text").load(path)
    parsed = raw.select(F.from_json("value", f"{schema}, _bad string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_bad"}).alias("r"))
    return parsed.where("r is not null and r._bad is null").select("r.*").drop("_bad")


def event_time(df: DataFrame, millis: str, into: str, delay: str = "2 seconds") -> DataFrame:
    """Event time and watermark from epoch milliseconds; seconds and microseconds are told by their size."""
    x = F.col(millis)
    ms = F.when(x > 10**14, x / 1000).when(x < 10**11, x * 1000).otherwise(x).cast("long")
    return df.withColumn(into, F.timestamp_millis(ms)).withWatermark(into, delay)


def candles(trades: DataFrame, ts: str = "trade_ts", length: str = "1 minute") -> DataFrame:
    """Tumbling candles; open and close by event time, then trade id. The same for a stream and a table."""
    order = F.struct(F.col(ts), F.col("trade_id"))
    w = trades.groupBy(F.window(ts, length).alias("w"), "symbol").agg(
        F.max_by("trade_id", order).alias("trade_id"), F.min_by("price", order).alias("open_price"), F.max("price").alias("high_price"), F.min("price").alias("low_price"), F.max_by("price", order).alias("close_price"),
        F.sum("quantity").alias("volume"), safe_div(F.sum(F.col("price") * F.col("quantity")), F.sum("quantity")).alias("vwap"),
    )
    return w.select("symbol", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"), "trade_id", "open_price", "high_price", "low_price", "close_price", "volume", "vwap")


#: What makes a record of each source a dead letter, and the reason that goes with it.
DEAD_LETTERS = {
    "crypto_trades": ("price <= 0 or quantity <= 0 or symbol is null", "price or quantity not positive, or no symbol"),
    "crypto_orderbook": ("best_bid_price <= 0 or best_ask_price <= 0 or best_bid_qty < 0 or best_ask_qty < 0 or symbol is null", "price not positive, negative quantity, or no symbol"),
    "crypto_liquidations": ("price <= 0 or quantity <= 0 or symbol is null", "price or quantity not positive, or no symbol"),
    "crypto_sentiment": ("symbol is null or funding_rate_pct is null or oi_delta_pct is null", "no symbol, funding rate or open-interest change"),
    "crypto_onchain_alerts": ("amount <= 0 or symbol is null", "amount not positive, or no symbol"),
}


def route_dead_letters(df: DataFrame, source: str, condition: str | None = None, reason: str | None = None) -> tuple[DataFrame, DataFrame]:
    """(clean rows, dead letters with source, payload as JSON and reason). A condition that is null is not met."""
    default = DEAD_LETTERS.get(source, (None, None))
    bad = F.coalesce(F.expr(condition or default[0]), F.lit(False))
    letters = df.where(bad).select(F.lit(source).alias("source_name"), F.to_json(F.struct(*df.columns), {"ignoreNullFields": "false"}).alias("raw_payload"), F.lit(reason or default[1]).alias("error_reason"))
    return df.where(~bad), letters


def interval_joined(left: DataFrame, right: DataFrame, left_ts: str, right_ts: str, low: str, high: str, how: str = "inner") -> DataFrame:
    """Stream-stream join on symbol and right_ts in [left_ts + low, left_ts + high]; both sides have watermarks."""
    r = right.withColumnRenamed("symbol", "_symbol")
    on = (F.col("symbol") == F.col("_symbol")) & (F.col(right_ts) >= F.col(left_ts) + F.expr(f"interval {low}")) & (F.col(right_ts) <= F.col(left_ts) + F.expr(f"interval {high}"))
    return left.join(r, on, "left_outer" if how == "left" else how).drop("_symbol")


def bollinger_stream(candle_stream: DataFrame, rows: int = 20, width: float = 2.0) -> DataFrame:
    """Bands over the last candles of a symbol, in time order, once the watermark has passed them."""
    s = rolling(candle_stream, "window_start", "trade_id", F.col("close_price"), rows=rows, ttl_minutes=24 * 60)
    return s.select("symbol", F.col("ts").alias("window_start"), F.col("value").alias("close_price"), F.col("mean").alias("sma20"), (F.col("mean") + F.col("dev") * width).alias("upper_band"), (F.col("mean") - F.col("dev") * width).alias("lower_band"))


def oi_delta(sentiment: DataFrame, ts: str = "sent_ts", value: str = "open_interest") -> DataFrame:
    """Change of open interest against the symbol's observation before, in per cent (a table; ``state.change`` for a stream)."""
    from pyspark.sql import Window

    before = F.lag(value).over(Window.partitionBy("symbol").orderBy(ts))
    return sentiment.withColumn("oi_delta_pct", safe_div(F.col(value) - before, before) * 100)


def late_safe(df: DataFrame, keys: list[str]) -> DataFrame:
    """Drops repeats of a key within the watermark; later ones are late and go with the watermark."""
    return df.dropDuplicatesWithinWatermark(keys)


def upsert_sink(path: str, keys: list[str], order: str, partition: str | None = None) -> Callable[[DataFrame, int], None]:
    """For foreachBatch: the last row of each key replaces the stored one. Replaying a batch changes nothing."""

    def write(batch: DataFrame, _: int) -> None:
        merge_upsert(path, keep_latest(batch, keys, [F.col(order)]), keys, partition)

    return write


@dataclass(frozen=True)
class Sink:
    name: str
    frame: DataFrame
    path: str
    partition_by: tuple[str, ...] = ()


def start_all(sinks: list[Sink], checkpoints: str, every: str = "60 seconds", once: bool = False) -> list:
    """One query a sink, each with its own checkpoint; append to partitioned Parquet."""
    started = []
    for s in sinks:
        writer = s.frame.writeStream.format("parquet").option("path", s.path).option("checkpointLocation", f"{checkpoints}/{s.name}").outputMode("append").queryName(s.name)
        writer = writer.partitionBy(*s.partition_by) if s.partition_by else writer
        started.append((writer.trigger(availableNow=True) if once else writer.trigger(processingTime=every)).start())
    return started


def lake_columns(df: DataFrame, ts: str) -> DataFrame:
    """Adds dt and hr, the lake's partitions."""
    return df.withColumn("dt", F.date_format(ts, "yyyy-MM-dd")).withColumn("hr", F.date_format(ts, "HH"))


