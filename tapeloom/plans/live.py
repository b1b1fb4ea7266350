"""The eight alerts run as streams over the events' files, until all rows are taken; closed windows equal the batch queries'."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tapeloom.plans.registry import SQL, query
from tapeloom.plans.standins import VIEWS
from tapeloom.plans.streams import P
from tapeloom.sources.shared import shared_folder
from tapeloom.streaming import live, state
from tapeloom.streaming.pipelines import Sink, start_all

FEEDS = {"trades": ("v_s_trades", "trade_ts"), "book": ("v_s_book", "ob_ts"), "liqs": ("v_s_liq", "liq_ts"), "sent": ("v_s_sent", "sent_ts"), "chain": ("v_s_chain", "chain_ts")}
DELAY = "10 minutes"
#: A window has closed for sure when its end lies so far behind the last row of the feed that ends first: twice the
#: longest look-back, a window, the delay, and what a baseline still holds back; sparse feeds hold windows back for longer.
CLOSED = "interval 14 days"
_LAST_SQL = f"(select min(ts) from (select max(ts) as ts from events group by event_type, event_id % 2) e) - {CLOSED}"


def _until(spark: SparkSession, events: str) -> DataFrame:
    last = spark.read.parquet(events).groupBy("event_type", F.col("event_id") % 2).agg(F.max("ts").alias("ts"))
    return F.broadcast(last.agg((F.min("ts") - F.expr(CLOSED)).cast("timestamp").alias("until")))  # one row


def streamed(spark: SparkSession, events: str, name: str, files: int | None = None) -> DataFrame:
    """A stand-in view as a stream of the events' files."""
    schema = spark.read.parquet(events).schema
    reader = spark.readStream.schema(schema).option("recursiveFileLookup", "true")
    view_, ts = FEEDS[name]
    source = (reader.option("maxFilesPerTrigger", files) if files else reader).parquet(events)
    rows = spark.sql(VIEWS[view_].replace("{events}", "{source}"), source=source)
    return rows.withColumn(ts, F.col(ts).cast("timestamp")).withWatermark(ts, DELAY)


def run(df: DataFrame, folder: str, name: str) -> None:
    """Everything there is, then stop; a second call goes on from the checkpoint."""
    for q in start_all([Sink(name, df, f"{folder}/{name}")], f"{folder}/checkpoints", once=True):
        q.awaitTermination()


def baseline(df: DataFrame, folder: str, name: str) -> DataFrame:
    """The first of two queries: runs it and streams its output on."""
    run(df, folder, name)
    return df.sparkSession.readStream.schema(df.schema).parquet(f"{folder}/{name}").withWatermark("ts", DELAY)


Feed = Callable[[str], DataFrame]
Held = Callable[[DataFrame, str], DataFrame]

#: query of the batch form -> the stream, from feeds and baselines
STREAMS: dict[str, Callable[[Feed, Held], DataFrame]] = {
    "t08_bull_trap": lambda feed, held: live.bull_trap(held(live.trade_baseline(feed("trades"), P), "trades"), feed("book"), feed("sent"), feed("chain"), P),
    "t09_true_breakout": lambda feed, held: live.true_breakout(held(live.trade_baseline(feed("trades"), P), "trades"), feed("book"), feed("sent"), feed("chain"), P),
    "t10_bottom_catcher": lambda feed, held: live.bottom_catcher(held(live.trade_baseline(feed("trades"), P), "trades"), held(live.liquidation_baseline(feed("liqs"), P), "liqs"), feed("book"), feed("sent"), feed("chain"), P, 100.0),
    "t11_spoofing": lambda feed, held: live.spoofing(feed("trades"), feed("book"), feed("sent"), feed("chain"), P),
    "t12_mean_reversion": lambda feed, held: live.mean_reversion(held(live.trade_baseline(feed("trades"), P, "scalp_baseline_seconds"), "trades"), feed("book"), P),
    "t13_order_flow": lambda feed, held: live.order_flow(feed("book"), feed("sent"), feed("chain"), P),
    "t14_liquidation_cascade": lambda feed, held: live.liquidation_cascade(held(live.liquidation_baseline(feed("liqs"), P), "liqs"), feed("book"), feed("sent"), feed("chain"), P),
    "t15_lead_lag": lambda feed, held: live.lead_lag(feed("trades"), feed("sent"), feed("chain"), "S0", "S1", P),
}


def stream_session(spark: SparkSession) -> SparkSession:
    """A session of its own for streams, with their state store; a stage of theirs has no more partitions than there are cores.

    State is kept a partition a store, so their number is chosen once, before the first run of a checkpoint.
    """
    own = spark.newSession()
    state.use_store(own)
    own.conf.set("spark.sql.session.timeZone", "UTC")
    own.conf.set("spark.sql.shuffle.partitions", str(max(2, min(int(spark.conf.get("spark.sql.shuffle.partitions")), spark.sparkContext.defaultParallelism // 2))))
    return own


def _closed_sql(name: str) -> str:
    """The batch query's rows whose windows have closed for sure."""
    return f"select * from ({SQL[name]}) a where event_time <= {_LAST_SQL}"


def _register(name: str) -> None:
    def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
        own, events, folder = stream_session(spark), f"{sf_dir}/events.parquet", shared_folder(spark, name)
        df = STREAMS[name](lambda feed: streamed(own, events, feed), lambda df, of: baseline(df, folder, of))
        run(df, folder, "alerts")
        return spark.read.schema(df.schema).parquet(f"{folder}/alerts").join(_until(spark, events), F.col("event_time") <= F.col("until")).drop("until")

    query(f"{name}_live")(alerts)
    SQL[f"{name}_live"] = _closed_sql(name)


for _name in STREAMS:
    _register(_name)


@query(
    "m59_oi_delta_live",
    f"select * from ({SQL['m59_oi_delta']}) a join (select sent_id as id, symbol as s, sent_ts from v_s_sent) t on t.id = a.sent_id where sent_ts <= {_LAST_SQL}".replace("select * from", "select sent_id, symbol, oi_delta_pct from", 1),
    "oi_delta_pct",
)
def oi_delta(spark: SparkSession, sf_dir: str) -> DataFrame:
    """M59 as a stream: the observation before is kept as state."""
    own, events, folder = stream_session(spark), f"{sf_dir}/events.parquet", shared_folder(spark, "oi_delta")
    df = state.change(streamed(own, events, "sent").withColumn("open_interest", F.col("oi_delta_pct") + 10), "sent_ts", "sent_id", F.col("open_interest"), ttl_minutes=None)
    run(df, folder, "changes")
    rows = spark.read.schema(df.schema).parquet(f"{folder}/changes").join(_until(spark, events), F.col("ts") <= F.col("until"))
    return rows.select(F.col("tie").alias("sent_id"), "symbol", F.col("change_pct").alias("oi_delta_pct"))
