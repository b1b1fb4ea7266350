"""Series in chunks: one key's rows spread over many tasks, with the results of one window over all of them.

A frame that reaches back a fixed time or number of rows needs only the rows shortly before its chunk, so these are
copied to the next chunk (a halo) and dropped again after the window. What reaches back without bound needs a carry:
the last row, or the sum, of all chunks before, of which there are few.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.window import WindowSpec

from tapeloom.sources.shared import written

Frames = Callable[[WindowSpec], dict[str, Column]]


def _micros(ts: str) -> Column:
    return F.unix_micros(F.col(ts).cast("timestamp"))


def over_time(df: DataFrame, keys: Sequence[str], ts: str, reach: int, columns: Frames, size: int | None = None) -> DataFrame:
    """Adds ``columns`` over the rows of a key from ``reach`` seconds before each row up to it (equal times included).

    ``columns`` gets a window ordered by time with that range. Chunks are ``size`` seconds long (four times the reach
    by default, never shorter than it), so a row is in two windows at most. Rows without a time see themselves and
    others without, as in a plain window.
    """
    length = max(reach, size or 4 * reach) * 1_000_000
    at = _micros(ts)
    chunk = F.floor(at / length)
    ahead = F.pmod(at, F.lit(length)) >= length - reach * 1_000_000  # within the reach of the next chunk
    dealt = df.withColumn("_at", at).withColumn("_chunk", F.explode(F.when(ahead, F.array(chunk, chunk + 1)).otherwise(F.array(chunk)))).withColumn("_own", F.coalesce(F.col("_chunk") == chunk, F.lit(True)))
    w = Window.partitionBy(*keys, "_chunk").orderBy("_at").rangeBetween(-reach * 1_000_000, 0)
    return dealt.withColumns(columns(w)).where("_own").drop("_at", "_chunk", "_own")


def mean_over_time(df: DataFrame, keys: Sequence[str], ts: str, reach: int, value: str, into: str) -> DataFrame:
    """Adds the mean of the values from ``reach`` seconds before each row up to it (equal times included), in time in
    proportion to the rows however many a frame has: ``over_time`` adds each frame up anew.

    Chunks are as long as the reach, so a frame is the chunk's own rows up to the row and the last ones of the chunk
    before. Each row is also placed a reach later, in the next chunk; there a running sum from the end of the chunk
    gives the second part, as one from its beginning gives the first. Nothing is subtracted, so no precision is lost.
    """
    length = reach * 1_000_000
    at = _micros(ts)
    place = lambda ahead: F.struct((F.floor(at / length) + ahead).alias("chunk"), (at + ahead * length).alias("at"), F.lit(ahead == 0).alias("own"))
    dealt = df.withColumn("_p", F.explode(F.when(at.isNotNull(), F.array(place(0), place(1))).otherwise(F.array(place(0))))).withColumns({"_chunk": F.col("_p.chunk"), "_at": F.col("_p.at"), "_own": F.col("_p.own")})
    up, down = (Window.partitionBy(*keys, "_chunk").orderBy(o).rangeBetween(Window.unboundedPreceding, Window.currentRow) for o in (F.col("_at").asc(), F.col("_at").desc()))
    mine, before = F.when(F.col("_own"), F.col(value)), F.when(~F.col("_own"), F.col(value))
    summed = dealt.withColumns({"_sum": F.sum(mine).over(up), "_n": F.count(mine).over(up), "_sum_b": F.sum(before).over(down), "_n_b": F.count(before).over(down)}).where("_own")
    mean = (F.coalesce("_sum", F.lit(0.0)) + F.coalesce("_sum_b", F.lit(0.0))) / F.nullif(F.col("_n") + F.col("_n_b"), F.lit(0))
    return summed.withColumn(into, mean).drop("_p", "_chunk", "_at", "_own", "_sum", "_n", "_sum_b", "_n_b")


def ranked(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], into: str = "rank") -> DataFrame:
    """Adds the 0-based place of each row among its key's, without one task a key (or, without keys, for all rows).

    Rows are range-partitioned by key and order. A key that goes on from one partition to the next is the first of
    that one, so the offsets are at most a row a partition, and are broadcast. Rows equal in the order are told apart
    by their place in the input. The frame is written once to the shared folder.
    """
    order = [F.col(c) if isinstance(c, str) else c for c in order]
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tied = df.withColumn("_tie", F.monotonically_increasing_id())
    parted = written(tied.repartitionByRange(n, *keys, *order, "_tie").withColumn("_pid", F.spark_partition_id()), "ranked")
    held = parted.groupBy("_pid", *keys).agg(F.count(F.lit(1)).alias("_rows"))
    ahead = Window.partitionBy(*keys).orderBy("_pid").rowsBetween(Window.unboundedPreceding, -1)  # a row a key and partition
    offsets = held.select(F.col("_pid").alias("_o_pid"), *[F.col(k).alias(f"_o_{k}") for k in keys], F.sum("_rows").over(ahead).alias("_off")).where("_off > 0")
    same = F.col("_pid") == F.col("_o_pid")
    for k in keys:
        same = same & F.col(k).eqNullSafe(F.col(f"_o_{k}"))
    local = parted.withColumn(into, F.row_number().over(Window.partitionBy("_pid", *keys).orderBy(*order, "_tie")) - 1)
    return local.join(F.broadcast(offsets), same, "left").withColumn(into, F.col(into) + F.coalesce("_off", F.lit(0))).drop("_pid", "_tie", "_o_pid", "_off", *[f"_o_{k}" for k in keys])


def over_rows(df: DataFrame, keys: Sequence[str], order: Sequence[Column | str], before: int, after: int, columns: Frames, size: int = 100_000) -> DataFrame:
    """Adds ``columns`` over frames of rows that reach no further than ``before`` rows back and ``after`` ahead.

    ``columns`` gets a window of the key's rows in order, without a frame (lags, leads and frames of rows may be used).
    Chunks have ``size`` rows by rank, so a key of any number of rows is many tasks.
    """
    size = max(size, before, after, 1)
    chunk, place = F.floor(F.col("_rank") / size), F.col("_rank") % size
    copies = F.array_compact(F.array(chunk, F.when(place >= size - before, chunk + 1), F.when((place < after) & (chunk > 0), chunk - 1)))
    dealt = ranked(df, keys, order, "_rank").withColumn("_chunk", F.explode(copies)).withColumn("_own", F.col("_chunk") == chunk)
    w = Window.partitionBy(*keys, "_chunk").orderBy("_rank")
    return dealt.withColumns(columns(w)).where("_own").drop("_rank", "_chunk", "_own")


def _carried(rows: DataFrame, keys: Sequence[str], value: Column) -> DataFrame:
    """Of each key and chunk what the chunks before leave: ``value`` aggregates a chunk, the last one known is carried on."""
    each = rows.groupBy(*keys, "_chunk").agg(value.alias("_last"))
    ahead = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)  # a row a chunk
    return each.select(*[F.col(k).alias(f"_c_{k}") for k in keys], F.col("_chunk").alias("_c_chunk"), F.last("_last", ignorenulls=True).over(ahead).alias("_carry"))


def _with_carry(rows: DataFrame, keys: Sequence[str], carry: DataFrame) -> DataFrame:
    on = F.col("_chunk").eqNullSafe(F.col("_c_chunk"))
    for k in keys:
        on = on & F.col(k).eqNullSafe(F.col(f"_c_{k}"))
    return rows.join(carry, on, "left").drop("_c_chunk", *[f"_c_{k}" for k in keys])


def fill_forward(df: DataFrame, keys: Sequence[str], order: Sequence[str], values: Sequence[str], seconds: int = 86_400) -> DataFrame:
    """Each value where it is null becomes the last known one of its key; ``order`` begins with the time and tells rows apart."""
    out = df.withColumn("_chunk", F.floor(_micros(order[0]) / (seconds * 1_000_000)))
    at = F.struct(*order)
    last = F.struct(*[F.max_by(F.col(v), F.when(F.col(v).isNotNull(), at)).alias(v) for v in values])
    each = out.groupBy(*keys, "_chunk").agg(last.alias("_last"))
    ahead = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)  # a row a chunk
    carry = each.select(*[F.col(k).alias(f"_c_{k}") for k in keys], F.col("_chunk").alias("_c_chunk"), *[F.last(f"_last.{v}", ignorenulls=True).over(ahead).alias(f"_carry_{v}") for v in values])
    within = Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0)
    met = _with_carry(out, keys, carry)
    return met.withColumns({v: F.coalesce(F.last(v, ignorenulls=True).over(within), F.col(f"_carry_{v}")) for v in values}).drop("_chunk", *[f"_carry_{v}" for v in values])


def running_sum(df: DataFrame, keys: Sequence[str], order: Sequence[str], value: str, into: str, seconds: int = 86_400) -> DataFrame:
    """Adds the sum of the key's values up to the row: what the chunks before sum to, and the chunk's own up to the row."""
    out = df.withColumn("_chunk", F.floor(_micros(order[0]) / (seconds * 1_000_000)))
    each = out.groupBy(*keys, "_chunk").agg(F.sum(value).alias("_sum"))
    ahead = Window.partitionBy(*keys).orderBy("_chunk").rowsBetween(Window.unboundedPreceding, -1)  # a row a chunk
    carry = each.select(*[F.col(k).alias(f"_c_{k}") for k in keys], F.col("_chunk").alias("_c_chunk"), F.sum("_sum").over(ahead).alias("_carry"))
    own = F.sum(value).over(Window.partitionBy(*keys, "_chunk").orderBy(*order).rowsBetween(Window.unboundedPreceding, 0))
    met = _with_carry(out, keys, carry).withColumn("_own", own)
    both = F.coalesce("_own", F.lit(0)) + F.coalesce("_carry", F.lit(0))
    return met.withColumn(into, F.when(F.col("_own").isNotNull() | F.col("_carry").isNotNull(), both)).drop("_chunk", "_carry", "_own")


def asof_join(left: DataFrame, right: DataFrame, keys: Sequence[str], left_ts: str, right_ts: str, tie: Sequence[str], values: Sequence[str], tolerance: str | None = None, seconds: int = 86_400) -> DataFrame:
    """As ``joins.asof_join``, in time chunks: the last right row of the chunks before is carried into each.

    Both sides are stacked; the window is over a key and chunk, so one key's rows are as many tasks as it has chunks.
    """
    payload = F.struct(F.col(right_ts).alias("_at"), *values)
    row, blank = F.struct(*left.columns), F.lit(None)
    names = [f"_k{i}" for i in range(len(keys))]
    ties = [f"_tie{i}" for i in range(len(tie))]
    left_type = left.select(row.alias("p")).schema["p"].dataType
    right_type = right.select(payload.alias("p")).schema["p"].dataType
    l_side = left.select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.col(left_ts).alias("_t"), F.lit(1).alias("_side"), *[blank.cast("string").alias(t) for t in ties], row.alias("_left"), blank.cast(right_type).alias("_right"))
    r_side = right.where(F.col(right_ts).isNotNull()).select(*[F.col(k).alias(n) for k, n in zip(keys, names, strict=True)], F.col(right_ts).alias("_t"), F.lit(0).alias("_side"), *[F.col(c).cast("string").alias(t) for c, t in zip(tie, ties, strict=True)], blank.cast(left_type).alias("_left"), payload.alias("_right"))
    both = l_side.unionByName(r_side).withColumn("_chunk", F.floor(F.unix_micros(F.col("_t").cast("timestamp")) / (seconds * 1_000_000)))
    carry = _carried(both, names, F.max_by("_right", F.when(F.col("_right").isNotNull(), F.struct("_t", *ties))))
    w = Window.partitionBy(*names, "_chunk").orderBy("_t", "_side", *ties).rowsBetween(Window.unboundedPreceding, 0)
    known = F.coalesce(F.last("_right", ignorenulls=True).over(w), F.when(F.col("_t").isNotNull(), F.col("_carry")))
    met = _with_carry(both, names, carry).withColumn("_right", known).where("_side = 1")
    fresh = F.col("_right._at") >= F.col("_t") - F.expr(f"interval {tolerance}") if tolerance else F.lit(True)
    return met.select("_left.*", F.when(fresh, F.col("_right._at")).alias(right_ts), *[F.when(fresh, F.col(f"_right.{v}")).alias(v) for v in values])
