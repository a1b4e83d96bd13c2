"""Spend threshold: the first row at which a key's running spend reaches a
threshold; one row per key, never again afterwards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.columns import T_MS, exact
from eventide.operators._common import SEQ, last_of, only_for_streams, require_time, with_time_seq
from eventide.streaming.ops import WATERMARK
from eventide.plans.keyed import HotKeys, keyed, scan


def spend_threshold(df: DataFrame, threshold: float, *, key="customer_id",
                    price: str = "price", order_id: str = "order_id",
                    time: str | None = "ts", seq: str | None = None,
                    rows_per_chunk: int | None = None, hot: HotKeys | None = None,
                    watermark: str | None = WATERMARK,
                    stream_order: str = "arrival", history: DataFrame | None = None) -> DataFrame:
    """Output: key (one column or several), total_spend DOUBLE, crossing_order_id STRING, order_count INT.

    Prices are summed exactly (DECIMAL(27,10)), so the crossing row does not
    depend on how a key's rows are grouped.  The crossing test is inclusive (``>=``); a null price counts as 0.  With
    negative prices a key may cross, fall back and cross again: only the first
    crossing is reported.

    On a streaming DataFrame the same call runs a transformWithState
    processor; ``watermark`` bounds lateness and ``stream_order`` is
    'arrival' (fold each micro-batch as it comes) or 'event' (buffer until
    the watermark passes, then fold in event-time order).

    ``history``: on a stream, a batch DataFrame of the input's columns whose
    rows come before all of the stream's: each key starts with the state that
    folding them leaves (computed as a batch job, handed over in the first
    micro-batch).  Keys that crossed in it are not reported again."""
    keys = [key] if isinstance(key, str) else list(key)
    d = with_time_seq(df, time, seq, "spend_threshold", need=(*keys, price, order_id))
    order = [T_MS, SEQ] if time is not None else [SEQ]
    if d.isStreaming:
        from eventide.streaming import ops as st
        require_time(time, "spend_threshold (stream)")
        state = None
        if history is not None:
            h = with_time_seq(history, time, seq, "spend_threshold (history)", need=(*keys, price, order_id))
            k = scan(_spent(h, keys, price, order_id, order, rows_per_chunk, hot), sums={"_crossed": F.when(
                F.col("_s").cast("double") >= F.lit(float(threshold)), 1)})
            state = last_of(k, order, total=F.col("_s").cast("string"), n=F.col("_n"), done=F.col("_crossed") > 0)
        return st.spend_threshold(
            d.withColumn("_price", F.col(price).cast("double")), threshold, key, order_id,
            watermark, stream_order, state)
    only_for_streams(history, "spend_threshold")
    k = _spent(d, keys, price, order_id, order, rows_per_chunk, hot)
    hits = k.result().withColumn("_s", F.col("_s").cast("double")).filter(F.col("_s") >= F.lit(float(threshold)))
    first = hits.groupBy(*keys).agg(
        F.min_by(F.struct("_s", order_id, "_n"), F.struct(*order)).alias("m"))
    return first.select(
        *keys,
        F.col("m._s").alias("total_spend"),
        F.col(f"m.{order_id}").cast("string").alias("crossing_order_id"),
        F.col("m._n").cast("int").alias("order_count"))


def _spent(d, keys, price, order_id, order, rows_per_chunk, hot):
    """Running row number and spend of each key."""
    d = d.select(*dict.fromkeys([*keys, price, order_id, *order]))
    return scan(keyed(d, keys, order, rows_per_chunk, hot), rn="_n",
                sums={"_s": exact(F.coalesce(F.col(price).cast("double"), F.lit(0.0)))})
