"""Custom event-time windows: count-or-time (hybrid) and early-firing."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.columns import T_MS, exact, interval_ms, ms_to_ntz, window_start
from eventide.operators._common import SEQ, last_of, only_for_streams, require_time, with_time_seq
from eventide.plans.keyed import HotKeys, keyed, scan
from eventide.streaming.ops import WATERMARK


def hybrid_window(df: DataFrame, size, count_threshold: int, *, key,
                  price: str = "price", time: str = "ts", seq: str | None = None,
                  rows_per_chunk: int | None = None, hot: HotKeys | None = None,
                  watermark: str | None = WATERMARK,
                  stream_order: str = "arrival", history: DataFrame | None = None) -> DataFrame:
    """Epoch-aligned tumbling window per key that also fires every
    ``count_threshold`` rows.  Output: key (one column or several), window_start, window_end
    (TIMESTAMP_NTZ, UTC), num_orders INT, total_price DOUBLE (null price as 0).

    On a streaming DataFrame the same call runs a transformWithState
    processor; ``watermark`` bounds lateness and ``stream_order`` is
    'arrival' (fold each micro-batch as it comes) or 'event' (buffer until
    the watermark passes, then fold in event-time order).

    ``history``: on a stream, a batch DataFrame of the input's columns whose
    rows come before all of the stream's: each key starts with the state that
    folding them leaves (computed as a batch job, handed over in the first
    micro-batch).  A window still open at its end goes on, and the
    stream reports it, not a batch over the history."""
    require_time(time, "hybrid_window")
    size_ms, n = interval_ms(size), int(count_threshold)
    keys = [key] if isinstance(key, str) else list(key)
    d = with_time_seq(df, time, seq, "hybrid_window", need=(*keys, price))
    if d.isStreaming:
        from eventide.streaming import ops as st
        state = None
        if history is not None:
            h = with_time_seq(history, time, seq, "hybrid_window (history)", need=(*keys, price))
            state = _open_window(_placed(h, keys, price, size_ms, rows_per_chunk, hot), price, n)
        return st.hybrid_window(d.withColumn("_price", F.col(price).cast("double")), size_ms, n,
                                key, watermark, stream_order, state)
    only_for_streams(history, "hybrid_window")
    b = _placed(d, keys, price, size_ms, rows_per_chunk, hot).result() \
        .withColumn("_b", F.floor((F.col("_rn") - F.col("_w0")) / F.lit(n)))
    g = b.groupBy(*keys, "_win", "_b").agg(
        F.count(F.lit(1)).cast("int").alias("num_orders"),
        F.sum(_price(price)).cast("double").alias("total_price"))
    return g.select(*keys, ms_to_ntz(F.col("_win")).alias("window_start"),
                    ms_to_ntz(F.col("_win") + size_ms).alias("window_end"),
                    "num_orders", "total_price")


def _price(price: str):
    return exact(F.coalesce(F.col(price).cast("double"), F.lit(0.0)))


def _placed(d, keys, price, size_ms, rows_per_chunk, hot):
    """Each row with its window, its number and that of the window's first row."""
    d = d.select(*keys, price, T_MS, SEQ).withColumn("_win", window_start(F.col(T_MS), size_ms))
    k = keyed(d, keys, [T_MS, SEQ], rows_per_chunk, hot)
    # windows are contiguous runs in event order: the row number inside the
    # window is the key's row number minus that of the window's first row
    k = scan(k, rn="_rn", lags={"_pw": F.col("_win")})
    first = F.when(~F.col("_pw").eqNullSafe(F.col("_win")), F.col("_rn"))
    return scan(k, lasts={"_w0": first})


def _open_window(k, price: str, n: int) -> DataFrame:
    """The rows since the last firing in the window of each key's last row."""
    k = scan(k, sums={"_tot": _price(price)})
    at = (F.col("_rn") - F.col("_w0")) % n
    k = scan(k, lasts={"_before": F.when(at == 0, F.col("_tot") - _price(price))})
    return last_of(k, [T_MS, SEQ], start=F.col("_win"), n=(at + 1).cast("int"),
                   total=(F.col("_tot") - F.col("_before")).cast("string")).filter(F.col("n") < n)


def early_fire_window(df: DataFrame, size, *, key, price: str = "price",
                      time: str = "ts", seq: str | None = None, order_by: str = "event",
                      keep=(),
                      rows_per_chunk: int | None = None, hot: HotKeys | None = None,
                      watermark: str | None = WATERMARK,
                      stream_order: str = "arrival", history: DataFrame | None = None) -> DataFrame:
    """Running window aggregate emitted on every row.  The running totals
    restart whenever a row's window differs from the previous row's (also for
    late rows).  ``order_by``: 'event' (time, seq) or 'arrival' (seq).
    Output: key (one column or several), window_start, window_end, num_orders, total_price (+ keep).

    On a streaming DataFrame the same call runs a transformWithState
    processor; ``watermark`` bounds lateness and ``stream_order`` is
    'arrival' (fold each micro-batch as it comes) or 'event' (buffer until
    the watermark passes, then fold in event-time order).

    ``history``: on a stream, a batch DataFrame of the input's columns whose
    rows come before all of the stream's: each key starts with the state that
    folding them leaves (computed as a batch job, handed over in the first
    micro-batch).  The running totals of its last window go on."""
    require_time(time, "early_fire_window")
    size_ms = interval_ms(size)
    if order_by not in ("event", "arrival"):
        raise ValueError("order_by must be 'event' or 'arrival'")
    if order_by == "arrival" and seq is None:
        raise ValueError("early_fire_window: in arrival order seq is the order and must be given")
    keys = [key] if isinstance(key, str) else list(key)
    d = with_time_seq(df, time, seq, "early_fire_window", need=(*keys, price, *keep))
    if d.isStreaming:
        from eventide.streaming import ops as st
        if order_by == "arrival" and stream_order == "event":
            raise ValueError("order_by='arrival' and stream_order='event' exclude each other")
        extra = [c for c in keep if c not in keys]
        if extra and extra != [seq]:
            raise NotImplementedError("streams keep only the seq column")
        state = None
        if history is not None:
            h = with_time_seq(history, time, seq, "early_fire_window (history)", need=(*keys, price))
            k = _running(h, keys, price, size_ms, order_by, (), rows_per_chunk, hot)
            state = last_of(k, [T_MS, SEQ] if order_by == "event" else [SEQ], start=F.col("_win"),
                            n=F.col("_cnt").cast("int"), total=F.col("_tot").cast("string"))
        return st.early_fire_window(d.withColumn("_price", F.col(price).cast("double")),
                                    size_ms, key, seq if extra else None, watermark,
                                    stream_order, order_by == "arrival", state)
    only_for_streams(history, "early_fire_window")
    return _running(d, keys, price, size_ms, order_by, keep, rows_per_chunk, hot).result().select(
        *keys, ms_to_ntz(F.col("_win")).alias("window_start"),
        ms_to_ntz(F.col("_win") + size_ms).alias("window_end"),
        F.col("_cnt").cast("int").alias("num_orders"),
        F.col("_tot").cast("double").alias("total_price"),
        *[c for c in keep if c not in keys])


def _running(d, keys, price, size_ms, order_by, keep, rows_per_chunk, hot):
    """Each row with the running count and total of its window."""
    d = d.select(*keys, price, T_MS, SEQ, *[c for c in keep if c not in (*keys, price)]) \
        .withColumn("_win", window_start(F.col(T_MS), size_ms))
    order = [T_MS, SEQ] if order_by == "event" else [SEQ]
    k = keyed(d, keys, order, rows_per_chunk, hot)
    price_0 = _price(price)
    if order_by == "event":
        # window start is monotone in event time: each window is one run
        k = scan(k, by=["_win"], rn="_cnt", sums={"_tot": price_0})
    else:
        # arrival order: a row whose window differs from the previous row's
        # (also a late row) restarts the totals
        k = scan(k, lags={"_pw": F.col("_win")})
        k = k.map(lambda d: d.withColumn(
            "_new", (~F.col("_pw").eqNullSafe(F.col("_win"))).cast("int")))
        k = scan(k, sums={"_isl": F.col("_new")})
        k = scan(k, by=["_isl"], rn="_cnt", sums={"_tot": price_0})
    return k
