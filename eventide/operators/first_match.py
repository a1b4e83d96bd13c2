"""One-shot first-match join of two co-keyed streams."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.columns import T_MS
from eventide.operators._common import SEQ, last_of, only_for_streams, with_time_seq
from eventide.functions.columns import interval_ms
from eventide.plans.keyed import HotKeys, keyed, scan, ttl_epochs
from eventide.streaming.ops import WATERMARK


def first_match_join(orders: DataFrame, customers: DataFrame, *,
                     key: str = "customerId", time: str = "ts",
                     order_seq: str | None = None, customer_seq: str | None = None,
                     order_id: str = "orderId", total: str = "totalAmount",
                     name: str = "name", email: str = "email", tier: str = "tier",
                     rows_per_chunk: int | None = None, hot: HotKeys | None = None,
                     watermark=WATERMARK,
                     state_ttl=None, stream_order: str = "arrival", history=None) -> DataFrame:
    """Output: orderId, customerId, totalAmount, customerName, customerEmail,
    customerTier, firstArrival ('ORDER'|'CUSTOMER'), joinTimestamp (ms).

    At most one row per key: at the first row (in event-time order) where an
    order row finds a stored customer with a non-null name, or a customer row
    finds a stored order with a non-null id.  Stored values are the latest of
    each side up to that row.

    ``state_ttl`` (ms or '1 hour'; the reference keeps state 1 hour):
    after a silence longer than that a key starts over and may match again.

    On a streaming DataFrame the same call runs a transformWithState
    processor; ``watermark`` bounds lateness (one delay, or one for each
    input; an input that lags behind the other holds it back) and ``stream_order`` is
    'arrival' (fold each micro-batch as it comes) or 'event' (buffer until
    the watermark passes, then fold in event-time order).

    ``history``: on streams, two batch DataFrames (orders, customers) whose
    rows come before all of the streams': each key starts with the state that
    folding them leaves.  Keys that matched in it do not match again."""
    o = with_time_seq(orders, time, order_seq, "first_match_join(orders)",
                      need=(key, order_id, total))
    c = with_time_seq(customers, time, customer_seq, "first_match_join(customers)",
                      need=(key, name, email, tier))
    ttl = interval_ms(state_ttl) if state_ttl else None
    ostruct = F.struct(F.col(order_id).cast("string").alias("orderId"),
                       F.col(total).cast("double").alias("totalAmount"))
    cstruct = F.struct(F.col(name).alias("name"), F.col(email).alias("email"),
                       F.col(tier).alias("tier"))
    evt = []
    if orders.isStreaming or customers.isStreaming:
        from eventide.streaming import ops as st
        late = st.delays(watermark, 2)
        o, c, evt = st.watermarked(o, late[0]), st.watermarked(c, late[1]), ["_evt"]

    def tagged(o, c, *more):
        return (o.select(key, T_MS, SEQ, F.lit(0).alias("_side"), ostruct.alias("_o"),
                         F.lit(None).cast(cstruct_type()).alias("_c"), *more)
                .unionByName(c.select(key, T_MS, SEQ, F.lit(1).alias("_side"),
                                      F.lit(None).cast(ostruct_type()).alias("_o"),
                                      cstruct.alias("_c"), *more)))

    u = tagged(o, c, *evt)
    order = [T_MS, "_side", SEQ]
    if u.isStreaming:
        s = u.select(key, T_MS, SEQ, "_side", F.col("_o.orderId").alias("_oid"),
                     F.col("_o.totalAmount").alias("_total"), F.col("_c.name").alias("_name"),
                     F.col("_c.email").alias("_email"), F.col("_c.tier").alias("_tier"), *evt)
        state = None
        if history is not None:
            old = tagged(with_time_seq(history[0], time, order_seq, "first_match_join(history)",
                                       need=(key, order_id, total)),
                         with_time_seq(history[1], time, customer_seq, "first_match_join(history)",
                                       need=(key, name, email, tier)))
            k, cand = _latest(old, key, order, rows_per_chunk, hot, ttl)
            k = scan(k, sums={"_hits": F.when(cand, 1)})
            state = last_of(k, order, o=F.col("_lo"), c=F.col("_lc"), first=F.col("_fs"), done=F.col("_hits") > 0)
        return st.first_match_join(s, key, late[0], ttl, stream_order, state)
    only_for_streams(history, "first_match_join")
    k, cand = _latest(u, key, order, rows_per_chunk, hot, ttl)
    hit = k.result().filter(F.coalesce(cand, F.lit(False)))
    first = hit.groupBy(*k.keys).agg(F.min_by(F.struct("_lo", "_lc", "_fs", T_MS),
                                          F.struct(*order)).alias("m"))
    return first.select(
        F.col("m._lo.orderId").alias("orderId"),
        F.col(key).alias("customerId"),
        F.col("m._lo.totalAmount").alias("totalAmount"),
        F.col("m._lc.name").alias("customerName"),
        F.col("m._lc.email").alias("customerEmail"),
        F.col("m._lc.tier").alias("customerTier"),
        F.when(F.col("m._fs") == 0, F.lit("ORDER")).otherwise(F.lit("CUSTOMER"))
        .alias("firstArrival"),
        F.col(f"m.{T_MS}").alias("joinTimestamp"))


def _latest(u, key, order, rows_per_chunk, hot, ttl):
    """Each row with both sides' latest values, and whether it can match."""
    k = ttl_epochs(keyed(u, [key], order, rows_per_chunk, hot), ttl)
    k = scan(k, lasts={"_lo": F.col("_o"), "_lc": F.col("_c")},
             firsts={"_fs": F.col("_side")})
    side = F.col("_side")
    return k, (((side == 0) & F.col("_lc.name").isNotNull())
               | ((side == 1) & F.col("_lo.orderId").isNotNull()))


def ostruct_type():
    return "struct<orderId:string,totalAmount:double>"


def cstruct_type():
    return "struct<name:string,email:string,tier:string>"
