"""Streaming forms of the keyed operators: the same column preparation as
the batch forms, a watermark on the event time, then ``transformWithState``
per key.  The batch functions in ``eventide.operators`` call these when
their input is a streaming DataFrame."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.columns import T_MS, ms_to_ntz

WATERMARK = "1 second"  # the reference's bounded out-of-orderness


def _named(proc, schema: str):
    from eventide.streaming.processors import field_names
    proc.names = field_names(schema)
    return proc


def watermarked(d: DataFrame, watermark: str | None) -> DataFrame:
    """One input with a watermark of its own.  Set before inputs are united:
    Spark then takes the smallest of them, so an input that lags behind the
    others is not late."""
    d = d.withColumn("_evt", F.timestamp_millis(F.col(T_MS)))
    return d.withWatermark("_evt", watermark) if watermark else d


def delays(watermark, inputs: int) -> list:
    """The watermark delay of each input: one for all, or a list of them."""
    if watermark is None or isinstance(watermark, str):
        return [watermark] * inputs
    if len(watermark) != inputs:
        raise ValueError(f"{inputs} watermarks expected, one for each input")
    return list(watermark)


def _tws(d: DataFrame, key, proc, schema: str, time_mode: str,
         watermark: str | None, order: str = "arrival", state: DataFrame | None = None) -> DataFrame:
    """``state``: what keys start from, rows for ``proc.restore``; only the first micro-batch reads it."""
    proc = _named(proc, schema)
    ttl = proc.silence()
    if ttl:
        proc.cleanup_ms = int(ttl)
        time_mode = "EventTime"
        if not watermark:
            raise ValueError("state_ttl on a stream needs a watermark")
    if order == "event":
        if not watermark:
            raise ValueError("stream order 'event' needs a watermark")
        fields = [f for f in d.schema.fields if f.name not in (*_keys(key), "_evt")]
        proc.buffer_fields = [f.name for f in fields]
        proc.buffer_schema = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
        time_mode = "EventTime"
    elif order != "arrival":
        raise ValueError("stream order must be 'arrival' or 'event'")
    if "_evt" not in d.columns:
        d = watermarked(d, watermark)
    first = None if state is None else state.groupBy(*_keys(key))
    return d.groupBy(*_keys(key)).transformWithState(proc, schema, "Append", time_mode, first)


def _keys(key) -> list:
    return [key] if isinstance(key, str) else list(key)


def _kddl(df: DataFrame, key) -> str:
    return ", ".join(f"{k} {_ktype(df, k)}" for k in _keys(key))


def _ktype(df: DataFrame, key: str) -> str:
    return df.schema[key].dataType.simpleString()


def spend_threshold(d: DataFrame, threshold, key, order_id, watermark=WATERMARK,
                    order="arrival", state=None):
    from eventide.streaming.processors import SpendThresholdProcessor
    d = d.select(*_keys(key), F.col(order_id), F.col("_price"), T_MS, "_q")
    schema = (f"{_kddl(d, key)}, total_spend double, crossing_order_id string, "
              "order_count int")
    return _tws(d, key, SpendThresholdProcessor(threshold, key, order_id), schema, "None",
                watermark, order, state)


def early_fire_window(d: DataFrame, size_ms, key, seq_name, watermark=WATERMARK,
                      order="arrival", by_seq=False, state=None):
    from eventide.streaming.processors import EarlyFireProcessor
    d = d.select(*_keys(key), "_price", T_MS, "_q")
    schema = (f"{_kddl(d, key)}, _ws long, _we long, num_orders int, "
              f"total_price double, _q {_ktype(d, '_q')}")
    out = _tws(d, key, EarlyFireProcessor(size_ms, by_seq), schema, "None", watermark, order, state)
    cols = [*_keys(key), ms_to_ntz(F.col("_ws")).alias("window_start"),
            ms_to_ntz(F.col("_we")).alias("window_end"), "num_orders", "total_price"]
    if seq_name:
        cols.append(F.col("_q").alias(seq_name))
    return out.select(*cols)


def hybrid_window(d: DataFrame, size_ms, threshold, key, watermark=WATERMARK,
                  order="arrival", state=None):
    from eventide.streaming.processors import HybridWindowProcessor
    d = d.select(*_keys(key), "_price", T_MS, "_q")
    schema = f"{_kddl(d, key)}, _ws long, _we long, num_orders int, total_price double"
    out = _tws(d, key, HybridWindowProcessor(size_ms, threshold), schema, "EventTime",
               watermark, order, state)
    return out.select(*_keys(key), ms_to_ntz(F.col("_ws")).alias("window_start"),
                      ms_to_ntz(F.col("_we")).alias("window_end"), "num_orders",
                      "total_price")


def sessions(d: DataFrame, timeout_ms, key, end_event, close, watermark=WATERMARK,
             order="arrival", ttl_ms=None, state=None):
    from eventide.streaming.processors import SessionProcessor
    d = d.select(*_keys(key), "_type", T_MS, "_q")
    schema = (f"{_kddl(d, key)}, status string, sessionDuration long, "
              "eventCount int, firstEventType string, lastEventType string")
    return _tws(d, key, SessionProcessor(timeout_ms, end_event, close, ttl_ms), schema, "EventTime",
                watermark, order, state)


def changelog_audit(d: DataFrame, key, time_type, rate_type, watermark=WATERMARK,
                    ttl_ms=None, order="arrival", state=None):
    from eventide.streaming.processors import AuditProcessor
    d = d.select(*_keys(key), "_op", F.col("_rate").cast("string").alias("_rate"), "_time", T_MS, "_q")
    schema = (f"{_kddl(d, key)}, change_type string, old_rate string, "
              f"new_rate string, change_time {time_type}")
    out = _tws(d, key, AuditProcessor(ttl_ms), schema, "None", watermark, order, state)
    return out.select(*_keys(key), "change_type", F.col("old_rate").cast(rate_type).alias("old_rate"),
                      F.col("new_rate").cast(rate_type).alias("new_rate"), "change_time")


def anomaly_alerts(d: DataFrame, key, rules, seq_name, watermark=WATERMARK,
                   order="arrival", ttl_ms=None, clocks=None, state=None):
    from eventide.streaming.processors import AnomalyProcessor
    d = d.select(*_keys(key), "_amount", "_country", "_merchant", T_MS, "_q")
    schema = (f"{_kddl(d, key)}, alertType string, riskScore double, reason string, "
              f"transactionCount int, _q {_ktype(d, '_q')}")
    out = _tws(d, key, AnomalyProcessor(rules, ttl_ms, clocks), schema, "None", watermark, order, state)
    return out.withColumnRenamed("_q", seq_name) if seq_name else out.drop("_q")


def first_match_join(u: DataFrame, key, watermark=WATERMARK, ttl_ms=None,
                     order="arrival", state=None):
    from eventide.streaming.processors import FirstMatchProcessor
    schema = (f"orderId string, {key} {_ktype(u, key)}, totalAmount double, "
              "customerName string, customerEmail string, customerTier string, "
              "firstArrival string, joinTimestamp long")
    out = _tws(u, key, FirstMatchProcessor(ttl_ms), schema, "None", watermark, order, state)
    return out.withColumnRenamed(key, "customerId")


def pattern_count(d: DataFrame, keys, ttl_ms=None, watermark=WATERMARK, order="arrival"):
    from eventide.streaming.processors import PatternCountProcessor
    schema = ", ".join(f"{k} {_ktype(d, k)}" for k in keys) + \
        ", formatted_row string, schema_info string, distinct_patterns long"
    if not ttl_ms:
        return (d.groupBy(*keys)
                .transformWithState(_named(PatternCountProcessor(), schema), schema, "Append", "None"))
    return _tws(d, keys, PatternCountProcessor(ttl_ms), schema, "EventTime", watermark, order)


def cdc_transactions(u: DataFrame, watermark=WATERMARK, ttl_ms=None, items="array"):
    from eventide.streaming.processors import TransactionProcessor, TransactionRowsProcessor
    schema = "transaction_id string, order_id long, customer_id long, status string, total_amount double, "
    if items == "rows":
        proc = TransactionRowsProcessor()
        schema += "line_no long, product_id long, quantity int, unit_price double"
    else:
        proc = TransactionProcessor()
        schema += "line_items array<struct<product_id:bigint,quantity:int,unit_price:double>>"
    if not ttl_ms:
        return u.groupBy("_txn").transformWithState(_named(proc, schema), schema, "Append",
                                                    "None")
    proc.ttl = ttl_ms
    u = u.withColumn("_q", F.lit(0).cast("long"))
    return _tws(u, "_txn", proc, schema, "EventTime", watermark)


def dynamic_pricing(u: DataFrame, args, watermark=WATERMARK, order="arrival", ttl_ms=None):
    from eventide.operators.pricing import price_step
    from eventide.streaming.processors import PricingProcessor
    schema = ("sku string, newPrice double, oldPrice double, reason string, "
              f"timestamp long, seq {_ktype(u, '_q')}")
    return _tws(u, "_sku", PricingProcessor(*args, fold_row=price_step, ttl_ms=ttl_ms), schema,
                "None", watermark, order)


def latest_changelog(d: DataFrame, keys, row_cols, watermark=None):
    """``d`` has ``_k*`` key columns, ``_t``, ``_q`` and the row columns."""
    from eventide.streaming.processors import LatestChangelogProcessor
    fields = [d.schema[c] for c in row_cols]
    row_ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in fields)
    schema = "op string, change_seq int, " + row_ddl
    proc = _named(LatestChangelogProcessor(list(row_cols), row_ddl), schema)
    return d.groupBy(*keys).transformWithState(proc, schema, "Append", "None")


def scd2_changes(d: DataFrame, keys, row_cols, time, watermark=None, order="arrival"):
    """``d`` has ``_k*`` key columns, ``_t``, ``_q``, ``_op`` and the row columns."""
    from eventide.streaming.processors import Scd2Processor
    row_ddl = ", ".join(f"{c} {_ktype(d, c)}" for c in row_cols)
    schema = f"op string, change_seq int, version long, {row_ddl}, valid_from {_ktype(d, time)}, valid_to {_ktype(d, time)}"
    return _tws(d, keys, Scd2Processor(list(row_cols), row_ddl, time), schema, "None", watermark, order)
