"""Stream == batch: the same rows, split into time-ordered files and read as
a stream one file per micro-batch, give the batch result.  A sentinel row on
another key, far in the future, advances the watermark so pending event-time
timers fire before the stream ends."""

import datetime as dt
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide import operators as ops
from eventide.plans import testbed as tb

SF = "/root/testdata/sf0.001"
SENTINEL = -1


def _split_to_stream(spark, df, order_col, parts=3, sentinel=None):
    d = tempfile.mkdtemp(prefix="eventide-stream-")
    c = F.col(order_col)
    if isinstance(df.schema[order_col].dataType, (T.TimestampType, T.TimestampNTZType)):
        c = F.unix_millis(c.cast("timestamp"))
    lo, hi = df.agg(F.min(c), F.max(c)).first()
    step = (hi - lo) // parts + 1
    for i in range(parts):
        df.filter((c >= lo + i * step) & (c < lo + (i + 1) * step)) \
            .coalesce(1).write.parquet(f"{d}/in/p{i}")
    if sentinel is not None:
        sentinel.coalesce(1).write.parquet(f"{d}/in/p{parts}")
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1) \
        .parquet(f"{d}/in/*"), d


def _run(spark, sdf, d):
    name = "s" + uuid.uuid4().hex[:8]
    q = (sdf.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", f"{d}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    return spark.table(name)


def _same(a, b):
    ra = sorted((tuple(r) for r in a.collect()), key=str)
    rb = sorted((tuple(r) for r in b.collect()), key=str)
    assert len(ra) == len(rb)
    assert ra == rb


def _sentinel(spark, df, **vals):
    row = df.limit(1)
    for c, v in vals.items():
        row = row.withColumn(c, F.lit(v).cast(df.schema[c].dataType))
    return row


def test_stream_spend_threshold(spark):
    mo = tb.marketplace_orders(spark, SF)
    s, d = _split_to_stream(spark, mo, "ts")
    kw = dict(key="customer_id", price="price", order_id="order_id", time="ts", seq="seq")
    _same(_run(spark, ops.spend_threshold(s, 500000.0, **kw), d),
          ops.spend_threshold(mo, 500000.0, **kw))


def test_stream_anomaly_and_audit(spark):
    tx = tb.transactions(spark, SF)
    s, d = _split_to_stream(spark, tx, "event_id")
    kw = dict(user="userId", time="ts", seq="event_id", keep=("event_id",))
    _same(_run(spark, ops.anomaly_alerts(s, **kw), d), ops.anomaly_alerts(tx, **kw))
    cc = tb.currency_changes(spark, SF)
    s, d = _split_to_stream(spark, cc, "event_id")
    kw = dict(time="update_time", seq="event_id")
    _same(_run(spark, ops.changelog_audit(s, **kw), d), ops.changelog_audit(cc, **kw))


@pytest.mark.parametrize("parts", [1, 3, 10])
def test_stream_early_fire(spark, parts):
    ev = tb.events(spark, SF)
    s, d = _split_to_stream(spark, ev, "event_id", parts=parts)
    kw = dict(key="user_id", price="value", time="ts", seq="event_id", keep=("event_id",))
    _same(_run(spark, ops.early_fire_window(s, 3_600_000, **kw), d),
          ops.early_fire_window(ev, 3_600_000, **kw))


@pytest.mark.parametrize("mode", ["continue", "close"])
def test_stream_sessions_with_timers(spark, mode):
    ev = tb.events(spark, SF)
    sent = _sentinel(spark, ev, user_id=SENTINEL, event_id=10**9,
                     ts=dt.datetime(2030, 1, 1))
    s, d = _split_to_stream(spark, ev, "event_id", sentinel=sent)
    kw = dict(user="user_id", event_type="event_type", time="ts", seq="event_id",
              end_event="purchase", on_timeout=mode)
    got = _run(spark, ops.sessions(s, 6 * 3600, **kw), d).filter(F.col("user_id") != SENTINEL)
    _same(got, ops.sessions(ev, 6 * 3600, **kw))


def test_stream_hybrid_with_timers(spark):
    ev = tb.events(spark, SF)
    sent = _sentinel(spark, ev, user_id=SENTINEL, event_id=10**9,
                     ts=dt.datetime(2030, 1, 1))
    s, d = _split_to_stream(spark, ev, "event_id", sentinel=sent)
    kw = dict(key="user_id", price="value", time="ts", seq="event_id")
    got = _run(spark, ops.hybrid_window(s, 6 * 3_600_000, 3, **kw), d) \
        .filter(F.col("user_id") != SENTINEL)
    _same(got, ops.hybrid_window(ev, 6 * 3_600_000, 3, **kw))


def test_stream_row_formatter_and_stateless(spark):
    ev = tb.user_events_nulled(spark, SF)
    s, d = _split_to_stream(spark, ev, "event_id")
    _same(_run(spark, ops.row_formatter(s, ["event_type"], order="event_id"), d),
          ops.row_formatter(ev, ["event_type"], order="event_id"))
    q = tb.quality_input(spark, SF)
    s, d = _split_to_stream(spark, q, "event_id")
    _same(_run(spark, ops.quality_score(s), d), ops.quality_score(q))


def test_stream_pricing(spark):
    inv, comp = tb._pricing_inputs(spark, SF)
    si, d1 = _split_to_stream(spark, inv, "event_id")
    sc, d2 = _split_to_stream(spark, comp, "event_id")
    kw = dict(key="sku", time="ts", inventory_seq="event_id", competitor_seq="event_id",
              demand_threshold=3)
    # both sides are cut at the same times, so each micro-batch holds the
    # same time range of both inputs and the fold order equals batch order
    got = _run(spark, ops.dynamic_pricing(si, sc, **kw), d1)
    _same(got, ops.dynamic_pricing(inv, comp, **kw))


def test_stream_first_match(spark):
    ev = tb.events(spark, SF)
    orders = ev.filter("event_type = 'purchase'").select(
        F.col("event_id").cast("string").alias("orderId"), F.col("user_id").alias("customerId"),
        F.col("value").alias("totalAmount"), "ts", "event_id")
    cust = ev.filter("event_type = 'signup'").select(
        F.col("user_id").alias("customerId"), F.col("event_type").alias("name"),
        F.lit("e").alias("email"), F.lit("t").alias("tier"), "ts", "event_id")
    so, d = _split_to_stream(spark, orders, "ts")
    sc, _ = _split_to_stream(spark, cust, "ts")
    kw = dict(time="ts", order_seq="event_id", customer_seq="event_id")
    _same(_run(spark, ops.first_match_join(so, sc, **kw), d),
          ops.first_match_join(orders, cust, **kw))


def test_stream_cdc_transactions(spark):
    oc, ic, te = tb.cdc_inputs(spark, SF)
    so, d = _split_to_stream(spark, oc, "ts_ms")
    si, _ = _split_to_stream(spark, ic, "ts_ms")
    st, _ = _split_to_stream(spark, te, "ts_ms")
    got = _run(spark, ops.cdc_transactions(so, si, st), d)
    _same(got, ops.cdc_transactions(oc, ic, te))


def test_stream_state_ttl(spark):
    cc = tb.currency_changes(spark, SF)
    s, d = _split_to_stream(spark, cc, "event_id")
    kw = dict(time="update_time", seq="event_id", state_ttl="3 hours")
    _same(_run(spark, ops.changelog_audit(s, **kw), d), ops.changelog_audit(cc, **kw))


def _shuffled_stream(spark, df, order_col, sentinel, order=(1, 0, 2)):
    """Files written in another order than their times: rows arrive late
    by up to one file's time span."""
    d = tempfile.mkdtemp(prefix="eventide-stream-")
    lo, hi = df.agg(F.min(order_col), F.max(order_col)).first()
    step = (hi - lo) // 3 + 1
    for n, i in enumerate(order):
        df.filter((F.col(order_col) >= lo + i * step) & (F.col(order_col) < lo + (i + 1) * step)) \
            .coalesce(1).write.parquet(f"{d}/in/p{n}")
    sentinel.coalesce(1).write.parquet(f"{d}/in/p9")
    return spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1) \
        .parquet(f"{d}/in/*"), d


def test_stream_event_order_equals_batch_with_late_files(spark):
    tx = tb.transactions(spark, SF)
    sent = _sentinel(spark, tx, userId=SENTINEL, event_id=10**9, ts=dt.datetime(2030, 1, 1))
    s, d = _shuffled_stream(spark, tx, "event_id", sent)
    kw = dict(user="userId", time="ts", seq="event_id", keep=("event_id",))
    got = _run(spark, ops.anomaly_alerts(s, watermark="60 days", stream_order="event", **kw), d)
    _same(got.filter(F.col("userId") != SENTINEL), ops.anomaly_alerts(tx, **kw))
    # the default arrival order folds the late file after the newer one
    s2, d2 = _shuffled_stream(spark, tx, "event_id", sent)
    arrival = _run(spark, ops.anomaly_alerts(s2, watermark="60 days", **kw), d2)
    assert sorted(map(str, arrival.filter(F.col("userId") != SENTINEL).collect())) != \
        sorted(map(str, ops.anomaly_alerts(tx, **kw).collect()))


def test_stream_latest_changelog_and_session_summary(spark):
    o = spark.read.parquet(f"{SF}/orders.parquet")
    s, d = _split_to_stream(spark, o, "o_orderkey")
    kw = dict(time="o_orderdate", seq="o_orderkey")
    _same(_run(spark, ops.latest_changelog(s, "o_custkey", **kw), d),
          ops.latest_changelog(o, "o_custkey", **kw))
    ev = tb.events(spark, SF)
    sent = _sentinel(spark, ev, user_id=SENTINEL, event_id=10**9, ts=dt.datetime(2030, 1, 1))
    s, d = _split_to_stream(spark, ev, "event_id", sentinel=sent)
    kw = dict(user="user_id", time="ts", value="value", event_type="event_type")
    got = _run(spark, ops.session_summary(s, "12 hours", **kw), d)
    # sessions still open at the end (the sentinel's) are not emitted in append mode
    _same(got, ops.session_summary(ev, "12 hours", **kw))


def test_stream_ttl_cleanup_transactions(spark):
    oc, ic, te = tb.cdc_inputs(spark, SF)
    so, d = _split_to_stream(spark, oc, "ts_ms")
    si, _ = _split_to_stream(spark, ic, "ts_ms")
    st, _ = _split_to_stream(spark, te, "ts_ms")
    got = _run(spark, ops.cdc_transactions(so, si, st, state_ttl="3650 days",
                                           watermark="36500 days"), d)
    _same(got, ops.cdc_transactions(oc, ic, te, state_ttl="3650 days"))


def test_stream_cdc_json_source(spark):
    from eventide.sources.cdc_json import read_cdc, read_cdc_stream
    from test_golden import _kv, _write_json
    rows = [_kv("1", "INSERT", "100", new={"name": "Alice", "age": "30"}),
            _kv("2", "MODIFY", "101", new={"name": "Alice", "age": "31"},
                old={"name": "Alice", "age": "30"})]
    path = _write_json(rows)
    batch = ops.cdc_changelog(read_cdc(spark, path, "kv_changes")).drop("event_time")
    s = ops.cdc_changelog(read_cdc_stream(spark, path, "kv_changes")).drop("event_time")
    _same(_run(spark, s, tempfile.mkdtemp(prefix="eventide-stream-")), batch)


@pytest.mark.parametrize("mode", ["continue", "close"])
def test_stream_event_order_timers_with_late_files(spark, mode):
    ev = tb.events(spark, SF)
    sent = _sentinel(spark, ev, user_id=SENTINEL, event_id=10**9, ts=dt.datetime(2030, 1, 1))
    s, d = _shuffled_stream(spark, ev, "event_id", sent)
    kw = dict(user="user_id", event_type="event_type", time="ts", seq="event_id",
              end_event="purchase", on_timeout=mode)
    got = _run(spark, ops.sessions(s, 6 * 3600, watermark="60 days", stream_order="event",
                                   **kw), d)
    _same(got.filter(F.col("user_id") != SENTINEL), ops.sessions(ev, 6 * 3600, **kw))
    s2, d2 = _shuffled_stream(spark, ev, "event_id", sent)
    kw = dict(key="user_id", price="value", time="ts", seq="event_id")
    got = _run(spark, ops.hybrid_window(s2, 6 * 3_600_000, 3, watermark="60 days",
                                        stream_order="event", **kw), d2)
    _same(got.filter(F.col("user_id") != SENTINEL),
          ops.hybrid_window(ev, 6 * 3_600_000, 3, **kw))
