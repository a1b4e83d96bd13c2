"""Streams that go on: from a batch history, after a stop, and under a name."""

import datetime as dt
import random
import tempfile
import uuid

import pytest
from pyspark.sql import functions as F

from eventide import operators as ops
from eventide.streaming.named import named_stream, signature

TX = "userId string, amount double, country string, merchant string, ts long, q long"
HOUR, START = 3_600_000, 1_700_000_000_000


def transactions(seed, n=260):
    rnd = random.Random(seed)
    out, t = [], START
    for i in range(n):
        t += rnd.choice([1000, 60_000, 600_000, 2 * HOUR] + [30 * HOUR] * (i % 40 == 0))
        out.append((rnd.choice(["a", "a", "b", None]), rnd.choice([1.5, 3.25, 9.0, 9.0, 9.0, 400.0, None]),
                    rnd.choice(["X", "Y", None]), rnd.choice(["m", "m", "n", None]), t, i))
    return out


def source(spark, rows, schema, files=2):
    d = tempfile.mkdtemp(prefix="eventide-history-")
    step = -(-len(rows) // files)
    for i in range(files):
        spark.createDataFrame(rows[i * step:(i + 1) * step], schema).coalesce(1).write.parquet(f"{d}/in/p{i}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/in/*"), d


def tuples(df):
    return sorted(map(tuple, df.collect()), key=str)


def run(spark, sdf, d):
    name = "h" + uuid.uuid4().hex[:8]
    q = (sdf.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", f"{d}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    return tuples(spark.table(name))


def whole_and_parts(spark, op, rows, schema, cut, **kw):
    """(one batch, batch over the history + stream over the rest)."""
    whole = tuples(op(spark.createDataFrame(rows, schema), **kw))
    past = spark.createDataFrame(rows[:cut], schema)
    rest, d = source(spark, rows[cut:], schema)
    return whole, tuples(op(past, **kw)), run(spark, op(rest, history=past, **kw), d)


@pytest.mark.parametrize("ttl", [None, "20 hours", {"history": "25 hours", "merchants": "3 hours", "amounts": "4 hours"}])
def test_anomaly_from_history(spark, ttl):
    kw = dict(seq="q", keep=("q",), threshold=0.2, state_ttl=ttl)
    whole, before, after = whole_and_parts(spark, ops.anomaly_alerts, transactions(3, 150), TX, 90,
                                           rows_per_chunk=30 if ttl else None, **kw)
    assert sorted(before + after, key=str) == whole and len(before) > 10 and len(after) > 10
    assert any("SMALL_TXN_PATTERN" in r[3] for r in after)


def test_spend_and_audit_from_history(spark):
    rows = transactions(5)
    kw = dict(threshold=3000.0, key="userId", price="amount", order_id="q", seq="q")
    for cut in (60, 200):
        whole, before, after = whole_and_parts(spark, ops.spend_threshold, rows, TX, cut, **kw)
        assert sorted(before + after, key=str) == whole and len(whole) > 1 and (after if cut == 60 else before)
    rnd = random.Random(2)
    changes = [(rnd.choice(["EUR", "USD", None]), rnd.choice([1.25, 2.5, None]), START + (i + i // 30 * 6) * HOUR,
                rnd.choice(["+I", "-U", "+U", "-D"]), i) for i in range(90)]
    schema = "currency string, rate double, update_time timestamp, op string, seq long"
    changes = [(c, r, dt.datetime.fromtimestamp(t / 1000), o, s) for c, r, t, o, s in changes]
    for ttl in (None, "4 hours"):
        whole, before, after = whole_and_parts(spark, ops.changelog_audit, changes, schema, 40, seq="seq", state_ttl=ttl)
        assert sorted(before + after, key=str) == whole and before and after


@pytest.mark.parametrize("order", ["arrival", "event"])
@pytest.mark.parametrize("mode", ["continue", "close"])
def test_sessions_from_history(spark, mode, order):
    rnd = random.Random(11)
    rows, t = [], START
    for i in range(120):
        t += rnd.choice([1000, 5000, 40_000, 200_000])
        rows.append((rnd.choice(["a", "b", "c", None]), rnd.choice(["x", "y", "LOGOUT", None]), t, i))
    rows += [("end", "x", t + 10**9, 999)]
    schema = "userId string, eventType string, ts long, q long"
    kw = dict(timeout_s=60, seq="q", on_timeout=mode)
    op = ops.sessions
    whole = tuples(op(spark.createDataFrame(rows, schema), **kw).filter("userId <> 'end' or userId is null"))
    past = spark.createDataFrame(rows[:70], schema)
    rest, d = source(spark, rows[70:], schema)
    after = run(spark, op(rest, history=past, stream_order=order, **kw)
                .filter("userId <> 'end' or userId is null"), d)
    # a batch over the history shows one more TIMEOUT for each session that is still open
    before, pending = tuples(op(past, **kw)), 0
    for r in tuples(past.groupBy("userId").agg(F.max_by("eventType", "q"))):
        pending += r[1] != "LOGOUT"
    assert len(before) - pending + len(after) == len(whole)
    missing = list(whole)
    for r in after:
        missing.remove(r)
    for r in missing:
        before.remove(r)
    assert len(before) == pending and all(r[1] == "TIMEOUT" for r in before)


def test_windows_from_history(spark):
    rows = [r for r in transactions(8) if r[0]] + [("end", 1.0, "X", "m", START * 2, 999)]
    kw = dict(size="1 hour", key="userId", price="amount", seq="q")
    whole, before, after = whole_and_parts(spark, ops.early_fire_window, rows, TX, 101, **kw)
    assert sorted(before + after, key=str) == whole
    whole, before, after = whole_and_parts(spark, ops.hybrid_window, rows, TX, 101, count_threshold=3, **kw)
    whole = [r for r in whole if r[0] != "end"]
    missing = list(whole)
    for r in after:
        missing.remove(r)
    assert not [r for r in missing if r not in before] and len(before) - len(missing) <= 2 and after


def test_first_match_from_history(spark):
    rnd = random.Random(4)
    orders = [(f"k{rnd.randrange(12)}" if i % 9 else None, f"o{i}" if i % 5 else None, float(i), START + i * 60_000, i)
              for i in range(40)]
    people = [(f"k{rnd.randrange(12)}", rnd.choice(["n", None]), "e", "gold", START + i * 60_000 + 30_000, i)
              for i in range(40)]
    so = "customerId string, orderId string, totalAmount double, ts long, q long"
    sc = "customerId string, name string, email string, tier string, ts long, q long"
    for ttl in (None, "10 minutes"):
        kw = dict(order_seq="q", customer_seq="q", state_ttl=ttl)
        whole = tuples(ops.first_match_join(spark.createDataFrame(orders, so), spark.createDataFrame(people, sc), **kw))
        past = spark.createDataFrame(orders[:20], so), spark.createDataFrame(people[:20], sc)
        o, d = source(spark, orders[20:], so, files=1)
        c, _ = source(spark, people[20:], sc, files=1)
        after = run(spark, ops.first_match_join(o, c, history=past, **kw), d)
        assert sorted(tuples(ops.first_match_join(*past, **kw)) + after, key=str) == whole and after


def test_empty_history_and_batch_history(spark):
    rows = transactions(6, 60)
    df = spark.createDataFrame(rows, TX)
    kw = dict(seq="q", keep=("q",), threshold=0.2)
    s, d = source(spark, rows, TX)
    assert run(spark, ops.anomaly_alerts(s, history=df.limit(0), **kw), d) == tuples(ops.anomaly_alerts(df, **kw))
    with pytest.raises(ValueError, match="history"):
        ops.anomaly_alerts(df, history=df, **kw)


def test_latest_changelog_after_a_row_without_a_time(spark):
    rows = [("a", None, 1), ("a", None, 2), ("a", 5, 3), ("a", 4, 4), ("a", None, 5), ("a", 6, 6)]
    schema = "k string, ts long, q long"
    s, d = source(spark, rows, schema, files=2)
    want = tuples(ops.latest_changelog(spark.createDataFrame(rows, schema), "k", time="ts", seq="q"))
    assert run(spark, ops.latest_changelog(s, "k", time="ts", seq="q"), d) == want


def test_named_stream_restarts_and_refuses_another_query(spark):
    rows = transactions(9, 180)
    d = tempfile.mkdtemp(prefix="eventide-named-")
    kw = dict(seq="q", keep=("q",), threshold=0.2)
    past = spark.createDataFrame(rows[:60], TX)

    def go(**more):
        s = spark.readStream.schema(TX).parquet(f"{d}/in/*")
        w = named_stream(ops.anomaly_alerts, s, uid="alerts", root=f"{d}/ck", **{**kw, **more})
        w.format("parquet").option("path", f"{d}/out").trigger(availableNow=True).start().awaitTermination()

    for i, (lo, hi) in enumerate([(60, 120), (120, 180)]):      # the second start goes on with the first's state
        spark.createDataFrame(rows[lo:hi], TX).coalesce(1).write.parquet(f"{d}/in/p{i}")
        go(history=past, state_ttl=None)
    want = tuples(ops.anomaly_alerts(spark.createDataFrame(rows, TX), **kw))
    got = tuples(spark.read.parquet(f"{d}/out")) + tuples(ops.anomaly_alerts(past, **kw))
    assert sorted(got, key=str) == want
    with pytest.raises(ValueError, match="threshold: 0.2 -> 0.3"):
        go(history=past, threshold=0.3)
    s = spark.readStream.schema(TX).parquet(f"{d}/in/*")
    with pytest.raises(ValueError, match="belongs to"):
        named_stream(ops.spend_threshold, s, 5.0, uid="alerts", root=f"{d}/ck", key="userId", price="amount",
                     order_id="q", seq="q")
    with pytest.raises(ValueError, match="uid"):
        named_stream(ops.anomaly_alerts, s, uid="../x", root=f"{d}/ck", **kw)


def test_signature_knows_defaults_and_columns(spark):
    df = spark.createDataFrame(transactions(1, 3), TX)
    plain = signature(ops.anomaly_alerts, df, seq="q")
    assert plain == signature(ops.anomaly_alerts, df, seq="q", user="userId", rows_per_chunk=5, history=df)
    assert plain != signature(ops.anomaly_alerts, df.withColumn("amount", F.lit(1)), seq="q")
    with pytest.raises(ValueError, match="lasting"):
        signature(ops.anomaly_alerts, df, seq=F.col("q"))
