"""Transactions at the edges: rows without an id, an END without a time,
repeated attempts of one id, and what a stream keeps."""

import tempfile

from eventide import operators as ops

ORDERS = ("after struct<id:long,customer_id:long,status:string,total_amount:double>, ts_ms long, "
          "transaction struct<id:string,total_order:long>")
ITEMS = ("after struct<product_id:long,quantity:int,unit_price:double>, ts_ms long, "
         "transaction struct<id:string,total_order:long>")
EVENTS = "status string, id string, ts_ms long, event_count long"


def order(txn, ts, n=1):
    return ((1, 2, "new", 9.5), ts, (txn, n))


def item(txn, ts, product, n=2):
    return ((product, 1, 2.5), ts, (txn, n))


def frames(spark, orders, items, events):
    return (spark.createDataFrame(orders, ORDERS), spark.createDataFrame(items, ITEMS),
            spark.createDataFrame(events, EVENTS))


def test_rows_without_an_id_complete_nothing(spark):
    got = ops.cdc_transactions(*frames(
        spark, [order("a", 1), ((5, 5, "snap", 1.0), 1, None)], [item("a", 2, 7), item(None, 2, 8)],
        [("END", "a", 3, 2), ("END", None, 3, 2)])).collect()
    assert [(r.transaction_id, len(r.line_items)) for r in got] == [("a", 1)]


def test_end_without_a_time_completes(spark):
    for kw in ({}, {"items": "rows"}, {"state_ttl": "1 hour"}):
        got = ops.cdc_transactions(*frames(spark, [order("a", 1)], [item("a", 2, 7)], [("END", "a", None, 2)]), **kw)
        assert got.count() == 1, kw


def test_items_of_other_attempts_stay_apart(spark):
    day = 86_400_000
    fs = frames(spark, [order("a", 1), order("a", day)], [item("a", 2, 7), item("a", day + 1, 8)],
                [("END", "a", 3, 2), ("END", "a", day + 2, 2)])
    rows = ops.cdc_transactions(*fs, items="rows", state_ttl="1 hour").collect()
    assert sorted(r.product_id for r in rows) == [7, 8]
    arrays = ops.cdc_transactions(*fs, state_ttl="1 hour").collect()
    assert sorted([x.product_id for x in r.line_items] for r in arrays) == [[7], [8]]


def test_a_stream_keeps_nothing_of_an_emitted_transaction(spark):
    d = tempfile.mkdtemp(prefix="eventide-cdc-")
    fs = frames(spark, [order("a", 1), order("b", 1)], [item("a", 2, 7), item("b", 2, 8)], [("END", "a", 3, 2)])
    streams = []
    for name, df in zip("oit", fs):
        df.write.parquet(f"{d}/{name}")
        streams.append(spark.readStream.schema(df.schema).parquet(f"{d}/{name}"))
    q = (ops.cdc_transactions(*streams).writeStream.format("parquet").option("path", f"{d}/out")
         .option("checkpointLocation", f"{d}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    assert [r.transaction_id for r in spark.read.parquet(f"{d}/out").collect()] == ["a"]
    state = spark.read.format("statestore").option("stateVarName", "txn").load(f"{d}/ck")
    assert [r.key[0] for r in state.collect()] == ["b"]
