"""Small examples with rows of our own, results worked out by hand."""

import datetime as dt
import json
import os
import tempfile
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from eventide import operators as ops
from eventide.sources.cdc_json import read_cdc


def _write_json(rows):
    d = tempfile.mkdtemp(prefix="eventide-golden-")
    p = os.path.join(d, "part-0.json")
    with open(p, "w") as f:
        for r in rows:
            f.write(json.dumps(r) + "\n")
    return d


TXN = "77:4100"


def _change(op, before, after, place, within, at, table):
    source = {"version": "0", "connector": "test", "name": "bakery", "ts_ms": at - 5, "db": "bakery", "schema": "sales",
              "table": table, "txId": 77, "lsn": 4100 + place, "xmin": None}
    return {"op": op, "before": before, "after": after, "source": source, "ts_ms": at,
            "transaction": {"id": TXN, "total_order": place, "data_collection_order": within}}


def _cdc_fixture():
    """One order opened, packed and paid; three lines, one of them corrected
    (an update appends a line too) and one taken back (no image after it)."""
    def order(status, total):
        return {"id": 31, "customer_id": 8, "status": status, "total_amount": total}

    def line(i, product, quantity, price):
        return {"id": i, "order_id": 31, "product_id": product, "quantity": quantity, "unit_price": price}

    opened, packed, paid = order("opened", 0.0), order("packed", 74.25), order("paid", 70.5)
    orders = [_change("c", None, opened, 1, 1, 60_000, "orders"), _change("u", opened, packed, 5, 2, 60_400, "orders"),
              _change("u", packed, paid, 8, 3, 60_900, "orders")]
    items = [_change("c", None, line(1, 12, 3, 9.5), 2, 1, 60_100, "items"),
             _change("c", None, line(2, 15, 1, 27.75), 3, 2, 60_200, "items"),
             _change("c", None, line(3, 19, 6, 3.0), 4, 3, 60_300, "items"),
             _change("u", line(1, 12, 3, 9.5), line(1, 12, 2, 9.5), 6, 4, 60_500, "items"),
             _change("d", line(3, 19, 6, 3.0), None, 7, 5, 60_600, "items")]
    bounds = [{"status": "BEGIN", "id": TXN, "ts_ms": 59_990, "event_count": None, "data_collections": None},
              {"status": "END", "id": TXN, "ts_ms": 60_950, "event_count": 8,
               "data_collections": [{"data_collection": "sales.orders", "event_count": 3},
                                    {"data_collection": "sales.items", "event_count": 5}]}]
    return orders, items, bounds


def test_cdc_transaction_assembly(spark):
    orders, items, txn = _cdc_fixture()
    o = read_cdc(spark, _write_json(list(reversed(orders))), "orders_cdc")
    i = read_cdc(spark, _write_json(list(reversed(items))), "order_items_cdc")
    t = read_cdc(spark, _write_json(txn), "transaction_events")
    rows = ops.cdc_transactions(o, i, t).collect()
    assert [tuple(r)[:5] for r in rows] == [(TXN, 31, 8, "paid", 70.5)]
    lines = [(12, 3, 9.5), (15, 1, 27.75), (19, 6, 3.0), (12, 2, 9.5)]
    assert [tuple(x) for x in rows[0].line_items] == lines
    flat = ops.cdc_transactions(o, i, t, items="rows").orderBy("line_no").collect()
    assert [(x.product_id, x.quantity, x.unit_price) for x in flat] == lines


@pytest.mark.parametrize("count", [7, 9, None])
def test_cdc_transaction_incomplete(spark, count):
    orders, items, txn = _cdc_fixture()
    txn = [txn[0]] + ([dict(txn[1], event_count=count)] if count else [])
    o = read_cdc(spark, _write_json(orders), "orders_cdc")
    i = read_cdc(spark, _write_json(items), "order_items_cdc")
    t = read_cdc(spark, _write_json(txn), "transaction_events")
    assert ops.cdc_transactions(o, i, t).count() == 0


def _kv(eid, name, seq, new=None, old=None, pk="shelf-3"):
    def img(d):
        if d is None:
            return None
        m = {"pk": {"S": pk}, "sk": {"S": "stock"}}
        m.update({k: ({"N": v} if k == "count" else {"S": v}) for k, v in d.items()})
        return m
    return {"eventID": eid, "eventName": name,
            "dynamodb": {"Keys": {"pk": {"S": pk}, "sk": {"S": "stock"}},
                         "NewImage": img(new), "OldImage": img(old), "SequenceNumber": seq,
                         "SizeBytes": 64, "StreamViewType": "NEW_AND_OLD_IMAGES"}}


def test_kv_changelog(spark):
    rye, more, rolls = {"bread": "rye", "count": "4"}, {"bread": "rye", "count": "9"}, {"bread": "rolls", "note": "warm"}
    rows = [_kv("a", "INSERT", "20", new=rolls, pk="shelf-8"), _kv("b", "INSERT", "21", new=rye),
            _kv("c", "REMOVE", "22", old=rolls, pk="shelf-8"), _kv("d", "MODIFY", "23", new=more, old=rye),
            _kv("e", "TTL_EXPIRED", "24"), _kv("f", "INSERT", "25", new=rolls, pk="shelf-8")]
    df = read_cdc(spark, _write_json(rows), "kv_changes")
    out = ops.cdc_changelog(df).orderBy("sequence_number", "change_seq").collect()
    assert [(r.op, r.pk, r.sk, r.attributes_json) for r in out] == [
        ("+I", "shelf-8", "stock", '{"bread":"rolls","note":"warm"}'),
        ("+I", "shelf-3", "stock", '{"bread":"rye","count":"4"}'),
        ("-D", "shelf-8", "stock", '{"bread":"rolls","note":"warm"}'),
        ("-U", "shelf-3", "stock", '{"bread":"rye","count":"4"}'),
        ("+U", "shelf-3", "stock", '{"bread":"rye","count":"9"}'),
        ("+I", "shelf-8", "stock", '{"bread":"rolls","note":"warm"}')]
    ups = ops.cdc_changelog(df, mode="upsert").select("op").collect()
    assert "-U" not in [r.op for r in ups]


def test_kv_changelog_json_modes(spark):
    rows = [_kv("1", "INSERT", "1", new={"name": 'say "hi"\\'}),
            _kv("2", "REMOVE", "2")]
    df = read_cdc(spark, _write_json(rows), "kv_changes")
    ref = {r.op: r.attributes_json for r in ops.cdc_changelog(df).collect()}
    assert ref["+I"] == '{"name":"say \\"hi\\"\\"}'
    assert ref["-D"] == "{}"  # no old image: the keys only, pk/sk skipped
    strict = ops.cdc_changelog(df, json="strict").filter("op = '+I'").first()
    assert json.loads(strict.attributes_json) == {"name": 'say "hi"\\'}


def test_early_fire_running_totals(spark):
    base = dt.datetime(2025, 1, 1, 0, 0, 0)
    rows = [(1, "c", base + dt.timedelta(seconds=s), p, i)
            for i, (s, p) in enumerate([(1, 10.0), (2, 15.0), (3, 15.0), (6, 15.0)])]
    df = spark.createDataFrame(rows, "k int, customer_id string, ts timestamp, price double, seq int")
    out = ops.early_fire_window(df, 5000, key="customer_id", seq="seq", keep=("seq",)) \
        .orderBy("seq").collect()
    assert [(r.num_orders, r.total_price) for r in out] == \
        [(1, 10.0), (2, 25.0), (3, 40.0), (1, 15.0)]
    assert out[0].window_start == dt.datetime(2025, 1, 1, 0, 0, 0)
    assert out[3].window_end == dt.datetime(2025, 1, 1, 0, 0, 10)


def test_early_fire_late_row_restarts(spark):
    base = dt.datetime(2025, 1, 1)
    secs = [1, 6, 2, 7]  # arrival order; the row at :02 is late
    rows = [(str(i), base + dt.timedelta(seconds=s), 1.0, i) for i, s in enumerate(secs)]
    df = spark.createDataFrame(rows, "id string, ts timestamp, price double, seq int") \
        .withColumn("customer_id", F.lit("c"))
    out = ops.early_fire_window(df, 5000, key="customer_id", seq="seq", order_by="arrival",
                                keep=("seq",)).orderBy("seq").collect()
    assert [r.num_orders for r in out] == [1, 1, 1, 1]


def test_hybrid_window_count_and_time(spark):
    base = dt.datetime(2025, 1, 1)
    rows = [("c", base + dt.timedelta(seconds=s), p, i)
            for i, (s, p) in enumerate([(1, 1.0), (2, 2.0), (3, None), (4, 4.0), (12, 5.0)])]
    df = spark.createDataFrame(rows, "customer_id string, ts timestamp, price double, seq int")
    out = ops.hybrid_window(df, "10 seconds", 3, key="customer_id", seq="seq") \
        .orderBy("window_start", F.desc("num_orders")).collect()
    assert [(r.num_orders, r.total_price) for r in out] == [(3, 3.0), (1, 4.0), (1, 5.0)]


def test_changelog_audit_example(spark):
    t0 = dt.datetime(2025, 3, 27, 9, 0)
    m = dt.timedelta(minutes=15)
    rows = [("+I", "EUR", "1.0850", t0), ("+I", "USD", "1.0000", t0),
            ("-U", "EUR", "1.0850", t0 + m), ("+U", "EUR", "1.0920", t0 + m),
            ("+I", "GBP", "0.8650", t0 + 2 * m),
            ("-U", "EUR", "1.0920", t0 + 3 * m), ("+U", "EUR", "1.0875", t0 + 3 * m),
            ("-D", "GBP", "0.8650", t0 + 4 * m)]
    df = spark.createDataFrame([(o, c, Decimal(r), t, i) for i, (o, c, r, t) in enumerate(rows)],
                               "op string, currency string, rate decimal(10,4), "
                               "update_time timestamp_ntz, seq int")
    out = ops.changelog_audit(df, seq="seq").orderBy("change_time", "currency").collect()
    got = [(r.change_type, r.currency, r.old_rate, r.new_rate) for r in out]
    D = Decimal
    assert sorted(got, key=str) == sorted([
        ("INSERT", "EUR", None, D("1.0850")), ("INSERT", "USD", None, D("1.0000")),
        ("UPDATE", "EUR", D("1.0850"), D("1.0920")), ("INSERT", "GBP", None, D("0.8650")),
        ("UPDATE", "EUR", D("1.0920"), D("1.0875")), ("DELETE", "GBP", D("0.8650"), None)],
        key=str)


def test_quality_example(spark):
    df = spark.createDataFrame(
        [("Alice", 50.0, "US", "Acme"), ("Bob", -10.0, "X", None),
         ("Carol", 500.0, "UK", "Shop"), ("Dan", 5.0, "DE", "\t \n"),
         ("Eve", float("nan"), "FR", "Mart")],
        "userId string, amount double, country string, merchant string")
    out = {r.userId: r for r in ops.quality_score(df).collect()}
    assert (out["Alice"].quality_score, out["Alice"].quality_issues, out["Alice"].is_valid) == \
        (100.0, "", True)
    assert (out["Bob"].quality_score, out["Bob"].quality_issues, out["Bob"].is_valid) == \
        (30.0, "INVALID_AMOUNT,INVALID_COUNTRY,INVALID_MERCHANT", False)
    assert out["Carol"].quality_score == 100.0
    assert out["Dan"].quality_issues == "INVALID_MERCHANT"
    assert (out["Eve"].quality_score, out["Eve"].is_valid) == (80.0, True)
    with pytest.raises(ValueError):
        ops.quality_score(df.withColumn("is_valid", F.lit(1)))


def test_row_formatter_example(spark):
    df = spark.createDataFrame([(1, "Alice", 30, 0), (1, None, 31, 1), (1, "B" * 60, 32, 2)],
                               "id int, name string, age int, seq int")
    out = ops.row_formatter(df.drop("seq").withColumn("seq", F.col("age")), ["id"],
                            order="seq").orderBy("distinct_patterns", "formatted_row").collect()
    first = [r for r in out if "Alice" in r.formatted_row][0]
    assert first.formatted_row == "[id=1] => {name=Alice, age=30, seq=30}"
    assert first.schema_info == "id:Integer, name:String, age:Integer, seq:Integer"
    nul = [r for r in out if "name=null" in r.formatted_row][0]
    assert nul.schema_info.startswith("id:Integer, name:NULL")
    assert nul.distinct_patterns == 2
    long = [r for r in out if "BBB" in r.formatted_row][0]
    assert "name=" + "B" * 47 + "..." in long.formatted_row
    assert long.distinct_patterns == 2
    sql = ops.row_formatter(df, ["id"], order="seq", type_names="sql").first()
    assert sql.schema_info == "id:INT, name:STRING, age:INT, seq:INT"


def test_row_formatter_java_time_text(spark):
    df = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1, 0, 0, 0)), (2, dt.datetime(2024, 1, 1, 0, 0, 7, 179000)),
         (3, dt.datetime(2024, 1, 1, 0, 0, 7, 179575)), (4, dt.datetime(2024, 1, 1, 0, 5))],
        "id int, ts timestamp_ntz")
    got = {r.formatted_row for r in ops.row_formatter(df, ["id"], order="id").collect()}
    assert got == {"[id=1] => {ts=2024-01-01T00:00}", "[id=2] => {ts=2024-01-01T00:00:07.179}",
                   "[id=3] => {ts=2024-01-01T00:00:07.179575}", "[id=4] => {ts=2024-01-01T00:05}"}


def test_spend_threshold_first_crossing_only(spark):
    rows = [("c1", 60.0, "o1", 1), ("c1", 50.0, "o2", 2), ("c1", -30.0, "o3", 3),
            ("c1", 40.0, "o4", 4), ("c2", 10.0, "o5", 1), ("c2", None, "o6", 2)]
    df = spark.createDataFrame(rows, "customer_id string, price double, order_id string, seq int")
    out = ops.spend_threshold(df, 100.0, time=None, seq="seq").collect()
    assert [(r.customer_id, r.total_spend, r.crossing_order_id, r.order_count) for r in out] == \
        [("c1", 110.0, "o2", 2)]


def test_sessions_modes(spark):
    h = 3600
    base = dt.datetime(2025, 1, 1)
    evs = [(0, "LOGIN"), (600, "CLICK"), (1200, "LOGOUT"), (5000, "VIEW"),
           (5000 + 2 * h, "CLICK"), (5000 + 5 * h, "CLICK")]
    df = spark.createDataFrame([("u", base + dt.timedelta(seconds=s), t, i)
                                for i, (s, t) in enumerate(evs)],
                               "userId string, ts timestamp, eventType string, seq int")
    cont = ops.sessions(df, h, seq="seq").orderBy("sessionDuration").collect()
    assert [(r.status, r.sessionDuration, r.eventCount, r.firstEventType, r.lastEventType)
            for r in cont] == [
        ("COMPLETED", 1_200_000, 3, "LOGIN", "LOGOUT"),
        ("TIMEOUT", 3_600_000, 1, "VIEW", "VIEW"),
        ("TIMEOUT", 3 * 3_600_000, 2, "VIEW", "CLICK"),
        ("TIMEOUT", 6 * 3_600_000, 3, "VIEW", "CLICK")]
    close = ops.sessions(df, h, seq="seq", on_timeout="close").collect()
    assert sorted((r.status, r.eventCount) for r in close) == \
        [("COMPLETED", 3), ("TIMEOUT", 1), ("TIMEOUT", 1), ("TIMEOUT", 1)]


def test_first_match_null_asymmetry(spark):
    base = dt.datetime(2025, 1, 1)
    orders = spark.createDataFrame([(7, "o1", 5.0, base, 1),
                                    (7, "o2", 6.0, base + dt.timedelta(seconds=9), 4)],
                                   "customerId int, orderId string, totalAmount double, "
                                   "ts timestamp, seq int")
    cust = spark.createDataFrame([(7, None, "e@x", "gold", base + dt.timedelta(seconds=5), 2),
                                  (8, "Zed", "z@x", "std", base, 3)],
                                 "customerId int, name string, email string, tier string, "
                                 "ts timestamp, seq int")
    out = ops.first_match_join(orders, cust, order_seq="seq", customer_seq="seq").collect()
    assert len(out) == 1
    r = out[0]
    # the customer row triggers (stored order id is set) although its name is null
    assert (r.orderId, r.customerId, r.customerName, r.customerTier, r.firstArrival) == \
        ("o1", 7, None, "gold", "ORDER")
    assert r.joinTimestamp == int((base + dt.timedelta(seconds=5)).replace(
        tzinfo=dt.timezone.utc).timestamp() * 1000)


def test_latest_changelog_ties_and_late_rows(spark):
    d = dt.datetime
    rows = [(1, "k", d(2025, 1, 2), 10.0), (2, "k", d(2025, 1, 1), 11.0),
            (3, "k", d(2025, 1, 2), 12.0), (4, "k", d(2025, 1, 3), 13.0)]
    df = spark.createDataFrame(rows, "seq int, key string, t timestamp, v double")
    out = ops.latest_changelog(df, "key", time="t", seq="seq") \
        .orderBy("seq", "change_seq").collect()
    got = [(r.op, r.seq) for r in out]
    assert sorted(got) == sorted([("+I", 1), ("-U", 1), ("+U", 3), ("-U", 3), ("+U", 4)])
    latest = ops.latest_by_key(df, "key", time="t", seq="seq").collect()
    assert [r.seq for r in latest] == [4]


def test_state_ttl_first_match_and_audit(spark):
    base = dt.datetime(2025, 1, 1)
    h = dt.timedelta(hours=1)
    orders = spark.createDataFrame([(1, "o1", 5.0, base, 1), (1, "o2", 6.0, base + 3 * h, 3)],
                                   "customerId int, orderId string, totalAmount double, "
                                   "ts timestamp, seq int")
    cust = spark.createDataFrame([(1, "Ann", "a@x", "gold", base + 2 * h, 2)],
                                 "customerId int, name string, email string, tier string, "
                                 "ts timestamp, seq int")
    kw = dict(order_seq="seq", customer_seq="seq")
    plain = ops.first_match_join(orders, cust, **kw).collect()
    assert [(r.orderId, r.firstArrival) for r in plain] == [("o1", "ORDER")]
    ttl = ops.first_match_join(orders, cust, state_ttl="1 hour", **kw).collect()
    # o1 expired before Ann arrived; o2 comes within the hour after Ann
    assert [(r.orderId, r.firstArrival) for r in ttl] == [("o2", "CUSTOMER")]
    d = dt.timedelta(days=1)
    ch = spark.createDataFrame([("+I", "EUR", Decimal("1.1"), base, 1),
                                ("+U", "EUR", Decimal("1.2"), base + 8 * d, 2),
                                ("+U", "EUR", Decimal("1.3"), base + 9 * d, 3)],
                               "op string, currency string, rate decimal(10,4), "
                               "update_time timestamp, seq int")
    out = ops.changelog_audit(ch, seq="seq", state_ttl="7 days").orderBy("change_time").collect()
    assert [r.old_rate for r in out] == [None, None, Decimal("1.2000")]


def test_state_ttl_transactions_and_pricing(spark):
    orders, items, txn = _cdc_fixture()
    late = [dict(items[-1], ts_ms=items[-1]["ts_ms"] + 2 * 3600_000)]  # 2 h later
    o = read_cdc(spark, _write_json(orders), "orders_cdc")
    i = read_cdc(spark, _write_json(items[:-1] + late), "order_items_cdc")
    t = read_cdc(spark, _write_json(txn), "transaction_events")
    assert ops.cdc_transactions(o, i, t).count() == 1
    assert ops.cdc_transactions(o, i, t, state_ttl="1 hour").count() == 0
    base = dt.datetime(2025, 1, 1)
    d = dt.timedelta(days=1)
    inv = spark.createDataFrame([("s", 5, 100.0, base, 1), ("s", 50, 10.0, base + 9 * d, 2)],
                                "sku string, quantity int, basePrice double, ts timestamp, seq int")
    plain = ops.dynamic_pricing(inv, None, inventory_seq="seq").collect()
    ttl = ops.dynamic_pricing(inv, None, inventory_seq="seq", state_ttl="7 days").collect()
    # low stock raises 100 -> 115; after 9 silent days the TTL form restarts at 10
    assert [r.newPrice for r in plain] == [pytest.approx(115.0)]
    assert [r.newPrice for r in ttl] == [pytest.approx(115.0)]
    inv2 = inv.union(spark.createDataFrame([("s", 5, 10.0, base + 9 * d, 3)], inv.schema))
    assert [round(r.oldPrice, 2) for r in ops.dynamic_pricing(
        inv2, None, inventory_seq="seq", state_ttl="7 days").collect()] == [100.0, 10.0]


def test_quality_readme_rules_variant(spark):
    df = spark.createDataFrame([("Alice", 0.0, "US", "Acme"), ("Bob1", 50000.0, "XX", "Shop")],
                               "userId string, amount double, country string, merchant string")
    code = {r.userId: r for r in ops.quality_score(df).collect()}
    assert code["Alice"].quality_issues == "" and code["Bob1"].quality_issues == "INVALID_AMOUNT"
    readme = {r.userId: r for r in ops.quality_score(df, rules="readme",
                                                     country_codes=["US", "DE"]).collect()}
    assert readme["Alice"].quality_issues == "INVALID_AMOUNT"  # 0 is not > 0
    assert readme["Bob1"].quality_issues == "INVALID_COUNTRY"  # 50 000 < 1 000 000 is fine
