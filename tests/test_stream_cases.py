"""Streams at the edges: tie-break columns of any type, arrival order, rows
without a time, null first types, and the cost of pending rows."""

import random
import tempfile
import uuid

import pytest

from eventide import operators as ops
from eventide.streaming.processors import CLEAN, _Processor

EVENTS = "userId string, eventType string, price double, ts long, q string"


def stream(spark, rows, schema, files=3):
    d = tempfile.mkdtemp(prefix="eventide-case-")
    step = -(-len(rows) // files)
    for i in range(files):
        spark.createDataFrame(rows[i * step:(i + 1) * step], schema).coalesce(1).write.parquet(f"{d}/in/p{i}")
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/in/*"), d


def run(spark, sdf, d):
    name = "c" + uuid.uuid4().hex[:8]
    q = (sdf.writeStream.format("memory").queryName(name).outputMode("append")
         .option("checkpointLocation", f"{d}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    return sorted(map(tuple, spark.table(name).collect()), key=str)


def batch(df):
    return sorted(map(tuple, df.collect()), key=str)


def rows(n=60):
    return [("u", ["a", "b", None][i % 3], float(i % 5) + 0.1, 1_000_000 + i * 7000, f"id{i:03}") for i in range(n)]


def test_string_tie_break_and_rows_without_a_time(spark):
    data = rows() + [("u", "a", 1.0, None, "id999")]
    df = spark.createDataFrame(data, EVENTS)
    s, d = stream(spark, data, EVENTS)
    kw = dict(key="userId", price="price", seq="q", keep=("q",))
    got = run(spark, ops.early_fire_window(s, "1 minute", **kw), d)
    assert got == batch(ops.early_fire_window(df, "1 minute", **kw)) and len(got) == 60


def test_arrival_order_restarts_on_late_rows(spark):
    data = [("u", "a", 1.0, t * 60_000, f"id{i:03}") for i, t in enumerate([1, 1, 2, 1, 2, 2, 1, 1, 3, 3])]
    df = spark.createDataFrame(data, EVENTS)
    kw = dict(key="userId", price="price", seq="q", order_by="arrival", keep=("q",))
    want = batch(ops.early_fire_window(df, "1 minute", **kw))
    assert [r[3] for r in sorted(want, key=lambda r: r[5])] == [1, 2, 1, 1, 1, 2, 1, 2, 1, 2]
    s, d = stream(spark, data, EVENTS, files=1)
    assert run(spark, ops.early_fire_window(s, "1 minute", watermark=None, **kw), d) == want
    with pytest.raises(ValueError):
        ops.early_fire_window(s, "1 minute", stream_order="event", **kw)


def test_a_null_first_type_leaves_the_session_unopened(spark):
    data = [("u", None, 0.0, 1000, "1"), ("u", "a", 0.0, 2000, "2"), ("u", "LOGOUT", 0.0, 4000, "3"),
            ("v", None, 0.0, 1000, "1"), ("v", None, 0.0, 2000, "2"), ("v", "b", 0.0, 5000, "3"),
            ("v", "LOGOUT", 0.0, 9000, "4")]
    want = [("u", "COMPLETED", 2000, 2, "a", "LOGOUT"), ("v", "COMPLETED", 4000, 2, "b", "LOGOUT")]
    df = spark.createDataFrame(data, EVENTS)
    for chunk in (0, 1):
        assert batch(ops.sessions(df, "30 minutes", seq="q", rows_per_chunk=chunk)) == want
    s, d = stream(spark, data, EVENTS, files=1)
    assert run(spark, ops.sessions(s, "30 minutes", seq="q"), d) == want


class _Handle:
    """A state store in memory that counts the rows read from maps."""

    def __init__(self):
        self.reads, self.timers = 0, set()

    def getMapState(self, name, key_schema, value_schema):
        return _Map(self)

    def getValueState(self, name, schema):
        return _Value()

    def registerTimer(self, t):
        self.timers.add(t)

    def deleteTimer(self, t):
        self.timers.discard(t)


class _Map:
    def __init__(self, handle):
        self.h, self.data = handle, {}

    def containsKey(self, k):
        return k in self.data

    def getValue(self, k):
        v = self.data[k]
        if isinstance(v[0], list):
            self.h.reads += len(v[0])
        return v

    def updateValue(self, k, v):
        self.data[k] = v

    def removeKey(self, k):
        self.data.pop(k, None)

    def keys(self):
        return iter(self.data)

    def clear(self):
        self.data = {}


class _Value:
    value = None

    def exists(self):
        return self.value is not None

    def get(self):
        return self.value

    def update(self, v):
        self.value = v

    def clear(self):
        self.value = None


class _At:
    def __init__(self, t):
        self.t = t

    def getExpiryTimeInMs(self):
        return self.t

    getCurrentWatermarkInMs = getExpiryTimeInMs


def fire(p, h, watermark):
    """Expired timers in order of time, each gone after its firing, as Spark does it."""
    out = []
    while due := [t for t in sorted(h.timers) if t <= watermark]:
        for t in due:
            if t in h.timers:
                out += list(p.handleExpiredTimer(("k",), _At(watermark), _At(t)))
                h.timers.discard(t)
    return out


class _Echo(_Processor):
    buffer_fields, buffer_schema = ["_t", "_q"], "_t long, _q long"

    def fold(self, key, rows):
        return iter([r["_t"] for r in sorted(rows, key=lambda r: r["_t"])])


def test_a_firing_reads_the_rows_that_are_due():
    """100,000 pending rows: the cost of each watermark is that of its rows."""
    p, h = _Echo(), _Handle()
    p.init(h)
    n = 100_000
    times = [(i * 7919) % n for i in range(n)]
    list(p.handleInputRows(("k",), [{"_t": t, "_q": t} for t in times], None))
    assert h.reads == 0 and len(h.timers) == n // 1000
    out, last = [], 0
    for watermark in (4999, 9999, 10499, 30000, n):
        before = h.reads
        out += fire(p, h, watermark)
        assert h.reads - before <= watermark - last + 1000
        last = watermark
    assert out == sorted(times) and not h.timers


def test_timers_of_several_purposes_share_a_time():
    """The timer stays until the last purpose is gone."""
    p, h = _Echo(), _Handle()
    p.cleanup_ms = 5000
    p.init(h)
    list(p.handleInputRows(("k",), [{"_t": 5000, "_q": 1}, {"_t": 0, "_q": 0}], None))
    assert h.timers == {0, 5000, 10000}
    p._arm(CLEAN, 5000)
    p._disarm(CLEAN, 5000)
    assert 5000 in h.timers
    assert fire(p, h, 4000) == [0] and fire(p, h, 9000) == [5000]
    assert h.timers == {10000}
    assert fire(p, h, 20000) == [] and not h.timers


def sentinel(data):
    """A row of another key far ahead moves the watermark past all others; two
    make Spark fire what the first firings set."""
    far = max(r[3] for r in data) + 10 ** 8
    return data + [("~", "LOGOUT", 0.0, far, "~1"), ("~", "LOGOUT", 0.0, far + 10 ** 8, "~2")]


def event_run(spark, data, make, files=None, **kw):
    s, d = stream(spark, data, EVENTS, files or len(data))
    return [r for r in run(spark, make(s, stream_order="event", seq="q", **kw), d) if r[0] != "~"]


def test_window_end_and_pending_row_at_one_time(spark):
    data = sentinel([("u", "a", 1.0, t * 1000, f"{i:03}") for i, t in enumerate([1, 4, 5, 20, 40, 60, 80])])
    make = lambda d, **kw: ops.hybrid_window(d, "5 seconds", 2, key="userId", **kw)
    want = [r for r in batch(make(spark.createDataFrame(data, EVENTS), seq="q")) if r[0] != "~"]
    assert len(want) == 6 and event_run(spark, data, make) == want


def test_session_end_and_pending_row_at_one_time(spark):
    types = {40: "LOGOUT"}
    data = sentinel([("u", types.get(t, "a"), 0.0, (1000 + t) * 1000, f"{i:03}")
                     for i, t in enumerate([0, 40, 100, 300, 600, 900, 1200])])
    for mode in ("continue", "close"):
        make = lambda d, **kw: ops.sessions(d, 100, on_timeout=mode, **kw)            # noqa: E731
        want = [r for r in batch(make(spark.createDataFrame(data, EVENTS), seq="q")) if r[0] != "~"]
        assert len(want) == 6 and event_run(spark, data, make) == want


@pytest.mark.parametrize("seed", [1, 2])
def test_random_whole_seconds(spark, seed):
    """Aligned times, rows out of order within the watermark delay: windows,
    sessions and state expiry give the batch result."""
    rnd = random.Random(seed)
    data = sorted([("uvw"[rnd.randrange(3)], rnd.choice(["a", "b", None, "LOGOUT"]), float(rnd.randrange(9)),
                   1_000_000 + 1000 * rnd.randrange(0, 120, 5), f"{i:03}") for i in range(40)], key=str)
    data = sentinel(sorted(data, key=lambda r: r[3] + rnd.randrange(-9000, 9000)))
    df = spark.createDataFrame(data, EVENTS)
    for make in (lambda d, **kw: ops.hybrid_window(d, "10 seconds", 3, key="userId", **kw),
                 lambda d, **kw: ops.sessions(d, 10, **kw),
                 lambda d, **kw: ops.sessions(d, 5, on_timeout="close", state_ttl="15 seconds", **kw)):
        want = [r for r in batch(make(df, seq="q")) if r[0] != "~"]
        assert event_run(spark, data, make, files=5, watermark="20 seconds") == want


def two_streams(spark, a, a_schema, b, b_schema):
    """Both inputs one row a file."""
    (sa, da), (sb, _) = stream(spark, a, a_schema, len(a)), stream(spark, b, b_schema, len(b))
    return sa, sb, da


ORDERS, CUSTOMERS = "orderId string, customerId int, totalAmount double, ts long", \
    "customerId int, name string, email string, tier string, ts long"
STOCK, RIVALS = "sku string, quantity int, basePrice double, ts long, q string", \
    "sku string, price double, ts long, q string"
HOUR = 3_600_000


@pytest.mark.parametrize("ttl", [None, "2 hours"])
def test_a_lagging_input_loses_nothing(spark, ttl):
    """Customers (competitor prices) come an hour of event time behind."""
    far = 10 ** 9
    orders = [(f"o{i}", i % 4, 10.0 + i, HOUR + i * HOUR // 4) for i in range(8)] + \
        [("~", 99, 0.0, far), ("~~", 99, 0.0, 2 * far)]
    people = [(i % 4, f"n{i}", "e", "t", i * HOUR // 4 + 500) for i in range(8)] + \
        [(98, None, "e", "t", far), (98, None, "e", "t", 2 * far)]
    want = batch(ops.first_match_join(spark.createDataFrame(orders, ORDERS), spark.createDataFrame(people, CUSTOMERS),
                                      order_seq="orderId", customer_seq="name", state_ttl=ttl))
    assert len(want) == 4
    for mark in ("1 second", ("1 second", "2 seconds")):
        a, b, d = two_streams(spark, orders, ORDERS, people, CUSTOMERS)
        got = run(spark, ops.first_match_join(a, b, order_seq="orderId", customer_seq="name", state_ttl=ttl,
                                              stream_order="event", watermark=mark), d)
        assert got == want
    stock = [("s%d" % (i % 2), 5 + i, 100.0, HOUR + i * HOUR // 4, f"i{i}") for i in range(8)] + \
        [("~", 50, 1.0, far, "i~"), ("~", 50, 1.0, 2 * far, "i~~")]
    rivals = [("s%d" % (i % 2), 60.0 + 9 * i, i * HOUR // 4, f"c{i}") for i in range(8)] + \
        [("~", 1.0, far, "c~"), ("~", 1.0, 2 * far, "c~~")]
    kw = dict(inventory_seq="q", competitor_seq="q", state_ttl=ttl)
    want = [r for r in batch(ops.dynamic_pricing(spark.createDataFrame(stock, STOCK),
                                                 spark.createDataFrame(rivals, RIVALS), **kw)) if r[0] != "~"]
    a, b, d = two_streams(spark, stock, STOCK, rivals, RIVALS)
    got = [r for r in run(spark, ops.dynamic_pricing(a, b, stream_order="event", **kw), d) if r[0] != "~"]
    assert got == want and len(want) > 4


def test_composite_keys_in_batch_and_stream(spark):
    data = [(r[0] + str(i % 2), "x" if i % 3 else "y", *r[2:]) for i, r in enumerate(rows())]
    df = spark.createDataFrame(data, EVENTS)
    kw = dict(key=["userId", "eventType"], price="price", seq="q")
    for run_on in (lambda d: ops.early_fire_window(d, "1 minute", keep=("q",), **kw),
                   lambda d: ops.spend_threshold(d, 12.5, order_id="q", **kw)):
        want = batch(run_on(df))
        assert want == batch(run_on(df.withColumnRenamed("userId", "u").withColumnRenamed("u", "userId")))
        s, d = stream(spark, data, EVENTS)
        assert run(spark, run_on(s), d) == want
    windows = ops.hybrid_window(df, "1 minute", 2, **kw)
    assert windows.columns[:2] == ["userId", "eventType"]
    assert batch(windows) == batch(ops.hybrid_window(df, "1 minute", 2, rows_per_chunk=3, **kw))
