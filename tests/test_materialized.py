"""Changelogs kept as tables batch by batch, SCD type 2 on streams, and
transactions streamed row by row."""

import random
import tempfile

import pytest
from pyspark.sql import functions as F

from eventide import operators as ops
from eventide.sources import materialized as mat
from test_stream_cases import batch, run, stream

CHANGES = "op string, k string, g int, v string, ts long, seq int"


def some_changes(n=80):
    rnd = random.Random(3)
    ops_ = ["+I", "-U", "+U", "+U", "-D"]
    return [(rnd.choice(ops_), rnd.choice(["a", "b", "c", None]), rnd.choice([1, 2]), f"v{i}", 1000 + i // 2 * 10, i)
            for i in range(n)]


def test_batches_amount_to_the_batch_result(spark):
    rows = some_changes()
    want = batch(ops.materialize_changelog(spark.createDataFrame(rows, CHANGES), ["k", "g"], time="ts", seq="seq"))
    path = tempfile.mkdtemp(prefix="eventide-mat-") + "/t"
    kw = dict(keys=["k", "g"], order=["ts", "seq"], compact_every=3)
    with pytest.raises(ValueError):
        mat.read_table(spark, path)
    random.Random(1).shuffle(rows)          # late changes in later batches
    parts = [spark.createDataFrame(rows[i:i + 10], CHANGES) for i in range(0, 80, 10)]
    for i, part in enumerate(parts):
        if i:
            before = batch(mat.read_table(spark, path))
            # a batch that stopped in mid-write: its folder is there, the pointer is not
            spark.createDataFrame([("+I", "zz", 1, "bad", 10 ** 6, 10 ** 6)], CHANGES).write.parquet(f"{path}/changes/{i}")
            assert batch(mat.read_table(spark, path)) == before
        assert mat.apply_changes(part, i, path, **kw)
        again = batch(mat.read_table(spark, path))
        assert not mat.apply_changes(part, i, path, **kw)       # replayed
        assert batch(mat.read_table(spark, path)) == again
    assert again == want and mat.pointer(spark, path)["base"] == 5
    assert mat.vacuum(spark, path) == ["base/2", *[f"changes/{i}" for i in range(6)]]
    assert batch(mat.read_table(spark, path)) == want and mat.vacuum(spark, path) == []
    with pytest.raises(ValueError):
        mat.apply_changes(parts[0], 99, path, keys=["k"], order=["ts"])


@pytest.mark.parametrize("order", ["arrival", "event"])
def test_scd2_on_streams(spark, order):
    rows = some_changes()
    if order == "event":
        rows = sorted(rows, key=lambda r: r[4] + r[5] * 7919 % 200)
        rows += [("-D", "~", 1, "", 10 ** 7, 1000), ("-D", "~", 1, "", 2 * 10 ** 7, 1001)]
    df = spark.createDataFrame(rows, CHANGES)
    kw = dict(time="ts", seq="seq")
    want = batch(ops.scd2_from_changelog(df, ["k", "g"], **kw))
    s, d = stream(spark, rows, CHANGES, 4)
    out = run(spark, ops.scd2_from_changelog(s, ["k", "g"], stream_order=order, watermark="1 second", **kw), d)
    schema = "op string, change_seq int, version long, k string, g int, v string, ts long, seq int, valid_from long, valid_to long"
    path = tempfile.mkdtemp(prefix="eventide-scd-") + "/t"
    cut = len(out) // 2
    for i, part in enumerate((out[:cut], out[cut:])):
        mat.apply_changes(spark.createDataFrame(part, schema), i, path, keys=["k", "g", "version"], order="change_seq")
    table = mat.read_table(spark, path)
    assert batch(table.drop("change_seq", "version")) == want
    versions = table.groupBy("k", "g").agg(F.max("version").alias("m"), F.count("*").alias("n"))
    assert versions.filter("m <> n").isEmpty()


IMAGE = "struct<id:bigint,customer_id:bigint,status:string,total_amount:double>"
ITEM = "struct<product_id:bigint,quantity:int,unit_price:double>"
TXN = "struct<id:string,total_order:bigint>"


def transactions(spark, sizes):
    """One header row and ``sizes[id]`` items each; the header comes last."""
    ids = [(t, n) for t, n in sizes.items()]
    base = spark.createDataFrame(ids, "id string, n int")
    o = base.select(F.lit(1000).cast("long").alias("ts_ms"),
                    F.struct(F.xxhash64("id").alias("id"), F.lit(5).cast("long").alias("customer_id"),
                             F.lit("ok").alias("status"), F.lit(2.5).alias("total_amount")).cast(IMAGE).alias("after"),
                    F.struct("id", (F.col("n") + 1).cast("long").alias("total_order")).cast(TXN).alias("transaction"))
    items = base.filter("n > 0").select("id", F.explode(F.sequence(F.lit(1), F.col("n"))).alias("i"))
    i = items.select(F.lit(900).cast("long").alias("ts_ms"),
                     F.when(F.col("i") % 10 != 0, F.struct(
                         F.col("i").cast("long").alias("product_id"), (F.col("i") % 7).alias("quantity"),
                         (F.col("i") * 0.5).cast("double").alias("unit_price"))).cast(ITEM).alias("after"),
                     F.struct("id", F.col("i").cast("long").alias("total_order")).cast(TXN).alias("transaction"))
    t = base.select(F.lit("END").alias("status"), "id", F.lit(2000).cast("long").alias("ts_ms"),
                    (F.col("n") + F.when(F.col("id") == "never", 2).otherwise(1)).cast("long").alias("event_count"))
    return o, i, t


@pytest.mark.parametrize("ttl", [None, "1 hour"])
def test_transactions_stream_row_by_row(spark, ttl):
    from eventide.streaming.processors import TransactionRowsProcessor
    three = transactions(spark, {"big": 100_000 if ttl is None else 3000, "none": 0, "never": 5, "page": 1111, "x": 3})
    streams, d = [], tempfile.mkdtemp(prefix="eventide-rows-")
    for n, df in enumerate(three):
        df.repartition(3).write.parquet(f"{d}/in{n}")
        streams.append(spark.readStream.schema(df.schema).option("maxFilesPerTrigger", 1).parquet(f"{d}/in{n}"))
    kw = dict(items="rows", state_ttl=ttl)
    want = ops.cdc_transactions(*three, **kw)
    name = "rows_" + ("ttl" if ttl else "plain")
    q = (ops.cdc_transactions(*streams, **kw).writeStream.format("memory").queryName(name)
         .option("checkpointLocation", f"{d}/ck").trigger(availableNow=True).start())
    q.awaitTermination()
    got = spark.table(name)
    assert got.columns == want.columns
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
    assert got.filter("transaction_id = 'never'").isEmpty() and got.filter("transaction_id = 'none'").count() == 1
    assert TransactionRowsProcessor().page_rows == 1000
