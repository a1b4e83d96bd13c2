"""Generator, sinks and file-metadata helpers."""

import os
import tempfile

from pyspark.sql import functions as F

from eventide import operators as ops
from eventide.sources import datagen, sinks


def test_generator_ranges_and_determinism(spark):
    df = datagen.generate(spark, "transactions", 5000, seed=7)
    r = df.agg(F.count("*"), F.min("amount"), F.max("amount"), F.min("ts"), F.max("ts"),
               F.max(F.length("country")), F.countDistinct("userId")).first()
    assert r[0] == 5000 and 1 <= r[1] and r[2] <= 10000 and (r[3], r[4]) == (1, 5000)
    assert r[5] == 2 and r[6] <= 16
    again = datagen.generate(spark, "transactions", 5000, seed=7)
    assert df.exceptAll(again).count() == 0
    cr = datagen.generate(spark, "currency_rates", 100)
    assert set(x[0] for x in cr.select("currency").distinct().collect()) <= \
        {"EUR", "USD", "GBP", "JPY", "CHF"}
    assert cr.schema["rate"].dataType.simpleString() == "decimal(10,4)"


def test_generated_table_feeds_operator(spark):
    tx = datagen.generate(spark, "transactions", 3000)
    out = ops.anomaly_alerts(tx, time="ts", seq="ts")
    assert out.count() > 0


def test_write_table_and_file_time(spark):
    d = tempfile.mkdtemp(prefix="eventide-sink-")
    df = datagen.generate(spark, "orders", 100)
    sinks.write_table(df, path=os.path.join(d, "t"), partition_by="customerId")
    back = sinks.with_file_time(spark.read.parquet(os.path.join(d, "t")))
    assert back.count() == 100 and back.filter(F.col("file_time").isNull()).count() == 0


def test_write_stream_changelog(spark):
    d = tempfile.mkdtemp(prefix="eventide-sink-")
    src = os.path.join(d, "in")
    datagen.generate(spark, "currency_rates", 50).withColumn(
        "update_time", F.timestamp_millis(F.lit(0) + F.monotonically_increasing_id())
        .cast("timestamp_ntz")).withColumn("op", F.lit("+I")).write.parquet(src)
    s = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    audit = ops.changelog_audit(s, time="update_time")
    q = sinks.write_stream(audit, path=os.path.join(d, "out"), query_name="audit_sink",
                           checkpoint=os.path.join(d, "ck"), trigger={"availableNow": True})
    q.awaitTermination()
    assert spark.read.parquet(os.path.join(d, "out")).count() == 50


def test_generator_stream_rate_source(spark):
    import time
    s = datagen.generate_stream(spark, "currency_rates", rows_per_second=50)
    assert s.isStreaming and "currency" in s.columns
    d = tempfile.mkdtemp(prefix="eventide-rate-")
    q = (s.writeStream.format("memory").queryName("rate_gen").outputMode("append")
         .option("checkpointLocation", os.path.join(d, "ck")).start())
    try:
        deadline = time.time() + 60
        while time.time() < deadline and spark.table("rate_gen").count() == 0:
            time.sleep(1)
    finally:
        q.stop()
    got = spark.table("rate_gen")
    assert got.count() > 0
    assert got.filter(~F.col("currency").isin("EUR", "USD", "GBP", "JPY", "CHF")).count() == 0
