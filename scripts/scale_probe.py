"""Throughput and skew probe on an expanded copy of the events table.

The sf0.1 events table is replicated N times inside Spark (explode of a
sequence; each copy gets its own user ids and a time shift), optionally
sending a third of all rows to one user.  Prints one JSON line per run.

usage: python scripts/scale_probe.py [copies] [--hot]
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def expanded(spark, sf_dir, copies, hot):
    from pyspark.sql import functions as F
    e = spark.read.parquet(os.path.join(sf_dir, "events.parquet"))
    x = e.withColumn("rep", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
    user = F.col("user_id") * copies + F.col("rep")
    if hot:  # a third of all rows (every third copy) belongs to user -1
        user = F.when(F.col("rep") % 3 == 0, F.lit(-1)).otherwise(user)
    return x.select(
        (F.col("event_id") * copies + F.col("rep")).alias("event_id"),
        (F.col("ts").cast("timestamp") + F.make_interval(days=F.col("rep") * 31))
        .cast("timestamp_ntz").alias("ts"),
        user.alias("user_id"), "event_type", "value", "props")


def main():
    args = [a for a in sys.argv[1:] if not a.startswith("--")]
    copies = int(args[0]) if args else 100
    hot = "--hot" in sys.argv
    from pyspark.sql import functions as F
    from eventide import operators as ops
    from eventide.session import get_session
    spark = get_session("local[8]", shuffle_partitions=64)
    out = os.environ.get("SCALE_DIR")
    src = expanded(spark, "/root/testdata/sf0.1", copies, hot)
    if out:  # materialise once, then read it back like a real input table
        path = os.path.join(out, f"events_x{copies}{'_hot' if hot else ''}")
        if not os.path.exists(path):
            src.write.parquet(path)
        src = spark.read.parquet(path)
    n = src.count()
    runs = {
        "anomaly_alerts": lambda rpc: ops.anomaly_alerts(
            src.withColumn("country", (F.col("value") % 20).cast("int").cast("string")),
            user="user_id", amount="value", merchant="event_type", time="ts",
            seq="event_id", rows_per_chunk=rpc),
        "sessions": lambda rpc: ops.sessions(
            src, 12 * 3600, user="user_id", event_type="event_type", time="ts",
            seq="event_id", end_event="purchase", rows_per_chunk=rpc),
        "spend_threshold": lambda rpc: ops.spend_threshold(
            src, 1e9, key="user_id", price="value", order_id="event_id", time="ts",
            seq="event_id", rows_per_chunk=rpc),
    }
    paths = {"plain": 0, "split": 500_000} if hot else {"plain": 0}
    for name, build in runs.items():
        for path, rpc in paths.items():
            t0 = time.perf_counter()
            build(rpc).write.format("noop").mode("overwrite").save()
            sec = time.perf_counter() - t0
            print(json.dumps({"query": name, "path": path, "rows": n, "hot_key": hot,
                              "sec": round(sec, 2), "rows_per_sec": int(n / sec)}))
    spark.stop()


if __name__ == "__main__":
    main()
