"""Deterministic generator for the demo tables of the reference's examples.

Batch: ``spark.range`` + hashed column expressions (fully parallel, no
driver-side data).  Stream: the ``rate`` source with the same expressions on
its ``value`` column.  Random fields are uniform in ``[min, max]`` or
strings of a fixed length; ``sequence`` fields count up from ``start``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# The demo tables' field specs and rates as the reference
# declares them (random strings by length, numbers by min/max, sequences).
SPECS = {
    "transactions": (10, [("userId", "str", 1), ("amount", "double", 1, 10000),
                          ("country", "str", 2), ("merchant", "str", 1),
                          ("ts", "seq", 1, 10000000)]),
    "inventory": (5, [("sku", "str", 2), ("quantity", "int", 1, 50),
                      ("basePrice", "double", 10, 100), ("ts", "seq", 1, 10000000)]),
    "competitor_prices": (3, [("sku", "str", 2), ("price", "double", 8, 120),
                              ("ts", "seq", 1, 100000)]),
    "user_events": (5, [("userId", "str", 3), ("eventType", "str", 5),
                        ("eventValue", "double", 1, 100), ("ts", "seq", 1, 10000000)]),
    "orders": (5, [("orderId", "str", 8), ("customerId", "int", 1, 100),
                   ("totalAmount", "double", 10, 500), ("ts", "seq", 1, 10000000)]),
    "customers": (3, [("customerId", "int", 1, 100), ("name", "str", 10), ("email", "str", 15),
                      ("tier", "str", 4), ("ts", "seq", 1, 10000000)]),
    "currency_rates": (2, [("currency_idx", "int", 0, 4), ("rate", "double", 0.5, 2.0)]),
    "quality_transactions": (10, [("transactionId", "str", 10), ("userId", "str", 5),
                                  ("amount", "double", -100, 10000), ("country", "str", 2),
                                  ("ts", "seq", 1, 10000000)]),
}
CURRENCIES = ["EUR", "USD", "GBP", "JPY", "CHF"]  # index 0..4, else UNK


def _unit(i: Column, seed: int, name: str) -> Column:
    """Uniform double in [0, 1) from (row id, seed, field name)."""
    h = F.xxhash64(i, F.lit(seed), F.lit(name))
    return F.pmod(h, F.lit(1 << 30)).cast("double") / float(1 << 30)


def _field(i: Column, seed: int, spec) -> Column:
    name, kind = spec[0], spec[1]
    if kind == "seq":
        return (F.lit(spec[2]) + i).cast("long")
    if kind == "str":
        return F.substring(F.sha2(F.concat_ws(":", i.cast("string"), F.lit(seed), F.lit(name)),
                                  256), 1, spec[2])
    lo, hi = spec[2], spec[3]
    u = _unit(i, seed, name)
    if kind == "int":
        return (F.lit(lo) + F.floor(u * (hi - lo + 1))).cast("int")
    return (F.lit(float(lo)) + u * float(hi - lo)).cast("double")


def _finish(df: DataFrame, table: str) -> DataFrame:
    if table == "currency_rates":
        idx = F.col("currency_idx")
        cur = F.coalesce(F.element_at(F.array(*[F.lit(c) for c in CURRENCIES]), idx + 1),
                         F.lit("UNK"))
        df = df.withColumns({"currency": cur,
                             "rate": F.col("rate").cast("decimal(10,4)")})
    if "ts" in df.columns:
        df = df.withColumn("event_time", F.timestamp_millis(F.col("ts")))
    return df


def _sequence_length(fields) -> int | None:
    """Rows after which a table's sequences end, None without a sequence."""
    return min((f[3] - f[2] + 1 for f in fields if f[1] == "seq"), default=None)


def generate(spark: SparkSession, table: str, rows: int, seed: int = 42,
             partitions: int | None = None) -> DataFrame:
    """``rows`` rows of a demo table; more than its sequences have is an error."""
    _, fields = SPECS[table]
    most = _sequence_length(fields)
    if most is not None and rows > most:
        raise ValueError(f"{table}: its sequences end after {most} rows, {rows} asked for")
    base = spark.range(0, rows, numPartitions=partitions) if partitions else spark.range(0, rows)
    i = F.col("id")
    df = base.select(*[_field(i, seed, f).alias(f[0]) for f in fields])
    return _finish(df, table)


def generate_stream(spark: SparkSession, table: str, rows_per_second: int | None = None,
                    seed: int = 42) -> DataFrame:
    """Demo table at the reference's rate (or ``rows_per_second``); no more
    rows come once its sequences have ended."""
    rate, fields = SPECS[table]
    s = (spark.readStream.format("rate")
         .option("rowsPerSecond", rows_per_second or rate).load())
    i, most = F.col("value"), _sequence_length(fields)
    if most is not None:
        s = s.filter(i < most)
    df = s.select(*[_field(i, seed, f).alias(f[0]) for f in fields],
                  F.col("timestamp").alias("proc_time"))
    if table == "currency_rates":
        df = df.withColumn("update_time", F.col("proc_time").cast("timestamp_ntz"))
    return _finish(df, table)
