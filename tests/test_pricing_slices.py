"""Pricing of SKUs with very many rows: slices with the state handed on."""

import random

from pyspark.sql import functions as F

from eventide import operators as ops
from eventide.plans.keyed import CHUNK, keyed


def inputs(spark, n=400):
    rnd = random.Random(2)
    stock = [(rnd.choice(["hot", "hot", "a", "b", None]), rnd.choice([None, 3, 50, 60]), rnd.choice([None, 100.0, float("nan")]),
              rnd.randrange(0, 3000, 5), f"i{i:04}") for i in range(n)]
    rivals = [(rnd.choice(["hot", "a"]), rnd.choice([None, 80.0, 120.0, 95.5, float("nan")]), rnd.randrange(0, 3000, 5), f"c{i:04}")
              for i in range(n // 2)]
    return (spark.createDataFrame(stock, "sku string, quantity int, basePrice double, ts long, q string"),
            spark.createDataFrame(rivals, "sku string, price double, ts long, q string"))


def run(a, b, **kw):
    out = ops.dynamic_pricing(a, b, inventory_seq="q", competitor_seq="q", demand_threshold=7, **kw)
    return sorted(map(tuple, out.collect()), key=str)


def test_slices_equal_one_fold(spark):
    a, b = inputs(spark)
    for ttl in (None, 40):
        want = run(a, b, rows_per_chunk=0, state_ttl=ttl)
        assert len(want) > 50
        for chunk in (1000, 150, 20):
            assert run(a, b, rows_per_chunk=chunk, state_ttl=ttl) == want, (ttl, chunk)
    assert run(a, None, rows_per_chunk=30) == run(a, None, rows_per_chunk=0)


def test_no_task_folds_more_than_a_slice(spark):
    """A SKU with a third of all rows, 20,000 of them: slices of 1,000."""
    n = 60_000
    a = spark.range(n).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("s"), F.col("id") % 997))
                              .alias("sku"), (F.col("id") % 40).cast("int").alias("quantity"),
                              F.lit(10.0).alias("basePrice"), F.col("id").alias("ts"), F.col("id").alias("q"))
    k = keyed(a, ["sku"], ["ts", "q"], 1000)
    assert k.hot.groupBy(CHUNK).count().agg(F.max("count")).first()[0] <= 1100
    kw = dict(inventory_seq="q", demand_threshold=30)
    got = ops.dynamic_pricing(a, rows_per_chunk=1000, **kw)
    want = ops.dynamic_pricing(a, rows_per_chunk=0, **kw)
    assert got.exceptAll(want).isEmpty() and want.exceptAll(got).isEmpty()
