"""The running count of null patterns: many patterns on one key, patterns that
expire, rows of equal order, and streams."""

import random

import pytest
from pyspark.sql import functions as F

from eventide import operators as ops
from test_stream_cases import batch, run, stream

ROWS = "k string, a int, b string, ts long, seq int"


def test_one_key_with_very_many_patterns(spark):
    """2^17 patterns in twice as many rows of one key, in slices of 30,000."""
    n = 1 << 17
    df = spark.range(2 * n).select(F.lit("k").alias("key"), "id", *[
        F.when(F.col("id").bitwiseAND(1 << i) == 0, F.lit(1)).alias(f"c{i}") for i in range(17)])
    out = ops.row_formatter(df, "key", order="id", rows_per_chunk=30_000)
    got = out.select(F.regexp_extract("formatted_row", r"id=(\d+)", 1).cast("long").alias("id"), "distinct_patterns")
    assert got.filter(F.col("distinct_patterns") != F.least(F.col("id") + 1, F.lit(n))).isEmpty()
    assert got.count() == 2 * n


def fold(rows, ttl):
    """One row after the other, as the definition says."""
    last, out = {}, []
    for k, a, b, ts, seq in sorted((r for r in rows if r[3] is not None), key=lambda r: (r[3], r[4])):
        last[k, a is None, b is None] = ts
        out.append((k, seq, sum(x == k and ts - t <= ttl for (x, _, _), t in last.items())))
    return sorted(out)


def some_rows(n=120):
    rnd = random.Random(4)
    rows = [(rnd.choice("xyz"), rnd.choice([None, 1]), rnd.choice([None, "é"]),
             1_000_000 + 1000 * rnd.randrange(0, 300, 5), i) for i in range(n)]
    return rows + [("x", 1, "b", None, n)]


def counts(df):
    return sorted((r.k, int(r.formatted_row.rsplit("seq=", 1)[1][:-1]), r.distinct_patterns) for r in df.collect())


@pytest.mark.parametrize("chunk", [None, 7])
def test_patterns_expire(spark, chunk):
    rows = some_rows()
    df = spark.createDataFrame(rows, ROWS)
    for ttl in (5, 15, 60):
        got = ops.row_formatter(df, "k", order="seq", time="ts", state_ttl=f"{ttl} seconds", rows_per_chunk=chunk)
        assert counts(got) == fold(rows, ttl * 1000)
    with pytest.raises(ValueError):
        ops.row_formatter(df, "k", order="seq", state_ttl="1 hour")


def test_patterns_expire_on_streams(spark):
    far = 10 ** 9
    rows = sorted((r for r in some_rows(60) if r[3]), key=lambda r: (r[3] + r[4] * 7919 % 9000, r[4]))
    rows += [("~", 1, "b", far, 1000), ("~", 1, "b", 2 * far, 1001)]
    kw = dict(order="seq", time="ts", state_ttl="15 seconds")
    want = batch(ops.row_formatter(spark.createDataFrame(rows, ROWS), "k", **kw))
    s, d = stream(spark, rows, ROWS, 5)
    got = run(spark, ops.row_formatter(s, "k", stream_order="event", watermark="30 seconds", **kw), d)
    assert [r for r in got if r[0] != "~"] == [r for r in want if r[0] != "~"]


def test_equal_and_null_order_and_maps(spark):
    df = spark.createDataFrame([("k", 1, {"a": 1}), ("k", 1, None), ("k", None, {"b": 2}), ("k", None, {"b": 2})],
                               "k string, o int, m map<string,int>")
    got = sorted(r.distinct_patterns for r in ops.row_formatter(df, "k", order="o").collect())
    assert got == [1, 1, 2, 3]
    rows = [("k", 1, "b", 5, None), ("k", None, "b", 6, 2), ("k", 1, None, 7, 1)]
    s, d = stream(spark, rows, ROWS, 1)
    assert sorted(r[3] for r in run(spark, ops.row_formatter(s, "k", order="seq"), d)) == [1, 2, 3]
