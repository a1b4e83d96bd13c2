"""Nested values in the row formatter, and session event lists in pages."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from eventide import operators as ops
from test_stream_cases import run, stream

NESTED = ("k string, o int, r struct<a:int,b:string,c:struct<d:double,e:array<string>>>, "
          "a array<array<int>>, m map<string,struct<x:int,y:timestamp_ntz>>, n array<map<int,decimal(6,2)>>")
ROWS = [
    ("k", 1, (1, "x", (2.5, ["p", None, "q"])), [[1, 2], [], None, [None]],
     {"b": (1, dt.datetime(2024, 1, 2, 3, 4)), "a": (None, None)}, [{2: Decimal("1.50"), 1: None}, None]),
    ("k", 2, (None, None, None), [], {}, None),
    ("k", 3, None, None, None, []),
]
WANT = [
    ("[k=k] => {o=1, r=+I[1, x, +I[2.5, [p, null, q]]], a=[[1, 2], [], null, [null]], "
     "m={a=+I[null, null], b=+I[1, 2024-01-02T03:04]}, n=[{1=null, 2=1.50}, null]}",
     "k:String, o:Integer, r:Row, a:Integer[][], m:HashMap, n:HashMap[]"),
    ("[k=k] => {o=2, r=+I[null, null, null], a=[], m={}, n=null}",
     "k:String, o:Integer, r:Row, a:Integer[][], m:HashMap, n:NULL"),
    ("[k=k] => {o=3, r=null, a=null, m=null, n=[]}",
     "k:String, o:Integer, r:NULL, a:NULL, m:NULL, n:HashMap[]"),
]


def test_nested_values_as_the_runtime_prints_them(spark):
    df = spark.createDataFrame(ROWS, NESTED)
    got = ops.row_formatter(df, "k", order="o").orderBy("distinct_patterns", "formatted_row").collect()
    assert [(r.formatted_row, r.schema_info) for r in got] == WANT
    s, d = stream(spark, ROWS, NESTED, 1)
    assert [r[1:3] for r in run(spark, ops.row_formatter(s, "k", order="o"), d)] == WANT
    sql = ops.row_formatter(df, "k", order="o", type_names="sql").first().schema_info
    assert sql == ("k:STRING, o:INT, r:ROW<`a` INT, `b` STRING, `c` ROW<`d` DOUBLE, `e` ARRAY<STRING>>>, "
                   "a:ARRAY<ARRAY<INT>>, m:MAP<STRING, ROW<`x` INT, `y` TIMESTAMP(6)>>, n:ARRAY<MAP<INT, DECIMAL(6, 2)>>")


def test_long_nested_text_is_cut(spark):
    df = spark.range(1).select(F.lit("k").alias("k"), "id", F.sequence(F.lit(1), F.lit(100)).alias("a"))
    text = ops.row_formatter(df, "k", order="id").first().formatted_row
    assert text == "[k=k] => {id=0, a=[" + ", ".join(str(i) for i in range(1, 100))[:46] + "...}"


SCHEMA = "userId string, eventType string, eventValue double, ts timestamp, seq int"


def test_a_session_of_a_million_events(spark):
    """One user's session in pages of a thousand, split into slices."""
    n = 1_000_000
    at = F.timestamp_millis(F.col("id") * 1000).alias("ts")
    df = spark.range(n).select(F.lit("u").alias("userId"), F.col("id").cast("string").alias("eventType"),
                               F.lit(1.0).alias("eventValue"), at, "id")
    got = ops.session_summary(df, "1 minute", seq="id", page_rows=1000, rows_per_chunk=200_000)
    first = F.col("eventTypes")[0] == ((F.col("page") - 1) * 1000).cast("string")
    last = F.col("eventTypes")[999] == (F.col("page") * 1000 - 1).cast("string")
    whole = (F.col("eventCount") == n) & (F.col("totalValue") == float(n)) & (F.size("eventTypes") == 1000)
    pages = got.groupBy().agg(F.count("*").alias("n"), F.min("page").alias("a"), F.max("page").alias("b"),
                              F.count(F.when(first & last & whole, 1)).alias("ok")).first()
    assert tuple(pages) == (1000, 1, 1000, 1000)


def test_event_pages_in_order_with_nulls_batch_and_stream(spark):
    def at(s):
        return dt.datetime(2024, 5, 1, 12, 0, s)
    rows = [("a", "x", 1.0, at(0), 1), ("a", None, 2.0, at(1), 2), ("a", "y", None, at(1), 3), ("a", "x", 1.0, at(20), 4),
            (None, "z", 1.0, at(3), 5), ("a", "x", 1.0, None, 6)]
    later = [("~", "t", 0.0, at(59) + dt.timedelta(days=i), 7 + i) for i in (1, 2)]
    df = spark.createDataFrame(rows + later, SCHEMA)
    for chunk in (0, 1):
        got = ops.session_summary(df, "10 seconds", seq="seq", page_rows=2, rows_per_chunk=chunk)
        flat = sorted(((r.userId, r.sessionStart.second, r.sessionEnd.second, r.eventCount, r.totalValue, r.page, r.eventTypes)
                       for r in got.collect() if r.userId != "~"), key=str)
        assert flat == [("a", 0, 11, 3, 3.0, 1, ["x", None]), ("a", 0, 11, 3, 3.0, 2, ["y"]),
                        ("a", 20, 30, 1, 1.0, 1, ["x"]), (None, 3, 13, 1, 1.0, 1, ["z"])]
    s, d = stream(spark, rows + later, SCHEMA, 4)
    kept = run(spark, ops.session_summary(s, "10 seconds", seq="seq", page_rows=2, watermark="1 hour"), d)
    assert [r for r in kept if r[0] != "~"] == sorted(map(tuple, got.filter("userId is null or userId <> '~'").collect()), key=str)
