"""Physical plan shape: native operators run without Python, keyed
operators shuffle once, filters and column pruning reach the scan."""

import pytest

import __spark_entry__ as E
from plan_report import facts

SF = "/root/testdata/sf0.001"
PYTHON_ALLOWED = {"dynamic_pricing"}  # the one true recurrence: sorted mapInPandas fold

ONE_EXCHANGE = ["anomaly_alerts", "sessions_continue", "sessions_close", "changelog_audit",
                "hybrid_window", "early_fire_window", "spend_threshold", "latest_by_key",
                "dynamic_pricing", "latest_changelog", "anomaly_alerts_ttl", "changelog_audit_ttl",
                "early_fire_window_arrival", "session_summary"]


@pytest.fixture(scope="module")
def static_plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    yield {n: facts(q(spark, SF)) for n, q in E.QUERIES.items()}
    spark.conf.set("spark.sql.adaptive.enabled", "true")


@pytest.mark.parametrize("name", list(E.QUERIES))
def test_no_python_in_native_operators(static_plans, name):
    f = static_plans[name]
    if name in PYTHON_ALLOWED:
        assert f["python"] == 1
    else:
        assert f["python"] == 0


@pytest.mark.parametrize("name", ONE_EXCHANGE)
def test_keyed_operator_shuffles_once(static_plans, name):
    assert static_plans[name]["exchanges"] == 1


def test_stateless_operators_do_not_shuffle(static_plans):
    assert static_plans["cdc_changelog"]["exchanges"] == 0
    assert static_plans["quality_score"]["exchanges"] == 0


def test_pruning_and_pushdown(static_plans):
    f = static_plans["spend_threshold"]
    assert f["scans"] == ["struct<o_orderkey:bigint,o_custkey:bigint,o_totalprice:double,"
                          "o_orderdate:timestamp_ntz>"]
    f = static_plans["first_match_join"]
    assert any("In(event_type, [click,purchase,view])" in p or "event_type" in p for p in f["pushed"])


def test_row_formatter_moves_full_rows_at_most_once(static_plans):
    # first rows per pattern (partial aggregate, then per key), and the join on the key
    assert static_plans["row_formatter_events"]["exchanges"] <= 3


def test_split_plans_read_the_input_once(spark):
    """Hot rows are checkpointed slices: no scan of theirs goes back to the input."""
    from pyspark.sql import functions as F

    from eventide import operators as ops
    ev = spark.read.parquet(f"{SF}/events.parquet")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        a = ops.anomaly_alerts(ev.withColumn("m", F.col("user_id") % 7), user="user_id", amount="value",
                               country="event_type", merchant="m", time="ts", seq="event_id", rows_per_chunk=10)
        b = ops.sessions(ev, 3600, user="user_id", event_type="event_type", time="ts", seq="event_id",
                         on_timeout="close", rows_per_chunk=10)
        assert [len(facts(d)["scans"]) for d in (a, b)] == [1, 1]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_hot_key_plan_uses_chunked_windows(spark):
    from pyspark.sql import functions as F
    from eventide import operators as ops
    ev = spark.read.parquet(f"{SF}/events.parquet")
    df = ops.spend_threshold(ev.withColumn("order_id", F.col("event_id")), 100.0,
                             key="user_id", price="value", order_id="order_id", time="ts",
                             seq="event_id", rows_per_chunk=10)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "_chunk" in plan
