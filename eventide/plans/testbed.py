"""Registered queries: each reference operator applied to inputs that Spark

Every function takes ``(spark, sf_dir)`` and returns a DataFrame over the
whole tables.  Expressions like ``k % 17 == 0`` only change values (to put
nulls, blanks and invalid values into the inputs); no row is ever filtered
out by them, and event types only deal rows out to an operator's inputs.  Money columns are rounded in the final projection only, so
that float sums computed in another association order compare equal."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide import operators as ops
from eventide.plans.keyed import hot_keys
from eventide.sources.tables import register_views, table

DAY_MS = 86_400_000


# ---------------------------------------------------------------- inputs
def _k() -> F.Column:
    return F.get_json_object("props", "$.k").cast("int")


def events(spark: SparkSession, d: str) -> DataFrame:
    return table(spark, d, "events").withColumn("k", _k())


def marketplace_orders(spark: SparkSession, d: str) -> DataFrame:
    """Orders as marketplace orders: order_id, customer_id, product_id, price, ts, seq."""
    o = table(spark, d, "orders")
    return o.select(F.col("o_orderkey").cast("string").alias("order_id"),
                    F.col("o_custkey").alias("customer_id"),
                    F.col("o_orderpriority").alias("product_id"),
                    F.col("o_totalprice").alias("price"),
                    F.col("o_orderdate").alias("ts"),
                    F.col("o_orderkey").alias("seq"))


def transactions(spark: SparkSession, d: str) -> DataFrame:
    """Card transactions: userId, amount, country, merchant, ts, event_id."""
    e = events(spark, d)
    return e.select(F.col("user_id").alias("userId"), F.col("value").alias("amount"),
                    (F.col("k") % 20).cast("string").alias("country"),
                    F.col("event_type").alias("merchant"), "ts", "event_id")


def currency_changes(spark: SparkSession, d: str) -> DataFrame:
    """A rate changelog: currency, op, rate DECIMAL(10,4), update_time, event_id."""
    e = events(spark, d)
    cur = (F.when(F.col("user_id") % 6 == 0, "EUR").when(F.col("user_id") % 6 == 1, "USD")
           .when(F.col("user_id") % 6 == 2, "GBP").when(F.col("user_id") % 6 == 3, "JPY")
           .when(F.col("user_id") % 6 == 4, "CHF").otherwise("UNK"))
    op = (F.when(F.col("event_type") == "signup", "+I")
          .when(F.col("event_type").isin("click", "view"), "+U")
          .when(F.col("event_type") == "error", "-U")
          .when(F.col("event_type") == "purchase", "-D"))
    return e.select(cur.alias("currency"), op.alias("op"),
                    F.col("value").cast("decimal(10,4)").alias("rate"),
                    F.col("ts").alias("update_time"), "event_id")


def quality_input(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d)
    n = table(spark, d, "nation")
    k = F.col("k")
    j = e.join(n, F.col("n_nationkey") == F.col("user_id") % 25, "left")
    return j.select(
        "event_id",
        F.col("user_id").cast("string").alias("userId"),
        F.when(k % 17 == 0, F.lit(None)).when(k % 19 == 0, -F.col("value"))
        .otherwise(F.col("value") * 30).alias("amount"),
        F.when(k % 23 == 0, F.lit(None))
        .otherwise(F.substring("n_name", 1, 1 + k % 4)).alias("country"),
        F.when(k % 11 == 0, F.lit(None)).when(k % 13 == 0, F.lit(" \t "))
        .otherwise(F.col("event_type")).alias("merchant"))


def user_events_nulled(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d)
    k = F.col("k")
    return e.select("event_id",
                    F.when(k % 13 == 0, F.lit(None)).otherwise(F.col("user_id")).alias("user_id"),
                    "event_type",
                    F.when(k % 9 == 0, F.lit(None)).otherwise(F.col("value")).alias("value"),
                    F.when(k % 5 == 0, F.lit(None)).otherwise(F.col("ts")).alias("ts"))


def cdc_inputs(spark: SparkSession, d: str):
    """Orders and line items as row-level CDC envelopes of one database
    transaction per order, plus END events announcing 1 + items changes
    (one too many for every tenth order, which must never complete)."""
    o = table(spark, d, "orders")
    li = table(spark, d, "lineitem")
    orders_cdc = o.select(
        F.lit(None).cast("struct<id:bigint,customer_id:bigint,status:string,"
                         "total_amount:double>").alias("before"),
        F.struct(F.col("o_orderkey").alias("id"), F.col("o_custkey").alias("customer_id"),
                 F.col("o_orderstatus").alias("status"),
                 F.col("o_totalprice").alias("total_amount")).alias("after"),
        F.lit("c").alias("op"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("ts_ms"),
        F.struct(F.col("o_orderkey").cast("string").alias("id"),
                 F.lit(1).cast("bigint").alias("total_order"),
                 F.lit(1).cast("bigint").alias("data_collection_order")).alias("transaction"))
    items_cdc = li.select(
        F.struct((F.col("l_orderkey") * 100 + F.col("l_linenumber")).alias("id"),
                 F.col("l_orderkey").alias("order_id"),
                 F.col("l_partkey").alias("product_id"),
                 F.col("l_quantity").cast("int").alias("quantity"),
                 F.col("l_extendedprice").alias("unit_price")).alias("after"),
        F.lit("c").alias("op"),
        F.unix_millis(F.col("l_shipdate").cast("timestamp")).alias("ts_ms"),
        F.struct(F.col("l_orderkey").cast("string").alias("id"),
                 (F.col("l_linenumber") + 1).cast("bigint").alias("total_order"),
                 F.col("l_linenumber").cast("bigint").alias("data_collection_order"))
        .alias("transaction"))
    # one aggregate over orders and items (map-side partial), no join
    per_txn = (o.select(F.col("o_orderkey").alias("k"),
                        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("ts_ms"),
                        F.lit(1).alias("n"))
               .unionByName(li.select(F.col("l_orderkey").alias("k"),
                                      F.lit(None).cast("long").alias("ts_ms"),
                                      F.lit(1).alias("n")))
               .groupBy("k").agg(F.max("ts_ms").alias("ts_ms"), F.sum("n").alias("n")))
    ends = (per_txn.filter(F.col("ts_ms").isNotNull())
            .select(F.lit("END").alias("status"), F.col("k").cast("string").alias("id"),
                    "ts_ms",
                    (F.col("n") + F.when(F.col("k") % 10 == 0, 1).otherwise(0))
                    .cast("bigint").alias("event_count")))
    begins = o.select(F.lit("BEGIN").alias("status"),
                      F.col("o_orderkey").cast("string").alias("id"),
                      F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("ts_ms"),
                      F.lit(None).cast("bigint").alias("event_count"))
    return orders_cdc, items_cdc, begins.unionByName(ends)


def kv_changes(spark: SparkSession, d: str) -> DataFrame:
    e = events(spark, d)
    k = F.col("k")

    def s(v):
        return F.struct(v.cast("string").alias("S"), F.lit(None).cast("string").alias("N"))

    def n(v):
        return F.struct(F.lit(None).cast("string").alias("S"), v.cast("string").alias("N"))

    pk = F.concat(F.lit("user#"), F.col("user_id").cast("string"))
    keys = F.create_map(F.lit("pk"), s(pk), F.lit("sk"), s(F.lit("profile")))
    note = F.when(k % 4 == 0, F.lit('say "hi"'))
    new_img = F.create_map(F.lit("pk"), s(pk), F.lit("sk"), s(F.lit("profile")),
                           F.lit("type"), s(F.col("event_type")), F.lit("value"),
                           n(F.col("value")), F.lit("k"), n(k), F.lit("note"), s(note))
    old_img = F.create_map(F.lit("pk"), s(pk), F.lit("sk"), s(F.lit("profile")),
                           F.lit("k"), n(k - 1))
    name = F.upper(F.when(F.col("event_type") == "signup", "INSERT")
                   .when(F.col("event_type") == "click", "MODIFY")
                   .when(F.col("event_type") == "purchase", "REMOVE")
                   .otherwise(F.col("event_type")))
    return e.select(
        F.col("event_id").cast("string").alias("eventID"), name.alias("eventName"),
        F.struct(keys.alias("Keys"),
                 F.when(name != "REMOVE", new_img).alias("NewImage"),
                 F.when((name == "MODIFY") | ((name == "REMOVE") & (k % 3 != 0)), old_img)
                 .alias("OldImage"),
                 F.col("event_id").cast("string").alias("SequenceNumber"),
                 F.lit(100).cast("bigint").alias("SizeBytes"),
                 F.lit("NEW_AND_OLD_IMAGES").alias("StreamViewType")).alias("dynamodb"),
        F.unix_millis(F.col("ts").cast("timestamp")).alias("emit_ms"))


# ---------------------------------------------------------------- queries
def q_spend_threshold(spark, d):
    r = ops.spend_threshold(marketplace_orders(spark, d), 500000.0, key="customer_id",
                            price="price", order_id="order_id", time="ts", seq="seq")
    return r.withColumn("total_spend", F.round("total_spend", 2))


def q_anomaly_alerts(spark, d, **options):
    return ops.anomaly_alerts(transactions(spark, d), user="userId", amount="amount",
                              country="country", merchant="merchant", time="ts",
                              seq="event_id", keep=("event_id",), **options)


def q_anomaly_alerts_ttl(spark, d):
    """Alerts of users whose history expires after 12 silent hours."""
    return q_anomaly_alerts(spark, d, threshold=0.5, state_ttl="12 hours")


def q_anomaly_alerts_clocks(spark, d):
    """Each part of a user's state expires by a clock of its own."""
    return q_anomaly_alerts(spark, d, threshold=0.4, state_ttl={
        "history": "12 hours", "merchants": "36 hours", "amounts": "48 hours"})


def _pricing_inputs(spark, d):
    e = events(spark, d)
    inv = e.filter(F.col("event_type") != "purchase").select(
        F.col("user_id").alias("sku"), (F.col("k") % 50 + 1).alias("quantity"),
        (F.lit(10.0) + F.col("k")).alias("basePrice"), "ts", "event_id")
    comp = e.filter(F.col("event_type") == "purchase").select(
        F.col("user_id").alias("sku"), F.col("value").alias("price"), "ts", "event_id")
    return inv, comp


def q_dynamic_pricing(spark, d):
    inv, comp = _pricing_inputs(spark, d)
    r = ops.dynamic_pricing(inv, comp, key="sku", time="ts", inventory_seq="event_id",
                            competitor_seq="event_id", demand_threshold=3)
    return r.withColumns({"newPrice": F.round("newPrice", 4),
                          "oldPrice": F.round("oldPrice", 4)})


def _sessions(mode):
    def q(spark, d):
        e = events(spark, d)
        return ops.sessions(e, 12 * 3600, user="user_id", event_type="event_type", time="ts",
                            seq="event_id", end_event="purchase", on_timeout=mode)
    return q


def q_session_summary(spark, d):
    r = ops.session_summary(events(spark, d), "12 hours", user="user_id", time="ts",
                            value="value", event_type="event_type")
    return r.select(F.col("user_id").alias("userId"), "sessionStart", "sessionEnd",
                    "eventCount", F.round("totalValue", 2).alias("totalValue"),
                    F.array_join("eventTypes", ",").alias("eventTypes"))


def q_session_event_pages(spark, d):
    """Every event of every session in order, four to a page."""
    r = ops.session_summary(events(spark, d), "12 hours", user="user_id", time="ts", value="value",
                            event_type="event_type", seq="event_id", page_rows=4)
    return r.select(F.col("user_id").alias("userId"), "sessionStart", "sessionEnd", "eventCount",
                    F.round("totalValue", 2).alias("totalValue"), "page",
                    F.array_join("eventTypes", ",").alias("eventTypes"))


def q_first_match_join(spark, d):
    e = events(spark, d)
    c = table(spark, d, "customer")
    is_order = F.col("event_type").isin("purchase", "click", "view")
    orders = e.filter(is_order).select(
        F.col("event_id").cast("string").alias("orderId"),
        F.col("user_id").alias("customerId"), F.col("value").alias("totalAmount"),
        "ts", "event_id")
    customers = (e.filter(~is_order)
                 .join(c, F.col("c_custkey") == F.col("user_id"))
                 .select(F.col("user_id").alias("customerId"),
                         F.when(F.col("k") % 7 == 0, F.lit(None)).otherwise(F.col("c_name"))
                         .alias("name"),
                         F.concat(F.lower(F.regexp_replace("c_name", "#", "")),
                                  F.lit("@example.com")).alias("email"),
                         F.col("c_mktsegment").alias("tier"), "ts", "event_id"))
    return ops.first_match_join(orders, customers, key="customerId", time="ts",
                                order_seq="event_id", customer_seq="event_id")


def q_changelog_audit(spark, d, **options):
    return ops.changelog_audit(currency_changes(spark, d), key="currency", rate="rate",
                               time="update_time", op="op", seq="event_id", **options)


def q_changelog_audit_ttl(spark, d):
    """The remembered rate expires after a minute without a change."""
    return q_changelog_audit(spark, d, state_ttl="1 minute")


def q_latest_by_key(spark, d):
    return ops.latest_by_key(table(spark, d, "orders"), "o_custkey", time="o_orderdate",
                             seq="o_orderkey")


def q_latest_changelog(spark, d):
    return ops.latest_changelog(table(spark, d, "orders"), "o_custkey", time="o_orderdate",
                                seq="o_orderkey")


def q_changelog_audit_versioned(spark, d):
    """Audit trail of the latest-order-per-customer view's changelog; both
    operators work per customer and share one measurement of the keys."""
    orders = table(spark, d, "orders")
    hot = hot_keys(orders, "o_custkey")
    ch = ops.latest_changelog(orders, "o_custkey", time="o_orderdate", seq="o_orderkey", hot=hot)
    ch = ch.select(F.col("o_custkey").alias("currency"), "op",
                   F.col("o_totalprice").cast("decimal(10,4)").alias("rate"),
                   F.col("o_orderdate").alias("update_time"),
                   (F.col("o_orderkey") * 2 + F.col("change_seq")).alias("seq"))
    return ops.changelog_audit(ch, key="currency", rate="rate", time="update_time", op="op",
                               seq="seq", hot=hot)


def q_changelog_materialized(spark, d):
    ch = ops.latest_changelog(table(spark, d, "orders"), "o_custkey", time="o_orderdate",
                              seq="o_orderkey")
    return ops.materialize_changelog(ch, "o_custkey", time="o_orderdate", seq="o_orderkey") \
        .drop("change_seq")


def q_changelog_scd2(spark, d):
    orders = table(spark, d, "orders")
    hot = hot_keys(orders, "o_custkey")
    ch = ops.latest_changelog(orders, "o_custkey", time="o_orderdate", seq="o_orderkey", hot=hot)
    return ops.scd2_from_changelog(ch.drop("change_seq"), "o_custkey", time="o_orderdate",
                                   seq="o_orderkey", hot=hot)


def q_quality_score(spark, d, **options):
    return ops.quality_score(quality_input(spark, d), user="userId", amount="amount",
                             country="country", merchant="merchant", **options)


def q_quality_score_readme(spark, d):
    return q_quality_score(spark, d, rules="readme")


def q_row_formatter_nation(spark, d):
    return ops.row_formatter(table(spark, d, "nation"), ["n_regionkey"], order="n_nationkey")


def q_row_formatter_sql_types(spark, d):
    return ops.row_formatter(user_events_nulled(spark, d), ["event_type"], order="event_id",
                             type_names="sql")


def q_row_formatter_nested(spark, d):
    """Rows, arrays and maps inside one another, as the runtime prints them."""
    k, user = F.col("k").cast("long"), F.col("user_id")
    one = lambda c: F.struct(c.alias("n"))
    lookup = F.create_map(F.lit("u"), F.array(one(user), F.lit(None)), F.lit("k"), F.array(one(k)))
    rows = events(spark, d).select(
        "event_id", "event_type",
        F.when(k % 7 != 0, F.struct(user, F.when(k % 9 != 0, F.col("value")).alias("value"), "ts")).alias("detail"),
        F.when(k % 11 == 0, F.array().cast("array<bigint>")).otherwise(F.array(k, F.lit(None), user)).alias("numbers"),
        lookup.alias("lookup"))
    return ops.row_formatter(rows, ["event_type"], order="event_id")


def q_row_formatter_ttl(spark, d):
    ev = user_events_nulled(spark, d).drop("ts").join(events(spark, d).select("event_id", "ts"), "event_id")
    return ops.row_formatter(ev, ["event_type"], order="event_id", time="ts", state_ttl="6 hours")


def q_row_formatter_events(spark, d):
    return ops.row_formatter(user_events_nulled(spark, d), ["event_type"], order="event_id")


def q_cdc_transactions(spark, d):
    oc, ic, te = cdc_inputs(spark, d)
    r = ops.cdc_transactions(oc, ic, te)
    text = F.array_join(F.transform("line_items", lambda x: F.concat_ws(
        ":", x["product_id"].cast("string"), x["quantity"].cast("string"),
        F.round(x["unit_price"] * 100).cast("bigint").cast("string"))), ";")
    return r.select("transaction_id", "order_id", "customer_id", "status", "total_amount",
                    F.size("line_items").alias("n_items"), text.alias("items_text"))


def q_cdc_transactions_rows(spark, d):
    oc, ic, te = cdc_inputs(spark, d)
    return ops.cdc_transactions(oc, ic, te, items="rows")


def q_cdc_changelog(spark, d, **options):
    return ops.cdc_changelog(kv_changes(spark, d), event_time="emit_ms", **options)


def q_cdc_changelog_upsert(spark, d):
    """Upsert changes with strict JSON, the emit time as a timestamp."""
    r = q_cdc_changelog(spark, d, mode="upsert", json="strict")
    return r.withColumn("event_time", F.timestamp_millis("event_time").cast("timestamp_ntz"))


def q_events_by_type_view(spark, d):
    """SQL over a named view."""
    register_views(spark, d, ["events"])
    return spark.sql("SELECT event_type, count(*) AS n, max(ts) AS last_ts FROM events GROUP BY event_type")


def q_hybrid_window(spark, d):
    r = ops.hybrid_window(events(spark, d), DAY_MS, 3, key="user_id", price="value",
                          time="ts", seq="event_id")
    return r.withColumn("total_price", F.round("total_price", 2))


def q_early_fire_window(spark, d):
    r = ops.early_fire_window(events(spark, d), DAY_MS, key="user_id", price="value",
                              time="ts", seq="event_id", keep=("event_id",))
    return r.withColumn("total_price", F.round("total_price", 2))


def q_early_fire_window_arrival(spark, d):
    """Rows arrive by their number k, so many are late for their window."""
    e = events(spark, d).withColumn("arrival", F.col("k") * 10_000_000 + F.col("event_id"))
    r = ops.early_fire_window(e, DAY_MS, key="user_id", price="value", time="ts", seq="arrival",
                              order_by="arrival", keep=("event_id",))
    return r.withColumn("total_price", F.round("total_price", 2))


QUERIES = {
    "anomaly_alerts": q_anomaly_alerts,
    "dynamic_pricing": q_dynamic_pricing,
    "sessions_continue": _sessions("continue"),
    "sessions_close": _sessions("close"),
    "session_summary": q_session_summary,
    "first_match_join": q_first_match_join,
    "changelog_audit": q_changelog_audit,
    "latest_by_key": q_latest_by_key,
    "latest_changelog": q_latest_changelog,
    "changelog_audit_versioned": q_changelog_audit_versioned,
    "changelog_materialized": q_changelog_materialized,
    "changelog_scd2": q_changelog_scd2,
    "quality_score": q_quality_score,
    "row_formatter_nation": q_row_formatter_nation,
    "row_formatter_events": q_row_formatter_events,
    "cdc_transactions": q_cdc_transactions,
    "cdc_changelog": q_cdc_changelog,
    "hybrid_window": q_hybrid_window,
    "early_fire_window": q_early_fire_window,
    "spend_threshold": q_spend_threshold,
    "anomaly_alerts_ttl": q_anomaly_alerts_ttl,
    "anomaly_alerts_clocks": q_anomaly_alerts_clocks,
    "row_formatter_nested": q_row_formatter_nested,
    "session_event_pages": q_session_event_pages,
    "changelog_audit_ttl": q_changelog_audit_ttl,
    "quality_score_readme": q_quality_score_readme,
    "row_formatter_ttl": q_row_formatter_ttl,
    "row_formatter_sql_types": q_row_formatter_sql_types,
    "cdc_transactions_rows": q_cdc_transactions_rows,
    "cdc_changelog_upsert": q_cdc_changelog_upsert,
    "early_fire_window_arrival": q_early_fire_window_arrival,
    "events_by_type_view": q_events_by_type_view,
}
