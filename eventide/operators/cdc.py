"""Change-data-capture operators: assembling multi-table database
transactions, and turning key-value change records into a changelog."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.columns import interval_ms

ITEM = "struct<product_id:bigint,quantity:int,unit_price:double>"


def cdc_transactions(orders_cdc: DataFrame, items_cdc: DataFrame,
                     txn_events: DataFrame, *, items: str = "array", state_ttl=None,
                     watermark="1 second") -> DataFrame:
    """Join the order-header and order-item change events of one database
    transaction once the transaction's END event has arrived and exactly the
    announced number of change events is present.

    Output (items='array'): transaction_id, order_id, customer_id, status,
    total_amount, line_items ARRAY<STRUCT<product_id, quantity, unit_price>>.
    The header is the last orders image with a non-null ``after`` (by
    ``transaction.total_order``); every item event with ``after`` appends a
    line item, ordered by ``total_order``.

    items='rows' returns one row per line item instead of an array (plus
    ``line_no``): completeness is then decided by partial aggregates only and
    no transaction is ever gathered into one row.  On streams the items wait in
    pages of map state and are emitted page by page.

    ``state_ttl`` (the reference keeps 1 hour): events of a transaction more
    than that apart (by ``ts_ms``) belong to separate attempts, and a stream
    clears a transaction's state once it has been silent that long (by the
    watermark, of which each input has its own), so
    transactions that never complete do not keep state forever."""
    if items not in ("array", "rows"):
        raise ValueError("items must be 'array' or 'rows'")
    ttl = interval_ms(state_ttl) if state_ttl else None
    o = orders_cdc.select(
        F.col("transaction.id").alias("_txn"), F.lit(0).alias("_side"),
        F.col("transaction.total_order").alias("_ord"), F.col("ts_ms").alias("_ts"),
        F.col("after").alias("_hdr"), F.lit(None).cast(ITEM).alias("_item"),
        F.lit(None).cast("bigint").alias("_expected"))
    it = items_cdc.select(
        F.col("transaction.id").alias("_txn"), F.lit(1).alias("_side"),
        F.col("transaction.total_order").alias("_ord"), F.col("ts_ms").alias("_ts"),
        F.lit(None).cast(orders_cdc.schema["after"].dataType).alias("_hdr"),
        F.when(F.col("after").isNotNull(), F.struct(
            F.col("after.product_id").cast("bigint").alias("product_id"),
            F.col("after.quantity").cast("int").alias("quantity"),
            F.col("after.unit_price").cast("double").alias("unit_price"))).alias("_item"),
        F.lit(None).cast("bigint").alias("_expected"))
    t = txn_events.filter(F.col("status") == "END").select(
        F.col("id").alias("_txn"), F.lit(2).alias("_side"),
        F.lit(None).cast("bigint").alias("_ord"), F.col("ts_ms").alias("_ts"),
        F.lit(None).cast(orders_cdc.schema["after"].dataType).alias("_hdr"),
        F.lit(None).cast(ITEM).alias("_item"), F.col("event_count").alias("_expected"))
    if any(d.isStreaming for d in (o, it, t)) and ttl:
        from eventide.streaming import ops as st
        from eventide.functions.columns import T_MS
        o, it, t = (st.watermarked(d.withColumn(T_MS, F.col("_ts")), w)
                    for d, w in zip((o, it, t), st.delays(watermark, 3)))
    # rows without a transaction id (snapshots) can never complete one
    u = o.unionByName(it).unionByName(t).filter(F.col("_txn").isNotNull())
    if u.isStreaming:
        from eventide.streaming import ops as st
        return st.cdc_transactions(u, st.delays(watermark, 3)[0], ttl, items)
    grp = ["_txn"]
    if ttl:
        from eventide.functions.columns import T_MS
        from eventide.plans.keyed import keyed, ttl_epochs
        u = u.withColumn(T_MS, F.col("_ts")).withColumn("_q", F.xxhash64(*u.columns))
        k = ttl_epochs(keyed(u, ["_txn"], [T_MS, "_side", "_q"]), ttl)
        u = k.result()
        grp = ["_txn", "_epoch"]
    counts = [F.count(F.when(F.col("_side") < 2, 1)).alias("_received"),
              F.max(F.col("_side") == 2).alias("_ended"),
              # the last END by time; one without a time counts as the earliest
              F.max_by("_expected", F.when(F.col("_side") == 2, F.struct(
                  F.coalesce("_ts", F.lit(-(1 << 63)).cast("bigint")),
                  F.coalesce("_expected", F.lit(-1).cast("bigint"))))).alias("_exp")]
    done = (F.coalesce(F.col("_ended"), F.lit(False)) & F.col("_exp").isNotNull()
            & (F.col("_received") == F.col("_exp")))

    def header(h):
        return [F.col("_txn").alias("transaction_id"),
                h["id"].cast("bigint").alias("order_id"),
                h["customer_id"].cast("bigint").alias("customer_id"),
                h["status"].alias("status"),
                h["total_amount"].cast("double").alias("total_amount")]

    def tagged(c, name):
        return F.collect_list(F.when(F.col(c).isNotNull(), F.struct(
            F.col("_ord").alias("o"), F.col("_ts").alias("t"), F.col(c).alias(name))))

    if items == "array":
        # Only collect_list and fixed-width aggregates: Spark plans a hash-based
        # ObjectHashAggregate with map-side partial aggregation (no sorts).
        g = u.groupBy(*grp).agg(tagged("_hdr", "h").alias("_hs"), *counts,
                                  tagged("_item", "i").alias("_items"))
        g = g.filter(done).withColumn("_h", F.array_max("_hs")["h"])
        return g.select(*header(F.col("_h")),
                        F.transform(F.array_sort("_items"), lambda x: x["i"])
                        .alias("line_items"))
    hdr = F.max_by("_hdr", F.when(F.col("_hdr").isNotNull(), F.struct("_ord", "_ts")))
    # the epoch tells the attempts of one transaction apart
    attempt = [F.col("_txn").alias("transaction_id"), *[F.col(c) for c in grp[1:]]]
    g = u.groupBy(*grp).agg(hdr.alias("_h"), *counts).filter(done) \
        .select(*header(F.col("_h")), *grp[1:])
    lines = u.filter(F.col("_item").isNotNull()).select(*attempt, "_ord", "_ts", "_item")
    return (g.join(lines, ["transaction_id", *grp[1:]], "left")
            .select(*[F.col(c) for c in g.columns if c not in grp[1:]],
                    F.col("_ord").alias("line_no"), F.col("_item.*")))


def _image_json(img, strict: bool):
    entries = F.filter(F.array_sort(F.map_entries(img)),
                       lambda e: ~e["key"].isin("pk", "sk"))
    if strict:
        kv = F.transform(entries, lambda e: F.struct(
            e["key"].alias("key"), F.coalesce(e["value"]["S"], e["value"]["N"]).alias("value")))
        body = F.to_json(F.map_from_entries(kv))
        return F.when(img.isNull() | (F.size(img) == 0), F.lit("{}")).otherwise(body)
    parts = F.transform(entries, lambda e: F.concat(
        F.lit('"'), e["key"], F.lit('":"'),
        F.coalesce(F.replace(F.coalesce(e["value"]["S"], e["value"]["N"]), F.lit('"'),
                             F.lit('\\"')), F.lit("null")),
        F.lit('"')))
    body = F.concat(F.lit("{"), F.array_join(parts, ","), F.lit("}"))
    return F.when(img.isNull() | (F.size(img) == 0), F.lit("{}")).otherwise(body)


def cdc_changelog(df: DataFrame, *, mode: str = "retract", json: str = "reference",
                  event_time: str | None = None) -> DataFrame:
    """Key-value change records -> changelog rows.

    INSERT -> +I NewImage; MODIFY -> -U OldImage, +U NewImage; REMOVE -> -D
    OldImage (Keys when OldImage is null); other event names are skipped.
    Output: op, change_seq (0, or 1 for the +U of a MODIFY), pk, sk,
    attributes_json, sequence_number, event_time.

    ``mode='upsert'`` drops the -U rows.  ``json='reference'`` renders every
    value as a quoted string with only ``"`` escaped and keys sorted;
    ``'strict'`` uses full JSON escaping.  ``event_time``: column with the
    emit time in ms; default the query's current time."""
    strict = json == "strict"
    ddb = F.col("dynamodb")
    keys_map = ddb["Keys"]
    pk = F.col("pk") if "pk" in df.columns else keys_map["pk"]["S"]
    sk = F.coalesce(keys_map["sk"]["S"], keys_map["sk"]["N"])
    new_j = _image_json(ddb["NewImage"], strict)
    old_j = _image_json(ddb["OldImage"], strict)
    rem_j = _image_json(F.coalesce(ddb["OldImage"], keys_map), strict)

    def ch(op, seq, js):
        return F.struct(F.lit(op).alias("op"), F.lit(seq).alias("change_seq"),
                        js.alias("attributes_json"))

    name = F.col("eventName")
    modify = [ch("+U", 1, new_j)] if mode == "upsert" else [ch("-U", 0, old_j),
                                                             ch("+U", 1, new_j)]
    changes = (F.when(name == "INSERT", F.array(ch("+I", 0, new_j)))
               .when(name == "MODIFY", F.array(*modify))
               .when(name == "REMOVE", F.array(ch("-D", 0, rem_j))))
    et = F.col(event_time).cast("long") if event_time else F.unix_millis(F.current_timestamp())
    return (df.select(pk.alias("pk"), sk.alias("sk"),
                      ddb["SequenceNumber"].alias("sequence_number"), et.alias("event_time"),
                      F.explode(changes).alias("c"))
            .select("c.op", "c.change_seq", "pk", "sk", "c.attributes_json",
                    "sequence_number", "event_time"))
