"""Dynamic pricing: a per-SKU price recurrence with feedback.

The new price depends on the previous price through thresholds, so there is
no window-function form.  The plan is a keyed fold: one hash exchange on the
SKU, a sort by (sku, time, seq) inside each partition (Spark's external sort,
spills as needed), then ``mapInArrow`` walks the sorted rows carrying the
state of the current SKU across Arrow batches.  Memory is bounded by the
batch size, not by the key size.

A SKU of more than ``rows_per_chunk`` rows is folded slice by slice: its rows
are range-partitioned in order, each slice is a task of its own, and the five
values of its state go from one slice to the next through a written table.  The
slices of one SKU still follow one another, as the recurrence demands.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from eventide.functions.columns import T_MS, interval_ms
from eventide.operators._common import SEQ, with_time_seq
from eventide.plans.keyed import CHUNK, HotKeys, keyed
from eventide.session import ensure_checkpoint_dir
from eventide.streaming.ops import WATERMARK, delays, watermarked

# Fixed values that must equal the reference's defaults.
MIN_PRICE_CHANGE = 0.02
INVENTORY_THRESHOLD = 10
DEMAND_THRESHOLD = 100
LOW_INVENTORY_CAP, LOW_INVENTORY_RAISE = 1.2, 1.15
HIGH_DEMAND_CAP, HIGH_DEMAND_RAISE = 1.1, 1.08
COMPETITOR_TOLERANCE, COMPETITOR_UNDERCUT = 0.05, 0.98

OUT_SCHEMA = ("sku string, newPrice double, oldPrice double, reason string, "
              "timestamp bigint, seq {seq}")


def price_step(state, side, qty, base, cprice, inventory_threshold, demand_threshold,
               min_change):
    """Apply one row to ``state = [price, inventory, competitor, demand]``;
    return (newPrice, oldPrice, reason) when the price changes, else None."""
    if side == 0:
        state[1] = qty
        state[3] += 1
        if state[0] is None and base is not None and base == base:
            state[0] = base
    else:
        state[2] = None if cprice is None or cprice != cprice else cprice
    price, inv, comp = state[0], state[1], state[2]
    if price is None:
        return None
    new = price
    reasons = []
    if inv is not None and inv < inventory_threshold and new < price * LOW_INVENTORY_CAP:
        new = price * LOW_INVENTORY_RAISE
        reasons.append("LOW_INVENTORY")
    if state[3] > demand_threshold and new < price * HIGH_DEMAND_CAP:
        new = price * HIGH_DEMAND_RAISE
        reasons.append("HIGH_DEMAND")
        state[3] = 0
    if comp is not None and abs(new - comp) > comp * COMPETITOR_TOLERANCE:
        new = comp * COMPETITOR_UNDERCUT
        reasons.append("COMPETITOR_MATCH")
    if abs(new - price) > price * min_change:
        state[0] = new
        return new, price, ",".join(reasons) if reasons else "BASELINE"
    return None


# What a SKU's fold hands on from one slice of its rows to the next.
STATE = "_s_price double, _s_inv int, _s_comp double, _s_dem int, _s_t bigint"
_STATE = [c.split()[0] for c in STATE.split(", ")]


def _fold(inventory_threshold, demand_threshold, min_change, ttl_ms=None, carry=False):
    """Fold sorted rows.  ``carry``: rows bring the state that their SKU's
    earlier slices ended with (null at the first), and one more row per SKU,
    without an emission, takes the state on."""
    names = ["sku", "newPrice", "oldPrice", "reason", "timestamp", "seq", *(_STATE if carry else [])]

    def run(batches):
        import pyarrow as pa
        cur, state, last_t = None, None, None
        schema = None

        def end():
            return (cur, None, None, None, None, None, *state, last_t)

        for b in batches:
            if schema is None:
                types = [pa.string(), pa.float64(), pa.float64(), pa.string(), pa.int64(), b.schema.field("_q").type,
                         pa.float64(), pa.int32(), pa.float64(), pa.int32(), pa.int64()]
                schema = pa.schema(list(zip(names, types)))
            out = []
            cols = ["_sku", "_side", "_qty", "_base", "_cprice", "_t", "_q", *(_STATE if carry else [])]
            for sku, side, qty, base, cprice, t, seq, *old in zip(*(b.column(c).to_pylist() for c in cols)):
                if state is None or sku != cur:
                    if carry and state is not None:
                        out.append(end())
                    known = carry and old[4] is not None
                    cur, state, last_t = sku, old[:4] if known else [None, 0, None, 0], old[4] if known else t
                if ttl_ms and t - last_t > ttl_ms:
                    state = [None, 0, None, 0]
                last_t = t
                hit = price_step(state, side, qty, base, cprice, inventory_threshold,
                                 demand_threshold, min_change)
                if hit is not None:
                    out.append((sku, *hit, t, seq, *([None] * len(_STATE) if carry else [])))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*out), schema)], schema=schema)
        if carry and state is not None:
            yield pa.RecordBatch.from_arrays([pa.array([v], f.type) for v, f in zip(end(), schema)], schema=schema)
    return run


def _fold_slices(k, args, ttl, out_schema: str) -> DataFrame:
    """The rows of hot SKUs: round n folds the n-th slice of each, all SKUs at
    once, from the states that the round before has written.  No task holds
    more than a slice, and a lost one is folded again from its own slice."""
    spark = k.hot.sparkSession
    order = Window.partitionBy("_sku").orderBy(CHUNK)
    turn = k.hot.select("_sku", CHUNK).distinct().withColumn("_turn", F.row_number().over(order)) \
        .select(F.col("_sku").alias("_of"), F.col(CHUNK).alias("_slice"), "_turn")
    on = F.col("_sku").eqNullSafe(F.col("_of")) & (F.col(CHUNK) == F.col("_slice"))
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/pricing-{uuid.uuid4().hex}"
    cols = ["_sku", "_side", "_qty", "_base", "_cprice", "_t", "_q"]
    k.hot.join(turn, on).select(*cols, "_turn").write.partitionBy("_turn").parquet(f"{path}/rows")
    rows = spark.read.parquet(f"{path}/rows")
    last = rows.agg(F.max("_turn")).first()[0]
    state = spark.createDataFrame([], f"sku string, {STATE}")
    for n in range(1, last + 1):
        now = rows.filter(F.col("_turn") == n)
        one = now.join(state, F.col("_sku").eqNullSafe(F.col("sku")), "left").select(*cols, *_STATE) \
            .repartition("_sku").sortWithinPartitions("_sku", "_t", "_side", "_q") \
            .mapInArrow(_fold(*args, ttl, carry=True), f"{out_schema}, {STATE}")
        one.write.parquet(f"{path}/out/turn={n}")
        done = spark.read.schema(f"{out_schema}, {STATE}").parquet(f"{path}/out/turn={n}")
        state = done.filter("_s_t is not null").select("sku", *_STATE)
    return spark.read.schema(f"{out_schema}, {STATE}").parquet(*[f"{path}/out/turn={n}" for n in range(1, last + 1)]) \
        .filter("_s_t is null").drop(*_STATE)


def dynamic_pricing(inventory: DataFrame, competitor: DataFrame | None = None, *,
                    key: str = "sku", quantity: str = "quantity",
                    base_price: str = "basePrice", price: str = "price",
                    time: str = "ts", inventory_seq: str | None = None,
                    competitor_seq: str | None = None,
                    inventory_threshold: int = INVENTORY_THRESHOLD,
                    demand_threshold: int = DEMAND_THRESHOLD,
                    min_change: float = MIN_PRICE_CHANGE,
                    stream_order: str = "arrival", state_ttl=None, watermark=WATERMARK,
                    rows_per_chunk: int | None = None, hot: HotKeys | None = None) -> DataFrame:
    """Output: sku, newPrice, oldPrice, reason, timestamp (event ms), seq.

    Inventory rows set the stock level, count one demand signal and give the
    starting price; competitor rows set the competitor price (optional
    input).  After each row: low stock raises by 15 %, more than
    ``demand_threshold`` signals raise by 8 % (and reset the counter), a
    competitor price more than 5 % away sets 98 % of it; a change above
    ``min_change`` is emitted and becomes the price.  At equal times
    inventory rows go before competitor rows.  ``state_ttl`` (the reference
    keeps 7 days): after a longer silence a SKU starts from a fresh state.

    On a streaming DataFrame the same call runs a transformWithState
    processor; ``watermark`` bounds lateness (one delay, or one for each
    input; an input that lags behind the other holds it back) and ``stream_order`` is
    'arrival' (fold each micro-batch as it comes) or 'event' (buffer until
    the watermark passes, then fold in event-time order)."""
    ttl = interval_ms(state_ttl) if state_ttl else None
    inv = with_time_seq(inventory, time, inventory_seq, "dynamic_pricing(inventory)",
                        need=(key, quantity, base_price))
    late = delays(watermark, 1 if competitor is None else 2)
    evt = []
    if inv.isStreaming or competitor is not None and competitor.isStreaming:
        inv, evt = watermarked(inv, late[0]), ["_evt"]
    parts = [inv.select(F.col(key).cast("string").alias("_sku"), F.lit(0).alias("_side"),
                        F.col(quantity).cast("int").alias("_qty"),
                        F.col(base_price).cast("double").alias("_base"),
                        F.lit(None).cast("double").alias("_cprice"),
                        F.col(T_MS).alias("_t"), F.col(SEQ).alias("_q"), *evt)]
    if competitor is not None:
        comp = with_time_seq(competitor, time, competitor_seq,
                             "dynamic_pricing(competitor)", need=(key, price))
        comp = watermarked(comp, late[1]) if evt else comp
        parts.append(comp.select(F.col(key).cast("string").alias("_sku"),
                                 F.lit(1).alias("_side"), F.lit(None).cast("int").alias("_qty"),
                                 F.lit(None).cast("double").alias("_base"),
                                 F.col(price).cast("double").alias("_cprice"),
                                 F.col(T_MS).alias("_t"),
                                 F.col(SEQ).alias("_q"), *evt))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    if u.isStreaming:
        from eventide.streaming import ops as st
        return st.dynamic_pricing(u, (int(inventory_threshold), int(demand_threshold),
                                      float(min_change)), late[0], order=stream_order, ttl_ms=ttl)
    args = (int(inventory_threshold), int(demand_threshold), float(min_change))
    out_schema = OUT_SCHEMA.format(seq=u.schema["_q"].dataType.simpleString())
    k = keyed(u, ["_sku"], ["_t", "_side", "_q"], rows_per_chunk, hot)
    cold = k.df.repartition("_sku").sortWithinPartitions("_sku", "_t", "_side", "_q") \
        .mapInArrow(_fold(*args, ttl), out_schema)
    return cold if k.hot is None else cold.unionByName(_fold_slices(k, args, ttl, out_schema))
