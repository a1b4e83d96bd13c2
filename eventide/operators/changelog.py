"""Changelog operators: audit trail of a changelog, latest row per key, the
changelog of a latest-row view, and materialising / versioning a changelog.

A changelog is a DataFrame with an ``op`` column in {+I, -U, +U, -D}."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.columns import T_MS
from eventide.operators._common import SEQ, last_of, only_for_streams, with_time_seq
from eventide.functions.columns import interval_ms
from eventide.plans.keyed import HotKeys, Keyed, keyed, scan, ttl_epochs
from eventide.streaming.ops import WATERMARK

OPS = ("+I", "-U", "+U", "-D")


def changelog_audit(df: DataFrame, *, key="currency", rate: str = "rate",
                    time: str = "update_time", op: str = "op", seq: str | None = None,
                    rate_type: str = "decimal(10,4)",
                    rows_per_chunk: int | None = None, hot: HotKeys | None = None,
                    watermark: str | None = WATERMARK,
                    state_ttl=None, stream_order: str = "arrival",
                    history: DataFrame | None = None) -> DataFrame:
    """Output: currency (key; one column or a list), change_type, old_rate,
    new_rate, change_time.

    INSERT -> (null, rate); UPDATE_AFTER -> (remembered, rate); UPDATE_BEFORE
    ignored; DELETE -> (remembered, null) and forgets the rate.
    ``state_ttl`` (the reference keeps 7 days): after a longer silence the
    remembered rate is gone.

    On a streaming DataFrame the same call runs a transformWithState
    processor; ``watermark`` bounds lateness and ``stream_order`` is
    'arrival' (fold each micro-batch as it comes) or 'event' (buffer until
    the watermark passes, then fold in event-time order).

    ``history``: on a stream, a batch DataFrame of the input's columns whose
    rows come before all of the stream's: each key starts with the state that
    folding them leaves (computed as a batch job, handed over in the first
    micro-batch).  Each key starts with the rate remembered after it."""
    keys = [key] if isinstance(key, str) else list(key)
    opc = F.col(op)

    def changes(table):
        d = with_time_seq(table, time, seq, "changelog_audit", need=(*keys, rate, op))
        return d.filter(opc.isin("+I", "+U", "-D")).select(
            *keys, op, F.col(rate).cast(rate_type).alias("_rate"), F.col(time).alias("_time"),
            T_MS, SEQ)

    d = changes(df)
    if d.isStreaming:
        from eventide.streaming import ops as st
        state = None
        if history is not None:     # the last row alone decides, whatever expired before it
            state = last_of(Keyed(changes(history), tuple(keys), (T_MS, SEQ)), [T_MS, SEQ],
                            prev=F.when(opc != "-D", F.col("_rate").cast("string")))
        return st.changelog_audit(d.withColumn("_op", opc), keys,
                                  df.schema[time].dataType.simpleString(), rate_type, watermark,
                                  interval_ms(state_ttl) if state_ttl else None,
                                  stream_order, state)
    only_for_streams(history, "changelog_audit")
    k = keyed(d, keys, [T_MS, SEQ], rows_per_chunk, hot)
    k = ttl_epochs(k, interval_ms(state_ttl) if state_ttl else None)
    k = scan(k, lags={"_prev": F.when(opc != "-D", F.col("_rate"))})
    return k.result().select(
        *keys,
        F.when(opc == "+I", "INSERT").when(opc == "+U", "UPDATE").otherwise("DELETE")
        .alias("change_type"),
        F.when(opc == "+I", F.lit(None)).otherwise(F.col("_prev")).cast(rate_type)
        .alias("old_rate"),
        F.when(opc == "-D", F.lit(None)).otherwise(F.col("_rate")).cast(rate_type)
        .alias("new_rate"),
        F.col("_time").alias("change_time"))


def latest_by_key(df: DataFrame, keys, *, time: str, seq: str | None = None) -> DataFrame:
    """``ROW_NUMBER() OVER (PARTITION BY keys ORDER BY time DESC, seq DESC) = 1``
    as a max_by aggregate: partial aggregation before the shuffle, so a hot
    key costs one row per map task instead of one huge sort."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    cols = df.columns
    d = with_time_seq(df, time, seq, "latest_by_key", need=keys, null_time=True)
    row = F.struct(*[F.col(c) for c in cols])
    agg = d.groupBy(*keys).agg(F.max_by(row, F.struct(T_MS, SEQ)).alias("_row"))
    return agg.select("_row.*")


def latest_changelog(df: DataFrame, keys, *, time: str, seq: str,
                     rows_per_chunk: int | None = None,
                        hot: HotKeys | None = None) -> DataFrame:
    """Changes of the latest-row-per-key view as rows arrive in ``seq`` order:
    a row replaces the current one when its time is >= the newest time seen
    for the key (ties: the later row wins).  The first row is ``+I``, each
    replacement emits ``-U`` (old row) then ``+U`` (new row); never ``-D``.
    Output: op, change_seq (0, 1 within one replacement), then the row."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    cols = df.columns
    d = with_time_seq(df, time, seq, "latest_changelog", need=keys, null_time=True)
    if d.isStreaming:
        from eventide.streaming import ops as st
        s = d.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)], T_MS, SEQ,
                     *cols)
        return st.latest_changelog(s, [f"_k{i}" for i in range(len(keys))], cols)
    row = F.struct(*[F.col(c) for c in cols])
    d = d.select(*[F.col(c).alias(f"_k{i}") for i, c in enumerate(keys)], row.alias("_row"),
                 T_MS, SEQ)
    kk = [f"_k{i}" for i in range(len(keys))]
    k = keyed(d, kk, [SEQ], rows_per_chunk, hot)
    k = scan(k, maxes_before={"_mx": F.col(T_MS)})
    # Dropping superseded rows keeps the partitioning (and slices): the second
    # scan needs no new exchange or key statistics.
    k2 = scan(k.map(lambda d: d.filter(F.col("_mx").isNull() | (F.col(T_MS) >= F.col("_mx")))
                    .drop("_mx")), lags={"_old": F.col("_row")})
    r = k2.result()
    ch = F.when(F.col("_old").isNull(),
                F.array(F.struct(F.lit("+I").alias("op"), F.lit(0).alias("change_seq"),
                                 F.col("_row").alias("r")))) \
        .otherwise(F.array(
            F.struct(F.lit("-U").alias("op"), F.lit(0).alias("change_seq"),
                     F.col("_old").alias("r")),
            F.struct(F.lit("+U").alias("op"), F.lit(1).alias("change_seq"),
                     F.col("_row").alias("r"))))
    return (r.select(F.explode(ch).alias("x"))
            .select("x.op", "x.change_seq", "x.r.*"))


def materialize_changelog(df: DataFrame, keys, *, op: str = "op", time: str,
                          seq: str | None = None) -> DataFrame:
    """Current table state from a changelog: per key the last change, kept
    unless it is a delete (documented use case of the CDC emitter)."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    last = latest_by_key(df.filter(F.col(op) != "-U"), keys, time=time, seq=seq)
    return last.filter(F.col(op) != "-D").drop(op)


def scd2_from_changelog(df: DataFrame, keys, *, op: str = "op", time: str,
                        seq: str | None = None,
                        rows_per_chunk: int | None = None,
                        hot: HotKeys | None = None, watermark: str | None = WATERMARK,
                        stream_order: str = "arrival") -> DataFrame:
    """Slowly-changing-dimension type 2 rows from a changelog: every +I / +U
    image becomes a version valid from its time until the next change of the
    key (``valid_to`` null for the current version).

    On a streaming DataFrame the versions come as a changelog: op, change_seq,
    ``version`` (from 1 per key) and the row; ``+I`` opens a version, ``+U``
    closes it.  ``sources.materialized`` keeps that as a table by keys and
    version, which then holds the batch result."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    cols = [c for c in df.columns if c != op]
    d = with_time_seq(df.filter(F.col(op) != "-U"), time, seq, "scd2_from_changelog",
                      need=keys, null_time=stream_order != "event")
    if d.isStreaming:
        from eventide.streaming import ops as st
        kk = [f"_k{i}" for i in range(len(keys))]
        s = d.select(*[F.col(c).alias(k) for c, k in zip(keys, kk)], F.col(op).alias("_op"), T_MS, SEQ, *cols)
        return st.scd2_changes(s, kk, cols, time, watermark, stream_order)
    k = keyed(d, keys, [T_MS, SEQ], rows_per_chunk, hot)
    k = scan(k, leads={"_valid_to": F.col(time)})
    r = k.result().filter(F.col(op).isin("+I", "+U"))
    return r.select(*cols, F.col(time).alias("valid_from"),
                    F.col("_valid_to").alias("valid_to"))
