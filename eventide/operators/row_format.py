"""Schema-agnostic row rendering with a running count of null patterns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from eventide.functions.columns import T_MS, epoch_ms, interval_ms
from eventide.functions.render import (java_text, runtime_type_name, sql_type_name,
                                        truncate_text)
from eventide.operators._common import SEQ
from eventide.plans.keyed import HotKeys, hot_keys, keyed, scan
from eventide.streaming.ops import WATERMARK


def _has_map(dt: T.DataType) -> bool:
    if isinstance(dt, T.StructType):
        return any(_has_map(f.dataType) for f in dt.fields)
    return isinstance(dt, T.MapType) or isinstance(dt, T.ArrayType) and _has_map(dt.elementType)


def row_formatter(df: DataFrame, keys, *, order: str, type_names: str = "runtime",
                  time: str | None = None, state_ttl=None, rows_per_chunk: int | None = None,
                  hot: HotKeys | None = None, watermark: str | None = WATERMARK,
                  stream_order: str = "arrival") -> DataFrame:
    """Output: keys ++ formatted_row, schema_info, distinct_patterns BIGINT.

    formatted_row = ``[k=v, ...] => {c=v, ...}`` in schema order, null as
    ``null``, texts longer than 50 cut to 47 chars + ``...``.  schema_info
    names each column's runtime type (``NULL`` for a null value), or its SQL
    type with ``type_names='sql'``.  Nested values are rendered at any depth as the
    runtime prints them (``functions.render.java_text``).  distinct_patterns counts the null/set
    patterns seen so far for the key (row included), in ``order``; rows of equal
    ``order`` follow a hash of the row.

    ``state_ttl`` (the reference keeps patterns 24 hours) needs ``time``: rows
    are counted in (time, order), and a pattern that no row of the key has had
    for longer than that no longer counts until it comes again.  Rows without
    a time then take no part.

    A pattern counts from its first row on, that is a running sum of first-row
    marks; with a TTL each stretch of a pattern's use adds one at its first row
    and takes one away when it expires.  Both are keyed scans, so a key of any
    size and with any number of patterns is counted slice by slice."""
    keys = [keys] if isinstance(keys, str) else list(keys)
    if order not in df.columns:
        raise ValueError(f"row_formatter: order column {order!r} missing")
    fields = df.schema.fields
    kset = set(keys)

    def part(f):
        v = java_text(F.col(f.name), f.dataType)
        return F.concat(F.lit(f.name + "="),
                        F.when(F.col(f.name).isNull(), F.lit("null"))
                        .otherwise(truncate_text(v)))

    tname = runtime_type_name if type_names == "runtime" else sql_type_name
    formatted = F.concat(
        F.lit("["), F.concat_ws(", ", *[part(f) for f in fields if f.name in kset]),
        F.lit("] => {"), F.concat_ws(", ", *[part(f) for f in fields if f.name not in kset]),
        F.lit("}"))
    if type_names == "runtime":
        schema_info = F.concat_ws(", ", *[
            F.concat(F.lit(f.name + ":"), F.when(F.col(f.name).isNull(), F.lit("NULL"))
                     .otherwise(F.lit(tname(f.dataType)))) for f in fields])
    else:
        schema_info = F.lit(", ".join(f"{f.name}:{tname(f.dataType)}" for f in fields))
    # The null/set signature as bit masks (62 columns per long): the same
    # grouping as the "name:SET|name:NULL" text, far cheaper to sort on.
    names = [f.name for f in fields]
    groups = [names[j:j + 62] for j in range(0, len(names), 62)]
    mcols = [f"_m{g}" for g in range(len(groups))]
    mask_exprs = [sum((F.col(c).isNull().cast("long") * (1 << i) for i, c in enumerate(grp)),
                      F.lit(0)) for grp in groups]
    masks = [m.alias(name) for m, name in zip(mask_exprs, mcols)]
    ttl = interval_ms(state_ttl) if state_ttl else None
    if ttl and time is None:
        raise ValueError("row_formatter: state_ttl needs a time column")
    if ttl:
        df = df.withColumn(T_MS, epoch_ms(df, time)).filter(F.col(T_MS).isNotNull())
    if df.isStreaming:
        from eventide.streaming import ops as st
        sig = F.concat_ws("|", *[m.cast("string") for m in mask_exprs])
        s = df.select(*keys, F.col(order).alias("_ord"), formatted.alias("formatted_row"),
                      schema_info.alias("schema_info"), sig.alias("_sig"), *([T_MS] if ttl else []))
        return st.pattern_count(s, keys, ttl, watermark, stream_order)
    tie = F.xxhash64(*[F.to_json(F.struct(f.name)) if _has_map(f.dataType) else F.col(f.name) for f in fields])
    d = df.withColumns({SEQ: tie, **dict(zip(mcols, mask_exprs))})
    # texts are rendered after the scans: only input columns travel through them
    hot = hot or hot_keys(d, keys, rows_per_chunk)
    if ttl:
        counted = _expiring(d, keys, [T_MS, order, SEQ], mcols, ttl, hot)
    else:
        k = scan(keyed(d, keys, [order, SEQ], rows_per_chunk, hot), by=mcols, rn="_rn")
        k = k.map(lambda x: x.withColumn("_new", (F.col("_rn") == 1).cast("int")))
        counted = scan(k, sums={"_n": F.col("_new")}).result()
    return counted.select(
        *[F.col(k) for k in keys], formatted.alias("formatted_row"),
        schema_info.alias("schema_info"), F.col("_n").cast("long").alias("distinct_patterns"))


def _expiring(d: DataFrame, keys: list, order: list, mcols: list, ttl: int, hot: HotKeys) -> DataFrame:
    """``d`` with ``_n``, the patterns alive at each row.  A use more than
    ``ttl`` after the last one of its pattern opens a stretch (+1); the last
    use before such a gap closes it (-1) one TTL later, after the rows that
    come at that very time."""
    t = F.col(T_MS)
    k = scan(keyed(d, keys, order, hot=hot), by=mcols, lags={"_pt": t}, leads={"_nt": t})
    used = k.result().withColumn("_step", F.coalesce(t - F.col("_pt") > ttl, F.lit(True)).cast("int")) \
        .withColumn("_gone", F.lit(0))
    ends = used.filter(F.coalesce(F.col("_nt") - t > ttl, F.lit(True))) \
        .withColumns({T_MS: t + ttl, "_step": F.lit(-1), "_gone": F.lit(1)})
    rest = [c for c in used.columns if c not in (*keys, *order, "_step", "_gone")]
    ends = ends.withColumns({c: F.lit(None).cast(used.schema[c].dataType) for c in rest})
    both = used.unionByName(ends)
    k = scan(keyed(both, keys, [T_MS, "_gone", *order[1:]], hot=hot), sums={"_n": F.col("_step")})
    return k.result().filter("_gone = 0")
