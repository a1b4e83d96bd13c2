"""Ordered per-key scans that stay balanced when one key is very large.

Every stateful operator of the library is a fold over the rows of a key in a
fixed order.  Most of those folds have a closed form in window functions
(running sums, last non-null value, previous / next row, row number, counts
over the last K rows).  A plain ``Window.partitionBy(key)`` puts a whole key
into one task, which is fine for ordinary keys but not for a key holding a
third of all rows.

``hot_keys()`` measures the keys (a count of the key columns alone, combined
before its shuffle).  Keys of more than ``rows_per_chunk`` rows are hot:
``keyed()`` range-partitions their rows by (key, whole order) into slices of
about equal depth, whatever the order values look like (outliers, many equal
times, nulls), and writes them to the shared checkpoint folder once, so that
no later scan goes back to the input.  ``scan()`` then evaluates the window
functions per ``(key, slice)`` and repairs the slice borders with a carry
computed on a per-slice summary table (one row per slice): prefix sums of
slice totals, the last value of the previous slice, the first value of the
next one, the tail rows of the previous slices.

Results do not depend on the slicing as long as summed expressions are
integers or decimals; operators sum money as DECIMAL (``functions.columns.exact``)
and cast at the end.  Ordinary keys keep the plain plan: one hash exchange on
the key, one sort, windows.  Operators stacked on the same key take the
measurement of the first one (``hot=``) instead of measuring again.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

CHUNK = "_chunk"
# A key with more rows than this is split into slices of at most about this size.
DEFAULT_ROWS_PER_CHUNK = 4_000_000
# Slices are cut for this share of the bound: their borders come from samples.
FILL = 0.8
SAMPLES_PER_SLICE = "1000"
SAMPLE_CONF = "spark.sql.execution.rangeExchange.sampleSizePerPartition"
ROWS_PER_CHUNK_CONF = "spark.eventide.rowsPerChunk"

_UNB = Window.unboundedPreceding
_UNF = Window.unboundedFollowing


@dataclass(frozen=True)
class Keyed:
    """The rows to scan, by key and order: ``df`` holds the keys that take
    the plain single-window plan; ``hot`` (split path only) holds the rows of
    the hot keys, with their slice number and normalised key columns."""

    df: DataFrame
    keys: tuple[str, ...]
    order: tuple[str, ...]
    chunked: bool = False
    hot_keys: int = 0
    extra: dict = field(default_factory=dict)
    hot: DataFrame | None = None

    def drop_columns(self) -> list:
        """Columns of the hot part that are not the caller's."""
        return [CHUNK, *self.extra.get("norm", [])]

    def plain_window(self, by=()) -> Window:
        return Window.partitionBy(*self.keys, *by).orderBy(*self.order)

    def map(self, fn) -> "Keyed":
        """Apply a row-wise DataFrame transformation to both parts."""
        return Keyed(fn(self.df), self.keys, self.order, self.chunked, self.hot_keys,
                     self.extra, None if self.hot is None else fn(self.hot))

    def cluster(self) -> "Keyed":
        """Hash-partition the plain part by the key once, so that scans with
        different ``by`` columns (all containing the key) share that one
        exchange.  Split scans place their own exchange."""
        return Keyed(self.df.repartition(*self.keys), self.keys, self.order, self.chunked,
                     self.hot_keys, self.extra, self.hot)

    def result(self) -> DataFrame:
        if self.hot is None:
            return self.df
        return self.df.unionByName(self.hot.drop(*self.drop_columns()))


def _rows_per_chunk(df: DataFrame, rows_per_chunk: int | None) -> int:
    if rows_per_chunk is not None:
        return int(rows_per_chunk)
    v = df.sparkSession.conf.get(ROWS_PER_CHUNK_CONF, None)
    return int(v) if v else DEFAULT_ROWS_PER_CHUNK


def _normalized(df: DataFrame, c: str, prefix: str) -> dict:
    """Two never-null columns that identify the value of ``c`` (null
    included): ``coalesce(c, default)`` and ``isnull(c)``.  Partitioning and
    joining on them keeps one hash partitioning from window to carry join."""
    dt = df.schema[c].dataType
    if isinstance(dt, (T.NumericType,)):
        default = F.lit(0).cast(dt)
        v = F.col(c)
    elif isinstance(dt, T.StringType):
        default, v = F.lit(""), F.col(c)
    elif isinstance(dt, T.BooleanType):
        default, v = F.lit(False), F.col(c)
    elif isinstance(dt, (T.TimestampType, T.TimestampNTZType, T.DateType)):
        default, v = F.timestamp_millis(F.lit(0)).cast(dt), F.col(c)
    elif isinstance(dt, T.BinaryType):
        default, v = F.lit(bytearray()), F.col(c)
    else:  # nested types: compare their JSON text
        default, v = F.lit(""), F.to_json(F.col(c))
    return {f"{prefix}v": F.coalesce(v, default), f"{prefix}n": F.col(c).isNull()}


def _null_safe_on(left: DataFrame, right: DataFrame, pairs) -> Column:
    cond = None
    for lcol, rcol in pairs:
        c = left[lcol].eqNullSafe(right[rcol])
        cond = c if cond is None else cond & c
    return cond


@dataclass(frozen=True)
class HotKeys:
    """The keys of more than ``limit`` rows: ``table`` (columns ``_hk0``, ...)
    is None if there is none; ``slices`` is how many all of them need."""

    limit: int
    table: DataFrame | None = None
    count: int = 0
    slices: int = 0


def hot_keys(df: DataFrame, keys, rows_per_chunk: int | None = None) -> HotKeys:
    """Measure the keys of ``df``.  Only the key columns are read, counts are
    combined before the shuffle, and the hot ones are checkpointed."""
    limit = _rows_per_chunk(df, rows_per_chunk)
    if limit <= 0:
        return HotKeys(0)
    keys = [keys] if isinstance(keys, str) else list(keys)
    hot = (df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).filter(F.col("_n") > limit)
           .select(*[F.col(k).alias(f"_hk{i}") for i, k in enumerate(keys)],
                   F.ceil(F.col("_n") / F.lit(limit * FILL)).alias("_slices")))
    from eventide.session import ensure_checkpoint_dir
    ensure_checkpoint_dir(df.sparkSession)
    hot = hot.checkpoint(eager=True)
    n, slices = hot.agg(F.count(F.lit(1)), F.sum("_slices")).first()
    if not n:
        return HotKeys(limit)
    return HotKeys(limit, hot.drop("_slices"), n, int(slices))


def keyed(df: DataFrame, keys, order, rows_per_chunk: int | None = None,
          hot: HotKeys | None = None) -> Keyed:
    """Prepare ``df`` for ordered scans per ``keys`` in ``order``; ``order``
    as a whole must be unique within a key.  ``hot`` is the measurement of
    the same keys by an operator below; without it the keys are measured."""
    keys, order = tuple(keys), tuple(order)
    if df.isStreaming:
        raise ValueError("batch form only; use eventide.streaming for streams")
    hot = hot or hot_keys(df, keys, rows_per_chunk)
    if hot.table is None:
        return Keyed(df, keys, order, False)
    on = _null_safe_on(df, hot.table, [(k, f"_hk{i}") for i, k in enumerate(keys)])
    # rows of ordinary keys keep the plain plan; only hot keys are sliced
    cold = df.join(hot.table, on, "left_anti")
    rows = df.join(hot.table, on, "left_semi")
    norm = {}
    for i, kc in enumerate(keys):
        norm.update(_normalized(rows, kc, f"_nk{i}"))
    conf = df.sparkSession.conf
    before = conf.get(SAMPLE_CONF, None)
    conf.set(SAMPLE_CONF, SAMPLES_PER_SLICE)
    try:
        # an explicit number of partitions: adaptive execution must not merge slices
        out = (rows.repartitionByRange(max(2, hot.slices), *keys, *order)
               .withColumn(CHUNK, F.spark_partition_id().cast("long")).withColumns(norm)
               .checkpoint(eager=True))
    finally:
        conf.unset(SAMPLE_CONF) if before is None else conf.set(SAMPLE_CONF, before)
    return Keyed(cold, keys, order, True, hot.count, {"part": list(norm), "norm": list(norm)}, out)


def ttl_epochs(k: Keyed, ttl_ms: int | None) -> Keyed:
    """Event-time state expiry: when a row comes more than ``ttl_ms`` after
    the last row (with a time) of its key, the state has expired and the row
    starts from a fresh one.  Returns the scan keyed by ``keys + (_epoch,)``,
    one epoch per stretch of live state; ``order[0]`` is the event time."""
    if not ttl_ms:
        return k
    t = F.col(k.order[0])
    k = scan(k, lasts_before={"_ttl_prev": t})
    k = k.map(lambda d: d.withColumn("_ttl_new", F.coalesce(
        t - F.col("_ttl_prev") > int(ttl_ms), F.lit(False)).cast("int")))
    k = scan(k, sums={"_epoch": F.col("_ttl_new")})
    k = k.map(lambda d: d.drop("_ttl_prev", "_ttl_new"))
    extra = dict(k.extra)
    if k.hot is not None:
        # slices stay those of the key; the epoch only separates the scans
        extra.update(part=[*extra["part"], "_epoch"], partitioned_by=None)
    return Keyed(k.df, k.keys + ("_epoch",), k.order, k.chunked, k.hot_keys, extra, k.hot)


def scan(k: Keyed, *, by=(), rn: str | None = None, sums=None, sums_before=None,
         lasts=None, lasts_before=None, lags=None, leads=None, firsts=None,
         maxes_before=None, recent=None, backs=None) -> Keyed:
    """Add running per-key columns, computed in ``k.order`` within
    ``k.keys + by``:

    rn            1-based row number
    sums          {name: expr}  running sum including the row (null as 0)
    sums_before   {name: expr}  running sum of the rows before (null as 0)
    lasts         {name: expr}  last non-null value, row included
    lasts_before  {name: expr}  last non-null value before the row
    lags / leads  {name: expr}  value of the previous / next row
    firsts        {name: expr}  value of the first row
    maxes_before  {name: expr}  max over the rows before
    recent        {name: (predicate, K)}  rows among the K previous rows
                  for which the predicate is true
    backs         {name: (expr, K)}  value of the K-th previous row
    """
    sums, sums_before = sums or {}, sums_before or {}
    lasts, lasts_before = lasts or {}, lasts_before or {}
    lags, leads, firsts = lags or {}, leads or {}, firsts or {}
    maxes_before, recent, backs = maxes_before or {}, recent or {}, backs or {}
    by = tuple(by)
    plain = _scan_plain(k, by, rn, sums, sums_before, lasts, lasts_before, lags, leads, firsts,
                        maxes_before, recent, backs)
    if k.hot is None:
        return plain
    return _scan_chunked(plain, by, rn, sums, sums_before, lasts, lasts_before, lags, leads,
                         firsts, maxes_before, recent, backs)


def _scan_plain(k, by, rn, sums, sums_before, lasts, lasts_before, lags, leads, firsts,
                maxes_before, recent, backs) -> Keyed:
    w = k.plain_window(by)
    cols = {}
    if rn:
        cols[rn] = F.row_number().over(w)
    for n, e in sums.items():
        cols[n] = F.coalesce(F.sum(e).over(w.rowsBetween(_UNB, 0)), F.lit(0))
    for n, e in sums_before.items():
        cols[n] = F.coalesce(F.sum(e).over(w.rowsBetween(_UNB, -1)), F.lit(0))
    for n, e in lasts.items():
        cols[n] = F.last(e, True).over(w.rowsBetween(_UNB, 0))
    for n, e in lasts_before.items():
        cols[n] = F.last(e, True).over(w.rowsBetween(_UNB, -1))
    for n, e in lags.items():
        cols[n] = F.lag(e).over(w)
    for n, e in leads.items():
        cols[n] = F.lead(e).over(w)
    for n, e in firsts.items():
        cols[n] = F.first(e).over(w.rowsBetween(_UNB, 0))
    for n, e in maxes_before.items():
        cols[n] = F.max(e).over(w.rowsBetween(_UNB, -1))
    for n, (p, kk) in recent.items():
        cols[n] = F.count(F.when(p, 1)).over(w.rowsBetween(-kk, -1))
    for n, (e, kk) in backs.items():
        cols[n] = F.lag(e, kk).over(w)
    return Keyed(k.df.withColumns(cols), k.keys, k.order, k.chunked, k.hot_keys, k.extra,
                 k.hot)


def _scan_chunked(k, by, rn, sums, sums_before, lasts, lasts_before, lags, leads,
                  firsts, maxes_before, recent, backs) -> Keyed:
    bnorm = {}
    for j, b in enumerate(by):
        bnorm.update(_normalized(k.hot, b, f"_nb{j}"))
    base = k.hot.withColumns(bnorm) if bnorm else k.hot
    grp = [*k.extra["part"], *bnorm]
    part = [*grp, CHUNK]
    if k.extra.get("partitioned_by") != tuple(part):
        # one explicit exchange on the slice keys: the windows and the carry
        # join share it (the per-slice summary, which needs fewer columns, is
        # pruned by Catalyst into its own narrower exchange of the hot rows)
        base = base.repartition(*part)
    wc = Window.partitionBy(*part).orderBy(*k.order)
    ostruct = F.struct(*[F.col(c) for c in k.order])
    local = {"_l__rn": F.row_number().over(wc),
             "_l__last": F.lead(F.lit(1)).over(wc).isNull()}
    for n, e in sums.items():
        local[f"_l_{n}"] = F.sum(e).over(wc.rowsBetween(_UNB, 0))
    for n, e in sums_before.items():
        local[f"_l_{n}"] = F.sum(e).over(wc.rowsBetween(_UNB, -1))
    for n, e in lasts.items():
        local[f"_l_{n}"] = F.last(e, True).over(wc.rowsBetween(_UNB, 0))
    for n, e in lasts_before.items():
        local[f"_l_{n}"] = F.last(e, True).over(wc.rowsBetween(_UNB, -1))
    for n, e in lags.items():
        local[f"_l_{n}"] = F.lag(e).over(wc)
    for n, e in leads.items():
        local[f"_l_{n}"] = F.lead(e).over(wc)
    for n, e in maxes_before.items():
        local[f"_l_{n}"] = F.max(e).over(wc.rowsBetween(_UNB, -1))
    for n, (p, kk) in recent.items():
        local[f"_l_{n}"] = F.count(F.when(p, 1)).over(wc.rowsBetween(-kk, -1))
    for n, (e, kk) in backs.items():
        local[f"_l_{n}"] = F.lag(e, kk).over(wc)
    tails = {**recent, **backs}
    for n, (_, kk) in tails.items():
        local[f"_t_{n}"] = F.lead(F.lit(1), kk).over(wc).isNull()
    ldf = base.withColumns(local)

    # one summary row per non-empty chunk
    aggs = [F.count(F.lit(1)).alias("_s__cnt")]
    for n, e in {**sums, **sums_before}.items():
        aggs.append(F.sum(e).alias(f"_s_{n}"))
    for n, e in {**lasts, **lasts_before}.items():
        aggs.append(F.max_by(e, F.when(e.isNotNull(), ostruct)).alias(f"_s_{n}"))
    for n, e in lags.items():
        aggs.append(F.max_by(e, ostruct).alias(f"_s_{n}"))
    for n, e in {**leads, **firsts}.items():
        aggs.append(F.min_by(e, ostruct).alias(f"_s_{n}"))
    for n, e in maxes_before.items():
        aggs.append(F.max(e).alias(f"_s_{n}"))
    for n, (p, kk) in tails.items():
        tail = F.collect_list(F.when(F.col(f"_t_{n}"), F.struct(ostruct.alias("o"),
                                                                 p.alias("p"))))
        aggs.append(F.transform(F.array_sort(tail), lambda x: x["p"]).alias(f"_s_{n}"))
    summ = ldf.groupBy(*part).agg(*aggs)

    s = Window.partitionBy(*grp).orderBy(CHUNK)
    carry = {"_c__cnt": F.sum("_s__cnt").over(s.rowsBetween(_UNB, -1))}
    for n in {**sums, **sums_before}:
        carry[f"_c_{n}"] = F.sum(f"_s_{n}").over(s.rowsBetween(_UNB, -1))
    for n in {**lasts, **lasts_before}:
        carry[f"_c_{n}"] = F.last(f"_s_{n}", True).over(s.rowsBetween(_UNB, -1))
    for n in lags:
        carry[f"_c_{n}"] = F.lag(f"_s_{n}").over(s)
    for n in leads:
        carry[f"_c_{n}"] = F.lead(f"_s_{n}").over(s)
    for n in firsts:
        carry[f"_c_{n}"] = F.first(f"_s_{n}").over(s.rowsBetween(_UNB, 0))
    for n in maxes_before:
        carry[f"_c_{n}"] = F.max(f"_s_{n}").over(s.rowsBetween(_UNB, -1))
    for n, (_, kk) in tails.items():
        prev = F.array_sort(F.collect_list(F.struct(F.col(CHUNK).alias("c"),
                                                    F.col(f"_s_{n}").alias("t")))
                            .over(s.rowsBetween(-kk, -1)))
        flat = F.flatten(F.transform(prev, lambda x: x["t"]))
        carry[f"_c_{n}"] = F.slice(flat, F.greatest(F.size(flat) - kk + 1, F.lit(1)),
                                   F.lit(kk))
    cdf = summ.withColumns(carry).select(
        *[F.col(c).alias(f"_j{i}") for i, c in enumerate(part)], *carry.keys())

    on = None
    for i, c in enumerate(part):  # never-null columns: a plain equi-join that
        e = ldf[c] == cdf[f"_j{i}"]  # keeps the window's hash partitioning
        on = e if on is None else on & e
    joined = ldf.join(cdf, on, "left")
    lrn = F.col("_l__rn")
    out = {}
    if rn:
        out[rn] = lrn + F.coalesce(F.col("_c__cnt"), F.lit(0))
    for n in {**sums, **sums_before}:
        out[n] = F.coalesce(F.col(f"_l_{n}"), F.lit(0)) + F.coalesce(F.col(f"_c_{n}"), F.lit(0))
    for n in {**lasts, **lasts_before}:
        out[n] = F.coalesce(F.col(f"_l_{n}"), F.col(f"_c_{n}"))
    for n in lags:
        out[n] = F.when(lrn == 1, F.col(f"_c_{n}")).otherwise(F.col(f"_l_{n}"))
    for n in leads:
        out[n] = F.when(F.col("_l__last"), F.col(f"_c_{n}")).otherwise(F.col(f"_l_{n}"))
    for n in firsts:
        out[n] = F.col(f"_c_{n}")
    for n in maxes_before:
        out[n] = F.greatest(F.col(f"_l_{n}"), F.col(f"_c_{n}"))
    for n, (_, kk) in recent.items():
        c = F.col(f"_c_{n}")
        need = F.lit(kk) - lrn + 1
        from_prev = F.size(F.filter(c, lambda x, i: x & (i >= F.size(c) - need)))
        out[n] = F.col(f"_l_{n}") + F.when(lrn <= kk, F.coalesce(from_prev, F.lit(0))) \
            .otherwise(F.lit(0))
    for n, (_, kk) in backs.items():
        c = F.col(f"_c_{n}")
        out[n] = F.when(lrn > kk, F.col(f"_l_{n}")).otherwise(F.get(c, F.size(c) - F.lit(kk) + lrn - 1))
    drop = [c for c in joined.columns if c.startswith(("_l_", "_t_", "_c_", "_j"))] + list(bnorm)
    extra = dict(k.extra, partitioned_by=tuple(part) if not bnorm else None)
    return Keyed(k.df, k.keys, k.order, k.chunked, k.hot_keys, extra,
                 joined.withColumns(out).drop(*drop))
