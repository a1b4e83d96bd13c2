"""Input preparation shared by the keyed operators."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.functions.columns import T_MS, epoch_ms, require_columns

SEQ = "_q"  # internal unique tie-break within a key


def with_time_seq(df: DataFrame, time: str | None, seq: str | None, what: str,
                  need=(), null_time: bool = False) -> DataFrame:
    """Add ``_t`` (epoch ms) and ``_q`` (tie-break).  Without ``seq`` the
    tie-break is a hash of the whole row: deterministic under recomputation,
    and equal only for identical rows.

    A row without an event time has no place in the order: it takes no part,
    in batch and on streams alike.  ``null_time`` keeps it, as the earliest,
    for the relational operators."""
    require_columns(df, [c for c in (time, seq, *need) if c], what)
    if time is None and seq is None:
        raise ValueError(f"{what}: without a time column, seq is the order and must be given")
    cols = {}
    if time is not None:
        cols[T_MS] = epoch_ms(df, time)
    if seq is not None:
        cols[SEQ] = F.col(seq)
    else:
        cols[SEQ] = F.xxhash64(*[F.col(c) for c in df.columns])
    df = df.withColumns(cols)
    return df.filter(F.col(T_MS).isNotNull()) if time is not None and not null_time else df


def require_time(time, what):
    if time is None:
        raise ValueError(f"{what} requires an event-time column (on_time)")


def only_for_streams(history, what):
    if history is not None:
        raise ValueError(f"{what}: history is where a stream starts from; in batch unite the tables")


def last_of(k, order, **values) -> DataFrame:
    """One row per key of a scan: ``values`` at the key's last row by ``order``,
    and that row's time (``_t``).  With TTL epochs the last row is in the epoch
    that is alive.  Combined before its shuffle, so a hot key is one row a task."""
    keys = [c for c in k.keys if c != "_epoch"]
    last = F.max_by(F.struct(*[v.alias(n) for n, v in values.items()], F.col(T_MS).alias(T_MS)), F.struct(*order))
    return k.result().groupBy(*keys).agg(last.alias("_last")).select(*keys, "_last.*")
