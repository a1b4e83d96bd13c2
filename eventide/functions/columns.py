"""Column helpers shared by the operators (all native Catalyst expressions)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

T_MS = "_t"  # internal epoch-millisecond event time


def col_of(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def epoch_ms(df: DataFrame, c: str) -> Column:
    """Epoch milliseconds of a TIMESTAMP / TIMESTAMP_NTZ / DATE / integral
    column.  NTZ values are read as UTC wall clock (session time zone UTC)."""
    dt = df.schema[c].dataType
    if isinstance(dt, (T.TimestampType,)):
        return F.unix_millis(F.col(c))
    if isinstance(dt, (T.TimestampNTZType, T.DateType)):
        return F.unix_millis(F.col(c).cast("timestamp"))
    if isinstance(dt, (T.LongType, T.IntegerType, T.ShortType, T.ByteType)):
        return F.col(c).cast("long")
    raise TypeError(f"column {c!r} of type {dt.simpleString()} is not a time column")


def ms_to_ntz(ms: Column) -> Column:
    """Epoch ms -> TIMESTAMP_NTZ in UTC (the reference's LocalDateTime at UTC)."""
    return F.timestamp_millis(ms).cast("timestamp_ntz")


def window_start(ms: Column, size_ms: int) -> Column:
    """Epoch-aligned tumbling window start; pmod keeps pre-1970 times right."""
    return ms - F.pmod(ms, F.lit(int(size_ms)))


def exact(c: Column) -> Column:
    """A money amount for summing: DECIMAL(27,10) (below 1e17), so that a sum
    does not depend on the order or grouping in which it is made."""
    return c.cast("double").cast("decimal(27,10)")


def not_blank(c: Column) -> Column:
    """Java ``!s.trim().isEmpty()``: trim strips every char <= U+0020."""
    return c.rlike("[^\\x00-\\x20]")


def null_safe_differs(a: Column, b: Column) -> Column:
    return ~a.eqNullSafe(b)


def require_columns(df: DataFrame, cols, what: str) -> None:
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"{what}: input lacks column(s) {missing}; has {df.columns}")


def interval_ms(v) -> int:
    """Accept milliseconds or a simple interval string like '5 seconds', '1 day'."""
    if isinstance(v, (int, float)):
        return int(v)
    num, unit = str(v).strip().split()
    unit = "ms" if unit.lower() == "ms" else unit.lower().rstrip("s")
    scale = {"millisecond": 1, "ms": 1, "second": 1000, "minute": 60_000,
             "hour": 3_600_000, "day": 86_400_000}.get(unit)
    if scale is None:
        raise ValueError(f"interval {v!r}: unit not known")
    return int(float(num) * scale)
