"""Text rendering of values the way the reference's runtime (Java) prints
them, as native column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Java class simple names of the runtime value of each SQL type.
RUNTIME_NAMES = {
    T.StringType: "String", T.IntegerType: "Integer", T.LongType: "Long",
    T.DoubleType: "Double", T.FloatType: "Float", T.BooleanType: "Boolean",
    T.ShortType: "Short", T.ByteType: "Byte", T.DecimalType: "BigDecimal",
    T.TimestampNTZType: "LocalDateTime", T.TimestampType: "Instant",
    T.DateType: "LocalDate", T.StructType: "Row", T.BinaryType: "byte[]",
    T.MapType: "HashMap",
}


def runtime_type_name(dt: T.DataType) -> str:
    if isinstance(dt, T.ArrayType):
        return runtime_type_name(dt.elementType) + "[]"
    for cls, name in RUNTIME_NAMES.items():
        if isinstance(dt, cls):
            return name
    return type(dt).__name__


def sql_type_name(dt: T.DataType) -> str:
    if isinstance(dt, T.TimestampNTZType):
        return "TIMESTAMP(6)"
    if isinstance(dt, T.TimestampType):
        return "TIMESTAMP_LTZ(6)"
    if isinstance(dt, T.DecimalType):
        return f"DECIMAL({dt.precision}, {dt.scale})"
    if isinstance(dt, T.ArrayType):
        return f"ARRAY<{sql_type_name(dt.elementType)}>"
    if isinstance(dt, T.MapType):
        return f"MAP<{sql_type_name(dt.keyType)}, {sql_type_name(dt.valueType)}>"
    if isinstance(dt, T.StructType):
        return "ROW<" + ", ".join(f"`{f.name}` {sql_type_name(f.dataType)}" for f in dt.fields) + ">"
    return dt.simpleString().upper()


def _iso_time(c: Column, instant: bool) -> Column:
    """java.time ISO text: minutes always, seconds when non-zero (always for
    Instant), fraction in groups of 3 digits when non-zero."""
    ts = c.cast("timestamp")
    frac = F.pmod(F.unix_micros(ts), F.lit(1_000_000))
    sec = F.second(ts)
    secs = F.concat(F.lit(":"), F.lpad(sec.cast("string"), 2, "0"))
    if not instant:
        secs = F.when((sec == 0) & (frac == 0), F.lit("")).otherwise(secs)
    fr = (F.when(frac == 0, F.lit(""))
          .when(frac % 1000 == 0,
                F.concat(F.lit("."), F.lpad((frac / 1000).cast("long").cast("string"), 3, "0")))
          .otherwise(F.concat(F.lit("."), F.lpad(frac.cast("string"), 6, "0"))))
    out = F.concat(F.date_format(ts, "yyyy-MM-dd'T'HH:mm"), secs, fr)
    return F.concat(out, F.lit("Z")) if instant else out


def java_text(c: Column, dt: T.DataType) -> Column:
    """``String.valueOf(value)`` of the runtime object behind a column.  Nested
    values as the runtime prints them, at any depth: a row ``+I[1, abc]``, an
    array ``[1, 2]``, a map ``{a=1, b=2}`` (in key order, as a hash map has
    none), a null inside as ``null``."""
    if isinstance(dt, T.StringType):
        return c
    if isinstance(dt, T.TimestampNTZType):
        return _iso_time(c, instant=False)
    if isinstance(dt, T.TimestampType):
        return _iso_time(c, instant=True)
    if isinstance(dt, T.StructType):
        inner = F.concat_ws(", ", *[_or_null(c.getField(f.name), f.dataType) for f in dt.fields])
        return F.when(c.isNotNull(), F.concat(F.lit("+I["), inner, F.lit("]")))
    if isinstance(dt, T.ArrayType):
        inner = F.transform(c, lambda x: _or_null(x, dt.elementType))
        return F.concat(F.lit("["), F.array_join(inner, ", "), F.lit("]"))
    if isinstance(dt, T.MapType):
        entries = F.array_sort(F.transform(F.map_entries(c), lambda e: F.struct(
            e["key"].alias("k"), F.concat(_or_null(e["key"], dt.keyType), F.lit("="),
                                          _or_null(e["value"], dt.valueType)).alias("text"))))
        return F.concat(F.lit("{"), F.array_join(F.transform(entries, lambda e: e["text"]), ", "), F.lit("}"))
    if isinstance(dt, T.BinaryType):
        return F.hex(c)
    return c.cast("string")


def _or_null(c: Column, dt: T.DataType) -> Column:
    return F.coalesce(java_text(c, dt), F.lit("null"))


def truncate_text(s: Column, limit: int = 50, keep: int = 47) -> Column:
    return F.when(F.length(s) > limit, F.concat(F.substring(s, 1, keep), F.lit("..."))) \
        .otherwise(s)
