"""Streams with a lasting name: the same name continues the same query.

``named_stream`` starts from the checkpoint ``<root>/<uid>`` and keeps beside
it, in ``<root>/<uid>.operator``, which operator with which parameters and input
columns it belongs to.  A later start under that name continues after the last
batch if operator, parameters and input columns are the same; otherwise it is
refused, before the state of one query can be read as another's.
"""

from __future__ import annotations

import inspect
import json
import os
import re

from pyspark.sql import Column, DataFrame
from pyspark.sql.streaming.readwriter import DataStreamWriter

from eventide.session import ensure_checkpoint_dir
from eventide.sources.materialized import create_text, read_text

# These change how a query runs, or only how it first starts, not what it is.
FREE = {"history", "hot", "rows_per_chunk"}


def signature(operator, *args, **params) -> dict:
    """The operator, its parameters (defaults too) and its inputs' columns, as plain JSON values."""
    call = inspect.signature(operator).bind(*args, **params)
    call.apply_defaults()
    return {"operator": f"{operator.__module__}.{operator.__qualname__}",
            "parameters": {n: _plain(n, v) for n, v in sorted(call.arguments.items()) if n not in FREE}}


def _plain(name: str, v):
    if isinstance(v, DataFrame):
        return v.schema.simpleString()
    if isinstance(v, dict):
        return {str(k): _plain(name, x) for k, x in sorted(v.items(), key=lambda e: str(e[0]))}
    if isinstance(v, (list, tuple)):
        return [_plain(name, x) for x in v]
    if v is None or isinstance(v, (bool, int, float, str)):
        return v
    if isinstance(v, Column) or callable(v):
        raise ValueError(f"{name}: columns and functions have no lasting form; use names and values")
    return str(v)


def named_stream(operator, *args, uid: str, root: str | None = None, **params) -> DataStreamWriter:
    """A stream writer of ``operator(*args, **params)`` (an operator on streaming
    DataFrames) that lacks only its sink: query name ``uid``, append mode and
    the checkpoint of that name under ``root`` (default: ``streams`` in the
    session's checkpoint folder)."""
    if not re.fullmatch(r"[A-Za-z0-9][A-Za-z0-9_.-]*", uid) or uid.endswith(".operator"):
        raise ValueError("uid: letters, digits, '_', '-' and '.', not starting with a sign")
    out = operator(*args, **params)
    if not out.isStreaming:
        raise ValueError(f"{uid}: none of the inputs is a stream")
    spark = out.sparkSession
    root = root or os.path.join(ensure_checkpoint_dir(spark), "streams")
    claim(spark, f"{root}/{uid}.operator", uid, signature(operator, *args, **params))
    return out.writeStream.queryName(uid).outputMode("append").option("checkpointLocation", f"{root}/{uid}")


def claim(spark, path: str, uid: str, now: dict):
    """Write the signature, or compare with the one that is there."""
    text = json.dumps(now, sort_keys=True)
    if create_text(spark, path, text):
        return
    then = json.loads(read_text(spark, path))
    if then == json.loads(text):
        return
    if then["operator"] != now["operator"]:
        raise ValueError(f"{uid} belongs to {then['operator']}, not {now['operator']}")
    old, new = then["parameters"], json.loads(text)["parameters"]
    differ = [f"{n}: {old.get(n)!r} -> {new.get(n)!r}" for n in sorted({*old, *new}) if old.get(n) != new.get(n)]
    raise ValueError(f"{uid} was started with other parameters ({'; '.join(differ)}); use another uid")
