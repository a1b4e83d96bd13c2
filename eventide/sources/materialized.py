"""A changelog kept as a table: what a stream of changes amounts to so far.

``path`` holds one folder per batch of changes (the last change of each key),
a base folder that all older batches were merged into, and the file POINTER
that names the folders in force.  A batch writes its folder first and swaps
the pointer last, by one atomic rename: readers see the table before or after
the batch, a batch that stopped in mid-write leaves the table as it was and
overwrites its folder when it comes again, and a batch that comes again after
its pointer was swapped does nothing.

Reading merges the base with at most ``compact_every`` folders of changes;
every so many batches they become the next base.  Deleted keys stay in the
folders as deletes, so that an older change that comes late cannot bring a key
back.  Folders no longer in force stay until ``vacuum``, for readers that still
use them.  One writer at a time (the stream's own checkpoint sees to that)."""

from __future__ import annotations

import json
import os
import uuid

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.session import ensure_checkpoint_dir

POINTER = "POINTER"


def materialize_stream(changes: DataFrame, path: str, *, keys, order, op: str = "op", query_name: str,
                       checkpoint: str | None = None, trigger: dict | None = None, compact_every: int = 16):
    """Start a stream that keeps ``changes`` (with an ``op`` column) as a table
    under ``path``: per ``keys`` the last change by the ``order`` columns."""
    ck = checkpoint or os.path.join(ensure_checkpoint_dir(changes.sparkSession), "streams", query_name)

    def write(batch, batch_id):
        apply_changes(batch, batch_id, path, keys=keys, order=order, op=op, compact_every=compact_every)

    w = (changes.writeStream.foreachBatch(write).queryName(query_name).option("checkpointLocation", ck))
    return (w.trigger(**trigger) if trigger else w).start()


def apply_changes(batch: DataFrame, batch_id: int, path: str, *, keys, order, op: str = "op",
                  compact_every: int = 16) -> bool:
    """Apply one batch of changes; False if it was applied before.  A change
    that is not the newest of its key by ``order`` does not count, whichever
    batch brings it; of equal ones the later batch's does."""
    spark = batch.sparkSession
    keys, order = ([c] if isinstance(c, str) else list(c) for c in (keys, order))
    now = pointer(spark, path) or {"last": -1, "base": None, "changes": [], "keys": keys, "order": order, "op": op}
    if (now["keys"], now["order"], now["op"]) != (keys, order, op):
        raise ValueError(f"{path} is kept by {now['keys']}, {now['order']}, {now['op']!r}")
    if batch_id <= now["last"]:
        return False
    last = _last(batch.filter(F.col(op) != "-U").withColumn("_batch", F.lit(batch_id).cast("long")), keys, order)
    last.write.mode("overwrite").parquet(f"{path}/changes/{batch_id}")
    then = {**now, "last": batch_id, "changes": [*now["changes"], batch_id]}
    if len(then["changes"]) >= compact_every:
        _merged(spark, path, then).write.mode("overwrite").parquet(f"{path}/base/{batch_id}")
        then.update(base=batch_id, changes=[])
    _swap(spark, path, then)
    return True


def read_table(spark: SparkSession, path: str) -> DataFrame:
    """The rows in force: the last change of each key that is not a delete."""
    now = pointer(spark, path)
    if now is None:
        raise ValueError(f"{path}: no batch has been applied")
    return _merged(spark, path, now).filter(F.col(now["op"]) != "-D").drop("_batch", now["op"])


def vacuum(spark: SparkSession, path: str) -> list[str]:
    """Delete the folders no longer in force; returns their names."""
    now, fs = pointer(spark, path), _fs(spark, path)
    if now is None:
        return []
    gone = []
    for kind, keep in (("base", {str(now["base"])}), ("changes", {str(c) for c in now["changes"]})):
        at = _path(spark, f"{path}/{kind}")
        for f in fs.listStatus(at) if fs.exists(at) else []:
            name = f.getPath().getName()
            if name not in keep and int(name) <= now["last"]:
                fs.delete(f.getPath(), True)
                gone.append(f"{kind}/{name}")
    return sorted(gone)


def _last(d: DataFrame, keys: list, order: list) -> DataFrame:
    row = F.struct(*[F.col(c) for c in d.columns])
    return d.groupBy(*keys).agg(F.max_by(row, F.struct(*order, "_batch")).alias("_row")).select("_row.*")


def _merged(spark: SparkSession, path: str, now: dict) -> DataFrame:
    folders = [f"{path}/changes/{c}" for c in now["changes"]]
    if now["base"] is not None:
        folders.append(f"{path}/base/{now['base']}")
    return _last(spark.read.parquet(*folders), now["keys"], now["order"])


def _path(spark, path):
    return spark._jvm.org.apache.hadoop.fs.Path(path)


def _fs(spark, path):
    return _path(spark, path).getFileSystem(spark._jsc.hadoopConfiguration())


def create_text(spark: SparkSession, path: str, text: str) -> bool:
    """Write a small file whole, unless there is one: False then.  A writer
    that stops midway leaves none."""
    fs, at = _fs(spark, path), _path(spark, path)
    if fs.exists(at):
        return False
    fs.mkdirs(at.getParent())
    new = _path(spark, f"{path}.{uuid.uuid4().hex}.tmp")
    out = fs.create(new, False)
    out.write(bytearray(text.encode()))
    out.close()
    try:
        _rename(spark, fs, new, at, [])
    except Py4JJavaError:
        if not fs.exists(at):
            raise
        fs.delete(new, False)
        return False
    return True


def read_text(spark: SparkSession, path: str) -> str:
    return "".join(r.value for r in spark.read.text(path, wholetext=True).collect())


def _rename(spark, fs, old, new, options: list):
    jvm = spark._jvm
    rename = jvm.org.apache.hadoop.fs.Options.Rename
    how = spark.sparkContext._gateway.new_array(rename, len(options))
    for i, name in enumerate(options):
        how[i] = getattr(rename, name)
    target = fs.makeQualified(new)
    files = jvm.org.apache.hadoop.fs.FileContext.getFileContext(target.toUri(), spark._jsc.hadoopConfiguration())
    files.rename(fs.makeQualified(old), target, how)


def pointer(spark: SparkSession, path: str) -> dict | None:
    """Which folders are in force; None before the first batch."""
    fs, at = _fs(spark, path), _path(spark, f"{path}/{POINTER}")
    if not fs.exists(at):
        return None
    return json.loads(read_text(spark, f"{path}/{POINTER}"))


def _swap(spark, path, then: dict):
    fs, new = _fs(spark, path), _path(spark, f"{path}/_{POINTER}_{then['last']}")
    out = fs.create(new, True)
    out.write(bytearray(json.dumps(then).encode()))
    out.close()
    _rename(spark, fs, new, _path(spark, f"{path}/{POINTER}"), ["OVERWRITE"])
