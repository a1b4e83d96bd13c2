"""Helpers shared by the operators of this package."""

from __future__ import annotations

import sys
import types
import uuid

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from eventide.session import ensure_checkpoint_dir

# A word is a run of digits, a-z (after lower-casing A-Z) and code points from
# U+0080; on UTF-8 bytes: every byte that this table does not map to a space.
WORD_BYTES = bytes(b + 32 if 0x41 <= b <= 0x5A else
                   b if 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A or b >= 0x80 else 0x20
                   for b in range(256))

# Bytes of text that a task turns into arrays at a time.
SECTION = 1 << 20


def utf8(text: str | None) -> bytes:
    """UTF-8 bytes; null is empty, lone surrogates become U+FFFD."""
    if not text:
        return b""
    try:
        return text.encode()
    except UnicodeEncodeError:
        return text.encode("utf-8", "replace")


def sections(data: bytes, size: int = SECTION):
    """Cut space-separated words into pieces of about ``size`` bytes, so that
    a very long text never becomes one list of word objects."""
    at = 0
    while at < len(data):
        end = len(data) if len(data) - at <= size else data.find(b" ", at + size)
        end = len(data) if end < 0 else end
        yield data[at:end]
        at = end


def text_slices(texts: list, size: int = 4 * SECTION):
    """Ranges of consecutive texts of about ``size`` characters each."""
    start = total = 0
    for i, t in enumerate(texts):
        total += len(t or "")
        if total >= size:
            yield start, i + 1
            start, total = i + 1, 0
    if start < len(texts):
        yield start, len(texts)


def slices_of(column: pa.Array, size: int):
    """Ranges of consecutive texts of about ``size`` bytes each, without
    making Python strings of the whole column."""
    ends = np.cumsum(pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False), dtype=np.int64)
    at = 0
    while at < len(column):
        done = ends[at - 1] if at else 0
        hi = min(len(column), int(np.searchsorted(ends, done + size)) + 1)
        yield at, hi
        at = hi


def mix64(h: np.ndarray) -> np.ndarray:
    """Finalizer that spreads every input bit over the 64 output bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


def lower_ascii(c: Column) -> Column:
    """Lower-case A-Z only."""
    return F.translate(c, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def id_hash_mod(c: Column, n: int) -> Column:
    """crc32 of the id as text, modulo ``n``; 0 for a null id."""
    return F.coalesce(F.crc32(c.cast("string").cast("binary")) % n, F.lit(0))


def plain_names(df: DataFrame) -> tuple[DataFrame, dict]:
    """(``df`` with columns c0, c1, ..., the new name of each old one), for
    maps over whole rows: names may hold dots, back quotes or anything else."""
    names = [f"c{i}" for i in range(len(df.columns))]
    return df.toDF(*names), dict(zip(df.columns, names))


def quoted(name: str) -> str:
    """A column name for ``F.col``, whatever signs it has."""
    return "`" + name.replace("`", "``") + "`"


def free_name(df: DataFrame, name: str) -> str:
    """A column name like ``name`` that ``df`` does not have, whatever the case."""
    taken = {c.lower() for c in df.columns}
    while name.lower() in taken:
        name += "_"
    return name


# Rows of an Arrow batch; the default of 10,000 is for narrow rows, not texts.
BATCH_ROWS = 1000
_BATCH_CONF = "spark.sql.execution.arrow.maxRecordsPerBatch"
_WORKER_CACHE = "_eventide_worker_cache"


def small_batches(spark: SparkSession) -> None:
    """Let tasks see ``BATCH_ROWS`` texts at a time, unless the session has
    a setting of its own."""
    if spark.conf.get(_BATCH_CONF, "10000") == "10000":
        spark.conf.set(_BATCH_CONF, str(BATCH_ROWS))


def worker_cache(key, make):
    """An object that outlives a task in its Python worker, made anew for
    another ``key``.  Shipped code cannot keep it in a module of its own."""
    store = sys.modules.setdefault(_WORKER_CACHE, types.ModuleType(_WORKER_CACHE))
    if getattr(store, "key", None) != key:
        store.value = None
        store.key, store.value = key, make()
    return store.value


def release_worker_cache() -> None:
    """Give back what tasks of another operator have left in this worker."""
    sys.modules.pop(_WORKER_CACHE, None)


def reliable(df: DataFrame) -> DataFrame:
    """Cut lineage with files in the shared checkpoint folder, which survive
    the loss of any executor."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def shared_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder."""
    root = ensure_checkpoint_dir(spark).rstrip("/")
    return f"{root}/{name}-{uuid.uuid4().hex}"
