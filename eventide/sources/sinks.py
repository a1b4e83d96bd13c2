"""Writing results: tables (CREATE TABLE AS SELECT), append streams of
results or changelogs, and file metadata as a time column."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from eventide.session import ensure_checkpoint_dir


def write_table(df: DataFrame, *, path: str | None = None, table: str | None = None,
                mode: str = "errorifexists", fmt: str = "parquet", partition_by=None) -> None:
    """``CREATE TABLE ... AS SELECT``: to a path or to a catalog table, which
    must not exist unless another ``mode`` says so."""
    w = df.write.mode(mode).format(fmt)
    if partition_by:
        w = w.partitionBy(*([partition_by] if isinstance(partition_by, str) else partition_by))
    if table:
        w.saveAsTable(table)
    elif path:
        w.save(path)
    else:
        raise ValueError("give path or table")


def write_stream(df: DataFrame, *, path: str | None = None, query_name: str,
                 fmt: str = "parquet", checkpoint: str | None = None,
                 trigger: dict | None = None, output_mode: str = "append"):
    """Start an append stream of operator results.  Changelog outputs keep
    their ``op`` / ``change_seq`` columns, so a file sink stores the
    changelog as rows.  The checkpoint goes under the session's shared
    checkpoint folder unless given."""
    ck = checkpoint or os.path.join(ensure_checkpoint_dir(df.sparkSession), "streams",
                                    query_name)
    w = (df.writeStream.format(fmt).outputMode(output_mode).queryName(query_name)
         .option("checkpointLocation", ck))
    if path:
        w = w.option("path", path)
    if trigger:
        w = w.trigger(**trigger)
    return w.start()


def with_file_time(df: DataFrame, name: str = "file_time") -> DataFrame:
    """Connector metadata as a column: the source file's modification time."""
    return df.withColumn(name, F.col("_metadata.file_modification_time"))
