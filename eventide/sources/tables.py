"""Readers for the parquet test tables (one parquet file or folder per table)."""

from __future__ import annotations

import os

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")

DEFAULT_DIR = "/root/testdata/sf0.01"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    if name not in TABLES:
        raise KeyError(name)
    path = os.path.join(sf_dir, f"{name}.parquet")
    return spark.read.parquet(path)


def register_views(spark: SparkSession, sf_dir: str, names=TABLES) -> None:
    """Expose the tables as temp views for spark.sql(...)."""
    for n in names:
        try:
            df = table(spark, sf_dir, n)
        except AnalysisException:       # not every folder has every table
            continue
        df.createOrReplaceTempView(n)
