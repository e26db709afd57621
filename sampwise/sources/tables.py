"""The parquet tables of a scale-factor folder."""

from __future__ import annotations

import os

from pyspark.sql import DataFrame, SparkSession

# Table names of the test-data folders.
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
          "events", "documents", "embeddings", "pages", "benchmark", "labels",
          "conversations")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy parquet scan of ``<sf_dir>/<name>.parquet`` (pushdown and pruning apply)."""
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))
