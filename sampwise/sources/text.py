"""Line-oriented text input (one row per line)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession


def read_lines(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """``value: string`` with one row per line; splits follow the file layout."""
    return spark.read.text(path)
