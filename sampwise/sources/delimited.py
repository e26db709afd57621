"""Delimited files (CSV and friends) and the schema clean-up applied after reading."""

from __future__ import annotations

import re
from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from ..functions.columns import col as col_of


def read_delimited(spark: SparkSession, path: str | list[str], *, sep: str = ",",
                   header: bool = True, schema: StructType | str | None = None,
                   infer_schema: bool = False, mode: str = "PERMISSIVE") -> DataFrame:
    """Read a delimited text file.

    Pass ``schema`` at scale: inference costs an extra full pass over the input.
    """
    reader = spark.read.option("header", header).option("sep", sep).option("mode", mode)
    if schema is not None:
        reader = reader.schema(schema)
    else:
        reader = reader.option("inferSchema", infer_schema)
    return reader.csv(path)


def clean_name(name: str) -> str:
    """Column name safe for ML stages: dots and other punctuation become underscores."""
    return re.sub(r"[^0-9A-Za-z_]", "_", name)


def clean_column_names(df: DataFrame, mapping: Mapping[str, str] | None = None) -> DataFrame:
    """Rename columns; by default every name gets :func:`clean_name`.

    With ``mapping`` (plain names, no backticks) only those columns are renamed,
    and a missing source column is an error instead of a silent no-op.
    """
    if mapping is None:
        mapping = {c: clean_name(c) for c in df.columns if clean_name(c) != c}
    missing = [old for old in mapping if old not in df.columns]
    if missing:
        raise ValueError(f"columns to rename not found: {missing}; have {df.columns}")
    new_names = [mapping.get(c, c) for c in df.columns]
    if len(set(new_names)) != len(new_names):
        raise ValueError(f"renaming would create duplicate columns: {new_names}")
    return df.toDF(*new_names)


def to_typed(df: DataFrame, spec: Mapping[str, tuple[str, str]]) -> DataFrame:
    """Project to named, typed columns: ``{new_name: (source_column, spark_type)}``."""
    return df.select([col_of(src).cast(typ).alias(new) for new, (src, typ) in spec.items()])


# The iris CSV header names and the names the models use.
IRIS_COLUMNS = {
    "sepal_length": ("SepalLengthCm", "double"),
    "sepal_width": ("SepalWidthCm", "double"),
    "petal_length": ("PetalLengthCm", "double"),
    "petal_width": ("PetalWidthCm", "double"),
    "species": ("Species", "string"),
}


def read_iris(spark: SparkSession, path: str) -> DataFrame:
    """Iris CSV (header, comma) read by column name into the model schema; ``Id`` dropped."""
    raw = read_delimited(spark, path, sep=",", header=True,
                         schema="Id INT, SepalLengthCm DOUBLE, SepalWidthCm DOUBLE, "
                                "PetalLengthCm DOUBLE, PetalWidthCm DOUBLE, Species STRING")
    return to_typed(raw, IRIS_COLUMNS)
