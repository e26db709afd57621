"""Small driver-side rows into a DataFrame (fixtures, result and parameter tables)."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType


def from_rows(spark: SparkSession, rows: Iterable, schema: StructType | str) -> DataFrame:
    """``createDataFrame`` with an explicit schema; only for bounded, small inputs."""
    return spark.createDataFrame(list(rows), schema)


def from_literals(spark: SparkSession, rows: Sequence[Sequence], schema: StructType) -> DataFrame:
    """A few rows as literals evaluated in the JVM: one partition, no Python data path.

    For parameter tables (a handful of rows, planned as one expression).
    """
    if not rows:
        return from_rows(spark, rows, schema)
    structs = [F.struct(*[F.lit(v).cast(f.dataType).alias(f.name)
                          for v, f in zip(row, schema.fields)]) for row in rows]
    out = spark.range(0, 1, 1, 1).select(F.inline(F.array(*structs)))
    return out.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in schema.fields])
