"""Helpers of the training-data operators: tables, shared intermediate files, names."""

from __future__ import annotations

import math
import uuid
from collections.abc import Callable, Iterator
from contextlib import contextmanager

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructField, StructType

from sampwise.session import checkpoint_dir


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


_SCRATCH: list[list[str]] = []


def stored(df: DataFrame, tag: str) -> DataFrame:
    """Write ``df`` under the shared checkpoint folder and read it back.

    Cuts the lineage: executors that are lost later cost no recomputation, and
    values that a rerun could order differently are fixed once.  Files written inside a
    ``scratch`` block go at its end; others stay until the cluster clears the folder.
    """
    spark = df.sparkSession
    path = new_folder(spark, tag)
    if _SCRATCH:
        _SCRATCH[-1].append(path)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def new_folder(spark: SparkSession, tag: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/{tag}-{uuid.uuid4().hex}"


def delete(spark: SparkSession, path: str) -> None:
    """Remove a folder of this library's own, on whatever file system holds it."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark._jsc.hadoopConfiguration()).delete(folder, True)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """What ``stored`` writes inside the block is deleted at its end, also after an error."""
    _SCRATCH.append([])
    try:
        yield
    finally:
        for path in _SCRATCH.pop():
            delete(spark, path)


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


#: Bytes of asked blocks, with the best rows found for them, that a task of ``every_pair`` holds.
HELD_BYTES = 16 << 20


def asked_parts(blocks: int, block_bytes: int, width: int) -> int:
    """Parts of the asked blocks: one block each, several if there are more than ``width`` blocks and
    about ``HELD_BYTES`` hold them."""
    return max(1, min(blocks, max(width, math.ceil(blocks * block_bytes / HELD_BYTES))))


def every_pair(asked: DataFrame, index: DataFrame, parts: int) -> DataFrame:
    """Every row of ``asked`` beside every row of ``index``, a stored table, whose columns come first.

    ``asked`` is dealt into ``parts``; each with each scan partition of ``index`` is a task, which holds
    the asked part and streams the index rows.  No row is copied, ``index`` is read in place and
    nothing goes through the driver; the hint keeps Spark from broadcasting a side that its estimate
    calls small.  All rows of an asked part come one after another for each row of ``index``.
    """
    return index.crossJoin(asked.repartition(parts).hint("shuffle_replicate_nl"))


def text_or_empty(col: str):
    return F.coalesce(F.col(col).cast("string"), F.lit(""))


def fresh(df: DataFrame, *names: str) -> list[str]:
    """The names, with underscores added until no column of ``df`` is called so."""
    taken = {c.lower() for c in df.columns}
    out = []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def extend(docs: DataFrame, given: Column, fields: list[StructField],
           compute: Callable[[pa.Array], list[pa.Array]]) -> DataFrame:
    """``docs`` with ``fields`` added, computed in Arrow batches from the column ``given``.

    Columns travel by position, so no name in ``docs`` can clash or need quoting.
    """
    names = [f"c{k}" for k in range(len(docs.columns))]
    types = [StructField(n, f.dataType) for n, f in zip(names, docs.schema.fields)]
    added = [StructField(f"x{k}", f.dataType) for k, f in enumerate(fields)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(n) for n in names), *compute(batch.column("given"))],
                names=[*names, *(f.name for f in added)])

    flat = docs.withColumn(fresh(docs, "given")[0], given).toDF(*names, "given")
    return flat.mapInArrow(run, StructType([*types, *added])).toDF(*docs.columns, *(f.name for f in fields))
