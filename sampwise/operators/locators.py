"""Samples by row locators: number narrow rows, fetch wide rows only where they are sampled.

A *locator* of a row in a Parquet file is (file, place in the file), which the reader
itself reports (``_metadata``).  Locators make two things possible that a copy of the
table is not needed for:

* **scan-order index**: rows before the file plus the place in the file.  Files are taken in
  the order of their paths, so the index depends on the files and their names alone, not on
  how splits are cut or packed (``spark.sql.files.maxPartitionBytes``).  Text and CSV files,
  whose reader reports no places, use (file, block start) and the position in the block; the index is
  the same.  One pass over no column counts rows per file (or block); nothing is copied or moved.
* **key-order sample**: only (key, file, place) goes through the range exchange and the
  written copy of the index; the locators of the sample are dealt by file and part of it, and tasks fetch
  their rows from the files.  No other column is in any exchange or copy, no unique key is needed.

The only broadcast is one row per file (or block), the size of the table's file listing.

Defined cases: an empty table gives no rows; a file without rows takes no index; equal keys
are numbered in file order; columns with dots or quotes keep their names.  A frame that is
not a bare scan (it filters, joins, moves or repeats rows) is refused, since its rows are not those of the files.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence
from urllib.parse import unquote, urlsplit

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StructField, StructType

from ..functions.columns import col as col_of, cols as by_name
from ..functions.predicates import residue
from ..session import stored_table
from .index import POS_BITS, indexed

#: Rows of a file that one task fetches at most at a time.
FETCH_ROWS = 1 << 20
# Plan nodes of a bare scan; Spark prints each node's name first on its line.
_BARE = re.compile(r"^[\s:+\-*()\d]*(Project|ColumnarToRow|FileScan|BatchScan|Scan|AdaptiveSparkPlan|== |InputAdapter"
                   r"|WholeStageCodegen)")


def require_bare_scan(df: DataFrame) -> str:
    """The file format of ``df`` if it is a bare scan of files; ValueError otherwise."""
    plan = df._jdf.queryExecution().executedPlan().toString()
    lines = [line for line in plan.splitlines() if line.strip()]
    scans = re.findall(r"FileScan (\w+)", plan)
    if len(scans) != 1 or any(not _BARE.match(line) for line in lines):
        raise ValueError("not a bare scan of files: read the table and select columns only")
    return scans[0]


def _fresh(df: DataFrame, *names: str) -> list[str]:
    taken, out = {c.lower() for c in df.columns}, []
    for name in names:
        while name.lower() in taken:
            name += "_"
        out.append(name)
    return out


def scan_order_index(scan: DataFrame, *, base: int = 0, name: str = "row_index") -> DataFrame:
    """``scan`` with a consecutive ``name`` column first, in the order of paths and places, no copy."""
    return _scan_index(scan, base, name)[0]


def _scan_index(scan: DataFrame, base: int, name: str) -> tuple[DataFrame, DataFrame]:
    if name in scan.columns:
        raise ValueError(f"column {name!r} already exists")
    file, block, place = _fresh(scan, "_sw_file", "_sw_block", "_sw_place")
    parquet = require_bare_scan(scan) == "parquet"
    meta = scan.withColumn(file, F.col("_metadata.file_path"))
    if parquet:
        # a place is a property of the file: blocks of one file need no offsets of their own
        meta = meta.withColumn(block, F.lit(0).cast("long")).withColumn(place, F.col("_metadata.row_index"))
    else:
        meta = (meta.withColumn(block, F.col("_metadata.file_block_start"))
                .withColumn(place, F.monotonically_increasing_id()))
    counts = meta.groupBy(file, block).agg(F.count(F.lit(1)).alias("n"), F.min(place).alias("first"))
    before = Window.orderBy(file, block).rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored_table(counts.withColumn("before", F.coalesce(F.sum("n").over(before), F.lit(0))), "scan-offsets")
    small = offsets.select(file, block, F.col("n").alias("_sw_n"), F.col("first").alias("_sw_first"),
                           F.col("before").alias("_sw_before"))
    position = col_of(place) - F.col("_sw_first")
    index = F.when(position < F.col("_sw_n"), F.col("_sw_before") + position + F.lit(base)).otherwise(
        F.raise_error(F.lit("the files changed between two reads")))
    rows = meta.join(F.broadcast(small), [file, block], "left")
    return rows.select(index.cast("long").alias(name), *by_name(scan.columns)), offsets


def _paths(uri: str):
    import pyarrow.fs

    parts = urlsplit(uri)
    if parts.scheme in ("", "file"):
        return pyarrow.fs.LocalFileSystem(), unquote(parts.path)
    return pyarrow.fs.FileSystem.from_uri(unquote(uri))


def _fetch(columns: Sequence[str], names: Sequence[str], schema: pa.Schema):
    """Tasks: sorted locators (index, file, place) to the rows they name."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import numpy as np
        import pyarrow.parquet as pq

        opened: tuple[str, pq.ParquetFile, np.ndarray] | None = None
        for batch in batches:
            files, places = batch.column("file"), batch.column("place").to_numpy()
            uris = files.to_pylist()
            cut = [0, *[k for k in range(1, len(uris)) if uris[k] != uris[k - 1]], len(uris)]
            for start, end in zip(cut, cut[1:]):
                if start == end:
                    continue
                if opened is None or opened[0] != uris[start]:
                    system, path = _paths(uris[start])
                    file = pq.ParquetFile(system.open_input_file(path))
                    sizes = [file.metadata.row_group(g).num_rows for g in range(file.num_row_groups)]
                    opened = (uris[start], file, np.concatenate([[0], np.cumsum(sizes)]))
                _, file, starts = opened
                here = places[start:end]
                group = np.searchsorted(starts, here, side="right") - 1
                for g in np.unique(group):
                    mine = np.flatnonzero(group == g)
                    table = file.read_row_group(int(g), columns=list(columns)).take(
                        pa.array(here[mine] - starts[g]))
                    index = batch.column("index").take(pa.array(start + mine))
                    arrays = [index, *[table.column(c).combine_chunks().cast(f.type, safe=False)
                                       for c, f in zip(columns, list(schema)[1:])]]
                    yield pa.RecordBatch.from_arrays(arrays, names=list(names))
    return run


def fetch_rows(scan: DataFrame, locators: DataFrame, index_col: str) -> DataFrame:
    """Rows (``index_col``, columns of ``scan``) of ``locators`` (index, file, place), from the Parquet files.

    Locators are dealt by file and stretch of it, so a long file is many tasks' work.
    """
    spark = scan.sparkSession
    width = int(spark.conf.get("spark.sql.shuffle.partitions"))
    schema = StructType([StructField(f"c{k}", f.dataType) for k, f in enumerate(
        [StructField(index_col, LongType()), *scan.schema.fields])])
    stretch = F.floor(F.col("place") / F.lit(FETCH_ROWS))
    dealt = (locators.select("index", "file", "place").repartition(width, "file", stretch)
             .sortWithinPartitions("file", "place"))
    arrow = to_arrow_schema(schema)
    rows = dealt.mapInArrow(_fetch(scan.columns, [f.name for f in schema], arrow), schema)
    return rows.toDF(index_col, *scan.columns)


def _locators(scan: DataFrame, keys: Sequence[str], base: int):
    """The index of (key, file, place) in key order, equal keys in file order."""
    for k in keys:
        if k not in scan.columns:
            raise ValueError(f"order_by column {k!r} not in {scan.columns}")
    file, place, index = _fresh(scan, "file", "place", "index")
    narrow = scan.select(*by_name(keys), F.col("_metadata.file_path").alias(file),
                         F.col("_metadata.row_index").alias(place))
    numbered = indexed(narrow, [*keys, file, place], base=base, name=index)
    rows = numbered.frame.select(col_of(index).alias("index"), col_of(file).alias("file"), col_of(place).alias("place"))
    return rows, numbered.size


def located_sample(scan: DataFrame, step: int | None = None, start: int = 0, *, n_samples: int | None = None,
                   order_by: str | Sequence[str] | None = None, base: int = 0,
                   index_col: str = "row_index", keep_index: bool = True) -> DataFrame:
    """Systematic sample of a bare Parquet scan: every ``step``-th row, or about ``n_samples`` rows.

    The rows of :func:`systematic_sample` (and of :func:`interval_sample` with
    ``n_samples``) without moving or copying a column that is no key.  In scan order (``order_by=None``,
    any file format) the sample is a filter of the scan.
    """
    from .sampling import sampling_interval

    if (step is None) == (n_samples is None):
        raise ValueError("give step or n_samples")
    if step is not None and step < 1:
        raise ValueError("step must be >= 1")
    if order_by is None:
        rows, offsets = _scan_index(scan, base, index_col)
        k = step or sampling_interval(offsets.agg(F.sum("n")).first()[0] or 0, n_samples)
        out = rows.filter(residue(index_col, start, k))
    else:
        if require_bare_scan(scan) != "parquet":
            raise ValueError("rows are located by place in Parquet files only; use systematic_sample")
        if index_col in scan.columns:
            raise ValueError(f"column {index_col!r} already exists")
        rows, size = _locators(scan, [order_by] if isinstance(order_by, str) else list(order_by), base)
        k = step or sampling_interval(size(), n_samples)
        out = fetch_rows(scan, rows.filter(residue("index", start, k)), index_col)
    return out if keep_index else out.drop(index_col)
