"""Consecutive row index (0..N-1 or 1..N) without pulling the table into one task.

An unpartitioned ``row_number() OVER (ORDER BY ...)`` sends every row through
one task (``Exchange SinglePartition``).  Here the index is
``offset(partition) + position inside partition``:

* **key order** (any sortable columns): rows are range-partitioned and sorted on
  the key plus a scan-position tie-break, so a value that fills many partitions
  (a hot key, NULL, NaN, an outlier's neighbours) is spread over them;
* **scan order** (``order_by=None``, the order ``zipWithIndex`` gives): the
  partitions are the input's own.

The placed rows are written once under ``spark.checkpoint.dir`` and numbered from
that table: the count pass (one narrow column) and the data pass read the same
files, so they agree whatever produced the rows, and a lost executor only rereads
files.  There is one plan for every size, type and distribution.

A bare scan may skip the copy with ``deterministic_input=True`` (scan order only);
a plan with an exchange is then refused, and rows that the count pass did not see
raise an error instead of vanishing.

The only broadcast is the offsets table: one row per partition.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import cols as by_name
from ..session import stored_table

POS_BITS = 33  # monotonically_increasing_id = partition index << 33 | position in it

_MID = "_sw_mid"
_GRP = "_sw_grp"
_CNT = "_sw_n"
_OFF = "_sw_off"


@dataclass(frozen=True)
class Indexed:
    """Numbered rows, and the counts that number them, stored beside the placed rows."""

    frame: DataFrame
    counts: DataFrame  # one row per partition of the placed rows

    def size(self) -> int:
        """The number of rows, from the stored counts: no pass over the rows."""
        return int(self.counts.agg(F.coalesce(F.sum(_CNT), F.lit(0))).first()[0])


def with_row_index(df: DataFrame, order_by: str | Sequence[str] | None = None, *,
                   base: int = 0, name: str = "row_index",
                   deterministic_input: bool = False,
                   partitions: int | None = None) -> DataFrame:
    """The rows of :func:`indexed`."""
    return indexed(df, order_by, base=base, name=name, deterministic_input=deterministic_input,
                   partitions=partitions).frame


def indexed(df: DataFrame, order_by: str | Sequence[str] | None = None, *,
            base: int = 0, name: str = "row_index",
            deterministic_input: bool = False,
            partitions: int | None = None) -> Indexed:
    """``df`` with a consecutive ``name`` column first, starting at ``base``.

    ``order_by=None`` numbers rows in input order (partition by partition, as
    ``zipWithIndex``); otherwise in ascending key order, NULLs first.  Equal
    keys get consecutive indexes in scan order, so give a unique key when the
    exact rows per index matter.

    ``partitions`` is the number of key ranges (default: ``spark.sql.shuffle.partitions``).
    ``deterministic_input=True`` states that ``df`` is a bare scan that re-reads the
    same rows in the same splits; only scan order uses it.
    """
    if name in df.columns:
        raise ValueError(f"column {name!r} already exists")
    flat = df.toDF(*[f"c{i}" for i in range(len(df.columns))])  # names cannot clash or need quoting
    if order_by is None:
        if deterministic_input:
            _refuse_exchange(df)
            placed = flat.withColumn(_MID, F.monotonically_increasing_id())
            return _numbered(placed, df.columns, base, name)
        return _numbered(_placed(flat), df.columns, base, name)
    keys = [order_by] if isinstance(order_by, str) else list(order_by)
    if not keys:
        raise ValueError("order_by must name at least one column")
    for k in keys:
        if k not in df.columns:
            raise ValueError(f"order_by column {k!r} not in {df.columns}")
    order = [F.col(f"c{df.columns.index(k)}").asc_nulls_first() for k in keys]
    width = partitions or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    tie = "_sw_tie"
    ranged = (flat.withColumn(tie, F.monotonically_increasing_id())
              .repartitionByRange(width, *order, F.col(tie))
              .sortWithinPartitions(*order, F.col(tie)).drop(tie))
    return _numbered(_placed(ranged), df.columns, base, name)


def _placed(df: DataFrame) -> DataFrame:
    """The rows with their place, written once and read back."""
    return stored_table(df.withColumn(_MID, F.monotonically_increasing_id()), "row-index")


def _refuse_exchange(df: DataFrame) -> None:
    plan = df._jdf.queryExecution().executedPlan().toString()
    if "Exchange" in plan:
        raise ValueError("the input shuffles rows, so it is not a bare scan: "
                         "leave deterministic_input=False")


def _numbered(placed: DataFrame, names: Sequence[str], base: int, name: str) -> Indexed:
    """Offsets of the partitions (an exclusive running sum over one row each) plus positions.

    The window has no partition key on purpose: its input is the per-partition
    counts, not the data.
    """
    grouped = placed.withColumn(_GRP, F.shiftright(_MID, POS_BITS))
    counts = grouped.groupBy(_GRP).agg(F.count(F.lit(1)).alias(_CNT))
    before = Window.orderBy(_GRP).rowsBetween(Window.unboundedPreceding, -1)
    offsets = stored_table(counts.select(_GRP, _CNT, F.coalesce(F.sum(_CNT).over(before), F.lit(0)).alias(_OFF)),
                           "row-counts")
    position = F.col(_MID).bitwiseAND(F.lit((1 << POS_BITS) - 1))
    joined = grouped.join(F.broadcast(offsets), _GRP, "left")
    index = F.when(position < F.col(_CNT), F.col(_OFF) + position + F.lit(base)).otherwise(
        F.raise_error(F.lit("the input changed between two reads: leave deterministic_input=False")))
    return Indexed(joined.select(index.cast("long").alias(name),
                                 *[F.col(f"c{i}").alias(n) for i, n in enumerate(names)]), offsets)


def with_unique_id(df: DataFrame, name: str = "uid") -> DataFrame:
    """Unique, increasing but not consecutive id (split index << 33 | position)."""
    return df.select(F.monotonically_increasing_id().alias(name), *by_name(df.columns))
