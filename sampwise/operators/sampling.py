"""Systematic samples, systematic partitions and random splits.

A systematic sample keeps the rows whose consecutive index falls in one
residue class ``start (mod step)``.  The index comes from
:func:`with_row_index`, so no step of it runs in a single task; the residue
filter is folded into the plan right above the offset join.

Random splits come in two forms:

* :func:`hash_split` (default): the bucket of a row is a function of
  ``(seed, key)`` only (md5 based), so it is the same on any cluster layout,
  under retries, and in any SQL engine with md5.  No sort, no shuffle.
  ``hash_fn="xxhash64"`` draws about ten times cheaper per row, reproducible
  in Spark only.
* ``method="bernoulli"``: Spark's ``randomSplit``.  It sorts each partition
  to be retry-safe and its draw depends on the partitioning.
"""

from __future__ import annotations

import random
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.hashing import bucket_of, cumulative_bounds, uniform
from ..functions.predicates import residue
from .index import indexed, with_row_index


def _indexed(df: DataFrame, index_col: str, order_by, base: int,
             deterministic_input: bool) -> DataFrame:
    if index_col in df.columns:
        return df
    return with_row_index(df, order_by, base=base, name=index_col,
                          deterministic_input=deterministic_input)


def systematic_sample(df: DataFrame, step: int, start: int = 0, *,
                      order_by: str | Sequence[str] | None = None, base: int = 0,
                      index_col: str = "row_index", keep_index: bool = True,
                      deterministic_input: bool = False) -> DataFrame:
    """Rows whose index ``i`` satisfies ``(i - start) mod step == 0``.

    With ``base=0`` this is ``zipWithIndex`` + filter; with ``base=1`` and
    ``0 <= start < step`` it is ``row_number() % step == start``.  A ``start``
    outside ``0..step-1`` selects the same residue class (floored modulo).
    An existing ``index_col`` is used as is.
    """
    if step < 1:
        raise ValueError("step must be >= 1")
    idx = _indexed(df, index_col, order_by, base, deterministic_input)
    out = idx.filter(residue(index_col, start, step))
    return out if keep_index else out.drop(index_col)


def systematic_partition(df: DataFrame, n_parts: int, *,
                         order_by: str | Sequence[str] | None = None, base: int = 0,
                         index_col: str = "row_index", part_col: str = "part",
                         deterministic_input: bool = False) -> DataFrame:
    """Add ``part = (index - base) mod n_parts``: n disjoint systematic samples, one pass.

    Part ``j`` is exactly ``systematic_sample(step=n_parts, start=j)``; the parts
    cover the table and their sizes differ by at most one.
    """
    if n_parts < 1:
        raise ValueError("n_parts must be >= 1")
    idx = _indexed(df, index_col, order_by, base, deterministic_input)
    return idx.withColumn(part_col, F.pmod(F.col(index_col) - F.lit(base), F.lit(n_parts)))


def sampling_interval(n_rows: int, n_samples: int) -> int:
    """``k = N // n`` (at least 1): the step that yields about ``n`` rows."""
    if n_samples < 1:
        raise ValueError("n_samples must be >= 1")
    return max(1, n_rows // n_samples)


def interval_sample(df: DataFrame, n_samples: int, start: int = 0, *,
                    order_by: str | Sequence[str] | None = None, base: int = 0,
                    index_col: str = "row_index",
                    deterministic_input: bool = False) -> DataFrame:
    """Systematic sample of about ``n_samples`` rows: step ``k = N // n_samples``."""
    if index_col in df.columns:
        last = df.agg(F.max(index_col)).first()[0]
        rows, size = df, 0 if last is None else last - base + 1
    else:
        numbered = indexed(df, order_by, base=base, name=index_col, deterministic_input=deterministic_input)
        rows, size = numbered.frame, numbered.size()  # from the counts kept with the index
    return rows.filter(residue(index_col, start, sampling_interval(size, n_samples)))


def draw_offsets(step: int, n: int, seed: int | None = None, *,
                 replace: bool = True) -> list[int]:
    """``n`` start offsets in ``0..step-1`` from a seeded generator (driver side).

    ``replace=False`` draws distinct offsets, so at most ``step`` of them.
    """
    if step < 1:
        raise ValueError("step must be >= 1")
    rng = random.Random(seed)
    if replace:
        return [rng.randint(0, step - 1) for _ in range(n)]
    if n > step:
        raise ValueError(f"cannot draw {n} distinct offsets from {step}")
    return rng.sample(range(step), n)


def split_column(key: str | Column | Sequence[str | Column], weights: Sequence[float],
                 seed: int, hash_fn: str = "md5") -> Column:
    """Bucket ``0..len(weights)-1`` of each row, from ``uniform(key, seed)``."""
    return bucket_of(uniform(key, seed, hash_fn=hash_fn), weights)


def hash_split(df: DataFrame, weights: Sequence[float], seed: int,
               key: str | Sequence[str], *, name: str = "split",
               hash_fn: str = "md5") -> DataFrame:
    """Add ``name`` = the bucket a row falls in; weights need not sum to 1.

    ``hash_fn`` as in :func:`uniform` (md5: reproducible in SQL; xxhash64: faster).
    """
    cumulative_bounds(weights)
    return df.withColumn(name, split_column(key, weights, seed, hash_fn))


def random_split(df: DataFrame, weights: Sequence[float], seed: int,
                 key: str | Sequence[str] | None = None, *,
                 method: str = "hash", hash_fn: str = "md5") -> list[DataFrame]:
    """Split into ``len(weights)`` disjoint DataFrames covering ``df``.

    ``method="hash"`` needs a ``key`` (unique per row for exact proportions);
    ``"bernoulli"`` is Spark's ``randomSplit``.
    """
    if method == "bernoulli":
        return df.randomSplit([float(w) for w in weights], seed)
    if method != "hash":
        raise ValueError("method must be 'hash' or 'bernoulli'")
    if key is None:
        raise ValueError("hash split needs a key column")
    tmp = "_sw_split"
    tagged = hash_split(df, weights, seed, key, name=tmp, hash_fn=hash_fn)
    return [tagged.filter(F.col(tmp) == i).drop(tmp) for i in range(len(weights))]


def train_test_split(df: DataFrame, train_fraction: float = 0.8, seed: int = 42,
                     key: str | Sequence[str] | None = None, *,
                     method: str = "hash",
                     hash_fn: str = "md5") -> tuple[DataFrame, DataFrame]:
    """``(train, test)`` with about ``train_fraction`` of the rows in train."""
    train, test = random_split(df, [train_fraction, 1.0 - train_fraction], seed, key,
                               method=method, hash_fn=hash_fn)
    return train, test
