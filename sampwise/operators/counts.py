"""Counting operators: word count, per-field counts, top-k, row counts.

All are declarative aggregations: partial HashAggregate per input partition,
one hash exchange on the grouping key, final HashAggregate.  A hot key (a word
or field value holding a third of all rows) is combined map-side first, so the
exchange carries one row per key per partition, never the hot rows themselves.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col as col_of
from ..functions.text import WHITESPACE_RUN, field_at


def tokenize(df: DataFrame, col: str = "value", *, lower: bool = True,
             name: str = "word", keep: Sequence[str] = ()) -> DataFrame:
    """One row per whitespace token of ``col`` (``str.split()`` semantics), lower-cased.

    ``keep`` names columns carried along with every token (e.g. a document id).
    """
    text = F.lower(col_of(col)) if lower else col_of(col)
    words = df.select(*[col_of(k) for k in keep],
                      F.explode(F.split(text, WHITESPACE_RUN)).alias(name))
    return words.filter(F.col(name) != "")


def word_count(df: DataFrame, col: str = "value", *, lower: bool = True) -> DataFrame:
    """``(word, count)`` over all tokens of ``col``; punctuation stays on the token."""
    return (tokenize(df, col, lower=lower)
            .groupBy("word").agg(F.count(F.lit(1)).alias("count")))


def count_by(df: DataFrame, *keys: str | Column) -> DataFrame:
    """Row count per key value: grouping columns plus ``count``."""
    named = [col_of(k).alias(k) if isinstance(k, str) else k for k in keys]
    return df.groupBy(*named).agg(F.count(F.lit(1)).alias("count"))


def field_count(df: DataFrame, sep: str = ",", index: int = 3, *, col: str = "value",
                on_missing: str = "error") -> DataFrame:
    """``(key, count)`` where key is the ``index``-th ``sep`` field of each line."""
    keyed = df.select(field_at(col, sep, index, on_missing).alias("key"))
    return count_by(keyed, "key")


def top_k(df: DataFrame, k: int, by: str = "count", *, tie_break: Sequence[str] | str | None = None,
          ascending: bool = False) -> DataFrame:
    """First ``k`` rows by ``by`` (descending by default), ties broken by the other columns.

    Planned as TakeOrderedAndProject: each partition keeps its own k, one task
    merges at most k x partitions rows; the input is never fully sorted.
    """
    if k < 0:
        raise ValueError("k must be >= 0")
    if tie_break is None:
        tie_break = [c for c in df.columns if c != by]
    elif isinstance(tie_break, str):
        tie_break = [tie_break]
    main = col_of(by).asc() if ascending else col_of(by).desc()
    return df.orderBy(main, *[col_of(c).asc() for c in tie_break]).limit(k)


def row_counts(tables: Mapping[str, DataFrame]) -> DataFrame:
    """``(table_name, row_count)``, one row per named DataFrame."""
    parts = [df.agg(F.count(F.lit(1)).alias("row_count"))
             .select(F.lit(name).alias("table_name"), "row_count")
             for name, df in tables.items()]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out


def head(df: DataFrame, n: int, order_by: Sequence[str] | str | None = None) -> DataFrame:
    """First ``n`` rows; with ``order_by`` the choice is stable."""
    if order_by is not None:
        df = df.orderBy(*[col_of(c) for c in ([order_by] if isinstance(order_by, str) else order_by)])
    return df.limit(n)
