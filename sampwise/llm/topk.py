"""Exact top-k inner products by an impact-ordered, score-at-a-time index.

Index: the vectors, as whole numbers, are cut into blocks of ``block_rows``.  In a
block every component that is not zero is a posting (dimension, row, value); the
postings are put into *segments* by quantised impact, the power of two above the
value's size.  A stored block row holds the ids and its segments from the highest
impact down: the postings in order of dimension and row, and per row the norm of
everything in lower segments.  The vectors themselves are not stored.

Search: a block of queries meets a block of the index and adds the segments' postings to
the scores by descending impact.  After a segment, the true score of every row lies within
``accumulated +- |query| * |rest of row|`` (Cauchy-Schwarz).  Rows whose upper end is
below the k-th best lower end cannot be members.  Processing stops only when this
proof leaves few rows for each query, or all segments are done; the rows left are
rescored exactly in whole numbers.  Every block gives each query its best k; a task keeps
the best k of its blocks so far, whose last score is one more lower end for the next block,
and a per-query merge picks the final k.  Nothing is approximate.

Every query must meet every block: each part of the query blocks is a task with each part of
the stored index, which is read in place (``every_pair``).  Blocks are not copied or broadcast.
Memory per task is one part of query blocks with their best rows (a block, or ``HELD_BYTES``) and
what the reader holds of the index.

Defined cases: vectors that are null, empty, or hold a null or non-finite component,
and rows with a null id, take no part; missing trailing components count as zero; rows
that repeat an id and vector count once; a candidate with the query's id is its own;
equal scores go to the smaller id; fewer than k candidates give them all; an empty
table gives an empty result; other columns are ignored.  Scores are exact while
the products' sums stay below 2^53.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sampwise.llm.shared import asked_parts, every_pair, shuffle_width, stored


def _matrix(column: pa.ListArray, dims: int) -> np.ndarray:
    """Rows of doubles, zero-padded to ``dims``."""
    sizes = np.diff(column.offsets.to_numpy())
    flat = column.flatten().to_numpy(zero_copy_only=False)
    out = np.zeros((len(column), dims))
    out[np.arange(dims) < sizes[:, None]] = flat
    return out


def _blocks(dims: int, block_rows: int, content, schema: pa.Schema):
    """Rows cut into blocks in id order; ``content`` makes a block's column from its matrix."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made, ids, rows = 0, [], []

        def block(ids, rows):
            order = np.argsort(ids, kind="stable")
            ids, values = ids[order], rows[order]
            name = (TaskContext.get().partitionId() << 32) + made
            return pa.RecordBatch.from_pylist(
                [{"block": name, "ids": ids.astype("<i8").tobytes(), schema.names[2]: content(values)}],
                schema=schema)

        for batch in batches:
            ids.append(batch.column("id").to_numpy())
            rows.append(_matrix(batch.column("v"), dims))
            while sum(map(len, ids)) >= block_rows:
                i, r = np.concatenate(ids), np.concatenate(rows)
                yield block(i[:block_rows], r[:block_rows])
                made += 1
                ids, rows = [i[block_rows:]], [r[block_rows:]]
        if sum(map(len, ids)):
            yield block(np.concatenate(ids), np.concatenate(rows))
    return run


_SEGMENT = pa.struct([("impact", pa.int32()), ("at", pa.binary()), ("values", pa.binary()),
                      ("rests", pa.binary())])
_INDEX = pa.schema([("block", pa.int64()), ("ids", pa.binary()), ("segments", pa.list_(_SEGMENT))])
_INDEX_SQL = ("block long, ids binary, "
              "segments array<struct<impact:int,at:binary,values:binary,rests:binary>>")
_ASKED = pa.schema([("block", pa.int64()), ("ids", pa.binary()), ("vectors", pa.binary())])
_ASKED_SQL = "block long, ids binary, vectors binary"
_HITS = pa.schema([("query_id", pa.int64()), ("score", pa.int64()), ("vec_id", pa.int64())])
_HITS_SQL = "query_id long, score long, vec_id long"


def _value_type(impact: int) -> str:
    """The narrowest type for whole numbers below 2^impact in size."""
    return "<i2" if impact <= 15 else "<i4" if impact <= 31 else "<f8"


def _place_type(places: int) -> str:
    return "<u2" if places <= 1 << 16 else "<i4"


def impact_segments(vectors: np.ndarray) -> list[dict]:
    """The postings of a block from the highest impact down.

    ``impact`` is the exponent of the power of two above the values' size, ``at`` the place
    dimension * rows + row of each posting, ``rests`` the norm per row of all lower segments.
    """
    rows = len(vectors)
    flat = vectors.T.ravel()
    at = np.flatnonzero(flat)
    _, impact = np.frexp(np.abs(flat[at]))
    below, out = np.zeros(rows), []
    for x in np.unique(impact):
        mine = at[impact == x]
        out.append({"impact": int(x), "at": mine.astype(_place_type(flat.size)).tobytes(),
                    "values": flat[mine].astype(_value_type(x)).tobytes(),
                    "rests": np.sqrt(below).astype("<f8").tobytes()})
        below = below + np.bincount(mine % rows, weights=flat[mine] ** 2, minlength=rows)
    return out[::-1]


def postings(segment: dict, dims: int, rows: int) -> np.ndarray:
    """A segment's postings in place, one row per dimension."""
    out = np.zeros(dims * rows)
    out[np.frombuffer(segment["at"], _place_type(out.size))] = np.frombuffer(segment["values"],
                                                                             _value_type(segment["impact"]))
    return out.reshape(dims, rows)


def search_block(queries: np.ndarray, query_ids: np.ndarray, segments: list[dict],
                 ids: np.ndarray, k: int, stop_at: int = 8,
                 reached: np.ndarray | None = None) -> list[tuple[int, int, int]]:
    """The k best (query id, score, id) of one block for every query, exactly.

    ``ids`` ascend, so the first of equal scores is the smaller id.  ``reached`` is a score per
    query that k rows of other blocks have; rows below it are left out.
    """
    dims, rows_n = queries.shape[1], len(ids)
    size = np.sqrt((queries * queries).sum(axis=1))[:, None]
    got = np.zeros((len(queries), rows_n))
    own = query_ids[:, None] == ids[None, :]
    got[own] = -np.inf
    kth = min(k, rows_n)
    possible, done = ~own, 0
    for segment in segments:
        got += queries @ postings(segment, dims, rows_n)
        done += 1
        slack = size * np.frombuffer(segment["rests"], "<f8")[None, :] * (1 + 1e-12)
        floor = np.partition(got - slack, rows_n - kth, axis=1)[:, rows_n - kth]
        if reached is not None:
            floor = np.maximum(floor, reached)
        possible = (got + slack >= floor[:, None]) & ~own
        if possible.sum() <= stop_at * k * len(queries):
            break  # proven: every member is among the possible rows
    rows, cols = np.nonzero(possible)
    exact = got[rows, cols]
    if done < len(segments) and len(rows):
        left = np.zeros((rows_n, dims))
        for segment in segments[done:]:
            left += postings(segment, dims, rows_n).T
        exact = exact + np.einsum("ij,ij->i", queries[rows], left[cols])
    order = np.lexsort((ids[cols], -exact, rows))
    rows, cols, exact = rows[order], cols[order], exact[order]
    rank = np.arange(len(rows)) - np.searchsorted(rows, rows)
    best = rank < k
    return list(zip(query_ids[rows[best]].tolist(), exact[best].astype(np.int64).tolist(),
                    ids[cols[best]].tolist()))


def best_hits(hits: np.ndarray, k: int) -> np.ndarray:
    """Of rows (query id, score, id) the k best of each query, queries ascending."""
    hits = hits[np.lexsort((hits[:, 2], -hits[:, 1], hits[:, 0]))]
    return hits[np.arange(len(hits)) - np.searchsorted(hits[:, 0], hits[:, 0]) < k]


def reached_scores(best: np.ndarray, query_ids: np.ndarray, k: int) -> np.ndarray:
    """The k-th best score of each query so far, or minus infinity."""
    first = np.searchsorted(best[:, 0], query_ids)
    full = np.searchsorted(best[:, 0], query_ids, side="right") - first == k
    out = np.full(len(query_ids), -np.inf)
    out[full] = best[first[full] + k - 1, 1]
    return out


def _search(dims: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, np.ndarray] = {}  # by query block
        held = None
        for batch in batches:
            for at in range(len(batch)):  # one pair of blocks in memory at a time
                value = lambda c: batch.column(c)[at].as_py()  # noqa: B023, E731
                if held != value("block"):  # an index block meets the query blocks one after another
                    held, ids, segments = value("block"), np.frombuffer(value("ids"), "<i8"), value("segments")
                asked, q_ids = value("q_block"), np.frombuffer(value("q_ids"), "<i8")
                old = best.get(asked, np.zeros((0, 3), dtype=np.int64))
                hits = search_block(np.frombuffer(value("q_vectors"), "<f8").reshape(len(q_ids), dims), q_ids,
                                    segments, ids, k, reached=reached_scores(old, q_ids, k))
                if hits:
                    best[asked] = best_hits(np.concatenate([old, np.array(hits, dtype=np.int64)]), k)
        for rows in best.values():
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in rows.T], schema=_HITS)
    return run


def whole_numbers(vector: str, factor: int = 256) -> Column:
    """Each component x as floor(factor * x), x as double; null if any is null or not finite."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when((F.size(vector) > 0) & fine,
                  F.transform(doubles, lambda x: F.floor(x * factor).cast("double")))


def top_k(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding",
          k: int = 5, factor: int = 256, block_rows: int = 1024) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k best of all rows for each query row."""
    spark = vectors.sparkSession
    usable = (vectors.select(F.col(id_col).cast("long").alias("id"),
                             whole_numbers(vector_col, factor).alias("v"),
                             is_query.alias("is_query"))
              .where("id IS NOT NULL AND v IS NOT NULL"))
    rows = stored(usable.groupBy("id", "v").agg(F.max("is_query").alias("is_query")), "topk-rows")
    dims, n, n_asked = rows.agg(F.coalesce(F.max(F.size("v")), F.lit(1)), F.count("*"),
                                F.count_if("is_query")).first()

    def in_blocks(part, n, content, schema, sql, tag):
        few = part.select("id", "v").coalesce(max(1, -(-n // block_rows)))  # whole blocks
        return stored(few.mapInArrow(_blocks(dims, block_rows, content, schema), sql), tag)

    index = in_blocks(rows, n, impact_segments, _INDEX, _INDEX_SQL, "topk-index")
    asked = in_blocks(rows.where("is_query"), n_asked, lambda m: m.astype("<f8").tobytes(),
                      _ASKED, _ASKED_SQL, "topk-queries")
    parts = asked_parts(-(-n_asked // block_rows), 8 * (dims + 1 + 3 * k) * block_rows, shuffle_width(spark))
    queries = asked.select(*[F.col(c).alias(f"q_{c}") for c in asked.columns])
    hits = every_pair(queries, index, parts).mapInArrow(_search(dims, k), _HITS_SQL)
    order = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (hits.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
