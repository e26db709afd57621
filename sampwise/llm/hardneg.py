"""Hard negatives by exact integer tile products and mergeable heaps.

An anchor's *positives* are its ``n_positive`` best rows of the same label; for each
positive, its *hard negatives* are the best ``n_negative`` rows of another label whose score
lies in the window ``low * positive <= 100 * negative <= high * positive`` (per cent).

1. *Tiles.*  Rows become blocks of whole-number vectors; anchors become blocks of their own.
   Every anchor block must meet every candidate block: each part of the anchor blocks is a task
   with each part of the stored candidate blocks, which are read in place (``every_pair``).  Blocks
   are not copied or broadcast.  A task holds its anchor blocks with their heaps (a block, or
   ``HELD_BYTES``) and what the reader holds of the candidates.
2. *Products.*  A tile's scores are one matrix product by Strassen's recursion: both sides
   are cut into quarters, padded with zero rows and columns where a side is odd, seven
   products of sums replace eight, down to ``LEAF`` columns.  All sums are int64, so every
   score is the exact inner product (as long as it fits 64 bits; sums wrap modulo 2^64 on
   the way, which the recursion survives because it only adds, subtracts and multiplies).
3. *Heaps.*  A tile gives each anchor its best few positives, at most ``n_positive`` rows; heaps
   merge by taking the best of their union, which a task does over its tiles (``best_of_heaps``)
   and Spark over the tasks, so no task ever holds an anchor's candidates.  The window
   heaps follow in a second pass over the same tiles, keyed by (anchor, positive), as the
   window is known only once the positives are.

Nothing is sampled, capped or approximate: each pass reads every anchor-candidate pair.

Defined cases: rows with a null id, label or vector, or with a null or non-finite component
take no part; missing trailing components (and an empty vector) count as zero; components
beyond a long are the nearest long; of rows that share an id the one with the least (label,
vector) takes part, so exact repeats count once; equal scores go to the smaller id; fewer
rows than asked for give them all; a positive without a row in its window gives none; an
empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sampwise.llm.shared import asked_parts, every_pair, shuffle_width, stored

LEAF = 16
ANCHOR_ROWS, BLOCK_ROWS = 256, 1024
#: Found rows that a task gathers before it merges its heaps.
MERGE_ROWS = 1 << 16
_LEAST = np.iinfo(np.int64).min


def strassen(a: np.ndarray, b: np.ndarray, leaf: int = LEAF) -> np.ndarray:
    """The exact int64 product ``a @ b`` by Strassen's recursion with zero padding."""
    (n, d), m = a.shape, b.shape[1]
    if min(n, d, m) <= leaf:
        return a @ b
    a, b = _even(a), _even(b)
    h, i, j = a.shape[0] // 2, a.shape[1] // 2, b.shape[1] // 2
    a11, a12, a21, a22 = a[:h, :i], a[:h, i:], a[h:, :i], a[h:, i:]
    b11, b12, b21, b22 = b[:i, :j], b[:i, j:], b[i:, :j], b[i:, j:]
    p1 = strassen(a11 + a22, b11 + b22, leaf)
    p2 = strassen(a21 + a22, b11, leaf)
    p3 = strassen(a11, b12 - b22, leaf)
    p4 = strassen(a22, b21 - b11, leaf)
    p5 = strassen(a11 + a12, b22, leaf)
    p6 = strassen(a21 - a11, b11 + b12, leaf)
    p7 = strassen(a12 - a22, b21 + b22, leaf)
    out = np.empty((2 * h, 2 * j), dtype=np.int64)
    out[:h, :j] = p1 + p4 - p5 + p7
    out[:h, j:] = p3 + p5
    out[h:, :j] = p2 + p4
    out[h:, j:] = p1 - p2 + p3 + p6
    return out[:n, :m]


def _even(x: np.ndarray) -> np.ndarray:
    """``x`` with a zero row or column where its side is odd."""
    odd = (x.shape[0] % 2, x.shape[1] % 2)
    return np.pad(x, ((0, odd[0]), (0, odd[1]))) if any(odd) else x


def best_of_rows(scores: np.ndarray, ids: np.ndarray, allowed: np.ndarray, k: int):
    """(row, column) of each row's ``k`` best allowed scores; ``ids`` ascend, ties to the smaller."""
    held = np.where(allowed, scores, _LEAST)
    if k < held.shape[1]:
        floor = np.partition(held, held.shape[1] - k, axis=1)[:, held.shape[1] - k]
        allowed = allowed & (held >= floor[:, None])
    rows, cols = np.nonzero(allowed)
    order = np.lexsort((ids[cols], ~scores[rows, cols], rows))
    rows, cols = rows[order], cols[order]
    best = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
    return rows[best], cols[best]


def window_of_rows(scores: np.ndarray, allowed: np.ndarray, top: np.ndarray, low: np.ndarray,
                   known: np.ndarray, k: int):
    """(row, heap, column) of the ``k`` best allowed scores between ``low`` and ``top`` per row and heap.

    ``top``, ``low`` and ``known`` are (rows, heaps); columns ascend by id.
    """
    held = np.where(allowed, scores, _LEAST)
    order = np.argsort(~held, axis=1, kind="stable")  # ~x descends as x ascends, without overflow
    ranked = np.take_along_axis(held, order, axis=1)
    usable = np.take_along_axis(allowed, order, axis=1)
    out = []
    for h in range(top.shape[1]):
        first = (ranked > top[:, h:h + 1]).sum(axis=1)
        at = first[:, None] + np.arange(min(k, scores.shape[1]))[None, :]
        inside = at < scores.shape[1]
        at = np.minimum(at, scores.shape[1] - 1)
        fine = (inside & known[:, h:h + 1] & np.take_along_axis(usable, at, axis=1)
                & (np.take_along_axis(ranked, at, axis=1) >= low[:, h:h + 1]))
        rows, place = np.nonzero(fine)
        out.append((rows, np.full(len(rows), h), order[rows, at[rows, place]]))
    return tuple(np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, int),) * 3


_BLOCK = pa.schema([("block", pa.int64()), ("ids", pa.binary()), ("labels", pa.binary()),
                    ("vectors", pa.binary()), ("heap_ids", pa.binary()), ("heap_scores", pa.binary()),
                    ("heap_sizes", pa.binary())])
_BLOCK_SQL = ("block long, ids binary, labels binary, vectors binary, heap_ids binary, "
              "heap_scores binary, heap_sizes binary")


def _padded(column: pa.ListArray, width: int) -> np.ndarray:
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), width), dtype=np.int64)
    out[np.arange(width) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _blocks(dims: int, heaps: int, block_rows: int):
    """Rows (id, label, v, heap_ids, heap_scores) into blocks, ids ascending in each."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, made = [], 0

        def block(parts):
            nonlocal made
            order = np.argsort(parts[0], kind="stable")
            made += 1
            row = [np.ascontiguousarray(p[order]).tobytes() for p in parts]
            return pa.RecordBatch.from_pylist([dict(zip(
                _BLOCK.names, [(TaskContext.get().partitionId() << 32) + made, *row]))], schema=_BLOCK)

        for batch in batches:
            hid = batch.column("heap_ids")
            held.append([batch.column("id").to_numpy(), batch.column("label").to_numpy(),
                         _padded(batch.column("v"), dims), _padded(hid, heaps),
                         _padded(batch.column("heap_scores"), heaps),
                         np.diff(hid.offsets.to_numpy()).astype(np.int64)])
            while sum(len(p[0]) for p in held) >= block_rows:
                whole = [np.concatenate(x) for x in zip(*held)]
                yield block([x[:block_rows] for x in whole])
                held = [[x[block_rows:] for x in whole]]
        if sum(len(p[0]) for p in held):
            yield block([np.concatenate(x) for x in zip(*held)])
    return run


_FOUND = pa.schema([("anchor_id", pa.int64()), ("positive_id", pa.int64()), ("positive_score", pa.int64()),
                    ("vec_id", pa.int64()), ("score", pa.int64())])
_FOUND_SQL = "anchor_id long, positive_id long, positive_score long, vec_id long, score long"


def window_bounds(scores: np.ndarray, low: int, high: int) -> tuple[np.ndarray, np.ndarray]:
    """The least and greatest whole number n with ``low * s <= 100 n <= high * s``, without overflow."""
    least = [-((-low * int(s)) // 100) for s in scores.ravel()]
    most = [(high * int(s)) // 100 for s in scores.ravel()]
    clip = lambda x: np.array([min(max(y, -2 ** 63), 2 ** 63 - 1) for y in x], dtype=np.int64)
    return clip(least).reshape(scores.shape), clip(most).reshape(scores.shape)


def best_of_heaps(found: np.ndarray, k: int) -> np.ndarray:
    """Of rows as in ``_FOUND`` the ``k`` best of each heap (anchor, positive)."""
    found = found[np.lexsort((found[:, 3], ~found[:, 4], found[:, 1], found[:, 0]))]
    place = np.arange(len(found))
    new = np.r_[True, (found[1:, :2] != found[:-1, :2]).any(axis=1)][:len(found)]
    return found[place - np.maximum.accumulate(np.where(new, place, 0)) < k]


def _tiles(dims: int, heaps: int, k: int, window: tuple[int, int] | None):
    """Tiles to heaps: the best of the anchor's label, or the windows of its positives."""
    def tile(num):
        a_ids, ids = num("a_ids"), num("ids")
        scores = strassen(num("a_vectors").reshape(len(a_ids), dims), num("vectors").reshape(len(ids), dims).T)
        same = num("a_labels")[:, None] == num("labels")[None, :]
        if window is None:
            rows, cols = best_of_rows(scores, ids, same & (a_ids[:, None] != ids[None, :]), k)
            pid = ps = np.zeros(len(rows), dtype=np.int64)
        else:
            h_ids, h_scores = (num(c).reshape(len(a_ids), heaps) for c in ("a_heap_ids", "a_heap_scores"))
            low, top = window_bounds(h_scores, *window)
            known = np.arange(heaps)[None, :] < num("a_heap_sizes")[:, None]
            rows, h, cols = window_of_rows(scores, ~same, top, low, known, k)
            pid, ps = h_ids[rows, h], h_scores[rows, h]
        return np.column_stack([a_ids[rows], pid, ps, ids[cols], scores[rows, cols]])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best, found = np.zeros((0, len(_FOUND)), dtype=np.int64), []
        for batch in batches:
            for at in range(len(batch)):
                found.append(tile(lambda c: np.frombuffer(batch.column(c)[at].as_py(), "<i8")))  # noqa: B023
                if sum(map(len, found)) > MERGE_ROWS + len(best):
                    best, found = best_of_heaps(np.concatenate([best, *found]), k), []
        best = best_of_heaps(np.concatenate([best, *found]), k)
        if len(best):
            yield pa.RecordBatch.from_arrays([pa.array(c) for c in best.T], schema=_FOUND)
    return run


def _merged(found: DataFrame, by: list[str], k: int) -> DataFrame:
    """Heaps of tasks merged: the ``k`` best rows of each key, ranked from 1."""
    order = Window.partitionBy(*by).orderBy(F.desc("score"), "vec_id")
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def whole_vector(vector: str, factor: int) -> Column:
    """Each component x as the long floor(factor * x), x as double; null if any is null or not finite."""
    doubles = F.transform(vector, lambda x: x.cast("double"))
    fine = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    return F.when(fine, F.transform(doubles, lambda x: F.floor(x * factor).cast("long")))


def hard_negatives(vectors: DataFrame, is_anchor: Column, label: Column, *, id_col: str = "vec_id",
                   vector_col: str = "embedding", n_positive: int = 5, n_negative: int = 5,
                   low: int = 80, high: int = 100, factor: int = 256, block_rows: int = BLOCK_ROWS,
                   anchor_rows: int = ANCHOR_ROWS) -> DataFrame:
    """Rows (anchor_id, positive_id, rank, negative_id, positive_score, negative_score)."""
    spark = vectors.sparkSession
    usable = (vectors.select(F.col(id_col).cast("long").alias("id"), label.cast("long").alias("label"),
                             whole_vector(vector_col, factor).alias("v"), is_anchor.alias("is_anchor"))
              .where("id IS NOT NULL AND label IS NOT NULL AND v IS NOT NULL"))
    one = usable.groupBy("id").agg(F.min(F.struct("label", "v")).alias("r"),
                                   F.max(F.coalesce("is_anchor", F.lit(False))).alias("is_anchor"))
    none = F.array().cast("array<long>")
    rows = stored(one.select("id", "r.label", "r.v", "is_anchor", none.alias("heap_ids"),
                             none.alias("heap_scores")), "hard-rows")
    dims, n, n_anchors = rows.agg(F.coalesce(F.max(F.size("v")), F.lit(1)), F.count("*"),
                                  F.count_if("is_anchor")).first()
    dims = max(1, dims)

    def in_blocks(part, n, size, heaps, tag):
        few = part.select("id", "label", "v", "heap_ids", "heap_scores").coalesce(max(1, -(-n // size)))
        return stored(few.mapInArrow(_blocks(dims, heaps, size), _BLOCK_SQL), tag)

    index = in_blocks(rows, n, block_rows, 1, "hard-index").select("ids", "labels", "vectors")

    def tiles(anchors, heaps, k, window):
        blocks = in_blocks(anchors, n_anchors, anchor_rows, heaps, "hard-anchors")
        asked = blocks.select(*[F.col(c).alias(f"a_{c}") for c in blocks.columns if c != "block"])
        parts = asked_parts(-(-n_anchors // anchor_rows),
                            8 * (dims + 2 * heaps + 3 + 5 * heaps * k) * anchor_rows, shuffle_width(spark))
        return every_pair(asked, index, parts).mapInArrow(_tiles(dims, heaps, k, window), _FOUND_SQL)

    anchors = rows.where("is_anchor")
    positives = _merged(tiles(anchors, 1, n_positive, None), ["anchor_id"], n_positive)
    heaps = (positives.groupBy("anchor_id").agg(F.sort_array(F.collect_list(F.struct("rank", "vec_id", "score"))).alias("h"))
             .select(F.col("anchor_id").alias("id"), F.col("h.vec_id").alias("heap_ids"),
                     F.col("h.score").alias("heap_scores")))
    with_heaps = anchors.drop("heap_ids", "heap_scores").join(stored(heaps, "hard-positives"), "id")
    found = tiles(with_heaps, n_positive, n_negative, (low, high))
    return (_merged(found, ["anchor_id", "positive_id"], n_negative)
            .select("anchor_id", "positive_id", "rank", F.col("vec_id").alias("negative_id"),
                    "positive_score", F.col("score").alias("negative_score")))
