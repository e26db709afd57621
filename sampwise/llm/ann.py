"""Approximate nearest neighbours by balanced posting lists in memory-resident centroids.

Nearness is the largest inner product.  Vectors get one more component that brings all to
the greatest norm, queries a zero there and the same norm, so the order by inner product is
the order by distance.

1. *Vectors.*  Equal vectors are one entry with the ``k + 1`` smallest of their ids: no query
   can have use of more of them, so a vector that fills a third of the table costs one row.
2. *Centroids.*  Lloyd steps on a sample of at most ``FIT_ROWS`` vectors (those of least hash);
   after every step lists with less than half their share move into those with twice it or more,
   which keeps the lists balanced.  There are about ``2 sqrt(rows)`` centroids, ``MOST_LISTS`` at most: the only
   things broadcast, with their neighbour graph, at most a few MB at any size.
3. *Posting lists.*  Every vector goes to its nearest list; a boundary vector also to lists
   whose centroids are within ``REPLICA_RATIO`` of the nearest distance and closer to the vector than
   to a list chosen before (at most ``REPLICAS``).  Lists that follow each other along the graph
   make a lane; lanes are cut into pieces of about ``PIECE_BYTES`` of vectors, so a long list is
   many pieces.
4. *Search.*  Every different query vector walks the centroid graph best first.  Its base is the distance
   at which the lists found hold ``BASE_ROWS`` times k rows; it takes every list
   within ``PROBE_RATIO`` of the base (distance-ratio pruning: few lists where the data are
   clustered, most of them where nothing is near).  There is no limit of lists.
5. *Scan.*  Queries meet the pieces of their lanes, in pieces of about ``QUERY_BYTES``;
   scores are inner products of the original vectors in double precision, added up in the
   order of the components.  Each piece gives its best ``k + 1``, merged per query.

Only which lists are read is approximate: the centroids are fitted on a sample, but every row
is indexed.  Measured recall is in the README.

Defined cases: rows with a null id, and vectors that are null, empty, zero, or hold a null or non-finite
component, take no part; missing trailing components count as zero; rows that repeat an id
and vector count once; a candidate with the query's id is its own; equal scores go to the
smaller id; fewer than k candidates give all that the lists hold; an empty table gives an empty
result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from sampwise.llm.shared import stored

FIT_ROWS, MOST_LISTS, LLOYD_STEPS = 65_536, 4_096, 8
REPLICAS, REPLICA_RATIO = 4, 1.02
DEGREE, FAR_LINKS, ENTRIES = 16, 4, 8
BASE_ROWS, PROBE_RATIO = 25, 1.18
PIECE_BYTES, QUERY_BYTES = 4 << 20, 2 << 20


def distances(x: np.ndarray, centroids: np.ndarray) -> np.ndarray:
    d = (x * x).sum(axis=1)[:, None] + (centroids * centroids).sum(axis=1)[None, :] - 2 * (x @ centroids.T)
    return np.sqrt(np.maximum(d, 0))


def fit_centroids(sample: np.ndarray, n_lists: int, steps: int = LLOYD_STEPS) -> np.ndarray:
    """Balanced Lloyd steps: lists with less than half their share move into those with twice it."""
    centroids = sample[np.linspace(0, len(sample) - 1, n_lists).astype(int)].copy()
    share = len(sample) / n_lists
    for step in range(steps):
        own = np.concatenate([distances(sample[at:at + 4096], centroids).argmin(axis=1)
                              for at in range(0, len(sample), 4096)])
        size = np.bincount(own, minlength=n_lists)
        total = np.zeros_like(centroids)
        np.add.at(total, own, sample)
        full = size > 0
        centroids[full] = total[full] / size[full, None]
        if step == steps - 1:
            break
        small = [x for x in np.argsort(size, kind="stable") if size[x] < share / 2]
        for big in np.argsort(-size, kind="stable"):
            more = int(size[big] // share) - 1
            if more < 1 or not small:
                break
            members = np.flatnonzero(own == big)
            for at in np.linspace(0, len(members) - 1, more).astype(int):
                if small:
                    centroids[small.pop(0)] = sample[members[at]]
    return centroids


def centroid_graph(centroids: np.ndarray) -> np.ndarray:
    """(lists, links): the nearest other centroids, and a few far ones that keep it connected."""
    n = len(centroids)
    near = np.empty((n, min(DEGREE, n - 1)), dtype=np.int64)
    for at in range(0, n, 1024):
        d = distances(centroids[at:at + 1024], centroids)
        d[np.arange(len(d)), np.arange(at, at + len(d))] = np.inf
        near[at:at + 1024] = np.argsort(d, axis=1, kind="stable")[:, :near.shape[1]]
    # a ring through all lists, and steps that halve it: every list can be reached
    steps = [max(1, n >> s) for s in range(1, FAR_LINKS)] + [1]
    far = (np.arange(n)[:, None] + np.array(steps)[None, :]) % n
    return np.concatenate([near, far], axis=1)


def chain(graph: np.ndarray) -> np.ndarray:
    """Each list's place in a walk of the graph that goes on to an unvisited neighbour where it can."""
    n = len(graph)
    place, at, rest = np.full(n, -1), 0, 0
    for k in range(n):
        place[at] = k
        ahead = [x for x in graph[at] if place[x] < 0]
        while rest < n and place[rest] >= 0:
            rest += 1
        at = ahead[0] if ahead else rest
    return place


def select_lists(queries: np.ndarray, centroids: np.ndarray, graph: np.ndarray, sizes: np.ndarray,
                 rows: int, ratio: float) -> np.ndarray:
    """(queries, lists) boolean: best-first walks of the graph from a few entries.

    A walk goes on while a visited list within ``ratio`` of the base is not expanded; the base
    is the distance at which the visited lists, nearest first, hold ``rows`` rows.
    """
    n, m = len(queries), len(centroids)
    dist = np.full((n, m), np.inf)
    norm = (centroids * centroids).sum(axis=1)
    expanded = np.zeros((n, m), dtype=bool)
    new = np.zeros((n, m), dtype=bool)
    new[:, np.unique(np.linspace(0, m - 1, min(ENTRIES, m)).astype(int))] = True
    while True:
        q, c = np.nonzero(new)
        dot = np.empty(len(q))
        for at in range(0, len(q), 1 << 16):
            s = slice(at, at + (1 << 16))
            dot[s] = np.einsum("ij,ij->i", queries[q[s]], centroids[c[s]])
        dist[q, c] = np.sqrt(np.maximum((queries[q] ** 2).sum(axis=1) + norm[c] - 2 * dot, 0))
        order = np.argsort(dist, axis=1, kind="stable")
        ranked = np.take_along_axis(dist, order, axis=1)
        held = np.cumsum(np.where(np.isfinite(ranked), sizes[order], 0), axis=1)
        base = np.take_along_axis(ranked, np.minimum((held < rows).sum(axis=1), m - 1)[:, None], axis=1)
        inside = np.isfinite(dist) & (dist <= base * ratio)
        todo = inside & ~expanded
        if not todo.any():
            return inside & (sizes[None, :] > 0)
        # the nearer half of what is open at a time, so that far lists are not opened too early
        limit = np.where(todo, dist, np.inf).min(axis=1, keepdims=True)
        step = todo & (dist <= limit * (1 + (ratio - 1) / 2))
        expanded |= step
        q, c = np.nonzero(step)
        reached = np.zeros((n, m), dtype=bool)
        reached[q[:, None], graph[c]] = True
        new = reached & ~np.isfinite(dist)


def assign_lists(x: np.ndarray, centroids: np.ndarray, between: np.ndarray) -> list[np.ndarray]:
    """The lists of each vector: the nearest and, near a boundary, a few more on other sides."""
    d = distances(x, centroids)
    most = min(REPLICAS, len(centroids))
    near = np.argpartition(d, most - 1, axis=1)[:, :most]
    near = np.take_along_axis(near, np.argsort(np.take_along_axis(d, near, axis=1), axis=1, kind="stable"), axis=1)
    dn = np.take_along_axis(d, near, axis=1)
    take = dn <= dn[:, :1] * REPLICA_RATIO
    for j in range(1, most):
        for i in range(j):
            take[:, j] &= ~take[:, i] | (between[near[:, i], near[:, j]] >= dn[:, j])
    take[:, 0] = True
    return [near[r, take[r]] for r in range(len(x))]


def _numbers(column: pa.Array, dims: int) -> np.ndarray:
    sizes = np.diff(column.offsets.to_numpy())
    out = np.zeros((len(column), dims))
    out[np.arange(dims) < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return out


def _lifted(x: np.ndarray, greatest: float) -> np.ndarray:
    rest = np.sqrt(np.maximum(greatest ** 2 - (x * x).sum(axis=1), 0))
    return np.concatenate([x, rest[:, None]], axis=1)


def _unit_query(x: np.ndarray, greatest: float) -> np.ndarray:
    size = np.sqrt((x * x).sum(axis=1, keepdims=True))
    return np.concatenate([x * (greatest / size), np.zeros((len(x), 1))], axis=1)


def plain_scores(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Row-wise inner products, added up in the order of the components."""
    out = np.zeros(len(a))
    for j in range(a.shape[1]):
        out += a[:, j] * b[:, j]
    return out


_POSTING_SQL = "list int, entry long, least long, ids array<long>, vector binary"
_ASKED_SQL = "lane int, entry long, lists array<int>, vector binary"


def _slices(n: int, width: int) -> Iterator[slice]:
    step = max(64, (1 << 21) // max(1, width))
    return (slice(at, at + step) for at in range(0, n, step))


def _post(centroids: np.ndarray, dims: int, unit: float, greatest: float):
    between = distances(centroids, centroids)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in _slices(len(batch), len(centroids)):
                part = batch.slice(s.start, s.stop - s.start)
                x = _numbers(part.column("v"), dims)
                lists = assign_lists(_lifted(x / unit, greatest), centroids, between)
                row = np.repeat(np.arange(len(lists)), [len(y) for y in lists])
                blobs = pa.array([v.tobytes() for v in x], pa.binary())
                flat = np.concatenate(lists).astype(np.int32) if lists else np.zeros(0, np.int32)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(flat), *[part.column(c).take(pa.array(row)) for c in ("entry", "least", "ids")],
                     blobs.take(pa.array(row))], names=["list", "entry", "least", "ids", "vector"])
    return run


def _ask(centroids, graph, sizes, lane_of, dims: int, unit: float, greatest: float, rows: int, ratio: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for s in _slices(len(batch), 8 * len(centroids)):
                part = batch.slice(s.start, s.stop - s.start)
                x = _numbers(part.column("v"), dims)
                chosen = select_lists(_unit_query(x / unit, greatest), centroids, graph, sizes, rows, ratio)
                entry = part.column("entry").to_numpy()
                q, c = np.nonzero(chosen)
                order = np.lexsort((c, lane_of[c], q))
                q, c = q[order], c[order]
                if not len(q):
                    continue
                cut = np.flatnonzero(np.r_[True, (q[1:] != q[:-1]) | (lane_of[c[1:]] != lane_of[c[:-1]])])
                lists = pa.ListArray.from_arrays(pa.array(np.append(cut, len(q)), pa.int32()),
                                                 pa.array(c, pa.int32()))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(lane_of[c[cut]], pa.int32()), pa.array(entry[q[cut]]), lists,
                     pa.array([x[i].tobytes() for i in q[cut]], pa.binary())],
                    names=["lane", "entry", "lists", "vector"])
    return run


_HIT_SQL = "asked long, entry long, least long, ids array<long>, score double"


def _scan(dims: int, k: int):
    def run(_, posts: pd.DataFrame, asked: pd.DataFrame) -> pd.DataFrame:
        none = pd.DataFrame({"asked": [], "entry": [], "least": [], "ids": [], "score": []})
        if not len(posts) or not len(asked):
            return none
        x = np.frombuffer(b"".join(posts["vector"]), "<f8").reshape(-1, dims)
        q = np.frombuffer(b"".join(asked["vector"]), "<f8").reshape(-1, dims)
        held, entry, least = (posts[c].to_numpy() for c in ("list", "entry", "least"))
        wants = asked["lists"].tolist()
        who = np.repeat(np.arange(len(wants)), [len(w) for w in wants])
        what = np.concatenate([np.asarray(w) for w in wants])
        found_q, found_x, found_s = [], [], []
        for one in np.unique(held):
            rows, qs = np.flatnonzero(held == one), who[what == one]
            if not len(qs):
                continue
            for at in range(0, len(qs), 1024):  # a tile of at most 1024 queries
                few = qs[at:at + 1024]
                s = q[few] @ x[rows].T
                best = (np.argpartition(-s, k - 1, axis=1)[:, :k] if len(rows) > k
                        else np.broadcast_to(np.arange(len(rows)), s.shape))
                found_q.append(np.repeat(few, best.shape[1]))
                found_x.append(rows[best.ravel()])
                found_s.append(np.take_along_axis(s, best, axis=1).ravel())
        if not found_q:
            return none
        fq, fx, fs = (np.concatenate(f) for f in (found_q, found_x, found_s))
        order = np.lexsort((entry[fx], fq))  # a boundary vector may come from several lists
        fq, fx, fs = fq[order], fx[order], fs[order]
        new = np.r_[True, (fq[1:] != fq[:-1]) | (entry[fx[1:]] != entry[fx[:-1]])]
        fq, fx, fs = fq[new], fx[new], fs[new]
        order = np.lexsort((least[fx], -fs, fq))
        fq, fx = fq[order], fx[order]
        best = np.arange(len(fq)) - np.searchsorted(fq, fq) < k
        fq, fx = fq[best], fx[best]
        return pd.DataFrame({"asked": asked["entry"].to_numpy()[fq], "entry": entry[fx], "least": least[fx],
                             "ids": posts["ids"].to_numpy()[fx], "score": plain_scores(q[fq], x[fx])})
    return run


def usable_vectors(vectors: DataFrame, id_col: str, vector_col: str, is_query: Column) -> DataFrame:
    doubles = F.transform(vector_col, lambda x: x.cast("double"))
    fine = F.forall(doubles, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf")))
    some = F.exists(doubles, lambda x: x != 0)
    return (vectors.select(F.col(id_col).cast("long").alias("id"), F.when(fine & some, doubles).alias("v"),
                           F.coalesce(is_query, F.lit(False)).alias("is_query"))
            .where("id IS NOT NULL AND v IS NOT NULL")
            .groupBy("id", "v").agg(F.max("is_query").alias("is_query")))


def nearest(vectors: DataFrame, is_query: Column, id_col: str = "vec_id", vector_col: str = "embedding",
            k: int = 20, ratio: float = PROBE_RATIO, fit_rows: int = FIT_ROWS) -> DataFrame:
    """Rows (query_id, rank, vec_id, score): the k nearest found for each query row."""
    rows = stored(usable_vectors(vectors, id_col, vector_col, is_query), "ann-rows")
    by_id = Window.partitionBy("v").orderBy("id")
    few = rows.withColumn("place", F.row_number().over(by_id)).where(F.col("place") <= k + 1)
    entries = stored(few.groupBy("v").agg(F.sort_array(F.collect_list("id")).alias("ids"))
                     .select(F.monotonically_increasing_id().alias("entry"), "v", "ids",
                             F.element_at("ids", 1).alias("least")), "ann-entries")
    dims, n, unit = entries.agg(
        F.coalesce(F.max(F.size("v")), F.lit(1)), F.count("*"),
        F.coalesce(F.max(F.array_max(F.transform("v", lambda x: F.abs(x)))), F.lit(1.0))).first()
    # lists are chosen on vectors in units of the greatest component: squares stay finite
    square = F.aggregate("v", F.lit(0.0), lambda a, x: a + (x / F.lit(unit)) * (x / F.lit(unit)))
    greatest = entries.agg(F.coalesce(F.sqrt(F.max(square)), F.lit(1.0))).first()[0]
    n_lists = int(max(1, min(2 * np.sqrt(n), MOST_LISTS, n)))
    sample = (entries.select("v", F.xxhash64("v").alias("h")).orderBy("h", "v")
              .limit(min(16 * n_lists, fit_rows)).select("v").toArrow())
    if not sample.num_rows:
        return rows.select(F.col("id").alias("query_id"), F.lit(0).alias("rank"), F.col("id").alias("vec_id"),
                           F.lit(0.0).alias("score")).limit(0)
    centroids = fit_centroids(_lifted(_numbers(sample.column("v").combine_chunks(), dims) / unit, greatest), n_lists)
    graph = centroid_graph(centroids) if n_lists > 1 else np.zeros((1, 1), dtype=np.int64)

    posts = stored(entries.mapInArrow(_post(centroids, dims, unit, greatest), _POSTING_SQL), "ann-postings")
    sizes = np.zeros(n_lists, dtype=np.int64)
    for r in posts.groupBy("list").count().collect():  # a row per list, at most MOST_LISTS
        sizes[r["list"]] = r["count"]
    post_rows, ask_rows = (max(256, size // (8 * dims)) for size in (PIECE_BYTES, QUERY_BYTES))
    place = chain(graph)
    along = np.argsort(place, kind="stable")
    lane_of = np.zeros(n_lists, dtype=np.int32)
    lane_of[along] = (np.cumsum(sizes[along]) - sizes[along]) // post_rows
    lane_rows = np.bincount(lane_of, weights=sizes).astype(int)

    queries = rows.where("is_query").select(F.col("id").alias("query_id"), "v")
    asked_entries = queries.select("v").distinct().join(entries.select("entry", "v"), "v")
    ask = _ask(centroids, graph, sizes, lane_of, dims, unit, greatest, BASE_ROWS * k, ratio)
    asked = stored(asked_entries.select("entry", "v").mapInArrow(ask, _ASKED_SQL), "ann-asked")
    asked_rows = np.zeros(len(lane_rows), dtype=np.int64)
    for r in asked.groupBy("lane").count().collect():  # a row per lane
        asked_rows[r["lane"]] = r["count"]

    # pieces of a lane: every posting meets every query piece, every query every posting piece
    spark = vectors.sparkSession
    lane_list = F.array(*[F.lit(int(x)) for x in lane_of])
    pieces_p = F.array(*[F.lit(int(max(1, -(-x // post_rows)))) for x in lane_rows])
    pieces_q = F.array(*[F.lit(int(max(1, -(-x // ask_rows)))) for x in asked_rows])
    lane = F.element_at(lane_list, F.col("list") + 1)
    all_of = lambda pieces, at: F.explode(F.sequence(F.lit(0), F.element_at(pieces, at + 1) - 1))
    one_of = lambda pieces, at: F.pmod(F.xxhash64("entry"), F.element_at(pieces, at + 1))
    left = (posts.withColumn("lane", lane).withColumn("piece", one_of(pieces_p, F.col("lane")).cast("int"))
            .withColumn("q_piece", all_of(pieces_q, F.col("lane"))))
    right = (asked.withColumn("q_piece", one_of(pieces_q, F.col("lane")).cast("int"))
             .withColumn("piece", all_of(pieces_p, F.col("lane"))))
    key = ["lane", "piece", "q_piece"]
    hits = left.groupBy(*key).cogroup(right.groupBy(*key)).applyInPandas(_scan(dims, k + 1), _HIT_SQL)
    order = Window.partitionBy("asked").orderBy(F.desc("score"), "least")
    best = (hits.dropDuplicates(["asked", "entry"]).withColumn("place", F.row_number().over(order))
            .where(F.col("place") <= k + 1)
            .groupBy("asked").agg(F.collect_list(F.struct("score", "ids")).alias("found")))
    named = queries.join(entries.select(F.col("entry").alias("asked"), "v"), "v").select("query_id", "asked")
    flat = (named.join(best, "asked").select("query_id", F.explode("found").alias("f"))
            .select("query_id", "f.score", F.explode("f.ids").alias("vec_id"))
            .where("query_id <> vec_id"))
    rank = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    return (flat.dropDuplicates(["query_id", "vec_id"]).withColumn("rank", F.row_number().over(rank))
            .where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score"))
