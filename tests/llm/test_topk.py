import math

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sampwise.llm import shared, topk
from sampwise.llm.topk import impact_segments, postings, search_block, top_k
from tests.llm.conftest import with_clashes


def brute(rows, is_query, k=5):
    use = sorted({(i, tuple(math.floor(256 * float(np.float32(x))) for x in v)) for i, v in rows
                  if i is not None and v and all(x is not None and math.isfinite(x) for x in v)})
    out = []
    for q, a in use:
        if is_query(q):
            best = sorted((-sum(x * y for x, y in zip(a, b)), i) for i, b in use if i != q)[:k]
            out += [(q, rank + 1, i, -s) for rank, (s, i) in enumerate(best)]
    return sorted(out)


def run(spark, rows, **options):
    df = with_clashes(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    got = top_k(df, F.col("vec_id") % 3 == 0, **options).collect()
    return sorted((r["query_id"], r["rank"], r["vec_id"], r["score"]) for r in got)


@pytest.mark.parametrize("block_rows", [1024, 7])
def test_matches_brute_force(spark, block_rows):
    rng = np.random.default_rng(4)
    rows = [(i, rng.normal(scale=0.2, size=12).tolist()) for i in range(60)]
    rows += [(100 + i, rows[i][1]) for i in range(20)]  # ties
    assert run(spark, rows, block_rows=block_rows) == brute(rows, lambda q: q % 3 == 0)


def test_hostile_rows(spark):
    rows = [(0, [0.5, -0.5]), (3, [0.0, 0.0]), (3, [0.0, 0.0]), (1, None), (2, []), (4, [None, 1.0]),
            (5, [float("nan"), 1.0]), (6, [float("inf"), 1.0]), (None, [1.0, 1.0]), (7, [1.0]), (8, [1.0, 2.0, 3.0]),
            (9, [-1.0, 0.004])]
    assert run(spark, rows) == brute(rows, lambda q: q % 3 == 0)
    assert run(spark, rows[:1]) == []
    assert run(spark, [(1, [1.0])]) == []


def test_empty_table(spark):
    df = spark.createDataFrame([], "vec_id long, embedding array<float>")
    assert top_k(df, F.col("vec_id") % 3 == 0).collect() == []


@pytest.mark.parametrize("seed", range(4))
def test_stopping_keeps_every_member(seed):
    """The search stops early on spread-out impacts and is still exact."""
    rng = np.random.default_rng(seed)
    vectors = np.floor(rng.standard_t(2, size=(400, 16)) * 40)
    queries, ids = vectors[::40], np.arange(400)
    got = search_block(queries, ids[::40], impact_segments(vectors), ids, 5)
    scores = queries @ vectors.T
    for row, q in enumerate(ids[::40].tolist()):
        best = sorted((-s, i) for i, s in enumerate(scores[row]) if i != q)[:5]
        assert [(-s, i) for a, s, i in got if a == q] == [(s, i) for s, i in best]


@pytest.mark.parametrize("scale", [0.5, 100, 3e4, 1e12])
def test_segments_hold_every_posting_by_impact(scale):
    vectors = np.floor(np.random.default_rng(0).normal(size=(50, 8)) * scale)
    segments = impact_segments(vectors)
    parts = [postings(s, 8, 50).T for s in segments]
    assert np.array_equal(sum(parts), vectors)
    assert sum(np.count_nonzero(p) for p in parts) == np.count_nonzero(vectors)
    impacts = [s["impact"] for s in segments]
    assert impacts == sorted(set(impacts), reverse=True)
    for k, (s, part) in enumerate(zip(segments, parts)):
        sizes = np.abs(part[part != 0])
        assert (sizes < 2.0 ** s["impact"]).all() and (sizes >= 2.0 ** (s["impact"] - 1)).all()
        below = sum(parts[k + 1:], np.zeros_like(vectors))
        assert np.allclose(np.frombuffer(s["rests"], "<f8"), np.sqrt((below ** 2).sum(axis=1)))


def test_the_proof_stops_before_the_low_impacts():
    """Segments behind the proof are read for the rows left only; the result is whole."""
    rng = np.random.default_rng(5)
    vectors = np.floor(rng.normal(size=(300, 16)))
    vectors[:40, 0] = 1000 * np.arange(40, 0, -1)
    segments = impact_segments(vectors)
    got = search_block(vectors[:1], np.array([0]), segments, np.arange(300), 5)
    scores = vectors @ vectors[0]
    assert [(s, i) for _, s, i in got] == [(scores[i], i) for i in range(1, 6)]
    top = segments[:6]  # what lies below cannot change the order, only the scores
    assert [i for _, _, i in search_block(vectors[:1], np.array([0]), top, np.arange(300), 5)] == [1, 2, 3, 4, 5]


def test_query_blocks_are_neither_copied_nor_broadcast(spark):
    """Copied to as many lanes as there are shuffle partitions and broadcast, they outgrew the driver."""
    rng = np.random.default_rng(6)
    df = spark.createDataFrame([(i, rng.normal(size=8).tolist()) for i in range(200)],
                               "vec_id long, embedding array<float>")
    plan = top_k(df, F.col("vec_id") % 3 == 0, block_rows=16)._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "Generate" not in plan and "CartesianProduct" in plan


@pytest.mark.parametrize("blocks,block_bytes,width,parts",
                         [(0, 8, 8, 1), (1, 8, 200, 1), (15, 600_000, 200, 15), (16_000, 600_000, 200, 573),
                          (16_000, 600, 200, 200), (40, 64 << 20, 8, 40)])
def test_asked_parts_are_bounded(blocks, block_bytes, width, parts):
    assert shared.asked_parts(blocks, block_bytes, width) == parts


@pytest.mark.parametrize("parts", [1, 3, 20])
def test_every_pair_meets_once(spark, parts):
    got = shared.every_pair(spark.range(20), spark.range(31).withColumnRenamed("id", "x"), parts).collect()
    assert sorted((r["id"], r["x"]) for r in got) == [(i, x) for i in range(20) for x in range(31)]


def test_rows_below_what_is_reached_are_left_out():
    rng = np.random.default_rng(7)
    vectors = np.floor(rng.normal(size=(300, 16)) * 60)
    ids, scores = np.arange(300), vectors[:4] @ vectors.T
    for reached in (-np.inf, 0.0, 1.0, 1e9):
        at = np.array([np.sort(s)[-4] for s in scores]) if reached == 1.0 else np.full(4, reached)
        got = search_block(vectors[:4], ids[:4], impact_segments(vectors), ids, 5, reached=at)
        for row in range(4):
            best = sorted((-s, i) for i, s in enumerate(scores[row]) if i != row)[:5]
            assert [(-s, i) for q, s, i in got if q == row and s >= at[row]] == [(s, i) for s, i in best if -s >= at[row]]


def test_a_task_gives_each_query_its_best_k_over_all_blocks():
    """One task's tiles: two query blocks, one of an id with two vectors, against four index blocks."""
    rng = np.random.default_rng(8)
    vectors = np.floor(rng.normal(size=(400, 8)) * 60)
    asked = [(0, np.arange(0, 20), vectors[:20]), (1, np.array([30, 30]), vectors[[30, 31]])]
    rows = [{"block": b, "ids": np.arange(b, b + 100).astype("<i8").tobytes(),
             "segments": impact_segments(vectors[b:b + 100]), "q_block": a,
             "q_ids": q.astype("<i8").tobytes(), "q_vectors": v.astype("<f8").tobytes()}
            for b in range(0, 400, 100) for a, q, v in asked]
    got = [tuple(r.values()) for t in topk._search(8, 5)([pa.RecordBatch.from_pylist(rows[:3]), pa.RecordBatch.from_pylist(rows[3:])])
           for r in t.to_pylist()]
    want = []
    for q in [*range(20), 30]:
        found = [(-int(vectors[a] @ vectors[i]), i) for a in ([30, 31] if q == 30 else [q]) for i in range(400) if i != q]
        want += [(q, -s, i) for s, i in sorted(found)[:5]]
    assert sorted(got) == sorted(want)


@pytest.mark.parametrize("rows", [1024, 1025])
def test_places_of_small_and_large_blocks(rows):
    vectors = np.floor(np.random.default_rng(1).normal(size=(rows, 64)) * 40)
    segments = impact_segments(vectors)
    assert np.array_equal(sum(postings(s, 64, rows).T for s in segments), vectors)
    assert len(segments[0]["at"]) == (2 if rows == 1024 else 4) * np.count_nonzero(postings(segments[0], 64, rows))
