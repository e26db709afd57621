import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from sampwise.llm import hardneg
from tests.llm.conftest import with_clashes


@pytest.mark.parametrize("shape", [(1, 1, 1), (5, 3, 7), (33, 65, 17), (64, 64, 64), (70, 20, 301)])
def test_strassen_is_exact(shape):
    rng = np.random.default_rng(sum(shape))
    n, d, m = shape
    a, b = rng.integers(-10**6, 10**6, (n, d)), rng.integers(-10**6, 10**6, (d, m))
    assert (hardneg.strassen(a, b, leaf=2) == a @ b).all()
    assert (hardneg.strassen(a, b) == a @ b).all()


def test_strassen_near_the_ends_of_a_long():
    a = np.full((40, 40), 2**28, dtype=np.int64)
    assert (hardneg.strassen(a, a * 2, leaf=2) == a @ (a * 2)).all()


def test_window_bounds_do_not_overflow():
    s = np.array([[7, -7, 2**62, -2**62, 0]])
    low, top = hardneg.window_bounds(s, 80, 100)
    assert low.tolist() == [[6, -5, -((-80 * 2**62) // 100), -((80 * 2**62) // 100), 0]]
    assert top.tolist() == s.tolist()


def brute(rows, n_pos=5, n_neg=5):
    """rows: (id, vector, label); everything in Python integers."""
    held = {}
    for i, v, lab in rows:
        if i is None or lab is None or v is None or any(x is None or not np.isfinite(x) for x in v):
            continue
        if i % 7 == 0:
            lab = (lab + 1) % 10
        w = (lab, [int(np.floor(256 * float(x))) for x in v])
        held[i] = min(held.get(i, w), w)
    dot = lambda a, b: sum(x * y for x, y in zip(a, b))
    out = []
    for a, (la, va) in held.items():
        if a % 100:
            continue
        scored = sorted((-dot(va, v), i, lab) for i, (lab, v) in held.items() if i != a)
        for ps, p, _ in [x for x in scored if x[2] == la][:n_pos]:
            fits = [x for x in scored if x[2] != la and 80 * -ps <= 100 * -x[0] <= 100 * -ps][:n_neg]
            out += [(a, p, r + 1, x[1], -ps, -x[0]) for r, x in enumerate(fits)]
    return sorted(out)


def mine(spark, rows, **kw):
    df = with_clashes(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    out = hardneg.hard_negatives(df, F.col("vec_id") % 100 == 0, label, **kw)
    assert out.columns == ["anchor_id", "positive_id", "rank", "negative_id", "positive_score", "negative_score"]
    return sorted(tuple(r) for r in out.collect())


def clustered(n, dims=9, copies=40):
    rng = np.random.default_rng(n)
    heart = rng.normal(size=(6, dims))
    x = heart[rng.integers(0, 6, n)] + 0.2 * rng.normal(size=(n, dims))
    x[:copies] = heart[0]  # equal vectors: ties
    return [(int(i), [float(np.float32(v)) for v in x[i]], int(rng.integers(0, 10))) for i in range(n)]


def test_equals_brute_force_in_small_tiles(spark):
    rows = clustered(700)
    got = mine(spark, rows, block_rows=64, anchor_rows=3)
    assert got == brute(rows) and len(got) > 50


def test_hostile_rows(spark):
    rows = clustered(250)
    odd = [(None, [1.0] * 9, 1), (300, None, 1), (301, [1.0, None], 1), (302, [float("nan")] * 9, 2),
           (303, [float("inf")] * 9, 2), (304, [1.0] * 9, None), (400, [], 3), (305, [0.5], 3), rows[0], rows[1],
           (100, [9.0] * 9, 9), (500, [-1.0] * 9, 4)]
    assert mine(spark, rows + odd) == brute(rows + odd)


def test_few_rows_and_none(spark):
    assert mine(spark, []) == []
    assert mine(spark, [(0, [1.0], 1)]) == []
    rows = [(0, [1.0, 0.0], 1), (1, [0.9, 0.0], 2), (2, [1.0, 0.0], 2), (3, [1.0, 0.1], 1)]
    assert mine(spark, rows) == brute(rows)


def test_anchor_blocks_are_neither_copied_nor_broadcast(spark):
    """Copied to as many lanes as there are shuffle partitions and broadcast, they outgrew the driver."""
    df = spark.createDataFrame(clustered(300), "vec_id long, embedding array<float>, label int")
    out = hardneg.hard_negatives(df, F.col("vec_id") % 20 == 0, F.col("label"), block_rows=32, anchor_rows=4)
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Broadcast" not in plan and "Generate" not in plan and "CartesianProduct" in plan


def plain_heaps(found, k):
    out = []
    for key in sorted({(r[0], r[1]) for r in found}):
        out += sorted((r for r in found if (r[0], r[1]) == key), key=lambda r: (-r[4], r[3]))[:k]
    return out


def test_heaps_keep_the_best_of_their_union():
    rng = np.random.default_rng(3)
    found = np.column_stack([rng.integers(0, 4, 500), rng.integers(0, 3, 500), np.zeros(500, np.int64),
                             np.arange(500), rng.integers(-5, 5, 500)]).astype(np.int64)
    found[:2, 4] = -2**63, 2**63 - 1
    got = hardneg.best_of_heaps(found, 5)
    assert [tuple(r) for r in got.tolist()] == plain_heaps([tuple(r) for r in found.tolist()], 5)
    assert hardneg.best_of_heaps(found[:0], 5).shape == (0, 5)


@pytest.mark.parametrize("merge_rows", [0, 1 << 16])
def test_a_task_gives_each_anchor_its_heap_over_all_tiles(monkeypatch, merge_rows):
    monkeypatch.setattr(hardneg, "MERGE_ROWS", merge_rows)
    rng = np.random.default_rng(9)
    v, label = rng.integers(-50, 50, (200, 6)), rng.integers(0, 3, 200)
    rows = [{"ids": np.arange(b, b + 50), "labels": label[b:b + 50], "vectors": v[b:b + 50],
             "a_ids": np.arange(a, a + 8), "a_labels": label[a:a + 8], "a_vectors": v[a:a + 8]}
            for b in range(0, 200, 50) for a in (0, 8)]
    rows = [{c: np.ascontiguousarray(x, dtype="<i8").tobytes() for c, x in r.items()} for r in rows]
    batches = [pa.RecordBatch.from_pylist(rows[:3]), pa.RecordBatch.from_pylist(rows[3:])]
    got = [tuple(r.values()) for b in hardneg._tiles(6, 1, 5, None)(batches) for r in b.to_pylist()]
    found = [(a, 0, 0, i, int(v[a] @ v[i])) for a in range(16) for i in range(200) if i != a and label[a] == label[i]]
    assert got == plain_heaps(found, 5)
    assert list(hardneg._tiles(6, 1, 5, None)(iter([]))) == []
