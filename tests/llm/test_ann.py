import numpy as np
import pytest
from pyspark.sql import functions as F

from sampwise.llm import ann
from tests.llm.conftest import with_clashes


def usable(rows):
    return {(i, tuple(v)) for i, v in rows
            if i is not None and v and all(x is not None and np.isfinite(x) for x in v) and any(v)}


def brute(rows, k=20, every=20):
    held = usable(rows)
    dims = max((len(v) for _, v in held), default=1)
    out = {}
    for q, qv in held:
        if q % every:
            continue
        best = {}
        for i, v in held:
            if i != q:
                a, b = np.zeros(dims), np.zeros(dims)
                a[:len(qv)], b[:len(v)] = qv, v
                s = 0.0
                for x, y in zip(a, b):
                    s += x * y
                best[i] = max(best.get(i, -np.inf), s)
        out[q] = sorted((-s, i) for i, s in best.items())[:k]
    return out


def run(spark, rows, every=20, **kw):
    df = with_clashes(spark.createDataFrame(rows, "vec_id long, embedding array<float>, label int"))
    out = ann.nearest(df, F.col("vec_id") % every == 0, **kw)
    assert out.columns == ["query_id", "rank", "vec_id", "score"]
    got = {}
    for r in out.orderBy("query_id", "rank").collect():
        got.setdefault(r["query_id"], []).append((-r["score"], r["vec_id"]))
        assert r["rank"] == len(got[r["query_id"]])
    return got


def vectors(n, dims, hearts, seed=0, spread=0.1):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, dims))
    if hearts:
        x = rng.normal(size=(hearts, dims))[rng.integers(0, hearts, n)] + spread * x
    x = (x * rng.uniform(0.5, 2, (n, 1))).astype(np.float32)  # norms differ
    return [(i, [float(v) for v in x[i]], 0) for i in range(n)]


def recall(got, want):
    return np.mean([len({i for _, i in got.get(q, [])} & {i for _, i in w}) / max(1, len(w)) for q, w in want.items()])


@pytest.mark.parametrize("hearts", [0, 30])
def test_recall_against_brute_force(spark, hearts):
    rows = vectors(3000, 16, hearts)
    want, got = brute([r[:2] for r in rows]), run(spark, rows)
    assert set(got) == set(want) and all(len(g) == 20 for g in got.values())
    assert recall(got, want) >= 0.9
    true = {q: {i: s for s, i in brute([r[:2] for r in rows], k=3000)[q]} for q in list(want)[:5]}
    for q in true:  # scores are the measure itself
        assert all(true[q][i] == s for s, i in got[q])


def test_copies_fill_a_third(spark):
    rows = vectors(900, 8, 12)
    rows = [(i, rows[0][1] if i % 3 == 0 else v, 0) for i, v, _ in rows]
    want, got = brute([r[:2] for r in rows]), run(spark, rows)
    assert recall(got, want) >= 0.9
    for q in (0, 60, 120):  # ties go to the smaller id, the query itself left out
        assert [i for _, i in got[q]] == [i for _, i in want[q]]


def test_hostile_rows(spark):
    rows = [r[:2] for r in vectors(40, 4, 0)]
    odd = [(None, [1.0, 0.0, 0.0, 0.0]), (41, None), (42, []), (43, [0.0] * 4), (44, [float("nan"), 1.0]), (45, [1.0, None]),
           (46, [float("-inf")]), (47, [2.0]), (48, [1e30, 1.0]), (60, [1.0, 1.0]), rows[0], rows[20], (20, [3.0])]
    rows = rows + odd
    got, want = run(spark, [(*r, 0) for r in rows]), brute(rows)
    assert {q: [i for _, i in g] for q, g in got.items() if q != 20} == {
        q: [i for _, i in w] for q, w in want.items() if q != 20}
    assert len(got[20]) == 20


def test_no_rows_and_one(spark):
    assert run(spark, []) == {}
    assert run(spark, [(0, [1.0, 2.0], 0)]) == {}
    assert run(spark, [(0, [1.0], 0), (1, [-1.0], 0)]) == {0: [(1.0, 1)]}


def test_graph_reaches_every_list():
    rng = np.random.default_rng(1)
    c = np.concatenate([rng.normal(size=(60, 5)) * 0.01 + k * 100 for k in range(5)])
    graph = ann.centroid_graph(c)
    assert sorted(ann.chain(graph)) == list(range(300))
    chosen = ann.select_lists(c[:7] + 1e-3, c, graph, np.ones(300, int), rows=10, ratio=1e9)
    assert chosen.all()


def test_centroids_are_balanced():
    rng = np.random.default_rng(2)
    x = np.concatenate([rng.normal(size=(3000, 6)) * 0.05, rng.normal(size=(1000, 6)) + 5])
    d = ann.distances(x, ann.fit_centroids(x, 40))
    assert np.bincount(d.argmin(axis=1), minlength=40).max() < 8 * 100
