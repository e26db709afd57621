"""Trees of all experiments grown together, against a plain recursion and under other layouts."""

import math
import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from sampwise.operators.trees import grow, poisson_weight
from sampwise.plans.batched import run_tree_experiments
from sampwise.plans.experiments import RESULT_SCHEMA

SCHEMA = "experiment int, key long, is_train boolean, y int, a double, b double, c string"


def rows(n, seed=0, classes=2, experiments=2):
    rng = random.Random(seed)
    out = []
    for e in range(experiments):
        for k in range(n):
            a, b, c = rng.choice([1.0, 2.0, 3.0, 5.0, None]), float(rng.randrange(4)), rng.choice("pqrst")
            y = (int((a or 0) > 2) + int(c in "pq") + int(b == 3)) % classes if rng.random() < 0.85 else rng.randrange(classes)
            out.append((e, k, rng.random() < 0.7, y, a, b, None if c == "t" and k % 2 else c))
    return out


def plain_tree(data, classes, depth):
    """Predictions of test rows by a recursion over row lists (features a, b numeric, c a category)."""
    low = -math.inf
    borders = []
    for f in (4, 5):
        v = sorted({low if r[f] is None else r[f] for r in data if r[2]})
        borders.append([-1.7976931348623157e308 if x == low else (x + z) / 2 for x, z in zip(v, v[1:])])

    def bins(r):
        number = [sum((low if r[f] is None else r[f]) > t for t in borders[f - 4]) for f in (4, 5)]
        return [*number, "" if r[6] is None else "=" + r[6]]

    def counts(part):
        n = Counter(r[3] for r, _ in part if r[2])
        return [n[c] for c in range(classes)]

    def gini(n):
        return 1 - sum((x / sum(n)) ** 2 for x in n)

    def guess(part):
        n = counts(part)
        return max(range(classes), key=lambda c: (n[c], -c))

    out = {}

    def split(part, level):
        n, best = counts(part), None
        if level < depth:
            main = max(range(classes), key=lambda c: (n[c], -c))
            for f in range(3):
                cells = {}
                for r, b in part:
                    if r[2]:
                        cells.setdefault(b[f], []).append((r, b))
                rank = {x: x if f < 2 else -counts(p)[main] / len(p) for x, p in cells.items()}
                order = sorted(cells, key=lambda x: (rank[x], str(x)))
                for k in range(1, len(order)):
                    left = set(order[:k])
                    nl = [sum(counts(cells[x])[c] for x in left) for c in range(classes)]
                    nr = [x - y for x, y in zip(n, nl)]
                    gain = round(gini(n) - sum(nl) / sum(n) * gini(nl) - sum(nr) / sum(n) * gini(nr), 12)
                    at = (gain, -f, -rank[order[k - 1]], str(order[k - 1]))
                    if gain > 0 and (best is None or at > best[0]):
                        best = (at, f, order[k - 1] if f < 2 else left)
        if best is None:
            for r, _ in part:
                if not r[2]:
                    out[r[1]] = guess(part)
            return
        _, f, cut = best
        goes = lambda b: b[f] <= cut if f < 2 else b[f] in cut
        for side in (True, False):
            split([(r, b) for r, b in part if goes(b) == side], level + 1)

    split([(r, bins(r)) for r in data], 0)
    return out


@pytest.mark.parametrize("classes, depth", [(2, 1), (2, 3), (3, 3)])
def test_equals_a_plain_recursion(spark, classes, depth):
    data = rows(300, seed=classes + depth, classes=classes)
    df = spark.createDataFrame(data, SCHEMA)
    nodes, got = grow(df, n_classes=classes, numeric=["a", "b"], categorical=["c"], depth=depth)
    found = {(r["experiment"], r["key"]): r["prediction"] for r in got.collect()}
    want = {(e, k): p for e in (0, 1) for k, p in plain_tree([r for r in data if r[0] == e], classes, depth).items()}
    assert found == want
    assert nodes.agg(F.max("level")).first()[0] == depth


def test_same_forest_in_every_layout(spark):
    data = rows(250, seed=7)
    seen = []
    for n in (4, 8, 50):
        df = spark.createDataFrame(data, SCHEMA).orderBy(F.rand(n)).repartition(n)
        nodes, got = grow(df, n_classes=2, numeric=["a", "b"], categorical=["c"], depth=3, trees=50,
                          bootstrap=True, subset=2, seed=5)
        seen.append((sorted(map(repr, nodes.collect())), sorted(map(repr, got.collect()))))
    assert seen[0] == seen[1] == seen[2]
    trees = {tuple(r) for r in nodes.where("node = 1").select("tree", "feature", "cut").collect()}
    assert len({t[0] for t in trees}) == 50 and len({t[1:] for t in trees}) > 1


def test_bootstrap_weights_are_poisson(spark):
    df = spark.range(20_000).select(F.col("id").alias("key"), F.lit(1).alias("experiment"))
    w = df.select(F.explode(poisson_weight(3, 2, F.col("key"))).alias("d")).groupBy("d.tree", "d.w").count().collect()
    n = {(r["tree"], r["w"]): r["count"] / 20_000 for r in w}
    for tree in (0, 1):
        for k in (0, 1, 2, 3):
            assert n[tree, float(k)] == pytest.approx(math.exp(-1) / math.factorial(k), abs=0.015)


def test_as_many_levels_as_rows(spark):
    """15,000 levels: the cut puts every training row right, unknown levels go to the right child."""
    df = spark.range(15_000).select(
        F.lit(1).alias("experiment"), F.col("id").alias("key"), (F.col("id") % 5 > 0).alias("is_train"),
        (F.xxhash64("id") % 3 == 0).cast("int").alias("y"), F.concat(F.lit("Customer "), "id").alias("c"))
    nodes, got = grow(df, n_classes=2, numeric=[], categorical=["c"], depth=1)
    leaves = {r["node"]: r["classes"] for r in nodes.where("level = 1").collect()}
    assert leaves[2][1] == 0 and leaves[3][0] == 0 and sum(leaves[2]) + sum(leaves[3]) == 12_000
    assert got.select("prediction").distinct().collect() == [(1,)] and got.count() == 3000


def test_odd_rows(spark):
    data = [(1, 1, True, 0, float("nan"), None, None), (1, 2, True, 1, 1.0, float("inf"), ""),
            (1, 3, True, None, 2.0, 1.0, "x"), (1, 4, False, 1, None, -1.0, "unseen"), (1, 5, False, 0, 9.0, 2.0, None),
            (2, 1, False, 0, 1.0, 1.0, "x"), (3, 1, True, 1, 1.0, 1.0, "x"), (3, 2, False, 0, 1.0, 1.0, "x")]
    nodes, got = grow(spark.createDataFrame(data, SCHEMA), n_classes=2, numeric=["a", "b"], categorical=["c"], depth=4)
    assert sorted(map(tuple, got.collect()), key=repr) == [
        (1, 4, 1, 0), (1, 5, 0, 1), (2, 1, 0, None), (3, 2, 0, 1)]
    none = spark.createDataFrame([], SCHEMA)
    assert grow(none, n_classes=2, numeric=["a"], depth=2)[1].collect() == []
    with pytest.raises(ValueError):
        grow(none, n_classes=2, numeric=[])


def test_quantile_borders_learn_a_threshold(spark):
    df = spark.range(6000).select(F.lit(1).alias("experiment"), F.col("id").alias("key"), (F.col("id") % 4 > 0).alias("is_train"),
                                  (F.col("id") > 2000).cast("int").alias("y"), F.sqrt("id").alias("a"))
    _, got = grow(df, n_classes=2, numeric=["a"], depth=2, max_bins=32)
    assert got.agg(F.avg((F.col("y") == F.col("prediction")).cast("double"))).first()[0] > 0.96


def test_experiments_with_clashing_names(spark):
    df = spark.range(400).select(F.col("id").alias("y"), (F.col("id") % 2).alias("key"), F.lit(1).alias("a.b"),
                                 F.when(F.col("id") % 2 == 0, "u").otherwise("v").alias("experiment"))
    out = run_tree_experiments(df, label="key", numeric=["a.b"], categorical=["experiment"], key="y", step=5,
                               offsets=[0, 3, 3], depth=2)
    assert out.columns == RESULT_SCHEMA.names
    got = sorted(map(tuple, out.collect()))
    assert [r[0] for r in got] == [1, 2, 3] and all(r[2] == 80 and r[5] == 1.0 and r[6] is None for r in got)
