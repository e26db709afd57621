"""Batched linear SVMs: objective against a dual bound, layouts, defined cases, code tables."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from sampwise.operators.features import index_columns, level_codes, with_level_codes
from sampwise.operators.models import linear_svm
from sampwise.operators.svm import fit_svms, scaled, scales
from sampwise.plans.batched import run_svm_experiments
from sampwise.plans.experiments import run_experiments


def noisy(seed, n=150, d=3):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d)) * [1.0, 50.0, 0.01][:d] + [5.0, -1e4, 0.0][:d]
    centred = (x - x.mean(0)) / x.std(0)
    y = np.where(centred.sum(1) + 1.5 * rng.normal(size=n) > 0.4, 1.0, -1.0)
    return x, y


def dual_bound(x, y, reg, rounds=20_000):
    """A lower bound of the least objective: the dual value after pairwise steps on the worst pair."""
    z = (x - x.mean(0)) / x.std(0, ddof=1)
    n = len(y)
    kernel, alpha, top = z @ z.T / reg, np.zeros(n), 1.0 / n
    grad = np.ones(n)  # of sum(alpha) - 1/2 (alpha y) K (alpha y), along alpha
    for _ in range(rounds):
        score = y * grad
        up = np.where(((y > 0) & (alpha < top)) | ((y < 0) & (alpha > 0)), score, -np.inf)
        down = np.where(((y > 0) & (alpha > 0)) | ((y < 0) & (alpha < top)), score, np.inf)
        i, j = up.argmax(), down.argmin()
        if up[i] - down[j] < 1e-9:
            break
        step = (up[i] - down[j]) / max(kernel[i, i] + kernel[j, j] - 2 * kernel[i, j], 1e-12)
        step = min(step, top - alpha[i] if y[i] > 0 else alpha[i], alpha[j] if y[j] > 0 else top - alpha[j])
        alpha[i] += step * y[i]
        alpha[j] -= step * y[j]
        grad = 1 - y * (kernel @ (alpha * y))
    return alpha.sum() - 0.5 * (alpha * y) @ kernel @ (alpha * y)


def objective(model, x, y, reg):
    loss = np.maximum(0, 1 - y * (x @ model.coefficients + model.intercept)).mean()
    return loss + reg / 2 * ((model.coefficients * x.std(0, ddof=1)) ** 2).sum()


def table(spark, samples):
    rows = [(e, *map(float, row), float(s)) for e, (x, y) in samples.items() for row, s in zip(x, y)]
    d = next(iter(samples.values()))[0].shape[1]
    names = [f"x{k}" for k in range(d)]
    return spark.createDataFrame(rows, f"experiment int, {', '.join(c + ' double' for c in names)}, side double"), names


def fitted(rows, names, **options):
    by = scales(rows, names)
    return fit_svms(scaled(rows, names, by).cache(), names, by, **options)


@pytest.mark.parametrize("reg", [0.1, 0.01])
def test_objective_within_a_millionth_of_the_optimum(spark, reg):
    samples = {e: noisy(e) for e in (1, 2, 5)}
    rows, names = table(spark, samples)
    models = fitted(rows.repartition(5), names, reg_param=reg)
    for e, (x, y) in samples.items():
        value = objective(models[e], x, y, reg)
        assert value == pytest.approx(models[e].objective, abs=1e-9)
        assert models[e].gap <= 1e-6 and models[e].passes < 100
        assert -1e-9 <= value - dual_bound(x, y, reg) <= 1e-6


def test_layouts_and_other_experiments_change_nothing(spark):
    samples = {e: noisy(e) for e in (1, 2)}
    rows, names = table(spark, samples)
    one = fitted(rows.coalesce(1), names)
    many = fitted(rows.repartition(7), names)
    alone = fitted(table(spark, {2: samples[2]})[0], names)
    for other, e in ((many, 1), (many, 2), (alone, 2)):
        assert other[e].objective == pytest.approx(one[e].objective, abs=1e-6)
        assert other[e].coefficients == pytest.approx(one[e].coefficients, rel=1e-2, abs=1e-2)


def test_constant_feature_repeats_and_one_pass(spark):
    x, y = noisy(3)
    x[:, 1] = 0.1
    rows, names = table(spark, {1: (x, y)})
    model = fitted(rows, names)[1]
    assert model.coefficients[1] == 0.0 and model.gap <= 1e-6
    twice = fitted(rows.union(rows), names)[1]  # the sample deviation changes a little
    assert twice.objective == pytest.approx(model.objective, abs=1e-3)
    short = fitted(rows, names, max_iter=1)[1]
    assert short.passes == 1 and short.objective == pytest.approx(1.0)
    with pytest.raises(ValueError):
        fitted(rows, names, reg_param=0)


def test_agrees_with_the_single_fits(spark):
    x, y = noisy(11, n=600)
    rows = [(k, *map(float, r), "up" if s > 0 else "down", "abc"[k % 3]) for k, (r, s) in enumerate(zip(x, y))]
    df = spark.createDataFrame(rows, "id long, a double, b double, c double, turn string, kind string")
    options = dict(label="turn", numeric=["a", "b", "c"], categorical=["kind"], key="id", offsets=[0, 3, 3])
    got = run_svm_experiments(df, **options).collect()
    want = run_experiments(df, linear_svm(), **options).collect()
    for g, w in zip(got, want):
        assert g[:5] == w[:5] and g["error"] is None
        assert abs(g["accuracy"] - w["accuracy"]) <= 0.1  # a border row may fall to either side


def test_defined_cases(spark):
    def run(rows, offsets=(0,), step=1):
        df = spark.createDataFrame(rows, "id long, x double, label string")
        return run_svm_experiments(df, label="label", numeric=["x"], key="id", offsets=list(offsets),
                                   step=step).collect()

    good = [(k, float(k % 7), "up" if k % 7 > 3 else "down") for k in range(60)]
    assert run(good)[0]["accuracy"] == 1.0
    assert run([])[0]["error"] == "empty sample"
    assert run(good[:1])[0]["error"] == "empty train or test part"
    assert run(good + [(99, None, "up")])[0]["error"] == "NULL or non-finite feature"
    assert run(good + [(99, float("nan"), "up")])[0]["error"] == "NULL or non-finite feature"
    assert run(good + [(99, float("-inf"), "up")])[0]["error"] == "NULL or non-finite feature"
    assert run(good + [(99, 1.0, None)])[0]["error"] == "NULL label"
    assert "exactly 2" in run([(k, x, "up") for k, x, _ in good])[0]["error"]
    assert "exactly 2" in run([(k, x, "abc"[k % 3]) for k, x, _ in good])[0]["error"]
    assert run([(k, 1.0, lab) for k, _, lab in good])[0]["error"] is None
    few = run(good + [(k, None, "up") for k in range(61, 120, 2)], offsets=(0, 1, 5), step=61)
    assert [r["error"] is None for r in few] == [False] * 3


def test_level_codes_by_group_equal_the_codes_of_each_group(spark):
    rows = [(g, k, "abcd"[(k * k + g) % (2 + g)] if k % 9 else None, f"n{k}") for g in (1, 2) for k in range(40)]
    df = spark.createDataFrame(rows, "g int, k int, v string, name string")
    codes = level_codes(df, ["v", "name"], ["g"])
    got = with_level_codes(df, codes, ["v", "name"], ["cv", "cname"], ["g"])
    for g in (1, 2):
        want = index_columns(df.where(F.col("g") == g), ["v", "name"], ["cv", "cname"])
        cols = ["g", "k", "cv", "cname"]
        assert sorted(map(tuple, got.where(F.col("g") == g).select(cols).collect())) == \
            sorted(map(tuple, want.select(cols).collect()))
    other = spark.createDataFrame([(1, "zz"), (2, "zz"), (3, "a")], "g int, v string")
    unseen = with_level_codes(other, codes, ["v"], ["cv"], ["g"]).orderBy("g").collect()
    known = {r["g"]: r["n"] for r in df.groupBy("g").agg(F.count_distinct("v").alias("n")).collect()}
    assert [r["cv"] for r in unseen] == [known[1], known[2], 0.0]
