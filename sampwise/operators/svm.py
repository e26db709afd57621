"""Linear SVMs of many experiments in one pass of the rows per iteration.

Every experiment minimises mean hinge loss + ``reg_param`` / 2 * |w|^2 over features scaled to
unit standard deviation, with a free intercept: what ``LinearSVC`` minimises.  The loss is convex
and piecewise linear, so its value and slope at a point bound it from below everywhere (a cutting
plane).  One iteration:

* the points to try, a few per experiment, are broadcast (experiments x ``len(STEPS)`` rows);
* one grouped aggregate gives loss and slope of every experiment at its points: sums only, combined
  in each task before the shuffle;
* the driver adds the planes and minimises each experiment's lower model, a quadratic program
  over at most ``max_iter`` x ``len(STEPS)`` planes of ``features`` numbers.

The least value met minus the least value of the lower model is a proven bound of the error, so an
experiment stops at ``tol`` by proof and leaves the passes that follow.

Defined cases: a feature without variance has the coefficient 0; repeated rows count as often as
they occur; a row with a NULL side counts for nothing; features must be finite (the caller checks).
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..sources.rows import from_rows

STEPS = (0.05, 0.15, 0.4, 1.0)  # points tried between the best point and the lower model's


@dataclass
class Bundle:
    """One experiment's planes, best point and proven bounds; points are (w, b) of scaled features."""

    reg: float
    reach: float  # no optimum has a larger intercept
    width: int
    slopes: list = field(default_factory=list)
    levels: list = field(default_factory=list)
    best: np.ndarray | None = None
    value: float = np.inf
    bound: float = 0.0
    target: np.ndarray | None = None

    def points(self) -> list[np.ndarray]:
        if self.best is None:
            return [np.zeros(self.width + 1)]
        return [self.best + t * (self.target - self.best) for t in STEPS]

    def add(self, point: np.ndarray, loss: float, slope: np.ndarray) -> None:
        self.slopes.append(slope)
        self.levels.append(loss - slope @ point)
        value = loss + self.reg / 2 * point[:-1] @ point[:-1]
        if value < self.value:
            self.value, self.best = value, point

    def improve(self) -> None:
        self.target, bound = lower_minimum(np.array(self.slopes), np.array(self.levels), self.reg, self.reach)
        self.bound = max(self.bound, bound)

    @property
    def gap(self) -> float:
        return self.value - self.bound


def lower_minimum(slopes: np.ndarray, levels: np.ndarray, reg: float, reach: float,
                  rounds: int = 100) -> tuple[np.ndarray, float]:
    """Least reg/2 |w|^2 + max(0, slopes @ (w, b) + levels) with |b| <= reach: its point, and a lower
    bound of the least value (interior points with a predictor and a corrector)."""
    d = slopes.shape[1]
    planes = np.vstack([slopes, np.zeros(d)])
    box = np.zeros((2, d + 1))
    box[0, d - 1], box[1, d - 1] = 1.0, -1.0
    rows = np.vstack([np.column_stack([planes, -np.ones(len(planes))]), box])
    limit = np.concatenate([-levels, [0.0, reach, reach]])
    curve = np.append(np.full(d - 1, reg), [0.0, 0.0])
    cost = np.append(np.zeros(d), 1.0)
    u = np.append(np.zeros(d), max(0.0, levels.max()) + 1.0)
    slack, dual = limit - rows @ u, np.full(len(limit), 1.0 / len(limit))
    for _ in range(rounds):
        off_dual = curve * u + cost + rows.T @ dual
        off_rows = rows @ u + slack - limit
        mean = slack @ dual / len(limit)
        if mean * len(limit) < 1e-11 and np.abs(off_dual).max() < 1e-10:
            break
        system = np.diag(curve) + rows.T @ (rows * (dual / slack)[:, None])
        system[np.diag_indices_from(system)] += 1e-14 * np.trace(system)

        def move(wish):
            step = np.linalg.solve(system, -off_dual + rows.T @ ((wish - dual * off_rows) / slack))
            by_slack = -off_rows - rows @ step
            return step, by_slack, -(wish + dual * by_slack) / slack

        def room(x, dx):
            with np.errstate(over="ignore"):
                return min(1.0, np.min(-x[dx < 0] / dx[dx < 0], initial=np.inf))

        _, s1, d1 = move(slack * dual)
        after = (slack + room(slack, s1) * s1) @ (dual + room(dual, d1) * d1) / len(limit)
        step, s2, d2 = move(slack * dual + s1 * d1 - (after / mean) ** 3 * mean)
        take = 0.99 * min(room(slack, s2), room(dual, d2))
        u, slack, dual = u + take * step, slack + take * s2, dual + take * d2
    # the dual value at these multipliers, made feasible: plane weights sum to one
    weights = np.maximum(dual[:len(planes)], 0)
    weights /= weights.sum()
    pull = weights @ planes
    bound = weights @ np.append(levels, 0.0) - pull[:-1] @ pull[:-1] / (2 * reg) - reach * abs(pull[-1])
    return u[:d], float(bound)


@dataclass(frozen=True)
class Svm:
    """A fitted experiment: coefficients of the features as given, objective, proven error, passes."""

    coefficients: np.ndarray
    intercept: float
    objective: float
    gap: float
    passes: int


def scales(rows: DataFrame, features: Sequence[str]) -> dict[int, np.ndarray]:
    """Mean, standard deviation (0: no variance) and reach of every feature of every experiment."""
    found = rows.groupBy("experiment").agg(*[
        f(c).alias(f"{name}{k}") for k, c in enumerate(features)
        for name, f in (("mean", F.avg), ("std", F.stddev_samp), ("min", F.min), ("max", F.max))])
    out = {}
    for r in found.collect():  # one row per experiment
        mean = np.array([r[f"mean{k}"] for k in range(len(features))], dtype=float)
        std = np.array([r[f"std{k}"] or 0.0 for k in range(len(features))], dtype=float)
        far = np.array([max(r[f"max{k}"] - m, m - r[f"min{k}"]) for k, m in enumerate(mean)], dtype=float)
        flat = std <= 1e-12 * np.abs(mean)  # rounding, not variance
        std[flat] = 0.0
        out[int(r["experiment"])] = np.array([mean, std, np.divide(far, std, out=np.zeros_like(far), where=~flat)])
    return out


def scaled(rows: DataFrame, features: Sequence[str], by: dict[int, np.ndarray]) -> DataFrame:
    """``rows`` with centred features of unit deviation, by their experiment (one broadcast row each)."""
    table = from_rows(rows.sparkSession, [(e, s[0].tolist(), s[1].tolist()) for e, s in by.items()],
                      "experiment int, _sw_mean array<double>, _sw_std array<double>")
    value = {c: F.when(F.col("_sw_std")[k] > 0, (F.col(c) - F.col("_sw_mean")[k]) / F.col("_sw_std")[k])
             .otherwise(0.0) for k, c in enumerate(features)}
    return rows.join(F.broadcast(table), "experiment").withColumns(value).drop("_sw_mean", "_sw_std")


def margin(features: Sequence[str], point: str):
    """Sum of feature times entry of the array ``point``, plus its last entry."""
    total = F.col(point)[len(features)]
    for k, c in enumerate(features):
        total = total + F.col(c) * F.col(point)[k]
    return total


def losses(rows: DataFrame, features: Sequence[str], points: list[tuple[int, int, list[float]]]) -> list:
    """Per (experiment, number): rows, hinge loss and its slope, summed over ``rows`` in one aggregate."""
    table = from_rows(rows.sparkSession, points, "experiment int, number int, _sw_point array<double>")
    side = F.col("side")
    met = (rows.join(F.broadcast(table), "experiment")
           .withColumn("_sw_short", 1.0 - side * margin(features, "_sw_point")))
    pull = F.when(F.col("_sw_short") > 0, -side).otherwise(0.0)
    return met.groupBy("experiment", "number").agg(
        F.count("side").alias("n"), F.sum(F.greatest("_sw_short", F.lit(0.0))).alias("loss"),
        *[F.sum(pull * F.col(c)).alias(f"g{k}") for k, c in enumerate(features)],
        F.sum(pull).alias(f"g{len(features)}")).collect()


def fit_svms(rows: DataFrame, features: Sequence[str], by: dict[int, np.ndarray], *, reg_param: float = 0.1,
             max_iter: int = 100, tol: float = 1e-6) -> dict[int, Svm]:
    """Fit every experiment of ``by`` (:func:`scales`) on ``rows``: experiment, side (-1.0 or 1.0) and
    features as :func:`scaled` gives them, read once per iteration, so stored."""
    if reg_param <= 0:
        raise ValueError("reg_param must be positive")
    known = rows.where(F.col("side").isNotNull())
    open_ = {e: Bundle(reg_param, 1.0 + float(np.linalg.norm(s[2])) * (2.0 / reg_param) ** 0.5, len(features))
             for e, s in by.items()}
    out = {}
    for passes in range(1, max_iter + 1):
        if not open_:
            break
        tried = {(e, j): p for e, b in open_.items() for j, p in enumerate(b.points())}
        live = known.where(F.col("experiment").isin(list(open_)))
        for r in losses(live, features, [(e, j, p.tolist()) for (e, j), p in tried.items()]):
            slope = np.array([r[f"g{k}"] for k in range(len(features) + 1)]) / r["n"]
            open_[r["experiment"]].add(tried[r["experiment"], r["number"]], r["loss"] / r["n"], slope)
        for e, bundle in list(open_.items()):
            if bundle.best is None:  # no rows
                del open_[e]
                continue
            bundle.improve()
            if bundle.gap <= tol or passes == max_iter:
                mean, std, _ = by[e]
                raw = np.divide(bundle.best[:-1], std, out=np.zeros_like(std), where=std > 0)
                out[e] = Svm(raw, float(bundle.best[-1] - raw @ mean), bundle.value, bundle.gap, passes)
                del open_[e]
    return out
