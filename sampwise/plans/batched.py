"""Repeated tree and SVM experiments as one set of jobs.

The same experiments as :func:`run_experiments` (systematic sample, seeded split, fit, accuracy),
with the trees of all experiments grown together by :mod:`sampwise.operators.trees`: the
sampled rows are tagged with their experiment, stored once, and every level of every tree is one
aggregate.  Sizes and accuracies come from one grouped aggregate over the joint prediction table.
Nothing is collected but the number of label values.

SVM experiments (:mod:`sampwise.operators.svm`) share every pass of the rows, too: category codes are
tables fitted on the training rows, the scaled rows are stored once and read once per iteration.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col as col_of
from ..functions.hashing import uniform
from ..operators.features import index_columns, level_codes, with_level_codes
from ..operators.sampling import draw_offsets, systematic_partition
from ..operators.svm import fit_svms, margin, scaled, scales
from ..operators.trees import grow
from ..session import stored_table
from ..sources.rows import from_literals, from_rows
from .experiments import RESULT_SCHEMA, experiment_table, keep


def experiment_rows(df: DataFrame, *, label: str, numeric: Sequence[str], categorical: Sequence[str] = (),
                    key: str, offsets: Sequence[int], step: int = 5, split_seed_base: int = 42,
                    train_fraction: float = 0.8, hash_fn: str = "md5") -> tuple[DataFrame, int]:
    """(rows, number of label values): experiment, key, is_train, y, x0.., z0.., stored once.

    ``y`` is the label's code over the whole table, most frequent first.
    """
    if any(not 0 <= int(o) < step for o in offsets):
        raise ValueError(f"offsets must lie in 0..{step - 1}: {list(offsets)}")
    spark = df.sparkSession
    features = [col_of(c).alias(f"x{k}") for k, c in enumerate(numeric)]
    features += [col_of(c).alias(f"z{k}") for k, c in enumerate(categorical)]
    narrow = df.select(col_of(key).alias("key"), col_of(label).cast("string").alias("label"), *features)
    parts = systematic_partition(narrow, step, order_by="key", index_col="_sw_idx", part_col="_sw_part")
    coded = index_columns(parts, ["label"], ["y"])
    plan = experiment_table(spark, offsets, [split_seed_base + i for i in range(len(offsets))])
    tagged = coded.join(F.broadcast(plan), F.col("_sw_part") == F.col("start_offset"))
    rows = stored_table(tagged.select(
        F.col("experiment_id").alias("experiment"), "key",
        (uniform("key", F.col("seed"), hash_fn=hash_fn) < F.lit(float(train_fraction))).alias("is_train"),
        F.when(F.col("label").isNotNull(), F.col("y").cast("int")).alias("y"),
        *[f"x{k}" for k in range(len(numeric))], *[f"z{k}" for k in range(len(categorical))]), "experiment-rows")
    known = rows.agg(F.max("y")).first()[0]
    return rows, 1 if known is None else int(known) + 1


def run_tree_experiments(df: DataFrame, *, label: str, numeric: Sequence[str], categorical: Sequence[str] = (),
                         key: str, step: int = 5, n_experiments: int = 5, offset_seed: int | None = None,
                         offsets: Sequence[int] | None = None, split_seed_base: int = 42,
                         train_fraction: float = 0.8, depth: int = 5, max_bins: int = 32, trees: int = 1,
                         bootstrap: bool = False, subset: int | None = None, seed: int = 0,
                         hash_fn: str = "md5") -> DataFrame:
    """One row per experiment, the columns of ``RESULT_SCHEMA``.

    An experiment without samples, training or test rows has a NULL accuracy and a message.
    """
    spark = df.sparkSession
    if offsets is None:
        offsets = draw_offsets(step, n_experiments, offset_seed)
    offsets = [int(o) for o in offsets]
    rows, n_classes = experiment_rows(df, label=label, numeric=numeric, categorical=categorical, key=key,
                                      offsets=offsets, step=step, split_seed_base=split_seed_base,
                                      train_fraction=train_fraction, hash_fn=hash_fn)
    _, predictions = grow(rows, n_classes=n_classes, numeric=[f"x{k}" for k in range(len(numeric))],
                          categorical=[f"z{k}" for k in range(len(categorical))], depth=depth, max_bins=max_bins,
                          trees=trees, bootstrap=bootstrap, subset=subset, seed=seed)
    sizes = rows.groupBy("experiment").agg(F.count(F.lit(1)).alias("n"), F.count_if("is_train").alias("t"))
    hit = F.coalesce(F.col("y") == F.col("prediction"), F.lit(False))
    scores = predictions.groupBy("experiment").agg(F.avg(hit.cast("double")).alias("accuracy"))
    plan = experiment_table(spark, offsets, [split_seed_base + i for i in range(len(offsets))])
    n, t = F.coalesce("n", F.lit(0)).cast("long"), F.coalesce("t", F.lit(0)).cast("long")
    error = F.when(n == 0, "empty sample").when((t == 0) | (n == t), "empty train or test part")
    # one row per experiment on every side
    return (plan.join(F.broadcast(sizes), plan["experiment_id"] == sizes["experiment"], "left").drop("experiment")
            .join(F.broadcast(scores), F.col("experiment_id") == scores["experiment"], "left")
            .select("experiment_id", "start_offset", n.alias("num_samples"), t.alias("num_train"),
                    (n - t).alias("num_test"), F.when(error.isNull(), F.col("accuracy")).alias("accuracy"),
                    error.alias("error")))


def run_svm_experiments(df: DataFrame, *, label: str, numeric: Sequence[str], categorical: Sequence[str] = (),
                        key: str, step: int = 5, n_experiments: int = 5, offset_seed: int | None = None,
                        offsets: Sequence[int] | None = None, split_seed_base: int = 42,
                        train_fraction: float = 0.8, max_iter: int = 100, reg_param: float = 0.1,
                        tol: float = 1e-6, hash_fn: str = "md5") -> DataFrame:
    """One row per experiment, the columns of ``RESULT_SCHEMA``.

    An experiment without samples, training or test rows, with a NULL label, with a NULL or non-finite
    feature, without exactly two labels in its training rows, or with a test label unknown to them has a
    NULL accuracy and a message.  The driver gets one row per experiment (and pass).
    """
    spark = df.sparkSession
    if offsets is None:
        offsets = draw_offsets(step, n_experiments, offset_seed)
    offsets = [int(o) for o in offsets]
    rows, _ = experiment_rows(df, label=label, numeric=numeric, categorical=categorical, key=key, offsets=offsets,
                              step=step, split_seed_base=split_seed_base, train_fraction=train_fraction,
                              hash_fn=hash_fn)
    levels, coded = [f"z{k}" for k in range(len(categorical))], [f"c{k}" for k in range(len(categorical))]
    given = [f"x{k}" for k in range(len(numeric))]
    if categorical:
        codes = stored_table(level_codes(rows.where("is_train"), levels, ["experiment"]), "level-codes")
        rows = with_level_codes(rows, codes, levels, coded, ["experiment"])
    features = [*given, *coded]
    rows = rows.select("experiment", "is_train", "y", *[F.col(c).cast("double").alias(c) for c in features])

    finite = F.lit(True)
    for c in features:
        finite = finite & F.coalesce(F.abs(c) < float("inf"), F.lit(False))
    classes = (rows.groupBy("experiment", "y").agg(
        F.count(F.lit(1)).alias("n"), F.count_if("is_train").alias("t"), F.count_if(~finite).alias("bad"))
        .groupBy("experiment").agg(
            F.sum("n").alias("n"), F.sum("t").alias("t"), F.sum("bad").alias("bad"),
            F.sum(F.when(F.col("y").isNull(), F.col("n")).otherwise(0)).alias("unlabelled"),
            F.min(F.when(F.col("t") > 0, F.col("y"))).alias("low"),
            F.max(F.when(F.col("t") > 0, F.col("y"))).alias("high"),
            F.count_if((F.col("t") > 0) & F.col("y").isNotNull()).alias("labels"),
            F.count_if((F.col("t") == 0) & F.col("y").isNotNull()).alias("unknown")))
    seen = {r["experiment"]: r for r in classes.collect()}

    def problem(e: int) -> str | None:
        r = seen.get(e)
        if r is None:
            return "empty sample"
        if r["t"] in (0, r["n"]):
            return "empty train or test part"
        if r["unlabelled"]:
            return "NULL label"
        if r["bad"]:
            return "NULL or non-finite feature"
        if r["labels"] != 2:
            return f"linear SVM needs exactly 2 label values, training rows have {r['labels']}"
        return "the test rows hold a label that the training rows do not" if r["unknown"] else None

    errors = {i + 1: problem(i + 1) for i in range(len(offsets))}
    fit = [e for e, error in errors.items() if error is None]
    accuracies = {}
    if fit:
        high = from_rows(spark, [(e, seen[e]["high"]) for e in fit], "experiment int, high int")
        sided = (rows.join(F.broadcast(high), "experiment")
                 .withColumn("side", F.when(F.col("y") == F.col("high"), 1.0).otherwise(-1.0)).drop("y", "high"))
        by = scales(sided.where("is_train"), features)
        kept, release = keep(scaled(sided, features, by), "experiment")
        try:
            models = fit_svms(kept.where("is_train").drop("is_train"), features, by, max_iter=max_iter,
                              reg_param=reg_param, tol=tol)
            planes = []
            for e, m in models.items():
                mean, std, _ = by[e]
                planes.append((e, [*(m.coefficients * std).tolist(), m.intercept + float(m.coefficients @ mean)]))
            table = from_rows(spark, planes, "experiment int, plane array<double>")
            hit = (margin(features, "plane") > 0) == (F.col("side") > 0)
            scored = (kept.where("NOT is_train").join(F.broadcast(table), "experiment")
                      .groupBy("experiment").agg(F.avg(hit.cast("double")).alias("accuracy")))
            accuracies = {r["experiment"]: r["accuracy"] for r in scored.collect()}
        finally:
            release()
    out = []
    for i, offset in enumerate(offsets):
        n, t = (int(seen[i + 1]["n"]), int(seen[i + 1]["t"])) if i + 1 in seen else (0, 0)
        out.append((i + 1, offset, n, t, n - t, accuracies.get(i + 1), errors[i + 1]))
    return from_literals(spark, out, RESULT_SCHEMA)
