"""Repeated sample -> train -> score jobs and their summary.

``run_experiments``: index the table once, draw a start offset per experiment,
take the 1-in-``step`` systematic sample at that offset, split it into train and
test with a per-experiment seed, fit and score one model per experiment.

Data flow:

* only the key, label and feature columns are read (column pruning);
* the index is computed once; rows tagged with their residue class ``part`` are
  written as a table partitioned by ``part`` under ``spark.checkpoint.dir``, so hours of
  model fitting never depend on lineage and each experiment reads only its own partition;
* all sample/train/test sizes come from ONE grouped aggregate over ``part``;
* experiments run as concurrent Spark jobs from a small driver thread pool, as many at a time
  as the cores ask for; results do not depend on the order they finish in.

An experiment whose sample, training or test part is empty, or whose rows do not allow
the fit, gets a NULL accuracy and a message; the others are unaffected.  Failures of the
cluster are raised.
"""

from __future__ import annotations

import os
import uuid
from collections.abc import Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace as with_changes

from pyspark import StorageLevel, inheritable_thread_target
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (DoubleType, IntegerType, LongType, StringType, StructField,
                               StructType)

from ..functions.columns import col as col_of, cols as by_name
from ..functions.hashing import bucket_of, uniform
from ..operators.models import DataProblem, ModelSpec, train_and_score
from ..operators.sampling import draw_offsets, systematic_partition
from ..session import checkpoint_dir
from ..sources.rows import from_literals

RESULT_SCHEMA = StructType([
    StructField("experiment_id", IntegerType(), False),
    StructField("start_offset", IntegerType(), False),
    StructField("num_samples", LongType(), False),
    StructField("num_train", LongType(), False),
    StructField("num_test", LongType(), False),
    StructField("accuracy", DoubleType(), True),
    StructField("error", StringType(), True),
])

PART_RESULT_SCHEMA = StructType([
    StructField("part", IntegerType(), False),
    StructField("num_samples", LongType(), False),
    StructField("num_train", LongType(), False),
    StructField("num_test", LongType(), False),
    StructField("accuracy", DoubleType(), True),
    StructField("error", StringType(), True),
])


def _needed(df: DataFrame, key: str | None, label: str, numeric, categorical) -> DataFrame:
    cols = ([key] if key else []) + [label] + list(numeric) + list(categorical)
    seen: list[str] = []
    for c in cols:
        if c not in seen:
            seen.append(c)
    return df.select(*by_name(seen))


def _train_flag(key_col: str, seed, train_fraction: float, hash_fn: str = "md5"):
    return uniform(key_col, seed, hash_fn=hash_fn) < F.lit(float(train_fraction))


# Training rows per task of a fit.  Iterative learners run a job per iteration and forests
# draw their bootstrap per partition, so the training rows get a layout that depends on the
# split key and their number only: same rows, same seed, same model on any cluster.
FIT_ROWS_PER_TASK = 200_000
# Fits run together until every core has so many tasks: small fits leave no core idle, and the rows
# that forests hold at a time follow the cores, not the number of experiments.  Other learners hold
# little beside the rows and run many short jobs: at least LEAST_FITS of them run together.
FIT_TASKS_PER_CORE = 3
LEAST_FITS = 4
MOST_FITS = 16  # threads of the driver


def keep(df: DataFrame, part_col: str) -> tuple[DataFrame, callable]:
    """Keep ``df`` for repeated use; returns the kept frame and a release function.

    A table partitioned by ``part_col`` under the shared checkpoint folder: the lineage
    is cut, filters on ``part_col`` read only their partition, and the folder is removed
    if the write fails.
    """
    spark = df.sparkSession
    path = os.path.join(checkpoint_dir(spark), f"sampwise-samples-{uuid.uuid4().hex}")
    try:
        df.write.partitionBy(part_col).parquet(path)
    except BaseException:
        _delete_path(spark, path)
        raise
    return spark.read.schema(df.schema).parquet(path), (lambda: _delete_path(spark, path))


def _delete_path(spark, path: str) -> None:
    """Remove a folder this module wrote, on whatever file system holds it."""
    hpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    hpath.getFileSystem(spark._jsc.hadoopConfiguration()).delete(hpath, True)


def fit_tasks(n_train: int, fixed: int | None = None) -> int:
    """Tasks of a fit over ``n_train`` rows: ``fixed``, or as many as the rows ask for."""
    return fixed or max(1, -(-n_train // FIT_ROWS_PER_TASK))


def fits_at_once(tasks: Sequence[int], cores: int, spec: ModelSpec) -> int:
    """Fits to run together, given the tasks of each."""
    wanted = -(-FIT_TASKS_PER_CORE * cores * len(tasks) // max(1, sum(tasks)))
    return min(max(1 if spec.holds_trees_per_row else LEAST_FITS, wanted), MOST_FITS)


def fixed_layout(df: DataFrame, key: str, partitions: int) -> DataFrame:
    """Rows dealt and sorted by ``key``, whatever layout they come in."""
    return df.repartition(partitions, col_of(key)).sortWithinPartitions(col_of(key))


def _score(train: DataFrame, test: DataFrame, spec: ModelSpec, label, numeric,
           categorical, key: str, partitions: int) -> tuple[float | None, str | None]:
    """Accuracy, or NULL and the message of a known data problem; anything else is raised.

    The training rows are dealt once and held on the executors (memory, then disk) while the
    encoders, the scaler and the learner pass over them; parts of a lost executor are dealt
    again from the kept table.
    """
    dealt = fixed_layout(train, key, partitions).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        score = train_and_score(dealt, test, spec, label=label, numeric=numeric,
                                categorical=categorical)
        return score.accuracy, None
    except DataProblem as exc:
        return None, f"{type(exc).__name__}: {exc}"
    finally:
        dealt.unpersist()


EXPERIMENT_SCHEMA = StructType([
    StructField("experiment_id", IntegerType(), False),
    StructField("start_offset", IntegerType(), False),
    StructField("seed", IntegerType(), False),
])


def experiment_table(spark, offsets: Sequence[int], seeds: Sequence[int]) -> DataFrame:
    """``(experiment_id, start_offset, seed)``: one row per planned experiment."""
    rows = [(i + 1, int(o), int(s)) for i, (o, s) in enumerate(zip(offsets, seeds))]
    return from_literals(spark, rows, EXPERIMENT_SCHEMA)


def experiment_sizes(indexed: DataFrame, key_col: str, experiments: DataFrame,
                     train_fraction: float, part_col: str = "part",
                     hash_fn: str = "md5") -> DataFrame:
    """``(experiment_id, start_offset, num_samples, num_train, num_test)`` in one pass.

    Each row meets the experiments whose offset equals its residue class (a
    broadcast of one row per experiment); the train flag uses the experiment's
    own seed column; one grouped aggregate with map-side partials counts all.
    Experiments with an empty sample keep zero counts.
    """
    tagged = indexed.join(F.broadcast(experiments), F.col(part_col) == F.col("start_offset"))
    flag = _train_flag(key_col, F.col("seed"), train_fraction, hash_fn).cast("long")
    counts = tagged.groupBy("experiment_id").agg(F.count(F.lit(1)).alias("_n"),
                                                 F.sum(flag).alias("_t"))
    n = F.coalesce(F.col("_n"), F.lit(0)).cast("long")
    t = F.coalesce(F.col("_t"), F.lit(0)).cast("long")
    # counts has at most one row per experiment: a bounded broadcast
    return (experiments.join(F.broadcast(counts), "experiment_id", "left")
            .select("experiment_id", "start_offset", n.alias("num_samples"),
                    t.alias("num_train"), (n - t).alias("num_test")))


def run_experiments(df: DataFrame, spec: ModelSpec, *, label: str, numeric: Sequence[str],
                    categorical: Sequence[str] = (), key: str | None = None,
                    n_experiments: int = 5, step: int = 5, offset_seed: int | None = None,
                    offsets: Sequence[int] | None = None, split_seed_base: int = 42,
                    train_fraction: float = 0.8, replace: bool = True,
                    parallelism: int | None = None,
                    fit_partitions: int | None = None, hash_fn: str = "md5",
                    deterministic_input: bool = False, seed_models: bool = True) -> DataFrame:
    """One result row per experiment (``RESULT_SCHEMA``), ``experiment_id`` from 1.

    ``key`` orders the index and seeds the train/test hash; without it rows are
    numbered in input order and the index itself is the split key.
    ``deterministic_input`` is passed to the index; ``fit_partitions`` fixes the number of
    tasks of a fit (else one per ``FIT_ROWS_PER_TASK`` training rows); ``parallelism`` the number
    of fits at a time (else :func:`fits_at_once`); ``hash_fn``
    picks the train/test draw (see :func:`uniform`).  With ``seed_models`` a seeded model (tree,
    forest) gets its experiment's split seed ``split_seed_base + i``.
    """
    spark = df.sparkSession
    if offsets is None:
        offsets = draw_offsets(step, n_experiments, offset_seed, replace=replace)
    offsets = [int(o) for o in offsets]
    if any(not 0 <= o < step for o in offsets):
        raise ValueError(f"offsets must lie in 0..{step - 1}: {offsets}")
    seeds = [split_seed_base + i for i in range(len(offsets))]

    narrow = _needed(df, key, label, numeric, categorical)
    indexed = systematic_partition(narrow, step, order_by=key, index_col="_sw_idx",
                                   part_col="_sw_part", deterministic_input=deterministic_input)
    split_key = key or "_sw_idx"
    work, release = keep(indexed.filter(F.col("_sw_part").isin(sorted(set(offsets)))), "_sw_part")
    try:
        plan = experiment_table(spark, offsets, seeds)
        sizes = {r["experiment_id"]: (r["num_samples"], r["num_train"], r["num_test"])
                 for r in experiment_sizes(work, split_key, plan, train_fraction,
                                           "_sw_part", hash_fn).collect()}

        def one(i: int) -> tuple:
            off, seed = offsets[i], seeds[i]
            n, n_train, n_test = sizes[i + 1]
            if n == 0:
                return (i + 1, off, 0, 0, 0, None, "empty sample")
            if n_train == 0 or n_test == 0:
                return (i + 1, off, n, n_train, n_test, None, "empty train or test part")
            sample = work.filter(F.col("_sw_part") == off)
            flag = _train_flag(split_key, seed, train_fraction, hash_fn)
            spec_i = spec
            if seed_models and "seed" in spec.params:
                spec_i = with_changes(spec, params={**spec.params, "seed": seed})
            acc, err = _score(sample.filter(flag), sample.filter(~flag), spec_i, label,
                              numeric, categorical, split_key, fit_tasks(n_train, fit_partitions))
            return (i + 1, off, n, n_train, n_test, acc, err)

        tasks = [fit_tasks(sizes[i + 1][1], fit_partitions) for i in range(len(offsets))]
        rows = _run_all(spark, one, len(offsets),
                        parallelism or fits_at_once(tasks, spark.sparkContext.defaultParallelism, spec))
    finally:
        release()
    return from_literals(spark, rows, RESULT_SCHEMA)


def run_per_part(df: DataFrame, spec: ModelSpec, *, label: str, numeric: Sequence[str],
                 categorical: Sequence[str] = (), key: str | None = None, n_parts: int = 3,
                 method: str = "systematic", split_seed: int = 1, part_seed: int = 42,
                 part_weights: Sequence[float] | None = None,
                 train_fraction: float = 0.8,
                 parallelism: int | None = None,
                 fit_partitions: int | None = None, hash_fn: str = "md5",
                 deterministic_input: bool = False) -> DataFrame:
    """Cut the table into ``n_parts`` disjoint parts, one model per part.

    ``method="systematic"``: part = index mod n_parts.  ``"random"``: hash split
    seeded by ``part_seed`` with ``part_weights`` (equal by default; needs ``key``).
    """
    spark = df.sparkSession
    narrow = _needed(df, key, label, numeric, categorical)
    if method == "systematic":
        parted = systematic_partition(narrow, n_parts, order_by=key, index_col="_sw_idx",
                                      part_col="_sw_part", deterministic_input=deterministic_input)
        split_key = key or "_sw_idx"
    elif method == "random":
        if key is None:
            raise ValueError("random parts need a key")
        weights = list(part_weights) if part_weights is not None else [1.0] * n_parts
        if len(weights) != n_parts:
            raise ValueError("part_weights needs one weight per part")
        parted = narrow.withColumn("_sw_part", bucket_of(
            uniform(key, part_seed, hash_fn=hash_fn), weights))
        split_key = key
    else:
        raise ValueError("method must be 'systematic' or 'random'")
    parted, release = keep(parted, "_sw_part")
    try:
        flag = _train_flag(split_key, split_seed, train_fraction, hash_fn)
        sizes = {r["_sw_part"]: (int(r["n"]), int(r["t"] or 0)) for r in
                 parted.groupBy("_sw_part").agg(F.count(F.lit(1)).alias("n"),
                                                 F.sum(flag.cast("long")).alias("t")).collect()}

        def one(p: int) -> tuple:
            n, n_train = sizes.get(p, (0, 0))
            n_test = n - n_train
            if n == 0:
                return (p, 0, 0, 0, None, "empty sample")
            if n_train == 0 or n_test == 0:
                return (p, n, n_train, n_test, None, "empty train or test part")
            part = parted.filter(F.col("_sw_part") == p)
            acc, err = _score(part.filter(flag), part.filter(~flag), spec, label, numeric,
                              categorical, split_key, fit_tasks(n_train, fit_partitions))
            return (p, n, n_train, n_test, acc, err)

        tasks = [fit_tasks(sizes.get(p, (0, 0))[1], fit_partitions) for p in range(n_parts)]
        rows = _run_all(spark, one, n_parts,
                        parallelism or fits_at_once(tasks, spark.sparkContext.defaultParallelism, spec))
    finally:
        release()
    return from_literals(spark, rows, PART_RESULT_SCHEMA)


def _run_all(spark, fn, n: int, parallelism: int) -> list[tuple]:
    """Run ``fn(0..n-1)`` as concurrent Spark jobs; results in index order."""
    if parallelism <= 1 or n <= 1:
        return [fn(i) for i in range(n)]
    with ThreadPoolExecutor(max_workers=min(parallelism, n)) as pool:
        return list(pool.map(inheritable_thread_target(spark)(fn), range(n)))


def summarise(results: DataFrame) -> DataFrame:
    """One row: planned and finished experiments, average/lowest/highest accuracy."""
    return results.agg(
        F.count(F.lit(1)).alias("planned"),
        F.count("accuracy").alias("finished"),
        F.avg("accuracy").alias("avg_accuracy"),
        F.min("accuracy").alias("min_accuracy"),
        F.max("accuracy").alias("max_accuracy"),
    )


def finished(results: DataFrame) -> DataFrame:
    """Experiments that produced an accuracy."""
    return results.filter(F.col("accuracy").isNotNull())
