"""Decision trees and forests of many experiments, grown together one level at a time.

All experiments and all their trees share every job.  A row of the work table is (experiment, tree,
node, label, weight, bins); a level is

1. one aggregate: weight per (experiment, tree, node, feature, bin) and class, combined in the tasks
   before the shuffle;
2. a running sum over the bins of each (node, feature), which gives the Gini gain of every cut, and
   the best cut of every node;
3. one join that moves each row to its child.

So the number of jobs grows with the depth, not with experiments, trees or nodes.  Test rows
travel along with weight 0, so predictions need no further pass: a row that reaches a node without a
cut takes that node's classes.

Numeric features are cut between ``max_bins`` bins; bin borders are the midpoints of different values, or
quantiles where there are more, of the ``BORDER_ROWS`` rows of least hash of the key in each
experiment.  A category's levels are ordered by their share of the node's most frequent class in each node and cut
there, so any number of levels is allowed and none is sent to the driver; for two classes
the best cut of that order is the best of all subsets.  A level that no training row of the node
has goes right.

Everything is a function of the rows, their keys and the seed: bootstrap weights are Poisson numbers
from the hash of (seed, key, experiment, tree), feature subsets come from the hash of the node, borders from hashed rows.
The layout of the rows does not enter.

Defined cases: NULL and NaN numbers count as the lowest values; a NULL level is a level of its own;
equal gains go to the earlier feature and the lower cut; equal class weights to the smaller class; an
experiment without training rows has no nodes and its test rows no prediction.  ``key`` names a row
of an experiment: rows that share it share bootstrap weights and are one row of the predictions.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.columns import col as col_of
from ..session import stored_table

BORDER_ROWS = 10_000
_NODE = ["experiment", "tree", "node"]


def _number(name: str) -> Column:
    x = col_of(name).cast("double")
    return F.when(x.isNull() | F.isnan(x), F.lit(float("-inf"))).otherwise(x)


def bin_borders(rows: DataFrame, numeric: Sequence[str], max_bins: int) -> DataFrame:
    """(experiment, f0, f1, ..): sorted borders of each numeric feature, one row per experiment."""
    by_hash = Window.partitionBy("experiment").orderBy(F.xxhash64("key"), "key")
    few = (rows.where("is_train").withColumn("place", F.row_number().over(by_hash))
           .where(F.col("place") <= BORDER_ROWS))
    sorted_values = few.groupBy("experiment").agg(
        *[F.array_sort(F.collect_list(_number(c))).alias(f"s{k}") for k, c in enumerate(numeric)])

    def borders(s: Column) -> Column:
        d = F.array_distinct(s)
        middle = F.transform(F.sequence(F.lit(1), F.size(d) - 1), lambda i: F.when(
            F.get(d, i - 1) == float("-inf"), F.lit(-1.7976931348623157e308))
            .otherwise((F.get(d, i - 1) + F.get(d, i)) / 2))
        at = F.transform(F.sequence(F.lit(1), F.lit(max_bins - 1)),
                         lambda j: F.get(s, F.floor(j * F.size(s) / max_bins).cast("int")))
        return (F.when(F.size(d) < 2, F.array().cast("array<double>"))
                .when(F.size(d) <= max_bins, middle).otherwise(F.array_distinct(at)))
    return sorted_values.select("experiment", *[borders(F.col(f"s{k}")).alias(f"f{k}") for k in range(len(numeric))])


def _bin_of(x: Column, borders: Column) -> Column:
    """The number of borders below ``x``, as text; 0 where an experiment has no borders."""
    return F.coalesce(F.size(F.filter(borders, lambda t: x > t)), F.lit(0)).cast("string")


def poisson_weight(seed: int, trees: int, key: Column) -> Column:
    """(tree, weight) pairs with a weight above 0: Poisson(1) by inversion of a hashed uniform."""
    steps, p, total = [], math.exp(-1), 0.0
    for k in range(12):
        total += p
        steps.append(total)
        p /= k + 1

    def one(tree: Column) -> Column:
        u = F.xxhash64(F.lit(seed), key, F.col("experiment"), tree).bitwiseAND(F.lit(0xFFFFFFFF)) / F.lit(2.0 ** 32)
        weight = F.lit(0)
        for s in steps:
            weight = weight + F.when(u >= s, 1).otherwise(0)
        return F.struct(tree.cast("int").alias("tree"), weight.cast("double").alias("w"))
    return F.transform(F.sequence(F.lit(0), F.lit(trees - 1)), one)


def grow(rows: DataFrame, *, n_classes: int, numeric: Sequence[str], categorical: Sequence[str] = (),
         depth: int = 5, max_bins: int = 32, trees: int = 1, bootstrap: bool = False,
         subset: int | None = None, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(nodes, predictions) of all experiments of ``rows``.

    ``rows``: experiment, key, is_train, y (class 0..n_classes-1, NULL: unknown) and the features.
    ``nodes``: experiment, tree, node (root 1, children 2n and 2n+1), level, feature, cut, levels, gain, classes.
    ``predictions``: experiment, key, y, prediction for rows that are not in training.
    ``subset``: features tried in each node (default all).
    """
    m = len(numeric) + len(categorical)
    if not m:
        raise ValueError("no features")
    rows = rows.select("experiment", "key", "is_train", "y",
                       *[col_of(c).alias(f"_v{k}") for k, c in enumerate([*numeric, *categorical])])
    numeric, categorical = ([f"_v{k}" for k in span] for span in (range(len(numeric)), range(len(numeric), m)))
    level_bins = [F.coalesce(F.concat(F.lit("="), col_of(c).cast("string")), F.lit("")) for c in categorical]
    packed, number_bins = rows, []
    if numeric:
        borders = bin_borders(rows, numeric, max_bins)  # one row per experiment
        names = [f"f{k}" for k in range(len(numeric))]
        packed = rows.join(F.broadcast(borders.select("experiment", F.struct(*names).alias("_borders"))), "experiment", "left")
        number_bins = [_bin_of(_number(c), F.col(f"_borders.f{k}")) for k, c in enumerate(numeric)]
    members = F.struct(F.lit(0).alias("tree"), F.lit(1.0).alias("w"))
    draws = poisson_weight(seed, trees, F.col("key")) if bootstrap else F.transform(
        F.sequence(F.lit(0), F.lit(trees - 1)), lambda t: F.struct(t.cast("int").alias("tree"), F.lit(1.0).alias("w")))
    if trees == 1 and not bootstrap:
        draws = F.array(members)
    work = stored_table(
        packed.select("experiment", "key", "is_train", "y", F.array(*number_bins, *level_bins).alias("bins"), F.explode(draws).alias("d"))
        .select("experiment", "d.tree", F.lit(1).cast("long").alias("node"), "key", "is_train", "y", "bins",
                F.when(F.col("is_train") & F.col("y").isNotNull(), F.col("d.w")).otherwise(0.0).alias("w"))
        .where("w > 0 OR NOT is_train"), "tree-rows")
    classes = [f"n{c}" for c in range(n_classes)]
    by_class = [F.sum(F.when(F.col("y") == c, F.col("w")).otherwise(0.0)).alias(f"n{c}") for c in range(n_classes)]
    all_nodes, done = [], []
    for level in range(depth + 1):
        live = work.where("w > 0")
        if level == depth:
            nodes = stored_table(live.groupBy(*_NODE).agg(*by_class).select(
                *_NODE, F.lit(level).alias("level"), F.lit(None).cast("int").alias("feature"),
                F.lit(None).cast("int").alias("cut"), F.lit(None).cast("array<string>").alias("levels"),
                F.lit(None).cast("double").alias("gain"), F.array(*classes).alias("classes")), "tree-nodes")
        else:
            nodes = stored_table(_level(live, classes, by_class, len(numeric), m, subset, seed, level), "tree-nodes")
        all_nodes.append(nodes)
        moved = work.join(nodes.select(*_NODE, "feature", "cut", "levels", "classes"), _NODE, "left")
        here = F.get("bins", F.col("feature"))
        left = F.when(F.col("feature") < len(numeric), here.cast("int") <= F.col("cut")).otherwise(
            F.array_contains("levels", here))
        moved = moved.withColumn("node", F.when(F.col("feature").isNotNull(),
                                                2 * F.col("node") + F.when(left, 0).otherwise(1)).otherwise(F.col("node")))
        kept = ["experiment", "tree", "node", "key", "is_train", "y", "bins", "w", "classes"]
        moved = stored_table(moved.select(*kept, F.col("feature").isNull().alias("ended")), "tree-rows")
        done.append(moved.where("ended AND NOT is_train").select("experiment", "tree", "key", "y", "classes"))
        work = moved.where("NOT ended").drop("ended", "classes")
        if level == depth or work.isEmpty():
            break
    ended, model = done[0], all_nodes[0]
    for more in done[1:]:
        ended = ended.unionByName(more)
    for more in all_nodes[1:]:
        model = model.unionByName(more)
    return model, _votes(ended, n_classes)


def _level(live: DataFrame, classes: list[str], by_class: list[Column], n_numeric: int, m: int,
           subset: int | None, seed: int, level: int) -> DataFrame:
    """The nodes of one level with their best cut."""
    cells = live.select(*_NODE, "y", "w", F.posexplode("bins").alias("feature", "bin"))
    hist = cells.groupBy(*_NODE, "feature", "bin").agg(*by_class)
    group = Window.partitionBy(*_NODE, "feature")
    for c in classes:
        hist = hist.withColumn(f"t{c}", F.sum(c).over(group))
    total = sum((F.col(f"t{c}") for c in classes[1:]), F.col(f"t{classes[0]}"))
    here = sum((F.col(c) for c in classes[1:]), F.col(classes[0]))
    # a number's bins in their order, a category's by the share of the node's main class
    top = F.greatest(*[F.col(f"t{c}") for c in classes]) if len(classes) > 1 else F.col(f"t{classes[0]}")
    main = F.lit(0.0)
    for c in reversed(classes):
        main = F.when(F.col(f"t{c}") == top, F.col(c)).otherwise(main)
    hist = hist.withColumn("rank", F.when(F.col("feature") < n_numeric, F.col("bin").cast("double"))
                           .otherwise(-main / here))
    upto = group.orderBy("rank", "bin").rowsBetween(Window.unboundedPreceding, 0)
    for c in classes:
        hist = hist.withColumn(f"l{c}", F.sum(c).over(upto))
    hist = hist.withColumn("total", total).withColumn(
        "left", sum((F.col(f"l{c}") for c in classes[1:]), F.col(f"l{classes[0]}")))

    def gini(part: list[Column], n: Column) -> Column:
        return F.lit(1.0) - sum(((x / n) * (x / n) for x in part[1:]), (part[0] / n) * (part[0] / n))
    t, lo = [F.col(f"t{c}") for c in classes], [F.col(f"l{c}") for c in classes]
    hi, right = [a - b for a, b in zip(t, lo)], F.col("total") - F.col("left")
    gain = F.when(right > 0, gini(t, F.col("total")) - F.col("left") / F.col("total") * gini(lo, F.col("left"))
                  - right / F.col("total") * gini(hi, right))
    # sums of weights differ in their last digits by order: equal gains must be equal
    hist = hist.withColumn("gain", F.round(gain, 12))
    if subset is not None and subset < m:
        drawn = F.row_number().over(Window.partitionBy(*_NODE).orderBy("h", "feature"))
        tried = (hist.select(*_NODE, "feature").distinct()
                 .withColumn("h", F.xxhash64(F.lit(seed), *_NODE, "feature")).withColumn("place", drawn))
        hist = hist.join(tried.where(F.col("place") <= subset).select(*_NODE, "feature"), [*_NODE, "feature"])
    best = hist.groupBy(*_NODE).agg(
        F.max_by(F.struct("feature", "rank", "bin", "gain"),
                 F.struct("gain", (-F.col("feature")).alias("f"), (-F.col("rank")).alias("r"), F.col("bin").alias("b")))
        .alias("s"), F.first(F.array(*t)).alias("classes"))
    cuts = F.col("s.gain") > 0
    best = best.select(*_NODE, "classes", F.when(cuts, F.col("s.feature")).alias("feature"),
                       F.when(cuts, F.col("s.rank")).alias("cut_rank"), F.when(cuts, F.col("s.bin")).alias("cut_bin"),
                       F.when(cuts, F.col("s.gain")).alias("gain"))
    # the levels left of a category's cut
    chosen = hist.select(*_NODE, "feature", "rank", "bin").join(
        best.where(F.col("feature") >= n_numeric).select(*_NODE, "feature", "cut_rank", "cut_bin"), [*_NODE, "feature"])
    inside = (F.col("rank") < F.col("cut_rank")) | (F.col("rank") == F.col("cut_rank")) & (F.col("bin") <= F.col("cut_bin"))
    levels = chosen.where(inside).groupBy(*_NODE).agg(F.array_sort(F.collect_list("bin")).alias("levels"))
    return best.join(levels, _NODE, "left").select(
        *_NODE, F.lit(level).alias("level"), "feature",
        F.when(F.col("feature") < n_numeric, F.col("cut_bin").cast("int")).alias("cut"), "levels", "gain", "classes")


def _votes(ended: DataFrame, n_classes: int) -> DataFrame:
    """The class of the largest mean share over a row's trees; equal shares go to the smaller class."""
    whole = F.aggregate("classes", F.lit(0.0), lambda a, x: a + x)
    votes = ended.groupBy("experiment", "key", "y").agg(
        *[F.sum(F.get("classes", F.lit(c)) / whole).alias(f"v{c}") for c in range(n_classes)])
    v = [F.round(F.col(f"v{c}"), 9) for c in range(n_classes)]
    top = F.greatest(*v) if n_classes > 1 else v[0]
    guess = F.lit(None).cast("int")
    for c in reversed(range(n_classes)):
        guess = F.when(v[c] == top, c).otherwise(guess)
    return votes.select("experiment", "key", "y", guess.alias("prediction"))
