"""Feature preparation: label/category indexing, vector assembly, scaling.

``index_columns`` codes levels with DataFrames only.  ``feature_pipeline`` is Spark ML,
fitted on training rows only; its indexers bring the levels to the driver, where they
are the model, so callers bound their number first (``most_levels``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.feature import StandardScaler, StringIndexer, StringIndexerModel, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col as col_of, cols as by_name
from .index import with_row_index


def indexed_name(col: str) -> str:
    return f"{col}_indexed"


def index_columns(df: DataFrame, input_cols: Sequence[str],
                  output_cols: Sequence[str] | None = None, *,
                  handle_invalid: str = "keep") -> DataFrame:
    """Category -> double code per column, most frequent level = 0.0, ties by value.

    The values StringIndexer gives, as DataFrames throughout: the levels are counted,
    numbered in (count descending, value) order by the distributed row index and joined
    back, so any number of levels works and none reaches the driver.  NULL gets the code
    after the last level (``"keep"``), fails (``"error"``) or drops the row (``"skip"``).
    """
    if handle_invalid not in ("keep", "error", "skip"):
        raise ValueError("handle_invalid must be 'keep', 'error' or 'skip'")
    outs = list(output_cols) if output_cols else [indexed_name(c) for c in input_cols]
    out, level, less, code = df, "_sw_level", "_sw_less", "_sw_code"
    for c, name in zip(input_cols, outs):
        counts = (df.where(col_of(c).isNotNull()).groupBy(col_of(c).cast("string").alias(level))
                  .agg((-F.count(F.lit(1))).alias(less)))
        levels = with_row_index(counts, [less, level], name=code).select(level, code)
        if handle_invalid == "skip":
            out = out.where(col_of(c).isNotNull())
        joined = out.join(levels, col_of(c).cast("string") == F.col(level), "left")
        missing = (F.lit(levels.count()) if handle_invalid == "keep"
                   else F.raise_error(F.lit(f"NULL in {c}")))
        value = F.when(col_of(c).isNull(), missing).otherwise(F.col(code)).cast("double")
        out = joined.withColumn("_sw_out", value).drop(level, code)
        out = out.select(*by_name([x for x in out.columns if x != "_sw_out"]), F.col("_sw_out").alias(name))
    return out


def level_codes(df: DataFrame, columns: Sequence[str], by: Sequence[str]) -> DataFrame:
    """(by.., column number, level, code, levels): the codes of :func:`index_columns`, fitted in every
    group of ``by`` on the rows of ``df`` and held as a table; ``levels`` is the group's number of levels.

    Counted, numbered by the distributed index over (group, column, count, level) and shifted by the
    first number of the group, so a column may have as many levels as rows.
    """
    pairs = F.explode(F.array(*[F.struct(F.lit(k).alias("column"), col_of(c).cast("string").alias("level"))
                                for k, c in enumerate(columns)])).alias("_sw_pair")
    group = [*by, "column"]
    counts = (df.select(*by_name(by), pairs).select(*by_name(by), "_sw_pair.*").where("level IS NOT NULL")
              .groupBy(*group, "level").agg((-F.count(F.lit(1))).alias("_sw_less")))
    placed = with_row_index(counts, [*group, "_sw_less", "level"], name="_sw_at")
    first = placed.groupBy(*group).agg(F.min("_sw_at").alias("_sw_first"), F.count(F.lit(1)).alias("levels"))
    return (placed.join(first, group)
            .select(*group, "level", (F.col("_sw_at") - F.col("_sw_first")).alias("code"), "levels"))


def with_level_codes(df: DataFrame, codes: DataFrame, columns: Sequence[str], outs: Sequence[str],
                     by: Sequence[str]) -> DataFrame:
    """``df`` with the codes of ``columns``; a NULL or a level the codes do not know gets the code after
    the last (0.0 where the group has none), by the missing match of an outer join."""
    for k, (c, name) in enumerate(zip(columns, outs)):
        mine = codes.where(F.col("column") == k)
        sizes = mine.groupBy(*by).agg(F.max("levels").alias("_sw_levels"))
        level = mine.select(*by, F.col("level").alias("_sw_level"), F.col("code").alias("_sw_code"))
        df = (df.withColumn("_sw_level", col_of(c).cast("string")).join(level, [*by, "_sw_level"], "left")
              .join(sizes, list(by), "left")
              .withColumn(name, F.coalesce("_sw_code", "_sw_levels", F.lit(0)).cast("double"))
              .drop("_sw_level", "_sw_code", "_sw_levels"))
    return df


def assemble(df: DataFrame, input_cols: Sequence[str], output_col: str = "features", *,
             handle_invalid: str = "error") -> DataFrame:
    """Numeric columns -> one ML vector column."""
    return VectorAssembler(inputCols=list(input_cols), outputCol=output_col,
                           handleInvalid=handle_invalid).transform(df)


def vector_columns(df: DataFrame, vector_col: str, names: Sequence[str]) -> DataFrame:
    """Unpack an ML vector into named double columns (vector dropped)."""
    arr = "_sw_arr"
    out = df.withColumn(arr, vector_to_array(F.col(vector_col)))
    out = out.select(*by_name([c for c in df.columns if c != vector_col]),
                     *[F.col(arr)[i].alias(n) for i, n in enumerate(names)])
    return out


def scale_columns(df: DataFrame, input_cols: Sequence[str], output_cols: Sequence[str], *,
                  with_std: bool = True, with_mean: bool = False) -> DataFrame:
    """StandardScaler semantics on plain columns: ``x / stddev_samp(x)`` by default.

    Fit is one global aggregate (map-side partials, one row to the driver);
    transform is column arithmetic inside whole-stage codegen.  A column with
    zero variance (or a single row) scales to 0.0, as StandardScaler does.
    """
    aggs = []
    for i, c in enumerate(input_cols):
        aggs += [F.stddev_samp(col_of(c)).alias(f"s{i}"), F.avg(col_of(c)).alias(f"m{i}")]
    stats = df.agg(*aggs).first()
    outs = {}
    for i, (c, o) in enumerate(zip(input_cols, output_cols)):
        x = col_of(c).cast("double")
        if with_mean:
            x = x - F.lit(stats[f"m{i}"] or 0.0)
        std = stats[f"s{i}"]
        if with_std:
            x = x / F.lit(std) if std else x * F.lit(0.0)
        outs[o] = x
    return df.withColumns(outs)


def feature_pipeline(label: str, numeric: Sequence[str], categorical: Sequence[str], *,
                     label_col: str = "label", features_col: str = "features",
                     scale: bool = False, scaled_col: str = "scaledFeatures",
                     handle_invalid: str = "keep") -> Pipeline:
    """Label indexer (errors on unseen labels) + one multi-column category
    indexer + assembler (+ scaler without centring)."""
    stages = [StringIndexer(inputCol=label, outputCol=label_col, handleInvalid="error")]
    cat_out = [indexed_name(c) for c in categorical]
    if categorical:
        stages.append(StringIndexer(inputCols=list(categorical), outputCols=cat_out,
                                    handleInvalid=handle_invalid))
    stages.append(VectorAssembler(inputCols=list(numeric) + cat_out, outputCol=features_col))
    if scale:
        stages.append(StandardScaler(inputCol=features_col, outputCol=scaled_col,
                                     withStd=True, withMean=False))
    return Pipeline(stages=stages)


def label_levels(model: PipelineModel) -> list[str]:
    """Levels of the fitted label indexer (first stage)."""
    return list(model.stages[0].labels)


def max_category_levels(model: PipelineModel) -> int:
    """Most codes any categorical feature can take (levels + the 'unseen' code)."""
    most = 0
    for stage in model.stages[1:]:
        if isinstance(stage, StringIndexerModel):
            for labels in stage.labelsArray:
                most = max(most, len(labels) + 1)
    return most


def most_levels(df: DataFrame, columns: Sequence[str]) -> int:
    """The largest number of different values of any column, counted exactly before any
    level leaves the executors, all columns in one aggregate (one row reaches the driver)."""
    return max(df.agg(*[F.count_distinct(col_of(c)).alias(f"n{k}") for k, c in enumerate(columns)]).first())
