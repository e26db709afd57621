"""Evaluation of predictions as DataFrame aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.columns import col as col_of
from ..functions.predicates import correct


def accuracy(predictions: DataFrame, label: str = "label",
             prediction: str = "prediction") -> DataFrame:
    """One row ``(n, n_correct, accuracy)``; accuracy is NULL on no rows.

    Same value as MulticlassClassificationEvaluator(metricName="accuracy"),
    computed as one global aggregate with map-side partials.
    """
    hit = correct(label, prediction)
    return predictions.agg(F.count(F.lit(1)).alias("n"),
                           F.coalesce(F.sum(hit), F.lit(0.0)).cast("long").alias("n_correct"),
                           F.avg(hit).alias("accuracy"))


def accuracy_value(predictions: DataFrame, label: str = "label",
                   prediction: str = "prediction") -> float | None:
    row = accuracy(predictions, label, prediction).first()
    return None if row is None else row["accuracy"]


def confusion(predictions: DataFrame, label: str = "label",
              prediction: str = "prediction") -> DataFrame:
    """``(label, prediction, count)`` for every observed pair."""
    return (predictions.groupBy(col_of(label).alias("label"),
                                col_of(prediction).alias("prediction"))
            .agg(F.count(F.lit(1)).alias("count")))
