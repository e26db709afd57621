"""Classifiers on one sample: decision tree, random forest, linear SVM.

``train_and_score`` fits the feature pipeline on the training rows only, checks
what the model needs (category levels within ``maxBins`` for trees, exactly two
classes for the SVM), fits, predicts the test rows and returns the accuracy.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.ml.classification import (DecisionTreeClassifier, LinearSVC,
                                       RandomForestClassifier)
from pyspark.sql import DataFrame

from ..functions.columns import col as col_of
from .features import feature_pipeline, label_levels, max_category_levels, most_levels
from .metrics import accuracy_value


@dataclass(frozen=True)
class ModelSpec:
    """Which classifier to fit and with what parameters."""

    kind: str  # "decision_tree" | "random_forest" | "linear_svm"
    params: dict = field(default_factory=dict)

    @property
    def scales_features(self) -> bool:
        return self.kind == "linear_svm"

    @property
    def holds_trees_per_row(self) -> bool:
        """A fit keeps a count and a node per tree with each training row."""
        return self.kind == "random_forest"


def decision_tree(max_depth: int = 5, max_bins: int = 32, seed: int | None = None) -> ModelSpec:
    """Spark's defaults: depth 5, 32 bins."""
    return ModelSpec("decision_tree", {"maxDepth": max_depth, "maxBins": max_bins, "seed": seed})


def random_forest(num_trees: int = 20, max_depth: int = 10, max_bins: int = 32,
                  seed: int | None = None, bootstrap: bool = True,
                  features_per_split: str = "auto") -> ModelSpec:
    return ModelSpec("random_forest", {"numTrees": num_trees, "maxDepth": max_depth,
                                       "maxBins": max_bins, "seed": seed, "bootstrap": bootstrap,
                                       "featureSubsetStrategy": features_per_split})


def linear_svm(max_iter: int = 100, reg_param: float = 0.1,
               standardization: bool = True) -> ModelSpec:
    """Binary linear SVM; LinearSVC takes no seed (only the split is seeded)."""
    return ModelSpec("linear_svm", {"maxIter": max_iter, "regParam": reg_param,
                                    "standardization": standardization})


# Trees need maxBins >= the levels of every categorical feature (maxBins is raised to
# that where the caller's value is lower), and indexers hold all levels in memory; beyond
# this many levels the feature should be encoded differently, so the fit is refused.
MAX_TREE_BINS = 10_000


class DataProblem(ValueError):
    """The rows do not allow this fit; nothing is wrong with the cluster."""


def _estimator(spec: ModelSpec, label_col: str, features_col: str, min_bins: int):
    params = {k: v for k, v in spec.params.items() if v is not None}
    if spec.kind == "decision_tree":
        params["maxBins"] = max(params.get("maxBins", 32), min_bins)
        return DecisionTreeClassifier(labelCol=label_col, featuresCol=features_col, **params)
    if spec.kind == "random_forest":
        params["maxBins"] = max(params.get("maxBins", 32), min_bins)
        # Each row keeps its node in every tree, so a level does not walk all trees from the root again.
        # A fit of one pass per level ends before the first checkpoint; more passes cut their lineage.
        params = {"cacheNodeIds": True, "checkpointInterval": 2 * params.get("maxDepth", 5) + 2, **params}
        return RandomForestClassifier(labelCol=label_col, featuresCol=features_col, **params)
    if spec.kind == "linear_svm":
        return LinearSVC(labelCol=label_col, featuresCol=features_col, **params)
    raise ValueError(f"unknown model kind {spec.kind!r}")


@dataclass
class Score:
    accuracy: float | None
    n_test: int | None = None
    classes: int | None = None


def train_and_score(train: DataFrame, test: DataFrame, spec: ModelSpec, *, label: str,
                    numeric: Sequence[str], categorical: Sequence[str] = (),
                    on_fitted: Callable | None = None) -> Score:
    """Fit features + model on ``train``, return accuracy on ``test``.

    Raises :class:`DataProblem` for too many levels of a category, an SVM whose
    training labels are not exactly two classes, or a label seen only in test.
    """
    scale = spec.scales_features
    levels = most_levels(train, [label, *categorical])
    if levels >= MAX_TREE_BINS:
        raise DataProblem(f"a categorical column has {levels} levels; at most {MAX_TREE_BINS - 1} are indexed")
    features = feature_pipeline(label, numeric, categorical, scale=scale).fit(train)
    classes = len(label_levels(features))
    if spec.kind == "linear_svm" and classes != 2:
        raise DataProblem(f"linear SVM needs exactly 2 label values, training rows have {classes}")
    feat_col = "scaledFeatures" if scale else "features"
    known = label_levels(features)
    unseen = test.where(~col_of(label).cast("string").isin(known)).limit(1).count()
    if unseen:
        raise DataProblem("the test rows hold a label that the training rows do not")
    estimator = _estimator(spec, "label", feat_col, max_category_levels(features))
    train_f = features.transform(train)
    model = estimator.fit(train_f)
    if on_fitted is not None:
        on_fitted(features, model)
    preds = model.transform(features.transform(test))
    return Score(accuracy_value(preds, "label", "prediction"), classes=classes)
