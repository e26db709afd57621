import pytest
from pyspark.ml.evaluation import MulticlassClassificationEvaluator
from pyspark.sql import functions as F

from sampwise.operators.features import feature_pipeline
from sampwise.operators.index import with_row_index
from sampwise.operators.metrics import accuracy, accuracy_value, confusion
from sampwise.operators.models import (decision_tree, linear_svm, random_forest,
                                       train_and_score)
from sampwise.operators.sampling import train_test_split
from tests.fixtures import IRIS_SCHEMA, iris_like_rows

NUMERIC = ["sepal_length", "sepal_width", "petal_length", "petal_width"]


@pytest.fixture(scope="module")
def iris(spark):
    df = spark.createDataFrame(iris_like_rows(), IRIS_SCHEMA)
    return with_row_index(df.coalesce(1), name="rid").cache()


def test_decision_tree_learns(iris):
    train, test = train_test_split(iris, 0.8, 1, "rid")
    score = train_and_score(train, test, decision_tree(), label="species", numeric=NUMERIC)
    assert score.accuracy >= 0.9 and score.classes == 3


def test_same_seed_same_accuracy(iris):
    train, test = train_test_split(iris, 0.8, 3, "rid")
    spec = random_forest(num_trees=5, max_depth=4, seed=42)
    a = train_and_score(train, test, spec, label="species", numeric=NUMERIC).accuracy
    b = train_and_score(train, test, spec, label="species", numeric=NUMERIC).accuracy
    assert a == b and a >= 0.9


def test_svm_refuses_three_classes(iris):
    train, test = train_test_split(iris, 0.8, 1, "rid")
    with pytest.raises(ValueError, match="exactly 2"):
        train_and_score(train, test, linear_svm(), label="species", numeric=NUMERIC)


def test_svm_two_classes(iris):
    two = iris.filter(F.col("species") != "Iris-virginica")
    train, test = train_test_split(two, 0.8, 1, "rid")
    score = train_and_score(train, test, linear_svm(max_iter=20), label="species",
                            numeric=NUMERIC)
    assert score.accuracy >= 0.9


def test_many_levels_raise_max_bins(spark):
    rows = [(f"c{i % 40}", float(i % 40 >= 20), "yes" if i % 40 >= 20 else "no")
            for i in range(400)]
    df = spark.createDataFrame(rows, "cat string, x double, y string")
    df = with_row_index(df.coalesce(1), name="rid")
    train, test = train_test_split(df, 0.8, 1, "rid")
    score = train_and_score(train, test, decision_tree(max_bins=32), label="y",
                            numeric=["x"], categorical=["cat"])
    assert score.accuracy == 1.0


def test_accuracy_equals_evaluator(spark):
    rows = [(float(i % 3), float((i * 7) % 3)) for i in range(100)]
    preds = spark.createDataFrame(rows, "label double, prediction double")
    ev = MulticlassClassificationEvaluator(labelCol="label", predictionCol="prediction",
                                           metricName="accuracy").evaluate(preds)
    assert accuracy_value(preds) == pytest.approx(ev, abs=1e-15)
    row = accuracy(preds).first()
    assert row["n"] == 100 and row["n_correct"] == round(ev * 100)
    cells = {(r["label"], r["prediction"]): r["count"] for r in confusion(preds).collect()}
    assert sum(cells.values()) == 100


def test_accuracy_empty_is_null(spark):
    empty = spark.createDataFrame([], "label double, prediction double")
    assert accuracy_value(empty) is None


def test_too_many_levels_refused(spark, monkeypatch):
    import sampwise.operators.models as M

    monkeypatch.setattr(M, "MAX_TREE_BINS", 10)
    rows = [(f"c{i % 40}", float(i % 2), "yes" if i % 2 else "no") for i in range(200)]
    df = with_row_index(spark.createDataFrame(rows, "cat string, x double, y string")
                        .coalesce(1), name="rid")
    train, test = train_test_split(df, 0.8, 1, "rid")
    with pytest.raises(ValueError, match="levels"):
        train_and_score(train, test, decision_tree(), label="y", numeric=["x"],
                        categorical=["cat"])


def test_forest_rows_keep_their_nodes(iris, spark):
    """No level walks the trees from the root again, and the forest is that of the plain learner."""
    from pyspark.ml.classification import RandomForestClassifier
    from sampwise.operators.models import _estimator

    fit = _estimator(random_forest(num_trees=8, max_depth=6, seed=5), "label", "features", 32)
    assert fit.getCacheNodeIds() and fit.getCheckpointInterval() > fit.getMaxDepth()
    rows = feature_pipeline("species", NUMERIC, []).fit(iris).transform(iris)
    plain = RandomForestClassifier(labelCol="label", featuresCol="features", numTrees=8, maxDepth=6, maxBins=32, seed=5)
    held = spark.sparkContext._jsc.getPersistentRDDs().size()
    ours, theirs = (m.fit(rows).toDebugString.split("\n", 1)[1] for m in (fit, plain))
    assert ours == theirs and "Tree 7" in ours
    assert spark.sparkContext._jsc.getPersistentRDDs().size() == held
