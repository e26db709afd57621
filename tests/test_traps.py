"""One test per remaining decision on the traps of the studied workload."""

from pyspark.ml.classification import LinearSVC

from sampwise.operators.features import feature_pipeline
from sampwise.operators.models import _estimator, linear_svm, decision_tree
from sampwise.plans.experiments import run_experiments
from tests.fixtures import IRIS_SCHEMA, iris_like_rows


def test_svm_spec_has_no_seed(spark):
    # LinearSVC takes no seed; passing one would be a TypeError
    assert "seed" not in linear_svm().params
    est = _estimator(linear_svm(), "label", "features", 0)
    assert isinstance(est, LinearSVC) and not est.hasParam("seed")


def test_svm_standardization_is_an_option(spark):
    assert _estimator(linear_svm(), "label", "f", 0).getStandardization() is True
    off = _estimator(linear_svm(standardization=False), "label", "f", 0)
    assert off.getStandardization() is False


def test_results_do_not_depend_on_concurrency(spark):
    df = spark.createDataFrame(iris_like_rows(), IRIS_SCHEMA).coalesce(1)
    kw = dict(label="species", numeric=["sepal_length", "petal_length"],
              offsets=[0, 1, 2, 1], step=3)
    serial = run_experiments(df, decision_tree(seed=3), parallelism=1, **kw).collect()
    pooled = run_experiments(df, decision_tree(seed=3), parallelism=4, **kw).collect()
    assert [tuple(r) for r in serial] == [tuple(r) for r in pooled]


def test_indexers_fit_on_training_rows_only(spark):
    train = spark.createDataFrame([("a", 1.0, "no"), ("a", 2.0, "yes"), ("b", 3.0, "no")],
                                  "c string, x double, y string")
    test = spark.createDataFrame([("zzz", 1.0, "no")], "c string, x double, y string")
    model = feature_pipeline("y", ["x"], ["c"]).fit(train)
    code = model.transform(test).first()["c_indexed"]
    assert code == 2.0  # 'zzz' never seen in training: the extra 'unseen' code
