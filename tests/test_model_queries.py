"""Model queries have no SQL form: check their shape and invariants on the smallest tables."""

import pytest

from sampwise.plans.catalog import N_EXPERIMENTS, N_PARTS, QUERIES, experiment_offsets
from tests.conftest import SF_SMALL

# The noisy signal decides most rows but not all: no model can be near 1 without a leak.
LOW, HIGH = 0.6, 0.97
RESULT_COLS = ["experiment_id", "start_offset", "num_samples", "num_train", "num_test",
               "accuracy", "error"]


@pytest.mark.parametrize("name", ["dt_experiments", "rf_experiments", "svm_experiments"])
def test_experiment_queries(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    rows = df.orderBy("experiment_id").collect()
    assert df.columns == RESULT_COLS
    assert [r["experiment_id"] for r in rows] == list(range(1, N_EXPERIMENTS + 1))
    assert [r["start_offset"] for r in rows] == experiment_offsets()
    sizes = QUERIES["experiment_sizes"](spark, SF_SMALL).orderBy("experiment_id").collect()
    for r, s in zip(rows, sizes):
        assert (r["num_samples"], r["num_train"], r["num_test"]) == \
            (s["num_samples"], s["num_train"], s["num_test"])
        assert r["accuracy"] is not None and LOW <= r["accuracy"] <= HIGH, r["error"]


def test_summary_query(spark):
    row = QUERIES["experiment_summary"](spark, SF_SMALL).first()
    assert (row["planned"], row["finished"]) == (N_EXPERIMENTS, N_EXPERIMENTS)
    assert row["min_accuracy"] <= row["avg_accuracy"] <= row["max_accuracy"]


@pytest.mark.parametrize("name", ["per_part_models", "random_part_models"])
def test_part_queries(spark, name):
    rows = QUERIES[name](spark, SF_SMALL).orderBy("part").collect()
    assert [r["part"] for r in rows] == list(range(N_PARTS))
    total = spark.read.parquet(f"{SF_SMALL}/events.parquet").count()
    assert sum(r["num_samples"] for r in rows) == total
    assert all(r["accuracy"] is not None for r in rows)
