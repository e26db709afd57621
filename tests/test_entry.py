import importlib.util
import os

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def load_entry():
    spec = importlib.util.spec_from_file_location("spark_entry",
                                                  os.path.join(ROOT, "__spark_entry__.py"))
    mod = importlib.util.module_from_spec(spec)
    spec.loader.exec_module(mod)
    return mod


def test_entry_runs(spark):
    mod = load_entry()
    df = mod.entry(spark)
    rows = df.collect()
    assert len(rows) == 5
    assert df.columns == ["experiment_id", "start_offset", "num_samples", "num_train",
                          "num_test", "accuracy", "error"]
    assert all(r["accuracy"] is not None for r in rows)


def test_contract_keys(spark):
    mod = load_entry()
    # the optional training-data operators are tested in tests/llm
    q = {k: v for k, v in mod.queries().items() if k not in mod.LLM_QUERIES}
    o = {k: v for k, v in mod.oracle_sql().items() if k not in mod.LLM_ORACLE_SQL}
    assert set(o) <= set(q)
    missing = set(q) - set(o)
    # only model fits lack a SQL form
    assert missing == {"dt_experiments", "rf_experiments", "levelwise_dt", "levelwise_rf", "svm_experiments", "batched_svm",
                       "experiment_summary", "per_part_models", "random_part_models"}
