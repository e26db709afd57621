import pytest
from pyspark.sql import functions as F

from sampwise.operators.features import (assemble, index_columns, scale_columns,
                                         vector_columns)
from sampwise.sources.delimited import clean_column_names, clean_name, to_typed


def test_index_frequency_then_value(spark):
    vals = ["b"] * 3 + ["a"] * 3 + ["c"] * 5 + ["d"]
    df = spark.createDataFrame([(v,) for v in vals], "v string")
    got = {r["v"]: r["v_indexed"] for r in index_columns(df, ["v"]).distinct().collect()}
    assert got == {"c": 0.0, "a": 1.0, "b": 2.0, "d": 3.0}


def test_index_two_columns_and_unseen(spark):
    train = spark.createDataFrame([("x", "p"), ("x", "q"), ("y", "q")], "a string, b string")
    out = index_columns(train, ["a", "b"])
    got = {(r["a"], r["b"]): (r["a_indexed"], r["b_indexed"]) for r in out.collect()}
    assert got[("x", "q")] == (0.0, 0.0)
    assert got[("y", "q")] == (1.0, 0.0)
    with_null = spark.createDataFrame([("x",), (None,)], "a string")
    codes = sorted(r["a_indexed"] for r in index_columns(with_null, ["a"]).collect())
    assert codes == [0.0, 1.0]  # NULL kept as the extra code


def test_assemble_round_trip(spark):
    df = spark.createDataFrame([(1.0, 2.0), (3.0, 4.5)], "a double, b double")
    out = vector_columns(assemble(df, ["a", "b"], "v").select("v"), "v", ["x", "y"])
    assert sorted(tuple(r) for r in out.collect()) == [(1.0, 2.0), (3.0, 4.5)]


def test_scale_is_x_over_sample_std_and_zero_variance(spark):
    df = spark.createDataFrame([(1.0, 5.0), (2.0, 5.0), (3.0, 5.0), (6.0, 5.0)],
                               "a double, c double")
    out = scale_columns(df, ["a", "c"], ["a_s", "c_s"]).collect()
    std = df.agg(F.stddev_samp("a")).first()[0]
    for r in out:
        assert r["a_s"] == pytest.approx(r["a"] / std)
        assert r["c_s"] == 0.0  # zero variance scales to 0.0 (no centring)


def test_clean_column_names_dots():
    assert clean_name("emp.var.rate") == "emp_var_rate"


def test_clean_column_names(spark):
    df = spark.createDataFrame([(1, 2.0)], "`emp.var.rate` int, `nr.employed` double")
    out = clean_column_names(df)
    assert out.columns == ["emp_var_rate", "nr_employed"]
    mapped = clean_column_names(df, {"emp.var.rate": "rate"})
    assert mapped.columns == ["rate", "nr.employed"]
    with pytest.raises(ValueError, match="not found"):
        clean_column_names(df, {"`emp.var.rate`": "rate"})  # backticks are not names


def test_to_typed(spark):
    df = spark.createDataFrame([("1.5", "x")], "a string, b string")
    out = to_typed(df, {"val": ("a", "double"), "name": ("b", "string")})
    assert out.dtypes == [("val", "double"), ("name", "string")]
    assert out.first()["val"] == 1.5


def test_scale_columns_equals_ml_standard_scaler(spark):
    from pyspark.ml.feature import StandardScaler
    from pyspark.ml.functions import vector_to_array

    rows = [(float((i * 37) % 101), float((i * 11) % 7) * 0.5) for i in range(300)]
    df = spark.createDataFrame(rows, "a double, b double")
    vec = assemble(df, ["a", "b"], "v")
    ml = StandardScaler(inputCol="v", outputCol="s", withStd=True, withMean=False).fit(vec)
    want = sorted(tuple(r[0]) for r in
                  ml.transform(vec).select(vector_to_array("s")).collect())
    got = sorted((r["a_s"], r["b_s"]) for r in
                 scale_columns(df, ["a", "b"], ["a_s", "b_s"]).collect())
    for w, g in zip(want, got):
        assert g == pytest.approx(w, rel=1e-12)
