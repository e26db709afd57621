from sampwise.operators.index import with_unique_id
from sampwise.sources.delimited import read_delimited, read_iris
from sampwise.sources.rows import from_rows
from sampwise.sources.tables import TABLES, table
from tests.conftest import SF_SMALL
from tests.fixtures import SPECIES, bank_csv_text, iris_csv_text


def test_read_iris_by_name(spark, tmp_dir):
    path = f"{tmp_dir}/iris.csv"
    with open(path, "w") as fh:
        fh.write(iris_csv_text())
    df = read_iris(spark, path)
    assert df.columns == ["sepal_length", "sepal_width", "petal_length", "petal_width",
                          "species"]
    assert dict(df.dtypes)["sepal_length"] == "double"
    counts = {r["species"]: r["count"] for r in df.groupBy("species").count().collect()}
    assert counts == {s: 50 for s in SPECIES}


def test_read_delimited_semicolon_inferred(spark, tmp_dir):
    path = f"{tmp_dir}/bank.csv"
    with open(path, "w") as fh:
        fh.write(bank_csv_text(20))
    df = read_delimited(spark, path, sep=";", header=True, infer_schema=True)
    assert df.count() == 20
    types = dict(df.dtypes)
    assert types["age"] == "int" and types["emp.var.rate"] == "double"
    assert types["job"] == "string"


def test_read_delimited_explicit_schema(spark, tmp_dir):
    path = f"{tmp_dir}/x.csv"
    with open(path, "w") as fh:
        fh.write("a;b\n1;x\n2;y\n")
    df = read_delimited(spark, path, sep=";", schema="a long, b string")
    assert [tuple(r) for r in df.orderBy("a").collect()] == [(1, "x"), (2, "y")]


def test_from_rows_and_unique_id(spark):
    df = from_rows(spark, [(1, "a"), (2, "b")], "n int, s string")
    ids = [r["uid"] for r in with_unique_id(df).collect()]
    assert len(set(ids)) == 2


def test_tables_readable(spark):
    for name in TABLES:
        assert table(spark, SF_SMALL, name).columns


def test_from_literals(spark):
    from pyspark.sql.types import IntegerType, StringType, StructField, StructType

    from sampwise.sources.rows import from_literals

    schema = StructType([StructField("a", IntegerType(), False),
                         StructField("b", StringType(), True)])
    df = from_literals(spark, [(1, "x"), (2, None)], schema)
    assert df.schema.fieldNames() == ["a", "b"] and dict(df.dtypes)["a"] == "int"
    assert sorted(tuple(r) for r in df.collect()) == [(1, "x"), (2, None)]
    assert df.rdd.getNumPartitions() == 1
    assert from_literals(spark, [], schema).count() == 0
