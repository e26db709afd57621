"""Row locators: samples without moved payload, scan order without a copy."""

import re

import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from sampwise.operators.index import indexed
from sampwise.operators.locators import located_sample, require_bare_scan, scan_order_index
from sampwise.operators.sampling import interval_sample, systematic_sample
from sampwise.plans.catalog import QUERIES, scan_order_facts
from tests.conftest import SF_SMALL


@pytest.fixture(scope="module")
def files(spark, tmp_path_factory):
    """Several files of several row groups, repeated and NULL keys, odd column names."""
    path = str(tmp_path_factory.mktemp("wide table")) + "/t"
    df = spark.range(5000).select(
        F.when(F.col("id") % 7 > 0, F.pmod(F.col("id") * 37, F.lit(900))).alias("key"),
        F.col("id").alias("a.b"), F.concat(F.lit("payload "), F.col("id")).alias("text"),
        F.timestamp_micros(F.col("id") * 1_000_003).alias("row_number"),
        F.array(F.col("id"), F.lit(None)).alias("list"))
    (df.repartition(5).write.option("parquet.block.size", 20_000).option("parquet.page.size", 1000).parquet(path))
    return path


def rows(df):
    return sorted(map(repr, df.collect()))


@pytest.mark.parametrize("base, start", [(0, 2), (1, 0), (0, -3)])
def test_key_order_sample_equals_the_moved_one(spark, files, base, start):
    scan = spark.read.parquet(files)
    got = located_sample(scan, 5, start, order_by="key", base=base)
    assert got.columns == ["row_index", *scan.columns]
    meta = scan.select("*", F.col("_metadata.file_path").alias("f"), F.col("_metadata.row_index").alias("p"))
    want = systematic_sample(meta, 5, start, order_by=["key", "f", "p"], base=base).drop("f", "p")
    assert rows(got) == rows(want) and got.count() in (1000, 1001)


def test_sample_by_number_and_without_index(spark, files):
    scan = spark.read.parquet(files)
    got = located_sample(scan, n_samples=100, order_by=["key", "a.b"], keep_index=False)
    assert got.columns == scan.columns and got.count() == 100
    want = interval_sample(scan, 100, order_by=["key", "a.b"]).drop("row_index")
    assert rows(got) == rows(want)


def test_payload_is_in_no_exchange_and_no_copy(spark, files):
    scan = spark.read.parquet(files)
    plan = located_sample(scan, 5, 2, order_by="key")._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if re.search(r"Exchange|FileScan", line)]
    assert moved and not any(c in line for line in moved for c in ("text", "a.b", "row_number", "list"))
    assert "BroadcastExchange" in plan  # the per-partition offsets


def test_scan_index_does_not_depend_on_splits(spark, files):
    seen = []
    for most in ("128m", "4k", "9000"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", most)
        try:
            idx = scan_order_index(spark.read.parquet(files))
            plan = idx._jdf.queryExecution().executedPlan().toString()
            assert "hashpartitioning" not in plan and "rangepartitioning" not in plan
            seen.append(rows(idx))
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
    assert seen[0] == seen[1] == seen[2]
    assert sorted(r[0] for r in idx.select("row_index").collect()) == list(range(5000))


@pytest.mark.parametrize("kind", ["csv", "text"])
def test_scan_index_of_lines_does_not_depend_on_splits(spark, tmp_path, kind):
    path = str(tmp_path / "lines")
    spark.range(3000).select(F.concat(F.lit("line,"), F.col("id")).alias("value")).repartition(3).write.text(path)
    want = []
    import glob
    for file in sorted(glob.glob(path + "/part*")):
        want += open(file).read().split("\n")[:-1]
    for most in ("128m", "2k", "700"):
        spark.conf.set("spark.sql.files.maxPartitionBytes", most)
        try:
            scan = spark.read.text(path) if kind == "text" else spark.read.csv(path)
            got = scan_order_index(scan, base=1).collect()
        finally:
            spark.conf.unset("spark.sql.files.maxPartitionBytes")
        assert [",".join(r[1:]) for r in sorted(got)] == want
        assert sorted(r[0] for r in got) == list(range(1, 3001))


def test_scan_order_sample_of_a_file(spark, tmp_path):
    path = str(tmp_path / "bank.csv")
    with open(path, "w") as out:
        out.write("age;job\n" + "".join(f"{k};job{k}\n" for k in range(103)))
    scan = spark.read.option("header", True).option("sep", ";").csv(path)
    got = located_sample(scan, 5, 3, base=1)
    assert [(r[0], r[1]) for r in sorted(got.collect())] == [(i, str(i - 1)) for i in range(3, 104, 5)]


def test_empty_tables(spark, tmp_path):
    path = str(tmp_path / "none")
    spark.range(0).write.parquet(path)
    scan = spark.read.parquet(path)
    assert scan_order_index(scan).collect() == []
    assert located_sample(scan, 3, order_by="id").collect() == []
    assert located_sample(scan, n_samples=3).collect() == []


def test_frames_that_are_no_bare_scan_are_refused(spark, files):
    scan = spark.read.parquet(files)
    assert require_bare_scan(scan.select("key")) == "parquet"
    for odd in (scan.where("key > 3"), scan.distinct(), scan.limit(3), scan.union(scan), scan.repartition(3),
                scan.withColumn("x", F.explode(F.array(F.lit(1), F.lit(2)))), spark.range(3), scan.sample(0.5)):
        with pytest.raises(ValueError):
            located_sample(odd, 3)
    with pytest.raises(ValueError):
        located_sample(scan, 3, n_samples=3)
    with pytest.raises(ValueError):
        located_sample(scan, 3, order_by="nothing")


def test_size_comes_from_the_stored_counts(spark):
    orders = spark.read.parquet(f"{SF_SMALL}/orders.parquet").select("o_orderkey", "o_custkey")
    numbered = indexed(orders, "o_orderkey")
    assert numbered.size() == orders.count() == numbered.frame.count()
    assert "o_orderkey" not in numbered.counts.columns


def test_scan_order_facts_see_every_pair_of_neighbours(spark):
    """Wrong steps inside a stretch and on its edge, in two files; the one-window form is the reference."""
    places = spark.range(40).select(F.col("id").alias("place"))
    file = F.explode(F.array(F.lit("a"), F.lit("b"))).alias("file")
    index = F.col("place") + F.when(F.col("file") == "b", 40).otherwise(0)
    idx = places.select(file, "place").withColumn(
        "row_index", F.when(index.isin(7, 8, 43), F.lit(70)).when(index == 61, F.lit(0)).otherwise(index))
    step = Window.partitionBy("file").orderBy("place")
    seen = idx.withColumn("before", F.lag("row_index").over(step))
    want = seen.agg(F.count(F.lit(1)), F.min("row_index"), F.max("row_index"), F.countDistinct("row_index"),
                    F.count_if(F.col("before") >= F.col("row_index"))).first()
    assert want[4] == 4
    for stretch in (1, 2, 8, 1000):
        assert tuple(scan_order_facts(idx, stretch).first()) == tuple(want)
    assert tuple(scan_order_facts(idx.where("place < 0"), 8).first()) == (0, None, None, 0, 0)


def test_scan_order_query_compares_a_file_in_many_tasks(spark):
    """No window takes the rows of a file as one group: rows meet by stretch, only stretches by file."""
    plan = QUERIES["row_index_scan_order"](spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
    groups = re.findall(r"Window \[lag\(row_index.*?\], \[([^\]]*)\], \[place", plan)
    assert groups and all("stretch" in g for g in groups)
    assert not re.search(r"keys=\[row_index#\w+\].*partial_count\(1\)", plan)
