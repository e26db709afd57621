import pytest
from pyspark.sql import functions as F

from sampwise.operators.index import with_row_index


def indexes(df, name="row_index"):
    return sorted(r[0] for r in df.select(name).collect())


@pytest.mark.parametrize("parts", [1, 4, 50])
def test_scan_order_index_is_consecutive(spark, parts, tmp_dir):
    path = f"{tmp_dir}/t"
    spark.range(0, 3000, 1, parts).write.parquet(path)
    df = spark.read.parquet(path)
    out = with_row_index(df)
    assert indexes(out) == list(range(3000))


def test_scan_order_equals_zip_with_index(spark, tmp_dir):
    path = f"{tmp_dir}/z"
    spark.range(0, 2000, 1, 7).select((F.col("id") * 7919 % 2000).alias("v")).write.parquet(path)
    df = spark.read.parquet(path)
    ours = {r["row_index"]: r["v"] for r in with_row_index(df).collect()}
    ref = {i: row["v"] for row, i in df.rdd.zipWithIndex().collect()}
    assert ours == ref


@pytest.mark.parametrize("partitions", [None, 53])
@pytest.mark.parametrize("parts", [1, 4, 50])
def test_key_order_index(spark, parts, partitions):
    df = spark.range(0, 5000, 1, parts).select(
        ((F.col("id") * 7919) % 5003).alias("k"), F.col("id").alias("payload"))
    out = with_row_index(df, "k", partitions=partitions).collect()
    by_index = sorted(out, key=lambda r: r["row_index"])
    assert [r["row_index"] for r in by_index] == list(range(5000))
    keys = [r["k"] for r in by_index]
    assert keys == sorted(keys)


def test_key_order_base_one(spark):
    df = spark.range(10).select((9 - F.col("id")).alias("k"))
    out = {r["k"]: r["row_index"] for r in with_row_index(df, "k", base=1).collect()}
    assert out == {k: k + 1 for k in range(10)}


def test_hot_key_and_nulls_are_spread_and_ordered(spark):
    # a third of the rows share one key, a seventh are NULL
    df = spark.range(0, 6000, 1, 6).select(
        F.when(F.col("id") % 3 == 0, F.lit(500))
        .when(F.col("id") % 7 == 0, F.lit(None))
        .otherwise(F.col("id")).alias("k"))
    out = with_row_index(df, "k", partitions=12)
    rows = sorted(out.collect(), key=lambda r: r["row_index"])
    assert [r["row_index"] for r in rows] == list(range(6000))
    keys = [-1 if r["k"] is None else r["k"] for r in rows]
    assert keys == sorted(keys)
    # the hot value is not kept in one partition: several hold it, none more than its share
    stored = spark.read.parquet(out.inputFiles()[0].rsplit("/", 1)[0])
    sizes = [r["count"] for r in stored.groupBy(F.shiftright("_sw_mid", 33)).count().collect()]
    assert len(sizes) == 12 and max(sizes) < 2 * 6000 / 12


def test_double_key_with_nan(spark):
    vals = [3.5, float("nan"), -1.0, 2.0, None, 1e300]
    df = spark.createDataFrame([(v,) for v in vals], "k double")
    rows = sorted(with_row_index(df, "k", partitions=10).collect(),
                  key=lambda r: r["row_index"])
    got = [r["k"] for r in rows]
    assert got[0] is None and got[1:5] == [-1.0, 2.0, 3.5, 1e300]
    assert got[5] != got[5]  # NaN sorts last


def test_string_key(spark):
    words = [f"w{i:05d}" for i in range(3000)]
    df = spark.createDataFrame([(w,) for w in reversed(words)], "k string").repartition(5)
    rows = sorted(with_row_index(df, "k", partitions=10).collect(),
                  key=lambda r: r["row_index"])
    assert [r["k"] for r in rows] == words
    assert [r["row_index"] for r in rows] == list(range(3000))


def test_two_column_key(spark):
    df = spark.range(0, 1000, 1, 3).select((F.col("id") % 10).alias("a"),
                                           (-F.col("id")).alias("b"))
    rows = sorted(with_row_index(df, ["a", "b"]).collect(), key=lambda r: r["row_index"])
    pairs = [(r["a"], r["b"]) for r in rows]
    assert pairs == sorted(pairs)


def test_rows_after_a_shuffle(spark):
    """No row is lost or doubled when the count and the data pass would split differently."""
    df = spark.range(0, 60000, 1, 4).repartition("id")
    joined = df.join(spark.range(60000).withColumnRenamed("id", "other").hint("merge"),
                     F.col("id") == F.col("other"))
    for rows in (df, joined):
        facts = with_row_index(rows).agg(F.count("*"), F.countDistinct("row_index"),
                                         F.countDistinct("id"), F.max("row_index")).first()
        assert tuple(facts) == (60000, 60000, 60000, 59999)
        with pytest.raises(ValueError, match="shuffles"):
            with_row_index(rows, deterministic_input=True)


def test_hot_keys_that_share_a_double(spark):
    key = F.when(F.col("id") % 3 == 0, F.col("id")).otherwise(F.lit(2 ** 60) + F.col("id") % 2)
    df = spark.range(0, 40000, 1, 4).select(key.alias("k"), "id")
    out = with_row_index(df, "k", partitions=40)
    assert indexes(out) == list(range(40000))
    ends = out.where(F.col("k") >= 2 ** 60).groupBy("k").agg(
        F.min("row_index").alias("low"), F.max("row_index").alias("high"), F.count("*").alias("n")).collect()
    (a, b) = sorted(tuple(r) for r in ends)
    assert a[2] + 1 == b[1] and all(r[2] - r[1] + 1 == r[3] for r in (a, b))


def test_largest_range_is_near_the_mean(spark):
    df = spark.range(0, 200000, 1, 8).select((F.col("id") * 7919 % 200003).alias("k"))
    out = with_row_index(df, "k", partitions=100)
    stored = spark.read.parquet(out.inputFiles()[0].rsplit("/", 1)[0])
    sizes = [r["count"] for r in stored.groupBy(F.shiftright("_sw_mid", 33)).count().collect()]
    assert len(sizes) == 100 and max(sizes) < 2 * 2000


def single_partition_inputs(df):
    """Input column lists of every SinglePartition exchange in the formatted plan."""
    jvm = df.sparkSession._jvm
    mode = jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted")
    text = df._jdf.queryExecution().explainString(mode)
    found = []
    for block in text.split("\n\n"):
        if "Arguments: SinglePartition" in block:
            found.append(next(l for l in block.splitlines() if l.startswith("Input")))
    return text, found


def test_no_single_partition_exchange_over_data(spark):
    df = spark.range(0, 100000, 1, 8).select(F.col("id").alias("k"), F.lit("x").alias("p"))
    for out in (with_row_index(df, "k", partitions=10), with_row_index(df)):
        text, inputs = single_partition_inputs(out)
        assert "Window" not in text  # the counts are numbered once, when the rows are placed
        for line in inputs:
            cols = line.split("[", 2)[2].rstrip("]").split(", ")
            # only the per-group counts table is gathered in one task
            assert all(c.startswith("_sw_") for c in cols), line


def test_existing_name_rejected(spark):
    with pytest.raises(ValueError):
        with_row_index(spark.range(3).withColumnRenamed("id", "row_index"))


def test_timestamp_ntz_and_date_keys_use_ranges(spark):
    import datetime as dt

    base = dt.datetime(2024, 3, 10, 1, 0, 0)
    stamps = [base + dt.timedelta(minutes=7 * ((i * 7919) % 700), microseconds=i)
              for i in range(700)]
    df = spark.createDataFrame([(s, s.date(), i) for i, s in enumerate(stamps)],
                               "ts timestamp_ntz, d date, i long")
    for key, conv in (("ts", lambda s: s), ("d", lambda s: s.date())):
        out = with_row_index(df, key, partitions=12).collect()
        rows = sorted(out, key=lambda r: r["row_index"])
        assert [r["row_index"] for r in rows] == list(range(700))
        assert [r[key] for r in rows] == sorted(conv(s) for s in stamps)


def test_timestamp_key_with_session_zone(spark):
    import datetime as dt

    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        base = dt.datetime(2024, 3, 10, 1, 30, 0)  # spans the spring-forward gap
        stamps = [base + dt.timedelta(minutes=3 * i) for i in range(400)]
        df = spark.createDataFrame([(s,) for s in reversed(stamps)], "ts timestamp_ntz")
        rows = sorted(with_row_index(df, "ts", partitions=12).collect(),
                      key=lambda r: r["row_index"])
        assert [r["ts"] for r in rows] == stamps
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("kind", ["long", "double"])
def test_mixed_keys(spark, kind):
    n = 20000
    k = (F.when(F.col("id") % 5 == 0, F.lit(3)).when(F.col("id") % 11 == 0, F.lit(None))
         .otherwise((F.col("id") * 7919) % 100003 - 50000))
    df = spark.range(0, n, 1, 3).select(k.cast(kind).alias("k"), F.col("id"))
    if kind == "double":
        df = df.withColumn("k", F.when(F.col("id") == 17, F.lit(float("nan")))
                           .otherwise(F.col("k")))
    out = with_row_index(df, "k")
    text, inputs = single_partition_inputs(out)
    for line in inputs:
        assert all(c.split("#")[0].startswith("_sw_") for c in
                   line.split("[", 2)[2].rstrip("]").split(", ")), line
    rows = sorted(out.collect(), key=lambda r: r["row_index"])
    assert [r["row_index"] for r in rows] == list(range(n))
    keys = [r["k"] for r in rows]
    nulls = sum(1 for x in keys if x is None)
    assert all(x is None for x in keys[:nulls])
    rest = keys[nulls:]
    if kind == "double":
        assert rest[-1] != rest[-1]  # NaN last
        rest = rest[:-1]
    assert rest == sorted(rest)


@pytest.mark.parametrize("order_by", [None, "k.v", "s.t"])
def test_dotted_column_names(spark, order_by):
    df = spark.range(0, 300, 1, 3).selectExpr("id * 7 % 300 AS `k.v`",
                                              "cast(id AS string) AS `s.t`", "id AS `a.b`")
    out = with_row_index(df, order_by)
    assert out.columns == ["row_index", "k.v", "s.t", "a.b"]
    assert indexes(out) == list(range(300))


def test_timestamp_with_zone_key(spark):
    import datetime as dt

    spark.conf.set("spark.sql.session.timeZone", "America/New_York")
    try:
        base = dt.datetime(2024, 11, 3, 0, 0, 0, tzinfo=dt.timezone.utc)
        stamps = [base + dt.timedelta(minutes=2 * ((i * 37) % 500)) for i in range(500)]
        df = spark.createDataFrame([(s, i) for i, s in enumerate(stamps)], "ts timestamp, i int")
        rows = sorted(with_row_index(df, "ts", partitions=12).collect(),
                      key=lambda r: r["row_index"])
        assert [r["row_index"] for r in rows] == list(range(500))
        got = [r["ts"] for r in rows]
        assert got == sorted(got)
    finally:
        spark.conf.set("spark.sql.session.timeZone", "UTC")


@pytest.mark.parametrize("order_by", [None, "k"])
def test_recomputation_gives_same_index(spark, tmp_dir, order_by):
    path = f"{tmp_dir}/re_{order_by}"
    spark.range(0, 20000, 1, 6).selectExpr("(id * 7919) % 20011 AS k", "id").write.parquet(path)
    out = with_row_index(spark.read.parquet(path), order_by, partitions=10)
    first = {r["id"]: r["row_index"] for r in out.collect()}
    second = {r["id"]: r["row_index"] for r in out.collect()}  # a second, full re-run
    assert first == second and sorted(first.values()) == list(range(20000))
