import math

import pytest
from pyspark.sql import functions as F

from sampwise.operators.sampling import (draw_offsets, hash_split, interval_sample,
                                         random_split, sampling_interval, systematic_partition,
                                         systematic_sample, train_test_split)
from tests.fixtures import IRIS_SCHEMA, SPECIES, iris_like_rows


def ids(df, col="id"):
    return sorted(r[col] for r in df.select(col).collect())


@pytest.mark.parametrize("step,start", [(5, 0), (5, 4), (3, 1), (1, 0), (7, 6)])
def test_systematic_sample_size(spark, step, start):
    n = 1003
    df = spark.range(0, n, 1, 4)
    got = ids(systematic_sample(df, step, start, order_by="id"))
    assert got == [i for i in range(n) if (i - start) % step == 0]
    assert len(got) == math.ceil((n - start) / step)


def test_start_beyond_step_is_residue(spark):
    df = spark.range(0, 100, 1, 2)
    a = ids(systematic_sample(df, 5, 7, order_by="id"))
    b = ids(systematic_sample(df, 5, 2, order_by="id"))
    assert a == b and 2 in a  # rows below start are kept (Python % semantics)


def test_one_based_equals_zero_based(spark):
    df = spark.range(0, 500, 1, 3).select((F.col("id") * 3).alias("k"))
    for k in (5, 3):
        for offset in range(k):
            m2 = ids(systematic_sample(df, k, offset, order_by="k", base=1), "k")
            m1 = ids(systematic_sample(df, k, (offset - 1) % k, order_by="k"), "k")
            assert m1 == m2


def test_systematic_partition_properties(spark):
    df = spark.range(0, 1000, 1, 5)
    parts = systematic_partition(df, 3, order_by="id").collect()
    by = {}
    for r in parts:
        by.setdefault(r["part"], []).append(r["id"])
    assert sorted(by) == [0, 1, 2]
    assert sorted(sum(by.values(), [])) == list(range(1000))
    sizes = [len(v) for v in by.values()]
    assert max(sizes) - min(sizes) <= 1
    for j in range(3):
        assert sorted(by[j]) == ids(systematic_sample(df, 3, j, order_by="id"))


def test_iris_systematic_partition_golden(spark):
    df = spark.createDataFrame(iris_like_rows(), IRIS_SCHEMA).coalesce(1)
    parts = systematic_partition(df, 3)  # input order, as zipWithIndex
    got = {(r["part"], r["species"]): r["count"] for r in
           parts.groupBy("part", "species").count().collect()}
    golden = {0: (17, 17, 16), 1: (17, 16, 17), 2: (16, 17, 17)}
    for part, counts in golden.items():
        for species, c in zip(SPECIES, counts):
            assert got[(part, species)] == c


def test_interval_sample(spark):
    df = spark.range(0, 1050, 1, 3)
    assert sampling_interval(1050, 100) == 10
    got = ids(interval_sample(df, 100, 3, order_by="id"))
    assert got == list(range(3, 1050, 10))


def test_draw_offsets_seeded():
    a = draw_offsets(5, 5, seed=1)
    assert a == draw_offsets(5, 5, seed=1)
    assert all(0 <= o < 5 for o in a)
    b = draw_offsets(5, 5, seed=1, replace=False)
    assert sorted(b) == [0, 1, 2, 3, 4]
    with pytest.raises(ValueError):
        draw_offsets(5, 6, seed=1, replace=False)


def test_hash_split_independent_of_layout(spark):
    df = spark.range(0, 5000, 1, 3)
    a = {r["id"]: r["split"] for r in hash_split(df, [0.33, 0.33, 0.34], 42, "id").collect()}
    b = {r["id"]: r["split"] for r in
         hash_split(df.repartition(11), [0.33, 0.33, 0.34], 42, "id").collect()}
    assert a == b
    counts = [list(a.values()).count(i) for i in range(3)]
    assert all(abs(c - e) < 200 for c, e in zip(counts, (1650, 1650, 1700)))


def test_random_split_disjoint_cover(spark):
    df = spark.range(0, 3000, 1, 4)
    parts = random_split(df, [1, 1, 1], 42, "id")
    all_ids = sorted(sum((ids(p) for p in parts), []))
    assert all_ids == list(range(3000))
    bern = random_split(df, [0.5, 0.5], 42, method="bernoulli")
    assert sum(p.count() for p in bern) == 3000


def test_train_test_split_fraction(spark):
    df = spark.range(0, 10000, 1, 4)
    train, test = train_test_split(df, 0.8, 7, "id")
    n_train, n_test = train.count(), test.count()
    assert n_train + n_test == 10000 and abs(n_train - 8000) < 200


def test_sample_plan_has_no_full_sort_or_single_task(spark):
    df = spark.range(0, 50000, 1, 4)
    plan = systematic_sample(df, 5, 1)._jdf.queryExecution().executedPlan().toString()
    # the per-split counts are numbered once, when the rows are placed, and read back
    assert "Sort [" not in plan and "Window" not in plan and "SinglePartition" not in plan


def test_bad_step(spark):
    with pytest.raises(ValueError):
        systematic_sample(spark.range(3), 0)
    with pytest.raises(ValueError):
        systematic_partition(spark.range(3), 0)


def test_xxhash_split_layout_independent(spark):
    df = spark.range(0, 20000, 1, 3)
    kw = dict(name="s", hash_fn="xxhash64")
    a = {r["id"]: r["s"] for r in hash_split(df, [0.7, 0.3], 5, "id", **kw).collect()}
    b = {r["id"]: r["s"] for r in hash_split(df.repartition(9), [0.7, 0.3], 5, "id",
                                             **kw).collect()}
    assert a == b
    share = sum(1 for v in a.values() if v == 0) / len(a)
    assert abs(share - 0.7) < 0.02
    md5 = {r["id"]: r["s"] for r in hash_split(df, [0.7, 0.3], 5, "id", name="s").collect()}
    assert md5 != a  # a different, equally valid draw
    with pytest.raises(ValueError):
        hash_split(df, [1, 1], 5, "id", hash_fn="crc")
