"""Property tests: the key-order index is a permutation of 0..N-1 consistent with the key."""

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql.types import LongType, StructField, StructType

from sampwise.operators.index import with_row_index

BIG = 2 ** 60

keys = st.lists(
    st.one_of(
        st.none(),
        st.integers(-50, 50),                      # many duplicates
        st.integers(-(2 ** 62), 2 ** 62),          # spread out
        st.integers(BIG, BIG + 300),               # distinct longs that share a double
        st.just(7),                                # a hot value
    ),
    min_size=0, max_size=400)


@settings(max_examples=12, deadline=None,
          suppress_health_check=[HealthCheck.function_scoped_fixture,
                                 HealthCheck.too_slow])
@given(values=keys, parts=st.integers(1, 6), per_bucket=st.sampled_from([1, 4, 64]))
def test_index_is_ordered_permutation(spark, values, parts, per_bucket):
    schema = StructType([StructField("k", LongType(), True),
                         StructField("pos", LongType(), False)])
    df = spark.createDataFrame([(v, i) for i, v in enumerate(values)], schema)
    df = df.repartition(parts) if values else df
    out = with_row_index(df, "k", partitions=per_bucket).collect()
    assert sorted(r["row_index"] for r in out) == list(range(len(values)))
    assert sorted(r["pos"] for r in out) == list(range(len(values)))
    ordered = [r["k"] for r in sorted(out, key=lambda r: r["row_index"])]
    as_sortable = [(0, 0) if k is None else (1, k) for k in ordered]
    assert as_sortable == sorted(as_sortable)
