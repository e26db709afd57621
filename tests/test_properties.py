"""Brute-force checks of the column semantics on random inputs (hypothesis)."""

import hashlib

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from sampwise.functions.hashing import cumulative_bounds
from sampwise.operators.counts import word_count
from sampwise.operators.sampling import hash_split, systematic_sample

SETTINGS = settings(max_examples=15, deadline=None,
                    suppress_health_check=[HealthCheck.function_scoped_fixture,
                                           HealthCheck.too_slow])


def py_bucket(seed, key, weights):
    digest = hashlib.md5(f"{seed}|{key}".encode()).hexdigest()
    u = int(digest[:8], 16) / 4294967296.0
    for i, b in enumerate(cumulative_bounds(weights)[:-1]):
        if u < b:
            return i
    return len(weights) - 1


@SETTINGS
@given(keys=st.lists(st.integers(-(2 ** 63), 2 ** 63 - 1), max_size=60, unique=True),
       seed=st.integers(0, 10 ** 6),
       weights=st.lists(st.floats(0.01, 5.0), min_size=1, max_size=4))
def test_hash_split_matches_python_md5(spark, keys, seed, weights):
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = {r["k"]: r["split"] for r in hash_split(df, weights, seed, "k").collect()}
    assert got == {k: py_bucket(seed, k, weights) for k in keys}


@SETTINGS
@given(n=st.integers(0, 120), step=st.integers(1, 9), start=st.integers(-20, 30),
       base=st.sampled_from([0, 1]), parts=st.integers(1, 5))
def test_systematic_sample_matches_python(spark, n, step, start, base, parts):
    df = spark.range(0, n, 1, parts).selectExpr("id * 3 AS k")
    got = sorted(r["k"] for r in
                 systematic_sample(df, step, start, order_by="k", base=base).collect())
    assert got == [3 * i for i in range(n) if (i + base - start) % step == 0]


alphabet = st.sampled_from(list("abcXYZ .,;-'\t\n") + [
    "\u00a0", "\u2003", "\u3000", "\x1c", "\x85", "\u2028",  # whitespace to Python
    "\u00c9", "\u00df", "\u03a3", "\u200b"])  # case-folding cases; zero-width is not space


@SETTINGS
@given(lines=st.lists(st.text(alphabet, max_size=40), max_size=8))
def test_word_count_matches_python_split(spark, lines):
    df = spark.createDataFrame([(line,) for line in lines], "value string")
    got = {r["word"]: r["count"] for r in word_count(df).collect()}
    want = {}
    for line in lines:
        for w in line.split():
            want[w.lower()] = want.get(w.lower(), 0) + 1
    assert got == want
