"""Types of delimited files: the lattice, misfits, malformed lines, defined cases."""

import os

import pytest
from pyspark.sql import functions as F

from sampwise.sources.infer import TYPES, infer_delimited, mask, narrowest


def write(folder, *texts):
    for k, text in enumerate(texts):
        with open(os.path.join(folder, f"part{k}.csv"), "w", encoding="utf-8") as fh:
            fh.write(text)
    return folder


def types_of(found):
    return {r["column"]: r["type"] for r in found.types.collect()}


@pytest.mark.parametrize("value,want", [
    ("1", {"int", "bigint", "double"}), ("-2147483648", {"int", "bigint", "double"}),
    ("2147483648", {"bigint", "double"}), ("9223372036854775808", {"double"}), ("1.5e3", {"double"}),
    (".5", {"double"}), ("1d", set()), ("NaN", {"double"}), ("nan", set()), ("2024-02-29", {"date"}),
    ("2023-02-29", set()), ("2024-02-29 10:11:12.5", {"timestamp"}), ("TRUE", {"boolean"}), ("yes", set()),
    (" 1", set()), ("", set()), ("٣", set())])
def test_types_of_a_value(spark, value, want):
    bits = spark.createDataFrame([(value,)], "v string").select(mask(F.col("v"))).first()[0]
    assert {t for k, t in enumerate(TYPES) if bits >> k & 1} == want


def test_narrowest_type_merges_like_the_intersection():
    assert narrowest({}, 1.0) == ("string", 0)
    assert narrowest({0b111: 3, 0b110: 1}, 1.0) == ("bigint", 0)
    assert narrowest({0b111: 3, 0b100: 1}, 1.0) == ("double", 0)
    assert narrowest({0b111: 3, 0b001000: 1}, 1.0) == ("string", 0)
    assert narrowest({0b111: 9, 0: 1}, 0.9) == ("int", 1)
    assert narrowest({0: 1}, 0.1) == ("string", 0)


def test_files_agree_on_one_type_and_values_are_kept(spark, tmp_dir):
    path = write(tmp_dir, "a;b.c;d;e\n1;2;x;\n3;4;2024-01-01;\n", 'a;b.c;d;e\n5;2.5;"q;r";\n;;;\n')
    found = infer_delimited(spark, path, sep=";")
    assert types_of(found) == {"a": "int", "b.c": "double", "d": "string", "e": "string"}
    assert found.frame.dtypes == [("a", "int"), ("b.c", "double"), ("d", "string"), ("e", "string")]
    assert sorted(map(tuple, found.frame.collect()), key=repr) == sorted(
        [(1, 2.0, "x", None), (3, 4.0, "2024-01-01", None), (5, 2.5, "q;r", None), (None,) * 4], key=repr)
    assert found.misfits.count() == 0
    counts = {r["column"]: (r["n_values"], r["n_null"]) for r in found.types.collect()}
    assert counts == {"a": (3, 1), "b.c": (3, 1), "d": (3, 1), "e": (0, 4)}


def test_misfits_and_malformed_lines(spark, tmp_dir):
    good = "".join(f"{k},{k}\n" for k in range(20))
    path = write(tmp_dir, "a,b\n" + good + "oops,1\n1,2,3\n7\n")
    strict = infer_delimited(spark, path)
    assert types_of(strict) == {"a": "string", "b": "int"}
    assert sorted(r["line"] for r in strict.misfits.collect()) == ["1,2,3", "7"]
    loose = infer_delimited(spark, path, share=0.9)
    assert types_of(loose) == {"a": "int", "b": "int"}
    assert sorted(map(tuple, loose.misfits.collect()), key=repr) == sorted(
        [("a", "oops", None), (None, None, "1,2,3"), (None, None, "7")], key=repr)
    assert loose.frame.select("b").count() == len(loose.frame.select("b").collect()) == 21
    assert loose.frame.count() == 21 and loose.frame.where("a IS NULL").count() == 1


def test_header_alone_and_bad_share(spark, tmp_dir):
    found = infer_delimited(spark, write(tmp_dir, "a,b\n"))
    assert types_of(found) == {"a": "string", "b": "string"} and found.frame.count() == 0
    with pytest.raises(ValueError):
        infer_delimited(spark, tmp_dir, share=0)


def test_one_exchange_of_counts_only(spark, tmp_dir):
    path = write(tmp_dir, "a,b\n1,2\n")
    plan = infer_delimited(spark, path).frame._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "FileScan csv" in plan
