import pytest
from pyspark.sql import functions as F

from sampwise.operators.counts import (count_by, field_count, head, row_counts, top_k,
                                       word_count)
from sampwise.sources.text import read_lines

# Two lines of the studied word-count input (fixture D1).
D1 = ["Apache Spark is fast and powerful.", "Spark is used for big data processing."]


def lines(spark, values):
    return spark.createDataFrame([(v,) for v in values], "value string")


def as_dict(df, key, val="count"):
    return {r[key]: r[val] for r in df.collect()}


def test_word_count_golden(spark):
    got = as_dict(word_count(lines(spark, D1)), "word")
    assert got == {"apache": 1, "spark": 2, "is": 2, "fast": 1, "and": 1, "powerful.": 1,
                   "used": 1, "for": 1, "big": 1, "data": 1, "processing.": 1}
    assert sum(got.values()) == 13


def test_word_count_whitespace_like_python_split(spark):
    odd = ["", "   ", "  lead trail  ", "tab\tsep", "nb\u00a0sp", "em\u2003sp",
           "sep\x1cfile", "line\u2028sep", "next\x85line", "zero\u200bwidth",
           "ideo\u3000sp", None]
    got = as_dict(word_count(lines(spark, odd), lower=False), "word")
    expected = {}
    for line in odd:
        for w in (line or "").split():
            expected[w] = expected.get(w, 0) + 1
    assert got == expected


def test_word_count_case_folding(spark):
    got = as_dict(word_count(lines(spark, ["Spark SPARK spark"])), "word")
    assert got == {"spark": 3}


def test_read_lines_then_count(spark, tmp_dir):
    path = f"{tmp_dir}/input.txt"
    with open(path, "w") as fh:
        fh.write("\n".join(D1) + "\n")
    got = as_dict(word_count(read_lines(spark, path)), "word")
    assert got["spark"] == 2 and len(got) == 11


def test_dotted_names(spark):
    df = spark.createDataFrame([("a", 2), ("b", 1), ("a", 3)], "k string, n int").toDF("the.key", "the.n")
    assert count_by(df, "the.key").orderBy("count").collect()[1]["the.key"] == "a"
    assert top_k(df, 1, "the.n").first()["the.n"] == 3
    assert head(df, 1, "the.n").first()["the.n"] == 1


# Order lines (fixture D2): 12 keys in field 4, a tie at the 10th place.
def order_rows():
    rows, n = [], 0
    counts = {"k01": 9, "k02": 8, "k03": 7, "k04": 6, "k05": 5, "k06": 4, "k07": 4,
              "k08": 3, "k09": 3, "k10": 2, "k11": 2, "k12": 1}
    for key, c in counts.items():
        for _ in range(c):
            n += 1
            rows.append(f"{n},cust{n % 7},{n * 1.5},{key},x")
    return rows, counts


def test_field_count_top10_ties(spark):
    rows, counts = order_rows()
    got = top_k(field_count(lines(spark, rows), ",", 3), 10, "count", tie_break="key").collect()
    assert [(r["key"], r["count"]) for r in got] == sorted(
        counts.items(), key=lambda kv: (-kv[1], kv[0]))[:10]
    assert got[-1]["key"] == "k10"  # k10 and k11 tie at 2; the key breaks the tie


def test_field_count_short_line(spark):
    rows = ["1,a,b,KEY", "2,a"]
    with pytest.raises(Exception, match="fewer than 4 fields"):
        field_count(lines(spark, rows), ",", 3).collect()
    got = as_dict(field_count(lines(spark, rows), ",", 3, on_missing="null"), "key")
    assert got == {"KEY": 1, None: 1}


def test_field_count_regex_separator_is_literal(spark):
    got = as_dict(field_count(lines(spark, ["a|b|c|d", "a|b|c|d"]), "|", 3), "key")
    assert got == {"d": 2}


def test_count_by_and_top_k_plan_is_take_ordered(spark):
    df = spark.range(1000).select((F.col("id") % 17).alias("k"))
    top = top_k(count_by(df, "k"), 3, "count", tie_break="k")
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan
    assert [r["k"] for r in top.collect()] == [0, 1, 2]


def test_row_counts(spark):
    got = as_dict(row_counts({"a": spark.range(5), "b": spark.range(0)}), "table_name",
                  "row_count")
    assert got == {"a": 5, "b": 0}


def test_head_ordered(spark):
    got = head(spark.range(20).repartition(4), 5, "id").collect()
    assert [r.id for r in got] == [0, 1, 2, 3, 4]
