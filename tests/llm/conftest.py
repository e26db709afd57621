"""Small hostile tables for the training-data operators."""

import pytest

#: Extra columns whose names clash with the operators' own.
CLASHES = ("id", "key", "sha", "keep", "n", "row", "item", "bands", "p", "rate", "rank", "label", "gone",
           "code", "near_item", "near_text", "doc_sha", "keep_id", "mix_p", "mix_words", "quality_p",
           "sequence_id", "offset", "score", "lane", "block", "host", "path", "turns", "segments")


def with_clashes(df):
    from pyspark.sql import functions as F

    for c in CLASHES:
        if c not in df.columns:
            df = df.withColumn(c, F.lit(f"clash {c}"))
    return df.withColumn("a.b", F.lit(1))


@pytest.fixture(scope="session")
def documents(spark):
    """(rows, DataFrame): nulls, empties, ties, repeats, a long text, unusual characters."""
    words = [f"word{i}" for i in range(40)]
    base = " ".join(words)
    near = " ".join(["other"] + words[1:])
    long = " ".join(f"tok{i % 977} is here." for i in range(60_000))
    rows = [(1, base), (2, base), (3, near), (4, None), (5, ""), (6, "  \n\t "), (7, "é ü 漢字 🙂 x"),
            (8, long), (8, long), (9, "one"), (10, "one"), (None, base), (None, None), (11, "a b c d e"),
            (12, "<|endoftext|> tail"), (13, base.upper()), (9, "nine has a second text")]
    df = spark.createDataFrame([(i, t, None if i == 3 else "en", None, None if t is None else len(t))
                                for i, t in rows],
                               "doc_id long, text string, lang string, source string, n_chars long")
    return rows, with_clashes(df)


@pytest.fixture(scope="session")
def no_documents(spark, documents):
    return documents[1].limit(0)


@pytest.fixture(scope="session")
def labels(spark):
    rows = [(i, i % 2, 0) for i in range(1, 12)] + [(1, 0, 1), (None, 1, 0), (2, None, None)]
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")
