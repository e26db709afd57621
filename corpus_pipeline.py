"""The corpus pipeline: quality, exact copies, near copies, mixing, packing.

Every stage takes (spark, docs, sf_dir) and returns a DataFrame; ``run`` writes each
stage's rows as Parquet in the shared folder and reads them back as the next stage's
documents; a stage's own files go when its rows are written, and its input with them.  All
stages but the last return the columns of ``documents``.

Defined cases: null and empty texts have the quality of the model's bias, are equal to each other (the
largest id stays), similar to no other text, mixed in once, and packed as the end id alone; a
null id has no label; rows that repeat are copies; without labelled rows every text has the same
quality and rates are 1; an empty table gives empty results; extra columns pass through every stage but the last.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from sampwise.llm import exact, mixing, near, packing
from sampwise.llm.queries import QUALITY_THRESHOLD, quality_model
from sampwise.llm.shared import delete, fresh, new_folder, read, scratch

#: Target shares of tokens for (clean, toxic) documents.
MIX_SHARES = (0.97, 0.03)


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the quality classifier accepts.  The model learns from the labelled
    rows of this stage's own documents."""
    p, n = fresh(docs, "quality_p", "quality_words")
    scored = quality_model(docs, read(spark, sf_dir, "labels")).annotate(docs, "text", p, n)
    return scored.where(F.get(p, F.lit(1)) >= QUALITY_THRESHOLD).drop(p, n)


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts, the row with the largest doc_id."""
    return exact.drop_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of near duplicates, the row with the smallest doc_id."""
    return near.drop_near(docs)


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Rows repeated so that clean and toxic texts meet their shares of the tokens; clean texts stand
    in the mix once, so the toxic ones are what changes."""
    label = F.when(F.col("toxic").isin(0, 1), F.col("toxic"))
    return mixing.mix(docs, read(spark, sf_dir, "labels"), MIX_SHARES, label, keep=0)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Sequences of 1024 token ids: one row per piece of a document, with its ids."""
    return packing.pack(docs).withColumnRenamed("id", "doc_id")


STAGES = [("quality classifier", quality), ("exact dedup", exact_dedup), ("near dedup", near_dedup),
          ("source mixing", source_mixing), ("packing", pack)]

#: The classifier, the mixing rates and the token ids have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, before = read(spark, sf_dir, "documents"), None
    for k, (_, stage) in enumerate(STAGES):
        path = new_folder(spark, f"pipeline-{k}")
        with scratch(spark):
            rows = stage(spark, docs, sf_dir)
            rows.write.parquet(path)
        docs = spark.read.schema(rows.schema).parquet(path)
        if before is not None:
            delete(spark, before)
        before = path
    return docs
