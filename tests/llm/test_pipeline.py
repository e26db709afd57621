"""Every stage on hostile rows, and the whole pipeline against the operators' brute forces."""

import collections

import pytest

import corpus_pipeline as pipeline
from tests.conftest import SF_SMALL
from tests.llm.test_near import brute_classes
from tests.llm.test_packing import check_pieces


@pytest.mark.parametrize("k", range(4))
def test_stages_keep_the_columns(spark, documents, no_documents, k):
    for df in (documents[1], no_documents):
        out = pipeline.STAGES[k][1](spark, df, SF_SMALL)
        assert out.columns == df.columns
        assert out.count() <= 10 * len(documents[0])


def test_last_stage_on_hostile_rows(spark, documents, no_documents):
    assert pipeline.pack(spark, documents[1], SF_SMALL).count() >= len(documents[0])
    assert pipeline.pack(spark, no_documents, SF_SMALL).collect() == []


def test_stages_on_the_given_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{SF_SMALL}/labels.parquet").collect()}
    rows = {r["doc_id"]: r["text"] for r in docs.collect()}
    good = {r["doc_id"]: r["text"] for r in pipeline.quality(spark, docs, SF_SMALL).collect()}
    judged = [(i in good) == (labels[i]["quality"] == 1) for i in rows if i in labels]
    assert sum(judged) >= 0.95 * len(judged)

    apart = pipeline.exact_dedup(spark, docs, SF_SMALL)
    last = collections.defaultdict(int)
    for i, t in rows.items():
        last[t] = max(last[t], i)
    assert {r["doc_id"] for r in apart.collect()} == set(last.values())

    one = pipeline.near_dedup(spark, docs, SF_SMALL)
    stay = {i for i, _, _, kept in brute_classes(sorted(rows.items())) if kept}
    assert {r["doc_id"] for r in one.collect()} == stay

    mixed = pipeline.source_mixing(spark, docs, SF_SMALL)
    times = collections.Counter(r["doc_id"] for r in mixed.collect())
    clean = [i for i, r in labels.items() if i in rows and not r["toxic"] and r["quality"] == 1]
    assert sum(times[i] >= 1 for i in clean) >= 0.97 * len(clean)
    assert sum(times.values()) <= 1.1 * len(rows)


def test_run(spark):
    rows = pipeline.run(spark, SF_SMALL).withColumnRenamed("doc_id", "id").collect()
    text = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    whole = collections.defaultdict(int)
    for r in rows:
        whole[r["id"]] += r["length"]
        assert r["doc_tokens"] > 0
    tokens = {r["id"]: r["doc_tokens"] for r in rows}
    assert all(whole[i] % tokens[i] == 0 for i in whole) and set(whole) <= set(text)
    copies = [(i, text[i]) for i in whole for _ in range(whole[i] // tokens[i])]
    check_pieces(rows, copies)


def test_mixing_meets_its_shares_on_the_labels(spark, caplog):
    sf = "/root/testdata/sf0.01"
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    labels = {r["doc_id"]: r for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    size = {r["doc_id"]: len((r["text"] or "").split()) for r in docs.collect()}
    with caplog.at_level("INFO"):
        mixed = pipeline.source_mixing(spark, docs, sf)
    times = collections.Counter(r["doc_id"] for r in mixed.collect())
    clean = [i for i, r in labels.items() if i in size and not r["toxic"] and r["quality"] == 1]
    toxic = [i for i, r in labels.items() if i in size and r["toxic"]]
    assert sum(times[i] >= 1 for i in clean) >= 0.97 * len(clean)
    assert sum(size[i] * n for i, n in times.items()) <= 1.1 * sum(size.values())
    assert sum(times[i] for i in toxic) <= 0.6 * len(toxic)
    assert "wanted [0.97, 0.03]" in caplog.text


def test_finished_stages_leave_no_files(spark):
    import glob
    from sampwise.session import checkpoint_dir
    folder = checkpoint_dir(spark).removeprefix("file:")
    before = set(glob.glob(f"{folder}/*"))
    rows = pipeline.run(spark, SF_SMALL)
    left = set(glob.glob(f"{folder}/*")) - before
    assert len(left) == 1 and "pipeline-4" in left.pop() and rows.count() > 0
