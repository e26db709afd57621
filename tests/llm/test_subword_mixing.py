import numpy as np
import pytest
from pyspark.sql import functions as F

from sampwise.llm import mixing
from sampwise.llm.queries import op1_quality_classifier, op2_source_mixing, quality_model
from sampwise.llm import subword
from sampwise.llm.subword import PIECE, SubwordModel, bucket_counts, fit, train
from tests.conftest import SF_SMALL

SF = "/root/testdata/sf0.01"


def plain_logits(model, text):
    """The class scores as the mean of the table rows of all features, one by one."""
    idx, counts = bucket_counts(text)
    if not len(idx):
        return model.bias
    return (model.table[idx] * counts[:, None]).sum(axis=0) / counts.sum() + model.bias


def test_batches_equal_single_texts():
    rng = np.random.default_rng(3)
    model = SubwordModel(np.hstack([np.zeros((1 << 16, 1)), rng.normal(size=(1 << 16, 2))]), np.zeros(3))
    texts = [b"", b"  ", b"a", b"one two two", "é ü 漢字".encode(), b"x" * 50, b"The The The end.",
             b" ".join(b"w%d" % (i % 313) for i in range(PIECE // 3))]
    logits, n = model.logits(texts)
    assert n.tolist() == [len(t.split()) for t in texts]
    for row, text in zip(logits, texts):
        assert np.allclose(row, plain_logits(model, text), atol=1e-4)


def test_pieces_lose_no_feature(monkeypatch):
    """Small pieces give the features of the whole text; long words are cut from their start."""
    monkeypatch.setattr(subword, "LONGEST_WORD", 9)
    rng = np.random.default_rng(8)
    texts = [b"", b"   ", b" " * 300 + b"a", b"a" + b"\n" * 300 + b"b c", b"abcdefghijk" * 30]
    for _ in range(60):
        words = [bytes(rng.choice(list(b"abc"), rng.integers(1, 16)).tolist()) for _ in range(rng.integers(60))]
        texts.append(b"".join(w + bytes(rng.choice(list(b" \n\t"), rng.integers(1, 30)).tolist()) for w in words))
    whole = [bucket_counts(t) for t in texts]
    model = SubwordModel(np.hstack([np.zeros((1 << 16, 1)), rng.normal(size=(1 << 16, 1))]), np.zeros(2))
    logits, n = model.logits(texts)
    cut = bytearray()
    for k, b in enumerate(texts[4]):
        cut += (b" " if k and k % 9 == 0 else b"") + bytes([b])
    assert np.array_equal(whole[4][0], bucket_counts(bytes(cut))[0])
    monkeypatch.setattr(subword, "PIECE", 24)
    for (idx, counts), text in zip(whole, texts):
        got = bucket_counts(text)
        assert np.array_equal(idx, got[0]) and np.array_equal(counts, got[1])
    again, n_again = model.logits(texts)
    assert np.allclose(logits, again, atol=1e-6) and np.array_equal(n, n_again)


def test_labels_without_documents_do_not_use_up_the_sample(spark):
    docs = spark.createDataFrame([(k, f"text {k % 2} of {k}") for k in range(20)], "doc_id long, text string")
    few = spark.createDataFrame([(k, k % 2) for k in range(20)], "doc_id long, quality int")
    many = spark.createDataFrame([(k, k % 2) for k in range(500)], "doc_id long, quality int")
    one, two = (train(docs, labels, F.col("quality"), 2, max_train=20) for labels in (few, many))
    assert np.array_equal(one.table, two.table) and one.table.any()


def test_held_out_accuracy(spark):
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    rows = (op1_quality_classifier(spark, SF).where("held_out").join(labels, "doc_id")
            .select("predicted", "quality", "score").collect())
    assert len(rows) > 50
    assert np.mean([r["predicted"] == r["quality"] for r in rows]) >= 0.95
    assert all(0 <= r["score"] <= 1 for r in rows)


def test_hostile_rows(documents, labels):
    rows, df = documents
    got = quality_model(df, labels).score(df).collect()
    assert len(got) == len(rows)
    assert all(abs(sum(r["p"]) - 1) < 1e-9 for r in got)
    empty = {tuple(r["p"]) for r in got if r["n_words"] == 0}
    assert len(empty) == 1


def test_no_labels_and_no_rows(spark, documents, no_documents, labels):
    df = documents[1]
    model = train(df, labels.limit(0), F.col("quality"), 2)
    assert {tuple(r["p"]) for r in model.score(df).collect() if r["n_words"] == 0} == {(0.5, 0.5)}
    assert model.score(no_documents).collect() == []


def test_repeated_ids_give_one_model_in_any_layout(spark):
    rows = [(k % 30, f"good words {k} here" if k % 2 else f"bad text {k * k} there") for k in range(120)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(k, k % 2) for k in range(30)], "doc_id long, quality int")
    one, two = (train(d, labels, F.col("quality"), 2) for d in
                (docs.coalesce(1), docs.orderBy(F.desc("text")).repartition(7)))
    assert np.array_equal(one.table, two.table) and np.array_equal(one.bias, two.bias)


def test_fit_is_repeatable():
    rows = [(*bucket_counts(b"good fine text %d" % i), 1) for i in range(20)]
    rows += [(*bucket_counts(b"junk junk %d" % i), 0) for i in range(20)]
    a, b = fit(rows, 2), fit(rows, 2)
    assert np.array_equal(a.table, b.table)
    p, _ = a.probabilities([b"good fine words", b"junk junk junk"])
    assert p[0, 1] > 0.8 > 0.2 > p[1, 1]


def brute_rates(p, tokens, shares, steps=4000):
    """Projected gradient on the same objective with small plain steps, all rows at once."""
    total = np.array(shares) / sum(shares) * tokens.sum()
    gram = np.linalg.pinv((p * tokens[:, None]).T @ p)
    r = np.ones(len(p))
    for _ in range(steps):
        miss = (p * (tokens * r)[:, None]).sum(axis=0) - total
        r = np.maximum(0, r - p @ (gram @ miss))
    return r, (p * (tokens * r)[:, None]).sum(axis=0), total


def test_rates_meet_targets_like_brute_force(spark):
    rows = op2_source_mixing(spark, SF_SMALL).collect()
    p = np.array([[r["p_low_quality"], r["p_clean"], r["p_toxic"]] for r in rows])
    tokens, rate = np.array([r["n_words"] for r in rows], float), np.array([r["rate"] for r in rows])
    _, reached, target = brute_rates(p, tokens, (0.02, 0.96, 0.02))
    got = (p * (tokens * rate)[:, None]).sum(axis=0)
    assert (rate >= 0).all()
    ours, theirs = np.abs(got - target).sum(), np.abs(reached - target).sum()
    assert ours <= theirs + 1e-4 * target.sum()
    assert all(r["copies"] in (int(r["rate"]), int(r["rate"]) + 1) for r in rows)


@pytest.mark.parametrize("shares", [(0.5, 0.5), (0.0, 1.0)])
def test_mix_keeps_columns_and_takes_effect(spark, documents, labels, shares):
    df = documents[1]
    label = F.when(F.col("toxic").isin(0, 1), F.col("toxic"))
    out = mixing.mix(df, labels, shares, label)
    assert out.columns == df.columns
    assert out.count() >= 1


def test_mix_of_nothing(no_documents, labels):
    label = F.when(F.col("toxic").isin(0, 1), F.col("toxic"))
    assert mixing.mix(no_documents, labels, (0.9, 0.1), label).collect() == []
    assert mixing.mixing_rates(no_documents, labels, (0.1, 0.8, 0.1)).collect() == []


def _rates(spark, rows, keep):
    df = spark.createDataFrame(rows, "p array<double>, n_words long")
    steps = mixing.fit_rates(df, (0.97, 0.03), keep=keep)
    rate = mixing.rate_of(F.col("p"), F.col("n_words"), steps, keep=keep)
    return np.array([r[0] for r in df.select(rate).collect()])


def test_anchored_rows_stay_once_and_the_others_shrink(spark):
    rows = [([0.999, 0.001], 100)] * 60 + [([0.3, 0.7], 50)] * 4 + [([0.05, 0.95], 200)] * 9
    p, n = np.array([r[0] for r in rows]), np.array([r[1] for r in rows])
    assert (_rates(spark, rows, None)[:60] != 1).all()
    rate = _rates(spark, rows, 0)
    got = (p * (n * rate)[:, None]).sum(axis=0)
    assert (rate[:60] == 1).all() and (rate >= 0).all()
    assert got[1] / got.sum() == pytest.approx(0.03, abs=1e-5) and got.sum() < n.sum()


def test_shares_out_of_reach_give_the_nearest(spark, caplog):
    rows = [([0.9, 0.1], 100)] * 60 + [([0.1, 0.9], 100)] * 9
    with caplog.at_level("WARNING"):
        rate = _rates(spark, rows, 0)
    assert (rate[:60] == 1).all() and np.allclose(rate[60:], 0)
    assert "wanted" in caplog.text


def test_rare_others_grow(spark):
    rows = [([1.0, 0.0], 1000)] * 60 + [([0.0, 1.0], 100)] * 3
    rate = _rates(spark, rows, 0)
    assert (rate[:60] == 1).all() and rate[60:] * 300 == pytest.approx(np.full(3, 60_000 * 3 / 97), rel=1e-4)
