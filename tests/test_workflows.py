"""The end-to-end jobs over files, and the command line around them."""

from sampwise.__main__ import main
from sampwise.plans import workflows as W
from tests.fixtures import SPECIES, bank_csv_text, iris_csv_text

D1 = "Apache Spark is fast and powerful.\nSpark is used for big data processing.\n"


def write(tmp_dir, name, text):
    path = f"{tmp_dir}/{name}"
    with open(path, "w") as fh:
        fh.write(text)
    return path


def test_words_in_file(spark, tmp_dir):
    got = {r["word"]: r["count"] for r in
           W.words_in_file(spark, write(tmp_dir, "in.txt", D1)).collect()}
    assert got["spark"] == 2 and got["powerful."] == 1 and len(got) == 11


def test_top_fields_in_file(spark, tmp_dir):
    lines = [f"{i},c{i % 3},{i * 2.5},K{i % 4}" for i in range(40)] + ["41,c,1.0,K9"]
    top = W.top_fields_in_file(spark, write(tmp_dir, "orders.txt", "\n".join(lines)), k=3)
    assert [(r["key"], r["count"]) for r in top.collect()] == [("K0", 10), ("K1", 10),
                                                               ("K2", 10)]


def test_sample_file(spark, tmp_dir):
    path = write(tmp_dir, "bank.csv", bank_csv_text(53))
    offset, sample, first = W.sample_file(spark, path, step=5, seed=3)
    expected = len([i for i in range(1, 54) if i % 5 == offset])
    assert sample.count() == expected
    idx = [r["row_index"] for r in first.collect()]
    assert idx == sorted(idx) and all(i % 5 == offset for i in idx)


def test_bank_experiments_file_order(spark, tmp_dir):
    path = write(tmp_dir, "bank2.csv", bank_csv_text(200))
    results, summary = W.bank_experiments(spark, path, "dt", offset_seed=1)
    rows = results.collect()
    assert len(rows) == 5 and all(r["num_samples"] == 40 for r in rows)
    s = summary.first()
    assert s["planned"] == 5 and s["finished"] == 5


def test_iris_parts(spark, tmp_dir):
    path = write(tmp_dir, "iris.csv", iris_csv_text())
    for method in ("systematic", "random"):
        rows = W.iris_parts(spark, path, method=method).orderBy("part").collect()
        assert sum(r["num_samples"] for r in rows) == 150
        assert all(r["accuracy"] is not None for r in rows)


def test_cli(spark, tmp_dir, capsys):
    path = write(tmp_dir, "cli.txt", D1)
    assert main(["words", path, "--show", "50"]) == 0
    out = capsys.readouterr().out
    assert "spark" in out and "processing." in out
    out_dir = f"{tmp_dir}/wc"
    assert main(["words", path, "--out", out_dir]) == 0
    back = spark.read.option("header", True).csv(out_dir)
    assert back.count() == 11
    assert SPECIES  # fixture import used by other tests in this module


def test_cli_other_jobs(spark, tmp_dir, capsys):
    lines = "\n".join(f"{i},c,{i},K{i % 2}" for i in range(10)) + "\n"
    assert main(["top-fields", write(tmp_dir, "o.txt", lines), "--k", "2"]) == 0
    assert "K0" in capsys.readouterr().out
    bank = write(tmp_dir, "b.csv", bank_csv_text(60))
    assert main(["sample", bank, "--seed", "2", "--show", "3"]) == 0
    out = capsys.readouterr().out
    assert "start offset" in out and "row_index" in out
    assert main(["iris", write(tmp_dir, "i.csv", iris_csv_text())]) == 0
    assert "accuracy" in capsys.readouterr().out
    assert main(["experiments", bank, "--model", "dt", "--seed", "4"]) == 0
    out = capsys.readouterr().out
    assert "avg_accuracy" in out and "experiment_id" in out


def test_crlf_and_gzip_text(spark, tmp_dir):
    import gzip

    crlf = write(tmp_dir, "crlf.txt", "1,a,b,K1\r\n2,a,b,K1\r\n3,a,b,K2\r\n")
    got = {r["key"]: r["count"] for r in W.top_fields_in_file(spark, crlf).collect()}
    assert got == {"K1": 2, "K2": 1}  # no '\r' left on the last field
    gz = f"{tmp_dir}/in.txt.gz"
    with gzip.open(gz, "wt") as fh:
        fh.write(D1 * 50)
    counts = {r["word"]: r["count"] for r in W.words_in_file(spark, gz).collect()}
    assert counts["spark"] == 100 and len(counts) == 11
