import collections
import random
import re

from sampwise.llm.spans import remove_repeated_spans
from tests.conftest import SF_SMALL

GAP = "[\x00-\x20]"
SENTENCE = re.compile(f"{GAP}*[^\x00-\x20].*?(?:(?<=[.!?]){GAP}+|{GAP}*\n{GAP}*|\\Z)", re.S)
LOWER = {c: c + 32 for c in range(65, 91)}


def check(df, rows):
    want = all_runs(rows)
    got = remove_repeated_spans(df).collect()
    assert sorted(((r["id"], r["text"], r["n_removed"]) for r in got), key=repr) == sorted(
        ((i, *want[i, t or ""]) for i, t in rows), key=repr)


def test_given_documents(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    check(df, [(r["doc_id"], r["text"]) for r in df.collect()])


def test_shared_passage(spark):
    passage = ("The first of the shared sentences has ten words in it. The second of the shared sentences is "
               "longer than the first one was. A third one follows here. And the fourth one ends the passage "
               "that many documents carry.")
    rows = [(k, f"Document {k} opens in its own way. {passage} Document {k} closes alone.") for k in range(6)]
    rows += [(10, "Nothing here is shared with anybody else. It stays. Truly it does stay as it is, whole."),
             (11, passage + " " + passage), (12, passage), (13, "Of it. Of it. Of it."), (14, None), (15, "")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check(df, rows)
    out = {r["id"]: r["text"] for r in remove_repeated_spans(df).collect()}
    assert sum(t.count("A third one follows here.") for t in out.values()) == 1
    assert out[0] == rows[0][1] and out[10] == rows[6][1] and out[13] == rows[9][1]
    assert out[3] == "Document 3 opens in its own way. Document 3 closes alone."


def test_hostile_rows(documents):
    rows, df = documents
    short = [(i, t) for i, t in rows if not t or len(t) < 10_000]
    from pyspark.sql import functions as F
    check(df.where(F.coalesce(F.length("text"), F.lit(0)) < 10_000), short)
    assert remove_repeated_spans(df).count() == len(rows)


def test_empty_table(no_documents):
    assert remove_repeated_spans(no_documents).collect() == []


def all_runs(rows, words=16, alone=50):
    """Text and removed sentences per distinct row, in the order of (id, null first), from every run
    of at least two sentences and ``words`` words, and every sentence of ``alone`` words."""
    docs = sorted({(i, t or "") for i, t in rows}, key=lambda x: (x[0] is not None, x[0] or 0))
    cut = {d: [m.group(0) for m in SENTENCE.finditer(d[1])] for d in docs}
    places = collections.defaultdict(list)
    for d in docs:
        each = [tuple(s.translate(LOWER).split()) for s in cut[d]]
        for k in range(len(each)):
            for end in range(k + 1, len(each) + 1):
                n = sum(map(len, each[k:end]))
                if n >= (alone if end == k + 1 else words):
                    places[tuple(each[k:end])].append((d, k, end))
    gone = collections.defaultdict(set)
    for seen in places.values():
        for d, k, end in seen[1:]:
            gone[d] |= set(range(k, end))
    return {d: ("".join(s for k, s in enumerate(cut[d]) if k not in gone[d]) if gone[d] else d[1], len(gone[d]))
            for d in docs}


def check_all_runs(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    out = {(r["id"], t): r["text"] for r in remove_repeated_spans(df).collect()
           for t in [dict(rows)[r["id"]]]}
    assert out == {d: text for d, (text, _) in all_runs(rows).items()}
    return {i: t for (i, _), t in out.items()}


def test_one_long_sentence(spark):
    """A text of one sentence, and a long passage without stops between different neighbours."""
    alone = " ".join(f"word{k}" for k in range(50))
    short = " ".join(f"term{k}" for k in range(49))
    rows = [(1, alone), (2, alone.upper()), (3, short), (4, short),
            (5, f"It opens so.\n{alone}\nIt goes on."), (6, f"Another opening! {alone}.\nAnd another end."),
            (7, f"Here is a third one.\n{alone}.\nIt ends."), (8, f"{alone}\n{alone}")]
    out = check_all_runs(spark, rows)
    assert out[1] == alone and out[2] == "" and out[8] == "" and out[3] == out[4] == short
    assert out[5] == "It opens so.\nIt goes on." and out[7] == "Here is a third one.\nIt ends."
    assert out[6] == rows[5][1]  # the first with a stop after the last word


def test_end_of_a_shared_passage(spark):
    """The span from the 20-word sentence stops before the last one, the next needs foreign words."""
    passage = " ".join(f"{w}{k}" + "." * (k == n - 1) for w, n in (("a", 20), ("b", 8), ("c", 5)) for k in range(n))
    rows = [(k, f"Own opening {k} of this text. {passage} Then text {k} goes its own way. And ends {k}.")
            for k in range(4)]
    out = check_all_runs(spark, rows)
    assert out[0] == rows[0][1] and all("c0" not in out[k] for k in (1, 2, 3))


def test_all_runs_of_random_texts(spark):
    rng = random.Random(3)
    pool = [" ".join(f"s{k}w{j}" for j in range(rng.choice([1, 2, 5, 9, 17, 30, 49, 50, 70]))) + rng.choice(".!?\n")
            for k in range(40)]
    rows = []
    for i in range(60):
        text = []
        while len(text) < 20:
            at = rng.randrange(len(pool))
            text += pool[at:at + rng.randrange(1, 6)] + [f"own{i}x{len(text)}."] * rng.randrange(2)
        rows.append((i, " ".join(text)))
    check_all_runs(spark, rows)


def test_all_runs_of_the_given_documents(spark):
    df = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    rows = [(r["doc_id"], r["text"]) for r in df.collect()]
    out = {(r["id"], dict(rows)[r["id"]] or ""): r["text"] for r in remove_repeated_spans(df).collect()}
    assert out == {d: text for d, (text, _) in all_runs(rows).items()}
