import collections
import itertools
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from sampwise.llm.packing import hilbert_key, pack
from tests.conftest import SF_SMALL


def check_pieces(rows, docs):
    """Every id lies in one piece, sequences have no gaps, lengths need no padding."""
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    sequences, by_doc = collections.defaultdict(list), collections.defaultdict(list)
    for r in rows:
        sequences[r["sequence_id"]].append((r["offset"], r["length"]))
        by_doc[r["id"]].append(r)
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at and length > 0
            at += length
        assert at == 1024 or at < 1024 and at & (at - 1) == 0
    want = collections.defaultdict(list)
    for i, text in docs:
        want[i].append(tokenizer.encode(text or "", add_special_tokens=False).ids + [0])
    assert set(want) == set(by_doc)
    for i, texts in want.items():
        # pieces of rows that share an id: take them by length of document and start
        got = sorted(by_doc[i], key=lambda r: (r["doc_tokens"], r["start"]))
        assert sum(r["length"] for r in got) == sum(map(len, texts))
        if len(texts) == 1:
            at = 0
            for r in got:
                ids = np.array(texts[0][at:at + r["length"]], "<u4")
                assert r["start"] == at and r["doc_tokens"] == len(texts[0])
                assert r["ids_crc32"] == zlib.crc32(ids.tobytes())
                assert bytes(r["ids"]) == ids.astype("<u2").tobytes()
                at += r["length"]


def test_given_documents(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet")
    check_pieces(pack(docs).collect(), [(r["doc_id"], r["text"]) for r in docs.collect()])


def test_hostile_rows(documents):
    rows, df = documents
    check_pieces(pack(df).collect(), rows)


def test_empty_table(no_documents):
    assert pack(no_documents).collect() == []


def test_hilbert_curve_visits_neighbours():
    """All cells once, each step to an adjacent cell."""
    for dims, bits in ((2, 4), (3, 3)):
        cells = np.array(list(itertools.product(range(1 << bits), repeat=dims)))
        order = np.argsort(hilbert_key(cells, bits))
        assert sorted(hilbert_key(cells, bits)) == list(range(len(cells)))
        assert (np.abs(np.diff(cells[order], axis=0)).sum(axis=1) == 1).all()


def test_similar_documents_are_neighbours(spark):
    """Two vocabularies: neighbours along the packing are mostly of one kind."""
    import random
    rng = random.Random(2)
    kinds = ["alpha beta gamma delta epsilon".split(), "eins zwei drei vier fünf sechs".split()]
    rows = [(i, " ".join(rng.choices(kinds[i % 2], k=60))) for i in range(200)]
    got = pack(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    line = [r["id"] % 2 for r in sorted(got, key=lambda r: (r["sequence_id"], r["offset"]))]
    assert sum(a == b for a, b in zip(line, line[1:])) / (len(line) - 1) > 0.85


def test_very_long_white_space(spark):
    rows = [(1, "a" + " " * 2_000_000 + "b"), (2, "\n" * 1_200_000), (3, "short")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    check_pieces(pack(df).collect(), rows)
