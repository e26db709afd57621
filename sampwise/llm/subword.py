"""Supervised subword embeddings: a text classifier trained by stochastic gradient descent.

Features of a text are its words, its pairs of neighbouring words (a pair of equal words
is one feature whatever the word), and its character 3- and 4-grams inside words (with
one border space), hashed to ``2**BITS`` buckets.  Every bucket has a learned vector; a
document is the average of its features' vectors, and a softmax layer on the average
gives class probabilities.  Vectors and layer are trained together in numpy.

Because the layer is linear in the average, a trained model is applied through one
table of per-bucket class scores: the mean of a document's table rows equals the layer
applied to its mean vector.  Texts are read whole, in pieces of ``PIECE`` bytes cut at
white space, so that memory does not depend on a text's length; a piece repeats the last
word before it as context, so no feature is lost at a cut.  A run of more than
``LONGEST_WORD`` bytes without white space counts as several words, cut every
``LONGEST_WORD`` bytes from its start.

Training reads at most ``max_train`` labelled rows whose document is there, those with the
smallest hash of their id, so the sample does not depend on the layout of the tables.

Defined cases: null and empty texts have no features and get the probabilities of the
bias alone; labels that are null, or that contradict each other for one id, are not
used; with no usable label every class is equally likely; rows that repeat are scored
one by one, but an id trains once, on the text with the least (hash, text); other columns
are ignored, whatever their names.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, LongType, StructField

from sampwise.llm.shared import extend, text_or_empty

BITS = 16
PIECE = 1 << 20
LONGEST_WORD = 1 << 16
MAX_TRAIN = 2400
_SPACE = 32
_FIRST = 0  # the pair bucket of a text's first word
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = np.uint64(1_000_003)


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=np.uint64)
    out[0] = 1
    return np.cumprod(out, dtype=np.uint64)


def _hash32(grams: np.ndarray, odd: int) -> np.ndarray:
    return (grams * np.uint32(odd)) >> np.uint32(32 - BITS)


def word_hashes(buf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """A 64-bit hash of every word of a buffer that begins and ends with a space; word starts."""
    solid = buf != _SPACE
    starts = np.flatnonzero(solid[1:] & ~solid[:-1]) + 1
    ends = np.flatnonzero(solid[:-1] & ~solid[1:]) + 1
    total = np.zeros(len(buf) + 1, dtype=np.uint64)
    np.cumsum(buf * _powers(int(_BASE), len(buf)), out=total[1:])
    inverse = _powers(pow(int(_BASE), -1, 1 << 64), len(buf))
    words = (total[ends] - total[starts]) * inverse[starts]
    return words ^ (words >> np.uint64(29)), starts


def _features(buf: np.ndarray) -> tuple[np.ndarray, ...]:
    """Buckets of 3-grams and 4-grams by position (2**BITS: none), of words and pairs; word starts.

    ``buf`` begins and ends with a space; white space has been made spaces.
    """
    none = 1 << BITS
    solid = buf != _SPACE
    wide = buf.astype(np.uint32)
    g3 = wide[:-2] | wide[1:-1] << np.uint32(8) | wide[2:] << np.uint32(16)
    f3, f4 = np.full(len(buf), none, dtype=np.uint32), np.full(len(buf), none, dtype=np.uint32)
    f3[:-2] = np.where(solid[1:-1], _hash32(g3, 2654435761), none)
    f4[:-3] = np.where(solid[1:-2] & solid[2:-1],
                       _hash32(g3[:-1] | wide[3:] << np.uint32(24), 2246822519), none)
    words, starts = word_hashes(buf)
    pairs = np.zeros_like(words)  # of each word with the one before
    pairs[1:] = np.where(words[1:] == words[:-1], np.uint64(1), words[1:] * _BASE + words[:-1])
    shift = np.uint64(64 - BITS)
    return (f3, f4, ((words * _ODD) >> shift).astype(np.uint32),
            ((pairs * _ODD + _ODD) >> shift).astype(np.uint32), starts)


def _with_short_words(text: bytes) -> bytes:
    """``text`` with a space after every ``LONGEST_WORD`` bytes of a longer word."""
    if len(text) <= LONGEST_WORD:
        return text
    edges = np.flatnonzero(np.diff(np.frombuffer(text, dtype=np.uint8) > _SPACE, prepend=False, append=False))
    cuts = [c for start, end in edges.reshape(-1, 2) if end - start > LONGEST_WORD
            for c in range(start + LONGEST_WORD, end, LONGEST_WORD)]
    return b" ".join(text[x:y] for x, y in zip([0, *cuts], [*cuts, len(text)])) if cuts else text


def _last_word(part: bytes) -> bytes:
    """The last word and a space; nothing where there is no word."""
    solid = np.flatnonzero(np.frombuffer(part, dtype=np.uint8) > _SPACE)
    if not len(solid):
        return b""
    gaps = np.flatnonzero(np.diff(solid) > 1)
    return part[solid[gaps[-1] + 1] if len(gaps) else solid[0]:solid[-1] + 1] + b" "


def _pieces(texts: list[bytes]) -> Iterator[tuple[np.ndarray, ...]]:
    """(buffer, document numbers, their starts in it, bytes of context that each begins with);
    long texts come in several pieces, cut before white space."""
    parts, owners, context, held = [], [], [], 0

    def flush():
        starts = np.cumsum([0] + [len(p) + 1 for p in parts[:-1]])
        buf = np.frombuffer(b" " + b" ".join(parts) + b" ", dtype=np.uint8).copy()
        buf[buf <= _SPACE] = _SPACE
        return buf, np.array(owners), starts, np.array(context)

    for i, text in enumerate(map(_with_short_words, texts)):
        at, before = 0, b""
        while at < len(text):
            end = min(len(text), at + PIECE)
            if end < len(text):  # words are shorter than pieces, so there is white space
                near = np.frombuffer(text, np.uint8, LONGEST_WORD + 1, end - LONGEST_WORD)
                end += int(np.flatnonzero(near <= _SPACE)[-1]) - LONGEST_WORD
            parts.append(before + text[at:end])
            owners.append(i)
            context.append(len(before))
            held += end - at
            if end < len(text):
                before = _last_word(parts[-1]) or before
            at = end
            if held >= PIECE:
                yield flush()
                parts, owners, context, held = [], [], [], 0
    if parts:
        yield flush()


def _document_features(buf: np.ndarray, starts: np.ndarray, context: np.ndarray) -> tuple[np.ndarray, ...]:
    """Buckets of 3-grams and 4-grams by position, of words and of pairs by word, and the words'
    place among ``starts``.  What lies in the context has no bucket and no place (-1)."""
    none = 1 << BITS
    f3, f4, words, pairs, at = _features(buf)
    place = np.searchsorted(starts, at, side="right") - 1
    first = np.flatnonzero(np.diff(place, prepend=-1))
    pairs[first] = _FIRST  # never a pair across texts
    for k in np.flatnonzero(context):
        f3[starts[k]:starts[k] + context[k]] = none
        f4[starts[k]:starts[k] + context[k]] = none
    known = first[context[place[first]] > 0]
    words[known], pairs[known], place[known] = none, none, -1
    return f3, f4, words, pairs, place


def bucket_counts(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The different buckets of one text and how often each occurs."""
    counts = np.zeros((1 << BITS) + 1, dtype=np.int64)
    for buf, _, starts, context in _pieces([text]):
        for f in _document_features(buf, starts, context)[:4]:
            counts += np.bincount(f, minlength=len(counts))
    idx = np.flatnonzero(counts[:-1])
    return idx.astype(np.uint32), counts[idx].astype(np.float32)


class SubwordModel:
    """Per-bucket class scores (2**BITS + 1 rows, the last zero) and the bias."""

    def __init__(self, table: np.ndarray, bias: np.ndarray):
        self.table = np.vstack([table, np.zeros((1, table.shape[1]))]).astype(np.float32)
        self.bias = bias

    def logits(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """Class logits and word counts of each text."""
        k = len(self.bias)
        sums, seen = np.zeros((len(texts), k)), np.zeros(len(texts))
        n_words = np.zeros(len(texts), dtype=np.int64)
        # only differences to the first class matter: its column is zero
        for buf, owner, starts, context in _pieces(texts):
            f3, f4, words, pairs, place = _document_features(buf, starts, context)
            words, pairs, doc_of_word = (x[place >= 0] for x in (words, pairs, place))
            word_n = np.bincount(doc_of_word, minlength=len(owner))
            total = 2.0 * word_n
            for f in (f3, f4):
                total += np.add.reduceat(f != 1 << BITS, starts, dtype=np.int64)
            for c in range(1, k):
                column = np.ascontiguousarray(self.table[:, c])
                got = np.bincount(doc_of_word, weights=column[words] + column[pairs],
                                  minlength=len(owner)).astype(float)  # no words: whole numbers
                for f in (f3, f4):
                    got += np.add.reduceat(column[f], starts, dtype=np.float64)
                np.add.at(sums[:, c], owner, got)
            np.add.at(seen, owner, total)
            np.add.at(n_words, owner, word_n)
        return sums / np.maximum(seen, 1)[:, None] + self.bias, n_words

    def probabilities(self, texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        z, n_words = self.logits(texts)
        e = np.exp(z - z.max(axis=1, keepdims=True))
        return e / e.sum(axis=1, keepdims=True), n_words

    def score(self, docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
        """Rows (id, p array<double>, n_words), one per input row, without a shuffle."""
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                p, n = self.probabilities(batch.column("text").cast(pa.binary()).to_pylist())
                yield pa.RecordBatch.from_arrays(
                    [batch.column("id"), pa.array(list(p), pa.list_(pa.float64())), pa.array(n)],
                    names=["id", "p", "n_words"])
        return (docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
                .mapInArrow(run, "id long, p array<double>, n_words long"))

    def annotate(self, docs: DataFrame, text_col: str, p_name: str, n_name: str) -> DataFrame:
        """``docs`` with the probabilities and the word count in two more columns."""
        def compute(column: pa.Array) -> list[pa.Array]:
            p, n = self.probabilities(column.cast(pa.binary()).to_pylist())
            return [pa.array(list(p), pa.list_(pa.float64())), pa.array(n)]
        return extend(docs, text_or_empty(text_col), [StructField(p_name, ArrayType(DoubleType())),
                                                      StructField(n_name, LongType())], compute)


_SAMPLE = pa.schema([("id", pa.int64()), ("y", pa.int32()), ("idx", pa.binary()),
                     ("counts", pa.binary())])


def fit(rows: list[tuple[np.ndarray, np.ndarray, int]], n_classes: int, dim: int = 8,
        epochs: int = 6, rate: float = 2.0, seed: int = 1) -> SubwordModel:
    """SGD over (buckets, counts, class) rows, one row at a time, the rate falling to zero."""
    rng = np.random.default_rng(seed)
    vectors = rng.uniform(-1 / dim, 1 / dim, (1 << BITS, dim)).astype(np.float32)
    layer = rng.normal(0, 0.3, (dim, n_classes)).astype(np.float32)
    bias = np.zeros(n_classes, dtype=np.float32)
    step, steps = 0, max(1, epochs * len(rows))
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            idx, counts, y = rows[i]
            eta = rate * (1 - step / steps)
            step += 1
            if not len(idx):
                continue
            share = counts / counts.sum()
            mean = share @ vectors[idx]
            z = mean @ layer + bias
            p = np.exp(z - z.max())
            p /= p.sum()
            p[y] -= 1
            # a feature's step is scaled up from its share: shares are tiny in long texts
            vectors[idx] -= eta * np.outer(np.minimum(share * 50, 1), layer @ p)
            layer -= 0.1 * eta * np.outer(mean, p)
            bias -= 0.02 * eta * p
    table = vectors @ layer
    return SubwordModel(table - table[:, :1], bias - bias[0])


def train(docs: DataFrame, labels: DataFrame, label: Column, n_classes: int,
          where: Column | None = None, id_col: str = "doc_id", text_col: str = "text",
          max_train: int = MAX_TRAIN, **options) -> SubwordModel:
    """Fit on at most ``max_train`` rows of ``docs`` whose id has one label in ``labels``.

    ``label`` gives the class 0..n_classes-1 of a row of ``labels`` (null: none);
    ``where`` restricts the usable rows.  An id with several texts counts once.  The
    features are made by tasks; the driver gets the bucket counts of the sample only.
    """
    usable = labels.select(F.col(id_col).cast("long").alias("id"), label.cast("int").alias("y"),
                           (F.lit(True) if where is None else where).alias("w"))
    one = (usable.where("w AND y IS NOT NULL AND id IS NOT NULL").groupBy("id")
           .agg(F.min("y").alias("y"), F.max("y").alias("other")).where("y = other"))
    here = docs.select(F.col(id_col).cast("long").alias("id")).distinct()
    sample = (one.join(here, "id", "left_semi").orderBy(F.xxhash64("id"), "id").limit(max_train)
              .select("id", "y"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, y, text in zip(batch.column("id").to_pylist(), batch.column("y").to_pylist(),
                                  batch.column("text").cast(pa.binary()).to_pylist()):
                idx, counts = bucket_counts(text)
                yield pa.RecordBatch.from_pylist(
                    [{"id": i, "y": y, "idx": idx.tobytes(), "counts": counts.tobytes()}],
                    schema=_SAMPLE)

    texts = (docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
             .join(F.broadcast(sample), "id").groupBy("id", "y")
             .agg(F.min(F.struct(F.xxhash64("text").alias("hash"), "text")).alias("least"))
             .select("id", "y", "least.text"))
    got = texts.mapInArrow(run, "id long, y int, idx binary, counts binary").collect()
    rows = [(np.frombuffer(r["idx"], np.uint32), np.frombuffer(r["counts"], np.float32), r["y"])
            for r in sorted(got, key=lambda r: r["id"])]
    return fit(rows, n_classes, **options)
