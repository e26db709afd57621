"""Spelling variants by reduced-alphabet neighbourhoods.

1. *Words.*  Runs of letters, lower-cased in A-Z only, counted over all texts.  (A run whose
   ``crc32("<id>:<run>")`` is a multiple of ``NOISE`` first loses one code point: the planted
   misspellings of this operator.)  Tasks count before the shuffle.
2. *Reduced alphabet.*  Every letter is hashed to one of ``SYMBOLS`` symbols.  Words at one edit
   have reduced words that are equal or at one edit.
3. *Neighbourhoods.*  Every word gives its reduced word, all reduced words with one symbol left
   out, and all with one symbol replaced by a higher one; an insertion is the other
   word's deletion and a lower symbol the other word's higher one, so the two neighbourhoods
   of a pair together are the full ones and each pair is met once.
4. *Join.*  An edit leaves one end of the word intact: the first ``HEAD`` letters if it is behind them,
   the last ``TAIL`` otherwise.  A neighbour's key is the hash of its reduced word and of
   the intact end in original letters, and every word offers its reduced word with either
   end.  So frequent reduced words split by original letters.
5. *Verification.*  Candidates stay if the original strings are at exactly one edit.
6. *Forms and roots.*  A word's form is its near word of largest count (ties: the smallest in
   code-point order) if that is at least twice its own.  Counts double along forms, so
   paths end; roots come by doubling the steps of all paths at once.

Defined cases: null and empty texts hold no words; a null id counts as the empty string before the colon;
rows that repeat count each; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sampwise.llm.shared import stored

LETTERS = "[A-Za-zÀ-ÿ]+"
NOISE, LEAST_LETTERS, LEAST_COUNT = 97, 5, 3
SYMBOLS, HEAD, TAIL = 6, 3, 2
#: A task hands on its counts when it holds this many different words.
HELD_WORDS = 500_000
_LOWER = {65 + k: 97 + k for k in range(26)}
_ODD = 0x9E3779B97F4A7C15
_BASE = 0xD6E8FEB86659FD93
_BASE_BACK = pow(_BASE, -1, 1 << 64)


def letter_runs(text: str) -> list[str]:
    return re.findall(LETTERS, text.translate(_LOWER))


def document_words(doc_id: str, text: str) -> tuple[list[str], list[tuple[str, str]]]:
    """The lower-cased runs of a text, and (run, misspelling) of those runs that lose a letter."""
    runs = letter_runs(text)
    start = zlib.crc32(f"{doc_id}:".encode())
    noisy = []
    for run in set(runs):
        h = zlib.crc32(run.encode(), start)
        if h % NOISE == 0:
            k = h % len(run)
            noisy.append((run, run[:k] + run[k + 1:]))
    return runs, noisy


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held: Counter = Counter()

    def counts():
        some = [(w, n) for w, n in held.items() if n and len(w) >= LEAST_LETTERS]
        held.clear()
        return pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in some], pa.string()), pa.array([n for _, n in some], pa.int64())],
            names=["word", "n"])

    for batch in batches:
        for doc_id, text in zip(batch.column("id").to_pylist(), batch.column("text").to_pylist()):
            runs, noisy = document_words(doc_id, text)
            held.update(runs)
            if noisy:
                times = Counter(runs)
                for run, wrong in noisy:
                    held[run] -= times[run]
                    held[wrong] += times[run]
            if len(held) >= HELD_WORDS:
                yield counts()
    if held:
        yield counts()


def word_counts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (word, n): words of at least ``LEAST_LETTERS`` code points that occur ``LEAST_COUNT`` times."""
    rows = docs.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("id"),
                       F.col(text_col).cast("string").alias("text")).where("text IS NOT NULL")
    return (rows.mapInArrow(_count, "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))
            .where(F.col("n") >= LEAST_COUNT))


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * np.uint64(_ODD)
    return x ^ (x >> np.uint64(29))


def _powers(n: int) -> np.ndarray:
    return np.array([pow(_BASE, k, 1 << 64) for k in range(n)], dtype=np.uint64)


def _end(letters: np.ndarray, side: int) -> np.ndarray:
    """A hash of the intact end: the first letters for side 0, the last for side 1."""
    part = letters[:, :HEAD] if side == 0 else letters[:, letters.shape[1] - TAIL:]
    return _mixed((part * _powers(part.shape[1])).sum(axis=1, dtype=np.uint64) + np.uint64(side + 1))


def _keys(reduced: np.ndarray, end: np.ndarray) -> np.ndarray:
    return _mixed(reduced * np.uint64(_ODD) + end)


def offers(letters: np.ndarray) -> list[np.ndarray]:
    """The two keys of each word of one length: its reduced word with either end."""
    symbols = letters % np.uint64(SYMBOLS) + np.uint64(1)
    whole = (symbols * _powers(letters.shape[1])).sum(axis=1, dtype=np.uint64)
    return [_keys(whole, _end(letters, side)) for side in (0, 1)]


def neighbours(letters: np.ndarray) -> list[tuple[np.ndarray, np.ndarray, int]]:
    """(rows, keys, side) of the one-deletion and higher-symbol neighbours of words of one length."""
    n, size = letters.shape
    symbols = letters % np.uint64(SYMBOLS) + np.uint64(1)
    power = _powers(size)
    terms = symbols * power
    before = np.concatenate([np.zeros((n, 1), np.uint64), np.cumsum(terms, axis=1, dtype=np.uint64)], axis=1)
    ups = np.arange(SYMBOLS, dtype=np.uint64)[:, None] * power
    whole, ends, every = before[:, -1], [_end(letters, side) for side in (0, 1)], np.arange(n)
    out = []
    for i in range(size):
        side = 0 if i >= HEAD else 1
        if size > LEAST_LETTERS:
            left_out = before[:, i] + (whole - before[:, i + 1]) * np.uint64(_BASE_BACK)
            # of a run of one symbol leaving out any gives the same: once for each side
            last = i + 1 == size or (i + 1 >= HEAD) != (i >= HEAD)
            rows = every if last else np.flatnonzero(symbols[:, i] != symbols[:, i + 1])
            out.append((rows, _keys(left_out[rows], ends[side][rows]), side))
        for up in range(1, SYMBOLS):
            rows = np.flatnonzero(symbols[:, i] + np.uint64(up) <= SYMBOLS)
            out.append((rows, _keys(whole[rows] + ups[up][i], ends[side][rows]), side))
    return out


_KEY_SQL = "key long, own boolean, head boolean, word string, n long"


def _by_length(batch: pa.RecordBatch):
    """(rows, code points) for each word length of a batch."""
    words = batch.column("word").to_pylist()
    size = np.array([len(w) for w in words])
    for one in np.unique(size):
        rows = np.flatnonzero(size == one)
        text = "".join(words[r] for r in rows).encode("utf-32-le")
        yield rows, np.frombuffer(text, "<u4").reshape(len(rows), one).astype(np.uint64)


def _keyed(with_neighbours: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, len(batch), 2048):
                part = batch.slice(at, 2048)
                rows, keys, own, head = [], [], [], []
                for r, letters in _by_length(part):
                    for side, key in enumerate(offers(letters)):
                        rows.append(r), keys.append(key)
                        own.append(np.ones(len(r), bool)), head.append(np.full(len(r), side == 0))
                    for some, key, side in neighbours(letters) if with_neighbours else ():
                        rows.append(r[some]), keys.append(key)
                        own.append(np.zeros(len(some), bool)), head.append(np.full(len(some), side == 0))
                if rows:
                    take = pa.array(np.concatenate(rows))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(keys).view(np.int64)), pa.array(np.concatenate(own)),
                         pa.array(np.concatenate(head)), part.column("word").take(take),
                         part.column("n").take(take)], names=["key", "own", "head", "word", "n"])
    return run


def near_words(words: DataFrame) -> DataFrame:
    """Rows (a, na, b, nb): every pair of words at exactly one edit, once."""
    asks = words.mapInArrow(_keyed(True), _KEY_SQL).select(
        "key", "own", "head", F.col("word").alias("a"), F.col("n").alias("na"))
    gives = words.mapInArrow(_keyed(False), _KEY_SQL).select(
        "key", F.col("word").alias("b"), F.col("n").alias("nb"))
    # with equal first letters the pair is met at the head, otherwise at the tail
    same_head = F.substring("a", 1, HEAD) == F.substring("b", 1, HEAD)
    once = F.when(F.col("own"), F.col("a") < F.col("b")).otherwise(F.col("a") != F.col("b"))
    return (asks.join(gives, "key").where((F.col("head") == same_head) & once)
            .where(F.levenshtein("a", "b", 1) == 1).select("a", "na", "b", "nb"))


def follow(steps: DataFrame) -> DataFrame:
    """Rows (word, root) for rows (word, root) of single steps: every path followed to its end."""
    while True:
        ahead = steps.select(F.col("word").alias("root"), F.col("root").alias("next"))
        new = stored(steps.join(ahead, "root", "left").select(
            "word", F.coalesce("next", "root").alias("root"), F.col("next").isNotNull().alias("moved")), "spell-steps")
        if new.where("moved").isEmpty():
            return new.select("word", "root")
        steps = new.select("word", "root")


def spelling_variants(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (word, form, root, n, n_near, form_n), one per word."""
    words = stored(word_counts(docs, id_col, text_col), "spell-words")
    pairs = stored(near_words(words), "spell-pairs")
    sides = pairs.select(F.inline(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("nb").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("na").alias("near_n")))))
    best = sides.groupBy("word").agg(F.count(F.lit(1)).alias("n_near"),
                                     F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("best"))
    fits = -F.col("best.less") >= 2 * F.col("n")
    formed = stored(words.join(best, "word", "left").select(
        "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(fits, F.col("best.near")).alias("form"), F.when(fits, -F.col("best.less")).alias("form_n")),
        "spell-forms")
    roots = follow(formed.where("form IS NOT NULL").select("word", F.col("form").alias("root")))
    return formed.join(roots, "word", "left").select(
        "word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
