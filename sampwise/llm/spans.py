"""Substring duplicates by sliding sentence spans.

A text is cut into sentences after ``.``, ``!`` or ``?`` before white space, and after
line ends.  A *span* starts and one ends at every sentence: the shortest run of at least
``MIN_SENTENCES`` consecutive sentences that has at least ``MIN_WORDS`` words.  A
sentence of at least ``LONG_SENTENCE`` words is a span by itself, too.  The
extent of a span depends on its own content only, so a passage that many documents
share has the same spans in each, wherever it stands.  Together they cover every longer
run: where the span that starts at a sentence leaves the run, the one that ends with the
run contains the sentence.

Every span is hashed to 128 bits (words only, lower case) and the spans of all documents meet in
one global aggregation that finds, per repeated hash, its first place (smallest
document key, then position).  Sentences covered by any other occurrence are removed;
the rest of the text stays byte for byte.

The aggregation combines map-side and only spans that repeat are joined back, on the
hash, so a span that a third of all documents share is a few partial rows and an
ordinary skewed join, which adaptive execution splits.

Defined cases: null and empty texts and texts shorter than a span are left as they
are (null becomes empty); repeats inside one text count like those between texts;
rows that repeat both id and text are one document and are cut alike; null ids come
first; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampwise.llm.near import _mixed, groups
from sampwise.llm.shared import stored, text_or_empty
from sampwise.llm.subword import word_hashes

MIN_SENTENCES, MIN_WORDS = 2, 16
LONG_SENTENCE = 50  # words that make one sentence a span
# Two odd bases; a span's code has 64 bits from each.
_ODD, _ODD2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xD6E8FEB86659FD93)
LEAST = -(1 << 63)  # where a null id is placed
_STOPS = np.zeros(256, dtype=bool)
_STOPS[[ord(c) for c in ".!?"]] = True


def sentence_starts(text: bytes) -> np.ndarray:
    """Byte offsets at which sentences start; white space between belongs to the one before."""
    buf = np.frombuffer(b" " + text + b" ", dtype=np.uint8)
    blank = buf <= 32
    starts = np.flatnonzero(~blank[1:] & blank[:-1]) + 1  # word starts in buf
    if not len(starts):
        return np.zeros(0, dtype=np.int64)
    ends = np.flatnonzero(~blank[:-1] & blank[1:])  # last bytes of words
    stop = _STOPS[buf[ends]]
    lines = np.concatenate([[0], np.cumsum(buf == 10)])
    newline = lines[starts[1:]] > lines[ends[:-1] + 1]
    first = np.concatenate([[True], stop[:-1] | newline])
    out = starts[first] - 1
    out[0] = 0  # leading white space belongs to the first sentence
    return out


def spans(texts: list[bytes], min_sentences: int = MIN_SENTENCES, min_words: int = MIN_WORDS,
          long_sentence: int = LONG_SENTENCE):
    """(text number, first sentence, sentences covered, two hashes) of every span of the texts."""
    buf = np.frombuffer(b" " + b" ".join(texts) + b" ", dtype=np.uint8).copy()
    low = np.where((buf >= 65) & (buf <= 90), buf + 32, buf)
    low[low <= 32] = 32
    text_at = np.cumsum([0] + [len(t) + 1 for t in texts[:-1]])
    words, at = word_hashes(low)
    if not len(words):
        return tuple(np.zeros(0, dtype=np.int64) for _ in range(3)) + tuple(
            np.zeros(0, dtype=np.uint64) for _ in range(2))
    words = _mixed(words)
    heads = [sentence_starts(t) for t in texts]
    count = np.array([len(h) for h in heads])
    # the first word of every sentence, and the sentence of the next text as a border
    place = np.concatenate([h + text_at[i] + 1 for i, h in enumerate(heads)])
    first_word = np.searchsorted(at, place, side="left")
    owner = np.repeat(np.arange(len(texts)), count)
    number = np.arange(len(owner)) - np.repeat(np.cumsum(count) - count, count)
    border = np.append(first_word, len(words))  # words before sentence s
    here = np.arange(len(owner))
    # the least end e (a sentence index) with enough sentences and enough words
    end = np.maximum(here + min_sentences, np.searchsorted(border, first_word + min_words, side="left"))
    last = np.cumsum(count)[owner]  # one past the text's last sentence
    fits = end <= last
    # the greatest begin of a run that ends with sentence s; runs found forward are not repeated
    back = np.minimum(here + 1 - min_sentences,
                      np.searchsorted(border, border[1:] - min_words, side="right") - 1)
    other = back >= (np.cumsum(count) - count)[owner]
    other[other] = end[back[other]] != here[other] + 1
    alone = here[np.diff(border) >= long_sentence]
    head = np.concatenate([here[fits], back[other], alone])
    tail = np.concatenate([end[fits], here[other] + 1, alone + 1])
    begin, stop = border[head], border[tail]
    return (owner[head], number[head], tail - head, _run_hash(words, begin, stop, _ODD),
            _run_hash(_mixed(words ^ _ODD2), begin, stop, _ODD2))


def _run_hash(words: np.ndarray, begin: np.ndarray, stop: np.ndarray, base: np.uint64) -> np.ndarray:
    """An order-dependent 64-bit hash of every ``words[begin:stop]``, from running sums."""
    one = np.uint64(1)
    powers = np.cumprod(np.append(one, np.full(len(words), base, dtype=np.uint64)), dtype=np.uint64)
    inverse = np.cumprod(np.append(one, np.full(len(words), pow(int(base), -1, 1 << 64), dtype=np.uint64)),
                         dtype=np.uint64)
    total = np.append(np.uint64(0), np.cumsum(words * powers[:-1], dtype=np.uint64))
    code = (total[stop] - total[begin]) * inverse[begin]
    return _mixed(code ^ _mixed((stop - begin).astype(np.uint64)))


def _emit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts = batch.column("text").cast(pa.binary()).to_pylist()
        keys, rows = batch.column("key").to_numpy(), batch.column("row").to_numpy()
        for at, end in groups(texts):
            doc, first, n, code, code2 = spans(texts[at:end])
            if len(doc):
                yield pa.RecordBatch.from_arrays(
                    [pa.array(code.view(np.int64)), pa.array(code2.view(np.int64)),
                     pa.array(keys[at:end][doc]), pa.array(rows[at:end][doc]),
                     pa.array(first.astype(np.int32)), pa.array(n.astype(np.int32))],
                    names=["code", "code2", "key", "row", "first", "n"])


def _remove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        texts, gone = batch.column("text").cast(pa.binary()).to_pylist(), batch.column("gone").to_pylist()
        out, sentences, removed = [], [], []
        for text, ranges in zip(texts, gone):
            starts = sentence_starts(text)
            drop = np.zeros(len(starts) + 1, dtype=np.int32)
            for r in ranges or ():
                drop[r["first"]] += 1
                drop[r["first"] + r["n"]] -= 1
            drop = np.cumsum(drop[:-1]) > 0
            if drop.any():
                cuts = np.append(starts, len(text)).tolist()
                text = b"".join(text[cuts[k]:cuts[k + 1]] for k in np.flatnonzero(~drop))
            out.append(text)
            sentences.append(len(starts))
            removed.append(int(drop.sum()))
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), pa.array(out, pa.binary()).cast(pa.string()), pa.array(sentences, pa.int32()),
             pa.array(removed, pa.int32())], names=["id", "text", "n_sentences", "n_removed"])


def remove_repeated_spans(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, text, n_sentences, n_removed), one per input row; text without repeats."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
    rows = (rows.withColumn("key", F.coalesce("id", F.lit(LEAST)))
            .withColumn("row", F.xxhash64("id", "text")))
    found = stored(rows.select("key", "row", "text")
                   .mapInArrow(_emit, "code long, code2 long, key long, row long, first int, n int"), "spans-all")
    place = F.struct("key", "row", "first")
    repeated = stored(found.groupBy("code", "code2").agg(F.min(place).alias("keep"), F.max(place).alias("last"))
                      .where("keep <> last").select("code", "code2", "keep"), "spans-repeated")
    covered = (found.join(repeated, ["code", "code2"]).where(place != F.col("keep"))
               .groupBy("key", "row").agg(F.collect_set(F.struct("first", "n")).alias("gone")))
    return (rows.join(stored(covered, "spans-covered"), ["key", "row"], "left")
            .select("id", "text", "gone")
            .mapInArrow(_remove, "id long, text string, n_sentences int, n_removed int"))
