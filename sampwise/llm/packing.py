"""Packing documents into fixed-length sequences along a space-filling curve.

1. A document becomes token ids (a public byte-level BPE vocabulary) plus an end id.
2. Its hashed bag of tokens is projected to ``DIMS`` dimensions; the point's cell on a
   Hilbert curve is its key, so similar documents get close keys.
3. Documents are range-sorted by (key, id, digest of the ids): neighbours on the curve
   are neighbours in a task.  A hot key (many copies) is spread by id over tasks.
4. Every task lays its documents end to end and cuts the stream every ``length`` ids.
   What remains at a task's end is cut into sequences of power-of-two lengths, which
   need no padding: the packing has no padding at all.

The token table is written to the shared folder once (two bytes an id), so that the
range sort samples and sorts files and never tokenizes twice.

Defined cases: null text is empty and consists of the end id only; a null id sorts
first; rows that repeat are packed as often as they occur; documents longer than a
sequence are cut freely; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import base64
import re
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampwise.llm.shared import shuffle_width, stored, text_or_empty

DIMS, BITS = 3, 10
HASHED = 4096
SPECIAL = "<|endoftext|>"
#: Longer runs of white space overflow the fast coder's stack.
LONG_SPACE = 100_000

_CODERS: dict = {}


def _coders(vocabulary: str, ranks: str):
    """The tokenizer of ``vocabulary`` and a faster coder of the same vocabulary, once a worker."""
    if (vocabulary, ranks) not in _CODERS:
        import public_tokenizers
        import tiktoken
        from tokenizers import Tokenizer

        path = public_tokenizers.path(ranks)
        with open(path, "rb") as lines:
            merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
        fast = tiktoken.Encoding("ranks", pat_str=public_tokenizers.PATTERN,
                                 mergeable_ranks=merges, special_tokens={})
        _CODERS[vocabulary, ranks] = (
            Tokenizer.from_file(public_tokenizers.path(vocabulary)), fast)
    return _CODERS[vocabulary, ranks]


def token_ids(text: str, vocabulary: str, ranks: str) -> list[int]:
    """Ids of a text.  The rank file codes ordinary text to the same ids, several times
    as fast; a text that holds the special token's string or a very long run of white space
    goes to the tokenizer itself."""
    exact, fast = _coders(vocabulary, ranks)
    if SPECIAL in text or _long_space(text):
        return exact.encode(text, add_special_tokens=False).ids
    return fast.encode_ordinary(text)


def _long_space(text: str) -> bool:
    return len(text) >= LONG_SPACE and any(
        m.end() - m.start() >= LONG_SPACE for m in re.finditer(r"\s+", text))


def projection(seed: int = 7) -> np.ndarray:
    """A fixed random map from hashed tokens to ``DIMS`` dimensions."""
    return np.random.default_rng(seed).normal(size=(HASHED, DIMS)).astype(np.float32)


def hilbert_key(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Position on the Hilbert curve of each row of non-negative cells (n, dims).

    The cells' bits are untangled from the top bit down (reflect and exchange axes),
    Gray-decoded, and interleaved.
    """
    x = cells.astype(np.int64).T.copy()
    dims = len(x)
    level = 1 << (bits - 1)
    while level > 1:
        low = level - 1
        for axis in range(dims):
            high = (x[axis] & level) > 0
            swap = np.where(high, 0, (x[0] ^ x[axis]) & low)
            x[0] = np.where(high, x[0] ^ low, x[0] ^ swap)
            x[axis] ^= swap
        level >>= 1
    for axis in range(1, dims):
        x[axis] ^= x[axis - 1]
    flip = np.zeros_like(x[0])
    level = 1 << (bits - 1)
    while level > 1:
        flip = np.where((x[dims - 1] & level) > 0, flip ^ (level - 1), flip)
        level >>= 1
    x ^= flip
    key = np.zeros_like(x[0])
    for bit in range(bits - 1, -1, -1):
        for axis in range(dims):
            key = key << 1 | (x[axis] >> bit & 1)
    return key


def _tokenize(vocabulary: str, ranks: str, end_id: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = projection()
        spread = (np.arange(1 << 16, dtype=np.uint32) * np.uint32(2654435761)) >> np.uint32(20)
        for batch in batches:
            coded, points = [], np.zeros((batch.num_rows, DIMS), dtype=np.float32)
            for i, text in enumerate(batch.column("text").to_pylist()):
                ids = np.array(token_ids(text, vocabulary, ranks) + [end_id], dtype="<u2")
                coded.append(ids.tobytes())
                counts = np.bincount(spread[ids], minlength=HASHED)
                # square roots keep a few very frequent tokens from ruling the direction
                vector = np.sqrt(counts, dtype=np.float32)
                points[i] = (vector / np.linalg.norm(vector)) @ table
            cells = np.clip((points + 3) / 6 * (1 << BITS), 0, (1 << BITS) - 1)
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), pa.array(hilbert_key(cells)), pa.array(coded, pa.binary())],
                names=["id", "key", "ids"])
    return run


_PIECES = pa.schema([("id", pa.int64()), ("start", pa.int64()), ("length", pa.int64()),
                     ("ids_crc32", pa.int64()), ("doc_tokens", pa.int64()),
                     ("sequence_id", pa.int64()), ("offset", pa.int64()), ("ids", pa.binary())])
_PIECES_SQL = ("id long, start long, length long, ids_crc32 long, doc_tokens long, "
               "sequence_id long, offset long, ids binary")


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """One open sequence is held back: only the task's last one needs another cut."""
        sequence = TaskContext.get().partitionId() << 40
        held, filled = [], 0

        def emit(pieces, offset, number):
            out = []
            for i, start, ids, tokens in pieces:
                out.append((i, start, len(ids), zlib.crc32(ids.astype("<u4").tobytes()), tokens,
                            number, offset, ids.tobytes()))
                offset += len(ids)
            return out

        def batch_of(rows):
            return pa.RecordBatch.from_arrays(
                [pa.array(c, f.type) for c, f in zip(zip(*rows), _PIECES)], schema=_PIECES)

        for batch in batches:
            rows = []
            for i, blob in zip(batch.column("id").to_pylist(), batch.column("ids").to_pylist()):
                ids, at = np.frombuffer(blob, dtype="<u2"), 0
                while at < len(ids):
                    part = ids[at:at + length - filled]
                    held.append((i, at, part, len(ids)))
                    at, filled = at + len(part), filled + len(part)
                    if filled == length:
                        rows += emit(held, 0, sequence)
                        sequence, held, filled = sequence + 1, [], 0
            if rows:
                yield batch_of(rows)
        # the rest: one sequence for each power of two in its size
        rows = []
        while filled:
            size = 1 << (filled.bit_length() - 1)
            now, room = [], size
            while room:
                i, start, ids, tokens = held.pop(0)
                now.append((i, start, ids[:room], tokens))
                if len(ids) > room:
                    held.insert(0, (i, start + room, ids[room:], tokens))
                room -= len(now[-1][2])
            rows += emit(now, 0, sequence)
            sequence, filled = sequence + 1, filled - size
        if rows:
            yield batch_of(rows)
    return run


def tokenized(docs: DataFrame, vocabulary: str = "byte_bpe_50k.json",
              ranks: str = "byte_bpe_50k.tiktoken", end_id: int = 0,
              id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, key, ids): curve key and 16-bit ids with the end id.  No shuffle."""
    return (docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
            .mapInArrow(_tokenize(vocabulary, ranks, end_id), "id long, key long, ids binary"))


def pack(docs: DataFrame, length: int = 1024, **options) -> DataFrame:
    """Rows (id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids), one per piece."""
    tokens = stored(tokenized(docs, **options), "packing-tokens")
    along = (tokens.withColumn("tie", F.xxhash64("ids"))
             .repartitionByRange(shuffle_width(docs.sparkSession), "key", "id", "tie")
             .sortWithinPartitions("key", "id", "tie").select("id", "ids"))
    return along.mapInArrow(_cut(length), _PIECES_SQL)
