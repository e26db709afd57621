"""Exact duplicates by an extendible-hash index in shared files.

1. Every text gets a key: the first ``key_bits`` bits of its SHA-256.
2. The *directory* is grown from per-bucket counts of different keys: it starts at the
   depth the row count asks for and doubles while some bucket holds more than
   ``capacity`` keys; only overfull buckets split.  What reaches the driver is one
   count per bucket, never a key.
3. Copies inside one Arrow batch are combined first, so a text that makes up a third
   of all rows reaches its bucket as a few rows.
4. *Owner tasks* take whole buckets in key order.  Texts of one key are chained and
   told apart by comparing their bytes; each chain entry keeps the largest id and the
   number of rows.  The entries are written as files in the shared folder, which is
   the index; a lost executor costs at most its own bucket tasks.
5. Documents look up their entry by digest and the row with the largest id stays.

Defined cases: null text is the empty text; a null id stays only if all ids of the
group are null; of rows that repeat both id and text one stays; an empty table gives
an empty result; other columns are ignored (or passed through by ``drop_copies``).
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from sampwise.llm.shared import fresh, stored, text_or_empty

KEY_BITS = 60
CAPACITY = 2048


def _key(digest: str, key_bits: int):
    """The first ``key_bits`` (60 at most) bits of a hex digest as a long."""
    whole = F.conv(F.substring(digest, 1, 15), 16, 10).cast("long")
    return F.shiftright(whole, KEY_BITS - key_bits)


class Directory:
    """Slots 0..2^depth-1, by leading key bits; ``bucket_of[slot]`` names the bucket."""

    def __init__(self, depth: int, bucket_of: np.ndarray, local_depth: dict[int, int],
                 key_bits: int):
        self.depth, self.bucket_of, self.local_depth = depth, bucket_of, local_depth
        self.key_bits = key_bits

    def buckets(self, keys: np.ndarray) -> np.ndarray:
        return self.bucket_of[keys >> (self.key_bits - self.depth)]


def grow_directory(keys: DataFrame, key_bits: int, capacity: int) -> Directory:
    """Split buckets until none holds more than ``capacity`` different keys.

    ``keys`` has one row per different key, so a hot key counts once and cannot force
    endless splitting.  Each round counts only the halves of overfull buckets.
    """
    total = keys.count()
    depth = min(key_bits, max(0, math.ceil(math.log2(max(1, total / capacity)))))
    counts = {r["slot"]: r["n"] for r in
              keys.groupBy(F.shiftright("key", key_bits - depth).alias("slot"))
              .agg(F.count("*").alias("n")).collect()}
    leaves = {(slot, depth): counts.get(slot, 0) for slot in range(1 << depth)}
    while True:
        over = [leaf for leaf, n in leaves.items() if n > capacity and leaf[1] < key_bits]
        if not over:
            break
        at = over[0][1]  # all overfull leaves are of the newest depth
        slots = [slot for slot, _ in over]
        halves = {r["slot"]: r["n"] for r in
                  keys.where(F.shiftright("key", key_bits - at).isin(slots))
                  .groupBy(F.shiftright("key", key_bits - at - 1).alias("slot"))
                  .agg(F.count("*").alias("n")).collect()}
        for slot in slots:
            del leaves[slot, at]
            for half in (2 * slot, 2 * slot + 1):
                leaves[half, at + 1] = halves.get(half, 0)
    depth = max(d for _, d in leaves)
    bucket_of, local = np.zeros(1 << depth, dtype=np.int32), {}
    for bucket, (slot, d) in enumerate(sorted(leaves, key=lambda x: x[0] << (depth - x[1]))):
        bucket_of[slot << (depth - d): (slot + 1) << (depth - d)] = bucket
        local[bucket] = d
    return Directory(depth, bucket_of, local, key_bits)


class _Entry:
    __slots__ = ("text", "sha", "keep", "n")

    def __init__(self, text, sha, keep, n):
        self.text, self.sha, self.keep, self.n = text, sha, keep, n

    def add(self, keep, n):
        self.n += n
        if keep is not None and (self.keep is None or keep > self.keep):
            self.keep = keep


def _chain(entries: list, text: bytes, sha: str, keep, n) -> None:
    """Join the entry with the same bytes, or append a new one."""
    for e in entries:
        if e.text == text:
            return e.add(keep, n)
    entries.append(_Entry(text, sha, keep, n))


_COMBINED = pa.schema([("bucket", pa.int32()), ("key", pa.int64()), ("sha", pa.string()),
                       ("text", pa.binary()), ("keep", pa.int64()), ("n", pa.int64())])
_ENTRIES = pa.schema([("bucket", pa.int32()), ("key", pa.int64()), ("chain", pa.int32()),
                      ("sha", pa.string()), ("keep_id", pa.int64()), ("group_size", pa.int64())])


def _combine(directory: Directory):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            chains: dict[int, list] = {}
            keys = batch.column("key").to_pylist()
            texts = batch.column("text").cast(pa.binary()).to_pylist()
            for key, text, sha, i in zip(keys, texts, batch.column("sha").to_pylist(),
                                         batch.column("id").to_pylist()):
                _chain(chains.setdefault(key, []), text, sha, i, 1)
            flat = [(k, e) for k, entries in chains.items() for e in entries]
            ks = np.array([k for k, _ in flat], dtype=np.int64)
            yield pa.RecordBatch.from_arrays(
                [pa.array(directory.buckets(ks)), pa.array(ks),
                 pa.array([e.sha for _, e in flat], pa.string()),
                 pa.array([e.text for _, e in flat], pa.binary()),
                 pa.array([e.keep for _, e in flat], pa.int64()),
                 pa.array([e.n for _, e in flat], pa.int64())], schema=_COMBINED)
    return run


def _own(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows come in (bucket, key) order; only the chain of one key is held."""
    at, chain = None, []

    def rows(out):
        return pa.RecordBatch.from_pylist(out, schema=_ENTRIES)

    def flush():
        return [{"bucket": at[0], "key": at[1], "chain": pos, "sha": e.sha, "keep_id": e.keep,
                 "group_size": e.n} for pos, e in enumerate(chain)]

    for batch in batches:
        out = []
        for b, k, sha, text, keep, n in zip(*(batch.column(c).to_pylist() for c in _COMBINED.names)):
            if (b, k) != at:
                out += flush() if chain else []
                at, chain = (b, k), []
            _chain(chain, text, sha, keep, n)
        if out:
            yield rows(out)
    if chain:
        yield rows(flush())


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                key_bits: int = KEY_BITS, capacity: int = CAPACITY) -> tuple[DataFrame, Directory]:
    """The index files (bucket, key, chain, sha, keep_id, group_size) and their directory."""
    rows = (docs.select(F.col(id_col).cast("long").alias("id"), text_or_empty(text_col).alias("text"))
            .withColumn("sha", F.sha2("text", 256)).withColumn("key", _key("sha", key_bits)))
    keys = stored(rows.select("key").distinct(), "exact-keys")
    directory = grow_directory(keys, key_bits, capacity)
    combined = rows.select("id", "text", "sha", "key").mapInArrow(
        _combine(directory), "bucket int, key long, sha string, text binary, keep long, n long")
    entries = (combined.repartition("bucket").sortWithinPartitions("bucket", "key")
               .mapInArrow(_own, "bucket int, key long, chain int, sha string, "
                                 "keep_id long, group_size long"))
    return stored(entries, "exact-index"), directory


def find_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                key_bits: int = KEY_BITS, capacity: int = CAPACITY) -> DataFrame:
    """Rows (id, keep_id, group_size, kept, text_sha256), one per input row."""
    index, _ = build_index(docs, id_col, text_col, key_bits, capacity)
    rows = (docs.select(F.col(id_col).cast("long").alias("id"),
                        F.sha2(text_or_empty(text_col), 256).alias("sha"))
            .groupBy("id", "sha").agg(F.count("*").cast("int").alias("times")))
    found = rows.join(index.select("sha", "keep_id", "group_size"), "sha")
    return (found.select("*", F.posexplode(F.array_repeat(F.lit(0), F.col("times"))).alias("pos", "_"))
            .select("id", "keep_id", "group_size",
                    (F.col("id").eqNullSafe(F.col("keep_id")) & (F.col("pos") == 0)).alias("kept"),
                    F.col("sha").alias("text_sha256")))


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` without the copies, columns unchanged."""
    sha, keep_id, keep_sha = fresh(docs, "doc_sha", "keep_id", "keep_sha")
    kept = (find_copies(docs, id_col, text_col).where("kept")
            .select(F.col("id").alias(keep_id), F.col("text_sha256").alias(keep_sha)))
    keyed = docs.withColumn(sha, F.sha2(text_or_empty(text_col), 256))
    match = keyed[id_col].cast("long").eqNullSafe(kept[keep_id]) & (keyed[sha] == kept[keep_sha])
    return keyed.join(kept, match, "left_semi").dropDuplicates([id_col, sha]).drop(sha)
