"""Seeded, layout-independent pseudo-random numbers derived from a key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

from .columns import col as col_of

# u = first 8 hex digits of md5('<seed>|<key>') read as an
# unsigned 32-bit integer, divided by 2^32.  Any SQL engine with md5 can
# reproduce it, so a split is checkable outside Spark.
HASH_HEX_DIGITS = 8
HASH_SCALE = 4294967296.0


def uniform(key: str | Column | Sequence[str | Column], seed: int | Column, *,
            hash_fn: str = "md5") -> Column:
    """A double in [0, 1) that depends only on (seed, key), not on partitioning.

    ``seed`` may be a column, so one pass can evaluate several seeded splits.
    ``hash_fn="md5"`` (default) can be reproduced by any SQL engine;
    ``"xxhash64"`` is about ten times cheaper per row but only Spark computes it.
    """
    keys = [key] if isinstance(key, (str, Column)) else list(key)
    if hash_fn == "xxhash64":
        raw = [col_of(k) if isinstance(k, str) else k for k in keys]
        seed_col = seed.cast("long") if isinstance(seed, Column) else F.lit(int(seed))
        word = F.xxhash64(seed_col, *raw).bitwiseAND(F.lit(0xFFFFFFFF))
        return word / F.lit(HASH_SCALE)
    if hash_fn != "md5":
        raise ValueError("hash_fn must be 'md5' or 'xxhash64'")
    cols = [(col_of(k) if isinstance(k, str) else k).cast("string") for k in keys]
    seed_col = seed.cast("string") if isinstance(seed, Column) else F.lit(str(int(seed)))
    digest = F.md5(F.concat_ws("|", seed_col, *cols))
    word = F.conv(F.substring(digest, 1, HASH_HEX_DIGITS), 16, 10).cast("long")
    return word / F.lit(HASH_SCALE)


def bucket_of(u: Column, weights: Sequence[float]) -> Column:
    """Index of the first cumulative weight above ``u`` (weights normalised)."""
    bounds = cumulative_bounds(weights)
    expr = F.lit(len(bounds) - 1)
    for i in range(len(bounds) - 2, -1, -1):
        expr = F.when(u < F.lit(bounds[i]), F.lit(i)).otherwise(expr)
    return expr


def cumulative_bounds(weights: Sequence[float]) -> list[float]:
    ws = [float(w) for w in weights]
    if not ws or any(w < 0 for w in ws) or sum(ws) <= 0:
        raise ValueError("weights must be non-negative with a positive sum")
    total = sum(ws)
    out, acc = [], 0.0
    for w in ws:
        acc += w
        out.append(acc / total)
    out[-1] = 1.0
    return out
