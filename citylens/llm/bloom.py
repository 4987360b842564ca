"""Blocked Bloom filter: one 64-bit block per key, ``PROBES`` bits inside the block.

Built by Spark (a ``bit_or`` per block, combined map-side) and probed with
numpy inside tasks.  The number of blocks is fixed by a parameter, so what is
broadcast has a proven bound; more keys than it was planned for only raise the
share of false positives, which an exact join behind the filter removes.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

PROBES = 4


def _mask(h: Column) -> Column:
    """OR of PROBES bits chosen by the low 6-bit groups of the hash."""
    mask = F.lit(0).cast("bigint")
    for i in range(PROBES):
        bit = F.shiftrightunsigned(h, 6 * i).bitwiseAND(F.lit(63)).cast("int")
        mask = mask.bitwiseOR(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit))
    return mask


def build(keys: DataFrame, hash_col: str, log2_blocks: int = 20) -> np.ndarray:
    """Filter over the 64-bit hashes in ``hash_col``: at most ``2**log2_blocks`` words (8 MB at 20)."""
    h = F.col(hash_col)
    words = (keys.where(h.isNotNull())
             .select(F.shiftrightunsigned(h, 64 - log2_blocks).alias("b"), _mask(h).alias("m"))
             .groupBy("b").agg(F.bit_or("m").alias("m")))
    blocks = np.zeros(1 << log2_blocks, dtype=np.uint64)
    for batch in _arrow(words):
        blocks[batch.column("b").to_numpy()] = batch.column("m").to_numpy().view(np.uint64)
    return blocks


def _arrow(df: DataFrame):
    """At most one small row per block reaches the driver (bounded by the filter's size)."""
    return df.toArrow().to_batches()


def might_contain(blocks: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Boolean array: False means surely absent."""
    h = hashes.astype(np.int64, copy=False).view(np.uint64)
    log2_blocks = np.uint64(int(blocks.size).bit_length() - 1)
    mask = np.zeros(h.shape, dtype=np.uint64)
    for i in range(PROBES):
        mask |= np.uint64(1) << ((h >> np.uint64(6 * i)) & np.uint64(63))
    return (blocks[(h >> (np.uint64(64) - log2_blocks)).astype(np.int64)] & mask) == mask
