"""A bitmap that tells which rows can't belong to a set of keys.

It is a one-hash Bloom filter of some sixteen bits a key, between ``BITS`` and ``MOST`` (32 MB): the cluster
ors the bits of all keys together, at most one number per 64 bits reaches the driver, and rows whose bit
is unset are known to be strangers. Rows that pass still need an exact join; beyond ``MOST`` the filter
passes more, and the result stays the same.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS, MOST = 1 << 22, 1 << 28


@dataclass(frozen=True)
class BitFilter:
    """The bitmap, broadcast; keys are hashed by ``xxhash64`` on the cluster."""

    table: Broadcast
    bits: int

    def passes(self, hashes: np.ndarray) -> np.ndarray:
        """Whether each hashed key may be in the set; for use inside a task."""
        spots = np.mod(hashes, self.bits)
        return (self.table.value[spots >> 6] >> np.mod(hashes, 64).astype(np.uint64)) & np.uint64(1) == 1


def bit_filter(keys: DataFrame, column: str) -> BitFilter:
    bits = min(max(BITS, 1 << (16 * keys.count()).bit_length()), MOST)
    key = F.xxhash64(F.col(column))
    bit = F.expr(f"shiftleft(1L, cast(pmod(xxhash64(`{column}`), 64) as int))")
    words = (
        keys.select(F.shiftright(F.pmod(key, F.lit(bits)), 6).cast("int").alias("word"), bit.alias("bit"))
        .groupBy("word")
        .agg(F.bit_or("bit").alias("bits"))
    )
    table = np.zeros(bits // 64, np.uint64)
    for line in words.toLocalIterator():
        table[line.word] = np.int64(line.bits).astype(np.uint64)
    return BitFilter(keys.sparkSession.sparkContext.broadcast(table), bits)
