"""Broadcast bit sets that spare shuffling: rows whose name is surely not wanted need not travel to a join.

A set is at most 2 ** MOST_BITS bits (64 MB), however many names it holds. It only lets rows through that a join decides on
afterwards, so results do not depend on its size; with more than some 10 ** 9 names it spares little.
"""

from __future__ import annotations

import numpy as np
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

LEAST_BITS, MOST_BITS, BITS_A_NAME = 20, 29, 16


def bit_set(names: DataFrame, count: int) -> Broadcast:
    """(bits, set) of `names`: one long column, `name`, of values spread over all bits; count: about how many there are."""
    bits = min(MOST_BITS, max(LEAST_BITS, (BITS_A_NAME * count).bit_length()))
    at = F.shiftrightunsigned("name", 64 - bits)
    blocks = names.select(at.alias("at")).groupBy(F.floor(F.col("at") / 32768).alias("block")).agg(
        F.bitmap_construct_agg(F.col("at") % 32768).alias("bits"))
    out = np.zeros(1 << (bits - 3), np.uint8)
    for row in blocks.toLocalIterator():
        part = np.frombuffer(bytes(row.bits), np.uint8)
        out[row.block * 4096:row.block * 4096 + len(part)] = part
    return names.sparkSession.sparkContext.broadcast((bits, out))


def has(shared: Broadcast, names: np.ndarray) -> np.ndarray:
    """Which of the names (64 bits each) may be in the set."""
    bits, held = shared.value
    at = (names.view(np.uint64) >> np.uint64(64 - bits)).astype(np.int64)
    return (held[at >> 3] >> (at & 7).astype(np.uint8)) & 1 == 1
