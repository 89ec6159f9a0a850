"""Bitmaps of bounded size that say which keys may matter.

A bitmap only spares work: a key that is in is always kept, one that is out is nearly always dropped, and an exact join
decides afterwards. Its size follows the number of keys up to ``MAX_BITS``; beyond that it drops less.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, functions as F

MAX_BITS = 1 << 27  # 16 MB
_MIN_BITS = 1 << 16


def size_for(keys: int) -> int:
    return min(MAX_BITS, max(_MIN_BITS, 1 << (16 * max(1, keys) - 1).bit_length()))


def bitmap(frame: DataFrame, key: Column, bits: int) -> np.ndarray:
    """The bits at the lowest bits of ``key``, a well-mixed long. What reaches the driver is ``bits / 64`` rows at most."""
    place = key.bitwiseAND(F.lit(bits - 1))
    word, bit = F.shiftright(place, 6), F.call_function("shiftleft", F.lit(1).cast("long"), place.bitwiseAND(F.lit(63)).cast("int"))
    rows = frame.select(word.alias("word"), bit.alias("bit")).groupBy("word").agg(F.bit_or("bit").alias("bits")).toArrow()
    out = np.zeros(bits // 64, dtype=np.uint64)
    out[rows.column("word").to_numpy()] = rows.column("bits").to_numpy().view(np.uint64)
    return out


def maybe(bits: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of ``keys`` may be in."""
    place = keys & np.uint64(len(bits) * 64 - 1)
    return ((bits[(place >> np.uint64(6)).astype(np.int64)] >> (place & np.uint64(63))) & np.uint64(1)).astype(bool)
