"""Fixed-size bitmaps of keys: a sieve that may pass a key too many but never loses one."""

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

BITS = 1 << 23  # one megabyte, however many keys there are


def key_bitmap(keys: DataFrame, column: str, bits: int = BITS) -> np.ndarray:
    """Words of 64 bits; bit (key mod bits) is set for each 64-bit key. Null keys set none.

    Only the words come to the driver, bits / 8 bytes at most. More keys than bits make the
    sieve pass more, so what it passes still has to meet the exact join that follows.
    """
    bit = F.pmod(F.col(column), F.lit(bits))
    found = (keys.where(F.col(column).isNotNull())
             .groupBy(F.shiftright(bit, 6).alias("word"))
             .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"),
                                           (bit % 64).cast("int"))).alias("mask"))
             .toArrow())
    words = np.zeros(bits // 64, np.uint64)
    words[found["word"].to_numpy()] = found["mask"].to_numpy().view(np.uint64)
    return words


def passes(words: np.ndarray, keys: np.ndarray) -> np.ndarray:
    """Which of the keys (64-bit integers) the bitmap lets through."""
    bit = keys.astype(np.int64, copy=False).view(np.uint64) & np.uint64(len(words) * 64 - 1)
    return (words[bit >> np.uint64(6)] >> (bit & np.uint64(63)) & np.uint64(1)).astype(bool)
