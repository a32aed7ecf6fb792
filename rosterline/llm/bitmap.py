"""A filter of fixed size for hashes: what is listed always passes, a few others do too."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

FILTER_BITS = 1 << 24


def residue_filter(keys: DataFrame, key: str) -> bytes:
    """A bitmap of the keys' residues modulo FILTER_BITS.

    At most that many numbers reach the driver, whatever the number of keys, and the bitmap has
    2 MB. Where it fills up, more passes it and is sorted out by the join behind.
    """
    seen = keys.select(F.pmod(F.col(key), F.lit(FILTER_BITS)).cast("int").alias("r")).distinct()
    flags = np.zeros(FILTER_BITS, dtype=bool)
    flags[seen.toArrow().column("r").to_numpy()] = True
    return np.packbits(flags, bitorder="little").tobytes()


def passes(bitmap: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes pass a filter, given as an array of bytes."""
    residue = hashes.view(np.int64) % FILTER_BITS
    return (bitmap[residue >> 3] >> (residue & 7).astype(np.uint8) & 1).astype(bool)
