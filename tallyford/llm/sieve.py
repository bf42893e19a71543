"""A filter of fixed size for 64-bit hashes: it lets all of a set pass, and more of the others as it fills."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def sieve(df: DataFrame, column: str, bits: int) -> np.ndarray:
    """One bit for each of 2 ** bits slots, packed: set where a hash falls. Never more slots than that come to the driver."""
    slots = df.select(F.shiftrightunsigned(column, 64 - bits).cast("int").alias("slot")).distinct().toArrow()
    there = np.zeros(1 << bits, bool)
    there[slots.column("slot").to_numpy()] = True
    return np.packbits(there)


def passes(sieved: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    """Which unsigned hashes may be in the set."""
    bits = (8 * len(sieved)).bit_length() - 1
    slot = (hashes >> np.uint64(64 - bits)).astype(np.int64)
    return (sieved[slot >> 3] >> (7 - (slot & 7)).astype(np.uint8)) & 1 == 1
