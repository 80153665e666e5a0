"""A filter over 64-bit hashes whose size does not depend on the number of hashes.

It lets everything that was put in pass, and little else while it is not overfull. Tasks use it
to leave out rows early; what matters is then decided by a join.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Bits, a power of two; a filter is 1 MB.
BITS = 1 << 23
_SHIFTS = (0, 20, 41)


def filter_of(df: DataFrame, hashed: Column) -> bytes:
    """The filter of all values of ``hashed`` (bigint); at most BITS / 64 numbers reach the driver."""
    places = F.array(*[F.shiftrightunsigned(F.col("h"), s).bitwiseAND(F.lit(BITS - 1)) for s in _SHIFTS])
    bit = F.expr("shiftleft(1L, cast(place & 63 AS int))")
    cells = (
        df.select(hashed.alias("h"))
        .select(F.explode(places).alias("place"))
        .groupBy(F.shiftright("place", 6).alias("cell"))
        .agg(F.bit_or(bit).alias("bits"))
        .collect()
    )
    bits = np.zeros(BITS // 64, np.int64)
    for row in cells:
        bits[row["cell"]] = row["bits"]
    return bits.tobytes()


def passes(bits: bytes, hashes: np.ndarray) -> np.ndarray:
    """Which of the hashes (uint64) pass."""
    cells = np.frombuffer(bits, np.uint8)
    ok = np.ones(len(hashes), bool)
    for s in _SHIFTS:
        place = ((hashes >> np.uint64(s)) & np.uint64(BITS - 1)).astype(np.int64)
        ok &= (cells[place >> 3] >> (place & 7).astype(np.uint8)) & 1 == 1
    return ok
