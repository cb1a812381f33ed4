"""Exact sums of whole, non-negative weights as two BIGINT limbs: ``high * 2^62 + low``.

The arithmetic is vectorised: a pair of numpy arrays per value, normalised so that
``0 <= low < 2^62``. ``to_double`` rounds once, to the nearest double, as a cast of an
exact decimal does.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F

BITS = 62
MASK = (1 << BITS) - 1
Wide = tuple[np.ndarray, np.ndarray]


def wide(values: Sequence[int]) -> Wide:
    """The limbs of Python integers."""
    return np.array([v >> BITS for v in values], np.int64), np.array([v & MASK for v in values], np.int64)


def normal(high: np.ndarray, low: np.ndarray) -> Wide:
    """Limbs with ``low`` brought into its range (it may be anything a BIGINT holds)."""
    return high + (low >> BITS), low & MASK


def add(a: Wide, b: Wide) -> Wide:
    return normal(a[0] + b[0], a[1] + b[1])


def subtract(a: Wide, b: Wide) -> Wide:
    return normal(a[0] - b[0], a[1] - b[1])


def to_double(a: Wide) -> np.ndarray:
    """The nearest double of each non-negative value."""
    high, low = a
    out = low.astype(np.float64)
    big = np.flatnonzero(high)
    if len(big):
        h, l = high[big], low[big]
        # The leading bits as one whole number; a last bit stands for all that is cut off.
        shift = np.frexp(h.astype(np.float64))[1].astype(np.int64)
        lead = (h << (BITS - shift)) | (l >> shift)
        lead |= (l & ((np.int64(1) << shift) - 1)) != 0
        out[big] = np.ldexp(lead.astype(np.float64), shift)
    return out


def running(values: np.ndarray) -> Wide:
    """Exclusive running sums."""
    if float(values.sum(dtype=np.float64)) < 2.0**61:
        return np.zeros(len(values), np.int64), np.cumsum(values) - values
    half = BITS // 2
    upper, lower = (np.cumsum(x) - x for x in (values >> half, values & ((1 << half) - 1)))
    return normal(upper >> half, ((upper & ((1 << half) - 1)) << half) + lower)


def limbs(exact: Column) -> tuple[Column, Column]:
    """The two limbs of a DECIMAL(38,0) column that holds a non-negative whole number."""
    base = F.lit(1 << BITS).cast("decimal(38,0)")
    low = F.pmod(exact, base)
    return ((exact - low) / base).cast("bigint"), low.cast("bigint")


def joined(high: Column, low: Column) -> Column:
    """The DECIMAL(38,0) value of two limbs."""
    exact = high.cast("decimal(19,0)") * F.lit(1 << BITS).cast("decimal(19,0)")
    return exact.cast("decimal(38,0)") + low.cast("decimal(38,0)")


def joined_halves(upper: Column, lower: Column) -> Column:
    """The DECIMAL(38,0) value of ``upper * 2^31 + lower``."""
    exact = upper.cast("decimal(19,0)") * F.lit(1 << BITS // 2).cast("decimal(19,0)")
    return exact.cast("decimal(38,0)") + lower.cast("decimal(38,0)")
