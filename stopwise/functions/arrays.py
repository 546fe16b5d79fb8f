"""Array expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def sorted_quantile(values: Column, q: float) -> Column:
    """Linear-interpolation quantile of a sorted, null-free array; null when empty."""
    rank = (F.size(values) - 1) * F.lit(float(q))
    low = F.floor(rank)
    frac = rank - low
    a = F.get(values, low.cast("int")).cast("double")
    b = F.get(values, F.ceil(rank).cast("int")).cast("double")
    # From the nearer end, which keeps whole-number results whole.
    inside = F.when(frac < 0.5, a + (b - a) * frac).otherwise(b - (b - a) * (1 - frac))
    return F.when(F.size(values) > 0, inside)


def last_items(values: Column, n: int) -> Column:
    """The last ``n`` items of an array."""
    start = F.greatest(F.size(values) - n, F.lit(0)) + 1
    return F.slice(values, start, F.lit(n))
