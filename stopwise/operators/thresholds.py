"""Flags from a rolling quantile of the scores.

The score under test is part of its own window, so "score above the quantile"
is a question of rank: with ``n`` scores in the window it holds exactly when at
least ``floor((n - 1) * q) + 1`` of them are smaller. The rank does not depend on
``q``, so one pass serves every quantile.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column
from pyspark.sql import functions as F


def smaller_in_window(scores: np.ndarray, window_size: int) -> np.ndarray:
    """Per score, how many of the ``window_size`` scores up to it are smaller.

    A wavelet matrix over the ranks: at each bit the rows are parted stably by it, and all windows follow their own
    score's bits at once. A set bit leaves the window's rows without it behind, and those are smaller. Equal scores
    rank from the last to the first, so that no earlier one counts as smaller.
    """
    n = len(scores)
    place = np.arange(n)
    rank = np.empty(n, dtype=np.int64)
    rank[np.lexsort((-place, scores))] = place
    low, high = np.maximum(place - window_size + 1, 0), place + 1
    out, level = np.zeros(n, dtype=np.int64), rank
    for bit in range(max(n - 1, 0).bit_length() - 1, -1, -1):
        unset = (level >> bit) & 1 == 0
        before = np.concatenate([[0], np.cumsum(unset)])
        low_unset, high_unset = before[low], before[high]
        up = (rank >> bit) & 1 == 1
        out += np.where(up, high_unset - low_unset, 0)
        low = np.where(up, before[-1] + low - low_unset, low_unset)
        high = np.where(up, before[-1] + high - high_unset, high_unset)
        level = np.concatenate([level[unset], level[~unset]])
    return out


def above_quantile(window_size: Column, quantile: Column) -> Column:
    """1 where the window is full and the score lies above its quantile."""
    needed = F.floor((window_size - 1) * quantile) + 1
    return ((F.col("seq") >= window_size) & (F.col("n_smaller") >= needed)).cast("int")
