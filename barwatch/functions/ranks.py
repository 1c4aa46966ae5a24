"""Counts over sliding ranges of an array, for windows too long to hold per row."""

from __future__ import annotations

import numpy as np


def counts_at_most(values: np.ndarray, rows: int, first: int) -> np.ndarray:
    """For each place from ``first`` on, how many of the ``rows`` values before it are at most its own.

    NaN is a missing value: above all others when counted, and at its own place the count is 0.

    The ranks are sorted bit by bit from the highest, zeros before ones, and every range follows its
    bits down through prefix counts of zeros (a wavelet matrix, one level in memory at a time): n log n
    steps on whole arrays, whatever ``rows`` is.
    """
    known = ~np.isnan(values)
    distinct = np.unique(values[known])
    level = np.where(known, np.searchsorted(distinct, values), len(distinct))
    below = np.where(known, level + 1, 0)[first:]
    high = np.arange(first, len(values))
    low = np.maximum(high - rows, 0)
    found = np.zeros(len(high), np.int64)
    for bit in reversed(range(len(distinct).bit_length())):
        ones = (level >> bit & 1).astype(bool)
        zeros = np.concatenate([[0], np.cumsum(~ones)])
        some = (below >> bit & 1).astype(bool)
        at_low, at_high = zeros[low], zeros[high]
        found += np.where(some, at_high - at_low, 0)
        low = np.where(some, zeros[-1] + low - at_low, at_low)
        high = np.where(some, zeros[-1] + high - at_high, at_high)
        level = np.concatenate([level[~ones], level[ones]])
    return found
