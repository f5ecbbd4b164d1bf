"""Weighted counting of points in boxes, for one task's worth of points."""

from __future__ import annotations

import numpy as np


def box_weights(x, y, weight, x_low, x_high, y_low, y_high):
    """Total weight of the points inside each box, bounds included.

    The points are sorted by y, which makes each box a run of them; a wavelet
    matrix over the ranks of x then counts inside the runs bit by bit. Costs
    (points + boxes) times the bits of a rank, whatever the number of hits.
    """
    order = np.argsort(y, kind="stable")
    y, weight = y[order], weight[order].astype(np.int64)
    distinct, rank = np.unique(x[order], return_inverse=True)
    first = np.searchsorted(y, y_low, side="left")
    last = np.maximum(np.searchsorted(y, y_high, side="right"), first)
    below = np.searchsorted(distinct, x_low, side="left")
    upto = np.maximum(np.searchsorted(distinct, x_high, side="right"), below)
    # weight of ranks < upto minus weight of ranks < below, in one go
    limit = np.concatenate([upto, below])
    start, stop = np.concatenate([first, first]), np.concatenate([last, last])
    total = np.zeros(len(limit), dtype=np.int64)
    for bit in range(len(distinct).bit_length() - 1, -1, -1):
        zero = (rank >> bit) & 1 == 0
        zeros = np.concatenate([[0], np.cumsum(zero)])
        zero_weight = np.concatenate([[0], np.cumsum(np.where(zero, weight, 0))])
        one = (limit >> bit) & 1 == 1
        total += np.where(one, zero_weight[stop] - zero_weight[start], 0)
        start = np.where(one, zeros[-1] + start - zeros[start], zeros[start])
        stop = np.where(one, zeros[-1] + stop - zeros[stop], zeros[stop])
        rank, weight = np.concatenate([rank[zero], rank[~zero]]), np.concatenate([weight[zero], weight[~zero]])
    return total[: len(upto)] - total[len(upto) :]


def reach(value, radius):
    """Lowest and highest double within ``radius`` of each value.

    Exactly the doubles v with abs(v - value) <= radius in floating point, found
    by bisection over the ordered bit patterns.
    """
    value = np.asarray(value, dtype=np.float64)
    low = -_farthest(-value, radius)
    return low, _farthest(value, radius)


def _farthest(value, radius):
    if np.isinf(radius):
        return np.full(value.shape, np.inf)
    slack = 4 * np.spacing(np.maximum(np.abs(value), radius))
    good, bad = _ordinal(value), _ordinal(value + radius + slack)
    # Settle the side of zero first: good and bad then differ by less than 2**63.
    zero_inside = np.abs(value) <= radius
    good = np.where((value < 0) & zero_inside, 0, good)
    bad = np.where((value < 0) & ~zero_inside, np.minimum(bad, 0), bad)
    while np.any(bad - good > 1):
        middle = good + (bad - good) // 2
        inside = np.abs(_from_ordinal(middle) - value) <= radius
        good, bad = np.where(inside, middle, good), np.where(inside, bad, middle)
    return _from_ordinal(good)


def _ordinal(value):
    """Integers in the order of the doubles they stand for."""
    bits = np.ascontiguousarray(value + 0.0).view(np.int64)
    return np.where(bits >= 0, bits, np.int64(-(2**63)) - bits)


def _from_ordinal(number):
    bits = np.where(number >= 0, number, np.int64(-(2**63)) - number)
    return np.ascontiguousarray(bits).view(np.float64)
