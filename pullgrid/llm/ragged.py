"""Numpy helpers for arrays of varying length, laid end to end."""

from __future__ import annotations

import numpy as np


def offsets(lengths: np.ndarray) -> np.ndarray:
    out = np.zeros(len(lengths) + 1, np.int64)
    np.cumsum(lengths, out=out[1:])
    return out


def gather(flat: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """flat[starts[i] : starts[i] + lengths[i]] for every i, end to end."""
    ends = offsets(lengths)
    shift = np.repeat(starts - ends[:-1], lengths)
    return flat[shift + np.arange(ends[-1])]
