"""Words of one text as numbers, and exact equality of word windows."""

from __future__ import annotations

import numpy as np


def word_numbers(words: list[bytes]) -> tuple[np.ndarray, int]:
    """(number of each word, number of different words); equal words have equal numbers."""
    seen: dict[bytes, int] = {}
    ids = np.fromiter((seen.setdefault(w, len(seen)) for w in words), dtype=np.int64, count=len(words))
    return ids, len(seen)


def window_numbers(ids: np.ndarray, size: int) -> np.ndarray:
    """A number for each window of ``size`` neighbours; two windows have one number exactly if they are equal.

    Numbers of pairs of shorter windows are numbered again until the windows are long enough, so no hash decides.
    """
    cur, have = ids, 1
    while have < size and len(cur):
        step = min(have, size - have)
        if len(cur) <= step:
            return cur[:0]
        pairs = cur[:-step] * (cur.max() + 1) + cur[step:]
        cur = np.unique(pairs, return_inverse=True)[1].reshape(-1)
        have += step
    return cur


def covered(starts: np.ndarray, size: int, n: int) -> np.ndarray:
    """Which of ``n`` positions lie in a window of ``size`` that begins at one of ``starts``."""
    change = np.zeros(n + 1, dtype=np.int64)
    np.add.at(change, starts, 1)
    np.add.at(change, starts + size, -1)
    return np.cumsum(change[:-1]) > 0


def repeated_positions(ids: np.ndarray, size: int) -> np.ndarray:
    """Which positions lie in a window of ``size`` that occurs twice or more (the first occurrence included)."""
    windows = window_numbers(ids, size)
    if not len(windows):
        return np.zeros(len(ids), dtype=bool)
    again = np.bincount(windows)[windows] > 1
    return covered(np.flatnonzero(again), size, len(ids))
