"""Suffix arrays over sequences of word numbers, with numpy."""

from __future__ import annotations

import numpy as np


def suffix_array(text: np.ndarray, depth: int) -> np.ndarray:
    """Starts of the suffixes of text that begin with a symbol above 0, sorted by `depth` symbols.

    Symbol 0 stands for a stop: what follows a stop has no bearing on the order. The first pass
    sorts by as many symbols as fit into 62 bits; each further pass doubles that, and only for
    suffixes that aren't yet told apart.
    """
    at = np.flatnonzero(text)
    if not len(at):
        return at
    bits = max(1, int(text.max()).bit_length())
    known = max(1, 62 // bits)
    padded = np.concatenate([text, np.zeros(known, text.dtype)]).astype(np.int64)
    key = np.zeros(len(at), np.int64)
    for j in range(known):
        key = key << bits | padded[at + j]
    order = np.argsort(key, kind="stable")
    starts, key = at[order], key[order]
    first = np.concatenate([[True], key[1:] != key[:-1]])
    group = np.flatnonzero(first)[np.cumsum(first) - 1]
    rank = np.zeros(len(text) + 1, np.int64)
    rank[starts] = group + 1
    while known < depth:
        alone = first & np.concatenate([first[1:], [True]])
        rows = np.flatnonzero(~alone)
        if not len(rows):
            break
        here = starts[rows]
        key = group[rows] << 32 | rank[np.minimum(here + known, len(text))]
        order = np.argsort(key, kind="stable")
        starts[rows], key = here[order], key[order]
        first[rows] = np.concatenate([[True], key[1:] != key[:-1]])
        group = np.flatnonzero(first)[np.cumsum(first) - 1]
        rank[starts[rows]] = group[rows] + 1
        known *= 2
    return starts


def narrowed(
    text: np.ndarray, starts: np.ndarray, low: np.ndarray, high: np.ndarray, symbol: np.ndarray, depth: int
) -> tuple[np.ndarray, np.ndarray]:
    """Of each range of the suffix array, the part whose symbol at `depth` is the wanted one.

    text ends in more stops than any match is long.
    """

    def bound(up: bool) -> np.ndarray:
        left, right = low.copy(), high.copy()
        while (left < right).any():
            middle = (left + right) >> 1
            seen = text[starts[np.minimum(middle, len(starts) - 1)] + depth]
            on = (left < right) & ((seen <= symbol) if up else (seen < symbol))
            right = np.where((left < right) & ~on, middle, right)
            left = np.where(on, middle + 1, left)
        return left

    return bound(False), bound(True)
