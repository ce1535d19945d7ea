"""Repeated strings of a collection by interval expansion on its Burrows-Wheeler transform."""

from __future__ import annotations

import numpy as np

PACKED = 7  # characters in the first sort key, nine bits each


def _order(values: np.ndarray, to_end: np.ndarray, depth: int) -> np.ndarray:
    """The suffixes in order of their first ``depth`` characters or more (prefix doubling).

    ``values`` has 0 for an end mark, ``to_end`` the distance of each place to its
    end mark; end marks of different strings differ.
    """
    n = len(values)
    padded = np.concatenate((values.astype(np.int64), np.zeros(PACKED, np.int64)))
    key = np.zeros(n, np.int64)
    for j in range(PACKED):
        key = (key << 9) | np.where(to_end >= j, padded[j:n + j], 0)
    # a key that reaches an end mark differs from all others: stable sorting leaves such suffixes in order of their strings
    order = np.argsort(key, kind="stable")
    sorted_key = key[order]
    new = np.ones(n, bool)
    new[1:] = (sorted_key[1:] != sorted_key[:-1]) | (to_end < PACKED)[order][1:]
    rank = np.empty(n, np.int64)
    rank[order] = np.cumsum(new) - 1
    h = PACKED
    while h < depth and rank[order[-1]] < n - 1:
        key = rank * (n + 1)
        key[:n - h] += rank[h:] + 1
        order, sorted_key = _sorted(key, n)
        new[1:] = sorted_key[1:] != sorted_key[:-1]
        rank[order] = np.cumsum(new) - 1
        h *= 2
    return order


def _sorted(key: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Places in order of their keys (below (n + 1) squared), and the keys; both fit one word for blocks of the usual size."""
    bits = n.bit_length()
    if 3 * bits > 63:
        order = np.argsort(key)
        return order, key[order]
    both = np.sort((key << bits) | np.arange(n))
    return both & ((1 << bits) - 1), both >> bits


def _expand(low: np.ndarray, high: np.ndarray, before: np.ndarray, to_front: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Intervals of all strings that have one character more in front."""
    width = high - low
    one = width == 1
    alone = low[one]
    alone = to_front[alone[before[alone] > 0]]
    low, width = low[~one], width[~one]
    place = np.repeat(low - np.cumsum(width) + width, width) + np.arange(int(width.sum()))
    of = np.repeat(np.arange(len(low)), width)
    inside = before[place] > 0  # end marks extend nothing
    place = place[inside]
    # interval, character and place in one word: one sort groups them, places in order
    key = np.sort((of[inside] << 40) | (before[place].astype(np.int64) << 31) | place)
    place, key = key & ((1 << 31) - 1), key >> 31
    start = np.ones(len(key), bool)
    start[1:] = key[1:] != key[:-1]
    stop = np.ones(len(key), bool)
    stop[:-1] = start[1:]
    return np.concatenate((to_front[place[start]], alone)), np.concatenate((to_front[place[stop]], alone)) + 1


def repeats(strings: list[bytes], length: int) -> list[np.ndarray]:
    """For each string, which places start a string of ``length`` bytes that starts anywhere else in the collection too.

    The order of all suffixes gives the transform: for each suffix the character
    before it. An interval of suffixes that share a prefix w is extended backward
    by every character c before it, which gives the interval of cw; the first
    interval to end at a place shows how long a prefix the suffixes on both
    sides of that place share. Intervals are expanded breadth first, so
    common prefixes come by increasing length and the search stops at
    ``length``: places that no interval ended at share at least that much.
    """
    sizes = np.array([len(s) + 1 for s in strings])
    ends = np.cumsum(sizes) - 1
    n = int(sizes.sum())
    values = np.zeros(n, np.int16)
    values[np.setdiff1d(np.arange(n), ends, assume_unique=True)] = np.frombuffer(b"".join(strings), np.uint8).astype(np.int16) + 1
    owner = np.repeat(np.arange(len(strings)), sizes)
    order = _order(values, ends[owner] - np.arange(n), length)
    before = values[order - 1]  # the place before the first one is the last end mark
    to_front = np.empty(n, np.int64)
    to_front[np.argsort(before, kind="stable")] = np.arange(n)
    counts = np.bincount(values, minlength=257)
    bounds = np.concatenate(([0], np.cumsum(counts)))
    shorter = np.zeros(n + 1, bool)  # places whose two sides share less than `length`
    shorter[:counts[0] + 1] = True
    shorter[bounds] = True
    present = np.flatnonzero(counts[1:]) + 1
    marks = np.arange(counts[0])  # every end mark is a character of its own
    low, high = np.concatenate((marks, bounds[present])), np.concatenate((marks + 1, bounds[present + 1]))
    for _ in range(1, length):
        low, high = _expand(low, high, before, to_front)
        fresh = ~shorter[high]
        low, high = low[fresh], high[fresh]
        if not len(low):
            break
        shorter[high] = True
    again = ~shorter[:n] | ~shorter[1:]
    found = np.zeros(n, bool)
    found[order] = again
    return [found[e - s + 1:e] for s, e in zip(sizes.tolist(), ends.tolist(), strict=True)]
