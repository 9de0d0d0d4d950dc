"""Suffix arrays over sequences of word numbers, by prefix doubling in numpy."""

from __future__ import annotations

import numpy as np


def suffix_array(ids: np.ndarray) -> tuple[np.ndarray, list[np.ndarray]]:
    """The suffixes in order, and per level k a number for each position's window of 2**k ids.

    Equal numbers mean equal windows. Only suffixes that are not yet apart are sorted again.
    """
    n = len(ids)
    order = np.argsort(ids, kind="stable")
    first = np.empty(n, bool)
    first[:1] = True
    first[1:] = ids[order[1:]] != ids[order[:-1]]
    slots = np.arange(n)
    rank = np.empty(n, np.int64)
    rank[order] = np.maximum.accumulate(np.where(first, slots, 0))
    levels, width = [rank.astype(np.int32)], 1
    alone = first & np.append(first[1:], True)
    active = slots[~alone]
    while len(active):
        at = order[active]
        after = np.where(at + width < n, rank[np.minimum(at + width, n - 1)] + 1, 0)
        key = rank[at] * (n + 1) + after
        again = np.argsort(key, kind="stable")
        at, key = at[again], key[again]
        order[active] = at
        head = np.empty(len(at), bool)
        head[0] = True
        head[1:] = key[1:] != key[:-1]
        rank = rank.copy()
        rank[at] = np.maximum.accumulate(np.where(head, active, 0))
        width *= 2
        levels.append(rank.astype(np.int32))
        active = active[~(head & np.append(head[1:], True))]
    return order, levels


def common_prefixes(order: np.ndarray, levels: list[np.ndarray]) -> np.ndarray:
    """The length of the common prefix of each suffix in order and the one before it."""
    n = len(order)
    length = np.zeros(n, np.int64)
    a, b = order[1:].copy(), order[:-1].copy()
    for k in range(len(levels) - 1, -1, -1):
        inside = (a < n) & (b < n)
        same = inside.copy()
        same[inside] = levels[k][a[inside]] == levels[k][b[inside]]
        step = same.astype(np.int64) << k
        length[1:] += step
        a += step
        b += step
    return length


def longest_repeats(ids: np.ndarray) -> np.ndarray:
    """For every position the length of the longest sequence from there that also starts elsewhere."""
    best = np.zeros(len(ids), np.int64)
    if len(ids) > 1:
        order, levels = suffix_array(ids)
        length = common_prefixes(order, levels)
        best[order] = np.maximum(length, np.append(length[1:], 0))
    return best


def covered(best: np.ndarray, least: int) -> np.ndarray:
    """The positions inside a repeat of at least so many ids."""
    n = len(best)
    starts = np.flatnonzero(best >= least)
    edge = np.zeros(n + 1, np.int64)
    np.add.at(edge, starts, 1)
    np.add.at(edge, starts + best[starts], -1)
    return np.cumsum(edge[:n]) > 0


def covered_by_windows(best: np.ndarray, width: int) -> np.ndarray:
    """The positions inside a window of ``width`` ids that is found twice or more."""
    return covered(np.where(best >= width, width, 0), width)
