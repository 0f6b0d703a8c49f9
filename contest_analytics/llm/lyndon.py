"""Suffix sorting by Lyndon grouping, for many small texts at once.

The texts lie end to end; every step handles one group of each text together, as numpy operations.

1. Suffixes start grouped by their first symbol. Groups are taken in descending order. A suffix of the
   group points to the nearest earlier suffix that lies in a lower group. Suffixes that are pointed
   to get the group's prefix appended as many times as they are pointed to, and move behind the rest
   of their own group, more times further behind. When all groups are taken, a group holds the
   suffixes with one longest Lyndon prefix, and groups are in its order.
2. A suffix is its Lyndon prefix followed by the next smaller suffix. Groups are taken in ascending
   order and each is emitted by the ranks of these followers, which are known by then.
"""

from __future__ import annotations

import numpy as np


def _ranges(starts: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    """All numbers of the ranges, end to end."""
    ends = np.cumsum(sizes)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - sizes), sizes)


def lyndon_groups(symbols: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(suffixes by group, start of each suffix's group, length of its Lyndon prefix).

    Text b is ``symbols[bounds[b]:bounds[b + 1]]``; places in the order are numbered over all texts.
    """
    n, low, high = len(symbols), bounds[:-1], bounds[1:].copy()
    owner = np.repeat(np.arange(len(low)), np.diff(bounds))
    order = np.lexsort((symbols, owner))
    new = np.empty(n, bool)
    new[:1] = True
    new[1:] = (symbols[order[1:]] != symbols[order[:-1]]) | (owner[order[1:]] != owner[order[:-1]])
    heads = np.flatnonzero(new)
    size = np.zeros(n + 1, np.int64)
    size[heads] = np.diff(np.append(heads, n))
    group, place = np.empty(n, np.int64), np.empty(n, np.int64)
    group[order], place[order] = np.repeat(heads, size[heads]), np.arange(n)
    length, before = np.ones(n, np.int64), np.arange(-1, n - 1)
    before[low[low < n]] = -1
    count, marked = np.zeros(n, np.int64), np.zeros(n, bool)

    live = np.flatnonzero(high > low)
    while len(live):
        start = group[order[high[live] - 1]]
        members = order[_ranges(start, high[live] - start)]
        high[live] = start
        live = live[start > low[live]]
        while True:  # to the nearest earlier suffix of a lower group
            at = before[members]
            far = (at >= 0) & (group[at] >= group[members])
            if not far.any():
                break
            before[members[far]] = before[at[far]]
        at = before[members]
        pointing = at >= 0
        at, added = at[pointing], length[members[pointing]]
        if not len(at):
            continue
        np.add.at(count, at, 1)
        # All that point to a parent are in one group and have one prefix length.
        parents, first = np.unique(at, return_index=True)
        times = count[parents]
        length[parents] += times * added[first]
        count[parents] = 0
        by = np.lexsort((times, group[parents]))
        parents, times = parents[by], times[by]
        own = group[parents]
        new = np.append(True, own[1:] != own[:-1])
        heads = own[new]
        moved = np.diff(np.append(np.flatnonzero(new), len(own)))
        tail = heads + size[heads] - moved
        places = _ranges(tail, moved)
        marked[parents] = True
        displaced = order[places]
        displaced = displaced[~marked[displaced]]
        left = place[parents]
        left = left[left < np.repeat(tail, moved)]
        order[left], place[displaced] = displaced, left
        order[places], place[parents] = parents, places
        marked[parents] = False
        size[heads] -= moved
        split = new | np.append(True, times[1:] != times[:-1])
        begin = places[split]
        size[begin] = np.diff(np.append(np.flatnonzero(split), len(own)))
        group[parents] = np.repeat(begin, size[begin])
    return order, group, length


def suffix_arrays(symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The suffix arrays of all texts, end to end; entries are positions in ``symbols``."""
    order, group, length = lyndon_groups(symbols, bounds)
    n = len(symbols)
    low = bounds[:-1]
    owner = np.repeat(np.arange(len(low)), np.diff(bounds))
    end = bounds[1:][owner]
    # The follower outside the group, and how often the group's prefix repeats before it, by doubling.
    follower = np.append(np.arange(n) + length, n)
    ended = np.append(follower[:-1] >= end, True)
    follower[ended] = n
    group_of = np.append(group, -1)
    hops = np.ones(n + 1, np.int64)
    while True:
        inside = np.flatnonzero(group_of[follower] == group_of)
        inside = inside[inside < n]
        if not len(inside):
            break
        via = follower[inside]
        hops[inside], follower[inside] = hops[inside] + hops[via], follower[via]
    follower, hops = follower[:-1], hops[:-1]

    rank = np.append(group, -1)  # final for groups of one
    sizes = np.bincount(group, minlength=n + 1)
    several = np.flatnonzero(sizes > 1)
    text = owner[order[several]] if n else several
    turn = np.arange(len(several)) - np.searchsorted(text, text)  # the t-th such group of each text
    by_turn = np.argsort(turn, kind="stable")
    cuts = np.append(np.searchsorted(turn[by_turn], np.arange(turn.max() + 1)), len(turn)) if len(turn) else [0]
    for a, b in zip(cuts[:-1], cuts[1:]):
        starts = several[by_turn[a:b]]
        places = _ranges(starts, sizes[starts])
        members = order[places]
        by = np.lexsort((rank[follower[members]], hops[members], group[members]))
        order[places] = members[by]
        rank[members[by]] = places
    return order
