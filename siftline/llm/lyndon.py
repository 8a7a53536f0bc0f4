"""Suffix orders of many short texts at once, by linear grouping construction.

A suffix's Lyndon prefix is its longest prefix that is smaller than all that prefix's own suffixes. Suffixes with one such
prefix are a group. Groups are made in descending order: the members of the largest group that is left stand, in the
text, right of smaller suffixes; runs of members right of the same previous smaller suffix make its prefix longer by as
many repeats, so such suffixes leave their group for a new, larger one, and the members are done. Then the groups are
gone through in ascending order: a member's place in its group follows from the place, known by then, of the next
smaller suffix behind its run. Nothing is renamed and nothing recurs (Baier, "Linear-time Suffix Sorting", CPM 2016).

Here, a group of every bucket takes each step at the same time, on arrays over all buckets. What is left of a text is
kept as a linked list, so that its next element to the left is the previous smaller suffix.
"""

from __future__ import annotations

import numpy as np


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """start[0], start[0] + 1, ..., for size[0] numbers, then those of start[1], and so on."""
    ends = np.cumsum(size)
    return np.repeat(start - ends + size, size) + np.arange(ends[-1] if len(ends) else 0)


class _Groups:
    """Groups as ranges of the suffix order: a group is named by its range's start, and larger groups come later."""

    def __init__(self, symbols: np.ndarray, bounds: np.ndarray):
        n = len(symbols)
        key = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds)) * 256 + symbols
        self.order = np.argsort(key, kind="stable")
        self.place = np.empty(n, np.int64)
        self.place[self.order] = np.arange(n)
        start = np.flatnonzero(np.r_[True, np.diff(key[self.order]) != 0])
        self.end = np.zeros(n + 1, np.int64)  # of the group that starts here
        self.start = np.zeros(n + 1, np.int64)  # of the group that ends here
        stop = np.r_[start[1:], n]
        self.end[start], self.start[stop] = stop, start
        self.of = np.empty(n, np.int64)
        self.of[self.order] = np.repeat(start, stop - start)
        self._moved = np.zeros(n, bool)

    def raise_(self, who: np.ndarray) -> None:
        """Those suffixes leave their groups for new ones right above them."""
        group = self.of[who]
        by = np.argsort(group, kind="stable")
        who, group = who[by], group[by]
        at = np.flatnonzero(np.r_[True, group[1:] != group[:-1]])
        group, count = group[at], np.diff(np.r_[at, len(who)])
        stop = self.end[group]
        new = stop - count
        part = new != group  # where all of a group leave it, nothing changes
        if not part.all():
            who = who[np.repeat(part, count)]
            group, count, stop, new = group[part], count[part], stop[part], new[part]
            if not len(who):
                return
        target, mine = _ranges(new, count), np.repeat(new, count)
        self._moved[who] = True
        fill = target[~self._moved[self.order[target]]]
        self._moved[who] = False
        place = self.place[who]
        hole = place[place < mine]
        up, down = self.order[hole], self.order[fill]
        self.order[hole], self.order[fill] = down, up
        self.place[down], self.place[up] = hole, fill
        self.of[who] = mine
        self.end[new], self.end[group] = stop, new
        self.start[stop], self.start[new] = new, group


def suffix_order(symbols: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """All places, bucket by bucket (bucket i has bounds[i] to bounds[i + 1]), each bucket's in the order of its suffixes.

    symbols are 0 to 255. A suffix ends at the next 0. Every bucket must end in a 0, and the first is a single 0; zeros come
    first in their bucket, in no particular order.
    """
    n = len(symbols)
    groups = _Groups(symbols, bounds)
    left, right = np.arange(n) - 1, np.arange(n) + 1
    behind, repeat = np.zeros(n, np.int64), np.ones(n, np.int64)  # the next smaller suffix behind the run; members up to its end
    top, open_ = bounds[1:].copy(), np.arange(len(bounds) - 1)
    while True:
        stop = top[open_]
        start = groups.start[stop]
        more = start > bounds[open_]  # the zeros are never taken
        if not more.all():
            open_, start, stop = open_[more], start[more], stop[more]
        if not len(open_):
            break
        top[open_] = start
        member = np.sort(groups.order[_ranges(start, stop - start)])
        before = left[member]
        head = np.flatnonzero(before != np.r_[-1, member[:-1]])
        tail = np.r_[head[1:], len(member)] - 1
        length = tail - head + 1
        smaller, after = before[head], right[member[tail]]
        behind[member] = np.repeat(after, length)
        repeat[member] = np.repeat(tail, length) - np.arange(len(member)) + 1
        right[smaller], left[after] = after, smaller
        real = symbols[smaller] != 0
        smaller, length = smaller[real], length[real]
        if len(smaller):
            for times in np.unique(length)[::-1] if length.max() > 1 else (1,):
                groups.raise_(smaller[length == times])

    order, place, of = groups.order, groups.place, groups.of
    start = np.flatnonzero(np.r_[True, np.diff(of[order]) != 0])
    size = np.diff(np.r_[start, n])
    bucket = np.searchsorted(bounds, start, "right") - 1
    several = (size > 1) & (start != bounds[bucket])
    start, size, bucket = start[several], size[several], bucket[several]
    turn = np.arange(len(start)) - np.searchsorted(bucket, bucket)  # a bucket's first group, second, ...
    by = np.argsort(turn, kind="stable")
    cuts = np.searchsorted(turn[by], np.arange(turn.max(initial=-1) + 2))
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        now = by[a:b]
        where = _ranges(start[now], size[now])
        member = order[where]
        member = member[np.lexsort((place[behind[member]], repeat[member], np.repeat(start[now], size[now])))]
        order[where], place[member] = member, where
    return order
