"""Suffix arrays by the linear grouping construction.

Suffixes are first grouped by their longest Lyndon prefix: groups start as the buckets of first symbols and are
processed in descending order. For each suffix of a group, the previous-smaller pointer leads to the nearest suffix to
its left in a lower group; that suffix's prefix grows by the group's prefix, once for every member that points to
it, so it leaves its group for a new one just above. When all groups are processed, one ascending pass over the
array emits each group's order: after a suffix is placed, the suffixes that end before it are placed along their pointers.
Nothing is renamed and nothing recurs.
"""

from __future__ import annotations

import numpy as np


def lyndon_groups(text: np.ndarray) -> tuple[list[int], list[int]]:
    """First array position of each suffix's final group, and its previous-smaller pointer (-1: none)."""
    n = len(text)
    order = np.argsort(text, kind="stable")
    sa: list[int] = order.tolist()
    isa_ = np.empty(n, np.int64)
    isa_[order] = np.arange(n)
    isa: list[int] = isa_.tolist()
    starts = np.flatnonzero(np.r_[True, np.diff(text[order]) != 0])
    sizes = np.diff(np.r_[starts, n])
    where = np.empty(n, np.int64)
    where[order] = np.repeat(starts, sizes)
    group: list[int] = where.tolist()
    size = [0] * n
    for s, k in zip(starts.tolist(), sizes.tolist(), strict=True):
        size[s] = k
    prev = [-1] * n
    top = n - 1
    while top >= 0:
        low = group[sa[top]]
        if low == top:  # a group of one: its pointer's suffix leaves its group alone
            s = sa[top]
            p = s - 1
            while p >= 0 and group[p] >= low:
                p = prev[p]
            prev[s] = p
            if p >= 0:
                h = group[p]
                k = size[h]
                if k > 1:
                    last = h + k - 1
                    at = isa[p]
                    q = sa[last]
                    sa[at] = q
                    isa[q] = at
                    sa[last] = p
                    isa[p] = last
                    size[h] = k - 1
                    group[p] = last
                    size[last] = 1
            top = low - 1
            continue
        members = sa[low:top + 1]
        members.sort()
        count: dict[int, int] = {}
        for s in members:
            p = s - 1
            while p >= 0 and group[p] >= low:
                p = prev[p]
            prev[s] = p
            if p >= 0:
                count[p] = count.get(p, 0) + 1
        levels: dict[int, dict[int, list[int]]] = {}
        for p, c in count.items():
            own = levels.get(c)
            if own is None:
                own = levels[c] = {}
            h = group[p]
            if h in own:
                own[h].append(p)
            else:
                own[h] = [p]
        for c in sorted(levels, reverse=True):
            # A suffix of a group split at a higher level still stands in that group's lower part.
            for h, ps in levels[c].items():
                k, m = size[h], len(ps)
                if m == k:
                    continue
                last = h + k - 1
                for p in ps:
                    at = isa[p]
                    q = sa[last]
                    sa[at] = q
                    isa[q] = at
                    sa[last] = p
                    isa[p] = last
                    last -= 1
                new = last + 1
                size[h] = k - m
                size[new] = m
                for p in ps:
                    group[p] = new
        top = low - 1
    return group, prev


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Suffix array of symbols >= 1; the end of the text counts as a symbol below all."""
    if not len(text):
        return np.zeros(0, np.int64)
    ended = np.append(np.asarray(text, np.int64), 0)
    group, prev = lyndon_groups(ended)
    n = len(ended)
    free = list(range(n))  # next place of the group that starts there
    placed = bytearray(n)
    sa = [-1] * n
    sa[0] = n - 1
    placed[n - 1] = 1
    for i in range(n):
        s = sa[i] - 1
        while s >= 0 and not placed[s]:
            g = group[s]
            sa[free[g]] = s
            free[g] += 1
            placed[s] = 1
            s = prev[s]
    return np.array(sa[1:], np.int64)
