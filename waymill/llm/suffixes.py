"""Suffix arrays by grouping suffixes by their Lyndon prefixes, in linear time."""

from __future__ import annotations

from collections.abc import Sequence


def suffix_array(symbols: Sequence[int]) -> list[int]:
    """The starts of all suffixes in their order, a suffix that is the beginning of another coming first.

    First, suffixes are in groups by their first symbol.  From the highest group down, each suffix of a
    group points to the nearest place before it that is in a lower group, and the suffixes pointed to
    leave their groups for new, higher ones next to them: the more often pointed to, the higher.  In
    the end a group holds the suffixes that begin with the same Lyndon word.  Then, from the least suffix on,
    the suffix before each and those that it points to in turn take the next free place of their
    groups.  Nothing is sorted again or renamed.
    """
    n = len(symbols) + 1
    # The end is a symbol of its own, less than all others.
    size_of: dict[int, int] = {}
    for s in symbols:
        size_of[s] = size_of.get(s, 0) + 1
    first, at = {}, 1
    for s in sorted(size_of):
        first[s] = at
        at += size_of[s]
    group = [first[s] for s in symbols] + [0]
    sizes = [0] * n
    sizes[0] = 1
    for s, start in first.items():
        sizes[start] = size_of[s]
    free = dict.fromkeys(first.values(), 0)
    order, place = [0] * n, [0] * n
    order[0], place[n - 1] = n - 1, 0
    for i in range(n - 1):
        g = group[i]
        p = g + free[g]
        free[g] += 1
        order[p], place[i] = i, p
    before = [-1] * n
    high = n
    while high > 0:
        low = group[order[high - 1]]
        members = order[low:high]
        if len(members) > 1:
            members.sort()
        times: dict[int, int] = {}
        for i in members:
            j = i - 1
            # Places already handled are in higher groups or in this one; they lead on to lower ones.
            while j >= 0 and group[j] >= low:
                j = before[j]
            before[i] = j
            if j >= 0:
                times[j] = times.get(j, 0) + 1
        if times:
            most = max(times.values())
            if most == 1:
                levels = [list(times)]
            else:
                levels = [[] for _ in range(most)]
                for j, k in times.items():
                    levels[most - k].append(j)
            for level in levels:
                moved: dict[int, int] = {}
                for j in level:
                    g = group[j]
                    m = moved.get(g, 0) + 1
                    moved[g] = m
                    # To the back of its group, by an exchange.
                    to, p = g + sizes[g] - m, place[j]
                    other = order[to]
                    order[to], order[p] = j, other
                    place[j], place[other] = to, p
                for g, m in moved.items():
                    start = g + sizes[g] - m
                    sizes[g] -= m
                    if start != g:
                        sizes[start] = m
                        for p in range(start, start + m):
                            group[order[p]] = start
                    else:
                        sizes[g] = m
        high = low
    result = [-1] * n
    done = bytearray(n)
    following = list(range(n))
    result[0] = n - 1
    done[n - 1] = 1
    for k in range(n):
        j = result[k] - 1
        while j >= 0 and not done[j]:
            g = group[j]
            result[following[g]] = j
            following[g] += 1
            done[j] = 1
            j = before[j]
    return result[1:]
