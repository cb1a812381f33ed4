"""Linear suffix sorting by grouping, in two phases.

Phase one groups suffixes by their longest Lyndon prefix. Groups start as those of equal
first symbols and are processed from the greatest down. A processed suffix points to the
nearest one to its left that is smaller than its group (its previous smaller suffix); that
one's prefix grows by the group's, as often as processed suffixes point to it, so within
its group it moves up to a new group of those with as many. Phase two walks the order
from the least suffix and places, at the next free slot of their groups, the suffix just
before each one placed and whatever its chain of pointers still has unplaced. There is
no renaming and no recursion.
"""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: list[int]) -> list[int]:
    """Starts of the suffixes of ``symbols`` in order. The last symbol must be the least, and unique."""
    n = len(symbols)
    values = np.asarray(symbols)
    by_symbol = np.argsort(values, kind="stable")
    heads = np.flatnonzero(np.append(True, np.diff(values[by_symbol]) != 0))
    tails = np.append(heads[1:], n)
    place = np.empty(n, np.int64)
    place[by_symbol] = np.arange(n)
    group = np.empty(n, np.int64)
    group[by_symbol] = np.repeat(heads, tails - heads)
    line, place, group = by_symbol.tolist(), place.tolist(), group.tolist()
    stop = dict(zip(heads.tolist(), tails.tolist()))
    smaller = list(range(-1, n - 1))

    high = n
    while high:
        low = group[line[high - 1]]
        if high - low == 1:
            # The usual case: one suffix, and so one parent, which becomes the last of its group.
            parent = smaller[line[low]]
            while parent >= 0 and group[parent] >= low:
                parent = smaller[parent]
            smaller[line[low]] = parent
            if parent >= 0:
                head = group[parent]
                tail = stop[head] - 1
                if tail > head:
                    at, other = place[parent], line[tail]
                    line[at], place[other] = other, at
                    line[tail], place[parent] = parent, tail
                    group[parent] = stop[head] = tail
                    stop[tail] = tail + 1
        else:
            parents = []
            for suffix in sorted(line[low:high]):
                parent = smaller[suffix]
                while parent >= 0 and group[parent] >= low:
                    parent = smaller[parent]
                smaller[suffix] = parent
                if parent >= 0:
                    parents.append(parent)
            if len(set(parents)) == len(parents):
                rounds = [parents]
            else:
                times: dict[int, int] = {}
                for parent in parents:
                    times[parent] = times.get(parent, 0) + 1
                by_count: dict[int, list[int]] = {}
                for parent, count in times.items():
                    by_count.setdefault(count, []).append(parent)
                rounds = [by_count[count] for count in sorted(by_count, reverse=True)]
            for parents in rounds:
                tops: dict[int, int] = {}
                for parent in parents:
                    head = group[parent]
                    tail = (tops[head] if head in tops else stop[head]) - 1
                    tops[head] = tail
                    at, other = place[parent], line[tail]
                    line[at], place[other] = other, at
                    line[tail], place[parent] = parent, tail
                for parent in parents:
                    group[parent] = tops[group[parent]]
                for head, tail in tops.items():
                    if tail > head:
                        stop[tail] = stop[head]
                        stop[head] = tail
        high = low

    order = [-1] * n
    slot = list(range(n))
    placed = bytearray(n + 1)
    placed[n] = 1  # what -1 reads
    order[0] = n - 1
    placed[n - 1] = 1
    for i in range(n):
        suffix = order[i] - 1
        while not placed[suffix]:
            head = group[suffix]
            order[slot[head]] = suffix
            slot[head] += 1
            placed[suffix] = 1
            suffix = smaller[suffix]
    return order
