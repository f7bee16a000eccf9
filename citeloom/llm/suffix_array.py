"""Suffix arrays by linear grouping, and the classes of equal prefixes that they give."""

from __future__ import annotations

import numpy as np


def suffix_array(symbols: list[int]) -> list[int]:
    """The suffixes of an integer text in ascending order; the last symbol must be smaller than all others.

    First suffixes are grouped by their longest Lyndon prefixes: groups are taken in descending order; each member finds
    the nearest earlier suffix of a smaller group, and the suffixes so found leave their groups for new ones just above,
    the higher the more members found them.  Then one ascending pass emits each group's order by the same pointers.
    """
    n = len(symbols)
    order = sorted(range(n), key=symbols.__getitem__)
    place, group, size = [0] * n, [0] * n, [0] * n
    start = 0
    for k, s in enumerate(order):
        if k and symbols[s] != symbols[order[k - 1]]:
            start = k
        place[s], group[s] = k, start
        size[start] += 1
    before = [-1] * n
    end = n
    while end > 0:
        start = group[order[end - 1]]
        members = order[start:end]
        end = start
        if len(members) == 1:
            i = members[0]
            j = i - 1
            while j >= 0 and group[j] >= start:
                j = before[j]
            before[i] = j
            if j >= 0 and size[group[j]] > 1:
                _lift([j], order, place, group, size)
            continue
        members.sort()
        found: dict[int, int] = {}
        for i in members:
            j = i - 1
            while j >= 0 and group[j] >= start:
                j = before[j]
            before[i] = j
            if j >= 0:
                found[j] = found.get(j, 0) + 1
        by_count: dict[int, list[int]] = {}
        for j, count in found.items():
            by_count.setdefault(count, []).append(j)
        for count in sorted(by_count, reverse=True):
            own: dict[int, list[int]] = {}
            for j in by_count[count]:
                own.setdefault(group[j], []).append(j)
            for lifted in own.values():
                _lift(lifted, order, place, group, size)
    out, done, following = [n - 1] * n, [False] * n, list(range(n))
    done[n - 1] = True
    for k in range(n):
        j = out[k] - 1
        while j >= 0 and not done[j]:
            start = group[j]
            out[following[start]] = j
            following[start] += 1
            done[j] = True
            j = before[j]
    return out


def _lift(lifted: list[int], order: list[int], place: list[int], group: list[int], size: list[int]) -> None:
    """Move some members of one group to a new group just above the rest of it."""
    start = group[lifted[0]]
    if len(lifted) == size[start]:
        return
    last = start + size[start] - 1
    for s in lifted:
        at, other = place[s], order[last]
        order[at], order[last] = other, s
        place[other], place[s] = at, last
        last -= 1
    fresh = last + 1
    size[start] -= len(lifted)
    size[fresh] = len(lifted)
    for s in lifted:
        group[s] = fresh


def prefix_classes(symbols: np.ndarray, order: np.ndarray, lengths: tuple[int, ...]) -> list[np.ndarray]:
    """For each length a number for each position, equal where the next so many symbols are; the text must go on so far."""
    n, most = len(symbols), max(lengths)
    padded = np.concatenate((symbols, np.full(most, -1, symbols.dtype)))
    same, out = np.ones(max(n - 1, 0), bool), {}
    for j in range(most):
        same &= padded[order[1:] + j] == padded[order[:-1] + j]
        if j + 1 in lengths:
            number = np.zeros(n, np.int64)
            number[order] = np.concatenate(([0], np.cumsum(~same))) if n else 0
            out[j + 1] = number
    return [out[k] for k in lengths]
