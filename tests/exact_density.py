"""Density clusters of a few points with all distances, to hold the distributed ones against."""

import numpy as np


def density_cluster(points: np.ndarray, min_cluster_size: int = 15, min_samples: int | None = None) -> np.ndarray:
    """HDBSCAN labels of a small set of points: mutual reachability, minimum spanning tree, condensed tree, stability.

    Exact and quadratic in memory; meant for one group of bounded size, larger corpora use cluster_kmeans.
    """
    n = len(points)
    if n < 2 * min_cluster_size:
        return np.full(n, -1)
    k = min(min_samples or min_cluster_size, n - 1)
    square = (points**2).sum(1)
    distance = np.sqrt(np.maximum(square[:, None] + square[None] - 2 * points @ points.T, 0))
    core = np.partition(distance, k, axis=1)[:, k]
    reach = np.maximum(distance, np.maximum(core[:, None], core[None]))
    inside, best, source = np.zeros(n, bool), np.full(n, np.inf), np.zeros(n, int)
    edges, at = [], 0
    for _ in range(n - 1):
        inside[at] = True
        closer = (reach[at] < best) & ~inside
        best[closer], source[closer] = reach[at][closer], at
        best[inside] = np.inf
        at = int(best.argmin())
        edges.append((best[at], int(source[at]), at))
    edges.sort()
    node, members = list(range(n)), {i: 1 for i in range(n)}

    def root(i: int) -> int:
        while node[i] != i:
            node[i] = node[node[i]]
            i = node[i]
        return i

    children: dict[int, tuple[int, int, float]] = {}
    for d, a, b in edges:
        ra, rb = root(a), root(b)
        node.append(len(node))
        node[ra] = node[rb] = len(node) - 1
        children[len(node) - 1] = (ra, rb, d)
        members[len(node) - 1] = members[ra] + members[rb]
    stability, kids, births, points_of = {}, {}, {}, {}

    def grow(top: int, birth: float) -> None:
        stack = [(top, birth)]
        while stack:
            start, born = stack.pop()
            births[start], kids[start], points_of[start], total, i = born, [], _leaves(children, start, n), 0.0, start
            while i >= n:
                a, b, d = children[i]
                lam = 1 / max(d, 1e-12)
                big = [c for c in (a, b) if members[c] >= min_cluster_size]
                if len(big) == 2:
                    total += members[i] * (lam - born)
                    kids[start] = [a, b]
                    stack += [(a, lam), (b, lam)]
                    break
                if not big:
                    total += members[i] * (lam - born)
                    break
                total += (members[i] - members[big[0]]) * (lam - born)
                i = big[0]
            stability[start] = total

    grow(len(node) - 1, 0.0)
    chosen: dict[int, bool] = {}
    for c in sorted(stability, key=lambda c: members[c]):
        below = sum(stability[x] for x in kids[c])
        if kids[c] and (below > stability[c] or c == len(node) - 1):
            stability[c], chosen[c] = below, False
        else:
            chosen[c] = c != len(node) - 1 or not kids[c]
    label = np.full(n, -1)
    number, stack = 0, [len(node) - 1]
    while stack:
        c = stack.pop()
        if chosen[c]:
            label[points_of[c]] = number
            number += 1
        else:
            stack += kids[c][::-1]
    return label


def _leaves(children: dict, top: int, n: int) -> list[int]:
    out, stack = [], [top]
    while stack:
        i = stack.pop()
        if i < n:
            out.append(i)
        else:
            stack += children[i][:2]
    return out
