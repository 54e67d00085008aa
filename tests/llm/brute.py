"""Plain versions of the operators, for small tables."""

from __future__ import annotations

from collections import defaultdict

import numpy as np


def components(nodes, links):
    """Smallest reachable node of each node."""
    root = {n: n for n in nodes}

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for a, b in links:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def shingle_set(text):
    words = (text or "").encode().lower().split()
    if len(words) < 5:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + 5]) for i in range(len(words) - 4)}


def near_duplicates(rows):
    """``doc_id -> (n_shingles, component_id)``; ids are distinct."""
    sets = {i: shingle_set(t) for i, t in rows}
    holders = defaultdict(list)
    links = []
    for i, own in sets.items():
        shared = defaultdict(int)
        for s in own:
            for j in holders[s]:
                shared[j] += 1
            holders[s].append(i)
        links += [(i, j) for j, n in shared.items() if 100 * n >= 75 * (len(own) + len(sets[j]) - n)]
    roots = components(sets, links)
    return {i: (len(s), roots[i]) for i, s in sets.items()}


def near_vectors(rows, threshold=0.98):
    """``vec_id -> (n_links, component_id)`` of ``(vec_id, embedding, label)`` rows."""
    usable = {}
    for i, v, label in rows:
        if label is None or v is None or not len(v) or any(x is None for x in v):
            continue
        v = np.array(v, float)
        if np.isfinite(v).all() and v.any():
            usable[i] = (label, v / np.sqrt((v * v).sum()))
    links = [
        (a, b)
        for a in usable
        for b in usable
        if a < b and usable[a][0] == usable[b][0] and usable[a][1] @ usable[b][1] >= threshold
    ]
    ids = [i for i, _, _ in rows]
    degree = defaultdict(int)
    for a, b in links:
        degree[a] += 1
        degree[b] += 1
    roots = components(ids, links)
    return {i: (degree[i], roots[i]) for i in ids}


def cheapest_cost(places, costs, window, free):
    """Least cost of cutting a stream, by looking at every pair of places."""
    at = [0, *places]
    best = [0.0] + [float("inf")] * len(places)
    for j in range(1, len(at)):
        for i in range(j):
            size = at[j] - at[i]
            if size <= window:
                pad = 0 if size in free else window - size
                best[j] = min(best[j], best[i] + pad + costs[j - 1])
    return best[-1]
