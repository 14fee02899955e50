"""Complete-linkage clustering of a distance matrix."""

from __future__ import annotations

import numpy as np


def complete_linkage(distance: np.ndarray) -> np.ndarray:
    """Complete linkage by chains of nearest neighbours, in quadratic time.

    A chain goes from a cluster to its nearest one until two are each other's nearest; these merge, as no later merge can
    come between them. Of equally near clusters the one before in the chain is taken, else the one with the smallest leaf number
    of those that hold places in the matrix. Returns a row for each merge by rising height, as (left, right, height, size)
    with left < right; leaves are 0 to n - 1 and merge i makes cluster n + i.
    """
    n = len(distance)
    d = np.array(distance, float)
    np.fill_diagonal(d, np.inf)
    chain: list[int] = []
    gone = np.zeros(n, bool)
    merges = []
    for _ in range(n - 1):
        if not chain:
            chain.append(int(np.argmin(gone)))
        while True:
            i = chain[-1]
            j = int(d[i].argmin())
            if len(chain) > 1 and d[i, chain[-2]] <= d[i, j]:
                j = chain[-2]
                break
            chain.append(j)
        del chain[-2:]
        a, b = sorted((i, j))
        merges.append((d[a, b], a, b))
        far = np.maximum(d[a], d[b])
        far[a] = np.inf
        d[a], d[:, a] = far, far
        d[b], d[:, b] = np.inf, np.inf
        gone[b] = True
    name, size = list(range(n)), [1] * n
    out = np.empty((len(merges), 4))
    for k, (height, a, b) in enumerate(sorted(merges, key=lambda m: m[0])):  # stable: parts of a merge come before it
        x, y = sorted((name[a], name[b]))
        size[a] += size[b]
        name[a] = n + k
        out[k] = x, y, height, size[a]
    return out


def leaves_of(linkage: np.ndarray) -> list[list[int]]:
    """The leaves of every cluster, leaves first, left before right."""
    n = len(linkage) + 1
    out = [[i] for i in range(n)]
    for a, b, *_ in linkage:
        out.append(out[int(a)] + out[int(b)])
    return out


def cut(linkage: np.ndarray, k: int) -> list[list[int]]:
    """At most k clusters: the top merges undone, as long as equal heights allow exactly that many. In order of traversal."""
    n = len(linkage) + 1
    heights = linkage[:, 2] if n > 1 else np.empty(0)
    # the smallest height at which at most k clusters are left
    limit = next((h for h in np.unique(heights) if n - (heights <= h).sum() <= k), np.inf) if n > k else -np.inf
    members = leaves_of(linkage)

    def walk(c: int) -> list[list[int]]:
        if c < n or linkage[c - n, 2] <= limit:
            return [members[c]]
        return walk(int(linkage[c - n, 0])) + walk(int(linkage[c - n, 1]))

    return walk(2 * n - 2) if n else []


def average_ranks(x: np.ndarray) -> np.ndarray:
    """Ranks of each column from 1; equal values share the mean rank."""
    out = np.empty(x.shape)
    for j, column in enumerate(x.T):
        _, inverse, counts = np.unique(column, return_inverse=True, return_counts=True)
        last = np.cumsum(counts)
        out[:, j] = (last - (counts - 1) / 2)[inverse]
    return out


def spearman_distance(x: np.ndarray) -> np.ndarray:
    """1 minus the rank correlation of columns."""
    r = average_ranks(x)
    r -= r.mean(0)
    norm = np.sqrt((r * r).sum(0))
    norm[norm == 0] = np.nan
    c = (r.T @ r) / norm[:, None] / norm[None, :]
    out = 1 - np.clip(np.nan_to_num(c, nan=0.0), -1, 1)
    np.fill_diagonal(out, 0)
    return out
