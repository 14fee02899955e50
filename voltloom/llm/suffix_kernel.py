"""Numpy kernels of the exact-repeat search: anchors of windows, and a hash-compared suffix sort.

Strings are hashed with polynomials modulo 2**64 over a table of random byte values: ``prefix[i]`` is the sum of
``value[s[j]] * BASE**j`` for j < i, so that two stretches are compared by cross-multiplying with powers of the base. As
such a hash can collide, all equalities it finds are verified on the bytes.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

_RNG = np.random.default_rng(20240229)
_VALUE = _RNG.integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_MIX = np.uint64(0xD6E8FEB86659FD93)


@lru_cache(maxsize=1)
def _powers(bits: int) -> tuple[np.ndarray, np.ndarray]:
    """The first 2**bits powers of the base and of its inverse modulo 2**64."""
    out = []
    for b in (int(_BASE), pow(int(_BASE), -1, 1 << 64)):
        p = np.ones(1 << bits, np.uint64)
        for k in range(bits):
            p[1 << k : 2 << k] = p[: 1 << k] * np.uint64(pow(b, 1 << k, 1 << 64))
        out.append(p)
    return out[0], out[1]


def _table(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _powers(max(20, int(n).bit_length()))


def prefix_hash(raw: np.ndarray) -> np.ndarray:
    """Polynomial hashes of all prefixes of the bytes ``raw``."""
    out = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(_VALUE[raw] * _table(len(raw))[0][: len(raw)], out=out[1:])
    return out


def _sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` neighbours, from running minima of blocks of that width."""
    n = len(x)
    pad = -n % width
    blocks = np.concatenate([x, np.full(pad, np.iinfo(x.dtype).max, x.dtype)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, 1).ravel()
    behind = np.minimum.accumulate(blocks[:, ::-1], 1)[:, ::-1].ravel()
    return np.minimum(behind[: n - width + 1], ahead[width - 1 : n])


def anchors(raw: np.ndarray, starts: np.ndarray, stops: np.ndarray, window: int, gram: int) -> tuple[np.ndarray, ...]:
    """The anchors of all windows of ``window`` bytes that lie within one of the texts raw[starts[i]:stops[i]].

    A window's anchor is the leftmost gram of ``gram`` bytes with the smallest hash in it; so equal windows have equal
    anchors at the same place. Returns for each run of neighbouring windows with one anchor: its text, the first
    window's start, the number of windows, the anchor's distance from the first start, and the gram's hash.
    """
    n = len(raw)
    empty = tuple(np.empty(0, np.int64) for _ in range(5))
    if n < window:
        return empty
    prefix, inverse = prefix_hash(raw), _table(n)[1]
    h = (prefix[gram:] - prefix[:-gram]) * inverse[: n - gram + 1]
    h ^= h >> np.uint64(32)
    h *= _MIX
    h ^= h >> np.uint64(29)
    bits = max(20, int(n).bit_length())
    keyed = (h >> np.uint64(bits)) << np.uint64(bits) | np.arange(len(h), dtype=np.uint64)
    at = (_sliding_min(keyed, window - gram + 1) & np.uint64((1 << bits) - 1)).astype(np.int64)
    counts = np.maximum(stops - starts - window + 1, 0)
    total = int(counts.sum())
    if not total:
        return empty
    text = np.repeat(np.arange(len(starts)), counts)
    first = np.repeat(starts, counts) + np.arange(total) - np.repeat(np.cumsum(counts) - counts, counts)
    at = at[first]
    change = np.flatnonzero(np.concatenate([[True], (at[1:] != at[:-1]) | (text[1:] != text[:-1])]))
    length = np.diff(np.append(change, total))
    return text[change], first[change], length, at[change] - first[change], h[at[change]].view(np.int64)


class Suffixes:
    """Suffixes of a buffer, compared on their first ``window`` bytes by prefix hashes."""

    def __init__(self, raw: np.ndarray, window: int):
        self.raw, self.window = raw, window
        self.prefix, self.power = prefix_hash(raw), _table(len(raw))[0]

    def equal(self, x: np.ndarray, y: np.ndarray, length) -> np.ndarray:
        """Whether raw[x:x+length] and raw[y:y+length] hash alike."""
        p, w = self.prefix, self.power
        return (p[x + length] - p[x]) * w[y] == (p[y + length] - p[y]) * w[x]

    def common(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Longest common extension, at most the window, by binary search over hash comparisons."""
        low, high = np.zeros(len(x), np.int64), np.full(len(x), self.window, np.int64)
        while True:
            open_ = low < high
            if not open_.any():
                return low
            mid = (low + high + 1) >> 1
            same = self.equal(x, y, mid)
            low, high = np.where(open_ & same, mid, low), np.where(open_ & ~same, mid - 1, high)

    def less(self, x: np.ndarray, y: np.ndarray) -> np.ndarray:
        """Whether suffix x sorts before suffix y on the window; a logarithmic number of hash comparisons."""
        k = self.common(x, y)
        short = k < self.window
        if (self.raw[(x + k)[short]] == self.raw[(y + k)[short]]).any():
            raise HashCollision
        out = np.zeros(len(x), bool)
        out[short] = self.raw[(x + k)[short]] < self.raw[(y + k)[short]]
        return out


class HashCollision(Exception):
    """Bytes contradict their hashes."""


def merge_sort(suffixes: Suffixes, at: np.ndarray, first: np.ndarray, size: np.ndarray) -> np.ndarray:
    """Sort each set of suffixes ``at[first[i]:first[i]+size[i]]``; all sets go through the levels together.

    A bottom-up mergesort: the place of an element after a merge is its place in its own run plus the elements of the
    neighbouring run that sort before it, found by binary search.
    """
    at = at.copy()
    run = 1
    while True:
        live = size > run
        if not live.any():
            return at
        n = size[live]
        total = int(n.sum())
        base = np.repeat(first[live], n)
        place = np.arange(total) - np.repeat(np.cumsum(n) - n, n)
        size_of = np.repeat(n, n)
        own, other = place // run * run, (place // run ^ 1) * run
        width = np.clip(size_of - other, 0, run)
        left = own < other
        x = at[base + place]
        low, high = np.zeros(total, np.int64), width.copy()
        todo = np.flatnonzero(low < high)
        while len(todo):
            mid = (low[todo] + high[todo]) >> 1
            y = at[base[todo] + other[todo] + mid]
            # an element of the left run goes before equal ones of the right run
            a, b = np.where(left[todo], y, x[todo]), np.where(left[todo], x[todo], y)
            less = suffixes.less(a, b)
            before = np.where(left[todo], less, ~less)  # whether y goes before x
            low[todo], high[todo] = np.where(before, mid + 1, low[todo]), np.where(before, high[todo], mid)
            todo = todo[low[todo] < high[todo]]
        at[base + np.minimum(own, other) + place - own + low] = x
        run *= 2


def repeated_windows(pieces: list[bytes], group: np.ndarray, shift: np.ndarray, count: np.ndarray, window: int) -> list[np.ndarray]:
    """Windows that occur in two pieces of a group at the same distance from the anchor.

    Piece ``i`` holds ``count[i]`` windows; ``shift[i]`` is the anchor's distance from its first window. Returns, for
    each piece, whether each of its windows is repeated.
    """
    raw = np.frombuffer(b"".join(pieces), np.uint8)
    length = np.array([len(p) for p in pieces], np.int64)
    begin = np.cumsum(length) - length
    ends = np.cumsum(count)
    piece = np.repeat(np.arange(len(pieces)), count)
    offset = np.arange(int(ends[-1])) - np.repeat(ends - count, count)
    at = begin[piece] + offset
    # a set: the windows of one group with one distance
    distance = shift[piece] - offset
    order = np.lexsort((distance, group[piece]))
    g, d = group[piece][order], distance[order]
    edge = np.concatenate([[True], (g[1:] != g[:-1]) | (d[1:] != d[:-1])])
    first = np.flatnonzero(edge)
    size = np.diff(np.append(first, len(order)))
    start_to_slot = np.empty(len(raw) + 1, np.int64)
    start_to_slot[at] = np.arange(len(at))
    suffixes = Suffixes(raw, window)
    try:
        wide = size > 2
        sorted_at = merge_sort(suffixes, at[order], first[wide], size[wide])
        mates = np.flatnonzero(~edge[1:])  # neighbours in a set
        x, y = sorted_at[mates], sorted_at[mates + 1]
        same = suffixes.equal(x, y, window)
        x, y = x[same], y[same]
        _verify(raw, x, y, window)
        flag = np.zeros(len(at), bool)
        flag[start_to_slot[x]] = True
        flag[start_to_slot[y]] = True
    except HashCollision:
        flag = _by_bytes(raw.tobytes(), at, order, edge, window)
    return np.split(flag, ends[:-1])


def _verify(raw: np.ndarray, x: np.ndarray, y: np.ndarray, window: int) -> None:
    """Compare the bytes of all pairs; neighbouring pairs (x, y), (x + 1, y + 1), ... are one longer stretch."""
    if not len(x):
        return
    low, high = np.minimum(x, y), np.maximum(x, y)
    order = np.lexsort((low, high - low))
    low, gap = low[order], (high - low)[order]
    new = np.flatnonzero(np.concatenate([[True], (gap[1:] != gap[:-1]) | (low[1:] > low[:-1] + 1)]))
    last = np.append(new[1:], len(low)) - 1
    view = memoryview(raw)
    for a, b, k in zip(low[new].tolist(), low[last].tolist(), gap[new].tolist(), strict=True):
        if view[a : b + window] != view[a + k : b + k + window]:
            raise HashCollision


def _by_bytes(raw: bytes, at: np.ndarray, order: np.ndarray, edge: np.ndarray, window: int) -> np.ndarray:
    """The same result from the bytes alone, for buffers in which a hash collided."""
    flag = np.zeros(len(at), bool)
    for slots in np.split(order, np.flatnonzero(edge)[1:]):
        seen: dict[bytes, int] = {}
        for s in slots.tolist():
            w = raw[at[s] : at[s] + window]
            if w in seen:
                flag[s] = flag[seen[w]] = True
            seen.setdefault(w, s)
    return flag
