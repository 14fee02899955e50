"""Weighted word shingles of many texts at once, in numpy."""

from __future__ import annotations

import numpy as np

from .suffix_kernel import _table, prefix_hash

#: Fixed odd multipliers that set the places of a shingle's words apart.
_PLACES = np.random.default_rng(511).integers(1, 1 << 62, 16, dtype=np.uint64) * np.uint64(2) + np.uint64(1)


def mix(x: np.ndarray) -> np.ndarray:
    """Finalise 64-bit hashes."""
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0x7FB5D329728EA185)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x81DADEF4BC2DD44D)
    return x ^ (x >> np.uint64(33))


def shingles(texts: list[str | None], words: int = 5) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text with their counts.

    Words are lower-cased and parted by white space. A text of fewer words has one shingle, of all of them; a text
    without words has none. Returns text numbers (ascending), 64-bit hashes (ascending in a text) and counts.
    """
    rows = [(t or "").lower().split() for t in texts]
    counts = np.array([len(r) for r in rows], np.int64)
    total = int(counts.sum())
    if not total:
        return np.empty(0, np.int64), np.empty(0, np.uint64), np.empty(0, np.int64)
    raw = np.frombuffer((" ".join(" ".join(r) for r in rows if r) + " ").encode("utf-8", "surrogatepass"), np.uint8)
    stops = np.flatnonzero(raw == 32)
    starts = np.concatenate([[0], stops[:-1] + 1])
    prefix, inverse = prefix_hash(raw), _table(len(raw))[1]
    word = mix((prefix[stops] - prefix[starts]) * inverse[starts])
    text = np.repeat(np.arange(len(rows)), counts)
    first = np.repeat(np.cumsum(counts) - counts, counts)
    own = np.repeat(np.maximum(counts - words + 1, 1), counts)
    at = np.flatnonzero(np.arange(total) - first < own)  # where a shingle begins
    h = np.zeros(len(at), np.uint64)
    end = first[at] + np.repeat(counts, counts)[at]
    for k in range(words):
        ok = at + k < end
        h[ok] += (word[at[ok] + k] + np.uint64(k + 1)) * _PLACES[k]
    h = mix(h)
    text = text[at]
    order = np.lexsort((h, text))
    text, h = text[order], h[order]
    new = np.flatnonzero(np.concatenate([[True], (text[1:] != text[:-1]) | (h[1:] != h[:-1])]))
    return text[new], h[new], np.diff(np.append(new, len(h)))
