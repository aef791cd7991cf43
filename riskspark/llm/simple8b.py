"""Simple-8b: a selector in the top four bits of a 64-bit word says how many values
of how many bits follow. Values of more than 60 bits are escapes: the word holds
their place in a separate list. Coding and decoding are numpy operations on all
words of a block, but for the walk from word to word."""

from __future__ import annotations

import numpy as np

#: Fixed values of the format: (values, bits) by selector; selector 1 is the escape.
SELECTORS = [(240, 0), (1, 0), (60, 1), (30, 2), (20, 3), (15, 4), (12, 5), (10, 6),
             (8, 7), (7, 8), (6, 10), (5, 12), (4, 15), (3, 20), (2, 30), (1, 60)]
ESCAPE = 1
COUNTS = np.array([c for c, _ in SELECTORS], np.int64)
_WIDTH16 = np.array([v.bit_length() for v in range(1 << 16)], np.uint8)
U64 = np.uint64


def _widths(values: np.ndarray) -> np.ndarray:
    if not len(values) or values.max() < 1 << 16:
        return _WIDTH16[values.astype(np.int64)]
    return np.searchsorted(U64(1) << np.arange(64, dtype=U64), values, side="right").astype(np.uint8)


def _choices(width: np.ndarray) -> np.ndarray:
    """The selector of a word that would begin at each value: the one that holds most."""
    best = np.where(width > 60, ESCAPE, 15).astype(np.uint8)
    a, below = 1, width  # the largest width among the next a values
    for selector in range(14, -1, -1):
        count, bits = SELECTORS[selector]
        if selector == ESCAPE:
            continue
        n = len(width) - count + 1
        if n <= 0:
            break
        starts = {*range(0, count - a, a), count - a}  # stretches of a values, the last may overlap
        below, a = np.maximum.reduce([below[k : k + n] for k in sorted(starts)]), count
        fits = below <= bits
        if fits.any():
            best[:n][fits] = selector
    return best


def encode(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(words, escapes) of unsigned 64-bit values."""
    values = values.astype(U64, copy=False)
    best = _choices(_widths(values))
    step, at, i, n = COUNTS.astype(np.uint8)[best].tobytes(), [], 0, len(values)
    while i < n:
        at.append(i)
        i += step[i]
    at = np.array(at, np.int64)
    chosen = best[at]
    words = chosen.astype(U64) << U64(60)
    for selector in np.unique(chosen):
        count, bits = SELECTORS[selector]
        own = np.flatnonzero(chosen == selector)
        if selector == ESCAPE:
            words[own] |= np.arange(len(own), dtype=U64)
        elif bits:
            for k in range(count):
                words[own] |= values[at[own] + k] << U64(bits * k)
    return words, values[at[chosen == ESCAPE]]


def decode(words: np.ndarray, escapes: np.ndarray) -> np.ndarray:
    chosen = (words >> U64(60)).astype(np.int64)
    ends = np.cumsum(COUNTS[chosen])
    out = np.zeros(int(ends[-1]) if len(ends) else 0, U64)
    for selector in np.unique(chosen):
        count, bits = SELECTORS[selector]
        own = np.flatnonzero(chosen == selector)
        first = ends[own] - count
        if selector == ESCAPE:
            out[first] = escapes[(words[own] & U64((1 << 60) - 1)).astype(np.int64)]
        elif bits:
            for k in range(count):
                out[first + k] = (words[own] >> U64(bits * k)) & U64((1 << bits) - 1)
    return out
