"""Suffix arrays by the difference-cover algorithm, in numpy.

Suffixes at places 1 and 2 modulo 3 are sorted by their triples; while triples repeat,
the array of their names is sorted by the same algorithm.  The remaining suffixes are
sorted by their first symbol and the rank of the sampled suffix after it, and the two
orders are merged.
"""

from __future__ import annotations

import math

import numpy as np


def _packed(columns: tuple[np.ndarray, ...]) -> np.ndarray | None:
    """The rows as single numbers in the same order; None if they do not fit 63 bits."""
    tops = [int(c.max(initial=0)) + 1 for c in columns]
    if math.prod(tops) >= 1 << 63:
        return None
    key = columns[0]
    for c, top in zip(columns[1:], tops[1:], strict=True):
        key = key * top + c
    return key


def _named(*columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rows' order, and each row's name: equal for equal rows, rising with the order, from 1."""
    key = _packed(columns)
    order = np.lexsort(columns[::-1]) if key is None else np.argsort(key)
    new = np.ones(len(order), bool)
    if len(order):
        new[1:] = np.any([c[order][1:] != c[order][:-1] for c in (columns if key is None else (key,))], axis=0)
    names = np.empty(len(order), np.int64)
    names[order] = np.cumsum(new)
    return order, names


def suffix_array(symbols: np.ndarray) -> np.ndarray:
    """The starts of the suffixes in order; symbols are integers of at least 1."""
    n = len(symbols)
    if n < 8:
        return np.array(sorted(range(n), key=lambda i: symbols[i:].tolist()), dtype=np.int64)
    t = np.concatenate([symbols.astype(np.int64), np.zeros(3, np.int64)])
    one, two = np.arange(1, n + (n % 3 == 1), 3), np.arange(2, n, 3)
    sample = np.concatenate([one, two])
    order, names = _named(t[sample], t[sample + 1], t[sample + 2])
    if len(names) and names.max() < len(names):
        order = suffix_array(names)
    ranked = sample[order]
    rank = np.zeros(n + 3, np.int64)
    rank[ranked] = np.arange(1, len(ranked) + 1)
    ranked = ranked[ranked < n]
    rest = np.arange(0, n, 3)
    width = n + 4
    rest = rest[np.argsort(t[rest] * width + rank[rest + 1])]
    first, second = ranked[ranked % 3 == 1], ranked[ranked % 3 == 2]
    place = np.arange(len(rest)) + np.searchsorted(t[first] * width + rank[first + 1], t[rest] * width + rank[rest + 1])
    both = np.concatenate([rest, second])
    pair = _packed((t[both], t[both + 1]))
    if pair is None or (int(pair.max(initial=0)) + 1) * width >= 1 << 63:
        _, pair = _named(t[both], t[both + 1])
    place += np.searchsorted(pair[len(rest) :] * width + rank[second + 2], pair[: len(rest)] * width + rank[rest + 2])
    out = np.empty(n, np.int64)
    taken = np.zeros(n, bool)
    taken[place] = True
    out[place] = rest
    out[~taken] = ranked
    return out


def repeated_windows(text: np.ndarray, starts: np.ndarray, length: int, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Which of the windows text[s : s + length] are equal.

    ends: where the separate strings of the text end; windows lie within one string.
    Returns the windows (as places in starts) in suffix order and the number of each one's group.
    """
    symbols = text.astype(np.int64) + 2
    breaks = np.zeros(len(text) + len(ends), bool)
    breaks[ends + np.arange(len(ends))] = True
    spaced = np.ones(len(breaks), np.int64)
    spaced[~breaks] = symbols
    moved = starts + np.searchsorted(ends, starts, side="right")
    wanted = np.full(len(spaced), -1, np.int64)
    wanted[moved] = np.arange(len(starts))
    order = wanted[suffix_array(spaced)]
    order = order[order >= 0]
    views = np.lib.stride_tricks.sliding_window_view(text, length)
    new = np.ones(len(order), bool)
    for i in range(1, len(order), 65536):
        j = min(len(order), i + 65536)
        new[i:j] = (views[starts[order[i:j]]] != views[starts[order[i - 1 : j - 1]]]).any(axis=1)
    return order, np.cumsum(new)
