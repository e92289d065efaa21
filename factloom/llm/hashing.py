"""Vectorised hashing of bytes and words in numpy; equal on every machine and in every process."""

from __future__ import annotations

import numpy as np

BASE = np.uint64(0xD1342543DE82EF95)
ODD = np.uint64(0x9E3779B97F4A7C15)


def mixed(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and shift)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


#: A random-looking 64-bit value for each byte.
BYTES = mixed(np.arange(1, 257, dtype=np.uint64) * ODD)


def ordered(x: np.ndarray) -> np.ndarray:
    """np.argsort(x, kind="stable") of whole numbers from 0, by sorting single numbers that carry their places in their low bits."""
    n, x = len(x), x.astype(np.uint64)
    bits = np.uint64(n.bit_length())
    low, places = (np.uint64(1) << bits) - np.uint64(1), np.arange(n, dtype=np.uint64)
    if not n or x.max() >> (np.uint64(64) - bits) == 0:
        return (np.sort(x << bits | places) & low).astype(np.int64)
    top = np.sort(x & ~low | places)
    order = (top & low).astype(np.int64)
    same, x_sorted = top[1:] >> bits == top[:-1] >> bits, x.take(order)
    return np.argsort(x, kind="stable") if (x_sorted[1:] != x_sorted[:-1])[same].any() else order


def distinct(x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """np.unique(x, return_index=True, return_inverse=True) of whole numbers from 0."""
    order = ordered(x)
    x_sorted = x.take(order)
    new = np.append(True, x_sorted[1:] != x_sorted[:-1])[: len(x)]
    inverse = np.empty(len(x), np.int64)
    inverse[order] = np.cumsum(new) - 1
    return x_sorted[new], order[new], inverse


class Powers:
    """Powers of the base and of its inverse, modulo 2**64, as far as needed."""

    def __init__(self) -> None:
        self.up = self.down = np.ones(1, np.uint64)

    def to(self, n: int) -> Powers:
        if len(self.up) < n:
            inverse = np.uint64(pow(int(BASE), -1, 1 << 64))
            n = max(n, 1 << 16)
            self.up, self.down = (np.multiply.accumulate(np.concatenate([np.ones(1, np.uint64), np.full(n, b, np.uint64)])) for b in (BASE, inverse))
        return self


powers = Powers()


def masses(data: np.ndarray) -> np.ndarray:
    """Prefix sums of the bytes' polynomial; spans() turns them into hashes of substrings."""
    mass = np.empty(len(data) + 1, np.uint64)
    mass[0] = 0
    np.cumsum(BYTES[data] * powers.to(len(data) + 1).up[: len(data)], out=mass[1:])
    return mass


def spans(mass: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Hashes of the substrings [starts, ends); equal for equal substrings."""
    return mixed((mass[ends] - mass[starts]) * powers.down[starts])


#: Bytes between words: white space, or everything in ASCII but letters and digits.
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
PUNCTUATION = np.array([i < 128 and not chr(i).isalnum() for i in range(256)])


def words(texts: list[str], between: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words of the lower-cased texts, and where each text's begin (one more entry than texts)."""
    parts = [t.lower().encode("utf-8", "replace") for t in texts]
    data = np.frombuffer(b"\n".join([*parts, b""]) or b"\n", np.uint8)
    edges = np.cumsum([0] + [len(p) + 1 for p in parts])
    space = between[data]
    begin = ~space
    begin[1:] &= space[:-1]
    end = space.copy()
    end[1:] &= ~space[:-1]
    end[0] = False
    starts, ends = np.flatnonzero(begin), np.flatnonzero(end)
    return spans(masses(data), starts, ends), np.searchsorted(starts, edges)


def shingles(texts: list[str], size: int = 5) -> list[np.ndarray]:
    """Sorted distinct hashes of each text's runs of `size` words; a shorter text has one, an empty one none."""
    hashes, edges = words(texts)
    n = len(hashes) - size + 1
    if n > 0:
        rolled = np.zeros(n, np.uint64)
        for j in range(size):
            rolled = rolled * BASE + hashes[j : j + n]
        rolled = mixed(rolled)
    out = []
    for a, b in zip(edges[:-1], edges[1:], strict=True):
        if b - a >= size:
            out.append(np.unique(rolled[a : b - size + 1]))
        elif b > a:
            short = np.array([b - a], np.uint64)
            for h in hashes[a:b]:
                short = mixed(short * BASE + h)
            out.append(short)
        else:
            out.append(np.zeros(0, np.uint64))
    return out
