"""Hashed word shingles of a text as a sorted array, in numpy."""

from __future__ import annotations

import numpy as np

_A, _B, _C = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))
_P = np.uint64(6364136223846793005)
_P_INVERSE = np.uint64(pow(int(_P), -1, 2**64))
_BYTE = np.random.default_rng(20240601).integers(1, 2**63, 256, dtype=np.uint64)
_BLANK = np.zeros(256, dtype=bool)
_BLANK[[9, 10, 11, 12, 13, 32]] = True


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _B
    h = (h ^ (h >> np.uint64(27))) * _C
    return h ^ (h >> np.uint64(31))


class Powers:
    """Powers of an odd number and of its inverse modulo 2**64, grown on demand."""

    def __init__(self):
        self.up = self.down = np.ones(1, dtype=np.uint64)

    def __call__(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            size = max(n, 2 * len(self.up))
            self.up, self.down = (
                np.concatenate([[np.uint64(1)], np.multiply.accumulate(np.full(size, p))])
                for p in (_P, _P_INVERSE))
        return self.up, self.down


_powers = Powers()


def _parted(text: str | None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Starts and ends of the words (A-Z lower-cased), sums of the bytes times powers, inverse powers."""
    data = np.frombuffer((text or "").encode("utf-8", "surrogatepass").lower(), dtype=np.uint8)
    n = len(data)
    inside = np.zeros(n + 2, dtype=np.int8)
    inside[1:-1] = ~_BLANK[data]
    edges = np.flatnonzero(np.diff(inside))
    up, down = _powers(n + 1)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(_BYTE[data] * up[:n], out=total[1:])
    return edges[0::2], edges[1::2], total, down


def word_hashes(text: str | None) -> np.ndarray:
    """A 64-bit hash for each word of the text, A-Z lower-cased, in text order."""
    start, end, total, down = _parted(text)
    return mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))


def start_hashes(text: str | None, lengths: tuple[int, ...]) -> np.ndarray:
    """Hashes of all words and of their first bytes, `lengths` of them where a word is longer."""
    start, end, total, down = _parted(text)
    out = [mix((total[end] - total[start]) * down[start])]
    for n in lengths:
        a = start[end - start > n]
        out.append(mix((total[a + n] - total[a]) * down[a] + np.uint64(n)))
    return np.concatenate(out)


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """The distinct shingles of `size` words, sorted; shorter texts are one shingle, texts
    without words the empty set."""
    h = word_hashes(text)
    n = len(h)
    if not n:
        return h
    width = min(n, size)
    s = h[: n - width + 1] + np.uint64(n if n < size else 0)
    for i in range(1, width):
        s = mix(s * _A) + h[i : n - width + 1 + i]
    s = np.sort(mix(s))
    return s[np.concatenate([[True], s[1:] != s[:-1]])]
