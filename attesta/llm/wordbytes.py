"""Words and word windows of many texts at once, as numpy arrays over their UTF-8 bytes.

A word is a run of ASCII letters, digits and non-ASCII characters; A-Z are lower-cased. Every byte
of a non-ASCII character is over 127, so bytes decide the same as characters.
"""

from __future__ import annotations

import numpy as np

_B = np.arange(256)
LOWER = np.where((_B >= 65) & (_B <= 90), _B + 32, _B).astype(np.uint8)
WORD = ((_B >= 48) & (_B <= 57)) | ((_B >= 65) & (_B <= 90)) | ((_B >= 97) & (_B <= 122)) | (_B >= 128)

_P = 0x9E3779B97F4A7C15 | 1
_Q = 0xC2B2AE3D27D4EB4F | 1
_M = (1 << 64) - 1
_powers: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 ... base ** (n - 1) modulo 2 ** 64."""
    have = _powers.get(base)
    if have is None or len(have) < n:
        steps = np.full(max(n, 1 << 16), base, np.uint64)
        steps[0] = 1
        _powers[base] = have = np.cumprod(steps, dtype=np.uint64)
    return have[:n]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes."""
    h = h ^ (h >> np.uint64(31))
    h = h * np.uint64(0xBF58476D1CE4E5B9)
    h ^= h >> np.uint64(27)
    h *= np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def spans_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash of values[start:end] for each span, from one running sum."""
    n = len(values)
    sums = np.empty(n + 1, np.uint64)
    sums[0] = 0
    np.cumsum(values * powers(base, n), dtype=np.uint64, out=sums[1:])
    back = powers(pow(base, -1, 1 << 64), n + 1)
    return (sums[ends] - sums[starts]) * back[starts]


class Words:
    """Spans, hashes and documents of the words in a buffer of texts laid back to back."""

    def __init__(self, data: np.ndarray, borders: np.ndarray):
        self.data, n = LOWER[data], len(data)
        is_word = WORD[data]
        first, last = is_word.copy(), is_word.copy()
        first[1:] &= ~is_word[:-1]
        last[:-1] &= ~is_word[1:]
        heads, tails = borders[:-1][borders[:-1] < borders[1:]], borders[1:][borders[:-1] < borders[1:]] - 1
        first[heads] |= is_word[heads]
        last[tails] |= is_word[tails]
        self.starts, self.ends = np.flatnonzero(first), np.flatnonzero(last) + 1
        #: Of document i the words are edges[i] : edges[i + 1].
        self.edges = np.searchsorted(self.starts, borders)
        self.hashes = mix(spans_hash(self.data.astype(np.uint64) + np.uint64(1), self.starts, self.ends, _P) + (self.ends - self.starts).astype(np.uint64)) if n else np.empty(0, np.uint64)

    def windows(self, size: int) -> tuple[np.ndarray, np.ndarray]:
        """First words and hashes of all windows of `size` words that lie in one document."""
        n = len(self.hashes) - size + 1
        if n <= 0:
            return np.empty(0, np.int64), np.empty(0, np.uint64)
        at = np.arange(n)
        hashes = mix(spans_hash(self.hashes, at, at + size, _Q))
        # A window crosses a border when the border lies within its words.
        cross = np.zeros(n + 1, np.int32)
        inner = self.edges[1:-1][(np.diff(self.edges)[1:] > 0) & (self.edges[1:-1] > 0)]
        np.add.at(cross, np.clip(inner - size + 1, 0, n), 1)
        np.add.at(cross, np.clip(inner, 0, n), -1)
        inside = np.cumsum(cross[:-1]) == 0
        return at[inside], hashes[inside]

    def text(self, first: int, size: int) -> bytes:
        """The words of a window joined by one space."""
        return b" ".join(self.data[s:e].tobytes() for s, e in zip(self.starts[first : first + size], self.ends[first : first + size], strict=True))
