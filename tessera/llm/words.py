"""Vectorised word and shingle hashes over many texts at once.

A word is a maximal run of bytes that are not ASCII white space.  Word hashes
come from one prefix sum: with S[i] the sum of value(byte j) * P^j for j < i,
the word [a, b) has hash (S[b] - S[a]) * P^-a, all modulo 2^64, then mixed.
"""

from __future__ import annotations

import numpy as np

P = 0x9E3779B97F4A7C55 | 1
P_INV = pow(P, -1, 1 << 64)
MASK = (1 << 64) - 1
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
#: A 64-bit value for each byte.
VALUE = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """The splitmix64 finaliser on every element."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _power(n: int, base: int, name: str) -> np.ndarray:
    have = _powers.get(name)
    if have is None or len(have) < n:
        size = max(n, 1 << 16)
        have = np.full(size, base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if size <= 1 << 23:  # longer ones are made anew, not kept
            _powers[name] = have
    return have[:n]


class Words:
    """The words of several texts: byte ranges, hashes, owners."""

    def __init__(self, texts: list[str], space: np.ndarray = SPACE):
        raw = [t.encode("utf-8", "surrogatepass") for t in texts]
        data = np.frombuffer(b"\n".join(raw) + b"\n", np.uint8)
        edge = np.flatnonzero(np.diff(space[data], prepend=True))
        self.starts, self.ends = edge[0::2], edge[1::2]  # data ends in white space, so they pair up
        self.data = data
        self.sums = np.empty(len(data) + 1, np.uint64)
        self.sums[0] = 0
        np.cumsum(VALUE[data] * _power(len(data), P, "p"), out=self.sums[1:])
        self.scale = _power(len(data), P_INV, "inverse")[self.starts]
        bounds = np.cumsum([len(r) + 1 for r in raw])
        self.counts = np.diff(np.searchsorted(self.starts, bounds), prepend=0)
        self.owner = np.repeat(np.arange(len(texts)), self.counts)

    def hashes(self, bytes_most: int | None = None) -> np.ndarray:
        """Hash of each word, or of its first bytes."""
        ends = self.ends if bytes_most is None else np.minimum(self.ends, self.starts + bytes_most)
        h = (self.sums[ends] - self.sums[self.starts]) * self.scale
        return mix(h + (ends - self.starts).astype(np.uint64))


def word_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(hash of each word, number of words per text, line breaks before each word).

    The third array counts from the first text on; it only serves to tell
    whether two words of a text share a line.
    """
    words = Words(texts)
    lines = np.searchsorted(np.flatnonzero(words.data == 10), words.starts)
    return words.hashes(), words.counts, lines


def shingles(h: np.ndarray, counts: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(hash of each k-word shingle in order, number of shingles per text).

    A text of 1 to k-1 words has one shingle, all its words; one without a
    word has none.
    """
    n = len(h)
    if not n:
        return np.zeros(0, np.uint64), np.zeros(len(counts), np.int64)
    owner = np.repeat(np.arange(len(counts)), counts)
    ends = np.cumsum(counts)
    first = ends - counts
    total = np.zeros(n, np.uint64)
    padded = np.concatenate([h, np.zeros(k, np.uint64)])
    at = np.arange(n)
    left = ends[owner] - at  # words from here to the text's end
    for j in range(k):
        part = padded[j : j + n] * np.uint64(pow(P, 2 * j + 1, 1 << 64))
        total += np.where(left > j, part, np.uint64(0))
    whole = (left >= k) | (at == first[owner])
    out = mix(total[whole])
    return out, np.bincount(owner[whole], minlength=len(counts))
