"""Words of many texts as 64-bit hashes, in whole-array steps."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_SPACES = bytes([0x20, *range(0x09, 0x0E)])
_UPPER = bytes(range(0x41, 0x5B))

# Byte maps: white space to a space, and A-Z to lower case as well.
SPACED = bytes.maketrans(_SPACES, b" " * len(_SPACES))
SPACED_LOWER = bytes.maketrans(_SPACES + _UPPER, b" " * len(_SPACES) + _UPPER.lower())

_ODD = 0x9E3779B97F4A7C15
_BASE = 0xD6E8FEB86659FD93
_INVERSE = pow(_BASE, -1, 1 << 64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values (multiply and shift, three times)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))


def powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


class Powers:
    """Powers of the polynomial's base and of its inverse, grown as longer arrays come."""

    def __init__(self):
        self.up = self.down = np.ones(0, np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            self.up, self.down = powers(_BASE, 2 * n), powers(_INVERSE, 2 * n)
        return self.up[:n], self.down[:n]


@dataclass
class Words:
    """Words of texts in order: hash, number of the text; text i has words bounds[i]:bounds[i+1]."""

    hash: np.ndarray
    text: np.ndarray
    bounds: np.ndarray
    data: np.ndarray  # bytes of all texts after the byte map, a space after each
    offsets: np.ndarray  # text i has bytes offsets[i] : offsets[i + 1] - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)


def hash_words(texts: list[bytes | None], fold: bytes, cache: Powers) -> Words:
    """Hashes of the words left when ``fold`` has mapped separators to spaces."""
    lengths = np.fromiter((len(t) + 1 if t else 1 for t in texts), np.int64, len(texts))
    offsets = np.concatenate([[0], np.cumsum(lengths)])
    joined = b"".join(part for t in texts for part in (t or b"", b" "))
    data = np.frombuffer(joined.translate(fold), np.uint8)
    inside = data != 0x20
    edges = np.flatnonzero(np.diff(np.concatenate([[0], inside.view(np.int8)])))
    starts, ends = edges[::2], edges[1::2]
    up, down = cache.upto(len(data) + 1)
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(BYTE_VALUES[data] * up[: len(data)], out=sums[1:])
    hashes = (sums[ends] - sums[starts]) * down[starts]
    hashes = mix(hashes + (ends - starts).astype(np.uint64) * np.uint64(_ODD))
    bounds = np.searchsorted(starts, offsets)
    text = np.repeat(np.arange(len(texts)), np.diff(bounds))
    return Words(hashes, text, bounds, data, offsets)


def windows(words: Words, n: int) -> tuple[np.ndarray, np.ndarray]:
    """(first words, hashes) of all runs of ``n`` words that lie within one text."""
    count = len(words.hash)
    if count < n:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    total = np.zeros(count - n + 1, np.uint64)
    for k in range(n):
        total = mix(total + words.hash[k : count - n + 1 + k] + np.uint64(k + 1))
    first = np.flatnonzero(words.text[: count - n + 1] == words.text[n - 1 :])
    return first, total[first]


def per_text(flags: np.ndarray, words: Words) -> np.ndarray:
    """Number of set flags (one per byte of ``data``) in each text."""
    sums = np.concatenate([[0], np.cumsum(flags, dtype=np.int64)])
    return sums[words.offsets[1:] - 1] - sums[words.offsets[:-1]]
