"""Vectorised text kernels: words, lines and shingles of many texts at once.

Texts are lower-cased and laid end to end as UTF-8 bytes, each followed by a
newline. A word is a maximal run of ASCII letters, digits and bytes above 0x7F.
Word hashes are polynomial hashes modulo 2**64 read off one prefix sum.
"""

from __future__ import annotations

from functools import cached_property

import numpy as np

_ASCII_WORD = np.zeros(256, bool)
_ASCII_WORD[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_P = np.uint64(0x9E3779B97F4A7C15 | 1)
_PINV = np.uint64(pow(int(_P), -1, 2**64))
_powers: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit moves every output bit."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def _pow(base: np.uint64, n: int) -> np.ndarray:
    key = str(base)
    have = _powers.get(key)
    if have is None or len(have) < n:
        out = np.full(max(n, 1 << 16), base, np.uint64)
        out[0] = 1
        have = _powers[key] = np.cumprod(out, dtype=np.uint64)
    return have[:n]


def inner_bytes(raw: np.ndarray) -> np.ndarray:
    """Places of the bytes 0x80 to 0xBF, which continue a code point."""
    return np.flatnonzero(raw.view(np.int8) < -64)


def forget() -> None:
    """Drop the tables of powers."""
    _powers.clear()


class Words:
    """Words of a chunk of texts: byte starts and ends, hash, index of the text."""

    def __init__(self, texts: list[str], lower: bool = True, ascii_lower: bool = False):
        raws = [(t.lower() if lower else t).encode("utf-8", "surrogatepass") for t in texts]
        self.sizes = np.array([len(r) + 1 for r in raws], np.int64)
        self.bounds = np.concatenate(([0], np.cumsum(self.sizes)))
        self.bytes = np.frombuffer(b"\n".join(raws) + b"\n" if raws else b"", np.uint8)
        if ascii_lower:  # keeps every offset
            self.bytes = _LOWER[self.bytes]
        n = len(self.bytes)
        isw = _ASCII_WORD[self.bytes]
        flips = np.flatnonzero(isw[1:] != isw[:-1]) + 1  # the last byte is a newline, so every word ends
        if isw[:1].any():
            flips = np.concatenate(([0], flips))
        self.starts, self.ends = flips[::2].copy(), flips[1::2].copy()
        total = np.zeros(n + 1, np.uint64)
        weighted = total[1:]
        np.add(self.bytes, np.uint64(1), out=weighted)
        weighted *= _pow(_P, n)
        np.cumsum(weighted, out=weighted)
        self.total = total

    @cached_property
    def inner(self) -> np.ndarray:
        return inner_bytes(self.bytes)

    def letters(self, at: np.ndarray) -> np.ndarray:
        """How many code points begin before each byte place."""
        return at - np.searchsorted(self.inner, at)

    @cached_property
    def hash(self) -> np.ndarray:
        return self.span_hash(self.starts, self.ends)

    @cached_property
    def doc(self) -> np.ndarray:
        return np.searchsorted(self.bounds, self.starts, "right") - 1

    @cached_property
    def first(self) -> np.ndarray:
        """Where each text's words begin; one more than there are texts."""
        return np.searchsorted(self.starts, self.bounds)

    def span_hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """Hashes of byte spans: equal bytes give equal hashes, wherever they stand."""
        if not len(starts):
            return np.zeros(0, np.uint64)
        inverse = _pow(_PINV, len(self.bytes) + 1)
        return mix((self.total[ends] - self.total[starts]) * inverse[starts] + (ends - starts).astype(np.uint64))


def min_hashes(values: np.ndarray, cut: np.ndarray, count: int) -> np.ndarray:
    """(count, sets): minima of ``count`` 32-bit hash functions over each set.

    Set i is values[cut[i]:cut[i+1]]; none may be empty.
    """
    base = (mix(values) >> np.uint64(32)).astype(np.uint32)
    seeds = mix(np.arange(1, 2 * count + 1, dtype=np.uint64)).astype(np.uint32)
    out, h = np.empty((count, len(cut) - 1), np.uint32), np.empty_like(base)
    for j in range(count if len(cut) > 1 else 0):
        np.bitwise_xor(base, seeds[2 * j], out=h)
        np.multiply(h, seeds[2 * j + 1] | np.uint32(1), out=h)
        np.minimum.reduceat(h, cut[:-1], out=out[j])
    return out


def band_keys(minima: np.ndarray, rows: int) -> np.ndarray:
    """(sets, bands) 64-bit keys, each of ``rows`` minima in a row."""
    bands = len(minima) // rows
    out = np.empty((minima.shape[1], bands), np.uint64)
    for b in range(bands):
        key = np.full(minima.shape[1], b + 1, np.uint64)
        for r in range(rows):
            key = key * np.uint64(0x100000001B3) + minima[b * rows + r]
        out[:, b] = mix(key)
    return out


def shingles(hashes: np.ndarray, k: int) -> np.ndarray:
    """Hash of each k words in a row; n-k+1 of them (none if there are fewer words)."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.zeros(n, np.uint64)
    for j in range(k):
        out = out * np.uint64(0x100000001B3) + hashes[j : j + n]
    return mix(out)


def jaccard(a: np.ndarray, b: np.ndarray) -> float:
    """Of two sorted arrays of distinct values; 1.0 if both are empty."""
    if not len(a) and not len(b):
        return 1.0
    both = len(np.intersect1d(a, b, assume_unique=True))
    return both / (len(a) + len(b) - both)
