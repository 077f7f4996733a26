"""Word shingles of many texts at once, as sets of 64-bit hashes."""

from __future__ import annotations

import hashlib

import numpy as np

U64 = np.uint64
BASE = 0x9E3779B97F4A7C15  # odd
# Bytes outside words (blank, tab to carriage return).
SEPARATORS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit numbers."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> U64(27))
    x = x * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


class Shingler:
    """Distinct shingles of ``size`` words; a shorter text is one shingle, an empty one none."""

    def __init__(self, size: int) -> None:
        self.size = size
        lower = np.arange(256, dtype=np.uint8)
        lower[65:91] += 32  # A-Z
        self.lower = lower
        self.blank = np.zeros(256, bool)
        self.blank[list(SEPARATORS)] = True
        self.value = np.random.default_rng(11).integers(1, 2**63, 256).astype(U64)
        self.powers = np.ones(1, U64)
        self.inverse = np.ones(1, U64)

    def _grow(self, n: int) -> None:
        if len(self.powers) < n:
            for name, base in (("powers", BASE), ("inverse", pow(BASE, -1, 2**64))):
                steps = np.full(n, base, U64)
                steps[0] = 1
                setattr(self, name, np.multiply.accumulate(steps))

    def sets(self, texts: list[bytes]) -> list[np.ndarray]:
        """Sorted distinct shingle hashes of each text."""
        buffer = b"\n".join(texts) + b"\n"
        ends = np.cumsum([len(t) + 1 for t in texts])
        data = self.lower[np.frombuffer(buffer, np.uint8)]
        self._grow(len(data) + 1)
        inside = ~self.blank[data]
        change = np.flatnonzero(np.diff(np.concatenate(([False], inside, [False])).astype(np.int8)))
        begin, end = change[0::2], change[1::2]
        sums = np.concatenate(([U64(0)], np.cumsum(self.value[data] * self.powers[:len(data)])))
        words = mixed((sums[end] - sums[begin]) * self.inverse[begin] + (end - begin).astype(U64))
        first = np.searchsorted(begin, np.concatenate(([0], ends[:-1])))
        last = np.concatenate((first[1:], [len(words)]))
        out = []
        grams = self._grams(words, self.size)
        for lo, hi in zip(first, last):
            n = hi - lo
            if n >= self.size:
                out.append(np.unique(grams[lo:hi - self.size + 1]))
            elif n:
                out.append(self._grams(words[lo:hi], n) ^ U64(n))
            else:
                out.append(np.zeros(0, U64))
        return out

    @staticmethod
    def _grams(words: np.ndarray, size: int) -> np.ndarray:
        n = len(words) - size + 1
        if n <= 0:
            return np.zeros(0, U64)
        total = words[:n].copy()
        for k in range(1, size):
            total = mixed(total) + words[k:k + n] * U64(2 * k + 1)
        return mixed(total)


class Signer:
    """MinHash: the least value of each of ``k`` permutations of the 32 high bits of a hash."""

    def __init__(self, k: int, seed: int = 5) -> None:
        rng = np.random.default_rng(seed)
        self.factor = (rng.integers(0, 2**31, k, dtype=np.uint64) * U64(2) + U64(1)).astype(np.uint32)
        self.shift = rng.integers(0, 2**32, k, dtype=np.uint64).astype(np.uint32)

    def sign(self, hashes: np.ndarray) -> np.ndarray:
        high = (hashes >> U64(32)).astype(np.uint32)
        least = np.full(len(self.factor), 0xFFFFFFFF, np.uint32)
        for lo in range(0, len(high), 2048):
            part = (high[lo:lo + 2048, None] ^ self.shift) * self.factor
            np.minimum(least, part.min(axis=0), out=least)
        return least.view(np.int32)


def digest(hashes: np.ndarray) -> bytes:
    """Names a whole set: 128 bits of its sorted hashes."""
    return hashlib.blake2b(hashes.tobytes(), digest_size=16).digest()
