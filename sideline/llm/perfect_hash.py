"""A minimal perfect hash over 128-bit keys, as numpy arrays."""

from __future__ import annotations

import io

import numpy as np

from sideline.llm.common import mixed

_GAMMA = 1.5


def _place(h1: np.ndarray, h2: np.ndarray, level: int, size: int) -> np.ndarray:
    turn = np.uint64((level * 0x9E3779B97F4A7C15 + 1) % 2**64)
    return mixed(h1 ^ mixed(h2 + turn)) % np.uint64(size)


class PerfectHash:
    """Distinct keys (h1, h2) to 0..n-1, in about three bits a key.

    Level by level, each remaining key hashes to a position of a bit array; positions that exactly
    one key hits are set and settle that key, the others go on to the next level. A key's number is
    the count of set bits before its own.
    """

    def __init__(self, words: list[np.ndarray]):
        self.words = words
        bits = [np.bitwise_count(w).astype(np.int64) for w in words]
        self.before, total = [], 0
        for b in bits:
            self.before.append(total + np.cumsum(b) - b)
            total += int(b.sum())
        self.n = total

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray) -> PerfectHash:
        words = []
        while len(h1):
            size = 64 * max(1, int(np.ceil(_GAMMA * len(h1) / 64)))
            at = _place(h1, h2, len(words), size)
            hits = np.bincount(at.astype(np.int64), minlength=size)
            alone = hits == 1
            words.append(np.packbits(alone, bitorder="little").view(np.uint64))
            rest = ~alone[at.astype(np.int64)]
            h1, h2 = h1[rest], h2[rest]
        return cls(words)

    def find(self, h1: np.ndarray, h2: np.ndarray) -> np.ndarray:
        """Number of each key; of a key that was not built in any number or -1."""
        out = np.full(len(h1), -1, np.int64)
        left = np.arange(len(h1))
        for level, (words, before) in enumerate(zip(self.words, self.before, strict=True)):
            at = _place(h1[left], h2[left], level, 64 * len(words))
            word, bit = (at >> np.uint64(6)).astype(np.int64), at & np.uint64(63)
            value = words[word]
            here = (value >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(value & ((np.uint64(1) << bit) - np.uint64(1))).astype(np.int64)
            out[left[here]] = (before[word] + below)[here]
            left = left[~here]
            if not len(left):
                break
        return out


class Shard:
    """Fingerprint, count and largest document per key, at the key's number."""

    def __init__(self, hash_: PerfectHash, fingerprint: np.ndarray, count: np.ndarray, last: np.ndarray):
        self.hash, self.fingerprint, self.count, self.last = hash_, fingerprint, count, last

    @classmethod
    def build(cls, h1: np.ndarray, h2: np.ndarray, count: np.ndarray, last: np.ndarray) -> Shard:
        hash_ = PerfectHash.build(h1, h2)
        at = hash_.find(h1, h2)
        out = [np.empty(len(at), kind) for kind in (np.uint64, np.int64, np.int64)]
        for array, values in zip(out, (h2, count, last), strict=True):
            array[at] = values
        return cls(hash_, *out)

    def probe(self, h1: np.ndarray, h2: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Count (0 for keys that are not in the shard) and largest document."""
        if not self.hash.n:
            return np.zeros(len(h1), np.int64), np.zeros(len(h1), np.int64)
        at = self.hash.find(h1, h2)
        known = (at >= 0) & (self.fingerprint[at] == h2)
        return np.where(known, self.count[at], 0), self.last[at]

    def to_bytes(self) -> bytes:
        out = io.BytesIO()
        np.savez(out, *self.hash.words, fingerprint=self.fingerprint, count=self.count, last=self.last)
        return out.getvalue()

    @classmethod
    def from_bytes(cls, data: bytes) -> Shard:
        held = np.load(io.BytesIO(data))
        words = [held[f"arr_{i}"] for i in range(len(held.files) - 3)]
        return cls(PerfectHash(words), held["fingerprint"], held["count"], held["last"])
