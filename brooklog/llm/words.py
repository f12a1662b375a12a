"""Hashes of words and shingles, as arrays."""

from __future__ import annotations

import numpy as np
import xxhash

#: Words of which a worker keeps the hash; beyond it starts anew.
CACHE_WORDS = 100_000
_U = np.uint64


class _Hashes(dict):
    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        out = self[word] = xxhash.xxh3_64_intdigest(word)
        return out


_hashes = _Hashes()


def forget() -> None:
    _hashes.clear()


def words_of(text: str | None, lower: bool = False) -> list[bytes]:
    """The runs of anything but ASCII white space, in UTF-8; lower: with A-Z in lower case."""
    data = (text or "").encode()
    return (data.lower() if lower else data).split()


def hashes_of(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(_hashes.__getitem__, words), _U, len(words))


def runs(hashes: np.ndarray, k: int, seed: int = 0) -> np.ndarray:
    """A hash of every k consecutive hashes."""
    n = len(hashes) - k + 1
    if n <= 0:
        return np.empty(0, _U)
    out = np.full(n, seed * 0x9E3779B97F4A7C15 + k & 0xFFFFFFFFFFFFFFFF, _U)
    for i in range(k):
        out ^= hashes[i : i + n]
        out *= _U(0xBF58476D1CE4E5B9)
        out ^= out >> _U(31)
        out *= _U(0x94D049BB133111EB)
        out ^= out >> _U(29)
    return out


def shingles(text: str | None, k: int) -> np.ndarray:
    """The sorted set of hashed k-word shingles of a text in lower case; with fewer words, of the whole sequence."""
    h = hashes_of(words_of(text, lower=True))
    return np.unique(runs(h, min(k, len(h)))) if len(h) else np.empty(0, _U)
