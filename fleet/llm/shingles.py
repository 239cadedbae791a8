"""Hashes of words and word shingles, as numpy arrays."""

from __future__ import annotations

import numpy as np
import xxhash

_WORDS_KEPT = 400_000


class _WordHashes(dict):
    def __missing__(self, word: bytes) -> int:
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value


_CACHE = _WordHashes()


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads their bits."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_hashes(text: str | None, lower: bool = True) -> np.ndarray:
    """Hash of each word; with ``lower``, A-Z count as a-z. Words are runs of other bytes than space and 09 to 0D."""
    data = (text or "").encode("utf-8", "surrogatepass")
    words = (data.lower() if lower else data).split()
    if len(_CACHE) > _WORDS_KEPT:
        _CACHE.clear()
    return np.fromiter(map(_CACHE.__getitem__, words), np.uint64, len(words))


def shingle_set(text: str | None, width: int) -> np.ndarray:
    """Distinct shingle hashes, ascending. Fewer words than ``width`` are one shingle; no word gives none."""
    words = word_hashes(text)
    return np.unique(windows(words, min(width, len(words)))) if len(words) else words


def windows(words: np.ndarray, width: int) -> np.ndarray:
    """Hash of every run of ``width`` words."""
    n = max(0, len(words) - width + 1)
    out = np.full(n, width, np.uint64)
    for place in range(width):
        out = mix(out * np.uint64(0x9E3779B97F4A7C15) + words[place : n + place])
    return out
