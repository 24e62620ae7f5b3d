"""Words, word hashes and shingle hashes of whole texts, for use inside tasks."""

from __future__ import annotations

import numpy as np
import xxhash

_MULT = np.uint64(0x9E3779B97F4A7C15)
_MIX = np.uint64(0xBF58476D1CE4E5B9)


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    def __init__(self, most: int = 400_000):
        super().__init__()
        self.most = most

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.most:
            self.clear()
        self[word] = value = xxhash.xxh64_intdigest(word)
        return value


HASHES = WordHashes()


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(HASHES.__getitem__, words), np.uint64, len(words))


def windows(hashes: np.ndarray, width: int) -> np.ndarray:
    """A hash per run of ``width`` words; empty where there are fewer."""
    n = len(hashes) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    mixed = hashes[:n].copy()
    for k in range(1, width):
        mixed *= _MULT
        mixed += hashes[k : k + n]
    mixed ^= mixed >> np.uint64(31)
    mixed *= _MIX
    mixed ^= mixed >> np.uint64(29)
    return mixed


def shingle_set(text: str | None, width: int = 5) -> np.ndarray:
    """Sorted distinct hashes of the lower-cased (A-Z) text's shingles; a shorter text is one shingle."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = word_hashes(words)
    return np.unique(windows(hashes, min(width, len(words))))
