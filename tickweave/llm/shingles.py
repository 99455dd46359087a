"""Word shingles of texts as hashes (numpy, inside tasks)."""

from __future__ import annotations

import numpy as np
import xxhash

_M1, _M2, _M3 = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xBF58476D1CE4E5B9, 0x94D049BB133111EB))


class WordHashes(dict):
    """64-bit hashes of words, remembered up to a bound."""

    limit = 100_000

    def __missing__(self, word: bytes) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = self[word] = xxhash.xxh64_intdigest(word)
        return h


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` with A-Z lower-cased, as UTF-8 (``bytes`` lowers and splits ASCII only)."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def _mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * _M2
    x = (x ^ (x >> np.uint64(27))) * _M3
    return x ^ (x >> np.uint64(31))


def shingle_set(words: list[bytes], width: int, cache: WordHashes) -> np.ndarray:
    """Sorted distinct 64-bit hashes of ``width``-word shingles; fewer words count as one shingle."""
    if not words:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(cache.__getitem__, words), np.uint64, len(words))
    span = min(width, len(words))
    with np.errstate(over="ignore"):
        x = np.full(len(h) - span + 1, span, np.uint64)
        for i in range(span):
            x = _mix(x * _M1 + h[i:len(h) - span + 1 + i])
    return np.unique(x)
