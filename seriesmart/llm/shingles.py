"""Word shingles of whole texts as arrays of 64-bit hashes."""

from __future__ import annotations

from itertools import chain

import numpy as np
import xxhash

CACHED_WORDS = 100_000
_MULTIPLIERS = np.array(
    [0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F],
    dtype=np.uint64,
)


class _WordHashes(dict):
    """64-bit hash by word, kept up to a fixed number of words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHED_WORDS:
            self.clear()
        value = xxhash.xxh3_64_intdigest(word)
        if len(word) <= 64:
            self[word] = value
        return value


_HASHES = _WordHashes()


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def words(text: str | None) -> list[bytes]:
    """A-Z lower-cased, cut at space and the characters 9 to 13; nothing else is changed."""
    return text.encode("utf-8", "surrogatepass").lower().split() if text else []


def shingle_sets(texts: list[str | None], size: int = 5) -> list[np.ndarray]:
    """For each text its distinct shingles, sorted. A text of fewer words gives its
    whole sequence as one shingle, one without words an empty array."""
    cut = [words(t) for t in texts]
    lengths = np.fromiter(map(len, cut), np.int64, len(cut))
    flat = np.fromiter(map(_HASHES.__getitem__, chain.from_iterable(cut)), np.uint64, int(lengths.sum()))
    ends = np.cumsum(lengths)
    if len(flat) >= size:
        rolled = flat[: len(flat) - size + 1] * _MULTIPLIERS[0]
        for k in range(1, size):
            rolled += flat[k : len(flat) - size + 1 + k] * _MULTIPLIERS[k % 5] * np.uint64(2 * (k // 5) + 1)
        rolled = mixed(rolled)
    out = []
    for end, length in zip(ends.tolist(), lengths.tolist(), strict=True):
        start = end - length
        if length >= size:
            out.append(np.unique(rolled[start : end - size + 1]))
        elif length:
            out.append(mixed((flat[start:end] * _MULTIPLIERS[:1] ** np.arange(1, length + 1, dtype=np.uint64))
                             .sum(keepdims=True, dtype=np.uint64) + np.uint64(length)))
        else:
            out.append(np.empty(0, np.uint64))
    return out
