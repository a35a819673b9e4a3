"""Words and word shingles as 64-bit hashes, in numpy."""

from __future__ import annotations

from collections.abc import Callable

import numpy as np
import xxhash

CACHE_WORDS = 200_000
_MIX = (np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB))
_STEP = 0x9E3779B97F4A7C15


class WordHashes(dict):
    """64-bit hashes of words, kept for reuse up to CACHE_WORDS."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= CACHE_WORDS:
            self.clear()
        value = self[word] = xxhash.xxh3_64_intdigest(word)
        return value

    def of(self, words: list[bytes]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def word_hashes() -> WordHashes:
    """One for each task: a word is hashed sooner than it is worth keeping from stage to stage."""
    return WordHashes()


def split_words(text: str | None, lower: bool = False) -> list[bytes]:
    """The runs of anything but ASCII white space; bytes.lower and bytes.split know ASCII alone."""
    raw = (text or "").encode()
    return (raw.lower() if lower else raw).split()


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(30))) * _MIX[0]
    h = (h ^ (h >> np.uint64(27))) * _MIX[1]
    return h ^ (h >> np.uint64(31))


def gram_hashes(words: np.ndarray, width: int) -> np.ndarray:
    """The hash of every run of `width` words, in order."""
    n = len(words) - width + 1
    if n <= 0:
        return np.empty(0, np.uint64)
    h = np.zeros(n, np.uint64)
    for i in range(width):
        h += words[i : i + n] * np.uint64(pow(_STEP, i, 2**64))
    return mix(h)


def shingle_set(text: str | None, width: int, hashes: Callable[[list[bytes]], np.ndarray]) -> np.ndarray:
    """Sorted distinct hashes of the text's shingles in lower case; a text with fewer words is one shingle, an empty one none."""
    words = hashes(split_words(text, lower=True))
    if 0 < len(words) < width:
        return gram_hashes(words, len(words))
    return np.unique(gram_hashes(words, width))
