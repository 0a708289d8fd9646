"""Word shingles as 64-bit hashes, vectorised over batches of texts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import xxhash

_M = np.uint64(0x9E3779B97F4A7C15)
_CACHE = 300_000


class _Known(dict):
    """Hashes of words; one that is not known yet is hashed when it is asked for."""

    def __missing__(self, word: bytes) -> int:
        found = self[word] = xxhash.xxh64_intdigest(word)
        return found


_known = _Known()

#: Texts handled at once: bounds the words that are held as objects.
SLICE = 256


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit."""
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    h = h ^ (h >> np.uint64(32))
    h = h * np.uint64(0xD6E8FEB86659FD93)
    return h ^ (h >> np.uint64(32))


def word_hashes(words: list[bytes]) -> np.ndarray:
    if len(_known) > _CACHE:
        _known.clear()
    return np.fromiter(map(_known.__getitem__, words), np.uint64, len(words))


def words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lowered."""
    return (text or "").encode().lower().split()


def rolled(w: np.ndarray, k: int) -> np.ndarray:
    """A hash of each run of ``k`` words."""
    n = len(w) - k + 1
    h = np.zeros(max(0, n), np.uint64)
    for i in range(k):
        h = h * _M + w[i : i + n]
    return mix(h)


def shingle_sets(texts: list[str | None], k: int = 5) -> Iterator[np.ndarray]:
    """For each text its distinct k-word shingles, ascending; with fewer words all of them as one; without, none."""
    lists = [words(t) for t in texts]
    flat = word_hashes([w for x in lists for w in x])
    at = 0
    grams = rolled(flat, k) if len(flat) >= k else np.zeros(0, np.uint64)
    for x in lists:
        n = len(x)
        if n >= k:
            yield np.unique(grams[at : at + n - k + 1])
        elif n:
            h = np.uint64(0xA0761D6478BD642F) + np.uint64(n)
            for v in flat[at : at + n]:
                with np.errstate(over="ignore"):
                    h = h * _M + v
            yield mix(np.array([h], np.uint64))
        else:
            yield np.zeros(0, np.uint64)
        at += n
