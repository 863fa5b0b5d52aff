"""Hashed word shingles of many texts at once, in numpy.

Words are runs of letters and digits, lower-cased. A word's hash is a
polynomial of its code points, a shingle's a mixed sum of its words' hashes,
all modulo 2^64. A text with fewer words than a shingle has one shingle of
all of them; a text without a word has none.
"""

from __future__ import annotations

from functools import lru_cache

import numpy as np

SIZE = 5
ODD = np.uint64(0x9E3779B97F4A7C15)
MIX1, MIX2 = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
KEEP = np.uint64(52)  # bits of a shingle's hash


@lru_cache(maxsize=1)
def _word_chars() -> np.ndarray:
    return np.array([chr(c).isalnum() if not 0xD800 <= c < 0xE000 else False for c in range(0x110000)])


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser."""
    x = (x ^ (x >> np.uint64(30))) * MIX1
    x = (x ^ (x >> np.uint64(27))) * MIX2
    return x ^ (x >> np.uint64(31))


_held: list[np.ndarray] = []
HELD = 1 << 18  # longer tables are not kept: they would stay in every worker


def _powers(n: int) -> list[np.ndarray]:
    """Powers of an odd base and of its inverse, modulo 2^64: at least n; the
    longest tables of at most ``HELD`` so far are kept."""
    if _held and len(_held[0]) >= n:
        return _held
    up = np.full(n, ODD, np.uint64)
    down = np.full(n, pow(int(ODD), -1, 1 << 64), np.uint64)
    up[0] = down[0] = 1
    made = [np.multiply.accumulate(up), np.multiply.accumulate(down)]
    if n <= HELD:
        _held[:] = made
    return made


def words(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(text number, hash) of each word, in order."""
    low = [t.lower() + " " for t in texts]
    points = np.frombuffer("".join(low).encode("utf-32-le", "surrogatepass"), "<u4")
    if not len(points):
        return np.zeros(0, np.int64), np.zeros(0, np.uint64)
    inside = _word_chars()[points].view(np.int8)
    edge = np.diff(inside, prepend=np.int8(0))
    start, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    up, down = _powers(1 << (len(points) - 1).bit_length())
    value = mix(points.astype(np.uint64) + np.uint64(1)) * up[:len(points)]
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)])
    word = mix((total[end] - total[start]) * down[start] + (end - start).astype(np.uint64))
    text_end = np.cumsum([len(t) for t in low])
    return np.searchsorted(text_end, start, "right"), word


def shingles(texts: list[str], size: int = SIZE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(text number, hash, count) of each distinct shingle, sorted by both."""
    text, word = words(texts)
    n = np.bincount(text, minlength=len(texts))
    first = np.cumsum(n) - n
    short = np.minimum(n, size)
    total = np.zeros(len(word), np.uint64)
    for k in range(size):
        factor = mix(np.uint64([k + 1]))[0] | np.uint64(1)
        ahead = np.zeros(len(word), np.uint64)
        later = word[k:]
        ahead[:len(later)] = later * factor
        inside = np.arange(len(word)) + k < (first + n)[text]
        total += np.where(inside, ahead, np.uint64(0))
    starts = np.arange(len(word)) - first[text] <= (n - short)[text]
    text, total = text[starts], mix(total[starts]) >> (np.uint64(64) - KEEP)
    if len(texts) >= 1 << 12:
        raise ValueError("too many texts at once")
    key, count = np.unique((text.astype(np.uint64) << KEEP) | total, return_counts=True)
    return (key >> KEEP).astype(np.int64), key & ((np.uint64(1) << KEEP) - np.uint64(1)), count
