"""Hashes of words and of word sequences over whole batches of texts, with numpy.

A word's hash is the difference of two values of a running polynomial hash, so one pass over the
bytes serves all words. Sequences of words are hashed from their words' hashes. 64 bits each;
equal words always have equal hashes, in every process.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

import numpy as np

BUFFER_BYTES = 1 << 18
U64 = np.uint64
WHITE = b" \t\n\x0b\x0c\r"
#: Bytes that are part of a word: all but blanks; and ASCII letters, digits and all non-ASCII.
NOT_BLANK = np.array([b not in WHITE for b in range(256)])
ALNUM = np.array([b >= 0x80 or chr(b).isalnum() for b in range(256)])


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit over all others."""
    x = x ^ (x >> U64(33))
    x = x * U64(0xFF51AFD7ED558CCD)
    x = x ^ (x >> U64(33))
    x = x * U64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> U64(33))


BYTE_VALUES = mix(np.arange(1, 257, dtype=U64) * U64(0x9E3779B97F4A7C15))
BASE = 0x5851F42D4C957F2D  # odd, so that it has an inverse modulo 2^64


@lru_cache(maxsize=1)
def _powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    def run(base: int) -> np.ndarray:
        steps = np.full(size, base, dtype=U64)
        steps[0] = 1
        return np.cumprod(steps, dtype=U64)

    return run(BASE), run(pow(BASE, -1, 1 << 64))


def powers(size: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse, for at least ``size`` places."""
    return _powers(max(BUFFER_BYTES * 2, 1 << (size - 1).bit_length()))


def running_hash(data: np.ndarray) -> np.ndarray:
    """Value at i: the polynomial over the first i bytes."""
    up, _ = powers(len(data) + 1)
    total = np.empty(len(data) + 1, dtype=U64)
    total[0] = 0
    np.cumsum(BYTE_VALUES[data] * up[:len(data)], out=total[1:])
    return total


def span_hash(total: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Hashes of byte spans; equal bytes give equal hashes wherever they stand."""
    _, down = powers(len(total))
    return (total[end] - total[start]) * down[start]


def words_of(raw: bytes, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Starts, ends and hashes of a buffer's words. Lower-case A-Z before."""
    data = np.frombuffer(raw, dtype=np.uint8)
    inside = np.zeros(len(data) + 2, dtype=np.int8)
    inside[1:-1] = is_word[data]
    turns = np.diff(inside)
    start, end = np.flatnonzero(turns == 1), np.flatnonzero(turns == -1)
    return start, end, mix(span_hash(running_hash(data), start, end))


def grams(words: np.ndarray, n: int) -> np.ndarray:
    """Hashes of all runs of n words."""
    count = len(words) - n + 1
    if count <= 0:
        return np.empty(0, dtype=U64)
    total = np.full(count, n, dtype=U64)
    for i in range(n):
        total = (total ^ words[i:i + count]) * U64(0x9FB21C651E98DF25)
        total ^= total >> U64(29)
    return mix(total)


def batches(texts: Sequence[str | None]) -> Iterator[tuple[list[int], bytes, np.ndarray]]:
    """Lower-cased texts joined by blanks, about a buffer at a time: rows, bytes, text starts."""
    rows: list[int] = []
    parts: list[bytes] = []
    held = 0
    for i, text in enumerate(texts):
        part = (text or "").encode().lower()
        if rows and held + len(part) > BUFFER_BYTES:
            yield rows, b" ".join(parts), _starts(parts)
            rows, parts, held = [], [], 0
        rows.append(i)
        parts.append(part)
        held += len(part) + 1
    if rows:
        yield rows, b" ".join(parts), _starts(parts)


def _starts(parts: list[bytes]) -> np.ndarray:
    sizes = np.array([len(p) + 1 for p in parts], dtype=np.int64)
    return np.concatenate(([0], np.cumsum(sizes)[:-1]))


def row_bounds(starts: np.ndarray, word_starts: np.ndarray) -> np.ndarray:
    """Index of each text's first word, and the number of all words at the end."""
    return np.append(np.searchsorted(word_starts, starts), len(word_starts))
