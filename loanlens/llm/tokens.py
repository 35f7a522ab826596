"""Words and word shingles of many texts at once, as 64-bit hashes in numpy.

A word is a run of characters other than space and tab to carriage return; ``A`` to
``Z`` are lower-cased and nothing else.  The work is done on the UTF-8 bytes of an
Arrow column: a word's hash is a multilinear sum over its bytes with one random odd
factor per position, then mixed.  Memory stays near ``WINDOW`` bytes times a small
factor, whatever the length of a text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

WINDOW = 1 << 20

#: Bytes between words: white space; or all of ASCII but letters and digits.
SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
PUNCTUATION = np.ones(256, dtype=bool)
PUNCTUATION[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = False
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit integers (SplitMix64's finaliser)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` pseudo-random 64-bit integers that depend on ``seed`` only."""
    counter = np.arange(1, n + 1, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15)
    return mix(counter + mix(np.array([seed + 1], dtype=np.uint64)))


_FACTORS = stream(1, 4096) | np.uint64(1)


def _factors(length: int) -> np.ndarray:
    """One odd factor per position in a word; the same first ones for every length."""
    return _FACTORS if length <= len(_FACTORS) else stream(1, length) | np.uint64(1)


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All UTF-8 bytes of a text column and the offsets of its rows; null is empty."""
    texts = texts.cast(pa.large_string()).fill_null("")
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = texts.buffers()
    bounds = np.frombuffer(offsets, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return raw[bounds[0] : bounds[-1]], bounds - bounds[0]


def pieces(texts: pa.Array, size: int = WINDOW) -> Iterator[tuple[int, pa.Array]]:
    """Consecutive slices of a column with about ``size`` bytes each, one row at least."""
    lengths = np.diff(text_bytes(texts)[1])
    start, held = 0, 0
    for i, n in enumerate(lengths):
        if held and held + n > size:
            yield start, texts.slice(start, i - start)
            start, held = i, 0
        held += int(n)
    if start < len(texts):
        yield start, texts.slice(start)


def word_bounds(
    raw: np.ndarray, offsets: np.ndarray, gaps: np.ndarray = SPACE
) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Byte start and end of every word, and per row the index of its first word."""
    solid = ~gaps[raw]
    inner = np.zeros(len(raw) + 1, dtype=bool)
    inner[1:-1] = solid[:-1] & solid[1:]
    inner[offsets] = False
    starts = np.flatnonzero(solid & ~inner[:-1])
    ends = np.flatnonzero(solid & ~inner[1:]) + 1
    return starts, ends, np.searchsorted(starts, offsets)


def word_hashes(texts: pa.Array, gaps: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all lower-cased words, and per row the index of its first word."""
    raw, offsets = text_bytes(texts)
    starts, ends, first = word_bounds(raw, offsets, gaps)
    out = np.empty(len(starts), np.uint64)
    lengths = ends - starts
    sums = np.concatenate([[0], np.cumsum(lengths)])
    low = 0
    while low < len(starts):
        high = max(low + 1, int(np.searchsorted(sums, sums[low] + WINDOW, "right")) - 1)
        n, begin = lengths[low:high], sums[low:high] - sums[low]
        place = np.arange(int(n.sum()), dtype=np.int64)
        inside = place - np.repeat(begin, n)
        byte = _LOWER[raw[np.repeat(starts[low:high] - begin, n) + place]]
        value = (byte.astype(np.uint64) + np.uint64(1)) * _factors(int(n.max()))[inside]
        out[low:high] = np.add.reduceat(value, begin)
        low = high
    return mix(out), first


def windows(hashes: np.ndarray, size: int, seed: int = 2) -> np.ndarray:
    """Hash of every run of ``size`` consecutive words."""
    n = len(hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    factors = _window_factors(seed, size)
    total = hashes[:n] * factors[0]
    for j in range(1, size):
        total += hashes[j : j + n] * factors[j]
    total += factors[size]
    return mix(total)


def _window_factors(seed: int, size: int) -> np.ndarray:
    return stream(seed + 1000 * size, size + 1) | np.uint64(1)


def shingle_sets(texts: pa.Array, size: int) -> Iterator[np.ndarray]:
    """Per row the sorted distinct shingles of ``size`` words.

    A row with fewer words has one shingle, its whole sequence; a row without any word,
    and a null, has none.
    """
    for _, part in pieces(texts):
        hashes, first = word_hashes(part)
        runs = windows(hashes, size)
        for low, high in zip(first[:-1].tolist(), first[1:].tolist(), strict=True):
            if high - low >= size:
                own = np.sort(runs[low : high - size + 1])
                fresh = np.empty(len(own), bool)
                fresh[0] = True
                np.not_equal(own[1:], own[:-1], out=fresh[1:])
                yield own[fresh]
            else:
                yield windows(hashes[low:high], high - low) if high > low else hashes[:0]
