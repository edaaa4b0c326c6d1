"""Words, shingles and minimum hashes of whole texts in numpy, straight from Arrow buffers.

Texts are cut at ASCII white space after A-Z are lower-cased. A word's hash is a polynomial over its bytes
modulo 2^64 with a random value for each byte, then mixed; a shingle's hash combines the hashes of its words.
Work goes over a quarter of a megabyte of text at a time, so memory is bounded by that and the longest single
text.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SPACES = b" \t\n\x0b\x0c\r"
AT_ONCE = 256 << 10
_random = np.random.default_rng(20240229)
_VALUES = _random.integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0x9E3779B97F4A7C15)
_IN_SHINGLE = np.uint64(0xD6E8FEB86659FD93)
_lower = np.arange(256, dtype=np.uint8)
_lower[65:91] += 32
_SPACE = np.zeros(256, bool)
_SPACE[list(SPACES)] = True
_VALUES = _VALUES[_lower]
_VALUES[_SPACE] = 0
_powers = np.ones(1, np.uint64)


def _powers_of(n: int) -> np.ndarray:
    global _powers
    if len(_powers) < n:
        size = max(n, 2 * len(_powers), 1 << 16)
        with np.errstate(over="ignore"):
            _powers = np.concatenate([np.ones(1, np.uint64), np.cumprod(np.full(size - 1, _BASE, np.uint64))])
    return _powers


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection on 64-bit integers that spreads every bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string array and where each text begins and ends; null is empty."""
    texts = texts.fill_null("")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    offsets = np.frombuffer(texts.buffers()[1], kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = texts.buffers()[2]
    whole = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return whole[offsets[0] : offsets[-1]], offsets - offsets[0]


def runs(texts: pa.Array, at_once: int = AT_ONCE) -> Iterator[tuple[int, int]]:
    """Consecutive rows of about `at_once` bytes together: (first, past the last)."""
    if not len(texts):
        return
    _, offsets = text_bytes(texts)
    at = 0
    while at < len(texts):
        end = max(at + 1, int(np.searchsorted(offsets, offsets[at] + at_once, "right")) - 1)
        yield at, end
        at = end


def words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all words, and the number of the first word of each text (with the total at the end)."""
    return sized_words(texts)[:2]


def sized_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As `words`, and each word's bytes."""
    data, offsets = text_bytes(texts)
    none = np.empty(0, np.uint64), np.zeros(len(offsets), np.int64), np.empty(0, np.int64)
    if not len(data):
        return none
    inside = ~_SPACE[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    borders = offsets[(offsets > 0) & (offsets < len(data))]
    begins[borders] = inside[borders]
    starts = np.flatnonzero(begins)
    if not len(starts):
        return none
    lengths = np.diff(np.append(starts, len(data)))
    place = np.arange(len(data), dtype=np.int64)[starts[0] :] - np.repeat(starts, lengths)
    values = _VALUES[data[starts[0] :]]
    values *= _powers_of(int(lengths.max()) + 1)[place]
    sizes = np.add.reduceat(inside[starts[0] :].astype(np.int64), starts - starts[0])
    return mixed(np.add.reduceat(values, starts - starts[0])), np.searchsorted(starts, offsets), sizes


def shingles(hashes: np.ndarray, size: int) -> np.ndarray:
    """Distinct shingles of one text's words, sorted: runs of `size` words, or the whole shorter text."""
    n = len(hashes)
    if not n:
        return hashes
    width = min(size, n)
    out = np.zeros(n - width + 1, np.uint64)
    for k in range(width):
        out *= _IN_SHINGLE
        out += hashes[k : n - width + 1 + k]
    return np.unique(mixed(out + np.uint64(width)))


class MinHash:
    """Minimum hashes of sets of 64-bit hashes under `count` universal functions a*x+b modulo 2^64."""

    def __init__(self, count: int, seed: int = 7) -> None:
        source = np.random.default_rng(seed)
        self.count = count
        self.a = source.integers(0, 2**63, count, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
        self.b = source.integers(0, 2**63, count, dtype=np.uint64)

    def minima(self, values: np.ndarray) -> np.ndarray:
        """The upper 32 bits of each function's minimum; all ones for the empty set."""
        lowest = np.full(self.count, 2**64 - 1, np.uint64)
        for at in range(0, len(values), 256):
            part = np.multiply.outer(self.a, values[at : at + 256])
            part += self.b[:, None]
            np.minimum(lowest, part.min(axis=1), out=lowest)
        return (lowest >> np.uint64(32)).astype(np.uint32)
