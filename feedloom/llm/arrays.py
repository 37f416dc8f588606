"""Texts of an Arrow batch as numpy arrays: bytes, words and rolling hashes."""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 1 << 20

_U = np.uint64
_RNG = np.random.default_rng(97)
BYTE_CODES = _RNG.integers(1, 2**64, 256, dtype=_U)
FOLDED_CODES = BYTE_CODES.copy()
FOLDED_CODES[65:91] = BYTE_CODES[97:123]  # A-Z count as a-z

SPACES = np.zeros(256, bool)
SPACES[[32, *range(9, 14)]] = True

_BASE = _U(0x9E3779B97F4A7C15)
_INVERSE = _U(pow(int(_BASE), -1, 1 << 64))
_powers: list[np.ndarray] = [np.ones(1, _U), np.ones(1, _U)]


def mix(x: np.ndarray) -> np.ndarray:
    """Spread every bit of 64-bit values over all bits."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


class Rolling(NamedTuple):
    """Prefix sums from which the hash of any slice follows."""

    sums: np.ndarray
    inverse: np.ndarray

    def hashes(self, start: np.ndarray, stop: np.ndarray) -> np.ndarray:
        raw = (self.sums[stop] - self.sums[start]) * self.inverse[start]
        return mix(raw + (stop - start).astype(_U) * _U(0xD6E8FEB86659FD93))

    def every(self, length: int) -> np.ndarray:
        """Hashes of all slices of one length, by their starts."""
        n = max(0, len(self.sums) - length)
        raw = (self.sums[length : length + n] - self.sums[:n]) * self.inverse[:n]
        return mix(raw + _U(length * 0xD6E8FEB86659FD93 % 2**64))


def rolling(codes: np.ndarray) -> Rolling:
    n = len(codes) + 1
    if len(_powers[0]) < n:
        size = max(n, CHUNK_BYTES + 1)
        for i, base in enumerate((_BASE, _INVERSE)):
            steps = np.full(size, base, _U)
            steps[0] = 1
            _powers[i] = np.cumprod(steps, dtype=_U)
    sums = np.zeros(n, _U)
    np.cumsum(codes * _powers[0][: n - 1], out=sums[1:])
    return Rolling(sums, _powers[1])


class Chunk(NamedTuple):
    """Rows first..last of a batch: their bytes one after another, and each row's bounds."""

    first: int
    last: int
    data: np.ndarray
    bounds: np.ndarray


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cut a text column into runs of rows of about ``limit`` bytes; null counts as empty."""
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    texts = pc.fill_null(texts.cast(pa.large_string()), "")
    n = len(texts)
    if not n:
        return
    _, at, data = texts.buffers()
    offsets = np.frombuffer(at, np.int64)[texts.offset : texts.offset + n + 1]
    bytes_ = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        last = min(n, max(first + 1, last))
        yield Chunk(
            first, last, bytes_[offsets[first] : offsets[last]],
            offsets[first : last + 1] - offsets[first],
        )
        first = last


class Words(NamedTuple):
    """Byte slices of words, and the bounds of each row's words among them."""

    start: np.ndarray
    stop: np.ndarray
    bounds: np.ndarray


def words(chunk: Chunk, separators: np.ndarray = SPACES) -> Words:
    data, bounds = chunk.data, chunk.bounds
    inside = ~separators[data]
    opens, closes = inside.copy(), inside.copy()
    opens[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    edges = bounds[(bounds > 0) & (bounds < len(data))]
    opens[edges] = inside[edges]
    closes[edges - 1] = inside[edges - 1]
    start = np.flatnonzero(opens)
    return Words(start, np.flatnonzero(closes) + 1, np.searchsorted(start, bounds))


def word_codes(chunk: Chunk, found: Words, fold: bool = False) -> np.ndarray:
    """A 64-bit hash of every word."""
    codes = (FOLDED_CODES if fold else BYTE_CODES)[chunk.data]
    return rolling(codes).hashes(found.start, found.stop)


def owners(bounds: np.ndarray) -> np.ndarray:
    """The row of every item, from the rows' bounds."""
    return np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))


def expand(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The indices start, start + 1, ... of every slice, one slice after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    ends = np.cumsum(lengths)
    return np.arange(total) - np.repeat(ends - lengths - starts, lengths)
