"""Words and hashes of many texts at once, on the UTF-8 bytes of an Arrow column.

A word is a maximal run of ``0-9``, ``a-z`` (after A-Z are lower-cased) and bytes
from 0x80 on; for UTF-8 that is ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+``.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes handled at once; a longer text is handled alone.
CHUNK_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
#: A fixed random value per byte, the same in every process.
_BYTE_VALUES = np.random.Generator(np.random.PCG64(20240607)).integers(1, 2**63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
LOWER_BYTES = bytes(_LOWER)
_IS_WORD = np.zeros(256, bool)
_IS_WORD[48:58] = _IS_WORD[65:91] = _IS_WORD[97:123] = _IS_WORD[128:] = True
#: Lower-cases and turns everything between words into spaces.
SPACED = bytes(int(_LOWER[i]) if _IS_WORD[i] else 32 for i in range(256))
_LOWER_VALUES = _BYTE_VALUES[_LOWER]
_powers: dict[str, np.ndarray] = {"up": np.ones(1, np.uint64), "down": np.ones(1, np.uint64)}


def _power_table(name: str, base: int, size: int) -> np.ndarray:
    table = _powers[name]
    while len(table) < size:
        table = np.concatenate([table, table * np.uint64(pow(base, len(table), 1 << 64))])
    _powers[name] = table
    return table[:size]


def mix(values: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit hashes (a bijection)."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x7FB5D329728EA185)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x81DADEF4BC2DD44D)
    x ^= x >> np.uint64(33)
    return x


class RangeHash:
    """64-bit polynomial hashes of any byte ranges of ``data``."""

    def __init__(self, data: np.ndarray, lower: bool):
        values = (_LOWER_VALUES if lower else _BYTE_VALUES)[data]
        values *= _power_table("up", _BASE, len(data))
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(values, out=self.sums[1:])

    def of(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        down = _power_table("down", _INVERSE, len(self.sums))
        return (self.sums[ends] - self.sums[starts]) * down[starts]

    def every(self, width: int) -> np.ndarray:
        """The hash of each run of ``width`` bytes."""
        n = len(self.sums) - width
        if n <= 0:
            return np.zeros(0, np.uint64)
        return (self.sums[width:] - self.sums[:n]) * _power_table("down", _INVERSE, len(self.sums))[:n]


def chunks(texts: pa.Array, limit: int = CHUNK_BYTES) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(first row, bytes, offsets of the rows in them); null counts as empty.

    The bytes of at most ``limit`` or of one text.
    """
    if isinstance(texts, pa.ChunkedArray):
        texts = texts.combine_chunks()
    if len(texts) == 0:
        return
    texts = pc.fill_null(texts, b"" if pa.types.is_binary(texts.type) or pa.types.is_large_binary(texts.type) else "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offset_buffer, data_buffer = texts.buffers()
    offsets = np.frombuffer(offset_buffer, np.int64 if wide else np.int32)
    offsets = offsets[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    data = np.frombuffer(data_buffer, np.uint8) if data_buffer is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(texts):
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1)
        last = min(last, len(texts))
        yield first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first]
        first = last


@dataclass
class Words:
    """The words of a chunk: byte ranges, 64-bit hashes, and per text the first word."""

    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def owners(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.bounds) - 1), self.counts)


def words(data: np.ndarray, offsets: np.ndarray) -> Words:
    """All words of a chunk; none crosses the border of two texts."""
    inside = _IS_WORD[data]
    begins = inside.copy()
    begins[1:] &= ~inside[:-1]
    closes = inside.copy()
    closes[:-1] &= ~inside[1:]
    borders = offsets[1:-1]
    borders = borders[(borders > 0) & (borders < len(data))]
    begins[borders] = inside[borders]
    closes[borders - 1] = inside[borders - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    hashes = mix(RangeHash(data, lower=True).of(starts, ends))
    return Words(starts, ends, hashes, np.searchsorted(starts, offsets))


def shingles(found: Words, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of ``size`` consecutive words and the text each is in (with repeats)."""
    n = len(found.hashes) - size + 1
    if n <= 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    total = np.zeros(n, np.uint64)
    for k in range(size):
        total *= np.uint64(0xC2B2AE3D27D4EB4F)
        total += found.hashes[k : n + k]
    owners = found.owners()
    same = owners[:n] == owners[size - 1 :]
    return mix(total[same]), owners[:n][same]


def segment_sums(values: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Sums of ``values[bounds[i]:bounds[i + 1]]`` (also of empty ranges), along the first axis."""
    total = np.zeros((len(values) + 1, *values.shape[1:]), np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, axis=0, out=total[1:])
    return total[bounds[1:]] - total[bounds[:-1]]
