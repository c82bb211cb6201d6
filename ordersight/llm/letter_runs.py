"""Runs of letters in many texts at once, told apart by their bytes.

A run is maximal within its text; which bytes belong to one is a table of 256 flags, or for
letters of two bytes a mask made from the text itself. Only A-Z are lower-cased.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa

from ordersight.llm.byte_words import LOWER_BYTES, RangeHash, mix

LOWER = np.frombuffer(LOWER_BYTES, np.uint8)
_BYTES = np.arange(256)
_ASCII = ((_BYTES >= 65) & (_BYTES <= 90)) | ((_BYTES >= 97) & (_BYTES <= 122))
_WIDE = _ASCII | (_BYTES >= 128)


def wide_letters(data: np.ndarray) -> np.ndarray:
    """Bytes of ``[^\\x00-\\x40\\x5B-\\x60\\x7B-\\x7F]``: ASCII letters and all beyond ASCII."""
    return _WIDE[data]


def latin_letters(data: np.ndarray) -> np.ndarray:
    """Bytes of ``[A-Za-z\\u00C0-\\u00FF]``: ASCII letters and what UTF-8 writes as C3 80 to C3 BF."""
    inside, lead = _ASCII[data], data == 0xC3
    inside |= lead
    inside[1:] |= lead[:-1]
    return inside


@dataclass
class Runs:
    """Lower-cased bytes of a chunk, and the runs in them: byte ranges, hashes, text of each."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    owners: np.ndarray

    def text(self, at: int) -> bytes:
        return self.data[self.starts[at] : self.ends[at]].tobytes()


def runs(data: np.ndarray, offsets: np.ndarray, inside: np.ndarray) -> Runs:
    """The runs of a chunk of texts that lie one after another at ``offsets``."""
    begins, closes = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    closes[:-1] &= ~inside[1:]
    borders = offsets[1:-1]
    borders = borders[(borders > 0) & (borders < len(data))]
    begins[borders] = inside[borders]
    closes[borders - 1] = inside[borders - 1]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(closes) + 1
    owners = np.searchsorted(offsets, starts, "right") - 1
    return Runs(LOWER[data], starts, ends, mix(RangeHash(data, lower=True).of(starts, ends)), owners)


def spans(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The places ``starts[i] .. starts[i] + lengths[i]`` of all i, one after another."""
    before = np.cumsum(lengths) - lengths
    return np.repeat(starts - before, lengths) + np.arange(int(lengths.sum()))


def same_bytes(a: np.ndarray, a_starts: np.ndarray, b: np.ndarray, b_starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """For each i (``lengths[i]`` > 0) whether these bytes of ``a`` and ``b`` are equal."""
    if not len(lengths):
        return np.zeros(0, bool)
    equal = a[spans(a_starts, lengths)] == b[spans(b_starts, lengths)]
    return np.logical_and.reduceat(equal, np.cumsum(lengths) - lengths)


def distinct(found: Runs) -> tuple[np.ndarray, np.ndarray]:
    """(an occurrence of each different run, for every run the number of its kind).

    Kinds are found by hash and confirmed byte by byte.
    """
    _, first, kind = np.unique(found.hashes, return_index=True, return_inverse=True)
    lengths, stand_in = found.ends - found.starts, first[kind]
    alike = lengths == lengths[stand_in]
    alike[alike] = same_bytes(found.data, found.starts[alike], found.data, found.starts[stand_in[alike]], lengths[alike])
    if alike.all():
        return first, kind
    # Two runs share a 64-bit hash: number them by their bytes.
    numbers: dict[bytes, int] = {}
    kind = np.array([numbers.setdefault(found.text(at), len(numbers)) for at in range(len(kind))])
    return np.unique(kind, return_index=True)[1], kind


def strings(found: Runs, at: np.ndarray) -> pa.StringArray:
    """The runs numbered ``at`` as an Arrow array."""
    lengths = found.ends[at] - found.starts[at]
    offsets = np.zeros(len(at) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    data = found.data[spans(found.starts[at], lengths)]
    return pa.StringArray.from_buffers(len(at), pa.py_buffer(offsets), pa.py_buffer(data))
