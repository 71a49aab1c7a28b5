"""Hashes of words, lines and runs of words over whole Arrow batches, in numpy.

Texts are UTF-8 bytes.  White space is the six ASCII characters ``\\x20`` and
``\\x09-\\x0D``, so words can be found byte by byte.  A hash is a polynomial over the bytes
with a fixed odd base modulo 2**64, followed by a mixing step; equal segments get equal
hashes wherever they stand, and 64 bits keep accidental equality out of reach within one
text and negligible over a corpus.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

# Text bytes handled at once; a longer text is cut at white space.
BLOCK_BYTES = 1 << 18

_SPAN = 1 << 16
_BASE = 0x9E3779B97F4A7C15
_POWERS = np.cumprod(np.full(_SPAN, _BASE, np.uint64))

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Finishing step of splitmix64."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def segment_hashes(units: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """Hash of each of the segments that follow one another in ``units`` without gaps."""
    if not len(lengths):
        return np.zeros(0, np.uint64)
    ends = np.cumsum(lengths)
    starts = ends - lengths
    place = np.arange(len(units), dtype=np.int64) - np.repeat(starts, lengths)
    values = units.astype(np.uint64) + np.uint64(1)
    if len(units) and lengths.max() > _SPAN:
        values *= mix((place >> 16).astype(np.uint64)) | np.uint64(1)
        place &= _SPAN - 1
    values *= _POWERS[place]
    sums = np.zeros(len(lengths), np.uint64)
    filled = lengths > 0
    if filled.any():
        sums[filled] = np.add.reduceat(values, starts[filled])
    return mix(sums + lengths.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))


@dataclass
class Words:
    """Words of some texts: hash, first byte, length in bytes, and the number of the text."""

    hashes: np.ndarray
    starts: np.ndarray
    lengths: np.ndarray
    texts: np.ndarray


def _cuts(data: np.ndarray, offsets: np.ndarray) -> Iterator[tuple[int, int]]:
    """Ranges of about ``BLOCK_BYTES`` bytes that end at a text's end or at white space."""
    at, end = int(offsets[0]), int(offsets[-1])
    while at < end:
        to = min(at + BLOCK_BYTES, end)
        if to < end:
            edge = int(offsets[np.searchsorted(offsets, to, "right") - 1])
            if edge > at:
                to = edge
            else:
                gaps = np.flatnonzero(_SPACE[data[at:to]])
                limit = int(offsets[np.searchsorted(offsets, at, "right")])
                while not len(gaps) and to < limit:
                    later = min(to + BLOCK_BYTES, limit)
                    gaps = np.flatnonzero(_SPACE[data[to:later]]) + (to - at)
                    gaps = gaps[:1]
                    to = later
                if len(gaps):
                    to = at + int(gaps[-1]) + 1
        yield at, to
        at = to


def words(data: np.ndarray, offsets: np.ndarray, lower: bool) -> Words:
    """All words of the texts ``data[offsets[i]:offsets[i + 1]]`` in order."""
    hashes, starts, lengths = [], [], []
    for at, to in _cuts(data, offsets):
        part = data[at:to]
        inside = ~_SPACE[part]
        begins = inside.copy()
        begins[1:] &= ~inside[:-1]
        edges = offsets[np.searchsorted(offsets, at) : np.searchsorted(offsets, to)] - at
        begins[edges] = inside[edges]
        begin = np.flatnonzero(begins)
        units = part[inside]
        length = np.diff(np.append(np.flatnonzero(begins[inside]), len(units)))
        hashes.append(segment_hashes(_LOWER[units] if lower else units, length))
        starts.append(begin + at)
        lengths.append(length)
    if not hashes:
        none = np.zeros(0, np.int64)
        return Words(np.zeros(0, np.uint64), none, none, none)
    start = np.concatenate(starts)
    return Words(
        np.concatenate(hashes),
        start,
        np.concatenate(lengths),
        np.searchsorted(offsets, start, "right") - 1,
    )


def runs(hashes: np.ndarray, n: int) -> np.ndarray:
    """Hash of the ``n`` words from each place on; the last ``n - 1`` places have none."""
    count = max(len(hashes) - n + 1, 0)
    sums = np.zeros(count, np.uint64)
    for j in range(n):
        sums = sums * np.uint64(_BASE) + hashes[j : j + count]
    return mix(sums + np.uint64(n))


def per_text(counts: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sums of a per-byte array over the texts; byte 0 of it is byte ``offsets[0]``."""
    sums = np.zeros(len(offsets) - 1, np.int64)
    filled = np.diff(offsets) > 0
    if filled.any():
        starts = offsets[:-1][filled] - offsets[0]
        sums[filled] = np.add.reduceat(counts, starts, dtype=np.int64)
    return sums


def text_buffers(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is an empty text."""
    column = column.fill_null("") if column.null_count else column
    wide = pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if offsets is None or not len(column):
        return np.zeros(0, np.uint8), np.zeros(len(column) + 1, np.int64)
    edges = np.frombuffer(offsets, kind)[column.offset : column.offset + len(column) + 1]
    return (
        np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8),
        edges.astype(np.int64),
    )


def release_memory() -> None:
    """Give freed memory back: workers are used again and should not hold it meanwhile."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def text_slices(
    batches: Iterator[pa.RecordBatch], column: int, most: int = BLOCK_BYTES
) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Parts of the batches with at most ``most`` text bytes, or one row, with their texts."""
    for batch in batches:
        data, offsets = text_buffers(batch.column(column))
        lo = 0
        while lo < batch.num_rows:
            hi = int(np.searchsorted(offsets, offsets[lo] + most, "right")) - 1
            hi = min(max(hi, lo + 1), batch.num_rows)
            base, top = offsets[lo], offsets[hi]
            yield batch.slice(lo, hi - lo), data[base:top], offsets[lo : hi + 1] - base
            lo = hi
    release_memory()
