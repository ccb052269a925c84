"""Vectorised text scanning over Arrow string columns (numpy, inside tasks).

Words are runs of bytes other than the six ASCII white-space characters, so a
UTF-8 column can be scanned without decoding it. A span of up to 8 bytes has a
64-bit hash of its own among those of its length, one of up to 16 bytes mixes two
such halves, and a longer one takes 64 bits of its BLAKE2b digest, so no pattern
within a text makes two spans collide; equal spans have equal hashes at every
position and in every task.
Columns are scanned in slices of whole documents of about ``SLICE`` bytes, so
memory is bounded by the slice (or by the longest single document).
"""

from __future__ import annotations

import ctypes
import hashlib
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401

SLICE = 1 << 20
U = np.uint64
SPACE = np.zeros(256, bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_LANE = np.array([(1 << 8 * k) - 1 for k in range(9)], U)  # the low k bytes


def mix64(x: np.ndarray) -> np.ndarray:
    """The finaliser of splitmix64, a bijection on 64-bit values."""
    x = (x ^ (x >> U(30))) * U(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U(27))) * U(0x94D049BB133111EB)
    return x ^ (x >> U(31))


def stream(seed: int, n: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit values."""
    return mix64((np.arange(1, n + 1, dtype=np.uint64) + U(seed)) * U(0x9E3779B97F4A7C15))


class Slice(NamedTuple):
    """Some whole documents of a column: ``first`` row, bytes, document bounds."""

    first: int
    data: np.ndarray
    bounds: np.ndarray  # n + 1 offsets into data

    @property
    def docs(self) -> int:
        return len(self.bounds) - 1


def slices(column: pa.Array, size: int = SLICE) -> Iterator[Slice]:
    """The documents of a string column in order; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()).fill_null("")
    n = len(column)
    if not n:
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + n + 1]
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + size, "right")) - 1)
        last = min(last, n)
        yield Slice(first, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first])
        first = last


def parts(batches: Iterable[pa.RecordBatch], text: int, size: int = 2 * SLICE) -> Iterator[pa.RecordBatch]:
    """Slices of record batches with about ``size`` bytes in column ``text`` (at least one row each)."""
    for batch in batches:
        at = 0
        lengths = np.cumsum([0, *(x or 0 for x in pa.compute.binary_length(batch.column(text)).to_pylist())])
        while at < batch.num_rows:
            end = min(batch.num_rows, max(at + 1, int(np.searchsorted(lengths, lengths[at] + size, "right")) - 1))
            yield batch.slice(at, end - at)
            at = end


def runs(inside: np.ndarray, bounds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of runs of True that do not cross a document bound."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    starts = inside.copy()
    starts[1:] &= ~inside[:-1]
    cut = bounds[(bounds > 0) & (bounds < n)]
    starts[cut] = inside[cut]
    ends = inside.copy()
    ends[:-1] &= ~inside[1:]
    ends[cut - 1] = inside[cut - 1]
    return np.flatnonzero(starts), np.flatnonzero(ends) + 1


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool) -> np.ndarray:
    """64-bit hash of each span's bytes (A-Z lower-cased when ``lower``)."""
    if not len(starts):
        return np.zeros(0, U)
    padded = np.zeros(len(data) + 16, np.uint8)
    padded[:len(data)] = _LOWER[data] if lower else data
    lanes = np.ndarray(len(data) + 9, "<u8", padded.data, 0, (1,))  # the 8 bytes from every place on
    n = ends - starts
    h = mix64((lanes[starts] & _LANE[np.minimum(n, 8)]) ^ U(0x9E3779B97F4A7C15))
    second = np.flatnonzero(n > 8)
    if len(second):
        h[second] += mix64((lanes[starts[second] + 8] & _LANE[np.minimum(n[second] - 8, 8)]) ^ U(0x8CB92BA72F3D8DD7))
    h = mix64(h + n.astype(U) * U(0xD6E8FEB86659FD93))
    long = np.flatnonzero(n > 16)
    if len(long):
        raw = memoryview(padded)
        digest = hashlib.blake2b
        h[long] = np.frombuffer(b"".join([digest(raw[a:b], digest_size=8).digest() for a, b in
                                          zip(starts[long].tolist(), ends[long].tolist())]), "<u8")
    return h


class Words(NamedTuple):
    doc: np.ndarray     # row within the slice
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    bounds: np.ndarray  # first word of each document, n + 1


def words(s: Slice, lower: bool = True) -> Words:
    """Every word of the slice, in order."""
    start, end = runs(~SPACE[s.data], s.bounds)
    bounds = np.searchsorted(start, s.bounds)
    doc = np.repeat(np.arange(s.docs), np.diff(bounds))
    return Words(doc, start, end, span_hashes(s.data, start, end, lower), bounds)


def pair_hash(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Ordered combination of two hashes."""
    return mix64(a * U(0xC2B2AE3D27D4EB4F) + (b ^ (b >> U(29))))


def released(run):
    """``run`` over batches, which gives free memory back to the system at its end: workers are reused by later stages."""
    def and_release(batches):
        yield from run(batches)
        pa.default_memory_pool().release_unused()
        try:
            ctypes.CDLL(None).malloc_trim(0)
        except (OSError, AttributeError):  # no such function outside of glibc
            pass

    return and_release
