"""Byte-level text kernels used inside Arrow tasks.

All of them work on the concatenated UTF-8 buffer of a slice of rows, so the
cost per document is a few vector operations however short it is. Separators
are ASCII, so words can be cut on bytes. Hashes are 64-bit: a polynomial in an
odd base modulo 2^64 over random symbol values, finished by a bit mixer.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa

SLICE_BYTES = 4 << 20  # text handled at once; a longer document is a slice of its own

U64 = np.uint64
_BASE = 0x9E3779B97F4A7C15  # odd
_INVERSE = pow(_BASE, -1, 1 << 64)
_TABLES: dict[str, np.ndarray] = {}


def mix(x: np.ndarray) -> np.ndarray:
    """Bijective 64-bit finaliser (in place on a fresh array)."""
    x = np.array(x, dtype=U64)
    x ^= x >> U64(30)
    x *= U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    x ^= x >> U64(31)
    return x


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base^i and base^-i for i < n, modulo 2^64; kept between slices."""
    if len(_TABLES.get("pow", ())) < n:
        size = -(-n >> 17) << 17  # some more, for slices of about the same length
        for name, base in (("pow", _BASE), ("inv", _INVERSE)):
            steps = np.full(size, base, dtype=U64)
            steps[0] = 1
            _TABLES[name] = np.cumprod(steps, dtype=U64)
    return _TABLES["pow"], _TABLES["inv"]


class RangeHash:
    """Hash of any range of a sequence of 64-bit symbols in constant time."""

    def __init__(self, symbols: np.ndarray):
        n = len(symbols)
        powers, self.inverse = _powers(n + 1)
        self.prefix = np.zeros(n + 1, dtype=U64)
        np.cumsum(symbols * powers[:n], dtype=U64, out=self.prefix[1:])

    def __call__(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        out = self.prefix[end]
        out -= self.prefix[start]
        out *= self.inverse[start]
        out ^= (end - start).astype(U64) * U64(0xD6E8FEB86659FD93)
        return mix(out)


def byte_symbols(lower: bool = False) -> np.ndarray:
    """A random 64-bit value for each byte; A-Z get those of a-z if ``lower``."""
    table = mix(np.arange(1, 257, dtype=U64) * U64(_BASE))
    if lower:
        table[65:91] = table[97:123]
    return table


def _byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    out = np.zeros(256, dtype=bool)
    for lo, hi in ranges:
        out[lo:hi + 1] = True
    return out


BLANK_SPLIT = ~_byte_set((0x20, 0x20), (0x09, 0x0D))                # [^\x20\x09-\x0D]
ALNUM_SPLIT = _byte_set((0x30, 0x39), (0x61, 0x7A), (0x80, 0xFF))   # after lower-casing A-Z
ALNUM_SPLIT[65:91] = True


def column_slices(batch: pa.RecordBatch, column: str, max_bytes: int = SLICE_BYTES):
    """Yield (first row, offsets, bytes) over runs of rows of about ``max_bytes``.

    ``offsets`` has one entry more than the run has rows and starts at 0. Null
    texts count as empty.
    """
    array = batch.column(batch.schema.get_field_index(column))
    if array.null_count:
        array = array.fill_null(b"" if pa.types.is_binary(array.type) or pa.types.is_large_binary(array.type) else "")
    wide = pa.types.is_large_string(array.type) or pa.types.is_large_binary(array.type)
    _, where, what = array.buffers()
    n = len(array)
    if not n:
        return
    offsets = np.frombuffer(where, dtype=np.int64 if wide else np.int32,
                            count=array.offset + n + 1)[array.offset:].astype(np.int64)
    data = np.frombuffer(what, dtype=np.uint8) if what is not None else np.zeros(0, np.uint8)
    row = 0
    while row < n:
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + max_bytes, "right")) - 1)
        lo, hi = int(offsets[row]), int(offsets[end])
        yield row, offsets[row:end + 1] - lo, data[lo:hi]
        row = end


class Words:
    """Words of a slice: byte ranges, and the first word of each row."""

    def __init__(self, offsets: np.ndarray, data: np.ndarray, is_word: np.ndarray):
        edge = np.zeros(len(data) + 1, dtype=bool)
        edge[offsets] = True
        inside = np.zeros(len(data) + 2, dtype=bool)
        inside[1:-1] = is_word[data]
        here, before, after = inside[1:-1], inside[:-2], inside[2:]
        self.data, self.offsets = data, offsets
        self.start = np.flatnonzero(here & (~before | edge[:-1]))
        self.end = np.flatnonzero(here & (~after | edge[1:])) + 1
        self.first = np.searchsorted(self.start, offsets)  # per row, and one past the last
        self.counts = np.diff(self.first)

    def __len__(self) -> int:
        return len(self.start)

    def hashes(self, lower: bool) -> np.ndarray:
        return RangeHash(byte_symbols(lower)[self.data])(self.start, self.end)

    def row(self) -> np.ndarray:
        """Row of each word."""
        return np.repeat(np.arange(len(self.counts)), self.counts)


def binary_column(flat: np.ndarray, lengths: np.ndarray) -> pa.Array:
    """Cut a flat array into one binary value per row; ``lengths`` in items."""
    offsets = np.zeros(len(lengths) + 1, dtype=np.int32)
    np.cumsum(np.asarray(lengths) * flat.itemsize, out=offsets[1:])
    return pa.Array.from_buffers(pa.binary(), len(lengths),
                                 [None, pa.py_buffer(offsets), pa.py_buffer(np.ascontiguousarray(flat))])


def unpack(array: pa.Array, dtype) -> tuple[np.ndarray, np.ndarray]:
    """(flat items, offsets in items) of a binary column without nulls."""
    _, where, what = array.buffers()
    if not len(array):
        return np.zeros(0, dtype), np.zeros(1, np.int64)
    offsets = np.frombuffer(where, dtype=np.int32, count=array.offset + len(array) + 1)[array.offset:]
    data = np.frombuffer(what, dtype=np.uint8) if what is not None else np.zeros(0, np.uint8)
    flat = data[offsets[0]:offsets[-1]]
    size = np.dtype(dtype).itemsize
    return np.frombuffer(flat.tobytes(), dtype=dtype), (offsets - offsets[0]).astype(np.int64) // size


def spans_to_mask(start: np.ndarray, end: np.ndarray, n: int) -> np.ndarray:
    """Positions below n covered by any [start, end)."""
    turns = np.bincount(start, minlength=n + 1) - np.bincount(end, minlength=n + 1)
    return np.cumsum(turns[:n]) > 0
