"""Words and their 64-bit hashes for whole Arrow batches of texts (numpy, no loop over words).

A text column becomes one byte string with offsets; words are the runs of bytes
outside a separator class.  UTF-8 continuation bytes are never separators here, so
byte runs and character runs are the same.  Nothing is cut: a batch is processed
in slices of bounded size, and one long text in blocks of words.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: White space that ends a word: x20 and x09 to x0D.
SPACES = bytes([0x20, *range(0x09, 0x0E)])
#: A-Z to a-z, byte for byte.
LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
#: Text bytes that one step handles at once.
STEP_BYTES = 2 << 20
#: Text bytes that are hashed at once (temporary arrays take some 60 times this).
HASH_BYTES = 512 << 10

_U = np.uint64
_RNG = np.random.default_rng(20240611)
_BYTE = _RNG.integers(1, 2**63, 256, dtype=np.uint64) * _U(2) + _U(1)
_BASE = _U(0x9E3779B97F4A7C15)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every input bit (finaliser of a multiply-xorshift hash)."""
    x = x ^ (x >> _U(33))
    x = x * _U(0xFF51AFD7ED558CCD)
    x = x ^ (x >> _U(33))
    x = x * _U(0xC4CEB9FE1A85EC53)
    return x ^ (x >> _U(33))


def text_buffer(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
        if isinstance(column, pa.ChunkedArray):
            column = pa.concat_arrays(column.chunks) if column.num_chunks else pa.array([], column.type)
    column = pc.fill_null(column.cast(pa.large_binary()), b"")
    offsets = np.frombuffer(column.buffers()[1], np.int64, len(column) + 1, column.offset * 8) if len(column) else np.zeros(1, np.int64)
    raw = column.buffers()[2] if len(column) else None
    data = np.frombuffer(raw, np.uint8) if raw is not None and raw.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batch, column: str, limit: int = STEP_BYTES) -> Iterator:
    """Runs of rows of a batch or table with about ``limit`` bytes of text each (one row at least)."""
    n = batch.num_rows
    if not n:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    block = (np.cumsum(sizes) - sizes) // limit
    cuts = [0, *(np.flatnonzero(np.diff(block)) + 1).tolist(), n]
    for a, b in zip(cuts, cuts[1:]):
        yield batch.slice(a, b - a)
    release()


def release() -> None:
    """Hands memory that is free again back to the system: Spark keeps its Python workers, and idle ones count too."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):  # another C library keeps its own account
        pass


@dataclass
class Words:
    """Words of a batch in order: byte spans, the row each is in, and for each row its first word."""

    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    first: np.ndarray  # len(rows) + 1; words of row i are first[i]:first[i + 1]

    @property
    def rows(self) -> np.ndarray:
        return np.repeat(np.arange(len(self.first) - 1), np.diff(self.first))


def find_words(data: np.ndarray, offsets: np.ndarray, separators: bytes = SPACES) -> Words:
    table = np.ones(256, bool)
    table[list(separators)] = False
    inside = np.zeros(len(data) + 1, bool)
    inside[:-1] = table[data]
    edge = np.zeros(len(data) + 1, bool)  # a row starts here
    edge[offsets] = True
    before = np.zeros(len(data) + 1, bool)
    before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (edge | ~before))
    ends = np.flatnonzero(before & (edge | ~inside))
    return Words(data, starts, ends, np.searchsorted(starts, offsets))


def hash_words(w: Words, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of each word's bytes (with ``lower``, after A-Z became a-z)."""
    out = np.empty(len(w.starts), np.uint64)
    value = _BYTE[np.frombuffer(LOWER, np.uint8)] if lower else _BYTE
    longest = int((w.ends - w.starts).max(initial=0))
    power = np.cumprod(np.full(min(longest, 2 * HASH_BYTES) + 1, _BASE), dtype=np.uint64)
    a, n = 0, len(w.starts)
    while a < n:
        b = max(a + 1, int(np.searchsorted(w.ends, w.starts[a] + HASH_BYTES)))
        lo, hi = int(w.starts[a]), int(w.ends[b - 1])
        if hi - lo > 2 * HASH_BYTES:  # one word of many MB
            out[a] = _long_word(w.data[lo:hi], value)
            a = b
            continue
        s, length = w.starts[a:b] - lo, w.ends[a:b] - w.starts[a:b]
        at = np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        terms = value[w.data[np.repeat(s, length) + at + lo]] * power[at]
        out[a:b] = np.add.reduceat(terms, np.cumsum(length) - length)
        a = b
    return mix(out ^ (w.ends - w.starts).astype(np.uint64))


def _long_word(data: np.ndarray, value: np.ndarray) -> np.uint64:
    total, scale = np.zeros(1, np.uint64), np.ones(1, np.uint64)
    power = np.cumprod(np.full(HASH_BYTES + 1, _BASE), dtype=np.uint64)
    for a in range(0, len(data), HASH_BYTES):
        part = value[data[a:a + HASH_BYTES]]
        total = total + scale * (part * power[:len(part)]).sum(dtype=np.uint64)
        scale = scale * power[len(part) - 1]
    return total[0]


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's bigint."""
    return x.view(np.int64)
