"""Text columns as numpy byte arrays: chunks, word spans, span hashes, code points."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Iterable, Iterator
from functools import cache

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 500_000  # the arrays of a chunk should fit a core's cache
U64 = np.uint64

SPACES = np.zeros(256, bool)  # \x20 and \x09-\x0D
SPACES[[0x20, *range(0x09, 0x0E)]] = True
NOT_SPACE = ~SPACES
LOWER = np.arange(256, dtype=np.uint8)  # A-Z to a-z, other bytes as they are
LOWER[0x41:0x5B] += 0x20


def chunks(batches: Iterable[pa.RecordBatch], text: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Cut batches so that the texts of each cut hold about ``limit`` bytes; a longer text comes alone."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
        ends, start = np.cumsum(sizes, dtype=np.int64), 0
        while start < batch.num_rows:
            before = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, before + limit, "right")))
            yield batch.slice(start, stop - start)
            start = stop
    release_memory()


def release_memory() -> None:
    """Give free pages back: a worker may wait long for its next task, and other operators run in it."""
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(AttributeError, OSError):  # only some C libraries have it
        ctypes.CDLL(None).malloc_trim(0)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of a string or binary column and the offset of each row; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, b"" if pa.types.is_binary(column.type) or pa.types.is_large_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, places, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(places, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    offsets = offsets.astype(np.int64)
    if data is None or offsets[-1] == offsets[0]:
        return np.zeros(0, np.uint8), np.zeros(len(offsets), np.int64)
    return np.frombuffer(data, np.uint8)[offsets[0]:offsets[-1]], offsets - offsets[0]


def spans(inside: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Runs of true bytes, none across rows: starts, ends, and for each row its first run's number."""
    n = len(inside)
    if not n:
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    begins, stops = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    stops[:-1] &= ~inside[1:]
    heads, tails = offsets[:-1], offsets[1:]
    heads, tails = heads[heads < n], tails[tails > 0] - 1
    begins[heads], stops[tails] = inside[heads], inside[tails]
    starts, ends = np.flatnonzero(begins), np.flatnonzero(stops) + 1
    return starts, ends, np.searchsorted(starts, offsets)


@cache
def byte_codes(seed: int, fold: bool) -> np.ndarray:
    """A random 64-bit code for each byte; with ``fold``, A-Z have those of a-z."""
    codes = np.random.default_rng(seed).integers(1, 2**64 - 1, 256, dtype=np.uint64)
    return codes[LOWER] if fold else codes


_POWERS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def powers(base: int, n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse modulo 2**64."""
    have = _POWERS.get(base)
    if have is None or len(have[0]) < n:
        size = max(n, 1 << 16)
        up, down = (np.full(size, U64(b % 2**64)) for b in (base, pow(base, -1, 2**64)))
        up[0] = down[0] = 1
        have = np.cumprod(up), np.cumprod(down)
        if size <= 16 * CHUNK_BYTES:
            _POWERS[base] = have
    return have[0][:n], have[1][:n]


def mix(x: np.ndarray) -> np.ndarray:
    """The finalizer of splitmix64: a bijection that spreads every bit."""
    x = (x ^ (x >> U64(30))) * U64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> U64(27))) * U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def running(values: np.ndarray, base: int) -> tuple[np.ndarray, np.ndarray]:
    """Prefix sums of values times powers of ``base``, for :func:`between`."""
    up, down = powers(base, len(values) + 1)
    total = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[:-1], out=total[1:])
    return total, down


def between(sums: tuple[np.ndarray, np.ndarray], starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span, the same wherever the span stands."""
    total, down = sums
    return mix((total[ends] - total[starts]) * down[starts] + (ends - starts).astype(np.uint64) * U64(0x9E3779B97F4A7C15))


BASES = (0x9E3779B97F4A7C15, 0xD1342543DE82EF95)  # any odd numbers will do


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0, fold: bool = False) -> np.ndarray:
    if not len(starts):
        return np.zeros(0, np.uint64)
    return between(running(byte_codes(seed, fold)[data], BASES[seed % 2]), starts, ends)


def window_hashes(words: np.ndarray, width: int, seed: int = 0) -> np.ndarray:
    """A hash of every ``width`` consecutive word hashes; windows that cross rows are among them."""
    if len(words) < width:
        return np.zeros(0, np.uint64)
    at = np.arange(len(words) - width + 1)
    return between(running(words, BASES[(seed + 1) % 2]), at, at + width)


def row_of(first: np.ndarray) -> np.ndarray:
    """The row of each run, from the rows' first runs."""
    return np.repeat(np.arange(len(first) - 1), np.diff(first))


def code_points(data: np.ndarray) -> np.ndarray:
    """How many code points begin before each byte."""
    out = np.zeros(len(data) + 1, np.int64)
    np.cumsum((data & 0xC0) != 0x80, out=out[1:])
    return out


def within(starts: np.ndarray, lengths: np.ndarray) -> np.ndarray:
    """The positions of all spans, one span after another."""
    ends = np.cumsum(lengths)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(starts - (ends - lengths), lengths)


def per_row(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """The sum of values over each row's runs."""
    total = np.zeros(len(values) + 1, np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]


def binary_array(data: np.ndarray, offsets: np.ndarray, kind: pa.DataType = pa.binary()) -> pa.Array:
    """An Arrow string or binary array over bytes that are already laid out."""
    wide = pa.types.is_large_binary(kind) or pa.types.is_large_string(kind)
    places = np.ascontiguousarray(offsets, np.int64 if wide else np.int32)
    return pa.Array.from_buffers(kind, len(offsets) - 1, [None, pa.py_buffer(places), pa.py_buffer(np.ascontiguousarray(data))])
