"""Sorted number arrays as compact byte strings, for exchanges of runs between tasks."""

from __future__ import annotations

import ctypes
import functools

import numpy as np
import pyarrow as pa
import zstandard


@functools.cache
def _codec() -> tuple[zstandard.ZstdCompressor, zstandard.ZstdDecompressor]:
    return zstandard.ZstdCompressor(level=1), zstandard.ZstdDecompressor()


@functools.cache
def _libc() -> ctypes.CDLL | None:
    try:
        return ctypes.CDLL("libc.so.6")
    except OSError:
        return None


def give_back() -> None:
    """Return freed memory to the system. Python workers are reused from stage to stage, and what they keep adds up."""
    pa.default_memory_pool().release_unused()
    if _libc():
        _libc().malloc_trim(0)


def squeeze(data: bytes) -> bytes:
    return _codec()[0].compress(data)


def unsqueeze(data: bytes) -> bytes:
    return _codec()[1].decompress(data)


def dump(values: np.ndarray) -> bytes:
    """An array of any integer or float type, byte planes apart (high bytes are mostly equal), compressed."""
    planes = np.ascontiguousarray(values).view(np.uint8).reshape(-1, values.dtype.itemsize).T
    return values.dtype.str.encode() + b"\n" + squeeze(np.ascontiguousarray(planes).tobytes())


def load(data: bytes) -> np.ndarray:
    kind, _, packed = data.partition(b"\n")
    dtype = np.dtype(kind.decode())
    planes = np.frombuffer(unsqueeze(packed), np.uint8).reshape(dtype.itemsize, -1)
    return np.ascontiguousarray(planes.T).reshape(-1).view(dtype)


def dump_sorted(values: np.ndarray) -> bytes:
    """Sorted unsigned 64-bit integers as differences."""
    return dump(np.diff(values, prepend=np.uint64(0)))


def load_sorted(data: bytes) -> np.ndarray:
    return np.cumsum(load(data), dtype=np.uint64)


def dump_small(values: np.ndarray) -> bytes:
    """Non-negative integers in the narrowest type that holds them."""
    top = int(values.max()) if len(values) else 0
    return dump(values.astype(np.uint8 if top < 1 << 8 else np.uint16 if top < 1 << 16 else np.uint32 if top < 1 << 32 else np.uint64))


def range_cuts(keys: np.ndarray, ranges: int) -> np.ndarray:
    """Where sorted 64-bit keys pass from one of `ranges` equal ranges to the next."""
    edges = (np.arange(1, ranges, dtype=np.uint64) * np.uint64((1 << 64) // ranges)) if ranges > 1 else np.zeros(0, np.uint64)
    return np.concatenate([[0], np.searchsorted(keys, edges), [len(keys)]])
