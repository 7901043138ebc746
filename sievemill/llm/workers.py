"""Memory of Python workers, which Spark keeps from one stage to the next."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa

try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # another C library
    _trim = None


def release() -> None:
    """Gives freed memory back to the system: Arrow's pool and the allocator of numpy arrays hold on to it otherwise."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function of mapInArrow that leaves no freed memory behind at the end of a partition."""

    @functools.wraps(run)
    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            yield from run(batches)
        finally:
            release()

    return wrapped


def lean_group(run: Callable[[tuple, pa.Table], pa.Table]) -> Callable[[tuple, pa.Table], pa.Table]:
    """A function of applyInArrow that gives memory back after a group of some size."""

    def wrapped(key: tuple, table: pa.Table) -> pa.Table:
        large = table.nbytes > 1 << 22
        try:
            return run(key, table)
        finally:
            if large:
                release()

    return wrapped
