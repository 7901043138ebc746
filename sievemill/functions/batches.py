"""Arrow batches in small slices, for Python that makes much of a little text."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa

#: Rows and bytes of a slice, at most; a larger row is a slice of its own.
ROWS, BYTES = 1000, 1 << 20

try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # another C library
    _trim = None


def release() -> None:
    """Gives freed memory back to the system."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def slices(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch's rows in order, without copies."""
    stack = [batch]
    while stack:
        b = stack.pop()
        if b.num_rows > 1 and (b.num_rows > ROWS or b.get_total_buffer_size() > BYTES and b.nbytes > BYTES):
            half = b.num_rows // 2
            stack += [b.slice(half), b.slice(0, half)]
        elif b.num_rows:
            yield b


def sliced(run: Callable[[pa.RecordBatch], pa.RecordBatch]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """A function of mapInArrow from one of slices, each sent on before the next is taken."""

    def wrapped(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        try:
            for batch in batches:
                for part in slices(batch):
                    yield run(part)
        finally:
            release()

    return wrapped
