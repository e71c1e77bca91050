"""Memory of Python workers: they serve one task after the other, and what a task has freed should not stay with them."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa

try:
    _trim = ctypes.CDLL("libc.so.6").malloc_trim
except (OSError, AttributeError):  # another C library keeps its own counsel
    _trim = None


def release() -> None:
    """Gives free memory of Arrow and numpy back to the system."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def lean(run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable:
    """A function for ``mapInArrow`` that releases what it has freed after every batch and at its end."""
    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for out in run(batches):
            yield out
            del out
            release()
        release()
    return over
