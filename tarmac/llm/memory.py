"""Memory that the Python workers give back.

Spark keeps its Python workers for later tasks. What a kernel has freed stays with the allocators of Arrow and of
the C library meanwhile, some 100 to 300 MB in each worker, and counts against the executor beside the JVM's heap.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa


def give_back() -> None:
    """Return what is free to the system. Without glibc, only Arrow's part."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def returning(run: Callable[..., Iterator[pa.RecordBatch]]) -> Callable[..., Iterator[pa.RecordBatch]]:
    """``run`` over the batches of a task, which gives memory back at its end."""

    @wraps(run)
    def task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from run(batches)
        give_back()

    return task


def returning_group(run: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """``run`` on a group, which gives memory back at its end."""

    @wraps(run)
    def group(table: pa.Table) -> pa.Table:
        result = run(table)
        give_back()
        return result

    return group
