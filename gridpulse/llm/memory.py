"""Memory that a task used goes back to the system when it is done.

Spark keeps Python workers for later tasks, and allocators keep what was freed; so without this an executor holds the largest
task that each of its workers ever had, next to whatever runs now.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from functools import wraps

import pyarrow as pa


def give_back() -> None:
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # only the GNU library has it
    if trim is not None:
        trim(0)


def given_back(batches: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """The same function of a task's batches, which gives memory back at the end."""

    @wraps(batches)
    def run(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        yield from batches(rows)
        give_back()

    return run
