"""What a Python worker gives back when a task ends: workers live on, and the next task in them may be another stage's."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa

from tickharbor.llm import encoding, textbytes

Batches = Iterator[pa.RecordBatch]


def release() -> None:
    """Drop encoders and tables that grew with the longest text, and return what the allocators hold free."""
    encoding.forget()
    textbytes.SpanHash.shrink()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass  # another C library: nothing to give back by hand


def freed(function: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """The function of a task's batches, with memory given back before its first and after its last one."""
    @functools.wraps(function)
    def run(batches: Batches) -> Batches:
        release()
        try:
            yield from function(batches)
        finally:
            release()

    return run
