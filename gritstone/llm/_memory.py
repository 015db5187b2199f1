"""Python workers live on from task to task, and with them what a task has freed but not given back to the system."""

from __future__ import annotations

import ctypes
import functools
from collections.abc import Callable, Iterator

import pyarrow as pa

_Batches = Iterator[pa.RecordBatch]


def give_back() -> None:
    """Give freed memory back to the system, where the allocators can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError, TypeError):  # not glibc
        pass


def frugal(f: Callable[[_Batches], _Batches]) -> Callable[[_Batches], _Batches]:
    """A function for ``mapInArrow`` that gives back at its end what it has freed, so that an idle worker is small."""

    @functools.wraps(f)
    def own(batches: _Batches) -> _Batches:
        try:
            yield from f(batches)
        finally:
            give_back()

    return own
