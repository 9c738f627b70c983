"""What a task's Python process does when its rows are finished."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import pyarrow as pa

Batches = Iterator[pa.RecordBatch]


def returning_memory(run: Callable[[Batches], Batches]) -> Callable[[Batches], Batches]:
    """``run`` for ``mapInArrow``; freed memory goes back to the system when it ends.

    Spark keeps worker processes for later tasks. What their allocators hold counts against the executor while stages
    without Python run.
    """

    def running(batches: Batches) -> Batches:
        try:
            yield from run(batches)
        finally:
            pa.default_memory_pool().release_unused()
            trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of the GNU library only
            if trim is not None:
                trim(0)

    return running
