"""Arrow workers on columns of texts: a batch is worked on part by part, and each part is given back as soon as it is made."""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

#: Values (bytes of texts, elements of lists) that a worker turns into Python objects at a time.
PART = 1 << 20


def cuts(rows: pa.Array, most: int = PART) -> Iterator[tuple[int, int]]:
    """(first, number) of runs of rows that hold about ``most`` values at most, one row at least."""
    wide = pa.types.is_large_string(rows.type) or pa.types.is_large_list(rows.type)
    off = np.frombuffer(rows.buffers()[1] or bytes(8), np.int64 if wide else np.int32)[rows.offset : rows.offset + len(rows) + 1]
    at = 0
    while at < len(rows):
        to = min(len(rows), max(at + 1, int(np.searchsorted(off, int(off[at]) + most, "right")) - 1))
        yield at, to - at
        at = to


def trim() -> None:
    """Gives memory that is free in this worker back to the system: workers live on after their task. Without effect where there is no malloc_trim."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (OSError, AttributeError):
        pass


def by_workers(make: Callable[[], Callable[[list], pa.Array | list]], ddl: str, kind: pa.DataType) -> Callable[[Column], Column]:
    """A column function by Arrow workers: ``make`` is called once a task and gives a function from a list of values to the list of results.

    Only PART of a batch is held as Python objects, so memory follows neither the rows of a batch nor those of the table.
    """

    @F.arrow_udf(ddl)
    def run(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        fn = make()
        try:
            for rows in batches:
                if not len(rows):
                    yield pa.array([], kind)
                for at, n in cuts(rows):
                    out = fn(rows.slice(at, n).to_pylist())
                    yield out if isinstance(out, pa.Array) else pa.array(out, kind)
        finally:
            trim()

    return run
