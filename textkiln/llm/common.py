"""Helpers shared by the operators: hashing and batch plumbing."""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

from textkiln.functions.workers import trim
from textkiln.operators.storage import TEXT_ROWS, text_batches  # noqa: F401  the operators take them from here

#: Fixed constants of the splitmix64 finaliser.
MIX_A, MIX_B = np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)
GOLDEN = np.uint64(0x9E3779B97F4A7C15)


def splitmix(x: np.ndarray) -> np.ndarray:
    """64-bit finaliser, elementwise; wraps modulo 2**64."""
    x = (x ^ (x >> np.uint64(30))) * MIX_A
    x = (x ^ (x >> np.uint64(27))) * MIX_B
    return x ^ (x >> np.uint64(31))


def slices(batches: Iterator[pa.RecordBatch], column: str, max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in batches whose ``column`` holds about ``max_bytes`` at most (one row at least)."""
    for batch in batches:
        col = batch.column(column)
        if batch.num_rows == 0:
            continue
        if pa.types.is_large_string(col.type) or pa.types.is_large_binary(col.type):
            off = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
        else:
            off = np.frombuffer(col.buffers()[1], np.int32)[col.offset : col.offset + len(col) + 1]
        at = 0
        while at < batch.num_rows:
            to = max(at + 1, int(np.searchsorted(off, int(off[at]) + max_bytes, "right")) - 1)
            to = min(to, batch.num_rows)
            yield batch.slice(at, to - at)
            at = to


def trimmed(run):
    """The batches of ``run``, then trim()."""

    @functools.wraps(run)
    def whole(*args, **options):
        try:
            yield from run(*args, **options)
        finally:
            trim()

    return whole


def text_buffers(col: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets of a string column; a null is empty."""
    col = col.cast(pa.large_string()).fill_null("") if col.null_count else col.cast(pa.large_string())
    off = np.frombuffer(col.buffers()[1], np.int64)[col.offset : col.offset + len(col) + 1]
    data = np.frombuffer(col.buffers()[2] or b"", np.uint8)[off[0] : off[-1]]
    return data, off


def batch_of(schema: pa.Schema, columns: list) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(columns, schema, strict=True)], schema=schema)
